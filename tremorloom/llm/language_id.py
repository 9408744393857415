"""Language ID (operator 6): compression classification with one zstandard raw-content dictionary per language.

A dictionary is text of the language from a bounded sample of labelled rows (the first ``sample_chars`` characters of
``sample_docs`` texts per language, the first by a hash of the id). A text is cut into blocks, each block is
compressed with every dictionary, and the language whose sizes add up to least is chosen. A text of any length is read
whole. The margin is how much larger the second smallest sum is; where it is narrow the text is
rejected: under ``margin_share`` of the bytes compared plus ``NOISE`` times their square root, as the difference between two
languages grows with the text and chance with its root. Equal sums are always too narrow. Without ``margin_share`` only long texts
with next to no margin are rejected. ``learn_margins`` fits the narrowest margin of each language on all other labelled rows instead,
so that a stated share of them is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import sqrt

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremorloom.llm.common import found_by_workers, id_and_bytes, slices, stash, texts_of

UNKNOWN = "und"
BLOCK = 2048
LEAST_BYTES = 512
#: chosen on labelled rows at scale factor 0.01, so that most texts of a language left out are rejected
MARGIN_SHARE = 0.018
NOISE = 0.5
LEVEL = 3
SAMPLE_DOCS, SAMPLE_CHARS = 96, 8192
#: margins are counted in cells of this width before the wanted ones are looked at one by one
CELL = 1 / 256
_LETTER = regex.compile(r"\p{L}")
_OTHERS = re.compile(r"[\W\d_]+")

_compressors: dict = {}


def _first_rows(labelled: DataFrame, docs: int, chars: int, id_col: str) -> DataFrame:
    """``id, text, lang, nth`` of the first ``docs`` rows by language that have text, cut to ``chars``."""
    usable = labelled.select(F.col(f"`{id_col}`").alias("id"), F.substring("text", 1, chars).alias("text"), "lang").where(
        "lang IS NOT NULL AND text IS NOT NULL AND text <> ''"
    )
    order = [F.xxhash64(F.col("id")), F.col("id"), F.col("text")]
    # top rows are cut in each task before the shuffle
    return usable.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("nth") <= docs)


def learn_dictionaries(
    labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS, dictionary_bytes: int = 1 << 17, id_col: str = "doc_id"
) -> dict[str, bytes]:
    """Dictionary content by language from rows of ``doc_id, text, lang``; rows without text or language are passed over.

    ``sample_docs`` and ``sample_chars`` bound what reaches the driver per language.
    """
    texts: dict[str, list[str]] = {}
    for row in _first_rows(labelled, sample_docs, sample_chars, id_col).orderBy("lang", "nth").collect():
        if _LETTER.search(row["text"]):
            texts.setdefault(row["lang"], []).append(plain(row["text"]))
    # a row per language; the commonest comes first, which decides ties
    usable = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND text <> ''")
    common = [r["lang"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()]
    # the end of a raw dictionary is nearest and cheapest to refer to
    return {lang: " ".join(texts[lang]).encode()[-dictionary_bytes:] for lang in common if lang in texts}


def _quantiles(margins: DataFrame, share: float) -> DataFrame:
    """``lang, least``: the exact quantile of each language's margins, linear between two of them as ``percentile`` has it.

    Only the cells that hold the wanted places are looked at margin by margin, so no task gets a language's margins whole.
    """
    margins = stash(margins.withColumn("cell", F.floor(F.col("margin") / CELL)), "margins")
    counted = margins.groupBy("lang", "cell").agg(F.count("*").alias("n"))
    upto, place = F.sum("n").over(Window.partitionBy("lang").orderBy("cell")), share * (F.sum("n").over(Window.partitionBy("lang")) - 1)
    cells = counted.select("lang", "cell", "n", upto.alias("upto"), place.alias("place")).withColumn("before", F.col("upto") - F.col("n"))
    low, high = F.floor("place"), F.ceil("place")
    wanted = cells.where((F.col("upto") > low) & (F.col("before") <= high)).select("lang", "cell", "before", "place")
    single = margins.join(F.broadcast(wanted), ["lang", "cell"]).groupBy("lang", "cell", "before", "place", "margin").agg(F.count("*").alias("n"))
    reached = F.col("before") + F.sum("n").over(Window.partitionBy("lang", "cell").orderBy("margin"))
    ends = single.withColumn("upto", reached).groupBy("lang", "place").agg(
        *[F.min(F.when(F.col("upto") > end, F.col("margin"))).alias(name) for name, end in (("low", low), ("high", high))]
    )
    return ends.select("lang", (F.col("low") + (F.col("high") - F.col("low")) * (F.col("place") - low)).alias("least"))


def learn_margins(
    labelled: DataFrame, dictionaries: dict[str, bytes], false_rejection: float = 0.01, skip_docs: int = SAMPLE_DOCS, level: int = LEVEL, id_col: str = "doc_id"
) -> dict[str, float]:
    """Least margin by language, in bytes for each root of the bytes compared: ``false_rejection`` of its labelled rows lie below.

    Read are all whole texts but for the ``skip_docs`` of ``learn_dictionaries`` and their equals, so no text is compared
    with itself. A language without such rows has no entry; ``language_id`` then rejects equal sums only.
    """
    ident, start = F.col(f"`{id_col}`"), F.xxhash64(F.substring("text", 1, SAMPLE_CHARS))
    usable = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND text <> ''").select(
        "lang", F.col("text").cast("binary").alias("text"), F.xxhash64(ident, ident.isNull()).alias("id_hash"), start.alias("start")
    )
    first = _first_rows(labelled, skip_docs, SAMPLE_CHARS, id_col)
    known = first.select("lang", F.xxhash64("id", F.col("id").isNull()).alias("id_hash"), F.xxhash64("text").alias("start"))
    rows = usable.join(F.broadcast(known), ["lang", "id_hash", "start"], "left_anti").select("lang", "text")
    found_by_workers(rows.sparkSession)
    held = rows.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches) -> Iterator[pa.RecordBatch]:
        made = compressors(held.value, level)
        for batch in batches:
            for part in slices(batch):
                langs, margins = [], []
                for lang, raw in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    text = raw.decode("utf-8", "replace")
                    if len(made) > 1 and _LETTER.search(text):
                        ranked, compared = sizes(text, made)
                        if ranked[0][1] == lang:
                            langs.append(lang)
                            margins.append((ranked[1][0] - ranked[0][0]) / sqrt(compared))
                yield pa.record_batch({"lang": pa.array(langs, pa.string()), "margin": pa.array(margins, pa.float64())})

    margins = rows.mapInArrow(run, "lang string, margin double")
    return {r["lang"]: r["least"] for r in _quantiles(margins, false_rejection).collect()}


def compressors(dictionaries: dict[str, bytes], level: int) -> dict:
    """A compressor per language, once per worker and set of dictionaries."""
    key = (level, tuple((k, hash(v)) for k, v in dictionaries.items()))
    if key not in _compressors:
        _compressors.clear()
        made = {}
        for lang, content in dictionaries.items():
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=level)
            made[lang] = zstandard.ZstdCompressor(dict_data=data, level=level, write_content_size=False)
        _compressors[key] = made
    return _compressors[key]


def plain(text: str) -> str:
    """Lower-case words with single spaces; signs and digits say nothing about the language but break up matches."""
    return _OTHERS.sub(" ", text.lower()).strip()


def sizes(text: str, made: dict, block: int = BLOCK) -> tuple[list[tuple[int, str]], int]:
    """Compressed size of the whole text by language, smallest first, ties in the order of the dictionaries; bytes compared.

    In each block a word counts once, or a text that repeats itself would be its own dictionary.
    """
    data = plain(text).encode()
    parts = [b" ".join(dict.fromkeys(data[i : i + block].split(b" "))) for i in range(0, len(data), block)]
    return sorted(((sum(len(c.compress(p)) for p in parts), lang) for lang, c in made.items()), key=lambda x: x[0]), sum(map(len, parts))


def language_id(
    docs: DataFrame, dictionaries: dict[str, bytes], least_margin: float = 0.001, level: int = LEVEL, id_col: str = "doc_id", text_col: str = "text",
    margin_share: float | None = None, margins: dict[str, float] | None = None,
) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every row.

    ``lang_pred`` is ``und`` and ``score`` 0 for NULL, empty and letterless texts, and where nothing was learned. ``score`` is the
    margin: by how much of it the second best sum is above the best one, 0 to 1. ``rejected``: ``und``, or with
    ``margin_share`` equal sums or too narrow a margin for the bytes compared, without it a margin below ``least_margin`` on ``LEAST_BYTES`` bytes or more.
    With ``margins`` (of ``learn_margins``) equal sums and margins under the chosen language's are rejected instead.
    Equal sums go to the first of ``dictionaries``. Rows are judged one by one, so repeated rows and
    NULL ids don't matter; an empty table gives no rows.
    """
    rows = id_and_bytes(docs, id_col, text_col)
    held = rows.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches) -> Iterator[pa.RecordBatch]:
        made = compressors(held.value, level)
        for ids, texts in texts_of(batches):
            pred, score, rejected = [], [], []
            for raw in texts:
                text = raw.decode("utf-8", "replace")
                if not made or not _LETTER.search(text):
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    rejected.append(True)
                    continue
                ranked, compared = sizes(text, made)
                pred.append(ranked[0][1])
                score.append(1.0 - ranked[0][0] / ranked[1][0] if len(ranked) > 1 else 1.0)
                if margins is not None and len(ranked) > 1:
                    apart = ranked[1][0] - ranked[0][0]
                    rejected.append(apart <= 0 or apart < margins.get(pred[-1], 0.0) * sqrt(compared))
                elif margin_share is None or len(ranked) < 2:
                    rejected.append(score[-1] < least_margin and compared >= LEAST_BYTES)
                else:
                    apart = ranked[1][0] - ranked[0][0]
                    rejected.append(apart <= 0 or apart < margin_share * compared + NOISE * sqrt(compared))
            yield pa.record_batch(
                {
                    "doc_id": ids,
                    "lang_pred": pa.array(pred, pa.string()),
                    "score": pa.array(score, pa.float64()),
                    "rejected": pa.array(rejected, pa.bool_()),
                }
            )

    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
