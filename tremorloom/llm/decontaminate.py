"""Benchmark decontamination (operator 10), in DataFrame functions only.

A window is ``size`` consecutive words of a benchmark item, or the whole of a shorter item. First a filter that loses nothing:
every place where a window of m words can stand covers one of the text's aligned grams of ``(m + 1) // 2`` words, so one hash
in ``m - (m + 1) // 2 + 1`` positions is looked up among the grams of the windows. Texts with such a gram are scanned
at every position; hits are verified on the words themselves. The tables of grams and windows are broadcast while they
are small (they come from the benchmark alone, and are counted first), else joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorloom.llm.common import lower_ascii, stash

WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: rows of a table that is broadcast (hashes, keys of fixed length, windows of at most ``size`` words)
BROADCAST_ROWS = 2_000_000
BROADCAST_KEYS = 200_000


def words_of(text):
    """The words of a text: A-Z lower-cased, runs of letters, digits and code points above 127."""
    normal = F.trim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), WORDS, " "))
    return F.when(normal == "", F.array().cast("array<string>")).otherwise(F.split(normal, " "))


def _grams(words, size, step, first=None):
    """Hashes of the grams of ``size`` words that begin at every ``step``-th word."""
    last = F.size(words) - size
    return F.when(last < 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(step)), lambda i: F.xxhash64(F.slice(words, i + 1, size)))
    )


def _small(df: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if rows <= most else df


def benchmark_windows(benchmark: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """``item, m, hash, words``: the distinct windows of each item."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("item"), words_of(F.col(f"`{text_col}`")).alias("w"))
    items = items.where("item IS NOT NULL AND size(w) > 0").withColumn("m", F.least(F.size("w"), F.lit(size)))
    at = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("m") + 1)).alias("at")
    windows = items.select("item", "m", "w", at).select("item", "m", F.slice("w", F.col("at"), F.col("m")).alias("words"))
    return windows.distinct().withColumn("hash", F.xxhash64("words"))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items, spans`` for every row.

    ``items``: ids (as text, sorted) of the items with an occurring window; ``spans``: first and last word of each stretch of hit
    words, from 0. NULL and empty texts have no words and no hits. Rows that share an id and differ in text are told apart
    by their text; equal rows have equal results. Items without words or id have no windows. Empty tables give no rows or no hits.
    """
    windows = stash(benchmark_windows(benchmark, size, item_col, item_text_col), "windows")
    lengths = {r["m"]: r["n"] for r in windows.groupBy("m").agg(F.count("*").alias("n")).collect()}  # at most ``size`` rows
    body, doc = F.col(f"`{text_col}`"), F.col(f"`{id_col}`").cast("long")
    # a row is known by its id and its text
    key = F.concat(F.coalesce(doc.cast("string"), F.lit("-")), F.lit(":"), F.sha2(F.coalesce(body, F.lit("")).cast("binary"), 256))
    worded = docs.select(doc.alias("doc_id"), key.alias("key"), words_of(body).alias("w"))
    counted = stash(worded.select("doc_id", "key", F.size("w").cast("long").alias("n_words")), "word-counts")
    no_items, no_spans = F.array().cast("array<string>"), F.array().cast("array<struct<first:int,last:int>>")
    if not lengths:
        zero = F.lit(0).cast("long")
        return counted.select("doc_id", "n_words", zero.alias("n_hit"), zero.alias("n_items"), no_items.alias("items"), no_spans.alias("spans"))
    grams = None
    for m in sorted(lengths):
        g = (m + 1) // 2
        of_window = F.transform(F.sequence(F.lit(1), F.lit(m - g + 1)), lambda i: F.xxhash64(F.slice("words", i, g)))
        own = windows.where(F.col("m") == m).select(F.explode(of_window).alias("gram"), F.lit(m).alias("m"))
        grams = own if grams is None else grams.unionByName(own)
    grams = stash(grams.distinct(), "window-grams")
    looked = [F.struct(F.lit(m).alias("m"), _grams(F.col("w"), (m + 1) // 2, m - (m + 1) // 2 + 1).alias("grams")) for m in sorted(lengths)]
    probe = worded.select("key", F.explode(F.array(*looked)).alias("p")).select("key", F.col("p.m").alias("m"), F.explode("p.grams").alias("gram"))
    candidates = stash(probe.join(_small(grams, grams.count()), ["m", "gram"], "left_semi").select("key").distinct(), "candidates")
    # the words of candidates alone, each text once
    chosen = worded.join(_small(candidates, candidates.count(), BROADCAST_KEYS), "key", "left_semi").select("key", "w")
    chosen = stash(chosen.dropDuplicates(["key"]), "candidate-words")
    places = None
    for m in sorted(lengths):
        own = chosen.select("key", "w", F.posexplode(_grams(F.col("w"), m, 1)).alias("at", "hash"), F.lit(m).alias("m"))
        places = own if places is None else places.unionByName(own)
    hits = (
        places.join(_small(windows.withColumnRenamed("words", "window"), sum(lengths.values())), ["m", "hash"])
        .where(F.slice("w", F.col("at") + 1, F.col("m")) == F.col("window"))
        .select("key", "at", "m", "item")
    )
    hits = stash(hits, "hits")
    items = hits.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    covered = hits.select("key", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("m") - 1)).alias("at")).distinct()
    words = covered.groupBy("key").agg(F.sort_array(F.collect_list("at")).alias("hit"))
    first = F.filter("hit", lambda x, i: (i == 0) | (F.get("hit", i - 1) != x - 1))
    last = F.filter("hit", lambda x, i: (i == F.size("hit") - 1) | (F.get("hit", i + 1) != x + 1))
    spans = words.select("key", F.size("hit").alias("n"), F.arrays_zip(first.alias("first"), last.alias("last")).alias("spans"))
    found = counted.join(items.join(spans, "key"), "key", "left")
    return found.select(
        "doc_id",
        "n_words",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.array_size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", no_items).alias("items"),
        F.coalesce("spans", no_spans).alias("spans"),
    )
