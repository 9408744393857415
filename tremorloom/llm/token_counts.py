"""Token counts (operator 1): two-tier lookup on the map side, no shuffle of pre-tokens.

Tier 1 is a compact table of the most frequent pre-tokens and their token counts, broadcast. Its size is fixed by
``table_size`` and ``MAX_PRETOKEN`` (at most 2 MB of text). It comes from per-task summaries over all texts: each
task keeps its own top pre-tokens, only those few rows are merged. Tier 2 is a cache in each Python worker: a
pre-token that is in neither is encoded by the tokenizer library once per worker. The table decides speed only,
every count is the library's.

A pre-token here is a run between ASCII white space; the vocabulary's splitter never joins across white space, so
the tokens of a text are those of its pre-tokens. Letters are lower-cased beforehand only where the library gives
the same ids (no special strings, no combining accents).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorloom.llm.common import id_and_bytes, slices, texts_of

VOCABULARY = "word_bpe_49k.json"
TABLE_SIZE = 32_768
TASK_TOP = 8_192
MAX_PRETOKEN = 64
CACHE_ENTRIES = 250_000
SUMMARY_ENTRIES = 400_000
_TAIL = b".,;:!?*#$%&|)"
_LATIN = re.compile("[a-zß-öø-ÿ]+")
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyz")

_encoders: dict[str, object] = {}
_caches: dict[str, tuple] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    return str(public_tokenizers.path(name))


def encoder(path: str):
    """The library's tokenizer, once per worker; its own word cache is left as it is."""
    if path not in _encoders:
        from tokenizers import Tokenizer

        _encoders[path] = Tokenizer.from_file(path)
    return _encoders[path]


def pretokens(text: bytes) -> list[bytes]:
    """Runs between white space. Special strings and combining accents forbid lower-casing before the library."""
    if b"<|" in text or b"\xcc" in text or b"\xcd" in text:
        return text.split()
    return text.lower().split()


def as_bytes(words: pa.Array) -> list[bytes]:
    """The values of an array of strings without NULLs, cut from one copy of its data (``to_pylist`` makes a scalar of each)."""
    offsets = np.frombuffer(words.buffers()[1], np.int64 if pa.types.is_large_string(words.type) else np.int32)
    ends = offsets[words.offset : words.offset + len(words) + 1].tolist()
    data = (words.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
    return [data[a:b] for a, b in zip(ends, ends[1:])]


def slice_pretokens(texts: pa.Array) -> tuple[list[bytes], pa.Array, np.ndarray]:
    """``pretokens`` of all texts of a slice at once: distinct ones, the number of each in order, and where texts begin in
    that order (with the end behind). White space at the ends of a text gives an empty pre-token, which has no tokens."""
    odd = pc.match_substring(texts, b"<|")
    for lead in (b"\xcc", b"\xcd"):
        odd = pc.or_(odd, pc.match_substring(texts, lead))
    text = texts.view(pa.string())
    lists = pc.ascii_split_whitespace(pc.if_else(odd, text, pc.ascii_lower(text)))
    coded = lists.flatten().dictionary_encode()
    starts = lists.offsets.to_numpy().astype(np.int64)
    return as_bytes(coded.dictionary), coded.indices, starts - starts[0]


def _core(word: bytes) -> bytes:
    """The word without the punctuation behind it, which is separate for the splitter if what remains ends in a letter; else the word."""
    core = word.rstrip(_TAIL)
    if core and core != word and core[-1] in _LETTERS and b"<|" not in word:
        return core
    return word


def _byte_letters() -> dict[int, str]:
    """The letters by which a byte-level vocabulary writes bytes: printable ones as they are, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(others)}}


_AS_LETTERS = _byte_letters()


class PretokenCache:
    """Pre-token -> value (a count, or ids as bytes) in front of the tokenizer.

    Two generations of ``entries`` each at most bound the memory: when the young one is full it becomes the old one, and what is
    met again there returns.
    """

    def __init__(self, path: str, value: Callable[[list[int]], object], frequent: dict | None = None, entries: int = CACHE_ENTRIES):
        self.path, self.value, self.frequent, self.entries = path, value, frequent or {}, entries
        self.known, self.old = dict(self.frequent), {}

    def encoded(self, words: list[bytes]) -> list:
        """Values from the library. A lower-case Latin word is one pre-token that normalisation leaves alone, so
        the library's merge step gets it directly; all others take the whole way."""
        out, rest = [None] * len(words), []
        merge, value = encoder(self.path).model.tokenize, self.value
        for i, word in enumerate(words):
            if word.isalpha():  # ASCII letters, in lower case where pretokens() did that
                if word.islower():
                    out[i] = value([t.id for t in merge(word.decode())])
                    continue
            elif _LATIN.fullmatch(word.decode("utf-8", "replace")):
                out[i] = value([t.id for t in merge("".join([_AS_LETTERS[b] for b in word]))])
                continue
            rest.append(i)
        if rest:
            found = encoder(self.path).encode_batch_fast([words[i].decode("utf-8", "replace") for i in rest], add_special_tokens=False)
            for i, e in zip(rest, found):
                out[i] = value(e.ids)
        return out

    def lookup(self, lists: list[list[bytes]]) -> dict:
        """A table that has every word of the given lists."""
        known, old = self.known, self.old
        missing = {w for words in lists for w in words if w not in known}
        if not missing:
            return known
        if len(known) + len(missing) > self.entries + len(self.frequent):
            self.old = old = known
            self.known = known = dict(self.frequent)
            missing = {w for words in lists for w in words if w not in known}
        new, cut, pieces = [], {}, set()
        for word in missing:
            if word in old:
                known[word] = old[word]
                continue
            core = _core(word)
            if core is word:
                new.append(word)
            else:
                cut[word] = core
                pieces.add(core)
                pieces.add(word[len(core) :])
        pieces.difference_update(known, new)
        for piece in pieces:
            if piece in old:
                known[piece] = old[piece]
            else:
                new.append(piece)
        known.update(zip(new, self.encoded(new)))
        for word, core in cut.items():
            known[word] = known[core] + known[word[len(core) :]]
        return known


def worker_cache(kind: str, path: str, value: Callable, frequent: dict | None = None) -> PretokenCache:
    """The cache of this worker process, kept from task to task; one of each kind."""
    key = (path, id(frequent) if frequent else 0)
    if kind not in _caches or _caches[kind][0] != key:
        _caches[kind] = (key, PretokenCache(path, value, frequent))
    return _caches[kind][1]


def frequent_lengths(rows: DataFrame, path: str, table_size: int = TABLE_SIZE, task_top: int = TASK_TOP) -> dict[bytes, int]:
    """Token counts of the most frequent pre-tokens over all texts, merged from per-task summaries of bounded size."""

    def summary(batches) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for _, texts in texts_of(batches):
            for text in texts:
                seen.update(pretokens(text))
            if len(seen) > SUMMARY_ENTRIES:  # bounded memory; what is rare so far can't be frequent here
                seen = Counter(dict(seen.most_common(SUMMARY_ENTRIES // 4)))
        top = [(w, n) for w, n in seen.most_common(task_top) if len(w) <= MAX_PRETOKEN]
        yield pa.record_batch({"word": pa.array([w for w, _ in top], pa.binary()), "n": pa.array([n for _, n in top], pa.int64())})

    merged = rows.mapInArrow(summary, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = [bytes(r["word"]) for r in merged.orderBy(F.desc("n"), "word").limit(table_size).collect()]
    cache = PretokenCache(path, len)
    known = cache.lookup([top])
    return {w: known[w] for w in top}


def token_counts(
    docs: DataFrame, path: str | None = None, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", table_size: int = TABLE_SIZE
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row.

    NULL and empty texts have 0 bytes and 0 tokens; repeated rows and NULL ids each give a row of their own; an empty
    table gives none; other columns are not looked at. A text is read whole, in slices of bounded size.
    """
    path = path or vocabulary_path()
    rows = id_and_bytes(docs, id_col, text_col)
    frequent = rows.sparkSession.sparkContext.broadcast(frequent_lengths(rows, path, table_size))

    def count(batches) -> Iterator[pa.RecordBatch]:
        cache = worker_cache("lengths", path, len, frequent.value)
        for part in (part for batch in batches for part in slices(batch)):
            words, order, starts = slice_pretokens(part.column("text"))
            known = cache.lookup([words])
            lengths = np.array([known[w] for w in words], np.int64)
            n = np.diff(np.concatenate([[0], np.cumsum(lengths[order.to_numpy()])])[starts])
            yield pa.record_batch(
                {
                    "doc_id": part.column("id"),
                    "n_bytes": pc.binary_length(part.column("text")).cast(pa.int64()),
                    "n_tokens": pa.array(n, pa.int64()),
                    "over_limit": pa.array(n > limit, pa.bool_()),
                }
            )

    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
