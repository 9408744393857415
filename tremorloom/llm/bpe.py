"""BPE encoding and decoding (operator 11): merges by a segment tree over the ranks of adjacent pairs.

A text is cut at ASCII white space, which the vocabulary's splitter never crosses; distinct runs are looked up in a cache of
the worker, new ones are normalised and split into pre-tokens as the tokenizer file says, and new pre-tokens are merged.
``merge`` does that for many pre-tokens at once, with one segment tree each: leaf p holds the rank of the pair that starts at
symbol p, and p itself, so that the root is the leftmost pair of the lowest rank. A merge changes three leaves (its own, the
one before, the one it swallows) and their ancestors, until a root shows that no pair can be merged.

Decoding joins the tokens' texts as the file's decoder does; files with another decoder or model option are refused.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorloom.llm.common import id_and_bytes, slices
from tremorloom.llm.token_counts import encoder, vocabulary_path

CACHE_RUNS = 400_000
CACHE_PIECES = 400_000
#: symbols of the pre-tokens that are merged side by side
BATCH_SYMBOLS = 1 << 18
_NONE = np.iinfo(np.int64).max
_PLAIN = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
#: texts of ASCII and accented Latin letters, which normalisation only lower-cases
_LATIN = re.compile("[\\x00-\\x7fÀ-ÖØ-öø-ÿ]+")
_LATIN_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
_models: dict[str, BpeModel] = {}


def _byte_symbols() -> list[str]:
    """The letter of each byte in a byte-level vocabulary: printable ones as they are, the others from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class BpeModel:
    """Ids, merges and special strings of a tokenizer file, and the caches of a worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "fuse_unk", "ignore_merges") if model.get(k)]
        if model.get("type") != "BPE" or odd or told.get("decoder") is not None:
            raise ValueError(f"not a BPE vocabulary of the known kind: {model.get('type')}, {odd}, decoder {told.get('decoder')}")
        vocabulary, self.suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.library = encoder(path)
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        letters = _byte_symbols()
        self.inner = np.array([vocabulary[c] for c in letters], np.int64)
        self.last = np.array([vocabulary[c + self.suffix] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.size = 1 + max([*vocabulary.values(), *self.special.values()])
        key = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = np.append(key[order], _NONE), np.append(order, 0)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        texts = {i: t for t, i in [*vocabulary.items(), *self.special.items()]}
        self.texts = pa.array([texts.get(i, "").encode() for i in range(self.size)], pa.binary())
        self.runs: dict[bytes, bytes] = {}
        self.pieces: dict[bytes, bytes] = {}

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pre-tokens, each the UTF-8 bytes of one."""
        out: list[np.ndarray] = [np.zeros(0, "<u4")] * len(pieces)
        lengths = np.array([len(p) for p in pieces], np.int64)
        leaves = np.maximum(1, 1 << np.ceil(np.log2(np.maximum(lengths - 1, 1))).astype(np.int64))
        for size in np.unique(leaves).tolist():
            own = np.flatnonzero((leaves == size) & (lengths > 0))
            step = max(1, BATCH_SYMBOLS // size)
            for at in range(0, len(own), step):
                part = own[at : at + step]
                for i, ids in zip(part.tolist(), self._merge_trees([pieces[i] for i in part], lengths[part], size)):
                    out[i] = ids
        return out

    def _merge_trees(self, pieces: list[bytes], lengths: np.ndarray, size: int) -> list[np.ndarray]:
        """A tree with ``size`` leaves for each piece, all in one array; every step of the loop is one merge in each
        piece that still has one."""
        n, bits = len(pieces), size.bit_length() - 1
        column = np.arange(size + 1)
        inside = column < lengths[:, None]
        symbol = np.zeros((n, size + 2), np.int64)
        symbol[:, : size + 1][inside] = self.inner[np.frombuffer(b"".join(pieces), np.uint8)]
        rows = np.arange(n)
        symbol[rows, lengths - 1] = self.last[[p[-1] for p in pieces]]
        following = np.tile(np.arange(1, size + 3), (n, 1))
        before = np.tile(np.arange(-1, size + 1), (n, 1))
        alive = np.zeros((n, size + 2), bool)
        alive[:, : size + 1] = inside
        place = np.arange(size)
        rank = self.pair_ranks(symbol[:, :size], symbol[:, 1 : size + 1])
        pair = (rank != _NONE) & (place + 1 < lengths[:, None])
        tree = np.full((n, 2 * size), _NONE, np.int64)
        tree[:, size:] = np.where(pair, np.where(pair, rank, 0) << bits | place, _NONE)
        for level in range(bits - 1, -1, -1):
            node = np.arange(1 << level, 2 << level)
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])

        def put(rows: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
            node = leaf + size
            tree[rows, node] = value
            for _ in range(bits):
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        def put_pair(rows: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
            found = self.pair_ranks(symbol[rows, left], symbol[rows, right])
            put(rows, left, np.where(found == _NONE, _NONE, (np.where(found == _NONE, 0, found) << bits) | left))

        while len(rows := rows[tree[rows, 1] != _NONE]):
            root = tree[rows, 1]
            left = root & (size - 1)
            right = following[rows, left]
            symbol[rows, left] = self.merged[root >> bits]
            alive[rows, right] = False
            after = following[rows, right]
            following[rows, left] = after
            before[rows, np.minimum(after, size + 1)] = left
            swallowed = right < size
            put(rows[swallowed], right[swallowed], np.full(int(swallowed.sum()), _NONE))
            on = after < lengths[rows]
            put(rows[~on], left[~on], np.full(int((~on).sum()), _NONE))
            put_pair(rows[on], left[on], after[on])
            earlier = before[rows, left]
            on = earlier >= 0
            put_pair(rows[on], earlier[on], left[on])
        ids = symbol[alive].astype("<u4")
        return np.split(ids, np.cumsum(alive.sum(1))[:-1])

    def split(self, run: bytes) -> list[bytes | int]:
        """Pre-tokens of a run without ASCII white space, as UTF-8 bytes, and ids of special strings.

        ASCII and accented Latin letters are lower-cased and split here; anything else, and what may hold a special
        string, goes through the file's normaliser and splitter.
        """
        plain = b"<|" not in run
        if plain and run.isascii():
            return _PLAIN.findall(run.lower())
        text = run.decode("utf-8", "replace")
        if plain and _LATIN.fullmatch(text):
            return [part.encode() for part in _LATIN_PARTS.findall(text.lower())]
        out: list[bytes | int] = []
        for nth, part in enumerate(self.cut_special.split(text) if self.cut_special else [text]):
            if nth % 2:
                out.append(self.special[part])
            elif part:
                normal = self.library.normalizer.normalize_str(part)
                out += [self.bytes_of(piece) for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        return out

    @staticmethod
    def bytes_of(piece: str) -> bytes:
        """The splitter writes bytes as letters; back to bytes."""
        return bytes(map(_BYTE_OF.__getitem__, piece))

    def ids_of_runs(self, runs: list[bytes]) -> list[bytes]:
        """Ids of each run, little-endian unsigned 32-bit. What the caches lack is merged in one go."""
        known = self.runs
        new = [r for r in runs if r not in known]
        if len(known) + len(new) > CACHE_RUNS:
            self.runs = known = {r: known[r] for r in runs if r in known}  # bounded: what these texts use stays
        split = [self.split(r) for r in new]
        pieces = list({p for parts in split for p in parts if p.__class__ is bytes and p not in self.pieces})
        if len(self.pieces) + len(pieces) > CACHE_PIECES:
            self.pieces = {}
            pieces = list({p for parts in split for p in parts if p.__class__ is bytes})
        self.pieces.update(zip(pieces, [ids.tobytes() for ids in self.merge(pieces)]))
        value = self.pieces
        for run, parts in zip(new, split):
            if len(parts) == 1 and parts[0].__class__ is bytes:
                known[run] = value[parts[0]]
            else:
                known[run] = b"".join([value[p] if p.__class__ is bytes else np.array([p], "<u4").tobytes() for p in parts])
        return [known[r] for r in runs]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and where each text's begin (with the end behind)."""
        lists = pc.ascii_split_whitespace(texts.view(pa.string()))
        flat = lists.flatten().dictionary_encode()
        ids = pa.array(self.ids_of_runs(flat.dictionary.view(pa.binary()).to_pylist()), pa.binary())
        lengths = pc.binary_length(ids).to_numpy().astype(np.int64) // 4
        held = ids.take(flat.indices).buffers()[2] if len(flat) else None
        upto = np.concatenate([[0], np.cumsum(lengths[flat.indices.to_numpy()])]).astype(np.int64) if len(flat) else np.zeros(1, np.int64)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        starts = upto[offsets - offsets[0]]
        return (np.frombuffer(held, "<u4", int(starts[-1])) if held else np.zeros(0, "<u4")), starts

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """The texts of ids: their tokens joined by spaces, special ones too."""
        held = self.texts.take(pa.array(ids.astype(np.int64)))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), held), b" ")


_BYTE_OF = {letter: byte for byte, letter in enumerate(_byte_symbols())}


def model_of(path: str) -> BpeModel:
    """The model of this worker process, kept from task to task."""
    if path not in _models:
        _models[path] = BpeModel(path)
    return _models[path]


def bpe_encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row; ``ids`` are little-endian unsigned 32-bit, without added special tokens.

    NULL and empty texts have no ids; repeated rows and NULL ids each give a row of their own; an empty table gives none;
    other columns are not looked at, whatever their names. A text is read whole, in slices of bounded size or one text;
    the time of a pre-token grows with its length times the logarithm of it. Special strings in a text are their ids.
    """
    path = path or vocabulary_path()
    rows = id_and_bytes(docs, id_col, text_col)

    def encode(batches) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            for part in slices(batch):
                ids, starts = model.encode(part.column("text"))
                held = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer((starts * 4).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.record_batch({"doc_id": part.column("id"), "n_tokens": pa.array(np.diff(starts)), "ids": held})

    return rows.mapInArrow(encode, "doc_id long, n_tokens long, ids binary")


def bpe_decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Adds ``decoded`` to ``doc_id, n_tokens, ids``: the text that the tokenizer's decode gives, special tokens included.

    Rows without ids (NULL or empty) give an empty text; an id that the vocabulary lacks gives nothing.
    """
    path = path or vocabulary_path()
    rows = encoded.select("doc_id", "n_tokens", F.coalesce("ids", F.lit(b"")).alias("ids"))

    def decode(batches) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            for part in slices(batch, "ids"):
                lengths = pc.binary_length(part.column("ids")).to_numpy().astype(np.int64) // 4
                ids = np.frombuffer(b"".join(part.column("ids").to_pylist()), "<u4")
                text = model.decode(ids, np.concatenate([[0], np.cumsum(lengths)]))
                yield pa.record_batch({"doc_id": part.column("doc_id"), "n_tokens": part.column("n_tokens"), "ids": part.column("ids"), "decoded": text})

    return rows.mapInArrow(decode, "doc_id long, n_tokens long, ids binary, decoded binary")
