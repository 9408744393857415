"""Token-ID output (operator 8): Simple-8b words in blocks with offsets, written and read by Spark.

File format. The output folder is a Parquet dataset whose rows are the records of shards; a shard is what one task
wrote, shards and records ascend with the document id. A record has ``shard``, ``record`` (0, 1, ... in its shard),
``first_id`` (ids before it in its shard), ``n_ids``, ``doc_ids``, ``doc_lens`` and ``payload``:

    4 bytes magic ``S8B1`` | u32 ids | u32 ids per block | u32 blocks | u32 word offset of each block, and the end
    | u64 words, little-endian

The upper 4 bits of a word are its selector, the lower 60 bits hold values from the low end. Selectors 2 to 15 stand
for the widths and counts in ``WIDTHS``; selector 0 is the escape: its 60 bits are the low part of a value whose
upper bits are the next value. Each block starts at a word of its own, so blocks are decoded independently and
all at once with numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremorloom.llm.common import id_and_bytes, slices
from tremorloom.llm.token_counts import slice_pretokens, vocabulary_path, worker_cache

MAGIC = b"S8B1"
BLOCK = 512
RECORD_IDS = 1 << 18
# Bits of a value by selector, 15 down to 2; a word holds 60 // bits of them
WIDTHS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
_BITS = np.array([60, 0, *WIDTHS[::-1]], np.int64)
_COUNT = np.array([1, 0, *[60 // w for w in WIDTHS[::-1]]], np.int64)
_LOW60 = np.uint64((1 << 60) - 1)

SCHEMA = "shard int, record long, first_id long, n_ids long, doc_ids array<long>, doc_lens array<long>, payload binary"


def _narrowest(values: np.ndarray) -> np.ndarray:
    limits = np.array([1 << w for w in WIDTHS[:0:-1]], np.uint64)
    return (2 + np.searchsorted(limits, values, side="right")).astype(np.uint8)


_OF_16_BITS = _narrowest(np.arange(1 << 16, dtype=np.uint64))


def _selectors(values: np.ndarray) -> np.ndarray:
    """The narrowest selector that holds each value."""
    if len(values) and values.max() < len(_OF_16_BITS):
        return _OF_16_BITS[values.astype(np.uint16)]
    return _narrowest(values)


def _fullest(selectors: np.ndarray) -> np.ndarray:
    """At each position the selector that packs most of the values from there; zeros stand behind the end."""
    n = len(selectors)
    widest, reach = np.concatenate([selectors, np.full(int(_COUNT[2]), 2, np.uint8)]), 1
    best = np.full(n, 15, np.uint8)
    for selector in range(14, 1, -1):  # ever more values, ever narrower
        while reach < _COUNT[selector]:
            step = min(reach, int(_COUNT[selector]) - reach)
            widest[:-step] = np.maximum(widest[:-step], widest[step:])
            reach += step
        fits = widest[:n] <= selector
        if not fits.any():
            break
        best[fits] = selector
    return best


def encode(values: np.ndarray, block: int = BLOCK) -> bytes:
    """A record's payload. ``values``: unsigned 64-bit; those of 2**60 and more take an escape."""
    values = np.asarray(values, np.uint64)
    n, blocks = len(values), -(-len(values) // block)
    escaped = values > _LOW60
    if escaped.any():
        return _encode_escaped(values, escaped, block)
    return _pack(values, np.arange(0, n, block), np.minimum(np.arange(1, blocks + 1) * block, n), None, n, block)


def _encode_escaped(values, escaped, block):
    """Every escaped value becomes two: its low 60 bits under selector 0, then its upper bits."""
    extra = np.cumsum(escaped)
    at = np.arange(len(values)) + extra - escaped
    wide = np.zeros(len(values) + int(extra[-1]), np.uint64)
    wide[at] = values & _LOW60
    wide[at[escaped] + 1] = values[escaped] >> np.uint64(60)
    marks = np.zeros(len(wide), bool)
    marks[at[escaped]] = True
    firsts = np.arange(0, len(values), block)
    starts = at[firsts]
    ends = np.append(starts[1:], len(wide))
    return _pack(wide, starts, ends, marks, len(values), block)


def _pack(values, starts, ends, marks, n, block) -> bytes:
    """Walk all blocks side by side; a step of the loop places the next word of each block that isn't done."""
    best = _fullest(_selectors(values)) if len(values) else np.zeros(0, np.uint8)
    if marks is not None:  # a word with other values must end before an escape
        marked = np.flatnonzero(marks)
        following = np.searchsorted(marked, np.arange(len(values)))
        room = np.where(following < len(marked), marked[np.minimum(following, len(marked) - 1)] - np.arange(len(values)), len(values))
        for selector in range(2, 15):
            best[(best == selector) & (room < _COUNT[selector])] = selector + 1
        best[marks] = 0
    is_word = np.zeros(len(values), bool)
    at, stop = starts.copy(), ends
    while len(at):
        is_word[at] = True
        at = at + _COUNT[best[at]]
        going = at < stop
        at, stop = at[going], stop[going]
    where = np.flatnonzero(is_word)
    lanes = np.searchsorted(starts, where, side="right") - 1
    chosen = best[where] if len(where) else best
    counts = _COUNT[chosen]
    first = np.cumsum(counts) - counts
    slot = np.arange(int(counts.sum())) - np.repeat(first, counts)
    held = np.concatenate([values, np.zeros(int(_COUNT[2]), np.uint64)])[slot + np.repeat(where, counts)]
    for i in np.flatnonzero(where + counts > ends[lanes]):  # the last word of a block, at most one each
        held[first[i] + ends[lanes[i]] - where[i] : first[i] + counts[i]] = 0
    held <<= (slot * np.repeat(_BITS[chosen], counts)).astype(np.uint64)
    words = np.bitwise_or.reduceat(held, first) if len(where) else held
    words |= chosen.astype(np.uint64) << np.uint64(60)
    offsets = np.searchsorted(lanes, np.arange(len(starts) + 1)).astype("<u4")
    head = MAGIC + np.array([n, block, len(starts)], "<u4").tobytes()
    return head + offsets.tobytes() + words.astype("<u8").tobytes()


def decode(payload: bytes) -> np.ndarray:
    """The values of a record, all blocks at once."""
    if payload[:4] != MAGIC:
        raise ValueError("not a record of this format")
    n, block, blocks = (int(x) for x in np.frombuffer(payload, "<u4", 3, 4))
    offsets = np.frombuffer(payload, "<u4", blocks + 1, 16)
    words = np.frombuffer(payload, "<u8", -1, 16 + 4 * (blocks + 1)).astype(np.uint64)
    if len(words) != offsets[-1]:
        raise ValueError("a record is cut off")
    selectors = (words >> np.uint64(60)).astype(np.int64)
    if not blocks:
        return np.zeros(0, np.uint64)
    if (selectors == 1).any():
        raise ValueError("a record has an unknown selector")
    escapes = np.add.reduceat((selectors == 0).astype(np.int64), offsets[:-1])
    size = np.minimum(block, n - block * np.arange(blocks)) + escapes  # values of each block, upper parts included
    counts = _COUNT[selectors]
    before = np.cumsum(counts) - counts
    slot = np.arange(int(counts.sum())) - np.repeat(before, counts)
    masks = (np.uint64(1) << _BITS[selectors].astype(np.uint64)) - np.uint64(1)
    out = (np.repeat(words, counts) >> (slot * np.repeat(_BITS[selectors], counts)).astype(np.uint64)) & np.repeat(masks, counts)
    starts = before[offsets[:-1]]
    slots = np.diff(np.append(starts, len(out)))
    inside = np.arange(len(out)) - np.repeat(starts, slots) < np.repeat(size, slots)  # the last word of a block may have room
    out, marks = out[inside], np.repeat(selectors == 0, counts)[inside]
    if marks.any():
        low = np.flatnonzero(marks)
        out[low] |= out[low + 1] << np.uint64(60)
        keep = np.ones(len(out), bool)
        keep[low + 1] = False
        out = out[keep]
    return out


def write_token_ids(
    docs: DataFrame, folder: str, path: str | None = None, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write the ids of all texts, each with ``end_id`` behind, in ascending document id.

    NULL and empty texts give the end id alone; a NULL id sorts first; rows of the same id follow each other in the
    order of their texts; an empty table gives a dataset without records. Texts are sorted before they are encoded,
    as they are smaller than the ids; a record ends with a document once it has ``RECORD_IDS`` ids.
    """
    path = path or vocabulary_path()
    rows = id_and_bytes(docs, id_col, text_col).repartitionByRange(F.col("id")).sortWithinPartitions("id", "text")

    def records(batches) -> Iterator[pa.RecordBatch]:
        cache = worker_cache("ids", path, lambda ids: pack(f"<{len(ids)}I", *ids))
        shard, record, first = TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], "<u4").tobytes()
        held, lens, doc_ids, n = [], [], [], 0

        def flush():
            nonlocal record, first, held, lens, doc_ids, n
            payload = encode(np.frombuffer(b"".join(held), "<u4"))
            row = {
                "shard": [shard], "record": [record], "first_id": [first], "n_ids": [n],
                "doc_ids": [doc_ids], "doc_lens": [lens], "payload": [payload],
            }
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            out = pa.record_batch([pa.array(v, t) for v, t in zip(row.values(), types)], names=list(row))
            record, first = record + 1, first + n
            held, lens, doc_ids, n = [], [], [], 0
            return out

        for part in (part for batch in batches for part in slices(batch)):
            words, order, starts = slice_pretokens(part.column("text"))
            known = cache.lookup([words])
            values = pa.array([known[w] for w in words], pa.binary())
            ends = np.concatenate([[0], np.cumsum(pc.binary_length(values).to_numpy().astype(np.int64)[order.to_numpy()])])[starts].tolist()
            ids = (values.take(order).buffers()[2] or pa.py_buffer(b"")).to_pybytes()
            for doc, first_byte, last_byte in zip(part.column("id").to_pylist(), ends, ends[1:]):
                own = ids[first_byte:last_byte] + end
                held.append(own)
                doc_ids.append(doc)
                lens.append(len(own) // 4)
                n += lens[-1]
                if n >= RECORD_IDS:
                    yield flush()
        if doc_ids:
            yield flush()

    rows.mapInArrow(records, SCHEMA).write.option("compression", "zstd").parquet(folder)


def read_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit) of each document, from the files alone."""
    records = spark.read.schema(SCHEMA).parquet(folder)
    # one row per shard, as many as tasks wrote
    totals = records.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    placed = records.join(F.broadcast(starts), "shard")

    def documents(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode(row["payload"]).astype("<u4")
                lens = np.array(row["doc_lens"], np.int64)
                ends = np.cumsum(lens)
                if len(ids) != row["n_ids"] or ends[-1] != row["n_ids"]:
                    raise ValueError("a record's index doesn't fit its words")
                begins = ends - lens
                yield pa.record_batch(
                    {
                        "doc_id": pa.array(row["doc_ids"], pa.int64()),
                        "start": pa.array(begins + row["first_id"] + row["shard_start"], pa.int64()),
                        "n_tokens": pa.array(lens, pa.int64()),
                        "ids": pa.array([ids[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary()),
                    }
                )

    return placed.select("first_id", "shard_start", "n_ids", "doc_ids", "doc_lens", "payload").mapInArrow(
        documents, "doc_id long, start long, n_tokens long, ids binary"
    )
