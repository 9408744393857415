"""Line dedup (operator 5): Bloom filters of once-seen and twice-seen line keys; only suspected repeats are shuffled.

A pass over all lines sets, per key and document, a few positions of two bit fields: ``once``, and ``twice`` where a
position is met again. Tasks hand on segments of their fields; two fields merge as saturating counters
(``twice = twice | twice' | (once & once')``), so a key of two documents is always found in ``twice``. A key whose
positions are all in ``twice`` is a suspect. Suspects alone are shuffled, as whole keys, to count their documents
and find the one that keeps the line. False suspects cost work, never rows.

The filter is sized by the number of lines, up to ``MAX_FILTER_BITS`` (32 MB); beyond that more keys are suspected
and the exact step takes a larger share of them, with the same result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorloom.llm.common import id_and_bytes, stash, texts_of

WHITE = b" \t\n\x0b\x0c\r"
PROBES = 3
MAX_FILTER_BITS = 1 << 28
SEGMENT_BYTES = 1 << 16


def line_key(line: bytes) -> bytes:
    return line.strip(WHITE).lower()


def long_key(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def keys_of(text: bytes, least: int) -> set[bytes]:
    """The distinct keys of a text that are long enough."""
    return {k for k in map(line_key, text.split(b"\n")) if long_key(k, least)}


def positions(keys: list[bytes], bits: int) -> np.ndarray:
    """``PROBES`` positions for each key; ``bits`` is a power of two."""
    h = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(h + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(PROBES)], axis=1).astype(np.int64)


def filter_bits(rows: DataFrame) -> int:
    """Eight bits a line, as a power of two in bounds."""
    newlines = F.length("text") - F.length(F.replace("text", F.lit("\n")))
    lines = rows.select(F.col("text").cast("string").alias("text")).agg(F.sum(newlines + 1)).first()[0] or 0
    return min(MAX_FILTER_BITS, max(8 * SEGMENT_BYTES, 1 << int(8 * lines).bit_length()))


def twice_filter(rows: DataFrame, bits: int, least: int) -> bytes:
    """The bits of the twice-seen filter over all texts of documents with an id."""
    n_segments = bits // 8 // SEGMENT_BYTES

    def fields(batches) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        any_row = False
        for ids, texts in texts_of(batches):
            keys = [k for doc, text in zip(ids.is_valid().to_pylist(), texts) if doc for k in keys_of(text, least)]
            if not keys:
                continue
            any_row = True
            # a key's own probes may coincide; they count once
            at = np.sort(positions(keys, bits), axis=1)
            fresh = np.ones(at.shape, bool)
            fresh[:, 1:] = at[:, 1:] != at[:, :-1]
            place, met = np.unique(at[fresh], return_counts=True)
            byte, bit = place >> 3, np.left_shift(1, place & 7).astype(np.uint8)
            again = (met > 1) | ((once[byte] & bit) != 0)
            np.bitwise_or.at(twice, byte[again], bit[again])
            np.bitwise_or.at(once, byte, bit)
        if any_row:
            for i in range(n_segments):
                part = slice(i * SEGMENT_BYTES, (i + 1) * SEGMENT_BYTES)
                if once[part].any():
                    yield pa.record_batch(
                        {
                            "segment": pa.array([i], pa.int32()),
                            "once": pa.array([zlib.compress(once[part].tobytes(), 1)], pa.binary()),
                            "twice": pa.array([zlib.compress(twice[part].tobytes(), 1)], pa.binary()),
                        }
                    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One segment's fields, streamed; the memory is that of one segment."""
        once, twice, segment = np.zeros(SEGMENT_BYTES, np.uint8), np.zeros(SEGMENT_BYTES, np.uint8), None
        for batch in batches:
            for row in batch.to_pylist():
                segment = row["segment"]
                own, double = (np.frombuffer(zlib.decompress(row[c]), np.uint8) for c in ("once", "twice"))
                twice |= double | (once & own)
                once |= own
        yield pa.record_batch({"segment": pa.array([segment], pa.int32()), "twice": pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())})

    merge.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    merged = rows.mapInArrow(fields, "segment int, once binary, twice binary").groupBy("segment").applyInArrow(merge, "segment int, twice binary")
    out = bytearray(bits // 8)
    for row in merged.collect():  # at most MAX_FILTER_BITS
        out[row["segment"] * SEGMENT_BYTES : (row["segment"] + 1) * SEGMENT_BYTES] = zlib.decompress(row["twice"])
    return bytes(out)


def line_dedup(
    docs: DataFrame, least_chars: int = 20, least_docs: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` for every row, without the lines other documents keep.

    A key of ``least_chars`` code points found in ``least_docs`` documents loses all its lines except in the largest
    document id that holds it, which keeps all of its own. NULL and empty texts are one empty line, kept. Rows of the same
    id count as one document. A row without id keeps all its lines and counts for no key. An empty table gives no rows.
    Only texts with a suspect are shuffled.
    """
    rows = id_and_bytes(docs, id_col, text_col)
    bits = filter_bits(rows)
    field = rows.sparkSession.sparkContext.broadcast(twice_filter(rows, bits, least_chars))

    def suspected(keys: list[bytes]) -> np.ndarray:
        """Whether a key may occur in two documents."""
        at = positions(keys, bits)
        twice = np.frombuffer(field.value, np.uint8)
        return ((twice[at >> 3] >> (at & 7)) & 1).all(axis=1)

    def suspects(batches) -> Iterator[pa.RecordBatch]:
        for ids, texts in texts_of(batches):
            doc, keys = [], []
            for i, (here, text) in enumerate(zip(ids.is_valid().to_pylist(), texts)):
                own = keys_of(text, least_chars) if here else ()
                keys += own
                doc += [i] * len(own)
            yes = suspected(keys) if keys else np.zeros(0, bool)
            at = np.array(doc, np.int64)[yes]
            yield pa.record_batch({"id": ids.take(pa.array(at)), "key": pa.array([k for k, y in zip(keys, yes) if y], pa.binary())})

    def split(batches) -> Iterator[pa.RecordBatch]:
        """Rows with the text, marked if it has a suspect."""
        for ids, texts in texts_of(batches):
            marked = []
            for here, text in zip(ids.is_valid().to_pylist(), texts):
                own = list(keys_of(text, least_chars)) if here else []
                marked.append(bool(own) and bool(suspected(own).any()))
            yield pa.record_batch({"id": ids, "text": pa.array(texts, pa.binary()), "suspect": pa.array(marked, pa.bool_())})

    def clean(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drops = batch.column("drop").to_pylist()
            first = 0
            for ids, texts in texts_of([batch]):
                kept, lines = [], []
                for text, drop in zip(texts, drops[first : first + len(texts)]):
                    own = text.split(b"\n")
                    gone = set(drop or ())
                    kept.append([x for x in own if line_key(x) not in gone] if gone else own)
                    lines.append(len(own))
                first += len(texts)
                yield pa.record_batch(
                    {
                        "doc_id": ids,
                        "n_lines": pa.array(lines, pa.int64()),
                        "n_dropped": pa.array([n - len(k) for n, k in zip(lines, kept)], pa.int64()),
                        "text": pa.array([b"\n".join(k) for k in kept], pa.binary()),
                    }
                )

    pairs = stash(rows.mapInArrow(suspects, "id long, key binary"), "line-suspects")
    # one row per key and document first, so a very common line is counted by many tasks
    counted = pairs.distinct().groupBy("key").agg(F.count("id").alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= least_docs)
    gone = (
        pairs.distinct()
        .join(counted.select("key", "keeper"), "key")
        .where(F.col("id") < F.col("keeper"))
        .groupBy("id")
        .agg(F.collect_list("key").alias("drop"))
    )
    parted = rows.mapInArrow(split, "id long, text binary, suspect boolean")
    none = F.lit(None).cast("array<binary>").alias("drop")
    untouched = parted.where(~F.col("suspect")).select("id", "text", none)
    touched = parted.where("suspect").select("id", "text").join(gone, "id", "left").select("id", "text", "drop")
    out = untouched.unionByName(touched).mapInArrow(clean, "doc_id long, n_lines long, n_dropped long, text binary")
    return out.withColumn("text", F.col("text").cast("string"))
