"""Vector code compression (operator 12): member-resident Lloyd.

Every part of every vector is a member of an entry of its position's codebook. Members live in tables bucketed by
(position, entry, salt): a bucket is read by one task, its owner, without a shuffle. In a round owners sum their resident
members, the few sums of entries are added up and give the new codebooks; then owners find the nearest new entry of their
members and write the table of the next round in the same bucketing. Members that keep their entry are written where they
are; only those that change it are shuffled, to the owner of their new entry.

A member's salt comes from its row number, an entry has ``buckets / 8`` salts: an entry that has all rows is still spread
over that many owners. All arithmetic is in 64-bit integers. What the driver sees is the codebooks.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorloom.llm.common import found_by_workers, new_path, stash
from tremorloom.operators.ranking import same_keys

OWNER = ["pos", "entry", "salt"]
#: members of a bucket at most, on average
BUCKET_MEMBERS = 4_000_000
SALT_SHARE = 8
#: components below this size give distances that fit 64 bits at any usual length
LARGEST = 1 << 24
CHUNK = 8192


class Coded(NamedTuple):
    """``rows``: ``row`` (a number), ``id``, ``label``, ``code``, ``error``; ``codebooks``: one array (entries, width) a position."""

    rows: DataFrame
    codebooks: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all components by position, entry and place, as decimals with commas between."""
        return hashlib.sha256(",".join(str(x) for book in self.codebooks for x in book.reshape(-1).tolist()).encode()).hexdigest()


def quantised(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``row, id, label, ints``: the vectors without NULL or non-finite components as floor(scale * x), numbered."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            lists = batch.column("vector")
            length = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = lists.flatten()
            x = values.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
            of = np.repeat(np.arange(len(length)), length)
            good = lists.is_valid().to_numpy(zero_copy_only=False)
            good &= np.bincount(of[~np.isfinite(x)], minlength=len(length)) == 0
            x = np.floor(x[good[of]] * scale)
            if len(x) and np.abs(x).max() >= LARGEST:
                raise ValueError(f"a component of {LARGEST // scale} or more: its distances don't fit 64 bits")
            ends = np.concatenate([[0], np.cumsum(length[good])]).astype(np.int32)
            kept = batch.filter(pa.array(good))
            yield pa.record_batch(
                {
                    "row": pa.array(row + np.arange(kept.num_rows)),
                    "id": kept.column("id"),
                    "label": kept.column("label"),
                    "ints": pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))),
                }
            )
            row += kept.num_rows

    plain = vectors.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector")
    )
    kinds = dict(plain.dtypes)
    return plain.mapInArrow(run, f"row long, id {kinds['id']}, label {kinds['label']}, ints array<int>")


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each part, ties to the lower index, and its squared distance."""
    entry, distance = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    sizes = (book * book).sum(1)
    for at in range(0, len(parts), CHUNK):
        x = parts[at : at + CHUNK]
        far = sizes - 2 * (x @ book.T)
        entry[at : at + CHUNK] = far.argmin(1)
        distance[at : at + CHUNK] = far.min(1) + (x * x).sum(1)
    return entry, distance


def salt_of(row: np.ndarray, salts: int) -> np.ndarray:
    mixed = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(salts)).astype(np.int32)


class Members:
    """Tables of members, a generation a round, in the folder that all executors share."""

    def __init__(self, spark: SparkSession, width: int, buckets: int):
        self.spark, self.width, self.buckets = spark, width, buckets
        self.name, self.folder, self.generation = f"members_{uuid.uuid4().hex}", new_path(spark, "members"), -1
        self.components = [f"p{i}" for i in range(width)]
        self.schema = ", ".join(["pos int, entry int, salt int, row long", *[f"{c} int" for c in self.components], "next int"])

    @property
    def table(self) -> str:
        return f"{self.name}_{self.generation}"

    def write(self, rows: DataFrame, table: str) -> None:
        folder = f"{self.folder}-{table.rpartition('_')[2]}"
        writer = rows.write.format("parquet").option("path", folder).option("compression", "zstd")
        writer.bucketBy(self.buckets, *OWNER).sortBy(*OWNER).mode("append").saveAsTable(table)

    def resident(self) -> DataFrame:
        """Members at their owners, read in the bucketing of the table."""
        return self.spark.table(self.table).where("entry = next").drop("next")

    def start(self, rows: DataFrame) -> None:
        """The first generation: all members are shuffled to their owners once."""
        self.generation = 0
        self.write(rows.repartition(self.buckets, *OWNER), self.table)

    def sums(self) -> DataFrame:
        """``pos, entry, n, p0, p1, ...``: owners add up resident members, without an exchange; then owners are added."""
        add = [F.sum(c).alias(c) for c in self.components]
        owners = self.resident().groupBy(*OWNER).agg(F.count("*").alias("n"), *add)
        return owners.groupBy("pos", "entry").agg(F.sum("n").alias("n"), *add)

    def move(self, codebooks: list[np.ndarray]) -> None:
        """The next generation by new codebooks: who changes entry is shuffled, all others stay with their owner."""
        components = self.components

        def owner(group: pa.Table) -> pa.Table:
            parts = np.stack([group.column(c).to_numpy().astype(np.int64) for c in components], axis=1)
            entry, _ = nearest(parts, codebooks[group.column("pos")[0].as_py()])
            return group.append_column("next", pa.array(entry.astype(np.int32)))

        old, new = self.table, f"{self.name}_{self.generation + 1}"
        self.write(self.resident().groupBy(*OWNER).applyInArrow(owner, self.schema), new)
        moved = self.spark.table(new).where("entry <> next").withColumn("entry", F.col("next"))
        self.write(moved.repartition(self.buckets, *OWNER), new)
        self.generation += 1
        self.forget(old)

    def forget(self, table: str) -> None:
        """Drop a table and its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}-{table.rpartition('_')[2]}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def vector_codes(
    vectors: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    buckets: int | None = None,
) -> Coded:
    """Codes of all vectors and the codebooks.

    A vector that is NULL or has a NULL or non-finite component is left out. Codebooks start as the parts of the
    ``entries`` smallest ids (NULL ids last, equal ids by their vectors); with fewer vectors they are as short. Rows are
    told apart by a number, so repeated rows and ids each have a row of their own. An empty table gives no rows and empty
    codebooks; other columns are left behind, whatever their names. Vectors of different lengths, lengths that ``parts``
    doesn't divide and components of 2^24 and more after scaling raise ValueError; long vectors only make wider members.
    """
    spark = vectors.sparkSession
    found_by_workers(spark)
    if entries > 256:
        raise ValueError("an index has two hex digits")
    base = stash(quantised(vectors, scale, id_col, vector_col, label_col), "vectors")
    seen = base.agg(F.count("*").alias("n"), F.min(F.size("ints")).alias("low"), F.max(F.size("ints")).alias("high")).first()
    if not seen["n"]:
        return Coded(base.select("row", "id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), [])
    if seen["low"] != seen["high"] or seen["high"] % parts or not seen["high"]:
        raise ValueError(f"vectors of {seen['low']} to {seen['high']} components can't be cut into {parts} equal parts")
    width = seen["high"] // parts
    first = base.orderBy(F.col("id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    start = np.array([r["ints"] for r in first], np.int64).reshape(len(first), parts, width)
    codebooks = [start[:, pos].copy() for pos in range(parts)]

    least = -(-int(seen["n"]) * parts // BUCKET_MEMBERS)
    members = Members(spark, width, buckets or max(least, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    salts = -(-members.buckets // SALT_SHARE)
    books, components = codebooks, members.components

    def join_entries(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("ints").flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, parts, width)
            row = batch.column("row").to_numpy()
            salt = pa.array(salt_of(row, salts))
            for pos in range(parts):
                entry = pa.array(nearest(vectors[:, pos], books[pos])[0].astype(np.int32))
                place = pa.array(np.full(len(row), pos, np.int32))
                own = [pa.array(vectors[:, pos, i].astype(np.int32)) for i in range(width)]
                yield pa.record_batch([place, entry, salt, batch.column("row"), *own, entry], names=["pos", "entry", "salt", "row", *components, "next"])

    for nth in range(rounds):
        if nth:
            members.move(codebooks)
        else:
            members.start(base.select("row", "ints").mapInArrow(join_entries, members.schema))
        codebooks = [book.copy() for book in codebooks]
        for r in members.sums().collect():  # a row for each used entry
            codebooks[r["pos"]][r["entry"]] = [r[c] // r["n"] for c in components]
    coded = stash(final_codes(base, members, codebooks, parts) if rounds else _no_rounds(base, codebooks, parts, width), "vector-codes")
    if rounds:
        members.forget(members.table)
    return Coded(coded, codebooks)


def _code_columns(parts: int) -> list:
    """The code as 64-bit words of eight indexes, put together by a bitwise or: no list of a vector's members is made."""
    at = lambda w: F.when((F.col("pos") / 8).cast("int") == w, F.expr("shiftleft(cast(entry AS BIGINT), 8 * (7 - pos % 8))")).otherwise(F.lit(0).cast("long"))
    return [F.bit_or(at(w)).alias(f"word{w}") for w in range(-(-parts // 8))]


def _spelled(parts: int):
    words = [F.lpad(F.lower(F.hex(f"word{w}")), 16, "0") for w in range(-(-parts // 8))]
    return F.substring(F.concat(*words), 1, 2 * parts)


def final_codes(base: DataFrame, members: Members, codebooks: list[np.ndarray], parts: int) -> DataFrame:
    """``row, id, label, code, error``: members find their entry once more, their vectors put the indexes together."""
    components = members.components

    def assign(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pos = batch.column("pos").to_numpy()
            x = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in components], axis=1)
            entry, error = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
            for p in np.unique(pos):
                own = np.flatnonzero(pos == p)
                entry[own], error[own] = nearest(x[own], codebooks[p])
            yield pa.record_batch(
                {"row": batch.column("row"), "pos": batch.column("pos"), "entry": pa.array(entry.astype(np.int32)), "error": pa.array(error)}
            )

    found = members.resident().select("row", "pos", *components).mapInArrow(assign, "row long, pos int, entry int, error long")
    codes = found.groupBy("row").agg(*_code_columns(parts), F.sum("error").alias("error"))
    return base.select("row", "id", "label").join(codes, "row").select("row", "id", "label", _spelled(parts).alias("code"), "error")


def _no_rounds(base: DataFrame, codebooks: list[np.ndarray], parts: int, width: int) -> DataFrame:
    """Codes by the first codebooks, without members."""

    def assign(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("ints").flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, parts, width)
            found = [nearest(x[:, pos], codebooks[pos]) for pos in range(parts)]
            code = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8)
            yield pa.record_batch(
                [batch.column("row"), batch.column("id"), batch.column("label"), pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(sum(e for _, e in found))],
                names=["row", "id", "label", "code", "error"],
            )

    kinds = dict(base.dtypes)
    return base.mapInArrow(assign, f"row long, id {kinds['id']}, label {kinds['label']}, code string, error long")


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds the error summed over rows of equal label, NULL labels together; summed before the shuffle, joined by size."""
    labels = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    return same_keys(coded, labels, ["label"])
