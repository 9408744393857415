"""Exact dedup (operator 9): a persistent digest index, bucketed and sorted by digest.

The index is a table with a row per known text: ``digest`` (SHA-256 of the normalised text), ``keep_id``. New texts
meet it in a sort-merge anti-join, for which only the new digests are shuffled; what is new is appended in the same
bucketing. The files carry the bucket in their names, so another session registers the folder again and goes on.

A table that is deduplicated as a whole goes through the same index in batches of descending ids: the first batch that
has a text holds its largest id, all later ones find the text in the index.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorloom.llm.common import lower_ascii, new_path, stash

BUCKETS = 64
#: digests in a bucket (about 160 MB), by which the number of buckets of a new index is chosen
BUCKET_ROWS = 4_000_000
#: ranges of descending ids in which a whole table meets the index
BATCHES = 4
#: copies of one row that are written out together
BLOCK = 4096


def buckets_for(n: int, partitions: int = 1) -> int:
    """Buckets of an index for ``n`` texts; as many as shuffle partitions at least, so that a partition is one bucket's file."""
    return max(BUCKETS, partitions, -(-n // BUCKET_ROWS))


def new_index(docs: DataFrame) -> DigestIndex:
    """An empty index in the shared folder, sized for ``docs``."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return DigestIndex(spark, new_path(spark, "digest-index"), buckets_for(docs.count(), partitions))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: Sequence[str] = ()) -> DataFrame:
    """``id, digest`` and the columns ``more`` of every row: SHA-256 of the text with A-Z lower-cased; NULL counts as empty."""
    normal = lower_ascii(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.unhex(F.sha2(normal.cast("binary"), 256)).alias("digest"), *more)


class DigestIndex:
    """A digest index in ``folder``, which all executors share; an existing one is taken up again, with its number of buckets."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.folder, self.buckets = spark, folder, buckets
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT) USING parquet OPTIONS (path '{folder}') "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def unknown(self, digest_rows: DataFrame) -> DataFrame:
        """Those of the given distinct digests that the index hasn't: a sort-merge anti-join on the bucketing."""
        return digest_rows.join(self.rows().hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame) -> None:
        """Add ``digest, keep_id`` rows, one file per bucket."""
        (
            groups.select("digest", "keep_id")
            .repartition(self.buckets, "digest")
            .write.format("parquet")
            .option("path", self.folder)
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .mode("append")
            .saveAsTable(self.table)
        )

    def close(self) -> None:
        """Take the table out of the catalog; its files stay, and so do results of ``exact_dedup``."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def _decide(own: DataFrame, index: DigestIndex) -> DataFrame:
    """``digest, keep_id, group_size, new`` of a batch's texts, stashed; those the index lacked are added to it."""
    groups = own.groupBy("digest").agg(F.max("id").alias("keep_id"), F.sum("times").alias("group_size"))
    fresh = stash(index.unknown(groups), "new-digests")
    known = index.rows().hint("merge").withColumnRenamed("keep_id", "known_id")
    old = groups.drop("keep_id").join(known, "digest").select("digest", F.col("known_id").alias("keep_id"), "group_size", F.lit(False).alias("new"))
    decided = stash(fresh.withColumn("new", F.lit(True)).unionByName(old), "decided")
    index.append(fresh)
    return decided


def _id_ranges(own: DataFrame, batches: int) -> list:
    """Conditions that deal rows into ranges of descending ids, NULL last; one id lies in one range."""
    shares = [i / batches for i in range(1, batches)]
    cuts = own.agg(F.percentile_approx("id", shares, 1000)).first()[0] if shares else None
    cuts = sorted(set(cuts or []), reverse=True)
    if not cuts:
        return [F.lit(True)]
    between = [(F.col("id") <= high) & (F.col("id") > low) for high, low in zip(cuts, cuts[1:])]
    return [F.col("id") > cuts[0], *between, F.col("id").isNull() | (F.col("id") <= cuts[-1])]


def exact_dedup(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", batches: int = 1) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest`` for every row; what the index lacked is added to it.

    Of equal texts the row with the largest id stays, unless the index had the text before the call: then none stays
    and ``keep_id`` is the one of the index. ``batches`` only says in how many ranges of descending ids the rows meet the
    index; rows and sizes are the same for any number. NULL texts equal empty ones. Of repeated rows with the largest id
    one is ``kept``, the others aren't. A NULL id is less than all others. An empty table gives no rows. Other columns are
    left behind, whatever their names; texts of any length are read whole.
    Rows are shuffled as digests and ids only; equal rows are counted before the shuffle.
    """
    own = stash(digests(docs, id_col, text_col).groupBy("digest", "id").agg(F.count("*").alias("times")), "digests")
    decided = None
    for part in _id_ranges(own, batches):
        found = _decide(own.where(part), index)
        decided = found if decided is None else decided.unionByName(found)
    # a text is new to one batch at most, and all batches agree on the id that stays
    verdicts = decided.groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.max("new").alias("new"))
    # the rows of one text may be many: the join's large partitions are split, no group is gathered
    rows = own.join(verdicts, "digest")
    last = F.floor((F.col("times") - 1) / BLOCK)
    few = rows.where(F.col("times") <= BLOCK).withColumn("block", F.lit(0).cast("long"))
    # copies of one row in id and text are written out by blocks, which are dealt to all tasks
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = rows.where(F.col("times") > BLOCK).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last))).repartition(tasks, "digest", "id", "block")
    first, stop = F.col("block") * BLOCK + 1, F.least("times", (F.col("block") + 1) * BLOCK)
    return (
        few.unionByName(many)
        .select("id", "digest", "keep_id", "group_size", "new", F.explode(F.sequence(first, stop)).alias("nth"))
        .select(
            F.col("id").alias("doc_id"),
            "keep_id",
            "group_size",
            (F.col("new") & F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
            "digest",
        )
    )
