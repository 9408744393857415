"""The corpus pipeline: language ID, exact dedup, near-duplicate join, benchmark decontamination, packing.

Each stage takes the documents its predecessor kept, whole, and returns the columns of ``documents`` (the last one its packing).
Decisions are made per row, as the operators make them: a row is known by its id and its text, so rows without an id are decided
like all others, and of rows that share an id each by its own text. Equal rows (id and text) have equal verdicts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorloom.llm import common
from tremorloom.llm.decontaminate import decontaminate
from tremorloom.llm.exact_dedup import BATCHES, digests, exact_dedup, new_index
from tremorloom.llm.language_id import language_id, learn_dictionaries, learn_margins
from tremorloom.llm.ngram_join import ngram_join
from tremorloom.llm.packing import pack
from tremorloom.llm.queries import token_lengths


def _unused(docs: DataFrame, name: str) -> str:
    """``name``, with as many ``_`` as make it differ from all columns of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a 63-bit hash of id and text, which the operators take for the id, and that column's name.

    Different rows with one hash (expected from some billions of rows on) go only if the stage would reject both.
    """
    key = _unused(docs, "row_key")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "text")]
    return docs.withColumn(key, F.shiftrightunsigned(F.xxhash64(F.col("doc_id").isNull(), *parts), 1)), key


def _without(keyed: DataFrame, gone: DataFrame, column: str) -> DataFrame:
    """The rows but for those whose ``column`` is in ``gone``, without it; keys alone meet the texts."""
    lost = common.stash(gone.select(column).distinct(), "lost")
    if lost.count() <= 1_000_000:  # 16 MB
        lost = F.broadcast(lost)
    return keyed.join(lost, column, "left_anti").drop(column)


def _all_rejected(found: DataFrame, rejected, key: str) -> DataFrame:
    """The keys of which every row is rejected."""
    return found.groupBy(F.col("doc_id").alias(key)).agg(F.bool_and(rejected).alias("gone")).where("gone").select(key)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go: no text, no letter, or a margin as narrow as one in a hundred labelled documents of that language has."""
    keyed, key = _keyed(docs)
    dictionaries = learn_dictionaries(docs)
    found = language_id(keyed, dictionaries, id_col=key, margins=learn_margins(docs, dictionaries))
    return _without(keyed, _all_rejected(found, F.col("rejected"), key), key)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays (one without an id only if all are); of repeated rows one."""
    index = new_index(docs)
    row = _unused(docs, "row")
    numbered = common.stash(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    kept = exact_dedup(docs, index, batches=BATCHES).where("kept").select(F.col("digest").alias("kept_digest"), "keep_id")
    index.close()
    rows = digests(numbered, more=[row])
    first = rows.groupBy("digest", "id").agg(F.min(row).alias(row))
    stays = first.join(kept, (F.col("digest") == F.col("kept_digest")) & F.col("id").eqNullSafe(F.col("keep_id")), "left_semi")
    return _without(numbered, rows.join(stays.select(row), row, "left_anti"), row)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the row with the least id stays, one without an id only if none has one."""
    keyed, key = _keyed(docs)
    found = ngram_join(keyed, words=5, percent=80, id_col=key).select(F.col("doc_id").alias(key), "component_id").distinct()
    groups = common.stash(found, "components")
    many = groups.where(F.col("component_id") != F.col(key)).select("component_id").distinct()
    members = groups.join(many, "component_id", "left_semi").join(keyed.select(key, "doc_id").distinct(), key)
    members = common.stash(members.withColumn("rank", F.struct(F.col("doc_id").isNull(), "doc_id", key)), "members")
    least = members.groupBy("component_id").agg(F.min("rank").alias("least")).select(F.col(f"least.{key}").alias(key))
    return _without(keyed, members.join(least, key, "left_anti"), key)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    keyed, key = _keyed(docs)
    found = decontaminate(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=key)
    return _without(keyed, _all_rejected(found, F.col("n_hit") > 0, key), key)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Buckets and batches of all documents' pieces."""
    return pack(token_lengths(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("ngram_join", near_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: compression sizes and the optimal buckets have no SQL form; tests compare with a plain Python version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage keeps is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stash(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
