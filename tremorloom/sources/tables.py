"""Readers and writers of the period, minute, sequence and parameter tables."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorloom.operators.periods import ContractViolation
from tremorloom.schemas import (
    MINUTE_COLUMNS,
    MINUTE_FILE_SUFFIX,
    MINUTES,
    MINUTES_TEXT,
    PARAMS,
    SPLITS,
)
from tremorloom.session import stored, use_utc


def read_periods_csv(spark: SparkSession, path: str) -> DataFrame:
    """Period metadata as text, with ``period_ord`` as the order of the file.

    The header decides the delimiter (``;`` or ``,``); a byte-order mark is dropped; empty fields are ''.
    Rows are numbered without a total order: files are read in splits that keep their lines together, so a row's number is
    what earlier splits hold plus its place in its own. Only the table of splits, a row each, is looked at as a whole.
    """
    use_utc(spark)
    header = spark.read.text(path).limit(1).collect()
    if not header:
        raise ContractViolation(f"empty periods file: {path}")
    sep = ";" if header[0][0].count(";") > header[0][0].count(",") else ","
    raw = spark.read.csv(path, header=True, sep=sep, encoding="UTF-8", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    named = raw.toDF(*[c.lstrip("﻿").strip() for c in raw.columns])
    text = stored(
        named.select(
            *[F.coalesce(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c) for c in named.columns],
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_at"),
        ),
        "periods",
    )
    splits = text.groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")).collect()
    numbered, before = [], 0
    for split in sorted(splits, key=lambda r: (r["_file"], r["_block"])):
        numbered.append((split["_file"], split["_block"], before - split["_first"]))
        before += split["_n"]
    shifts = spark.createDataFrame(numbered, "_file string, _block long, _shift long")
    shifted = text.join(shifts, ["_file", "_block"]).withColumn("period_ord", (F.col("_at") + F.col("_shift") + 1).cast("int"))
    return shifted.drop("_file", "_block", "_at", "_shift")


def read_minutes(spark: SparkSession, paths: str | Sequence[str], format: str = "csv", merge_headers: bool = False) -> DataFrame:
    """Minute aggregates of any number of periods in one scan, explicit schema.

    CSV columns are taken by header name; ``eruption_id`` falls back to the file name without its fixed suffix. CSV values
    stay text until ``prepare_minutes`` types them. Files whose header differs from the first one's raise, unless
    ``merge_headers``: then a pass over the lines finds each file's header, files are read in one scan per distinct header,
    and columns that a file lacks are NULL.
    """
    use_utc(spark)
    if format == "parquet":
        found = spark.read.schema(MINUTES).parquet(*([paths] if isinstance(paths, str) else paths))
        return found.select(*MINUTE_COLUMNS)
    if format != "csv":
        raise ValueError("format must be 'csv' or 'parquet'")
    files = paths if isinstance(paths, str) else list(paths)
    if merge_headers:
        found = None
        for header, own in _files_by_header(spark, files).items():
            schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
            part = _named_by_file(spark.read.schema(schema).csv(own, header=True))
            found = part if found is None else found.unionByName(part, allowMissingColumns=True)
        return spark.createDataFrame([], MINUTES_TEXT) if found is None else found.select(*[c for c in MINUTE_COLUMNS if c in found.columns])
    first = spark.read.csv(files, header=True)
    # a file whose header differs from the first one's fails instead of giving its values to other columns
    return _named_by_file(spark.read.schema(first.schema).csv(files, header=True, enforceSchema=False))


def _files_by_header(spark: SparkSession, files: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files of each header. A header is the line with names of minute columns; files without one hold nothing."""
    line = F.regexp_replace("value", "^\ufeff", "")
    cells = F.transform(F.split(line, ","), lambda c: F.trim(F.regexp_replace(c, '"', "")))
    lines = spark.read.text(files).select(F.col("_metadata.file_path").alias("file"), cells.alias("header"))
    named = lines.where(F.arrays_overlap("header", F.array(*[F.lit(c) for c in MINUTE_COLUMNS])))
    out: dict[tuple[str, ...], list[str]] = {}
    for row in named.groupBy("file").agg(F.min("header").alias("header")).orderBy("file").collect():  # a row per file
        out.setdefault(tuple(row["header"]), []).append(unquote(row["file"]))
    return out


def _named_by_file(found: DataFrame) -> DataFrame:
    stem = F.regexp_extract(F.input_file_name(), "([^/]+)$", 1)
    from_name = F.regexp_replace(F.url_decode(stem), MINUTE_FILE_SUFFIX.replace(".", "\\.") + "$", "")
    given = F.col("eruption_id") if "eruption_id" in found.columns else F.lit(None).cast("string")
    rest = [F.col(c) for c in MINUTE_COLUMNS[1:] if c in found.columns]
    return found.select(F.coalesce(F.nullif(given, F.lit("")), from_name).alias("eruption_id"), *rest)


def write_minutes(minutes: DataFrame, path: str, mode: str = "overwrite", files_per_period: int | None = None) -> None:
    """Parquet in a folder per period (``eruption_id``), each file sorted by station, channel, time.

    Rows are range-partitioned by period, station, channel and time from sampled bounds: tasks and files are even, however
    large a period is, small ones share a task, and files don't overlap, so that their statistics prune. With
    ``files_per_period`` rows are spread by a hash of station, channel and day instead.
    """
    order = ["eruption_id", "station", "channel", "time_min"]
    if files_per_period is None:
        ranged = minutes.repartitionByRange(*order).sortWithinPartitions(*order)
        ranged.write.mode(mode).partitionBy("eruption_id").parquet(path)
        return
    spread = [F.col("eruption_id")]
    if files_per_period > 1:
        spread.append(F.pmod(F.xxhash64("station", "channel", F.to_date("time_min")), F.lit(files_per_period)))
    (
        minutes.repartition(*spread)
        .sortWithinPartitions(*order)
        .write.mode(mode)
        .partitionBy("eruption_id")
        .parquet(path)
    )


def write_sequences(sequences: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet partitioned by split."""
    sequences.write.mode(mode).partitionBy("split").parquet(path)


def read_sequences(spark: SparkSession, path: str, required: Sequence[str] = SPLITS) -> DataFrame:
    """Sequences of all splits; fails when a required split has no row (only the partition column is read)."""
    use_utc(spark)
    sequences = spark.read.parquet(path)
    present = {r["split"] for r in sequences.select("split").distinct().collect()}
    missing = [s for s in required if s not in present]
    if missing:
        raise ContractViolation(f"required splits missing in {path}: {missing}")
    return sequences


def write_params(params: DataFrame, path: str) -> None:
    """Contract and fit parameters: one small file ordered by position."""
    params.coalesce(1).sortWithinPartitions("idx").write.mode("overwrite").parquet(path)


def read_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARAMS).parquet(path)


def read_contract(spark: SparkSession, path: str) -> list[str]:
    """Ordered feature names from a params table, or from a text file with one name per line."""
    if path.endswith(".txt"):
        lines = spark.read.text(path, wholetext=True).first()
        names = [n.strip() for n in lines[0].splitlines() if n.strip()] if lines else []
    else:
        names = [r["name"] for r in read_params(spark, path).orderBy("idx").select("name").collect()]
    if not names:
        raise ContractViolation(f"empty feature contract: {path}")
    return names


def write_contract(spark: SparkSession, names: Sequence[str], path: str) -> None:
    """Ordered feature names as a small table (``read_contract`` takes it back)."""
    spark.createDataFrame(list(enumerate(names)), "idx int, name string").coalesce(1).write.mode("overwrite").parquet(path)
