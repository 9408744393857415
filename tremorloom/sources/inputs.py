"""Which input file belongs to which period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorloom.schemas import MINUTE_FILE_SUFFIX


def list_files(spark: SparkSession, path: str, recursive: bool = False, pattern: str | None = None) -> DataFrame:
    """Files under a folder as ``(path, absolute_path, size_bytes, modified, mtime_ns)``; contents are not read.

    The columns are those that ``update_manifest`` takes; ``path`` is absolute too.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    plain = F.regexp_replace("path", "^file:/*", "/")
    return reader.load(path).select(
        plain.alias("path"),
        plain.alias("absolute_path"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified"),
        (F.unix_micros("modificationTime") * 1000).alias("mtime_ns"),
    )


def expected_path(directory: str, suffix: str = MINUTE_FILE_SUFFIX) -> Column:
    """Explicit ``csv_path``, else ``<directory>/<period_id><suffix>``."""
    explicit = F.nullif(F.trim("csv_path"), F.lit(""))
    return F.coalesce(explicit, F.concat(F.lit(directory.rstrip("/") + "/"), F.col("period_id"), F.lit(suffix)))


def resolve_inputs(periods: DataFrame, files: DataFrame, directory: str, suffix: str = MINUTE_FILE_SUFFIX) -> DataFrame:
    """Periods with ``input_path`` and ``found``; the file listing is a table with a ``path`` column."""
    known = files.select(F.col("path").alias("input_path"), F.lit(True).alias("found")).distinct()
    return (
        periods.withColumn("input_path", expected_path(directory, suffix))
        .join(known, "input_path", "left")
        .fillna(False, ["found"])
    )


def missing_inputs(periods: DataFrame, files: DataFrame, directory: str, suffix: str = MINUTE_FILE_SUFFIX) -> DataFrame:
    """All periods whose file is absent (not only the first one)."""
    known = files.select(F.col("path").alias("input_path"))
    return (
        periods.withColumn("input_path", expected_path(directory, suffix))
        .join(known, "input_path", "left_anti")
        .select("period_id", "input_path")
    )


def resolve_uris(
    rows: DataFrame, bucket: str | None = None, prefix: str | None = None, scheme: str = "s3a"
) -> DataFrame:
    """Adds ``input_uri`` and ``uri_problem``.

    Precedence: ``s3_csv_path``, a full URI in ``csv_path``, ``s3_csv_key``, then ``prefix`` + base name of
    ``csv_path``; otherwise the local ``csv_path``. ``s3_bucket`` of a row overrides ``bucket``. A key without
    any bucket is a problem, as is an ``s3_csv_path`` that is blank.
    """
    has = set(rows.columns)
    text = lambda c: F.trim(F.col(c)) if c in has else F.lit(None).cast("string")
    row_bucket = F.nullif(text("s3_bucket"), F.lit(""))
    own_bucket = F.coalesce(row_bucket, F.lit(bucket).cast("string"))
    is_uri = lambda c: F.coalesce(c.rlike("^s3[an]?://"), F.lit(False))
    as_uri = lambda c: F.regexp_replace(c, "^s3[an]?://", f"{scheme}://")
    from_key = lambda key: F.concat(F.lit(f"{scheme}://"), own_bucket, F.lit("/"), key)
    full, path, key = text("s3_csv_path"), text("csv_path"), text("s3_csv_key")
    base = F.regexp_extract(path, "([^/\\\\]+)$", 1)
    prefixed = F.concat(F.lit((prefix or "").rstrip("/") + "/"), base)
    use_prefix = F.lit(bool(prefix)) & (F.coalesce(path, F.lit("")) != "")
    uri = (
        F.when(full.isNotNull(), F.when(is_uri(full), as_uri(full)).when(full != "", from_key(full)))
        .when(is_uri(path), as_uri(path))
        .when(key.isNotNull(), F.when(is_uri(key), as_uri(key)).otherwise(from_key(key)))
        .when(use_prefix, from_key(prefixed))
        .otherwise(F.nullif(path, F.lit("")))
    )
    problem = (
        F.when(full == "", "blank_s3_csv_path")
        .when(uri.isNull() & (full.isNotNull() | key.isNotNull() | use_prefix), "no_bucket")
        .when(uri.isNull(), "no_path")
    )
    return rows.withColumn("input_uri", uri).withColumn("uri_problem", problem)
