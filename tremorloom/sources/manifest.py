"""Incremental input manifest as a table: detect, integrate, archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorloom.operators.periods import ContractViolation, require_none

_STATE = ["status", "first_seen_at_utc", "last_seen_at_utc", "integrated_at_utc", "last_training_run_id"]
_FILE = ["absolute_path", "size_bytes", "mtime_ns"]


def update_manifest(manifest: DataFrame, listing: DataFrame, now: Column) -> DataFrame:
    """New manifest snapshot plus ``is_new`` and ``pending``.

    ``listing`` has ``path, absolute_path, size_bytes, mtime_ns``. A file whose size, time or absolute path
    differs from the manifest is changed; a changed file that was integrated becomes ``detected`` again and
    loses its run. Pending are listed files that are not integrated. Files that are no longer listed keep
    their record.
    """
    old = manifest.select("path", *[F.col(c).alias(f"_o_{c}") for c in _FILE], *_STATE, F.lit(True).alias("_known"))
    new = listing.select("path", *_FILE, F.lit(True).alias("_listed"))
    both = new.join(old, "path", "full")
    listed, known = F.coalesce("_listed", F.lit(False)), F.coalesce("_known", F.lit(False))
    same = F.lit(True)
    for c in _FILE:
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    reopened = listed & known & ~same & (F.col("status") == "integrated")
    status = F.when(~known | reopened, F.lit("detected")).otherwise(F.col("status"))
    return both.select(
        "path",
        *[F.when(listed, F.col(c)).otherwise(F.col(f"_o_{c}")).alias(c) for c in _FILE],
        status.alias("status"),
        F.when(known, F.col("first_seen_at_utc")).otherwise(now).alias("first_seen_at_utc"),
        F.when(listed, now).otherwise(F.col("last_seen_at_utc")).alias("last_seen_at_utc"),
        F.when(~reopened, F.col("integrated_at_utc")).alias("integrated_at_utc"),
        F.when(~reopened, F.col("last_training_run_id")).alias("last_training_run_id"),
        (~known).alias("is_new"),
        (listed & (status != "integrated")).alias("pending"),
    )


def detection_summary(snapshot: DataFrame, min_new_files: int) -> DataFrame:
    """One row: new and pending counts and whether there are enough files to retrain."""
    if min_new_files < 1:
        raise ValueError("min_new_files must be >= 1")
    return snapshot.agg(
        F.count_if("is_new").alias("new_files_count"),
        F.count_if("pending").alias("pending_files_count"),
        (F.count_if("pending") >= min_new_files).alias("should_retrain"),
    )


def match_manifest(processed: DataFrame, manifest: DataFrame) -> DataFrame:
    """Processed files with the manifest record found by path, else by absolute path.

    Two equality joins; one join with OR would compare every pair.
    """
    by_path = manifest.select(
        F.col("path").alias("_p"), F.struct("path", "status", "last_training_run_id").alias("_m1")
    )
    # several records may share an absolute path; the first by path is taken
    by_absolute = manifest.groupBy(F.col("absolute_path").alias("_a")).agg(
        F.min(F.struct("path", "status", "last_training_run_id")).alias("_m2")
    )
    return (
        processed.join(by_path, F.col("path") == F.col("_p"), "left")
        .join(by_absolute, F.col("absolute_path") == F.col("_a"), "left")
        .withColumn("_m", F.coalesce("_m1", "_m2"))
        .drop("_p", "_a", "_m1", "_m2")
    )


def integration_outcomes(processed: DataFrame, manifest: DataFrame, run_id: str) -> DataFrame:
    """``(path, manifest_path, outcome)``: integrate, already_integrated, other_run or not_in_manifest."""
    if not run_id or not run_id.strip():
        raise ContractViolation("the training run id must not be empty")
    m = F.col("_m")
    done = m["status"] == "integrated"
    outcome = (
        F.when(m["path"].isNull(), "not_in_manifest")
        .when(done & m["last_training_run_id"].eqNullSafe(F.lit(run_id)), "already_integrated")
        .when(done, "other_run")
        .otherwise("integrate")
    )
    return match_manifest(processed, manifest).select(
        "path", m["path"].alias("manifest_path"), outcome.alias("outcome")
    )


def mark_integrated(
    processed: DataFrame, manifest: DataFrame, run_id: str, now: Column, status: str = "integrated"
) -> DataFrame:
    """Manifest snapshot with the processed files marked; the same run again changes nothing.

    Fails when a file is not in the manifest or was integrated by another run.
    """
    outcomes = integration_outcomes(processed, manifest, run_id)
    require_none(
        outcomes.where(F.col("outcome").isin("not_in_manifest", "other_run")), "files cannot be integrated"
    )
    marked = (
        outcomes.where(F.col("outcome") == "integrate")
        .select(F.col("manifest_path").alias("path"))
        .distinct()
        .withColumn("_mark", F.lit(True))
    )
    joined = manifest.join(marked, "path", "left")
    hit = F.coalesce("_mark", F.lit(False))
    return joined.withColumns(
        {
            "status": F.when(hit, F.lit(status)).otherwise(F.col("status")),
            "integrated_at_utc": F.when(hit, now).otherwise(F.col("integrated_at_utc")),
            "last_training_run_id": F.when(hit, F.lit(run_id)).otherwise(F.col("last_training_run_id")),
        }
    ).drop("_mark")


def archive_status(sources: DataFrame, listing: DataFrame, archive_dir: str) -> DataFrame:
    """``archived`` with the target path for sources still present, ``missing_source_file`` otherwise."""
    present = listing.select("path", F.lit(True).alias("_there")).distinct()
    there = F.coalesce("_there", F.lit(False))
    name = F.regexp_extract("path", "([^/]+)$", 1)
    return sources.join(present, "path", "left").select(
        F.col("path").alias("source_path"),
        F.when(there, F.concat(F.lit(archive_dir.rstrip("/") + "/"), name)).alias("archived_path"),
        F.when(there, "archived").otherwise("missing_source_file").alias("status"),
    )
