"""Minutes kept up to date from files that come and change: only pending files are read, only touched cells are rewritten.

Under ``root``:

* ``states``, by day and batch: mergeable partial states of every integrated file, one row per file, sensor and minute;
* ``covers``, by batch: which period and day cells each file reaches;
* ``minutes``, by period and day: the finished minute table;
* ``manifest``: versions of the input manifest, published last by a marker (``Snapshots``).

The manifest names the batch that holds the valid states of a file, so states of an older version of a file, or of a run that
died, are never merged. A run can be repeated at any point: each step overwrites its own partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorloom.operators import minutes
from tremorloom.schemas import MINUTE_COLUMNS, MINUTES
from tremorloom.session import stored, use_utc
from tremorloom.sources import manifest
from tremorloom.sources.snapshots import Snapshots

_TEXT, _COUNT, _TIME = T.StringType(), T.LongType(), T.TimestampType()
MANIFEST = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in {
            "path": _TEXT, "absolute_path": _TEXT, "size_bytes": _COUNT, "mtime_ns": _COUNT, "status": _TEXT,
            "first_seen_at_utc": _TIME, "last_seen_at_utc": _TIME, "integrated_at_utc": _TIME, "last_training_run_id": _TEXT,
        }.items()
    ]
)
_STATES = (
    "eruption_id string, network string, station string, channel string, source string, n long, mean double, m2 double, "
    "high double, low double, low_n long, high_n long, low_energy double, high_energy double, rate double, "
    "time_min timestamp, day date, batch string"
)
_COVERS = "eruption_id string, day date, source string, batch string"


class MinuteStore:
    """Incremental minute table in ``root``, a folder that all executors share.

    ``read(paths)`` gives the conditioned samples of files, as ``minute_aggregate`` takes them, with the file's path in
    ``source``, spelled as in the listing.
    """

    def __init__(self, spark: SparkSession, root: str, read: Callable[[Sequence[str]], DataFrame], step_seconds: int = 60):
        self.spark, self.root, self.read, self.step_seconds = use_utc(spark), root.rstrip("/"), read, step_seconds
        self.published = Snapshots(spark, f"{self.root}/manifest")

    def manifest(self) -> DataFrame:
        return self.published.latest("files", MANIFEST)

    def minutes(self) -> DataFrame:
        """The minute table as the last batch left it."""
        if self.published.last() is None:
            return self.spark.createDataFrame([], MINUTES)
        schema = T.StructType([*MINUTES.fields, T.StructField("day", T.DateType())])
        # a touched cell always has a row, without a time, so that it is overwritten even if nothing is left in it
        return self.spark.read.schema(schema).parquet(f"{self.root}/minutes").where("time_min IS NOT NULL").select(*MINUTE_COLUMNS)

    def integrate(self, batch: str, listing: DataFrame, now: Column) -> int:
        """Take up the files of ``listing`` that are new or changed; the number of them.

        A file is added with all its samples, in any order of files; a changed one replaces what it gave before. The same
        batch id again changes nothing. Files that are no longer listed keep their minutes.
        """
        if self.published.known(batch):
            return 0
        before = self.manifest()
        snapshot = stored(manifest.update_manifest(before, listing, now), "snapshot")
        pending = snapshot.where("pending")
        paths = [r["absolute_path"] for r in pending.select("absolute_path").collect()]  # names of this batch's files
        if paths:
            self._write_states(batch, paths)
            self._write_minutes(batch, before, snapshot)
        done = manifest.mark_integrated(pending.select("path", "absolute_path"), snapshot, batch, now) if paths else snapshot
        records = done.select(*[F.col(f.name).cast(f.dataType) for f in MANIFEST.fields])
        self.published.publish(batch, lambda commit: records.write.parquet(self.published.folder("files", commit)))
        return len(paths)

    def _write_states(self, batch: str, paths: Sequence[str]) -> None:
        states = minutes.minute_states(self.read(paths), self.step_seconds, ["source"]).withColumns(
            {"day": F.to_date("time_min"), "batch": F.lit(batch)}
        )
        by_day = states.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        by_day.partitionBy("day", "batch").parquet(f"{self.root}/states")
        own = self._states().where(F.col("batch") == batch)
        own.select("eruption_id", "day", "source").distinct().write.mode("overwrite").parquet(f"{self.root}/covers/batch={batch}")

    def _states(self) -> DataFrame:
        return self.spark.read.schema(_STATES).parquet(f"{self.root}/states")

    def _write_minutes(self, batch: str, before: DataFrame, snapshot: DataFrame) -> None:
        covers = self.spark.read.schema(_COVERS).parquet(f"{self.root}/covers")
        valid = before.where("status = 'integrated'").select(F.col("absolute_path").alias("source"), F.col("last_training_run_id").alias("batch"))
        now_pending = snapshot.where("pending").select(F.col("absolute_path").alias("source"))
        outdated = valid.join(now_pending, "source", "left_semi")
        dead = covers.join(self.published.markers().select("batch"), "batch", "left_anti")  # this batch, and runs that died
        touched = dead.unionByName(covers.join(outdated, ["source", "batch"], "left_semi"))
        cells = stored(touched.select("eruption_id", "day").distinct(), "cells")
        days = [r["day"] for r in cells.select("day").distinct().collect()]  # calendar days
        current = valid.join(now_pending, "source", "left_anti").unionByName(now_pending.withColumn("batch", F.lit(batch)))
        states = (
            self._states().where(F.col("day").isin(days)).join(cells, ["eruption_id", "day"], "left_semi").join(current, ["source", "batch"], "left_semi")
        )
        merged = minutes.merged_minutes(states).withColumn("day", F.to_date("time_min"))
        rows = merged.unionByName(cells, allowMissingColumns=True)
        writer = rows.hint("rebalance", "eruption_id", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("eruption_id", "day").parquet(f"{self.root}/minutes")


def samples_of(spark: SparkSession, schema: T.StructType | str) -> Callable[[Sequence[str]], DataFrame]:
    """Reader of Parquet sample files for ``MinuteStore``: ``source`` is the path as ``inputs.list_files`` spells it."""
    return lambda paths: spark.read.schema(schema).parquet(*paths).withColumn("source", F.regexp_replace("_metadata.file_path", "^file:/*", "/"))
