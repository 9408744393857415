"""Publication of tables by versioned folders and a marker that is written last.

A publication writes its tables to folders of their own, ``<root>/<table>/commit=<name>``, and then one small marker to
``<root>/commits``. Readers follow markers only, so what a crash left behind is never seen, and a publication shows all its
tables at once or none. A batch id is published once: the same batch again changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorloom.operators.periods import ContractViolation

MARKERS = "version long, batch string, commit string"


class Snapshots:
    """Published tables under ``root``, in storage that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, name: str) -> bool:
        path, files = self._path(name)
        return files.exists(path)

    def markers(self) -> DataFrame:
        """A row for each publication."""
        if not self._exists("commits"):
            return self.spark.createDataFrame([], MARKERS)
        return self.spark.read.schema(MARKERS).json(f"{self.root}/commits")

    def last(self) -> Row | None:
        return self.markers().orderBy(F.desc("version")).first()

    def known(self, batch: str) -> bool:
        return bool(self.markers().where(F.col("batch") == batch).take(1))

    def folder(self, table: str, commit: str) -> str:
        return f"{self.root}/{table}/commit={commit}"

    def publish(self, batch: str, write: Callable[[str], None]) -> bool:
        """``write(commit)`` fills folders of that commit; then the marker makes them visible. False: was published before.

        If ``write`` raises, nothing becomes visible. Of two publications at the same time one fails.
        """
        if not batch or not batch.strip():
            raise ContractViolation("the batch id must not be empty")
        if self.known(batch):
            return False
        last = self.last()
        version = 1 + (last["version"] if last else 0)
        commit = f"{version:010d}-{uuid.uuid4().hex}"
        write(commit)
        self.mark(version, batch, commit)
        return True

    def mark(self, version: int, batch: str, commit: str) -> None:
        """Write the marker under another name and rename it, which shows it whole or not at all."""
        draft, files = self._path(f"drafts/{commit}")
        out = files.create(draft, False)
        out.write(bytearray(json.dumps({"version": version, "batch": batch, "commit": commit}).encode()))
        out.close()
        final, _ = self._path(f"commits/{version:010d}.json")
        files.mkdirs(final.getParent())
        if files.exists(final) or not files.rename(draft, final):
            raise ContractViolation(f"version {version} was published by another job; publish batch {batch} again")

    def latest(self, table: str, schema: T.StructType) -> DataFrame:
        """The table as the last publication left it; without one an empty table."""
        last = self.last()
        if last is None or not self._exists(f"{table}/commit={last['commit']}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.folder(table, last["commit"]))

    def all_rows(self, table: str, schema: T.StructType) -> DataFrame:
        """Rows of all publications, each with its ``commit``; folders without a marker are not read."""
        with_commit = T.StructType([*schema.fields, T.StructField("commit", T.StringType())])
        if not self._exists(table):
            return self.spark.createDataFrame([], with_commit)
        rows = self.spark.read.schema(with_commit).parquet(f"{self.root}/{table}")
        return rows.join(self.markers().select("commit"), "commit", "left_semi")
