"""Session settings and the lineage-cutting helper shared by all jobs."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """All timestamps of this library are instants read and printed in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build_session(app_name: str = "tremorloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC and adaptive execution on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def found_by_workers(spark: SparkSession) -> None:
    """On one machine Python workers import this package from where the driver has it (a cluster gets it by --py-files)."""
    root, known = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH")]))


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where none is configured (tests on one machine) a scratch folder is used, because on a cluster it must be
    storage that all executors share.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            configured = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir().rstrip("/")


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=eager)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written as Parquet to the shared folder and read back: like a checkpoint, but later reads take the columns they need."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def told(observation: Observation) -> dict:
    """Metrics of an observation whose rows were written; {} where Spark knew that there are no rows and left it out."""
    try:
        return observation.get
    except Py4JJavaError as error:
        if "toPyRow" not in str(error):
            raise
        return {}
