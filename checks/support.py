"""Registration of check queries and their DuckDB statements.

A check has one output spec, such as ``"station:s time:t n:i mean:d"``, which shapes both sides alike:
``s`` text, ``t`` timestamp, ``i`` bigint, ``b`` boolean, ``d`` double. Doubles are rounded to 10 decimals and
to 24 bits, which absorbs the last-digit differences of two engines that add in different orders.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorloom.session import shared_folder, use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its zone-less timestamps are UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    naive = [c for c, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared one."""
    return f"{shared_folder(spark)}/check-{uuid.uuid4().hex}"


def _fields(spec: str) -> list[tuple[str, str]]:
    return [tuple(part.rsplit(":", 1)) for part in spec.split()]


def shape(df: DataFrame, spec: str) -> DataFrame:
    out = []
    for name, kind in _fields(spec):
        c = F.col(f"`{name}`")
        if kind == "s":
            c = c.cast("string")
        elif kind == "t":
            c = c.cast("timestamp").cast("timestamp_ntz")
        elif kind == "i":
            c = c.cast("bigint")
        elif kind == "b":
            c = c.cast("boolean")
        else:
            c = F.round(c.cast("double"), 10).cast("float").cast("double") + F.lit(0.0)
        out.append(c.alias(name))
    return df.select(*out)


def shape_sql(sql: str, spec: str) -> str:
    kinds = {
        "s": "CAST({c} AS VARCHAR)",
        "t": "CAST({c} AS TIMESTAMP)",
        "i": "CAST({c} AS BIGINT)",
        "b": "CAST({c} AS BOOLEAN)",
        "d": "CAST(CAST(round(CAST({c} AS DOUBLE), 10) AS FLOAT) AS DOUBLE) + 0.0",
    }
    columns = ", ".join(f'{kinds[k].format(c=chr(34) + n + chr(34))} AS "{n}"' for n, k in _fields(spec))
    return f"SELECT {columns} FROM ({sql}) AS shaped"


def check(name: str, spec: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``; ``sql`` is the equivalent DuckDB statement."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate check {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return shape(fn(spark, sf_dir), spec)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = shape_sql(sql, spec)
        return fn

    return register
