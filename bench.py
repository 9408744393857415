"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from checks import QUERIES  # noqa: E402
from checks.support import table  # noqa: E402
from tremorloom import build_session  # noqa: E402
from tremorloom.operators import features, minutes  # noqa: E402
from tremorloom.session import cut_lineage  # noqa: E402

# what a full run goes through, from samples to decisions
HEADLINE = [
    "assign_periods",
    "minute_aggregate",
    "minute_quality",
    "sensor_features",
    "network_stats_full",
    "contract_vectors",
    "build_sequences",
    "split_chronological_lines",
    "fit_params",
    "apply_params",
    "exact_quantiles",
    "weighted_quantiles",
    "sequence_summary",
    "feature_drift",
    "distribution_drift",
    "metric_values",
    "threshold_sweep",
    "alert",
    "detect_new_files",
    "compare_candidates",
]


def supplier_features(spark, sf_dir):
    """All 58 features of every (supplier, return flag) as a sensor, order lines as samples, days as cells."""
    li = table(spark, sf_dir, "lineitem")
    samples = li.select(
        F.lit("P").alias("period_id"),
        F.lit("LI").alias("network"),
        F.col("l_suppkey").cast("string").alias("station"),
        F.col("l_returnflag").alias("channel"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_quantity").alias("amplitude"),
        F.col("l_extendedprice").alias("low"),
        F.col("l_discount").alias("high"),
        F.lit(100.0).alias("sampling_rate"),
    )
    # the features of a job read a stored minute table
    daily = cut_lineage(features.prepare_minutes(minutes.minute_aggregate(samples, 86_400)))
    return features.sensor_features(daily, bucket="year")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=os.environ.get("BENCH_PARTITIONS", cpus),
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    todo = {name: QUERIES[name] for name in HEADLINE} | {"supplier_features": supplier_features}
    timings: dict[str, float] = {}
    spark.range(1000).selectExpr("sum(id)").collect()
    for name, query in todo.items():
        started = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    sf = Path(sf_dir).name.removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings, "sf": sf}
        )
    )


if __name__ == "__main__":
    main()
