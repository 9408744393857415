"""End-to-end extraction, the minute stream, and the shape of physical plans."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_signal import both_ways, trace
from tremorloom.operators import features, minutes, periods, ranking, sequences
from tremorloom.plans import jobs
from tremorloom.schemas import MINUTES, MINUTE_COLUMNS
from tremorloom.sources import tables


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def period_frame(spark, rows):
    columns = "period_id period_type period_start_utc period_end_utc eruption_start_utc eruption_end_utc split network stations channels"
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns.split()))


def test_extraction_job(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=24_000) + np.linspace(0, 50, 24_000)
    good = trace(x).drop(columns="period_id")
    gap = good.drop(index=range(7000, 7300))
    slow = trace(rng.normal(size=3000), rate=25.0, station="SLOW").drop(columns="period_id")
    other = trace(rng.normal(size=3000), station="OTHER").drop(columns="period_id")
    samples = spark.createDataFrame(pd.concat([gap, slow, other], ignore_index=True))
    table = period_frame(spark, [("p1", "calm", "2020-01-01T00:00:00Z", "2020-01-01T00:03:00Z", "", "", "", "N", "CSS,SLOW", "HHZ")])
    out = jobs.extract_minutes(samples, table).orderBy("time_min").toPandas()
    assert list(out.columns) == MINUTE_COLUMNS
    # the slow station fails Nyquist, the other one was not requested, the fourth minute is outside the period
    assert out.station.tolist() == ["CSS"] * 3 and out.amplitude_count.tolist() == [6000] * 3
    filled = x[:18_000].copy()
    filled[7000:7300] = np.interp(np.arange(7000, 7300), [6999, 7300], [x[6999], x[7300]])
    t = np.arange(18_000)
    flat = filled - np.polyval(np.polyfit(t, filled, 1), t)
    full, low, high = (both_ways(flat, *band, 100.0) for band in ((1, 16), (1, 5.5), (6, 16)))
    middle = slice(6000, 12_000)
    row = out.iloc[1]
    assert row.amplitude_std == pytest.approx(full[middle].std(ddof=1), rel=1e-6)
    assert row.amplitude_max == pytest.approx(full[middle].max(), rel=1e-6)
    e_low, e_high = (low[middle] ** 2).mean(), (high[middle] ** 2).mean()
    assert row.energy_low_1_5_5 == pytest.approx(e_low, rel=1e-6)
    assert row.frequency_index == pytest.approx(np.log10((e_high + 1e-12) / (e_low + 1e-12)), abs=1e-6)


def test_broken_period_table_stops_the_extraction(spark):
    table = period_frame(spark, [("p1", "calm", "2020-01-02T00:00:00Z", "2020-01-01T00:00:00Z", "", "", "", "N", "", "")])
    with pytest.raises(periods.ContractViolation, match="end_not_after_start"):
        jobs.extract_minutes(spark.createDataFrame(trace(np.ones(3)).drop(columns="period_id")), table)


@pytest.fixture()
def minute_table(spark, tmp_path):
    i = np.arange(3000)
    p = pd.DataFrame({"eruption_id": "p", "network": "N", "station": "S" + pd.Series(i % 3).astype(str), "channel": "Z", "time_min": pd.Timestamp("2020-01-01") + pd.to_timedelta(i // 3, unit="min")})
    for c in MINUTE_COLUMNS[5:]:
        p[c] = (i * 7919 % 101).astype(float)
    p["amplitude_count"] = 5
    df = spark.createDataFrame(p[MINUTE_COLUMNS], MINUTES)
    tables.write_minutes(df, str(tmp_path / "m"), files_per_period=2)
    return tables.read_minutes(spark, str(tmp_path / "m"), "parquet")


def test_feature_plan_has_one_sort_for_all_frames_and_no_nested_loop(spark, minute_table):
    plan = plan_of(features.sensor_features(features.prepare_minutes(minute_table)))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SinglePartition" not in plan
    # ranking inside days, running sum of day counts, counts, and the shared frame shuffle
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 4
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*_chunk", plan)) == 1


def test_columns_and_filters_reach_the_scan(spark, minute_table):
    kept = features.prepare_minutes(minute_table).where("eruption_id = 'p' AND station = 'S1'").select("time_min", "amplitude_mean")
    plan = plan_of(kept)
    assert "PartitionFilters: [isnotnull(eruption_id" in plan and "EqualTo(station,S1)" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} <= {"time_min", "amplitude_mean", "station"}


def test_period_join_is_an_equality_join(spark):
    rows = period_frame(spark, [(f"p{i}", "calm", "2020-01-01T00:00:00Z", "2020-01-09T00:00:00Z", "", "", "", "N", "", "") for i in range(3)])
    samples = spark.createDataFrame(trace(np.ones(5)).drop(columns="period_id"))
    joined = periods.assign_periods(samples, periods.typed_periods(periods.tidy_periods(rows)))
    plan = plan_of(joined)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "HashJoin [_day" in plan
    assert joined.count() == 15


def test_no_query_plan_multiplies_tables(spark):
    from checks import QUERIES

    small = "/root/testdata/sf0.001"
    for name in ("network_stats_full", "ks_distance", "population_stability", "detect_new_files", "integration_outcomes", "compare_candidates", "promote", "resolve_inputs", "threshold_sweep", "metric_values", "latest_predictions"):
        plan = plan_of(QUERIES[name](spark, small))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_broadcast_only_below_the_known_bound(spark):
    df = spark.range(10).select(F.lit("k").alias("key"), F.col("id").cast("double").alias("v"))
    hinted = lambda n: "BroadcastHashJoin" in plan_of(ranking.exact_quantiles(df, "key", "v", [0.5], n_keys=n))
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert hinted(1) and not hinted(10_000_000) and not hinted(None)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_one_hot_sensor_is_spread_over_many_chunks(spark):
    n = 5000
    df = spark.range(n).select(
        F.lit("p").alias("eruption_id"), F.lit("hot").alias("sensor"), F.timestamp_seconds(F.col("id") * 60).alias("time_min"), F.col("id").cast("double").alias("amplitude_mean")
    )
    frames = features.sensor_frames(df, before=9, chunk_rows=500)
    sizes = {r["_chunk"]: r["n"] for r in frames.groupBy("_chunk").agg(F.count("*").alias("n")).collect()}
    assert max(sizes.values()) <= 509 and len(sizes) >= 10
    assert frames.where("_own").count() == n


def test_quantiles_of_one_heavy_value_and_signs(spark):
    values = [0.0] * 500 + [-3.5, -3.5, -1e-30, 1e-30, 7.25, 1e9] * 50
    df = spark.createDataFrame([("a", v) for v in values] + [("b", float("nan")), ("b", 2.0)], "k string, v double")
    probabilities = [0.0, 0.05, 0.3, 0.5, 0.77, 1.0]
    got = {(r["k"], r["probability"]): r["quantile"] for r in ranking.exact_quantiles(df, "k", "v", probabilities).collect()}
    for p in probabilities:
        assert got["a", p] == pytest.approx(np.quantile(values, p), abs=0, rel=1e-12)
        assert got["b", p] == 2.0


def test_sequences_do_not_depend_on_the_chunk_size(spark):
    df = spark.range(100).select(
        F.lit("p").alias("period_id"), F.timestamp_seconds(F.col("id") * 60).alias("time_min"), F.array(F.col("id").cast("float")).alias("x")
    )
    indexed = sequences.index_rows(df, bucket="hour")
    ends = sequences.sequence_ends(indexed, 7, 3)
    want = [[[float(i)] for i in range(e - 7, e)] for e in range(7, 101, 3)]
    for size in (1, 5, 14, 1000):
        built = sequences.build_sequences(indexed, ends, 7, chunk_rows=size).orderBy("end_rn").collect()
        assert [r["x"] for r in built] == want
