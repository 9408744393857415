"""Mixed headers, file order, ranged files, closed-form gaps, row-local summaries, strict flags."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_jobs_and_plans import period_frame, plan_of
from tests.test_signal import trace
from tremorloom.operators import decision, drift, periods, sequences, signal
from tremorloom.schemas import MINUTE_COLUMNS, MINUTE_FILE_SUFFIX, MINUTES
from tremorloom.sources import tables


def test_headers_in_any_order_and_missing_columns(spark, tmp_path):
    (tmp_path / "a b_minutes.csv").write_text("﻿eruption_id,amplitude_mean,amplitude_std\np,1,9\n")
    (tmp_path / f"b{MINUTE_FILE_SUFFIX}").write_text('"amplitude_std",eruption_id,amplitude_mean\n8,q,2\n7,,3\n')
    (tmp_path / "c_minutes.csv").write_text("eruption_id,amplitude_mean\nr,4\n")
    (tmp_path / "d_minutes.csv").write_text("")
    rows = tables.read_minutes(spark, str(tmp_path), merge_headers=True).select("eruption_id", "amplitude_mean", "amplitude_std").collect()
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == [("p", "1", "9"), ("q", "2", "8"), ("b", "3", "7"), ("r", "4", None)]
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "x.csv").write_text("")
    assert tables.read_minutes(spark, str(tmp_path / "e"), merge_headers=True).count() == 0


def test_period_rows_are_numbered_across_splits(spark, tmp_path):
    path = tmp_path / "periods.csv"
    path.write_text("period_id;network\n" + "".join(f"p{i};{'n' * (i % 50)}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        df = tables.read_periods_csv(spark, str(path))
        rows = df.select("period_id", "period_ord").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {(r["period_id"], r["period_ord"]) for r in rows} == {(f"p{i}", i + 1) for i in range(5000)}
    assert "Window" not in plan_of(df)
    path.write_text("period_id;network\n")
    assert tables.read_periods_csv(spark, str(path)).count() == 0


def test_one_period_is_written_by_many_tasks_in_order(spark, tmp_path):
    i = np.arange(4000)
    p = pd.DataFrame({"eruption_id": "p", "network": "N", "station": "S", "channel": "Z", "time_min": pd.Timestamp("2020-01-01") + pd.to_timedelta(i[::-1], unit="min")})
    for c in MINUTE_COLUMNS[5:]:
        p[c] = 1.0
    p["amplitude_count"] = 5
    df = spark.createDataFrame(p[MINUTE_COLUMNS], MINUTES)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_minutes(df, str(tmp_path / "m"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = spark.read.parquet(str(tmp_path / "m")).groupBy(F.col("_metadata.file_path")).agg(F.min("time_min").alias("a"), F.max("time_min").alias("b"), F.count("*").alias("n"))
    spans = sorted((r["a"], r["b"], r["n"]) for r in back.collect())
    assert len(spans) == 4 and sum(n for *_, n in spans) == 4000
    assert all(left[1] < right[0] for left, right in zip(spans, spans[1:]))


def test_lines_of_gaps_need_no_samples_and_a_long_gap_is_shared(spark):
    rng = np.random.default_rng(5)
    n = 40_000
    full = trace(5 + 1e-4 * np.arange(n) + rng.normal(size=n), rate=0.1)
    holes = sorted({*range(100, 130), 777, *range(5000, 33_000)})
    df = spark.createDataFrame(full.drop(index=holes))
    linked = signal.link_gaps(df)
    closed = signal.linked_trace_lines(linked).first()
    made = signal.trace_lines(signal.interpolate_gaps(df)).first()
    for c in ("_day0", "_slope", "_centre", "_mean"):
        assert closed[c] == pytest.approx(made[c], rel=1e-9), c
    assert "Generate" not in plan_of(signal.linked_trace_lines(linked))
    assert re.search(r"Exchange hashpartitioning\([^)]*_us[^)]*_block", plan_of(signal.fill_gaps(linked)))
    filled = signal.interpolate_gaps(df).where("filled").withColumn("task", F.spark_partition_id())
    counts = [r["count"] for r in filled.groupBy("task").count().collect()]
    assert sum(counts) == len(holes) and len(counts) > 1


def test_summary_is_row_local_and_takes_any_shape(spark):
    rows = [
        (1, [[1.0, 2.0], [3.0, None]], "train"), (2, [[float("nan")], [None]], "val"), (3, [], "val"), (4, None, "test"),
        (5, [[1.0, 2.0, 3.0], [4.0]], "test"), (1, [[7.0]], "train"), (6, [[], [2.0]], "val"),
    ]
    df = spark.createDataFrame(rows, "seq_id int, x array<array<double>>, split string").coalesce(1)
    out = drift.sequence_summary(df)
    assert "Exchange" not in plan_of(out)
    got = {(r["seq_id"], r["sequence_mean"]): r for r in out.collect()}
    assert set(got) == {(1, 2.0), (2, None), (5, 2.5), (1, 7.0), (6, 2.0)}
    five = got[5, 2.5]
    assert five["temporal_delta_mean"] == 2.0 and five["sequence_std"] == pytest.approx(np.std([1, 2, 3, 4]))
    assert five["feature_std_mean"] == pytest.approx(np.mean([1.5, 0, 0])) and five["timestep_std_mean"] == pytest.approx(np.std([1, 2, 3]) / 2)
    assert got[1, 2.0]["first_timestep_mean"] == 1.5 and got[1, 2.0]["sequence_energy_mean"] == pytest.approx(14 / 3)
    assert got[2, None]["split"] == "val" and got[2, None]["sequence_max"] is None


def test_dry_run_must_be_a_json_boolean(spark):
    texts = ['{"dry_run": false}', '{"dry_run": true}', '{"dry_run": "false"}', '{"dry_run": 0}', "{}", "broken"]
    df = spark.createDataFrame([(t,) for t in texts], "result string")
    flags = [r["dry_run"] for r in decision.candidate_metrics(df).select("dry_run").collect()]
    assert flags == [False, True, None, None, None, None]


@pytest.mark.parametrize("few", [1, 50, 100_000])
def test_split_finds_its_keys_among_rows_of_one_instant(spark, monkeypatch, few):
    monkeypatch.setattr(sequences, "_FEW_KEYS", few)
    monkeypatch.setattr(sequences, "_BINS", 7)
    rows = [(f"{'é' * (i % 3)}p{i * 7919 % 1000}", "2020-01-01 10:00:00.000001" if i % 4 else f"2020-01-0{1 + i % 3} 11:00:{i % 60:02d}") for i in range(1000)]
    df = spark.createDataFrame(rows, "period_id string, t string").select("period_id", F.col("t").cast("timestamp").alias("t_end"))
    got = {(r["period_id"], r["split"]) for r in sequences.split_chronological(df, 0.5, 0.3).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[0].encode()))
    want = {(p, "train" if i < 500 else "val" if i < 800 else "test") for i, (p, _) in enumerate(order)}
    assert got == want
    assert "SinglePartition" not in plan_of(sequences.split_chronological(df, 0.5, 0.3))


def test_split_of_equal_keys(spark, monkeypatch):
    monkeypatch.setattr(sequences, "_FEW_KEYS", 3)
    df = spark.createDataFrame([("p",)] * 30, "period_id string").withColumn("t_end", F.lit("2020-01-01").cast("timestamp"))
    assert {r["split"] for r in sequences.split_chronological(df).collect()} == {"test"}


def test_spans_cover_and_stay_few():
    spans = [(0, 10), (5, 12), (100, 110), (13, 20), (500, 501), (30, 30)]
    assert periods.covered_spans(spans) == [(0, 12), (13, 20), (100, 110), (500, 501)]
    assert periods.covered_spans(spans, 2) == [(0, 110), (500, 501)]
    assert periods.covered_spans([]) == []


def test_scattered_periods_and_their_names_reach_the_scan(spark, tmp_path):
    hours = spark.range(24 * 3650).select(
        F.lit("N").alias("network"), F.concat(F.lit("S"), (F.col("id") % 5).cast("string")).alias("station"), F.lit("C").alias("channel"),
        F.timestamp_seconds(F.lit(1_262_304_000) + F.col("id") * 3600).alias("ts"),
    )
    hours.repartitionByRange(20, "ts").write.parquet(str(tmp_path / "s"))
    named = lambda i, year, stations: (f"p{i}", "calm", f"{year}-01-01T00:00:00Z", f"{year}-01-03T00:00:00Z", "", "", "", "N", stations, "")
    samples = spark.read.parquet(str(tmp_path / "s"))
    table = lambda rows: periods.typed_periods(periods.tidy_periods(period_frame(spark, rows)))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    joined = periods.assign_periods(samples, table([named(0, 2010, "S1,S2"), named(1, 2019, "S3")]))
    plan = plan_of(joined)
    pushed = re.search(r"PushedFilters: \[(.*)", plan).group(1)
    assert "Or(And(GreaterThanOrEqual(ts" in pushed and "EqualNullSafe(station,S1)" in pushed and "EqualNullSafe(station,S3)" in pushed
    want = {("p0", "S1"), ("p0", "S2"), ("p1", "S3")}
    assert {(r["period_id"], r["station"]) for r in joined.select("period_id", "station").distinct().collect()} == want
    every = periods.assign_periods(samples, table([named(0, 2010, ""), named(1, 2019, "S3")]))
    assert every.where("period_id = 'p0'").count() == 48 and 8 < every.where("period_id = 'p1'").count() < 12
    assert "EqualNullSafe(station" not in plan_of(every)
    assert periods.assign_periods(samples, table([])).count() == 0
