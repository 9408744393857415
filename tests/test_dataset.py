"""Sequences, splits, fit and the training / inference jobs."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tremorloom.functions.labels import horizon_label
from tremorloom.operators import gates, scaling, sequences
from tremorloom.operators.periods import ContractViolation
from tremorloom.plans import jobs
from tremorloom.schemas import MINUTE_COLUMNS
from tremorloom.sources import tables

START = pd.Timestamp("2020-01-01")


def minute_rows(period: str, n: int = 130, start=START) -> pd.DataFrame:
    i = np.arange(n)
    mean = np.sin(2 * np.pi * i / (n - 1))
    p = pd.DataFrame({"eruption_id": period, "network": "PF", "station": "CSS", "channel": "HHZ", "time_min": start + pd.to_timedelta(i, unit="min")})
    p["amplitude_mean"], p["amplitude_std"] = mean, 0.1
    p["amplitude_max"], p["amplitude_min"], p["amplitude_count"] = mean + 0.2, mean - 0.2, 100
    p["energy_low_1_5_5"], p["energy_high_6_16"] = np.linspace(1, 2, n), np.linspace(0.5, 1.5, n)
    p["frequency_index"] = np.linspace(0.1, 0.9, n)
    for c, v in zip(MINUTE_COLUMNS[13:], (100.0, 1.0, 16.0, 1.0, 5.5, 6.0, 16.0)):
        p[c] = v
    return p


def period_table(spark, rows):
    full = [(pid, kind, start, "", split, i) for i, (pid, kind, start, split) in enumerate(rows, start=1)]
    return spark.createDataFrame(
        full, "period_id string, period_type string, eruption_start_utc string, eruption_end_utc string, split string, period_ord int"
    )


def test_inference_job_130_minutes_give_three_sequences(spark):
    names = ["amplitude_mean__CSS__HHZ"] + [f"feature_{i:04d}" for i in range(1, 992)]
    params = spark.createDataFrame(
        pd.DataFrame({"idx": range(992), "name": names, "median": 0.0, "mean": 0.0, "scale": 1.0})
    )
    table = period_table(spark, [("quiet_test", "quiet", "", "")])
    out = jobs.inference_sequences(spark.createDataFrame(minute_rows("quiet_test")), table, names, params, 120, 5)
    rows = out.orderBy("t_end").collect()
    assert len(rows) == 3 and {r["period_id"] for r in rows} == {"quiet_test"}
    x = np.array([r["x"] for r in rows], dtype=float)
    assert x.shape == (3, 120, 992) and np.isfinite(x).all()
    np.testing.assert_allclose(x[1, :, 0], np.sin(2 * np.pi * np.arange(5, 125) / 129), atol=1e-6)
    assert [r["t_end"] for r in rows] == [START.to_pydatetime() + dt.timedelta(minutes=m) for m in (119, 124, 129)]


def test_training_job_has_three_splits_and_train_statistics(spark):
    table = period_table(spark, [("q1", "quiet", "", ""), ("e1", "eruption", "2020-01-03T00:00:00Z", "")])
    data = pd.concat([minute_rows("q1"), minute_rows("e1", start=START + pd.Timedelta(days=1))], ignore_index=True)
    out, params = jobs.training_dataset(spark.createDataFrame(data), table, length=40, stride=5, train_ratio=0.34, val_ratio=0.33)
    rows = out.collect()
    assert {r["split"] for r in rows} == {"train", "val", "test"}
    assert all(len(r["x"]) == 40 for r in rows)
    n_features = params.count()
    x = np.array([r["x"] for r in rows if r["split"] == "train"], dtype=float)
    assert x.shape[2] == n_features == 64
    flat = x.reshape(-1, n_features)
    np.testing.assert_allclose(flat.mean(axis=0), 0, atol=1e-4)
    spread = flat.std(axis=0)
    assert ((np.abs(spread - 1) < 1e-3) | (spread < 1e-6)).all()
    assert {r["y"] for r in rows} <= {0, 3, 4, 5}


def test_manual_split_needs_all_three(spark):
    table = period_table(spark, [("a", "quiet", "", "train"), ("b", "quiet", "", "val")])
    ends = spark.createDataFrame([("a",), ("b",)], "period_id string")
    with pytest.raises(ContractViolation, match="test"):
        sequences.split_manual(ends, table)


def test_label_boundaries(spark):
    hours = [0.0, 6.0, 6.01, 12.0, 24.0, 36.0, 48.0]
    df = spark.createDataFrame([(h,) for h in hours], "h double").select(horizon_label("h").alias("y"))
    assert [r["y"] for r in df.collect()] == [5, 5, 4, 4, 3, 2, 1]
    for bad in (48.01, -0.1):
        with pytest.raises(Exception, match="hours"):
            spark.createDataFrame([(bad,)], "h double").select(horizon_label("h")).collect()


def test_ends_outside_the_horizon_are_dropped_or_clamped(spark):
    event = dt.datetime(2020, 1, 3)
    hours = [-0.1, 0.0, 48.0, 48.01]
    rows = [(event, event - dt.timedelta(hours=h)) for h in hours]
    df = spark.createDataFrame(rows, "eruption_start_utc timestamp, t_end timestamp")
    assert sorted(r["hours"] for r in sequences.hours_to_event(df).collect()) == [0.0, 48.0]
    assert sorted(r["hours"] for r in sequences.hours_to_event(df, clamp_after_event=True).collect()) == [0.0, 0.0, 48.0]


@pytest.mark.parametrize("n,train,val", [(3, 0.7, 0.15), (10, 0.34, 0.33), (1000, 0.7, 0.15), (77, 0.1, 0.85), (9, 0.98, 0.01)])
def test_chronological_split_has_the_python_bounds(spark, n, train, val):
    rng = np.random.default_rng(n)
    t = [dt.datetime(2020, 1, 1) + dt.timedelta(hours=int(h)) for h in rng.integers(0, 60, n)]
    rows = list({(ti, f"p{i % 7}-{i}") for i, ti in enumerate(t)})
    df = spark.createDataFrame(rows, "t_end timestamp, period_id string")
    a, b = sequences.chronological_bounds(len(rows), train, val)
    assert 1 <= a < b < len(rows)
    want = {key: "train" if i < a else "val" if i < b else "test" for i, key in enumerate(sorted(rows))}
    got = {(r["t_end"], r["period_id"]): r["split"] for r in sequences.split_chronological(df, train, val).collect()}
    assert got == want


def test_fewer_than_three_sequences_cannot_be_split():
    with pytest.raises(ContractViolation):
        sequences.chronological_bounds(2, 0.7, 0.15)


def test_fit_equals_numpy_on_the_expanded_tensor(spark):
    rng = np.random.default_rng(3)
    n, length, stride, k = 140, 12, 5, 4
    x = rng.normal(50, 3, (n, k)).astype(np.float32)
    x[:, 1] = np.round(x[:, 1])
    x[rng.random((n, k)) < 0.2] = np.nan
    x[:, 2] = np.nan
    x[5:9, 0] = np.inf
    frame = pd.DataFrame({"period_id": "p", "time_min": [START + pd.Timedelta(minutes=i) for i in range(n)], "x": [[float(v) for v in r] for r in x]})
    df = spark.createDataFrame(frame).withColumn("x", F.col("x").cast("array<float>"))
    indexed = sequences.index_rows(df, bucket="hour")
    ends = sequences.sequence_ends(indexed, length, stride)
    kept = ends.where("end_rn < 90")
    weighted = sequences.sequence_weights(indexed, kept, length, chunk_rows=25)
    params = scaling.fit_params(weighted, [f"f{i}" for i in range(k)]).orderBy("idx").toPandas()
    tensor = np.stack([x[e - length : e] for e in range(length, 90, stride)]).reshape(-1, k)
    for j in range(k):
        col = tensor[:, j]
        good = col[np.isfinite(col)]
        median = np.float32(np.median(good)) if len(good) else np.float32(0)
        filled = np.where(np.isfinite(col), col, median).astype(np.float64)
        std = filled.std()
        assert params["median"][j] == median
        assert params["mean"][j] == pytest.approx(np.float32(filled.mean()), rel=1e-6)
        assert params["scale"][j] == pytest.approx(np.float32(std if std else 1.0), rel=1e-6)


def test_apply_replaces_bad_scales_and_checks_lengths(spark):
    df = spark.createDataFrame([([1.0, None, float("nan")],)], "x array<float>")
    params = spark.createDataFrame(
        [(0, "a", 0.0, 0.5, 0.0), (1, "b", 4.0, 1.0, 2.0), (2, "c", 7.0, 0.0, float("nan"))],
        "idx int, name string, median float, mean float, scale float",
    )
    assert scaling.apply_params(df, params, 3).first()["x"] == [0.5, 1.5, 7.0]
    with pytest.raises(ContractViolation):
        scaling.apply_params(df, params.where("idx < 2"), 3)
    with pytest.raises(Exception, match="vector width"):
        scaling.apply_params(df, params.where("idx < 2"), 2).collect()


def test_latest_batch_follows_period_order_then_time(spark):
    rows = [(i, 1 if i < 2 else 2, "a" if i < 2 else "b", dt.datetime(2026, 1, 1, 0, 10 * i)) for i in range(5)]
    # the second period is older than the first one
    rows = [(i, o, p, t - dt.timedelta(days=1) if o == 2 else t) for i, o, p, t in rows]
    df = spark.createDataFrame(rows, "seq_id int, period_ord int, period_id string, t_end timestamp")
    assert [r["seq_id"] for r in sequences.latest_batch(df, 1).collect()] == [4]
    assert sorted(r["seq_id"] for r in sequences.latest_batch(df, 2).collect()) == [3, 4]
    with pytest.raises(ContractViolation):
        sequences.latest_batch(df, 6)


def random_dataset(spark, spoil=None):
    rng = np.random.default_rng(42)
    rows = []
    for split, ys in (("train", [0, 1, 2]), ("val", [3, 4]), ("test", [4, 5])):
        for y in ys:
            rows.append([len(rows), split, float(y), rng.normal(size=(4, 3)).tolist()])
    if spoil:
        spoil(rows)
    return spark.createDataFrame(rows, "seq_id long, split string, y double, x array<array<float>>")


def broken_rules(df):
    return {(r["split"], r["rule"]) for r in gates.dataset_contract(df, 4, 3).where("n_bad > 0").collect()}


def test_dataset_contract_accepts_and_rejects(spark):
    assert broken_rules(random_dataset(spark)) == set()
    profile = gates.split_profile(random_dataset(spark))
    assert all(r["success"] for r in gates.expect(profile, gates.split_rules(profile, 4, 3)).collect())

    def nan(rows):
        rows[0][3][1][1] = float("nan")

    def label(rows):
        rows[3][2] = 6.0

    def fraction(rows):
        rows[4][2] = 2.5

    def shape(rows):
        rows[5][3].pop()

    assert broken_rules(random_dataset(spark, nan)) == {("train", "finite")}
    assert broken_rules(random_dataset(spark, label)) == {("val", "label_range")}
    assert broken_rules(random_dataset(spark, fraction)) == {("val", "label_integer")}
    assert broken_rules(random_dataset(spark, shape)) == {("test", "seq_len")}
    assert broken_rules(random_dataset(spark).where("split <> 'val'")) == {("val", "split_present")}


def test_sixteen_expectations_on_a_latest_batch(spark):
    x = np.random.default_rng(42).normal(size=(120, 992)).astype(float)
    df = spark.createDataFrame([(0, x.tolist())], "seq_id long, x array<array<float>>")
    profile = gates.sequence_profile(df)
    results = gates.expect(profile, gates.batch_rules(profile, 1, 120, 992)).collect()
    assert len(results) == 16 and all(r["success"] for r in results)
    failed = {r["rule"] for r in gates.expect(profile, gates.batch_rules(profile, 2, 60, 992)).collect() if not r["success"]}
    assert failed == {"row_count", "seq_len_between"}


def test_sequences_and_params_round_trip(spark, tmp_path):
    tables.write_sequences(random_dataset(spark), str(tmp_path / "seq"))
    assert tables.read_sequences(spark, str(tmp_path / "seq")).count() == 7
    tables.write_sequences(random_dataset(spark).where("split <> 'test'"), str(tmp_path / "part"))
    with pytest.raises(ContractViolation, match="test"):
        tables.read_sequences(spark, str(tmp_path / "part"))
    params = spark.createDataFrame([(1, "b", 0.0, 0.0, 1.0), (0, "a", 0.0, 0.0, 1.0)], "idx int, name string, median float, mean float, scale float")
    tables.write_params(params, str(tmp_path / "params"))
    assert tables.read_contract(spark, str(tmp_path / "params")) == ["a", "b"]
    (tmp_path / "names.txt").write_text("x\n\n y \n")
    assert tables.read_contract(spark, str(tmp_path / "names.txt")) == ["x", "y"]
