"""Gates of the extraction, audited publication, incremental minutes, batches of predictions."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_jobs_and_plans import period_frame
from tests.test_signal import trace
from tremorloom.operators import minutes, periods
from tremorloom.plans import incremental, jobs
from tremorloom.sources import inputs, predictions
from tremorloom.sources.snapshots import Snapshots

def now():
    return F.lit("2026-01-01").cast("timestamp")

PERIOD = ("p1", "calm", "2020-01-01T00:00:00Z", "2020-01-01T00:03:00Z", "", "", "", "N", "", "")


def samples_with(spark, *more: pd.DataFrame):
    rng = np.random.default_rng(1)
    good = trace(rng.normal(size=6000))
    return spark.createDataFrame(pd.concat([good, *more], ignore_index=True).drop(columns="period_id"))


@pytest.mark.parametrize(
    "more, rows, rule",
    [
        ([trace(np.ones(5), rate=0.001, station="ZERO").assign(sampling_rate=0.0)], [PERIOD], "bad_rate"),
        ([trace(np.ones(5), station="NULL").assign(sampling_rate=np.nan)], [PERIOD], "bad_rate"),
        ([trace(np.full(5, np.nan), station="NAN")], [PERIOD], "no_finite_value"),
        ([], [PERIOD, ("p2", "calm", "2021-01-01T00:00:00Z", "2021-01-02T00:00:00Z", "", "", "", "N", "", "")], "no_samples"),
    ],
)
def test_extraction_stops_on_bad_input(spark, tmp_path, more, rows, rule):
    samples = samples_with(spark, *more)
    samples = samples.withColumn("sampling_rate", F.when(~F.isnan("sampling_rate"), F.col("sampling_rate")))
    table = period_frame(spark, rows)
    with pytest.raises(periods.ContractViolation, match=rule):
        jobs.publish_minutes(samples, table, str(tmp_path), "batch")
    assert jobs.published_minutes(spark, str(tmp_path)).count() == 0


def test_minutes_are_published_once_and_whole(spark, tmp_path):
    samples, table, root = samples_with(spark), period_frame(spark, [PERIOD]), str(tmp_path)
    assert jobs.publish_minutes(samples, table, root, "a") and not jobs.publish_minutes(samples, table, root, "a")
    first = jobs.published_minutes(spark, root).collect()
    assert [r["amplitude_count"] for r in first] == [6000]
    for broken, rule in ((F.lit(-1.0), "std_negative"), (F.lit(float("inf")), "frequency_index_infinite")):
        column = "amplitude_std" if rule == "std_negative" else "frequency_index"
        with pytest.raises(periods.ContractViolation, match=rule):
            jobs.publish_audited(lambda: jobs.published_minutes(spark, root).withColumn(column, broken), spark, root, rule)
    with pytest.raises(periods.ContractViolation, match="no trace"):
        jobs.publish_audited(lambda: jobs.published_minutes(spark, root).where("false"), spark, root, "none")
    assert jobs.published_minutes(spark, root).collect() == first


def test_two_publications_of_one_version_and_empty_batch_ids(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    with pytest.raises(periods.ContractViolation, match="another job"):
        store.publish("outer", lambda commit: store.publish("inner", lambda c: None) and None)
    assert [r["batch"] for r in store.markers().collect()] == ["inner"]
    with pytest.raises(periods.ContractViolation, match="empty"):
        store.publish(" ", lambda commit: None)


def conditioned(day: str, seed: int, n: int = 400) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    df = trace(rng.normal(size=n) * 1e3 + 1e6, rate=2.0, start=f"2020-01-{day}T23:58:00")
    df.loc[:3, "amplitude"] = None
    return df.assign(low=rng.normal(size=n), high=rng.normal(size=n))


def test_incremental_minutes_survive_crashes_and_changes(spark, tmp_path, monkeypatch):
    files, root = tmp_path / "files", str(tmp_path / "store")
    files.mkdir()
    kept: dict[str, pd.DataFrame] = {}

    def put(name: str, df: pd.DataFrame) -> None:
        kept[name] = df
        df.assign(ts=df["ts"].dt.tz_localize("UTC")).to_parquet(files / f"{name}.parquet", index=False, coerce_timestamps="us", allow_truncated_timestamps=True)

    put("b", conditioned("02", 1))
    schema = spark.createDataFrame(kept["b"]).schema
    store = incremental.MinuteStore(spark, root, incremental.samples_of(spark, schema))

    def same_as_batch():
        want = minutes.minute_aggregate(spark.createDataFrame(pd.concat(kept.values(), ignore_index=True))).toPandas()
        got = store.minutes().toPandas()
        order = ["station", "time_min"]
        pd.testing.assert_frame_equal(got.sort_values(order, ignore_index=True), want.sort_values(order, ignore_index=True), rtol=1e-12)

    listing = lambda: inputs.list_files(spark, str(files))
    assert store.minutes().count() == 0
    assert store.integrate("one", listing(), now()) == 1 and store.integrate("one", listing(), now()) == 0
    same_as_batch()
    put("a", conditioned("02", 2))  # the same cells, from another file
    put("b", conditioned("05", 3))  # changed, and on another day
    mark = Snapshots.mark

    def stop(*_):
        raise InterruptedError

    monkeypatch.setattr(Snapshots, "mark", stop)
    with pytest.raises(InterruptedError):
        store.integrate("two", listing(), now())
    monkeypatch.setattr(Snapshots, "mark", mark)
    put("b", conditioned("07", 4, n=90))  # changed again before the repetition, under another batch id
    assert store.integrate("three", listing(), now()) == 2
    same_as_batch()
    assert store.integrate("four", listing(), now()) == 0
    same_as_batch()
    status = {r["path"].rpartition("/")[2]: (r["status"], r["last_training_run_id"]) for r in store.manifest().collect()}
    assert status == {"a.parquet": ("integrated", "three"), "b.parquet": ("integrated", "three")}


def test_batches_of_predictions(spark, tmp_path, monkeypatch):
    columns = "key string, created_at timestamp, seq long, probabilities array<double>, predicted_class int, predicted_probability double, p_alert_24h double, alert_24h boolean"
    row = lambda key, seq: (key, dt.datetime(2026, 6, 17, 6, seq), seq, [0.5, 0.5], 1, 0.5, 0.5, True)
    fixed = {"min_class_alert": F.lit(3), "alert_threshold_24h": F.lit(0.35), "n_classes": F.lit(2)}
    made = lambda *rows: spark.createDataFrame(list(rows), columns).withColumns(fixed)
    root, schema = str(tmp_path), "key string, created_at timestamp, seq long, payload string"
    publish = lambda df, batch: predictions.publish_batch(df, root, batch, ["key"], "seq", now())
    state = lambda: (
        sorted((r["key"], r["seq"]) for r in predictions.read_latest(spark, root, schema).collect()),
        sorted((r["key"], r["seq"]) for r in predictions.read_history(spark, root, schema).collect()),
    )
    assert state() == ([], [])
    assert publish(made(row("a", 1), row("b", 1)), "one")
    assert state() == ([("a", 1), ("b", 1)], [("a", 1), ("b", 1)])
    assert not publish(made(row("a", 1), row("b", 1)), "one")
    mark = Snapshots.mark

    def stop(*_):
        raise InterruptedError

    monkeypatch.setattr(Snapshots, "mark", stop)
    with pytest.raises(InterruptedError):
        publish(made(row("a", 2)), "two")
    assert state() == ([("a", 1), ("b", 1)], [("a", 1), ("b", 1)])
    monkeypatch.setattr(Snapshots, "mark", mark)
    assert publish(made(row("a", 2)), "two")
    assert state() == ([("a", 2), ("b", 1)], [("a", 1), ("a", 2), ("b", 1)])
