"""Keys, ids and matrices as users have them: NULL keys, text ids, ragged sequences, differing headers."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tremorloom.operators import decision, evaluation, gates, periods, scoring, signal
from tremorloom.plans import jobs
from tremorloom.sources import inputs, manifest, tables

TRACE = "period_id string, network string, station string, channel string, ts timestamp, amplitude double, sampling_rate double"


def samples(spark, network):
    rows = [("p", network, "S", "Z", f"2020-01-01 00:00:0{i}", float(i * i), 1.0) for i in (0, 1, 2, 5)]
    return spark.createDataFrame(rows, TRACE.replace("ts timestamp", "ts string")).withColumn("ts", F.to_timestamp("ts"))


@pytest.mark.parametrize("network", ["N", None])
def test_null_keys_keep_their_rows(spark, network):
    df = samples(spark, network)
    assert signal.interpolate_gaps(df).count() == 6
    assert signal.demean(df).count() == 4
    assert signal.detrend_linear(df).count() == 4


def test_the_later_segment_may_be_named_by_its_start(spark):
    df = samples(spark, "N").withColumn("start", F.col("ts"))
    assert signal.interpolate_gaps(df, segment="start").count() == 6


def test_best_runs_take_text_ids(spark):
    runs = spark.createDataFrame([("a", 1.0, "run-b"), ("a", 1.0, "run-a"), ("a", None, "run-0")], "sel string, s double, id string")
    assert [r["id"] for r in decision.best_runs(runs, "sel", ["s"], "id").collect()] == ["run-a"]


def test_ragged_sequences_raise_and_even_ones_score(spark):
    mean = lambda x: np.repeat(x.mean(axis=(1, 2))[:, None], 2, axis=1)
    schema = "id int, x array<array<double>>"
    even = spark.createDataFrame([(1, [[1.0], [1.0]]), (2, [[9.0], [9.0]])], schema).coalesce(1)
    assert sorted(r["scores"][0] for r in scoring.score(even, mean, 2).collect()) == [1.0, 9.0]
    for bad in ([[9.0]] * 5, None):
        ragged = spark.createDataFrame([(1, [[1.0]] * 3), (2, bad)], schema).coalesce(1)
        with pytest.raises(Exception, match="differ in length"):
            scoring.score(ragged, mean, 2).collect()


def test_other_headers_fail_instead_of_swapping(spark, tmp_path):
    (tmp_path / "a_minutes.csv").write_text("eruption_id,amplitude_mean,amplitude_std\np,1,9\n")
    (tmp_path / "b_minutes.csv").write_text("eruption_id,amplitude_std,amplitude_mean\np,9,1\n")
    with pytest.raises(Exception, match="header"):
        tables.read_minutes(spark, str(tmp_path)).collect()


def test_pairs_outside_the_grid_count_as_misses(spark):
    pairs = spark.createDataFrame([(0, 0), (1, 1), (1, 9), (None, 0), (-2, -2)], "y int, yhat int")
    m = evaluation.confusion_matrix(pairs)
    cells = {(r["y"], r["yhat"]): r["n"] for r in m.collect()}
    assert sum(cells.values()) == 5 and len(cells) == 36 + 3
    assert (cells[1, 6], cells[-1, 0], cells[-1, -1]) == (1, 1, 1)
    assert evaluation.classification_metrics(m).first()["accuracy"] == pytest.approx(2 / 5)
    classes = {r["cls"]: r for r in evaluation.per_class_metrics(m).collect()}
    assert sorted(classes) == list(range(6)) and classes[1]["recall"] == 0.5 and classes[0]["precision"] == 0.5
    alerts = {r["level"]: r for r in evaluation.alert_metrics(m).collect()}
    assert (alerts["alert"]["tp"], alerts["alert_24h"]["fp"]) == (2, 1)


def test_null_groups_of_the_grid_stay(spark):
    m = evaluation.confusion_matrix(spark.createDataFrame([(None, 1, 1)], "g string, y int, yhat int"), by=["g"])
    assert m.agg(F.sum("n")).first()[0] == 1 and m.count() == 36


def test_listed_files_go_to_the_manifest(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x")
    known = spark.createDataFrame(
        [],
        "path string, absolute_path string, size_bytes long, mtime_ns long, status string, first_seen_at_utc timestamp, "
        "last_seen_at_utc timestamp, integrated_at_utc timestamp, last_training_run_id string",
    )
    listing = inputs.list_files(spark, str(tmp_path))
    row = manifest.update_manifest(known, listing, F.current_timestamp()).collect()
    assert [(r["path"], r["size_bytes"], r["is_new"], r["pending"]) for r in row] == [(f"{tmp_path}/a.csv", 1, True, True)]


def test_hours_are_targets_of_a_regression_report(spark):
    rows = [(s, [[1.0]], y) for s, y in (("train", 1.5), ("train", -1.0), ("val", 50.0), ("test", 2.25))]
    df = spark.createDataFrame(rows, "split string, x array<array<double>>, y double")
    found = {(r["severity"], r["split"], r["rule"]): r["n_bad"] for r in gates.dataset_report(df, 1, 1, 1, task="regression").collect()}
    assert found == {("error", "train", "target_not_negative"): 1, ("warning", "val", "beyond_horizon"): 1}


def period_rows(spark, *ids):
    names = "period_id period_type period_start_utc period_end_utc eruption_start_utc eruption_end_utc split network stations channels"
    start = {"p": "2020-01-01T00:00:00Z", "empty": "2021-01-01T00:00:00Z"}
    rows = [(i, "calm", start[i], start[i].replace("00Z", "30Z"), "", "", "", "N", "S,T", "Z") for i in ids]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names.split()))


def test_extraction_report_names_periods_without_samples(spark):
    raw = samples(spark, "N").drop("period_id").withColumn("sampling_rate", F.lit(0.0))
    report = {tuple(r) for r in jobs.extraction_report(raw, period_rows(spark, "p", "empty")).collect()}
    assert report == {
        ("error", "p", "bad_rate", "N.S.Z"), ("error", "empty", "no_samples", ""), ("warning", "p", "missing_station", "T"),
        ("warning", "empty", "missing_station", "S"), ("warning", "empty", "missing_station", "T"),
    }


def test_period_bounds_reach_the_scan_of_samples(spark, tmp_path):
    samples(spark, "N").drop("period_id").write.parquet(f"{tmp_path}/s")
    read = spark.read.parquet(f"{tmp_path}/s")
    joined = periods.assign_periods(read, periods.typed_periods(period_rows(spark, "p")))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2020-01-01" in plan and "LessThan(ts,2020-01-01" in plan
    assert joined.count() == 4


def test_a_batch_of_another_shape_is_not_scored(spark):
    batch = spark.createDataFrame([(1, [[1.0]])], "seq_id int, x array<array<double>>")
    with pytest.raises(periods.ContractViolation, match="seq_len"):
        jobs.predict_alerts(batch, lambda x: x, seq_len=2, n_features=1)
