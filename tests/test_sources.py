"""Readers, input resolution, manifest and publication."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tremorloom.operators import periods
from tremorloom.operators.features import prepare_minutes
from tremorloom.operators.periods import ContractViolation
from tremorloom.schemas import MANIFEST, MINUTE_FILE_SUFFIX, MINUTES
from tremorloom.sources import inputs, manifest, predictions, tables

HEADER = "period_id{0}period_type{0}period_start_utc{0}period_end_utc{0}network{0}stations{0}channels"


@pytest.mark.parametrize("sep,bom", [(";", "﻿"), (",", "")])
def test_period_file_delimiter_bom_and_order(spark, tmp_path, sep, bom):
    lists = '"A,B"' if sep == "," else "A,B"
    lines = [HEADER.format(sep)] + [
        sep.join([f" p{i} ", "Calme", "2020-01-01T00:00:00Z", "2020-01-02T00:00:00Z", "PF", lists, ""]) for i in (3, 1, 2)
    ]
    path = tmp_path / "periods.csv"
    path.write_text(bom + "\n".join(lines) + "\n", encoding="utf-8")
    df = tables.read_periods_csv(spark, str(path))
    rows = df.orderBy("period_ord").collect()
    assert [r["period_id"] for r in rows] == ["p3", "p1", "p2"] and rows[0]["channels"] == ""
    tidy = periods.tidy_periods(df)
    assert {"split", "eruption_start_utc"} <= set(tidy.columns)
    assert periods.validate_periods(tidy).count() == 0
    typed = periods.typed_periods(tidy).first()
    assert typed["period_type"] == "quiet" and typed["stations"] == ["A", "B"] and typed["channels"] is None


def test_period_violations(spark):
    base = dict(period_start_utc="2020-01-01T00:00:00Z", period_end_utc="2020-01-02T00:00:00Z", network="N", stations="", channels="", eruption_start_utc="", eruption_end_utc="", split="")
    rows = [
        dict(base, period_id="ok", period_type=" EVENT "),
        dict(base, period_id="kind", period_type="volcanic"),
        dict(base, period_id="order", period_type="quiet", period_end_utc="2020-01-01T00:00:00Z"),
        dict(base, period_id="event", period_type="eruption", eruption_start_utc="2020-01-03T00:00:00Z", eruption_end_utc="2020-01-02T00:00:00Z"),
        dict(base, period_id="text", period_type="quiet", period_start_utc="soon"),
        dict(base, period_id="", period_type="quiet"),
        dict(base, period_id="twice", period_type="quiet"),
        dict(base, period_id="twice", period_type="quiet"),
    ]
    df = spark.createDataFrame(rows)
    found = {(r["period_id"], r["rule"]) for r in periods.validate_periods(df).collect()}
    assert found == {
        ("kind", "unknown_period_type"),
        ("order", "end_not_after_start"),
        ("event", "event_end_before_start"),
        ("text", "bad_period_start"),
        ("", "empty_period_id"),
        ("twice", "duplicate_period_id"),
    }
    with pytest.raises(ContractViolation, match="network"):
        periods.tidy_periods(df.drop("network"))


def test_training_refuses_inference_periods_and_retraining_drops_them(spark):
    df = spark.createDataFrame(
        [("a", "quiet", "", "train"), ("b", "predict", "", "train")], "period_id string, period_type string, eruption_start_utc string, split string"
    )
    with pytest.raises(ContractViolation, match="inference_in_training"):
        periods.select_periods(df, "training")
    assert [r["period_id"] for r in periods.select_periods(df, "training", drop_inference=True).collect()] == ["a"]
    with pytest.raises(ContractViolation, match="invalid_split"):
        periods.select_periods(df.withColumn("split", F.lit("later")), "inference", manual_split=True)


def test_minute_files_are_matched_by_header_and_named_by_file(spark, tmp_path):
    one = tmp_path / f"first{MINUTE_FILE_SUFFIX}"
    one.write_text("channel,time_min,station,amplitude_mean,amplitude_std,amplitude_max,amplitude_min,amplitude_count\nHHZ,2020-01-01 00:00:00+00:00,CSS,1.5,x,2,1,100\n")
    two = tmp_path / f"second{MINUTE_FILE_SUFFIX}"
    two.write_text("channel,time_min,station,amplitude_mean,amplitude_std,amplitude_max,amplitude_min,amplitude_count\nHHZ,2020-01-01 00:01:00+00:00,BOR,2.5,0.1,3,2,90\n")
    df = prepare_minutes(tables.read_minutes(spark, [str(one), str(two)]))
    rows = {r["eruption_id"]: r for r in df.collect()}
    assert rows["first"]["sensor"] == "CSS__HHZ" and rows["first"]["amplitude_std"] is None
    assert rows["second"]["amplitude_mean"] == 2.5
    assert rows["second"]["time_min"] == dt.datetime(2020, 1, 1, 0, 1)


def test_inputs_found_and_missing_on_disk(spark, tmp_path):
    for name in (f"a{MINUTE_FILE_SUFFIX}", "special.csv"):
        (tmp_path / name).write_text("x")
    files = inputs.list_files(spark, str(tmp_path))
    df = spark.createDataFrame(
        [("a", ""), ("b", f"{tmp_path}/special.csv"), ("c", None)], "period_id string, csv_path string"
    )
    found = {r["period_id"]: r["found"] for r in inputs.resolve_inputs(df, files, str(tmp_path)).collect()}
    assert found == {"a": True, "b": True, "c": False}
    assert [r["period_id"] for r in inputs.missing_inputs(df, files, str(tmp_path)).collect()] == ["c"]


def stamp(text):
    return F.lit(text).cast("timestamp")


def listing(spark, rows):
    return spark.createDataFrame(rows, "path string, absolute_path string, size_bytes long, mtime_ns long")


def test_manifest_life_cycle(spark):
    empty = spark.createDataFrame([], MANIFEST)
    files = listing(spark, [("r/a", "/d/r/a", 1, 10), ("r/b", "/d/r/b", 2, 20)])
    first = manifest.update_manifest(empty, files, stamp("2026-01-01"))
    assert manifest.detection_summary(first, 2).first().asDict() == {
        "new_files_count": 2, "pending_files_count": 2, "should_retrain": True,
    }
    table = first.drop("is_new", "pending")
    # found by its absolute path although the relative path moved
    done = spark.createDataFrame([("other/a", "/d/r/a")], "path string, absolute_path string")
    marked = manifest.mark_integrated(done, table, "run1", stamp("2026-01-02"))
    state = {r["path"]: (r["status"], r["last_training_run_id"]) for r in marked.collect()}
    assert state == {"r/a": ("integrated", "run1"), "r/b": ("detected", None)}
    again = manifest.mark_integrated(done, marked, "run1", stamp("2026-01-03"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, marked.select(again.columns).collect()))
    with pytest.raises(ContractViolation, match="other_run"):
        manifest.mark_integrated(done, marked, "run2", stamp("2026-01-03"))
    with pytest.raises(ContractViolation, match="not_in_manifest"):
        manifest.mark_integrated(spark.createDataFrame([("x", "/x")], "path string, absolute_path string"), marked, "run1", stamp("2026-01-03"))
    with pytest.raises(ContractViolation, match="empty"):
        manifest.mark_integrated(done, marked, " ", stamp("2026-01-03"))
    grown = listing(spark, [("r/a", "/d/r/a", 5, 10)])
    after = {r["path"]: r for r in manifest.update_manifest(marked, grown, stamp("2026-01-04")).collect()}
    assert after["r/a"]["status"] == "detected" and after["r/a"]["pending"] and after["r/a"]["last_training_run_id"] is None
    assert after["r/b"]["status"] == "detected" and not after["r/b"]["pending"]
    same = {r["path"]: r for r in manifest.update_manifest(marked, files, stamp("2026-01-04")).collect()}
    assert same["r/a"]["status"] == "integrated" and not same["r/a"]["pending"]


def test_latest_and_history_carry_the_same_payload(spark, tmp_path):
    base = spark.createDataFrame(
        [("v", dt.datetime(2026, 6, 17, 6, 30), 1, [0.05, 0.10, 0.15, 0.20, 0.25, 0.25], 4, 0.25, 0.70, True)],
        "volcano string, created_at timestamp, seq long, probabilities array<double>, predicted_class int, predicted_probability double, p_alert_24h double, alert_24h boolean",
    ).withColumns({"min_class_alert": F.lit(3), "alert_threshold_24h": F.lit(0.35), "n_classes": F.lit(6)})
    history, latest = str(tmp_path / "history"), str(tmp_path / "latest")
    predictions.publish_predictions(base, history, latest, ["volcano"], "seq", stamp("2026-06-17 06:31:00"))
    later = base.withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 1 HOUR")).withColumn("seq", F.lit(2).cast("long"))
    predictions.publish_predictions(later, history, latest, ["volcano"], "seq", stamp("2026-06-17 07:31:00"))
    assert sorted(d for d in os.listdir(history) if d.startswith("at=")) == ["at=20260617T063000Z", "at=20260617T073000Z"]
    newest = spark.read.parquet(latest).collect()
    kept = spark.read.parquet(history).where("seq = 2").first()
    assert len(newest) == 1 and newest[0]["seq"] == 2 and newest[0]["payload"] == kept["payload"]
    key = spark.range(1).select(predictions.history_key(stamp("2026-06-17 06:30:00"))).first()[0]
    assert key == "predictions/history/20260617T063000Z/prediction.json"


def test_minutes_round_trip_by_period(spark, tmp_path):
    row = tuple(["p", "N", "S", "C", dt.datetime(2020, 1, 1)] + [1.0] * 4 + [3] + [1.0] * 10)
    df = spark.createDataFrame([row], MINUTES)
    tables.write_minutes(df, str(tmp_path / "m"))
    assert tables.read_minutes(spark, str(tmp_path / "m"), "parquet").first() == df.first()
