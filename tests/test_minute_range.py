"""Means of many equal samples stay in their range; the audit refuses its broken batch on any table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks import QUERIES
from tremorloom.operators import minutes

NOON = dt.datetime(2024, 1, 2, 12)


def samples_of(spark, values):
    rows = [("P", "N", "S", "C", NOON, v, v, v, 100.0, i % 2) for i, v in enumerate(values)]
    return spark.createDataFrame(
        rows, "period_id string, network string, station string, channel string, ts timestamp, amplitude double, low double, high double, sampling_rate double, part int"
    )


def test_the_mean_of_equal_samples_is_in_their_range(spark):
    for value in (0.1, -0.1, 17.93):
        samples = samples_of(spark, [value] * 30)
        for made in (minutes.minute_aggregate(samples), minutes.merged_minutes(minutes.minute_states(samples, 60, ["part"]))):
            assert made.first()["amplitude_mean"] == value
    mixed = samples_of(spark, [1.0, float("inf"), float("-inf")])
    assert minutes.minute_aggregate(mixed).where(F.isnan("amplitude_mean")).count() == 1
    assert minutes.minute_aggregate(samples_of(spark, [None, None])).first()["amplitude_mean"] is None


def test_published_minutes_with_many_samples_in_each_cell(spark, tmp_path):
    rows = [(i, NOON, 3, "view", 0.1, '{"k": 1}') for i in range(30)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    (row,) = QUERIES["published_minutes"](spark, str(tmp_path)).collect()
    assert row["amplitude_count"] == 30
