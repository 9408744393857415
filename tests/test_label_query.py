"""The label query keeps rows beyond the horizon, without a class."""

from __future__ import annotations

from checks import QUERIES
from tremorloom.functions.labels import horizon_label


def test_label_query_gives_no_class_beyond_the_horizon(spark, tmp_path):
    rows = [(1, 0.0), (2, 61.5), (3, 61.6), (4, 492.0), (5, 492.1), (6, -3.0), (7, None), (8, float("nan"))]
    spark.createDataFrame(rows, "event_id long, value double").write.parquet(str(tmp_path / "events.parquet"))
    got = {r["event_id"]: r["y"] for r in QUERIES["horizon_label"](spark, str(tmp_path)).collect()}
    assert got == {1: 5, 2: 5, 3: 4, 4: 1, 5: None, 6: 5, 7: None, 8: None}
    inside = spark.createDataFrame([(h / 4,) for h in range(193)], "h double")
    assert inside.where(horizon_label("h") != horizon_label("h", strict=False)).isEmpty()
