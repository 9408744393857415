"""The given tables seen as sensor data.

``events`` are samples: the event type is the station, the user id modulo 3 the channel. Cells are hours.
Each view exists twice, as a DataFrame and as a SQL text for the common table expressions of the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.support import table
from tremorloom.operators import features, minutes, periods

HOUR = 3600

# (period_id, type, start, end, event start, split, stations)
PERIODS = [
    ("P1", "Eruption", "2024-01-01T00:00:00Z", "2024-01-08T00:00:00Z", "2024-01-07T00:00:00Z", "train", ""),
    ("P2", "calme", "2024-01-08T00:00:00Z", "2024-01-15T00:00:00Z", "", "train", ""),
    ("P3", " event ", "2024-01-15T00:00:00Z", "2024-01-22T00:00:00Z", "2024-01-21T00:00:00Z", "val", "view,click,error,absent"),
    ("P4", "predict", "2024-01-22T00:00:00Z", "2024-02-01T00:00:00Z", "", "test", ""),
]

PERIODS_SQL = (
    "periods(period_id, period_type, period_start, period_end, event_start, split, stations) AS (VALUES "
    "('P1','eruption',TIMESTAMP '2024-01-01',TIMESTAMP '2024-01-08',TIMESTAMP '2024-01-07','train',''),"
    "('P2','quiet',TIMESTAMP '2024-01-08',TIMESTAMP '2024-01-15',NULL,'train',''),"
    "('P3','eruption',TIMESTAMP '2024-01-15',TIMESTAMP '2024-01-22',TIMESTAMP '2024-01-21','val','view,click,error,absent'),"
    "('P4','inference',TIMESTAMP '2024-01-22',TIMESTAMP '2024-02-01',NULL,'test',''))"
)

SAMPLES_SQL = (
    "samples AS (SELECT 'EV' AS network, event_type AS station, 'C' || (user_id % 3) AS channel, ts, "
    "value AS amplitude, value AS low, CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS high, "
    "CASE event_type WHEN 'signup' THEN 30.0 ELSE 100.0 END AS sampling_rate, user_id, event_id FROM events)"
)

ASSIGNED_SQL = (
    f"{PERIODS_SQL}, {SAMPLES_SQL}, assigned AS (SELECT p.period_id, s.* FROM samples s JOIN periods p "
    "ON s.ts >= p.period_start AND s.ts < p.period_end "
    "AND (p.stations = '' OR list_contains(string_split(p.stations, ','), s.station)))"
)

HOURS_SQL = (
    f"{ASSIGNED_SQL}, hours AS (SELECT period_id AS eruption_id, network, station, channel, "
    "station || '__' || channel AS sensor, date_trunc('hour', ts) AS time_min, "
    "avg(amplitude) AS amplitude_mean, stddev_samp(amplitude) AS amplitude_std, max(amplitude) AS amplitude_max, "
    "min(amplitude) AS amplitude_min, count(amplitude) AS amplitude_count, avg(low*low) AS energy_low_1_5_5, "
    "avg(high*high) AS energy_high_6_16, "
    "log10((avg(high*high) + 1e-12) / (avg(low*low) + 1e-12)) AS frequency_index, "
    "max(amplitude) - min(amplitude) AS amplitude_range, abs(avg(amplitude)) AS amplitude_abs_mean, "
    "max(sampling_rate) AS sampling_rate_source_hz "
    "FROM assigned GROUP BY 1, 2, 3, 4, 5, 6)"
)

FRAME = (
    "(PARTITION BY eruption_id, sensor ORDER BY time_min ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"
)
BASE = [
    "amplitude_mean",
    "amplitude_std",
    "amplitude_max",
    "amplitude_min",
    "amplitude_range",
    "amplitude_abs_mean",
    "amplitude_count",
]


def _entropy_sql() -> str:
    """Equal-width histogram entropy of the list ``vals`` between its extremes, 20 bins."""
    edge = lambda i: f"(CASE WHEN {i} = 20 THEN hi ELSE lo + ({i}) * ((hi - lo) / 20) END)"
    first = "least(CAST(floor((v - lo) / (hi - lo) * 20) AS INT), 19)"
    return (
        "binned AS (SELECT eruption_id, sensor, time_min, b, count(*) AS c FROM ("
        f"SELECT eruption_id, sensor, time_min, CASE WHEN v < {edge('f')} THEN f - 1 "
        f"WHEN v >= {edge('f + 1')} AND f <> 19 THEN f + 1 ELSE f END AS b FROM ("
        f"SELECT *, CASE WHEN hi = lo THEN 0 ELSE {first} END AS f FROM ("
        "SELECT eruption_id, sensor, time_min, lo, hi, unnest(vals) AS v FROM framed WHERE n >= 5))) GROUP BY 1, 2, 3, 4), "
        "entropies AS (SELECT eruption_id, sensor, time_min, -sum(p * log2(p)) AS shannon_entropy FROM ("
        "SELECT *, c / sum(c) OVER (PARTITION BY eruption_id, sensor, time_min) AS p FROM binned) GROUP BY 1, 2, 3)"
    )


# one row per sensor hour with the first-level rolling features
ROLLED_SQL = (
    f"{HOURS_SQL}, numbered AS (SELECT *, row_number() OVER (PARTITION BY eruption_id, sensor ORDER BY time_min) AS rn FROM hours), "
    "framed AS (SELECT *, "
    + ", ".join(
        f"CASE WHEN count({c}) OVER w >= 5 THEN {fn}({c}) OVER w END AS {c}_roll_{stat}"
        for c in BASE
        for stat, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"), ("median", "median"))
    )
    + ", count(amplitude_mean) OVER w AS n, min(amplitude_mean) OVER w AS lo, max(amplitude_mean) OVER w AS hi, "
    "list(amplitude_mean) OVER w AS vals, "
    "CASE WHEN count(amplitude_mean) OVER w >= 5 THEN CASE WHEN min(amplitude_mean) OVER w = max(amplitude_mean) OVER w "
    "THEN 0 ELSE kurtosis(amplitude_mean) OVER w END END AS kurtosis, "
    "CASE WHEN count(amplitude_mean) OVER w >= 5 THEN regr_slope(amplitude_mean, rn) OVER w END AS amplitude_mean_slope "
    f"FROM numbered WINDOW w AS {FRAME}), {_entropy_sql()}, "
    "rolled AS (SELECT f.*, e.shannon_entropy FROM framed f LEFT JOIN entropies e USING (eruption_id, sensor, time_min)), "
    "features AS (SELECT *, "
    "CASE WHEN count(shannon_entropy) OVER w >= 3 THEN median(shannon_entropy) OVER w END AS shannon_entropy_env, "
    "CASE WHEN count(kurtosis) OVER w >= 3 THEN median(kurtosis) OVER w END AS kurtosis_env, "
    "CASE WHEN count(amplitude_mean_roll_mean) OVER w >= 3 THEN median(amplitude_mean_roll_mean) OVER w END AS amplitude_mean_env "
    f"FROM rolled WINDOW w AS {FRAME})"
)


def period_rows(spark: SparkSession) -> DataFrame:
    rows = [
        (pid, kind, start, end, event, "", split, "EV", stations, "")
        for pid, kind, start, end, event, split, stations in PERIODS
    ]
    return spark.createDataFrame(
        rows,
        "period_id string, period_type string, period_start_utc string, period_end_utc string, "
        "eruption_start_utc string, eruption_end_utc string, split string, network string, stations string, channels string",
    )


def period_table(spark: SparkSession) -> DataFrame:
    return periods.typed_periods(periods.tidy_periods(period_rows(spark)))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.lit("EV").alias("network"),
        F.col("event_type").alias("station"),
        F.concat(F.lit("C"), (F.col("user_id") % 3).cast("string")).alias("channel"),
        "ts",
        F.col("value").alias("amplitude"),
        F.col("value").alias("low"),
        F.get_json_object("props", "$.k").cast("double").alias("high"),
        F.when(F.col("event_type") == "signup", 30.0).otherwise(100.0).alias("sampling_rate"),
        "event_id",
    )


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.assign_periods(samples(spark, sf_dir), period_table(spark))


def hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.prepare_minutes(minutes.minute_aggregate(assigned(spark, sf_dir), HOUR))


def frames(spark: SparkSession, sf_dir: str, before: int = 9) -> DataFrame:
    return features.sensor_frames(features.direct_features(hours(spark, sf_dir)), before=before, chunk_rows=64)


def sensor_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.sensor_features(hours(spark, sf_dir), 10, 20, chunk_rows=64)
