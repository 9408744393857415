"""Schemas and fixed values of the data model.

Values in this file are part of the data contract (column names, suffixes, class rules); changing one
changes results.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: period table -------------------------------------------------------------------
PERIOD_REQUIRED = [
    "period_id",
    "period_type",
    "period_start_utc",
    "period_end_utc",
    "network",
    "stations",
    "channels",
]
PERIOD_OPTIONAL = ["split", "eruption_start_utc", "eruption_end_utc"]
PERIOD_TYPE_SYNONYMS = {
    "eruption": "eruption",
    "eruptive": "eruption",
    "event": "eruption",
    "quiet": "quiet",
    "calm": "quiet",
    "calme": "quiet",
    "background": "quiet",
    "non_eruptive": "quiet",
    "inference": "inference",
    "predict": "inference",
    "prediction": "inference",
    "unknown": "inference",
}
SPLITS = ["train", "val", "test"]

# --- fixed values: minute table -------------------------------------------------------------------
MINUTE_FILE_SUFFIX = "_filtered_1_16Hz_aggregated_1min_with_fi.csv"
MINUTE_COLUMNS = [
    "eruption_id",
    "network",
    "station",
    "channel",
    "time_min",
    "amplitude_mean",
    "amplitude_std",
    "amplitude_max",
    "amplitude_min",
    "amplitude_count",
    "energy_low_1_5_5",
    "energy_high_6_16",
    "frequency_index",
    "sampling_rate_source_hz",
    "filter_full_low_hz",
    "filter_full_high_hz",
    "filter_fi_low_min_hz",
    "filter_fi_low_max_hz",
    "filter_fi_high_min_hz",
    "filter_fi_high_max_hz",
]
FILTER_COLUMNS = {
    "filter_full_low_hz": 1.0,
    "filter_full_high_hz": 16.0,
    "filter_fi_low_min_hz": 1.0,
    "filter_fi_low_max_hz": 5.5,
    "filter_fi_high_min_hz": 6.0,
    "filter_fi_high_max_hz": 16.0,
}
BAND_FULL = (1.0, 16.0)
BAND_LOW = (1.0, 5.5)
BAND_HIGH = (6.0, 16.0)
NYQUIST_MINIMUM_HZ = 16.0
FREQUENCY_INDEX_EPS = 1e-12

# --- fixed values: features -----------------------------------------------------------------------
ROLLING_BASE = [
    "amplitude_mean",
    "amplitude_std",
    "amplitude_max",
    "amplitude_min",
    "amplitude_range",
    "amplitude_abs_mean",
    "amplitude_count",
]
ROLLING_STATS = ["mean", "std", "min", "max", "median"]
MINUTE_NUMERIC = [c for c in MINUTE_COLUMNS[5:]]
SENSOR_FEATURES = (
    MINUTE_NUMERIC
    + ["amplitude_range", "amplitude_abs_mean"]
    + [f"{base}_roll_{stat}" for base in ROLLING_BASE for stat in ROLLING_STATS]
    + [
        "shannon_entropy",
        "kurtosis",
        "amplitude_mean_slope",
        "shannon_entropy_env",
        "kurtosis_env",
        "amplitude_mean_env",
    ]
)
CORE_FEATURES = [
    "frequency_index",
    "energy_low_1_5_5",
    "energy_high_6_16",
    "shannon_entropy",
    "shannon_entropy_env",
    "kurtosis",
    "kurtosis_env",
    "amplitude_mean_slope",
]
# network column prefix -> sensor feature it summarises
NETWORK_FULL = {
    "network_entropy": "shannon_entropy",
    "network_kurtosis": "kurtosis",
    "network_amplitude": "amplitude_mean_roll_mean",
}

# --- fixed values: labels, alerts, decision -------------------------------------------------------
N_CLASSES = 6
HORIZON_CLASSES = [(6.0, 5), (12.0, 4), (24.0, 3), (36.0, 2), (48.0, 1)]
ALERT_MIN_CLASS = 3
ALERT_THRESHOLD = 0.35
CLASS_MULTIPLIERS = {
    "balanced": [1.0, 1.0, 1.0, 1.0, 1.0, 1.0],
    "alert_priority": [1.0, 1.2, 1.4, 1.8, 2.2, 2.8],
    "early_warning_priority": [1.5, 2.0, 1.8, 1.5, 1.3, 1.2],
}
BUSINESS_SCORE_WEIGHTS = {
    "macro_f1": 0.15,
    "balanced_accuracy": 0.15,
    "class_0_f1": 0.15,
    "class_1_f1": 0.20,
    "class_2_f1": 0.20,
    "alert_24h_f1": 0.15,
}

# --- schemas --------------------------------------------------------------------------------------
SAMPLES = T.StructType(
    [
        T.StructField("period_id", T.StringType()),
        T.StructField("network", T.StringType()),
        T.StructField("station", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("amplitude", T.DoubleType()),
        T.StructField("sampling_rate", T.DoubleType()),
    ]
)


def _minute_type(name: str) -> T.DataType:
    if name in ("eruption_id", "network", "station", "channel"):
        return T.StringType()
    if name == "time_min":
        return T.TimestampType()
    if name == "amplitude_count":
        return T.LongType()
    return T.DoubleType()


MINUTES = T.StructType([T.StructField(c, _minute_type(c)) for c in MINUTE_COLUMNS])
MINUTES_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in MINUTE_COLUMNS])

SEQUENCES = T.StructType(
    [
        T.StructField("seq_id", T.LongType()),
        T.StructField("period_ord", T.IntegerType()),
        T.StructField("period_id", T.StringType()),
        T.StructField("t_end", T.TimestampType()),
        T.StructField("split", T.StringType()),
        T.StructField("y", T.IntegerType()),
        T.StructField("x", T.ArrayType(T.ArrayType(T.FloatType()))),
    ]
)

PARAMS = T.StructType(
    [
        T.StructField("idx", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("median", T.FloatType()),
        T.StructField("mean", T.FloatType()),
        T.StructField("scale", T.FloatType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("absolute_path", T.StringType()),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("mtime_ns", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("first_seen_at_utc", T.TimestampType()),
        T.StructField("last_seen_at_utc", T.TimestampType()),
        T.StructField("integrated_at_utc", T.TimestampType()),
        T.StructField("last_training_run_id", T.StringType()),
    ]
)

PREDICTION = T.StructType(
    [
        T.StructField("created_at_utc", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("n_classes", T.IntegerType()),
        T.StructField("min_class_alert", T.IntegerType()),
        T.StructField("predicted_class", T.IntegerType()),
        T.StructField("predicted_probability", T.DoubleType()),
        T.StructField("p_alert_24h", T.DoubleType()),
        T.StructField("alert_24h", T.BooleanType()),
        T.StructField("probabilities", T.ArrayType(T.DoubleType())),
        T.StructField("probabilities_by_class", T.MapType(T.StringType(), T.DoubleType())),
    ]
)
