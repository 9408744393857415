"""Causal rolling features per sensor and network statistics per minute.

Frames count rows, not minutes: a gap in the minutes does not shorten a frame. A result is NULL until the
frame holds enough non-missing values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorloom.functions.numeric import finite
from tremorloom.operators.ranking import ROW, chunk_window, global_rank, own_rows, with_halo
from tremorloom.schemas import (
    CORE_FEATURES,
    MINUTE_NUMERIC,
    NETWORK_FULL,
    ROLLING_BASE,
    SENSOR_FEATURES,
)

SENSOR_KEYS = ["eruption_id", "sensor"]
_COERCED = ["amplitude_mean", "amplitude_std", "amplitude_max", "amplitude_min", "amplitude_count"]


def bad_time_count(minutes: DataFrame) -> DataFrame:
    """One row: how many ``time_min`` texts are not timestamps."""
    parsed = F.try_to_timestamp(F.col("time_min").cast("string"))
    return minutes.agg(F.count_if(parsed.isNull()).alias("n_bad_time"))


def prepare_minutes(minutes: DataFrame, strict_time: bool = True) -> DataFrame:
    """Typed minute rows with a ``sensor`` column.

    Numbers that do not parse, NaN and infinities become NULL. A ``time_min`` that does not parse fails the
    job, or drops the row when ``strict_time`` is off.
    """
    kinds = dict(minutes.dtypes)
    raw = F.col("time_min")
    time = F.try_to_timestamp(raw) if kinds["time_min"] == "string" else raw.cast("timestamp")
    if strict_time:
        message = F.concat(F.lit("bad time_min: "), F.coalesce(raw.cast("string"), F.lit("NULL")))
        time = F.coalesce(time, F.raise_error(message).cast("timestamp"))
    numeric = [c for c in MINUTE_NUMERIC if c in kinds]
    typed = minutes.withColumns(
        {
            "time_min": time,
            **{c: finite(F.col(c).try_cast("double")) for c in numeric},
            "station": F.col("station").cast("string"),
            "channel": F.col("channel").cast("string"),
        }
    ).withColumn("sensor", F.concat_ws("__", "station", "channel"))
    return typed if strict_time else typed.where(F.col("time_min").isNotNull())


def direct_features(minutes: DataFrame) -> DataFrame:
    return minutes.withColumns(
        {
            "amplitude_range": F.col("amplitude_max") - F.col("amplitude_min"),
            "amplitude_abs_mean": F.abs("amplitude_mean"),
        }
    )


def sensor_frames(
    df: DataFrame,
    keys: Sequence[str] = SENSOR_KEYS,
    before: int = 0,
    chunk_rows: int = 8192,
    bucket: str = "day",
) -> DataFrame:
    """Ranked, chunked rows of each sensor, ready for row frames of up to ``before`` earlier rows.

    ``bucket`` is a ``date_trunc`` unit; choose it so that it holds some thousand rows of one sensor.
    """
    ties = [c for c in ("amplitude_mean", "amplitude_max", "amplitude_count") if c in df.columns]
    ranked = global_rank(df, keys, ["time_min", *ties], F.date_trunc(bucket, F.col("time_min")))
    return with_halo(ranked, chunk_rows, before=before)


def _minimum(window_rows: int, floor: int = 3) -> int:
    return max(floor, window_rows // 2)


def with_entropy(df: DataFrame, window_rows: int, bins: int) -> DataFrame:
    """Shannon entropy (bits) of an equal-width histogram of each frame; 0 for a constant frame.

    Expects the frame's values and extremes in ``_vals, _lo, _hi``, which are dropped. A value that rounding
    puts next to its bin is moved by comparing it with the bin edges, the last bin being closed on both sides.

    Lambdas are interpreted, so little is done per value: the bin, its correction, and one addition to small
    counters packed into 64-bit integers. Counts are then read by shift and mask in compiled code, with
    ``c * log2(c)`` from a table.
    """
    bits = window_rows.bit_length()
    per_word = 62 // bits
    words = -(-bins // per_word)
    low, step, zero = F.col("_lo"), F.col("_step"), F.lit(0).cast("bigint")

    def corrected(b: Column, i: Column) -> Column:
        v = F.get("_vals", i)
        below = F.when(v < low + b * step, F.lit(1)).otherwise(F.lit(0))
        above = F.when((v >= low + (b + 1) * step) & (b < bins - 1), F.lit(1)).otherwise(F.lit(0))
        return b - below + above

    first = F.transform("_vals", lambda v: F.least(F.floor((v - low) / F.col("_width") * bins).cast("int"), F.lit(bins - 1)))

    def packed(j: int) -> Column:
        def add(acc: Column, b: Column) -> Column:
            at = b - j * per_word
            one = F.call_function("shiftleft", F.lit(1).cast("bigint"), at * bits)
            return acc + (one if words == 1 else F.when(at.between(0, per_word - 1), one).otherwise(zero))

        return F.aggregate("_bins", zero, add)

    table = F.lit([0.0] + [c * math.log2(c) for c in range(1, window_rows + 1)])
    mask = F.lit((1 << bits) - 1)
    counts = [F.shiftright(f"_w{k // per_word}", bits * (k % per_word)).bitwiseAND(mask) for k in range(bins)]
    terms = [F.get(table, c.cast("int")) for c in counts]
    n = F.size("_vals")
    spread = F.log2(n.cast("double")) - sum(terms[1:], terms[0]) / F.nullif(n, F.lit(0))
    value = F.when(F.col("_hi") == low, F.lit(0.0)).otherwise(spread)
    width = F.nullif(F.col("_hi") - low, F.lit(0.0))
    return (
        df.withColumns({"_width": width, "_step": width / bins})
        .withColumn("_bins", F.transform(first, corrected))
        .withColumns({f"_w{j}": packed(j) for j in range(words)})
        .withColumn("shannon_entropy", F.when(n >= _minimum(window_rows), value))
        .drop("_vals", "_lo", "_hi", "_width", "_step", "_bins", *[f"_w{j}" for j in range(words)])
    )


def _frame_stats(w, window_rows: int, base: Sequence[str]) -> dict[str, Column]:
    need = _minimum(window_rows)
    out: dict[str, Column] = {}
    for c in base:
        enough = F.count(c).over(w) >= need
        out[f"{c}_roll_mean"] = F.when(enough, F.avg(c).over(w))
        out[f"{c}_roll_std"] = F.when(enough, F.stddev_samp(c).over(w))
        out[f"{c}_roll_min"] = F.when(enough, F.min(c).over(w))
        out[f"{c}_roll_max"] = F.when(enough, F.max(c).over(w))
        out[f"{c}_roll_median"] = F.when(enough, F.percentile(c, 0.5).over(w))
    return out


def _corrected_kurtosis(c: str, w, window_rows: int) -> Column:
    n = F.count(c).over(w).cast("double")
    excess = F.kurtosis(c).over(w)
    corrected = (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0)) * ((n + 1) * excess + 6)
    flat = F.min(c).over(w) == F.max(c).over(w)
    return F.when(n >= _minimum(window_rows, 4), F.when(flat, F.lit(0.0)).otherwise(corrected))


def _slope(c: str, w, window_rows: int) -> Column:
    # only the distance between positions matters, so the rank serves as x whatever the frame start is
    return F.when(F.count(c).over(w) >= _minimum(window_rows), F.regr_slope(c, ROW).over(w))


def _shape_columns(w, window_rows: int) -> dict[str, Column]:
    c = "amplitude_mean"
    return {
        "kurtosis": _corrected_kurtosis(c, w, window_rows),
        "amplitude_mean_slope": _slope(c, w, window_rows),
        "_vals": F.collect_list(c).over(w),
        "_lo": F.min(c).over(w),
        "_hi": F.max(c).over(w),
    }


def _frame(keys: Sequence[str], window_rows: int):
    return chunk_window(keys).rowsBetween(-(window_rows - 1), 0)


def rolling_stats(
    frames: DataFrame, window_rows: int, base: Sequence[str] = ROLLING_BASE, keys: Sequence[str] = SENSOR_KEYS
) -> DataFrame:
    """Rolling mean, sample std, min, max and median of the base columns."""
    return frames.withColumns(_frame_stats(_frame(keys, window_rows), window_rows, base))


def rolling_shape(
    frames: DataFrame, window_rows: int, bins: int, keys: Sequence[str] = SENSOR_KEYS
) -> DataFrame:
    """Rolling entropy, bias-corrected excess kurtosis and slope of the mean amplitude."""
    w = _frame(keys, window_rows)
    return with_entropy(frames.withColumns(_shape_columns(w, window_rows)), window_rows, bins)


def envelopes(frames: DataFrame, window_rows: int, keys: Sequence[str] = SENSOR_KEYS) -> DataFrame:
    """Rolling medians of entropy, kurtosis and the rolling mean amplitude."""
    w = _frame(keys, max(3, window_rows))
    sources = {
        "shannon_entropy_env": "shannon_entropy",
        "kurtosis_env": "kurtosis",
        "amplitude_mean_env": "amplitude_mean_roll_mean",
    }
    return frames.withColumns(
        {
            name: F.when(F.count(c).over(w) >= 3, F.percentile(c, 0.5).over(w))
            for name, c in sources.items()
        }
    )


def sensor_features(
    minutes: DataFrame,
    window_rows: int = 10,
    bins: int = 20,
    keys: Sequence[str] = SENSOR_KEYS,
    chunk_rows: int = 8192,
    bucket: str = "day",
) -> DataFrame:
    """All 58 features of each sensor row (input: ``prepare_minutes``).

    The envelopes look back over rolling values, so a chunk carries twice the window of earlier rows. All
    frames share partitioning and order: one shuffle and one sort serve both window levels.
    """
    reach = (window_rows - 1) + (max(3, window_rows) - 1)
    frames = sensor_frames(direct_features(minutes), keys, reach, chunk_rows, bucket)
    w = _frame(keys, window_rows)
    rolled = frames.withColumns({**_frame_stats(w, window_rows, ROLLING_BASE), **_shape_columns(w, window_rows)})
    first_level = with_entropy(rolled, window_rows, bins)
    return own_rows(envelopes(first_level, window_rows, keys)).drop(ROW)


def merge_repeated(features: DataFrame, columns: Sequence[str], period: str = "eruption_id") -> DataFrame:
    """Average rows that repeat (period, time, sensor), as a mean pivot does."""
    return features.groupBy(period, "time_min", "sensor").agg(*[F.avg(c).alias(c) for c in columns])


def network_stats(features: DataFrame, kind: str = "full", period: str = "eruption_id") -> DataFrame:
    """Statistics over the sensors present at each minute.

    ``full``: mean and sample std of entropy, kurtosis and rolling mean amplitude.
    ``core``: mean, sample std, min and max of the eight core features.
    """
    if kind == "full":
        sources = NETWORK_FULL
        stats = {"mean": F.avg, "std": F.stddev_samp}
    elif kind == "core":
        sources = {f"network_{c}": c for c in CORE_FEATURES if c in features.columns}
        stats = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    else:
        raise ValueError("kind must be 'full' or 'core'")
    # rows of a minute meet in one shuffle, which serves both the averaging of repeats and the statistics
    together = features.repartition(period, "time_min")
    merged = merge_repeated(together, list(dict.fromkeys(sources.values())), period)
    return merged.groupBy(period, "time_min").agg(
        *[fn(c).alias(f"{prefix}_{stat}") for prefix, c in sources.items() for stat, fn in stats.items()]
    )


def select_core(features: DataFrame, period: str = "eruption_id") -> DataFrame:
    """Keys and the core features that the table has; absent ones are simply left out."""
    available = [c for c in CORE_FEATURES if c in features.columns]
    if not available:
        raise ValueError("no core feature available")
    return features.select(period, "time_min", "sensor", *available)


def pivot_features(
    features: DataFrame, sensors: Sequence[str], columns: Sequence[str], period: str = "eruption_id"
) -> DataFrame:
    """One row per minute with columns ``feature__sensor``; repeated rows are averaged.

    For narrow, user-facing output. The dataset path keeps array blocks instead (``contract`` module).
    """
    wide = (
        features.groupBy(period, "time_min")
        .pivot("sensor", list(sensors))
        .agg(*[F.avg(c).alias(c) for c in columns])
    )
    renamed = {}
    for s in sensors:
        for c in columns:
            spark_name = s + "_" + c if len(columns) > 1 else s
            renamed[f"{c}__{s}"] = F.col(f"`{spark_name}`")
    return wide.select(period, "time_min", *[col.alias(name) for name, col in renamed.items()])
