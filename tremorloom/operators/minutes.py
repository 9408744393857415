"""Per-minute aggregates of conditioned samples and their quality report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tremorloom.functions.numeric import finite, frequency_index
from tremorloom.schemas import FILTER_COLUMNS, FREQUENCY_INDEX_EPS, MINUTE_COLUMNS

_SENSOR_KEYS = ["period_id", "network", "station", "channel"]


def _between(mean, low, high):
    """``mean`` without the last digits by which sums of many equal values leave their range; NaN stays."""
    return F.when(F.isnan(mean), mean).otherwise(F.greatest(low, F.least(high, mean)))


def minute_aggregate(
    samples: DataFrame, step_seconds: int = 60, eps: float = FREQUENCY_INDEX_EPS
) -> DataFrame:
    """One row per sensor and time cell with the 20 contract columns.

    ``samples`` holds ``period_id, network, station, channel, ts, sampling_rate`` and the three filtered
    signals ``amplitude, low, high``. A plain grouped aggregate: partial sums are built before the shuffle,
    so the size of one sensor does not matter.
    """
    cell = F.window("ts", f"{step_seconds} seconds")
    grouped = samples.groupBy(*_SENSOR_KEYS, cell.alias("_cell")).agg(
        _between(F.avg("amplitude"), F.min("amplitude"), F.max("amplitude")).alias("amplitude_mean"),
        F.stddev_samp("amplitude").alias("amplitude_std"),
        F.max("amplitude").alias("amplitude_max"),
        F.min("amplitude").alias("amplitude_min"),
        F.count("amplitude").alias("amplitude_count"),
        F.avg(F.col("low") * F.col("low")).alias("energy_low_1_5_5"),
        F.avg(F.col("high") * F.col("high")).alias("energy_high_6_16"),
        F.max("sampling_rate").alias("sampling_rate_source_hz"),
    )
    complete = grouped.withColumnRenamed("period_id", "eruption_id").withColumns(
        {
            "time_min": F.col("_cell.start"),
            "frequency_index": frequency_index("energy_low_1_5_5", "energy_high_6_16", eps),
            **{name: F.lit(value) for name, value in FILTER_COLUMNS.items()},
        }
    )
    return complete.select(*MINUTE_COLUMNS)


_CELL = ["eruption_id", "network", "station", "channel", "time_min"]


def minute_states(samples: DataFrame, step_seconds: int = 60, by: Sequence[str] = ()) -> DataFrame:
    """Mergeable partial states of ``minute_aggregate``, one row per sensor, time cell and ``by``.

    ``n, mean, m2`` are the count, mean and sum of squared deviations of the amplitude; the energies are counts and sums.
    """
    cell = F.window("ts", f"{step_seconds} seconds")
    squared = lambda c: F.col(c) * F.col(c)
    grouped = samples.groupBy(*_SENSOR_KEYS, *by, cell.alias("_cell")).agg(
        F.count("amplitude").alias("n"),
        F.avg("amplitude").alias("mean"),
        (F.var_pop("amplitude") * F.count("amplitude")).alias("m2"),
        F.max("amplitude").alias("high"),
        F.min("amplitude").alias("low"),
        *[F.count(squared(c)).alias(f"{c}_n") for c in ("low", "high")],
        *[F.sum(squared(c)).alias(f"{c}_energy") for c in ("low", "high")],
        F.max("sampling_rate").alias("rate"),
    )
    return grouped.withColumnRenamed("period_id", "eruption_id").withColumn("time_min", F.col("_cell.start")).drop("_cell")


def merged_minutes(states: DataFrame, eps: float = FREQUENCY_INDEX_EPS) -> DataFrame:
    """The minute table from any partial states of its cells; the same as ``minute_aggregate`` of all their samples.

    Deviations are moved to the mean of the cell before they are added, so no digits are lost. A cell has as many states
    as inputs that reach into it.
    """
    cell = Window.partitionBy(*_CELL)
    mean = F.sum(F.col("n") * F.col("mean")).over(cell) / F.nullif(F.sum("n").over(cell), F.lit(0))
    away = F.col("mean") - F.col("_mean")
    n, m2 = F.sum("n"), F.sum(F.col("m2") + F.col("n") * away * away)
    grouped = states.withColumn("_mean", mean).groupBy(*_CELL).agg(
        _between(F.first("_mean"), F.min("low"), F.max("high")).alias("amplitude_mean"),
        F.when(n > 1, F.sqrt(m2 / (n - 1))).alias("amplitude_std"),
        F.max("high").alias("amplitude_max"),
        F.min("low").alias("amplitude_min"),
        n.alias("amplitude_count"),
        (F.sum("low_energy") / F.nullif(F.sum("low_n"), F.lit(0))).alias("energy_low_1_5_5"),
        (F.sum("high_energy") / F.nullif(F.sum("high_n"), F.lit(0))).alias("energy_high_6_16"),
        F.max("rate").alias("sampling_rate_source_hz"),
    )
    index = frequency_index("energy_low_1_5_5", "energy_high_6_16", eps)
    fixed = {name: F.lit(value) for name, value in FILTER_COLUMNS.items()}
    return grouped.withColumns({"frequency_index": index, **fixed}).select(*MINUTE_COLUMNS)


def _row_errors(present: set[str]) -> list[tuple[str, object]]:
    """Error rules that a single row of a typed minute table can break."""
    rules = []
    if "time_min" in present:
        rules.append(("bad_time", F.col("time_min").isNull()))
    if "amplitude_count" in present:
        rules.append(("count_not_positive", F.col("amplitude_count") <= 0))
    if "amplitude_std" in present:
        rules.append(("std_negative", finite("amplitude_std") < 0))
    if {"amplitude_min", "amplitude_mean", "amplitude_max"} <= present:
        below, above = finite("amplitude_min") > finite("amplitude_mean"), finite("amplitude_mean") > finite("amplitude_max")
        rules.append(("amplitude_order", below | above))
    for name in ("energy_low_1_5_5", "energy_high_6_16"):
        if name in present:
            rules.append((f"negative_{name}", finite(name) < 0))
    if "frequency_index" in present:
        rules.append(("frequency_index_infinite", F.abs(F.col("frequency_index").cast("double")) == F.lit(float("inf"))))
    return rules


def observed(minutes: DataFrame, audit: Observation) -> DataFrame:
    """The same rows; whoever writes them learns on the way whether there are any and which row rules were broken.

    The metrics are flags and not counts, since a task that runs twice must not change them.
    """
    rules = _row_errors(set(minutes.columns))
    flags = [F.coalesce(F.bool_or(broken), F.lit(False)).alias(name) for name, broken in rules]
    return minutes.observe(audit, (F.count(F.lit(1)) == 0).alias("empty_table"), *flags)


def minute_quality(minutes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Violations of the minute-table rules: rows ``(*by, rule, severity, n_bad)``.

    All rules are counted in one pass over the data (grouped by the row key so that repeated keys are seen,
    then summed). ``time_min`` may still be text; what does not parse counts as a bad time.
    """
    by = list(by)
    present = set(minutes.columns)
    checks: list[tuple[str, str, object]] = []
    time_type = dict(minutes.dtypes).get("time_min")
    if time_type is not None:
        parsed = F.col("time_min") if time_type != "string" else F.try_to_timestamp(F.col("time_min"))
        checks.append(("bad_time", "error", parsed.isNull()))
    for name in MINUTE_COLUMNS[5:13]:
        if name in present:
            value = F.col(name).cast("double")
            checks.append((f"null_{name}", "warning", value.isNull() | F.isnan(value)))
    if "amplitude_count" in present:
        checks.append(("count_not_positive", "error", F.col("amplitude_count") <= 0))
    if "amplitude_std" in present:
        checks.append(("std_negative", "error", finite("amplitude_std") < 0))
    if {"amplitude_min", "amplitude_mean", "amplitude_max"} <= present:
        disorder = (finite("amplitude_min") > finite("amplitude_mean")) | (
            finite("amplitude_mean") > finite("amplitude_max")
        )
        checks.append(("amplitude_order", "error", disorder))
    for name in ("energy_low_1_5_5", "energy_high_6_16"):
        if name in present:
            checks.append((f"negative_{name}", "error", finite(name) < 0))
    if "frequency_index" in present:
        infinite = F.abs(F.col("frequency_index").cast("double")) == F.lit(float("inf"))
        checks.append(("frequency_index_infinite", "error", infinite))

    key = [c for c in ("station", "channel", "time_min") if c in present]
    counted = minutes.groupBy(*dict.fromkeys([*by, *key])).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(condition).alias(f"_c{i}") for i, (_, _, condition) in enumerate(checks)],
    )
    summed = counted.groupBy(*by).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("_repeated"),
        *[F.coalesce(F.sum(f"_c{i}"), F.lit(0)).alias(f"_c{i}") for i in range(len(checks))],
    )
    missing = len(set(MINUTE_COLUMNS) - present)
    rules = [
        ("missing_columns", "error", F.lit(missing)),
        ("empty_table", "error", (F.col("_rows") == 0).cast("bigint")),
    ]
    rules += [(name, severity, F.col(f"_c{i}")) for i, (name, severity, _) in enumerate(checks)]
    if len(key) == 3:
        rules.append(("duplicate_sensor_time", "error", F.col("_repeated")))
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.lit(severity).alias("severity"),
                count.cast("bigint").alias("n_bad"),
            )
            for name, severity, count in rules
        ]
    )
    return summed.select(*by, F.explode(entries).alias("_e")).select(*by, "_e.*")
