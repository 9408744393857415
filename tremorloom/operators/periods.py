"""Period metadata: normalising, validation, mode rules, and the join of samples to periods.

Rules return violation rows ``(period_id, rule, detail)`` instead of stopping at the first bad row, so a
caller sees all of them; ``require_none`` turns them into an error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorloom.functions.labels import lookup_period_type
from tremorloom.functions.times import parse_utc
from tremorloom.schemas import PERIOD_OPTIONAL, PERIOD_REQUIRED, SPLITS


class ContractViolation(ValueError):
    """Input rows break a rule that the job cannot go on without."""


def require_none(violations: DataFrame, what: str) -> None:
    """Raise when there is any violation row (shows a few of them)."""
    found = violations.limit(20).collect()
    if found:
        raise ContractViolation(f"{what}: " + "; ".join(str(r.asDict()) for r in found))


def tidy_periods(periods: DataFrame, required: list[str] = PERIOD_REQUIRED) -> DataFrame:
    """Trimmed text columns, optional columns added empty, NULL text as ''."""
    named = periods.toDF(*[c.strip() for c in periods.columns])
    missing = sorted(set(required) - set(named.columns))
    if missing:
        raise ContractViolation(f"missing columns in the periods table: {missing}")
    for c in PERIOD_OPTIONAL:
        if c not in named.columns:
            named = named.withColumn(c, F.lit(""))
    return named.select(
        *[
            F.coalesce(F.trim(F.col(c)), F.lit("")).alias(c) if t == "string" else F.col(c)
            for c, t in named.dtypes
        ]
    )


def _as_utc(c: str, kinds: dict[str, str]) -> Column:
    # the metadata reader takes text without an offset as UTC
    return parse_utc(c, allow_naive=True) if kinds[c] == "string" else F.col(c).cast("timestamp")


def typed_periods(periods: DataFrame) -> DataFrame:
    """Canonical type, timestamps, and ``stations`` / ``channels`` as arrays."""
    kinds = dict(periods.dtypes)
    columns: dict[str, Column] = {"period_type": lookup_period_type("period_type")}
    for c in ("period_start_utc", "period_end_utc", "eruption_start_utc", "eruption_end_utc"):
        if c in kinds:
            columns[c] = _as_utc(c, kinds)
    for c in ("stations", "channels"):
        if kinds.get(c) == "string":
            columns[c] = F.when(F.col(c) != "", F.split(c, ","))
    return periods.withColumns(columns)


def _violations(df: DataFrame, rules: list[tuple[str, Column, Column]], key: str = "period_id") -> DataFrame:
    """One output row per (input row, broken rule), in a single pass."""
    entries = F.array(
        *[
            F.when(
                F.coalesce(broken, F.lit(False)),
                F.struct(F.lit(rule).alias("rule"), F.coalesce(detail, F.lit("")).alias("detail")),
            )
            for rule, broken, detail in rules
        ]
    )
    return df.select(F.col(key), F.explode(F.array_compact(entries)).alias("_v")).select(key, "_v.*")


def validate_periods(periods: DataFrame) -> DataFrame:
    """Violations of the extraction metadata (input: ``tidy_periods``)."""
    kinds = dict(periods.dtypes)
    start, end = _as_utc("period_start_utc", kinds), _as_utc("period_end_utc", kinds)
    ev_start, ev_end = _as_utc("eruption_start_utc", kinds), _as_utc("eruption_end_utc", kinds)
    given = lambda c: F.col(c).cast("string") != ""
    text = lambda c: F.col(c).cast("string")
    rules = [
        ("empty_period_id", F.col("period_id") == "", F.lit("")),
        ("unknown_period_type", lookup_period_type("period_type").isNull(), F.col("period_type")),
        ("bad_period_start", start.isNull(), text("period_start_utc")),
        ("bad_period_end", end.isNull(), text("period_end_utc")),
        ("end_not_after_start", end <= start, text("period_end_utc")),
        ("bad_event_start", given("eruption_start_utc") & ev_start.isNull(), text("eruption_start_utc")),
        (
            "bad_event_end",
            given("eruption_start_utc") & given("eruption_end_utc") & ev_end.isNull(),
            text("eruption_end_utc"),
        ),
        ("event_end_before_start", ev_end < ev_start, text("eruption_end_utc")),
    ]
    repeated = (
        periods.groupBy("period_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select(
            "period_id", F.lit("duplicate_period_id").alias("rule"), F.col("n").cast("string").alias("detail")
        )
    )
    return _violations(periods, rules).unionByName(repeated)


def mode_violations(periods: DataFrame, mode: str, manual_split: bool = False) -> DataFrame:
    """What forbids using these periods: training refuses inference periods and undated event periods; a
    manual split must name train, val or test."""
    kind = lookup_period_type("period_type")
    dated = F.coalesce(F.col("eruption_start_utc").cast("string"), F.lit("")) != ""
    rules = [
        ("empty_period_id", F.coalesce(F.trim("period_id"), F.lit("")) == "", F.lit("")),
        ("unknown_period_type", kind.isNull(), F.col("period_type")),
    ]
    if mode == "training":
        rules.append(("inference_in_training", kind == "inference", F.col("period_type")))
        rules.append(("event_start_missing", (kind == "eruption") & ~dated, F.lit("")))
    elif mode != "inference":
        raise ValueError("mode must be 'training' or 'inference'")
    if manual_split:
        rules.append(("invalid_split", ~F.coalesce(F.col("split"), F.lit("")).isin(SPLITS), F.col("split")))
    return _violations(periods, rules)


def select_periods(periods: DataFrame, mode: str, manual_split: bool = False, drop_inference: bool = False) -> DataFrame:
    """Typed periods for the mode; fails when one of them is not usable.

    ``drop_inference`` leaves inference periods out, as retraining does, instead of refusing them.
    """
    kept = periods
    if drop_inference:
        kept = kept.where(F.coalesce(lookup_period_type("period_type") != "inference", F.lit(True)))
    require_none(mode_violations(kept, mode, manual_split), f"periods not usable for {mode}")
    return typed_periods(kept)


# bounds of a scan: most spans, and most names in a list
_MAX_SPANS = 48
_MAX_NAMES = 48


def covered_spans(spans: list[tuple[int, int]], most: int = _MAX_SPANS) -> list[tuple[int, int]]:
    """Disjoint ``[start, end)`` that cover all given ones, ``most`` at most: the shortest gaps are closed first."""
    merged: list[list[int]] = []
    for start, end in sorted(s for s in spans if s[0] < s[1]):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    gaps = sorted((b[0] - a[1], i) for i, (a, b) in enumerate(zip(merged, merged[1:])))
    closed = {i for _, i in gaps[: max(0, len(merged) - most)]}
    out: list[tuple[int, int]] = []
    for i, (start, end) in enumerate(merged):
        if i and i - 1 in closed:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def _scan_bounds(periods: DataFrame, filters: list[str]) -> list[Column]:
    """Conditions that every sample of a period meets, simple enough for the scan: row groups between periods are skipped."""
    rows = periods.where(F.col("period_end_utc") > F.col("period_start_utc"))
    named = {c: column for c, column in (("network", "network"), ("stations", "station"), ("channels", "channel")) if c in filters}
    as_list = lambda c: F.array(c) if c == "network" else F.col(c)
    unnamed = lambda c: F.coalesce(F.col(c) == "", F.lit(True)) if c == "network" else F.col(c).isNull()
    # a row per day on which a period starts: metadata
    days = rows.groupBy(F.to_date("period_start_utc")).agg(
        F.min(F.unix_micros("period_start_utc")).alias("a"),
        F.max(F.unix_micros("period_end_utc")).alias("b"),
        *[F.bool_or(unnamed(c)).alias(f"any_{c}") for c in named],
        *[F.array_distinct(F.flatten(F.collect_set(as_list(c)))).alias(c) for c in named],
    ).collect()
    spans = covered_spans([(day["a"], day["b"]) for day in days])
    instant = lambda us: F.timestamp_micros(F.lit(us))
    bounds = [reduce(lambda a, b: a | b, [(F.col("ts") >= instant(a)) & (F.col("ts") < instant(b)) for a, b in spans])] if spans else []
    for c, column in named.items():
        names = sorted({name for day in days for name in day[c] if name is not None})
        if names and len(names) <= _MAX_NAMES and not any(day[f"any_{c}"] for day in days):
            bounds.append(reduce(lambda a, b: a | b, [F.col(column).eqNullSafe(F.lit(name)) for name in names]))
    return bounds


def assign_periods(samples: DataFrame, periods: DataFrame) -> DataFrame:
    """Samples of each period: ``start <= ts < end`` and a requested network, station and channel.

    ``periods`` is typed. The range condition is carried by an equality on the day, so a growing period table
    never turns the join into a nested loop; Spark broadcasts the period side while its measured size is
    below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, splitting skewed days. What the periods cover
    (``covered_spans``), and the networks and stations they name if every period does, bound the scan of the samples.
    """
    last = F.col("period_end_utc") - F.expr("INTERVAL 1 MICROSECOND")
    days = F.sequence(F.to_date("period_start_utc"), F.to_date(last))
    wanted = ["period_id", "period_start_utc", "period_end_utc"]
    filters = [c for c in ("network", "stations", "channels") if c in periods.columns]
    spread = periods.where(F.col("period_end_utc") > F.col("period_start_utc")).select(
        *wanted, *[F.col(c).alias(f"_p_{c}") for c in filters], F.explode(days).alias("_day")
    )
    conditions = [
        F.col("ts") >= F.col("period_start_utc"),
        F.col("ts") < F.col("period_end_utc"),
    ]
    if "network" in filters:
        conditions.append((F.col("_p_network") == "") | (F.col("_p_network") == F.col("network")))
    for listed, column in (("stations", "station"), ("channels", "channel")):
        if listed in filters:
            listing = F.col(f"_p_{listed}")
            conditions.append(listing.isNull() | F.array_contains(listing, F.col(column)))
    samples = samples.where(reduce(lambda a, b: a & b, _scan_bounds(periods, filters), F.lit(True)))
    joined = samples.withColumn("_day", F.to_date("ts")).join(spread, "_day")
    dropped = ["_day", "period_start_utc", "period_end_utc", *[f"_p_{c}" for c in filters]]
    return joined.where(reduce(lambda a, b: a & b, conditions)).drop(*dropped)
