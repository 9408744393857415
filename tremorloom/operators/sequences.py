"""Overlapping sequences over contract vectors: ends, labels, splits, weights, materialised tensors.

A *virtual* sequence is only its end position; labels, splits and fit statistics need nothing more.
``build_sequences`` writes out the matrices, which repeat each row up to ``length / stride`` times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremorloom.functions.labels import horizon_label
from tremorloom.functions.times import hours_between, micros
from tremorloom.operators.periods import ContractViolation, require_none
from tremorloom.operators.ranking import (
    CHUNK,
    ROW,
    bounded_broadcast,
    chunk_window,
    global_rank,
    own_rows,
    with_halo,
)
from tremorloom.schemas import SPLITS


def index_rows(vectors: DataFrame, period: str = "period_id", bucket: str = "day") -> DataFrame:
    """Adds ``_rn``, the 1-based position of the row in its period."""
    return global_rank(vectors, [period], ["time_min"], F.date_trunc(bucket, F.col("time_min")))


def sequence_ends(indexed: DataFrame, length: int, stride: int = 1, period: str = "period_id") -> DataFrame:
    """Rows that end a sequence: positions ``length``, ``length + stride``, ..."""
    if stride < 1 or length < 1:
        raise ValueError("length and stride must be >= 1")
    return indexed.where((F.col(ROW) >= length) & ((F.col(ROW) - length) % stride == 0)).select(
        period, F.col("time_min").alias("t_end"), F.col(ROW).alias("end_rn")
    )


def hours_to_event(
    ends: DataFrame, max_horizon_hours: float = 48.0, clamp_after_event: bool = False
) -> DataFrame:
    """Adds ``hours``; drops ends after the event (or sets them to 0) and ends beyond the horizon.

    Expects ``eruption_start_utc`` on the rows.
    """
    hours = hours_between("eruption_start_utc", "t_end")
    if clamp_after_event:
        hours = F.when(hours < 0, F.lit(0.0)).otherwise(hours)
    timed = ends.withColumn("hours", hours)
    return timed.where((F.col("hours") >= 0) & (F.col("hours") <= max_horizon_hours))


def label_sequences(
    ends: DataFrame,
    periods: DataFrame,
    max_horizon_hours: float = 48.0,
    clamp_after_event: bool = False,
    task: str = "classification",
) -> DataFrame:
    """Kept ends of event and quiet periods with their target ``y``.

    Classification: class 0 for quiet periods, 1..5 by hours to the event. Regression: the hours themselves,
    event periods only. ``periods`` is typed metadata, one row per period.
    """
    wanted = [c for c in ("period_id", "period_type", "eruption_start_utc", "split", "period_ord") if c in periods.columns]
    joined = ends.join(periods.select(*wanted), "period_id")
    events = hours_to_event(joined.where(F.col("period_type") == "eruption"), max_horizon_hours, clamp_after_event)
    if task == "regression":
        return events.withColumn("y", F.col("hours").cast("float")).drop("eruption_start_utc", "period_type")
    if task != "classification":
        raise ValueError("task must be 'classification' or 'regression'")
    quiet = joined.where(F.col("period_type") == "quiet").withColumn("hours", F.lit(None).cast("double"))
    labelled = events.withColumn("y", horizon_label("hours")).unionByName(quiet.withColumn("y", F.lit(0)))
    return labelled.drop("eruption_start_utc", "period_type")


def ends_per_period(periods: DataFrame, kept: DataFrame) -> DataFrame:
    """Kept sequences per period, 0 where a period produced none."""
    counts = kept.groupBy("period_id").agg(F.count(F.lit(1)).alias("n_sequences"))
    return periods.select("period_id").join(counts, "period_id", "left").fillna(0, ["n_sequences"])


# --- splits ---------------------------------------------------------------------------------------


def chronological_bounds(n: int, train_ratio: float, val_ratio: float) -> tuple[int, int]:
    """First positions of val and test: truncated shares, each part keeping at least one sequence."""
    if n < 3:
        raise ContractViolation(f"cannot make three splits of {n} sequences")
    if train_ratio <= 0 or val_ratio <= 0 or train_ratio + val_ratio >= 1:
        raise ValueError("ratios must be positive and sum to less than 1")
    val_from = max(1, min(int(n * train_ratio), n - 2))
    test_from = max(val_from + 1, min(int(n * (train_ratio + val_ratio)), n - 1))
    return val_from, test_from


# so many keys are simply fetched and sorted; more are counted in bins first
_FEW_KEYS = 4096
_BINS = 1024


def _bin_of(bins: list, wanted: int) -> tuple:
    """The bin that holds a 0-based position, and the position inside it; bins are ordered."""
    for row in bins:
        if wanted < row["n"]:
            return row, wanted
        wanted -= row["n"]
    raise ValueError("position behind the last row")


def _key_at(ends: DataFrame, per_day: list, position: int) -> tuple:
    """``(t_end, period_id)`` of the 0-based position in (t_end, period_id) order, by distributed selection.

    ``per_day`` are the ordered day counts. A histogram of instants in the day of the position leads to one bin, whose
    histogram leads to a narrower one, down to one instant; then the next two bytes of the period ids are counted, again and
    again. Every step is a grouped count of at most ``_BINS`` or 65 537 bins, until few keys or a single one are left.
    """
    day, wanted = _bin_of(per_day, position)
    n, us = day["n"], micros("t_end")
    rows = ends.where(F.col("_day") == F.lit(day["_day"])).select(us.alias("_us"), "period_id")
    span = rows.agg(F.min("_us").alias("low"), F.max("_us").alias("high")).first()
    while n > _FEW_KEYS and span["low"] < span["high"]:
        width = -(-(span["high"] - span["low"] + 1) // _BINS)
        cell = F.floor((F.col("_us") - F.lit(span["low"])) / F.lit(width)).alias("cell")
        counted = rows.groupBy(cell).agg(F.count(F.lit(1)).alias("n"), F.min("_us").alias("low"), F.max("_us").alias("high"))
        span, wanted = _bin_of(sorted(counted.collect(), key=lambda r: r["cell"]), wanted)
        n, rows = span["n"], rows.where(F.col("_us").between(span["low"], span["high"]))
    known = 0
    while n > _FEW_KEYS:
        following = F.substring(F.col("period_id").cast("binary"), known + 1, 2).alias("bytes")
        counted = rows.groupBy(following).agg(F.count(F.lit(1)).alias("n"), F.min("period_id").alias("low"), F.max("period_id").alias("high"))
        found, wanted = _bin_of(sorted(counted.collect(), key=lambda r: bytes(r["bytes"])), wanted)
        n, known, rows = found["n"], known + 2, rows.where(F.col("period_id").between(found["low"], found["high"]))
        if found["low"] == found["high"]:
            return _instant(span["low"]), found["low"]
    keys = sorted(((r["_us"], r["period_id"]) for r in rows.collect()), key=lambda k: (k[0], k[1].encode()))
    return _instant(keys[wanted][0]), keys[wanted][1]


def _instant(us: int) -> Column:
    return F.timestamp_micros(F.lit(us))


def split_chronological(ends: DataFrame, train_ratio: float = 0.70, val_ratio: float = 0.15) -> DataFrame:
    """Adds ``split`` by position in (t_end, period_id) order over all sequences.

    No ranking of the whole table: counts per day (a short list) tell the day of each boundary, the boundary
    key is found inside that day by ever finer counts, and every row is then compared with the two keys.
    """
    dated = ends.withColumn("_day", F.to_date("t_end"))
    per_day = dated.groupBy("_day").agg(F.count(F.lit(1)).alias("n")).orderBy("_day").collect()
    n = sum(row["n"] for row in per_day)
    val_from, test_from = chronological_bounds(n, train_ratio, val_ratio)
    val_key, test_key = (_key_at(dated, per_day, p) for p in (val_from, test_from))

    def precedes(key: tuple) -> Column:
        t, p = key[0], F.lit(key[1])
        return (F.col("t_end") < t) | ((F.col("t_end") == t) & (F.col("period_id") < p))

    split = F.when(precedes(val_key), "train").when(precedes(test_key), "val").otherwise("test")
    return dated.withColumn("split", split).drop("_day")


def empty_splits(sequences: DataFrame) -> DataFrame:
    """Required splits without any sequence."""
    seen = sequences.select("split").distinct()
    required = sequences.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    return required.join(seen, "split", "left_anti")


def split_manual(ends: DataFrame, periods: DataFrame) -> DataFrame:
    """``split`` from the period metadata; every split must be non-empty."""
    assigned = ends.drop("split").join(periods.select("period_id", "split"), "period_id")
    require_none(empty_splits(assigned), "no sequence in a required split")
    return assigned


# --- weights and tensors --------------------------------------------------------------------------


def sequence_weights(
    indexed: DataFrame, kept: DataFrame, length: int, period: str = "period_id", chunk_rows: int = 8192
) -> DataFrame:
    """Adds ``weight``: in how many kept sequences the row occurs (0 when in none)."""
    marks = kept.select(period, F.col("end_rn").alias(ROW)).withColumn("_kept", F.lit(1))
    flagged = indexed.join(marks, [period, ROW], "left").withColumn("_kept", F.coalesce("_kept", F.lit(0)))
    cover = chunk_window([period]).rowsBetween(0, length - 1)
    counted = with_halo(flagged, chunk_rows, after=length - 1).withColumn(
        "weight", F.sum("_kept").over(cover).cast("bigint")
    )
    return own_rows(counted).drop("_kept")


def build_sequences(
    indexed: DataFrame,
    ends: DataFrame,
    length: int,
    period: str = "period_id",
    chunk_rows: int | None = None,
) -> DataFrame:
    """``ends`` with ``x``: the last ``length`` vectors as a matrix, oldest first.

    Rows are gathered once per chunk of end positions (with ``length - 1`` earlier rows copied in) and every
    sequence is a slice of that array; the shuffle carries each row about once, not once per sequence.
    """
    size = chunk_rows or 2 * length
    held = with_halo(indexed.select(period, ROW, "x"), size, before=length - 1)
    gathered = held.groupBy(period, CHUNK).agg(
        F.min(ROW).alias("_first"), F.sort_array(F.collect_list(F.struct(F.col(ROW).alias("rn"), "x"))).alias("_rows")
    )
    placed = ends.withColumn(CHUNK, F.floor((F.col("end_rn") - 1) / size).cast("bigint"))
    start = (F.col("end_rn") - length + 1 - F.col("_first") + 1).cast("int")
    window = F.slice(F.col("_rows"), start, length)
    return (
        placed.join(gathered, [period, CHUNK])
        .withColumn("x", F.transform(window, lambda r: r["x"]))
        .drop(CHUNK, "_first", "_rows")
    )


def latest_batch(sequences: DataFrame, k: int) -> DataFrame:
    """The last ``k`` sequences in dataset order: period order first, then time.

    Only the two order columns are ranked (a top-k); the matrices are fetched for the chosen ones.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    order = [F.col("period_ord").desc(), F.col("t_end").desc()]
    newest = sequences.select("period_ord", "t_end").orderBy(*order).limit(k)
    available = newest.count()
    if k > available:
        raise ContractViolation(f"batch of {k} exceeds the {available} available sequences")
    return sequences.join(bounded_broadcast(newest, k), ["period_ord", "t_end"], "left_semi").orderBy(*order).limit(k)


def merge_datasets(reference: DataFrame, *ready: DataFrame) -> DataFrame:
    """Reference sequences and all ready ones, split by split, in source order (``source_ord``).

    Columns only the reference has are kept (NULL elsewhere); extra columns of the others are dropped.
    """
    merged = reference.withColumn("source_ord", F.lit(0))
    columns = merged.columns
    for i, other in enumerate(ready, start=1):
        tagged = other.withColumn("source_ord", F.lit(i))
        known = tagged.select(*[c for c in columns if c in tagged.columns])
        merged = merged.unionByName(known, allowMissingColumns=True)
    return merged
