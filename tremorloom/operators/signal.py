"""Conditioning of raw sample traces: gaps, trend, band-passes, and trace checks.

A trace is one (period, network, station, channel). A trace may be arbitrarily long, so nothing here sorts or
collects a whole trace in one task: per-trace figures come from grouped aggregates, neighbours across time
buckets from small bucket summaries, and filters run on bounded chunks whose states are composed.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tremorloom.functions.numeric import is_finite
from tremorloom.functions.times import micros
from tremorloom.operators import recursive_filter
from tremorloom.operators.ranking import same_keys
from tremorloom.schemas import BAND_FULL, BAND_HIGH, BAND_LOW, NYQUIST_MINIMUM_HZ
from tremorloom.session import found_by_workers, stored

TRACE_KEYS = ["period_id", "network", "station", "channel"]

# A gap is filled in blocks of this many samples: one long gap is never one huge array.
_FILL_BLOCK = 4096


def merge_segments(samples: DataFrame, segment: str | None = None, keys: Sequence[str] = TRACE_KEYS) -> DataFrame:
    """One value per trace and instant; where segments overlap the one that starts later wins."""
    rate = F.max("sampling_rate").alias("sampling_rate")
    if segment is None:
        return samples.groupBy(*keys, "ts").agg(F.max("amplitude").alias("amplitude"), rate)
    return samples.groupBy(*keys, "ts").agg(F.max_by("amplitude", segment).alias("amplitude"), rate)


def interpolate_gaps(
    samples: DataFrame,
    keys: Sequence[str] = TRACE_KEYS,
    bucket_seconds: int = 3600,
    segment: str | None = None,
) -> DataFrame:
    """Merge overlapping segments and add the missing samples of each trace by linear interpolation.

    Column ``filled`` marks added samples; NULL and non-finite values count as missing. This is ``link_gaps`` and then
    ``fill_gaps``; a job that needs the lines of the filled traces stores what is between them.
    """
    return fill_gaps(link_gaps(samples, keys, bucket_seconds, segment), keys)


def link_gaps(
    samples: DataFrame,
    keys: Sequence[str] = TRACE_KEYS,
    bucket_seconds: int = 3600,
    segment: str | None = None,
) -> DataFrame:
    """Merged samples, each with what fills the gap behind it: ``_us, _next_us, _next_amplitude, _missing`` (how many).

    Samples are shuffled once, by trace and time bucket; merging and the look at the next sample happen there. The last
    sample of a bucket gets the first one of the next non-empty bucket from a table with one row per bucket, which is
    aggregated before its shuffle.
    """
    keys = list(keys)
    valid = (
        samples.where(is_finite("amplitude"))
        .withColumn("_us", micros("ts"))
        .withColumn("_b", F.floor(F.col("_us") / F.lit(bucket_seconds * 1_000_000)).cast("bigint"))
    )
    winner = F.col("amplitude") if segment is None else F.col(segment)
    by_bucket = Window.partitionBy(*keys).orderBy("_b")
    heads = (
        valid.groupBy(*keys, "_b")
        .agg(F.max_by(F.struct("_us", "amplitude"), F.struct(-F.col("_us"), winner)).alias("_head"))
        .withColumn("_after", F.lead("_head").over(by_bucket))
        .select(*keys, "_b", "_after")
    )
    merged = (
        valid.repartition(*keys, "_b")
        .groupBy(*keys, "_b", "_us")
        .agg(
            F.max_by("amplitude", winner).alias("amplitude"),
            F.max("ts").alias("ts"),
            F.max("sampling_rate").alias("sampling_rate"),
        )
    )
    inside = Window.partitionBy(*keys, "_b").orderBy("_us")
    intervals = (F.col("_next._us") - F.col("_us")) / (F.lit(1e6) / F.col("sampling_rate"))
    return (
        merged.withColumn("_next", F.lead(F.struct("_us", "amplitude")).over(inside))
        .transform(lambda left: same_keys(left, heads, [*keys, "_b"]))
        .withColumn("_next", F.coalesce("_next", "_after"))
        .select(
            *keys,
            "ts",
            "amplitude",
            "sampling_rate",
            "_us",
            F.col("_next._us").alias("_next_us"),
            F.col("_next.amplitude").alias("_next_amplitude"),
            F.greatest(F.coalesce(F.round(intervals).cast("bigint") - 1, F.lit(0)), F.lit(0)).cast("bigint").alias("_missing"),
        )
    )


def fill_gaps(linked: DataFrame, keys: Sequence[str] = TRACE_KEYS) -> DataFrame:
    """Linked samples and the missing ones, marked by ``filled``.

    A gap is cut into blocks, and blocks are dealt out by (trace, gap, block) before their samples are made: however long
    a gap is, all tasks share it. Samples themselves aren't moved.
    """
    keys = list(keys)
    own = linked.select(*keys, "ts", "amplitude", "sampling_rate", F.lit(False).alias("filled"))
    last_block = F.floor((F.col("_missing") - 1) / _FILL_BLOCK).cast("bigint")
    blocks = linked.where(F.col("_missing") > 0).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
    start = F.col("_block") * _FILL_BLOCK
    steps = F.sequence((start + 1).cast("bigint"), F.least(start + _FILL_BLOCK, F.col("_missing")).cast("bigint"))
    # a given number, since adaptive execution would join the few bytes that blocks are before they grow
    tasks = int(linked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = F.col("amplitude") + (F.col("_next_amplitude") - F.col("amplitude")) * (F.col("_i") / (F.col("_missing") + 1))
    instant = F.timestamp_micros((F.col("_us") + F.round(F.col("_i") * (F.lit(1e6) / F.col("sampling_rate")))).cast("bigint"))
    made = (
        blocks.repartition(tasks, *keys, "_us", "_block")
        .withColumn("_i", F.explode(steps))
        .select(*keys, instant.alias("ts"), line.alias("amplitude"), "sampling_rate", F.lit(True).alias("filled"))
    )
    return own.unionByName(made)


def demean(samples: DataFrame, keys: Sequence[str] = TRACE_KEYS) -> DataFrame:
    """Subtract the mean of each trace (aggregate, then join back the small trace table)."""
    means = samples.groupBy(*keys).agg(F.avg("amplitude").alias("_mean"))
    return (
        same_keys(samples, means, keys).withColumn("amplitude", F.col("amplitude") - F.col("_mean")).drop("_mean")
    )


_DAY_US = 86_400_000_000


def trace_lines(samples: DataFrame, keys: Sequence[str] = TRACE_KEYS) -> DataFrame:
    """Least-squares line of each trace: ``(*keys, _day0, _slope, _centre, _mean)``.

    Moments are taken per day, relative to the day's start, and combined per trace on the small table of days.
    That is one pass over the samples, and no digits are lost to large epoch seconds.
    """
    return _lines_of_days(_day_moments(samples, keys), keys)


def linked_trace_lines(linked: DataFrame, keys: Sequence[str] = TRACE_KEYS) -> DataFrame:
    """``trace_lines`` of the filled traces, from ``link_gaps`` alone: the samples of a gap are never made for it.

    The missing samples of a gap of m are an arithmetic series in time and value, so their means and moments are closed
    forms: with step d in time and e in value, the variance of time is d*d*(m*m-1)/12 and the covariance d*e*(m*m-1)/12.
    """
    keys = list(keys)
    m = F.col("_missing").cast("double")
    dt = F.lit(1.0) / F.col("sampling_rate")
    step = (F.col("_next_amplitude") - F.col("amplitude")) / (m + 1)
    spread = (m * m - 1) / 12
    gap = linked.where(F.col("_missing") > 0).select(
        *keys,
        F.floor(F.col("_us") / F.lit(_DAY_US)).cast("bigint").alias("_day"),
        m.alias("_m"),
        (F.pmod(F.col("_us"), F.lit(_DAY_US)) / F.lit(1e6) + dt * (m + 1) / 2).alias("_x"),
        (F.col("amplitude") + step * (m + 1) / 2).alias("_y"),
        (dt * dt * spread).alias("_vx"),
        (dt * step * spread).alias("_vxy"),
    )
    total = F.sum("_m")
    mean = lambda c: F.sum(F.col("_m") * c) / total
    x, y = F.col("_x"), F.col("_y")
    gaps = gap.groupBy(*keys, "_day").agg(
        total.cast("bigint").alias("n"),
        mean(x).alias("x"),
        mean(y).alias("y"),
        (mean(F.col("_vx")) + mean(x * x) - mean(x) * mean(x)).alias("vx"),
        (mean(F.col("_vxy")) + mean(x * y) - mean(x) * mean(y)).alias("vxy"),
    )
    return _lines_of_days(_day_moments(linked, keys).unionByName(gaps), keys)


def _day_moments(samples: DataFrame, keys: Sequence[str]) -> DataFrame:
    us = micros("ts")
    day = F.floor(us / F.lit(_DAY_US)).cast("bigint")
    timed = samples.where(F.col("amplitude").isNotNull()).select(
        *keys, day.alias("_day"), (F.pmod(us, F.lit(_DAY_US)) / F.lit(1e6)).alias("_x"), F.col("amplitude").alias("_y")
    )
    return timed.groupBy(*keys, "_day").agg(
        F.count("_y").alias("n"),
        F.avg("_x").alias("x"),
        F.avg("_y").alias("y"),
        F.var_pop("_x").alias("vx"),
        F.covar_pop("_x", "_y").alias("vxy"),
    )


def _lines_of_days(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    keys = list(keys)
    trace = Window.partitionBy(*keys)
    total = F.sum("n").over(trace)
    placed = days.withColumn("_day0", F.min("_day").over(trace)).withColumn(
        "x", F.col("x") + (F.col("_day") - F.col("_day0")) * F.lit(86_400.0)
    )
    centred = placed.withColumn("_centre", F.sum(F.col("n") * F.col("x")).over(trace) / total).withColumn(
        "_mean", F.sum(F.col("n") * F.col("y")).over(trace) / total
    )
    dx, dy = F.col("x") - F.col("_centre"), F.col("y") - F.col("_mean")
    slope = F.sum(F.col("n") * (F.col("vxy") + dx * dy)) / F.nullif(
        F.sum(F.col("n") * (F.col("vx") + dx * dx)), F.lit(0.0)
    )
    return centred.groupBy(*keys).agg(
        F.first("_day0").alias("_day0"),
        slope.alias("_slope"),
        F.first("_centre").alias("_centre"),
        F.first("_mean").alias("_mean"),
    )


def detrend_linear(
    samples: DataFrame, keys: Sequence[str] = TRACE_KEYS, lines: DataFrame | None = None
) -> DataFrame:
    """Subtract the least-squares line of each trace; the table of lines (one row per trace) is joined back.

    The line absorbs the mean, so a ``demean`` before it does not change the result. Pass ``lines`` (from
    ``trace_lines``, measured and broadcast) to keep a very long trace from being shuffled by its key.
    """
    seconds = (micros("ts") - F.col("_day0") * F.lit(_DAY_US)) / F.lit(1e6)
    # a single instant has no slope: only its mean is removed
    line = F.col("_mean") + F.coalesce(F.col("_slope") * (seconds - F.col("_centre")), F.lit(0.0))
    return (
        same_keys(samples, trace_lines(samples, keys) if lines is None else lines, keys)
        .withColumn("amplitude", F.col("amplitude") - line)
        .drop("_day0", "_slope", "_centre", "_mean")
    )


def usable_traces(samples: DataFrame, minimum_hz: float = NYQUIST_MINIMUM_HZ) -> DataFrame:
    """Drop traces whose Nyquist frequency does not exceed the upper band edge."""
    return samples.where(F.col("sampling_rate") / 2 > minimum_hz)


_PIECE = (
    "n long, whole boolean, forward array<double>, backward array<double>, first_us long, first_rate double, "
    "first_good boolean, last_us long, last_rate double, last_good boolean"
)
# chunks whose pieces are composed in one task
_FAN = 1024


def bandpass(
    samples: DataFrame,
    bands: dict[str, tuple[float, float]] | None = None,
    keys: Sequence[str] = TRACE_KEYS,
    corners: int = 4,
    chunk_seconds: int = 600,
    pad_seconds: int | None = None,
) -> DataFrame:
    """Zero-phase Butterworth band-passes of every trace, one output column per band.

    Second-order sections run forward and then backward over each run of samples: usable values of one rate, one sampling
    interval apart. A gap, a change of the rate, and a value that is NULL or not finite end a run; the filter starts from
    rest behind them. Unusable samples, and those whose rate doesn't reach twice a band's upper edge, are returned with
    NULL in all bands. Samples without ``ts`` are left out.

    Samples are shuffled once, into one row per chunk, which is stored. What a chunk does to the filter's state is an
    affine map of a few numbers (``recursive_filter.Piece``). These are composed over ``_FAN`` chunks each, then over the trace, and
    handed down again, so every chunk knows the exact state that enters it at either end and is filtered on its own; the
    result doesn't depend on ``chunk_seconds``. ``pad_seconds`` has no effect: no padding is needed.

    Default bands: ``amplitude`` 1-16 Hz, ``low`` 1-5.5 Hz, ``high`` 6-16 Hz.
    """
    chosen = dict(bands or {"amplitude": BAND_FULL, "low": BAND_LOW, "high": BAND_HIGH})
    edges = [(float(low), float(high)) for low, high in chosen.values()]
    keys, order, top = list(keys), int(corners), max(high for _, high in edges)
    found_by_workers(samples.sparkSession)
    kinds = dict(samples.select(*keys).dtypes)
    key_schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    us = micros("ts")
    timed = samples.where(F.col("ts").isNotNull()).select(
        *keys,
        F.floor(us / F.lit(chunk_seconds * 1_000_000)).cast("bigint").alias("_chunk"),
        us.alias("_us"),
        F.col("amplitude").cast("double").alias("_x"),
        F.col("sampling_rate").cast("double").alias("_rate"),
    )

    def chunk_row(group):
        us, x, rate = (_numbers(group, c) for c in ("_us", "_x", "_rate"))
        order_of = np.argsort(us, kind="stable")
        us, x, rate = us[order_of].astype(np.int64), x[order_of], rate[order_of]
        piece = recursive_filter.summed_up(us, x, _usable(x, rate, top), rate, edges, order)
        lists = {"_us": pa.array([us]), "_x": pa.array([x]), "_rate": pa.array([rate])}
        return _with_columns(group.slice(0, 1).select([*keys, "_chunk"]), lists | _piece_columns([piece]))

    chunks = stored(
        timed.groupBy(*keys, "_chunk").applyInArrow(
            chunk_row, f"{key_schema}, _chunk long, _us array<long>, _x array<double>, _rate array<double>, {_PIECE}"
        ),
        "chunks",
    )
    states = _entering_states(chunks.drop("_us", "_x", "_rate"), keys, key_schema, edges, order)

    def filter_rows(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                us, x, rate = (row.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("_us", "_x", "_rate"))
                inflow, outflow = (_states(row.column(c), len(edges))[0] for c in ("inflow", "outflow"))
                out = recursive_filter.filtered(us, x, _usable(x, rate, top), rate, inflow, outflow, edges, order)
                again = pa.array(np.zeros(len(us), np.int64))
                found = {k: row.column(k).take(again) for k in keys} | {"_us": pa.array(us), "sampling_rate": pa.array(rate, from_pandas=True)}
                yield pa.record_batch(found | {name: pa.array(y, from_pandas=True) for name, y in zip(chosen, out)})

    columns = ", ".join(f"`{name}` double" for name in chosen)
    return (
        same_keys(chunks.select(*keys, "_chunk", "_us", "_x", "_rate"), states, [*keys, "_chunk"])
        .mapInArrow(filter_rows, f"{key_schema}, _us long, sampling_rate double, {columns}")
        .select(*keys, F.timestamp_micros("_us").alias("ts"), "sampling_rate", *chosen)
    )


def _entering_states(pieces: DataFrame, keys: list[str], key_schema: str, edges: list, order: int) -> DataFrame:
    """``(*keys, _chunk, inflow, outflow)``: up over ``_FAN`` chunks, across each trace, and down again."""
    far = pieces.withColumn("_far", F.floor(F.col("_chunk") / _FAN).cast("bigint"))

    def fold(group):
        group = group.sort_by("_chunk")
        whole = recursive_filter.fold(_pieces(group, len(edges)), edges, order)
        return _with_columns(group.slice(0, 1).select([*keys, "_far"]), _piece_columns([whole]))

    def hand_down(group, by):
        group = group.sort_by(by)
        rest = np.zeros((len(edges), 2 * order))
        inflow = _states(group.column("_inflow"), len(edges))[0] if "_inflow" in group.column_names else rest
        outflow = _states(group.column("_outflow"), len(edges))[0] if "_outflow" in group.column_names else rest
        entering, leaving, _ = recursive_filter.resolve(_pieces(group, len(edges)), inflow, outflow, edges, order)
        lists = {"inflow": pa.array([s.reshape(-1) for s in entering]), "outflow": pa.array([s.reshape(-1) for s in leaving])}
        return _with_columns(group.select([*keys, by]), lists)

    stretches = far.groupBy(*keys, "_far").applyInArrow(fold, f"{key_schema}, _far long, {_PIECE}")
    ends = "inflow array<double>, outflow array<double>"
    outer = stretches.groupBy(*keys).applyInArrow(lambda group: hand_down(group, "_far"), f"{key_schema}, _far long, {ends}")
    outer = outer.withColumnsRenamed({"inflow": "_inflow", "outflow": "_outflow"})
    inner = same_keys(far, outer, [*keys, "_far"]).groupBy(*keys, "_far")
    return inner.applyInArrow(lambda group: hand_down(group, "_chunk"), f"{key_schema}, _chunk long, {ends}")


def _numbers(group: pa.Table, column: str) -> np.ndarray:
    """A column as numbers, NULL as NaN."""
    return group.column(column).to_pandas().to_numpy()


def _usable(x: np.ndarray, rate: np.ndarray, top: float) -> np.ndarray:
    return np.isfinite(x) & np.isfinite(rate) & (rate > 2 * top)


def _with_columns(table: pa.Table, columns: dict) -> pa.Table:
    for name, values in columns.items():
        table = table.append_column(name, values)
    return table


def _states(column, n_bands: int) -> list[np.ndarray]:
    return [np.array(v, float).reshape(n_bands, -1) for v in column.to_pylist()]


def _piece_columns(pieces: list) -> dict:
    ends = {f"{side}_{name}": pa.array([getattr(p, side)[i] for p in pieces]) for side in ("first", "last") for i, name in enumerate(("us", "rate", "good"))}
    return {
        "n": pa.array([p.n for p in pieces], pa.int64()),
        "whole": pa.array([p.whole for p in pieces]),
        "forward": pa.array([p.forward.reshape(-1) for p in pieces]),
        "backward": pa.array([p.backward.reshape(-1) for p in pieces]),
        **ends,
    }


def _pieces(group: pa.Table, n_bands: int) -> list:
    end = lambda r, side: (r[f"{side}_us"], r[f"{side}_rate"], r[f"{side}_good"])
    shaped = lambda v: np.array(v, float).reshape(n_bands, -1)
    rows = group.select(["n", "whole", "forward", "backward", *[f"{s}_{c}" for s in ("first", "last") for c in ("us", "rate", "good")]]).to_pylist()
    return [
        recursive_filter.Piece(r["n"], r["whole"], shaped(r["forward"]), shaped(r["backward"]), end(r, "first"), end(r, "last")) for r in rows
    ]


def trace_quality(samples: DataFrame, keys: Sequence[str] = TRACE_KEYS) -> DataFrame:
    """Per trace: counts and the error flags that make it unusable."""
    return (
        samples.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_samples"),
            F.min("sampling_rate").alias("sampling_rate"),
            F.count_if(is_finite("amplitude")).alias("n_finite"),
            F.min("ts").alias("start_ts"),
            F.max("ts").alias("end_ts"),
        )
        .withColumns(
            {
                "bad_rate": F.coalesce(F.col("sampling_rate") <= 0, F.lit(True)),
                "no_finite_value": F.col("n_finite") == 0,
            }
        )
        .withColumn("failed", F.col("bad_rate") | F.col("no_finite_value"))
    )


def observe_traces(samples: DataFrame, seen: Observation, keys: Sequence[str] = TRACE_KEYS) -> DataFrame:
    """The same samples; whoever reads them learns on the way how many traces and periods there are and how many are sound.

    All metrics are minima and sizes of sets, which a task that runs twice doesn't change. The sets hold a hash per trace.
    """
    trace, sound = F.xxhash64(*keys), is_finite("amplitude")
    return samples.observe(
        seen,
        F.coalesce(F.min(F.coalesce(F.col("sampling_rate"), F.lit(0.0))), F.lit(1.0)).alias("least_rate"),
        F.size(F.collect_set(trace)).alias("traces"),
        F.size(F.collect_set(F.when(sound, trace))).alias("sound_traces"),
        F.size(F.collect_set("period_id")).alias("periods"),
    )


def network_warnings(traces: DataFrame, periods: DataFrame) -> DataFrame:
    """Traces whose network is not the one requested for their period."""
    wanted = periods.select("period_id", F.col("network").alias("expected_network"))
    return traces.join(wanted, "period_id").where(F.col("network") != F.col("expected_network"))


def _expected_stations(periods: DataFrame) -> DataFrame:
    stations = F.col("stations") if dict(periods.dtypes)["stations"] != "string" else F.split("stations", ",")
    return periods.select("period_id", F.explode(stations).alias("station")).where(F.col("station") != "").distinct()


def missing_stations(samples: DataFrame, periods: DataFrame) -> DataFrame:
    """Requested stations without any sample in their period."""
    seen = samples.select("period_id", "station").distinct()
    return _expected_stations(periods).join(seen, ["period_id", "station"], "left_anti")


def station_coverage(samples: DataFrame, periods: DataFrame) -> DataFrame:
    """Per period: requested stations, how many delivered samples, and the ratio."""
    seen = samples.select("period_id", "station").distinct().withColumn("_seen", F.lit(1))
    return (
        _expected_stations(periods)
        .join(seen, ["period_id", "station"], "left")
        .groupBy("period_id")
        .agg(F.count(F.lit(1)).alias("n_expected"), F.count("_seen").alias("n_seen"))
        .withColumn("coverage", F.col("n_seen") / F.col("n_expected"))
    )
