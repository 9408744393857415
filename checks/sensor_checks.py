"""Checks of samples, minutes and rolling features."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from checks import standins as st
from checks.standins import ASSIGNED_SQL, HOURS_SQL, PERIODS_SQL, ROLLED_SQL, SAMPLES_SQL
from checks.support import check, table
from tremorloom.functions.numeric import frequency_index
from tremorloom.operators import features, minutes, signal
from tremorloom.operators.ranking import own_rows
from tremorloom.schemas import CORE_FEATURES, ROLLING_BASE, ROLLING_STATS

SENSOR = "eruption_id:s sensor:s time_min:t"


@check(
    "assign_periods",
    "period_id:s event_id:i",
    f"WITH {ASSIGNED_SQL} SELECT period_id, event_id FROM assigned",
)
def _(spark, sf):
    return st.assigned(spark, sf)


MINUTE_SPEC = (
    "eruption_id:s network:s station:s channel:s time_min:t amplitude_mean:d amplitude_std:d amplitude_max:d "
    "amplitude_min:d amplitude_count:i energy_low_1_5_5:d energy_high_6_16:d frequency_index:d "
    "sampling_rate_source_hz:d filter_full_low_hz:d filter_full_high_hz:d filter_fi_low_min_hz:d "
    "filter_fi_low_max_hz:d filter_fi_high_min_hz:d filter_fi_high_max_hz:d"
)


@check(
    "minute_aggregate",
    MINUTE_SPEC,
    f"WITH {HOURS_SQL} SELECT *, 1.0 AS filter_full_low_hz, 16.0 AS filter_full_high_hz, 1.0 AS filter_fi_low_min_hz, "
    "5.5 AS filter_fi_low_max_hz, 6.0 AS filter_fi_high_min_hz, 16.0 AS filter_fi_high_max_hz FROM hours",
)
def _(spark, sf):
    return minutes.minute_aggregate(st.assigned(spark, sf), st.HOUR)


@check(
    "minute_aggregate_60s",
    "eruption_id:s station:s channel:s time_min:t amplitude_mean:d amplitude_std:d amplitude_count:i",
    f"WITH {ASSIGNED_SQL} SELECT period_id AS eruption_id, station, channel, date_trunc('minute', ts) AS time_min, "
    "avg(amplitude) AS amplitude_mean, stddev_samp(amplitude) AS amplitude_std, count(amplitude) AS amplitude_count "
    "FROM assigned GROUP BY 1, 2, 3, 4",
)
def _(spark, sf):
    return minutes.minute_aggregate(st.assigned(spark, sf))


@check(
    "frequency_index",
    "l_orderkey:i l_linenumber:i frequency_index:d",
    "SELECT l_orderkey, l_linenumber, log10((l_discount + 1e-12) / (l_tax + 1e-12)) AS frequency_index FROM lineitem",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.withColumn("frequency_index", frequency_index("l_tax", "l_discount"))


QUALITY_NULLS = ["amplitude_mean", "amplitude_std", "amplitude_max", "amplitude_min", "amplitude_count",
                 "energy_low_1_5_5", "energy_high_6_16", "frequency_index"]


def _quality_sql() -> str:
    # the sign of one column is turned and rows of busy cells are repeated, so that rules have something to find
    counts = ["8 AS missing_columns", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS empty_table",
              "count(*) FILTER (time_min IS NULL) AS bad_time"]
    counts += [f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in QUALITY_NULLS]
    counts += [
        "count(*) FILTER (amplitude_count <= 0) AS count_not_positive",
        "count(*) FILTER (amplitude_std < 0) AS std_negative",
        "count(*) FILTER (amplitude_min > amplitude_mean OR amplitude_mean > amplitude_max) AS amplitude_order",
        "count(*) FILTER (energy_low_1_5_5 < 0) AS negative_energy_low_1_5_5",
        "count(*) FILTER (energy_high_6_16 < 0) AS negative_energy_high_6_16",
        "count(*) FILTER (isinf(frequency_index)) AS frequency_index_infinite",
        "count(*) - count(DISTINCT (station, channel, time_min)) AS duplicate_sensor_time",
    ]
    names = [c.rsplit(" AS ", 1)[1] for c in counts]
    errors = {"missing_columns", "empty_table", "bad_time", "count_not_positive", "std_negative", "amplitude_order",
              "negative_energy_low_1_5_5", "negative_energy_high_6_16", "frequency_index_infinite", "duplicate_sensor_time"}
    # 20 contract columns, of which the stand-in lacks the six filter columns and adds none that count
    counts[0] = "6 AS missing_columns"
    damaged = (
        "damaged AS (SELECT eruption_id, network, station, channel, time_min, -amplitude_mean AS amplitude_mean, "
        "-amplitude_std AS amplitude_std, amplitude_max, amplitude_min, amplitude_count - 1 AS amplitude_count, "
        "energy_low_1_5_5, -energy_high_6_16 AS energy_high_6_16, frequency_index FROM hours "
        "UNION ALL SELECT eruption_id, network, station, channel, time_min, amplitude_mean, amplitude_std, amplitude_max, "
        "amplitude_min, amplitude_count, energy_low_1_5_5, energy_high_6_16, frequency_index FROM hours WHERE amplitude_count > 1)"
    )
    rows = " UNION ALL ".join(
        f"SELECT eruption_id, '{n}' AS rule, '{'error' if n in errors else 'warning'}' AS severity, {n} AS n_bad FROM c" for n in names
    )
    return f"WITH {HOURS_SQL}, {damaged}, c AS (SELECT eruption_id, {', '.join(counts)} FROM damaged GROUP BY 1) {rows}"


@check("minute_quality", "eruption_id:s rule:s severity:s n_bad:i", _quality_sql())
def _(spark, sf):
    m = minutes.minute_aggregate(st.assigned(spark, sf), st.HOUR).drop(
        "filter_full_low_hz", "filter_full_high_hz", "filter_fi_low_min_hz", "filter_fi_low_max_hz",
        "filter_fi_high_min_hz", "filter_fi_high_max_hz",
    )
    turned = m.withColumns(
        {
            "amplitude_mean": -F.col("amplitude_mean"),
            "amplitude_std": -F.col("amplitude_std"),
            "amplitude_count": F.col("amplitude_count") - 1,
            "energy_high_6_16": -F.col("energy_high_6_16"),
        }
    )
    return minutes.minute_quality(turned.unionByName(m.where("amplitude_count > 1")), by=["eruption_id"])


@check(
    "prepare_minutes",
    "eruption_id:s sensor:s time_min:t amplitude_mean:d amplitude_std:d",
    f"WITH {HOURS_SQL} SELECT eruption_id, sensor, time_min, CASE WHEN amplitude_count > 1 THEN amplitude_mean END AS amplitude_mean, "
    "amplitude_std FROM hours WHERE station <> 'view'",
)
def _(spark, sf):
    m = minutes.minute_aggregate(st.assigned(spark, sf), st.HOUR)
    text = m.select(*[F.col(c).cast("string").alias(c) for c in m.columns])
    broken = text.withColumn("amplitude_mean", F.when(F.col("amplitude_count") == "1", "n/a").otherwise(F.col("amplitude_mean")))
    broken = broken.withColumn("time_min", F.when(F.col("station") == "view", "not a time").otherwise(F.col("time_min")))
    return features.prepare_minutes(broken, strict_time=False)


@check(
    "bad_time_count",
    "n_bad_time:i",
    f"WITH {HOURS_SQL} SELECT count(*) AS n_bad_time FROM hours WHERE station = 'view'",
)
def _(spark, sf):
    m = minutes.minute_aggregate(st.assigned(spark, sf), st.HOUR)
    broken = m.withColumn("time_min", F.when(F.col("station") == "view", "?").otherwise(F.col("time_min").cast("string")))
    return features.bad_time_count(broken)


# --- rolling features -----------------------------------------------------------------------------


@check(
    "direct_features",
    f"{SENSOR} amplitude_range:d amplitude_abs_mean:d",
    f"WITH {HOURS_SQL} SELECT * FROM hours",
)
def _(spark, sf):
    return features.direct_features(st.hours(spark, sf))


MOMENTS = [f"{c}_roll_{s}" for c in ROLLING_BASE for s in ROLLING_STATS if s != "median"]
MEDIANS = [f"{c}_roll_median" for c in ROLLING_BASE]


@check("rolling_stats", SENSOR + "".join(f" {c}:d" for c in MOMENTS), f"WITH {ROLLED_SQL} SELECT * FROM framed")
def _(spark, sf):
    return own_rows(features.rolling_stats(st.frames(spark, sf), 10))


@check("rolling_median", SENSOR + "".join(f" {c}:d" for c in MEDIANS), f"WITH {ROLLED_SQL} SELECT * FROM framed")
def _(spark, sf):
    return own_rows(features.rolling_stats(st.frames(spark, sf), 10))


@check("rolling_entropy", f"{SENSOR} shannon_entropy:d", f"WITH {ROLLED_SQL} SELECT * FROM rolled")
def _(spark, sf):
    return own_rows(features.rolling_shape(st.frames(spark, sf), 10, 20))


@check("rolling_kurtosis", f"{SENSOR} kurtosis:d", f"WITH {ROLLED_SQL} SELECT * FROM rolled")
def _(spark, sf):
    return own_rows(features.rolling_shape(st.frames(spark, sf), 10, 20))


@check("rolling_slope", f"{SENSOR} amplitude_mean_slope:d", f"WITH {ROLLED_SQL} SELECT * FROM rolled")
def _(spark, sf):
    return own_rows(features.rolling_shape(st.frames(spark, sf), 10, 20))


ENVELOPES = "shannon_entropy_env:d kurtosis_env:d amplitude_mean_env:d"


@check("envelopes", f"{SENSOR} {ENVELOPES}", f"WITH {ROLLED_SQL} SELECT * FROM features")
def _(spark, sf):
    return st.sensor_rows(spark, sf)


FEATURE_SPEC = (
    SENSOR
    + "".join(f" {c}:d" for c in MOMENTS + MEDIANS)
    + f" shannon_entropy:d kurtosis:d amplitude_mean_slope:d {ENVELOPES} amplitude_mean:d frequency_index:d"
)


@check("sensor_features", FEATURE_SPEC, f"WITH {ROLLED_SQL} SELECT * FROM features")
def _(spark, sf):
    return st.sensor_rows(spark, sf)


NETWORK_SQL = (
    f"WITH {ROLLED_SQL} SELECT eruption_id, time_min, avg(shannon_entropy) AS network_entropy_mean, "
    "stddev_samp(shannon_entropy) AS network_entropy_std, avg(kurtosis) AS network_kurtosis_mean, "
    "stddev_samp(kurtosis) AS network_kurtosis_std, avg(amplitude_mean_roll_mean) AS network_amplitude_mean, "
    "stddev_samp(amplitude_mean_roll_mean) AS network_amplitude_std FROM features GROUP BY 1, 2"
)


@check(
    "network_stats_full",
    "eruption_id:s time_min:t network_entropy_mean:d network_entropy_std:d network_kurtosis_mean:d "
    "network_kurtosis_std:d network_amplitude_mean:d network_amplitude_std:d",
    NETWORK_SQL,
)
def _(spark, sf):
    return features.network_stats(st.sensor_rows(spark, sf), "full")


CORE_STATS = [(c, s, f) for c in CORE_FEATURES for s, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))]


@check(
    "network_stats_core",
    "eruption_id:s time_min:t" + "".join(f" network_{c}_{s}:d" for c, s, _ in CORE_STATS),
    f"WITH {ROLLED_SQL} SELECT eruption_id, time_min, "
    + ", ".join(f"{f}({c}) AS network_{c}_{s}" for c, s, f in CORE_STATS)
    + " FROM features GROUP BY 1, 2",
)
def _(spark, sf):
    return features.network_stats(st.sensor_rows(spark, sf), "core")


@check(
    "select_core",
    SENSOR + "".join(f" {c}:d" for c in CORE_FEATURES),
    f"WITH {ROLLED_SQL} SELECT * FROM features",
)
def _(spark, sf):
    return features.select_core(st.sensor_rows(spark, sf))


PIVOT_SENSORS = [f"{s}__C{c}" for s in ("click", "error", "purchase", "signup", "view") for c in range(3)]
PIVOT_FEATURES = ["amplitude_mean", "amplitude_std"]


@check(
    "pivot_features",
    "eruption_id:s time_min:t" + "".join(f" {f}__{s}:d" for s in PIVOT_SENSORS for f in PIVOT_FEATURES),
    f"WITH {HOURS_SQL} SELECT eruption_id, time_min, "
    + ", ".join(f"avg({f}) FILTER (sensor = '{s}') AS \"{f}__{s}\"" for s in PIVOT_SENSORS for f in PIVOT_FEATURES)
    + " FROM hours GROUP BY 1, 2",
)
def _(spark, sf):
    return features.pivot_features(st.hours(spark, sf), PIVOT_SENSORS, PIVOT_FEATURES)


# --- signal conditioning --------------------------------------------------------------------------

TRACE = ["network", "station", "channel"]


@check(
    "demean",
    "event_id:i amplitude:d",
    f"WITH {ASSIGNED_SQL} SELECT event_id, amplitude - avg(amplitude) OVER (PARTITION BY period_id, network, station, channel) AS amplitude FROM assigned",
)
def _(spark, sf):
    return signal.demean(st.assigned(spark, sf))


@check(
    "detrend_linear",
    "event_id:i amplitude:d",
    f"WITH {ASSIGNED_SQL}, timed AS (SELECT *, (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY period_id, network, station, channel)) / 1e6 AS x FROM assigned), "
    "lines AS (SELECT period_id, station, channel, regr_slope(amplitude, x) AS a, regr_intercept(amplitude, x) AS b, avg(amplitude) AS m FROM timed GROUP BY 1, 2, 3) "
    "SELECT event_id, amplitude - coalesce(b + a * x, m) AS amplitude FROM timed JOIN lines USING (period_id, station, channel)",
)
def _(spark, sf):
    return signal.detrend_linear(st.assigned(spark, sf))


@check(
    "usable_traces",
    "event_id:i",
    f"WITH {SAMPLES_SQL} SELECT event_id FROM samples WHERE sampling_rate / 2 > 16",
)
def _(spark, sf):
    return signal.usable_traces(st.samples(spark, sf))


@check(
    "trace_quality",
    "period_id:s station:s channel:s n_samples:i n_finite:i sampling_rate:d start_ts:t end_ts:t bad_rate:b no_finite_value:b failed:b",
    f"WITH {ASSIGNED_SQL} SELECT period_id, station, channel, count(*) AS n_samples, "
    "count(*) FILTER (station <> 'view' AND amplitude IS NOT NULL) AS n_finite, min(sampling_rate - 30) AS sampling_rate, min(ts) AS start_ts, max(ts) AS end_ts, "
    "min(sampling_rate - 30) <= 0 AS bad_rate, count(*) FILTER (station <> 'view') = 0 AS no_finite_value, "
    "min(sampling_rate - 30) <= 0 OR count(*) FILTER (station <> 'view') = 0 AS failed FROM assigned GROUP BY 1, 2, 3",
)
def _(spark, sf):
    worse = st.assigned(spark, sf).withColumns(
        {
            "amplitude": F.when(F.col("station") == "view", F.lit(float("nan"))).otherwise(F.col("amplitude")),
            "sampling_rate": F.col("sampling_rate") - 30,
        }
    )
    return signal.trace_quality(worse)


@check(
    "missing_stations",
    "period_id:s station:s",
    f"WITH {ASSIGNED_SQL}, expected AS (SELECT period_id, unnest(string_split(stations, ',')) AS station FROM periods WHERE stations <> '') "
    "SELECT period_id, station FROM expected e WHERE NOT EXISTS (SELECT 1 FROM assigned a WHERE a.period_id = e.period_id AND a.station = e.station)",
)
def _(spark, sf):
    return signal.missing_stations(st.assigned(spark, sf), st.period_table(spark))


@check(
    "network_warnings",
    "period_id:s station:s channel:s network:s expected_network:s",
    f"WITH {ASSIGNED_SQL} SELECT DISTINCT period_id, station, channel, 'X' || station AS network, 'EV' AS expected_network FROM assigned",
)
def _(spark, sf):
    other = st.assigned(spark, sf).withColumn("network", F.concat(F.lit("X"), F.col("station")))
    return signal.network_warnings(signal.trace_quality(other), st.period_table(spark))


@check(
    "station_coverage",
    "period_id:s n_expected:i n_seen:i coverage:d",
    f"WITH {ASSIGNED_SQL}, expected AS (SELECT period_id, unnest(string_split(stations, ',')) AS station FROM periods WHERE stations <> ''), "
    "seen AS (SELECT DISTINCT period_id, station FROM assigned) "
    "SELECT e.period_id, count(*) AS n_expected, count(s.station) AS n_seen, count(s.station) / count(*) AS coverage "
    "FROM expected e LEFT JOIN seen s ON s.period_id = e.period_id AND s.station = e.station GROUP BY 1",
)
def _(spark, sf):
    return signal.station_coverage(st.assigned(spark, sf), st.period_table(spark))


# hourly counts of each station are a regular series with gaps
@check(
    "interpolate_gaps",
    "station:s ts:t amplitude:d filled:b",
    f"WITH {ASSIGNED_SQL}, hourly AS (SELECT station, channel, date_trunc('hour', ts) AS ts, max(amplitude) AS amplitude FROM assigned GROUP BY 1, 2, 3), "
    "linked AS (SELECT *, lead(ts) OVER w AS t2, lead(amplitude) OVER w AS a2 FROM hourly WINDOW w AS (PARTITION BY station, channel ORDER BY ts)), "
    "counted AS (SELECT *, CAST(round((epoch_us(t2) - epoch_us(ts)) / 3.6e9) AS BIGINT) - 1 AS missing FROM linked) "
    "SELECT station || channel AS station, ts, amplitude, false AS filled FROM counted UNION ALL "
    "SELECT station || channel, ts + to_hours(CAST(i AS INT)), amplitude + (a2 - amplitude) * (i / (missing + 1)), true FROM ("
    "SELECT *, unnest(range(1, missing + 1)) AS i FROM counted WHERE missing > 0)",
)
def _(spark, sf):
    hourly = st.assigned(spark, sf).withColumn("ts", F.date_trunc("hour", "ts")).withColumn(
        "sampling_rate", F.lit(1 / 3600.0)
    ).withColumn("period_id", F.lit("all"))
    merged = signal.merge_segments(hourly)
    filled = signal.interpolate_gaps(merged, bucket_seconds=6 * 3600)
    return filled.withColumn("station", F.concat("station", "channel"))


@check(
    "merge_segments",
    "period_id:s station:s channel:s ts:t amplitude:d",
    f"WITH {ASSIGNED_SQL} SELECT period_id, station, channel, date_trunc('hour', ts) AS ts, arg_max(amplitude, event_id) AS amplitude FROM assigned GROUP BY 1, 2, 3, 4",
)
def _(spark, sf):
    hourly = st.assigned(spark, sf).withColumn("ts", F.date_trunc("hour", "ts"))
    return signal.merge_segments(hourly, "event_id")


BANDS_PER_DAY = {"amplitude": (1.0, 5.5), "low": (1.0, 3.0), "high": (3.0, 5.5)}
RATE_CHANGE = "2024-01-18 00:00:00"


def _section_rows() -> str:
    """``(per_day, band, g1, a11, a12, g2, ...)``: the filter's sections, from its polynomials."""
    rows = []
    for per_day in (24, 12):
        for name, (low, high) in BANDS_PER_DAY.items():
            w = 2 * per_day * np.tan(np.pi * np.array([low, high]) / per_day)
            half = np.exp(1j * np.pi * (2 * np.arange(4) + 5) / 8) * (w[1] - w[0]) / 2
            poles = np.concatenate([half + np.sqrt(half**2 - w[0] * w[1]), half - np.sqrt(half**2 - w[0] * w[1])])
            gain = np.real(((w[1] - w[0]) * 2 * per_day) ** 4 / np.prod(2 * per_day - poles))
            digital = (2 * per_day + poles) / (2 * per_day - poles)
            one = [gain**0.25 * np.sign(gain)] + [gain**0.25] * 3
            sections = [(g, -2 * p.real, abs(p) ** 2) for g, p in zip(one, digital[digital.imag > 0])]
            rows.append(f"({per_day}, '{name}', " + ", ".join(f"{float(v)!r}::DOUBLE" for s in sections for v in s) + ")")
    return ", ".join(rows)


def _pass_sql(name: str, source: str, value: str, nth: str) -> str:
    """A recursive filter over ``source``: one row of each run and band a step, four sections in direct form."""
    states = [f"z{k}{j}" for k in range(1, 5) for j in (1, 2)]
    steps = ", ".join(
        f"g{k} * u{k - 1} + z{k}1 AS u{k}, z{k}2 - a{k}1 * u{k} AS n{k}1, -g{k} * u{k - 1} - a{k}2 * u{k} AS n{k}2" for k in range(1, 5)
    )
    return (
        f"{name} AS (SELECT DISTINCT rid, bands.band, 0::BIGINT AS i, 0.0::DOUBLE AS y, {', '.join(f'0.0::DOUBLE AS {z}' for z in states)} "
        f"FROM {source}, (SELECT DISTINCT band AS band FROM sections) AS bands UNION ALL "
        f"SELECT rid, band, i, u4 AS y, {', '.join(z.replace('z', 'n') for z in states)} FROM (SELECT p.rid, p.band, p.i + 1 AS i, s.{value} AS u0, {steps} "
        f"FROM {name} AS p JOIN {source} AS s ON s.rid = p.rid AND s.{nth} = p.i + 1{' AND s.band = p.band' if source != 'numbered' else ''} "
        "JOIN sections AS c ON c.per_day = s.per_day AND c.band = p.band))"
    )


def _bandpass_sql() -> str:
    same = "PARTITION BY period_id, station, channel ORDER BY ts"
    late = f"ts >= TIMESTAMP '{RATE_CHANGE}'"
    columns = ", ".join(f"g{k}, a{k}1, a{k}2" for k in range(1, 5))
    return (
        f"WITH RECURSIVE {ASSIGNED_SQL}, sections(per_day, band, {columns}) AS (VALUES {_section_rows()}), "
        f"binned AS (SELECT period_id, station, channel, CASE WHEN {late} THEN time_bucket(INTERVAL '2 hours', ts) ELSE date_trunc('hour', ts) END AS ts, "
        f"CASE WHEN {late} THEN 12 ELSE 24 END AS per_day, amplitude FROM assigned), "
        "series AS (SELECT period_id, station, channel, ts, per_day, CASE WHEN hour(ts) = 4 AND day(ts) % 3 = 0 THEN NULL ELSE max(amplitude) END AS x "
        "FROM binned GROUP BY period_id, station, channel, ts, per_day), "
        f"marked AS (SELECT *, CASE WHEN lag(x) OVER ({same}) IS NOT NULL AND lag(per_day) OVER ({same}) = per_day "
        f"AND epoch_us(ts) - epoch_us(lag(ts) OVER ({same})) = 86400000000 // per_day THEN 0 ELSE 1 END AS head FROM series), "
        f"islands AS (SELECT *, sum(head) OVER ({same} ROWS UNBOUNDED PRECEDING) AS run FROM marked), "
        "numbered AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY period_id, station, channel, run) AS rid, "
        "row_number() OVER (PARTITION BY period_id, station, channel, run ORDER BY ts) AS i, "
        "row_number() OVER (PARTITION BY period_id, station, channel, run ORDER BY ts DESC) AS j FROM islands WHERE x IS NOT NULL), "
        f"{_pass_sql('forward', 'numbered', 'x', 'i')}, "
        "once AS MATERIALIZED (SELECT n.rid, n.j, n.per_day, f.band, f.y FROM forward AS f JOIN numbered AS n USING (rid, i)), "
        f"{_pass_sql('backward', 'once', 'y', 'j')}, "
        "done AS (SELECT n.period_id, n.station, n.channel, n.ts, b.band, b.y FROM backward AS b JOIN numbered AS n ON n.rid = b.rid AND n.j = b.i) "
        "SELECT s.period_id, s.station, s.channel, s.ts, "
        + ", ".join(f"round(max(y) FILTER (band = '{name}'), 4) AS {name}" for name in BANDS_PER_DAY)
        + " FROM series AS s LEFT JOIN done AS d USING (period_id, station, channel, ts) GROUP BY 1, 2, 3, 4"
    )


@check("bandpass", "period_id:s station:s channel:s ts:t amplitude:d low:d high:d", _bandpass_sql())
def _(spark, sf):
    """Hourly and, from a day on, two-hourly series with gaps and NULLs, filtered with bands in cycles per day."""
    day = 86400.0
    late = F.col("ts") >= F.lit(RATE_CHANGE).cast("timestamp")
    coarse = F.timestamp_seconds((F.floor(F.unix_timestamp("ts") / 7200) * 7200).cast("bigint"))
    binned = st.assigned(spark, sf).withColumns(
        {"sampling_rate": F.when(late, 12 / day).otherwise(24 / day), "ts": F.when(late, coarse).otherwise(F.date_trunc("hour", "ts"))}
    )
    merged = signal.merge_segments(binned)
    silent = (F.hour("ts") == 4) & (F.dayofmonth("ts") % 3 == 0)
    holed = merged.withColumn("amplitude", F.when(~silent, F.col("amplitude")))
    bands = {name: (low / day, high / day) for name, (low, high) in BANDS_PER_DAY.items()}
    found = signal.bandpass(holed, bands, chunk_seconds=17 * 3600)
    return found.withColumns({name: F.round(name, 4) for name in bands})
