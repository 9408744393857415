"""Checks of what is published: incremental minutes, audited minutes, extraction reports, batches of predictions."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import standins as st
from checks.record_checks import PROBS_SQL, _now, _stamped
from checks.sensor_checks import MINUTE_SPEC
from checks.standins import ASSIGNED_SQL, HOURS_SQL
from checks.support import check, scratch, table
from tremorloom.operators import decision, features, minutes, periods, sequences, signal
from tremorloom.plans import incremental, jobs
from tremorloom.sources import inputs, predictions, tables
from tremorloom.sources.snapshots import Snapshots


def named_files(df, folder: str, stem: str, n: int) -> None:
    """``<folder>/<stem>-<i>.parquet``, ``n`` files, replacing files of these names."""
    spark, draft = df.sparkSession, f"{folder}-drafts/{uuid.uuid4().hex}"
    df.repartition(n, "event_id").write.option("maxRecordsPerFile", 0).parquet(draft)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    parts = sorted(f.getPath().toString() for f in files.listStatus(path(draft)) if f.getPath().getName().startswith("part-"))
    for i, part in enumerate(parts):
        target = path(f"{folder}/{stem}-{i}.parquet")
        files.delete(target, False)
        files.rename(path(part), target)


FIXED = ", 1.0 AS filter_full_low_hz, 16.0 AS filter_full_high_hz, 1.0 AS filter_fi_low_min_hz, 5.5 AS filter_fi_low_max_hz, 6.0 AS filter_fi_high_min_hz, 16.0 AS filter_fi_high_max_hz"


@check("incremental_minutes", MINUTE_SPEC, f"WITH {HOURS_SQL} SELECT *{FIXED} FROM hours")
def _(spark, sf):
    """Three rounds: the newest files first, then the others, one of them wrong, then that one again as it should be."""
    samples, root = st.assigned(spark, sf), scratch(spark)
    third = lambda i: samples.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == i)
    read = incremental.samples_of(spark, samples.schema)
    store = incremental.MinuteStore(spark, f"{root}/store", read, st.HOUR)
    arrive = lambda batch: store.integrate(batch, inputs.list_files(spark, f"{root}/files"), _now())
    named_files(third(2), f"{root}/files", "c", 2)
    arrive("first")
    named_files(third(0), f"{root}/files", "a", 2)
    moved = third(1).withColumns({"ts": F.col("ts") - F.expr("INTERVAL 20 DAYS"), "amplitude": -F.col("amplitude")})
    named_files(moved, f"{root}/files", "b", 2)
    arrive("second")
    named_files(third(1), f"{root}/files", "b", 2)
    arrive("third")
    arrive("third")
    return store.minutes()


@check("minute_states", MINUTE_SPEC, f"WITH {HOURS_SQL} SELECT *{FIXED} FROM hours")
def _(spark, sf):
    samples = st.assigned(spark, sf).withColumn("part", F.pmod(F.col("event_id"), F.lit(5)))
    return minutes.merged_minutes(minutes.minute_states(samples, st.HOUR, ["part"]))


@check("published_minutes", MINUTE_SPEC, f"WITH {HOURS_SQL} SELECT *{FIXED} FROM hours")
def _(spark, sf):
    """A batch that fails its audit in between stays unseen."""
    root = scratch(spark)
    made = lambda: minutes.minute_aggregate(st.assigned(spark, sf), st.HOUR)
    jobs.publish_audited(made, spark, root, "good", files_per_period=2)
    try:
        jobs.publish_audited(lambda: made().withColumn("amplitude_count", -F.col("amplitude_count")), spark, root, "bad")
    except periods.ContractViolation:
        return jobs.published_minutes(spark, root)
    raise AssertionError("the audit let a broken table through")


@check(
    "extraction_report",
    "severity:s period_id:s rule:s detail:s",
    f"WITH {ASSIGNED_SQL}, worse AS (SELECT *, CASE WHEN station = 'view' THEN NULL ELSE amplitude END AS value, sampling_rate - 30 AS rate FROM assigned), "
    "traces AS (SELECT period_id, network || '.' || station || '.' || channel AS trace, station, count(value) AS finite, min(rate) AS rate FROM worse GROUP BY 1, 2, 3) "
    "SELECT 'error' AS severity, period_id, 'no_finite_value' AS rule, trace AS detail FROM traces WHERE finite = 0 "
    "UNION ALL SELECT 'error', period_id, 'bad_rate', trace FROM traces WHERE rate <= 0 "
    "UNION ALL SELECT 'error', 'P5', 'no_samples', '' "
    "UNION ALL SELECT 'error', 'P6', 'end_not_after_start', '2031-01-01T00:00:00Z' UNION ALL SELECT 'error', 'P6', 'no_samples', '' "
    "UNION ALL SELECT 'warning', period_id, 'missing_station', station FROM (SELECT period_id, unnest(string_split(stations, ',')) AS station "
    "FROM periods WHERE stations <> '') AS e WHERE NOT EXISTS (SELECT 1 FROM traces t WHERE t.period_id = e.period_id AND t.station = e.station)",
)
def _(spark, sf):
    """Traces without a value or a sound rate, a period that nothing falls into, one that ends before it starts."""
    rows = st.period_rows(spark)
    more = [
        ("P5", "calm", "2030-01-01T00:00:00Z", "2030-01-02T00:00:00Z", "", "", "", "EV", "", ""),
        ("P6", "calm", "2031-01-02T00:00:00Z", "2031-01-01T00:00:00Z", "", "", "", "EV", "", ""),
    ]
    table = periods.tidy_periods(rows.unionByName(spark.createDataFrame(more, rows.schema)))
    worse = st.samples(spark, sf).withColumns(
        {
            "amplitude": F.when(F.col("station") == "view", F.lit(float("nan"))).otherwise(F.col("amplitude")),
            "sampling_rate": F.col("sampling_rate") - 30,
        }
    )
    return jobs.extraction_report(worse, table)


BATCHES = 3


@check(
    "publish_batches",
    "kind:s run_id:s vec_id:i n:i",
    f"WITH {PROBS_SQL} SELECT 'history' AS kind, 'run-' || label AS run_id, vec_id, 1 AS n FROM classes "
    "UNION ALL SELECT 'latest', 'run-' || label, max(vec_id), 1 FROM classes GROUP BY label",
)
def _(spark, sf):
    """Three batches, one of them twice, one after a run that died before its marker: history and latest hold each row once."""
    root, all_rows = scratch(spark), _stamped(spark, sf)
    keys, tie = ["run_id"], "vec_id"
    for i in range(BATCHES):
        batch = all_rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(BATCHES)) == i)
        _dies(lambda: predictions.publish_batch(batch, root, f"batch-{i}", keys, tie, _now()), i == 1)
        predictions.publish_batch(batch, root, f"batch-{i}", keys, tie, _now())
        predictions.publish_batch(batch, root, "batch-0", keys, tie, _now())
    schema = "run_id string, created_at timestamp, vec_id long, payload string"
    history = predictions.read_history(spark, root, schema).withColumn("kind", F.lit("history"))
    latest = predictions.read_latest(spark, root, schema).withColumn("kind", F.lit("latest"))
    both = history.select("kind", "run_id", "vec_id").unionByName(latest.select("kind", "run_id", "vec_id"))
    return both.groupBy("kind", "run_id", "vec_id").agg(F.count("*").alias("n"))


def _dies(publish, really: bool) -> None:
    """Run a publication that ends after its tables are written, before the marker."""
    if not really:
        return
    marker, Snapshots.mark = Snapshots.mark, _stop
    try:
        publish()
    except InterruptedError:
        pass
    finally:
        Snapshots.mark = marker


def _stop(*_):
    raise InterruptedError


@check(
    "read_minutes_mixed_csv",
    "eruption_id:s sensor:s time_min:t amplitude_mean:d amplitude_std:d amplitude_count:i rate:d",
    f"WITH {HOURS_SQL} SELECT *, CASE WHEN amplitude_count % 3 <> 2 THEN sampling_rate_source_hz END AS rate FROM hours",
)
def _(spark, sf):
    """Three kinds of files: contract order, reversed order, and without one column."""
    root = scratch(spark)
    made = minutes.minute_aggregate(st.assigned(spark, sf), st.HOUR)
    kinds = [made.columns, made.columns[::-1], [c for c in made.columns if c != "sampling_rate_source_hz"]]
    for i, columns in enumerate(kinds):
        made.where(F.col("amplitude_count") % 3 == i).select(*columns).write.csv(f"{root}/{i}", header=True)
    found = tables.read_minutes(spark, [f"{root}/{i}" for i in range(3)], merge_headers=True)
    prepared = features.prepare_minutes(found)
    return prepared.withColumn("rate", F.col("sampling_rate_source_hz").cast("double"))


@check(
    "periods_order",
    "period_id:s period_ord:i",
    "SELECT o_orderkey::VARCHAR AS period_id, row_number() OVER (ORDER BY o_orderkey) AS period_ord FROM orders",
)
def _(spark, sf):
    """A period file in many parts and splits: rows are numbered as they stand."""
    folder = f"{scratch(spark)}/periods"
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderkey").cast("string").alias("period_id"), "o_orderstatus")
    rows.repartitionByRange(7, "key").sortWithinPartitions("key").drop("key").write.csv(folder, header=True, sep=";")
    return tables.read_periods_csv(spark, folder)


@check(
    "minute_file_order",
    "eruption_id:s n:i n_unsorted:i n_overlaps:i",
    f"WITH {HOURS_SQL} SELECT eruption_id, count(*) AS n, 0 AS n_unsorted, 0 AS n_overlaps FROM hours GROUP BY 1",
)
def _(spark, sf):
    """Written minutes: rows of a file ascend, files of a period don't overlap."""
    folder = f"{scratch(spark)}/minutes"
    tables.write_minutes(minutes.minute_aggregate(st.assigned(spark, sf), st.HOUR), folder)
    key = F.struct("station", "channel", "time_min")
    rows = spark.read.parquet(folder).select(
        "eruption_id", key.alias("key"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    by_file = rows.withColumn("late", F.coalesce(before > F.col("key"), F.lit(False))).groupBy("eruption_id", "file").agg(
        F.count("*").alias("n"), F.count_if("late").alias("n_unsorted"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    upto = F.max("high").over(Window.partitionBy("eruption_id").orderBy("low").rowsBetween(Window.unboundedPreceding, -1))
    overlaps = by_file.withColumn("overlap", F.coalesce(upto >= F.col("low"), F.lit(False)))
    return overlaps.groupBy("eruption_id").agg(
        F.sum("n").alias("n"), F.sum("n_unsorted").alias("n_unsorted"), F.count_if("overlap").alias("n_overlaps")
    )


@check(
    "empty_splits",
    "split:s",
    "SELECT split FROM (VALUES ('train'), ('val'), ('test')) AS required(split) WHERE split NOT IN "
    "(SELECT CASE o_orderstatus WHEN 'F' THEN 'train' WHEN 'O' THEN 'val' ELSE 'extra' END FROM orders)",
)
def _(spark, sf):
    status = F.col("o_orderstatus")
    split = F.when(status == "F", "train").when(status == "O", "val").otherwise("extra")
    return sequences.empty_splits(table(spark, sf, "orders").select(split.alias("split")))


@check(
    "linked_trace_lines",
    "period_id:s station:s channel:s slope:d mean:d",
    f"WITH {ASSIGNED_SQL}, hourly AS (SELECT period_id, station, channel, date_trunc('hour', ts) AS ts, max(amplitude) AS y FROM assigned GROUP BY ALL), "
    "linked AS (SELECT *, lead(ts) OVER w AS t2, lead(y) OVER w AS y2 FROM hourly WINDOW w AS (PARTITION BY period_id, station, channel ORDER BY ts)), "
    "counted AS (SELECT *, coalesce(CAST(round((epoch_us(t2) - epoch_us(ts)) / 3.6e9) AS BIGINT) - 1, 0) AS missing FROM linked), "
    "filled AS (SELECT period_id, station, channel, epoch(ts) / 3600 + i AS h, y + coalesce((y2 - y) * (i / (missing + 1)), 0) AS y FROM "
    "(SELECT *, unnest(range(0, missing + 1)) AS i FROM counted)), "
    "centred AS (SELECT *, h - avg(h) OVER (PARTITION BY period_id, station, channel) AS x FROM filled) "
    "SELECT period_id, station, channel, round(regr_slope(y, x), 6) AS slope, round(avg(y), 6) AS mean FROM centred GROUP BY ALL",
)
def _(spark, sf):
    """Lines of gap-filled hourly traces, gaps as closed forms."""
    hourly = st.assigned(spark, sf).withColumns({"ts": F.date_trunc("hour", "ts"), "sampling_rate": F.lit(1 / 3600.0)})
    lines = signal.linked_trace_lines(signal.link_gaps(hourly, bucket_seconds=6 * 3600))
    return lines.select("period_id", "station", "channel", F.round(F.col("_slope") * 3600, 6).alias("slope"), F.round("_mean", 6).alias("mean"))


@check(
    "audit_rows_whole",
    "doc_id:i kind:s name:s value:d text:s",
    "SELECT doc_id, 'metric' AS kind, 'n_chars' AS name, n_chars::DOUBLE AS value, NULL AS text FROM documents WHERE n_chars IS NOT NULL "
    "UNION ALL SELECT doc_id, 'tag', 'text', NULL, text FROM documents WHERE text <> '' AND text <> 'None' "
    "UNION ALL SELECT doc_id, 'param', 'lang', NULL, lang FROM documents WHERE lang IS NOT NULL",
)
def _(spark, sf):
    return decision.audit_rows(table(spark, sf, "documents"), "doc_id", ["n_chars"], [], ["text"], ["lang"])
