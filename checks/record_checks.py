"""Checks of period rules, inputs, manifest, publication, decisions and time helpers."""

from __future__ import annotations


from pyspark.sql import functions as F

from checks import standins as st
from checks.model_checks import PROBS_SQL, predictions
from checks.support import check, scratch, table
from tremorloom.functions import times
from tremorloom.functions.jsonpaths import first_number, first_string
from tremorloom.functions.labels import infer_period_type, lookup_period_type, normalize_period_type
from tremorloom.operators import decision, periods
from tremorloom.sources import inputs, manifest, predictions as published, tables

# --- periods: every order describes one ---------------------------------------------------------------

KIND_SQL = "CASE o_orderpriority WHEN '1-URGENT' THEN ' Event ' WHEN '2-HIGH' THEN 'CALME' WHEN '3-MEDIUM' THEN 'prediction' WHEN '4-NOT SPECIFIED' THEN 'quiet' ELSE 'bogus' END"
TYPE_SQL = "CASE o_orderpriority WHEN '1-URGENT' THEN 'eruption' WHEN '2-HIGH' THEN 'quiet' WHEN '3-MEDIUM' THEN 'inference' WHEN '4-NOT SPECIFIED' THEN 'quiet' END"


def _kind():
    p = F.col("o_orderpriority")
    return (
        F.when(p == "1-URGENT", " Event ").when(p == "2-HIGH", "CALME").when(p == "3-MEDIUM", "prediction")
        .when(p == "4-NOT SPECIFIED", "quiet").otherwise("bogus")
    )


def order_periods(spark, sf):
    o = table(spark, sf, "orders")
    iso = lambda ts: F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    start = F.col("o_orderdate")
    # cheap orders end before they start; ids are customers and therefore repeat
    end = F.when(F.col("o_totalprice") < 50000, start - F.expr("INTERVAL 1 DAY")).otherwise(start + F.expr("INTERVAL 3 DAYS"))
    return o.select(
        F.col("o_custkey").cast("string").alias("period_id"),
        _kind().alias("period_type"),
        F.when(F.col("o_orderstatus") == "P", F.lit("soon")).otherwise(iso(start)).alias("period_start_utc"),
        iso(end).alias("period_end_utc"),
        F.when(F.col("o_totalprice") > 200000, iso(start + F.expr("INTERVAL 2 DAYS"))).otherwise(F.lit("")).alias("eruption_start_utc"),
        F.when(F.col("o_totalprice") > 400000, iso(start)).otherwise(F.lit("")).alias("eruption_end_utc"),
        F.when(F.col("o_orderstatus") == "F", "train").when(F.col("o_orderstatus") == "O", " val ").otherwise("extra").alias("split"),
        F.lit("EV").alias("network"),
        F.lit("a,b").alias("stations"),
        F.lit("c").alias("channels"),
        "o_orderkey",
    )


@check(
    "normalize_period_type",
    "o_orderkey:i period_type:s",
    f"SELECT o_orderkey, coalesce({TYPE_SQL}, 'inference') AS period_type FROM orders",
)
def _(spark, sf):
    rows = order_periods(spark, sf).replace("bogus", "Predict", ["period_type"])
    return rows.withColumn("period_type", normalize_period_type("period_type"))


@check("lookup_period_type", "o_orderkey:i period_type:s", f"SELECT o_orderkey, {TYPE_SQL} AS period_type FROM orders")
def _(spark, sf):
    return order_periods(spark, sf).withColumn("period_type", lookup_period_type("period_type"))


@check(
    "infer_period_type",
    "o_orderkey:i period_type:s",
    "SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'eruption' WHEN o_orderpriority = '2-HIGH' THEN 'quiet' WHEN o_orderstatus = 'F' THEN 'quiet' ELSE 'eruption' END AS period_type FROM orders",
)
def _(spark, sf):
    o = table(spark, sf, "orders")
    given = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), _kind())
    pid = F.concat(F.when(F.col("o_orderstatus") == "F", F.lit(" Quiet_")).otherwise(F.lit("run_")), F.col("o_orderkey").cast("string"))
    return o.withColumn("period_type", infer_period_type(pid, given))


@check(
    "validate_periods",
    "period_id:s rule:s detail:s",
    f"WITH o AS (SELECT o_custkey::VARCHAR AS period_id, trim({KIND_SQL}) AS kind, {TYPE_SQL} AS t, o_orderstatus = 'P' AS bad, o_totalprice AS v, o_orderdate AS d FROM orders), "
    "f AS (SELECT *, strftime(CASE WHEN v < 50000 THEN d - INTERVAL 1 DAY ELSE d + INTERVAL 3 DAY END, '%Y-%m-%dT%H:%M:%SZ') AS e, strftime(d, '%Y-%m-%dT%H:%M:%SZ') AS s FROM o) "
    "SELECT period_id, 'unknown_period_type' AS rule, kind AS detail FROM f WHERE t IS NULL UNION ALL "
    "SELECT period_id, 'bad_period_start', 'soon' FROM f WHERE bad UNION ALL "
    "SELECT period_id, 'end_not_after_start', e FROM f WHERE NOT bad AND v < 50000 UNION ALL "
    "SELECT period_id, 'event_end_before_start', s FROM f WHERE v > 400000 UNION ALL "
    "SELECT period_id, 'duplicate_period_id', count(*)::VARCHAR FROM f GROUP BY 1 HAVING count(*) > 1",
)
def _(spark, sf):
    return periods.validate_periods(periods.tidy_periods(order_periods(spark, sf)))


@check(
    "mode_violations",
    "period_id:s rule:s",
    f"WITH o AS (SELECT o_custkey::VARCHAR AS period_id, {TYPE_SQL} AS t, o_orderstatus AS st, o_totalprice AS v FROM orders) "
    "SELECT period_id, 'unknown_period_type' AS rule FROM o WHERE t IS NULL UNION ALL SELECT period_id, 'inference_in_training' FROM o WHERE t = 'inference' UNION ALL "
    "SELECT period_id, 'event_start_missing' FROM o WHERE t = 'eruption' AND v <= 200000 UNION ALL SELECT period_id, 'invalid_split' FROM o WHERE st = 'P'",
)
def _(spark, sf):
    return periods.mode_violations(periods.tidy_periods(order_periods(spark, sf)), "training", manual_split=True)


@check(
    "select_periods",
    "period_id:s period_type:s event:t n_stations:i",
    "SELECT o_custkey::VARCHAR AS period_id, CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 200000 THEN 'eruption' ELSE 'quiet' END AS period_type, CASE WHEN o_totalprice > 200000 THEN o_orderdate + INTERVAL 2 DAY END AS event, 2 AS n_stations "
    "FROM orders WHERE o_orderpriority <> '3-MEDIUM'",
)
def _(spark, sf):
    # unknown kinds and undated events become quiet periods; those of inference are dropped by the operator
    unusable = "period_type = 'bogus' OR (period_type = ' Event ' AND eruption_start_utc = '')"
    sound = order_periods(spark, sf).withColumn("period_type", F.when(F.expr(unusable), "quiet").otherwise(F.col("period_type")))
    chosen = periods.select_periods(periods.tidy_periods(sound), "training", drop_inference=True)
    return chosen.select("period_id", "period_type", F.col("eruption_start_utc").alias("event"), F.size("stations").alias("n_stations"))


# --- inputs -------------------------------------------------------------------------------------------

SUFFIX = "_filtered_1_16Hz_aggregated_1min_with_fi.csv"
INPUT_SQL = (
    "p AS (SELECT o_orderkey::VARCHAR AS period_id, CASE WHEN o_orderpriority = '1-URGENT' THEN '/explicit/' || o_orderkey || '.csv' "
    f"ELSE '/in/' || o_orderkey || '{SUFFIX}' END AS input_path FROM orders), "
    f"files AS (SELECT DISTINCT CASE WHEN l_returnflag = 'A' THEN '/explicit/' || l_orderkey || '.csv' ELSE '/in/' || l_orderkey || '{SUFFIX}' END AS path FROM lineitem)"
)


def _input_tables(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    key, line = F.col("o_orderkey").cast("string"), F.col("l_orderkey").cast("string")
    p = o.select(
        key.alias("period_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("/explicit/"), key, F.lit(".csv"))).otherwise(F.lit("")).alias("csv_path"),
    )
    files = li.select(
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("/explicit/"), line, F.lit(".csv")))
        .otherwise(F.concat(F.lit("/in/"), line, F.lit(SUFFIX))).alias("path")
    )
    return p, files


@check(
    "resolve_inputs",
    "period_id:s input_path:s found:b",
    f"WITH {INPUT_SQL} SELECT period_id, input_path, files.path IS NOT NULL AS found FROM p LEFT JOIN files ON files.path = p.input_path",
)
def _(spark, sf):
    p, files = _input_tables(spark, sf)
    return inputs.resolve_inputs(p, files, "/in/")


@check(
    "missing_inputs",
    "period_id:s input_path:s",
    f"WITH {INPUT_SQL} SELECT period_id, input_path FROM p WHERE input_path NOT IN (SELECT path FROM files)",
)
def _(spark, sf):
    p, files = _input_tables(spark, sf)
    return inputs.missing_inputs(p, files, "/in/")


@check(
    "resolve_uris",
    "o_orderkey:i input_uri:s uri_problem:s",
    "WITH b AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'rowb' END AS rb FROM orders) SELECT o_orderkey, CASE o_orderpriority "
    "WHEN '1-URGENT' THEN CASE WHEN o_totalprice > 200000 THEN 's3a://full/' || o_orderkey || '.csv' ELSE NULL END "
    "WHEN '2-HIGH' THEN 's3a://path/' || o_orderkey || '.csv' WHEN '3-MEDIUM' THEN 's3a://' || rb || '/keys/' || o_orderkey || '.csv' "
    "WHEN '4-NOT SPECIFIED' THEN 's3a://' || rb || '/pre/' || o_orderkey || '.csv' END AS input_uri, "
    "CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice <= 200000 THEN 'blank_s3_csv_path' "
    "WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') AND rb IS NULL THEN 'no_bucket' WHEN o_orderpriority = '5-LOW' THEN 'no_path' END AS uri_problem FROM b",
)
def _(spark, sf):
    p, k = F.col("o_orderpriority"), F.col("o_orderkey").cast("string")
    name = F.concat(k, F.lit(".csv"))
    rows = table(spark, sf, "orders").withColumns(
        {
            "s3_csv_path": F.when(p == "1-URGENT", F.when(F.col("o_totalprice") > 200000, F.concat(F.lit("s3://full/"), name)).otherwise(F.lit(" "))),
            "csv_path": F.when(p == "2-HIGH", F.concat(F.lit("s3://path/"), name)).when(p == "4-NOT SPECIFIED", F.concat(F.lit("/data/x/"), name)),
            "s3_csv_key": F.when(p == "3-MEDIUM", F.concat(F.lit("keys/"), name)),
            "s3_bucket": F.when(F.col("o_orderstatus") == "F", F.lit("rowb")),
        }
    )
    return inputs.resolve_uris(rows, prefix="pre/")


# --- manifest: orders as files, unfinished ones not seen before ------------------------------------------

NOW = "2026-06-17 06:30:00"
MANIFEST_SQL = (
    "listing AS (SELECT 'ready/' || o_orderkey AS path, '/data/ready/' || o_orderkey AS absolute_path, CAST(round(o_totalprice * 100) AS BIGINT) AS size_bytes, "
    "epoch_us(o_orderdate) * 1000 AS mtime_ns FROM orders WHERE o_orderstatus <> 'O' OR o_totalprice > 100000), "
    "mani AS (SELECT 'ready/' || o_orderkey AS path, CASE WHEN o_orderpriority = '3-MEDIUM' THEN '/old/' ELSE '/data/ready/' END || o_orderkey AS absolute_path, "
    "CAST(round(o_totalprice * 100) AS BIGINT) + CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS size_bytes, epoch_us(o_orderdate) * 1000 AS mtime_ns, "
    "CASE WHEN o_custkey < 700 THEN 'integrated' ELSE 'detected' END AS status, CASE WHEN o_custkey < 700 THEN 'run-' || (o_totalprice > 250000)::INT END AS run FROM orders WHERE o_orderstatus <> 'P')"
)


def _manifest_tables(spark, sf):
    o = table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    stamp = (F.unix_micros("o_orderdate") * 1000).alias("mtime_ns")
    size = F.round(F.col("o_totalprice") * 100).cast("bigint")
    path = F.concat(F.lit("ready/"), key).alias("path")
    listing = o.where("o_orderstatus <> 'O' OR o_totalprice > 100000").select(
        path, F.concat(F.lit("/data/ready/"), key).alias("absolute_path"), size.alias("size_bytes"), stamp
    )
    known = o.where("o_orderstatus <> 'P'").select(
        path,
        F.concat(F.when(F.col("o_orderpriority") == "3-MEDIUM", "/old/").otherwise("/data/ready/"), key).alias("absolute_path"),
        (size + F.when(F.col("o_orderpriority") == "2-HIGH", 1).otherwise(0)).alias("size_bytes"),
        stamp,
        F.when(F.col("o_custkey") < 700, "integrated").otherwise("detected").alias("status"),
        F.col("o_orderdate").alias("first_seen_at_utc"),
        F.col("o_orderdate").alias("last_seen_at_utc"),
        F.when(F.col("o_custkey") < 700, F.col("o_orderdate")).alias("integrated_at_utc"),
        F.when(F.col("o_custkey") < 700, F.concat(F.lit("run-"), (F.col("o_totalprice") > 250000).cast("int").cast("string"))).alias("last_training_run_id"),
    )
    return listing, known


def _now():
    return F.lit(NOW).cast("timestamp")


SNAPSHOT_SQL = (
    f"{MANIFEST_SQL}, joined AS (SELECT coalesce(l.path, m.path) AS path, l.path IS NOT NULL AS listed, m.path IS NOT NULL AS known, m.status AS s, m.run, "
    "l.absolute_path IS NOT DISTINCT FROM m.absolute_path AND l.size_bytes IS NOT DISTINCT FROM m.size_bytes AND l.mtime_ns IS NOT DISTINCT FROM m.mtime_ns AS same, "
    "coalesce(l.size_bytes, m.size_bytes) AS size_bytes FROM listing l FULL JOIN mani m USING (path)), "
    "snap AS (SELECT path, size_bytes, CASE WHEN NOT known OR (listed AND NOT same AND s = 'integrated') THEN 'detected' ELSE s END AS status, "
    "CASE WHEN NOT (known AND listed AND NOT same AND s = 'integrated') THEN run END AS last_training_run_id, NOT known AS is_new, listed FROM joined), "
    "snapshot AS (SELECT *, listed AND status <> 'integrated' AS pending FROM snap)"
)


@check(
    "detect_new_files",
    "path:s size_bytes:i status:s last_training_run_id:s is_new:b pending:b",
    f"WITH {SNAPSHOT_SQL} SELECT * FROM snapshot",
)
def _(spark, sf):
    listing, known = _manifest_tables(spark, sf)
    return manifest.update_manifest(known, listing, _now())


@check(
    "detection_summary",
    "new_files_count:i pending_files_count:i should_retrain:b",
    f"WITH {SNAPSHOT_SQL} SELECT count(*) FILTER (is_new) AS new_files_count, count(*) FILTER (pending) AS pending_files_count, count(*) FILTER (pending) >= 1000 AS should_retrain FROM snapshot",
)
def _(spark, sf):
    listing, known = _manifest_tables(spark, sf)
    return manifest.detection_summary(manifest.update_manifest(known, listing, _now()), 1000)


OUTCOME_SQL = (
    f"{MANIFEST_SQL}, outcomes AS (SELECT l.path, coalesce(a.path, b.path) AS manifest_path, coalesce(a.status, b.status) AS s, coalesce(a.run, b.run) AS r FROM "
    "(SELECT CASE WHEN size_bytes > 20000000 THEN 'moved/' || path ELSE path END AS path, absolute_path FROM listing) l "
    "LEFT JOIN mani a ON a.path = l.path LEFT JOIN mani b ON b.absolute_path = l.absolute_path)"
)


def _processed(listing):
    return listing.select(
        F.when(F.col("size_bytes") > 20000000, F.concat(F.lit("moved/"), F.col("path"))).otherwise(F.col("path")).alias("path"), "absolute_path"
    )


@check(
    "integration_outcomes",
    "path:s manifest_path:s outcome:s",
    f"WITH {OUTCOME_SQL} SELECT path, manifest_path, CASE WHEN manifest_path IS NULL THEN 'not_in_manifest' WHEN s = 'integrated' AND r = 'run-1' THEN 'already_integrated' "
    "WHEN s = 'integrated' THEN 'other_run' ELSE 'integrate' END AS outcome FROM outcomes",
)
def _(spark, sf):
    listing, known = _manifest_tables(spark, sf)
    return manifest.integration_outcomes(_processed(listing), known, "run-1")


@check(
    "mark_integrated",
    "path:s status:s last_training_run_id:s integrated_now:b",
    f"WITH {MANIFEST_SQL} SELECT path, 'integrated' AS status, coalesce(run, 'run-1') AS last_training_run_id, status = 'detected' AS integrated_now FROM mani WHERE coalesce(run, 'run-1') = 'run-1' "
    "UNION ALL SELECT path, status, run, false FROM mani WHERE run <> 'run-1'",
)
def _(spark, sf):
    _listing, known = _manifest_tables(spark, sf)
    done = known.where("coalesce(last_training_run_id, 'run-1') = 'run-1'").select("path", "absolute_path")
    marked = manifest.mark_integrated(done, known, "run-1", _now())
    return marked.withColumn("integrated_now", F.coalesce(F.col("integrated_at_utc") == _now(), F.lit(False)))


@check(
    "archive_status",
    "source_path:s archived_path:s status:s",
    f"WITH {MANIFEST_SQL} SELECT m.path AS source_path, CASE WHEN l.path IS NOT NULL THEN 'archive/' || regexp_extract(m.path, '([^/]+)$', 1) END AS archived_path, "
    "CASE WHEN l.path IS NOT NULL THEN 'archived' ELSE 'missing_source_file' END AS status FROM mani m LEFT JOIN listing l USING (path)",
)
def _(spark, sf):
    listing, known = _manifest_tables(spark, sf)
    return manifest.archive_status(known.select("path"), listing, "archive/")


# --- publication -----------------------------------------------------------------------------------------


def _stamped(spark, sf):
    created = F.timestamp_seconds(F.lit(1781677800) + F.col("vec_id"))
    return predictions(spark, sf).drop("embedding").withColumns(
        {
            "created_at": created,
            "min_class_alert": F.lit(3),
            "alert_threshold_24h": F.lit(0.35),
            "n_classes": F.lit(6),
            "run_id": F.concat(F.lit("run-"), F.col("label").cast("string")),
        }
    )


@check(
    "prediction_payload",
    "vec_id:i created:s generated:s active:b threshold:d p3:d run_id:s model_missing:b predicted:i history:s",
    f"WITH {PROBS_SQL} SELECT vec_id, strftime(make_timestamp((1781677800 + vec_id) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS created, '2026-06-17T06:30:00Z' AS generated, "
    "p_alert_24h >= 0.35 AS active, 0.35 AS threshold, p[4] AS p3, 'run-' || label AS run_id, true AS model_missing, predicted_class AS predicted, "
    "'predictions/history/' || strftime(make_timestamp((1781677800 + vec_id) * 1000000), '%Y%m%dT%H%M%SZ') || '/prediction.json' AS history FROM classes",
)
def _(spark, sf):
    ready = published.prediction_payload(_stamped(spark, sf), _now()).withColumn("json", F.to_json("payload"))
    at = lambda p: F.get_json_object("json", p)
    return ready.select(
        "vec_id",
        at("$.prediction.created_at_utc").alias("created"),
        at("$.generated_at_utc").alias("generated"),
        at("$.alert.active").cast("boolean").alias("active"),
        at("$.alert.threshold_24h").cast("double").alias("threshold"),
        at("$.classification.probabilities_by_class.class_3").cast("double").alias("p3"),
        at("$.model.run_id").alias("run_id"),
        at("$.model.model_name").isNull().alias("model_missing"),
        at("$.prediction.predicted_class").cast("int").alias("predicted"),
        published.history_key(F.col("created_at")).alias("history"),
    )


@check(
    "inference_report",
    "vec_id:i report_key:s alert_24h:b predicted_class:i",
    f"WITH {PROBS_SQL} SELECT vec_id, 'reports/inference/' || strftime(make_timestamp((1781677800 + vec_id) * 1000000), '%Y%m%dT%H%M%SZ') || '/report.json' AS report_key, "
    "p_alert_24h >= 0.35 AS alert_24h, predicted_class FROM classes",
)
def _(spark, sf):
    r = published.inference_report(_stamped(spark, sf), _now())
    return r.select("vec_id", F.col("report.outputs.inference_report").alias("report_key"), "report.prediction_summary.alert_24h", "report.prediction_summary.predicted_class")


@check(
    "latest_predictions",
    "user_id:i created_at:t event_id:i value:d",
    "SELECT user_id, ts AS created_at, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def _(spark, sf):
    e = table(spark, sf, "events").withColumnRenamed("ts", "created_at")
    return published.latest_predictions(e, ["user_id"], "event_id")


@check(
    "publish_predictions",
    "run_id:s vec_id:i created:s",
    "SELECT 'run-' || label AS run_id, max(vec_id) AS vec_id, strftime(make_timestamp((1781677800 + max(vec_id)) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS created FROM embeddings GROUP BY 1",
)
def _(spark, sf):
    root = scratch(spark)
    # one history folder per day keeps the number of folders of this check small
    stamped = _stamped(spark, sf).withColumn("created_at", F.date_trunc("day", "created_at"))
    published.publish_predictions(stamped, f"{root}/history", f"{root}/latest", ["run_id"], "vec_id", _now())
    latest = spark.read.parquet(f"{root}/latest")
    exact = F.timestamp_seconds(F.lit(1781677800) + F.col("vec_id"))
    return latest.select("run_id", "vec_id", times.format_utc(exact).alias("created"))


@check(
    "write_minutes",
    "eruption_id:s station:s channel:s time_min:t amplitude_mean:d amplitude_count:i",
    f"WITH {st.HOURS_SQL} SELECT * FROM hours",
)
def _(spark, sf):
    from tremorloom.operators import minutes

    root = scratch(spark)
    tables.write_minutes(minutes.minute_aggregate(st.assigned(spark, sf), st.HOUR), root, files_per_period=4)
    return tables.read_minutes(spark, root, "parquet")


# --- time and JSON helpers ---------------------------------------------------------------------------------


@check(
    "floor_minutes",
    "event_id:i bucket:t",
    "SELECT event_id, date_trunc('day', ts) + to_minutes(CAST(((hour(ts) * 60 + minute(ts)) // 7) * 7 AS INT)) AS bucket FROM events",
)
def _(spark, sf):
    return table(spark, sf, "events").withColumn("bucket", times.floor_minutes("ts", 7))


@check(
    "utc_window",
    "event_id:i window_start:t window_end:t",
    "SELECT event_id, ts - INTERVAL 90 MINUTE AS window_start, ts AS window_end FROM events",
)
def _(spark, sf):
    start, end = times.utc_window("ts", 1.5)
    return table(spark, sf, "events").withColumns({"window_start": start, "window_end": end})


@check(
    "format_and_parse_utc",
    "event_id:i iso:s compact:s parsed:t offset_parsed:t naive_refused:b",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(ts, '%Y%m%dT%H%M%SZ') AS compact, date_trunc('second', ts) AS parsed, "
    "date_trunc('second', ts) - INTERVAL 2 HOUR AS offset_parsed, true AS naive_refused FROM events",
)
def _(spark, sf):
    e = table(spark, sf, "events").withColumn("iso", times.format_utc("ts"))
    plain = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return e.withColumns(
        {
            "compact": times.format_utc_compact("ts"),
            "parsed": times.parse_utc("iso"),
            "offset_parsed": times.parse_utc(F.concat(plain, F.lit("+02:00"))),
            "naive_refused": times.parse_utc(plain).isNull() & times.parse_utc(plain, allow_naive=True).isNotNull(),
        }
    )


@check(
    "first_number",
    "event_id:i number:d text:s",
    "SELECT event_id, CASE event_type WHEN 'view' THEN CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) WHEN 'click' THEN value WHEN 'error' THEN value END AS number, "
    "CASE event_type WHEN 'signup' THEN 'x' || user_id END AS text FROM events",
)
def _(spark, sf):
    t, v = F.col("event_type"), F.col("value")
    report = F.when(t == "view", F.col("props")).when(t == "click", F.to_json(F.struct(F.struct(v.alias("b")).alias("a")))).when(
        t == "error", F.to_json(F.struct(F.lit("n/a").alias("k"), v.cast("string").alias("z")))
    ).when(t == "signup", F.to_json(F.struct(F.lit(" ").alias("p"), F.concat(F.lit("x"), F.col("user_id").cast("string")).alias("q")))).otherwise(F.lit("[]"))
    e = table(spark, sf, "events").withColumn("report", report)
    return e.withColumn("number", first_number("report", [["k"], ["a", "b"], ["z"]])).withColumn("text", first_string("report", [["p"], ["q"]]))


# --- decisions: suppliers are candidates, nations the families with one champion each ------------------------

CAND_SQL = (
    "cand AS (SELECT l_suppkey AS candidate_id, s_nationkey AS family, count(*) AS epochs, round(avg(l_discount) * 4, 6) AS business_score, round(avg(l_tax) * 18, 6) AS alert_24h_f1, "
    "round(avg(l_quantity) / 36, 6) AS alert_24h_recall, round(avg(l_linenumber) / 9.9, 6) AS alert_24h_precision, "
    "CASE WHEN max(s_acctbal) > 3000 THEN round(avg(l_discount) * 3, 6) END AS class_5_f1, max(s_acctbal) AS bal FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2), "
    "champ AS (SELECT family, avg(business_score) AS business_score, avg(alert_24h_f1) AS alert_24h_f1, avg(alert_24h_recall) AS alert_24h_recall, "
    "avg(alert_24h_precision) AS alert_24h_precision, avg(class_5_f1) AS class_5_f1 FROM cand GROUP BY 1)"
)
METRIC_NAMES = ["business_score", "alert_24h_f1", "alert_24h_recall", "alert_24h_precision", "class_5_f1"]


def _candidate_numbers(spark, sf):
    li, s = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    r = lambda c: F.round(c, 6)
    return li.join(s, F.col("s_suppkey") == F.col("l_suppkey")).groupBy(F.col("l_suppkey").alias("candidate_id"), F.col("s_nationkey").alias("family")).agg(
        F.count(F.lit(1)).alias("n"),
        r(F.avg("l_discount") * 4).alias("business_score"),
        r(F.avg("l_tax") * 18).alias("alert_24h_f1"),
        r(F.avg("l_quantity") / 36).alias("alert_24h_recall"),
        r(F.avg("l_linenumber") / 9.9).alias("alert_24h_precision"),
        F.when(F.max("s_acctbal") > 3000, r(F.avg("l_discount") * 3)).alias("class_5_f1"),
        F.max("s_acctbal").alias("bal"),
    )


def _candidates(spark, sf):
    """Numbers packed into the JSON layout of training results and read back."""
    c = _candidate_numbers(spark, sf)
    result = F.to_json(
        F.struct(
            F.when(F.col("bal") > -500, "success").otherwise("failed").alias("status"),
            (F.col("bal") > 9500).alias("dry_run"),
            F.array(F.lit("train"), F.lit("--epochs"), F.col("n").cast("string")).alias("command"),
            F.struct(
                F.struct(
                    F.col("business_score").alias("business_score_classification"), "alert_24h_f1", "alert_24h_recall", "alert_24h_precision", "class_5_f1"
                ).alias("test")
            ).alias("metrics"),
        )
    )
    packed = c.select("candidate_id", "family", "bal", result.alias("result"))
    return decision.candidate_metrics(packed).withColumns(
        {
            "drift_status": F.lit("success"),
            "critical_drift": F.col("bal") < 500,
            "rejected_by_drift": F.col("bal") < 400,
        }
    )


def _champions(spark, sf):
    c = _candidate_numbers(spark, sf)
    averages = c.groupBy("family").agg(*[F.avg(m).alias(m) for m in METRIC_NAMES])
    section = F.struct(
        F.col("business_score").alias("test_business_score_classification"),
        F.col("alert_24h_f1").alias("f1_alert_24h"),
        F.col("alert_24h_recall").alias("recall_alert_24h"),
        F.col("alert_24h_precision").alias("precision_alert_24h"),
        F.col("class_5_f1").alias("test_class_5_f1"),
    )
    packed = averages.select("family", F.to_json(F.struct(section.alias("classification_candidate"))).alias("decision"))
    return decision.champion_metrics(packed)


@check(
    "candidate_metrics",
    "candidate_id:i epochs:i status:s dry_run:b business_score:d alert_24h_f1:d alert_24h_recall:d alert_24h_precision:d class_5_f1:d",
    f"WITH {CAND_SQL} SELECT *, CASE WHEN bal > -500 THEN 'success' ELSE 'failed' END AS status, bal > 9500 AS dry_run FROM cand",
)
def _(spark, sf):
    return _candidates(spark, sf)


@check("champion_metrics", "family:i business_score:d alert_24h_f1:d alert_24h_recall:d alert_24h_precision:d class_5_f1:d", f"WITH {CAND_SQL} SELECT * FROM champ")
def _(spark, sf):
    return _champions(spark, sf)


RULES_SQL = (
    f"{CAND_SQL}, r AS (SELECT c.candidate_id, c.family, unnest(range(12)) AS rule_order, unnest(['candidate_training_success','candidate_not_dry_run','minimum_epochs_for_promotion','required_metrics_available',"
    "'business_score_not_lower_than_champion','alert_24h_f1_not_degraded','alert_24h_recall_minimum','alert_24h_precision_minimum','class_5_f1_not_degraded','drift_summary_success',"
    "'no_critical_drift_detected','candidate_not_rejected_by_drift_check']) AS rule, unnest([bal > -500, NOT bal > 9500, epochs >= 2, true, c.business_score >= h.business_score - 0.0, "
    "c.alert_24h_f1 >= h.alert_24h_f1 - CAST(0.02 AS DOUBLE), c.alert_24h_recall >= 0.7, c.alert_24h_precision >= 0.4, c.class_5_f1 >= h.class_5_f1 - CAST(0.05 AS DOUBLE), true, NOT bal < 500, NOT bal < 400]) AS passed "
    "FROM cand c JOIN champ h USING (family)), "
    "d AS (SELECT candidate_id, family, bool_and(coalesce(passed, true)) AS eligible_for_promotion, coalesce(string_agg(rule, ', ' ORDER BY rule_order) FILTER (NOT passed), '') AS failed_rules FROM r GROUP BY 1, 2)"
)


def _rules(spark, sf):
    return decision.compare_candidates(_candidates(spark, sf), _champions(spark, sf), "family")


@check("compare_candidates", "candidate_id:i rule_order:i rule:s passed:b", f"WITH {RULES_SQL} SELECT * FROM r")
def _(spark, sf):
    return _rules(spark, sf)


@check(
    "decide",
    "candidate_id:i eligible_for_promotion:b decision:s failed_rules:s",
    f"WITH {RULES_SQL} SELECT *, CASE WHEN eligible_for_promotion THEN 'promote_candidate' ELSE 'reject_candidate' END AS decision FROM d",
)
def _(spark, sf):
    return decision.decide(_rules(spark, sf))


@check(
    "promote",
    "family:i version:i candidate_id:i replaces_version:i business_score:d class_5_f1:d",
    f"WITH {RULES_SQL}, best AS (SELECT c.* FROM cand c JOIN d USING (candidate_id) WHERE eligible_for_promotion QUALIFY row_number() OVER (PARTITION BY c.family ORDER BY c.business_score DESC, c.candidate_id) = 1) "
    "SELECT family, family + 2 AS version, candidate_id, family + 1 AS replaces_version, b.business_score, coalesce(b.class_5_f1, h.class_5_f1) AS class_5_f1 FROM best b JOIN champ h USING (family)",
)
def _(spark, sf):
    candidates, champions = _candidates(spark, sf), _champions(spark, sf)
    old = champions.withColumn("version", F.col("family") + 1)
    older = champions.select("family", *[F.lit(0.0).alias(m) for m in METRIC_NAMES], F.col("family").alias("version"))
    decisions = decision.decide(decision.compare_candidates(candidates, champions, "family"))
    return decision.promote(old.drop("decision").unionByName(older), candidates, decisions, _now(), "family")


@check(
    "promotion_action",
    "candidate_id:i action:s reason:s",
    f"WITH {RULES_SQL}, s AS (SELECT d.*, bal > 1000 AS good FROM d JOIN cand USING (candidate_id)) SELECT candidate_id, CASE WHEN good AND eligible_for_promotion THEN 'candidate_promoted' ELSE 'promotion_skipped' END AS action, "
    "CASE WHEN NOT good THEN 'comparison_status_is_not_success' WHEN NOT eligible_for_promotion THEN 'candidate_not_eligible_for_promotion' END AS reason FROM s",
)
def _(spark, sf):
    decisions = decision.decide(_rules(spark, sf))
    status = _candidate_numbers(spark, sf).select("candidate_id", F.when(F.col("bal") > 1000, "success").otherwise("failed").alias("status"))
    return decision.promotion_action(decisions.join(status, "candidate_id"))


@check(
    "best_runs",
    "flag:s l_orderkey:i l_linenumber:i l_extendedprice:d",
    "SELECT l_returnflag || l_linestatus AS flag, l_orderkey, l_linenumber, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_extendedprice DESC, l_orderkey * 10 + l_linenumber) = 1",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumns(
        {"flag": F.concat("l_returnflag", "l_linestatus"), "run": F.col("l_orderkey") * 10 + F.col("l_linenumber")}
    )
    return decision.best_runs(li, "flag", ["test_score", "l_extendedprice"], "run")


@check(
    "audit_rows",
    "o_orderkey:i kind:s name:s value:d text:s",
    "SELECT o_orderkey, 'metric' AS kind, 'price' AS name, o_totalprice AS value, NULL AS text FROM orders WHERE o_orderstatus <> 'P' UNION ALL "
    "SELECT o_orderkey, 'metric', 'rich', (o_totalprice > 200000)::INT, NULL FROM orders UNION ALL "
    "SELECT o_orderkey, 'tag', 'note', NULL, repeat('ab', 250) FROM orders WHERE o_orderpriority <> '5-LOW' UNION ALL "
    "SELECT o_orderkey, 'param', 'o_orderpriority', NULL, o_orderpriority FROM orders",
)
def _(spark, sf):
    o = table(spark, sf, "orders").withColumns(
        {
            "price": F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).otherwise(F.col("o_totalprice")),
            "rich": F.col("o_totalprice") > 200000,
            "note": F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(F.repeat(F.lit("ab"), F.lit(400))),
        }
    )
    return decision.audit_rows(o, "o_orderkey", ["price"], ["rich"], ["note"], ["o_orderpriority"], tag_chars=500, param_chars=250)


@check(
    "select_runs",
    "o_orderkey:i",
    "SELECT o_orderkey FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED' UNION ALL SELECT -1 - o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'",
)
def _(spark, sf):
    o = table(spark, sf, "orders")
    by_text = decision.select_runs(o, "NOT SPECIFIED").select("o_orderkey")
    named = o.withColumns(
        {
            "model_family": F.when(F.col("o_orderstatus") == "F", "cnn_transformer").otherwise("cnn_bilstm"),
            "class_weighting": F.when(F.col("o_orderpriority") == "2-HIGH", "alert_priority").otherwise("none"),
        }
    )
    by_name = decision.select_runs(named, "cnn_transformer_alert_priority").select((-1 - F.col("o_orderkey")).alias("o_orderkey"))
    return by_text.unionByName(by_name)


@check(
    "read_periods_csv",
    "o_orderkey:i period_id:s period_type:s split:s stations:s start:s",
    f"SELECT o_orderkey, o_custkey::VARCHAR AS period_id, trim({KIND_SQL}) AS period_type, CASE o_orderstatus WHEN 'F' THEN 'train' WHEN 'O' THEN 'val' ELSE 'extra' END AS split, "
    "'a,b' AS stations, CASE WHEN o_orderstatus = 'P' THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS start FROM orders",
)
def _(spark, sf):
    root = scratch(spark)
    order_periods(spark, sf).write.csv(f"{root}/periods", header=True, sep=";")
    return tables.read_periods_csv(spark, f"{root}/periods").withColumnRenamed("period_start_utc", "start")


@check(
    "read_minutes_csv",
    "eruption_id:s sensor:s time_min:t amplitude_mean:d amplitude_std:d amplitude_count:i",
    f"WITH {st.HOURS_SQL} SELECT * FROM hours",
)
def _(spark, sf):
    from tremorloom.operators import features, minutes

    root = scratch(spark)
    minutes.minute_aggregate(st.assigned(spark, sf), st.HOUR).write.csv(f"{root}/minutes", header=True)
    return features.prepare_minutes(tables.read_minutes(spark, f"{root}/minutes"))
