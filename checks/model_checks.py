"""Checks of scores, alerts, drift and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.dataset_checks import MATRIX_SQL, matrices
from checks.support import check, table
from tremorloom.functions.arrays import softmax
from tremorloom.operators import drift, evaluation, scoring

# --- scores: six logits per embedding ---------------------------------------------------------------

PROBS_SQL = (
    "logits AS (SELECT vec_id, label, list_transform(embedding[1:6], lambda v: CAST(v AS DOUBLE) * 8) AS z FROM embeddings), "
    "shifted AS (SELECT *, list_transform(z, lambda v: exp(v - list_max(z))) AS e FROM logits), "
    "probs AS (SELECT vec_id, label, z, list_transform(e, lambda v: v / list_sum(e)) AS p FROM shifted), "
    "classes AS (SELECT *, list_position(p, list_max(p)) - 1 AS predicted_class, list_max(p) AS predicted_probability, "
    "p[4] + p[5] + p[6] AS p_alert_24h FROM probs)"
)
P_SPEC = " ".join(f"p{i}:d" for i in range(6))
P_SQL = ", ".join(f"p[{i + 1}] AS p{i}" for i in range(6))


def logits(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.withColumn("scores", F.transform(F.slice("embedding", 1, 6), lambda v: v.cast("double") * 8))


def probable(spark, sf):
    return scoring.to_probabilities(logits(spark, sf), is_logits=True)


def predictions(spark, sf):
    return scoring.alert(scoring.predicted_class(probable(spark, sf)))


def spread(df, column="probabilities"):
    return df.select("*", *[F.get(column, F.lit(i)).alias(f"p{i}") for i in range(6)])


@check("softmax", f"vec_id:i {P_SPEC}", f"WITH {PROBS_SQL} SELECT vec_id, {P_SQL} FROM probs")
def _(spark, sf):
    return spread(logits(spark, sf).withColumn("probabilities", softmax("scores")))


@check("to_probabilities", f"vec_id:i {P_SPEC}", f"WITH {PROBS_SQL} SELECT vec_id, {P_SQL} FROM probs")
def _(spark, sf):
    return spread(probable(spark, sf))


@check(
    "predicted_class",
    "vec_id:i predicted_class:i predicted_probability:d",
    f"WITH {PROBS_SQL} SELECT vec_id, predicted_class, predicted_probability FROM classes",
)
def _(spark, sf):
    return predictions(spark, sf)


@check(
    "alert",
    "vec_id:i p_alert_24h:d alert_24h:b",
    f"WITH {PROBS_SQL} SELECT vec_id, p_alert_24h, p_alert_24h >= 0.35 AS alert_24h FROM classes",
)
def _(spark, sf):
    return predictions(spark, sf)


@check(
    "score_model",
    "seq_id:i s0:d s1:d s2:d s3:d s4:d s5:d",
    f"WITH {MATRIX_SQL}, per_feature AS (SELECT vec_id AS seq_id, f, avg(v) AS m FROM cells GROUP BY 1, 2) SELECT seq_id, "
    + ", ".join(f"max(m) FILTER (f = {i}) AS s{i}" for i in range(6))
    + " FROM per_feature GROUP BY 1",
)
def _(spark, sf):
    """A stand-in model: the score of class i is the mean of feature i over the steps."""
    scored = scoring.score(matrices(spark, sf), lambda x: x.astype("float64").mean(axis=1)[:, :6])
    return scored.select("seq_id", *[F.get("scores", F.lit(i)).alias(f"s{i}") for i in range(6)])


@check(
    "validate_scores",
    "vec_id:i violation:s",
    "SELECT vec_id, CASE WHEN label = 3 THEN 'width' ELSE 'not_finite' END AS violation FROM embeddings WHERE label = 3 OR embedding[1] > CAST(0.2 AS FLOAT)",
)
def _(spark, sf):
    e = table(spark, sf, "embeddings")
    spoiled = F.transform(F.slice("embedding", 1, 6), lambda v: F.when(F.get("embedding", F.lit(0)) > F.lit(0.2).cast("float"), F.lit(float("inf"))).otherwise(v.cast("double")))
    raw = e.withColumn("scores", F.when(F.col("label") == 3, F.slice(spoiled, 1, 4)).otherwise(spoiled))
    return scoring.validate_scores(raw)


@check(
    "validate_probabilities",
    "vec_id:i violation:s",
    f"WITH {PROBS_SQL} SELECT vec_id, CASE label WHEN 0 THEN 'width' WHEN 1 THEN 'range' ELSE 'sum' END AS violation FROM probs WHERE label < 3",
)
def _(spark, sf):
    p = F.col("probabilities")
    worse = (
        F.when(F.col("label") == 0, F.slice(p, 1, 5))
        .when(F.col("label") == 1, F.transform(p, lambda v: -v))
        .when(F.col("label") == 2, F.transform(p, lambda v: v * 0.5))
        .otherwise(p)
    )
    return scoring.validate_probabilities(probable(spark, sf).withColumn("probabilities", worse))


for _how, _sql in (
    ("last", f"SELECT label AS batch, {P_SQL}, vec_id AS selected_index FROM probs QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id DESC) = 1"),
    ("mean", "SELECT label AS batch, " + ", ".join(f"avg(p[{i + 1}]) AS p{i}" for i in range(6)) + ", NULL AS selected_index FROM probs GROUP BY 1"),
    ("max_alert", f"SELECT label AS batch, {P_SQL}, vec_id AS selected_index FROM classes QUALIFY row_number() OVER (PARTITION BY label ORDER BY p_alert_24h DESC, vec_id) = 1"),
):

    def _run(spark, sf, how=_how):
        return spread(scoring.aggregate_batch(predictions(spark, sf), how, "label", "vec_id")).withColumnRenamed("label", "batch")

    check(f"aggregate_batch_{_how}", f"batch:i {P_SPEC} selected_index:i", f"WITH {PROBS_SQL} {_sql}")(_run)


@check(
    "prediction_classes",
    "vec_id:i yhat:i",
    f"WITH {PROBS_SQL} SELECT vec_id, predicted_class AS yhat FROM classes",
)
def _(spark, sf):
    found, _source = scoring.prediction_classes(probable(spark, sf).drop("embedding"))
    return found


VERIFY = {
    1: "created_at_missing",
    2: "model_name_missing",
    3: "min_class_invalid",
    4: "p_alert_inconsistent",
    5: "class_keys",
    6: "alert_missing",
}


@check(
    "verify_predictions",
    "vec_id:i rule:s",
    "SELECT vec_id, unnest(CASE label "
    + " ".join(f"WHEN {k} THEN ['{v}'{', ' + repr('p_alert_inconsistent') if k == 3 else ''}]" for k, v in VERIFY.items())
    + " WHEN 7 THEN ['probabilities_width', 'class_keys'] END) AS rule FROM embeddings WHERE label BETWEEN 1 AND 7",
)
def _(spark, sf):
    label = F.col("label")
    p = F.when(label == 7, F.slice("probabilities", 1, 5)).otherwise(F.col("probabilities"))
    base = predictions(spark, sf).withColumns(
        {
            "created_at_utc": F.when(label == 1, F.lit("")).otherwise(F.lit("2026-06-17T06:30:00Z")),
            "model_name": F.when(label != 2, F.lit("model")),
            "run_id": F.lit("run"),
            "n_classes": F.lit(6),
            "min_class_alert": F.when(label == 3, F.lit(6)).otherwise(F.lit(3)),
            "p_alert_24h": F.when(label == 4, 1 - F.col("p_alert_24h") / 2).otherwise(F.col("p_alert_24h")),
            "alert_24h": F.when(label != 6, F.col("alert_24h")),
            "probabilities_by_class": scoring.class_key_map("probabilities"),
        }
    )
    extra = F.map_concat("probabilities_by_class", F.create_map(F.lit("class_9"), F.lit(0.0)))
    spoiled = base.withColumn("probabilities_by_class", F.when(label == 5, extra).when(label == 7, F.map_filter("probabilities_by_class", lambda k, v: k != "class_5")).otherwise(F.col("probabilities_by_class")))
    return scoring.verify_predictions(spoiled.withColumn("probabilities", p), "vec_id")


# --- drift: open order lines against fulfilled ones --------------------------------------------------

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

def _long_sql(kind: str) -> str:
    return "long AS (" + " UNION ALL ".join(
        f"SELECT CASE l_linestatus WHEN 'F' THEN 'reference' ELSE 'candidate' END AS dataset, '{c}' AS feature, CAST(CAST({c} AS {kind}) AS DOUBLE) AS v FROM lineitem"
        for c in LINE_FEATURES
    ) + ")"


LONG_SQL = _long_sql("DOUBLE")
# distribution distances compare float32 values
FLOAT_SQL = _long_sql("FLOAT")


def lines(spark, sf):
    li = table(spark, sf, "lineitem")
    return drift.long_features(li.where("l_linestatus = 'F'"), li.where("l_linestatus <> 'F'"), LINE_FEATURES)


@check(
    "feature_drift",
    "feature:s reference_mean:d candidate_mean:d reference_std:d candidate_std:d standardized_mean_diff:d drifted:b",
    f"WITH {LONG_SQL}, s AS (SELECT feature, avg(v) FILTER (dataset = 'reference') AS reference_mean, avg(v) FILTER (dataset = 'candidate') AS candidate_mean, "
    "stddev_pop(v) FILTER (dataset = 'reference') AS reference_std, stddev_pop(v) FILTER (dataset = 'candidate') AS candidate_std FROM long GROUP BY 1) "
    "SELECT *, abs(candidate_mean - reference_mean) / reference_std AS standardized_mean_diff, abs(candidate_mean - reference_mean) / reference_std > 0.5 AS drifted FROM s",
)
def _(spark, sf):
    return drift.feature_drift(lines(spark, sf))


@check(
    "dataset_drift",
    "drifted_features_count:i total_features:i share_drifted_features:d dataset_drift:b",
    f"WITH {LONG_SQL}, s AS (SELECT feature, abs(avg(v) FILTER (dataset = 'candidate') - avg(v) FILTER (dataset = 'reference')) / stddev_pop(v) FILTER (dataset = 'reference') > 0.001 AS d FROM long GROUP BY 1) "
    "SELECT count(*) FILTER (d) AS drifted_features_count, count(*) AS total_features, avg(d::INT) AS share_drifted_features, avg(d::INT) > 0.3 AS dataset_drift FROM s",
)
def _(spark, sf):
    return drift.dataset_drift(drift.feature_drift(lines(spark, sf), 0.001))


@check(
    "ks_distance",
    "feature:s ks:d",
    f"WITH {FLOAT_SQL}, c AS (SELECT feature, v, count(*) FILTER (dataset = 'reference') AS r, count(*) FILTER (dataset = 'candidate') AS c FROM long GROUP BY 1, 2), "
    "k AS (SELECT feature, sum(r) OVER w / sum(r) OVER (PARTITION BY feature) - sum(c) OVER w / sum(c) OVER (PARTITION BY feature) AS gap FROM c WINDOW w AS (PARTITION BY feature ORDER BY v)) "
    "SELECT feature, max(abs(gap)) AS ks FROM k GROUP BY 1",
)
def _(spark, sf):
    return drift.ks_distance(lines(spark, sf))


PSI_SQL = (
    f"{FLOAT_SQL}, cuts AS (SELECT feature, quantile_cont(v, [0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM long WHERE dataset = 'reference' GROUP BY 1), "
    "placed AS (SELECT l.feature, dataset, len(list_filter(q, lambda c: c < v)) AS bin FROM long l JOIN cuts USING (feature)), "
    "n AS (SELECT feature, count(*) FILTER (dataset = 'reference') AS rn, count(*) FILTER (dataset = 'candidate') AS cn FROM long GROUP BY 1), "
    "b AS (SELECT feature, bin, count(*) FILTER (dataset = 'reference') AS r, count(*) FILTER (dataset = 'candidate') AS c FROM placed GROUP BY 1, 2), "
    "g AS (SELECT n.feature, greatest(coalesce(r, 0) / rn, 1e-4) AS pr, greatest(coalesce(c, 0) / cn, 1e-4) AS pc FROM n CROSS JOIN range(10) k(bin) LEFT JOIN b ON b.feature = n.feature AND b.bin = k.bin), "
    "psi AS (SELECT feature, sum((pc - pr) * ln(pc / pr)) AS psi FROM g GROUP BY 1)"
)


@check("population_stability", "feature:s psi:d", f"WITH {PSI_SQL} SELECT * FROM psi")
def _(spark, sf):
    return drift.population_stability(lines(spark, sf), n_features=len(LINE_FEATURES))


@check(
    "distribution_drift",
    "feature:s psi:d drifted:b",
    f"WITH {PSI_SQL}, c AS (SELECT feature, v, count(*) FILTER (dataset = 'reference') AS r, count(*) FILTER (dataset = 'candidate') AS c FROM long GROUP BY 1, 2), "
    "k AS (SELECT feature, sum(r) OVER w / sum(r) OVER (PARTITION BY feature) - sum(c) OVER w / sum(c) OVER (PARTITION BY feature) AS gap FROM c WINDOW w AS (PARTITION BY feature ORDER BY v)), "
    "ks AS (SELECT feature, max(abs(gap)) AS ks FROM k GROUP BY 1) SELECT feature, psi, ks > 0.003 OR psi > 0.2 AS drifted FROM psi JOIN ks USING (feature)",
)
def _(spark, sf):
    return drift.distribution_drift(lines(spark, sf), max_ks=0.003, n_features=len(LINE_FEATURES))


@check(
    "class_distribution",
    "label:i y:i share:d",
    "SELECT label, label % 3 AS y, 1.0 AS share FROM embeddings GROUP BY 1, 2 UNION ALL "
    "SELECT -1, l_linenumber, count(*) / (SELECT count(*) FROM lineitem) FROM lineitem GROUP BY 2",
)
def _(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("c", F.col("label") % 3)
    by_label = drift.class_distribution(e, "c", by=["label"])
    whole = drift.class_distribution(table(spark, sf, "lineitem"), "l_linenumber").withColumn("label", F.lit(-1))
    return by_label.unionByName(whole)


TVD_SQL = (
    "r AS (SELECT least(l_linenumber, 6) AS y, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1), "
    "c AS (SELECT greatest(l_linenumber, 2) AS y, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), "
    "d AS (SELECT 0.5 * sum(abs(coalesce(r.n, 0) / (SELECT sum(n) FROM r) - coalesce(c.n, 0) / (SELECT sum(n) FROM c))) AS distance FROM r FULL JOIN c USING (y))"
)


@check("target_drift", "distance:d target_drift:b", f"WITH {TVD_SQL} SELECT distance, distance > 0.14 AS target_drift FROM d")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    reference = li.where("l_returnflag <> 'R'").withColumn("y", F.least("l_linenumber", F.lit(6)))
    candidate = li.where("l_returnflag = 'R'").withColumn("y", F.greatest("l_linenumber", F.lit(2)))
    return drift.target_drift(reference, candidate, max_distance=0.14)


@check(
    "prediction_drift",
    "reference_split:s distance:d prediction_drift:b",
    f"WITH {PROBS_SQL}, t AS (SELECT label % 6 AS y, count(*) AS n FROM embeddings GROUP BY 1), h AS (SELECT predicted_class AS y, count(*) AS n FROM classes GROUP BY 1) "
    "SELECT 'all_splits' AS reference_split, d AS distance, d > 0.3 AS prediction_drift FROM (SELECT 0.5 * sum(abs(coalesce(t.n, 0) - coalesce(h.n, 0))) / (SELECT count(*) FROM embeddings) AS d FROM t FULL JOIN h USING (y))",
)
def _(spark, sf):
    found, _source = scoring.prediction_classes(probable(spark, sf).drop("embedding"))
    return drift.prediction_drift(found, matrices(spark, sf))


@check(
    "drift_verdict",
    "user_id:i dataset_drift:b target_drift:b prediction_drift:b critical_drift:b reason:s",
    "SELECT *, coalesce(dataset_drift, false) OR coalesce(target_drift, false) OR coalesce(prediction_drift, false) AS critical_drift, "
    "CASE WHEN coalesce(dataset_drift, false) OR coalesce(target_drift, false) OR coalesce(prediction_drift, false) THEN 'Critical drift detected: ' || "
    "concat_ws(', ', CASE WHEN dataset_drift THEN 'dataset_drift' END, CASE WHEN target_drift THEN 'target_drift' END, CASE WHEN prediction_drift THEN 'prediction_drift' END) "
    "ELSE 'No critical drift detected.' END AS reason FROM (SELECT user_id, avg(value) > 45 AS dataset_drift, count(*) > 70 AS target_drift, "
    "CASE WHEN min(event_type) = 'click' AND max(value) > 150 THEN max(value) > 250 END AS prediction_drift FROM events GROUP BY 1)",
)
def _(spark, sf):
    flags = table(spark, sf, "events").groupBy("user_id").agg(
        (F.avg("value") > 45).alias("dataset_drift"),
        (F.count("*") > 70).alias("target_drift"),
        F.when((F.min("event_type") == "click") & (F.max("value") > 150), F.max("value") > 250).alias("prediction_drift"),
    )
    return drift.drift_verdict(flags)


@check(
    "sequence_summary",
    "seq_id:i sequence_mean:d sequence_std:d sequence_min:d sequence_max:d sequence_abs_mean:d sequence_energy_mean:d first_timestep_mean:d "
    "last_timestep_mean:d temporal_delta_mean:d feature_std_mean:d timestep_std_mean:d",
    f"WITH {MATRIX_SQL}, fs AS (SELECT vec_id, avg(sd) AS v FROM (SELECT vec_id, f, stddev_pop(v) AS sd FROM cells GROUP BY 1, 2) GROUP BY 1), "
    "ts AS (SELECT vec_id, avg(sd) AS v FROM (SELECT vec_id, t, stddev_pop(v) AS sd FROM cells GROUP BY 1, 2) GROUP BY 1) "
    "SELECT c.vec_id AS seq_id, avg(c.v) AS sequence_mean, stddev_pop(c.v) AS sequence_std, min(c.v) AS sequence_min, max(c.v) AS sequence_max, "
    "avg(abs(c.v)) AS sequence_abs_mean, avg(c.v * c.v) AS sequence_energy_mean, avg(c.v) FILTER (t = 0) AS first_timestep_mean, "
    "avg(c.v) FILTER (t = 7) AS last_timestep_mean, avg(c.v) FILTER (t = 7) - avg(c.v) FILTER (t = 0) AS temporal_delta_mean, "
    "max(fs.v) AS feature_std_mean, max(ts.v) AS timestep_std_mean FROM cells c JOIN fs USING (vec_id) JOIN ts USING (vec_id) GROUP BY 1",
)
def _(spark, sf):
    return drift.sequence_summary(matrices(spark, sf))


@check(
    "monitoring_frame",
    "feature:s n:i mean:d",
    f"WITH {MATRIX_SQL} SELECT 'feature_' || lpad(f::VARCHAR, 4, '0') AS feature, count(v) AS n, avg(v) AS mean FROM cells GROUP BY 1",
)
def _(spark, sf):
    long = drift.monitoring_frame(matrices(spark, sf), drift.REFERENCE)
    return long.groupBy("feature").agg(F.count("v").alias("n"), F.avg("v").alias("mean"))


@check(
    "common_features",
    "feature:s",
    f"WITH {MATRIX_SQL} SELECT 'feature_' || lpad(f::VARCHAR, 4, '0') AS feature FROM cells WHERE f <> 2 AND f <> 5 GROUP BY 1",
)
def _(spark, sf):
    m = matrices(spark, sf)
    ref = drift.monitoring_frame(m.where("label < 5"), drift.REFERENCE)
    cand = drift.monitoring_frame(m.where("label >= 5"), drift.CANDIDATE)
    gone = lambda df, name: df.withColumn("v", F.when(F.col("feature") != name, F.col("v")))
    return drift.common_features(gone(ref, "feature_0002").unionByName(gone(cand, "feature_0005")))


@check(
    "top_variance_features",
    "feature:s variance:d",
    f"WITH {LONG_SQL} SELECT feature, var_pop(v) AS variance FROM long WHERE dataset = 'reference' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3",
)
def _(spark, sf):
    return drift.top_variance_features(lines(spark, sf), 3)


@check(
    "limit_rows_even",
    "event_id:i",
    "WITH n AS (SELECT count(*) AS n FROM events) SELECT DISTINCT CAST(CASE WHEN i = 776 THEN n - 1 ELSE floor(i * ((n - 1) / 776)) END AS BIGINT) AS event_id FROM n, range(777) r(i)",
)
def _(spark, sf):
    e = table(spark, sf, "events")
    return drift.limit_rows_even(e, e.count(), 777, "event_id")


@check(
    "sample_sequences",
    "split:s n:i",
    f"WITH {MATRIX_SQL} SELECT split, least(count(*), 60) AS n FROM seqs GROUP BY 1",
)
def _(spark, sf):
    picked = drift.sample_sequences(matrices(spark, sf), 60, 42)
    return picked.groupBy("split").agg(F.count_distinct("seq_id").alias("n"))


# --- evaluation: order lines as (class, predicted class) pairs ----------------------------------------

PAIRS_SQL = "pairs AS (SELECT l_returnflag AS flag, (l_linenumber - 1) % 6 AS y, CAST(round(l_discount * 100) AS INT) % 5 AS yhat FROM lineitem)"
GRID_SQL = (
    f"{PAIRS_SQL}, m AS (SELECT g.flag, a.k AS y, b.k AS yhat, count(p.y) AS n FROM (SELECT DISTINCT flag FROM pairs) g CROSS JOIN range(6) a(k) CROSS JOIN range(6) b(k) "
    "LEFT JOIN pairs p ON p.flag = g.flag AND p.y = a.k AND p.yhat = b.k GROUP BY 1, 2, 3), "
    "cls AS (SELECT g.flag, c.k AS cls, sum(n) FILTER (y = c.k) AS support, sum(n) FILTER (yhat = c.k) AS predicted, sum(n) FILTER (y = c.k AND yhat = c.k) AS hit "
    "FROM m g CROSS JOIN range(6) c(k) GROUP BY 1, 2), "
    "rated AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hit / predicted END AS precision, CASE WHEN support = 0 THEN 0 ELSE hit / support END AS recall, "
    "CASE WHEN support + predicted = 0 THEN 0 ELSE 2 * hit / (support + predicted) END AS f1 FROM cls), "
    "overall AS (SELECT flag, sum(recall * support) / sum(support) AS accuracy, avg(recall) FILTER (support > 0) AS balanced_accuracy, "
    "avg(precision) FILTER (support + predicted > 0) AS macro_precision, avg(recall) FILTER (support + predicted > 0) AS macro_recall, "
    "avg(f1) FILTER (support + predicted > 0) AS macro_f1, sum(precision * support) / sum(support) AS weighted_precision, "
    "sum(recall * support) / sum(support) AS weighted_recall, sum(f1 * support) / sum(support) AS weighted_f1 FROM rated GROUP BY 1), "
    "lv(level, k) AS (VALUES ('alert', 1), ('alert_24h', 3), ('alert_12h', 4), ('alert_6h', 5)), "
    "al AS (SELECT flag, level, sum(n) FILTER (y >= k AND yhat >= k) AS tp, sum(n) FILTER (y < k AND yhat >= k) AS fp, sum(n) FILTER (y >= k AND yhat < k) AS fn, "
    "sum(n) FILTER (y < k AND yhat < k) AS tn FROM m CROSS JOIN lv GROUP BY 1, 2), "
    "alerts AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall, "
    "CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1 FROM al)"
)


def matrix(spark, sf):
    li = table(spark, sf, "lineitem")
    pairs = li.select(
        F.col("l_returnflag").alias("flag"),
        ((F.col("l_linenumber") - 1) % 6).alias("y"),
        (F.round(F.col("l_discount") * 100).cast("int") % 5).alias("yhat"),
    )
    return evaluation.confusion_matrix(pairs, by=["flag"])


@check("confusion_matrix", "flag:s y:i yhat:i n:i", f"WITH {GRID_SQL} SELECT * FROM m")
def _(spark, sf):
    return matrix(spark, sf)


@check(
    "per_class_metrics",
    "flag:s cls:i precision:d recall:d f1:d support:i",
    f"WITH {GRID_SQL} SELECT * FROM rated",
)
def _(spark, sf):
    return evaluation.per_class_metrics(matrix(spark, sf), by=["flag"])


@check(
    "classification_metrics",
    "flag:s accuracy:d balanced_accuracy:d macro_precision:d macro_recall:d macro_f1:d weighted_precision:d weighted_recall:d weighted_f1:d",
    f"WITH {GRID_SQL} SELECT * FROM overall",
)
def _(spark, sf):
    return evaluation.classification_metrics(matrix(spark, sf), by=["flag"])


@check(
    "alert_metrics",
    "flag:s level:s tp:i fp:i fn:i tn:i precision:d recall:d f1:d",
    f"WITH {GRID_SQL} SELECT * FROM alerts",
)
def _(spark, sf):
    return evaluation.alert_metrics(matrix(spark, sf), by=["flag"])


VALUES_SQL = (
    f"{GRID_SQL}, vals AS (SELECT flag, unnest(['accuracy','balanced_accuracy','macro_precision','macro_recall','macro_f1','weighted_precision','weighted_recall','weighted_f1']) AS name, "
    "unnest([accuracy, balanced_accuracy, macro_precision, macro_recall, macro_f1, weighted_precision, weighted_recall, weighted_f1]) AS value FROM overall UNION ALL "
    "SELECT flag, 'class_' || cls || '_' || unnest(['precision','recall','f1','support']), unnest([precision, recall, f1, CAST(support AS DOUBLE)]) FROM rated UNION ALL "
    "SELECT flag, level || '_' || unnest(['precision','recall','f1']), unnest([precision, recall, f1]) FROM alerts)"
)


@check("metric_values", "flag:s name:s value:d", f"WITH {VALUES_SQL} SELECT * FROM vals")
def _(spark, sf):
    return evaluation.metric_values(matrix(spark, sf), by=["flag"])


@check(
    "business_score",
    "flag:s business_score:d",
    f"WITH {VALUES_SQL} SELECT flag, sum(value * CASE name WHEN 'macro_f1' THEN 0.15 WHEN 'balanced_accuracy' THEN 0.15 WHEN 'class_0_f1' THEN 0.15 "
    "WHEN 'class_1_f1' THEN 0.2 WHEN 'class_2_f1' THEN 0.2 WHEN 'alert_24h_f1' THEN 0.15 ELSE 0 END) AS business_score FROM vals GROUP BY 1",
)
def _(spark, sf):
    return evaluation.business_score(evaluation.metric_values(matrix(spark, sf), by=["flag"]), by=["flag"])


for _mode, _factors in (
    ("balanced", [1, 1, 1, 1, 1, 1]),
    ("alert_priority", [1.0, 1.2, 1.4, 1.8, 2.2, 2.8]),
    ("early_warning_priority", [1.5, 2.0, 1.8, 1.5, 1.3, 1.2]),
):

    def _weights(spark, sf, mode=_mode):
        li = table(spark, sf, "lineitem").withColumn("y", F.round(F.col("l_discount") * 100).cast("int") % 5)
        return evaluation.class_weights(li, mode)

    check(
        f"class_weights_{_mode}",
        "y:i weight:d",
        f"WITH {PAIRS_SQL}, f AS (SELECT unnest(range(6)) AS y, unnest([{', '.join(str(float(v)) for v in _factors)}]) AS factor), c AS (SELECT yhat AS y, count(*) AS n FROM pairs GROUP BY 1) "
        "SELECT y, coalesce((SELECT count(*) FROM pairs) / (6 * n) * factor, 0) AS weight FROM f LEFT JOIN c USING (y)",
    )(_weights)


SWEEP = [round(0.02 * i, 2) for i in range(1, 8)]
SWEEP_SQL = (
    "s AS (SELECT threshold, count(*) FILTER (p >= threshold AND a) AS tp, count(*) FILTER (p >= threshold AND NOT a) AS fp, "
    "count(*) FILTER (p < threshold AND a) AS fn, count(*) FILTER (p < threshold AND NOT a) AS tn FROM (SELECT l_tax + l_discount AS p, l_returnflag = 'R' AS a FROM lineitem) "
    f"CROSS JOIN (SELECT unnest([{', '.join(f'CAST({t} AS DOUBLE)' for t in SWEEP)}]) AS threshold) GROUP BY 1), "
    "sweep AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall, "
    "CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1 FROM s)"
)
SWEEP_SPEC = "threshold:d tp:i fp:i fn:i tn:i precision:d recall:d f1:d"


def sweep(spark, sf):
    li = table(spark, sf, "lineitem").select((F.col("l_tax") + F.col("l_discount")).alias("p_alert"), (F.col("l_returnflag") == "R").alias("actual"))
    return evaluation.threshold_sweep(li, SWEEP)


@check("threshold_sweep", SWEEP_SPEC, f"WITH {SWEEP_SQL} SELECT * FROM sweep")
def _(spark, sf):
    return sweep(spark, sf)


@check("threshold_winner", SWEEP_SPEC, f"WITH {SWEEP_SQL} SELECT * FROM sweep WHERE recall >= 0.8 ORDER BY f1 DESC, threshold DESC LIMIT 1")
def _(spark, sf):
    return evaluation.threshold_winner(sweep(spark, sf))


REG_SQL = "SELECT {by} count(*) AS n, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, 1 - avg(e * e) / var_pop(y) AS r2 FROM (SELECT *, l_quantity * 1500 - l_extendedprice AS e, l_extendedprice AS y FROM lineitem)"


@check("regression_metrics", "n:i mae:d rmse:d r2:d", REG_SQL.format(by=""))
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("yhat"))
    return evaluation.regression_metrics(li)


# hours as targets: metrics per horizon band
BAND_SQL = "CASE WHEN l_quantity <= 6 THEN 5 WHEN l_quantity <= 12 THEN 4 WHEN l_quantity <= 24 THEN 3 WHEN l_quantity <= 36 THEN 2 WHEN l_quantity <= 48 THEN 1 END"


@check(
    "regression_metrics_by_band",
    "band:i n:i mae:d rmse:d r2:d",
    f"SELECT band, count(*) AS n, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, 1 - avg(e * e) / var_pop(l_quantity) AS r2 FROM (SELECT l_quantity, {BAND_SQL} AS band, l_linenumber * 7 - l_quantity AS e FROM (SELECT least(l_quantity, 48) AS l_quantity, l_linenumber FROM lineitem)) GROUP BY 1",
)
def _(spark, sf):
    from tremorloom.functions.labels import horizon_label

    li = table(spark, sf, "lineitem")
    pairs = li.select(F.least("l_quantity", F.lit(48.0)).alias("y"), (F.col("l_linenumber") * 7).alias("yhat"))
    return evaluation.regression_metrics(pairs.withColumn("band", horizon_label("y")), by=["band"])


# months as epochs, lines per month as the metric of each supplier's run
@check(
    "early_stop_epoch",
    "run_id:i best_value:d best_epoch:i stop_epoch:i n_epochs:i",
    "WITH RECURSIVE h AS (SELECT l_suppkey AS run_id, year(l_shipdate) * 12 + month(l_shipdate) AS epoch, CAST(count(*) AS DOUBLE) AS v FROM lineitem GROUP BY 1, 2), "
    "o AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY epoch) AS i, count(*) OVER (PARTITION BY run_id) AS n FROM h), "
    "f AS (SELECT run_id, i, n, v AS best, epoch AS best_epoch, 0 AS waited, CAST(NULL AS BIGINT) AS stop_epoch FROM o WHERE i = 1 UNION ALL "
    "SELECT o.run_id, o.i, o.n, CASE WHEN stop_epoch IS NULL AND v - best > 0.5 THEN v ELSE best END, CASE WHEN stop_epoch IS NULL AND v - best > 0.5 THEN epoch ELSE best_epoch END, "
    "CASE WHEN stop_epoch IS NOT NULL THEN waited WHEN v - best > 0.5 THEN 0 ELSE waited + 1 END, "
    "CASE WHEN stop_epoch IS NOT NULL THEN stop_epoch WHEN v - best > 0.5 THEN NULL WHEN waited + 1 >= 12 THEN epoch END FROM f JOIN o ON o.run_id = f.run_id AND o.i = f.i + 1) "
    "SELECT run_id, best AS best_value, best_epoch, stop_epoch, n AS n_epochs FROM f WHERE i = n",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    history = li.groupBy(F.col("l_suppkey").alias("run_id"), (F.year("l_shipdate") * 12 + F.month("l_shipdate")).alias("epoch")).agg(
        F.count(F.lit(1)).cast("double").alias("score")
    )
    return evaluation.early_stop_epoch(history, "score", patience=12, min_delta=0.5)
