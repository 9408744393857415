"""Alert rule, evaluation, drift and decisions on hand-computed cases."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tremorloom.functions.arrays import softmax
from tremorloom.operators import decision, drift, evaluation, scoring
from tremorloom.plans import jobs

ROWS = [
    [0.80, 0.10, 0.05, 0.02, 0.02, 0.01],
    [0.20, 0.20, 0.20, 0.15, 0.15, 0.10],
    [0.30, 0.20, 0.15, 0.20, 0.10, 0.05],
]


def batch(spark, rows=ROWS):
    return spark.createDataFrame([("b", i, r) for i, r in enumerate(rows)], "batch_id string, sequence_index int, probabilities array<double>")


def test_alert_is_inclusive(spark):
    rows = scoring.alert(batch(spark)).orderBy("sequence_index").collect()
    assert [r["p_alert_24h"] for r in rows] == pytest.approx([0.05, 0.40, 0.35])
    assert [r["alert_24h"] for r in rows] == [False, True, True]


def test_batch_aggregations(spark):
    of = lambda how, rows=ROWS: scoring.aggregate_batch(batch(spark, rows), how).first()
    assert of("last")["probabilities"] == ROWS[2] and of("last")["selected_index"] == 2
    assert of("mean")["probabilities"] == pytest.approx(list(np.mean(ROWS, axis=0))) and of("mean")["selected_index"] is None
    assert of("max_alert")["selected_index"] == 1
    assert of("max_alert", [ROWS[1], ROWS[1]])["selected_index"] == 0
    with pytest.raises(ValueError):
        of("median")


def test_first_class_wins_a_tie(spark):
    r = scoring.predicted_class(batch(spark, [[0.05, 0.10, 0.15, 0.20, 0.25, 0.25]])).first()
    assert (r["predicted_class"], r["predicted_probability"]) == (4, 0.25)


def test_softmax_survives_large_scores(spark):
    got = spark.createDataFrame([([1001.0, 1002.0, 1003.0],)], "s array<double>").select(softmax("s")).first()[0]
    want = np.exp([-2, -1, 0]) / np.exp([-2, -1, 0]).sum()
    np.testing.assert_allclose(got, want)


def test_prediction_job_and_bad_models(spark):
    x = spark.createDataFrame([(i, [[float(i), 1.0]] * 3) for i in range(5)], "seq_id long, x array<array<float>>")

    class Model:
        def predict(self, a):
            assert a.shape[1:] == (3, 2) and a.dtype == np.float32
            return np.stack([a[:, 0, 0] * k for k in range(6)], axis=1)

    rows = jobs.predict_alerts(x, Model(), is_logits=True).orderBy("seq_id").collect()
    assert [r["predicted_class"] for r in rows] == [0, 5, 5, 5, 5] and rows[0]["p_alert_24h"] == pytest.approx(0.5)
    with pytest.raises(Exception, match="returned shape"):
        jobs.predict_alerts(x, lambda a: np.zeros((len(a), 3))).collect()
    with pytest.raises(Exception, match="bad probabilities: sum"):
        jobs.predict_alerts(x, lambda a: np.full((len(a), 6), 0.5)).collect()
    with pytest.raises(ValueError):
        scoring.alert(batch(spark), min_class=6)


def test_published_metrics_fixture(spark):
    cells = [(1, 1, 705), (0, 1, 389), (1, 0, 159), (0, 0, 1247)]
    # class 3 stands for an alert, class 0 for none
    m = spark.createDataFrame([(3 * y, 3 * p, n) for y, p, n in cells], "y int, yhat int, n long")
    r = evaluation.alert_metrics(m).where("level = 'alert_24h'").first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (705, 389, 159, 1247)
    assert r["precision"] == pytest.approx(0.6444241316270567, abs=1e-12)
    assert r["recall"] == pytest.approx(0.8159722222222222, abs=1e-12)
    assert r["f1"] == pytest.approx(0.7201225740551583, abs=1e-12)


def test_metrics_where_classes_are_absent(spark):
    pairs = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "y int, yhat int")
    m = evaluation.confusion_matrix(pairs)
    assert m.count() == 36 and m.agg(F.sum("n")).first()[0] == 4
    r = evaluation.classification_metrics(m).first()
    # classes 0, 1, 2 occur; recalls 1/2, 1, 0; precisions 1, 1/3, 0
    assert r["accuracy"] == pytest.approx(0.5) and r["balanced_accuracy"] == pytest.approx(0.5)
    assert r["macro_precision"] == pytest.approx((1 + 1 / 3) / 3) and r["macro_f1"] == pytest.approx((2 / 3 + 0.5) / 3)
    assert r["weighted_precision"] == pytest.approx((2 * 1 + 1 / 3) / 4)
    assert evaluation.per_class_metrics(m).where("cls = 5").first()["f1"] == 0


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 3 + [(5,)], "y int")
    w = {r["y"]: r["weight"] for r in evaluation.class_weights(df, "alert_priority").collect()}
    assert w == pytest.approx({0: 10 / 36, 1: 10 / 18 * 1.2, 2: 0, 3: 0, 4: 0, 5: 10 / 6 * 2.8})
    assert evaluation.class_weights(df, "none").count() == 0


@pytest.mark.parametrize("metric,values,best,stop", [
    ("f1", [0.1, 0.3, 0.305, 0.2, 0.31, 0.9], (2, 0.3), 5),
    ("val_loss", [5.0, 4.0, 4.5, 3.0], (4, 3.0), None),
])
def test_early_stop(spark, metric, values, best, stop):
    df = spark.createDataFrame([("r", i + 1, v) for i, v in enumerate(values)], f"run_id string, epoch int, {metric} double")
    r = evaluation.early_stop_epoch(df, metric, patience=3, min_delta=0.02).first()
    assert (r["best_epoch"], r["best_value"], r["stop_epoch"]) == (*best, stop)


def test_flat_reference_drifts_only_when_the_mean_moves(spark):
    def verdict(ref, cand):
        rows = [("reference", "f", v) for v in ref] + [("candidate", "f", v) for v in cand]
        return drift.feature_drift(spark.createDataFrame(rows, "dataset string, feature string, v double")).first()

    assert not verdict([1.0, 1.0], [1.0, 1.0])["drifted"]
    moved = verdict([1.0, 1.0], [1.5])
    assert moved["drifted"] and moved["standardized_mean_diff"] is None
    assert verdict([1.0], [math.nan])["drifted"]
    assert not verdict([0.0, 2.0], [1.4])["drifted"] and verdict([0.0, 2.0], [1.6])["drifted"]


def test_ks_and_psi_against_numpy(spark):
    rng = np.random.default_rng(5)
    ref, cand = rng.normal(0, 1, 400).astype(np.float32), np.append(rng.normal(0.4, 2, 300), [0, 0, -3e5]).astype(np.float32)
    rows = [("reference", "f", float(v)) for v in ref] + [("candidate", "f", float(v)) for v in cand]
    df = spark.createDataFrame(rows, "dataset string, feature string, v double")
    r = drift.distribution_drift(df).first()
    grid = np.concatenate([ref, cand])
    gap = lambda v: np.abs((ref <= v).mean() - (cand <= v).mean())
    assert r["ks"] == pytest.approx(max(gap(v) for v in grid))
    cuts = np.quantile(ref.astype(float), np.arange(1, 10) / 10)
    share = lambda a: np.maximum(np.bincount(np.searchsorted(cuts, a, side="left"), minlength=10) / len(a), 1e-4)
    p, q = share(ref.astype(float)), share(cand.astype(float))
    assert r["psi"] == pytest.approx(((q - p) * np.log(q / p)).sum())


@pytest.mark.parametrize("n,m", [(10, 4), (1000, 7), (5000, 4999), (12345, 678), (9, 1), (3, 5)])
def test_even_rows_equal_linspace(spark, n, m):
    df = spark.range(n).withColumnRenamed("id", "row_index")
    got = sorted(r["row_index"] for r in drift.limit_rows_even(df, n, m).collect())
    want = list(range(n)) if n <= m else sorted(set(np.linspace(0, n - 1, num=m, dtype=int).tolist()))
    assert got == want


def test_sample_is_deterministic_and_whole_when_small(spark):
    df = spark.range(100).select(F.col("id").alias("seq_id"), F.when(F.col("id") < 90, "train").otherwise("val").alias("split"))
    once = {r["seq_id"] for r in drift.sample_sequences(df, 20, 1).collect()}
    again = {r["seq_id"] for r in drift.sample_sequences(df.repartition(7), 20, 1).collect()}
    assert once == again and len(once) == 30 and once != {r["seq_id"] for r in drift.sample_sequences(df, 20, 2).collect()}


def test_prediction_drift_uses_the_split_of_equal_size(spark):
    targets = spark.createDataFrame([("train", 0)] * 5 + [("val", 1)] * 3 + [("test", 2)] * 3, "split string, y int")
    predicted = spark.createDataFrame([(1,), (1,), (2,)], "yhat int")
    r = drift.prediction_drift(predicted, targets).first()
    assert r["reference_split"] == "val" and r["distance"] == pytest.approx(1 / 3) and r["prediction_drift"]
    assert drift.prediction_drift(predicted.limit(2), targets).first()["reference_split"] == "all_splits"


CHAMPION = dict(business_score=0.2189, alert_24h_f1=0.7201, alert_24h_recall=0.8159, alert_24h_precision=0.6444, class_5_f1=0.2286)
GOOD = dict(CHAMPION, candidate_id=0, family="f", status="success", dry_run=False, epochs=2, drift_status="success", critical_drift=False, rejected_by_drift=False)
SINGLE = [
    ("candidate_training_success", dict(status="failed")),
    ("candidate_not_dry_run", dict(dry_run=True)),
    ("candidate_not_dry_run", dict(dry_run=None)),
    ("minimum_epochs_for_promotion", dict(epochs=1)),
    ("business_score_not_lower_than_champion", dict(business_score=0.2188)),
    ("alert_24h_f1_not_degraded", dict(alert_24h_f1=0.70)),
    ("alert_24h_recall_minimum", dict(alert_24h_recall=0.69)),
    ("alert_24h_precision_minimum", dict(alert_24h_precision=0.39)),
    ("class_5_f1_not_degraded", dict(class_5_f1=0.17)),
    ("drift_summary_success", dict(drift_status=None)),
    ("no_critical_drift_detected", dict(critical_drift=True)),
    ("candidate_not_rejected_by_drift_check", dict(rejected_by_drift=True)),
]


def test_each_rule_rejects_alone(spark):
    rows = [dict(GOOD)] + [dict(GOOD, candidate_id=i, **change) for i, (_, change) in enumerate(SINGLE, start=1)]
    rows += [dict(GOOD, candidate_id=50, class_5_f1=None), dict(GOOD, candidate_id=51, business_score=None)]
    schema = (
        "candidate_id int, family string, status string, dry_run boolean, epochs int, business_score double, alert_24h_f1 double, alert_24h_recall double, "
        "alert_24h_precision double, class_5_f1 double, drift_status string, critical_drift boolean, rejected_by_drift boolean"
    )
    names = [f.split()[0] for f in schema.split(", ")]
    candidates = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)
    champion = spark.createDataFrame([("f", *CHAMPION.values())], "family string, " + ", ".join(f"{k} double" for k in CHAMPION))
    rules = decision.compare_candidates(candidates, champion, "family")
    verdicts = {r["candidate_id"]: r for r in decision.decide(rules).collect()}
    assert verdicts[0]["decision"] == "promote_candidate" and verdicts[0]["failed_rules"] == ""
    for i, (rule, _) in enumerate(SINGLE, start=1):
        assert verdicts[i]["failed_rules"] == rule, rule
    assert verdicts[50]["eligible_for_promotion"]
    assert rules.where("candidate_id = 50 AND rule = 'class_5_f1_not_degraded'").first()["passed"] is None
    assert verdicts[51]["failed_rules"] == "required_metrics_available, business_score_not_lower_than_champion"


def test_candidate_epochs_from_the_command(spark):
    texts = [
        '{"epochs": 7}',
        '{"training_parameters": {"epochs": "9"}}',
        '{"command": ["python", "--epochs", "12"]}',
        '{"command": ["python", "--epochs=3"]}',
        '{"command": "none"}',
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, result string")
    got = {r["i"]: r["epochs"] for r in decision.candidate_metrics(df).collect()}
    assert got == {0: 7, 1: 9, 2: 12, 3: 3, 4: None}


def test_promotion_keeps_old_metrics_where_the_candidate_has_none(spark):
    metrics = ", ".join(f"{m} double" for m in decision.METRICS)
    registry = spark.createDataFrame([("f", 1, 0.1, 0.1, 0.1, 0.1, 0.1), ("f", 2, 0.2, 0.2, 0.2, 0.2, 0.2)], f"family string, version int, {metrics}")
    cand = spark.createDataFrame([("f", 1, 0.4, 0.5, 0.5, 0.5, None), ("f", 2, 0.9, 0.9, 0.9, 0.9, 0.9)], f"family string, candidate_id int, {metrics}")
    verdict = spark.createDataFrame([(1, True), (2, False)], "candidate_id int, eligible_for_promotion boolean")
    row = decision.promote(registry, cand, verdict, F.lit("2026-01-01").cast("timestamp"), "family").first()
    assert (row["version"], row["replaces_version"], row["candidate_id"], row["business_score"], row["class_5_f1"]) == (3, 2, 1, 0.4, 0.2)


def test_best_run_uses_the_first_available_score(spark):
    df = spark.createDataFrame([("m", 1, "0.3"), ("m", 2, "0.7"), ("m", 3, "n/a"), ("k", 4, None)], "model string, run int, test_macro_f1 string")
    best = decision.best_runs(df, "model", ["test_business_score_classification", "test_alert_24h_f1", "test_macro_f1"], "run")
    assert {r["model"]: r["run"] for r in best.collect()} == {"m": 2, "k": 4}
