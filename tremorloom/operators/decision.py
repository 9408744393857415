"""Run selection, candidate-versus-champion rules, promotion, and audit rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorloom.functions.jsonpaths import first_number, nested
from tremorloom.functions.numeric import finite

METRICS = ["business_score", "alert_24h_f1", "alert_24h_recall", "alert_24h_precision", "class_5_f1"]
REQUIRED_METRICS = METRICS[:4]

# fixed values: where reports keep each metric, in order of preference
CANDIDATE_PATHS = {
    "business_score": [
        ["metrics", "test", "business_score_classification"],
        ["metrics", "business_score_classification"],
        ["test_business_score_classification"],
        ["business_score_classification"],
    ],
    "alert_24h_f1": [["metrics", "test", "alert_24h_f1"], ["metrics", "alert_24h_f1"], ["alert_24h_f1"], ["f1_alert_24h"]],
    "alert_24h_recall": [
        ["metrics", "test", "alert_24h_recall"],
        ["metrics", "alert_24h_recall"],
        ["alert_24h_recall"],
        ["recall_alert_24h"],
    ],
    "alert_24h_precision": [
        ["metrics", "test", "alert_24h_precision"],
        ["metrics", "alert_24h_precision"],
        ["alert_24h_precision"],
        ["precision_alert_24h"],
    ],
    "class_5_f1": [["metrics", "test", "class_5_f1"], ["metrics", "class_5_f1"], ["test_class_5_f1"], ["class_5_f1"]],
}
CHAMPION_PATHS = {
    "business_score": [
        ["test_business_score_classification"],
        ["business_score_classification"],
        ["metrics", "test", "business_score_classification"],
        ["metrics", "business_score_classification"],
    ],
    "alert_24h_f1": [["f1_alert_24h"], ["alert_24h_f1"], ["metrics", "test", "alert_24h_f1"], ["metrics", "alert_24h_f1"]],
    "alert_24h_recall": [
        ["recall_alert_24h"],
        ["alert_24h_recall"],
        ["metrics", "test", "alert_24h_recall"],
        ["metrics", "alert_24h_recall"],
    ],
    "alert_24h_precision": [
        ["precision_alert_24h"],
        ["alert_24h_precision"],
        ["metrics", "test", "alert_24h_precision"],
        ["metrics", "alert_24h_precision"],
    ],
    "class_5_f1": [["test_class_5_f1"], ["class_5_f1"], ["metrics", "test", "class_5_f1"], ["metrics", "class_5_f1"]],
}
EPOCH_PATHS = [["epochs"], ["training_parameters", "epochs"], ["hyperparameters", "epochs"]]
CHAMPION_SECTIONS = ["classification_candidate", "champion"]


@dataclass(frozen=True)
class Policy:
    """Promotion limits."""

    min_epochs: int = 2
    max_business_score_drop: float = 0.0
    max_alert_24h_f1_drop: float = 0.02
    min_alert_24h_recall: float = 0.70
    min_alert_24h_precision: float = 0.40
    max_class_5_f1_drop: float = 0.05


# fixed values: selection names that stand for a model family and a class weighting
RUN_SELECTIONS = {
    "cnn_transformer_alert_priority": ("cnn_transformer", "alert_priority"),
    "cnn_transformer_none": ("cnn_transformer", "none"),
}


def select_runs(runs: DataFrame, selection: str) -> DataFrame:
    """Runs that a selection name stands for, or else those with the name in any of their columns."""
    if selection in RUN_SELECTIONS:
        family, weighting = RUN_SELECTIONS[selection]
        return runs.where((F.col("model_family") == family) & (F.col("class_weighting") == weighting))
    row_text = F.concat_ws(" ", *[F.col(c).cast("string") for c in runs.columns])
    return runs.where(F.contains(row_text, F.lit(selection)))


def best_runs(runs: DataFrame, selection: str, scores: Sequence[str], tie: str) -> DataFrame:
    """Best row per selection by the first score column that exists, highest first, missing last.

    A grouped maximum with map-side combine, not a sort of each group.
    """
    score = next((c for c in scores if c in runs.columns), None)
    numeric = F.lit(0.0) if score is None else F.coalesce(
        finite(F.col(score).try_cast("double")), F.lit(float("-inf"))
    )
    whole = F.struct(*runs.columns)
    rank = F.struct((-numeric).alias("s"), F.col(tie).alias("t"))  # the tie may be text
    return runs.groupBy(F.col(selection).alias("_sel")).agg(F.min_by(whole, rank).alias("_best")).select("_best.*")


def candidate_metrics(results: DataFrame, json: str = "result") -> DataFrame:
    """Typed candidate columns from training-result JSON."""
    command = F.coalesce(F.from_json(nested(json, ["command"]), "array<string>"), F.array().cast("array<string>"))
    after_flag = F.try_element_at(command, F.array_position(command, F.lit("--epochs")).cast("int") + 1)
    spaced = F.when(F.array_contains(command, "--epochs"), after_flag)
    joined = F.get(F.filter(command, lambda a: a.startswith("--epochs=")), F.lit(0))
    from_command = F.coalesce(spaced, F.regexp_extract(joined, "^--epochs=(.*)$", 1))
    epochs = F.coalesce(first_number(json, EPOCH_PATHS), from_command.try_cast("int").cast("double"))
    return results.withColumns(
        {
            "status": nested(json, ["status"]),
            # a JSON boolean; the text "false" isn't one, and an unknown flag fails the rule
            "dry_run": F.from_json(F.col(json), "dry_run boolean")["dry_run"],
            "epochs": epochs.cast("int"),
            **{m: first_number(json, paths) for m, paths in CANDIDATE_PATHS.items()},
        }
    )


def champion_metrics(decisions: DataFrame, json: str = "decision") -> DataFrame:
    """Typed champion columns from decision JSON (its champion section, or the document itself)."""
    section = F.coalesce(*[nested(json, [s]) for s in CHAMPION_SECTIONS], F.col(json))
    with_section = decisions.withColumn("_section", section)
    return with_section.withColumns({m: first_number("_section", p) for m, p in CHAMPION_PATHS.items()}).drop("_section")


def compare_candidates(
    candidates: DataFrame, champion: DataFrame, on: str, policy: Policy = Policy(), key: str = "candidate_id"
) -> DataFrame:
    """Rule rows ``(key, rule_order, rule, passed, candidate, limit)``; ``passed`` is NULL for a skipped rule.

    ``on`` is the column that pairs a candidate with its champion (a model family). A candidate without
    champion has NULL champion metrics and fails the relative rules.
    """
    renamed = champion.select(on, *[F.col(m).alias(f"champion_{m}") for m in METRICS])
    both = candidates.join(renamed, on, "left")
    ok = lambda c: F.coalesce(c, F.lit(False))
    null = F.lit(None).cast("double")

    def relative(metric: str, drop: float) -> tuple[Column, Column, Column]:
        limit = F.col(f"champion_{metric}") - drop
        return ok(F.col(metric) >= limit), F.col(metric), limit

    def minimum(metric: str, limit: float) -> tuple[Column, Column, Column]:
        return ok(F.col(metric) >= limit), F.col(metric), F.lit(limit)

    present = F.lit(True)
    for m in REQUIRED_METRICS:
        present = present & F.col(m).isNotNull() & F.col(f"champion_{m}").isNotNull()
    class_5 = relative("class_5_f1", policy.max_class_5_f1_drop)
    class_5_known = F.col("class_5_f1").isNotNull() & F.col("champion_class_5_f1").isNotNull()
    # fixed values: the rule names
    rules: list[tuple[str, Column, Column, Column]] = [
        ("candidate_training_success", ok(F.col("status") == "success"), null, null),
        ("candidate_not_dry_run", ok(~F.col("dry_run")), null, null),
        (
            "minimum_epochs_for_promotion",
            ok(F.col("epochs") >= policy.min_epochs),
            F.col("epochs").cast("double"),
            F.lit(float(policy.min_epochs)),
        ),
        ("required_metrics_available", present, null, null),
        ("business_score_not_lower_than_champion", *relative("business_score", policy.max_business_score_drop)),
        ("alert_24h_f1_not_degraded", *relative("alert_24h_f1", policy.max_alert_24h_f1_drop)),
        ("alert_24h_recall_minimum", *minimum("alert_24h_recall", policy.min_alert_24h_recall)),
        ("alert_24h_precision_minimum", *minimum("alert_24h_precision", policy.min_alert_24h_precision)),
        ("class_5_f1_not_degraded", F.when(class_5_known, class_5[0]), class_5[1], class_5[2]),
        ("drift_summary_success", ok(F.col("drift_status") == "success"), null, null),
        ("no_critical_drift_detected", ~ok(F.col("critical_drift")), null, null),
        ("candidate_not_rejected_by_drift_check", ~ok(F.col("rejected_by_drift")), null, null),
    ]
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("rule_order"),
                F.lit(name).alias("rule"),
                passed.alias("passed"),
                value.cast("double").alias("candidate"),
                limit.cast("double").alias("limit"),
            )
            for i, (name, passed, value, limit) in enumerate(rules)
        ]
    )
    return both.select(key, F.explode(entries).alias("_r")).select(key, "_r.*")


def decide(rules: DataFrame, key: str = "candidate_id") -> DataFrame:
    """Promote iff no rule failed: rows ``(key, eligible_for_promotion, decision, failed_rules)``."""
    failed = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.struct("rule_order", "rule"))))
    eligible = F.bool_and(F.coalesce("passed", F.lit(True)))
    return rules.groupBy(key).agg(
        eligible.alias("eligible_for_promotion"),
        F.when(eligible, "promote_candidate").otherwise("reject_candidate").alias("decision"),
        F.array_join(F.transform(failed, lambda r: r["rule"]), ", ").alias("failed_rules"),
    )


def promote(
    registry: DataFrame, candidates: DataFrame, decisions: DataFrame, promoted_at: Column, on: str, key: str = "candidate_id"
) -> DataFrame:
    """New champion rows to append to the registry.

    The registry is append-only with ``(on, version, metrics, ...)``; its newest version is the champion. For
    each approved candidate (the best business score when a family has several) the new row takes the
    candidate's metric where it has one and the champion's otherwise, and names the version it replaces.
    """
    current = registry.groupBy(on).agg(F.max_by(F.struct("version", *METRICS), "version").alias("_old"))
    approved = candidates.join(decisions.where("eligible_for_promotion").select(key), key, "left_semi")
    chosen = approved.groupBy(on).agg(
        F.min_by(F.struct(key, *METRICS), F.struct(-F.coalesce("business_score", F.lit(float("-inf"))), F.col(key))).alias("_new")
    )
    return chosen.join(current, on, "left").select(
        on,
        (F.coalesce("_old.version", F.lit(0)) + 1).alias("version"),
        F.col(f"_new.{key}").alias(key),
        *[F.coalesce(F.col(f"_new.{m}"), F.col(f"_old.{m}")).alias(m) for m in METRICS],
        F.col("_old.version").alias("replaces_version"),
        promoted_at.alias("promoted_at_utc"),
    )


def promotion_action(comparisons: DataFrame) -> DataFrame:
    """``action`` and ``reason`` for comparison rows ``(status, decision, eligible_for_promotion)``."""
    bad = ~F.coalesce(F.col("status") == "success", F.lit(False))
    approved = (F.col("decision") == "promote_candidate") & F.col("eligible_for_promotion")
    return comparisons.withColumns(
        {
            "action": F.when(~bad & F.coalesce(approved, F.lit(False)), "candidate_promoted").otherwise("promotion_skipped"),
            "reason": F.when(bad, "comparison_status_is_not_success").when(
                ~F.coalesce(approved, F.lit(False)), "candidate_not_eligible_for_promotion"
            ),
        }
    )


def audit_rows(reports: DataFrame, key: str, metrics: Sequence[str], flags: Sequence[str], tags: Sequence[str], params: Sequence[str], tag_chars: int | None = None, param_chars: int | None = None) -> DataFrame:
    """Flat ``(key, kind, name, value, text)`` rows of report columns.

    Numbers that are not finite are left out, booleans become 0/1, empty tags are left out. Texts are whole unless
    ``tag_chars`` or ``param_chars`` ask for a cut, as a tracking server may.
    """
    cut = lambda s, chars: s if chars is None else F.substring(s, 1, chars)
    number = lambda n, c: F.struct(F.lit("metric").alias("kind"), F.lit(n).alias("name"), c.alias("value"), F.lit(None).cast("string").alias("text"))
    text = lambda kind, n, c: F.struct(F.lit(kind).alias("kind"), F.lit(n).alias("name"), F.lit(None).cast("double").alias("value"), c.alias("text"))
    entries = [F.when(finite(m).isNotNull(), number(m, finite(m).cast("double"))) for m in metrics]
    entries += [F.when(F.col(f).isNotNull(), number(f, F.col(f).cast("int").cast("double"))) for f in flags]
    for t in tags:
        s = F.col(t).cast("string")
        entries.append(F.when(s.isNotNull() & (s != "") & (s != "None"), text("tag", t, cut(s, tag_chars))))
    for p in params:
        s = F.col(p).cast("string")
        entries.append(F.when(s.isNotNull(), text("param", p, cut(s, param_chars))))
    return reports.select(key, F.explode(F.array_compact(F.array(*entries))).alias("_a")).select(key, "_a.*")
