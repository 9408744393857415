"""Classification, alert and regression metrics.

Everything about classes derives from the confusion matrix, a table of at most ``n_classes**2`` rows per
group, so the data are read once whatever the number of metrics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorloom.functions.numeric import ratio
from tremorloom.schemas import BUSINESS_SCORE_WEIGHTS, CLASS_MULTIPLIERS, N_CLASSES

# fixed values: alert horizons and the lowest class that counts as an alert
ALERT_LEVELS = {"alert": 1, "alert_24h": 3, "alert_12h": 4, "alert_6h": 5}


def class_weights(train: DataFrame, mode: str, n_classes: int = N_CLASSES, column: str = "y") -> DataFrame:
    """Loss weight per class: rows ``(y, weight)``; no row for mode ``none``, 0 for absent classes."""
    spark = train.sparkSession
    if mode == "none":
        return spark.createDataFrame([], "y int, weight double")
    if mode not in CLASS_MULTIPLIERS:
        raise ValueError(f"unknown class weighting: {mode}")
    factors = spark.createDataFrame(list(enumerate(CLASS_MULTIPLIERS[mode][:n_classes])), "y int, factor double")
    totals = train.agg(*[F.count_if(F.col(column) == c).alias(f"_n{c}") for c in range(n_classes)])
    every = sum((F.col(f"_n{c}") for c in range(1, n_classes)), F.col("_n0"))
    counts = totals.select(
        every.alias("total"),
        F.posexplode(F.array(*[F.col(f"_n{c}") for c in range(n_classes)])).alias("y", "n"),
    )
    weight = F.when(F.col("n") > 0, F.col("total") / (n_classes * F.col("n")) * F.col("factor")).otherwise(F.lit(0.0))
    return counts.join(factors, "y").select("y", weight.alias("weight"))


def confusion_matrix(
    df: DataFrame, n_classes: int = N_CLASSES, y: str = "y", yhat: str = "yhat", by: Sequence[str] = ()
) -> DataFrame:
    """Full grid ``(*by, y, yhat, n)`` with zeros.

    Every pair counts: a class of ``n_classes`` or more is kept as ``n_classes``, a negative or NULL one as -1. These
    cells appear only where there are such pairs.
    """

    def inside(column: str) -> Column:
        c = F.col(column).cast("int")
        return F.when(c >= n_classes, F.lit(n_classes)).when(c >= 0, c).otherwise(F.lit(-1))

    counts = df.groupBy(*by, inside(y).alias("y"), inside(yhat).alias("yhat")).agg(F.count(F.lit(1)).alias("n"))
    cells = F.explode(
        F.array(*[F.struct(F.lit(a).alias("y"), F.lit(b).alias("yhat")) for a in range(n_classes) for b in range(n_classes)])
    ).alias("_cell")
    groups = counts.select(*by).distinct() if by else df.sparkSession.range(1)
    grid = groups.select(*by, cells).select(*by, "_cell.*")
    zeros = grid.withColumn("n", F.lit(0).cast("bigint"))
    return zeros.unionByName(counts).groupBy(*by, "y", "yhat").agg(F.sum("n").alias("n"))


def per_class_metrics(matrix: DataFrame, n_classes: int = N_CLASSES, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every class, 0 where undefined."""
    return _rated_classes(matrix, n_classes, by).where(F.col("cls").between(0, n_classes - 1))


def _rated_classes(matrix: DataFrame, n_classes: int, by: Sequence[str]) -> DataFrame:
    """As ``per_class_metrics``, with a class for each overflow cell, which is never hit."""
    hit = (F.col("y") == F.col("yhat")) & F.col("y").between(0, n_classes - 1)
    cells = F.array(
        F.struct(F.col("y").alias("cls"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("predicted"), F.lit(0).cast("bigint").alias("hit")),
        F.struct(F.col("yhat").alias("cls"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("predicted"), F.when(hit, F.col("n")).otherwise(0).cast("bigint").alias("hit")),
    )
    sums = matrix.select(*by, F.explode(cells).alias("_c")).select(*by, "_c.*").groupBy(*by, "cls").agg(
        F.sum("actual").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit")
    )
    rated = sums.withColumns(
        {
            "precision": ratio("hit", "predicted"),
            "recall": ratio("hit", "support"),
            "f1": ratio(F.lit(2.0) * F.col("hit"), F.col("support") + F.col("predicted")),
        }
    )
    return rated.select(*by, "cls", "precision", "recall", "f1", "support", "predicted")


def classification_metrics(matrix: DataFrame, by: Sequence[str] = (), n_classes: int = N_CLASSES) -> DataFrame:
    """Accuracy, balanced accuracy, macro and weighted precision / recall / F1: one row per group.

    Macro averages run over classes that occur in targets or predictions, balanced accuracy over classes that
    occur in targets. Pairs with a class outside the grid count as misses of one more class.
    """
    classes = _rated_classes(matrix, n_classes, by)
    occurs = (F.col("support") > 0) | (F.col("predicted") > 0)
    macro = lambda c: F.avg(F.when(occurs, F.col(c)))
    weighted = lambda c: ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    return classes.groupBy(*by).agg(
        ratio(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        macro("precision").alias("macro_precision"),
        macro("recall").alias("macro_recall"),
        macro("f1").alias("macro_f1"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
        weighted("f1").alias("weighted_f1"),
    )


def _binary(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    return {
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(F.lit(2.0) * tp, F.lit(2.0) * tp + fp + fn),
    }


def alert_metrics(matrix: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Binary metrics of "class at or above the level" for each alert level: rows ``(*by, level, ...)``.

    A class above the grid is an alert, a negative or NULL one is none.
    """
    levels = F.explode(
        F.array(*[F.struct(F.lit(k).alias("level"), F.lit(v).alias("min_class")) for k, v in ALERT_LEVELS.items()])
    )
    cells = matrix.select(*by, "y", "yhat", "n", levels.alias("_l")).select(*by, "y", "yhat", "n", "_l.*")
    actual, said = F.col("y") >= F.col("min_class"), F.col("yhat") >= F.col("min_class")
    count = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    sums = cells.groupBy(*by, "level").agg(
        count(actual & said).alias("tp"),
        count(~actual & said).alias("fp"),
        count(actual & ~said).alias("fn"),
        count(~actual & ~said).alias("tn"),
    )
    rates = _binary(F.col("tp"), F.col("fp"), F.col("fn"))
    return sums.withColumns(rates)


def metric_values(matrix: DataFrame, by: Sequence[str] = (), n_classes: int = N_CLASSES) -> DataFrame:
    """All metrics as rows ``(*by, name, value)``."""
    overall = classification_metrics(matrix, by, n_classes)
    names = [c for c in overall.columns if c not in by]
    stacked = lambda df, pairs: df.select(
        *by, F.explode(F.array(*[F.struct(n.alias("name"), v.cast("double").alias("value")) for n, v in pairs])).alias("_m")
    ).select(*by, "_m.*")
    parts = [stacked(overall, [(F.lit(n), F.col(n)) for n in names])]
    cls_name = lambda m: F.concat(F.lit("class_"), F.col("cls").cast("string"), F.lit(f"_{m}"))
    parts.append(
        stacked(per_class_metrics(matrix, n_classes, by), [(cls_name(m), F.col(m)) for m in ("precision", "recall", "f1", "support")])
    )
    parts.append(
        stacked(alert_metrics(matrix, by), [(F.concat(F.col("level"), F.lit(f"_{m}")), F.col(m)) for m in ("precision", "recall", "f1")])
    )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def business_score(values: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Weighted score from ``metric_values``; absent metrics count 0."""
    weight = F.create_map(*[F.lit(p) for kv in BUSINESS_SCORE_WEIGHTS.items() for p in kv])
    terms = F.coalesce(F.try_element_at(weight, F.col("name")), F.lit(0.0)) * F.col("value")
    return values.groupBy(*by).agg(F.sum(terms).alias("business_score"))


def metric_mode(name: str) -> str:
    return "min" if name == "loss" or name.endswith("_loss") else "max"


def early_stop_epoch(
    history: DataFrame, metric: str, patience: int, min_delta: float = 0.0, by: Sequence[str] = ("run_id",)
) -> DataFrame:
    """Best epoch of each run and the epoch at which training stops.

    An epoch improves when it beats the best so far by more than ``min_delta``; training stops at the first
    epoch with ``patience`` epochs since the last improvement. The best value depends on the order, so each
    run's history (one entry per epoch) is folded from first to last.
    """
    sign = -1.0 if metric_mode(metric) == "min" else 1.0
    entry = F.struct(F.col("epoch").cast("int").alias("epoch"), (F.col(metric).cast("double") * sign).alias("v"))
    runs = history.groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("_h"))
    start = F.struct(
        F.lit(float("-inf")).alias("best"),
        F.lit(None).cast("int").alias("best_epoch"),
        F.lit(0).alias("waited"),
        F.lit(None).cast("int").alias("stop_epoch"),
    )

    def step(acc: Column, e: Column) -> Column:
        running = acc["stop_epoch"].isNull()
        better = running & (e["v"] - acc["best"] > min_delta)
        waited = F.when(better, F.lit(0)).when(running, acc["waited"] + 1).otherwise(acc["waited"])
        return F.struct(
            F.when(better, e["v"]).otherwise(acc["best"]).alias("best"),
            F.when(better, e["epoch"]).otherwise(acc["best_epoch"]).alias("best_epoch"),
            waited.alias("waited"),
            F.when(running & (waited >= patience), e["epoch"]).otherwise(acc["stop_epoch"]).alias("stop_epoch"),
        )

    folded = runs.withColumn("_r", F.aggregate("_h", start, step))
    return folded.select(
        *by,
        (F.col("_r.best") * sign).alias("best_value"),
        F.col("_r.best_epoch").alias("best_epoch"),
        F.col("_r.stop_epoch").alias("stop_epoch"),
        F.size("_h").alias("n_epochs"),
    )


def threshold_sweep(df: DataFrame, thresholds: Sequence[float], p: str = "p_alert", actual: str = "actual") -> DataFrame:
    """Confusion counts and rates of ``p >= threshold`` for each threshold.

    Each row only finds how many thresholds it reaches; counts per such position (at most one more than there
    are thresholds) are then accumulated, so cost does not grow with rows times thresholds.
    """
    grid = sorted(float(t) for t in thresholds)
    reached = F.size(F.filter(F.lit(grid), lambda t: F.col(p) >= t))
    counted = df.where(F.col(p).isNotNull()).groupBy(reached.alias("_k")).agg(
        F.count_if(F.col(actual)).alias("pos"), F.count_if(~F.col(actual)).alias("neg")
    )
    rows = counted.select(
        "_k", "pos", "neg", F.posexplode(F.lit(grid)).alias("_i", "threshold")
    )
    said = F.col("_k") > F.col("_i")
    count = lambda c, v: F.sum(F.when(c, F.col(v)).otherwise(0))
    sums = rows.groupBy("threshold").agg(
        count(said, "pos").alias("tp"),
        count(said, "neg").alias("fp"),
        count(~said, "pos").alias("fn"),
        count(~said, "neg").alias("tn"),
    )
    return sums.withColumns(_binary(F.col("tp"), F.col("fp"), F.col("fn")))


def threshold_winner(sweep: DataFrame, min_recall: float = 0.8) -> DataFrame:
    """Best F1 among thresholds with enough recall (ties: the higher threshold)."""
    return sweep.where(F.col("recall") >= min_recall).orderBy(F.col("f1").desc(), F.col("threshold").desc()).limit(1)


def regression_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat", by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and R2; the residual and total sums come from one pass."""
    err = F.col(yhat) - F.col(y)
    return df.groupBy(*by).agg(
        F.count(err).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.lit(1.0) - F.avg(err * err) / F.nullif(F.var_pop(F.when(err.isNotNull(), F.col(y))), F.lit(0.0))).alias("r2"),
    )
