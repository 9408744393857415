"""Model scores, class probabilities and the alert rule."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorloom.functions.arrays import all_finite, alert_probability, argmax, array_sum, softmax
from tremorloom.functions.numeric import is_finite
from tremorloom.schemas import ALERT_MIN_CLASS, ALERT_THRESHOLD, N_CLASSES


def check_alert_arguments(n_classes: int, min_class: int, threshold: float) -> None:
    if not isinstance(n_classes, int) or n_classes < 2:
        raise ValueError("n_classes must be an integer >= 2")
    if not isinstance(min_class, int) or not 0 <= min_class < n_classes:
        raise ValueError("min_class must be in 0..n_classes-1")
    if not 0 <= float(threshold) <= 1:
        raise ValueError("threshold must be in 0..1")


def score(sequences: DataFrame, predict: Callable, n_classes: int = N_CLASSES, batch_rows: int = 64) -> DataFrame:
    """Adds ``scores array<double>`` from a user model.

    ``predict`` is a callable (or an object with ``predict``) from a float32 array (N, T, F) to (N, n_classes).
    It is shipped once per task and gets at most ``batch_rows`` sequences at a time; rows reach Python as
    Arrow batches and are reshaped without a per-row loop.
    """
    schema = T.StructType([*sequences.schema.fields, T.StructField("scores", T.ArrayType(T.DoubleType()))])
    call = predict.predict if hasattr(predict, "predict") else predict

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                part = batch.slice(start, batch_rows)
                x = part.column(part.schema.get_field_index("x"))
                steps = x.flatten()
                values = steps.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
                n = part.num_rows
                length, width = len(steps) // n, len(values) // max(1, len(steps))
                even = pc.all(pc.equal(pc.list_value_length(x), length)).as_py() and pc.all(pc.equal(pc.list_value_length(steps), width)).as_py()
                if x.null_count or steps.null_count or even is False:
                    raise ValueError("sequences of one batch differ in length or width, or a matrix is NULL")
                out = np.asarray(call(values.reshape(n, length, -1)), dtype=float)
                if out.ndim == 1:
                    out = out.reshape(1, -1)
                if out.shape != (n, n_classes):
                    raise ValueError(f"model returned shape {out.shape}, expected {(n, n_classes)}")
                scores = pa.array(list(out), type=pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns, scores], names=[*part.schema.names, "scores"])

    return sequences.mapInArrow(run, schema)


def score_violations(column: str, n_classes: int = N_CLASSES) -> Column:
    """Name of the first broken rule of raw model output, NULL when it is fine."""
    return (
        F.when(F.col(column).isNull() | (F.size(column) != n_classes), "width")
        .when(~all_finite(column), "not_finite")
    )


def validate_scores(df: DataFrame, column: str = "scores", n_classes: int = N_CLASSES) -> DataFrame:
    """Rows with unusable model output and the reason."""
    return df.withColumn("violation", score_violations(column, n_classes)).where(F.col("violation").isNotNull())


def probability_violation(column: str, n_classes: int = N_CLASSES, tolerance: float = 1e-4) -> Column:
    """First broken rule of a probability vector: width, finite, range, sum; NULL when valid."""
    return (
        score_violations(column, n_classes)
        .when(~F.forall(column, lambda p: (p >= 0) & (p <= 1)), "range")
        .when(F.abs(array_sum(column) - 1.0) > tolerance, "sum")
    )


def validate_probabilities(
    df: DataFrame, column: str = "probabilities", n_classes: int = N_CLASSES, tolerance: float = 1e-4
) -> DataFrame:
    violation = probability_violation(column, n_classes, tolerance)
    return df.withColumn("violation", violation).where(F.col("violation").isNotNull())


def to_probabilities(
    df: DataFrame, is_logits: bool = False, n_classes: int = N_CLASSES, column: str = "scores"
) -> DataFrame:
    """``scores`` to validated ``probabilities``; the job fails on output that breaks a rule."""
    raw = F.when(
        score_violations(column, n_classes).isNull(), softmax(column) if is_logits else F.col(column)
    ).otherwise(F.raise_error(F.concat(F.lit("bad model output: "), score_violations(column, n_classes))).cast("array<double>"))
    with_p = df.withColumn("probabilities", raw).drop(column)
    reason = probability_violation("probabilities", n_classes)
    checked = F.when(reason.isNull(), F.col("probabilities")).otherwise(
        F.raise_error(F.concat(F.lit("bad probabilities: "), reason)).cast("array<double>")
    )
    return with_p.withColumn("probabilities", checked)


def predicted_class(df: DataFrame, column: str = "probabilities") -> DataFrame:
    return df.withColumn("predicted_class", argmax(column)).withColumn(
        "predicted_probability", F.array_max(column).cast("double")
    )


def alert(
    df: DataFrame,
    n_classes: int = N_CLASSES,
    min_class: int = ALERT_MIN_CLASS,
    threshold: float = ALERT_THRESHOLD,
    column: str = "probabilities",
) -> DataFrame:
    """Adds the alert probability and the (inclusive) alert flag."""
    check_alert_arguments(n_classes, min_class, threshold)
    return df.withColumn("p_alert_24h", alert_probability(column, min_class, n_classes)).withColumn(
        "alert_24h", F.col("p_alert_24h") >= F.lit(float(threshold))
    )


def aggregate_batch(
    df: DataFrame,
    how: str,
    batch: str = "batch_id",
    order: str = "sequence_index",
    n_classes: int = N_CLASSES,
    min_class: int = ALERT_MIN_CLASS,
    column: str = "probabilities",
) -> DataFrame:
    """One probability vector per batch: rows ``(batch, probabilities, selected_index)``.

    ``last``: the last sequence; ``mean``: element-wise average (no index); ``max_alert``: the sequence with
    the highest alert probability, the earliest on ties. All three are plain aggregates with partial sums.
    """
    if how == "last":
        return df.groupBy(batch).agg(
            F.max_by(column, order).alias("probabilities"), F.max(order).cast("bigint").alias("selected_index")
        )
    if how == "mean":
        sums = [F.avg(F.get(column, F.lit(i))).alias(f"_p{i}") for i in range(n_classes)]
        return df.groupBy(batch).agg(*sums).select(
            batch,
            F.array(*[F.col(f"_p{i}") for i in range(n_classes)]).alias("probabilities"),
            F.lit(None).cast("bigint").alias("selected_index"),
        )
    if how == "max_alert":
        rank = F.struct(alert_probability(column, min_class, n_classes).alias("p"), (-F.col(order)).alias("o"))
        return df.groupBy(batch).agg(
            F.max_by(column, rank).alias("probabilities"), F.max_by(order, rank).cast("bigint").alias("selected_index")
        )
    raise ValueError("how must be 'last', 'mean' or 'max_alert'")


def class_key_map(column: str = "probabilities") -> Column:
    """``{class_0: p0, ...}``."""
    positions = F.sequence(F.lit(0), F.size(column) - 1)
    return F.map_from_arrays(
        F.transform(positions, lambda i: F.concat(F.lit("class_"), i.cast("string"))), F.col(column)
    )


def verify_predictions(predictions: DataFrame, key: str, tolerance: float = 1e-3) -> DataFrame:
    """Violations ``(key, rule)`` of published predictions (columns of ``schemas.PREDICTION``)."""
    p, k = F.col("probabilities"), F.col("n_classes")
    text_missing = lambda c: F.coalesce(F.trim(F.col(c)) == "", F.lit(True))
    unit = lambda c: ~F.coalesce(is_finite(c) & F.col(c).between(0, 1), F.lit(False))
    usable = (F.size(p) == k) & F.forall(p, is_finite)
    index = F.col("predicted_class")
    keys = F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.concat(F.lit("class_"), i.cast("string")))
    chosen = F.get(p, index)
    tail = array_sum(F.slice(p, F.col("min_class_alert") + 1, F.greatest(k - F.col("min_class_alert"), F.lit(0))))
    rules: list[tuple[str, Column]] = [
        ("created_at_missing", text_missing("created_at_utc")),
        ("model_name_missing", text_missing("model_name")),
        ("run_id_missing", text_missing("run_id")),
        ("n_classes_invalid", ~F.coalesce(k > 0, F.lit(False))),
        ("min_class_invalid", ~F.coalesce((F.col("min_class_alert") >= 0) & (F.col("min_class_alert") < k), F.lit(False))),
        ("predicted_class_invalid", ~F.coalesce((index >= 0) & (index < k), F.lit(False))),
        ("predicted_probability_range", unit("predicted_probability")),
        ("p_alert_range", unit("p_alert_24h")),
        ("alert_missing", F.col("alert_24h").isNull()),
        ("probabilities_width", F.coalesce(F.size(p) != k, F.lit(True))),
        ("probabilities_range", ~F.coalesce(F.forall(p, lambda v: is_finite(v) & (v >= 0) & (v <= 1)), F.lit(False))),
        ("probabilities_sum", F.when(usable, F.abs(array_sum(p) - 1.0) > tolerance)),
        (
            "class_keys",
            ~F.coalesce(
                F.array_sort(F.map_keys("probabilities_by_class")) == F.array_sort(keys), F.lit(False)
            ),
        ),
        ("predicted_class_inconsistent", F.when(usable, index != argmax(p))),
        ("predicted_probability_inconsistent", F.when(usable, F.abs(F.col("predicted_probability") - chosen) > 1e-6)),
        ("p_alert_inconsistent", F.when(usable, F.abs(F.col("p_alert_24h") - tail) > 1e-6)),
    ]
    broken = F.array_compact(
        F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules])
    )
    return predictions.select(key, F.explode(broken).alias("rule"))


# --- classes found in stored model outputs --------------------------------------------------------

# fixed values: column names searched in this order
CLASS_COLUMNS = ["y_pred", "predictions", "predicted_class", "predicted_classes", "test_predictions", "test_y_pred"]
SCORE_COLUMNS = ["probabilities", "probas", "y_proba", "test_probabilities", "test_probas", "logits", "test_logits"]
SCORE_NAME_PARTS = ["prob", "proba", "logit", "pred"]


def prediction_classes(outputs: DataFrame) -> tuple[DataFrame, str] | None:
    """Adds ``yhat`` from the first known class or score column; ``None`` when there is none."""
    kinds = {f.name: f.dataType for f in outputs.schema.fields}
    is_array = lambda c: isinstance(kinds[c], T.ArrayType)
    for c in CLASS_COLUMNS:
        if c in kinds:
            found = argmax(c) if is_array(c) else F.col(c).cast("int")
            return outputs.withColumn("yhat", found), c
    named = [c for c in SCORE_COLUMNS if c in kinds and is_array(c)]
    named += [c for c in kinds if is_array(c) and any(part in c.lower() for part in SCORE_NAME_PARTS)]
    if named:
        return outputs.withColumn("yhat", argmax(named[0])), named[0]
    return None
