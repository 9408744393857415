"""Median imputation and standardisation, fitted on train rows only.

Consecutive sequences overlap, so the reference statistics over the whole (sequence, step) tensor are weighted
statistics over rows, the weight being the number of train sequences a row occurs in. The tensor is never
expanded for fitting, and scaling is applied to rows before sequences are assembled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorloom.functions.arrays import constant_array
from tremorloom.functions.numeric import finite, is_finite
from tremorloom.operators.contract import contract_table
from tremorloom.operators.periods import ContractViolation
from tremorloom.operators.ranking import bounded_broadcast, exact_quantiles


def explode_vectors(vectors: DataFrame, weight: str | None = "weight") -> DataFrame:
    """Long form ``(idx, v, w)`` of vector rows with a positive weight; non-finite cells are NULL."""
    w = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    return (
        vectors.select(w.alias("w"), F.posexplode("x").alias("idx", "v"))
        .where(F.col("w") > 0)
        .withColumn("v", finite("v"))
    )


def fit_imputer(long: DataFrame, n_features: int | None = None) -> DataFrame:
    """``(idx, median)`` over finite values; a feature without any has no row (its median is 0)."""
    return exact_quantiles(long, "idx", "v", [0.5], weight="w", n_keys=n_features).select(
        "idx", F.col("quantile").cast("float").alias("median")
    )


def fit_scaler(long: DataFrame, medians: DataFrame, n_features: int | None = None) -> DataFrame:
    """``(idx, median, mean, scale)`` after imputation: population standard deviation, 0 replaced by 1.

    Sums are taken around the median, which imputed cells equal exactly; one pass, no loss of digits for
    features far from zero. ``medians`` has one row per contract feature.
    """
    shifted = (
        long.join(bounded_broadcast(medians, n_features), "idx", "left")
        .withColumn("median", F.coalesce("median", F.lit(0.0).cast("float")))
        .withColumn("d", F.coalesce(F.col("v").cast("double") - F.col("median"), F.lit(0.0)))
    )
    sums = shifted.groupBy("idx").agg(
        F.first("median").alias("median"),
        F.sum("w").alias("n"),
        F.sum(F.col("w") * F.col("d")).alias("s1"),
        F.sum(F.col("w") * F.col("d") * F.col("d")).alias("s2"),
    )
    off = F.col("s1") / F.col("n")
    std = F.sqrt(F.greatest(F.col("s2") / F.col("n") - off * off, F.lit(0.0)))
    return sums.select(
        "idx",
        "median",
        (F.col("median") + off).cast("float").alias("mean"),
        F.when(is_finite(std) & (std != 0), std).otherwise(F.lit(1.0)).cast("float").alias("scale"),
    )


def fit_params(train_rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Parameter table ``(idx, name, median, mean, scale)`` from vectors with a ``weight`` column."""
    long = explode_vectors(train_rows)
    fitted = fit_scaler(long, fit_imputer(long, len(names)), len(names))
    named = contract_table(train_rows.sparkSession, names)
    zero, one = F.lit(0.0).cast("float"), F.lit(1.0).cast("float")
    return named.join(fitted, "idx", "left").select(
        F.col("idx").cast("int").alias("idx"),
        "name",
        F.coalesce("median", zero).alias("median"),
        F.coalesce("mean", zero).alias("mean"),
        F.coalesce("scale", one).alias("scale"),
    )


def params_arrays(params: DataFrame, n_features: int) -> tuple[list[float], list[float], list[float]]:
    """Medians, means and scales in contract order; checks that there is one of each per feature."""
    rows = params.orderBy("idx").limit(n_features + 1).collect()
    if [r["idx"] for r in rows] != list(range(n_features)):
        raise ContractViolation(f"{len(rows)} parameter rows do not match {n_features} features")
    return [r["median"] for r in rows], [r["mean"] for r in rows], [r["scale"] for r in rows]


def apply_params(vectors: DataFrame, params: DataFrame, n_features: int) -> DataFrame:
    """Impute and standardise ``x`` with saved parameters; a bad scale counts as 1.

    The three parameter arrays (one value per contract feature) become constants of the plan.
    """
    medians, means, scales = params_arrays(params, n_features)
    usable = [s if s is not None and math.isfinite(s) and s != 0 else 1.0 for s in scales]
    med, mean, scale = (constant_array([float(v) for v in part], "float") for part in (medians, means, usable))
    fits = F.size("x") == n_features
    message = F.concat(F.lit(f"vector width is not {n_features}: "), F.size("x").cast("string"))
    scaled = F.transform(
        "x", lambda v, i: ((F.coalesce(finite(v), F.get(med, i)) - F.get(mean, i)) / F.get(scale, i)).cast("float")
    )
    return vectors.withColumn("x", F.when(fits, scaled).otherwise(F.raise_error(message).cast("array<float>")))
