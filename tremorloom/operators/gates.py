"""Dataset profiles and declarative quality gates.

A rule is a named condition; all rules of a gate are counted in one aggregate over the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorloom.functions.numeric import finite, is_finite
from tremorloom.schemas import N_CLASSES, SPLITS


@dataclass(frozen=True)
class Rule:
    """``holds`` must be true on each row; with ``table_level`` it is one condition over aggregates."""

    name: str
    holds: Column
    table_level: bool = False


def between(column: str, low: float | None = None, high: float | None = None) -> Rule:
    """Value range; NULLs are ignored, as range expectations do."""
    c = F.col(column)
    holds = F.lit(True)
    if low is not None:
        holds = holds & (c >= low)
    if high is not None:
        holds = holds & (c <= high)
    return Rule(f"{column}_between", F.coalesce(holds, F.lit(True)))


def not_null(column: str) -> Rule:
    return Rule(f"{column}_not_null", F.col(column).isNotNull())


def one_of(column: str, values: Sequence) -> Rule:
    return Rule(f"{column}_in_set", F.coalesce(F.col(column).isin(list(values)), F.lit(True)))


def row_count(expected: int) -> Rule:
    return Rule("row_count", F.count(F.lit(1)) == expected, table_level=True)


def column_list(df: DataFrame, expected: Sequence[str]) -> Rule:
    return Rule("column_list", F.lit(list(df.columns) == list(expected)), table_level=True)


def expect(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows ``(rule, n_bad, success)``, one per rule, from a single pass."""
    counts = []
    for i, r in enumerate(rules):
        if r.table_level:
            counts.append(F.when(r.holds, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias(f"_r{i}"))
        else:
            counts.append(F.count_if(~F.coalesce(r.holds, F.lit(False))).alias(f"_r{i}"))
    entries = F.array(
        *[F.struct(F.lit(r.name).alias("rule"), F.col(f"_r{i}").alias("n_bad")) for i, r in enumerate(rules)]
    )
    return (
        df.agg(F.count(F.lit(1)).alias("_n"), *counts)
        .select(F.explode(entries).alias("_e"))
        .select("_e.*", (F.col("_e.n_bad") == 0).alias("success"))
    )


# --- profiles -------------------------------------------------------------------------------------

# fixed values: the columns of both profiles
SEQUENCE_PROFILE_COLUMNS = [
    "sequence_index",
    "seq_len",
    "n_features",
    "dtype",
    "nan_count",
    "inf_count",
    "finite_count",
    "total_values",
    "finite_ratio",
    "min_value",
    "max_value",
    "mean_value",
    "std_value",
    "zero_ratio",
    "abs_max",
]

SPLIT_PROFILE_COLUMNS = [
    "split_name",
    "n_sequences",
    "seq_len",
    "n_features",
    "x_dtype",
    "y_dtype",
    "x_nan_count",
    "x_inf_count",
    "y_nan_count",
    "y_inf_count",
    "x_finite_count",
    "x_total_values",
    "x_finite_ratio",
    "y_finite_count",
    "y_total_values",
    "y_finite_ratio",
    "x_min_value",
    "x_max_value",
    "x_mean_value",
    "x_std_value",
    "x_abs_max",
    "label_min",
    "label_max",
    "n_unique_labels",
]


def _cells(sequences: DataFrame, keep: Sequence[str]) -> DataFrame:
    return sequences.select(*keep, F.explode("x").alias("_step")).select(*keep, F.explode("_step").alias("v"))


def _is_nan(c: str) -> Column:
    v = F.col(c).cast("double")
    return v.isNull() | F.isnan(v)


def _is_inf(c: str) -> Column:
    return F.abs(F.col(c).cast("double")) == F.lit(float("inf"))


def _element_type(df: DataFrame, column: str) -> str:
    t = df.schema[column].dataType
    while hasattr(t, "elementType"):
        t = t.elementType
    return t.simpleString()


def sequence_profile(sequences: DataFrame, index: str = "seq_id") -> DataFrame:
    """One row per sequence: counts and moments of its values (population standard deviation)."""
    v = finite(F.col("v").cast("double"))
    sized = sequences.select(
        index, F.size("x").alias("seq_len"), F.size(F.get("x", F.lit(0))).alias("n_features"), "x"
    )
    shape = [index, "seq_len", "n_features"]
    stats = _cells(sized, shape).groupBy(*shape).agg(
        F.count_if(_is_nan("v")).alias("nan_count"),
        F.count_if(_is_inf("v")).alias("inf_count"),
        F.count(v).alias("finite_count"),
        F.count(F.lit(1)).alias("total_values"),
        (F.count(v) / F.count(F.lit(1))).alias("finite_ratio"),
        F.min(v).alias("min_value"),
        F.max(v).alias("max_value"),
        F.avg(v).alias("mean_value"),
        F.stddev_pop(v).alias("std_value"),
        (F.count_if(v == 0) / F.count(F.lit(1))).alias("zero_ratio"),
        F.max(F.abs(v)).alias("abs_max"),
    )
    profile = stats.withColumnRenamed(index, "sequence_index")
    return profile.withColumn("dtype", F.lit(_element_type(sequences, "x"))).select(*SEQUENCE_PROFILE_COLUMNS)


def split_profile(sequences: DataFrame) -> DataFrame:
    """One row per split with the 24 profile columns.

    Matrices are read once; everything about labels comes from counts per (split, label), which read no matrix.
    """
    v = finite(F.col("v").cast("double"))
    y = finite(F.col("y").cast("double"))
    sized = sequences.select(
        "split", F.size("x").alias("_len"), F.size(F.get("x", F.lit(0))).alias("_width"), "x"
    )
    per_cell = _cells(sized, ["split", "_len", "_width"]).groupBy("split").agg(
        F.max("_len").alias("seq_len"),
        F.max("_width").alias("n_features"),
        F.count_if(_is_nan("v")).alias("x_nan_count"),
        F.count_if(_is_inf("v")).alias("x_inf_count"),
        F.count(v).alias("x_finite_count"),
        F.count(F.lit(1)).alias("x_total_values"),
        (F.count(v) / F.count(F.lit(1))).alias("x_finite_ratio"),
        F.min(v).alias("x_min_value"),
        F.max(v).alias("x_max_value"),
        F.avg(v).alias("x_mean_value"),
        F.stddev_pop(v).alias("x_std_value"),
        F.max(F.abs(v)).alias("x_abs_max"),
    )
    labels = sequences.groupBy("split", "y").agg(F.count(F.lit(1)).alias("_n"))
    counted = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("_n"))), F.lit(0))
    per_label = labels.groupBy("split").agg(
        F.sum("_n").alias("n_sequences"),
        counted(_is_nan("y")).alias("y_nan_count"),
        counted(_is_inf("y")).alias("y_inf_count"),
        counted(y.isNotNull()).alias("y_finite_count"),
        F.sum("_n").alias("y_total_values"),
        (counted(y.isNotNull()) / F.sum("_n")).alias("y_finite_ratio"),
        F.min(y).cast("int").alias("label_min"),
        F.max(y).cast("int").alias("label_max"),
        F.count("y").alias("n_unique_labels"),
    )
    profile = per_label.join(per_cell, "split").withColumnRenamed("split", "split_name")
    return profile.withColumns(
        {"x_dtype": F.lit(_element_type(sequences, "x")), "y_dtype": F.lit(_element_type(sequences, "y"))}
    ).select(*SPLIT_PROFILE_COLUMNS)


def batch_rules(profile: DataFrame, batch_size: int, seq_len: int, n_features: int) -> list[Rule]:
    """The 16 expectations on a latest-batch profile."""
    return [
        column_list(profile, SEQUENCE_PROFILE_COLUMNS),
        row_count(batch_size),
        between("sequence_index", 0, batch_size - 1),
        between("seq_len", seq_len, seq_len),
        between("n_features", n_features, n_features),
        between("nan_count", 0, 0),
        between("inf_count", 0, 0),
        between("finite_ratio", 1.0, 1.0),
        between("zero_ratio", 0.0, 1.0),
        not_null("min_value"),
        not_null("max_value"),
        not_null("mean_value"),
        not_null("std_value"),
        not_null("abs_max"),
        between("std_value", 0.0),
        between("abs_max", 0.0),
    ]


def split_rules(profile: DataFrame, seq_len: int, n_features: int, n_classes: int = N_CLASSES) -> list[Rule]:
    """Expectations on the profile of a training dataset."""
    return [
        column_list(profile, SPLIT_PROFILE_COLUMNS),
        row_count(len(SPLITS)),
        one_of("split_name", SPLITS),
        between("n_sequences", 1),
        between("seq_len", seq_len, seq_len),
        between("n_features", n_features, n_features),
        between("x_nan_count", 0, 0),
        between("x_inf_count", 0, 0),
        between("y_nan_count", 0, 0),
        between("y_inf_count", 0, 0),
        between("x_finite_ratio", 1.0, 1.0),
        between("y_finite_ratio", 1.0, 1.0),
        between("label_min", 0, n_classes - 1),
        between("label_max", 0, n_classes - 1),
        between("n_unique_labels", 1, n_classes),
    ]


# --- row-level contracts --------------------------------------------------------------------------


def _matrix_finite() -> Column:
    return F.forall("x", lambda step: F.forall(step, is_finite))


def batch_contract(seq_len: int, n_features: int) -> list[Rule]:
    """Exact shape and finite values of every sequence."""
    return [
        Rule("seq_len", F.size("x") == seq_len),
        Rule("n_features", F.forall("x", lambda step: F.size(step) == n_features)),
        Rule("finite", _matrix_finite()),
    ]


def validate_batch(sequences: DataFrame, batch_size: int, seq_len: int, n_features: int) -> DataFrame:
    return expect(sequences, [row_count(batch_size), *batch_contract(seq_len, n_features)])


def dataset_contract(
    sequences: DataFrame, seq_len: int, n_features: int, n_classes: int = N_CLASSES, task: str = "classification"
) -> DataFrame:
    """Hard rules per split: rows ``(split, rule, n_bad)``, including required splits that are absent.

    ``y`` is a class, or hours that are not negative when the task is ``regression``.
    """
    y = F.col("y").cast("double")
    if task not in ("classification", "regression"):
        raise ValueError("task must be 'classification' or 'regression'")
    rules = [*batch_contract(seq_len, n_features), Rule("label_finite", is_finite("y"))]
    if task == "classification":
        rules += [Rule("label_integer", y == F.round(y)), Rule("label_range", (y >= 0) & (y < n_classes))]
    else:
        rules.append(Rule("target_not_negative", y >= 0))
    counted = sequences.groupBy("split").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(~F.coalesce(r.holds, F.lit(False))).alias(f"_r{i}") for i, r in enumerate(rules)],
    )
    required = sequences.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    full = required.join(counted, "split", "left").fillna(0)
    entries = [F.struct(F.lit("split_present").alias("rule"), (F.col("_n") == 0).cast("bigint").alias("n_bad"))]
    entries += [F.struct(F.lit(r.name).alias("rule"), F.col(f"_r{i}").alias("n_bad")) for i, r in enumerate(rules)]
    return full.select("split", F.explode(F.array(*entries)).alias("_e")).select("split", "_e.*")


def class_counts(sequences: DataFrame, n_classes: int = N_CLASSES) -> DataFrame:
    """Count per (split, class) with zeros for absent classes, and a flag for classes out of range."""
    counts = sequences.groupBy("split", F.col("y").cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    grid = sequences.select("split").distinct().select(
        "split", F.explode(F.sequence(F.lit(0), F.lit(n_classes - 1))).alias("y")
    )
    return (
        grid.join(counts, ["split", "y"], "full")
        .fillna(0, ["n"])
        .withColumn("valid_class", F.col("y").between(0, n_classes - 1))
    )


def target_range(sequences: DataFrame, max_horizon_hours: float) -> DataFrame:
    """Regression targets per split: range, negatives (error) and values above the horizon (warning)."""
    y = F.col("y").cast("double")
    beyond = y > max_horizon_hours + 1e-6 if max_horizon_hours > 0 else F.lit(False)
    return sequences.groupBy("split").agg(
        F.min(y).alias("y_min"),
        F.max(y).alias("y_max"),
        F.avg(y).alias("y_mean"),
        F.count_if(y < 0).alias("n_negative"),
        F.count_if(beyond).alias("n_beyond_horizon"),
    )


def dataset_report(
    sequences: DataFrame,
    seq_len: int,
    n_features: int,
    n_names: int | None = None,
    n_classes: int = N_CLASSES,
    task: str = "classification",
    max_horizon_hours: float = 48.0,
) -> DataFrame:
    """All findings on a dataset: rows ``(severity, split, rule, n_bad)`` with ``n_bad > 0`` only.

    Warnings on labels are absent classes, or with the task ``regression`` hours beyond the horizon.
    """
    broken = dataset_contract(sequences, seq_len, n_features, n_classes, task).select(
        F.lit("error").alias("severity"), "split", "rule", "n_bad"
    )
    if task == "classification":
        absent = class_counts(sequences, n_classes).where(F.col("n") == 0).groupBy("split")
        odd = absent.agg(F.count(F.lit(1)).alias("n_bad")).withColumn("rule", F.lit("absent_classes"))
    else:
        beyond = target_range(sequences, max_horizon_hours)
        odd = beyond.select("split", F.col("n_beyond_horizon").alias("n_bad"), F.lit("beyond_horizon").alias("rule"))
    findings = broken.unionByName(odd.select(F.lit("warning").alias("severity"), "split", "rule", "n_bad"))
    if n_names is None or n_names != n_features:
        severity, rule = ("warning", "names_missing") if n_names is None else ("error", "names_count")
        extra = sequences.sparkSession.createDataFrame(
            [(severity, None, rule, 1)], "severity string, split string, rule string, n_bad bigint"
        )
        findings = findings.unionByName(extra)
    return findings.where(F.col("n_bad") > 0)
