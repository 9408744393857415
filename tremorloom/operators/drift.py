"""Drift between a reference and a candidate dataset.

Feature values travel in long form ``(dataset, feature, v)`` with dataset ``'reference'`` or ``'candidate'``;
each measure is a grouped aggregate, so no feature is ever collected into one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremorloom.functions.numeric import finite, is_finite, order_bucket
from tremorloom.operators.ranking import bounded_broadcast, exact_quantiles
from tremorloom.session import found_by_workers

REFERENCE, CANDIDATE = "reference", "candidate"

SUMMARY_COLUMNS = [
    "sequence_mean",
    "sequence_std",
    "sequence_min",
    "sequence_max",
    "sequence_abs_mean",
    "sequence_energy_mean",
    "first_timestep_mean",
    "last_timestep_mean",
    "temporal_delta_mean",
    "feature_std_mean",
    "timestep_std_mean",
]


def _summary_of(x: np.ndarray) -> list[float | None]:
    """``SUMMARY_COLUMNS`` of one sequence, steps by features; cells that are not finite don't count."""
    good = np.isfinite(x)
    v, total = np.where(good, x, 0.0), int(good.sum())
    if not total:
        return [None] * len(SUMMARY_COLUMNS)

    def lines(axis: int) -> tuple[np.ndarray, np.ndarray]:
        """Means and population deviations along an axis, NaN where no cell counts."""
        n = good.sum(axis)
        mean = np.divide(v.sum(axis), n, out=np.full(len(n), np.nan), where=n > 0)
        away = np.where(good, x - np.expand_dims(mean, axis), 0.0)
        return mean, np.sqrt(np.divide((away * away).sum(axis), n, out=np.full(len(n), np.nan), where=n > 0))

    step_means, step_devs = lines(1)
    _, feature_devs = lines(0)
    mean = v.sum() / total
    away = np.where(good, x - mean, 0.0)
    found = [
        mean, np.sqrt((away * away).sum() / total), x[good].min(), x[good].max(), np.abs(v).sum() / total, (v * v).sum() / total,
        step_means[0], step_means[-1], step_means[-1] - step_means[0], np.nanmean(feature_devs), np.nanmean(step_devs),
    ]
    return [None if np.isnan(f) else float(f) for f in found]


def sequence_summary(sequences: DataFrame, index: str = "seq_id") -> DataFrame:
    """Eleven summary numbers per sequence (all standard deviations are population ones).

    Row-local: a sequence's matrix is reduced with numpy on Arrow's flat values where it is read, nothing is shuffled. Steps of
    different widths are allowed. Sequences without a cell are left out; one without a finite cell has NULLs.
    """
    keep = [c for c in (index, "split", "y") if c in sequences.columns]

    def summarise(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps = batch.column("x").flatten()
            first = np.concatenate([[0], np.cumsum(batch.column("x").value_lengths().fill_null(0).to_numpy())])
            width = steps.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(width)])
            flat = steps.flatten().to_numpy(zero_copy_only=False).astype(float)
            rows, found = [], []
            for i in range(batch.num_rows):
                own = width[first[i] : first[i + 1]]
                if not own.sum():
                    continue
                cells = flat[at[first[i]] : at[first[i + 1]]]
                x = np.full((len(own), own.max()), np.nan)
                x[np.arange(own.max()) < own[:, None]] = cells
                rows.append(i)
                found.append(_summary_of(x))
            columns = [batch.column(c).take(pa.array(rows, pa.int64())) for c in keep]
            numbers = [pa.array([f[j] for f in found], pa.float64()) for j in range(len(SUMMARY_COLUMNS))]
            yield pa.record_batch([*columns, *numbers], names=[*keep, *SUMMARY_COLUMNS])

    found_by_workers(sequences.sparkSession)
    kinds = dict(sequences.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], *[f"{c} double" for c in SUMMARY_COLUMNS]])
    return sequences.select(*keep, F.col("x").cast("array<array<double>>").alias("x")).mapInArrow(summarise, schema)


def long_features(reference: DataFrame, candidate: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two wide tables with the same columns as one long table."""

    def melt(df: DataFrame, label: str) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in columns])
        return df.select(F.lit(label).alias("dataset"), F.explode(cells).alias("_c")).select("dataset", "_c.*")

    return melt(reference, REFERENCE).unionByName(melt(candidate, CANDIDATE))


def monitoring_frame(sequences: DataFrame, label: str) -> DataFrame:
    """Every (sequence, step) row as long cells ``feature_0000``, non-finite values NULL."""
    name = F.concat(F.lit("feature_"), F.lpad(F.col("_f").cast("string"), 4, "0"))
    return (
        sequences.select(F.explode("x").alias("_step"))
        .select(F.posexplode("_step").alias("_f", "_v"))
        .select(F.lit(label).alias("dataset"), name.alias("feature"), finite(F.col("_v").cast("double")).alias("v"))
    )


def common_features(long: DataFrame) -> DataFrame:
    """Features with at least one value in both datasets."""
    return (
        long.groupBy("feature")
        .agg(
            F.count(F.when(F.col("dataset") == REFERENCE, F.col("v"))).alias("_r"),
            F.count(F.when(F.col("dataset") == CANDIDATE, F.col("v"))).alias("_c"),
        )
        .where((F.col("_r") > 0) & (F.col("_c") > 0))
        .select("feature")
    )


def feature_drift(long: DataFrame, max_standardized_mean_diff: float = 0.5) -> DataFrame:
    """Shift of the mean in reference standard deviations, per feature.

    A constant reference drifts only when the means differ (infinite shift, reported as NULL); a feature
    without values on either side counts as drifted.
    """
    v = finite("v")
    side = lambda label: F.when(F.col("dataset") == label, v)
    stats = long.groupBy("feature").agg(
        F.avg(side(REFERENCE)).alias("reference_mean"),
        F.avg(side(CANDIDATE)).alias("candidate_mean"),
        F.stddev_pop(side(REFERENCE)).alias("reference_std"),
        F.stddev_pop(side(CANDIDATE)).alias("candidate_std"),
    )
    gap = F.abs(F.col("candidate_mean") - F.col("reference_mean"))
    close = gap <= F.greatest(
        F.lit(1e-12), F.lit(1e-9) * F.greatest(F.abs("candidate_mean"), F.abs("reference_mean"))
    )
    flat = F.abs("reference_std") <= 1e-12
    shift = F.when(flat & close, F.lit(0.0)).when(~flat, gap / F.col("reference_std"))
    empty = F.col("reference_mean").isNull() | F.col("candidate_mean").isNull()
    return stats.withColumn("standardized_mean_diff", shift).withColumn(
        "drifted", empty | F.col("standardized_mean_diff").isNull() | (F.col("standardized_mean_diff") > max_standardized_mean_diff)
    )


def dataset_drift(drifts: DataFrame, max_share: float = 0.30) -> DataFrame:
    """One row: drifted features, their share (1 when there is no feature) and the verdict."""
    share = F.coalesce(F.avg(F.col("drifted").cast("double")), F.lit(1.0))
    return drifts.agg(
        F.count_if("drifted").alias("drifted_features_count"),
        F.count(F.lit(1)).alias("total_features"),
        share.alias("share_drifted_features"),
        (share > max_share).alias("dataset_drift"),
    )


def class_distribution(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of each class: rows ``(*by, y, share)``."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, F.col(column).cast("int").alias("y")).agg(
        F.count(F.lit(1)).alias("n")
    )
    total = F.sum("n").over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1)))
    return counts.select(*by, "y", (F.col("n") / total).alias("share"))


def compare_distributions(reference: DataFrame, candidate: DataFrame) -> DataFrame:
    """Shares over the union of classes, 0 where a side lacks a class."""
    left = reference.select("y", F.col("share").alias("reference_share"))
    right = candidate.select("y", F.col("share").alias("candidate_share"))
    return left.join(right, "y", "full").fillna(0.0, ["reference_share", "candidate_share"])


def _distance() -> Column:
    return F.lit(0.5) * F.coalesce(F.sum(F.abs(F.col("reference_share") - F.col("candidate_share"))), F.lit(0.0))


def target_drift(reference: DataFrame, candidate: DataFrame, column: str = "y", max_distance: float = 0.20) -> DataFrame:
    """Total variation distance of the class shares and the verdict."""
    both = compare_distributions(class_distribution(reference, column), class_distribution(candidate, column))
    return both.agg(_distance().alias("distance"), (_distance() > max_distance).alias("target_drift"))


def prediction_drift(
    predictions: DataFrame, targets: DataFrame, column: str = "yhat", max_distance: float = 0.30
) -> DataFrame:
    """Predicted classes against targets.

    Targets are those of the first split (train, val, test) with as many rows as there are predictions, or of
    all splits when none has.
    """
    n_predictions = predictions.where(F.col(column).isNotNull()).count()
    sizes = {r["split"]: r["n"] for r in targets.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    split = next((s for s in ("train", "val", "test") if sizes.get(s) == n_predictions), None)
    compared = targets if split is None else targets.where(F.col("split") == split)
    both = compare_distributions(class_distribution(compared, "y"), class_distribution(predictions, column))
    return both.agg(
        F.lit(split or "all_splits").alias("reference_split"),
        _distance().alias("distance"),
        (_distance() > max_distance).alias("prediction_drift"),
    )


def drift_verdict(flags: DataFrame) -> DataFrame:
    """Adds ``critical_drift`` and ``reason`` to rows with the three drift flags (NULL: not available)."""
    names = ["dataset_drift", "target_drift", "prediction_drift"]
    raised = F.array_compact(F.array(*[F.when(F.coalesce(F.col(n), F.lit(False)), F.lit(n)) for n in names]))
    return flags.withColumn("critical_drift", F.size(raised) > 0).withColumn(
        "reason",
        F.when(F.size(raised) > 0, F.concat(F.lit("Critical drift detected: "), F.array_join(raised, ", "))).otherwise(
            F.lit("No critical drift detected.")
        ),
    )


def top_variance_features(long: DataFrame, max_features: int) -> DataFrame:
    """The ``max_features`` features of largest reference variance, ties by name; a top-k report."""
    variance = F.coalesce(finite(F.var_pop(F.when(F.col("dataset") == REFERENCE, finite("v")))), F.lit(-1.0))
    ranked = long.groupBy("feature").agg(variance.alias("variance"))
    return ranked.orderBy(F.col("variance").desc(), "feature").limit(max_features)


def limit_rows_even(indexed: DataFrame, n: int, max_rows: int, index: str = "row_index") -> DataFrame:
    """At most ``max_rows`` rows, evenly spaced over 0-based ``index`` (a sampling operator).

    Row i is kept when it is the truncated position of one of ``max_rows`` equally spaced points from 0 to
    n - 1, which is decided from the row's own index: no index list is built or joined.
    """
    if max_rows <= 0:
        raise ValueError("max_rows must be positive")
    if n <= max_rows:
        return indexed
    if max_rows == 1:
        return indexed.where(F.col(index) == 0)
    step = F.lit((n - 1) / (max_rows - 1))
    guess = F.floor(F.col(index) / step).cast("bigint")
    # the end point is exact; others are the product of position and step, truncated
    at = lambda k: F.when(k == max_rows - 1, F.lit(n - 1)).otherwise(F.floor(k * step)).cast("bigint")
    hits = [(guess + d).between(0, max_rows - 1) & (at(guess + d) == F.col(index)) for d in (0, 1, 2)]
    return indexed.where(hits[0] | hits[1] | hits[2])


def sample_sequences(sequences: DataFrame, max_rows: int, seed: int, index: str = "seq_id") -> DataFrame:
    """Per split, ``max_rows`` sequences drawn without replacement by a seeded hash (a sampling operator).

    Same rows for the same seed whatever the partitioning. Only ids are ranked (a top-k per split); the rows
    with their matrices are then fetched by a join with at most ``3 * max_rows`` ids.
    """
    if max_rows <= 0:
        return sequences
    ids = sequences.select("split", index)
    picked = None
    for split in ("train", "val", "test"):
        part = ids.where(F.col("split") == split)
        part = part.orderBy(F.xxhash64(F.col(index), F.lit(seed)), index).limit(max_rows)
        picked = part if picked is None else picked.unionByName(part)
    return sequences.join(bounded_broadcast(picked, 3 * max_rows), ["split", index], "left_semi")


# --- distribution distances -----------------------------------------------------------------------


def ks_distance(long: DataFrame) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per feature: rows ``(feature, ks)``.

    Values are compared as float32, the precision of feature data. Equal values are merged first. Cumulative
    counts are a running sum over bucket totals plus a running sum inside each bucket, so a feature is spread
    over as many tasks as it has buckets, and a bucket has a fixed upper limit of distinct values.
    """
    is_ref = F.col("dataset") == REFERENCE
    merged = (
        long.where(is_finite("v"))
        .select("feature", F.col("v").cast("float").cast("double").alias("v"), is_ref.alias("ref"))
        .withColumn("_b", order_bucket("v"))
        .groupBy("feature", "_b", "v")
        .agg(F.count_if("ref").alias("r"), F.count_if(~F.col("ref")).alias("c"))
    )
    earlier = Window.partitionBy("feature").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("feature")
    totals = merged.groupBy("feature", "_b").agg(F.sum("r").alias("_br"), F.sum("c").alias("_bc"))
    offsets = totals.select(
        "feature",
        "_b",
        F.coalesce(F.sum("_br").over(earlier), F.lit(0)).alias("_r0"),
        F.coalesce(F.sum("_bc").over(earlier), F.lit(0)).alias("_c0"),
        F.sum("_br").over(whole).alias("_rn"),
        F.sum("_bc").over(whole).alias("_cn"),
    )
    inside = Window.partitionBy("feature", "_b").orderBy("v")
    at = merged.withColumn("_r", F.sum("r").over(inside)).withColumn("_c", F.sum("c").over(inside)).join(
        offsets, ["feature", "_b"]
    )
    gap = F.abs((F.col("_r0") + F.col("_r")) / F.col("_rn") - (F.col("_c0") + F.col("_c")) / F.col("_cn"))
    return at.where((F.col("_rn") > 0) & (F.col("_cn") > 0)).groupBy("feature").agg(F.max(gap).alias("ks"))


def population_stability(
    long: DataFrame, bins: int = 10, floor: float = 1e-4, n_features: int | None = None
) -> DataFrame:
    """Population stability index per feature over reference quantile bins: rows ``(feature, psi)``.

    Shares below ``floor`` are raised to it. Pass ``n_features`` when the number of features is known, so that the cut table (one row each) may be broadcast.
    """
    at = [i / bins for i in range(1, bins)]
    clean = long.where(is_finite("v")).select(
        "feature", (F.col("dataset") == REFERENCE).alias("_ref"), F.col("v").cast("float").cast("double").alias("v")
    )
    quantiles = exact_quantiles(clean.where("_ref"), "feature", "v", at, n_keys=n_features)
    cuts = quantiles.groupBy("feature").agg(
        *[F.max(F.when(F.col("probability") == F.lit(q), F.col("quantile"))).alias(f"_q{i}") for i, q in enumerate(at)]
    )
    # few counters per row: one large aggregate over all bins would outgrow what the JVM compiles
    bin_of = F.lit(bins - 1)
    for i in reversed(range(bins - 1)):
        bin_of = F.when(F.col("v") <= F.col(f"_q{i}"), F.lit(i)).otherwise(bin_of)
    per_bin = (
        clean.join(bounded_broadcast(cuts, n_features), "feature")
        .groupBy("feature", bin_of.alias("_bin"))
        .agg(F.count_if("_ref").alias("r"), F.count_if(~F.col("_ref")).alias("c"))
    )
    held = lambda side, k: F.sum(F.when(F.col("_bin") == k, F.col(side)).otherwise(F.lit(0)))
    counts = (
        per_bin.groupBy("feature")
        .agg(
            F.sum("r").alias("_rn"),
            F.sum("c").alias("_cn"),
            *[held(side, k).alias(f"_{side}{k}") for side in "rc" for k in range(bins)],
        )
        .where((F.col("_rn") > 0) & (F.col("_cn") > 0))
    )

    def share(side: str, k: int) -> Column:
        return F.greatest(F.col(f"_{side}{k}") / F.col(f"_{side}n"), F.lit(floor))

    shares = counts.select(
        "feature", *[share(side, k).alias(f"_s{side}{k}") for side in "rc" for k in range(bins)]
    )
    terms = [
        (F.col(f"_sc{k}") - F.col(f"_sr{k}")) * F.ln(F.col(f"_sc{k}") / F.col(f"_sr{k}")) for k in range(bins)
    ]
    return shares.select("feature", sum(terms[1:], terms[0]).alias("psi"))


def distribution_drift(
    long: DataFrame, max_ks: float = 0.1, max_psi: float = 0.2, bins: int = 10, n_features: int | None = None
) -> DataFrame:
    """KS distance and PSI per feature; a feature drifts when either exceeds its limit."""
    stability = population_stability(long, bins, n_features=n_features)
    return ks_distance(long).join(stability, "feature").withColumn(
        "drifted", (F.col("ks") > max_ks) | (F.col("psi") > max_psi)
    )
