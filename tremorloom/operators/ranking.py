"""Row numbers, row-frame windows and exact quantiles that do not need one group in one task.

Everything here is shaped so that a single key (one sensor, one period, one feature) may hold a large part
of all rows: positions come from small per-bucket counts, frames are evaluated on bounded chunks that carry
a copy of their neighbours' edge rows, and quantiles sort only the bucket the wanted rank falls into.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremorloom.functions.numeric import is_finite, order_bucket
from tremorloom.session import cut_lineage

ROW = "_rn"
CHUNK = "_chunk"
OWN = "_own"


def global_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    bucket: Column,
    name: str = ROW,
) -> DataFrame:
    """1-based position of each row inside its key group, without sorting the group in one task.

    ``bucket`` must never decrease along ``order`` (a day of the time column, for instance). Rows are
    sorted inside (key, bucket); what precedes a bucket is a running sum over the bucket counts.
    """
    keys = list(keys)
    cut = df.withColumn("_bucket", bucket)
    counts = cut.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *keys, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    numbered = cut.withColumn("_in_bucket", F.row_number().over(inside))
    return (
        same_keys(numbered, offsets, [*keys, "_bucket"])
        .withColumn(name, F.col("_before") + F.col("_in_bucket"))
        .drop("_bucket", "_before", "_in_bucket")
    )


def with_halo(ranked: DataFrame, chunk_rows: int, before: int = 0, after: int = 0) -> DataFrame:
    """Cut ranked rows into chunks of ``chunk_rows`` and copy edge rows to the neighbouring chunks.

    Adds ``_chunk`` and ``_own`` (false for copies). A frame of up to ``before`` preceding and ``after``
    following rows, evaluated per (key, ``_chunk``) in ``_rn`` order, is then exact for all own rows.
    """
    position = F.col(ROW) - 1
    first = F.floor(F.greatest(position - after, F.lit(0)) / chunk_rows).cast("bigint")
    last = F.floor((position + before) / chunk_rows).cast("bigint")
    home = F.floor(position / chunk_rows).cast("bigint")
    return (
        ranked.withColumn("_home", home)
        .withColumn(CHUNK, F.explode(F.sequence(first, last)))
        .withColumn(OWN, F.col(CHUNK) == F.col("_home"))
        .drop("_home")
    )


def chunk_window(keys: Sequence[str]):
    return Window.partitionBy(*keys, CHUNK).orderBy(ROW)


def own_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(OWN)).drop(CHUNK, OWN)


# Largest side that is broadcast with a hint, in bytes; keys and short names count with NAME_BYTES each.
BROADCAST_BYTES = 16 << 20
NAME_BYTES = 64


def _row_bytes(df: DataFrame) -> int | None:
    """Bytes of a row of numbers, times and names; None for nested columns, whose width isn't known."""
    kinds = [t for _, t in df.dtypes]
    if any(t.startswith(("array", "map", "struct", "binary")) for t in kinds):
        return None
    return sum(NAME_BYTES if t == "string" else 8 for t in kinds)


def bounded_broadcast(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Broadcast hint when ``df`` has at most ``max_rows`` rows of plain columns and these are few bytes.

    Otherwise no hint: Spark then decides by measured size.
    """
    width = _row_bytes(df)
    fits = max_rows is not None and width is not None and max_rows * width <= BROADCAST_BYTES
    return F.broadcast(df) if fits else df


def measured_broadcast(df: DataFrame) -> DataFrame:
    """A table that should be small: checkpointed, counted, and broadcast only if its bytes are few."""
    small = cut_lineage(df)
    return bounded_broadcast(small, small.count())


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys where NULL equals NULL; the keys of the left side stay."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(other, on, how).drop(*[f"_right_{k}" for k in keys])


def exact_quantiles(
    df: DataFrame,
    key: str,
    value: str,
    probabilities: Sequence[float],
    weight: str | None = None,
    n_keys: int | None = None,
) -> DataFrame:
    """Exact linear-interpolation quantiles per key: rows ``(key, probability, quantile)``.

    ``weight`` is an integer repetition count. Two passes: bucket totals locate the bucket of each wanted
    rank, then only those buckets are sorted. Equal values are merged before any sort. Meant for values
    that came from float32, where a bucket has a hard upper limit of distinct values.

    With ``n_keys`` (an upper limit of the number of keys, such as the contract length) the table of wanted
    buckets, at most two per key and probability, is broadcast if that is few rows.
    """
    w = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")
    # filter on the plain column first: a conditional value would be repeated in every expression built on it
    clean = (
        df.where(is_finite(value) & (w > 0))
        .select(F.col(key), F.col(value).cast("double").alias("_v"), w.alias("_w"))
        .withColumn("_b", order_bucket("_v"))
    )
    running = Window.partitionBy(key).orderBy("_b")
    totals = (
        clean.groupBy(key, "_b")
        .agg(F.sum("_w").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(running))
        .withColumn("_all", F.sum("_n").over(Window.partitionBy(key)))
    )
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    ranked = (
        totals.withColumn("probability", F.explode(wanted))
        .withColumn("_pos", (F.col("_all") - 1) * F.col("probability"))
        .withColumn("_lo", (F.floor("_pos") + 1).cast("bigint"))
        .withColumn("_hi", (F.ceil("_pos") + 1).cast("bigint"))
    )
    holds = lambda rank: (F.col("_upto") - F.col("_n") < F.col(rank)) & (F.col(rank) <= F.col("_upto"))
    targets = ranked.where(holds("_lo") | holds("_hi")).select(
        key,
        "_b",
        (F.col("_upto") - F.col("_n")).alias("_before"),
        F.struct("probability", "_pos", "_lo", "_hi").alias("_t"),
    )
    buckets = targets.groupBy(key, "_b").agg(
        F.first("_before").alias("_before"), F.collect_list("_t").alias("_ts")
    )
    most = None if n_keys is None else 2 * n_keys * len(probabilities)
    inside = Window.partitionBy(key, "_b").orderBy("_v")
    candidates = (
        clean.join(bounded_broadcast(buckets.select(key, "_b"), most), [key, "_b"], "left_semi")
        .groupBy(key, "_b", "_v")
        .agg(F.sum("_w").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(inside))
        .join(buckets, [key, "_b"])
        .withColumn("_upto", F.col("_upto") + F.col("_before"))
        .withColumn("_t", F.explode("_ts"))
        .select(key, "_v", "_n", "_upto", "_t.*")
    )
    low = F.max(F.when(holds("_lo"), F.col("_v")))
    high = F.max(F.when(holds("_hi"), F.col("_v")))
    share = F.max(F.col("_pos") - F.floor("_pos"))
    return (
        candidates.groupBy(key, "probability")
        .agg(low.alias("_low"), high.alias("_high"), share.alias("_share"))
        .select(
            key,
            "probability",
            (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share")).alias("quantile"),
        )
    )
