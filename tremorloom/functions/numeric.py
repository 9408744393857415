"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tremorloom.schemas import FREQUENCY_INDEX_EPS

ColumnLike = Column | str


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_finite(c: ColumnLike) -> Column:
    """True for an ordinary number; false for NULL, NaN and both infinities."""
    v = as_column(c).cast("double")
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))


def finite(c: ColumnLike) -> Column:
    """The value, with NaN and infinities turned into NULL (Spark sorts NaN above every number)."""
    v = as_column(c)
    return F.when(is_finite(v), v)


def frequency_index(low: ColumnLike, high: ColumnLike, eps: float = FREQUENCY_INDEX_EPS) -> Column:
    return F.log10((as_column(high) + eps) / (as_column(low) + eps))


# Buckets per factor of two in ``order_bucket``. A bucket spans 1/128 of an octave, so it holds at most
# 2**23 / 128 * ln(2) * 2 < 2**17 different float32 values whatever the data are.
BUCKETS_PER_OCTAVE = 128
_BUCKET_SHIFT = 1100 * BUCKETS_PER_OCTAVE


def order_bucket(c: ColumnLike) -> Column:
    """Integer that never decreases as the value grows: a logarithmic bucket with sign.

    Ranking work over one unbounded group (median, quantiles, two-sample distances) is split on it:
    totals per bucket are small, and only single buckets are ever sorted in one task.
    """
    v = as_column(c).cast("double")
    magnitude = F.floor(F.log2(F.abs(v)) * BUCKETS_PER_OCTAVE) + F.lit(_BUCKET_SHIFT)
    # log2 is NULL for 0, which is the bucket in the middle; never NULL, so joins on it need no extra filter
    return F.coalesce(F.signum(v).cast("bigint") * magnitude.cast("bigint"), F.lit(0).cast("bigint"))


def ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """numerator / denominator with 0 where the denominator is 0 (metrics with ``zero_division=0``)."""
    d = as_column(denominator)
    return F.when(d == 0, F.lit(0.0)).otherwise(as_column(numerator) / d)
