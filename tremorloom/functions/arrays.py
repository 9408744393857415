"""Probability vectors held in array columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tremorloom.functions.numeric import ColumnLike, as_column, is_finite


def constant_array(values: Sequence[float] | Sequence[int], kind: str) -> Column:
    """A constant numeric array as one literal, which the optimizer folds; ``lit`` of a list is one per element."""
    if not values:
        return F.array().cast(f"array<{kind}>")
    return F.split(F.lit(",".join(repr(v) for v in values)), ",").cast(f"array<{kind}>")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once.

    The optimizer may copy a computed column into the lambda that uses it, where it would be computed again for
    every element; as a lambda argument it is a finished value.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def array_sum(values: ColumnLike) -> Column:
    """Left-to-right sum, so that the result has the same last digit as a plain loop."""
    return F.aggregate(as_column(values), F.lit(0.0), lambda acc, v: acc + v.cast("double"))


def softmax(scores: ColumnLike) -> Column:
    s = F.transform(as_column(scores), lambda v: v.cast("double"))
    shifted = bind(F.array_max(s), lambda top: F.transform(s, lambda v: F.exp(v - top)))
    return bind(shifted, lambda e: bind(array_sum(e), lambda total: F.transform(e, lambda v: v / total)))


def argmax(values: ColumnLike) -> Column:
    """Position of the largest element, the first one on ties."""
    v = as_column(values)
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def alert_probability(probabilities: ColumnLike, min_class: int, n_classes: int) -> Column:
    """Sum of the probabilities of ``min_class`` and above."""
    return array_sum(F.slice(as_column(probabilities), min_class + 1, n_classes - min_class))


def all_finite(values: ColumnLike) -> Column:
    return F.forall(as_column(values), is_finite)
