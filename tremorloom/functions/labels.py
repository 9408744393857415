"""Period types and class labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tremorloom.functions.numeric import ColumnLike, as_column
from tremorloom.schemas import HORIZON_CLASSES, PERIOD_TYPE_SYNONYMS


def lookup_period_type(value: ColumnLike, allow_inference: bool = True) -> Column:
    """Canonical period type or NULL for an unknown spelling."""
    text = F.lower(F.trim(as_column(value)))
    pairs = [(k, v) for k, v in PERIOD_TYPE_SYNONYMS.items() if allow_inference or v != "inference"]
    table = F.create_map(*[F.lit(part) for pair in pairs for part in pair])
    return F.try_element_at(table, text)


def normalize_period_type(value: ColumnLike, allow_inference: bool = True) -> Column:
    """Canonical period type; the job fails on an unknown spelling."""
    known = lookup_period_type(value, allow_inference)
    message = F.concat(F.lit("unknown period_type: "), F.coalesce(as_column(value), F.lit("")))
    return F.coalesce(known, F.raise_error(message).cast("string"))


def infer_period_type(period_id: ColumnLike, period_type: ColumnLike | None = None) -> Column:
    """Older metadata: explicit type first, then the ``quiet_`` id prefix, else an event period."""
    by_prefix = F.when(
        F.startswith(F.lower(F.trim(as_column(period_id))), F.lit("quiet_")), F.lit("quiet")
    ).otherwise(F.lit("eruption"))
    if period_type is None:
        return by_prefix
    given = as_column(period_type)
    return F.when(given.isNull(), by_prefix).otherwise(normalize_period_type(given, allow_inference=False))


def horizon_label(hours: ColumnLike, strict: bool = True) -> Column:
    """Class 5 (at most 6 h before the event) down to 1 (36-48 h); the job fails outside 0..48 h.

    With ``strict=False`` the bounds alone decide: hours after the event count as 0, those beyond the horizon have no class.
    """
    h = as_column(hours)
    if not strict:
        return F.coalesce(*[F.when(h <= bound, F.lit(cls)) for bound, cls in HORIZON_CLASSES])
    label = F.when(h < 0, F.raise_error(F.concat(F.lit("negative hours: "), h.cast("string"))).cast("int"))
    for bound, cls in HORIZON_CLASSES:
        label = label.when(h <= bound, F.lit(cls))
    beyond = F.raise_error(F.concat(F.lit("hours beyond the horizon: "), h.cast("string"))).cast("int")
    return F.when(h.isNotNull(), label.otherwise(beyond))
