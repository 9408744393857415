"""Tolerant lookups in JSON report columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tremorloom.functions.numeric import ColumnLike, as_column


def _path(keys: Sequence[str]) -> str:
    return "$" + "".join(f"['{k}']" for k in keys)


def nested(json: ColumnLike, keys: Sequence[str]) -> Column:
    """Text at the path, NULL where any key is absent."""
    return F.get_json_object(as_column(json), _path(keys))


def first_number(json: ColumnLike, paths: Sequence[Sequence[str]]) -> Column:
    """First path that holds something readable as a number."""
    return F.coalesce(*[nested(json, p).try_cast("double") for p in paths])


def first_string(json: ColumnLike, paths: Sequence[Sequence[str]]) -> Column:
    """First path that holds a non-blank text."""
    found = [nested(json, p) for p in paths]
    return F.coalesce(*[F.when(F.trim(t) != "", t) for t in found])
