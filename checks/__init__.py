"""Queries over the given tables, one or more per operator, with their DuckDB counterparts."""

from checks import dataset_checks, model_checks, publication_checks, record_checks, sensor_checks  # noqa: F401
from checks.support import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
