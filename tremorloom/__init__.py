"""Sensor time-series features, alert datasets and monitoring as Spark DataFrame jobs."""

from tremorloom.session import build_session, use_utc

__all__ = ["build_session", "use_utc"]
