"""All registered queries."""

from __future__ import annotations

from checks import flow_queries, hunt_queries, log_queries, source_queries, stream_queries  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
