"""Registered queries over the given tables, each with its SQL counterpart where one exists."""

from suite import jobs, series, spatial, streams, tables  # noqa: F401
from suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
