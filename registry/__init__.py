"""The checked queries: each operator on the given tables, with the SQL it must agree with."""

from registry.base import ORACLE, QUERIES
from registry import archives, continuous, functions, points, documents, rawlogs, records  # noqa: F401

__all__ = ["ORACLE", "QUERIES"]
