"""Operators bound to the test tables, each with the SQL that gives the same rows."""

from evalloom.plans.base import ORACLE, QUERIES
from evalloom.plans import (  # noqa: F401  (imported to register their queries)
    columns,
    combining,
    evaluation,
    extensions,
    ranking,
    streams,
    summaries,
    tables,
)

__all__ = ["ORACLE", "QUERIES"]
