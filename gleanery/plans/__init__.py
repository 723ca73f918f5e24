"""Query plans over the given tables, by name."""

from . import date_queries, match_queries, source_queries, state_queries, text_queries, view_queries  # noqa: F401
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
