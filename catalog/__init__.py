"""Queries over the given tables, one per operator and plan, with the SQL each must agree with."""

from catalog import views  # noqa: F401  (registers the views first)
from catalog import auditing, cleaning, deduping, integrating, joining, reshaping, surveys  # noqa: F401
from catalog import comparing  # noqa: F401  (builds on the surveys)
from catalog.core import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
