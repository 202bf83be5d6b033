"""Registered queries (Spark plan + DuckDB oracle SQL)."""

from . import queries_eda, queries_ensemble, queries_ml  # noqa: F401  (register on import)
from .registry import REGISTRY

__all__ = ["REGISTRY"]
