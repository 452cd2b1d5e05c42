"""Registered queries: ``name -> (Spark plan, oracle SQL)``.

Importing this package registers every query module.
"""

from . import domain, relational, scalars, sources, tables  # noqa: F401  (registers queries)
from .registry import REGISTRY, Query

__all__ = ["REGISTRY", "Query"]
