"""Every registered query: importing this module loads all query modules into the registry."""

from obsmatch.plans import (  # noqa: F401
    queries_gold,
    queries_merge,
    queries_quality,
    queries_silver,
    queries_sources,
)
from obsmatch.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
