"""Registered queries with their SQL, and the derived tables that they read."""

from . import expression_queries, hit_queries, interval_queries, model_queries, source_queries, transcript_queries  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
