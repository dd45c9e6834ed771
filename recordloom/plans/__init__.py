"""Registered queries over the given tables."""

from . import design_queries, ingest_queries, log_queries, read_queries, store_queries  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
