"""The runnable queries, one module per family."""

from tidemark.plans import aggregations, changes, joined, rows, sequences, windowed  # noqa: F401
from tidemark.plans import stores, streams  # noqa: F401  (after the batch forms it mirrors)
from tidemark.plans.registry import QUERIES, Tables

__all__ = ["QUERIES", "Tables"]
