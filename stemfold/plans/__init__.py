"""Queries: operators bound to tables."""

from stemfold.plans import curation, sequences
from stemfold.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "curation", "sequences"]
