"""Registered queries: every operator over the given tables, with SQL to check it where SQL can."""

from . import analysis, clusters, features, increments, ingestion, news, texts  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
