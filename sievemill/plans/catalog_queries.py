"""Registered queries of the catalog operators, each with the DuckDB SQL that it is held against."""

from __future__ import annotations

from . import coverage_queries, curation_queries, index_queries, link_queries, rule_queries, stat_queries, text_queries  # noqa: F401  they register themselves
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
