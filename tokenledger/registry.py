"""Collects every registered query module."""

from __future__ import annotations


def all_queries():
    from tokenledger import queries  # noqa: F401  (registers core queries)
    from tokenledger import queries_feeds, queries_insights, queries_marts, queries_quality, queries_reports, queries_semantic  # noqa: F401
    return queries.REGISTRY
