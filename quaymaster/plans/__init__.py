"""Jobs and the registry of queries with their reference SQL."""

from __future__ import annotations

from importlib import import_module

TOPICS = ["q_kpis", "q_views", "q_sources", "q_accounting", "q_quality", "q_tiers", "q_streams"]


def all_queries():
    """The registry with the queries of all topics."""
    for topic in TOPICS:
        import_module(f"quaymaster.plans.{topic}")
    from quaymaster.plans.registry import QUERIES

    return dict(QUERIES)
