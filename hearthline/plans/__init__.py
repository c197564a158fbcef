"""Registered queries and their SQL counterparts."""

from hearthline.plans import registry


def load():
    """Import every plan module once and return the registry."""
    from hearthline.plans import (  # noqa: F401
        q_aggregates, q_audiences, q_behavior, q_clusters, q_geo, q_joins, q_monitoring,
        q_predicates, q_seasonal, q_sources, q_text, q_ratio, q_vectors)
    return registry
