"""Imports every query module so that the registry is complete."""

from __future__ import annotations

from lodestar.plans import registry
from lodestar.plans import (  # noqa: F401
    q_detect, q_events, q_kernels, q_learning, q_lsh, q_metrics, q_models, q_network, q_relational, q_sources, q_stream, q_trees, q_vectors,
)


def queries():
    return dict(registry.QUERIES)


def oracle_sql():
    return dict(registry.ORACLE)
