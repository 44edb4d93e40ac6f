"""Queries over the driver tables, one module per family."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ("profile_plans", "text_plans", "metric_plans", "experiment_plans", "workflow_plans")


def all_queries():
    from ticketgrain.plans.registry import ORACLES, QUERIES

    for family in FAMILIES:
        import_module(f"ticketgrain.plans.{family}")
    return QUERIES, ORACLES
