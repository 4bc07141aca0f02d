"""Registered queries over the generated tables."""

from __future__ import annotations

import importlib

FAMILIES = ("q_scalars", "q_requests", "q_relations", "q_aggregates", "q_learning", "q_streams", "q_jobs")


def _load() -> None:
    for family in FAMILIES:
        importlib.import_module(f"seqloom.plans.{family}")


def all_queries():
    from seqloom.plans.registry import QUERIES

    _load()
    return dict(QUERIES)


def all_sql():
    from seqloom.plans.registry import SQL

    _load()
    return dict(SQL)
