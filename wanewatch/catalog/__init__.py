"""Registered queries on the driver tables and their SQL twins."""

from __future__ import annotations

from importlib import import_module

MODULES = [
    "quality",
    "feature_queries",
    "scoring_queries",
    "monitor_queries",
    "model_queries",
    "watch_queries",
    "fit_queries",
]


def load():
    """The registry with every query module imported."""
    for name in MODULES:
        import_module(f"wanewatch.catalog.{name}")
    return import_module("wanewatch.catalog.registry")
