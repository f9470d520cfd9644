"""Registered analytics queries over the given tables."""

from __future__ import annotations

import importlib

from martloom.plans.registry import REGISTRY, Registered

MODULES = ["customers", "cleaning", "lookups", "shaping", "series", "insight", "assurance"]


def all_queries() -> dict[str, Registered]:
    for name in MODULES:
        importlib.import_module(f"martloom.plans.{name}")
    return REGISTRY
