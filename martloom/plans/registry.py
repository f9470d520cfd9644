"""Registered queries, their independent SQL and the survey rows each one covers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    plan: Plan
    covers: tuple[str, ...]
    sql: str | None


REGISTRY: dict[str, Registered] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a plan under `name`; `covers` lists survey rows separated by spaces."""

    def add(plan: Plan) -> Plan:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Registered(plan, tuple(covers.split()), sql)
        return plan

    return add
