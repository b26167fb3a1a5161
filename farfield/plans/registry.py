"""All registered queries of the engine, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ("scalars", "spatial", "published", "details", "records", "verified")


def _cases() -> dict[str, tuple]:
    found: dict[str, tuple] = {}
    for name in MODULES:
        found |= import_module(f"farfield.plans.{name}").CASES
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in _cases().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _cases().items() if sql}
