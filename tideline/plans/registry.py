"""Registered queries over the test tables and their SQL equivalents, gathered from the modules of this folder."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES: tuple[str, ...] = ("panel", "joining", "checks", "pointintime", "streams", "more", "sourcing", "normalizing", "gating", "disclosed", "featuring", "completing")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict = {}
    for name in MODULES:
        out |= import_module(f"tideline.plans.{name}").QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict = {}
    for name in MODULES:
        out |= import_module(f"tideline.plans.{name}").SQL
    return out
