"""Query catalog: one Spark plan per operator of the inventory, each with its SQL oracle.

Every query reads the driver tables through the stand-in views of
``sources.fixtures`` (FIXTURES.md) and runs over whole tables.  The oracle text
is plain SQL for DuckDB over the same views, written independently of the Spark
plan (naive forms where the Spark plan is rewritten for scale).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


# importing the modules fills the catalog
from . import q_core, q_registry, q_rules, q_export, q_sync  # noqa: E402,F401
