"""Registry of named queries over the driver tables.

Each registered callable takes ``(spark, sf_dir)`` and returns a lazy
DataFrame; the optional oracle is the same question in DuckDB SQL over the
same parquet tables. Oracles are written independently of the Spark plan
(usually the plain relational statement) so that an agreement means
something.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

_MODULES = (
    "cairn.plans.q_sales",
    "cairn.plans.q_relational",
    "cairn.plans.q_semistructured",
    "cairn.plans.q_changes",
    "cairn.plans.q_text",
    "cairn.plans.q_policies",
    "cairn.plans.q_layout",
    "cairn.plans.q_features",
)


def register(name: str, oracle: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name!r}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return deco


def load_all() -> None:
    for mod in _MODULES:
        importlib.import_module(mod)


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLES)
