"""Name -> (query, DuckDB SQL). Modules of queries register themselves with `query`."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}

#: Modules that hold registered queries.
MODULES: tuple[str, ...] = ("quernstone.plans.records", "quernstone.plans.documents", "quernstone.plans.streams", "quernstone.plans.profiles", "quernstone.plans.sites", "quernstone.plans.forms", "quernstone.plans.portals", "quernstone.plans.exchange")


def query(name: str, sql: str | None = None):
    """Register a query; `sql` is its equivalent for DuckDB, None where SQL cannot express it."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"two queries are named {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return add


def _load() -> None:
    for module in MODULES:
        importlib.import_module(module)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
