"""Registered queries, one module per category, each with its DuckDB twin where SQL has one."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def _modules():
    return [importlib.import_module(f"{__name__}.{m.name}") for m in sorted(pkgutil.iter_modules(__path__), key=lambda m: m.name) if not m.name.startswith("_")]


def queries() -> dict[str, Query]:
    return {name: q for m in _modules() for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _modules() for name, sql in m.ORACLES.items()}
