"""Registered queries: each operator on the TPC-H-like tables, with the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

_MODULES = ("membership", "rows", "outliers", "linkage", "text", "sheets", "admission", "preset", "season")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and the SQL that must give the same rows."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def load() -> None:
    for m in _MODULES:
        import_module(f"batchgate.catalog.{m}")
