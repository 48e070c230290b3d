"""Registry of queries over the driver's tables, each with its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import analytics, records, spans, turns, wire

_MODULES = [turns, records, analytics, spans, wire]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
for _m in _MODULES:
    for _name, (_fn, _sql) in _m.QUERIES.items():
        if _name in QUERIES:
            raise ValueError(f"two queries are named {_name}")
        QUERIES[_name] = _fn
        if _sql:
            SQL[_name] = _sql
