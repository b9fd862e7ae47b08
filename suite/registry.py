"""Every query with its SQL twin."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from suite.entities import CTES, Entities

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_ctes(sql: str, extra: dict[str, str] | None = None) -> str:
    """``sql`` below the definitions of the entities it names."""
    known = CTES | (extra or {})
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(known[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{name} AS ({known[name]})" for name in needed) + "\n" + sql


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    """Register a function from entities to a frame, and the SQL that gives the same."""

    def register(fn: Callable[[Entities], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Entities(spark, folder))
        if sql is not None:
            ORACLES[name] = with_ctes(sql, extra)
        return fn

    return register


def half_up(a: str, b: str) -> str:
    """Whole quotient of two whole numbers, a >= 0, halves up."""
    return f"((2 * ({a}) + ({b})) // (2 * ({b})))"


def cents(a: str, b: str) -> str:
    """a / b, a whole number of cents, as money."""
    return f"(CAST({half_up(a, b)} AS DOUBLE) / 100)"
