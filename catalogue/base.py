"""Registry of named queries with the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linenet.fixtures import DUCK_VIEWS, NEEDS, Data

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_views(sql: str) -> str:
    """Put the fixture views a text names in front of it."""
    used: list[str] = []

    def need(name: str) -> None:
        for other in NEEDS.get(name, []):
            need(other)
        if name not in used:
            used.append(name)

    for name in DUCK_VIEWS:
        if re.search(rf"\b{name}\b", sql):
            need(name)
    ctes = [f"{name} AS ({DUCK_VIEWS[name]})" for name in used]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        ctes.append(body[5:].strip())
        return "WITH " + ",\n".join(ctes)
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def query(name: str, sql: str | None = None):
    """Register a query over the fixture views; without SQL only its rows are checked."""

    def register(fn: Callable[[Data], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Data(spark, folder))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register


def r6(c: Column | str, digits: int = 6) -> Column:
    """Rounded, so that the order of additions does not show."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def d6(expr: str, digits: int = 6) -> str:
    """The SQL side of ``r6``; adding zero turns minus zero into zero."""
    return f"(round({expr}, {digits}) + 0.0)"
