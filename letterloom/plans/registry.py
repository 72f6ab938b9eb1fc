"""Registry of named queries over the driver tables, with optional SQL twins."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
SQL_VIEWS: dict[str, str] = {}  # name -> SQL body, in dependency order


def sql_view(name: str, body: str) -> None:
    SQL_VIEWS[name] = body


def _mentioned(text: str) -> set[str]:
    return {v for v in SQL_VIEWS if re.search(rf"\b{v}\b", text)}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the views it mentions, directly or through others."""
    needed, todo = set(), _mentioned(sql)
    while todo:
        v = todo.pop()
        needed.add(v)
        todo |= _mentioned(SQL_VIEWS[v]) - needed
    if not needed:
        return sql
    ctes = ",\n".join(f"{v} AS ({SQL_VIEWS[v]})" for v in SQL_VIEWS if v in needed)
    glue = ", " if sql.lstrip().upper().startswith("WITH ") else "\n"
    rest = sql.lstrip()[5:] if glue == ", " else sql
    return f"WITH {ctes}{glue}{rest}"


def query(key: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = with_views(sql)
        return fn

    return register
