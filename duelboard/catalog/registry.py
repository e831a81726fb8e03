"""Registration of queries and their reference SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from duelboard.catalog.views import VIEWS, Tables, duckdb_view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under ``name``.

    ``sql`` may refer to the driver tables and to any derived view; the views it
    needs are put in front as common table expressions.
    """

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return build

    return register


def _needed(sql: str, found: list[str]) -> None:
    for view in VIEWS:
        if view not in found and re.search(rf"\b{view}\b", sql):
            _needed(duckdb_view(view), found)
            if view not in found:
                found.append(view)


def with_views(sql: str) -> str:
    found: list[str] = []
    _needed(sql, found)
    if not found:
        return sql
    heads = ",\n".join(f"{view} as (\n{duckdb_view(view)}\n)" for view in found)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {heads},\n{body[5:]}"
    return f"with {heads}\n{body}"
