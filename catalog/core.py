"""Registration of catalogue queries: a Spark function and the SQL that states the same result.

Inputs are the given tables, or views over them written in SQL that both engines
read alike, so a query and its SQL start from the same rows.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
VIEWS: dict[str, str] = {}


def fields(sql: str) -> list[str]:
    return list(dict.fromkeys(f for _, f, _, _ in string.Formatter().parse(sql) if f))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table, or a view over given tables."""
    if name in VIEWS:
        sql = VIEWS[name]
        return spark.sql(sql, **{f: table(spark, folder, f) for f in fields(sql)})
    return spark.read.parquet(f"{folder}/{name}.parquet")


def given(name: str) -> set[str]:
    """The given tables that a table or view reads."""
    return set().union(*[given(f) for f in fields(VIEWS[name])]) if name in VIEWS else {name}


def with_views(sql: str, views: Sequence[str]) -> str:
    """SQL preceded by the views it reads."""
    ordered: list[str] = []

    def visit(name):
        if name in TABLES or name in ordered:
            return
        for f in fields(VIEWS[name]):
            visit(f)
        ordered.append(name)

    for view in views:
        visit(view)
    if not ordered:
        return sql
    parts = [f"{v} AS ({VIEWS[v].format(**{f: f for f in fields(VIEWS[v])})})" for v in ordered]
    sql = sql.strip()
    if sql.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + sql[5:]
    return "WITH " + ",\n".join(parts) + "\n" + sql


def query(*inputs: str, sql: str | None = None):
    """Register a function of the named inputs under its own name."""
    def register(fn):
        name = fn.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(*[table(spark, folder, i) for i in inputs])

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_views(sql, [i for i in inputs if i in VIEWS])
        return fn

    return register
