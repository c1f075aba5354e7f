"""Registered queries: each reads the given tables and, where SQL can say the same, carries its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ...session import widen

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


# Tables whose per-row work is worth spreading when the file has few splits.
WIDE = {"documents", "pages", "conversations", "lineitem"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return widen(df) if name in WIDE else df


def load_all() -> None:
    from . import text, duplicates, vectors, facts, series, scoring, summaries, published, reports, streams  # noqa: F401
