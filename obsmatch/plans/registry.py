"""Registered queries: one per operator of SURVEY §2, each with its DuckDB twin.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame over the driver's tables (through the
substrates of ``fixtures``); ``ORACLE[name]`` is the same result in DuckDB SQL. Operators with no
SQL form (file listings) have no oracle entry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from obsmatch.plans.fixtures import duckdb_with, substrate

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def with_sql(substrates: tuple[str, ...], *ctes: str) -> str:
    head = duckdb_with(*substrates).rstrip()
    return head + "".join(f",\n{c}" for c in ctes) + "\n"


def sub(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [substrate(spark, sf_dir, n) for n in names]
