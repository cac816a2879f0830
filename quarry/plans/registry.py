"""Queries by name with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; sql is DuckDB SQL over the same tables, None where SQL cannot say it."""

    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is already registered")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
