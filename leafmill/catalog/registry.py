"""The query register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, and the SQL that gives the same rows."""
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """A driver table.

    With ``columns``, those only, dealt to all cores: these tables are one or
    a few files, and such queries work hard on each row.
    """
    whole = spark.read.parquet(f"{sf}/{name}.parquet")
    return whole.select(*columns).repartition(spark.sparkContext.defaultParallelism) if columns else whole
