"""Micro-batches that write several tables, seen by readers all at once or not at all.

A batch overwrites its own folder ``batch_id=N`` in each of its tables and then
its row in a table of commits.  Readers take only batches that have one, so a
batch that was killed between two tables shows in neither, and one that runs
again replaces what it left.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def commit_batch(spark: SparkSession, tables: Mapping[str, DataFrame], commits: str, batch_id: int) -> None:
    """Write each table's part of a batch, then commit it."""
    for path, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    spark.range(1).select(F.current_timestamp().alias("committed_at")).write.mode("overwrite").parquet(f"{commits}/batch_id={batch_id}")


def finished_batches(spark: SparkSession, commits: str) -> list[int]:
    """Ids of committed batches, in order; none before the first."""
    try:
        return sorted(r["batch_id"] for r in spark.read.parquet(commits).select("batch_id").distinct().collect())
    except AnalysisException:  # no folder yet
        return []


def read_batches(spark: SparkSession, path: str, batches: list[int], schema: str) -> DataFrame:
    """Rows of these batches; the folders of others stay closed."""
    found = [f"{path}/batch_id={n}" for n in batches]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*found)
