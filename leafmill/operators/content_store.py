"""Outcomes kept by content between runs: what was converted once is not converted again.

The store is a Parquet table in a folder, bucketed by the content's hash.  A run
moves its own hashes to the store's buckets; the store itself is read bucket by
bucket and never shuffled.  Only contents it does not hold are converted, and
appended in one committed write before any outcome is given.  A run that is
repeated, or was killed behind that write, finds them there; rows that two runs
have written at the same time count once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leafmill.operators.skew import join_many_to_one
from leafmill.session import through_table

KEYS = ["content_sha", "suffix", "option_key"]
BUCKETS = 64


def open_store(spark: SparkSession, path: str, outcome: StructType, buckets: int = BUCKETS) -> str:
    """The session's name for the table in that folder, which is declared if it is not yet known."""
    name = "content_store_" + hashlib.sha256(path.encode()).hexdigest()[:16]
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outcome.fields)
        spark.sql(f"CREATE TABLE {name} (content_sha STRING, suffix STRING, option_key STRING, {columns}) USING parquet "
                  f"CLUSTERED BY (content_sha) SORTED BY (content_sha) INTO {buckets} BUCKETS LOCATION '{path}'")
    return name


def known_outcomes(spark: SparkSession, name: str) -> DataFrame:
    """One row a key; grouped where it lies, as a bucket holds all rows of a hash."""
    table = spark.table(name)
    rest = [c for c in table.columns if c not in KEYS]
    return table.groupBy(*KEYS).agg(F.first(F.struct(*rest)).alias("_made")).select(*KEYS, "_made.*")


def of_contents(known: DataFrame, firsts: DataFrame) -> DataFrame:
    """What the store knows of these contents, under any options: they come to its buckets, and it stays where it is."""
    return known.join(firsts.select("content_sha"), "content_sha", "left_semi")


def convert_known(df: DataFrame, convert: Callable[[DataFrame], DataFrame], row_id: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """As ``converter.convert_once``, but contents that the store in ``path`` holds are not converted.

    ``df`` has ``row_id, content, suffix, option_key`` and what ``convert`` reads; ``row_id`` is unique.
    ``convert`` gives the outcome's columns beside the keys, and one row for each it got.
    """
    spark = df.sparkSession
    # Keys without nulls, for the joins: a value gets a mark in front, null is the empty string.
    values = (F.sha2("content", 256), F.col("suffix"), F.col("option_key"))
    marked = [F.coalesce(F.concat(F.lit("="), value), F.lit("")).alias(name) for name, value in zip(KEYS, values)]
    hashed = through_table(df.select(row_id, *marked), "hashes")
    firsts = through_table(hashed.groupBy(*KEYS).agg(F.min(row_id).alias(row_id), F.count(F.lit(1)).alias("copies")), "firsts")
    plain = [F.when(F.col(name) != "", F.substring(name, 2, 1 << 30)).alias(name) for name in KEYS]

    def made_of(wanted: DataFrame) -> DataFrame:
        rows = df.drop(*KEYS[1:]).join(wanted.select(row_id, *plain), row_id)
        made = convert(rows)
        again = {name: F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit("")) for name in KEYS}
        return made.drop(row_id).withColumns(again)

    outcome = StructType([f for f in made_of(firsts).schema.fields if f.name not in KEYS])
    name = open_store(spark, path, outcome, buckets)
    spark.catalog.refreshTable(name)
    mine = through_table(of_contents(known_outcomes(spark, name), firsts), "known-contents")
    fresh = through_table(firsts.join(mine.select(*KEYS), KEYS, "left_anti"), "new-contents")
    if not fresh.isEmpty():
        made = through_table(made_of(fresh).select(*KEYS, *outcome.names), "new-outcomes")
        made.repartition(F.col("content_sha")).write.mode("append").insertInto(name)
        spark.catalog.refreshTable(name)
        mine = mine.unionByName(made)
    return join_many_to_one(hashed, mine, KEYS, firsts, "copies", row_id).select(row_id, *outcome.names)
