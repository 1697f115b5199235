"""What the vector operators share: clean integer vectors, and sums over all rows in a fixed order."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT = float(1 << 53)  # integers up to here are doubles
FAN = 32  # partial sums that meet in one task


def integer_vectors(df: DataFrame, vector: Column, scale: int, shift: int = 0, **carry: Column) -> DataFrame:
    """``carry`` and ``x``, floor(scale * c) + shift of every component c as a double.

    Rows with a null vector or a null or non-finite component go, and with
    them those that a double can't hold exactly after scaling, empty ones, and
    those of another length than the commonest one (the shorter one of equals).
    """
    rows = df.select(*[c.alias(name) for name, c in carry.items()], vector.cast("array<double>").alias("_v"))
    fits = F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * scale < EXACT - abs(shift)))
    clean = rows.filter(F.coalesce(fits & (F.size("_v") > 0), F.lit(False)))
    made = clean.select(*carry, F.transform("_v", lambda c: F.floor(c * float(scale)) + F.lit(shift).cast("long")).alias("x"))
    common = made.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return made.filter(F.size("x") == (common["d"] if common else 0))


def matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    """The vectors of a batch as rows of int64."""
    values = batch.column(column)
    return values.flatten().to_numpy().reshape(len(values), -1)


def tree_sum(df: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], bytes | None], add: Callable[[bytes, bytes], bytes]) -> bytes | None:
    """The sum of each task's ``partial``, in the order of partitions at every level, so that a repeated run gives the same bits.

    At most ``FAN`` sums meet in a task or on the driver.
    """
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = partial(batches)
        if found is not None:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([found], pa.binary())], names=["part", "data"])

    def folded(rows: list[tuple[int, bytes]]) -> bytes | None:
        total = None
        for _, data in sorted(rows):
            total = data if total is None else add(total, data)
        return total

    def level(table: pa.Table) -> pa.Table:
        rows = list(zip(table.column("part").to_pylist(), table.column("data").to_pylist()))
        return pa.table({"part": pa.array([rows[0][0] // FAN], pa.int32()), "data": pa.array([folded(rows)], pa.binary())})

    schema = "part int, data binary"
    parts, n = df.mapInArrow(first, schema), df.rdd.getNumPartitions()
    while n > FAN:
        parts = parts.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(level, schema)
        n = -(-n // FAN)
    return folded([(r["part"], bytes(r["data"])) for r in parts.collect()])
