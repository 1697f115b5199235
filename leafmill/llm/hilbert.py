"""Shards cut from the Hilbert order of document metadata.

Each dimension is quantised at global percentiles into 2**bits cells, cells
are numbered along a Hilbert curve, rows are sorted by that number and the
sorted run is cut into shards of nearly equal bytes.  Shards then cover small
boxes in all dimensions at once, so the minimum and maximum of each file prune
on any of them.

Null values take cell 0.  Rows that repeat all values are interchangeable and
get slots next to each other.  An empty table gives an empty plan.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import checkpointed, extended, shuffle_width
from leafmill.session import ship_package, through_table

OVERHEAD = 8  # bytes a row takes besides its text


def leading_bytes(text: Column) -> Column:
    """A string as a number of the same order: its first 6 bytes."""
    return F.conv(F.rpad(F.hex(F.substring(F.encode(text, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the curve of points, given as an integer array of shape (dimensions, points).

    Follows the transposed-bits description of the curve by Skilling (2004):
    undo the excess work of each bit from the top, Gray-encode, and interleave.
    """
    x = cells.astype(np.int64).copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for d in range(dims):
            high = (x[d] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> level) & 1, (1 << level) - 1, 0)
    x ^= turn
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            index = (index << 1) | ((x[d] >> level) & 1)
    return index


def _with_index(edges: list[list[float]], bits: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for d, bounds in enumerate(edges):
                values = batch.column(f"dim{d}")
                known = values.is_valid().to_numpy(zero_copy_only=False)
                numbers = values.fill_null(0.0).to_numpy(zero_copy_only=False)
                cells.append(np.where(known, np.searchsorted(bounds, numbers, side="right") if bounds else 0, 0))
            yield batch.append_column("place", pa.array(hilbert_index(np.array(cells), bits)))

    return add


def _cut(starts: dict[int, tuple[int, int]], total: int, shards: int):
    """Rows in sorted order to shards; ``starts`` has bytes and rows before each partition."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = rows = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if before is None:
                before, rows = starts[batch.column("part")[0].as_py()]
            sizes = batch.column("size").to_numpy()
            ends = before + np.cumsum(sizes)
            middle = ends - (sizes + 1) // 2  # of each row; never beyond the total
            shard = np.minimum(middle.astype(object) * shards // max(total, 1), shards - 1).astype(np.int32)
            place = rows + np.arange(len(sizes))
            before, rows = int(ends[-1]), rows + len(sizes)
            keep = batch.drop_columns(["part"])
            yield keep.append_column("shard", pa.array(shard, pa.int32())).append_column("row_no", pa.array(place, pa.int64()))

    return add


def shard_plan(docs: DataFrame, dims: Mapping[str, Column], shards: int, id_col: str = "doc_id", text_col: str = "text",
               bits: int = 8, accuracy: int = 10_000) -> DataFrame:
    """doc_id, size, text_crc32, place, shard and slot of each row; the law is equal bytes.

    ``dims`` are numbers or strings of ``docs``.  Three small results reach the
    driver: percentiles (2**bits for a dimension), one row for each partition,
    one for each shard.
    """
    if len(dims) * bits > 62:
        raise ValueError("the curve's index must fit into 62 bits")
    spark = docs.sparkSession
    ship_package(spark)
    kinds = dict(docs.select(*[c.alias(n) for n, c in dims.items()]).dtypes)
    numbers = [(leading_bytes(c) if kinds[n] == "string" else c.cast("double")).alias(f"dim{d}") for d, (n, c) in enumerate(dims.items())]
    text = F.coalesce(docs[text_col], F.lit(""))
    meta = through_table(docs.select(
        docs[id_col].alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), *numbers,
    ), "shard-meta")
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = meta.agg(*[F.percentile_approx(f"dim{d}", shares, accuracy).alias(f"dim{d}") for d in range(len(dims))]).first()
    edges = [[] if e is None else list(e) for e in found]
    placed = meta.mapInArrow(_with_index(edges, bits), extended(meta, "place long")).select("doc_id", "size", "text_crc32", "place")
    order = ["place", "doc_id", "text_crc32", "size"]
    run = checkpointed(
        placed.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
    )
    starts, total, rows = {}, 0, 0
    for part, size, count in sorted(run.groupBy("part").agg(F.sum("size"), F.count("*")).collect()):
        starts[part] = (total, rows)
        total, rows = total + size, rows + count
    cut = run.mapInArrow(_cut(starts, total, shards), extended(run.drop("part"), "shard int, row_no long"))
    first = {shard: row for shard, row in cut.groupBy("shard").agg(F.min("row_no")).collect()}
    # Sorted rows fill shards in order, so a shard's rows are a run from its first.
    begin = F.element_at(F.create_map(*[F.lit(x) for pair in sorted(first.items()) for x in pair]), F.col("shard")) if first else F.lit(0)
    return cut.select("doc_id", "size", "text_crc32", "place", "shard", (F.col("row_no") - begin).cast("long").alias("slot"))


def write_shards(docs: DataFrame, plan: DataFrame, path: str, id_col: str = "doc_id", max_records: int = 1_000_000) -> None:
    """The documents as Parquet, a folder for each shard, rows in curve order, so that file statistics prune.

    Ids must be unique here.
    """
    where = plan.select(F.col("doc_id").alias("_id"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    out = docs.join(where, docs[id_col] == where["_id"]).drop("_id")
    out = out.repartitionByRange(shuffle_width(docs.sparkSession), "_shard", "_slot").sortWithinPartitions("_shard", "_slot")
    out.drop("_slot").write.mode("overwrite").option("maxRecordsPerFile", max_records).partitionBy("_shard").parquet(path)
