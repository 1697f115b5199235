"""Exact duplicates: a tree of merges over sorted runs of digests.

Every partition sorts the digests of its texts into one run and folds equal
neighbours.  Partitions then exchange runs in rounds.  The slot of a partition
is a number of several digits; in round r it trades with the slots that differ
in digit r only, each taking the digests whose own slot has its digit there.
After the last round each slot holds one sorted run of one digest range.  All
slots work in every round, so nothing meets in one root, and copies fold at
every level: of a text that a third of all rows share, a slot sends one row.

A digest counts as verified when SHA-256, byte length and a second,
independent 64-bit hash agree; rows that agree in part stay apart.

Null texts are empty texts.  A null id is the last choice to stay.  Rows that
repeat both id and text count in the group size and share one fate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import ids_and_text, shuffle_width
from leafmill.session import bound_batches, through_table

KEY = ["sha256", "n_bytes", "check"]
WAYS = 8


def digest_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """doc_id, and the key under which equal texts meet; the only step that reads texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    text = normalise(text) if normalise else text
    return ids_and_text(docs, id_col, text_col).select(
        "doc_id", F.unhex(F.sha2(text, 256)).alias("sha256"), F.octet_length(text).cast("long").alias("n_bytes"),
        F.xxhash64(text).alias("check"),
    )


def digits_for(width: int, ways: int = WAYS) -> list[int]:
    """Radices of a slot number with about ``width`` values and at most ``ways`` partners a round."""
    radices = []
    while width > 1:
        radices.append(min(ways, width))
        width = -(-width // ways)
    return radices or [1]


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows in, one row for each key out; holds one batch and one row."""
    carry = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        table = rows if carry is None else pa.concat_tables([carry.cast(rows.schema), rows])
        folded = table.group_by(KEY, use_threads=False).aggregate([("keep_id", "first"), ("group_size", "sum")])
        folded = folded.rename_columns({"keep_id_first": "keep_id", "group_size_sum": "group_size"}).select(table.column_names)
        carry = folded.slice(folded.num_rows - 1)
        yield from folded.slice(0, folded.num_rows - 1).to_batches()
    if carry is not None:
        yield from carry.to_batches()


def merge_runs(digests: DataFrame, keep: str = "smallest", ways: int = WAYS, width: int | None = None) -> DataFrame:
    """One row a text: its key, ``keep_id`` (smallest or largest id) and ``group_size``."""
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is smallest or largest, not {keep}")
    bound_batches(digests.sparkSession)
    order = F.col("keep_id").asc_nulls_last() if keep == "smallest" else F.col("keep_id").desc_nulls_last()
    radices = digits_for(width or shuffle_width(digests.sparkSession), ways)
    slots = 1
    for radix in radices:
        slots *= radix
    # The leading 48 bits of a digest are as good as random, so ranges of them are even.
    home = F.floor(F.conv(F.hex(F.substring("sha256", 1, 6)), 16, 10).cast("double") / float(1 << 48) * slots).cast("int")
    runs = digests.select(*KEY, F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))

    def fold(frame: DataFrame) -> DataFrame:
        return frame.select(*runs.columns).sortWithinPartitions(*KEY, order).mapInArrow(_fold, runs.schema)

    merged = fold(runs)
    unit = 1
    for radix in radices:
        here = F.pmod(F.spark_partition_id(), F.lit(slots))
        own, wanted = F.floor(here / unit) % radix, F.floor(home / unit) % radix
        merged = merged.withColumn("_to", (here + (wanted - own) * unit).cast("int")).repartitionById(slots, "_to")
        merged = fold(merged)
        unit *= radix
    return merged


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                normalise: Callable[[Column], Column] | None = None, ways: int = WAYS) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256.

    The way back is a plain equi-join with the groups of more than one row
    only; a hot text splits there, as each group stands once on its side.
    """
    rows = through_table(digest_table(docs, id_col, text_col, normalise), "digests")
    groups = merge_runs(rows, keep, ways).filter("group_size > 1")
    joined = rows.join(groups, KEY, "left")
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"), F.lower(F.hex("sha256")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The documents with one row for each text, with all their columns.

    Rows that repeat both id and text are one row afterwards.
    """
    gone = find_copies(docs, id_col, text_col, keep).filter("not kept").select(
        F.col("doc_id").alias("_gone"), F.col("text_sha256").alias("_gone_sha256"))
    # Id and text together tell a row, so one that only repeats an id stays.
    rows = docs.withColumn("_sha256", F.sha2(F.coalesce(docs[text_col].cast("string"), F.lit("")), 256))
    left = rows.join(gone, rows[id_col].eqNullSafe(gone["_gone"]) & (rows["_sha256"] == gone["_gone_sha256"]), "left_anti")
    return left.dropDuplicates([id_col, "_sha256"]).drop("_sha256")
