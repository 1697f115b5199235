"""An equi-join that stays even when few keys hold most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/HOT_SHARE of all rows, so there are
# fewer than HOT_SHARE hot keys whatever the size of the data.
HOT_SHARE = 128
SALTS = 64


def join_many_to_one(
    rows: DataFrame, ones: DataFrame, on: Sequence[str], counts: DataFrame, count: str, row_id: str
) -> DataFrame:
    """Join ``rows`` to ``ones``, in which each key stands once.

    Hot keys are found from ``counts``, the number of rows per key, which
    should be cheap to read twice; ``ones`` is read once.  The list of hot keys,
    bounded by ``HOT_SHARE``, is broadcast; a hot key's rows are spread over
    ``SALTS`` partitions and its one partner is copied to each.  Cold keys,
    nearly all, are joined as they are.
    """
    on = list(on)
    total = counts.agg(F.sum(count)).scalar()
    hot = counts.filter(F.col(count) * HOT_SHARE > total).select(*on, F.lit(True).alias("_hot"))
    salted_rows = rows.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(row_id), F.lit(SALTS)).cast("int")).otherwise(0)
    ).drop("_hot")
    salted_ones = ones.join(F.broadcast(hot), on, "left").withColumn(
        "_salt",
        F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))),
    ).drop("_hot")
    return salted_rows.join(salted_ones, [*on, "_salt"]).drop("_salt")
