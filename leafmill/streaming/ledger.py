"""The ledger kept current while events arrive.

A job's fold is made of minimums, and minimums of parts are those of the whole.
So a micro-batch is folded by itself and written; the stream keeps no state, a
batch that runs again changes nothing, and parts are merged when they are read
or compacted.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafmill.operators.ledger import event_fold, fold_to_jobs, with_details

PARTS = ("created_at", "first_name", "first_start", "first_end")


def stream_ledger(events: DataFrame, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Start the stream: the fold of each micro-batch goes to ``out``, a folder per batch.

    The fold goes by event time, so late and repeated events change nothing
    they should not.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        folded = with_details(batch).groupBy("job_id").agg(*event_fold())
        folded.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _merged(parts: DataFrame) -> DataFrame:
    return parts.groupBy("job_id").agg(*[F.min(part).alias(part) for part in PARTS])


def _parts(spark: SparkSession, out: str) -> DataFrame:
    """The last compacted table and the batches behind it; partition filters keep the others closed."""
    batches = spark.read.parquet(out)
    try:
        compacted = spark.read.parquet(f"{out}-compact")
    except AnalysisException:  # none yet
        return batches.select("job_id", *PARTS)
    upto = compacted.agg(F.max("upto")).scalar()
    return compacted.filter(F.col("upto") == upto).select("job_id", *PARTS).unionAll(
        batches.filter(F.col("batch_id") > upto).select("job_id", *PARTS))


def compact_ledger(spark: SparkSession, out: str, upto: int, forget_before: dt.datetime | None = None) -> None:
    """Merge the batches up to ``upto``, which must be closed, into one table beside ``out``.

    With ``forget_before`` jobs that ended before that time leave the table; an
    event for such a job that comes later starts a new row.  Folders of merged
    batches are no longer read and may be deleted.
    """
    parts = spark.read.parquet(out).filter(F.col("batch_id") <= upto).select("job_id", *PARTS)
    try:
        older = spark.read.parquet(f"{out}-compact")
        parts = parts.unionAll(older.filter(F.col("upto") == older.agg(F.max("upto")).scalar()).select("job_id", *PARTS))
    except AnalysisException:  # the first time
        pass
    merged = _merged(parts)
    if forget_before is not None:
        merged = merged.filter(F.col("first_end").isNull() | (F.col("first_end.ts") >= F.lit(forget_before)))
    merged.write.mode("overwrite").parquet(f"{out}-compact/upto={upto}")


def current_ledger(spark: SparkSession, out: str) -> DataFrame:
    """The jobs as they stand.  Deadlines are applied to this when it is read."""
    return fold_to_jobs(_merged(_parts(spark, out)))
