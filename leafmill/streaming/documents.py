"""Submit, then poll: files are taken as they arrive, results appear in a table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafmill.functions.paths import base_name, is_archive, local_form
from leafmill.limits import Limits
from leafmill.operators.admission import confine, size_refusal, typed_error, with_options, with_suffix
from leafmill.operators.ledger import STARTED, SUBMITTED, job_snapshot, outcome_events
from leafmill.plans.corpus import outcomes
from leafmill.fixed import INPUT_REJECTED
from leafmill.sources.files import read_files
from leafmill.streaming.commits import commit_batch, finished_batches, read_batches

_TAKEN = "job_id string, event_id string, ts timestamp, type string, filename string"
_ENDED = f"{_TAKEN}, error_code string, error string, missing_dependencies array<string>"
_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_documents(files: DataFrame, limits: Limits, roots: Iterable[str], resolve_links: bool = True) -> DataFrame:
    """Files as documents under default options; the path is the request id.

    The rules are those of requests that name a file: roots, links, size.
    Refused files stay closed.
    """
    confined = confine(files.select("path", "length"), roots, resolve_links)
    decided = confined.withColumn("_message", F.coalesce("path_error", size_refusal(F.col("length"), limits)))
    accepted = F.when(F.col("_message").isNull(), local_form(F.col("path")))
    packed = F.when(is_archive(F.col("path")), accepted)
    opened = read_files(decided.withColumn("archive", packed).withColumn("location", F.when(F.col("archive").isNull(), accepted)))
    unread = F.col("location").isNotNull() & F.col("content").isNull()
    message = F.when(unread, F.concat(F.lit("cannot open `"), F.col("path"), F.lit("`"))).otherwise(F.col("_message"))
    taken = opened.select(
        F.col("path").alias("request_id"), base_name(F.col("path")).alias("filename"), "content",
        F.parse_json(F.lit("{}")).alias("options"),
        F.when(message.isNotNull(), typed_error(INPUT_REJECTED, message)).alias("error"),
        F.col("archive").alias("location"),
    )
    return with_options(with_suffix(taken)).drop("options")


def stream_documents(spark: SparkSession, directory: str, out: str, checkpoint: str, limits: Limits,
                     roots: Iterable[str], glob: str | None = None, resolve_links: bool = True, files_per_batch: int = 1000, once: bool = False,
                     bytes_per_batch: int | None = None, **hook) -> StreamingQuery:
    """Start the stream.  Outcomes go to ``out``, a folder per micro-batch, and what happened to each file beside them.

    Each batch commits twice: when its files are taken (their jobs are
    submitted and started), and when outcomes and the events that end the jobs
    are written, both or neither.  A batch that runs again after a failure overwrites its own
    folders, so each file has one outcome.  ``once`` works off what is there and ends.

    A batch costs the driver many seconds to plan, whatever it holds; ``bytes_per_batch``
    bounds it by the size of its files instead of their number, so that small files share that.
    """
    reader = (
        spark.readStream.format("binaryFile").schema(_FILE)
        .option("recursiveFileLookup", "true")
    )
    if bytes_per_batch is None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", max(bytes_per_batch, 1))
    if glob:
        reader = reader.option("pathGlobFilter", glob)

    def write(batch: DataFrame, batch_id: int) -> None:
        taken = taken_events(batch.select("path", "modificationTime"), F.current_timestamp())
        commit_batch(spark, {f"{out}-taken": taken}, f"{out}-taken-commits", batch_id)
        made = outcomes(arriving_documents(batch, limits, roots, resolve_links), limits, **hook)
        made.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        written = spark.read.schema(made.schema).parquet(f"{out}/batch_id={batch_id}")
        ended = outcome_events(written, F.current_timestamp())
        commit_batch(spark, {f"{out}-ended": ended}, f"{out}-commits", batch_id)

    writer = reader.load(directory).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def taken_events(files: DataFrame, now: Column) -> DataFrame:
    """Files as the submission and the start of their jobs; the path is the job's id."""
    both = F.array(F.struct(F.col("modificationTime").alias("ts"), F.lit(SUBMITTED).alias("type"), base_name(F.col("path")).alias("filename")),
                   F.struct(F.greatest(now, "modificationTime").alias("ts"), F.lit(STARTED).alias("type"), F.lit(None).cast("string").alias("filename")))
    return files.select(F.col("path").alias("job_id"), F.lit("taken").alias("event_id"), F.explode(both).alias("e")).select("job_id", "event_id", "e.*")


def poll(spark: SparkSession, out: str) -> DataFrame:
    """The outcomes of finished batches."""
    done = finished_batches(spark, f"{out}-commits")
    return spark.read.parquet(*[f"{out}/batch_id={n}" for n in done]) if done else spark.read.parquet(out).limit(0)


def document_jobs(spark: SparkSession, out: str) -> DataFrame:
    """The job of each file that was taken: running until its batch is finished, then as it ended."""
    taken = read_batches(spark, f"{out}-taken", finished_batches(spark, f"{out}-taken-commits"), _TAKEN)
    ended = read_batches(spark, f"{out}-ended", finished_batches(spark, f"{out}-commits"), _ENDED)
    return job_snapshot(taken.unionByName(ended, allowMissingColumns=True))
