"""Queries for the job ledger.  A user's events stand for a job's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.catalog.registry import query, table
from leafmill.limits import Limits
from leafmill.operators import ledger as jobs
from leafmill.session import work_dir
from leafmill.streaming.ledger import compact_ledger, current_ledger
from leafmill.streaming.ledger import stream_ledger as start_ledger
from leafmill.streaming.live_ledger import live_jobs, stream_live_ledger

_TYPES = {"signup": "submitted", "view": "started", "click": "cancelled", "purchase": "succeeded", "error": "failed"}
# Of events this long ago, most jobs still run or wait, so each rule has cases.
_NOW = "2024-01-02 00:00:00"

_FOLD_SQL = """
WITH ends AS (
  SELECT user_id, arg_min(event_type, (ts, event_id)) AS kind, min(ts) AS ts, min((ts, event_id)) AS place, arg_min(event_id, (ts, event_id)) AS end_id
  FROM {events} WHERE event_type IN ('click', 'purchase', 'error') GROUP BY user_id
), begins AS (
  SELECT user_id, min((ts, event_id)) AS place, min(ts) AS ts FROM {events} WHERE event_type = 'view' GROUP BY user_id
), submits AS (
  SELECT user_id, min(ts) AS ts, arg_min(event_id, (ts, event_id)) AS first_id FROM {events} WHERE event_type = 'signup' GROUP BY user_id
), folded AS (
  SELECT u.user_id AS job_id, s.ts AS created_at, CASE WHEN e.place IS NULL OR b.place < e.place THEN b.ts END AS started_at,
    e.ts AS finished_at, e.kind, 'f' || first_id || '.pdf' AS filename, CASE WHEN kind = 'error' THEN 'parse_failed' END AS error_code,
    CASE WHEN kind = 'error' THEN 'event ' || end_id || ' failed' END AS error, CASE WHEN kind = 'error' THEN 'tool' ELSE '' END AS missing
  FROM (SELECT DISTINCT user_id FROM {events}) u LEFT JOIN ends e USING (user_id) LEFT JOIN begins b USING (user_id)
    LEFT JOIN submits s USING (user_id)
), jobs AS (
  SELECT *, CASE kind WHEN 'click' THEN 'cancelled' WHEN 'purchase' THEN 'succeeded' WHEN 'error' THEN 'failed'
    ELSE CASE WHEN started_at IS NOT NULL THEN 'running' ELSE 'queued' END END AS status
  FROM folded
)
"""
_ALL_SQL = _FOLD_SQL.format(events="events")
# Jobs named by user and page of a shop window: many more jobs, most of them unfinished.
_MANY = "(SELECT user_id * 100 + hour(ts) AS user_id, event_id, ts, event_type FROM events)"
_MANY_SQL = _FOLD_SQL.format(events=_MANY)
_SHOW = """job_id, status, epoch_us(created_at) AS created_us, epoch_us(started_at) AS started_us, epoch_us(finished_at) AS finished_us,
  filename, error_code, error, missing"""


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.event_rows(table(spark, sf, "events"), _TYPES, "user_id", "event_id", "ts", "event_type", **_details())


def _details() -> dict[str, Column]:
    """A submission names a file; an error tells what failed and what was missing."""
    failed = F.col("event_type") == "error"
    return {
        "filename": F.when(F.col("event_type") == "signup", F.concat(F.lit("f"), F.col("event_id").cast("string"), F.lit(".pdf"))),
        "error_code": F.when(failed, "parse_failed"),
        "error": F.when(failed, F.concat(F.lit("event "), F.col("event_id").cast("string"), F.lit(" failed"))),
        "missing_dependencies": F.when(failed, F.array(F.lit("tool"))),
    }


def _hourly_events(spark: SparkSession, sf: str) -> DataFrame:
    """One job per user and hour of the day."""
    return _events(spark, sf).withColumn("job_id", F.col("job_id") * 100 + F.hour("ts"))


def _shown(df: DataFrame, *more: str) -> DataFrame:
    """Wall-clock times as microseconds, whatever the session's time zone."""
    def micros(column: str):
        at = F.col(column)
        utc = F.make_timestamp(
            F.year(at), F.month(at), F.dayofmonth(at), F.hour(at), F.minute(at), F.extract(F.lit("SECOND"), at), F.lit("UTC")
        )
        return F.unix_micros(utc)

    return df.select(
        "job_id", "status", micros("created_at").alias("created_us"), micros("started_at").alias("started_us"),
        micros("finished_at").alias("finished_us"), *(more or ("filename", "error_code", "error")),
        *([] if more else [F.array_join("missing_dependencies", ";").alias("missing")]),
    )


@query(_ALL_SQL + f"SELECT {_SHOW} FROM jobs")
def job_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(jobs.job_snapshot(_events(spark, sf)))


_DEADLINE_SQL = _MANY_SQL + """
, marked AS (
  SELECT *, started_at + INTERVAL 600 SECOND AS deadline,
    coalesce(started_at + INTERVAL 600 SECOND <= {now} AND (finished_at IS NULL OR finished_at > started_at + INTERVAL 600 SECOND), false) AS late
  FROM jobs
)
"""


@query(_DEADLINE_SQL.replace("{now}", f"TIMESTAMP '{_NOW}'") + """
SELECT job_id, CASE WHEN late THEN 'failed' ELSE status END AS status, epoch_us(created_at) AS created_us, epoch_us(started_at) AS started_us,
  epoch_us(CASE WHEN late THEN deadline ELSE finished_at END) AS finished_us, CASE WHEN late THEN 'timeout' ELSE error_code END AS error_code
FROM marked
""")
def job_timeouts(spark: SparkSession, sf: str) -> DataFrame:
    snapshot = jobs.job_snapshot(_hourly_events(spark, sf))
    now = F.lit(_NOW).cast(snapshot.schema["started_at"].dataType)
    return _shown(jobs.mark_timeouts(snapshot, now, Limits()), "error_code")


@query(_MANY_SQL + f"SELECT {_SHOW} FROM jobs")
def job_listing(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(jobs.list_jobs(jobs.job_snapshot(_hourly_events(spark, sf))))


@query(_MANY_SQL + f"SELECT {_SHOW} FROM jobs WHERE job_id = (SELECT max(user_id * 100 + hour(ts)) FROM events)")
def job_lookup(spark: SparkSession, sf: str) -> DataFrame:
    events = _hourly_events(spark, sf)
    wanted = events.agg(F.max("job_id")).scalar()
    return _shown(jobs.get_job(jobs.job_snapshot(events), wanted))


@query(_MANY_SQL + f"""
, counted AS (
  SELECT *, row_number() OVER (PARTITION BY status IN ('succeeded', 'failed', 'cancelled') ORDER BY created_at NULLS FIRST, job_id) AS rn,
    count(*) OVER () AS total FROM jobs
)
SELECT {_SHOW} FROM counted WHERE NOT (status IN ('succeeded', 'failed', 'cancelled') AND rn <= total - 2000)
""")
def job_retention(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(jobs.retain_jobs(jobs.job_snapshot(_hourly_events(spark, sf)), Limits(max_jobs=2000)))


@query(_ALL_SQL + f"SELECT {_SHOW} FROM jobs")
def ledger_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The whole event table as a stream of several micro-batches, of which the first two are compacted."""
    arrived = work_dir(spark, "events")
    table(spark, sf, "events").repartition(8, "event_id").write.parquet(arrived)
    arriving = spark.readStream.schema(spark.read.parquet(arrived).schema).option("maxFilesPerTrigger", 2).parquet(arrived)
    events = jobs.event_rows(arriving, _TYPES, "user_id", "event_id", "ts", "event_type", **_details())
    out, checkpoint = work_dir(spark, "ledger"), work_dir(spark, "ledger-checkpoint")
    start_ledger(events, out, checkpoint, once=True).awaitTermination()
    compact_ledger(spark, out, upto=1)
    return _shown(current_ledger(spark, out))


@query(_DEADLINE_SQL.replace("{now}", "(SELECT max(ts) - INTERVAL 600 SECOND FROM events)") + """
SELECT job_id, CASE WHEN late THEN 'failed' ELSE status END AS status, epoch_us(created_at) AS created_us, epoch_us(started_at) AS started_us,
  epoch_us(CASE WHEN late THEN deadline ELSE finished_at END) AS finished_us, filename, CASE WHEN late THEN 'timeout' ELSE error_code END AS error_code,
  CASE WHEN late THEN 'the job ran past the 600s limit' ELSE error END AS error, CASE WHEN late THEN '' ELSE missing END AS missing
FROM marked
""")
def live_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The event table in six batches by time, each with the last minutes of the one before once more; deadlines fire in the stream."""
    arrived = work_dir(spark, "live-events")
    whole = table(spark, sf, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    borders = whole.select(at.alias("at")).approxQuantile("at", [k / 6 for k in range(7)], 0.01)
    for k, (low, high) in enumerate(zip(borders, borders[1:])):
        from_start, to_end = k == 0, k == 5
        part = whole.filter(F.lit(from_start) | (at >= int(low) - 300_000_000)).filter(F.lit(to_end) | (at < int(high)))
        part.write.parquet(f"{arrived}/{k}")
    arriving = spark.readStream.schema(whole.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(arrived)
    events = jobs.event_rows(arriving, _TYPES, "user_id", "event_id", "ts", "event_type", **_details()).withColumn("job_id", F.col("job_id") * 100 + F.hour("ts"))
    out = work_dir(spark, "live-ledger")
    stream_live_ledger(events, out, work_dir(spark, "live-checkpoint"), Limits(), horizon_secs=400 * 86_400, compact_every=3, once=True).awaitTermination()
    return _shown(live_jobs(spark, out))
