"""The job ledger: events folded to one row per job, deadlines, listing, retention.

An event is ``(job_id, event_id, ts, type)`` with type ``submitted``,
``started``, ``succeeded``, ``failed`` or ``cancelled``.  The fold is made of
minimums only, so it needs no order of arrival and combines on the map side: a
job with a third of all events still leaves one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill import fixed
from leafmill.limits import Limits

SUBMITTED, STARTED = "submitted", "started"


DETAILS = {"filename": "string", "error_code": "string", "error": "string", "missing_dependencies": "array<string>"}


def with_details(events: DataFrame) -> DataFrame:
    """Events with all of ``DETAILS``; those they lack are null."""
    absent = {name: F.lit(None).cast(kind) for name, kind in DETAILS.items() if name not in events.columns}
    return events.withColumns(absent) if absent else events


def event_fold() -> list[Column]:
    """Aggregates that hold all a job's state needs; used on batches and streams alike.

    Takes events ``with_details``: the first submission names the file, the
    first end carries the error.
    """
    kind = F.col("type")
    ends = F.struct("ts", "event_id", "type", "error_code", "error", "missing_dependencies")
    return [
        F.min(F.when(kind == SUBMITTED, F.col("ts"))).alias("created_at"),
        F.min(F.when((kind == SUBMITTED) & F.col("filename").isNotNull(), F.struct("ts", "event_id", "filename"))).alias("first_name"),
        F.min(F.when(kind == STARTED, F.struct("ts", "event_id"))).alias("first_start"),
        F.min(F.when(kind.isin(*fixed.TERMINAL_STATES), ends)).alias("first_end"),
    ]


def fold_to_jobs(folded: DataFrame) -> DataFrame:
    """The fold to job rows: the first terminal state wins, later ones change nothing.

    A start after the end means the job was cancelled while queued, so it
    never started.
    """
    end, start = F.col("first_end"), F.col("first_start")
    started = start.isNotNull() & (
        end.isNull() | (start < F.struct(end["ts"].alias("ts"), end["event_id"].alias("event_id")))
    )
    return folded.select(
        "job_id",
        F.when(end.isNotNull(), end["type"]).when(started, fixed.RUNNING).otherwise(fixed.QUEUED).alias("status"),
        "created_at",
        F.when(started, start["ts"]).alias("started_at"),
        end["ts"].alias("finished_at"),
        F.col("first_name.filename").alias("filename"),
        end["error_code"].alias("error_code"),
        end["error"].alias("error"),
        F.coalesce(end["missing_dependencies"], F.array().cast("array<string>")).alias("missing_dependencies"),
    )


def job_snapshot(events: DataFrame) -> DataFrame:
    """Events to ``(job_id, status, created_at, started_at, finished_at)`` and ``DETAILS``."""
    return fold_to_jobs(with_details(events).groupBy("job_id").agg(*event_fold()))


def outcome_events(outcomes: DataFrame, finished_at: Column) -> DataFrame:
    """Outcomes of a run as the events that end their jobs; the request id is the job's."""
    failed = F.col("error").isNotNull()
    return outcomes.select(
        F.col("request_id").alias("job_id"), F.lit("outcome").alias("event_id"), finished_at.alias("ts"),
        F.when(failed, fixed.FAILED).otherwise(fixed.SUCCEEDED).alias("type"),
        F.col("result.metadata.filename").alias("filename"), F.col("error.error_code").alias("error_code"),
        F.col("error.error").alias("error"), F.col("error.missing_dependencies").alias("missing_dependencies"),
    )


def mark_timeouts(jobs: DataFrame, now: Column, limits: Limits) -> DataFrame:
    """Turn jobs that ran past their deadline into failed ones, with that error.

    The deadline follows from the start, so an end that comes after it does
    not undo the timeout.
    """
    deadline = F.col("started_at") + F.make_dt_interval(secs=F.lit(limits.timeout_secs))
    late = F.coalesce(
        (F.col("started_at").isNotNull()) & (now >= deadline)
        & (F.col("finished_at").isNull() | (F.col("finished_at") > deadline)),
        F.lit(False),
    )
    return (
        jobs.withColumn("_late", late)
        .withColumn("error_code", F.when(F.col("_late"), fixed.TIMEOUT).otherwise(F.col("error_code")))
        .withColumn("error", F.when(F.col("_late"), f"the job ran past the {limits.timeout_secs}s limit").otherwise(F.col("error")))
        .withColumn("missing_dependencies", F.when(F.col("_late"), F.array().cast("array<string>")).otherwise(F.col("missing_dependencies")))
        .withColumn("finished_at", F.when(F.col("_late"), deadline).otherwise(F.col("finished_at")))
        .withColumn("status", F.when(F.col("_late"), fixed.FAILED).otherwise(F.col("status")))
        .drop("_late")
    )


def list_jobs(jobs: DataFrame) -> DataFrame:
    """Jobs in order of submission, without their results."""
    return jobs.drop("result").orderBy("created_at", "job_id")


def get_job(jobs: DataFrame, job_id: Column | str | int) -> DataFrame:
    """The job of that id; no row for an unknown one.  The filter reaches the scan."""
    return jobs.filter(F.col("job_id") == job_id)


def retain_jobs(jobs: DataFrame, limits: Limits) -> DataFrame:
    """Jobs that stay when the table holds ``max_jobs``: live ones always, the newest finished ones beside them.

    Without that bound all stay.  A top-k finds the border, the place in time of
    the oldest finished job that stays; then it is a filter, and nothing is gathered.
    """
    if limits.max_jobs is None:
        return jobs
    finished = F.col("status").isin(*fixed.TERMINAL_STATES)
    room = max(limits.max_jobs - jobs.filter(~finished).count(), 0)
    place = F.struct("created_at", "job_id")
    newest = jobs.filter(finished).select(place.alias("place")).orderBy(F.desc("place")).limit(room)
    border = newest.agg(F.min("place").alias("place")).first()["place"]
    if border is None:
        return jobs.filter(~finished)
    kinds = dict(jobs.dtypes)
    oldest = F.struct(*[F.lit(border[c]).cast(kinds[c]).alias(c) for c in ("created_at", "job_id")])
    return jobs.filter(~finished | (place >= oldest))


def event_rows(df: DataFrame, types: dict[str, str], job: str, event: str, ts: str, kind: str, **details: Column) -> DataFrame:
    """Any event table to ledger events, by a map from its types to the ledger's and columns for ``DETAILS``."""
    renamed = F.create_map(*[F.lit(part) for pair in types.items() for part in pair])
    return df.select(
        F.col(job).alias("job_id"), F.col(event).alias("event_id"), F.col(ts).alias("ts"), renamed[F.col(kind)].alias("type"),
        *[value.alias(name) for name, value in details.items()],
    )
