"""The ledger with state: jobs change as events arrive, and deadlines pass while nobody looks.

A stateful operator keeps the jobs.  It gives a job's row whenever that changes
(update mode), and looks at a job again at two points in event time:

* at the deadline of a running job, which then fails with ``timeout``.  A timer
  fires once the watermark has passed, that is when no end from before the
  deadline is to be waited for any more;
* ``horizon`` after the end, when the job's state goes.  Until then repeated and late
  events meet the state and change nothing they should not.  Events that are
  older than the watermark less the horizon are refused, so none of them brings a gone job back.

Each call to the state server takes milliseconds, far more than the work on a job.
So jobs share rows of state, a group of them (by hash) each, with one timer for the
earliest of their points; a micro-batch reads and writes a row once however many
of its jobs have events.  ``groups`` bounds these calls; it is fixed for the life of a checkpoint.

Each micro-batch is folded by job in the map tasks before it is shuffled, so a
job with a third of all events costs its reducer one row a task.  Folds are
minimums, so neither order nor repetition matters.

Rows carry a revision.  The sink writes a folder per batch and the commit behind
it; the table of jobs is the greatest revision of each.  Every ``compact_every``
batches the finished ones are merged into one table, by the stream itself.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from leafmill import fixed
from leafmill.limits import Limits
from leafmill.operators.ledger import STARTED, SUBMITTED, with_details
from leafmill.session import ship_package
from leafmill.streaming.commits import commit_batch, finished_batches, read_batches

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Places (time in microseconds, event id) of the first submission, named submission, start and end, and what these carry.
_FOLD = (
    "created long, name_at long, name_event long, filename string, start_at long, start_event long, "
    "end_at long, end_event long, type string, error_code string, error string, missing_dependencies array<string>"
)
_FIELDS = [part.split()[0] for part in _FOLD.split(", ")]
_STATE = "jobs string, due long"  # the jobs as JSON, each its id and what is kept of it; the earliest time of all
GROUPS = 4096
_KEPT = [*_FIELDS, "timed_out", "revision", "due"]
JOB = (
    "status string, created_at timestamp, started_at timestamp, finished_at timestamp, filename string, "
    "error_code string, error string, missing_dependencies array<string>"
)
# The minimum of each group is taken by its first two fields; the rest go with it.
_GROUPS = (("name_at", "name_event", "filename"), ("start_at", "start_event"),
           ("end_at", "end_event", "type", "error_code", "error", "missing_dependencies"))


def _earlier(a: dict[str, Any], b: dict[str, Any]) -> dict[str, Any]:
    """The fold of two folds."""
    found = dict(a)
    if b["created"] is not None and (a["created"] is None or b["created"] < a["created"]):
        found["created"] = b["created"]
    for at, event, *rest in _GROUPS:
        if b[at] is not None and (a[at] is None or (b[at], b[event]) < (a[at], a[event])):
            found.update({name: b[name] for name in (at, event, *rest)})
    return found


def fold_batches(key_type: pa.DataType):
    """Events (job_id, us, event_id, type, details) to folds, in each map task."""
    schema_of = {"long": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string())}
    types = [schema_of[part.split()[1]] for part in _FOLD.split(", ")]
    empty = dict.fromkeys(_FIELDS)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folds: dict[Any, dict[str, Any]] = {}
            newest: dict[Any, int] = {}
            for e in batch.to_pylist():
                job, at, event, kind = e["job_id"], e["us"], e["event_id"], e["type"]
                if at is None or kind is None:
                    continue
                own = dict(empty)
                if kind == SUBMITTED:
                    own["created"] = at
                    if e["filename"] is not None:
                        own.update(name_at=at, name_event=event, filename=e["filename"])
                elif kind == STARTED:
                    own.update(start_at=at, start_event=event)
                elif kind in fixed.TERMINAL_STATES:
                    own.update(end_at=at, end_event=event, type=kind, error_code=e["error_code"], error=e["error"],
                               missing_dependencies=e["missing_dependencies"])
                folds[job] = _earlier(folds[job], own) if job in folds else own
                newest[job] = max(newest.get(job, at), at)
            columns = [pa.array(list(folds), key_type), pa.array(list(newest.values()), pa.int64())]
            columns += [pa.array([f[name] for f in folds.values()], kind) for name, kind in zip(_FIELDS, types)]
            yield pa.record_batch(columns, names=["job_id", "newest", *_FIELDS])

    return fold


class JobProcessor(StatefulProcessor):
    """The state of a group of jobs, its timer, and a job's row whenever that changes."""

    def __init__(self, limits: Limits, horizon_secs: int):
        self.timeout_us, self.timeout_secs = limits.timeout_secs * 1_000_000, limits.timeout_secs
        self.horizon_us = horizon_secs * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("jobs", _STATE)

    def close(self) -> None:
        pass

    def _known(self) -> tuple[dict[Any, dict[str, Any]], int | None]:
        found = self.state.get()
        if found is None:
            return {}, None
        return {job_id: dict(zip(_KEPT, kept)) for job_id, *kept in json.loads(found[0])}, found[1]

    def _keep(self, jobs: dict[Any, dict[str, Any]], timer: int | None) -> None:
        """``timer`` is the one that is set; it is only touched where the earliest time changes."""
        due = min((job["due"] for job in jobs.values() if job["due"] is not None), default=None)
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        if jobs:
            kept = [[job_id, *[job[name] for name in _KEPT]] for job_id, job in jobs.items()]
            self.state.update((json.dumps(kept, ensure_ascii=False, separators=(",", ":")), due))
        else:
            self.state.clear()

    def _started(self, job: dict[str, Any]) -> bool:
        """A start after the end means the job was cancelled while queued."""
        start = (job["start_at"], job["start_event"])
        return start[0] is not None and (job["end_at"] is None or start < (job["end_at"], job["end_event"]))

    def _deadline(self, job: dict[str, Any]) -> int | None:
        return job["start_at"] + self.timeout_us if self._started(job) else None

    def _shown(self, job: dict[str, Any]) -> tuple:
        """What the job's row says."""
        started = self._started(job)
        start = job["start_at"] if started else None
        if job["timed_out"]:
            return (fixed.FAILED, job["created"], start, start + self.timeout_us, job["filename"], fixed.TIMEOUT,
                    f"the job ran past the {self.timeout_secs}s limit", [])
        status = job["type"] or (fixed.RUNNING if started else fixed.QUEUED)
        return (status, job["created"], start, job["end_at"], job["filename"], job["error_code"], job["error"], job["missing_dependencies"] or [])

    def _row(self, job_id: Any, job: dict[str, Any]) -> Row:
        status, created, start, end, filename, code, error, missing = self._shown(job)
        return Row(job_id=job_id, revision=job["revision"], status=status, created=created, started=start, finished=end, filename=filename,
                   error_code=code, error=error, missing_dependencies=missing)

    def _due(self, job: dict[str, Any]) -> int | None:
        """When to look at the job again, in milliseconds."""
        deadline, end = self._deadline(job), job["end_at"]
        if job["timed_out"]:
            due = deadline + self.horizon_us
        elif deadline is not None and (end is None or end > deadline):
            due = deadline
        elif end is not None:
            due = end + self.horizon_us
        else:
            return None  # queued: it waits as long as it takes
        return -(-due // 1000)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        jobs, timer = self._known()
        oldest = timerValues.getCurrentWatermarkInMs() * 1000 - self.horizon_us
        arrived: dict[Any, list[Row]] = {}
        for row in rows:
            if row["newest"] >= oldest:
                arrived.setdefault(row["job_id"], []).append(row)
        if not arrived:
            return
        for job_id, fresh in arrived.items():
            known = jobs.get(job_id)
            job = known or {**dict.fromkeys(_FIELDS), "timed_out": False, "revision": 0, "due": None}
            for row in fresh:
                timed_out = job["timed_out"], job["start_at"], job["start_event"], job["end_at"], job["end_event"]
                job = {**job, **_earlier({name: job[name] for name in _FIELDS}, {name: row[name] for name in _FIELDS})}
                if timed_out[0]:  # the deadline has passed: what was decided stays
                    job.update(zip(("start_at", "start_event", "end_at", "end_event"), timed_out[1:]))
            if known is None or self._shown(job) != self._shown(known):
                job["revision"] += 1
                yield self._row(job_id, job)
            job["due"] = self._due(job)
            jobs[job_id] = job
        self._keep(jobs, timer)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        """Looks at all jobs of the group whose time has come; those that ended a horizon ago go."""
        jobs, timer = self._known()
        now, expired = timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()
        for job_id, job in list(jobs.items()):
            while job["due"] is not None and job["due"] <= max(now, expired):
                deadline = self._deadline(job)
                if job["timed_out"] or deadline is None or (job["end_at"] is not None and job["end_at"] <= deadline):
                    del jobs[job_id]
                    break
                job["timed_out"] = True
                job["revision"] += 1
                yield self._row(job_id, job)
                job["due"] = self._due(job)
        self._keep(jobs, None if timer == expired else timer)  # one that has fired is gone


def job_changes(events: DataFrame, limits: Limits, delay: str, horizon_secs: int, groups: int = GROUPS) -> DataFrame:
    """A stream of events to a stream of job rows, each with its revision.

    ``delay`` is how far events may lie behind the newest one before a deadline is taken to have passed.
    """
    spark = events.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    timed = with_details(events).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    flat = timed.select("job_id", F.unix_micros("ts").alias("us"), F.col("event_id").cast("long").alias("event_id"), "type", "filename",
                        "error_code", "error", "missing_dependencies")
    kind = dict(flat.dtypes)["job_id"]
    key_type = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[kind]
    folds = flat.mapInArrow(fold_batches(key_type), f"job_id {kind}, newest long, {_FOLD}")
    out = (f"job_id {kind}, revision long, status string, created long, started long, finished long, filename string, error_code string, "
           "error string, missing_dependencies array<string>")
    grouped = folds.withColumn("_group", F.pmod(F.xxhash64("job_id"), F.lit(groups)).cast("int"))
    made = grouped.groupBy("_group").transformWithState(JobProcessor(limits, horizon_secs), out, "Update", "EventTime")
    return made.select(
        "job_id", "revision", "status", F.timestamp_micros("created").alias("created_at"), F.timestamp_micros("started").alias("started_at"),
        F.timestamp_micros("finished").alias("finished_at"), "filename", "error_code", "error", "missing_dependencies")


def latest(changes: DataFrame) -> DataFrame:
    """The greatest revision of each job; one row a map task and job is shuffled."""
    rest = [c for c in changes.columns if c != "job_id"]
    return changes.groupBy("job_id").agg(F.max_by(F.struct(*rest), "revision").alias("_row")).select("job_id", "_row.*")


def stream_live_ledger(events: DataFrame, out: str, checkpoint: str, limits: Limits, delay: str = "10 minutes", horizon_secs: int = 86_400,
                       compact_every: int = 50, once: bool = False, groups: int = GROUPS) -> StreamingQuery:
    """Start the stream.  ``out`` gets the folders ``changes``, ``commits`` and, from time to time, ``merged``."""
    changes = job_changes(events, limits, delay, horizon_secs, groups)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in changes.schema.fields)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        commit_batch(spark, {f"{out}/changes": batch}, f"{out}/commits", batch_id)
        if batch_id % compact_every == compact_every - 1:
            merged = latest(read_live(spark, out, schema))
            commit_batch(spark, {f"{out}/merged": merged}, f"{out}/merges", batch_id)

    writer = changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_live(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """The last merged table and the changes of finished batches behind it."""
    merges = finished_batches(spark, f"{out}/merges")
    upto = merges[-1] if merges else -1
    behind = [n for n in finished_batches(spark, f"{out}/commits") if n > upto]
    return read_batches(spark, f"{out}/merged", merges[-1:], schema).unionByName(read_batches(spark, f"{out}/changes", behind, schema))


def live_jobs(spark: SparkSession, out: str, job_type: str = "bigint") -> DataFrame:
    """The jobs as they stand; deadlines that the watermark has passed are in it."""
    return latest(read_live(spark, out, f"job_id {job_type}, revision bigint, {JOB}")).drop("revision")
