"""The stateful ledger: deadlines, late and repeated events, the horizon, batches killed half-way."""

from __future__ import annotations

import datetime as dt

import pytest

from leafmill.limits import Limits
from leafmill.streaming.commits import commit_batch, finished_batches, read_batches
from leafmill.streaming.live_ledger import live_jobs, stream_live_ledger

SCHEMA = "job_id long, event_id long, ts timestamp, type string, filename string"
T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


class Feed:
    """Events arrive batch by batch; each ``put`` runs the stream over what is new."""

    def __init__(self, spark, folder, **settings):
        self.spark, self.folder, self.n = spark, str(folder), 0
        self.settings = {"limits": Limits(timeout_secs=600), "delay": "1 minute", "horizon_secs": 3600, **settings}

    def put(self, *events):
        rows = [(job, i, at(s), kind, f"{job}.pdf" if kind == "submitted" else None) for job, i, s, kind in events]
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{self.folder}/in/{self.n}")
        self.n += 1
        arriving = self.spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{self.folder}/in")
        query = stream_live_ledger(arriving, f"{self.folder}/out", f"{self.folder}/checkpoint", once=True, **self.settings)
        query.awaitTermination()
        self.progress = query.recentProgress
        return {r.job_id: r for r in live_jobs(self.spark, f"{self.folder}/out").collect()}


def test_statuses_deadlines_late_and_repeated_events(spark, tmp_path):
    feed = Feed(spark, tmp_path, compact_every=3)
    jobs = feed.put((1, 1, 0, "submitted"), (2, 2, 0, "submitted"))
    assert {j: r.status for j, r in jobs.items()} == {1: "queued", 2: "queued"} and jobs[1].filename == "1.pdf"
    jobs = feed.put((1, 3, 10, "started"), (2, 4, 20, "started"), (3, 5, 30, "submitted"))
    assert {j: r.status for j, r in jobs.items()} == {1: "running", 2: "running", 3: "queued"}
    # Repeated, and a cancellation of a queued job that is then started.
    jobs = feed.put((1, 3, 10, "started"), (1, 1, 0, "submitted"), (2, 6, 100, "succeeded"), (3, 7, 110, "cancelled"), (3, 8, 120, "started"))
    assert {j: r.status for j, r in jobs.items()} == {1: "running", 2: "succeeded", 3: "cancelled"} and jobs[3].started_at is None
    # Nobody reads, nothing of job 1 arrives; others' events move the clock past its deadline at 610.
    jobs = feed.put((4, 9, 600, "submitted"))
    assert jobs[1].status == "running"
    jobs = feed.put((4, 10, 700, "started"))
    assert (jobs[1].status, jobs[1].error_code, jobs[1].finished_at) == ("failed", "timeout", at(610))
    # Its end comes late, from before the deadline and from behind it: the deadline has passed, so neither counts.
    jobs = feed.put((1, 11, 605, "succeeded"), (1, 12, 710, "succeeded"), (2, 13, 90, "failed"))
    assert (jobs[1].status, jobs[1].error_code) == ("failed", "timeout")
    # A late end that is earlier than the known one is the first end, as in the batch ledger.
    assert (jobs[2].status, jobs[2].finished_at) == ("failed", at(90))
    jobs = feed.put((4, 14, 1305, "succeeded"))  # behind its deadline of 1300, before the watermark gets there
    assert jobs[4].status == "succeeded"
    jobs = feed.put((5, 15, 1500, "submitted"))
    assert (jobs[4].status, jobs[4].error_code, jobs[4].finished_at) == ("failed", "timeout", at(1300))
    assert finished_batches(spark, f"{tmp_path}/out/merges")  # merged by the stream itself


def test_state_goes_behind_the_horizon(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.put((1, 1, 0, "submitted"), (1, 2, 5, "started"), (1, 3, 9, "succeeded"), (2, 4, 0, "submitted"))
    assert feed.progress[-1].stateOperators[0].numRowsTotal > 0
    jobs = feed.put((3, 5, 8000, "submitted"))
    before = jobs[1]
    # An old event finds no state and is refused; the row stays as it was.  Queued job 2 is still live.
    jobs = feed.put((1, 6, 2, "failed"), (1, 6, 2, "failed"), (2, 7, 8001, "started"))
    assert jobs[1] == before and jobs[2].status == "running" and jobs[2].created_at == at(0)


def test_a_batch_killed_between_two_tables_shows_in_neither(spark, tmp_path):
    a, b, commits = (f"{tmp_path}/{name}" for name in ("a", "b", "commits"))
    assert finished_batches(spark, commits) == []
    rows = spark.range(3)
    commit_batch(spark, {a: rows, b: rows}, commits, 0)

    class Killed(Exception):
        pass

    class Broken:
        @property
        def write(self):
            raise Killed

    with pytest.raises(Killed):
        commit_batch(spark, {a: rows, b: Broken()}, commits, 1)
    done = finished_batches(spark, commits)
    assert done == [0] and [read_batches(spark, t, done, "id long").count() for t in (a, b)] == [3, 3]
    commit_batch(spark, {a: spark.range(2), b: spark.range(2)}, commits, 1)
    done = finished_batches(spark, commits)
    assert [read_batches(spark, t, done, "id long").count() for t in (a, b)] == [5, 5]


def test_the_document_stream_keeps_its_ledger(spark, tmp_path, monkeypatch):
    from leafmill.streaming import documents as D

    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    source.mkdir()

    def run():
        D.stream_documents(spark, str(source), out, checkpoint, Limits(), [str(source)], once=True).awaitTermination()
        return {r.job_id.rsplit("/", 1)[1]: r for r in D.document_jobs(spark, out).collect()}

    (source / "a.md").write_text("# A")
    (source / "b.bin").write_bytes(b"x")
    jobs = run()
    assert (jobs["a.md"].status, jobs["a.md"].filename) == ("succeeded", "a.md") and jobs["a.md"].created_at <= jobs["a.md"].started_at <= jobs["a.md"].finished_at
    assert (jobs["b.bin"].status, jobs["b.bin"].error_code) == ("failed", "unsupported_format")
    # The next batch is killed between its outcomes and its ledger: neither shows, the job still runs.
    (source / "c.md").write_text("# C")
    commit = D.commit_batch

    def killed(session, tables, commits, batch_id):
        if commits.endswith("out-commits"):
            raise RuntimeError("killed")
        commit(session, tables, commits, batch_id)

    monkeypatch.setattr(D, "commit_batch", killed)
    with pytest.raises(Exception, match="killed"):
        run()
    assert {r.job_id.rsplit("/", 1)[1]: r.status for r in D.document_jobs(spark, out).collect()} == {"a.md": "succeeded", "b.bin": "failed", "c.md": "running"}
    assert D.poll(spark, out).count() == 2
    monkeypatch.setattr(D, "commit_batch", commit)
    assert run()["c.md"].status == "succeeded" and D.poll(spark, out).count() == 3


def test_jobs_share_state_rows_and_one_timer(spark, tmp_path):
    feed = Feed(spark, tmp_path, groups=2)
    feed.put(*[(n, n, n, "submitted") for n in range(40)], *[(n, 100 + n, 50 + n, "started") for n in range(30)])
    assert 0 < feed.progress[-1].stateOperators[0].numRowsTotal <= 16  # rows and timers of two groups, not of 40 jobs
    # The clock stands between the deadlines of jobs 14 and 15; job 3 ended before its own.
    feed.put((3, 200, 600, "succeeded"), (40, 201, 650 + 14 + 60, "submitted"))
    jobs = feed.put((41, 202, 650 + 14 + 60, "submitted"))
    assert {n for n, r in jobs.items() if r.status == "failed"} == set(range(15)) - {3}
    assert all(jobs[n].finished_at == at(650 + n) and jobs[n].error_code == "timeout" for n in range(15) if n != 3)
    assert jobs[3].status == "succeeded" and {jobs[n].status for n in range(15, 30)} == {"running"} and jobs[35].status == "queued"


def test_batches_of_documents_are_bounded_by_bytes(spark, tmp_path):
    from leafmill.streaming import documents as D

    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for n in range(5):
        (source / f"{n}.md").write_text("# 4567890")
    D.stream_documents(spark, str(source), out, str(tmp_path / "cp"), Limits(), [str(source)], once=True, bytes_per_batch=30, files_per_batch=1).awaitTermination()
    assert len(finished_batches(spark, f"{out}-commits")) == 2 and D.poll(spark, out).count() == 5
