"""Contents are converted once, over runs and inside archives."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import functions as F

from leafmill.limits import Limits
from leafmill.operators.content_store import known_outcomes, of_contents, open_store
from leafmill.plans.corpus import outcomes, run_corpus
from leafmill.session import through_table
from leafmill.sources.files import parse_requests

DOCUMENT = "request_id string, filename string, suffix string, content binary, option_key string"


def zipped(*members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, content in members:
            archive.writestr(name, content)
    return out.getvalue()


def test_later_runs_convert_only_what_is_new(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    noted = str(calls)

    def factory(options):
        def convert(name, content):
            import os
            import uuid

            open(os.path.join(noted, f"{content.decode()}-{uuid.uuid4().hex}"), "w").close()
            if content == b"bad":
                raise ValueError("not a document")
            return {"status": "SUCCESS", "markdown": f"M {content.decode()}", "text": "", "pages": [1]}

        return convert

    def run(rows):
        for note in calls.iterdir():
            note.unlink()
        df = spark.createDataFrame(rows, DOCUMENT).withColumn(
            "error", F.lit(None).cast("struct<error_code:string,error:string,missing_dependencies:array<string>>"))
        made = outcomes(df, Limits(), factory=factory, families=["pdf"], tag="store", store=str(tmp_path / "store")).collect()
        return {r.request_id: r.result.markdown if r.error is None else r.error.error_code for r in made}, sorted(n.name.split("-")[0] for n in calls.iterdir())

    def plain(i, text, options="{}"):
        return (i, f"{i}.pdf", ".pdf", text, options)

    first = [plain("a", b"one"), plain("b", b"one"), plain("c", b"two"), plain("d", b"bad"), plain("e", b"one", '{"ocr":true}'),
             ("z", "z.zip", ".zip", zipped(("x.pdf", "one"), ("y.pdf", "three"), ("t.txt", "text")), "{}")]
    made, called = run(first)
    assert made == {"a": "M one", "b": "M one", "c": "M two", "d": "parse_failed", "e": "M one", "z": "# t.txt\n\ntext\n\n# x.pdf\n\nM one\n\n# y.pdf\n\nM three"}
    # Plain documents and members are converted in two steps of one plan, of which the second finds the first's contents.
    assert sorted(set(called)) == ["bad", "one", "three", "two"] and len(called) <= 6
    again, called = run(first)
    assert again == made and called == []
    more, called = run([*first, plain("f", b"four"), ("w", "w.zip", ".zip", zipped(("q.pdf", "two"), ("r.pdf", "five")), "{}")])
    assert more == made | {"f": "M four", "w": "# q.pdf\n\nM two\n\n# r.pdf\n\nM five"} and called == ["five", "four"]
    # Rows that two runs wrote at the same time count once, and the store is not shuffled to be read.
    name = open_store(spark, str(tmp_path / "store"), spark.range(0).schema)
    whole = spark.table(name).count()
    through_table(spark.table(name), "twice").write.mode("append").insertInto(name)
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 2 * whole and known_outcomes(spark, name).count() == whole
    again, called = run(first)
    assert again == made and called == []
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    wanted = spark.range(9).select(F.col("id").cast("string").alias("content_sha"))
    plan = of_contents(known_outcomes(spark, name), wanted)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1, plan


def test_a_run_tells_the_ledger(spark, tmp_path):
    from leafmill.operators.ledger import job_snapshot

    rows = [("1", None, "eA==", "x.txt", None), ("2", None, "@@", "x.txt", None)]
    requests = parse_requests(spark.createDataFrame(rows, "request_id string, path string, content_base64 string, filename string, options string"))
    files = spark.createDataFrame([], "path string, length bigint, content binary")
    for _ in range(2):
        run_corpus(requests, files, Limits(), [], str(tmp_path / "r"), str(tmp_path / "e"), "2024-01-01", events_path=str(tmp_path / "v"))
    jobs = {r.job_id: (r.status, r.error_code) for r in job_snapshot(spark.read.parquet(str(tmp_path / "v"))).collect()}
    assert jobs == {"1": ("succeeded", None), "2": ("failed", "input_rejected")} and spark.read.parquet(str(tmp_path / "v")).count() == 2
