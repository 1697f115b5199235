"""Converter hook, ledger, budget and skew."""

from __future__ import annotations

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from leafmill import Limits
from leafmill.functions import export
from leafmill.functions.options import normalise_options, option_key
from leafmill.operators import ledger as J
from leafmill.operators.assemble import apply_budget
from leafmill.operators.converter import MissingDependency, convert_once, convert_with
from leafmill.operators.skew import join_many_to_one
from leafmill.streaming.ledger import compact_ledger, current_ledger, stream_ledger


def test_converter_outcomes(spark):
    def factory(options):
        if options.get("ocr_engine") == "tesseract":
            raise MissingDependency("tesseract is not installed", ["tesseract"])
        if options.get("ocr"):
            raise ImportError("no such library")

        def convert(name, content):
            if name == "crash":
                raise ValueError("boom")
            if name == "odd":
                raise RuntimeError("No Pipeline for odd")
            if name == "none":
                return {"status": "FAILURE", "markdown": "x", "errors": list("abcdef")}
            return {
                "status": "PARTIAL_SUCCESS", "markdown": "m", "text": None, "errors": list("abcdef"), "pages": [],
                "elements": [{"id": "1", "category": "Text", "text": " \xa0"}, {"id": "2", "category": "Text", "text": "yyy", "pages": [4, 5], "level": 2},
                             {"id": "3", "text": "z"}],
            }

        return convert

    rows = [(n, n, b"x", "{}") for n in ("ok", "crash", "odd", "none")]
    rows += [("lib", "lib", b"x", '{"ocr":true}'), ("dep", "dep", b"x", '{"ocr_engine":"tesseract"}')]
    df = spark.createDataFrame(rows, "doc_id string, name string, content binary, option_key string")
    made = {r.doc_id: r for r in convert_with(df, factory, Limits(max_element_chars=2, max_elements=1), "doc_id").collect()}
    ok = made["ok"]
    assert ok.error is None and ok.text == "m" and ok.page_count is None
    assert ok.warnings == ["the conversion is partial: some pages or elements were skipped", *[f"converter: {e}" for e in "abcd"]]
    assert [(e.id, e.text, e.page_number, e.level) for e in ok.elements] == [("2", "yy", 4, 2)]
    codes = {k: r.error.error_code for k, r in made.items() if r.error}
    assert codes == {"crash": "parse_failed", "odd": "unsupported_format", "none": "parse_failed", "lib": "library_missing", "dep": "missing_dependency"}
    assert made["none"].error.error.endswith(": a; b; c; d") and made["dep"].error.missing_dependencies == ["tesseract"]
    assert "ValueError: boom" in made["crash"].error.error


def test_convert_once_runs_once_per_content(spark, tmp_path):
    rows = [(i, f"text {i % 7 if i % 3 else 0}".encode(), ".txt", "{}") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, content binary, suffix string, option_key string")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def costly(content):
        seen.add(1)
        return bytes(content).decode().upper()

    made = convert_once(df, lambda d: d.withColumn("out", costly("content")).drop("content"), "doc_id").collect()
    assert {r.doc_id: r.out for r in made} == {i: c.decode().upper() for i, c, _, _ in rows} and len(made) == 500
    assert seen.value <= 7


def test_hot_keys_join_whole(spark):
    rng = random.Random(1)
    keys = ["hot"] * 3000 + [f"k{rng.randrange(400)}" for _ in range(2000)]
    rows = spark.createDataFrame(list(enumerate(keys)), "id long, k string")
    ones = rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.upper("k"))
    joined = join_many_to_one(rows, ones.drop("n"), ["k"], ones, "n", "id")
    assert sorted(joined.columns) == ["id", "k", "v"]
    got = joined.collect()
    assert {r.id: r.v for r in got} == {i: k.upper() for i, k in enumerate(keys)} and len(got) == len(keys)


def test_hot_keys_are_spread(spark):
    """Without the broadcasts that a small input allows."""
    rows = spark.createDataFrame([(i, "hot") for i in range(3000)] + [(i, f"k{i}") for i in range(3000, 3400)], "id long, k string")
    ones = rows.groupBy("k").agg(F.count("*").alias("n"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = join_many_to_one(rows, ones.drop("n"), ["k"], ones, "n", "id")
        parts = joined.filter(F.col("k") == "hot").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(r["count"] for r in parts) == 3000 and max(r["count"] for r in parts) < 1500


def test_the_hook_runs_once_per_content(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()
    where = str(log)

    def factory(options):
        import uuid

        def convert(name, content):
            open(f"{where}/{uuid.uuid4().hex}", "w").close()
            return {"status": "SUCCESS", "markdown": content.decode().upper()}

        return convert

    rows = [(i, "x", f"text {i % 5}".encode(), ".pdf", "{}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, name string, content binary, suffix string, option_key string")
    kept = ["content_sha", "suffix", "option_key", "copies"]
    made = convert_once(df, lambda d: convert_with(d, factory, Limits(), *kept, "doc_id", tag="count"), "doc_id").collect()
    assert {r.doc_id: r.markdown for r in made} == {i: f"TEXT {i % 5}" for i in range(60)}
    assert len(list(log.iterdir())) == 5


def test_options(values):
    bags = ['{"ocr": true, "ocr_engine": "EasyOCR", "ocr_languages": ["en", "", "de"], "table_structure": false}',
            '{"ocr": "true", "ocr_engine": "other", "ocr_languages": ["en", 1], "table_structure": 0}', '{"ocr_languages": []}',
            '{"ocr_languages": [null]}', '{"ocr_languages": "en", "ocr": null}', "{}"]
    keys = values(lambda x: option_key(normalise_options(F.parse_json(x))), bags)
    assert [json.loads(k) for k in keys] == [
        {"ocr": True, "ocr_engine": "easyocr", "ocr_languages": ["en", "de"], "table_structure": False}, {}, {"ocr_languages": []}, {}, {}, {}]
    assert keys[0] == json.dumps(json.loads(keys[0]), sort_keys=True, separators=(",", ":"))


ELEMENTS = "array<struct<id:string,category:string,text:string,page_number:int,level:int,source:string>>"


def as_json(e, with_source):
    record = dict(zip(("id", "category", "text", "page_number", "level", "source"), e))
    if not with_source or e[5] is None:
        del record["source"]
    return len(json.dumps(record)) + 1


def test_element_sizes_and_prefix(spark):
    rng = random.Random(4)
    texts = ["", "plain", "é\"\\", "😀\n\x00", "日本" * 9]
    lists = [[(f"#/{i}", "Text", rng.choice(texts), rng.choice([None, 7, 123]), rng.choice([None, 1]), rng.choice([None, "a/é.md"]))
              for i in range(rng.randrange(9))] for _ in range(60)]
    df = spark.createDataFrame([(i, x, rng.randrange(-5, 900)) for i, x in enumerate(lists)], f"i int, e {ELEMENTS}, b int")
    for row in df.select("i", "b", export.fitting_elements(F.col("e"), F.col("b"), True).alias("kept"),
                         F.transform("e", lambda e: export.element_bytes(e, True)).alias("sizes")).collect():
        sizes = [as_json(e, True) for e in lists[row.i]]
        assert row.sizes == sizes
        assert row.kept == sum(sum(sizes[: k + 1]) <= row.b for k in range(len(sizes)))


def test_one_budget_for_all_three(spark):
    budget = 1 << 20
    rows = [("over", "x" * (budget + 1024), "y" * 5000, 1), ("fat", "", "", 64)]
    record = "struct<id:string,category:string,text:string,page_number:int,level:int>"
    df = spark.createDataFrame(rows, "k string, markdown string, text string, n int").withColumn(
        "elements", F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.struct(
            i.cast("string").alias("id"), F.lit("").alias("category"), F.repeat(F.lit("z"), F.lit(512)).alias("text"),
            F.lit(None).cast("int").alias("page_number"), F.lit(None).cast("int").alias("level")).cast(record)))
    over = apply_budget(df.filter("k = 'over'"), Limits(max_output_bytes=budget)).first()
    assert len(over.markdown) == budget and over.text == "" and over.elements == [] and over.truncated
    fat = apply_budget(df.filter("k = 'fat'"), Limits(max_output_bytes=4096)).first()
    assert 0 < len(fat.elements) < 64 and fat.truncated
    whole = apply_budget(df.filter("k = 'fat'"), Limits()).first()
    assert len(whole.elements) == 64 and not whole.truncated
    free = apply_budget(df, Limits()).collect()
    assert [len(r.markdown) for r in free] == [budget + 1024, 0] and not any(r.truncated for r in free)


def test_element_caps_are_counted_and_are_no_truncation(spark):
    df = spark.range(1).select(F.lit("m").alias("markdown"), F.lit("t").alias("text"), F.array(F.struct(
        F.lit("1").alias("id"), F.lit("Text").alias("category"), F.lit("abc").alias("text"),
        F.lit(None).cast("int").alias("page_number"), F.lit(None).cast("int").alias("level"))).alias("elements"))
    for limits, shown, cuts in ((Limits(max_elements=0), 0, (1, 0)), (Limits(max_element_chars=1), 1, (0, 1)), (Limits(), 1, (0, 0))):
        cut = df.withColumn("cuts", export.echo_cuts(F.col("elements"), limits))
        row = apply_budget(cut.withColumn("elements", export.echo_elements(F.col("elements"), limits)), limits).first()
        assert row.truncated is False and len(row.elements) == shown and tuple(row.cuts) == cuts


T0 = dt.datetime(2024, 1, 1)


def events(spark, jobs):
    rows = [(job, i, T0 + dt.timedelta(seconds=at), kind) for job, history in jobs.items() for i, (at, kind) in enumerate(history)]
    return spark.createDataFrame(rows, "job_id string, event_id long, ts timestamp_ntz, type string")


HISTORIES = {
    "queued": [(0, "submitted")], "running": [(1, "submitted"), (2, "started")],
    "done": [(2, "submitted"), (3, "started"), (4, "succeeded"), (5, "cancelled")],
    "stopped": [(3, "submitted"), (4, "cancelled"), (5, "started"), (6, "succeeded")],
    "late": [(4, "submitted"), (5, "started"), (700, "succeeded")], "tie": [(5, "submitted"), (6, "failed"), (6, "succeeded")],
    "just": [(6, "submitted"), (7, "started"), (607, "failed")],
}
STATUS = {"queued": "queued", "running": "running", "done": "succeeded", "stopped": "cancelled", "late": "succeeded", "tie": "failed", "just": "failed"}


def test_ledger_fold_and_deadlines(spark):
    jobs = J.job_snapshot(events(spark, HISTORIES))
    rows = {r.job_id: r for r in jobs.collect()}
    assert {k: r.status for k, r in rows.items()} == STATUS
    assert rows["stopped"].started_at is None and rows["stopped"].finished_at == T0 + dt.timedelta(seconds=4)
    now = F.lit(T0 + dt.timedelta(seconds=1000)).cast("timestamp_ntz")
    timed = {r.job_id: r for r in J.mark_timeouts(jobs, now, Limits()).collect()}
    assert {k for k, r in timed.items() if r.error_code == "timeout"} == {"running", "late"}
    assert timed["late"].status == "failed" and timed["late"].finished_at == T0 + dt.timedelta(seconds=605)
    early = F.lit(T0 + dt.timedelta(seconds=601)).cast("timestamp_ntz")
    assert {r.job_id for r in J.mark_timeouts(jobs, early, Limits()).collect() if r.error_code} == set()
    assert [r.job_id for r in J.list_jobs(jobs.withColumn("result", F.lit("x"))).collect()] == list(HISTORIES)
    assert "result" not in J.list_jobs(jobs.withColumn("result", F.lit("x"))).columns
    assert J.get_job(jobs, "nothing").count() == 0 and J.get_job(jobs, "done").count() == 1


def test_retention_never_drops_live_jobs(spark):
    def kept(live, finished, limit):
        jobs = {f"l{i:03d}": [(2 * i, "submitted")] for i in range(live)}
        jobs |= {f"t{i:03d}": [(2 * i + 1, "submitted"), (9999, "succeeded")] for i in range(finished)}
        return {r.job_id for r in J.retain_jobs(J.job_snapshot(events(spark, jobs)), Limits(max_jobs=limit)).collect()}

    assert kept(66, 4, 64) == {f"l{i:03d}" for i in range(66)}
    assert kept(60, 10, 64) == {f"l{i:03d}" for i in range(60)} | {f"t{i:03d}" for i in range(6, 10)}
    assert len(kept(3, 4, 64)) == 7


def test_ledger_stream_ends_as_the_batch_does(spark, tmp_path):
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    all_events = events(spark, HISTORIES)
    # The last events come first.
    for part in range(3):
        all_events.filter(F.pmod("event_id", F.lit(3)) == 2 - part).coalesce(1).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(all_events.schema).option("maxFilesPerTrigger", 1).parquet(source)
        stream_ledger(arriving, out, checkpoint, once=True).awaitTermination()
    key = lambda r: r.job_id
    assert sorted(current_ledger(spark, out).collect(), key=key) == sorted(J.job_snapshot(all_events).collect(), key=key)
    before = sorted(current_ledger(spark, out).collect(), key=key)
    for upto in (0, 1):
        compact_ledger(spark, out, upto)
        assert sorted(current_ledger(spark, out).collect(), key=key) == before


def test_convert_once_gives_back_rows_without_a_key(spark):
    from leafmill.operators.converter import convert_once

    rows = [(1, b"a", ".t", "{}"), (2, b"a", ".t", "{}"), (3, None, ".t", "{}"), (4, b"a", None, None), (5, None, None, None), (6, b"a", None, None)]
    df = spark.createDataFrame(rows, "id int, content binary, suffix string, option_key string")
    made = convert_once(df, lambda d: d.select("id", "content_sha", "suffix", "option_key", "copies", F.length("content").alias("n")), "id").collect()
    assert sorted((r.id, r.copies, r.n, r.suffix) for r in made) == sorted(
        [(1, 2, 1, ".t"), (2, 2, 1, ".t"), (3, 1, None, ".t"), (4, 2, 1, None), (5, 1, None, None), (6, 2, 1, None)])


def test_members_behind_the_budget_are_not_gathered(spark):
    from leafmill import Limits
    from leafmill.operators.archives import merge_archive, within_budget

    element = "array<struct<id:string,category:string,text:string,page_number:int,level:int>>"
    rows = spark.range(200).select(
        F.lit("a").alias("archive_id"), F.col("id").cast("int").alias("ordinal"), F.format_string("m%03d", "id").alias("name"),
        F.repeat(F.lit("x"), F.lit(50_000)).alias("markdown"), F.repeat(F.lit("y"), F.lit(50_000)).alias("text"),
        F.array_repeat(F.struct(F.lit("1").alias("id"), F.lit("Text").alias("category"), F.lit("z").alias("text"),
                                F.lit(None).cast("int").alias("page_number"), F.lit(None).cast("int").alias("level")), 100).cast(element).alias("elements"),
        F.array().cast("array<string>").alias("warnings"), F.lit(1).alias("page_count"), F.lit(None).cast("string").alias("error"),
    )
    limits = Limits(max_output_bytes=120_000)
    kept = within_budget(rows.withColumn("blank", F.lit(False)), limits)
    size = kept.agg(F.sum(F.length("markdown")), F.sum(F.length("text")), F.sum(F.size("elements"))).first()
    assert tuple(size) == (150_000, 150_000, 2100)
    merged = merge_archive(rows, limits).first()
    assert len(merged.sources) == 200 and merged.page_count == 200
    free, bound = (apply_budget(merge_archive(rows, l), limits).first() for l in (Limits(), limits))
    assert (free.markdown, free.text, free.elements, free.truncated) == (bound.markdown, bound.text, bound.elements, True)
