"""The corpus job over real files, archives and requests."""

from __future__ import annotations

import base64
import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from leafmill import Limits
from leafmill.operators.archives import archive_verdict
from leafmill.plans.corpus import admit, outcomes, run_corpus
from leafmill.sources.archives import explode_archives
from leafmill.sources.files import load_requests, parse_requests, scan_documents
from leafmill.streaming.documents import poll, stream_documents


def zipped(*members, **modes):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, content in members:
            info = zipfile.ZipInfo(name)
            info.external_attr = modes.get(name, 0) << 16
            archive.writestr(info, content)
    return out.getvalue()


def tarred(*members, mode="w"):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as archive:
        for name, kind, content in members:
            info = tarfile.TarInfo(name)
            info.type, info.size = kind, len(content)
            info.linkname = "target"
            archive.addfile(info, io.BytesIO(content))
    return out.getvalue()


REG, DIR, SYM, LNK, FIFO = tarfile.REGTYPE, tarfile.DIRTYPE, tarfile.SYMTYPE, tarfile.LNKTYPE, tarfile.FIFOTYPE


@pytest.fixture
def run(spark, tmp_path):
    """Write requests and files, run the job, give outcomes by request id."""
    root = tmp_path / "root"
    root.mkdir()

    def go(requests, files=(), limits=Limits(), **hook):
        for name, content in dict(files).items():
            (root / name).write_bytes(content)
        listed = tmp_path / "requests.json"
        listed.write_text("\n".join(
            json.dumps({"request_id": key, **{k: v if isinstance(v, str) else json.dumps(v) for k, v in request.items()}})
            for key, request in requests.items()
        ))
        documents = admit(load_requests(spark, str(listed)), scan_documents(spark, str(root)), limits, [str(root)], resolve_links=True)
        return {row.request_id: row for row in outcomes(documents, limits, **hook).collect()}

    go.root = root
    return go


def test_requests_of_every_kind(run):
    root = run.root
    outside = root.parent / "beside.txt"
    outside.write_text("hidden text")
    (root / "link.txt").symlink_to(outside)
    hello = b"# Field notes\n\nRain and mud.\n\n| Site | Depth |\n| --- | --- |\n| North | 4 |\n"
    coded = base64.b64encode(b"# inline\n\nbody text\n").decode()
    made = run(
        {
            "ok": {"path": f"{root}/notes.md"}, "outside": {"path": str(outside)}, "dots": {"path": f"{root}/../beside.txt"},
            "link": {"path": f"{root}/link.txt"}, "missing": {"path": f"{root}/nothing.md"}, "neither": {}, "blank": {"path": "", "content_base64": ""},
            "both": {"path": f"{root}/notes.md", "content_base64": "eA=="}, "inline": {"content_base64": coded, "filename": "note.md"},
            "hints": {"content_base64": coded, "filename": "n.md", "options": {"speed": "slow", "unknown": 7, "ocr_engine": "Tesseract"}},
            "junk": {"content_base64": "e A==", "filename": "n.md"}, "pdf": {"content_base64": coded, "filename": "x.PDF"},
            "packed": {"content_base64": coded, "filename": "x.tar.gz"},
        },
        {"notes.md": hello},
    )
    result = made["ok"].result
    assert "Rain and mud." in result.markdown and result.truncated is False and result.metadata.filename == "notes.md"
    assert [e.category for e in result.elements] == ["Title", "Text", "Table"] and result.metadata.element_count == 3
    for key in ("outside", "dots", "link", "missing", "junk"):
        assert made[key].error.error_code == "input_rejected" and made[key].result is None, key
    for key in ("neither", "blank", "both"):
        assert made[key].error.error_code is None and "exactly one" in made[key].error.error
    assert made["inline"].result.markdown == "# inline\n\nbody text" and made["inline"].result.metadata.filename == "note.md"
    assert made["hints"].result.warnings == ["ocr_engine ignored: no OCR engine takes part in this conversion"]
    assert made["pdf"].error.error_code == "unsupported_format" and ".pdf" in made["pdf"].error.error
    # An inline archive with a double suffix is known by the last one only.
    assert made["packed"].error.error_code == "unsupported_format" and "`.gz`" in made["packed"].error.error


def test_size_gate(run, spark):
    made = run({"big": {"path": f"{run.root}/big.txt"}, "inline": {"content_base64": base64.b64encode(b"x" * 11).decode()}},
               {"big.txt": b"x" * 11}, Limits(max_input_bytes=10))
    assert made["big"].error.error == "input has 11 bytes, more than the 10 allowed"
    assert made["inline"].error.error == "inline input has 11 bytes, more than the 10 allowed"


def test_archive_merge_isolates_orders_and_drops(run):
    archive = zipped(("a-b/x.md", "# X\n"), ("a/b.txt", "hello"), ("q.pdf", "x"), ("blank.txt", "  \n"), ("d/", ""), ("in.zip", zipped(("z.txt", "z"))),
                     ("a/b.txt", "second"))
    made = run({"a": {"path": f"{run.root}/a.zip"}, "none": {"path": f"{run.root}/none.zip"}, "fails": {"path": f"{run.root}/fails.tgz"}},
               {"a.zip": archive, "none.zip": zipped(), "fails.tgz": tarred(("x.pdf", REG, b"x"), mode="w:gz")})
    result = made["a"].result
    assert result.markdown == "# a/b.txt\n\nsecond\n\n# a-b/x.md\n\n# X"
    assert result.text == "a/b.txt\n\nsecond\n\na-b/x.md\n\nX"
    assert result.metadata.sources == ["a/b.txt", "a-b/x.md"]
    assert [e.source for e in result.elements] == ["a/b.txt", "a-b/x.md"]
    assert result.warnings == ["in.zip: no conversion is available for `.zip`", "q.pdf: no conversion is available for `.pdf`"]
    assert made["none"].error is None and made["none"].result.markdown == ""
    # All members fail, the archive still succeeds, empty.
    assert made["fails"].error is None and made["fails"].result.warnings == ["x.pdf: no conversion is available for `.pdf`"]


def test_archive_refusals(spark):
    cases = {
        "upward.zip": (zipped(("../upward.txt", "left behind")), "parent-directory"),
        "rooted.zip": (zipped(("/rooted/x", "left behind")), "absolute"),
        "link.zip": (zipped(("ok", "x"), ("l", "t"), l=0o120777), "`l` is a symlink"),
        "fifo.zip": (zipped(("f", ""), f=0o010644), "no regular file"),
        "link.tar": (tarred(("l", SYM, b"")), "`l` is a link"),
        "hard.tar": (tarred(("a", REG, b"x"), ("l", LNK, b"")), "`l` is a link"),
        "fifo.tgz": (tarred(("f", FIFO, b""), mode="w:gz"), "no regular file"),
        "many.zip": (zipped(*[(f"{i}", "") for i in range(4)], ("../late", "")), "archive holds 5 members, 3 are allowed"),
        "many.tar": (tarred(*[(f"{i}", REG, b"") for i in range(4)]), "archive holds more than 3 members"),
        # While a tar is walked, a bad member before the bound comes first; a zip tells its total first.
        "early.tar": (tarred(("../e", REG, b""), *[(f"{i}", REG, b"") for i in range(4)]), "parent-directory"),
        "dirs.tar": (tarred(*[(f"d{i}", DIR, b"") for i in range(4)]), "more than 3 members"),
        "bytes.zip": (zipped(("a", "x" * 30), ("b", "x" * 30)), "beyond the 50-byte limit"),
        "bytes.txz": (tarred(("a", REG, b"x" * 30), ("b", REG, b"x" * 30), mode="w:xz"), "beyond the 50-byte limit"),
        "no.zip": (b"not an archive", "cannot be read as a zip or tar archive"),
        "good.tbz2": (tarred(("d", DIR, b""), ("d/a", REG, b"x"), mode="w:bz2"), None),
        "good.zip": (zipped(("a", "x"), ("d/", "")), None),
    }
    broken = bytearray(zipped(("a", "hello hello")))
    broken[35] ^= 0xFF
    rows = [(name, name, bytes(content), "{}") for name, (content, _) in cases.items()] + [("bad.zip", "bad.zip", bytes(broken), "{}")]
    limits = Limits(max_archive_members=3, max_archive_bytes=50)
    archives = spark.createDataFrame(rows, "archive_id string, filename string, content binary, option_key string")
    found = {r.archive_id: r for r in archive_verdict(explode_archives(archives, limits), limits).collect()}
    for name, (_, reason) in cases.items():
        assert (found[name].error is None) if reason is None else (reason in found[name].error), (name, found[name])
        assert found[name].error_code == (None if reason is None else "input_rejected"), name
    assert found["bad.zip"].error_code == "parse_failed" and "BadZipFile" in found["bad.zip"].error


def test_the_budget_reaches_archives(run):
    made = run({"a": {"path": f"{run.root}/a.zip"}}, {"a.zip": zipped(("a.txt", "é" * 50), ("b.txt", "x" * 50))}, Limits(max_output_bytes=64))
    result = made["a"].result
    # Nine bytes of heading and 27 letters of two bytes leave one byte of 64 for the text.
    assert result.markdown == "# a.txt\n\n" + "é" * 27 and result.text == "a" and result.elements == [] and result.truncated


def test_sinks_lose_nothing(spark, tmp_path):
    rows = [("1", None, "eA==", "x.txt", None), ("2", None, "@@", "x.txt", None), ("3", None, None, None, None), ("4", None, "eA==", "x.pdf", None)]

    requests = parse_requests(spark.createDataFrame(rows, "request_id string, path string, content_base64 string, filename string, options string"))
    files = spark.createDataFrame([], "path string, length bigint, content binary")
    results, errors = str(tmp_path / "r"), str(tmp_path / "e")
    run_corpus(requests, files, Limits(), [], results, errors, "2024-01-01")
    assert [r.request_id for r in spark.read.parquet(results).collect()] == ["1"]
    kept = {r.request_id: r.error_code for r in spark.read.parquet(errors).collect()}
    assert kept == {"2": "input_rejected", "3": None, "4": "unsupported_format"}


def test_stream_takes_files_as_they_come(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    source.mkdir()
    for wave in range(2):
        for i in range(3):
            (source / f"{wave}-{i}.md").write_text(f"# Doc {wave}{i}")
        (source / f"{wave}.bin").write_bytes(b"x")
        stream_documents(spark, str(source), out, checkpoint, Limits(), [str(source)], files_per_batch=2, once=True).awaitTermination()
    rows = poll(spark, out).collect()
    assert len(rows) == 8 and len({r.request_id for r in rows}) == 8
    assert sorted(r.result.markdown for r in rows if r.result) == [f"# Doc {w}{i}" for w in range(2) for i in range(3)]
    assert {r.error.error_code for r in rows if r.error} == {"unsupported_format"}


def test_scan_filters_by_size_before_reading(spark, tmp_path):
    (tmp_path / "a.txt").write_text("abc")
    from leafmill.operators.admission import size_gate

    plan = size_gate(scan_documents(spark, str(tmp_path)), Limits()).select("path", "content")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(length), LessThanOrEqual(length,209715200)]" in plan
    assert scan_documents(spark, str(tmp_path), "*.md").count() == 0


def test_member_hook_converts_inside_archives(run):
    def factory(options):
        return lambda name, content: {"status": "SUCCESS", "markdown": f"M {content.decode()}", "text": "", "pages": [1, 2]}

    made = run({"a": {"path": f"{run.root}/a.zip"}, "p": {"path": f"{run.root}/p.pdf"}}, {"a.zip": zipped(("x.pdf", "1"), ("y.txt", "t")), "p.pdf": b"2"},
               factory=factory, families=["pdf"], tag="t")
    assert made["a"].result.markdown == "# x.pdf\n\nM 1\n\n# y.txt\n\nt" and made["a"].result.metadata.page_count == 2
    assert made["p"].result.markdown == "M 2" and made["p"].result.text == "M 2"


def test_a_default_job_keeps_every_element(run):
    made = run({"long": {"path": f"{run.root}/long.txt"}}, {"long.txt": "\n\n".join(f"block {i} " + "x" * (3000 if i == 7 else 1) for i in range(5000)).encode()})
    result = made["long"].result
    assert len(result.elements) == 5000 and max(len(e.text) for e in result.elements) > 3000
    assert tuple(result.metadata.cuts) == (0, 0)


def test_only_requested_files_are_opened_and_no_content_is_moved(spark, tmp_path):
    """An unreadable file that nobody asked for is never opened; one that was asked for has a typed error."""
    (tmp_path / "a.md").write_text("# A")
    (tmp_path / "gone.md").write_text("# B")
    files = scan_documents(spark, str(tmp_path)).select("path", "length")
    listed = spark.createDataFrame(files.collect(), files.schema)
    (tmp_path / "gone.md").unlink()
    rows = [(k, f"{tmp_path}/{k}.md", None, None, None) for k in ("a", "gone")]
    requests = parse_requests(spark.createDataFrame(rows, "request_id string, path string, content_base64 string, filename string, options string"))
    documents = admit(requests, listed, Limits(), [str(tmp_path)])
    made = {r.request_id: r for r in documents.collect()}
    assert bytes(made["a"].content) == b"# A" and "cannot open" in made["gone"].error.error
    wide = admit(requests, scan_documents(spark, str(tmp_path)), Limits(), [str(tmp_path)])
    for line in wide._jdf.queryExecution().executedPlan().toString().split("\n"):
        if "binaryFile" in line:
            assert "content" not in line


def test_run_corpus_refuses_links_out_of_the_roots(spark, tmp_path):
    root, aside = tmp_path / "root", tmp_path / "aside"
    root.mkdir()
    aside.mkdir()
    (aside / "hidden.txt").write_text("private words")
    (root / "own.txt").write_text("own words")
    (root / "out.txt").symlink_to(aside / "hidden.txt")
    (root / "in.txt").symlink_to(root / "own.txt")
    rows = [(k, f"{root}/{k}.txt", None, None, None) for k in ("own", "out", "in")]
    requests = parse_requests(spark.createDataFrame(rows, "request_id string, path string, content_base64 string, filename string, options string"))
    results, errors = str(tmp_path / "r"), str(tmp_path / "e")
    for _ in range(2):  # a date that runs again replaces its rows
        run_corpus(requests, scan_documents(spark, str(root)), Limits(), [str(root)], results, errors, "2024-01-01")
    assert sorted(r.request_id for r in spark.read.parquet(results).collect()) == ["in", "own"]
    assert [r.request_id for r in spark.read.parquet(errors).collect()] == ["out"]
    out, checkpoint = str(tmp_path / "s"), str(tmp_path / "c")
    stream_documents(spark, str(root), out, checkpoint, Limits(), [str(root)], once=True).awaitTermination()
    taken = {r.request_id.rsplit("/", 1)[1]: r for r in poll(spark, out).collect()}
    assert "private" not in str(taken) and taken["own.txt"].result.markdown == "own words" and taken["out.txt"].error is not None


def test_linked_roots_and_links_out_of_the_listing(spark, tmp_path):
    """A root that is a link takes what lies beneath it by either name; a link may lead to an allowed file that was not listed."""
    real, other = tmp_path / "real" / "docs", tmp_path / "other"
    real.mkdir(parents=True)
    other.mkdir()
    (real / "a.txt").write_text("alpha")
    (other / "b.txt").write_text("beta")
    (real / "b.txt").symlink_to(other / "b.txt")
    (tmp_path / "link").symlink_to(tmp_path / "real")
    root = tmp_path / "link" / "docs"
    paths = {"named": root / "a.txt", "really": real / "a.txt", "out": root / "b.txt", "gone": root / "no.txt", "folder": root, "aside": tmp_path / "x.txt"}
    rows = [(k, str(p), None, None, None) for k, p in paths.items()]
    requests = parse_requests(spark.createDataFrame(rows, "request_id string, path string, content_base64 string, filename string, options string"))
    documents = admit(requests, scan_documents(spark, str(root)), Limits(), [str(root), str(other)])
    made = {r.request_id: r for r in documents.collect()}
    assert {k: bytes(made[k].content) for k in ("named", "really", "out")} == {"named": b"alpha", "really": b"alpha", "out": b"beta"}
    assert all("cannot open" in made[k].error.error for k in ("gone", "folder")) and "outside" in made["aside"].error.error
    out, checkpoint = str(tmp_path / "s"), str(tmp_path / "c")
    stream_documents(spark, str(root), out, checkpoint, Limits(), [str(root), str(other)], once=True).awaitTermination()
    assert sorted(r.result.markdown for r in poll(spark, out).collect()) == ["alpha", "beta"]


def test_member_portions_are_bounded_by_count_and_bytes():
    from leafmill.sources.archives import portions

    empty = [(i, b"", None) for i in range(10_000)]
    parts = list(portions(iter(empty)))
    assert [row for part in parts for row in part] == empty and max(map(len, parts)) <= 4096
    heavy = [(i, bytes(10), None) for i in range(7)] + [(7, None, "unread")]
    assert [len(part) for part in portions(iter(heavy), most_bytes=30)] == [3, 3, 2]


def test_outcomes_of_repeat_contents_move_once_to_their_rows(spark, monkeypatch):
    """The rows that wait for an outcome have their names with them, so outcomes are not moved by a second join."""
    from leafmill.catalog.converter import line_converter
    from leafmill.operators import converter

    seen = []

    def join(rows, *others, real=converter.join_many_to_one):
        seen.append(set(rows.columns))
        return real(rows, *others)

    monkeypatch.setattr(converter, "join_many_to_one", join)
    rows = [("r1", "a.pdf", b"one"), ("r2", "b.pdf", b"one"), ("r3", "c.pdf", b"two"), ("r4", "d.txt", b"three")]
    documents = spark.createDataFrame(rows, "request_id string, filename string, content binary").select(
        "request_id", "filename", F.regexp_extract("filename", r"\..*", 0).alias("suffix"), "content", F.lit("{}").alias("option_key"),
        F.lit(None).cast("struct<error_code:string,error:string,missing_dependencies:array<string>>").alias("error"))
    made = outcomes(documents, Limits(), factory=line_converter, families=["pdf"], tag="lines", once=True)
    got = {r.request_id: (r.filename, r.markdown) for r in made.select("request_id", "result.metadata.filename", "result.markdown").collect()}
    assert {k: v[0] for k, v in got.items()} == {"r1": "a.pdf", "r2": "b.pdf", "r3": "c.pdf", "r4": "d.txt"}
    assert "one" in got["r1"][1] and "one" in got["r2"][1] and "two" in got["r3"][1] and got["r4"][1] == "three"
    assert seen and all({"request_id", "name"} <= columns or "archive_id" in columns for columns in seen)
