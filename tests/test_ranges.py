"""Archives read by ranges: same members as whole archives, and only the ranges that are asked for."""

from __future__ import annotations

import io
import os
import random
import tarfile
import zipfile

import pytest

from leafmill.limits import Limits
from leafmill.operators.archives import archive_verdict, judge_members, merge_archive, merge_parts
from leafmill.sources import ranges, stores
from leafmill.sources.archives import explode_archives

SCHEMA = "archive_id string, filename string, location string, content binary"


def packed(rng, kind):
    out = io.BytesIO()
    members = [(f"d{rng.randint(0, 3)}/m{i}", rng.randbytes(rng.randint(0, 5000)) + b"x" * rng.randint(0, 70000)) for i in range(rng.randint(0, 12))]
    if kind.startswith("zip"):
        with zipfile.ZipFile(out, "w", {"zip": 0, "zip8": 8, "zip12": 12, "zip14": 14}[kind]) as archive:
            for name, content in members:
                archive.writestr(name, content)
            archive.writestr("sub/", "")
    else:
        with tarfile.open(fileobj=out, mode="w:" + kind[3:]) as archive:
            for name, content in members:
                info = tarfile.TarInfo(name * (40 if name.endswith("1") else 1))  # long names have headers of their own
                info.size = len(content)
                archive.addfile(info, io.BytesIO(content))
            link = tarfile.TarInfo("l")
            link.type, link.linkname = tarfile.DIRTYPE, ""
            archive.addfile(link)
    return out.getvalue()


def cases():
    rng = random.Random(7)
    found = {f"{kind}-{n}": packed(rng, kind) for n in range(3) for kind in ("zip", "zip8", "zip12", "zip14", "tar", "targz", "tarbz2", "tarxz")}
    broken = bytearray(found["zip8-0"])
    broken[45] ^= 0xFF
    return found | {"broken": bytes(broken), "cut": found["zip8-1"][:-30], "short": found["tar-0"][: len(found["tar-0"]) // 2],
                    "shortgz": found["targz-0"][: len(found["targz-0"]) // 2], "none": b"", "text": b"no archive at all",
                    "prefixed": b"#!/bin/sh\n" * 50 + found["zip8-2"]}


def test_members_are_those_of_whole_archives(spark, tmp_path):
    rows = []
    for name, content in cases().items():
        (tmp_path / name).write_bytes(content)
        rows.append((name, name, str(tmp_path / name) if len(rows) % 2 else f"file://{tmp_path}/{name}", content))
    archives = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for limits in (Limits(), Limits(max_archive_members=9, max_archive_bytes=300000)):
        whole = judge_members(explode_archives(archives, limits), limits)
        by_range = judge_members(ranges.explode_located(archives, limits), limits)

        def shown(df):
            return {(r.archive_id, r.ordinal): (r.name, r.kind, r.format, r.declared_size, None if r.content is None else bytes(r.content))
                    for r in df.collect() if r.refusal is None}

        assert shown(whole) == shown(by_range) and len(shown(whole)) > 5
        refused = [{r.archive_id: r.error_code for r in archive_verdict(explode(archives, limits), limits).collect()}
                   for explode in (explode_archives, ranges.explode_located)]
        assert refused[0] == refused[1]


class Counted(io.FileIO):
    """A file that notes what is read of it."""

    total = 0

    def read(self, size=-1):
        data = super().read(size)
        Counted.total += len(data)
        return data

    def readall(self):
        raise AssertionError("the whole file is read")


@pytest.mark.parametrize("kind", ["zip", "tar"])
def test_of_a_huge_archive_only_ranges_are_read(tmp_path, monkeypatch, kind):
    """64 GB of holes in the file, 3 small members asked for."""
    path = tmp_path / "huge"
    size = 64 << 30
    if kind == "zip":
        with open(path, "wb") as file:
            file.truncate(size)
            file.seek(size)
            with zipfile.ZipFile(file, "a", 8) as archive:
                for i in range(3):
                    archive.writestr(f"m{i}", f"text {i} " * 1000)
    else:
        with open(path, "wb") as file:
            for i in range(3):
                head = tarfile.TarInfo(f"m{i}")
                head.size = 8000
                file.write(head.tobuf() + (f"text {i} " * 1143)[:8000].encode().ljust(8192, b"\0"))
                hole = tarfile.TarInfo(f"hole{i}")
                hole.size = size // 3 // 512 * 512
                file.write(hole.tobuf(tarfile.GNU_FORMAT))
                file.seek(hole.size, 1)
            file.write(b"\0" * 1024)
    assert os.stat(path).st_blocks * 512 < 1 << 20 and path.stat().st_size >= size - 4096
    monkeypatch.setattr(ranges, "open_ranges", lambda location: Counted(location))
    Counted.total = 0
    limits = Limits(max_archive_bytes=1 << 50)
    rows = list(ranges.index_rows(str(path), "huge", limits))
    names = dict.fromkeys(ranges._NAMES)
    reader = ranges._Reader(1 << 20)
    import types

    for row in rows:
        own = types.SimpleNamespace(location=str(path), **dict(zip(names, row)))
        if own.name.startswith("m"):
            assert reader(own).startswith(f"text {own.name[1]} ".encode())
    assert len([r for r in rows if r[3].startswith("m")]) == 3
    assert Counted.total < 1 << 20


def test_a_missing_archive_is_a_typed_refusal(spark, tmp_path):
    archives = spark.createDataFrame([("a", "a.zip", str(tmp_path / "a.zip"), None)], SCHEMA)
    found = archive_verdict(ranges.explode_located(archives, Limits()), Limits()).first()
    assert found.error_code == "input_rejected" and "cannot open" in found.error


def test_failures_of_the_store_are_tried_again_then_raised():
    calls = []

    def flaky(failures, error):
        def work():
            calls.append(1)
            if len(calls) <= failures:
                raise error
            return "read"

        return work

    assert stores.attempt(flaky(2, OSError("slow down")), wait_secs=0) == "read" and len(calls) == 3
    calls.clear()
    with pytest.raises(TimeoutError):
        stores.attempt(flaky(9, TimeoutError("no answer")), wait_secs=0)
    calls.clear()
    assert stores.attempt(flaky(1, FileNotFoundError()), wait_secs=0) is None and len(calls) == 1


def test_one_client_a_store(tmp_path):
    (tmp_path / "a b").write_text("x")
    first = stores.store_and_path(f"file://{tmp_path}/x")
    assert stores.store_and_path(f"file://{tmp_path}/y/z")[0] is first[0]
    assert stores.store_and_path(f"file://{tmp_path}/y/z")[1] == f"{tmp_path}/y/z"
    assert stores.file_length(f"{tmp_path}/a b") == 1 and stores.file_length(f"file://{tmp_path}/a%20b") == 1
    assert stores.file_length(str(tmp_path)) is None and stores.file_length(f"{tmp_path}/no") is None


def converted_members(spark, archives):
    """archive_id to a list of (name, markdown, error) in stored order."""
    rows = [(a, i, name, markdown, markdown, [("", "Text", markdown, None, None)] * (i % 3), [f"w{i}"] if i % 5 == 0 else [], i % 2, error)
            for a, members in archives.items() for i, (name, markdown, error) in enumerate(members)]
    element = "array<struct<id:string,category:string,text:string,page_number:int,level:int>>"
    return spark.createDataFrame(rows, f"archive_id string, ordinal int, name string, markdown string, text string, elements {element}, "
                                       "warnings array<string>, page_count int, error string").repartition(7)


@pytest.mark.parametrize("part_bytes", [1, 700, 1 << 20])
def test_parts_make_the_whole_archive(spark, part_bytes):
    rng = random.Random(part_bytes)
    name = lambda: "/".join(rng.choice("abc-") + str(rng.randint(0, 40)) for _ in range(rng.randint(1, 3)))
    def member():
        return name(), rng.choice(["", " \n", "x" * rng.randint(1, 400), "é" * rng.randint(1, 90)]), rng.choice([None, None, None, "failed"])
    # One archive holds most of all members, so several ranges share it.
    rows = converted_members(spark, {"hot": [member() for _ in range(3000)], "small": [member() for _ in range(5)], "one": [("a", "b", None)]})
    whole = {r.archive_id: r for r in merge_archive(rows, Limits()).collect()}
    parts = merge_parts(rows, Limits(), part_bytes=part_bytes).orderBy("archive_id", "part").collect()
    for archive, expected in whole.items():
        own = [r for r in parts if r.archive_id == archive]
        assert [r.part for r in own] == list(range(len(own)))
        assert "\n\n".join(r.markdown for r in own if r.sources) == expected.markdown
        assert "\n\n".join(r.text for r in own if r.sources) == expected.text
        for field in ("sources", "warnings", "elements"):
            assert [x for r in own for x in r[field]] == expected[field]
        assert [r.first_element for r in own] == [sum(len(x.elements) for x in own[:i]) for i in range(len(own))]
        assert sum(r.page_count or 0 for r in own) == (expected.page_count or 0)
        assert all(len(r.markdown.encode()) <= part_bytes + 1500 for r in own)
    assert (len([r for r in parts if r.archive_id == "hot"]) > 100) == (part_bytes < 1000)


def test_an_archive_that_one_row_cannot_hold_is_a_typed_error(spark):
    from pyspark.sql import functions as F

    from leafmill.plans.corpus import outcomes

    def zipped(*members):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", 8) as archive:
            for name, content in members:
                archive.writestr(name, content)
        return out.getvalue()

    rows = [("large", "a.zip", ".zip", zipped(("a.txt", "x " * 3000), ("b.txt", "y " * 3000)), "{}"), ("small", "b.zip", ".zip", zipped(("a.txt", "x")), "{}")]
    documents = spark.createDataFrame(rows, "request_id string, filename string, suffix string, content binary, option_key string").withColumn(
        "error", F.lit(None).cast("struct<error_code:string,error:string,missing_dependencies:array<string>>"))
    made = {r.request_id: r for r in outcomes(documents, Limits(max_row_bytes=20000)).collect()}
    assert made["large"].result is None and made["large"].error.error_code == "parse_failed" and "merge it in parts" in made["large"].error.error
    assert made["small"].result.markdown == "# a.txt\n\nx"
    free = {r.request_id: r for r in outcomes(documents, Limits()).collect()}
    assert free["large"].error is None and len(free["large"].result.markdown) > 11000


def test_small_archives_are_read_in_one_place_and_large_ones_in_many(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    rows = []
    for n in range(3):
        with zipfile.ZipFile(tmp_path / f"{n}.zip", "w") as archive:
            for i in range(40):
                archive.writestr(f"m{i}", bytes([65 + n]) * 100)
        rows.append((str(n), f"{n}.zip", str(tmp_path / f"{n}.zip")))
    archives = spark.createDataFrame(rows, "archive_id string, filename string, location string")

    def places():
        members = ranges.explode_located(archives, Limits()).select("archive_id", "ordinal", "content", F.spark_partition_id().alias("at")).collect()
        assert sorted((r.archive_id, r.ordinal, bytes(r.content)) for r in members) == [(str(n), i, bytes([65 + n]) * 100) for n in range(3) for i in range(40)]
        return [len({r.at for r in members if r.archive_id == str(n)}) for n in range(3)]

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert places() == [1, 1, 1]
        monkeypatch.setattr(ranges, "RUN_BYTES", 300)
        assert min(places()) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
