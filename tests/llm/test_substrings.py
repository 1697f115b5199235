"""Repeated substrings against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np

from leafmill.llm import chunk_dedup, suffix_dedup

SF = "/root/testdata/sf0.001"


def brute(rows, length):
    seen = defaultdict(list)
    for k, (_, text) in enumerate(rows):
        data = (text or "").encode()
        for p in range(len(data) - length + 1):
            seen[data[p : p + length]].append((k, p))
    gone = [set() for _ in rows]
    for places in seen.values():
        if len(places) > 1:
            for k, p in places:
                gone[k].update(range(p, p + length))
    for (doc, text), lost in zip(rows, gone):
        data = (text or "").encode()
        spans = sum(1 for b in lost if b - 1 not in lost)
        kept = bytes(c for i, c in enumerate(data) if i not in lost)
        yield doc, len(data), len(lost), spans, hashlib.sha256(kept).hexdigest()


def rows_of(found):
    for r in found.collect():
        assert sum(s.stop - s.start for s in r.spans) == r.n_removed and hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
        yield r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256


def agrees(spark, rows, length):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(rows_of(suffix_dedup.remove_repeats(df, length)), key=str) == sorted(brute(rows, length), key=str)


def test_repeats_in_the_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    agrees(spark, rows, 400)


def test_passages_edits_and_periods(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 900)
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abé \n") for _ in range(n))
    passage = word(300)
    texts = [word(rng.randint(0, 200)) + passage[rng.randint(0, 120) :] + word(rng.randint(0, 200)) for _ in range(40)]
    texts += [passage[:i] + "#" + passage[i:] for i in range(0, 300, 17)]
    texts += ["ab" * 200, "a" * 500, "a" * 100, "a" * 99, "abc" * 70, word(3000), "", None, "é" * 60]
    texts += [texts[0], texts[0], word(150) * 3]
    agrees(spark, list(enumerate(texts)), 100)


def test_odd_rows(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(500))
    rows = [(1, text), (1, text), (None, text[100:]), (2, None), (3, "")]
    agrees(spark, rows, 400)
    wide = spark.createDataFrame([(1, "x", "t", 5, 6)], "doc_id long, text string, doc string, at int, runs int")
    assert [tuple(r)[:3] for r in suffix_dedup.remove_repeats(wide).collect()] == [(1, 1, 0)]
    assert suffix_dedup.remove_repeats(wide.limit(0)).count() == 0


def chunks_of(data):
    """Chunks by a hash that rolls a byte at a time."""
    from leafmill.llm.hashing import byte_table

    words = [int(w) >> 32 for w in byte_table(9)]
    start, h, found = 0, 0, []
    for i, b in enumerate(data):
        h = (h * 2 + words[b]) % 2**32
        size = i + 1 - start
        if size >= 32 and h >> 27 == 0 or size == 256 or i + 1 == len(data):
            found.append((start, data[start : i + 1]))
            start = i + 1
    return found


def brute_chunks(rows):
    rows = sorted(rows)
    times, first = defaultdict(int), {}
    for doc, text in rows:
        for at, chunk in chunks_of((text or "").encode()):
            if len(chunk) >= 32:
                times[chunk] += 1
                first.setdefault(chunk, (doc, at))
    for doc, text in rows:
        chunks = chunks_of((text or "").encode())
        gone = {at for at, c in chunks if times[c] > 1 and first[c] != (doc, at)}
        kept = b"".join(c for at, c in chunks if at not in gone)
        size = len((text or "").encode())
        yield doc, size, len(chunks), sum(times[c] > 1 for _, c in chunks), size - len(kept), hashlib.sha256(kept).hexdigest()


def test_chunks_of_the_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(-1, None), (-2, ""), (-3, "x" * 31), (-4, "x" * 31), (-5, "y" * 600), (-6, "\u00e9" * 5000)]
    got = chunk_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    got = got.select("doc_id", "n_bytes", "n_chunks", "n_repeated", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(brute_chunks(rows))


def test_an_insertion_moves_few_chunks():
    rng = random.Random(1)
    text = bytes(rng.choice(b"abcdefgh ") for _ in range(5000))
    shifted = b"inserted " + text[:2000] + b"more" + text[2000:]
    one, two = ({c for _, c in chunks_of(x)} for x in (text, shifted))
    assert len(one & two) > 0.8 * len(one)


def test_gear_in_segments(monkeypatch):
    data = np.frombuffer(random.Random(2).randbytes(10_000), np.uint8)
    whole = chunk_dedup.borders(data)
    monkeypatch.setattr(chunk_dedup, "SEGMENT", 700)
    assert (chunk_dedup.borders(data) == whole).all()


def test_chunks_of_odd_rows(spark):
    rows = [(None, "a" * 40, 1), (None, "a" * 40, 1), (1, None, 2), (1, "b" * 40, 3), (1, "b" * 40, 3)]
    got = chunk_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, digest int")).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_repeated, r.n_removed) for r in got) == [
        ("1", 0, 0, 0), ("1", 40, 1, 0), ("1", 40, 1, 0), ("None", 40, 1, 0), ("None", 40, 1, 0)]


def test_strings_that_fool_a_power_of_two(spark):
    """A Thue-Morse string and its complement have equal sums modulo 2**64 under any odd base."""
    one = "a"
    for _ in range(11):
        one += one.translate({97: "b", 98: "a"})
    other = one.translate({97: "b", 98: "a"})
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("cdefgh") for _ in range(rng.randint(50, 400)))
    rows = []
    for k in range(12):
        own = word()
        rows += [(2 * k, own + one[:2048] + own), (2 * k + 1, own + other[:2048] + own)]
    agrees(spark, rows[:4], 2048)
    agrees(spark, rows, 700)
