"""Exact and near copies against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pyarrow as pa
import pytest

from leafmill import session
from leafmill.llm import exact_dedup, jaccard_join, language
from leafmill.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"
ODD = [(1, None, "x"), (2, "", "x"), (3, "  \n", None), (4, "é" * 3000, "y"), (5, "a b c", "y"), (6, "A\tb  c", "z"), (7, "a b c", "z"),
       (7, "a b c", "z"), (None, "a b c", None), (8, None, None)]
SCHEMA = "doc_id long, text string, item string"


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows):
    sets = [(i, grams(t)) for i, t in rows]
    holds, root = {}, {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (_, s) in enumerate(sets):
        for g in s:
            holds.setdefault(g, []).append(k)
    for a, b in {(a, b) for ks in holds.values() for a in ks for b in ks if a < b}:
        x, y = sets[a][1], sets[b][1]
        if 100 * len(x & y) >= 80 * len(x | y):
            p, q = sorted((find(sets[a][0]), find(sets[b][0])))
            root[q] = p
    return {(i, len(s), find(i)) for i, s in sets}


def edited(rng, words, share):
    return " ".join(rng.choice("abcdefghij") * 3 if rng.random() < share else w for w in words)


def test_near_copies_of_the_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in QUERIES["op4_jaccard_join"](spark, SF).select("doc_id", "n_shingles", "component_id").collect()}
    assert got == brute([tuple(r) for r in rows])


def test_families_chains_and_a_common_passage(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(40)]
    texts = []
    for size in (7, 12, 60, 200):
        words = [word() for _ in range(size)]
        texts += [edited(rng, words, share) for share in (0, 0.01, 0.02, 0.03, 0.04) for _ in range(6)]
        for step in range(8):  # a chain: each close to the next, the ends far apart
            words = words[max(1, size // 20) :] + [word() for _ in range(max(1, size // 20))]
            texts.append(" ".join(words))
    texts += [" ".join([word() for _ in range(rng.randint(3, 60))] + passage) for _ in range(60)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_near_copies_of_odd_rows(spark):
    got = [tuple(r) for r in jaccard_join.near_duplicates(spark.createDataFrame(ODD, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 5), (6, 1, 5), (7, 1, 5), (7, 1, 5), (None, 1, 5), (8, 0, 8)], key=str)
    assert jaccard_join.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_copies_of_odd_rows(spark, keep):
    got = exact_dedup.find_copies(spark.createDataFrame(ODD, SCHEMA).repartition(3), keep=keep).collect()
    low, high = (1, 5) if keep == "smallest" else (8, 7)
    expected = []
    for i, text, _ in ODD:
        empty, abc = not text, text == "a b c"
        keep_id = low if empty else high if abc else i
        expected.append((i, keep_id, 3 if empty else 4 if abc else 1, i == keep_id, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert exact_dedup.find_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_dropping_copies_keeps_all_columns(spark):
    left = exact_dedup.drop_copies(spark.createDataFrame(ODD[:8], SCHEMA), keep="largest")
    assert left.columns == ["doc_id", "text", "item"]
    assert sorted(r.doc_id for r in left.collect()) == [2, 3, 4, 6, 7]
    rows = [(1, "a", None), (1, "b", None), (None, "c", None), (None, "d", None), (2, "b", None), (1, "a", None)]
    left = exact_dedup.drop_copies(spark.createDataFrame(rows, SCHEMA), keep="largest").collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == sorted([(1, "a"), (2, "b"), (None, "c"), (None, "d")], key=str)


@pytest.mark.parametrize("width", [1, 2, 7, 8, 9, 51, 211])
def test_rounds_reach_every_slot(width):
    radices = exact_dedup.digits_for(width)
    slots = 1
    for radix in radices:
        slots *= radix
    assert width <= slots <= 8 * max(width, 1) and max(radices) <= 8


def thue_morse(bits):
    """A string of a and b of 2**bits letters, and its complement."""
    text = "a"
    for _ in range(bits):
        text += text.translate({97: "b", 98: "a"})
    return text, text.translate({97: "b", 98: "a"})


def test_texts_without_a_common_shingle_are_not_linked(spark):
    """Any polynomial hash modulo a power of two takes the longer ones for equal."""
    rows = [(2 * bits + k, text) for bits in range(5, 14) for k, text in enumerate(thue_morse(bits))]
    rows += [(100 + k, f"one two {text} four five six") for k, text in enumerate(thue_morse(11))]
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_a_family_just_under_the_threshold(spark):
    """A thousand texts that nearly link with each other and with a family of true copies; a few of them do link with one far member."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(120)]

    def variant(edits):
        words = list(base)
        for at in rng.sample(range(len(words)), edits):
            words[at] = word()
        return words

    family = [variant(1) for _ in range(300)]
    outliers = [variant(4) for _ in range(1000)]
    far = []
    for words in outliers[:20]:
        words = list(words)
        words[rng.randrange(len(words))] = word()
        far.append(words)
    rows = list(enumerate(" ".join(t) for t in family + outliers + far))
    rng.shuffle(rows)
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_a_family_and_its_outliers_write_no_pairs_of_all(spark, monkeypatch):
    """Rows of the work tables grow with the items of a family, not with their square; a family without its centre loses no link."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(120)]

    def variant(words, edits):
        words = list(words)
        for at in rng.sample(range(len(words)), edits):
            words[at] = word()
        return words

    texts = [variant(base, edits) for edits, times in ((1, 20), (2, 200), (3, 200), (4, 100), (5, 50)) for _ in range(times)]
    texts += [variant(rng.choice(texts[-150:]), rng.randint(1, 2)) for _ in range(40)]
    rows = list(enumerate(" ".join(t) for t in texts))
    rng.shuffle(rows)
    wrote = []

    def through_table(df, purpose, real=jaccard_join.through_table):
        made = real(df, purpose)
        wrote.append((made.count(), purpose))
        return made

    monkeypatch.setattr(jaccard_join, "through_table", through_table)
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert {tuple(r) for r in got.collect()} == brute(rows)
    assert max(wrote)[0] <= 16 * len(rows), max(wrote)


def test_cells_of_a_large_ring_lose_no_link(spark, monkeypatch):
    """Rings cut into many cells give the same components."""
    monkeypatch.setattr(jaccard_join, "CELL_ITEMS", 300)
    test_a_family_just_under_the_threshold(spark)


def test_rows_go_to_python_in_batches_of_few_bytes(spark):
    rows = spark.range(0, 1000, 1, 1).selectExpr("id AS doc_id", "repeat('abcd ', 2000) AS text")
    exact_dedup.drop_copies(rows)
    sizes = rows.mapInArrow(lambda batches: (pa.record_batch([pa.array([b.nbytes])], names=["n"]) for b in batches), "n long")
    assert max(r.n for r in sizes.collect()) < 2 * session.BATCH_BYTES
    try:
        spark.conf.set(session.BATCH_SETTING, "54321")
        session.bound_batches(spark)
        assert spark.conf.get(session.BATCH_SETTING) == "54321"
    finally:
        spark.conf.unset(session.BATCH_SETTING)


def test_tasks_hold_little_before_they_send():
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(1200)) for _ in range(400)]
    batch = pa.record_batch([pa.array(["x"] * 400), pa.array(texts)], names=["lang", "text"])
    held = [b.column("n").to_numpy().sum() for b in language._count(iter([batch]))]
    assert sum(held) == 400 * 1200 * 5 and max(held) < 1 << 20
    sent = [sum(map(len, b.column("data").to_pylist())) for b in jaccard_join._send_heads(5, 50, 4)(iter([batch.select(["text"])] * 6))]
    assert max(sent) < 1 << 24
