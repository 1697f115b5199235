"""Decontamination, quality, sharding and chat formatting on small fixtures."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import chat, decontaminate, hilbert, quality
from leafmill.llm.catalog import ORACLE, QUERIES
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
ITEM = "A train with Anna leaves the old station at 60 km per hour, and after 3 hours it has gone 180 km along the river to the north."
PLAIN = "how many red apples does the boy have when he gives half of them away to his sister"


@pytest.mark.parametrize("name", ["op5_chat_format", "op9_exact_dedup"])
def test_queries_agree_with_their_sql(spark, name):
    assert compare(spark, connect(SF), name, QUERIES[name], ORACLE[name], SF) == []


def test_leaks_and_re_parameterised_questions(spark):
    other = ITEM.replace("60", "75").replace("180", "225").replace("Anna", "Maria")
    crossed = "A train with Anna leaves the old station at 60 km per hour, and after 60 hours it has gone 7 km along the river to the north."
    docs = [(1, "So it says. " + ITEM + " End."), (2, "lead in " + other + " and more"), (3, crossed), (4, ITEM[:40]), (5, None), (6, ""),
            (7, "He asked: " + PLAIN.upper() + "?"), (8, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17"), (9, "x " * 40_000), (1, "another row with the id"),
            (None, ITEM), (10, "what is this")]
    items = [(100, ITEM), (200, PLAIN), (300, None), (400, "what is this"), (500, "5 6 7 8"), (500, "")]
    docs = spark.createDataFrame([(*d, "text") for d in docs], "doc_id long, text string, item_id string")
    items = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, tuple(r["items"])) for r in decontaminate.judge(docs, items).collect()}
    assert got == {(1, (100,)), (2, (100,)), (3, ()), (4, ()), (5, ()), (6, ()), (7, (200,)), (8, ()), (9, ()), (None, ()), (10, (400,))}
    same = {r.doc_id: r.same_values for r in decontaminate.leaks(docs, items).collect()}
    assert same[1] is True and same[2] is False
    assert decontaminate.judge(docs, items.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.judge(docs.limit(0), items).count() == 0


def test_leaks_by_a_sorted_join_are_the_same(spark, monkeypatch):
    small = sorted(map(str, QUERIES["op1_decontamination"](spark, SF).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", -1)
    assert sorted(map(str, QUERIES["op1_decontamination"](spark, SF).collect())) == small


def test_documents_that_hold_an_item(spark):
    docs, items = (spark.read.parquet(f"{SF}/{n}.parquet").collect() for n in ("documents", "benchmark"))
    expected = {(d.doc_id, i.item_id) for d in docs for i in items if d.text and i.text.lower() in d.text.lower()}
    got = {(r.doc_id, i) for r in QUERIES["op1_decontamination"](spark, SF).collect() for i in r["items"]}
    assert expected and got == expected


def test_quality_follows_labels_and_sites(spark):
    rows = {r.doc_id: r for r in QUERIES["op8_quality"](spark, SF).collect()}
    told = spark.read.parquet(f"{SF}/labels.parquet").collect()
    right = [rows[r.doc_id].good == (r.quality == 1) for r in told if r.doc_id in rows]
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count() and np.mean(right) > 0.9


def test_sparse_sites_shrink_toward_their_host(spark):
    rng = random.Random(8)
    good, bad = "the quick brown fox went over the lazy dog and home. ", "BUY NOW!!! $$$ WIN %%% "
    rows, labels = [], []
    for i in range(600):
        is_good = rng.random() < (0.95 if i % 2 else 0.2)
        rows.append((i, (good if is_good else bad) * rng.randint(1, 5), "fine" if i % 2 else "poor", "p" if i % 50 else f"rare{i}"))
        labels.append((i, int(is_good)))
    rows += [(1000, None, None, None), (1001, "", "fine", "p"), (5, good, "poor", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    told = spark.createDataFrame(labels + [(1000, None)], "doc_id long, quality int")
    got = quality.score(docs, told, F.col("host"), F.col("path")).collect()
    by = {}
    for r, row in ((r, row) for r in got for row in rows if row[0] == r.doc_id and r.doc_id != 5):
        by.setdefault((row[2], row[3]), r)
    assert len(got) == len(rows) and all(0 < r.quality < 1 for r in got)
    assert by["fine", "p"].path_posterior > 0.85 and by["poor", "p"].path_posterior < 0.4
    assert by["poor", "rare0"].host_posterior < 0.4 < by["fine", "p"].host_posterior
    none = quality.score(docs, told.limit(0), F.col("host"), F.col("path")).collect()
    assert len(none) == len(rows) and quality.score(docs.limit(0), told, F.col("host"), F.col("path")).count() == 0


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(dims, bits):
    cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1)
    index = hilbert.hilbert_index(cells, bits)
    order = np.argsort(index)
    assert (index[order] == np.arange(1 << dims * bits)).all()
    assert (np.abs(np.diff(cells[:, order], axis=1)).sum(axis=0) == 1).all()


def test_shards_are_even_and_gapless(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op10_hilbert_shards"](spark, SF).collect()
    sizes, slots = {}, {}
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert r["size"] == len(raw) + 8 and r.text_crc32 == zlib.crc32(raw) and r.law == "bytes" and r.grown_shard is None
        sizes[r.shard] = sizes.get(r.shard, 0) + r["size"]
        slots.setdefault(r.shard, []).append((r.slot, r.place))
    assert sorted(r.doc_id for r in rows) == sorted(docs) and set(sizes) <= set(range(24))
    even, most = sum(sizes.values()) / 24, max(r["size"] for r in rows)
    assert all(abs(s - even) <= most for s in sizes.values())
    for found in slots.values():
        found.sort()
        assert [s for s, _ in found] == list(range(len(found))) and [p for _, p in found] == sorted(p for _, p in found)


def test_shards_of_odd_rows_and_files(spark, tmp_path):
    rows = [(1, None, None, None), (1, "a", "x", 1.5), (2, "a", "x", 1.5), (3, "é" * 5000, "y", None), (4, "", "", float("nan"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place string, size double")
    dims = {"place": docs["place"], "size": docs["size"]}
    plan = hilbert.shard_plan(docs, dims, 3)
    assert sorted((r.doc_id, r["size"]) for r in plan.collect()) == [(1, 8), (1, 9), (2, 9), (3, 10008), (4, 8)]
    assert hilbert.shard_plan(docs.limit(0), dims, 3).count() == 0
    some = docs.filter("doc_id > 1")
    hilbert.write_shards(some, hilbert.shard_plan(some, dims, 2), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in back.collect()) == [2, 3, 4]


def test_chat_merges_turns_and_reads_back(spark):
    odd = ["<|im_end|>", "a<", "|b", "\\", "\\b<\\p", "<|im_sep|>", "", None, "é\n\n", "<|im_start|>user\nhi", "\\n<"]
    rng, rows = random.Random(5), []
    for conv in range(60):
        rows += [(conv, t, rng.choice(["user", "assistant", "as\nsist<|", None]), rng.choice(odd) if rng.random() < 0.7 else "word " * rng.randint(0, 50))
                 for t in range(rng.randint(1, 9))]
    rows += [(None, None, None, None), (99, 1, "user", "same"), (99, 1, "user", "same"), (98, 1, "assistant", "x" * 200_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("turns", F.lit(1))
    back = chat.format_conversations(df).select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("t")).collect()
    expected = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        expected.setdefault(conv, []).append((role or "", text or ""))
    assert {r.conv_id: [tuple(t) for t in r.t] for r in back} == expected
    for r in back:
        roles = [role for role, _ in expected[r.conv_id]]
        assert r.formatted.count(chat.START) == 1 + sum(a != b for a, b in zip(roles, roles[1:]))
    assert chat.format_conversations(df.limit(0)).count() == 0


def leaked(spark, pairs):
    """Of (item, document) pairs, the places of those that leak."""
    docs = spark.createDataFrame([(i, d) for i, (_, d) in enumerate(pairs)], "doc_id long, text string")
    items = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(pairs)], "item_id long, text string")
    return [r.doc_id for r in decontaminate.leaks(docs, items).orderBy("doc_id").collect() if r.doc_id == r.item_id]


def test_number_heavy_items_match_by_their_values(spark):
    table = "12 47 93 5 61 8 22 70 31 4 19 66"
    terse = "Now add 31 and 52 then 17, 4, 88, 63, 29, 75, 11, 36, 94 and tell us what the whole sum of them is"
    assert leaked(spark, [
        ("What is 3 + 4 * 5?", "He asked: what is 3 + 4 * 5? No idea."), ("What is 6 + 4 * 5?", "So what is 7 + 4 * 5? No idea."),
        (table, "The table has " + table + " in it."), ("81 92 73 64 55 16 27 38", "The table has 81 92 74 64 55 17 27 38 in it."),
        ("18 + 30 = 48", "Known is 18 + 30 = 48 to all."), ("21 22 23 24 25 26 27 28 29", " ".join(map(str, range(20, 40)))),
        (terse, terse.replace("31", "41").replace("17", "18").replace("88", "89")),
    ]) == [0, 2, 4, 6]


def test_one_odd_value_leaves_the_alignment(spark):
    fives = "Tom had 5 red marbles in his left pocket and 5 blue ones near the gate before he gave 5 of them away"
    named = "Then Anna went out with the dog and Anna saw the fox, so Anna ran back and told all that Anna was right"
    fruit = "the boy has 3 apples and 5 pears in the basket when he comes home"
    twice = "the boy has 2 apples and the girl has 2 pears when they come home"
    tail = "the old road goes by the mill and the church and the long wall to the sea where {} boats and {} nets lie"
    four = "there are 2 cats and 2 dogs and 2 cows and 2 hens on the farm"
    assert leaked(spark, [
        (fives, fives.replace("5 blue", "6 blue")), (named, named.replace("that Anna", "that Anne")),
        (fruit, fruit.replace("3", "4").replace("5", "4")), (fruit, fruit.replace("5", "3")), (twice, "the boy has 3 apples and the girl has 5 pears when they come home"),
        (tail.format(60, 30), tail.format(60, 60)), (four, "there are 3 cats and 4 dogs and 5 cows and 6 hens on the farm"),
    ]) == [0, 1, 2, 3, 4, 5]


def test_names_are_told_by_the_capital_alone(spark):
    pens = "Anna buys 3 pens. Anna gives Tom 2 pens. Anna loses 1 pen. Anna finds 4 pens. Anna sells 5 pens. Anna keeps 6 pens."
    capital = "What is the capital of France?"
    gate = "the old friend Anna came to the big gate"
    assert leaked(spark, [
        (pens, pens.replace("Anna", "Maria").replace("Tom", "Paul").replace("3", "7").replace("2", "8")),
        (capital, "He put the question What is the capital of France to us"), (capital, "he put it: WHAT IS THE CAPITAL OF FRANCE?"),
        (gate, "So " + gate.replace(" Anna", "\nAnna")), (gate, "So " + gate.replace(" Anna", "  Anna")), (gate, gate.replace("Anna", "(Maria)")),
        ("so we ran 5 km with Tom", "So We Ran 7 KM With Tom"), (gate, gate.replace("Anna", "from the town")),
    ]) == [0, 1, 2, 3, 4, 5, 6]


def test_a_long_stretch_of_a_longer_item_leaks(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(400)]
    item = " ".join(words)
    assert leaked(spark, [(item, "It says " + " ".join(words[150:250]) + " and ends."), (item[::-1], " ".join(item[::-1].split()[100:135]))]) == [0]


def test_quotes_in_scripts_without_spaces(spark):
    item = "次の数列の一般項を求めよ"
    docs = [(1, f"試験では「{item}」という問題が出た"), (2, f"先生は{item}と言った"), (3, "先生は次の授業の準備を始めた"), (4, item)]
    found = decontaminate.judge(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert {r.doc_id: r.contaminated for r in found.collect()} == {1: True, 2: True, 3: False, 4: True}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 8])
def test_run_hashes_tell_runs_apart(spark, n):
    from itertools import product

    rows = [(list(r), 0) for r in product([1, 2], repeat=n)]
    df = spark.createDataFrame(rows, "h array<long>, x int")
    made = [r[0][0] for r in df.select(decontaminate._runs(F.col("h"), n)).collect()]
    assert len(set(made)) == len(rows)
    longer = spark.createDataFrame([([9, *rows[-1][0], 9],)], "h array<long>").select(decontaminate._runs(F.col("h"), n)).first()[0]
    assert longer[1] == made[-1]


@pytest.mark.parametrize("sizes", [(64, 64), (2, 2)])
def test_a_full_map_changes_nothing(spark, monkeypatch, sizes):
    docs = [(1, "Anna has 3 red apples and 5 green pears in her big basket today"), (2, "one two three four five six seven eight nine ten")]
    items = [(5, "Bob has 7 red apples and 9 green pears in her big basket today"), (6, "one two three")]
    monkeypatch.setattr(decontaminate, "MAP_SIZE", sizes)
    found = decontaminate.judge(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id: r["items"] for r in found.collect()} == {1: [5], 2: [6]}


def test_turns_beyond_an_int_are_formatted(spark, tmp_path):
    rows = [(1, 1 << 40, "assistant", "later"), (1, 5, "user", "first")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r.conv_id: r for r in QUERIES["op5_chat_format"](spark, str(tmp_path)).collect()}
    assert found[1].n_turns == 2 and found[1].loss_chars == 5
