"""The stages in a row against brute force."""

from __future__ import annotations

import re
import zlib

import corpus_pipeline
from test_copies import brute

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"\w+", text.lower())


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {i: t for i, t in rows.items() if t and any(c.isalpha() for c in t)}
    last = {}
    for i, t in sorted(left.items()):
        last[t] = i
    left = {i: t for t, i in last.items()}
    root = {i: r for i, _, r in brute(sorted(left.items()))}
    left = {i: t for i, t in left.items() if root[i] == i}

    def leaks(text):
        own = words(text)
        own = {tuple(own[k : k + 8]) for k in range(len(own) - 7)}
        return any(sum(tuple(w[k : k + 8]) in own for k in range(len(w) - 7)) >= 0.5 * (len(w) - 7) for w in items)

    left = {i: t for i, t in left.items() if not leaks(t)}
    out = corpus_pipeline.run(spark, SF)
    got = {r.doc_id: r for r in out.collect()}
    assert set(got) == set(left) and all(got[i].text == t and got[i].round_trip for i, t in left.items())
    assert out.columns == [*docs.columns, "ids", "round_trip"]


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(1, None, None, None, 0), (2, "", "en", "a", 1), (3, "One.", None, None, None), (4, "One.", "en", "b", 4)],
                                "doc_id long, text string, lang string, source string, n_chars long").select(docs.columns)
    for name, stage in corpus_pipeline.STAGES:
        for table in (odd, odd.limit(0)):
            out = stage(spark, table, SF)
            assert out.columns[: len(docs.columns)] == docs.columns and out.count() <= table.count(), name


def test_held_out_rule_is_crc32(spark):
    from leafmill.llm.catalog import learnable

    rows = spark.range(300).withColumnRenamed("id", "doc_id").select("doc_id", learnable().alias("x")).collect()
    assert all(r.x == (zlib.crc32(str(r.doc_id).encode()) % 3 != 1) for r in rows)
