"""Token counts against the library's own encoding of whole texts."""

from __future__ import annotations

import random

import pytest

from leafmill.llm import token_counts
from leafmill.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def own():
    import tokenizers

    return tokenizers.Tokenizer.from_file(token_counts.default_file())


def whole(own, text):
    return len(own.encode(text or "", add_special_tokens=False))


def test_counts_of_the_documents(spark, own):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_token_counts"](spark, SF).collect()
    expected = sorted((r.doc_id, len((r.text or "").encode()), whole(own, r.text), whole(own, r.text) > 1024) for r in rows)
    assert sorted(map(tuple, got)) == expected


def shapes(rng):
    """Texts of all kinds of runs, with and without white space."""
    words = ["don't", "we've", "''s", "!'re", "<|endoftext|>", "x1y22", "日本語の文", "ß", "naïve", "\U0001f600", "a" * 30, "9" * 40, "=" * 50,
             " " * 37, "\n\n", " \t ", "é", "٣٤", "ABC", "https://a.b/c?d=e", "　", " "]
    for glue in (" ", "", "\n", "  "):
        yield glue.join(rng.choice(words) for _ in range(rng.randint(200, 900)))
    for run in ("a", "ab", "9", "=", " ", "\n", "日", "a1", "<|endoftext|>", "'s", "\U0001f600"):
        yield run * rng.randint(900, 4000)
    letters = "abcdefghijklmnopqrstuvwxyz"
    yield "".join(rng.choice(letters) for _ in range(5000))
    yield "".join(rng.choice(letters + "0123456789+/") for _ in range(5000))
    yield "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(3000))
    yield "".join(rng.choice(" \n\t") for _ in range(3000))
    yield "".join(rng.choice("'s tld") for _ in range(3000))


@pytest.mark.parametrize("chunk,overlap", [(64, 16), (256, 32), (1000, 200)])
def test_spliced_windows_count_as_the_whole_text(spark, own, chunk, overlap):
    rows = list(enumerate([t for seed in range(3) for t in shapes(random.Random(seed))]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, chunk=chunk, overlap=overlap).collect()}
    assert got == {i: whole(own, t) for i, t in rows}


def test_odd_rows(spark, own):
    rows = [(1, None, "x"), (1, "", "x"), (None, "a b", None), (2, "don't", "y"), (2, "don't", "y"), (3, " ", None), (4, "word " * 300, "z"), (4, "word " * 300, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = token_counts.count_tokens(docs, limit=3, chunk=256, overlap=32).collect()
    expected = [(i, len((t or "").encode()), whole(own, t), whole(own, t) > 3) for i, t, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert token_counts.count_tokens(docs.limit(0)).count() == 0


def test_long_texts_in_windows_of_production_size(spark, own):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(3_000_000)), "lorem ipsum dolor " * 150_000, "z" * 1_000_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs).collect()}
    assert got == {i: whole(own, t) for i, t in enumerate(texts)}


def test_other_splits_are_refused(tmp_path):
    import json

    other = json.load(open(token_counts.default_file()))
    other["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(other))
    with pytest.raises(ValueError):
        token_counts.load(str(path))
