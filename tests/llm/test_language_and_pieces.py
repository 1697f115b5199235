"""Language filters and piece encoding: held-out accuracy, round trips, and a plain reading of the rules."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from leafmill.llm import language, sentencepiece
from leafmill.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"
ODD = [(1, "en", None), (2, None, ""), (3, "fr", " 12 !? \n"), (4, None, "A"), (5, "x", "straße " * 4000), (6, "en", "İstanbul\U0001f600 a▁b"), (6, "en", "twice"), (None, "en", "no id")]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op2_language_id"](spark, SF).join(docs, "doc_id").filter("held_out").collect()
    assert found and sum(r.lang == r.lang_pred for r in found) / len(found) >= 0.98
    assert all(0 <= r.score <= 1 for r in found)


def plain_trigrams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    return sorted(f" {w} "[i : i + 3] for w in words for i in range(len(w)))


def test_trigrams_are_those_of_the_words():
    texts = [None, "", "One  two-three.", "é\nÀb", "7", "İi x", *(t for _, _, t in ODD)]
    grams, rows = language.trigrams(texts)
    for i, text in enumerate(texts):
        codes = [int(g) for g in grams[rows == i]]
        assert sorted("".join(chr((g >> s) & 0x1FFFFF) for s in (42, 21, 0)) for g in codes) == plain_trigrams(text or "")


def test_filters_return_every_language_of_a_trigram():
    rng = random.Random(2)
    grams = {f"l{i}": rng.sample(range(1, 1 << 60), 300) for i in range(70)}
    filters = language.Filters.build(grams)
    for i, (lang, own) in enumerate(grams.items()):
        masks = filters.masks(np.array(own, np.int64).view(np.uint64))
        assert ((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).all()
    others = filters.masks(np.array(rng.sample(range(1 << 60, 1 << 61), 3000), np.int64).view(np.uint64))
    rate = np.mean([(others[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1) for i in range(70)])
    assert abs(rate - filters.false_rate.mean()) < 0.01


def test_language_of_odd_rows(spark):
    rows = spark.createDataFrame(ODD, "doc_id long, lang string, text string")
    model = language.learn(rows)
    got = [(r.doc_id, r.lang_pred, r.n_grams) for r in language.identify(rows, model).collect()]
    assert got[:4] == [(1, "und", 0), (2, "und", 0), (3, "und", 0), (4, got[3][1], 1)] and got[4][1] == "x" and len(got) == 8
    assert [r.doc_id for r in language.keep_known(rows, model).collect()] == [4, 5, 6, 6, None]
    nothing = language.learn(rows.limit(0))
    assert {r.lang_pred for r in language.identify(rows, nothing).collect()} == {"und"}


VOCABULARY = [("<unk>", 0, False, True)] + [(f"<0x{b:02X}>", 0, True, False) for b in range(256)] + [
    (p, -float(i % 5 + 1), False, False) for i, p in enumerate(["▁", "▁▁", "▁a", "a", "b", "ab", "▁ab", "bab", "é", "éa", "aéa", "▁▁a"])]


def best_score(model, word):
    """By trying all cuts."""
    known = {p: s for p, s in zip(model.pieces, model.scores) if s < 0}
    best = [0.0] + [-math.inf] * len(word)
    for e in range(1, len(word) + 1):
        for s in range(e):
            part = word[s:e].encode()
            score = known.get(part, model.unknown if e - s == 1 else -math.inf)
            best[e] = max(best[e], best[s] + score)
    return best[-1]


def test_segmentations_are_the_best_ones():
    rng = random.Random(7)
    for scores in ("stored", "zipf"):
        model = sentencepiece.Model.of(VOCABULARY, scores)
        words = [" " * rng.randint(1, 3) + "".join(rng.choice("aabbéxö") for _ in range(rng.randint(0, 90))) for _ in range(300)]
        packed = model.segment_all([w.encode() for w in words])
        for word, found in zip(words, packed):
            ids = np.frombuffer(found, np.int32).tolist()
            assert b"".join(model.pieces[i] for i in ids).decode() == word
            byte_ids, score, i = set(model.byte_ids.tolist()), 0.0, 0
            while i < len(ids):
                if ids[i] in byte_ids:
                    score, i = score + model.unknown, i + sentencepiece.char_width(model.pieces[ids[i]][0])
                else:
                    score, i = score + model.scores[ids[i]], i + 1
            assert score == pytest.approx(best_score(model, word))


def test_texts_come_back(spark):
    rows = QUERIES["op7_sentencepiece"](spark, SF).collect()
    assert rows and all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)


def test_pieces_of_odd_rows(spark):
    model = sentencepiece.Model.of(VOCABULARY)
    rows = spark.createDataFrame(ODD + [(9, None, t) for t in (" ", "  a ", "▁", "▁ ▁", "a\0b")], "doc_id long, ids string, text string")
    back = sentencepiece.decode(sentencepiece.encode(rows, model), model).collect()
    assert all(r.text == r.decoded for r in back) and [r.ids for r in back][:2] == [None, []]
    assert sentencepiece.encode(rows.limit(0), model).count() == 0


def test_long_words_leave_the_cache():
    model = sentencepiece.Model.load()
    texts = ["数" * 3000, "short words only", "数" * 3000 + " x", None]
    first = model.encode_all(texts)
    assert max(map(len, model.cache)) <= sentencepiece.CACHE_CHARS
    assert model.encode_all(texts) == first
    assert model.decode(np.frombuffer(first[0], np.int32).tolist()) == texts[0]
