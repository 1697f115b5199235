"""Text primitives against Python's own."""

from __future__ import annotations

import base64
import binascii
import json
import random

from pyspark.sql import functions as F

from leafmill.fixed import SPACES
from leafmill.functions import text as X
from leafmill.functions.payload import strict_base64

ALPHABET = "ab \t\n\"\\/\x00\x1f\x7f\x08éß€�日😀𝄞\u2028\xa0&;#"


def random_texts(n, longest=24, seed=7):
    rng = random.Random(seed)
    return ["", *("".join(rng.choice(ALPHABET) for _ in range(rng.randrange(longest))) for _ in range(n))]


def test_clip_is_the_longest_whole_prefix(spark):
    texts = random_texts(150, 8)
    rows = [(t, b) for t in texts for b in range(-1, 12)]
    df = spark.createDataFrame(rows, "t string, b int")
    for row in df.select("t", "b", X.clip_utf8(F.col("t"), F.col("b")).alias("c"), X.fits_utf8(F.col("t"), F.col("b")).alias("w")).collect():
        raw, budget = row.t.encode(), max(row.b, 0)
        assert row.c == raw[:budget].decode(errors="ignore"), row
        assert row.w == (len(raw) <= budget), row


def test_json_length(values):
    texts = random_texts(500)
    assert values(X.json_length, texts) == [len(json.dumps(t)) for t in texts]


def test_strip_and_blank_know_unicode_space(values):
    texts = [*random_texts(200), *SPACES, f" {SPACES}x{SPACES}y ", SPACES]
    assert values(X.strip, texts) == [t.strip() for t in texts]
    assert values(X.is_blank, texts) == [not t.strip() for t in texts]
    assert "".join(c for c in map(chr, range(0x110000)) if c.isspace()) == SPACES


def test_squeeze(values):
    texts = ["a  b", f"a{SPACES}b", "a\n\xa0b ", "’a\u2003b", ""]
    assert values(X.squeeze, texts) == ["a b", "a b", "a b ", "’a b", ""]


def test_entities_are_decoded_once(values):
    cases = {
        "&amp;lt;": "&lt;", "&lt;b&gt;": "<b>", "&#8364;&#x20AC;&#X1F600;": "€€😀", "&#38;lt;": "&lt;", "&amp;#38;": "&#38;",
        "&eacute;&nosuch;&": "é&nosuch;&", "&#0;&#xD800;&#1114112;&#99999999999;": "����", "AT&T &copy; &amp": "AT&T © &amp",
        "&quot;&apos;&nbsp;": "\"'\xa0", "&am": "&am", "": "",
    }
    assert values(X.decode_entities, list(cases)) == list(cases.values())


def test_bytes_to_text(values):
    raw = ["\ufeffx".encode(), b"a\xffb", "x\ufdd0y".encode(), b""]
    assert values(X.as_text, raw, "binary") == ["x", "a�b", "x\ufdd0y", ""]


def test_strict_base64(values):
    rng = random.Random(3)
    texts = ["", "eA", "eA==", "e A==", "@@", "eA==\n", "====", "eA=", "YWJj", "YWJjZA=="]
    texts += ["".join(rng.choice("aZ9+/= \n-") for _ in range(rng.randrange(9))) for _ in range(600)]

    def python(t):
        try:
            return base64.b64decode(t, validate=True)
        except (binascii.Error, ValueError):
            return None

    # Python takes data after padding in groups of its own, as in "YQ==YQ==";
    # the strict form takes padding at the end only.
    got = values(strict_base64, texts)
    for t, g in zip(texts, got):
        if "=" in t.rstrip("="):
            assert g is None
        else:
            assert (None if g is None else bytes(g)) == (python(t) if len(t) % 4 == 0 else None), t
