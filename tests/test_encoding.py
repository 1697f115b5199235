"""Declared encodings against Python's codecs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from leafmill.functions.encoding import LABELS, decoded
from leafmill.limits import Limits
from leafmill.plans.corpus import outcomes

WORDS = {"windows-1252": "naïve € “œ”", "ISO-8859-2": "Łódź", "ISO-8859-5": "Привет", "ISO-8859-7": "Ελλάδα", "ISO-8859-15": "€ Œ", "windows-1250": "Łódź",
         "windows-1251": "Привет", "windows-1253": "Ελλάδα", "windows-1254": "İğ", "KOI8-R": "Привет", "windows-31j": "日本語", "EUC-JP": "日本語",
         "ISO-2022-JP": "日本語", "GB18030": "汉字", "Big5": "漢字", "x-windows-949": "한국어", "x-MacRoman": "naïve", "IBM866": "Привет", "UTF-8": "é日"}
CODECS = {"windows-31j": "cp932", "x-windows-949": "cp949", "x-MacRoman": "mac_roman", "IBM866": "cp866"}


def read(spark, rows):
    df = spark.createDataFrame(rows, "id int, family string, content binary")
    return [(r._text, r._encoding, r._unread) for r in decoded(df, "content", "family").orderBy("id").collect()]


@pytest.mark.parametrize("family", ["html", "xml"])
def test_every_label_reads_what_it_names(spark, family):
    rows, expected = [], []
    for label, name in LABELS.items():
        if name not in WORDS:
            continue
        text = f'<?xml version="1.0" encoding="{label.upper()}"?><p>{WORDS[name]}</p>' if family == "xml" else f'<html><meta charset={label}><p>{WORDS[name]}</p>'
        rows.append((len(rows), family, text.encode(CODECS.get(name, name))))
        expected.append((text, name, None))
    assert read(spark, rows) == expected and len(rows) > 35


def test_marks_declarations_and_what_is_neither(spark):
    bare = '<?xml version="1.0" encoding="UTF-16"?><a>é</a>'
    cases = [
        ("text", "\ufeffé".encode("utf-16-le"), ("é", "UTF-16LE", None)), ("csv", "\ufeffa,é".encode("utf-16-be"), ("a,é", "UTF-16BE", None)),
        ("text", "\ufeffé".encode(), ("é", "UTF-8", None)), ("text", b'<meta charset="koi8-r">\xff', ('<meta charset="koi8-r">\ufffd', "UTF-8", None)),
        ("html", b"\xef\xbb\xbf<meta charset=koi8-r>\xc3\xa9", ("<meta charset=koi8-r>é", "UTF-8", None)),  # the mark counts
        ("xml", bare.encode("utf-16-le"), (bare, "UTF-16LE", None)), ("xml", bare.encode("utf-16-be"), (bare, "UTF-16BE", None)),
        ("xml", bare.encode(), (bare, "UTF-8", None)),  # it says UTF-16 in single bytes, so it is not
        ("html", b"<meta charset=martian>\xc3\xa9", ("<meta charset=martian>é", "UTF-8", "unknown encoding `martian`: read as UTF-8")),
        ("html", b" " * 2000 + b"<meta charset=koi8-r>", (" " * 2000 + "<meta charset=koi8-r>", "UTF-8", None)),  # too late
        ("html", b"", ("", "UTF-8", None)), ("html", b"<meta charset=euc-jp>\xff\xff!", None),
    ]
    got = read(spark, [(i, family, content) for i, (family, content, _) in enumerate(cases)])
    assert got[:-1] == [e for *_, e in cases[:-1]] and "\ufffd" in got[-1][0] and got[-1][1] == "EUC-JP"
    assert read(spark, [(0, "html", None)])[0][0] is None


def test_the_job_reads_by_declaration_and_tells_unknown_ones(spark):
    rows = [("a", ".html", "<meta charset=windows-1252><p>naïve €</p>".encode("cp1252")), ("b", ".xml", '<?xml version="1.0" encoding="shift_jis"?><p>日本</p>'.encode("cp932")),
            ("c", ".html", b"<meta charset=martian><p>x</p>"), ("d", ".txt", "Łódź".encode("utf-16"))]
    documents = spark.createDataFrame(rows, "request_id string, suffix string, content binary").select(
        "request_id", F.concat("request_id", "suffix").alias("filename"), "suffix", "content", F.lit("{}").alias("option_key"),
        F.lit(None).cast("struct<error_code:string,error:string,missing_dependencies:array<string>>").alias("error"))
    before = spark.conf.get("spark.sql.legacy.javaCharsets")
    made = {r.request_id: r.result for r in outcomes(documents, Limits()).collect()}
    assert {k: r.markdown for k, r in made.items()} == {"a": "naïve €", "b": "日本", "c": "x", "d": "Łódź"}
    assert made["c"].warnings == ["unknown encoding `martian`: read as UTF-8"] and made["a"].warnings == []
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == before
