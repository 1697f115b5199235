"""Block rules on small literals; the driver's tables hold no such cases."""

from __future__ import annotations

import csv
import io
import random

import pytest

from leafmill.functions.export import to_markdown
from leafmill.functions.lines import asciidoc_blocks, csv_blocks, csv_rows, markdown_blocks, text_blocks
from leafmill.functions.markup import html_blocks, xml_blocks
from leafmill.functions.tables import span_grid, table_markdown


def short(rows):
    return [(b.category, b.level, b.text) for b in rows]


@pytest.fixture
def blocks(values):
    return lambda rule, source: short(values(rule, [source])[0])


def test_html_rules(blocks):
    source = """<!DOCTYPE html><HTML><head><title>no</title></head><body>lead<H1 class="x">T &amp; &#8364;</H1><p>one<br/>two<b>three</b>
      <!-- <p>no</p> --><script>var a = "<p>no</p>";</script><STYLE>p{}</STYLE><h6>six</h6><ul><li>a<ul><li>b</ul></li></ul>
      <figcaption>cap</figcaption><header>top</header><footer>end</footer>&amp;lt;<p> &nbsp; </p><p>unclosed"""
    assert blocks(html_blocks, source) == [
        ("Text", None, "lead"), ("Title", 1, "T & €"), ("Text", None, "one twothree"), ("Section-header", 6, "six"),
        ("List-item", None, "a"), ("List-item", None, "b"), ("Caption", None, "cap"), ("Page-header", None, "top"),
        ("Page-footer", None, "end"), ("Text", None, "&lt;"), ("Text", None, "unclosed"),
    ]
    assert blocks(html_blocks, "") == []
    assert blocks(html_blocks, "<head><title>x</title><body>no head end") == [("Text", None, "no head end")]
    assert blocks(html_blocks, "a < b and <p") == [("Text", None, "a  b and p".replace("  ", " "))]


def test_html_tables(blocks):
    spans = "<table><tr><th colspan=2>A|B</th><th>C</th></tr><tr><td rowspan='0'>x</td><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr></table>"
    assert blocks(html_blocks, spans) == [
        ("Table", None, "| A\\|B | A\\|B | C |\n| --- | --- | --- |\n| x | 1 | 2 |\n| x | 3 | 4 |")
    ]
    ragged = "<p>a</p><table><tbody><td>1<td>2<tr><td>3</table>b<table></table><table><tr><td>z"
    assert blocks(html_blocks, ragged) == [
        ("Text", None, "a"), ("Table", None, "| 1 | 2 |\n| --- | --- |\n| 3 |  |"), ("Text", None, "b"), ("Table", None, "| z |\n| --- |"),
    ]


def python_grid(rows):
    """Spans by brute force: mark places cell by cell."""
    places = {}
    for r, row in enumerate(rows):
        c = 0
        for text, colspan, rowspan in row:
            for _ in range(colspan):
                while (r, c) in places:
                    c += 1
                for down in range(rowspan):
                    places[(r + down, c)] = text
                c += 1
    width = [max((c for rr, c in places if rr == r), default=-1) + 1 for r in range(len(rows))]
    return [[places.get((r, c), "") for c in range(w)] for r, w in enumerate(width)]


def test_span_grid_against_brute_force(spark):
    rng = random.Random(5)
    tables = [
        [[(f"{r}.{c}", rng.choice([1, 1, 2, 3]), rng.choice([1, 1, 2, 4])) for c in range(rng.randrange(4))] for r in range(rng.randrange(1, 6))]
        for _ in range(120)
    ]
    df = spark.createDataFrame(
        [(i, t) for i, t in enumerate(tables)], "i int, t array<array<struct<text:string,colspan:int,rowspan:int>>>"
    )
    from pyspark.sql import functions as F

    for row in df.select("i", span_grid(F.col("t")).alias("g")).collect():
        assert row.g == python_grid(tables[row.i]), tables[row.i]


def test_table_markdown(values):
    grids = [[["a", "b|c"], ["d\ne"]], [], [[]], [["x"]]]
    assert values(table_markdown, grids, "array<array<string>>") == [
        "| a | b\\|c |\n| --- | --- |\n| d e |  |", None, None, "| x |\n| --- |"
    ]


def test_markdown_rules(blocks):
    source = (
        "# T\r\n\r\npara one\r\nline two\r\n- a\r\n  * b\r\n3) c\r\n````\r\n# not a heading\r\n\r\n- nor an item\r\n```\r\n"
        "| R | T |\r\n|:---|---:|\r\n| EU | 12 |\r\n| x\\|y |\r\nafter\r\n####### seven\r\n###### six\r\n```\r\nopen end"
    )
    assert blocks(markdown_blocks, source) == [
        ("Title", 1, "T"), ("Text", None, "para one\nline two"), ("List-item", None, "a"), ("List-item", None, "b"), ("List-item", None, "c"),
        ("Text", None, "# not a heading\n\n- nor an item"), ("Table", None, "| R | T |\n| --- | --- |\n| EU | 12 |\n| x\\|y |  |"),
        ("Text", None, "after\n####### seven"), ("Section-header", 6, "six"), ("Text", None, "open end"),
    ]
    assert blocks(markdown_blocks, "") == []


def test_markdown_round_trip(values):
    source = "# T\n\npara\nmore\n\n- a\n- b\n\n```\n# code\n```\n\n| a | b |\n| --- | --- |\n| c | d |\n\n## S"
    assert values(lambda x: to_markdown(markdown_blocks(x)), [source]) == [source]


def test_asciidoc_rules(blocks):
    source = "= T\n\ntext\nmore\n== S\n* a\n*** b\n. c\n- d\n|===\n|a |b\n\n|c\n|d\n|e |f\n|===\n----\n= code\n----\nend"
    assert blocks(asciidoc_blocks, source) == [
        ("Title", 1, "T"), ("Text", None, "text\nmore"), ("Section-header", 2, "S"), ("List-item", None, "a"), ("List-item", None, "b"),
        ("List-item", None, "c"), ("List-item", None, "d"), ("Table", None, "| a | b |\n| --- | --- |\n| c | d |\n| e | f |"),
        ("Text", None, "= code"), ("Text", None, "end"),
    ]


def test_text_rules(blocks):
    assert blocks(text_blocks, "a\nb\n \t\n\n\xa0\nc\r\n\r\nd") == [("Text", None, "a\nb"), ("Text", None, "c"), ("Text", None, "d")]
    assert blocks(text_blocks, "\xa0\n") == []


def test_long_runs_do_not_exhaust_the_stack(values):
    lines = "word\n" * 60000
    assert [len(b[0].text) for b in values(text_blocks, [lines])] == [len(lines) - 1]
    assert [len(b) for b in values(markdown_blocks, [lines + "| a |\n" * 20000])] == [2]
    assert [len(r) for r in values(csv_rows, ['"' + "x\n" * 60000 + '",1\n' + "a,b\n" * 20000])] == [20001]


def test_csv_against_the_csv_module(values):
    rng = random.Random(11)
    tables = [[[("".join(rng.choice('ab,"\n x') for _ in range(rng.randrange(5)))) for _ in range(3)] for _ in range(rng.randrange(1, 5))] for _ in range(200)]
    sources = []
    for t in tables:
        out = io.StringIO()
        csv.writer(out, quoting=csv.QUOTE_MINIMAL).writerows(t)
        sources.append(out.getvalue())
    assert values(csv_rows, sources) == tables


def test_csv_corner_cases(blocks):
    assert blocks(csv_blocks, "") == []
    assert blocks(csv_blocks, "\r\n \r\n") == []
    assert blocks(csv_blocks, 'a,"b ""q"", c",d\n1\n5" p,"x"y,"open') == [
        ("Table", None, '| a | b "q", c | d |\n| --- | --- | --- |\n| 1 |  |  |\n| 5" p | xy | open |')
    ]


def test_xml_rules(blocks):
    source = '<?xml version="1.0"?><!DOCTYPE r><r a="1">\n<a>x &amp; y</a><!-- <b>no</b> --><b/><![CDATA[1 < 2 &amp; ]]>z<c>&#233;</c></r>'
    assert blocks(xml_blocks, source) == [("Text", None, "x & y"), ("Text", None, "1 < 2 &amp; z"), ("Text", None, "é")]


def test_inner_tables_give_their_text_to_the_cell(blocks):
    nested = "<table><tr><td>A</td><td>x<table><tr><td>in</td><td>ner</td></tr></table>y</td></tr><tr><td>B</td><td>C</td></tr></table><p>after</p>"
    twice = "<table><tr><td>a<table><tr><td>b<table><tr><td>c</td></tr></table></td></tr></table></td><td>d</td></tr></table>"
    assert blocks(html_blocks, nested) == [("Table", None, "| A | x in ner y |\n| --- | --- |\n| B | C |"), ("Text", None, "after")]
    assert blocks(html_blocks, twice) == [("Table", None, "| a b c | d |\n| --- | --- |")]
