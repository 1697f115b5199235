"""Queries for block extraction, tables and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.catalog.registry import query, table
from leafmill.functions.encoding import decoded
from leafmill.functions.export import echo_elements
from leafmill.functions.lines import asciidoc_blocks, csv_blocks, markdown_blocks, text_blocks
from leafmill.functions.markup import html_blocks as html_to_blocks
from leafmill.functions.markup import xml_blocks
from leafmill.limits import Limits
from leafmill.operators.blocks import block_rows, element_rows, extract

# The block rules over tokens and windows: another way to the same rows.
PAGE_BLOCKS_SQL = r"""
WITH tokens AS (
  SELECT page_id, unnest(t) AS tok, generate_subscripts(t, 1) AS pos
  FROM (SELECT page_id, regexp_extract_all(html,
    '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<[^>]*>|[^<]+') AS t FROM pages)
), named AS (
  SELECT *, lower(regexp_extract(tok, '^</?([a-zA-Z][a-zA-Z0-9]*)', 1)) AS name,
    tok LIKE '</%' AS closes, tok LIKE '<%' AS is_tag,
    regexp_matches(tok, '(?is)^(<!--|<script\b.*</script\s*>$|<style\b.*</style\s*>$)') AS dropped
  FROM tokens
), marked AS (
  SELECT *, sum(CASE WHEN name = 'head' AND NOT closes THEN 1 WHEN name = 'head' THEN -1 ELSE 0 END)
      OVER (PARTITION BY page_id ORDER BY pos) AS depth,
    NOT dropped AND name IN ('h1','h2','h3','h4','h5','h6','p','li','ul','ol','td','th','tr','table','pre','blockquote',
      'figcaption','div','article','section','main','header','footer','nav','body') AS starts
  FROM named
), numbered AS (
  SELECT *, sum(starts::INT) OVER (PARTITION BY page_id ORDER BY pos) AS blk
  FROM marked WHERE depth = 0 AND NOT dropped
), joined AS (
  SELECT page_id, blk, max(CASE WHEN starts THEN CASE WHEN closes THEN '/' ELSE '' END || name END) AS tag,
    string_agg(CASE WHEN name = 'br' AND is_tag THEN ' ' WHEN is_tag THEN '' ELSE tok END, '' ORDER BY pos) AS raw
  FROM numbered GROUP BY page_id, blk
), decoded AS (
  SELECT page_id, blk, tag, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(raw,
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&nbsp;', chr(160)), '&copy;', '©'), '&middot;', '·'),
    '&amp;', '&'), '[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) AS text
  FROM joined
), blocks AS (
  SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY blk) - 1)::INT AS seq,
    CASE WHEN tag = 'h1' THEN 'Title' WHEN tag IN ('h2','h3','h4','h5','h6') THEN 'Section-header'
      WHEN tag = 'li' THEN 'List-item' WHEN tag IN ('td','th') THEN 'Table' WHEN tag = 'figcaption' THEN 'Caption'
      WHEN tag = 'footer' THEN 'Page-footer' WHEN tag = 'header' THEN 'Page-header' ELSE 'Text' END AS category,
    CASE WHEN regexp_matches(tag, '^h[1-6]$') THEN tag[2]::INT END AS level, text
  FROM decoded WHERE text <> ''
)
"""

PAGE_EXPORTS_SQL = PAGE_BLOCKS_SQL + r"""
, rendered AS (
  SELECT page_id, seq, text, category,
    CASE WHEN seq = 0 THEN '' WHEN category = 'List-item' AND lag(category) OVER (PARTITION BY page_id ORDER BY seq) = 'List-item'
      THEN chr(10) ELSE chr(10) || chr(10) END AS gap,
    CASE WHEN level IS NOT NULL THEN repeat('#', level) || ' ' || text WHEN category = 'List-item' THEN '- ' || text ELSE text END AS md
  FROM blocks
), exports AS (
  SELECT p.page_id, coalesce(string_agg(gap || md, '' ORDER BY seq), '') AS markdown,
    coalesce(string_agg(text, chr(10) ORDER BY seq), '') AS text, count(seq)::INT AS n_blocks
  FROM pages p LEFT JOIN rendered r ON p.page_id = r.page_id GROUP BY p.page_id
)
"""


def extracted_pages(spark: SparkSession, sf: str) -> DataFrame:
    return extract(table(spark, sf, "pages", "page_id", "html"), html_to_blocks(F.col("html"))).drop("html")


@query(PAGE_BLOCKS_SQL + "SELECT page_id, seq, '#/blocks/' || seq AS id, category, level, text FROM blocks")
def html_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return block_rows(table(spark, sf, "pages", "page_id", "html"), html_to_blocks(F.col("html")), "page_id")


@query(PAGE_EXPORTS_SQL + "SELECT page_id, markdown FROM exports")
def html_markdown(spark: SparkSession, sf: str) -> DataFrame:
    return extracted_pages(spark, sf).select("page_id", "markdown")


@query(PAGE_EXPORTS_SQL + "SELECT page_id, text FROM exports")
def html_text(spark: SparkSession, sf: str) -> DataFrame:
    return extracted_pages(spark, sf).select("page_id", "text")


@query(PAGE_BLOCKS_SQL + """
SELECT page_id, seq, '#/blocks/' || seq AS id, category, level, substr(text, 1, 64) AS text,
  NULL::INT AS page_number
FROM blocks WHERE seq < 10
""")
def element_echo(spark: SparkSession, sf: str) -> DataFrame:
    limits = Limits(max_elements=10, max_element_chars=64)
    pages = extracted_pages(spark, sf).withColumn("elements", echo_elements(F.col("elements"), limits))
    return element_rows(pages, "page_id")


@query(r"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS n
  FROM (SELECT doc_id, string_split(regexp_replace(text, '[.]\n', E'.\n\n', 'g'), chr(10)) AS l FROM documents)
), grouped AS (
  SELECT *, sum((trim(line) = '')::INT) OVER (PARTITION BY doc_id ORDER BY n) AS grp FROM lines
), paragraphs AS (
  SELECT doc_id, grp, trim(string_agg(line, chr(10) ORDER BY n)) AS text
  FROM grouped WHERE trim(line) <> '' GROUP BY doc_id, grp
)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY grp) - 1)::INT AS seq, text FROM paragraphs
""")
def text_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    spaced = F.regexp_replace("text", "[.]\n", ".\n\n")
    return block_rows(table(spark, sf, "documents", "doc_id", "text"), text_blocks(spaced), "doc_id").select("doc_id", "seq", "text")


@query(r"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS n
  FROM (SELECT doc_id, string_split('# ' || source || ' ' || doc_id || E'\n\n' || text || E'\n- ' || lang || E'\n2. ' || n_chars
    || E'\n\n| lang | source |\n| --- | --- |\n| ' || lang || ' | ' || source || E' | extra |\n```\n# no heading ' || doc_id
    || E'\n\n| no | table |\n```\n```\nsecond\n```\n### end of ' || doc_id, chr(10)) AS l FROM documents)
), fences AS (
  SELECT *, regexp_matches(line, '^ {0,3}```') AS fence FROM lines
), counted AS (
  SELECT *, sum(fence::INT) OVER (PARTITION BY doc_id ORDER BY n) AS seen FROM fences
), classed AS (
  SELECT *, CASE WHEN fence OR seen % 2 = 1 THEN 'F' WHEN regexp_matches(line, '^#{1,6}[ \t]+') THEN 'H'
    WHEN regexp_matches(line, '^[ \t]*([-*+]|\d+[.)])[ \t]+') THEN 'L' WHEN regexp_matches(line, '^[ \t]*\|.*\|[ \t]*$') THEN 'R'
    WHEN trim(line) = '' THEN 'B' ELSE 'T' END AS cls, (seen + 1) // 2 AS fence_no
  FROM counted
), edges AS (
  SELECT *, CASE WHEN cls IN ('H', 'L') THEN 1 WHEN cls = 'F' AND fence_no IS DISTINCT FROM lag(CASE WHEN cls = 'F' THEN fence_no END)
      OVER (PARTITION BY doc_id ORDER BY n) THEN 1
    WHEN cls IS DISTINCT FROM lag(cls) OVER (PARTITION BY doc_id ORDER BY n) THEN 1 ELSE 0 END AS edge
  FROM classed
), runs AS (
  SELECT *, sum(edge) OVER (PARTITION BY doc_id ORDER BY n) AS run FROM edges
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY n) AS k,
    [trim(x) for x in string_split(regexp_replace(trim(line), '^\||\|$', '', 'g'), '|')] AS cells
  FROM runs WHERE cls <> 'B'
), rows_only AS (
  SELECT *, NOT (cls = 'R' AND k = 2 AND regexp_matches(line, '^[ \t]*\|?[ \t]*:?-+:?[ \t]*(\|[ \t]*:?-+:?[ \t]*)*\|?[ \t]*$')) AS kept
  FROM placed
), widths AS (
  SELECT *, max(len(cells)) FILTER (WHERE kept) OVER (PARTITION BY doc_id, run) AS width FROM rows_only
), texts AS (
  SELECT doc_id, run, any_value(cls) AS cls, min(line) AS first_line,
    CASE any_value(cls)
      WHEN 'H' THEN trim(regexp_replace(min(line), '^#+', ''))
      WHEN 'L' THEN trim(regexp_replace(min(line), '^[ \t]*([-*+]|\d+[.)])[ \t]+', ''))
      WHEN 'F' THEN coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT fence), '')
      WHEN 'R' THEN string_agg('| ' || array_to_string(list_resize(cells, width, ''), ' | ') || ' |'
        || CASE WHEN k = 1 THEN chr(10) || '| ' || array_to_string(['---' for i in range(width)], ' | ') || ' |' ELSE '' END,
        chr(10) ORDER BY n) FILTER (WHERE kept)
      ELSE trim(string_agg(line, chr(10) ORDER BY n)) END AS text
  FROM widths GROUP BY doc_id, run
)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY run) - 1)::INT AS seq,
  CASE WHEN cls = 'H' AND first_line LIKE '# %' THEN 'Title' WHEN cls = 'H' THEN 'Section-header' WHEN cls = 'L' THEN 'List-item'
    WHEN cls = 'R' THEN 'Table' ELSE 'Text' END AS category,
  CASE WHEN cls = 'H' THEN len(regexp_extract(first_line, '^(#+)', 1))::INT END AS level, text
FROM texts WHERE trim(text) <> ''
""")
def markdown_document_blocks(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("doc_id").cast("string")
    source = F.concat(
        F.lit("# "), "source", F.lit(" "), key, F.lit("\n\n"), "text", F.lit("\n- "), "lang", F.lit("\n2. "),
        F.col("n_chars").cast("string"), F.lit("\n\n| lang | source |\n| --- | --- |\n| "), "lang", F.lit(" | "), "source",
        F.lit(" | extra |\n```\n# no heading "), key,
        F.lit("\n\n| no | table |\n```\n```\nsecond\n```\n### end of "), key,
    )
    blocks = block_rows(table(spark, sf, "documents", "doc_id", "text", "source", "lang", "n_chars"), markdown_blocks(source), "doc_id")
    return blocks.select("doc_id", "seq", "category", "level", "text")


@query(r"""
SELECT p_partkey, b.* FROM part, LATERAL (
  SELECT 0 AS seq, 'Title' AS category, 1 AS level, p_name AS text
  UNION ALL SELECT 1, 'Text', NULL, p_brand || E' makes it.\nSize ' || p_size
  UNION ALL SELECT 2, 'Section-header', 2, 'Details of ' || p_partkey
  UNION ALL SELECT 3, 'List-item', NULL, p_type
  UNION ALL SELECT 4, 'List-item', NULL, 'size ' || p_size
  UNION ALL SELECT 5, 'List-item', NULL, 'first'
  UNION ALL SELECT 6, 'List-item', NULL, 'dash'
  UNION ALL SELECT 7, 'Table', NULL, E'| brand | type |\n| --- | --- |\n| ' || p_brand || ' | ' || p_type || E' |\n| x\\|y | ' || p_size || ' |'
  UNION ALL SELECT 8, 'Text', NULL, E'= no title\n\n* no item ' || p_partkey
) b
""")
def asciidoc_document_blocks(spark: SparkSession, sf: str) -> DataFrame:
    size, key = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    source = F.concat(
        F.lit("= "), "p_name", F.lit("\r\n\r\n"), "p_brand", F.lit(" makes it.\nSize "), size, F.lit("\n== Details of "), key,
        F.lit("\n\n* "), "p_type", F.lit("\n** size "), size, F.lit("\n. first\n- dash\n|===\n|brand |type\n\n|"), "p_brand",
        F.lit("\n|"), "p_type", F.lit("\n|x\\|y |"), size, F.lit("\n|===\n----\n= no title\n\n* no item "), key, F.lit("\n----\n"),
    )
    blocks = block_rows(table(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size"), asciidoc_blocks(source), "p_partkey")
    return blocks.select("p_partkey", "seq", "category", "level", "text")


@query(r"""
SELECT c_custkey, 'Table' AS category, E'| key | name | seg, "quoted" |  |\n| --- | --- | --- | --- |\n| ' || c_custkey || ' | ' || c_name
  || ' | ' || c_mktsegment || ' line "2"' || E' |  |\n| only ' || c_custkey || E' |  |  |  |\n| a\\|b | 5" pipe |  | end |' AS text
FROM customer
""")
def csv_table(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    source = F.concat(
        F.lit('key,name,"seg, ""quoted"""\r\n'), key, F.lit(',"'), "c_name", F.lit('","'), "c_mktsegment",
        F.lit('\nline ""2"""\r\n\r\nonly '), key, F.lit('\r\na|b,5" pipe,,end'),
    )
    blocks = block_rows(table(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment"), csv_blocks(source), "c_custkey")
    return blocks.select("c_custkey", "category", "text")


@query(r"""
SELECT o_orderkey, b.* FROM orders, LATERAL (
  SELECT 0 AS seq, o_orderstatus AS text
  UNION ALL SELECT 1, o_orderpriority || ' & <urgent> €'
  UNION ALL SELECT 2, 'a < b &amp; c ' || o_orderkey
  UNION ALL SELECT 3, 'tail of ' || o_orderkey
) b
""")
def xml_document_blocks(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    source = F.concat(
        F.lit('<?xml version="1.0"?>\n<order id="'), key, F.lit('">\n <!-- <x>no</x> -->\n <status>'), "o_orderstatus",
        F.lit("</status><priority>"), "o_orderpriority", F.lit(" &amp; &lt;urgent&gt;\n &#8364;</priority><empty/> <note><![CDATA[a < b &amp; c "),
        key, F.lit("]]></note>tail\tof "), key, F.lit("\n</order>"),
    )
    blocks = block_rows(table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority"), xml_blocks(source), "o_orderkey")
    return blocks.select("o_orderkey", "seq", "text")


@query(r"""
SELECT p_partkey, b.* FROM part, LATERAL (
  SELECT 0 AS seq, 'Text' AS category, 'before ' || p_partkey AS text
  UNION ALL SELECT 1, 'Caption', 'Part ' || p_name
  UNION ALL SELECT 2, 'Table', '| ' || p_brand || ' | ' || p_brand || ' | type |' || E'\n| --- | --- | --- |\n| ' || p_size || ' | ' || p_type || ' | a\|b |'
    || E'\n| ' || p_size || ' | ' || p_type || ' | c |' || E'\n| ' || p_size || ' | d | d |'
  UNION ALL SELECT 3, 'Text', 'after'
) b
""")
def table_spans(spark: SparkSession, sf: str) -> DataFrame:
    size, key = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    source = F.concat(
        F.lit("<body>before "), key, F.lit("<TABLE border=1><caption>Part "), "p_name",
        F.lit("</caption><thead><tr><th colspan=2>"), "p_brand", F.lit("</th><th>type</th></tr></thead><tr><td rowspan='3'>"), size,
        F.lit('</td><td class="x" rowspan="2"><p>'), "p_type",
        F.lit("</p></td><td>a|b</td></tr><tr><td>c</td></tr>\n<tr><td colspan = 2>d</td></tr></table>after</body>"),
    )
    blocks = block_rows(table(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size"), html_to_blocks(source), "p_partkey")
    return blocks.select("p_partkey", "seq", "category", "text")


@query(r"""
WITH shaped AS (
  SELECT page_id, page_id % 7 AS shape, CASE page_id % 7 WHEN 2 THEN replace(html, '"utf-8"', '"ISO-8859-1"')
    WHEN 3 THEN replace(replace(html, '<meta charset="utf-8">', '<meta http-equiv="Content-Type" content="text/html; charset=windows-1252">'), '</body>', '<p>€ “œ”</p></body>')
    WHEN 5 THEN replace(html, '"utf-8"', '"x-nowhere"') WHEN 6 THEN '<?xml version="1.0" encoding="koi8-r"?><p>Привет ' || page_id || '</p>' ELSE html END AS html FROM pages
)
SELECT page_id, CASE shape WHEN 0 THEN 'UTF-16LE' WHEN 1 THEN 'UTF-16BE' WHEN 2 THEN 'windows-1252' WHEN 3 THEN 'windows-1252' WHEN 6 THEN 'KOI8-R' ELSE 'UTF-8' END AS encoding,
  sha256(html) AS text_sha256, CASE shape WHEN 5 THEN 'unknown encoding `x-nowhere`: read as UTF-8' END AS warning
FROM shaped
""")
def declared_encodings(spark: SparkSession, sf: str) -> DataFrame:
    """Pages in several encodings, which their marks and declarations tell."""
    def shape(n: int) -> Column:
        return F.col("page_id") % 7 == n

    def labelled(label: str) -> Column:
        return F.replace(F.col("html"), F.lit('"utf-8"'), F.lit(f'"{label}"'))

    windows = F.replace(F.replace(F.col("html"), F.lit('<meta charset="utf-8">'), F.lit('<meta http-equiv="Content-Type" content="text/html; charset=windows-1252">')),
                        F.lit("</body>"), F.lit("<p>\x80 \x93\x9c\x94</p></body>"))  # these single bytes in Windows-1252
    russian = F.concat(F.unhex(F.lit("3C3F786D6C2076657273696F6E3D22312E302220656E636F64696E673D226B6F69382D72223F3E3C703EF0D2C9D7C5D420")),
                       F.encode(F.concat(F.col("page_id").cast("string"), F.lit("</p>")), "UTF-8"))
    content = (
        F.when(shape(0), F.concat(F.unhex(F.lit("FFFE")), F.encode("html", "UTF-16LE"))).when(shape(1), F.concat(F.unhex(F.lit("FEFF")), F.encode("html", "UTF-16BE")))
        .when(shape(2), F.encode(labelled("ISO-8859-1"), "ISO-8859-1")).when(shape(3), F.encode(windows, "ISO-8859-1"))
        .when(shape(4), F.concat(F.unhex(F.lit("EFBBBF")), F.encode("html", "UTF-8"))).when(shape(5), F.encode(labelled("x-nowhere"), "UTF-8"))
        .when(shape(6), russian)
    )
    pages = table(spark, sf, "pages", "page_id", "html").select(
        "page_id", content.alias("content"), F.when(shape(6), "xml").otherwise("html").alias("family"))
    made = decoded(pages, "content", "family")
    return made.select("page_id", F.col("_encoding").alias("encoding"), F.sha2("_text", 256).alias("text_sha256"), F.col("_unread").alias("warning"))
