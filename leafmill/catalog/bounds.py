"""Queries for budgets, sizes and result records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.catalog.documents import PAGE_BLOCKS_SQL, PAGE_EXPORTS_SQL, extracted_pages
from leafmill.catalog.registry import query, table
from leafmill.functions.export import echo_elements, element_bytes, fitting_elements
from leafmill.functions.text import clip_utf8, fits_utf8
from leafmill.functions.markup import html_blocks
from leafmill.limits import Limits
from leafmill.operators.assemble import apply_budget, assemble
from leafmill.operators.blocks import extract

_BUDGET = 12000
_ECHO = {"max_elements": 2000, "max_element_chars": 2048}

# Size of a text as ASCII JSON: by what is left after taking the plain characters out.
_JSON_LENGTH_SQL = r"""(len(text) + 2 + len(regexp_replace(text, '[^"\\]', '', 'g'))
  + 5 * len(regexp_replace(text, '[ -~]', '', 'g'))
  + 6 * len(regexp_replace(text, '[^\x{10000}-\x{10FFFF}]', '', 'g')))"""

_SIZED_SQL = PAGE_EXPORTS_SQL + r"""
, sized AS (
  SELECT page_id, seq, sum(60 + 2 + len('#/blocks/' || seq) + 2 + len(category) + """ + _JSON_LENGTH_SQL + r"""
    + 4 + coalesce(len(level::VARCHAR), 4) + 1) OVER (PARTITION BY page_id ORDER BY seq) AS running
  FROM (SELECT page_id, seq, category, level, substr(text, 1, 2048) AS text FROM blocks WHERE seq < 2000)
)
"""

_BUDGET_SQL = _SIZED_SQL + rf"""
, md_chars AS (
  SELECT page_id, unnest(c) AS ch, generate_subscripts(c, 1) AS i FROM (SELECT page_id, string_split(markdown, '') AS c FROM exports)
), md_run AS (
  SELECT *, sum(strlen(ch)) OVER (PARTITION BY page_id ORDER BY i) AS bytes FROM md_chars
), md AS (
  SELECT page_id, coalesce(string_agg(ch, '' ORDER BY i) FILTER (WHERE bytes <= {_BUDGET}), '') AS markdown,
    max(bytes) <= {_BUDGET} AS whole_md FROM md_run GROUP BY page_id
), tx_chars AS (
  SELECT page_id, unnest(c) AS ch, generate_subscripts(c, 1) AS i FROM (SELECT page_id, string_split(text, '') AS c FROM exports)
), tx_run AS (
  SELECT t.*, sum(strlen(ch)) OVER (PARTITION BY t.page_id ORDER BY i) AS bytes, {_BUDGET} - strlen(m.markdown) AS room
  FROM tx_chars t JOIN md m ON t.page_id = m.page_id
), tx AS (
  SELECT page_id, coalesce(string_agg(ch, '' ORDER BY i) FILTER (WHERE bytes <= room), '') AS text,
    max(bytes) <= max(room) AS whole_tx FROM tx_run GROUP BY page_id
), spent AS (
  SELECT e.page_id, md.markdown, tx.text, whole_md, whole_tx, n_blocks,
    {_BUDGET} - strlen(md.markdown) - strlen(tx.text) AS room
  FROM exports e JOIN md ON e.page_id = md.page_id JOIN tx ON e.page_id = tx.page_id
), fitted AS (
  SELECT s.*, (SELECT count(*) FROM sized z WHERE z.page_id = s.page_id AND z.running <= s.room)::INT AS kept FROM spent s
)
"""


@query(r"""
WITH chars AS (
  SELECT doc_id, n_chars * 3 // 4 + 1 AS budget, unnest(c) AS ch, generate_subscripts(c, 1) AS i
  FROM (SELECT doc_id, n_chars, string_split(text, '') AS c FROM documents)
), run AS (
  SELECT *, sum(strlen(ch)) OVER (PARTITION BY doc_id ORDER BY i) AS bytes FROM chars
)
SELECT doc_id, coalesce(string_agg(ch, '' ORDER BY i) FILTER (WHERE bytes <= budget), '') AS clipped,
  max(bytes) <= max(budget) AS whole FROM run GROUP BY doc_id
""")
def utf8_clip(spark: SparkSession, sf: str) -> DataFrame:
    budget = F.expr("n_chars * 3 div 4 + 1")
    return table(spark, sf, "documents", "doc_id", "text", "n_chars").select(
        "doc_id", clip_utf8(F.col("text"), budget).alias("clipped"), fits_utf8(F.col("text"), budget).alias("whole")
    )


def _shown(spark: SparkSession, sf: str) -> DataFrame:
    return extracted_pages(spark, sf).withColumn("elements", echo_elements(F.col("elements"), Limits(**_ECHO)))


@query(_BUDGET_SQL + """
SELECT page_id, markdown, text, kept AS elements_kept, NOT (whole_md AND whole_tx AND kept = n_blocks) AS truncated FROM fitted
""")
def output_budget(spark: SparkSession, sf: str) -> DataFrame:
    spent = apply_budget(_shown(spark, sf), Limits(max_output_bytes=_BUDGET))
    return spent.select("page_id", "markdown", "text", F.size("elements").alias("elements_kept"), "truncated")


@query(_SIZED_SQL + """
SELECT page_id, count(*) FILTER (WHERE running <= 3000)::INT AS elements_kept, max(running)::BIGINT AS json_bytes
FROM sized GROUP BY page_id
""")
def fit_elements(spark: SparkSession, sf: str) -> DataFrame:
    total = F.aggregate("elements", F.lit(0).cast("long"), lambda sum_, e: sum_ + element_bytes(e))
    return _shown(spark, sf).select(
        "page_id", fitting_elements(F.col("elements"), F.lit(3000)).alias("elements_kept"), total.alias("json_bytes")
    )


@query(_BUDGET_SQL + """
SELECT f.page_id, 'leafmill' AS backend, split_part(url, '/', 3) || '.html' AS filename, kept AS element_count,
  NULL::INT AS page_count, split_part(url, '/', 3) || '.html' AS sources, strlen(markdown)::INT AS markdown_bytes,
  strlen(text)::INT AS text_bytes, NOT (whole_md AND whole_tx AND kept = n_blocks) AS truncated
FROM fitted f JOIN pages p ON f.page_id = p.page_id
""")
def result_records(spark: SparkSession, sf: str) -> DataFrame:
    names = F.concat(F.split_part("url", F.lit("/"), F.lit(3)), F.lit(".html"))
    # The names ride along with the pages: no join is needed.
    pages = extract(table(spark, sf, "pages", "page_id", "url", "html"), html_blocks(F.col("html"))).select(
        "page_id", "markdown", "text", echo_elements(F.col("elements"), Limits(**_ECHO)).alias("elements"),
        names.alias("filename"), F.array(names).alias("sources"), F.lit(None).cast("int").alias("page_count"),
        F.array().cast("array<string>").alias("warnings"),
    )
    done = assemble(pages, Limits(max_output_bytes=_BUDGET))
    return done.select(
        "page_id", "result.backend", "result.metadata.filename", "result.metadata.element_count",
        "result.metadata.page_count", F.array_join("result.metadata.sources", ";").alias("sources"),
        F.octet_length("result.markdown").alias("markdown_bytes"), F.octet_length("result.text").alias("text_bytes"),
        "result.truncated",
    )
