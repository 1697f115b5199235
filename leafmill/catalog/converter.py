"""Queries for the converter hook, its states and failures, and converting once."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.catalog.admission import _pick
from leafmill.catalog.registry import query, table
from leafmill.functions.failures import classify_failure, status_error, status_warnings
from leafmill.functions.export import page_count
from leafmill.functions.lines import text_blocks
from leafmill.functions.text import as_text
from leafmill.limits import Limits
from leafmill.operators.blocks import extract
from leafmill.operators.content_store import convert_known as known
from leafmill.operators.content_store import open_store
from leafmill.operators.converter import convert_once as once
from leafmill.operators.converter import convert_with, hash_mismatch
from leafmill.session import work_dir


@query("""
SELECT event_id, CASE WHEN event_id % 5 IN (0, 2, 3) THEN 'unsupported_format' ELSE 'parse_failed' END AS error_code FROM events
""")
def converter_failures(spark: SparkSession, sf: str) -> DataFrame:
    message = _pick(
        F.col("event_id"), F.concat(F.lit("ValueError: UNSUPPORTED "), "event_type"), F.concat(F.lit("OSError: "), "event_type"),
        F.concat(F.lit("ConversionError: "), "event_type", F.lit(" is Not Supported")), "KeyError: No Pipeline for it",
        "ValueError: no pipe line",
    )
    return table(spark, sf, "events").select("event_id", classify_failure(message).alias("error_code"))


@query("""
WITH states AS (
  SELECT event_id, event_type, user_id % 6 AS n, event_id % 4 AS s, event_id % 7 <> 3 AS has_document,
    array_to_string([event_type || i for i in range(least(user_id % 6, 4))], '; ') AS shown FROM events
)
SELECT event_id, CASE WHEN NOT has_document THEN 'the converter returned no document for `' || event_type || '` (status='
      || CASE s WHEN 0 THEN 'SUCCESS' WHEN 1 THEN 'partial_success' WHEN 2 THEN 'Failure' ELSE 'SKIPPED' END || ')'
    WHEN s >= 2 THEN 'the converter failed on `' || event_type || '`' || CASE WHEN n > 0 THEN ': ' || shown ELSE '' END END AS error,
  concat_ws('|', CASE WHEN s = 1 THEN 'the conversion is partial: some pages or elements were skipped' END,
    CASE WHEN n > 0 THEN 'converter: ' || replace(shown, '; ', '|converter: ') END) AS warnings
FROM states
""")
def converter_status(spark: SparkSession, sf: str) -> DataFrame:
    status = _pick(F.col("event_id"), "SUCCESS", "partial_success", "Failure", "SKIPPED")
    numbers = F.sequence(F.lit(0), F.col("user_id") % 6)
    errors = F.transform(F.slice(numbers, F.lit(1), (F.col("user_id") % 6).cast("int")), lambda i: F.concat("event_type", i.cast("string")))
    return table(spark, sf, "events").select(
        "event_id",
        status_error(status, errors, F.col("event_id") % 7 != 3, F.col("event_type")).alias("error"),
        F.array_join(status_warnings(status, errors), "|").alias("warnings"),
    )


@query("SELECT event_id, nullif(user_id % 6, 0)::INT AS page_count FROM events")
def page_counts(spark: SparkSession, sf: str) -> DataFrame:
    pages = F.slice(F.sequence(F.lit(1), F.lit(6)), F.lit(1), (F.col("user_id") % 6).cast("int"))
    return table(spark, sf, "events").select("event_id", page_count(F.when(F.col("user_id") % 6 > 0, pages)).alias("page_count"))


def line_converter(options: dict[str, Any]) -> Callable[[str, bytes], dict[str, Any]]:
    """A small converter as a user might supply one: every ten lines make a page."""
    if options.get("ocr_engine") == "ocrmac":
        raise ImportError("no module named ocrmac")

    def convert(name: str, content: bytes) -> dict[str, Any]:
        text = content.decode("utf-8")
        lines = text.split("\n")
        if name.endswith(".slow"):
            time.sleep(60)
        if name.endswith(".bad"):
            raise ValueError("this format is not supported")
        if name.endswith(".none"):
            return {"status": "SKIPPED"}
        elements = [
            {"id": f"#/lines/{i}", "category": "Text", "text": line, "pages": [i // 10 + 1], "level": None}
            for i, line in enumerate(lines)
        ]
        partial = name.endswith(".part")
        return {
            "status": "PARTIAL_SUCCESS" if partial else "SUCCESS",
            "errors": ["page 1 is blurred"] if partial else [],
            "markdown": f"# {name}\n\n{text}",
            "text": "" if partial else text,
            "pages": list(range(1, (len(lines) + 9) // 10 + 1)),
            "elements": elements,
        }

    return convert


line_converter.honoured = ("ocr_engine", "ocr_languages", "table_structure")


@query(r"""
WITH named AS (
  SELECT doc_id, text, source || CASE WHEN doc_id % 997 = 8 THEN '.slow' ELSE CASE doc_id % 6 WHEN 0 THEN '.pdf' WHEN 1 THEN '.bad' WHEN 2 THEN '.none' WHEN 3 THEN '.part' WHEN 4 THEN '.docx' ELSE '.ocr' END END AS name,
    doc_id % 6 IN (0, 3, 4) AND doc_id % 997 <> 8 AS good, string_split(text, chr(10)) AS lines FROM documents
)
SELECT doc_id, name, CASE WHEN good THEN '# ' || name || chr(10) || chr(10) || text ELSE '' END AS markdown,
  CASE WHEN NOT good THEN '' WHEN doc_id % 6 = 3 THEN '# ' || name || chr(10) || chr(10) || text ELSE text END AS text,
  CASE WHEN good THEN (len(lines) + 9) // 10 END::INT AS page_count,
  CASE WHEN good THEN len([l for l in lines if trim(l) <> '']) ELSE 0 END::INT AS element_count,
  CASE WHEN good AND len([l for l in lines if trim(l) <> '']) >= 20 THEN 1 + (list_extract([i for i in range(len(lines)) if trim(lines[(i + 1)::INT]) <> ''], 20)) // 10 END::INT AS page_of_20,
  CASE doc_id % 6 WHEN 4 THEN 'ocr ignored: text is read as it is stored, no page image is recognised' WHEN 3 THEN 'the conversion is partial: some pages or elements were skipped;converter: page 1 is blurred' ELSE '' END AS warnings,
  CASE WHEN doc_id % 997 = 8 THEN 'timeout' ELSE CASE doc_id % 6 WHEN 1 THEN 'unsupported_format' WHEN 2 THEN 'parse_failed' WHEN 5 THEN 'library_missing' END END AS error_code,
  CASE WHEN doc_id % 997 = 8 THEN 'the conversion ran past the 1s limit' ELSE CASE doc_id % 6 WHEN 1 THEN 'the converter does not take `' || name || '`: ValueError: this format is not supported'
    WHEN 2 THEN 'the converter returned no document for `' || name || '` (status=SKIPPED)' WHEN 5 THEN 'no module named ocrmac' END END AS error
FROM named
""")
def converter_hook(spark: SparkSession, sf: str) -> DataFrame:
    doc = F.col("doc_id")
    named = table(spark, sf, "documents", "doc_id", "text", "source").select(
        "doc_id", F.concat("source", F.when(doc % 997 == 8, ".slow").otherwise(_pick(doc, ".pdf", ".bad", ".none", ".part", ".docx", ".ocr"))).alias("name"),
        F.encode("text", "UTF-8").alias("content"),
        F.when(doc % 6 == 5, '{"ocr_engine":"ocrmac"}').when(doc % 6 == 4, '{"ocr":true}').otherwise("{}").alias("option_key"),
    )
    done = convert_with(named, line_converter, Limits(timeout_secs=1), "doc_id", tag="lines")
    return done.select(
        "doc_id", "name", "markdown", "text", "page_count", F.size("elements").alias("element_count"),
        F.get("elements", F.lit(19))["page_number"].alias("page_of_20"), F.array_join("warnings", ";").alias("warnings"),
        "error.error_code", "error.error",
    )


@query(r"""
SELECT doc_id, sha256(text) AS content_sha, count(*) OVER (PARTITION BY text, doc_id % 2) AS copies, trim(text, E' \n') AS markdown FROM documents
""")
def convert_once(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select(
        "doc_id", F.encode("text", "UTF-8").alias("content"), F.lit(".txt").alias("suffix"),
        F.when(F.col("doc_id") % 2 == 0, "{}").otherwise('{"ocr":true}').alias("option_key"),
    )

    def convert(distinct: DataFrame) -> DataFrame:
        read = extract(distinct.withColumn("_text", as_text(F.col("content"))), text_blocks(F.col("_text")))
        return read.drop("content", "_text", "elements", "text")

    return once(documents, convert, "doc_id").select("doc_id", "content_sha", "copies", "markdown")


@query("SELECT doc_id, CASE WHEN doc_id % 10 = 4 THEN NULL ELSE doc_id % 10 = 3 END AS mismatch FROM documents")
def content_address(spark: SparkSession, sf: str) -> DataFrame:
    doc = F.col("doc_id")
    claimed = F.when(doc % 10 == 4, "").when(doc % 10 == 3, F.sha2("source", 256)).otherwise(F.upper(F.sha2("text", 256)))
    return table(spark, sf, "documents").select("doc_id", hash_mismatch(F.encode("text", "UTF-8"), claimed).alias("mismatch"))


@query(r"""
SELECT doc_id, trim(text, E' \n') AS markdown, (SELECT count(DISTINCT text) FROM documents) AS stored FROM documents
""")
def convert_known(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over one store: the first over the documents in English, the second over all, which converts the others only."""
    store = work_dir(spark, "content-store")
    documents = table(spark, sf, "documents").select(
        "doc_id", F.encode("text", "UTF-8").alias("content"), F.lit(".txt").alias("suffix"), F.lit("{}").alias("option_key"), "lang")

    def convert(distinct: DataFrame) -> DataFrame:
        read = extract(distinct.withColumn("_text", as_text(F.col("content"))), text_blocks(F.col("_text")))
        return read.select("doc_id", "content_sha", "suffix", "option_key", "markdown")

    for part in (documents.filter("lang = 'en'"), documents):
        made = known(part.drop("lang"), convert, "doc_id", store)
    rows = spark.table(open_store(spark, store, made.schema)).agg(F.count("*")).scalar()
    return made.select("doc_id", "markdown", F.lit(rows).cast("long").alias("stored"))
