"""Queries that go through files: scans, requests, archives, sinks, the corpus job, and the document stream."""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from leafmill.catalog.admission import _pick, plain_base64
from leafmill.catalog.converter import line_converter
from leafmill.catalog.documents import PAGE_EXPORTS_SQL
from leafmill.catalog.registry import query, table
from leafmill.functions.text import as_text, strip
from leafmill.limits import Limits
from leafmill.operators.admission import size_gate, with_suffix
from leafmill.operators.archives import archive_verdict, judge_members
from leafmill.plans.corpus import admit, outcomes, run_corpus
from leafmill.session import through_table, work_dir
from leafmill.sources.archives import explode_archives
from leafmill.sources.files import load_requests, parse_requests, scan_documents
from leafmill.sources.ranges import explode_located
from leafmill.sources.stores import store_and_path
from leafmill.streaming.documents import poll
from leafmill.streaming.documents import stream_documents as start_documents


def _document_files(spark: SparkSession, sf: str) -> str:
    """The documents as text files, a folder per source; gives the folder."""
    folder = work_dir(spark, "documents")
    table(spark, sf, "documents").select("source", "text").write.option("maxRecordsPerFile", 500).partitionBy("source").text(folder)
    return folder


def _source_of(path: str):
    return F.regexp_extract(path, "/source=([^/]+)/", 1)


def _filled_lines(text):
    """Lines that hold more than white space."""
    return F.size(F.filter(F.split(text, "\n"), lambda line: strip(line) != "")).cast("long")


_LINES_SQL = "len([l for l in string_split(text, chr(10)) if trim(l) <> ''])"


@query(f"SELECT source, sum(strlen(text) + 1)::BIGINT AS bytes, sum({_LINES_SQL})::BIGINT AS lines FROM documents GROUP BY source")
def file_scan(spark: SparkSession, sf: str) -> DataFrame:
    files = size_gate(scan_documents(spark, _document_files(spark, sf), "*.txt"), Limits())
    lines = files.select(_source_of("path").alias("source"), "length", _filled_lines(as_text(F.col("content"))).alias("lines"))
    return lines.groupBy("source").agg(F.sum("length").alias("bytes"), F.sum("lines").alias("lines"))


# A file holds the texts of one source, each with a line end; a block of text is
# a run of lines, which a blank line ends.
_FILE_SQL = f"SELECT source, sum({_LINES_SQL})::BIGINT AS lines, 0::BIGINT AS failed, 0::BIGINT AS cut FROM documents GROUP BY source"


@query(_FILE_SQL)
def file_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Path requests for each file written, through the whole job."""
    folder = _document_files(spark, sf)
    files = scan_documents(spark, folder, "*.txt")
    empty = F.lit(None).cast("string")
    requests = files.select(
        F.col("path").alias("request_id"), "path", empty.alias("content_base64"), empty.alias("filename"), empty.alias("options")
    )
    root = folder.removeprefix("file://")
    made = outcomes(admit(parse_requests(requests), files, Limits(), [root]), Limits())
    return _lines_by_source(made)


def _lines_by_source(made: DataFrame) -> DataFrame:
    return made.groupBy(_source_of("request_id").alias("source")).agg(
        F.sum(_filled_lines(F.col("result.markdown"))).alias("lines"), F.count_if(F.col("error").isNotNull()).alias("failed"),
        F.sum((F.size("result.elements") - F.col("result.metadata.element_count") + F.col("result.metadata.cuts.elements_dropped")).cast("long")).alias("cut"),
    )


_BATCH_BYTES = 1 << 30


@query(_FILE_SQL)
def document_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same files, taken as a stream in micro-batches and polled at the end."""
    folder = _document_files(spark, sf)
    out, checkpoint = work_dir(spark, "outcomes"), work_dir(spark, "documents-checkpoint")
    size = scan_documents(spark, folder, "*.txt").agg(F.sum("length")).first()[0]
    # Small tables still take several batches; large ones take more, of a size that repays their planning.
    per_batch = min((size or 0) // 3 + 1, _BATCH_BYTES)
    start_documents(spark, folder, out, checkpoint, Limits(), [folder], "*.txt", bytes_per_batch=per_batch, once=True).awaitTermination()
    return _lines_by_source(poll(spark, out))


# Requests of every outcome, one per document and per page.
_REQUESTS_SQL = PAGE_EXPORTS_SQL + r"""
, wanted AS (
  SELECT 'd' || doc_id AS request_id, doc_id % 20 AS k, trim(text, E' \n') AS markdown, trim(text, E' \n') AS text, 1 AS n_blocks, strlen(text) AS size FROM documents
  UNION ALL SELECT 'p' || e.page_id, 8, e.markdown, e.text, e.n_blocks, strlen(html) FROM exports e JOIN pages p ON e.page_id = p.page_id
), outcome AS (
  SELECT request_id, CASE WHEN k IN (1, 5) THEN NULL WHEN k IN (2, 6) THEN 'input_rejected'
      WHEN k = 3 THEN 'unsupported_format' END AS error_code,
    CASE WHEN k IN (1, 5) THEN 'give exactly one of the two, `path` or `content_base64`' WHEN k = 2 THEN '`content_base64` does not decode as base64'
      WHEN k = 6 THEN '`/elsewhere/' || request_id || '` leads outside the allowed roots (/srv/docs)'
      WHEN k = 3 THEN 'no conversion is available for `.pdf`' END AS error,
    markdown, text, n_blocks FROM wanted
)
"""
_REQUEST_LIMITS = Limits()


# Six of twenty documents are asked for in an odd way, the others plainly.
_PLAIN = [None] * 13


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    doc, blank = F.col("doc_id"), F.lit(None).cast("string")
    coded = plain_base64(F.col("text"))
    path = F.concat(F.lit("/elsewhere/d"), doc.cast("string"))
    documents = table(spark, sf, "documents", "doc_id", "text").select(
        F.concat(F.lit("d"), doc.cast("string")).alias("request_id"),
        _pick(doc, None, "", None, None, None, path, path, *_PLAIN).alias("path"),
        _pick(doc, coded, None, F.concat(coded, F.lit("\n")), coded, coded, coded, None, *[coded] * len(_PLAIN)).alias("content_base64"),
        _pick(doc, "a.txt", "a.txt", "a.txt", "a.pdf", "a.TEXT", "a.txt", "a.txt", *["a.txt"] * len(_PLAIN)).alias("filename"),
    )
    pages = table(spark, sf, "pages", "page_id", "html").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("request_id"), blank.alias("path"),
        plain_base64(F.col("html")).alias("content_base64"), F.lit("page.html").alias("filename"),
    )
    return documents.unionByName(pages).select(
        "*", blank.alias("mime"), F.lit(None).cast("bigint").alias("size_bytes"), blank.alias("blob_sha256"),
        F.lit('{"ocr": false}').alias("options"),
    )


def _no_files(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "path string, length bigint")


def _made(spark: SparkSession, sf: str) -> DataFrame:
    documents = admit(parse_requests(_requests(spark, sf)), _no_files(spark), _REQUEST_LIMITS, ["/srv/docs"])
    return outcomes(documents, _REQUEST_LIMITS)


@query(_REQUESTS_SQL + """
SELECT request_id, error_code, error, CASE WHEN error IS NULL THEN markdown END AS markdown, CASE WHEN error IS NULL THEN text END AS text,
  CASE WHEN error IS NULL THEN n_blocks END::INT AS element_count, CASE WHEN error IS NULL THEN false END AS truncated FROM outcome
""")
def corpus_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job over inline requests of every kind."""
    return _made(spark, sf).select(
        "request_id", "error.error_code", "error.error", "result.markdown", "result.text",
        "result.metadata.element_count", "result.truncated",
    )


@query(r"""
SELECT 'd' || doc_id AS request_id, CASE doc_id % 20 WHEN 1 THEN '' WHEN 5 THEN '/elsewhere/d' || doc_id WHEN 6 THEN '/elsewhere/d' || doc_id END AS path,
  CASE doc_id % 20 WHEN 3 THEN 'a.pdf' WHEN 4 THEN 'a.TEXT' ELSE 'a.txt' END AS filename,
  CASE WHEN doc_id % 20 NOT IN (1, 6) THEN strlen(to_base64(encode(text))) + CASE doc_id % 20 WHEN 2 THEN 1 ELSE 0 END END::INT AS encoded_chars,
  false AS ocr FROM documents
UNION ALL SELECT 'p' || page_id, NULL, 'page.html', strlen(to_base64(encode(html)))::INT, false FROM pages
""")
def request_load(spark: SparkSession, sf: str) -> DataFrame:
    """Requests written as JSON lines, then read by their schema."""
    folder = work_dir(spark, "requests")
    _requests(spark, sf).write.json(folder)
    return load_requests(spark, folder).select(
        "request_id", "path", "filename", F.length("content_base64").alias("encoded_chars"),
        F.try_variant_get("options", "$.ocr", "boolean").alias("ocr"),
    )


def _sunk(spark: SparkSession, sf: str) -> tuple[str, str]:
    results, errors = work_dir(spark, "results"), work_dir(spark, "errors")
    run_corpus(parse_requests(_requests(spark, sf)), _no_files(spark), _REQUEST_LIMITS, ["/srv/docs"], results, errors, "2024-01-01")
    return results, errors


@query(_REQUESTS_SQL + """
SELECT request_id, markdown, text, n_blocks::INT AS element_count, '2024-01-01' AS run_date FROM outcome WHERE error IS NULL
""")
def results_sink(spark: SparkSession, sf: str) -> DataFrame:
    results, _ = _sunk(spark, sf)
    return spark.read.parquet(results).select(
        "request_id", "markdown", "text", "metadata.element_count", F.col("run_date").cast("string").alias("run_date")
    )


@query(_REQUESTS_SQL + "SELECT request_id, error_code, error, '' AS missing, '2024-01-01' AS run_date FROM outcome WHERE error IS NOT NULL")
def errors_sink(spark: SparkSession, sf: str) -> DataFrame:
    _, errors = _sunk(spark, sf)
    return spark.read.parquet(errors).select(
        "request_id", "error_code", "error", F.array_join("missing_dependencies", ";").alias("missing"),
        F.col("run_date").cast("string").alias("run_date"),
    )


@F.pandas_udf(BinaryType())
def _packed(key: pd.Series, text: pd.Series) -> pd.Series:
    """Each text as an archive whose members are its lines: a zip for even keys, a compressed tar for odd ones."""
    def pack(key: int, text: str) -> bytes:
        out = io.BytesIO()
        members = [(f"lines/{i:05d}.txt", line.encode()) for i, line in enumerate(text.split("\n"))]
        if key % 2 == 0:
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                for name, content in members:
                    archive.writestr(name, content)
        else:
            with tarfile.open(fileobj=out, mode="w:gz", compresslevel=1) as archive:
                for name, content in members:
                    info = tarfile.TarInfo(name)
                    info.size = len(content)
                    archive.addfile(info, io.BytesIO(content))
        return out.getvalue()

    return pd.Series([pack(k, t) for k, t in zip(key, text)])


def _archives(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents", "doc_id", "text")
    return documents.select(
        F.col("doc_id").cast("string").alias("archive_id"),
        F.when(F.col("doc_id") % 10 == 7, F.encode("text", "UTF-8")).otherwise(_packed("doc_id", "text")).alias("content"),
        F.when(F.col("doc_id") % 2 == 0, "a.zip").otherwise("a.tgz").alias("filename"),
        F.lit("{}").alias("option_key"),
    )


_LINE_MEMBERS_SQL = """
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE doc_id % 10 <> 7),
members AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS n, len(l) AS total FROM split
)
"""


@query(_LINE_MEMBERS_SQL + """
SELECT doc_id::VARCHAR AS archive_id, CASE WHEN doc_id % 2 = 0 THEN 'zip' ELSE 'tar' END AS format, n::INT AS ordinal,
  'lines/' || lpad(n::VARCHAR, 5, '0') || '.txt' AS name, 'file' AS kind, strlen(line)::BIGINT AS declared_size, line AS text
FROM members WHERE total <= 512
""")
def archive_scan(spark: SparkSession, sf: str) -> DataFrame:
    return _good_members(explode_archives(_archives(spark, sf), Limits()))


def _good_members(members: DataFrame) -> DataFrame:
    judged = judge_members(members, Limits())
    return judged.filter(F.col("refusal").isNull()).select(
        "archive_id", "format", "ordinal", "name", "kind", "declared_size", as_text(F.col("content")).alias("text")
    )


def _archive_files(spark: SparkSession, sf: str) -> DataFrame:
    """The archives written as files into the shared folder, each by the task that packed it; gives their locations."""
    folder = work_dir(spark, "archive-files")
    store, path = FileSystem.from_uri(folder) if "://" in folder else (None, folder.removeprefix("file:"))
    if store is None or isinstance(store, LocalFileSystem):
        Path(path).mkdir(parents=True)
    lead = path if store is None else folder

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = []
            for name, content in zip(batch.column("archive_id").to_pylist(), batch.column("content").to_pylist()):
                places.append(f"{lead}/{name}")
                target, at = store_and_path(places[-1])
                with target.open_output_stream(at) as out:
                    out.write(content)
            yield pa.record_batch([batch.column("archive_id"), batch.column("filename"), pa.array(places, pa.string())], names=["archive_id", "filename", "location"])

    return through_table(_archives(spark, sf).mapInArrow(write, "archive_id string, filename string, location string"), "archive-places")


@query(_LINE_MEMBERS_SQL + """
SELECT doc_id::VARCHAR AS archive_id, CASE WHEN doc_id % 2 = 0 THEN 'zip' ELSE 'tar' END AS format, n::INT AS ordinal,
  'lines/' || lpad(n::VARCHAR, 5, '0') || '.txt' AS name, 'file' AS kind, strlen(line)::BIGINT AS declared_size, line AS text
FROM members WHERE total <= 512
""")
def archive_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Archives in files: the directory of each is read first, then its members one by one, by any task."""
    return _good_members(explode_located(_archive_files(spark, sf), Limits()))


@query("""
SELECT doc_id::VARCHAR AS archive_id, CASE WHEN reason IS NOT NULL THEN 'input_rejected' END AS error_code, reason AS error FROM (
  SELECT doc_id, CASE WHEN doc_id % 10 = 7 THEN '`a.tgz` cannot be read as a zip or tar archive'
    WHEN len(string_split(text, chr(10))) > 20 AND doc_id % 2 = 0 THEN 'archive holds ' || len(string_split(text, chr(10))) || ' members, 20 are allowed'
    WHEN len(string_split(text, chr(10))) > 20 THEN CASE WHEN list_sum([strlen(x) for x in string_split(text, chr(10))[1:20]]) > 3000
      THEN 'archive grows beyond the 3000-byte limit' ELSE 'archive holds more than 20 members' END
    WHEN strlen(replace(text, chr(10), '')) > 3000 THEN 'archive grows beyond the 3000-byte limit' END AS reason FROM documents)
""")
def archive_scan_verdict(spark: SparkSession, sf: str) -> DataFrame:
    limits = Limits(max_archive_members=20, max_archive_bytes=3000)
    return archive_verdict(explode_archives(_archives(spark, sf), limits), limits)


@query(_LINE_MEMBERS_SQL + r"""
, texts AS (
  SELECT doc_id, n, total, 'lines/' || lpad(n::VARCHAR, 5, '0') || '.txt' AS name, trim(line) AS line FROM members
)
SELECT doc_id::VARCHAR AS request_id, string_agg('# ' || name || E'\n\n' || line, E'\n\n' ORDER BY n) AS markdown,
  count(*)::INT AS sources, NULL AS error_code
FROM texts WHERE line <> '' AND total <= 512 GROUP BY doc_id
UNION ALL SELECT doc_id::VARCHAR, '', 0, NULL FROM texts GROUP BY doc_id HAVING max(total) <= 512 AND max(line) = ''
UNION ALL SELECT doc_id::VARCHAR, NULL, NULL, 'input_rejected' FROM texts GROUP BY doc_id HAVING max(total) > 512
UNION ALL SELECT doc_id::VARCHAR, NULL, NULL, 'input_rejected' FROM documents WHERE doc_id % 10 = 7
""".replace("\\n", "\n"))
def archive_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Archives through the whole job: members, verdict, conversion, merge."""
    documents = with_suffix(_archives(spark, sf)).select(
        F.col("archive_id").alias("request_id"), "filename", "suffix", "content", "option_key",
        F.lit(None).cast("struct<error_code:string,error:string,missing_dependencies:array<string>>").alias("error"),
    )
    return outcomes(documents, Limits()).select(
        "request_id", "result.markdown", F.array_size("result.metadata.sources").alias("sources"), "error.error_code"
    )


@query(r"""
SELECT doc_id::VARCHAR AS request_id, '# a.pdf' || chr(10) || chr(10) || coalesce(text, '') AS markdown, NULL::VARCHAR AS error_code FROM documents
""")
def corpus_hook_once(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of a converter's family through the job, each distinct content converted one time."""
    documents = table(spark, sf, "documents", "doc_id", "text").select(
        F.col("doc_id").cast("string").alias("request_id"), F.lit("a.pdf").alias("filename"), F.when(F.col("doc_id") >= 0, ".pdf").alias("suffix"),
        F.encode("text", "UTF-8").alias("content"), F.lit("{}").alias("option_key"),
        F.lit(None).cast("struct<error_code:string,error:string,missing_dependencies:array<string>>").alias("error"),
    )
    made = outcomes(documents, Limits(), factory=line_converter, families=["pdf"], tag="lines", once=True)
    return made.select("request_id", "result.markdown", "error.error_code")
