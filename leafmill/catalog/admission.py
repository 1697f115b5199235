"""Queries for requests, paths, payloads, names, formats and options."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.catalog.registry import query, table
from leafmill.functions.options import normalise_options, option_key as key_of, option_warnings as warnings_of
from leafmill.functions.paths import inline_suffix, is_archive, member_name, member_name_refusal
from leafmill.limits import Limits
from leafmill.operators.admission import check_request, confine, decode_inline, route, with_suffix
from leafmill.sources.files import parse_requests
from leafmill.session import work_dir

_ROOTS = ["/srv/docs", "/data", "s3a://own/in", "hdfs://node:8020/"]


def _pick(number: Column, *choices: Column | str | None) -> Column:
    """The choice at ``number`` modulo their count."""
    chosen = None
    for i, choice in enumerate(choices):
        value = choice if isinstance(choice, Column) else F.lit(choice).cast("string")
        at = F.pmod(number, F.lit(len(choices))) == i
        chosen = F.when(at, value) if chosen is None else chosen.when(at, value)
    return chosen


def plain_base64(text: Column) -> Column:
    """Base64 on one line, as requests carry it (Spark may break lines at 76 characters)."""
    return F.replace(F.base64(F.encode(text, "UTF-8")), F.lit("\r\n"), F.lit(""))


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """Requests of every well- and ill-formed kind, one per web page."""
    page = F.col("page_id")
    return table(spark, sf, "pages").select(
        "page_id",
        _pick(page, F.col("url"), None, "", F.col("url"), "").alias("path"),
        _pick(page, None, plain_base64(F.col("url")), "", F.lit("eA=="), F.lit("eA==")).alias("content_base64"),
    )


@query("""
SELECT page_id, CASE WHEN page_id % 5 IN (2, 3) THEN 'give exactly one of the two, `path` or `content_base64`' END AS request_error
FROM pages
""")
def request_check(spark: SparkSession, sf: str) -> DataFrame:
    return check_request(_requests(spark, sf)).select("page_id", "request_error")


_PATHS_SQL = """
WITH shaped AS (
  SELECT page_id, split_part(url, '/', 3) AS host,
    CASE page_id % 12 WHEN 0 THEN '/srv/docs/' || split_part(url, '/', 3) || '/a.md' WHEN 1 THEN '/srv/docs/../secret/' || page_id
      WHEN 2 THEN '/srv/docsx/' || page_id WHEN 3 THEN ' /srv/./docs//' || page_id || '/x/../y.html  '
      WHEN 4 THEN 'docs/' || page_id WHEN 5 THEN '' WHEN 6 THEN 'file:///data/' || page_id || '/' WHEN 7 THEN '/../../srv/docs'
      WHEN 8 THEN 's3a://own/in/./a//' || page_id WHEN 9 THEN 's3a://own/in/../' || page_id WHEN 10 THEN 'HDFS://node:8020/x/' || page_id ELSE 's3a://other/in/' || page_id END AS path,
    CASE page_id % 12 WHEN 0 THEN '/srv/docs/' || split_part(url, '/', 3) || '/a.md' WHEN 1 THEN '/srv/secret/' || page_id
      WHEN 2 THEN '/srv/docsx/' || page_id WHEN 3 THEN '/srv/docs/' || page_id || '/y.html'
      WHEN 6 THEN '/data/' || page_id WHEN 7 THEN '/srv/docs'
      WHEN 8 THEN 's3a://own/in/a/' || page_id WHEN 9 THEN 's3a://own/' || page_id WHEN 10 THEN 'hdfs://node:8020/x/' || page_id WHEN 11 THEN 's3a://other/in/' || page_id END AS resolved_path
  FROM pages
)
SELECT page_id, resolved_path, CASE WHEN page_id % 12 = 5 THEN 'missing `path`'
  WHEN page_id % 12 IN (1, 2, 4, 9, 11) THEN '`' || path || '` leads outside the allowed roots (/srv/docs, /data, s3a://own/in, hdfs://node:8020/)' END AS path_error
FROM shaped
"""


def _paths(spark: SparkSession, sf: str) -> DataFrame:
    page, text = F.col("page_id"), F.col("page_id").cast("string")
    return table(spark, sf, "pages").select(
        "page_id",
        _pick(
            page,
            F.concat(F.lit("/srv/docs/"), F.split_part("url", F.lit("/"), F.lit(3)), F.lit("/a.md")),
            F.concat(F.lit("/srv/docs/../secret/"), text),
            F.concat(F.lit("/srv/docsx/"), text),
            F.concat(F.lit(" /srv/./docs//"), text, F.lit("/x/../y.html  ")),
            F.concat(F.lit("docs/"), text),
            "",
            F.concat(F.lit("file:///data/"), text, F.lit("/")),
            "/../../srv/docs",
            F.concat(F.lit("s3a://own/in/./a//"), text),
            F.concat(F.lit("s3a://own/in/../"), text),
            F.concat(F.lit("HDFS://node:8020/x/"), text),
            F.concat(F.lit("s3a://other/in/"), text),
        ).alias("path"),
    )


@query(_PATHS_SQL)
def path_confinement(spark: SparkSession, sf: str) -> DataFrame:
    return confine(_paths(spark, sf), _ROOTS, resolve_links=False).drop("path")


@query("""
WITH shaped AS (
  SELECT page_id, CASE page_id % 7 WHEN 0 THEN '/root/in/' WHEN 1 THEN '/root/out/' WHEN 2 THEN '/root/docs/../out/../' WHEN 3 THEN '/root/docs/'
      WHEN 4 THEN '/linked/docs/' WHEN 5 THEN '/second/' ELSE '/linked/in/../../root/in/' END || page_id AS path,
    CASE page_id % 7 WHEN 1 THEN '/aside/deep/' WHEN 2 THEN '/aside/' WHEN 5 THEN '/aside/second/' ELSE '/root/docs/' END || page_id AS resolved_path FROM pages
)
SELECT page_id, resolved_path, CASE WHEN page_id % 7 IN (1, 2) THEN '`' || path || '` leads outside the allowed roots (/linked, /second)' END AS path_error
FROM shaped
""")
def resolved_confinement(spark: SparkSession, sf: str) -> DataFrame:
    """Real links in a folder of its own: both roots are links, ``in`` leads to a folder inside the first, ``out`` to one beside it."""
    folder = work_dir(spark, "links")
    # Its name is hidden from the result; a file system that links have, as the query is about those.
    base = Path(os.path.realpath(folder.removeprefix("file://").removeprefix("file:")))
    (base / "root" / "docs").mkdir(parents=True)
    (base / "aside" / "deep").mkdir(parents=True)
    (base / "aside" / "second").mkdir()
    (base / "root" / "in").symlink_to(base / "root" / "docs")
    (base / "root" / "out").symlink_to(base / "aside" / "deep")
    (base / "linked").symlink_to(base / "root")
    (base / "second").symlink_to(base / "aside" / "second")
    text = F.col("page_id").cast("string")
    lead = _pick(F.col("page_id"), "/root/in/", "/root/out/", "/root/docs/../out/../", "/root/docs/", "/linked/docs/", "/second/", "/linked/in/../../root/in/")
    paths = table(spark, sf, "pages").select("page_id", F.concat(F.lit(str(base)), lead, text).alias("path"))
    made = confine(paths, [f"{base}/linked", f"{base}/second"])
    return made.select("page_id", *[F.replace(c, F.lit(str(base)), F.lit("")).alias(c) for c in ("resolved_path", "path_error")])


@query(r"""
WITH coded AS (
  SELECT doc_id, to_base64(encode(text)) AS b FROM documents
), damaged AS (
  SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN b WHEN 1 THEN substr(b, 1, 8) || ' ' || substr(b, 9) WHEN 2 THEN rtrim(b, '=')
    WHEN 3 THEN '' WHEN 4 THEN b || chr(10) ELSE replace(b, 'A', '-') END AS b FROM coded
), judged AS (
  SELECT doc_id, b, regexp_full_match(b, '([A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?') AS good FROM damaged
), opened AS (
  SELECT *, CASE WHEN good THEN octet_length(from_base64(b)) END AS n FROM judged
)
SELECT doc_id, CASE WHEN NOT good THEN '`content_base64` does not decode as base64' WHEN n = 0 THEN '`content_base64` holds no bytes'
  WHEN n > 2000 THEN 'inline input has ' || n || ' bytes, more than the 2000 allowed' END AS inline_error,
  CASE WHEN good THEN sha256(from_base64(b)) END AS content_sha
FROM opened
""")
def inline_payloads(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").withColumn("b", plain_base64(F.col("text")))
    damaged = documents.select(
        "doc_id",
        _pick(
            F.col("doc_id"), F.col("b"), F.concat(F.substring("b", 1, 8), F.lit(" "), F.substring("b", 9, 2147483647)),
            F.rtrim("b", F.lit("=")), "", F.concat("b", F.lit("\n")), F.replace("b", F.lit("A"), F.lit("-")),
        ).alias("content_base64"),
        F.lit(None).cast("string").alias("filename"),
    )
    opened = decode_inline(damaged, Limits(max_input_bytes=2000))
    return opened.select("doc_id", "inline_error", F.sha2("content", 256).alias("content_sha"))


@query(r"""
SELECT doc_id, CASE doc_id % 9 WHEN 0 THEN '.gz' WHEN 1 THEN '.txt' WHEN 2 THEN '.txt' WHEN 3 THEN '.PDF' WHEN 4 THEN '.txt'
  WHEN 5 THEN substr('.' || source || 'aaaaaaaaaaaaaaaaaaaa', 1, 16) WHEN 6 THEN '.txt' WHEN 7 THEN '.md' ELSE '.' || lang END AS suffix
FROM documents
""")
def inline_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    named = _pick(
        F.col("doc_id"), F.concat("source", F.lit(".tar.gz")), F.concat("source", F.lit("-noext")), F.concat(F.lit("."), "source"),
        F.concat("source", F.lit(".x\\name.PDF")), F.concat("source", F.lit(".")), F.concat(F.lit("n."), "source", F.lit("a" * 20)),
        None, F.concat("source", F.lit(".d/b.md/")), F.concat(F.lit("../"), "source", F.lit("."), "lang"),
    )
    return table(spark, sf, "documents").select("doc_id", inline_suffix(named).alias("suffix"))


@query(r"""
WITH named AS (
  SELECT page_id, CASE page_id % 12 WHEN 0 THEN 'a/' || page_id || '.md' WHEN 1 THEN './a//' || page_id || '/./c.txt' WHEN 2 THEN '/abs/' || page_id
    WHEN 3 THEN '\abs\' || page_id WHEN 4 THEN 'a\..\' || page_id WHEN 5 THEN 'a/../' || page_id WHEN 6 THEN '' WHEN 7 THEN '.'
    WHEN 8 THEN 'C:\x' || page_id WHEN 9 THEN 'a..b/' || page_id || '..' WHEN 10 THEN './' ELSE 'd\' || page_id || '\e.md' END AS name
  FROM pages
)
SELECT page_id, CASE WHEN page_id % 12 IN (6, 7, 10) THEN 'archive member has an empty name'
    WHEN page_id % 12 IN (2, 3, 8) THEN 'archive member `' || name || '` has an absolute path'
    WHEN page_id % 12 IN (4, 5) THEN 'archive member `' || name || '` takes a parent-directory step' END AS refusal,
  CASE page_id % 12 WHEN 0 THEN 'a/' || page_id || '.md' WHEN 1 THEN 'a/' || page_id || '/c.txt' WHEN 9 THEN 'a..b/' || page_id || '..'
    WHEN 11 THEN 'd/' || page_id || '/e.md' END AS member_path
FROM named
""")
def member_names(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("page_id").cast("string")
    named = table(spark, sf, "pages").select(
        "page_id",
        _pick(
            F.col("page_id"), F.concat(F.lit("a/"), text, F.lit(".md")), F.concat(F.lit("./a//"), text, F.lit("/./c.txt")),
            F.concat(F.lit("/abs/"), text), F.concat(F.lit("\\abs\\"), text), F.concat(F.lit("a\\..\\"), text),
            F.concat(F.lit("a/../"), text), "", ".", F.concat(F.lit("C:\\x"), text), F.concat(F.lit("a..b/"), text, F.lit("..")),
            "./", F.concat(F.lit("d\\"), text, F.lit("\\e.md")),
        ).alias("name"),
    )
    refusal = member_name_refusal(F.col("name"))
    return named.select(
        "page_id", refusal.alias("refusal"), F.when(refusal.isNull(), member_name(F.col("name"))).alias("member_path")
    )


_NAMES = (".ZIP", ".tar", ".tar.GZ", ".tgz", ".tar.bz2", ".tbz2", ".tar.xz", ".txz", ".gz", ".zip.txt", "zip", ".md", ".PDF",
          ".docx", ".weird", "", ".html", ".Csv", ".eml", ".jpeg", ".xml", ".adoc", ".tex", ".epub", ".odt", ".text")
_NAMES_SQL = "list_value(" + ", ".join(f"'{name}'" for name in _NAMES) + f")[(doc_id % {len(_NAMES)} + 1)::INT]"


def _named_documents(spark: SparkSession, sf: str) -> DataFrame:
    endings = F.array(*[F.lit(name) for name in _NAMES])
    ending = F.get(endings, F.pmod("doc_id", F.lit(len(_NAMES))).cast("int"))
    return table(spark, sf, "documents").select("doc_id", F.concat("source", ending).alias("filename"))


@query(f"""
SELECT doc_id, regexp_matches(lower(source || {_NAMES_SQL}), '\\.(zip|tar|tar\\.gz|tgz|tar\\.bz2|tbz2|tar\\.xz|txz)$') AS archive
FROM documents
""")
def archive_names(spark: SparkSession, sf: str) -> DataFrame:
    return _named_documents(spark, sf).select("doc_id", is_archive(F.col("filename")).alias("archive"))


@query(f"""
WITH formats(suffix, family) AS (VALUES ('.html','html'), ('.htm','html'), ('.xhtml','html'), ('.md','markdown'), ('.adoc','asciidoc'),
  ('.asciidoc','asciidoc'), ('.txt','text'), ('.text','text'), ('.csv','csv'), ('.xml','xml'), ('.pdf','pdf'), ('.docx','office'),
  ('.pptx','office'), ('.xlsx','office'), ('.odt','opendocument'), ('.odp','opendocument'), ('.ods','opendocument'), ('.tex','latex'),
  ('.epub','ebook'), ('.eml','email'), ('.png','image'), ('.jpg','image'), ('.jpeg','image'), ('.tiff','image'), ('.tif','image'),
  ('.bmp','image'), ('.webp','image'), ('.zip','archive'), ('.tar','archive'), ('.tar.gz','archive'), ('.tgz','archive'),
  ('.tar.bz2','archive'), ('.tbz2','archive'), ('.tar.xz','archive'), ('.txz','archive')
), named AS (
  SELECT doc_id, regexp_extract(lower(source || {_NAMES_SQL}), '(\\.tar\\.(gz|bz2|xz)|\\.[^./]+)$', 1) AS suffix FROM documents
)
SELECT doc_id, n.suffix, family, CASE WHEN family IS NULL OR family NOT IN ('html','markdown','asciidoc','text','csv','xml','archive')
  THEN 'no conversion is available for `' || CASE WHEN n.suffix = '' THEN '(no suffix)' ELSE n.suffix END || '`' END AS format_error
FROM named n LEFT JOIN formats f ON n.suffix = f.suffix
""")
def format_routing(spark: SparkSession, sf: str) -> DataFrame:
    return route(with_suffix(_named_documents(spark, sf))).drop("filename")


_OPTIONS_SQL = """
WITH bags AS (
  SELECT event_id, CASE event_id % 9 WHEN 0 THEN '{"ocr": true, "ocr_engine": "Tesseract"}' WHEN 1 THEN '{"ocr": "true", "ocr_engine": 5}'
    WHEN 2 THEN '{"ocr_languages": ["en", "", "' || event_type || '"], "x": {"ocr": true}}' WHEN 3 THEN '{"ocr_languages": ["en", 5], "ocr": false}'
    WHEN 4 THEN '{"table_structure": false, "ocr_languages": []}' WHEN 5 THEN '{"ocr_engine": "' || event_type || '", "table_structure": 1}'
    WHEN 6 THEN props WHEN 7 THEN '[1, 2]' ELSE '{"ocr_engine": "ocrmac", "ocr_languages": ["d\\"e"], "ocr": true, "table_structure": true}' END::JSON AS o
  FROM events
), read AS (
  SELECT event_id, CASE WHEN json_type(o, '$.ocr') = 'BOOLEAN' THEN (o->>'$.ocr')::BOOLEAN END AS ocr,
    CASE WHEN json_type(o, '$.ocr_engine') = 'VARCHAR' AND lower(o->>'$.ocr_engine') IN ('easyocr','tesseract','tesserocr','rapidocr','ocrmac')
      THEN lower(o->>'$.ocr_engine') END AS ocr_engine,
    CASE WHEN json_type(o, '$.ocr_languages') = 'ARRAY'
      AND NOT list_contains([json_type(x) IS DISTINCT FROM 'VARCHAR' for x in json_extract(o, '$.ocr_languages[*]')], true)
      THEN [x->>'$' for x in json_extract(o, '$.ocr_languages[*]') if (x->>'$') <> ''] END AS languages,
    CASE WHEN json_type(o, '$.table_structure') = 'BOOLEAN' THEN (o->>'$.table_structure')::BOOLEAN END AS table_structure
  FROM bags
)
"""


def _option_bags(spark: SparkSession, sf: str) -> DataFrame:
    """Option bags of every kind, one per event, read as a request's are."""
    bags = table(spark, sf, "events").select(
        "event_id",
        _pick(
            F.col("event_id"), '{"ocr": true, "ocr_engine": "Tesseract"}', '{"ocr": "true", "ocr_engine": 5}',
            F.concat(F.lit('{"ocr_languages": ["en", "", "'), "event_type", F.lit('"], "x": {"ocr": true}}')),
            '{"ocr_languages": ["en", 5], "ocr": false}', '{"table_structure": false, "ocr_languages": []}',
            F.concat(F.lit('{"ocr_engine": "'), "event_type", F.lit('", "table_structure": 1}')), F.col("props"), "[1, 2]",
            '{"ocr_engine": "ocrmac", "ocr_languages": ["d\\"e"], "ocr": true, "table_structure": true}',
        ).alias("options"),
    )
    return parse_requests(bags).select("event_id", normalise_options(F.col("options")).alias("clean"))


@query(_OPTIONS_SQL + """
SELECT event_id, ocr, ocr_engine, array_to_string(languages, '|') AS ocr_languages, table_structure FROM read
""")
def options_normalised(spark: SparkSession, sf: str) -> DataFrame:
    return _option_bags(spark, sf).select(
        "event_id", "clean.ocr", "clean.ocr_engine", F.array_join("clean.ocr_languages", "|").alias("ocr_languages"),
        "clean.table_structure",
    )


@query(_OPTIONS_SQL + """
SELECT event_id, '{' || concat_ws(',', '"ocr":' || ocr, '"ocr_engine":"' || ocr_engine || '"',
  '"ocr_languages":[' || array_to_string([to_json(l)::VARCHAR for l in languages], ',') || ']',
  '"table_structure":' || table_structure) || '}' AS option_key FROM read
""")
def option_key(spark: SparkSession, sf: str) -> DataFrame:
    return _option_bags(spark, sf).select("event_id", key_of(F.col("clean")).alias("option_key"))


@query(_OPTIONS_SQL + """
SELECT event_id, concat_ws(';', CASE WHEN ocr THEN 'ocr ignored: text is read as it is stored, no page image is recognised' END,
  CASE WHEN ocr_engine IS NOT NULL THEN 'ocr_engine ignored: no OCR engine takes part in this conversion' END,
  CASE WHEN len(languages) > 0 THEN 'ocr_languages ignored: no OCR engine takes part in this conversion' END,
  CASE WHEN NOT table_structure THEN 'table_structure ignored: tables are always kept' END) AS warnings FROM read
""")
def option_warnings(spark: SparkSession, sf: str) -> DataFrame:
    return _option_bags(spark, sf).select("event_id", F.array_join(warnings_of(F.col("clean")), ";").alias("warnings"))
