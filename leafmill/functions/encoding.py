"""Which encoding a document declares, and its bytes as text.

A byte-order mark counts first; without one, markup may declare its encoding in
its first kilobyte, in an XML declaration or an HTML ``meta`` element.  All else
is UTF-8.  Everything is an expression on the row, and only documents that
declare another encoding than UTF-8 are decoded otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.text import as_text

PROLOG_BYTES = 1024
UTF_8 = "UTF-8"
# Labels of encodings in documents, and the JVM's name of each.
# As on the web, Latin-1 and ASCII mean Windows-1252.
LABELS: dict[str, str] = {
    "utf-8": UTF_8, "utf8": UTF_8, "unicode-1-1-utf-8": UTF_8,
    "utf-16": "UTF-16LE", "utf-16le": "UTF-16LE", "utf-16be": "UTF-16BE",
    "windows-1252": "windows-1252", "cp1252": "windows-1252", "iso-8859-1": "windows-1252", "iso8859-1": "windows-1252",
    "latin1": "windows-1252", "latin-1": "windows-1252", "l1": "windows-1252", "us-ascii": "windows-1252", "ascii": "windows-1252",
    "iso-8859-2": "ISO-8859-2", "latin2": "ISO-8859-2", "iso-8859-3": "ISO-8859-3", "iso-8859-4": "ISO-8859-4",
    "iso-8859-5": "ISO-8859-5", "iso-8859-6": "ISO-8859-6", "iso-8859-7": "ISO-8859-7", "iso-8859-8": "ISO-8859-8",
    "iso-8859-9": "windows-1254", "latin5": "windows-1254", "iso-8859-13": "ISO-8859-13", "iso-8859-15": "ISO-8859-15", "latin9": "ISO-8859-15",
    "windows-1250": "windows-1250", "windows-1251": "windows-1251", "cp1251": "windows-1251", "windows-1253": "windows-1253",
    "windows-1254": "windows-1254", "windows-1255": "windows-1255", "windows-1256": "windows-1256", "windows-1257": "windows-1257",
    "windows-1258": "windows-1258", "windows-874": "x-windows-874", "tis-620": "x-windows-874", "koi8-r": "KOI8-R", "koi8-u": "KOI8-U",
    "macintosh": "x-MacRoman", "ibm866": "IBM866", "cp866": "IBM866",
    "shift_jis": "windows-31j", "shift-jis": "windows-31j", "sjis": "windows-31j", "windows-31j": "windows-31j",
    "euc-jp": "EUC-JP", "iso-2022-jp": "ISO-2022-JP", "gb2312": "GB18030", "gbk": "GB18030", "gb18030": "GB18030",
    "big5": "Big5", "euc-kr": "x-windows-949", "ks_c_5601-1987": "x-windows-949",
}
MARKUP = ("html", "xml")


def byte_order_mark(content: Column) -> Column:
    """The encoding that the first bytes tell; null without a mark.  Markup in UTF-16 tells it by its first sign too."""
    head = F.hex(F.substring(content, 1, 4))
    return (
        F.when(head.startswith("EFBBBF"), UTF_8)
        .when(head.startswith("FFFE"), "UTF-16LE").when(head.startswith("FEFF"), "UTF-16BE")
        .when(head == "3C003F00", "UTF-16LE").when(head == "003C003F", "UTF-16BE")
    )


def declared_label(content: Column, family: Column) -> Column:
    """The label that markup declares, in lower case; null without one."""
    start = F.decode(F.substring(content, 1, PROLOG_BYTES), "ISO-8859-1")
    name = r"[\"']?\s*([A-Za-z0-9._:-]+)"
    prolog = F.nullif(F.regexp_extract(start, r"\A\s*<\?xml\s[^>]{0,200}?encoding\s*=\s*" + name, 1), F.lit(""))
    meta = F.nullif(F.regexp_extract(start, r"(?i)<meta\s[^>]{0,300}?charset\s*=\s*" + name, 1), F.lit(""))
    return F.lower(F.when(family == "html", F.coalesce(meta, prolog)).when(family == "xml", prolog))


def _known(label: Column) -> Column:
    pairs = F.create_map(*[F.lit(part) for pair in LABELS.items() for part in pair])
    found = F.try_element_at(pairs, label)
    # Whoever could read the declaration as single bytes has no UTF-16 before them.
    return F.when(found.startswith("UTF-16"), UTF_8).otherwise(found)


@contextmanager
def _any_charset(spark: SparkSession) -> Iterator[None]:
    """Let ``decode`` take every encoding of the JVM, and write U+FFFD for what does not fit; read when the plan is made."""
    settings = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key in settings:
            spark.conf.set(key, "true")
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def decoded(df: DataFrame, content: str, family: str, text: str = "_text", encoding: str = "_encoding", warning: str = "_unread") -> DataFrame:
    """Add the text, the name of its encoding, and a warning where a declared one is not known (then it is read as UTF-8)."""
    mark, label = byte_order_mark(F.col(content)), declared_label(F.col(content), F.col(family))
    named = df.withColumn("_mark", mark).withColumn("_label", F.when(F.col("_mark").isNull() & F.col(family).isin(*MARKUP), label))
    known = named.withColumn(encoding, F.coalesce("_mark", _known(F.col("_label")), F.lit(UTF_8)))
    unknown = F.col("_label").isNotNull() & _known(F.col("_label")).isNull()
    told = F.when(unknown, F.concat(F.lit("unknown encoding `"), F.col("_label"), F.lit("`: read as UTF-8")))
    with _any_charset(df.sparkSession):
        other = F.regexp_replace(F.call_function("decode", F.col(content), F.col(encoding)), "\\A\ufeff", "")
        return known.withColumns({
            text: F.when(F.col(encoding) != UTF_8, other).otherwise(as_text(F.col(content))), warning: told,
        }).drop("_mark", "_label")
