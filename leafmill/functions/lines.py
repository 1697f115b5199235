"""Markdown, AsciiDoc, plain text and CSV to blocks.

Each format is one regular expression whose alternatives eat whole lines: a
match is a block.  Runs use possessive repeats, which the regex engine walks
in a loop, so a run of any length is safe.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill import fixed
from leafmill.functions.markup import block, no_blocks
from leafmill.functions.tables import table_markdown
from leafmill.functions.text import let, strip

# White space inside a line.
_GAP = r"[\t\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_BLANK = rf"{_GAP}*+\n"

# The line rules.
_MD_FENCE = r"\x20{0,3}```[^\n]*\n"
_MD_HEADING = r"#{1,6}[ \t]+[^\n]*\n"
_MD_ITEM = r"[ \t]*(?:[-*+]|\d+[.)])[ \t]+[^\n]*\n"
_MD_ROW = r"[ \t]*\|[^\n]*\|[ \t]*\n"
_ADOC_FENCE = r"-{4,}[ \t]*\n"
_ADOC_HEADING = r"={1,6}[ \t]+[^\n]*\n"
_ADOC_ITEM = r"[ \t]*(?:\*{1,5}|\.{1,5}|-)[ \t]+[^\n]*\n"
_ADOC_TABLE = r"\|===[^\n]*\n"


def _fenced(fence: str) -> str:
    """A fence line, the lines up to the next one, and that one if it is there."""
    return rf"{fence}(?:(?!{fence})[^\n]*\n)*+(?:{fence})?"


def _run_of_none(*rules: str) -> str:
    return rf"(?:(?!{'|'.join(rules)})[^\n]*\n)++"


_MD_BLOCK = "|".join((
    _fenced(_MD_FENCE), _MD_HEADING, _MD_ITEM, rf"(?:{_MD_ROW})++",
    _run_of_none(_MD_FENCE, _MD_HEADING, _MD_ITEM, _MD_ROW, _BLANK),
))
_ADOC_BLOCK = "|".join((
    _fenced(_ADOC_FENCE), _fenced(_ADOC_TABLE), _ADOC_HEADING, _ADOC_ITEM,
    _run_of_none(_ADOC_FENCE, _ADOC_TABLE, _ADOC_HEADING, _ADOC_ITEM, _BLANK),
))
_PARAGRAPH = _run_of_none(_BLANK)


def _unix_lines(text: Column) -> Column:
    return F.concat(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\n"))


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _with_text(blocks: Column) -> Column:
    return F.filter(blocks, lambda b: F.coalesce(strip(b["text"]), F.lit("")) != "")


def _heading(lines: Column, mark: str) -> Column:
    level = F.length(F.regexp_extract(lines, rf"\A({mark}+)", 1))
    title = F.when(level == 1, fixed.TITLE).otherwise(fixed.SECTION_HEADER)
    return block(title, strip(F.regexp_replace(lines, rf"\A{mark}+", "")), level)


def _fence_body(lines: Column, fence: str) -> Column:
    """What lies between two fence lines, without its last line end."""
    inner = F.regexp_replace(F.regexp_replace(lines, rf"\A{fence}", ""), rf"(?<=\n|\A){fence}\z", "")
    return F.regexp_replace(inner, r"\n\z", "")


def text_blocks(text: Column) -> Column:
    """Plain text to paragraphs, which blank lines part."""
    return _with_text(
        F.transform(_matches(_unix_lines(text), _PARAGRAPH), lambda lines: block(fixed.TEXT, strip(lines)))
    )


def markdown_blocks(text: Column) -> Column:
    def parse(lines: Column) -> Column:
        return (
            F.when(lines.rlike(rf"\A{_MD_FENCE}"),
                   block(fixed.TEXT, _fence_body(lines, _MD_FENCE), fenced=F.lit(True)))
            .when(lines.rlike(rf"\A{_MD_HEADING}"), _heading(lines, "#"))
            .when(lines.rlike(rf"\A{_MD_ITEM}"),
                  block(fixed.LIST_ITEM, strip(F.regexp_replace(lines, r"\A[ \t]*(?:[-*+]|\d+[.)])[ \t]+", ""))))
            .when(lines.rlike(rf"\A{_MD_ROW}"), block(fixed.TABLE, table_markdown(_pipe_rows(lines))))
            .otherwise(block(fixed.TEXT, strip(lines)))
        )

    return _with_text(F.transform(_matches(_unix_lines(text), _MD_BLOCK), parse))


def _pipe_rows(lines: Column) -> Column:
    """The cells of a pipe table; the rule below the header is not a row."""
    def cells(row: Column) -> Column:
        inner = F.regexp_replace(strip(row), r"\A\||(?<!\\)\|\z", "")
        return F.transform(
            F.split(inner, r"(?<!\\)\|"), lambda cell: F.replace(strip(cell), F.lit("\\|"), F.lit("|"))
        )

    rows = F.split(F.regexp_replace(lines, r"\n\z", ""), "\n")
    rule = r"\A[ \t]*\|?[ \t]*:?-+:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)*+\|?[ \t]*\z"
    return F.transform(F.filter(rows, lambda row, i: ~((i == 1) & row.rlike(rule))), cells)


def asciidoc_blocks(text: Column) -> Column:
    def parse(lines: Column) -> Column:
        return (
            F.when(lines.rlike(rf"\A{_ADOC_FENCE}"),
                   block(fixed.TEXT, _fence_body(lines, _ADOC_FENCE), fenced=F.lit(True)))
            .when(lines.rlike(rf"\A{_ADOC_TABLE}"), block(fixed.TABLE, table_markdown(_adoc_rows(lines))))
            .when(lines.rlike(rf"\A{_ADOC_HEADING}"), _heading(lines, "="))
            .when(lines.rlike(rf"\A{_ADOC_ITEM}"),
                  block(fixed.LIST_ITEM, strip(F.regexp_replace(lines, r"\A[ \t]*(?:\*{1,5}|\.{1,5}|-)[ \t]+", ""))))
            .otherwise(block(fixed.TEXT, strip(lines)))
        )

    return _with_text(F.transform(_matches(_unix_lines(text), _ADOC_BLOCK), parse))


def _adoc_rows(lines: Column) -> Column:
    """Cells of a ``|===`` table.

    The first line with cells tells the number of columns; cells may then
    stand on one line or on lines of their own.
    """
    def cells(line: Column) -> Column:
        return F.transform(
            F.filter(F.split(line, r"(?<!\\)\|"), lambda _, i: i > 0),
            lambda cell: F.replace(strip(cell), F.lit("\\|"), F.lit("|")),
        )

    body = F.filter(F.split(_fence_body(lines, _ADOC_TABLE), "\n"), lambda line: F.contains(line, F.lit("|")))

    def chunk(rows: Column) -> Column:
        width = F.size(F.get(rows, 0))
        return let(F.flatten(rows), lambda flat: let(width, lambda w: chunks(flat, w)))

    def chunks(flat: Column, width: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(flat) - 1, width)
        return F.transform(starts, lambda start: F.slice(flat, start + 1, width))

    return let(
        F.filter(F.transform(body, cells), lambda row: F.size(row) > 0),
        lambda rows: F.when(F.size(rows) > 0, chunk(rows)).otherwise(F.array().cast("array<array<string>>")),
    )


# A quote means something only at the start of a cell.
_CSV_QUOTED = r'"((?:[^"]++|"")*+)(?:"|\z)'
_CSV_VALUE = rf'(?:{_CSV_QUOTED}[^,\n]*+|(?!")[^,\n]*+)'
_CSV_RECORD = rf"(?:{_CSV_VALUE},)*+{_CSV_VALUE}(?:\n|\z)"
_CSV_CELL = rf"{_CSV_VALUE}(?:,|\n|\z)"


def csv_rows(text: Column) -> Column:
    """CSV text to ``array<array<string>>``: quoted commas, quotes and line ends are content."""
    def cell(source: Column) -> Column:
        body = F.regexp_replace(source, r"[,\n]\z", "")
        quoted = rf"(?s)\A{_CSV_QUOTED}(.*)\z"
        inside = F.replace(F.regexp_extract(body, quoted, 1), F.lit('""'), F.lit('"'))
        return F.when(body.startswith('"'), F.concat(inside, F.regexp_extract(body, quoted, 2))).otherwise(body)

    def record(line: Column) -> Column:
        # ``\z`` in the cell rule can match nothing after the last delimiter.
        found = F.filter(_matches(line, _CSV_CELL), lambda source: source != "")
        return F.transform(found, cell)

    records = F.filter(_matches(_unix_lines(text), _CSV_RECORD), lambda line: strip(line) != "")
    return F.transform(records, record)


def csv_blocks(text: Column) -> Column:
    """CSV text to one table block; none for an empty file."""
    return let(
        table_markdown(csv_rows(text)),
        lambda table: F.when(table.isNotNull(), F.array(block(fixed.TABLE, table))).otherwise(no_blocks()),
    )
