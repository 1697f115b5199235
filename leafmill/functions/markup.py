"""HTML and XML to blocks.

One pass of a single regular expression turns a document into text with block
marks in it, a split at the marks gives the blocks.  Everything happens inside
the document's own row, so a corpus of any size needs no shuffle for it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill import fixed
from leafmill.functions.tables import MAX_COLSPAN, MAX_ROWSPAN, span_grid, table_markdown
from leafmill.functions.text import MARK, MARK_ATTR, MARK_END, decode_entities, let, squeeze, without_marks

BLOCK = "struct<category:string,level:int,text:string,fenced:boolean>"

# The tags that start a new block, open or close.
BLOCK_TAGS = (
    "h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "ul", "ol", "td", "th", "tr", "table", "pre",
    "blockquote", "figcaption", "div", "article", "section", "main", "header", "footer", "nav", "body",
)

_NAMES = "|".join(tag for tag in BLOCK_TAGS if tag not in ("td", "th"))
_HTML_TOKEN = (
    r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
    r"|<(/?)(td|th)(?![a-z0-9])([^>]*)>"
    rf"|<(/?)({_NAMES}|head|br)(?![a-z0-9])[^>]*>"
    r"|<[^>]*>|<"
)
_HEAD = rf"(?is){MARK}head{MARK_ATTR}.*?(?:{MARK}/head{MARK_ATTR}{MARK_END}|(?={MARK}body{MARK_ATTR})|\z)"
_BREAK = rf"(?i){MARK}/?(?:br|head){MARK_ATTR}{MARK_END}"
_AROUND_TABLES = rf"(?i)(?={MARK}table{MARK_ATTR})|(?<={MARK}/table{MARK_ATTR}{MARK_END})"
_NOT_TABLE_PART = rf"(?i){MARK}(?!/?t(?:able|r|d|h){MARK_ATTR})[^{MARK_END}]*{MARK_END}"


def block(category: Column | str, text: Column, level: Column | None = None, fenced: Column | None = None) -> Column:
    category = F.lit(category) if isinstance(category, str) else category
    return F.struct(
        category.alias("category"),
        (F.lit(None).cast("int") if level is None else level.cast("int")).alias("level"),
        text.alias("text"),
        (F.lit(False) if fenced is None else fenced).alias("fenced"),
    )


def no_blocks() -> Column:
    return F.array().cast(f"array<{BLOCK}>")


def _with_text(blocks: Column) -> Column:
    return F.filter(blocks, lambda b: b["text"] != "")


def html_blocks(html: Column) -> Column:
    """HTML text to ``array<BLOCK>`` in reading order; blank blocks are gone."""
    marked = F.regexp_replace(
        without_marks(html), _HTML_TOKEN, f"{MARK}$1$2$4$5{MARK_ATTR}$3{MARK_END}"
    )
    marked = F.replace(marked, F.lit(MARK + MARK_ATTR + MARK_END), F.lit(""))
    body = F.regexp_replace(F.regexp_replace(marked, _HEAD, ""), _BREAK, " ")
    ready = _without_inner_tables(squeeze(decode_entities(body)))

    def by_segment(text: Column) -> Column:
        return F.flatten(
            F.transform(
                F.split(text, _AROUND_TABLES),
                lambda segment: F.when(segment.rlike(rf"(?i)\A{MARK}table{MARK_ATTR}"), _table(segment)).otherwise(
                    _flow(segment)
                ),
            )
        )

    return let(
        ready,
        lambda text: F.when(text.rlike(rf"(?i){MARK}table{MARK_ATTR}"), by_segment(text)).otherwise(_flow(text)),
    )


def _without_inner_tables(text: Column) -> Column:
    """Tables inside a cell of another give their text to that cell."""
    def opens(piece: Column) -> Column:
        return piece.rlike(rf"(?i)\A{MARK}table{MARK_ATTR}")

    def closes(piece: Column) -> Column:
        return piece.rlike(rf"(?i){MARK}/table{MARK_ATTR}{MARK_END}\z")

    def step(state: Column, piece: Column) -> Column:
        depth = state["depth"] + opens(piece).cast("int")
        inner = F.regexp_replace(piece, rf"(?i){MARK}/?t(?:able|r|d|h){MARK_ATTR}[^{MARK_END}]*{MARK_END}", " ")
        return F.struct(
            F.greatest(depth - closes(piece).cast("int"), F.lit(0)).alias("depth"),
            F.array_append(state["out"], F.when(depth > 1, inner).otherwise(piece)).alias("out"),
        )

    def flat(pieces: Column) -> Column:
        start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(pieces, start, step, lambda state: F.array_join(state["out"], ""))

    def nested(pieces: Column) -> Column:
        """Whether a table opens before the last one ended."""
        return F.exists(
            F.transform(pieces, lambda piece, i: opens(piece) & ~closes(piece) & F.coalesce(opens(F.get(pieces, i + 1)), F.lit(False))),
            lambda found: found,
        )

    def resolved(text: Column) -> Column:
        return let(F.split(text, _AROUND_TABLES), lambda pieces: F.when(nested(pieces), flat(pieces)).otherwise(text))

    # Most texts have no table and are not split.
    return let(text, lambda t: F.when(t.rlike(rf"(?i){MARK}table{MARK_ATTR}"), resolved(t)).otherwise(t))


def _flow(text: Column) -> Column:
    """Marked text outside tables: each mark starts a block."""
    def parse(piece: Column) -> Column:
        tag = F.lower(F.substring_index(piece, MARK_ATTR, 1))
        content = F.trim(F.substring_index(piece, MARK_END, -1))
        heading = tag.rlike("^h[1-6]$")
        level = F.when(heading, F.substring(tag, 2, 1).cast("int"))
        category = (
            F.when(tag == "h1", fixed.TITLE)
            .when(heading, fixed.SECTION_HEADER)
            .when(tag == "li", fixed.LIST_ITEM)
            .when(tag.isin("td", "th"), fixed.TABLE)
            .when(tag == "figcaption", fixed.CAPTION)
            .when(tag == "footer", fixed.PAGE_FOOTER)
            .when(tag == "header", fixed.PAGE_HEADER)
            .otherwise(fixed.TEXT)
        )
        return block(category, content, level)

    pieces = F.split(F.concat(F.lit(MARK_ATTR + MARK_END), text), MARK)
    return _with_text(F.transform(pieces, parse))


def _table(segment: Column) -> Column:
    """One table to one block; text that stands in no cell comes first, as a caption."""
    def is_cell(piece: Column) -> Column:
        return piece.rlike(rf"(?i)\At[dh]{MARK_ATTR}")

    def content(piece: Column) -> Column:
        return squeeze(F.trim(F.substring_index(piece, MARK_END, -1)))

    def span(piece: Column, name: str, most: int, zero: int) -> Column:
        digits = F.regexp_extract(piece, rf"""(?i)[\s\x{{fdd1}}"']{name}\s*=\s*["']?0*([0-9]{{1,6}})""", 1)
        number = F.coalesce(F.nullif(digits, F.lit("")).cast("int"), F.lit(1))
        return let(number, lambda n: F.least(F.when(n == 0, F.lit(zero)).otherwise(n), F.lit(most)))

    def cells(row: Column) -> Column:
        return F.transform(
            F.filter(F.split(row, MARK), is_cell),
            lambda piece: F.struct(
                content(piece).alias("text"),
                span(piece, "colspan", MAX_COLSPAN, 1).alias("colspan"),
                span(piece, "rowspan", MAX_ROWSPAN, MAX_ROWSPAN).alias("rowspan"),
            ),
        )

    def parts(inner: Column) -> Column:
        rows = F.transform(F.split(inner, rf"(?i){MARK}tr{MARK_ATTR}{MARK_END}"), cells)
        # What precedes the first row mark is a row only if it holds cells.
        real = F.filter(rows, lambda row, i: (i > 0) | (F.size(row) > 0))
        outside = F.transform(F.filter(F.split(inner, MARK), lambda piece: ~is_cell(piece)), content)
        stray = F.array_join(F.filter(outside, lambda text: text != ""), " ")
        table = table_markdown(let(real, span_grid))
        return F.array(block(fixed.CAPTION, stray), block(fixed.TABLE, F.coalesce(table, F.lit(""))))

    return _with_text(let(F.regexp_replace(segment, _NOT_TABLE_PART, " "), parts))


_XML_ASIDE = r"(?s)<!--.*?-->|<\?.*?\?>|<![^>]*>"


def xml_blocks(xml: Column) -> Column:
    """XML text to ``array<BLOCK>``: every tag ends a block, CDATA is taken as it stands."""
    def escaped(section: Column) -> Column:
        """What follows a CDATA start: the data as ordinary text, then the markup after its end."""
        data = F.substring_index(section, "]]>", 1)
        rest = F.substring(section, F.length(data) + 4, F.length(section))
        safe = F.replace(F.replace(data, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return F.concat(safe, rest)

    def plain(text: Column) -> Column:
        sections = F.split(text, r"<!\[CDATA\[")
        merged = F.array_join(F.transform(sections, lambda part, i: F.when(i == 0, part).otherwise(escaped(part))), "")
        return F.when(F.contains(text, F.lit("<![CDATA[")), merged).otherwise(text)

    tags = F.regexp_replace(F.regexp_replace(let(without_marks(xml), plain), _XML_ASIDE, ""), "<[^>]*>", MARK)
    marked = squeeze(decode_entities(F.replace(tags, F.lit("<"), F.lit(""))))
    return _with_text(F.transform(F.split(marked, MARK), lambda text: block(fixed.TEXT, F.trim(text))))
