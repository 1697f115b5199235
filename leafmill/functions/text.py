"""Text primitives: white space, UTF-8 budgets, JSON sizes, entities."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.fixed import SPACES

# Noncharacters: Unicode keeps them for a program's own use, so no document
# text is lost by reserving them as block marks.
MARK, MARK_ATTR, MARK_END = chr(0xFDD0), chr(0xFDD1), chr(0xFDD2)

_REPLACEMENT = chr(0xFFFD)
_BYTE_ORDER_MARK = chr(0xFEFF)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body``.

    Expressions have no variables: naming a costly one twice runs it twice,
    and twice again at each level above.
    """
    return F.get(F.transform(F.array(value), body), 0)


def as_text(content: Column) -> Column:
    """Bytes as text: bad UTF-8 becomes U+FFFD, a byte-order mark goes."""
    return F.regexp_replace(F.make_valid_utf8(content.cast("string")), rf"\A{_BYTE_ORDER_MARK}", "")


def without_marks(text: Column) -> Column:
    """Text without the reserved characters.  Looking for them is far cheaper than the rare removal."""
    marks = (MARK, MARK_ATTR, MARK_END)

    def removed(text: Column) -> Column:
        found = reduce(lambda a, b: a | b, (F.contains(text, F.lit(mark)) for mark in marks))
        return F.when(found, F.translate(text, "".join(marks), "")).otherwise(text)

    return let(text, removed)


def strip(text: Column) -> Column:
    """Trim Unicode white space at both ends; only the ends are looked at."""
    return F.btrim(text, F.lit(SPACES))


# Latin-1 characters listed one by one become a bit set in the regex engine;
# the others are looked for only in texts that have something in their range.
_LATIN_SPACE = r"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
_FAR_SPACE = r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_FAR_RANGE = r"[\x{1680}-\x{3000}]"


def squeeze(text: Column) -> Column:
    """Each run of white space becomes one space."""
    def squeezed(text: Column) -> Column:
        wide = F.regexp_replace(text, f"[{_LATIN_SPACE}{_FAR_SPACE}]+", " ")
        return F.when(text.rlike(_FAR_RANGE), wide).otherwise(F.regexp_replace(text, f"[{_LATIN_SPACE}]+", " "))

    return let(text, squeezed)


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit("")) == ""


def clip_utf8(text: Column, budget: Column | int) -> Column:
    """The longest prefix of whole characters that fits ``budget`` UTF-8 bytes.

    A character is at most four bytes, so the cut moves back over at most
    three continuation bytes (80..BF).
    """
    budget = F.greatest(F.lit(budget) if isinstance(budget, int) else budget, F.lit(0)).cast("int")
    raw = text.cast("binary")

    def continues(back: int) -> Column:
        byte = F.hex(F.substring(raw, budget + F.lit(1 - back), F.lit(1)))
        return (byte >= "80") & (byte < "C0")

    back = (
        F.when(~continues(0), 0).when(~continues(1), 1).when(~continues(2), 2).otherwise(3)
    )
    cut = F.substring(raw, F.lit(1), budget - back).cast("string")
    return F.when(F.octet_length(text) <= budget, text).otherwise(cut)


def fits_utf8(text: Column, budget: Column | int) -> Column:
    """Whether ``clip_utf8`` leaves the text whole."""
    budget = F.lit(budget) if isinstance(budget, int) else budget
    return F.octet_length(text) <= F.greatest(budget, F.lit(0))


def json_length(text: Column) -> Column:
    """Length of a string as ASCII-escaped JSON, quotes included.

    Printable ASCII is itself, a quote, a backslash and the five named controls
    take two characters, all else six, or twelve beyond the first plane.
    """
    def measured(text: Column) -> Column:
        special = F.regexp_count(text, F.lit(r"[^ !#-\[\]-~]"))
        lettered = F.regexp_count(text, F.lit(r'["\\\n\r\t\x08\f]'))
        # A character beyond the first plane takes two units in UTF-16.
        pairs = F.octet_length(F.encode(text, "UTF-16BE")) / 2 - F.length(text)
        return F.length(text) + 2 + let(
            special, lambda n: F.when(n == 0, 0).otherwise(n * 5 - lettered * 4 + pairs.cast("int") * 6)
        )

    return let(text, measured)


def _numeric_entity(body: Column) -> Column:
    """``#8364`` or ``#x20ac`` to its character; unusable code points become U+FFFD."""
    digits = F.regexp_extract(body, "(?i)^#0*([0-9]{1,7})$", 1)
    hex_digits = F.regexp_extract(body, "(?i)^#x0*([0-9a-f]{1,6})$", 1)
    point = F.coalesce(F.nullif(digits, F.lit("")), F.conv(F.nullif(hex_digits, F.lit("")), 16, 10)).cast("int")

    def character(point: Column) -> Column:
        usable = (
            point.between(1, 0x10FFFF) & ~point.between(0xD800, 0xDFFF) & ~point.between(0xFDD0, 0xFDEF)
        )
        return F.when(usable, F.decode(F.unhex(F.lpad(F.hex(point.cast("long")), 8, "0")), "UTF-32")).otherwise(
            _REPLACEMENT
        )

    return let(point, character)


# The references nearly all texts make do with; ``amp`` has to be last.
_COMMON = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\xa0", "amp": "&"}
_UNCOMMON = r"&(?:#|(?!(?:" + "|".join(_COMMON) + r");)[0-9A-Za-z]+;)"


def decode_entities(text: Column, names: dict[str, int] | None = None) -> Column:
    """Replace character references, each once: ``&amp;lt;`` gives ``&lt;``.

    ``names`` maps entity names to code points; the HTML 4 set plus ``apos``
    by default.  Unknown names stay as written.  A text with common ones only
    takes plain replacements, which cannot meet each other's results while
    ``amp`` comes last.
    """
    names = {**name2codepoint, "apos": 39} if names is None else names
    # One literal, which the optimizer turns into a map once.
    table = F.from_json(F.lit(json.dumps({name: chr(point) for name, point in names.items()})), "map<string,string>")

    def piece(p: Column) -> Column:
        body = F.substring(p, F.lit(2), F.length(p) - 2)
        meant = F.when(p.startswith("&#"), let(body, _numeric_entity)).otherwise(F.try_element_at(table, body))
        return F.when(p.startswith("&") & (F.length(p) > 1), F.coalesce(meant, p)).otherwise(p)

    def decoded(text: Column) -> Column:
        pieces = F.regexp_extract_all(text, F.lit("&#?[0-9A-Za-z]+;|&|[^&]+"), F.lit(0))
        common = reduce(lambda t, name: F.replace(t, F.lit(f"&{name};"), F.lit(_COMMON[name])), _COMMON, text)
        return (
            F.when(~F.contains(text, F.lit("&")), text)
            .when(text.rlike(_UNCOMMON), F.array_join(F.transform(pieces, piece), ""))
            .otherwise(common)
        )

    return let(text, decoded)
