"""Blocks to numbered elements, Markdown and plain text; the shared output budget."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill import fixed
from leafmill.functions.text import clip_utf8, fits_utf8, is_blank, json_length
from leafmill.limits import Limits

ELEMENT = "struct<id:string,category:string,text:string,page_number:int,level:int>"


def number_blocks(blocks: Column) -> Column:
    """Blocks to elements: the place in the document gives the id."""
    return F.transform(
        blocks,
        lambda b, i: F.struct(
            F.concat(F.lit("#/blocks/"), i.cast("string")).alias("id"),
            b["category"].alias("category"),
            b["text"].alias("text"),
            F.lit(None).cast("int").alias("page_number"),
            b["level"].alias("level"),
        ),
    )


def to_markdown(blocks: Column) -> Column:
    """Markdown that mirrors the blocks; list items in a row stay together."""
    def render(b: Column) -> Column:
        return (
            F.when(b["level"].isNotNull(), F.concat(F.repeat(F.lit("#"), b["level"]), F.lit(" "), b["text"]))
            .when(b["category"] == fixed.LIST_ITEM, F.concat(F.lit("- "), b["text"]))
            .when(b["fenced"], F.concat(F.lit("```\n"), b["text"], F.lit("\n```")))
            .otherwise(b["text"])
        )

    def joined(b: Column, i: Column) -> Column:
        before = F.get(blocks, i - 1)["category"]
        in_list = (b["category"] == fixed.LIST_ITEM) & (before == fixed.LIST_ITEM)
        gap = F.when(i == 0, "").when(in_list, "\n").otherwise("\n\n")
        return F.concat(gap, render(b))

    return F.array_join(F.transform(blocks, joined), "")


def to_text(blocks: Column, markdown: Column) -> Column:
    """Markup-free text; the Markdown stands in when there is none."""
    return text_or_markdown(F.array_join(F.transform(blocks, lambda b: b["text"]), "\n"), markdown)


def text_or_markdown(text: Column, markdown: Column) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), markdown)


def page_count(pages: Column) -> Column:
    """Number of pages; null when there are none."""
    return F.nullif(F.size(F.coalesce(pages, F.array().cast("array<int>"))), F.lit(0))


def echo_elements(elements: Column, limits: Limits) -> Column:
    """Elements as a result shows them: no blank ones; with bounds, texts clipped and the first ones only."""
    shown = F.filter(elements, lambda e: ~is_blank(e["text"]))
    if limits.max_elements is not None:
        shown = F.slice(shown, 1, max(limits.max_elements, 0))
    if limits.max_element_chars is None:
        return shown
    return F.transform(
        shown, lambda e: e.withField("text", F.substring(e["text"], 1, limits.max_element_chars))
    )


def echo_cuts(elements: Column, limits: Limits) -> Column:
    """What the bounds of ``echo_elements`` cut: ``struct(elements_dropped, texts_clipped)``."""
    told = F.filter(elements, lambda e: ~is_blank(e["text"]))
    dropped, clipped, shown = F.lit(0), F.lit(0), told
    if limits.max_elements is not None:
        shown = F.slice(told, 1, max(limits.max_elements, 0))
        dropped = F.greatest(F.size(told) - max(limits.max_elements, 0), F.lit(0))
    if limits.max_element_chars is not None:
        clipped = F.size(F.filter(shown, lambda e: F.length(e["text"]) > limits.max_element_chars))
    return F.struct(dropped.alias("elements_dropped"), clipped.alias("texts_clipped"))


def no_cuts() -> Column:
    return F.struct(F.lit(0).alias("elements_dropped"), F.lit(0).alias("texts_clipped"))


def element_bytes(element: Column, with_source: bool = False) -> Column:
    """Size of an element as ASCII JSON with ``", "`` and ``": "``, plus one for its separator."""
    def number(value: Column) -> Column:
        return F.coalesce(F.length(value.cast("string")), F.lit(4))

    # 60 is what the five keys, their quotes and the braces take.
    size = (
        F.lit(60) + json_length(element["id"]) + json_length(element["category"]) + json_length(element["text"])
        + number(element["page_number"]) + number(element["level"])
    )
    if with_source:
        size = size + F.when(element["source"].isNull(), 0).otherwise(F.lit(12) + json_length(element["source"]))
    return size + 1


def fitting_elements(elements: Column, budget: Column, with_source: bool = False) -> Column:
    """How many leading elements fit ``budget`` bytes; the first that does not fit ends the list."""
    sizes = F.transform(elements, lambda element: element_bytes(element, with_source).cast("long"))
    start = F.struct(F.lit(0).cast("long").alias("used"), F.lit(0).alias("kept"))

    def step(state: Column, size: Column) -> Column:
        # Sizes are positive, so once over the budget the sum stays over it.
        used = state["used"] + size
        return F.struct(used.alias("used"), (state["kept"] + (used <= budget).cast("int")).alias("kept"))

    return F.aggregate(sizes, start, step, lambda state: state["kept"])


def spend_markdown(markdown: Column, limits: Limits) -> Column:
    """First claim on the budget: ``struct(text, whole, rest)``."""
    return _spend(markdown, F.lit(limits.max_output_bytes))


def spend_text(text: Column, rest: Column) -> Column:
    return _spend(text, rest)


def _spend(text: Column, budget: Column) -> Column:
    clipped = clip_utf8(text, budget)
    return F.struct(
        clipped.alias("text"),
        fits_utf8(text, budget).alias("whole"),
        (budget - F.octet_length(clipped)).alias("rest"),
    )
