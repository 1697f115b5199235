"""Documents to blocks, elements, Markdown and text.

Every step works inside a document's row: no shuffle, however large the
corpus and however uneven its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import export
from leafmill.functions.lines import asciidoc_blocks, csv_blocks, markdown_blocks, text_blocks
from leafmill.functions.markup import html_blocks, no_blocks, xml_blocks

BLOCKS_BY_FAMILY = {
    "html": html_blocks,
    "markdown": markdown_blocks,
    "asciidoc": asciidoc_blocks,
    "text": text_blocks,
    "csv": csv_blocks,
    "xml": xml_blocks,
}


def blocks_of(family: Column, text: Column) -> Column:
    """Blocks of a text by its family; only the matching branch is evaluated."""
    chosen = F.when(F.lit(False), no_blocks())
    for name, blocks in BLOCKS_BY_FAMILY.items():
        chosen = chosen.when(family == name, blocks(text))
    return chosen.otherwise(no_blocks())


def extract(df: DataFrame, blocks: Column) -> DataFrame:
    """Add ``elements``, ``markdown`` and ``text`` made from one ``blocks`` expression.

    ``blocks`` is a column of its own below them, so it is computed once.
    """
    return (
        df.withColumn("_blocks", blocks)
        .withColumn("elements", export.number_blocks(F.col("_blocks")))
        .withColumn("markdown", export.to_markdown(F.col("_blocks")))
        .withColumn("text", export.to_text(F.col("_blocks"), F.col("markdown")))
        .drop("_blocks")
    )


def _exploded(df: DataFrame, values: Column, keys: tuple[str, ...]) -> DataFrame:
    """One row per value, numbered from 0.

    The outer form with a filter after it, since for the inner form the
    optimizer adds a test of the array below, and makes the array twice.
    """
    numbered = df.select(*keys, F.posexplode_outer(values).alias("seq", "b"))
    return numbered.filter(F.col("seq").isNotNull())


def block_rows(df: DataFrame, blocks: Column, *keys: str) -> DataFrame:
    """One row per block, with its place in the document as ``seq``."""
    return _exploded(df, blocks, keys).select(
        *keys, "seq", F.concat(F.lit("#/blocks/"), F.col("seq").cast("string")).alias("id"), "b.category", "b.level", "b.text"
    )


def element_rows(df: DataFrame, *keys: str) -> DataFrame:
    """One row per element of the ``elements`` column."""
    return _exploded(df, F.col("elements"), keys).select(*keys, "seq", "b.*")
