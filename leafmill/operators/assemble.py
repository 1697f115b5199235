"""The shared output budget and the result record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import leafmill
from leafmill.functions import export
from leafmill.limits import Limits

BACKEND = "leafmill"


def apply_budget(df: DataFrame, limits: Limits, with_source: bool = False) -> DataFrame:
    """Spend one byte budget on ``markdown``, then ``text``, then ``elements``.

    The three columns are replaced by what fits and ``truncated`` is added.
    It tells of bytes only; ``metadata.cuts`` counts what the element bounds took.
    """
    if limits.max_output_bytes is None:
        return df.withColumn("truncated", F.lit(False))
    spent = (
        df.withColumn("_md", export.spend_markdown(F.col("markdown"), limits))
        .withColumn("_tx", export.spend_text(F.col("text"), F.col("_md.rest")))
        .withColumn("_kept", export.fitting_elements(F.col("elements"), F.col("_tx.rest"), with_source))
    )
    return (
        spent.withColumn("truncated", ~(F.col("_md.whole") & F.col("_tx.whole") & (F.col("_kept") == F.size("elements"))))
        .withColumn("markdown", F.col("_md.text"))
        .withColumn("text", F.col("_tx.text"))
        .withColumn("elements", F.slice("elements", F.lit(1), F.col("_kept")))
        .drop("_md", "_tx", "_kept")
    )


def result_record(filename: Column, sources: Column) -> Column:
    """The result of one request, from budgeted columns."""
    return F.struct(
        F.lit(BACKEND).alias("backend"),
        F.lit(leafmill.__version__).alias("backend_version"),
        F.col("markdown"),
        F.col("text"),
        F.col("elements"),
        F.col("warnings"),
        F.col("truncated"),
        F.struct(
            filename.alias("filename"),
            F.size("elements").alias("element_count"),
            F.col("page_count"),
            sources.alias("sources"),
            F.col("cuts").alias("cuts"),
        ).alias("metadata"),
    )


def assemble(df: DataFrame, limits: Limits, filename: str = "filename", sources: str = "sources",
             with_source: bool = False) -> DataFrame:
    """Budget the columns and add ``result``."""
    if "cuts" not in df.columns:
        df = df.withColumn("cuts", export.no_cuts())
    return apply_budget(df, limits, with_source).withColumn("result", result_record(F.col(filename), F.col(sources)))
