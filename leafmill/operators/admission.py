"""Admission: which requests may be converted, and as what."""

from __future__ import annotations

import os
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from leafmill import fixed
from leafmill.functions.options import normalise_options, option_key
from leafmill.functions.paths import clean_path, fold_location, fold_root, format_suffix, inline_suffix, local_form, store_of, within_roots
from leafmill.functions.payload import strict_base64
from leafmill.functions.text import let
from leafmill.limits import Limits

ERROR = "struct<error_code:string,error:string,missing_dependencies:array<string>>"


def typed_error(code: str | Column | None, message: Column, missing: Column | None = None) -> Column:
    code = F.lit(code).cast("string") if code is None or isinstance(code, str) else code
    return F.struct(
        code.alias("error_code"),
        message.alias("error"),
        (F.array().cast("array<string>") if missing is None else missing).alias("missing_dependencies"),
    )


def request_refusal() -> Column:
    """Message for a request that does not carry exactly one of path and payload.

    An empty text counts as absent.  This refusal alone has no error code.
    """
    given = F.coalesce(F.col("path"), F.lit("")) != ""
    inline = F.coalesce(F.col("content_base64"), F.lit("")) != ""
    return F.when(given == inline, F.lit("give exactly one of the two, `path` or `content_base64`"))


def check_request(requests: DataFrame) -> DataFrame:
    """Add ``request_error``, null for a well-formed request."""
    return requests.withColumn("request_error", request_refusal())


@F.pandas_udf(StringType())
def _real_path(paths: pd.Series) -> pd.Series:
    """Where a local path leads once links are followed."""
    return paths.map(os.path.realpath, na_action="ignore")


def resolved_path(path: Column, resolve_links: bool = True) -> Column:
    """The location a containment test looks at.

    Links of local paths are followed by the executors' file system, since a
    folded path may lead out of a root through one; stores have no links.
    """
    named = clean_path(path)
    folded = fold_location(named)
    if not resolve_links:
        return folded
    # ``..`` behind a link leaves where the link leads, so links come before folding.
    return F.when(store_of(named) == "", F.when(folded.isNotNull(), _real_path(local_form(named)))).otherwise(folded)


def really_within(path: Column, roots: Iterable[str]) -> Column:
    """Whether a resolved local path is a root or beneath one, where the roots' own links are followed too, in the executors."""
    local = [root for root in map(fold_root, roots) if root.startswith("/")]

    @F.pandas_udf(BooleanType())
    def inside(paths: pd.Series) -> pd.Series:
        real = [os.path.realpath(root) for root in local]
        return paths.map(lambda p: p is not None and any(p == r or p.startswith(r.rstrip("/") + "/") for r in real)).astype(bool)

    return inside(path) if local else F.lit(False)


def confine(df: DataFrame, roots: Iterable[str], resolve_links: bool = True) -> DataFrame:
    """Add ``resolved_path`` and ``path_error``; the error is null for a path inside the roots."""
    roots = list(roots)
    shown = ", ".join(roots) or "(none)"
    named = clean_path(F.col("path"))
    resolved = df.withColumn("resolved_path", resolved_path(F.col("path"), resolve_links))
    inside = within_roots(F.col("resolved_path"), roots)
    if resolve_links:
        inside = F.when(store_of(named) == "", really_within(F.col("resolved_path"), roots)).otherwise(inside)
    return resolved.withColumn(
        "path_error",
        F.when(named == "", F.lit("missing `path`"))
        .when(
            ~inside,
            F.concat(F.lit("`"), named, F.lit(f"` leads outside the allowed roots ({shown})")),
        ),
    )


def size_refusal(length: Column, limits: Limits, inline: bool = False) -> Column:
    """Message for an input over the limit, by its measured size."""
    lead = "inline input has " if inline else "input has "
    return F.when(
        length > limits.max_input_bytes,
        F.concat(F.lit(lead), length.cast("string"), F.lit(f" bytes, more than the {limits.max_input_bytes} allowed")),
    )


def size_gate(files: DataFrame, limits: Limits) -> DataFrame:
    """Files small enough to open.  The filter reaches the scan, so larger files are never read."""
    return files.filter(F.col("length") <= limits.max_input_bytes)


def decode_inline(requests: DataFrame, limits: Limits) -> DataFrame:
    """Add ``content``, ``suffix`` and ``inline_error`` for requests that carry their bytes."""
    def judged(raw: Column) -> Column:
        message = (
            F.when(raw.isNull(), F.lit("`content_base64` does not decode as base64"))
            .when(F.octet_length(raw) == 0, F.lit("`content_base64` holds no bytes"))
            .otherwise(size_refusal(F.octet_length(raw), limits, inline=True))
        )
        return F.struct(raw.alias("content"), message.alias("inline_error"))

    # One struct, bound once, so that the payload is decoded in one place of the plan.
    once = let(strict_base64(F.coalesce(F.col("content_base64"), F.lit(""))), judged)
    decoded = requests.withColumn("_decoded", once).withColumn("suffix", inline_suffix(F.col("filename")))
    return decoded.withColumns({"content": F.col("_decoded.content"), "inline_error": F.col("_decoded.inline_error")}).drop("_decoded")


def formats_df(spark: SparkSession) -> DataFrame:
    """The format dimension: one row per supported extension, in order."""
    rows = sorted(
        (suffix, family, family in fixed.BUILT_IN_FAMILIES)
        for family, suffixes in fixed.FORMAT_FAMILIES.items()
        for suffix in suffixes
    )
    return spark.createDataFrame(rows, "suffix string, family string, built_in boolean")


def route(df: DataFrame, extra_families: Iterable[str] = ()) -> DataFrame:
    """Add ``family`` and ``format_error`` from ``suffix``.

    The dimension has as many rows as there are formats, so broadcasting it
    is safe at any size.  ``extra_families`` are those a user's converter
    takes.  A format nobody takes gets a typed error that names it, never an
    empty document.
    """
    known = formats_df(df.sparkSession).select("suffix", "family")
    taken = [*fixed.BUILT_IN_FAMILIES, "archive", *extra_families]
    shown = F.coalesce(F.nullif(F.col("suffix"), F.lit("")), F.lit("(no suffix)"))
    return df.join(F.broadcast(known), "suffix", "left").withColumn(
        "format_error",
        F.when(
            ~F.coalesce(F.col("family").isin(*taken), F.lit(False)),
            F.concat(F.lit("no conversion is available for `"), shown, F.lit("`")),
        ),
    )


def with_suffix(df: DataFrame, name: str = "filename") -> DataFrame:
    return df.withColumn("suffix", format_suffix(F.coalesce(F.col(name), F.lit(""))))


def with_options(df: DataFrame) -> DataFrame:
    """Turn the VARIANT ``options`` into ``clean_options`` and ``option_key``."""
    cleaned = df.withColumn("clean_options", normalise_options(F.col("options")))
    return cleaned.withColumn("option_key", option_key(F.col("clean_options")))
