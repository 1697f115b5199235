"""The hook for a user's converter, and converting each distinct content once."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leafmill import fixed
from leafmill.functions import export
from leafmill.functions.failures import classify_failure, status_error, status_warnings
from leafmill.functions.options import HINTS, OPTIONS, option_warnings
from leafmill.limits import Limits
from leafmill.operators.admission import typed_error
from leafmill.operators.isolation import Died, Refused, convert_isolated
from leafmill.operators.skew import join_many_to_one
from leafmill.session import ship_package, through_table

RAW_ELEMENTS = "array<struct<id:string,category:string,text:string,pages:array<int>,level:int>>"
# What a converter gives for one document: a mapping with any of these keys.
CONVERTED = (
    "status string, errors array<string>, has_document boolean, markdown string, text string, "
    f"pages array<int>, elements {RAW_ELEMENTS}, failure_code string, failure string, missing array<string>"
)
_FIELDS = ("status", "errors", "has_document", "markdown", "text", "pages", "elements")

Converter = Callable[[str, bytes], Mapping[str, Any]]
Factory = Callable[[dict[str, Any]], Converter]


class MissingDependency(RuntimeError):
    """Raised by a factory whose options need a tool the node does not have."""

    def __init__(self, message: str, missing: list[str]) -> None:
        super().__init__(message)
        self.missing = missing


def _failure(code: str | None, text: str, missing: list[str] | None = None) -> dict[str, Any]:
    return {"failure_code": code, "failure": text, "missing": missing or []}


def _convert(factory: bytes, tag: str, key: str, name: str, content: bytes, seconds: float | None, max_bytes: int | None) -> dict[str, Any]:
    """One document's row, whatever the converter does."""
    try:
        made = convert_isolated(factory, tag, key, name, bytes(content), seconds, max_bytes)
    except Refused as exc:
        if exc.kind == "missing":
            return _failure(fixed.LIBRARY_MISSING, str(exc))
        if exc.kind == "dependency":
            return _failure(fixed.MISSING_DEPENDENCY, str(exc), exc.missing)
        return _failure(None, f"{exc.name}: {exc}")
    except TimeoutError:
        return _failure(fixed.TIMEOUT, f"the conversion ran past the {seconds:g}s limit")
    except Died as exc:
        return _failure(fixed.PARSE_FAILED, str(exc))
    row = {field: made.get(field) for field in _FIELDS}
    if row["has_document"] is None:
        row["has_document"] = row["markdown"] is not None
    return row


def _weight(row: Mapping[str, Any]) -> int:
    return len(row.get("markdown") or "") + len(row.get("text") or "") + sum(len(e.get("text") or "") + 100 for e in row.get("elements") or ())


def run_converter(df: DataFrame, factory: Factory, *keys: str, tag: str = "", timeout_secs: float | None = None,
                  max_bytes: int | None = None, flush_chars: int = 16 << 20) -> DataFrame:
    """``(keys..., name, content, option_key)`` to ``(keys..., name, CONVERTED)``.

    Rows stay in their partitions: option keys are few and very uneven, so a
    shuffle on them would put most documents into one task.  Each worker
    keeps a child process per option key it meets, with the converter in it.  A document that
    takes longer than ``timeout_secs`` or more memory than ``max_bytes`` fails alone, and
    its process is gone; outputs leave in portions of about ``flush_chars``.
    """
    packed = cloudpickle.dumps(factory)
    carried = [*keys, "name"]
    made_fields = StructType.fromDDL(CONVERTED)
    schema = StructType([*df.select(*carried).schema, *made_fields])

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def portion(rows: pd.DataFrame, made: list[dict[str, Any]]) -> pd.DataFrame:
            out = rows[carried].copy()
            for column in made_fields.names:
                out[column] = [row.get(column) for row in made]
            return out

        for batch in batches:
            start, made, size = 0, [], 0
            for i, (key, name, content) in enumerate(zip(batch["option_key"], batch["name"], batch["content"])):
                made.append(_convert(packed, tag, key, name, content, timeout_secs, max_bytes))
                size += _weight(made[-1])
                if size >= flush_chars or i + 1 == len(batch):
                    yield portion(batch.iloc[start : i + 1], made)
                    start, made, size = i + 1, [], 0

    ship_package(df.sparkSession)
    needed = dict.fromkeys([*carried, "content", "option_key"])
    return df.select(*needed).mapInPandas(convert, schema)


def map_status(converted: DataFrame, prefix: str = "converter: ") -> DataFrame:
    """Add ``error`` (a typed error or null) and ``warnings`` from a converter's raw outcome."""
    name = F.col("name")
    raised = F.col("failure").isNotNull()
    code = F.coalesce("failure_code", classify_failure(F.col("failure")))
    lead = (
        F.when(F.col("failure_code").isNotNull(), F.lit(""))
        .when(code == fixed.UNSUPPORTED_FORMAT, F.concat(F.lit("the converter does not take `"), name, F.lit("`: ")))
        .otherwise(F.concat(F.lit("parsing `"), name, F.lit("` failed: ")))
    )
    unusable = status_error(F.col("status"), F.col("errors"), F.coalesce("has_document", F.lit(False)), name)
    missing = F.coalesce("missing", F.array().cast("array<string>"))
    return converted.withColumn(
        "error",
        F.when(raised, typed_error(code, F.concat(lead, F.col("failure")), missing)).when(
            unusable.isNotNull(), typed_error(fixed.PARSE_FAILED, unusable)
        ),
    ).withColumn(
        "warnings",
        F.when(F.col("error").isNull(), status_warnings(F.col("status"), F.col("errors"), prefix)).otherwise(
            F.array().cast("array<string>")
        ),
    )


def first_page(element: Column) -> Column:
    """The page of an element's first provenance record."""
    return F.get(element["pages"], 0)


def convert_with(df: DataFrame, factory: Factory, limits: Limits, *keys: str, tag: str = "",
                 prefix: str = "converter: ") -> DataFrame:
    """Run a user's converter and bring its outcome to the common columns.

    A factory may name the hints it follows in an attribute ``honoured``; the
    others leave a warning.  Without it, it is taken to follow all.

    Gives ``keys, name, markdown, text, elements, cuts, page_count, warnings, error``.
    """
    carried = dict.fromkeys([*keys, "option_key"])
    mapped = map_status(run_converter(df, factory, *carried, tag=tag, timeout_secs=limits.timeout_secs, max_bytes=limits.max_converter_bytes), prefix)
    honoured = getattr(factory, "honoured", HINTS)
    hints = F.when(F.col("error").isNull(), option_warnings(F.from_json("option_key", OPTIONS), honoured))
    elements = F.transform(
        F.coalesce("elements", F.array().cast(RAW_ELEMENTS)),
        lambda e: F.struct(
            F.coalesce(e["id"], F.lit("")).alias("id"),
            F.coalesce(e["category"], F.lit("")).alias("category"),
            F.coalesce(e["text"], F.lit("")).alias("text"),
            first_page(e).alias("page_number"),
            e["level"].alias("level"),
        ),
    )
    markdown = F.coalesce("markdown", F.lit(""))
    return mapped.select(
        *keys,
        "name",
        markdown.alias("markdown"),
        export.text_or_markdown(F.col("text"), markdown).alias("text"),
        export.echo_elements(elements, limits).alias("elements"),
        export.echo_cuts(elements, limits).alias("cuts"),
        export.page_count(F.col("pages")).alias("page_count"),
        F.concat(F.coalesce(hints, F.array().cast("array<string>")), "warnings").alias("warnings"),
        "error",
    )


def convert_once(df: DataFrame, convert: Callable[[DataFrame], DataFrame], row_id: str, beside: DataFrame | None = None) -> DataFrame:
    """Run ``convert`` once per distinct content, suffix and options, and give every row its outcome.

    ``df`` has ``row_id, content, suffix, option_key`` and what ``convert``
    reads; ``row_id`` is unique.  Null contents are equal to each other, and so
    are null suffixes and option keys: such rows come back too.  ``convert`` keeps the columns ``content_sha, suffix, option_key,
    copies``.  Worth its shuffles when converting costs more than moving a
    document.

    Contents are hashed in one pass that moves only hashes; copies are counted
    before the shuffle; only one row per distinct content is moved; outcomes
    return through a join that spreads contents with very many copies.
    ``beside`` has small columns to return with each row; they join its hash, so
    outcomes are not moved again for them, and replace the converter's of that name.
    """
    keys = ["content_sha", "suffix", "option_key"]
    # Keys without nulls, for the joins: a value gets a mark in front, null is the empty string.
    hashed = through_table(df.select(row_id, *[
        F.coalesce(F.concat(F.lit("="), value), F.lit("")).alias(name)
        for name, value in zip(keys, (F.sha2("content", 256), F.col("suffix"), F.col("option_key")))
    ]), "hashes")
    firsts = through_table(
        hashed.groupBy(*keys).agg(F.min(row_id).alias(row_id), F.count(F.lit(1)).alias("copies")), "firsts"
    )
    plain = [F.when(F.col(name) != "", F.substring(name, 2, 1 << 30)).alias(name) for name in keys]
    distinct = df.drop("suffix", "option_key").join(firsts.select(row_id, *plain, "copies"), row_id)
    marked = {name: F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit("")) for name in keys}
    extra = [] if beside is None else beside.columns
    made = convert(distinct).drop(row_id, *extra).withColumns(marked)
    # A table, as a join has no size that Spark could rely on to send small ones to all executors.
    rows = hashed if beside is None else through_table(hashed.join(beside, row_id), "named-hashes")
    joined = join_many_to_one(rows, made, keys, firsts, "copies", row_id)
    return joined.select(*[plain[keys.index(c)] if c in keys else c for c in joined.columns])


def hash_mismatch(content: Column, claimed: Column) -> Column:
    """Whether a claimed content address differs from the bytes'; null without a claim."""
    return F.sha2(content, 256) != F.lower(F.nullif(claimed, F.lit("")))
