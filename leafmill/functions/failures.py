"""Converter states and failures as typed errors and warnings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill import fixed


def classify_failure(message: Column) -> Column:
    """``unsupported_format`` when a failure says so, else ``parse_failed``."""
    says_so = "|".join(fixed.UNSUPPORTED_MARKERS)
    return F.when(F.lower(message).rlike(says_so), fixed.UNSUPPORTED_FORMAT).otherwise(fixed.PARSE_FAILED)


def _first_errors(errors: Column) -> Column:
    return F.slice(F.coalesce(errors, F.array().cast("array<string>")), 1, fixed.REPORTED_ERRORS)


def status_error(status: Column, errors: Column, has_document: Column, name: Column) -> Column:
    """Message for a conversion that gave no usable document; null for one that did."""
    shown = _first_errors(errors)
    detail = F.when(F.size(shown) > 0, F.concat(F.lit(": "), F.array_join(shown, "; "))).otherwise("")
    return F.when(
        ~has_document,
        F.concat(
            F.lit("the converter returned no document for `"), name, F.lit("` (status="),
            F.coalesce(status, F.lit("None")), F.lit(")"),
        ),
    ).when(
        F.upper(status).isin(*fixed.FAILED_STATES),
        F.concat(F.lit("the converter failed on `"), name, F.lit("`"), detail),
    )


def status_warnings(status: Column, errors: Column, prefix: str = "converter: ") -> Column:
    """Warnings beside a usable document: partial success, then the first reported errors."""
    partial = F.when(
        F.upper(status) == fixed.PARTIAL_STATE,
        F.lit("the conversion is partial: some pages or elements were skipped"),
    )
    reported = F.transform(_first_errors(errors), lambda error: F.concat(F.lit(prefix), error))
    return F.concat(F.array_compact(F.array(partial)), reported)
