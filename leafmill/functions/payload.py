"""Inline payloads: strict base64."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STRICT = r"\A(?:[A-Za-z0-9+/]{4})*+(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?\z"


def strict_base64(encoded: Column) -> Column:
    """Bytes of a well-formed base64 text, null for anything else.

    Spark's decoder forgives spaces and lost padding, hence the guard.
    """
    return F.when(encoded.rlike(_STRICT), F.unbase64(encoded))
