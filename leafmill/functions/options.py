"""Per-request options: an open bag of hints of which a few are understood."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill import fixed

OPTIONS = "struct<ocr:boolean,ocr_engine:string,ocr_languages:array<string>,table_structure:boolean>"
HINTS = ("ocr", "ocr_engine", "ocr_languages", "table_structure")


def normalise_options(options: Column) -> Column:
    """VARIANT to ``OPTIONS``; a hint of the wrong type, or unknown, is dropped without a word."""
    def kind(key: str) -> Column:
        return F.schema_of_variant(F.variant_get(options, f"$.{key}", "variant"))

    def flag(key: str) -> Column:
        return F.when(kind(key) == "BOOLEAN", F.try_variant_get(options, f"$.{key}", "boolean"))

    engine = F.when(kind("ocr_engine") == "STRING", F.lower(F.try_variant_get(options, "$.ocr_engine", "string")))
    languages = F.when(
        kind("ocr_languages").isin("ARRAY<STRING>", "ARRAY<VOID>"),
        F.try_variant_get(options, "$.ocr_languages", "array<string>"),
    )
    # An empty list and a list of nulls have the same variant schema.
    strings_only = ~F.exists(languages, lambda language: language.isNull())
    return F.struct(
        flag("ocr").alias("ocr"),
        F.when(engine.isin(*fixed.OCR_ENGINES), engine).alias("ocr_engine"),
        F.when(strings_only, F.filter(languages, lambda language: language != "")).alias("ocr_languages"),
        flag("table_structure").alias("table_structure"),
    )


def option_key(clean: Column) -> Column:
    """One text per set of options: JSON in name order without the absent ones."""
    return F.to_json(clean)


def option_warnings(clean: Column, honoured: Iterable[str] = (), applies: Column | None = None) -> Column:
    """One warning per hint that the conversion at hand cannot follow.

    ``honoured`` names the hints it does follow.  A hint that asks for what
    happens anyway (no OCR, tables kept) needs no warning.
    """
    asked = {
        "ocr": clean["ocr"],
        "ocr_engine": clean["ocr_engine"].isNotNull(),
        "ocr_languages": F.size(F.coalesce(clean["ocr_languages"], F.array().cast("array<string>"))) > 0,
        "table_structure": ~clean["table_structure"],
    }
    reason = {
        "ocr": "text is read as it is stored, no page image is recognised",
        "ocr_engine": "no OCR engine takes part in this conversion",
        "ocr_languages": "no OCR engine takes part in this conversion",
        "table_structure": "tables are always kept",
    }
    given = [
        F.when(hint if applies is None else hint & applies, F.lit(f"{name} ignored: {reason[name]}"))
        for name, hint in asked.items()
        if name not in set(honoured)
    ]
    return F.array_compact(F.array(*given)) if given else F.array().cast("array<string>")
