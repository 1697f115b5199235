"""Table cells to a rectangular grid, and a grid to a Markdown pipe table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.text import let

# A cell on its way into the grid.
CELL = "struct<text:string,colspan:int,rowspan:int>"
_CARRY = "array<struct<col:int,text:string,left:int>>"
_GRID = "array<array<string>>"

# The largest spans HTML allows.
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534


def span_grid(rows: Column) -> Column:
    """``array<array<CELL>>`` to ``array<array<string>>`` with spans filled in.

    A spanned cell repeats its text in every place it covers.  Rows are
    handled in order with one piece of state: the cells still hanging down
    from above.  A new cell takes the first column no hanging cell holds.
    Tables without spans, nearly all of them, skip that walk.
    """
    plain = F.transform(rows, lambda row: F.transform(row, lambda cell: cell["text"]))
    spanned = F.exists(rows, lambda row: F.exists(row, lambda cell: (cell["colspan"] > 1) | (cell["rowspan"] > 1)))
    return F.when(spanned, _filled(rows)).otherwise(plain)


def _filled(rows: Column) -> Column:
    def step(state: Column, row: Column) -> Column:
        copies = F.flatten(F.transform(row, lambda cell: F.array_repeat(cell, cell["colspan"])))
        return let(copies, lambda cells: _place(state, cells))

    start = F.struct(
        F.array().cast(_CARRY).alias("carry"),
        F.array().cast(_GRID).alias("grid"),
    )
    return F.aggregate(rows, start, step, lambda state: state["grid"])


def _place(state: Column, cells: Column) -> Column:
    taken = F.transform(state["carry"], lambda entry: entry["col"])
    columns = F.sequence(F.lit(0), F.size(cells) + F.size(taken))
    free = F.filter(columns, lambda col: ~F.array_contains(taken, col))

    def placed(free: Column) -> Column:
        new = F.transform(
            cells,
            lambda cell, i: F.struct(
                F.get(free, i).alias("col"), cell["text"].alias("text"), cell["rowspan"].alias("left")
            ),
        )
        return let(F.array_sort(F.concat(new, state["carry"])), advanced)

    def advanced(entries: Column) -> Column:
        width = F.array_max(F.transform(entries, lambda entry: entry["col"])) + 1
        dense = F.transform(entries, lambda entry: entry["text"])
        gapped = F.transform(
            F.sequence(F.lit(0), width - 1),
            lambda col: F.coalesce(F.get(F.filter(entries, lambda entry: entry["col"] == col), 0)["text"], F.lit("")),
        )
        line = F.when(F.size(entries) == 0, F.array().cast("array<string>")).when(
            F.size(entries) == width, dense
        ).otherwise(gapped)
        hanging = F.transform(
            F.filter(entries, lambda entry: entry["left"] > 1),
            lambda entry: F.struct(
                entry["col"].alias("col"), entry["text"].alias("text"), (entry["left"] - 1).alias("left")
            ),
        )
        return F.struct(hanging.alias("carry"), F.array_append(state["grid"], line).alias("grid"))

    return let(free, placed)


def table_markdown(grid: Column) -> Column:
    """A grid as a pipe table: header row, rule, body; short rows padded; ``|`` escaped.

    Null for a grid without cells.
    """
    def cell(text: Column) -> Column:
        return F.replace(F.regexp_replace(text, r"\s*[\r\n]+\s*", " "), F.lit("|"), F.lit("\\|"))

    def line(row: Column, width: Column) -> Column:
        padded = F.concat(F.transform(row, cell), F.array_repeat(F.lit(""), width - F.size(row)))
        return F.concat(F.lit("| "), F.array_join(padded, " | "), F.lit(" |"))

    def render(rows: Column) -> Column:
        return let(F.array_max(F.transform(rows, lambda row: F.size(row))), lambda width: lines(rows, width))

    def lines(rows: Column, width: Column) -> Column:
        rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
        return F.array_join(
            F.flatten(
                F.transform(
                    rows,
                    lambda row, i: F.when(i == 0, F.array(line(row, width), rule)).otherwise(
                        F.array(line(row, width))
                    ),
                )
            ),
            "\n",
        )

    kept = F.filter(grid, lambda row: F.size(row) > 0)
    return let(kept, lambda rows: F.when(F.size(rows) > 0, render(rows)))
