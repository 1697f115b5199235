"""Chat formatting by relational operations: rows of turns to one training string, and back.

A conversation's turn structs are collected and sorted, adjacent turns of one
role become one message that holds an array of their texts, and the pieces are
concatenated; all of it Spark expressions.

    <|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n

Texts cannot forge marks: a backslash becomes ``\\b`` and ``<|`` becomes
``<\\p`` (in roles a line feed becomes ``\\n`` too), so ``<|`` in the output
is always a mark, and reading back undoes it.

Null text is empty text, a null role the empty role, a null turn sorts first.
Rows with one turn number stay in the order of role and text; repeated rows
are turns of their own.  A conversation is one record and so one row: its
length is bounded by Spark's row limit (2 GiB), and it is the unit of work.
Rows with a null conversation id form one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, SEP = "<|im_start|>", "<|im_end|>", "<|im_sep|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("<\\p"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\p"), F.lit("<|")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def _between(mark: str) -> str:
    return f"\\Q{mark}\\E"


def run_starts(turns: Column) -> Column:
    """Places (from 0) at which the role changes, the first included."""
    places = F.transform(turns, lambda _, i: i)
    return F.filter(places, lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))


def messages(turns: Column, starts: Column) -> Column:
    """Sorted turn structs to messages (role, texts): each run of one role becomes one."""
    def message(start: Column, k: Column) -> Column:
        stop = F.coalesce(F.get(starts, k + 1), F.size(turns))
        run = F.slice(turns, start + 1, stop - start)
        return F.struct(F.get(turns, start)["role"].alias("role"), F.transform(run, lambda t: t["text"]).alias("texts"))

    return F.transform(starts, message)


def format_messages(found: Column) -> Column:
    return F.array_join(F.transform(
        found,
        lambda m: F.concat(F.lit(START), escape_role(m["role"]), F.lit("\n"), F.array_join(F.transform(m["texts"], escape), SEP), F.lit(END + "\n")),
    ), "")


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """One row a conversation: conv_id, formatted."""
    turn = F.struct(
        rows[turn_col].alias("turn"), F.coalesce(rows[role_col].cast("string"), F.lit("")).alias("role"),
        F.coalesce(rows[text_col].cast("string"), F.lit("")).alias("text"),
    )
    sorted_turns = (
        rows.select(rows[conv_col].alias("conv_id"), turn.alias("turn")).groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    )
    merged = sorted_turns.withColumn("starts", run_starts(F.col("turns"))).select(
        "conv_id", messages(F.col("turns"), F.col("starts")).alias("messages")
    )
    return merged.select("conv_id", format_messages(F.col("messages")).alias("formatted"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted string holds."""
    blocks = F.filter(F.split(formatted, _between(START)), lambda _, i: i > 0)

    def turns_of(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        body = F.substring_index(F.substring(block, F.length(role) + 2, F.length(block)), END, 1)
        return F.transform(F.split(body, _between(SEP)), lambda t: F.struct(unescape_role(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def loss_texts(turns: Column, role: str = "assistant") -> Column:
    """The texts under the loss mask."""
    return F.transform(F.filter(turns, lambda t: t["role"] == role), lambda t: t["text"])
