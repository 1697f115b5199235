"""Benchmark decontamination by template windows and consistent slots, in Spark expressions only.

Numbers, units and names are replaced by typed placeholders, so a question with
other values has the same template.  Windows of template tokens are hash-joined
with those of the benchmark.  A run of matching windows on one alignment of
document and item is an instance; of its slots (the values under the
placeholders) of each kind at least half must agree.  Those agree in which a
value of the item stands for the document's value that it has most often.
Values of the item may meet in one value of the document; only a number of two
or more digits that keeps its place and takes another number's too ('60 km/h,
3 hours' as '60 km/h, 60 hours') speaks against both.  Of an instance that
contradicts itself, the windows whose values are all the item's count, if they
are at least half of the item's.  A document leaks an item if what counts covers
at least ``least_share`` of the item's windows, or holds ``long_run`` tokens of
the item in one piece.

Scripts without spaces between words have a token for each letter, so a
sentence quoted inside another is found.
A number is digits with inner points or commas; a unit is one of ``UNITS``
behind a number; a name is any capitalised word but those of ``NOT_NAMES``,
wherever it stands.  A window with names is hashed twice, once with them as
placeholders and once as lower-case words, so texts in other case match too.
Of the latter, windows with fewer than half plain tokens are exact: hashed with their values, so only the
very same numbers match.  The share is that of all windows or of the template
windows alone, whichever is larger, so exact windows take nothing from an item
with other values.  Left out are only windows of bare numbers that count in
equal steps ('5 6 7 8', or fewer than three), which any list holds.  An item
shorter than a window is one window of its length.

Null or empty texts leak nothing; null items are left out.  Rows that repeat an
id are judged together, and each is returned; a row without an id leaks nothing.
Items that share an id are judged together too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import let
from leafmill.session import through_table

WINDOW = 8
LEAST_SHARE = 0.3
LONG_RUN = 40  # tokens
BROADCAST_ROWS = 200_000  # benchmark windows, of about 100 bytes, up to which they are sent to all executors
UNITS = (
    "km", "cm", "mm", "m", "kg", "mg", "g", "ml", "l", "s", "min", "h", "hours?", "minutes?", "seconds?", "days?", "weeks?", "months?",
    "years?", "miles?", "feet", "inch(?:es)?", "pounds?", "dollars?", "euros?", "cents?", "percent", "%", "€", "\\$",
)
NOT_NAMES = (  # begin sentences
    "a", "an", "the", "this", "that", "these", "those", "it", "he", "she", "they", "we", "you", "i", "his", "her", "their", "its", "there", "if", "in",
    "on", "at", "of", "to", "for", "from", "by", "with", "and", "or", "but", "as", "is", "are", "was", "were", "do", "does", "did", "can", "has", "have",
    "what", "which", "who", "how", "when", "where", "why", "each", "every", "all", "some", "after", "before", "then", "so", "find", "suppose",
)
NUMBER, UNIT, NAME = "#", "~", "@"  # begin the token of a placeholder; the value follows
# Scripts that put no spaces between words, of which each letter is a token: Thai, Lao, Myanmar, Khmer, kana and Han.
# The first look is for speed, as most letters are below.
UNSPACED = r"(?=[\u0E00-\x{3FFFF}])[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}]"
MAP_SIZE = (1 << 14, 1 << 21)  # least and most places, a byte each, of the map of benchmark windows
WINDOWS = "array<struct<at: int, hash: bigint, slots: array<string>>>"


def tokens(text: Column) -> Column:
    """Lower-case words, and placeholders with their values."""
    plain = F.regexp_replace(text, rf"[{NUMBER}{UNIT}{NAME}]", " ")
    plain = F.regexp_replace(plain, UNSPACED, " $0 ")
    unit = "|".join(UNITS)
    valued = F.regexp_replace(plain, rf"(?i)(\d+(?:[.,]\d+)*)(?:\s?({unit})(?!\p{{L}}))?", f" {NUMBER}$1 {UNIT}$2 ")
    # A number without a unit leaves a bare mark, which goes.
    bare = F.replace(valued, F.lit(f" {UNIT} "), F.lit(" "))
    # The mark of a unit stands before it, so a unit is no name.
    named = F.regexp_replace(bare, rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{N}}{UNIT}%€$])(?!(?i:{'|'.join(NOT_NAMES)})(?!\p{{L}}))\p{{Lu}}", NAME + "$0")
    found = F.split(F.lower(named), rf"[^a-z0-9\p{{L}}\p{{N}}{NUMBER}{UNIT}{NAME}%€$.,]+|[.,$]+(?![\d])|(?<!\d)[.,]")
    return F.filter(found, lambda t: t != "")


def _kind(token: Column) -> Column:
    first = F.substring(token, 1, 1)
    return F.when(first.isin(NUMBER, UNIT, NAME), first)


def _is_name(token: Column) -> Column:
    return F.startswith(token, F.lit(NAME))


def _is_value(token: Column) -> Column:
    """Whether the token is a number or a unit."""
    return F.substring(token, 1, 1).isin(NUMBER, UNIT)


def _runs(hashes: Column, n: int) -> Column:
    """A hash of the ``n`` hashes from each place on: runs are paired to 2, 4, ... places, at last two that may overlap.

    The last ``n - 1`` places have no whole run and say nothing.
    """
    size = 1
    while size < n:
        step = min(size, n - size)
        hashes = let(hashes, lambda once: F.zip_with(once, F.slice(once, step + 1, F.size(once)), lambda a, b: F.xxhash64(a, b)))
        size += step
    return hashes


def _place(value: Column, size: int) -> Column:
    return value.bitwiseAND(size - 1).cast("int")


def _hash_map(hashes: DataFrame, size: int) -> Column:
    """Which of ``size`` places the hashes fill: one bounded array of booleans that any row may ask."""
    filled = hashes.select(_place(F.col("hash"), size).alias("place")).distinct()
    every = hashes.sparkSession.range(size).join(filled, F.col("id") == F.col("place"), "left").select(
        F.struct("id", F.col("place").isNotNull().alias("filled")).alias("entry"))
    return every.agg(F.transform(F.sort_array(F.collect_list("entry")), lambda e: e["filled"])).scalar()


def windows(texts: DataFrame, keys: list[str], lengths: list[int], spots: bool = False, known: tuple[Column, int] | None = None) -> DataFrame:
    """Rows for each window: the keys, ``at``, ``hash`` and ``slots``.

    In one row names are words, and of mostly placeholders the hash is that of
    the values; a window with names has another in which they are placeholders.
    With ``known``, a map of hashes and its size, windows whose hash finds its
    place empty are left out before they become rows.
    With ``spots`` there are also the slots as structs of place in the text and
    value, and ``told``, whether half the tokens are plain when names are not.
    """
    word = lambda t: F.when(_is_name(t), F.substring(t, 2, 1 << 30)).otherwise(t)
    holds = lambda h: F.lit(True) if known is None else F.get("known", _place(h, known[1]))
    split = texts.select(*keys, tokens(F.col("text")).alias("tokens"))
    split = split.select(*keys, "tokens", F.exists("tokens", _is_name).alias("has_names"), F.exists("tokens", lambda t: F.startswith(t, F.lit(NUMBER))).alias("has_values"))
    exact = F.transform("tokens", lambda t: F.xxhash64(word(t)))
    plain = F.transform("tokens", lambda t: F.xxhash64(F.when(_is_value(t), _kind(t)).otherwise(word(t))))
    named = F.transform("tokens", lambda t: F.xxhash64(F.when(_is_name(t), F.lit(NAME)).otherwise(t)))
    valued = F.transform("tokens", lambda t: F.xxhash64(F.coalesce(_kind(t), t)))
    split = split.select(*keys, "tokens", exact.alias("exact"), F.when(F.col("has_values"), plain).alias("plain"),
                         F.when(F.col("has_names"), F.when(F.col("has_values"), valued).otherwise(named)).alias("named"))
    kinds = ("exact", "plain", "named")
    # Each is used more than once.  A function of array elements may hold no subquery, so the map is a column.
    split = split.select(*keys, "tokens", *([known[0].alias("known")] if known else []), *[_runs(F.col(kind), n).alias(f"{kind}_{n}") for n in lengths for kind in kinds])

    def made(n: int) -> Column:
        every = F.sequence(F.lit(1), F.size("tokens") - n + 1)
        of = lambda kind, i: F.get(f"{kind}_{n}", i - 1)

        def window(i: Column, slots: Column) -> Column:
            part = F.when(F.size(slots) * 2 > n, of("exact", i)).otherwise(F.coalesce(of("plain", i), of("exact", i)))
            return F.struct(i.alias("at"), part.alias("hash"), F.when(F.size(slots) > 0, slots).alias("slots"))

        def with_names(i: Column) -> Column:
            slots = F.filter(F.slice("tokens", i, n), lambda t: _kind(t).isNotNull())
            return F.struct(i.alias("at"), of("named", i).alias("hash"), slots.alias("slots"))

        held = lambda kind: F.when(F.col(f"{kind}_{n}").isNotNull(), F.filter(every, lambda i: holds(of(kind, i))))
        found = F.when(F.col(f"plain_{n}").isNull(), held("exact")).otherwise(F.array_union(held("exact"), held("plain")))
        found = F.transform(found, lambda i: window(i, F.filter(F.slice("tokens", i, n), _is_value)))
        others = F.filter(F.transform(held("named"), with_names), lambda w: F.exists(w["slots"], _is_name))
        return F.concat(found, F.coalesce(others, F.array().cast(WINDOWS)))

    every = F.concat(*[F.when(F.size("tokens") >= n, made(n)).otherwise(F.array().cast(WINDOWS)) for n in lengths])
    if not spots:
        return split.select(*keys, F.inline(every))
    n = lengths[0]
    there = F.filter(F.transform("tokens", lambda t, i: F.struct((i + 1).alias("at"), t.alias("item"))), lambda s: _kind(s["item"]).isNotNull())
    found = split.select(*keys, there.alias("there"), F.inline(every))
    found = found.withColumn("there", F.filter("there", lambda s: (s["at"] >= F.col("at")) & (s["at"] < F.col("at") + n)))
    as_values = F.filter("there", lambda s: ~_is_name(s["item"]))
    has_names = F.size("there") == F.coalesce(F.size("slots"), F.lit(0))
    return found.select(*keys, "at", "hash", "slots", F.when(has_names, F.col("there")).otherwise(as_values).alias("spots"),
                        (F.size("there") * 2 <= n).alias("told"))


def _counts(slots: Column, n: Column) -> Column:
    """Whether a window of ``n`` tokens is bare numbers in equal steps."""
    value = F.transform(slots, lambda t: F.translate(F.substring(t, 2, 40), ",", "").try_cast("double"))
    step = F.transform(F.sequence(F.lit(2), F.greatest(F.size(slots), F.lit(2))), lambda i: F.round(F.get(value, i - 1) - F.get(value, i - 2), 6))
    bare = (F.size(slots) == n) & F.forall(slots, lambda t: F.startswith(t, F.lit(NUMBER)))
    return F.coalesce(bare & ((n < 3) | F.forall(step, lambda x: x == step[0])), F.lit(False))


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> tuple[DataFrame, list[int]]:
    """Windows of the items, how many of them each has (``of``) and how many are templates, and the window lengths in use (at most ``window``)."""
    rows = items.select(items[id_col].alias("item_id"), items[text_col].cast("string").alias("text")).filter("text IS NOT NULL")
    sized = rows.withColumn("n", F.least(F.size(tokens(F.col("text"))), F.lit(window))).filter("n > 0")
    lengths = sorted(r.n for r in sized.select("n").distinct().collect())
    parts = [windows(sized.filter(F.col("n") == n), ["item_id"], [n], spots=True).withColumn("n", F.lit(n)) for n in lengths]
    if not parts:
        parts = [windows(rows.limit(0), ["item_id"], [window], spots=True).withColumn("n", F.lit(window))]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    # Names as placeholders say nothing in a window of mostly placeholders; the other row has them as words.
    named = F.exists("spots", lambda s: _is_name(s["item"]))
    told = found.filter((F.col("told") | ~named) & ~_counts(F.col("slots"), F.col("n"))).drop("n")
    whole = told.groupBy("item_id").agg(F.count_distinct("at").alias("of"), F.count_distinct(F.when(F.col("told"), F.col("at"))).alias("of_told"))
    return through_table(told.join(whole, "item_id"), "item-windows"), lengths


def _consistent(pairs: Column) -> Column:
    """Whether at least half of the slots (``at``, ``item``, ``doc``) of each kind agree."""

    def agree(kind: str) -> Column:
        slots = F.filter(pairs, lambda p: F.startswith(p["item"], F.lit(kind)))
        clean = slots
        if kind == NUMBER:
            kept = F.filter(slots, lambda p: (p["item"] == p["doc"]) & (F.length(p["doc"]) > 2))
            crossed = F.transform(F.filter(slots, lambda p: (p["item"] != p["doc"]) & F.exists(kept, lambda k: k["doc"] == p["doc"])), lambda p: p["doc"])
            clean = F.filter(slots, lambda p: ~F.array_contains(crossed, p["doc"]))

        def most(value: Column) -> Column:
            met = F.transform(F.filter(clean, lambda p: p["item"] == value), lambda p: p["doc"])
            return F.array_max(F.transform(F.array_distinct(met), lambda d: F.size(F.filter(met, lambda m: m == d))))

        right = F.aggregate(F.array_distinct(F.transform(clean, lambda p: p["item"])), F.lit(0), lambda n, value: n + most(value))
        return right * 2 >= F.size(slots)

    # Most pairs are the same values throughout.
    return F.forall(pairs, lambda p: p["item"] == p["doc"]) | (agree(NUMBER) & agree(UNIT) & agree(NAME))


def _longest_run(places: Column) -> Column:
    """How many of the places follow each other at most."""
    offsets = F.transform(F.array_sort(places), lambda p, i: p - i)
    return F.coalesce(F.array_max(F.transform(F.array_distinct(offsets), lambda d: F.size(F.filter(offsets, lambda o: o == d)))), F.lit(0))


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
          item_text_col: str = "text", window: int = WINDOW, least_share: float = LEAST_SHARE, long_run: int = LONG_RUN) -> DataFrame:
    """Pairs (doc_id, item_id) with ``windows`` matched, ``share`` of the item's and ``same_values``."""
    known, lengths = item_windows(items, item_id_col, item_text_col, window)
    known = known.select("item_id", F.col("at").alias("item_at"), "hash", F.col("spots").alias("item_slots"), "told", "of", "of_told")
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    if not lengths:
        texts = texts.limit(0)
    # Beyond the bound Spark joins by sorting, and splits a window that very many texts have.
    n_known = known.count()
    small = n_known <= BROADCAST_ROWS
    # A full map lets all windows through, which costs work and no result.
    size = min(max(MAP_SIZE[0], 1 << (8 * n_known).bit_length()), MAP_SIZE[1])
    own = windows(texts, ["doc_id"], lengths or [window], known=(_hash_map(known.select("hash"), size), size))
    met = own.join(F.broadcast(known) if small else known, "hash")
    none = F.array().cast("array<string>")
    slots = F.zip_with("item_slots", F.coalesce("slots", none), lambda a, b: F.struct(a["at"].alias("at"), a["item"].alias("item"), b.alias("doc")))
    instances = met.withColumn("pairs", slots).groupBy("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.collect_set("item_at").alias("places"), F.collect_set(F.when(F.col("told"), F.col("item_at"))).alias("told"),
        F.collect_set(F.when(F.forall("pairs", lambda p: p["item"] == p["doc"]), F.col("item_at"))).alias("verbatim"),
        F.first("of").alias("of"), F.first("of_told").alias("of_told"), F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"))
    judged = instances.withColumn("agrees", _consistent(F.col("pairs"))).filter(
        F.col("agrees") | (F.size("verbatim") * 2 >= F.col("of")) | (_longest_run(F.col("verbatim")) + window - 1 >= long_run))
    consistent = judged.withColumn("told", F.when(F.col("agrees"), F.col("told")).otherwise(F.array_intersect("told", "verbatim"))).withColumn(
        "places", F.when(F.col("agrees"), F.col("places")).otherwise(F.col("verbatim")))
    same = F.forall("pairs", lambda p: p["item"] == p["doc"])
    whole = lambda places: F.size(F.array_distinct(F.flatten(F.collect_list(places)))).cast("long")
    long = F.size("places") + window - 1 >= long_run  # spares the search for most
    run = F.when(long, _longest_run(F.col("places")) + window - 1).otherwise(0)
    pairs = consistent.withColumn("same", same).withColumn("run", run).groupBy("doc_id", "item_id").agg(
        whole("places").alias("windows"), whole("told").alias("told"), F.first("of").alias("of"), F.first("of_told").alias("of_told"),
        F.max("same").alias("same_values"), F.max("run").alias("run"))
    share = F.greatest(F.col("windows") / F.col("of"), F.try_divide("told", "of_told"))
    told = pairs.withColumn("share", share).filter((F.col("share") >= least_share) | (F.col("run") >= long_run))
    return told.select("doc_id", "item_id", "windows", "share", "same_values")


def judge(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row a document: doc_id, contaminated, items (sorted ids), best_share."""
    found = leaks(docs, items, id_col, text_col, **settings).groupBy("doc_id").agg(
        F.sort_array(F.collect_set("item_id")).alias("items"), F.max("share").alias("best_share"))
    every = docs.select(docs[id_col].alias("doc_id")).join(found, "doc_id", "left")
    return every.select("doc_id", F.col("items").isNotNull().alias("contaminated"),
                        F.coalesce("items", F.array().cast(found.schema["items"].dataType)).alias("items"),
                        F.coalesce("best_share", F.lit(0.0)).alias("best_share"))


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The documents that leak no item, with all their columns."""
    gone = leaks(docs, items, id_col, text_col, **settings).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
