"""Rules over archive members, and the merge of converted members.

A member table has ``archive_id``, ``ordinal`` (from 0, in stored order),
``name``, ``kind``, ``declared_size`` and, where bytes were read,
``content_length``.  Each rule gives a refusal text or null.

An archive with more members than the limit is refused by its members up to
the first one over, so rows past that one take no part in any group: a filter
on ``ordinal`` bounds every group before the shuffle, and one archive holding
a third of all rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafmill import fixed
from leafmill.functions.export import no_cuts
from leafmill.functions.paths import member_name, member_name_refusal
from leafmill.functions.text import is_blank
from leafmill.limits import Limits
from leafmill.session import through_table


def decisive_members(members: DataFrame, limits: Limits) -> DataFrame:
    """Members that can still change the verdict on their archive."""
    return members.filter(F.col("ordinal") <= limits.max_archive_members)


def member_counts(members: DataFrame) -> DataFrame:
    """Members per archive, directories included; counted on the map side first."""
    return members.groupBy("archive_id").agg(F.count(F.lit(1)).cast("int").alias("member_count"))


def member_kind_refusal(name: Column, kind: Column, fmt: Column) -> Column:
    """Only regular files and directories may be members."""
    quoted = F.concat(F.lit("archive member `"), name, F.lit("`"))
    return (
        F.when((kind == "symlink") & (fmt == "zip"), F.concat(quoted, F.lit(" is a symlink")))
        .when(kind.isin("symlink", "hardlink"), F.concat(quoted, F.lit(" is a link")))
        .when(~kind.isin("file", "directory"), F.concat(quoted, F.lit(" is no regular file")))
    )


def member_count_refusal(limits: Limits) -> Column:
    """Zip tells its total first; tar is counted while walked."""
    over = limits.max_archive_members
    total = F.concat(
        F.lit("archive holds "), F.col("member_count").cast("string"), F.lit(f" members, {over} are allowed")
    )
    return F.when(F.col("format") == "zip", F.when(F.col("member_count") > over, total)).when(
        F.col("ordinal") >= over, F.lit(f"archive holds more than {over} members")
    )


def expanded_bytes() -> Column:
    """Declared bytes of an archive up to and with this member; directories take none."""
    size = F.when(F.col("kind") == "directory", 0).otherwise(F.col("declared_size"))
    so_far = W.partitionBy("archive_id").orderBy("ordinal").rowsBetween(W.unboundedPreceding, W.currentRow)
    return F.sum(size).over(so_far)


def expanded_bytes_refusal(running: Column, limits: Limits) -> Column:
    over = limits.max_archive_bytes
    return F.when(running > over, F.lit(f"archive grows beyond the {over}-byte limit"))


def actual_bytes_refusal(length: Column, limits: Limits) -> Column:
    return F.when(
        length > limits.max_archive_bytes, F.lit("archive member holds more bytes than it declares")
    )


def judge_members(members: DataFrame, limits: Limits) -> DataFrame:
    """Add ``refusal``, the same on all members of an archive: its first refusal in walk order, or null.

    One shuffle, on ``archive_id``.
    """
    near = decisive_members(members, limits)
    if "member_count" not in members.columns:
        near = near.join(member_counts(members), "archive_id")
    if "problem" not in members.columns:
        near = near.withColumn("problem", F.lit(None).cast("string"))
    if "content_length" not in members.columns:
        near = near.withColumn("content_length", F.octet_length("content"))

    directory = F.col("kind") == "directory"
    container = F.col("kind").isin("unreadable", "damaged", "empty")
    rejected, failed = F.lit(fixed.INPUT_REJECTED), F.lit(fixed.PARSE_FAILED)

    def found(code: Column, reason: Column, place: Column, check: int) -> Column:
        return F.when(
            reason.isNotNull(),
            F.struct(place.alias("place"), F.lit(check).alias("check"), code.alias("error_code"), reason.alias("error")),
        )

    here = F.col("ordinal")
    total_first = F.when(F.col("format") == "zip", F.lit(-1)).otherwise(here)
    checks = [
        found(F.when(F.col("kind") == "damaged", failed).otherwise(rejected),
              F.when(container, F.col("problem")), here, 0),
        found(rejected, member_count_refusal(limits), total_first, 1),
        found(rejected, F.when(~container, member_name_refusal(F.coalesce("name", F.lit("")))), here, 2),
        found(rejected, F.when(~directory & ~container,
                               member_kind_refusal(F.col("name"), F.col("kind"), F.col("format"))), here, 3),
        found(rejected, F.when(~directory & ~container, expanded_bytes_refusal(F.col("_running"), limits)), here, 4),
        found(failed, F.when(~container, F.col("problem")), here, 5),
        found(rejected, actual_bytes_refusal(F.col("content_length"), limits), here, 6),
    ]
    judged = near.withColumn("_running", expanded_bytes()).withColumn("_first", F.array_min(F.array(*checks)))
    first = F.min("_first").over(W.partitionBy("archive_id"))
    return judged.withColumn("refusal", first).drop("_running", "_first")


def archive_verdict(members: DataFrame, limits: Limits) -> DataFrame:
    """One row per archive: ``error_code`` and ``error`` of its first refusal, null for a good archive."""
    light = members.withColumn("content_length", F.octet_length("content")) if "content" in members.columns else members
    return (
        judge_members(light.drop("content"), limits)
        .groupBy("archive_id")
        .agg(F.min("refusal").alias("refusal"))
        .select("archive_id", "refusal.error_code", "refusal.error")
    )


def order_members(members: DataFrame) -> DataFrame:
    """Add ``position``: the place of a member when names are ordered by path segment, not as text."""
    placed = W.partitionBy("archive_id").orderBy(F.split("name", "/"), "ordinal")
    return members.withColumn("position", F.row_number().over(placed) - 1)


LEAST_ELEMENT_BYTES = 60  # of an element's record in the output budget


def within_budget(converted: DataFrame, limits: Limits) -> DataFrame:
    """Members with payloads emptied that lie wholly behind an asked-for output budget.

    Running sums in member order decide, over the members that count, before
    anything is gathered; so what is gathered of an archive stays near the
    budget however large its members are.  The one that passes the budget stays
    whole, so that the cut shows.
    """
    if limits.max_output_bytes is None:
        return converted
    name = member_name(F.col("name"))
    place = W.partitionBy("archive_id").orderBy(F.split(name, "/"), "ordinal")
    counts = F.col("error").isNull() & ~F.col("blank") & ~name.eqNullSafe(F.lead(name).over(place))
    numbered = converted.withColumn("_counts", counts)
    before = place.rowsBetween(W.unboundedPreceding, -1)

    def passed(size: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_counts"), size)).over(before), F.lit(0)) > limits.max_output_bytes

    full = {
        "markdown": F.when(passed(F.octet_length("markdown")), F.lit("")).otherwise(F.col("markdown")),
        "text": F.when(passed(F.octet_length("text")), F.lit("")).otherwise(F.col("text")),
        "elements": F.when(passed(F.size("elements") * LEAST_ELEMENT_BYTES), F.slice("elements", 1, 0)).otherwise(F.col("elements")),
    }
    return numbered.withColumns(full).drop("_counts")


def merged_bytes() -> Column:
    """What a member adds to a merged row: its Markdown and text under their headings, and its elements."""
    name = F.octet_length(member_name(F.col("name")))
    elements = F.aggregate(
        "elements", F.lit(0).cast("long"),
        lambda total, e: total + F.coalesce(F.octet_length(e["text"]), F.lit(0)) + LEAST_ELEMENT_BYTES)
    return F.octet_length("markdown") + F.octet_length("text") + 2 * name + 8 + elements


def too_large(converted: DataFrame, limits: Limits, counts: Column | None = None) -> DataFrame:
    """Add ``row_error``, the same on all members of an archive, where one row would not hold the merged archive.

    The sum is taken in the shuffle that the merge needs anyway, in a window
    that spills; payloads of such archives are emptied before anything is
    gathered.  ``merge_parts`` takes them.
    """
    used = F.col("error").isNull() if counts is None else counts & F.col("error").isNull()
    total = F.sum(F.when(used, merged_bytes())).over(W.partitionBy("archive_id"))
    summed = converted.withColumn("_total", total)
    over = F.coalesce(F.col("_total") > limits.max_row_bytes, F.lit(False))
    message = F.concat(F.lit("the merged archive has "), F.col("_total").cast("string"),
                       F.lit(f" bytes, more than the {limits.max_row_bytes} that one row may hold: merge it in parts"))
    return summed.withColumns({
        "markdown": F.when(over, F.lit("")).otherwise(F.col("markdown")), "text": F.when(over, F.lit("")).otherwise(F.col("text")),
        "elements": F.when(over, F.slice("elements", 1, 0)).otherwise(F.col("elements")), "row_error": F.when(over, message),
    }).drop("_total")


def member_offsets(light: DataFrame) -> DataFrame:
    """Add ``start`` and ``first_element``: sums of ``weight`` and ``n_elements`` over the members before, in member order.

    ``light`` has ``archive_id, segments, ordinal, weight, n_elements``.  Members are dealt
    by ranges of their order; sums within a range and sums of whole ranges add
    up to the offset, so an archive with most of all members is summed by many tasks.
    """
    ranged = light.repartitionByRange("archive_id", "segments", "ordinal").withColumn("_range", F.spark_partition_id())
    dealt = through_table(ranged, "member-ranges")  # the ranges stay what they are if a task runs again
    before = W.partitionBy("archive_id", "_range").orderBy("segments", "ordinal").rowsBetween(W.unboundedPreceding, -1)
    within = dealt.withColumns({f"_{c}": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("weight", "n_elements")})
    whole = dealt.groupBy("archive_id", "_range").agg(*[F.sum(c).alias(f"_all_{c}") for c in ("weight", "n_elements")])
    earlier = W.partitionBy("archive_id").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    lead = whole.select("archive_id", "_range", *[F.coalesce(F.sum(f"_all_{c}").over(earlier), F.lit(0)).alias(f"_lead_{c}") for c in ("weight", "n_elements")])
    joined = within.join(lead, ["archive_id", "_range"])
    return joined.select(*light.columns, (F.col("_weight") + F.col("_lead_weight")).alias("start"),
                         (F.col("_n_elements") + F.col("_lead_n_elements")).alias("first_element"))


def merge_parts(converted: DataFrame, limits: Limits, *keys: str, counts: Column | None = None, part_bytes: int = 64 << 20) -> DataFrame:
    """Converted members to numbered parts of an archive: rows of ``merge_archive`` with ``part`` (from 0, gapless) and ``first_element``.

    Parts in order, joined by blank lines, are the whole archive, of any size.  A part holds the members that begin in
    one stretch of ``part_bytes`` of ``merged_bytes``, so it is larger than that
    by its last member at most.  Offsets are summed over rows without payload; payloads are gathered by part only.
    """
    if "cuts" not in converted.columns:
        converted = converted.withColumn("cuts", no_cuts())
    if counts is not None:
        converted = converted.filter(counts)
    rows = through_table(converted, "converted-members")
    name = member_name(F.col("name"))
    kept = F.col("error").isNull() & ~is_blank(F.col("markdown"))
    light = rows.select("archive_id", "ordinal", name.alias("_name"), F.split(name, "/").alias("segments"),
                        F.when(kept, merged_bytes()).otherwise(0).cast("long").alias("weight"),
                        F.when(kept, F.size("elements")).otherwise(0).cast("long").alias("n_elements"))
    # Of members with one name the last stored counts.
    last = F.max("ordinal").over(W.partitionBy("archive_id", "_name"))
    latest = light.withColumn("_last", last).filter(F.col("_last") == F.col("ordinal")).drop("_last", "_name")
    stretch = F.floor(F.col("start") / part_bytes)
    placed = through_table(member_offsets(latest).withColumn("_stretch", stretch), "member-places")
    numbers = placed.groupBy("archive_id", "_stretch").agg(F.min("first_element").alias("_first"))
    numbered = numbers.withColumn("part", F.row_number().over(W.partitionBy("archive_id").orderBy("_stretch")) - 1)
    part_of = placed.select("archive_id", "ordinal", "_stretch").join(numbered, ["archive_id", "_stretch"])
    own = part_of.select("archive_id", "ordinal", "part", F.col("_first").alias("first_element"))
    return merge_archive(rows.join(own, ["archive_id", "ordinal"]), limits, *keys, "part", "first_element")


def merge_archive(converted: DataFrame, limits: Limits, *keys: str, counts: Column | None = None) -> DataFrame:
    """Converted members to one row per archive, in member order.

    Takes ``archive_id, ordinal, name, markdown, text, elements, cuts, warnings,
    page_count, error``.  A failed member leaves a warning, a blank one leaves
    nothing, the rest are joined under headings with their names.  Of members
    with one name the last counts.  The groups are whole archives that passed
    the verdict; with an output budget what lies behind it is not gathered.
    """
    if "cuts" not in converted.columns:
        converted = converted.withColumn("cuts", no_cuts())
    converted = within_budget(converted.withColumn("blank", is_blank(F.col("markdown"))), limits)
    member = F.struct(
        F.split(member_name(F.col("name")), "/").alias("segments"),
        F.col("ordinal"),
        member_name(F.col("name")).alias("name"),
        F.col("blank"),
        F.col("markdown"),
        F.col("text"),
        F.col("elements"),
        F.col("cuts"),
        F.col("warnings"),
        F.col("page_count"),
        F.col("error"),
    )
    listed = member if counts is None else F.when(counts, member)
    grouped = converted.groupBy("archive_id", *keys).agg(F.array_sort(F.collect_list(listed)).alias("_all"))
    latest = grouped.withColumn(
        "_members",
        F.filter("_all", lambda m, i: F.coalesce(F.get(F.col("_all"), i + 1)["name"] != m["name"], F.lit(True))),
    )
    kept = latest.withColumn(
        "_kept", F.filter("_members", lambda m: m["error"].isNull() & ~m["blank"])
    )

    def warnings_of(m: Column) -> Column:
        failed = F.array(F.concat(m["name"], F.lit(": "), m["error"]))
        own = F.transform(m["warnings"], lambda w: F.concat(m["name"], F.lit(": "), w))
        blank = F.array().cast("array<string>")
        return F.when(m["error"].isNotNull(), failed).when(m["blank"], blank).otherwise(own)

    def sourced(m: Column) -> Column:
        return F.transform(m["elements"], lambda e: e.withField("source", m["name"]))

    def joined(field: str, lead: str) -> Column:
        return F.array_join(
            F.transform("_kept", lambda m: F.concat(F.lit(lead), m["name"], F.lit("\n\n"), m[field])), "\n\n"
        )

    pages = F.aggregate(
        "_kept", F.lit(0), lambda total, m: total + F.coalesce(m["page_count"], F.lit(0)),
    )
    every = F.flatten(F.transform("_kept", sourced))

    def total(field: str) -> Column:
        return F.aggregate("_kept", F.lit(0), lambda sum_, m: sum_ + F.coalesce(m["cuts"][field], F.lit(0)))

    elements, dropped = every, total("elements_dropped")
    if limits.max_elements is not None:
        elements = F.slice(every, 1, max(limits.max_elements, 0))
        dropped = dropped + F.greatest(F.size(every) - max(limits.max_elements, 0), F.lit(0))
    cuts = F.struct(dropped.alias("elements_dropped"), total("texts_clipped").alias("texts_clipped"))
    return kept.select(
        "archive_id",
        *keys,
        joined("markdown", "# ").alias("markdown"),
        joined("text", "").alias("text"),
        elements.alias("elements"),
        cuts.alias("cuts"),
        F.flatten(F.transform("_members", warnings_of)).alias("warnings"),
        F.nullif(pages, F.lit(0)).alias("page_count"),
        F.transform("_kept", lambda m: m["name"]).alias("sources"),
    )
