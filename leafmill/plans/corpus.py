"""From requests to outcomes: the corpus job.

    requests -> check, confine, decode -> join files -> route
    route -> text families: in-row extraction
          -> archives: members, verdict, merge
          -> other families: the user's converter
    all   -> budget -> outcomes

An outcome is ``(request_id, result, error)`` with exactly one of the last two
present.  A document is shuffled once, to meet its request; an archive's
members once more, to meet each other.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill import fixed
from leafmill.functions import export
from leafmill.functions.encoding import decoded
from leafmill.functions.options import OPTIONS, option_warnings
from leafmill.functions.paths import base_name, format_suffix, is_archive, local_form
from leafmill.limits import Limits
from leafmill.operators.admission import (
    check_request, confine, decode_inline, route, size_refusal, typed_error, with_options,
)
from leafmill.operators.archives import judge_members, merge_archive, too_large
from leafmill.operators.assemble import assemble
from leafmill.operators.blocks import blocks_of, extract
from leafmill.operators.content_store import convert_known
from leafmill.operators.converter import Factory, convert_once, convert_with
from leafmill.operators.ledger import outcome_events
from leafmill.sources.archives import explode_archives
from leafmill.sources.files import length_of, read_files, write_dated, write_errors, write_results
from leafmill.sources.ranges import explode_located
from leafmill.session import through_table



def _rejected(message: Column) -> Column:
    return F.when(message.isNotNull(), typed_error(fixed.INPUT_REJECTED, message))


def admit(requests: DataFrame, files: DataFrame, limits: Limits, roots: Iterable[str],
          resolve_links: bool = True) -> DataFrame:
    """Requests to documents: ``request_id, filename, suffix, content, option_key, error, location`` with ``error`` set on those refused.

    Archives in files have a ``location`` instead of their content.
    Requests that carry their bytes meet no other row, so they are not moved.
    """
    checked = check_request(with_options(requests))
    names_file = F.col("request_error").isNull() & (F.coalesce("path", F.lit("")) != "")
    inline = decode_inline(checked.filter(~names_file), limits)
    error = F.when(F.col("request_error").isNotNull(), typed_error(None, F.col("request_error"))).otherwise(
        _rejected(F.col("inline_error"))
    )
    carried = inline.select(
        "request_id", F.coalesce("filename", F.lit("document.txt")).alias("filename"), F.lower("suffix").alias("suffix"),
        "content", "option_key", error.alias("error"), F.lit(None).cast("string").alias("location"),
    )
    return carried.unionByName(_opened(checked.filter(names_file), files, limits, roots, resolve_links))


def _opened(requests: DataFrame, files: DataFrame, limits: Limits, roots: Iterable[str], resolve_links: bool) -> DataFrame:
    """Requests that name a file, with its content.

    ``files`` gives locations and sizes; a content it may have is not read.
    Sizes decide, then executors open the accepted files where their rows are.
    Refused requests get a key of their own in the join, so that they do not
    pile up in one partition.
    """
    confined = confine(requests, roots, resolve_links)
    keyed = confined.withColumn(
        "_file",
        F.when(F.col("path_error").isNull(), F.col("resolved_path")).otherwise(
            F.concat(F.lit("no file: "), F.col("request_id"))
        ),
    )
    at = local_form(F.col("path")).alias("_file")
    sized = keyed.join(files.select(at, F.col("length").alias("_length")), "_file", "left")
    # What the listing lacks, such as the target of a link, is looked up where the row is.
    unlisted = F.when(F.col("path_error").isNull() & F.col("_length").isNull(), F.col("_file"))
    sized = sized.withColumn("_length", F.coalesce("_length", length_of(unlisted)))
    message = (
        F.when(F.col("path_error").isNotNull(), F.col("path_error"))
        .when(F.col("_length").isNull(), F.concat(F.lit("cannot open `"), F.col("path"), F.lit("`")))
        .otherwise(size_refusal(F.col("_length"), limits))
    )
    decided = sized.select(
        "request_id", "path", base_name(F.col("resolved_path")).alias("filename"), format_suffix(F.col("resolved_path")).alias("suffix"),
        "option_key", message.alias("message"), F.when(message.isNull(), F.col("_file")).alias("location"),
    )
    # An archive is read by ranges later on, member by member.
    packed = F.when(is_archive(F.col("suffix")), F.col("location"))
    opened = read_files(decided.withColumn("archive", packed).withColumn("location", F.when(F.col("archive").isNull(), F.col("location"))))
    unread = F.col("location").isNotNull() & F.col("content").isNull()
    refused = F.when(unread, F.concat(F.lit("cannot open `"), F.col("path"), F.lit("`"))).otherwise(F.col("message"))
    return opened.select(
        "request_id", "filename", "suffix", "content", "option_key", _rejected(refused).alias("error"), F.col("archive").alias("location"))


_MADE: dict[str, Column] = {}


def document_blocks() -> Column:
    """Blocks of ``_text`` by ``family``: a large expression, made once for an application and used by all its jobs and micro-batches."""
    app = SparkContext.getOrCreate().applicationId
    if app not in _MADE:
        _MADE.clear()
        _MADE[app] = blocks_of(F.col("family"), F.coalesce("_text", F.lit("")))
    return _MADE[app]


def convert_documents(df: DataFrame, limits: Limits, blocks: Column, *keys: str, factory: Factory | None = None,
                      families: Iterable[str] = (), tag: str = "", once: bool = False,
                      store: str | None = None, row: Column | None = None) -> DataFrame:
    """``(keys, name, suffix, family, format_error, content, option_key)`` to the common columns."""
    families = list(families) if factory else []
    readable = F.col("family").isin(*fixed.BUILT_IN_FAMILIES)
    here = df.filter(~F.coalesce(F.col("family").isin(*families), F.lit(False))) if families else df
    built_in = extract(decoded(here, "content", "family"), blocks).select(
        *keys, "name", "markdown", "text",
        export.echo_elements(F.col("elements"), limits).alias("elements"),
        export.echo_cuts(F.col("elements"), limits).alias("cuts"),
        F.lit(None).cast("int").alias("page_count"),
        F.concat(
            option_warnings(F.from_json("option_key", OPTIONS), applies=readable), F.array_compact(F.array("_unread")),
        ).alias("warnings"),
        F.when(
            ~F.coalesce(readable, F.lit(False)),
            typed_error(fixed.UNSUPPORTED_FORMAT, F.coalesce(
                "format_error", F.concat(F.lit("no conversion is available for `"), F.col("suffix"), F.lit("`")))),
        ).alias("error"),
    )
    if not families:
        return built_in
    taken = df.filter(F.col("family").isin(*families))
    if not once and store is None:
        return built_in.unionByName(convert_with(taken, factory, limits, *keys, tag=tag))
    taken = through_table(taken.withColumn("_row", F.col(keys[0]) if row is None else row), "to-convert")
    carried = ("_row", "content_sha", "suffix", "option_key", "copies")
    wanted = taken.select("_row", "name", "content", "suffix", "option_key")
    if store is not None:
        kept = ("_row", "content_sha", "suffix", "option_key")
        made = convert_known(
            wanted, lambda rows: convert_with(rows, factory, limits, *kept, tag=tag).drop("name"), "_row", store)
    else:
        made = convert_once(wanted, lambda distinct: convert_with(distinct, factory, limits, *carried, tag=tag), "_row",
                            taken.select(*keys, "name", "_row"))
        return built_in.unionByName(made.select(*built_in.columns))
    return built_in.unionByName(taken.select(*keys, "name", "_row").join(made, "_row").select(*built_in.columns))


def _with_source(elements: str) -> Column:
    return F.transform(elements, lambda e: e.withField("source", F.lit(None).cast("string")))


def outcomes(documents: DataFrame, limits: Limits, factory: Factory | None = None, families: Iterable[str] = (),
             tag: str = "", once: bool = False, store: str | None = None) -> DataFrame:
    """Documents to ``(request_id, result, error)``.

    With ``once`` the user's converter sees each distinct content, suffix and
    options one time; with ``store``, a folder, not again in later runs either
    (the store belongs to one converter; another one needs another folder).  Both need unique request ids.
    """
    hook = {"factory": factory, "families": families, "tag": tag, "once": once, "store": store}
    blocks = document_blocks()
    packs = is_archive(F.coalesce("suffix", F.lit(""))) & F.col("error").isNull()
    plain = convert_documents(
        route(documents.filter(~packs), families if factory else ()).select(
            "request_id", F.col("filename").alias("name"), "suffix", "family", "format_error", "option_key",
            F.when(F.col("error").isNull(), F.col("content")).alias("content"), F.col("error").alias("refused"),
        ),
        limits, blocks, "request_id", "refused", **hook,
    ).select(
        "request_id", F.col("name").alias("filename"), F.array("name").alias("sources"), "markdown", "text",
        _with_source("elements").alias("elements"), "cuts", "page_count", "warnings",
        F.coalesce("refused", "error").alias("error"),
    )
    done = plain.unionByName(convert_archives(documents.filter(packs), limits, blocks, **hook))
    return assemble(done, limits, with_source=True).select(
        "request_id", F.when(F.col("error").isNull(), F.col("result")).alias("result"), "error"
    )


def convert_archives(documents: DataFrame, limits: Limits, blocks: Column, factory: Factory | None = None,
                     families: Iterable[str] = (), tag: str = "", once: bool = False, store: str | None = None) -> DataFrame:
    """Archive documents to one merged row each.

    Members are read once; verdict and merge share the shuffle on the archive.
    Archives with a ``location`` are read by ranges, the others are in memory.
    """
    named = documents.withColumnRenamed("request_id", "archive_id")
    if "location" in documents.columns:
        held = explode_archives(named.filter(F.col("location").isNull()), limits, "filename", "option_key")
        members = held.unionByName(explode_located(named.filter(F.col("location").isNotNull()), limits, "filename", "option_key"))
    else:
        members = explode_archives(named, limits, "filename", "option_key")
    judged = judge_members(members, limits).withColumn(
        "content", F.when(F.col("refusal").isNull(), F.col("content"))
    )
    routed = route(judged.withColumn("suffix", format_suffix(F.coalesce("name", F.lit("")))), families if factory else ())
    # An archive inside an archive is a member nobody converts.
    converted = convert_documents(
        routed, limits, blocks, "archive_id", "filename", "ordinal", "kind", "refusal",
        factory=factory, families=families, tag=tag, once=once, store=store,
        row=F.concat_ws("/", F.col("ordinal").cast("string"), "archive_id"),
    ).withColumn("error", F.col("error.error"))
    counts = F.col("refusal").isNull() & (F.col("kind") == "file")
    refusal = F.when(
        F.col("refusal").isNotNull(), typed_error(F.col("refusal.error_code"), F.col("refusal.error"))
    ).when(F.col("row_error").isNotNull(), typed_error(fixed.PARSE_FAILED, F.col("row_error")))
    # With an output budget less is gathered than that, whatever the archive holds.
    bounded = too_large(converted, limits, counts) if limits.max_output_bytes is None else converted.withColumn("row_error", F.lit(None).cast("string"))
    return merge_archive(bounded, limits, "filename", "refusal", "row_error", counts=counts).select(
        F.col("archive_id").alias("request_id"), "filename", "sources", "markdown", "text", "elements", "cuts", "page_count",
        "warnings", refusal.alias("error"),
    )


def run_corpus(requests: DataFrame, files: DataFrame, limits: Limits, roots: Iterable[str], results_path: str,
               errors_path: str, run_date: str, resolve_links: bool = True, events_path: str | None = None, **hook) -> DataFrame:
    """The batch job: converts once, then writes the result and the error table.  Gives the outcomes.

    With ``events_path`` the events that end the jobs go there too, a folder per run date, for the ledger.
    ``resolve_links=False`` is for file systems that are known to hold none.
    """
    made = through_table(outcomes(admit(requests, files, limits, roots, resolve_links), limits, **hook), "outcomes")
    write_results(made, results_path, run_date)
    write_errors(made, errors_path, run_date)
    if events_path is not None:
        write_dated(outcome_events(made, F.current_timestamp()), events_path, run_date)
    return made


