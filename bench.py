"""Wall time of the headline queries; prints one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "result_records", "html_blocks", "text_paragraphs", "markdown_document_blocks", "asciidoc_document_blocks", "xml_document_blocks",
    "csv_table", "table_spans", "utf8_clip", "options_normalised", "inline_payloads", "format_routing", "archive_verdict",
    "archive_merge", "converter_hook", "convert_once", "job_snapshot", "job_retention", "ledger_stream", "file_corpus",
    "document_stream", "corpus_outcomes", "archive_corpus",
)


def main() -> None:
    from leafmill.catalog import QUERIES
    from leafmill.session import build_session

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = build_session(
        "bench", spark__master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # the session's own start is not a query
    small = sf if not Path("/root/testdata/sf0.001").is_dir() else "/root/testdata/sf0.001"
    seconds, building = {}, {}
    for name in HEADLINE:
        QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()  # warm-up
        began = time.perf_counter()
        made = QUERIES[name](spark, sf)
        building[name] = round(time.perf_counter() - began, 3)
        made.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_wall_time", "value": total, "unit": "sec", "queries": seconds, "of_which_build": building,
        "sf": Path(sf).name.removeprefix("sf"), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
