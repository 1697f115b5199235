"""Every registered query beside its SQL, over the smallest tables; and the shape of the plans."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry
from leafmill.catalog import ORACLE, QUERIES
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_its_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE[name], SF) == []


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["html_markdown", "text_paragraphs", "markdown_document_blocks", "output_budget", "options_normalised", "converter_hook"])
def test_row_work_needs_no_shuffle(spark, name):
    """But for the spreading of a small input."""
    plan = plan_of(QUERIES[name](spark, SF))
    assert "hashpartitioning" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_multiplies_rows(spark, name):
    if name in ("results_sink", "errors_sink", "ledger_stream", "live_ledger", "document_stream", "file_corpus", "file_scan", "request_load", "convert_once", "convert_known", "archive_ranges", "archive_parts"):
        return  # their plans read what they wrote
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_verdict_and_merge_share_one_shuffle(spark):
    plan = plan_of(QUERIES["archive_scan_verdict"](spark, SF))
    assert plan.count("hashpartitioning(archive_id") == 1


def test_blocks_are_made_once(spark):
    df = QUERIES["element_echo"](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?is)<!--") == 1
