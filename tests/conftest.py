from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from leafmill.session import build_session

    session = build_session(
        "tests", spark__master="local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("work")), spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate an expression of one string column over Python values."""
    from pyspark.sql import functions as F

    def run(expression, inputs, kind="string"):
        rows = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {kind}")
        return [row[0] for row in rows.select(expression(F.col("x")).alias("v"), "i").orderBy("i").collect()]

    return run
