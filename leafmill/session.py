"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

WORK_DIR_SETTING = "spark.checkpoint.dir"
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20
_SHIPPED: set[str] = set()


def build_session(app: str = "leafmill", **settings: str) -> SparkSession:
    """A session with what these jobs rely on; cluster settings win where they are given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Call sites in error messages cost more time than all else in making
        # a plan of many expressions.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Rows that go to Python may carry whole files.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder the cluster names.

    Only a local session without that setting, as in tests, gets a temporary
    folder; it is then set, so that later calls agree.
    """
    base = spark.conf.get(WORK_DIR_SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {WORK_DIR_SETTING} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="leafmill-")
        spark.conf.set(WORK_DIR_SETTING, base)
    return f"{base.rstrip('/')}/leafmill/{purpose}-{uuid.uuid4().hex}"


def through_table(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Work above is done once however often the result is used, and a lost
    executor does not undo it.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of few bytes; a value that is set already stays.

    By Spark's default a batch has 10,000 rows, here 20 MB of text and more of
    n-gram sets.  Executor and worker each hold several at a time, outside of the
    heap, and keep that memory.
    """
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, once per application."""
    package = Path(__file__).resolve().parent
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or not package.is_dir():  # not a folder: it was shipped to us
        return
    bundle = Path(tempfile.mkdtemp(prefix="leafmill-py-")) / f"{package.name}.zip"
    with zipfile.ZipFile(bundle, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(bundle))
    _SHIPPED.add(app)
