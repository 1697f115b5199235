"""Document files, request relations, and the result and error tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from leafmill.session import ship_package
from leafmill.sources.stores import attempt, file_length, store_and_path

REQUESTS = (
    "request_id string, path string, content_base64 string, filename string, mime string, "
    "size_bytes bigint, blob_sha256 string, options string"
)


def scan_documents(spark: SparkSession, directory: str, glob: str | None = None) -> DataFrame:
    """Files beneath a directory: ``path``, ``modificationTime``, ``length``, ``content``.

    Content is only read when a query uses it, and a filter on ``length``
    keeps larger files closed.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(directory)


def parse_requests(rows: DataFrame) -> DataFrame:
    """Requests with ``options`` as VARIANT; a bag that is no JSON object counts as empty."""
    parsed = F.try_parse_json(F.coalesce("options", F.lit("{}")))
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    return rows.withColumn("options", F.when(is_object, parsed).otherwise(F.parse_json(F.lit("{}"))))


def load_requests(spark: SparkSession, source: str, fmt: str = "json") -> DataFrame:
    """The request relation from JSON lines or Parquet, by a fixed schema."""
    return parse_requests(spark.read.schema(REQUESTS).format(fmt).load(source))


def read_files(df: DataFrame, location: str = "location", flush_bytes: int = 32 << 20) -> DataFrame:
    """Add ``content`` of the file each row names, null where there is none to read.

    Executors open the files where their rows are, so no content is moved and
    no file opened that nobody asked for.  A store that fails otherwise than by
    having no such file fails the task, not the document.  The location is a local path or the
    URI of any store that Arrow reads.
    """
    def read(where: str | None) -> bytes | None:
        if where is None:
            return None

        def whole() -> bytes:
            store, path = store_and_path(where)
            with store.open_input_stream(path) as stream:
                return stream.read()

        return attempt(whole)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held, size = 0, [], 0
            for i, where in enumerate(batch.column(location).to_pylist()):
                held.append(read(where))
                size += len(held[-1] or b"")
                if size >= flush_bytes or i + 1 == batch.num_rows:
                    yield batch.slice(start, len(held)).append_column("content", pa.array(held, pa.binary()))
                    start, held, size = i + 1, [], 0

    ship_package(df.sparkSession)
    return df.mapInArrow(opened, StructType([*df.schema.fields, StructField("content", BinaryType())]))


def length_of(location: Column) -> Column:
    """Bytes of the regular file at a location, looked up in the executors; null for anything else."""
    @F.pandas_udf(LongType())
    def look_up(locations: pd.Series) -> pd.Series:
        return locations.map(file_length, na_action="ignore").astype("Int64")

    return look_up(location)


def write_dated(rows: DataFrame, path: str, run_date: Column | str) -> None:
    """Rows of one run; a date that runs again replaces its own folder."""
    dated = rows.withColumn("run_date", F.lit(run_date))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path)


def write_results(outcomes: DataFrame, path: str, run_date: Column | str) -> None:
    """The succeeded results, one folder per run date; a date that runs again replaces its own folder."""
    write_dated(outcomes.filter(F.col("error").isNull()).select("request_id", "result.*"), path, run_date)


def write_errors(outcomes: DataFrame, path: str, run_date: Column | str) -> None:
    """The typed failures in the same way, so none is lost and none looks like an empty document."""
    write_dated(outcomes.filter(F.col("error").isNotNull()).select("request_id", "error.*"), path, run_date)
