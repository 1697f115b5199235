"""What several operators need: tables, shared-folder lineage cuts, text as bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leafmill.session import work_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ids_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator works on, under names of its own, so that no other column can clash."""
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage and hold row order and partitions, in the folder that all executors share."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(work_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager=True)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def utf8_length(text: Column) -> Column:
    """UTF-8 bytes, 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def extended(df: DataFrame, more: str) -> StructType:
    """The schema of ``df`` with the columns that ``more`` declares behind."""
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])
