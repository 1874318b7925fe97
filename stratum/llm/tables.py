"""Reading given tables, storing intermediate ones, and keys for rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import work_root


#: Rows of an Arrow batch. With documents of some kilobytes that keeps batches, on both sides, at a few megabytes.
ROWS_PER_BATCH = 1_000


def small_batches(spark: SparkSession) -> None:
    """Lets tasks that hand texts to Python hold little of them at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows as a table in the folder that all executors share: cuts the lineage and survives lost executors."""
    path = work_root(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Equal for rows with equal id and text only (up to hash collisions within one id)."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def crc_of_id(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
