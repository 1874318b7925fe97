"""Which file and which row of it a record came from.

Parquet readers know the row's index. Text readers only know the file, the start of the split and the
order inside it, so the row number is put together in three cheap steps instead of one big sort by file:

1. the scan tags each row with its split and a running id (``split_position``);
2. one small row per split holds how many rows the splits before it have (``split_offsets``);
3. joining the two gives the number (``number_rows``).

No step moves the rows of a file to one task, however large the file is. The tags must be stored between
steps 1 and 2: a second scan could be split differently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILE, ROW, LOADED = "source_file_name", "source_file_row_number", "ingestion_timestamp"
_SPLIT, _RUNNING = "__split", "__running"


def split_position() -> list[Column]:
    """Tags to select directly on a text scan."""
    return [
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(_SPLIT),
        F.monotonically_increasing_id().alias(_RUNNING),
    ]


def indexed_position() -> list[Column]:
    """File and row number, straight from a Parquet scan."""
    return [
        F.col("_metadata.file_path").alias(FILE),
        (F.col("_metadata.row_index") + 1).alias(ROW),
    ]


def split_offsets(tagged: DataFrame) -> DataFrame:
    """One row per split: its first running id and the number of rows in the file before it."""
    before = Window.partitionBy(FILE).orderBy(_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    return (
        tagged.groupBy(FILE, _SPLIT)
        .agg(F.min(_RUNNING).alias("first_id"), F.count(F.lit(1)).alias("split_rows"))
        .select(
            FILE, _SPLIT, "first_id",
            F.coalesce(F.sum("split_rows").over(before), F.lit(0)).alias("rows_before"),
        )
    )


def number_rows(tagged: DataFrame, offsets: DataFrame) -> DataFrame:
    number = F.col("rows_before") + F.col(_RUNNING) - F.col("first_id") + 1
    return (
        tagged.join(offsets, [FILE, _SPLIT])
        .withColumn(ROW, number)
        .drop(_SPLIT, _RUNNING, "first_id", "rows_before")
    )
