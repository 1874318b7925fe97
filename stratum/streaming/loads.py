"""Append new landing files to the raw tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum import storage
from stratum.functions import casting, lineage
from stratum.functions.cleaning import utc_now
from stratum.layout import Layout
from stratum.sources import files
from stratum.sources.files import Source
from stratum.streaming.arrivals import Arrivals, Delivery

FILES_PER_BATCH = 10_000


@dataclass
class LoadStats:
    table: str
    batches: int = 0
    files: int = 0
    loaded: int = 0
    rejected: int = 0


def ensure_raw(spark: SparkSession, source: Source, layout: Layout, recreate: bool = False) -> None:
    """Create the raw table if it is absent. ``recreate`` drops its rows and starts the load over.

    Every batch folder bears the name of the load's feed, and a new feed is published in one step: from then
    on the batches of the old one are no part of the table. Deleting them comes last and is made up for by
    the next call after a crash.
    """
    arrivals = _arrivals(spark, source, layout, "")
    if recreate:
        arrivals.reset()
    feed = arrivals.feed()
    for path in (layout.raw(source.table), layout.rejects(source.table)):
        storage.make_dir(spark, path)
        for batch in storage.names(spark, path):
            if not batch.startswith(f"batch_id={feed}-"):
                storage.remove(spark, f"{path}/{batch}")


def feed_name(spark: SparkSession, source: Source, layout: Layout) -> str:
    """The name that the batches of the table begin with."""
    return _arrivals(spark, source, layout, "").feed()


def _read(spark: SparkSession, source: Source, layout: Layout, schema: T.StructType, path: str) -> DataFrame:
    batches = F.col("batch_id").startswith(f"{feed_name(spark, source, layout)}-")
    return spark.read.schema(schema).parquet(path).where(batches)


def read_raw(spark: SparkSession, source: Source, layout: Layout) -> DataFrame:
    return _read(spark, source, layout, source.raw_schema, layout.raw(source.table))


def read_rejects(spark: SparkSession, source: Source, layout: Layout) -> DataFrame:
    return _read(spark, source, layout, source.reject_schema, layout.rejects(source.table))


def _arrivals(spark: SparkSession, source: Source, layout: Layout, landing_root: str) -> Arrivals:
    return Arrivals(spark, source.location(landing_root), source.glob, layout.state(f"load_{source.table}"))


def load(
    spark: SparkSession, source: Source, landing_root: str, layout: Layout, *,
    recreate: bool = False, files_per_batch: int = FILES_PER_BATCH, **reader_options,
) -> LoadStats:
    """Load the files that arrived since the last run. Each file is loaded once; rows are not compared.

    Rows that cannot be cast go to the rejects table with file, row, column, value and reason.
    """
    ensure_raw(spark, source, layout, recreate)
    stats = LoadStats(source.table)

    def append(delivery: Delivery) -> None:
        stats.batches += 1
        stats.files += delivery.names.count()
        loaded, rejected = _append(spark, source, landing_root, layout, delivery, reader_options)
        stats.loaded += loaded
        stats.rejected += rejected

    _arrivals(spark, source, layout, landing_root).run(append, files_per_batch)
    return stats


def _append(spark, source, landing_root, layout, delivery, reader_options) -> tuple[int, int]:
    partition = f"batch_id={delivery.batch_id}"
    good, bad = f"{layout.raw(source.table)}/{partition}", f"{layout.rejects(source.table)}/{partition}"
    if not storage.exists(spark, good):  # else: a replay of a batch published before the failure
        stage = f"{layout.staging(source.table)}/{delivery.batch_id}"
        storage.remove(spark, stage)
        rows = source.read(
            spark, delivery.paths(), source.schema, landing_root=landing_root, positions=True, **reader_options
        )
        rows = casting.cast_with_errors(rows, source.schema)
        if not source.row_index:
            rows = _number(spark, rows, stage)
        # One pass writes both outcomes; they part by folder.
        (
            rows.withColumn(lineage.LOADED, utc_now())
            .withColumn("rejected", F.col(casting.ERRORS).isNotNull())
            .write.partitionBy("rejected").parquet(f"{stage}/rows")
        )
        # Publishing the good rows comes last: their folder says that the batch is complete.
        _publish(spark, f"{stage}/rows/rejected=true", bad)
        _publish(spark, f"{stage}/rows/rejected=false", good)
        storage.remove(spark, stage)
    # Counted from Parquet footers.
    return tuple(spark.read.schema(source.schema).parquet(path).count() for path in (good, bad))


def _number(spark: SparkSession, rows: DataFrame, stage: str) -> DataFrame:
    rows.write.parquet(f"{stage}/tagged")
    tagged = spark.read.schema(rows.schema).parquet(f"{stage}/tagged")
    # Stored, so that the join below sees its true size and broadcasts it only if it is small.
    offsets = lineage.split_offsets(tagged)
    offsets.write.parquet(f"{stage}/offsets")
    return lineage.number_rows(tagged, spark.read.schema(offsets.schema).parquet(f"{stage}/offsets"))


def _publish(spark: SparkSession, staged: str, final: str) -> None:
    if storage.exists(spark, final):
        return
    if storage.exists(spark, staged):
        storage.rename(spark, staged, final)
    else:
        storage.make_dir(spark, final)


def load_customers(spark: SparkSession, landing_root: str, layout: Layout, **options) -> LoadStats:
    return load(spark, files.CUSTOMERS, landing_root, layout, **options)


def load_products(spark: SparkSession, landing_root: str, layout: Layout, **options) -> LoadStats:
    return load(spark, files.PRODUCTS, landing_root, layout, **options)


def load_orders(spark: SparkSession, landing_root: str, layout: Layout, **options) -> LoadStats:
    return load(spark, files.ORDERS, landing_root, layout, **options)
