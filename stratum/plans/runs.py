"""Whole runs: load what arrived, merge what is pending, show the counts.

Each function does one run and returns; an outside scheduler decides when.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum import schemas, storage
from stratum.functions import cleaning
from stratum.layout import Layout
from stratum.operators.snapshot import Folder, SnapshotTable, by_date, by_hash, one_slice
from stratum.operators.upsert import UpsertStats
from stratum.plans import marts, quality, reports
from stratum.sources import files
from stratum.sources.files import Source
from stratum.streaming import loads
from stratum.streaming.changefeed import ChangeFeed
from stratum.streaming.loads import LoadStats

DAILY_SALES_VIEW, AFFINITY_VIEW = marts.VIEWS
PARTITIONS_PER_STATEMENT = 500
# What "latest" means when a feed holds a key twice.
ARRIVAL_ORDER = ("ingestion_timestamp", "batch_id", "source_file_name", "source_file_row_number")


@dataclass(frozen=True)
class Conformed:
    """A conformed table, the raw table it is fed from, and how."""

    name: str
    source: Source
    schema: T.StructType
    key: str
    clean: Callable[..., DataFrame]
    slice_by: Callable = one_slice
    day: str | None = None


# A merge of a few changes rewrites the slices their keys fall into, not the table.
SLICES = 16
CUSTOMER = Conformed(
    "customer", files.CUSTOMERS, schemas.SILVER_CUSTOMER, "customer_id", cleaning.clean_customer,
    by_hash("customer_id", SLICES),
)
PRODUCT = Conformed(
    "product", files.PRODUCTS, schemas.SILVER_PRODUCT, "product_id", cleaning.clean_product,
    by_hash("product_id", SLICES),
)
ORDERS = Conformed(
    "orders", files.ORDERS, schemas.SILVER_ORDERS, "transaction_id", cleaning.clean_orders,
    by_date("transaction_date"), "transaction_date",
)
CONFORMED = (CUSTOMER, PRODUCT, ORDERS)


def table(spark: SparkSession, layout: Layout, which: Conformed) -> SnapshotTable:
    return SnapshotTable(spark, layout.conformed(which.name), which.schema, which.key, which.slice_by, which.day)


def feed(
    spark: SparkSession, layout: Layout, which: Conformed, consumer: str = "merge", start_from: str = "earliest",
) -> ChangeFeed:
    """The change feed of the raw table behind a conformed table."""
    source = which.source
    return ChangeFeed(
        spark, layout.raw(source.table), source.raw_schema, layout.state(f"feed_{source.table}"),
        consumer, start_from,
    )


def merge(
    spark: SparkSession, layout: Layout, which: Conformed, on_duplicate: str = "error",
    start_from: str = "earliest",
) -> list[UpsertStats]:
    """Clean and merge all pending rows of one table. An empty feed changes nothing."""
    target, results = table(spark, layout, which), []
    target.ensure()
    loads.ensure_raw(spark, which.source, layout)

    def apply(rows: DataFrame, delivery) -> None:
        cleaned = cleaning.stamp(which.clean(rows, keep=ARRIVAL_ORDER))
        results.append(target.merge(cleaned, delivery, on_duplicate, ARRIVAL_ORDER))

    feed(spark, layout, which, start_from=start_from).consume(apply)
    refresh(spark, layout)
    return results


# The names of these three are fixed: callers know the merges by them.
def process_customer_changes(spark: SparkSession, layout: Layout, **options) -> list[UpsertStats]:
    return merge(spark, layout, CUSTOMER, **options)


def merge_product_to_silver(spark: SparkSession, layout: Layout, **options) -> list[UpsertStats]:
    return merge(spark, layout, PRODUCT, **options)


def merge_order_to_silver(spark: SparkSession, layout: Layout, **options) -> list[UpsertStats]:
    return merge(spark, layout, ORDERS, **options)


def backfill(spark: SparkSession, layout: Layout, which: Conformed) -> UpsertStats:
    """Insert all raw rows, cleaned, without looking at keys or at the feed. Running it twice inserts twice."""
    raw = loads.read_raw(spark, which.source, layout)
    result = table(spark, layout, which).append(cleaning.stamp(which.clean(raw)))
    refresh(spark, layout)
    return result


def create_layers(spark: SparkSession, layout: Layout) -> None:
    """Namespaces and empty tables, where absent."""
    for name in ("bronze", "silver", "gold"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{layout.root}/catalog/{name}'")
    for source in files.SOURCES:
        loads.ensure_raw(spark, source, layout)
    for which in CONFORMED:
        table(spark, layout, which).ensure()


def run_loads(spark: SparkSession, layout: Layout, landing_root: str, **options) -> list[LoadStats]:
    results = [loads.load(spark, source, landing_root, layout, **options) for source in files.SOURCES]
    refresh(spark, layout)
    return results


def run_merges(spark: SparkSession, layout: Layout, **options) -> list[UpsertStats]:
    return [result for which in (ORDERS, PRODUCT, CUSTOMER) for result in merge(spark, layout, which, **options)]


def run_end_to_end(spark: SparkSession, layout: Layout, landing_root: str, **merge_options) -> DataFrame:
    """Three loads, three merges, then the counts of both layers."""
    run_loads(spark, layout, landing_root)
    run_merges(spark, layout, **merge_options)
    return counts(spark, layout)


def counts(spark: SparkSession, layout: Layout) -> DataFrame:
    return quality.layer_counts(
        {source.table: loads.read_raw(spark, source, layout) for source in files.SOURCES},
        {which.name: table(spark, layout, which).read() for which in CONFORMED},
    )


def daily_sales(
    spark: SparkSession, layout: Layout, first: dt.date | None = None, last: dt.date | None = None,
) -> DataFrame:
    """The mart of all days, or of those from ``first`` to ``last``: only folders that hold such days are listed."""
    orders = table(spark, layout, ORDERS).read(first, last)
    return marts.daily_sales(orders, table(spark, layout, PRODUCT).read(), table(spark, layout, CUSTOMER).read())


def customer_affinity(
    spark: SparkSession, layout: Layout, first: dt.date | None = None, last: dt.date | None = None,
) -> DataFrame:
    """The mart of the orders from ``first`` to ``last``; whole months if these are the ends of months."""
    orders = table(spark, layout, ORDERS).read(first, last)
    return marts.customer_affinity(table(spark, layout, CUSTOMER).read(), orders, table(spark, layout, PRODUCT).read())


def daily_trend(spark: SparkSession, layout: Layout, days: int = reports.TREND_DAYS) -> DataFrame:
    """The most recent days that have sales; slices of orders older than these are not listed."""
    orders = table(spark, layout, ORDERS)
    product, customer = (table(spark, layout, which).read() for which in (PRODUCT, CUSTOMER))
    return reports.daily_trend_backwards(lambda day: orders.read(day, undated=True), orders.span(), product, customer, days)


def register(spark: SparkSession, layout: Layout) -> None:
    """Make everything known to SQL: ``bronze.raw_*`` as external tables, ``silver.*`` as views of the current version,
    ``gold.vw_*`` as views that are computed on each access.

    Once is enough: every load, merge and backfill of this module brings what is registered up to date.
    """
    create_layers(spark, layout)
    for which in CONFORMED:
        name = f"silver.{which.name}"
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
            spark.sql(f"DROP TABLE {name}")  # registered by an earlier release
        schema = T.StructType([*which.schema.fields, *SnapshotTable.FOLDERS.fields])
        _external(spark, layout, f"{name}_files", schema, SnapshotTable.FOLDERS.fieldNames(), f"{layout.conformed(which.name)}/data")
    for source in files.SOURCES:
        _external(spark, layout, f"bronze.{source.table}", source.raw_schema, ["batch_id"], layout.raw(source.table))
    refresh(spark, layout)
    for view, text in marts.VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW gold.{view} AS {text}")


# Says which layout a registered table belongs to.
_ROOT = "stratum.root"


def _external(spark: SparkSession, layout: Layout, name: str, schema: T.StructType, folders: list[str], path: str) -> None:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    storage.make_dir(spark, path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(folders)}) "
              f"LOCATION '{path}' TBLPROPERTIES ('{_ROOT}' = '{layout.root}')")


def refresh(spark: SparkSession, layout: Layout) -> None:
    """Bring what ``register`` made for this layout up to date, by the folders that changed.

    A raw table gets its new folders. Of a conformed table all folders are registered first; then one statement gives the
    view the list of those that are live, so a reader sees the old version or the new one and nothing between. Folders
    that neither this version nor the one before holds are forgotten last: a reader that began a moment ago needs them.
    """
    for source in files.SOURCES:
        name = f"bronze.{source.table}"
        if _registered(spark, layout, name):
            feed_name = loads.feed_name(spark, source, layout)
            _bring(spark, name, {n for n in storage.names(spark, layout.raw(source.table)) if n.startswith(f"batch_id={feed_name}-")})
    for which in CONFORMED:
        name = f"silver.{which.name}"
        if _registered(spark, layout, f"{name}_files"):
            stored = table(spark, layout, which)
            live = stored.folders()
            _bring(spark, f"{name}_files", {f.path for f in live}, {f.path for f in stored.folders(back=1)},
                   lambda: spark.sql(f"CREATE OR REPLACE VIEW {name} AS {_live_rows(which, f'{name}_files', live)}"))


def _registered(spark: SparkSession, layout: Layout, name: str) -> bool:
    return spark.catalog.tableExists(name) and not spark.sql(f"SHOW TBLPROPERTIES {name}").where(
        (F.col("key") == _ROOT) & (F.col("value") == layout.root)).isEmpty()


def _bring(
    spark: SparkSession, name: str, wanted: set[str], spared: Iterable[str] = (), switch: Callable[[], object] = lambda: None,
) -> None:
    known = {row.partition for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    _alter(spark, f"ALTER TABLE {name} ADD IF NOT EXISTS", wanted - known, " ")
    spark.catalog.refreshTable(name)
    switch()
    _alter(spark, f"ALTER TABLE {name} DROP IF EXISTS", known - wanted - set(spared), ", ")
    spark.catalog.refreshTable(name)


def _live_rows(which: Conformed, source: str, live: list[Folder]) -> str:
    """The rows of these folders, as SQL.

    Where the days of folders are known, they are joined by folder and day with the days each has. A condition on the day
    then holds for these days too, and Spark opens only the folders left (dynamic partition pruning).
    """
    columns = ", ".join(which.schema.fieldNames())
    dated = [f for f in live if f.days and f.days[0]]
    parts = [f"SELECT {columns} FROM {source} WHERE {_any_of(f for f in live if f.days is None)}"]
    if which.day:
        parts.append(f"SELECT {columns} FROM {source} WHERE {which.day} IS NULL AND {_any_of(f for f in live if f.days and f.days[2])}")
    if dated:
        values = ", ".join(f"('{f.commit}', '{f.slice}', DATE'{f.days[0]}', DATE'{f.days[1]}')" for f in dated)
        days = ("SELECT commit AS __commit, slice AS __slice, explode(sequence(first, last)) AS __day "
                f"FROM VALUES {values} AS held (commit, slice, first, last)")
        parts.append(f"SELECT {columns} FROM {source} JOIN ({days}) "
                     f"ON commit = __commit AND slice = __slice AND {which.day} = __day")
    return " UNION ALL ".join(parts)


def _any_of(folders: Iterable[Folder]) -> str:
    names = ", ".join(f"'{f.commit}/{f.slice}'" for f in folders)
    return f"concat(commit, '/', slice) IN ({names})" if names else "false"


def _alter(spark: SparkSession, statement: str, folders: set[str], between: str) -> None:
    ordered = sorted(folders)
    for start in range(0, len(ordered), PARTITIONS_PER_STATEMENT):
        specs = (", ".join(f"{k}='{v}'" for k, v in (part.split("=", 1) for part in folder.split("/")))
                 for folder in ordered[start:start + PARTITIONS_PER_STATEMENT])
        spark.sql(f"{statement} " + between.join(f"PARTITION ({spec})" for spec in specs))
