"""The Spark side of every checked query."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures, scenarios, states
from stratum import schemas
from stratum.functions import casting, cleaning
from stratum.operators import upsert as merging
from stratum.plans import marts, quality, reports, runs
from stratum.sources import files

# Sums of money are compared exactly, so they are added as decimals.
MONEY = "decimal(18,2)"
CLEAN = {"customer": cleaning.clean_customer, "product": cleaning.clean_product, "orders": cleaning.clean_orders}
RAW = {"customer": "raw_customer", "product": "raw_product", "orders": "raw_order"}
RAW_UNIQUE = {**RAW, "orders": "raw_order_unique"}
KEYS = {"customer": "customer_id", "product": "product_id", "orders": "transaction_id"}
Query = Callable[[SparkSession, str], DataFrame]


def raw(spark: SparkSession, sf: str, which: str) -> DataFrame:
    return fixtures.derived(spark, sf, RAW[which])


def silver(spark: SparkSession, sf: str, which: str) -> DataFrame:
    return CLEAN[which](raw(spark, sf, which))


def _dimensions(spark: SparkSession, sf: str, folded: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    orders = cleaning.clean_orders(fixtures.derived(spark, sf, "raw_order_folded" if folded else "raw_order"))
    return orders, silver(spark, sf, "product"), silver(spark, sf, "customer")


def daily(spark: SparkSession, sf: str, folded: bool = False) -> DataFrame:
    orders, product, customer = _dimensions(spark, sf, folded)
    return marts.daily_sales(orders, product, customer, MONEY)


def affinity(spark: SparkSession, sf: str, folded: bool = False) -> DataFrame:
    orders, product, customer = _dimensions(spark, sf, folded)
    return marts.customer_affinity(customer, orders, product, MONEY)


def trend(spark: SparkSession, sf: str) -> DataFrame:
    """From the orders themselves, newest first; the folded row makes the same report of the whole mart."""
    orders, product, customer = _dimensions(spark, sf, folded=False)
    day = F.col("transaction_date")
    first, last = orders.agg(F.min(day), F.max(day)).first()
    return reports.daily_trend_backwards(
        lambda start: orders.where((day >= F.lit(start)) | day.isNull()), first and (first, last), product, customer,
        money_type=MONEY)


def _mart_queries(folded: bool) -> dict[str, Query]:
    """The marts and the reports over them, on real keys or on folded ones."""
    day = functools.partial(daily, folded=folded)
    pair = functools.partial(affinity, folded=folded)
    found: dict[str, Query] = {
        "daily_sales": day,
        "customer_affinity": pair,
        "top_products": lambda s, sf: reports.top_products(day(s, sf), money_type=MONEY),
        "revenue_by_segment": lambda s, sf: _rounded(
            reports.revenue_by_segment(day(s, sf), money_type=MONEY), "avg_basket_size"),
        "daily_trend": (lambda s, sf: reports.daily_trend(day(s, sf), money_type=MONEY)) if folded else trend,
        "top_customers": lambda s, sf: _rounded(
            reports.top_customers(pair(s, sf), money_type=MONEY), "avg_order_value"),
        "category_by_segment": lambda s, sf: reports.category_by_segment(pair(s, sf), money_type=MONEY),
        "repeat_buyers": lambda s, sf: reports.repeat_buyers(pair(s, sf)),
        "monthly_trend": lambda s, sf: _rounded(
            reports.monthly_trend(pair(s, sf), money_type=MONEY), "avg_order_value"),
    }
    return {f"{name}_folded" if folded else name: query for name, query in found.items()}


def cast_int_and_date(spark: SparkSession, sf: str) -> DataFrame:
    target = schemas.struct(int_txt=schemas.INT, date_txt=schemas.DAY)
    return casting.cast_with_errors(fixtures.derived(spark, sf, "raw_spelled"), target).drop(casting.ERRORS)


def json_bad_elements(spark: SparkSession, sf: str) -> DataFrame:
    space = scenarios.json_with_broken_elements(spark, raw(spark, sf, "product"))
    return space.raw(runs.PRODUCT.source).select(*runs.PRODUCT.source.schema.fieldNames())


def json_mixed_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Elements in one line beside elements over several, some of either kind cut off."""
    space = scenarios.json_with_broken_elements(spark, raw(spark, sf, "product"), scenarios.spread_products())
    return space.raw(runs.PRODUCT.source).select(*runs.PRODUCT.source.schema.fieldNames())


def json_mixed_rejects(spark: SparkSession, sf: str) -> DataFrame:
    space = scenarios.json_with_broken_elements(spark, raw(spark, sf, "product"), scenarios.spread_products())
    return scenarios.rejects(space, runs.PRODUCT.source).agg(F.count(F.lit(1)).alias("rejected"))


def json_rejects(spark: SparkSession, sf: str) -> DataFrame:
    space = scenarios.json_with_broken_elements(spark, raw(spark, sf, "product"))
    return scenarios.rejects(space, runs.PRODUCT.source).agg(F.count(F.lit(1)).alias("rejected"))


def fed(which: runs.Conformed, name: str) -> Query:
    """The stored table after both deliveries went through load, feed and merge."""
    def query(spark: SparkSession, sf: str) -> DataFrame:
        space = scenarios.two_deliveries(spark, {which.name: fixtures.derived(spark, sf, name)})
        return runs.table(spark, space.layout, which).read().drop("last_updated_timestamp")

    return query


def through_view(view: str, money: str, means: tuple[str, ...]) -> Query:
    """What SQL users see after two loads and merges. The views add doubles, so sums are cut to cents here."""
    def query(spark: SparkSession, sf: str) -> DataFrame:
        scenarios.live_views(spark, _all_raw(spark, sf))
        shown = spark.table(f"gold.{view}")
        shown = shown.withColumn(money, F.col(money).cast(MONEY).cast("double"))
        return functools.reduce(_rounded, means, shown)

    return query


def _rounded(df: DataFrame, column: str) -> DataFrame:
    # The small shift keeps means of ratios off rounding ties, where engines may differ.
    return df.withColumn(column, F.round(F.col(column) + 3e-7, 4))


def null_markers(spark: SparkSession, sf: str) -> DataFrame:
    return casting.null_if(fixtures.derived(spark, sf, "raw_text"), files.NULL_MARKERS, ["name_txt"])


_TEXT_SCHEMA = schemas.struct(id_txt=schemas.LONG, date_txt=schemas.DAY)


def cast_good(spark: SparkSession, sf: str) -> DataFrame:
    return casting.cast_or_reject(fixtures.derived(spark, sf, "raw_text"), _TEXT_SCHEMA)[0]


def cast_bad(spark: SparkSession, sf: str) -> DataFrame:
    rejected = casting.cast_or_reject(fixtures.derived(spark, sf, "raw_text"), _TEXT_SCHEMA)[1]
    return rejected.select("row_id", F.inline("errors")).select(
        "row_id", F.col("column").alias("column_name"), F.col("value").alias("bad_value")
    )


def parquet_typed_scan(spark: SparkSession, sf: str) -> DataFrame:
    target = schemas.struct(
        o_orderdate=schemas.DAY, o_orderkey=schemas.TEXT, o_custkey=schemas.INT, o_totalprice=schemas.REAL,
        o_orderstatus=schemas.TEXT,
    )
    return files.read_parquet_cast(spark, f"{sf}/orders.parquet", target)[0]


def json_field_extract(spark: SparkSession, sf: str) -> DataFrame:
    events = fixtures.given(spark, sf, "events")
    fields = {"k": ("$.k", schemas.INT), "missing": ("$.missing", schemas.TEXT)}
    return casting.json_fields(events, "props", fields).select("event_id", "event_type", *fields)


def _sides(spark: SparkSession, sf: str, which: str) -> tuple[DataFrame, DataFrame]:
    rows = fixtures.derived(spark, sf, RAW_UNIQUE[which])
    return tuple(CLEAN[which](cut(rows, which)) for cut in (fixtures.first_delivery, fixtures.second_delivery))


def upsert(which: str) -> Query:
    return lambda spark, sf: merging.upsert(*_sides(spark, sf, which), KEYS[which])


def upsert_product(spark: SparkSession, sf: str) -> DataFrame:
    """With products that have no id on both sides: they must not match one another."""
    target, source = _sides(spark, sf, "product")
    key = F.col("product_id")
    target = target.withColumn("product_id", F.when(key % 50 != 1, key))
    source = source.withColumn("product_id", F.when(key % 50 != 0, key))
    return merging.upsert(target, source, "product_id")


def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Many line items per order merge into the orders: the last one wins."""
    target = fixtures.given(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("ref_id"),
        F.lit(0).alias("line"), F.lit(0.0).alias("quantity"), F.col("o_totalprice").alias("amount"),
    )
    source = fixtures.given(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("ref_id"),
        F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("amount"), F.col("l_shipdate").alias("shipped"),
    )
    order = ("line", "shipped", "amount", "ref_id", "quantity")
    return merging.upsert(target, source, "order_id", "latest", order)


def upsert_stats(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        merging.upsert_stats(*_sides(spark, sf, which), KEYS[which])
        .select(F.lit(which).alias("table_name"), "rows_inserted", "rows_updated") for which in KEYS
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def _all_raw(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {which: fixtures.derived(spark, sf, name) for which, name in RAW_UNIQUE.items()}


def feed_incremental_upsert(spark: SparkSession, sf: str) -> DataFrame:
    rows = {"orders": fixtures.derived(spark, sf, "raw_order_unique")}
    space = scenarios.two_deliveries(spark, rows)
    return runs.table(spark, space.layout, runs.ORDERS).read().drop("last_updated_timestamp")


def end_to_end_layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    space, result = scenarios.Workspace(spark), None
    sources = {which.name: which.source for which in runs.CONFORMED}
    for cut in (fixtures.first_delivery, fixtures.second_delivery):
        for which, rows in _all_raw(spark, sf).items():
            space.landing.write(sources[which], cut(rows, which))
        result = runs.run_end_to_end(spark, space.layout, space.landing.root)
    return result


def silver_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.table_counts({which: silver(spark, sf, which) for which in RAW})


def layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.layer_counts(
        {name: raw(spark, sf, which) for which, name in RAW.items()},
        {which: silver(spark, sf, which) for which in RAW},
    )


QUERIES: dict[str, Query] = {
    **{f"silver_{which}": functools.partial(silver, which=which) for which in RAW},
    "null_markers": null_markers,
    "cast_or_reject_good": cast_good,
    "cast_or_reject_bad": cast_bad,
    "parquet_typed_scan": parquet_typed_scan,
    "json_field_extract": json_field_extract,
    "ingest_csv_roundtrip": lambda s, sf: scenarios.round_trip(s, raw(s, sf, "customer"), runs.CUSTOMER),
    "ingest_json_roundtrip": lambda s, sf: scenarios.round_trip(s, raw(s, sf, "product"), runs.PRODUCT),
    "ingest_parquet_roundtrip": lambda s, sf: scenarios.round_trip(s, raw(s, sf, "orders"), runs.ORDERS),
    "ingest_parquet_mixed_types": lambda s, sf: scenarios.mixed_types(s, raw(s, sf, "orders")),
    "ingest_row_numbers": lambda s, sf: scenarios.row_numbers(s, raw(s, sf, "customer"), runs.CUSTOMER),
    "pending_rows": lambda s, sf: scenarios.pending(s, _all_raw(s, sf)),
    "feed_incremental_upsert": feed_incremental_upsert,
    "ingest_json_bad_elements": json_bad_elements,
    "ingest_json_rejects": json_rejects,
    "ingest_json_mixed_layout": json_mixed_layout,
    "ingest_json_mixed_rejects": json_mixed_rejects,
    "ingest_json_row_numbers": lambda s, sf: scenarios.row_numbers(s, raw(s, sf, "product"), runs.PRODUCT),
    "ingest_parquet_row_numbers": lambda s, sf: scenarios.row_numbers(s, raw(s, sf, "orders"), runs.ORDERS),
    "ingest_csv_ragged": lambda s, sf: scenarios.ragged_csv(s, raw(s, sf, "customer")),
    "ingest_csv_compressed": lambda s, sf: states.compressed_csv(s, raw(s, sf, "customer")),
    "ingest_csv_quotes": lambda s, sf: states.quoted_csv(s, raw(s, sf, "customer")),
    "ingest_json_not_utf8": lambda s, sf: states.json_not_utf8(s, raw(s, sf, "product")),
    "ingest_lineage": lambda s, sf: states.lineage(s, raw(s, sf, "customer")),
    "ingest_recreated": lambda s, sf: states.recreated(s, raw(s, sf, "product")),
    "cast_int_and_date": cast_int_and_date,
    "feed_positions": lambda s, sf: states.feed_positions(s, fixtures.derived(s, sf, "raw_order_unique")),
    "merge_messages": lambda s, sf: states.messages(s, _all_raw(s, sf)),
    "merge_stamps": lambda s, sf: states.stamps(s, raw(s, sf, "customer")),
    "merge_replayed": lambda s, sf: states.replayed(s, fixtures.derived(s, sf, "raw_order_unique"), runs.ORDERS),
    "feed_customer": fed(runs.CUSTOMER, "raw_customer"),
    "feed_product": fed(runs.PRODUCT, "raw_product_nulls"),
    "backfill_customer_twice": lambda s, sf: scenarios.backfilled_twice(s, raw(s, sf, "customer"), runs.CUSTOMER),
    "backfill_product_twice": lambda s, sf: scenarios.backfilled_twice(s, raw(s, sf, "product"), runs.PRODUCT),
    "sql_daily_sales": through_view(
        runs.DAILY_SALES_VIEW, "total_sales", ("avg_price_per_unit", "avg_transaction_value")),
    "sql_affinity": through_view(runs.AFFINITY_VIEW, "total_spent", ("avg_purchase_amount",)),
    "upsert_customer": upsert("customer"),
    "upsert_product": upsert_product,
    "upsert_orders": upsert("orders"),
    "upsert_latest": upsert_latest,
    "upsert_stats": upsert_stats,
    "backfill_orders_twice": lambda s, sf: scenarios.backfilled_twice(s, raw(s, sf, "orders"), runs.ORDERS),
    **_mart_queries(folded=False),
    **_mart_queries(folded=True),
    "profile_customer": lambda s, sf: quality.profile_customer(silver(s, sf, "customer")),
    "profile_product": lambda s, sf: quality.profile_product(silver(s, sf, "product")),
    "profile_orders": lambda s, sf: quality.profile_orders(silver(s, sf, "orders")),
    "profile_customer_raw": lambda s, sf: quality.profile_customer(raw(s, sf, "customer")),
    "profile_product_raw": lambda s, sf: quality.profile_product(raw(s, sf, "product")),
    "profile_orders_raw": lambda s, sf: quality.profile_orders(raw(s, sf, "orders")),
    "silver_counts": silver_counts,
    "layer_counts": layer_counts,
    "end_to_end_layer_counts": end_to_end_layer_counts,
}
