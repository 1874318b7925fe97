"""Data-quality profiles, row counts and the reconciliation of layers.

A counter of bad rows is NULL, not 0, when there are none: it adds up ones and nothing else.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ones(condition: Column) -> Column:
    return F.sum(F.when(condition, F.lit(1)))


def profile_customer(customer: DataFrame) -> DataFrame:
    return customer.groupBy("customer_type", "gender").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("age").alias("min_age"),
        F.max("age").alias("max_age"),
        F.min("total_purchases").alias("min_purchases"),
    ).orderBy(F.asc_nulls_last("customer_type"), F.asc_nulls_last("gender"))


def profile_product(product: DataFrame) -> DataFrame:
    rating = F.col("rating")
    return product.agg(
        F.count(F.lit(1)).alias("total_rows"),
        _ones(F.col("price") < 0).alias("negative_prices"),
        _ones(F.col("stock_quantity") < 0).alias("negative_stock"),
        _ones((rating < 0) | (rating > 5)).alias("invalid_ratings"),
        F.min("price").alias("min_price"),
        F.max("rating").alias("max_rating"),
        F.count_if(F.col("is_active")).alias("active_products"),
    )


def profile_orders(orders: DataFrame) -> DataFrame:
    """Summed up per (store type, payment method) first. The two distinct counts then look at that handful
    of rows; asked of the orders directly they would make Spark process every order three times."""
    per_channel = orders.groupBy("store_type", "payment_method").agg(
        F.count(F.lit(1)).alias("total_rows"),
        _ones(F.col("transaction_id").isNull()).alias("null_transaction_ids"),
        _ones(F.col("total_amount") <= 0).alias("invalid_amounts"),
        F.min("total_amount").alias("min_amount"),
        F.max("total_amount").alias("max_amount"),
        F.min("transaction_date").alias("earliest_date"),
        F.max("transaction_date").alias("latest_date"),
    )
    return per_channel.agg(
        F.coalesce(F.sum("total_rows"), F.lit(0)).alias("total_rows"),
        F.sum("null_transaction_ids").alias("null_transaction_ids"),
        F.sum("invalid_amounts").alias("invalid_amounts"),
        F.min("min_amount").alias("min_amount"),
        F.max("max_amount").alias("max_amount"),
        F.min("earliest_date").alias("earliest_date"),
        F.max("latest_date").alias("latest_date"),
        F.countDistinct("store_type").alias("distinct_store_types"),
        F.countDistinct("payment_method").alias("distinct_payment_methods"),
    )


def _counts(tables: Mapping[tuple[str, ...], DataFrame], *labels: str) -> DataFrame:
    parts = [
        table.agg(F.count(F.lit(1)).alias("row_count"))
        .select(*[F.lit(value).alias(label) for value, label in zip(names, labels, strict=True)], "row_count")
        for names, table in tables.items()
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return _counts({(name,): table for name, table in tables.items()}, "table_name")


def layer_counts(bronze: Mapping[str, DataFrame], silver: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table of both layers. The difference between layers is what cleaning turned away."""
    tables = {("Bronze", name): df for name, df in bronze.items()}
    tables |= {("Silver", name): df for name, df in silver.items()}
    return _counts(tables, "layer", "table_name").orderBy(F.desc("layer"), "table_name")
