"""Reports over the marts. Averages here are plain means over mart rows, as the marts' users expect.

NULL sorts as the largest value: last when ascending, first when descending. Where the result is cut, the
sort ends in columns that make it total, so the cut is repeatable.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.plans import marts

# Report lengths.
TOP_PRODUCTS, TREND_DAYS, TOP_CUSTOMERS, REPEAT_BUYERS = 10, 30, 10, 20


def _money(column: str, money_type: str | None) -> Column:
    value = F.col(column)
    return F.sum(value.cast(money_type)).cast("double") if money_type else F.sum(value)


def _first_of(counted: str, *within: str) -> Column:
    """1 on one row of each value of ``counted`` in each group, else 0; their sum is the exact distinct count.

    The rows are sorted, which takes a task far less memory than hashing nearly unique keys.
    """
    place = F.row_number().over(Window.partitionBy(*within, counted).orderBy(counted))
    return F.when(F.col(counted).isNotNull() & (place == 1), 1).otherwise(0).cast("long")


def top_products(daily: DataFrame, n: int = TOP_PRODUCTS, money_type: str | None = None) -> DataFrame:
    """Products with the highest revenue."""
    return daily.groupBy("product_name", "product_category").agg(
        _money("total_sales", money_type).alias("total_revenue"),
        F.sum("total_quantity").alias("total_units_sold"),
        F.sum("num_transactions").alias("total_transactions"),
    ).orderBy(
        F.desc_nulls_first("total_revenue"), F.asc_nulls_last("product_name"), F.asc_nulls_last("product_category")
    ).limit(n)


def revenue_by_segment(daily: DataFrame, money_type: str | None = None) -> DataFrame:
    return daily.groupBy("customer_type").agg(
        _money("total_sales", money_type).alias("total_revenue"),
        F.sum("num_transactions").alias("total_transactions"),
        F.avg("avg_transaction_value").alias("avg_basket_size"),
    ).orderBy(F.desc_nulls_first("total_revenue"), F.asc_nulls_last("customer_type"))


def daily_trend(daily: DataFrame, days: int = TREND_DAYS, money_type: str | None = None) -> DataFrame:
    """The most recent days that have sales.

    Finds those days first, from the keys alone. Their lower bound then reaches the scan of the orders, so
    sums and distinct counts are made for these days and not for the whole history.
    """
    day = F.col("transaction_date")
    newest = F.desc_nulls_first("transaction_date")
    oldest_shown = daily.select(day).distinct().orderBy(newest).limit(days).agg(F.min(day)).scalar()
    return daily_totals(daily.where((day >= oldest_shown) | day.isNull()), days, money_type)


def daily_totals(daily: DataFrame, days: int, money_type: str | None = None) -> DataFrame:
    """The newest days of these mart rows; no day counts as the newest."""
    return daily.groupBy("transaction_date").agg(
        _money("total_sales", money_type).alias("daily_revenue"),
        F.sum("total_quantity").alias("daily_units_sold"),
        F.sum("num_transactions").alias("daily_transactions"),
    ).orderBy(F.desc_nulls_first("transaction_date")).limit(days)


# How much further back each look goes when the last one did not find enough days.
_WIDER = 4


def daily_trend_backwards(
    since: Callable[[dt.date], DataFrame], span: tuple[dt.date, dt.date] | None, product: DataFrame, customer: DataFrame,
    days: int = TREND_DAYS, money_type: str | None = None,
) -> DataFrame:
    """``daily_trend`` without a look at the whole history.

    ``since(day)`` gives the orders from that day on and those without a day, ``span`` the first and the last day of all
    (None if no order has one). Looks at the newest orders first: they are semi-joined with the two key columns to see on
    which days something was sold, and only if these are fewer than asked for does the next look go further back. The
    mart is then made of the days shown alone. All looks together read at most about a third more than the last one.
    """
    day = F.col("transaction_date")
    first, newest = span or (dt.date.max, dt.date.max)
    width = max(days, 1)
    while True:
        start = max(first, newest - dt.timedelta(days=min(width - 1, (newest - first).days)))
        sold = since(start).select("transaction_date", "product_id", "customer_id")
        for table, key in ((product, "product_id"), (customer, "customer_id")):
            sold = sold.join(table.select(key), key, "left_semi")
        # No more rows than the report has.
        shown = sold.select(day).distinct().orderBy(F.desc_nulls_first(day)).limit(days).collect()
        if len(shown) >= days or start == first:
            break
        width *= _WIDER
    dated = [row[0] for row in shown if row[0] is not None]
    orders = since(min(dated)) if dated else since(newest).where(day.isNull())
    return daily_totals(marts.daily_sales(orders, product, customer, money_type), days, money_type)


def top_customers(affinity: DataFrame, n: int = TOP_CUSTOMERS, money_type: str | None = None) -> DataFrame:
    marked = affinity.withColumn("new_product", _first_of("product_id", "customer_id", "customer_type"))
    return marked.groupBy("customer_id", "customer_type").agg(
        F.sum("new_product").alias("distinct_products_bought"),
        F.sum("purchase_count").alias("total_orders"),
        _money("total_spent", money_type).alias("lifetime_spend"),
        F.avg("avg_purchase_amount").alias("avg_order_value"),
    ).orderBy(
        F.desc_nulls_first("lifetime_spend"), F.asc_nulls_last("customer_id"), F.asc_nulls_last("customer_type")
    ).limit(n)


def category_by_segment(affinity: DataFrame, money_type: str | None = None) -> DataFrame:
    return affinity.groupBy("customer_type", "product_category").agg(
        F.sum("purchase_count").alias("total_orders"),
        F.sum("total_quantity").alias("total_units"),
        _money("total_spent", money_type).alias("total_revenue"),
    ).orderBy(
        F.asc_nulls_last("customer_type"), F.desc_nulls_first("total_revenue"), F.asc_nulls_last("product_category")
    )


def repeat_buyers(affinity: DataFrame, n: int = REPEAT_BUYERS) -> DataFrame:
    """Customers who bought a product more than once in a month."""
    shown = [
        "customer_id", "product_name", "product_category", "purchase_month", "purchase_count", "total_spent",
        "days_between_first_last_purchase",
    ]
    return affinity.where(F.col("purchase_count") > 1).orderBy(
        F.desc_nulls_first("purchase_count"), F.desc_nulls_first("total_spent"),
        F.asc_nulls_last("customer_id"), F.asc_nulls_last("purchase_month"), F.asc_nulls_last("product_name"),
        F.asc_nulls_last("product_category"), F.asc_nulls_last("days_between_first_last_purchase"),
    ).limit(n).select(*shown)


def monthly_trend(affinity: DataFrame, money_type: str | None = None) -> DataFrame:
    """Customers are counted by marks on rows that the mart's last join has put together by customer, products
    by one more grouping, so that no row is expanded for the two distinct counts."""
    marked = affinity.withColumn("new_customer", _first_of("customer_id", "purchase_month"))
    spent = F.col("total_spent").cast(money_type) if money_type else F.col("total_spent")
    by_product = marked.groupBy("purchase_month", "product_id").agg(
        F.sum("new_customer").alias("customers"), F.sum(spent).alias("spent"),
        F.sum("avg_purchase_amount").alias("means"), F.count("avg_purchase_amount").alias("n_means"),
    )
    revenue = F.sum("spent")
    return by_product.groupBy("purchase_month").agg(
        F.sum("customers").alias("active_customers"),
        F.count("product_id").alias("products_purchased"),
        (revenue.cast("double") if money_type else revenue).alias("monthly_revenue"),
        F.try_divide(F.sum("means"), F.sum("n_means")).alias("avg_order_value"),
    ).orderBy(F.desc_nulls_first("purchase_month"))
