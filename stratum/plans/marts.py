"""The two analytical marts, computed live from the conformed tables.

Both group orders first and join afterwards. The grouping keys hold the join keys, so the dimensions only
add columns that depend on the key, and the joins see far fewer and narrower rows. A dimension that holds a
key several times (a repeated backfill does that) multiplies sums; ``copies`` accounts for it without
bringing the repeated rows into the join.

``money_type`` (say ``decimal(18,2)``) makes money sums exact and independent of the order of rows; the
default adds doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRODUCT_COLUMNS = {"product_name": "name", "product_category": "category"}
CUSTOMER_COLUMNS = {"customer_type": "customer_type"}


def _dimension(table: DataFrame, key: str, columns: dict[str, str], copies: str) -> DataFrame:
    """Distinct attribute rows per key, and how often each occurs."""
    named = table.where(F.col(key).isNotNull()).select(
        key, *[F.col(source).alias(name) for name, source in columns.items()]
    )
    return named.groupBy(key, *columns).agg(F.count(F.lit(1)).cast("int").alias(copies))


def _with_dimensions(facts: DataFrame, product: DataFrame, customer: DataFrame) -> DataFrame:
    """Attach names and segments. Spark broadcasts a dimension that is small enough, else it sorts and
    merges; AQE splits a hot customer, whose rows here are one per group and not one per order."""
    return (
        facts.join(_dimension(product, "product_id", PRODUCT_COLUMNS, "product_copies"), "product_id")
        .join(_dimension(customer, "customer_id", CUSTOMER_COLUMNS, "customer_copies"), "customer_id")
        .withColumn("copies", F.col("product_copies") * F.col("customer_copies"))
    )


def _money(money_type: str | None) -> Column:
    amount = F.col("total_amount")
    return amount.cast(money_type) if money_type else amount


def _total(column: str) -> Column:
    return (F.col(column) * F.col("copies")).cast("double" if column == "amount" else "long")


def daily_sales(
    orders: DataFrame, product: DataFrame, customer: DataFrame, money_type: str | None = None,
) -> DataFrame:
    """Sales per day, product and customer."""
    facts = orders.groupBy("transaction_date", "product_id", "customer_id").agg(
        F.sum("quantity").alias("units"),
        F.sum(_money(money_type)).alias("amount"),
        F.countDistinct("transaction_id").alias("num_transactions"),
    )
    return _with_dimensions(facts, product, customer).withColumns({
        "total_quantity": _total("units"), "total_sales": _total("amount"),
    }).select(
        "transaction_date", "product_id", "product_name", "product_category", "customer_id", "customer_type",
        "total_quantity", "total_sales", "num_transactions",
        F.try_divide("total_sales", "total_quantity").alias("avg_price_per_unit"),
        F.try_divide("total_sales", "num_transactions").alias("avg_transaction_value"),
    )


def customer_affinity(
    customer: DataFrame, orders: DataFrame, product: DataFrame, money_type: str | None = None,
) -> DataFrame:
    """What each customer buys of each product per month."""
    day = F.col("transaction_date")
    facts = orders.groupBy(
        "customer_id", "product_id", F.trunc(day, "month").alias("purchase_month")
    ).agg(
        F.countDistinct("transaction_id").alias("purchase_count"),
        F.sum("quantity").alias("units"),
        F.sum(_money(money_type)).alias("amount"),
        F.count("total_amount").alias("amounts"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    )
    return _with_dimensions(facts, product, customer).select(
        "customer_id", "customer_type", "product_id", "product_name", "product_category", "purchase_month",
        "purchase_count",
        _total("units").alias("total_quantity"),
        _total("amount").alias("total_spent"),
        F.try_divide(F.col("amount").cast("double"), "amounts").alias("avg_purchase_amount"),
        F.datediff("last_day", "first_day").cast("long").alias("days_between_first_last_purchase"),
    )


# The marts for SQL, of the same shape as above. The names SQL users know them by.
_DIMENSIONS = """
  products AS (SELECT product_id, name AS product_name, category AS product_category, count(*) AS product_copies
    FROM silver.product WHERE product_id IS NOT NULL GROUP BY product_id, name, category),
  customers AS (SELECT customer_id, customer_type, count(*) AS customer_copies
    FROM silver.customer WHERE customer_id IS NOT NULL GROUP BY customer_id, customer_type)"""
VIEWS = {
    "vw_daily_sales_analysis": f"""
WITH facts AS (
    SELECT transaction_date, product_id, customer_id, sum(quantity) AS units, sum(total_amount) AS amount,
      count(DISTINCT transaction_id) AS num_transactions
    FROM silver.orders GROUP BY transaction_date, product_id, customer_id),{_DIMENSIONS},
  joined AS (
    SELECT *, CAST(units * product_copies * customer_copies AS BIGINT) AS total_quantity,
      amount * (product_copies * customer_copies) AS total_sales
    FROM facts JOIN products USING (product_id) JOIN customers USING (customer_id))
SELECT transaction_date, product_id, product_name, product_category, customer_id, customer_type, total_quantity, total_sales,
  num_transactions, try_divide(total_sales, total_quantity) AS avg_price_per_unit,
  try_divide(total_sales, num_transactions) AS avg_transaction_value
FROM joined""",
    "vw_customer_product_affinity": f"""
WITH facts AS (
    SELECT customer_id, product_id, trunc(transaction_date, 'month') AS purchase_month,
      count(DISTINCT transaction_id) AS purchase_count, sum(quantity) AS units, sum(total_amount) AS amount,
      count(total_amount) AS amounts, min(transaction_date) AS first_day, max(transaction_date) AS last_day
    FROM silver.orders GROUP BY customer_id, product_id, trunc(transaction_date, 'month')),{_DIMENSIONS}
SELECT customer_id, customer_type, product_id, product_name, product_category, purchase_month, purchase_count,
  CAST(units * product_copies * customer_copies AS BIGINT) AS total_quantity,
  amount * (product_copies * customer_copies) AS total_spent, try_divide(amount, amounts) AS avg_purchase_amount,
  CAST(datediff(last_day, first_day) AS BIGINT) AS days_between_first_last_purchase
FROM facts JOIN products USING (product_id) JOIN customers USING (customer_id)""",
}
