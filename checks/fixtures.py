"""Input tables for the checked queries, derived from the given tables in SQL that Spark and DuckDB share.

``{table}`` stands for a given table; Spark fills in a DataFrame, DuckDB a view name. Every row of the given
tables is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

GIVEN = ("customer", "part", "orders", "lineitem", "events")

RAW_CUSTOMER = """
SELECT CASE WHEN c_custkey % 97 = 13 THEN NULL ELSE c_custkey END AS customer_id, c_name AS name,
  CASE WHEN c_custkey % 41 = 7 THEN NULL ELSE concat('user', c_custkey, '@example.test') END AS email,
  concat('C', c_nationkey) AS country,
  CASE c_custkey % 9 WHEN 0 THEN 'REG' WHEN 1 THEN ' r ' WHEN 2 THEN 'Regular' WHEN 3 THEN 'PREM' WHEN 4 THEN 'p'
    WHEN 5 THEN 'premium ' WHEN 6 THEN 'GOLD' WHEN 7 THEN NULL ELSE '' END AS customer_type,
  CAST('2020-01-01' AS DATE) + CAST(c_custkey % 1000 AS INT) AS registration_date,
  CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE CAST(c_custkey % 140 - 5 AS INT) END AS age,
  CASE c_custkey % 7 WHEN 0 THEN 'M' WHEN 1 THEN ' male' WHEN 2 THEN 'F' WHEN 3 THEN 'Female ' WHEN 4 THEN 'X'
    WHEN 5 THEN NULL ELSE '' END AS gender,
  CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE CAST(c_custkey % 50 - 5 AS INT) END AS total_purchases
FROM {customer}"""

RAW_PRODUCT = """
SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_brand AS brand,
  CASE WHEN p_partkey % 17 = 3 THEN -p_retailprice WHEN p_partkey % 59 = 1 THEN NULL ELSE p_retailprice END AS price,
  CASE WHEN p_partkey % 61 = 2 THEN NULL ELSE CAST(p_partkey % 120 - 10 AS INT) END AS stock_quantity,
  CASE WHEN p_partkey % 67 = 4 THEN NULL ELSE CAST(p_partkey % 80 - 10 AS DOUBLE) / 10 END AS rating,
  p_partkey % 5 <> 0 AS is_active
FROM {part}"""

_ORDER = """
SELECT CASE WHEN l_orderkey % 101 = 0 AND l_linenumber = 1 THEN NULL
    ELSE concat('T', l_orderkey, '-', l_linenumber) END AS transaction_id,
  <customer> AS customer_id,
  CASE WHEN l_suppkey % 37 = 5 THEN 999999999 ELSE <product> END AS product_id,
  CASE WHEN l_partkey % 23 = 0 THEN 0 ELSE CAST(l_quantity AS INT) END AS quantity,
  CASE l_linenumber % 3 WHEN 0 THEN 'Online' WHEN 1 THEN 'In-Store' ELSE 'Mobile App' END AS store_type,
  CASE WHEN l_suppkey % 29 = 0 THEN -l_extendedprice WHEN l_suppkey % 29 = 1 THEN CAST(0 AS DOUBLE)
    WHEN l_suppkey % 29 = 2 THEN NULL ELSE l_extendedprice END AS total_amount,
  CAST(o_orderdate AS DATE) AS transaction_date,
  CASE l_linenumber % 4 WHEN 0 THEN 'Credit Card' WHEN 1 THEN 'PayPal' ELSE 'Bank Transfer' END AS payment_method
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""
RAW_ORDER = _ORDER.replace("<customer>", "o_custkey").replace("<product>", "l_partkey")
# Beside the real keys: folded to 25 customers and 10 products, so that the marts have groups of many orders.
RAW_ORDER_FOLDED = _ORDER.replace("<customer>", "o_custkey % 25").replace("<product>", "l_partkey % 10")

# Products without an id among the others.
RAW_PRODUCT_NULLS = RAW_PRODUCT.replace("p_partkey AS product_id", "CASE WHEN p_partkey % 50 <> 1 THEN p_partkey END AS product_id")

# Numbers with fractions, halves among them, and dates in several spellings.
RAW_SPELLED = """
SELECT c_custkey AS row_id,
  CASE c_custkey % 6 WHEN 0 THEN concat(c_custkey, '.5') WHEN 1 THEN concat('-', c_custkey, '.5') WHEN 2 THEN concat(c_custkey, '.49')
    WHEN 3 THEN concat('-', c_custkey, '.51') WHEN 4 THEN CAST(c_custkey AS STRING) ELSE '1.2.3' END AS int_txt,
  CASE c_custkey % 7 WHEN 0 THEN '2024-02-29' WHEN 1 THEN '02/29/2024' WHEN 2 THEN '29-FEB-2024' WHEN 3 THEN '2024'
    WHEN 4 THEN '2024-02' WHEN 5 THEN '02/30/2024' ELSE '2024-02-29 23:59:59' END AS date_txt
FROM {customer}"""

# One row per order: transaction ids are unique, as a merge needs them.
RAW_ORDER_UNIQUE = """
SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE concat('T', o_orderkey) END AS transaction_id,
  o_custkey AS customer_id, o_orderkey % 200 AS product_id, CAST(o_orderkey % 12 AS INT) AS quantity,
  CASE o_orderkey % 3 WHEN 0 THEN 'Online' WHEN 1 THEN 'In-Store' ELSE 'Mobile App' END AS store_type,
  CASE WHEN o_orderkey % 29 = 0 THEN -o_totalprice WHEN o_orderkey % 29 = 1 THEN CAST(0 AS DOUBLE)
    WHEN o_orderkey % 29 = 2 THEN NULL ELSE o_totalprice END AS total_amount,
  CAST(o_orderdate AS DATE) AS transaction_date,
  CASE o_orderkey % 4 WHEN 0 THEN 'Credit Card' WHEN 1 THEN 'PayPal' ELSE 'Bank Transfer' END AS payment_method
FROM {orders}"""

# Text columns with null markers, numbers that are none and dates that do not exist.
RAW_TEXT = """
SELECT c_custkey AS row_id,
  CASE c_custkey % 5 WHEN 0 THEN 'NULL' WHEN 1 THEN 'null' WHEN 2 THEN '' WHEN 3 THEN ' NULL' ELSE c_name END AS name_txt,
  CASE WHEN c_custkey % 11 = 0 THEN 'abc' WHEN c_custkey % 11 = 1 THEN '12x' WHEN c_custkey % 13 = 0 THEN NULL
    ELSE CAST(c_custkey AS STRING) END AS id_txt,
  CASE WHEN c_custkey % 17 = 0 THEN '2024-02-30' WHEN c_custkey % 17 = 1 THEN 'n/a' ELSE '2024-03-15' END AS date_txt
FROM {customer}"""

DERIVED = {
    "raw_customer": RAW_CUSTOMER, "raw_product": RAW_PRODUCT, "raw_order": RAW_ORDER,
    "raw_order_unique": RAW_ORDER_UNIQUE, "raw_text": RAW_TEXT, "raw_order_folded": RAW_ORDER_FOLDED,
    "raw_product_nulls": RAW_PRODUCT_NULLS, "raw_spelled": RAW_SPELLED,
}

# Two deliveries per table. Two thirds of the keys come first, a third comes later; with the later ones come
# changed values for half of the earlier keys. {rows} is the table, {key} its id as a number. Rows without an
# id belong to the first delivery.
FIRST = "coalesce({key} % 3, 1) <> 0"
SECOND = "({key} % 3 = 0 OR {key} % 2 = 0)"
CHANGES = {
    "customer": {"name": "concat(name, '!')"},
    "product": {"price": "price + 1"},
    "orders": {"quantity": "quantity + 1"},
}
NUMBER = {
    "customer": "customer_id", "product": "product_id",
    "orders": "CAST(substring(transaction_id, 2) AS BIGINT)",
}


_schemas: dict[str, T.StructType] = {}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its footer is read once per process, not by a job of its own in every query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = DERIVED[name]
    used = {t: given(spark, sf_dir, t) for t in GIVEN if "{" + t + "}" in text}
    return spark.sql(text, **used)


def first_delivery(rows: DataFrame, which: str) -> DataFrame:
    return rows.where(FIRST.format(key=NUMBER[which]))


def second_delivery(rows: DataFrame, which: str) -> DataFrame:
    changed = CHANGES[which]
    return rows.where(SECOND.format(key=NUMBER[which])).selectExpr(
        *[f"{changed[c]} AS {c}" if c in changed else c for c in rows.columns]
    )
