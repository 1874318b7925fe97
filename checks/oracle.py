"""What DuckDB computes for each checked query, written independently of the Spark side."""

from __future__ import annotations

import re

from checks import fixtures


def _duck(text: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", text)


# Cleaned tables. Spellings come from a lookup list, measures through greatest/between.
_SPELLINGS = """spellings(kind, spelling, label) AS (VALUES
  ('type', 'REGULAR', 'Regular'), ('type', 'REG', 'Regular'), ('type', 'R', 'Regular'),
  ('type', 'PREMIUM', 'Premium'), ('type', 'PREM', 'Premium'), ('type', 'P', 'Premium'),
  ('gender', 'M', 'Male'), ('gender', 'MALE', 'Male'), ('gender', 'F', 'Female'), ('gender', 'FEMALE', 'Female'))"""

_CLEAN = {
    "customer": """
  SELECT r.customer_id, r.name, r.email, r.country, coalesce(t.label, 'Unknown') AS customer_type,
    r.registration_date, if(r.age >= 18 AND r.age <= 120, r.age, NULL) AS age,
    coalesce(g.label, 'Other') AS gender, greatest(coalesce(r.total_purchases, 0), 0) AS total_purchases
  FROM {rows} r
  LEFT JOIN spellings t ON t.kind = 'type' AND t.spelling = upper(trim(r.customer_type, ' '))
  LEFT JOIN spellings g ON g.kind = 'gender' AND g.spelling = upper(trim(r.gender, ' '))
  WHERE r.customer_id IS NOT NULL AND r.email IS NOT NULL""",
    "product": """
  SELECT product_id, name, category, brand, if(price IS NULL, NULL, greatest(price, 0.0)) AS price,
    greatest(coalesce(stock_quantity, 0), 0) AS stock_quantity,
    if(rating >= 0 AND rating <= 5, rating, 0.0) AS rating, is_active
  FROM {rows}""",
    "orders": """
  SELECT transaction_id, customer_id, product_id, quantity, store_type, total_amount, transaction_date, payment_method
  FROM {rows} WHERE transaction_id IS NOT NULL AND coalesce(total_amount, 0) > 0""",
}
KEYS = {"customer": "customer_id", "product": "product_id", "orders": "transaction_id"}
RAW = {"customer": "raw_customer", "product": "raw_product", "orders": "raw_order"}


def _clean(which: str, rows: str) -> str:
    return _CLEAN[which].replace("{rows}", rows)


def _folded(text: str) -> str:
    """The same on orders with folded keys."""
    return re.sub(r"\b(sold|silver_orders|daily_mart|affinity_mart)\b", r"\1_folded", text)


def with_tables(query: str) -> str:
    """Put the definitions a query uses in front of it."""
    known = {name: _duck(text) for name, text in fixtures.DERIVED.items()}
    known |= {f"silver_{which}": _clean(which, raw) for which, raw in RAW.items()}
    known |= {"silver_orders_unique": _clean("orders", "raw_order_unique")}
    known |= {"silver_orders_folded": _clean("orders", "raw_order_folded")}
    known |= MARTS
    known |= {_folded(name): _folded(text) for name, text in MARTS.items()}
    parts: dict[str, str] = {}

    def need(text: str) -> None:
        for word in re.findall(r"\b\w+\b", text):
            if word == "spellings":
                parts.setdefault("spellings", _SPELLINGS)
            elif word in known and word not in parts:
                parts[word] = ""
                body = known[word]
                need(body)
                del parts[word]
                parts[word] = f"{word} AS ({body})"

    need(query)
    if not parts:
        return query
    if query.startswith("WITH "):
        return "WITH " + ",\n".join(parts.values()) + ",\n" + query.removeprefix("WITH ")
    return "WITH " + ",\n".join(parts.values()) + "\n" + query


_DEC = "DECIMAL(18,2)"
MARTS = {
    "sold": f"""
  SELECT s.*, CAST(s.total_amount AS {_DEC}) AS money, p.name AS product_name, p.category AS product_category, c.customer_type
  FROM silver_orders s, silver_product p, silver_customer c
  WHERE s.product_id = p.product_id AND s.customer_id = c.customer_id""",
    "daily_mart": """
  SELECT *, total_sales / nullif(total_quantity, 0) AS avg_price_per_unit,
    total_sales / nullif(num_transactions, 0) AS avg_transaction_value
  FROM (SELECT transaction_date, product_id, product_name, product_category, customer_id, customer_type,
      CAST(sum(quantity) AS BIGINT) AS total_quantity, CAST(sum(money) AS DOUBLE) AS total_sales,
      count(DISTINCT transaction_id) AS num_transactions
    FROM sold GROUP BY ALL)""",
    "affinity_mart": """
  SELECT customer_id, customer_type, product_id, product_name, product_category,
    CAST(date_trunc('month', transaction_date) AS DATE) AS purchase_month,
    count(DISTINCT transaction_id) AS purchase_count, CAST(sum(quantity) AS BIGINT) AS total_quantity,
    CAST(sum(money) AS DOUBLE) AS total_spent, CAST(sum(money) AS DOUBLE) / count(money) AS avg_purchase_amount,
    CAST(max(transaction_date) - min(transaction_date) AS BIGINT) AS days_between_first_last_purchase
  FROM sold GROUP BY ALL""",
}


def _money(column: str) -> str:
    return f"CAST(sum(CAST({column} AS {_DEC})) AS DOUBLE)"


def _mean(column: str) -> str:
    # The small shift keeps means of ratios off rounding ties, where engines may differ.
    return f"round(avg({column}) + 0.0000003, 4)"


def _big(column: str) -> str:
    return f"CAST(sum({column}) AS BIGINT)"


REPORTS = {
    "top_products": f"""SELECT product_name, product_category, {_money('total_sales')} AS total_revenue,
  {_big('total_quantity')} AS total_units_sold, {_big('num_transactions')} AS total_transactions
FROM daily_mart GROUP BY 1, 2 ORDER BY 3 DESC NULLS FIRST, 1, 2 LIMIT 10""",
    "revenue_by_segment": f"""SELECT customer_type, {_money('total_sales')} AS total_revenue,
  {_big('num_transactions')} AS total_transactions, {_mean('avg_transaction_value')} AS avg_basket_size
FROM daily_mart GROUP BY 1 ORDER BY 2 DESC NULLS FIRST""",
    "daily_trend": f"""SELECT transaction_date, {_money('total_sales')} AS daily_revenue,
  {_big('total_quantity')} AS daily_units_sold, {_big('num_transactions')} AS daily_transactions
FROM daily_mart GROUP BY 1 ORDER BY 1 DESC NULLS FIRST LIMIT 30""",
    "top_customers": f"""SELECT customer_id, customer_type, count(DISTINCT product_id) AS distinct_products_bought,
  {_big('purchase_count')} AS total_orders, {_money('total_spent')} AS lifetime_spend,
  {_mean('avg_purchase_amount')} AS avg_order_value
FROM affinity_mart GROUP BY 1, 2 ORDER BY 5 DESC NULLS FIRST, 1, 2 LIMIT 10""",
    "category_by_segment": f"""SELECT customer_type, product_category, {_big('purchase_count')} AS total_orders,
  {_big('total_quantity')} AS total_units, {_money('total_spent')} AS total_revenue
FROM affinity_mart GROUP BY 1, 2 ORDER BY 1, 5 DESC NULLS FIRST, 2""",
    "repeat_buyers": """SELECT customer_id, product_name, product_category, purchase_month, purchase_count,
  total_spent, days_between_first_last_purchase
FROM affinity_mart WHERE purchase_count > 1
ORDER BY purchase_count DESC NULLS FIRST, total_spent DESC NULLS FIRST, customer_id, purchase_month, product_name, product_category,
  days_between_first_last_purchase LIMIT 20""",
    "monthly_trend": f"""SELECT purchase_month, count(DISTINCT customer_id) AS active_customers,
  count(DISTINCT product_id) AS products_purchased, {_money('total_spent')} AS monthly_revenue,
  {_mean('avg_purchase_amount')} AS avg_order_value
FROM affinity_mart GROUP BY 1 ORDER BY 1 DESC NULLS FIRST""",
}


def _profile_customer(table: str) -> str:
    return f"""SELECT customer_type, gender, count(*) AS row_count, min(age) AS min_age, max(age) AS max_age,
  min(total_purchases) AS min_purchases FROM {table} GROUP BY ALL ORDER BY 1, 2"""


def _bad(condition: str) -> str:
    return f"nullif(count(*) FILTER (WHERE {condition}), 0)"


def _profile_product(table: str) -> str:
    return f"""SELECT count(*) AS total_rows, {_bad('price < 0')} AS negative_prices,
  {_bad('stock_quantity < 0')} AS negative_stock, {_bad('rating NOT BETWEEN 0 AND 5')} AS invalid_ratings,
  min(price) AS min_price, max(rating) AS max_rating, count(*) FILTER (WHERE is_active) AS active_products
FROM {table}"""


def _profile_orders(table: str) -> str:
    return f"""SELECT count(*) AS total_rows, {_bad('transaction_id IS NULL')} AS null_transaction_ids,
  {_bad('total_amount <= 0')} AS invalid_amounts, min(total_amount) AS min_amount, max(total_amount) AS max_amount,
  min(transaction_date) AS earliest_date, max(transaction_date) AS latest_date,
  count(DISTINCT store_type) AS distinct_store_types, count(DISTINCT payment_method) AS distinct_payment_methods
FROM {table}"""


def _count(table: str, *labels: str) -> str:
    names = ("table_name",) if len(labels) == 1 else ("layer", "table_name")
    shown = ", ".join(f"'{value}' AS {name}" for value, name in zip(labels, names, strict=True))
    return f"SELECT {shown}, count(*) AS row_count FROM {table}"


SILVER_COUNTS = "\nUNION ALL ".join(_count(f"silver_{n}", n) for n in RAW)
LAYER_COUNTS = "\nUNION ALL ".join(
    [_count(raw, "Bronze", raw) for raw in RAW.values()] + [_count(f"silver_{n}", "Silver", n) for n in RAW]
)


# Two deliveries, and what a merge of the second into the first must leave.
def _deliveries(which: str, rows: str) -> str:
    number, changed = fixtures.NUMBER[which], fixtures.CHANGES[which]
    replaced = ", ".join(f"{new} AS {column}" for column, new in changed.items())
    return (
        f"first_{which} AS (SELECT * FROM {rows} WHERE {fixtures.FIRST.format(key=number)}),\n"
        f"second_{which} AS (SELECT * REPLACE ({replaced}) FROM {rows} WHERE {fixtures.SECOND.format(key=number)})"
    )


def _merged(which: str, target: str, source: str) -> str:
    """Target rows without a partner, a source row for each target row that has one, new source rows."""
    key = KEYS[which]
    return f"""SELECT t.* FROM {target} t ANTI JOIN {source} s ON t.{key} = s.{key}
UNION ALL SELECT s.* FROM {target} t JOIN {source} s ON t.{key} = s.{key}
UNION ALL SELECT s.* FROM {source} s ANTI JOIN {target} t ON s.{key} = t.{key}"""


def _two_deliveries(which: str, raw: str, select: str) -> str:
    return (
        f"WITH {_deliveries(which, raw)},\nold AS ({_clean(which, 'first_' + which)}),\n"
        f"new AS ({_clean(which, 'second_' + which)}),\nmerged AS ({_merged(which, 'old', 'new')})\n{select}"
    )


NULL_PRODUCT = {
    "old": "SELECT * REPLACE (if(product_id % 50 = 1, NULL, product_id) AS product_id) FROM old",
    "new": "SELECT * REPLACE (if(product_id % 50 = 0, NULL, product_id) AS product_id) FROM new",
}
_UPSERT_PRODUCT = (
    f"WITH {_deliveries('product', 'raw_product')},\nold AS ({_clean('product', 'first_product')}),\n"
    f"new AS ({_clean('product', 'second_product')}),\n"
    f"old_n AS ({NULL_PRODUCT['old']}),\nnew_n AS ({NULL_PRODUCT['new']}),\n"
    f"merged AS ({_merged('product', 'old_n', 'new_n')})\nSELECT * FROM merged"
)

# Line items come in the order of their line number, ship date and price; the last one of an order wins.
_LATEST = """WITH ranked AS (
  SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate, row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_quantity DESC
  ) AS place FROM lineitem),
last AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice FROM ranked WHERE place = 1)
SELECT o_orderkey AS order_id, coalesce(l_partkey, o_custkey) AS ref_id, coalesce(l_linenumber, 0) AS line,
  if(l_orderkey IS NULL, 0.0, l_quantity) AS quantity, if(l_orderkey IS NULL, o_totalprice, l_extendedprice) AS amount
FROM orders LEFT JOIN last ON l_orderkey = o_orderkey
UNION ALL
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice FROM last ANTI JOIN orders ON l_orderkey = o_orderkey"""

_STATS_PARTS = [
    (which, raw, f"old_{which}", f"new_{which}") for which, raw in
    (("customer", "raw_customer"), ("product", "raw_product"), ("orders", "raw_order_unique"))
]
_UPSERT_STATS = "WITH " + ",\n".join(
    f"{_deliveries(which, raw)},\n{old} AS ({_clean(which, 'first_' + which)}),\n{new} AS ({_clean(which, 'second_' + which)})"
    for which, raw, old, new in _STATS_PARTS
) + "\n" + "\nUNION ALL ".join(
    f"SELECT '{which}' AS table_name, (SELECT count(*) FROM {new} s ANTI JOIN {old} t ON s.{KEYS[which]} = t.{KEYS[which]}) "
    f"AS rows_inserted, (SELECT count(*) FROM {old} t SEMI JOIN {new} s ON s.{KEYS[which]} = t.{KEYS[which]}) AS rows_updated"
    for which, _, old, new in _STATS_PARTS
)

_PENDING = "WITH " + ",\n".join(_deliveries(which, raw) for which, raw, *_ in _STATS_PARTS) + "\n" + "\nUNION ALL ".join(
    f"SELECT '{RAW[which]}' AS table_name, count(*) AS pending_rows FROM second_{which}" for which, *_ in _STATS_PARTS
)

_MESSAGES = _UPSERT_STATS[: _UPSERT_STATS.rindex("\nSELECT '" + _STATS_PARTS[0][0])] + "\n" + "\nUNION ALL ".join(
    f"SELECT 1 AS delivery, '{which} processed: ' || (SELECT count(*) FROM {old}) || ' inserted, 0 updated' AS message UNION ALL "
    f"SELECT 2, '{which} processed: ' || (SELECT count(*) FROM {new} s ANTI JOIN {old} t ON s.{KEYS[which]} = t.{KEYS[which]}) "
    f"|| ' inserted, ' || (SELECT count(*) FROM {old} t SEMI JOIN {new} s ON s.{KEYS[which]} = t.{KEYS[which]}) || ' updated'"
    for which, _, old, new in _STATS_PARTS
)

_STAMPS = f"""WITH {_deliveries('customer', 'raw_customer')},
o AS ({_clean('customer', 'first_customer')}), n AS ({_clean('customer', 'second_customer')})
SELECT (SELECT count(*) FROM n) AS stamped_again,
  (SELECT count(*) FROM o ANTI JOIN n ON o.customer_id = n.customer_id) AS as_before"""

_STEPS = {
    "one, first": "first", "one, looking": "second", "one, failing": "second", "one, again": "second", "two, all": "both",
    "one, reset": "both",
}
_POSITIONS = f"""WITH {_deliveries('orders', 'raw_order_unique')},
steps(step, gets) AS (VALUES {', '.join(f"('{step}', '{gets}')" for step, gets in _STEPS.items())}),
parts AS (SELECT 'first' AS gets, * FROM first_orders UNION ALL SELECT 'second', * FROM second_orders
  UNION ALL SELECT 'both', * FROM first_orders UNION ALL SELECT 'both', * FROM second_orders)
SELECT step, count(*) AS row_count, CAST(sum(quantity) AS BIGINT) AS quantity, min(transaction_id) AS lowest,
  max(transaction_id) AS highest FROM steps JOIN parts USING (gets) GROUP BY step"""

_END_TO_END = "WITH " + ",\n".join(
    f"{_deliveries(which, raw)},\nboth_{which} AS (SELECT * FROM first_{which} UNION ALL SELECT * FROM second_{which}),\n"
    f"cleaned_{which} AS ({_clean(which, 'both_' + which)})" for which, raw, *_ in _STATS_PARTS
) + "\n" + "\nUNION ALL ".join(
    [f"SELECT 'Bronze' AS layer, '{RAW[which]}' AS table_name, count(*) AS row_count FROM both_{which}" for which, *_ in _STATS_PARTS]
    + [f"SELECT 'Silver', '{which}', count(DISTINCT {KEYS[which]}) FROM cleaned_{which}" for which, *_ in _STATS_PARTS]
)

# What the views show after both deliveries of all three tables: the marts over the merged tables.
_MERGED_ALL = "WITH " + ",\n".join(
    f"{_deliveries(which, raw)},\nold_{which} AS ({_clean(which, 'first_' + which)}),\n"
    f"new_{which} AS ({_clean(which, 'second_' + which)}),\nall_{which} AS ({_merged(which, 'old_' + which, 'new_' + which)})"
    for which, raw, *_ in _STATS_PARTS
)


def _over_merged(mart: str, *means: str) -> str:
    names = {"sold": "sold_all", "silver_orders": "all_orders", "silver_product": "all_product", "silver_customer": "all_customer"}
    swap = lambda text: re.sub(r"\b(" + "|".join(names) + r")\b", lambda m: names[m[0]], text)
    rounded = ", ".join(f"round({mean} + 0.0000003, 4) AS {mean}" for mean in means)
    return f"{_MERGED_ALL},\nsold_all AS ({swap(MARTS['sold'])})\nSELECT * REPLACE ({rounded}) FROM ({swap(MARTS[mart])})"


_SQL_DAILY = _over_merged("daily_mart", "avg_price_per_unit", "avg_transaction_value")
_SQL_AFFINITY = _over_merged("affinity_mart", "avg_purchase_amount")

_TEXT_GOOD = "(id_txt IS NULL OR try_cast(id_txt AS BIGINT) IS NOT NULL) AND (date_txt IS NULL OR try_cast(date_txt AS DATE) IS NOT NULL)"

QUERIES = {
    **{f"silver_{which}": f"SELECT * FROM silver_{which}" for which in RAW},
    "null_markers": """SELECT row_id, if(name_txt IN ('NULL', 'null', ''), NULL, name_txt) AS name_txt, id_txt, date_txt
FROM raw_text""",
    "cast_or_reject_good": f"""SELECT row_id, name_txt, try_cast(id_txt AS BIGINT) AS id_txt, try_cast(date_txt AS DATE) AS date_txt
FROM raw_text WHERE {_TEXT_GOOD}""",
    "cast_or_reject_bad": """SELECT row_id, 'id_txt' AS column_name, id_txt AS bad_value FROM raw_text
WHERE id_txt IS NOT NULL AND try_cast(id_txt AS BIGINT) IS NULL
UNION ALL SELECT row_id, 'date_txt', date_txt FROM raw_text WHERE date_txt IS NOT NULL AND try_cast(date_txt AS DATE) IS NULL""",
    "parquet_typed_scan": """SELECT CAST(o_orderdate AS DATE) AS o_orderdate, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
  CAST(o_custkey AS INTEGER) AS o_custkey, o_totalprice, o_orderstatus FROM orders""",
    "json_field_extract": """SELECT event_id, event_type, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k,
  json_extract_string(props, '$.missing') AS missing FROM events""",
    "ingest_csv_roundtrip": """SELECT * REPLACE (nullif(customer_type, '') AS customer_type, nullif(gender, '') AS gender)
FROM raw_customer""",
    "ingest_json_roundtrip": "SELECT * FROM raw_product",
    "ingest_parquet_roundtrip": "SELECT * FROM raw_order",
    "ingest_parquet_mixed_types": "SELECT * FROM raw_order",
    "ingest_row_numbers": "SELECT count(*) AS row_count, true AS numbered_from_one FROM raw_customer",
    "pending_rows": _PENDING,
    "ingest_json_bad_elements": "SELECT * FROM raw_product WHERE product_id % 10 <> 0",
    "ingest_json_rejects": "SELECT count(*) AS rejected FROM raw_product WHERE product_id % 10 = 0",
    "ingest_json_mixed_layout": "SELECT * FROM raw_product WHERE product_id % 10 <> 0",
    "ingest_json_mixed_rejects": "SELECT count(*) AS rejected FROM raw_product WHERE product_id % 10 = 0",
    "ingest_json_row_numbers": "SELECT count(*) AS row_count, true AS numbered_from_one FROM raw_product",
    "ingest_parquet_row_numbers": "SELECT count(*) AS row_count, true AS numbered_from_one FROM raw_order",
    "ingest_csv_ragged": """SELECT customer_id, name, email, country, nullif(customer_type, '') AS customer_type,
  if(customer_id % 4 = 1, NULL, registration_date) AS registration_date, if(customer_id % 4 = 1, NULL, age) AS age,
  if(customer_id % 4 = 1, NULL, nullif(gender, '')) AS gender, if(customer_id % 4 = 1, NULL, total_purchases) AS total_purchases
FROM raw_customer""",
    "ingest_csv_compressed": """SELECT * REPLACE (nullif(customer_type, '') AS customer_type, nullif(gender, '') AS gender)
FROM raw_customer""",
    "ingest_csv_quotes": """SELECT * REPLACE ('"' || name || '"' AS name, nullif(customer_type, '') AS customer_type,
  nullif(gender, '') AS gender) FROM raw_customer""",
    "ingest_json_not_utf8": "SELECT * REPLACE (name || chr(65533) AS name) FROM raw_product",
    "ingest_lineage": f"""WITH {_deliveries('customer', 'raw_customer')}
SELECT (SELECT count(*) FROM first_customer) + (SELECT count(*) FROM second_customer) AS row_count,
  CAST(0 AS BIGINT) AS unmatched_files, true AS stamped""",
    "ingest_recreated": "SELECT * FROM raw_product",
    "feed_positions": _POSITIONS,
    "merge_messages": _MESSAGES,
    "merge_stamps": _STAMPS,
    "merge_replayed": _two_deliveries("orders", "raw_order_unique", "SELECT * FROM merged"),
    "cast_int_and_date": """SELECT row_id, CASE WHEN row_id % 6 <> 5 THEN CAST(sign(CAST(int_txt AS DECIMAL(18, 2)))
    * floor(abs(CAST(int_txt AS DECIMAL(18, 2))) + 0.5) AS INTEGER) END AS int_txt,
  CASE WHEN row_id % 7 IN (0, 1, 2, 6) THEN DATE '2024-02-29' END AS date_txt FROM raw_spelled""",
    "feed_customer": _two_deliveries("customer", "raw_customer", "SELECT * FROM merged"),
    "feed_product": _two_deliveries("product", "raw_product_nulls", "SELECT * FROM merged"),
    "feed_incremental_upsert": _two_deliveries("orders", "raw_order_unique", "SELECT * FROM merged"),
    "upsert_customer": _two_deliveries("customer", "raw_customer", "SELECT * FROM merged"),
    "upsert_product": _UPSERT_PRODUCT,
    "upsert_orders": _two_deliveries("orders", "raw_order_unique", "SELECT * FROM merged"),
    "upsert_latest": _LATEST,
    "upsert_stats": _UPSERT_STATS,
    **{f"backfill_{which}_twice": f"SELECT * FROM silver_{which} UNION ALL SELECT * FROM silver_{which}"
       for which in ("orders", "customer", "product")},
    "daily_sales": "SELECT * FROM daily_mart",
    "customer_affinity": "SELECT * FROM affinity_mart",
    **REPORTS,
    **{f"{name}_folded": _folded(text) for name, text in
       {"daily_sales": "SELECT * FROM daily_mart", "customer_affinity": "SELECT * FROM affinity_mart", **REPORTS}.items()},
    "sql_daily_sales": _SQL_DAILY, "sql_affinity": _SQL_AFFINITY,
    "profile_customer": _profile_customer("silver_customer"),
    "profile_product": _profile_product("silver_product"),
    "profile_orders": _profile_orders("silver_orders"),
    "profile_customer_raw": _profile_customer("raw_customer"),
    "profile_product_raw": _profile_product("raw_product"),
    "profile_orders_raw": _profile_orders("raw_order"),
    "silver_counts": SILVER_COUNTS,
    "layer_counts": LAYER_COUNTS + "\nORDER BY layer DESC, table_name",
    "end_to_end_layer_counts": _END_TO_END,
}


def sql() -> dict[str, str]:
    return {name: with_tables(query) for name, query in QUERIES.items()}
