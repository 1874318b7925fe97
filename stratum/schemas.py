"""Declared schemas of every stored table and mart. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, INT, TEXT = T.LongType(), T.IntegerType(), T.StringType()
REAL, DAY, FLAG, CLOCK = T.DoubleType(), T.DateType(), T.BooleanType(), T.TimestampNTZType()


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def extend(*parts: T.StructType) -> T.StructType:
    return T.StructType([field for part in parts for field in part.fields])


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, all strings: how CSV and JSON are read before casting."""
    return T.StructType([T.StructField(f.name, TEXT) for f in schema.fields])


CUSTOMER = struct(
    customer_id=LONG, name=TEXT, email=TEXT, country=TEXT, customer_type=TEXT,
    registration_date=DAY, age=INT, gender=TEXT, total_purchases=INT,
)
PRODUCT = struct(
    product_id=LONG, name=TEXT, category=TEXT, brand=TEXT, price=REAL,
    stock_quantity=INT, rating=REAL, is_active=FLAG,
)
ORDER = struct(
    transaction_id=TEXT, customer_id=LONG, product_id=LONG, quantity=INT, store_type=TEXT,
    total_amount=REAL, transaction_date=DAY, payment_method=TEXT,
)

LINEAGE = struct(source_file_name=TEXT, source_file_row_number=LONG, ingestion_timestamp=CLOCK)
BATCH = struct(batch_id=TEXT)
UPDATED = struct(last_updated_timestamp=CLOCK)
ERRORS = struct(errors=T.ArrayType(struct(column=TEXT, value=TEXT, reason=TEXT)))

RAW_CUSTOMER = extend(CUSTOMER, LINEAGE, BATCH)
RAW_PRODUCT = extend(PRODUCT, LINEAGE, BATCH)
RAW_ORDER = extend(ORDER, LINEAGE, BATCH)

SILVER_CUSTOMER = extend(CUSTOMER, UPDATED)
SILVER_PRODUCT = extend(PRODUCT, UPDATED)
SILVER_ORDERS = extend(ORDER, UPDATED)

DAILY_SALES = struct(
    transaction_date=DAY, product_id=LONG, product_name=TEXT, product_category=TEXT,
    customer_id=LONG, customer_type=TEXT, total_quantity=LONG, total_sales=REAL,
    num_transactions=LONG, avg_price_per_unit=REAL, avg_transaction_value=REAL,
)
CUSTOMER_AFFINITY = struct(
    customer_id=LONG, customer_type=TEXT, product_id=LONG, product_name=TEXT, product_category=TEXT,
    purchase_month=DAY, purchase_count=LONG, total_quantity=LONG, total_spent=REAL,
    avg_purchase_amount=REAL, days_between_first_last_purchase=LONG,
)
