"""Cleaning rules between the raw and the conformed layer. Each rule is a Column expression.

The rules differ in what they do with NULL, on purpose:
``floor_or_zero`` and ``within_or`` replace it by their default, ``floor_keep_null`` keeps it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum import schemas

# Accepted spellings per label.
CUSTOMER_TYPES = {"Regular": ["REGULAR", "REG", "R"], "Premium": ["PREMIUM", "PREM", "P"]}
GENDERS = {"Male": ["M", "MALE"], "Female": ["F", "FEMALE"]}
ADULT_AGE = (18, 120)
RATING_SCALE = (0, 5)


def standardise(column: Column, labels: dict[str, Sequence[str]], default: str) -> Column:
    """Map spellings to labels, ignoring case and outer spaces; anything else is ``default``."""
    spelling = F.trim(F.upper(column))
    matches = [F.when(spelling.isin(*codes), F.lit(label)) for label, codes in labels.items()]
    return F.coalesce(*matches, F.lit(default))


def within_or(column: Column, low, high, default=None) -> Column:
    return F.when(column.between(low, high), column).otherwise(F.lit(default))


def floor_or_zero(column: Column) -> Column:
    return F.when(column >= 0, column).otherwise(F.lit(0))


def floor_keep_null(column: Column) -> Column:
    return F.when(column < 0, F.lit(0.0)).otherwise(column)


def _conform(raw: DataFrame, schema, changed: dict[str, Column], keep: Sequence[str]) -> DataFrame:
    columns = [changed.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
    return raw.select(*columns, *keep)


def clean_customer(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Customers with an id and an email. ``keep`` names extra raw columns to carry along."""
    usable = raw.where(F.col("customer_id").isNotNull() & F.col("email").isNotNull())
    return _conform(usable, schemas.CUSTOMER, {
        "customer_type": standardise(F.col("customer_type"), CUSTOMER_TYPES, "Unknown"),
        "age": within_or(F.col("age"), *ADULT_AGE),
        "gender": standardise(F.col("gender"), GENDERS, "Other"),
        "total_purchases": floor_or_zero(F.col("total_purchases")),
    }, keep)


def clean_product(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """All products, also those without an id; measures brought into range."""
    return _conform(raw, schemas.PRODUCT, {
        "price": floor_keep_null(F.col("price")),
        "stock_quantity": floor_or_zero(F.col("stock_quantity")),
        "rating": within_or(F.col("rating"), *RATING_SCALE, 0.0),
    }, keep)


def clean_orders(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Orders with an id and a positive amount; values are not touched."""
    usable = raw.where(F.col("transaction_id").isNotNull() & (F.col("total_amount") > 0))
    return _conform(usable, schemas.ORDER, {}, keep)


def stamp(rows: DataFrame) -> DataFrame:
    """Add the time of the merge, in UTC whatever the session's zone is."""
    return rows.withColumn("last_updated_timestamp", utc_now())


def utc_now() -> Column:
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
