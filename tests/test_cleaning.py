import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from stratum import schemas
from stratum.functions import cleaning
from tests.conftest import shape


def apply(spark, kind, rule, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", rule(F.col("v")).alias("o")).orderBy("i").collect()]


@pytest.mark.parametrize(("value", "label"), [
    ("REG", "Regular"), ("r", "Regular"), (" Regular ", "Regular"), ("prem", "Premium"), (" P", "Premium"),
    ("PREMIUM", "Premium"), ("gold", "Unknown"), ("", "Unknown"), ("  ", "Unknown"), (None, "Unknown"),
    ("REG\t", "Unknown"), ("R EG", "Unknown"),
])
def test_customer_type(spark, value, label):
    rule = lambda c: cleaning.standardise(c, cleaning.CUSTOMER_TYPES, "Unknown")
    assert apply(spark, "string", rule, [value]) == [label]


def test_gender(spark):
    rule = lambda c: cleaning.standardise(c, cleaning.GENDERS, "Other")
    values = ["m", "Male ", " F", "FEMALE", "X", "", None, "mal"]
    assert apply(spark, "string", rule, values) == ["Male", "Male", "Female", "Female"] + ["Other"] * 4


def test_age_is_kept_at_both_ends(spark):
    rule = lambda c: cleaning.within_or(c, *cleaning.ADULT_AGE)
    assert apply(spark, "int", rule, [17, 18, 50, 120, 121, -1, None]) == [None, 18, 50, 120, None, None, None]


def test_rating_defaults_to_zero(spark):
    rule = lambda c: cleaning.within_or(c, *cleaning.RATING_SCALE, 0.0)
    values = [-0.1, 0.0, 4.5, 5.0, 5.01, math.nan, None]
    assert apply(spark, "double", rule, values) == [0.0, 0.0, 4.5, 5.0, 0.0, 0.0, 0.0]


def test_floors_differ_in_null(spark):
    assert apply(spark, "int", cleaning.floor_or_zero, [-3, 0, 7, None]) == [0, 0, 7, 0]
    kept = apply(spark, "double", cleaning.floor_keep_null, [-3.0, 0.0, 7.5, None, math.nan])
    assert kept[:4] == [0.0, 0.0, 7.5, None]
    assert math.isnan(kept[4])


def test_customer_needs_id_and_email(spark):
    day = dt.date(2024, 1, 1)
    raw = spark.createDataFrame([
        (1, "a", "a@x", "C", "reg", day, 20, "m", 3),
        (None, "b", "b@x", "C", "reg", day, 20, "m", 3),
        (3, "c", None, "C", "reg", day, 20, "m", 3),
    ], schemas.CUSTOMER)
    out = cleaning.clean_customer(raw)
    assert shape(out.schema) == shape(schemas.CUSTOMER)
    assert [tuple(r) for r in out.collect()] == [(1, "a", "a@x", "C", "Regular", day, 20, "Male", 3)]


def test_product_without_id_stays(spark):
    raw = spark.createDataFrame([(None, "n", "c", "b", -1.0, None, 9.0, True)], schemas.PRODUCT)
    out = cleaning.clean_product(raw)
    assert shape(out.schema) == shape(schemas.PRODUCT)
    assert tuple(out.first()) == (None, "n", "c", "b", 0.0, 0, 0.0, True)


def test_orders_need_id_and_positive_amount(spark):
    cases = [("a", 1.0), (None, 1.0), ("b", 0.0), ("c", -1.0), ("d", None), ("e", math.nan)]
    raw = spark.createDataFrame([(t, 1, 1, -2, "s", a, None, "p") for t, a in cases], schemas.ORDER)
    out = cleaning.clean_orders(raw)
    assert sorted(r.transaction_id for r in out.collect()) == ["a", "e"]
    assert out.first().quantity == -2


def test_stamp_is_utc_without_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        stamped = cleaning.stamp(spark.range(1))
        assert stamped.schema["last_updated_timestamp"].dataType == schemas.CLOCK
        got = stamped.first().last_updated_timestamp
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((now - got).total_seconds()) < 60
