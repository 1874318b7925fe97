import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stratum import schemas
from stratum.plans import marts, quality, reports
from tests.conftest import rows, shape

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def small(spark):
    """Hot customer and product, repeated dimension rows, orphans, NULL keys, zero quantities."""
    rnd = random.Random(7)
    orders = [
        (f"T{rnd.randint(0, 150)}", rnd.choice([1, 1, 1, 2, 3, 99, None]), rnd.choice([10, 10, 11, 12, 98, None]),
         rnd.choice([0, 0, 1, 2, None]), "Online", float(rnd.randint(1, 50)), DAY + dt.timedelta(rnd.randint(0, 70)), "Card")
        for _ in range(400)
    ]
    product = [
        (10, "Pen", "Office", "b", 1.0, 1, 1.0, True), (10, "Pen", "Office", "b", 2.0, 1, 1.0, True),
        (11, "Cup", "Home", "b", 1.0, 1, 1.0, True), (11, "Mug", "Home", "b", 1.0, 1, 1.0, True),
        (12, "Hat", None, "b", 1.0, 1, 1.0, True), (None, "Nil", "x", "b", 1.0, 1, 1.0, True),
    ]
    customer = [
        (i, "n", "e", "c", t, DAY, 20, "Male", 1)
        for i, t in [(1, "Regular"), (1, "Regular"), (2, "Premium"), (2, "Unknown"), (3, None)]
    ]
    return (spark.createDataFrame(orders, schemas.ORDER), spark.createDataFrame(product, schemas.PRODUCT),
            spark.createDataFrame(customer, schemas.CUSTOMER))


def brute(small):
    """Every joined row, one by one."""
    orders, product, customer = ([r.asDict() for r in df.collect()] for df in small)
    for o in orders:
        for p in product:
            for c in customer:
                if o["product_id"] is not None and o["product_id"] == p["product_id"] and o["customer_id"] == c["customer_id"]:
                    yield o, p, c


def grouped(small, key):
    groups = {}
    for o, p, c in brute(small):
        groups.setdefault(key(o, p, c), []).append(o)
    return groups


def units(group):
    values = [o["quantity"] for o in group if o["quantity"] is not None]
    return sum(values) if values else None


def test_daily_sales_equals_join_then_group(small):
    orders, product, customer = small
    got = {tuple(r)[:6]: tuple(r)[6:] for r in marts.daily_sales(orders, product, customer).collect()}
    expected = {}
    groups = grouped(small, lambda o, p, c: (
        o["transaction_date"], p["product_id"], p["name"], p["category"], c["customer_id"], c["customer_type"]))
    for key, group in groups.items():
        n, money, ids = units(group), sum(o["total_amount"] for o in group), len({o["transaction_id"] for o in group})
        expected[key] = (n, money, ids, money / n if n else None, money / ids)
    assert got == expected
    assert any(v[0] == 0 and v[3] is None for v in got.values())


def test_affinity_equals_join_then_group(small):
    orders, product, customer = small
    got = {tuple(r)[:6]: tuple(r)[6:] for r in marts.customer_affinity(customer, orders, product).collect()}
    expected = {}
    groups = grouped(small, lambda o, p, c: (
        c["customer_id"], c["customer_type"], p["product_id"], p["name"], p["category"],
        o["transaction_date"].replace(day=1)))
    for key, group in groups.items():
        money, days = [o["total_amount"] for o in group], [o["transaction_date"] for o in group]
        expected[key] = (len({o["transaction_id"] for o in group}), units(group), sum(money),
                         pytest.approx(sum(money) / len(money)), (max(days) - min(days)).days)
    assert got == expected


def test_mart_schemas(small):
    orders, product, customer = small
    for money in (None, "decimal(18,2)"):
        assert shape(marts.daily_sales(orders, product, customer, money).schema) == shape(schemas.DAILY_SALES)
        assert shape(marts.customer_affinity(customer, orders, product, money).schema) == shape(schemas.CUSTOMER_AFFINITY)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_mart_plan(spark, small, tmp_path):
    """Narrow scans, filters in the scan, groups built before the joins, no nested loops."""
    for name, df in zip(("orders", "product", "customer"), small, strict=True):
        df.write.parquet(str(tmp_path / name))
    orders, product, customer = (spark.read.parquet(str(tmp_path / n)) for n in ("orders", "product", "customer"))
    text = plan(marts.daily_sales(orders, product, customer))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "IsNotNull(product_id)" in text and "IsNotNull(customer_id)" in text
    scan = next(line for line in text.splitlines() if "FileScan" in line and "transaction_id" in line)
    assert "payment_method" not in scan and "store_type" not in scan
    joins = [i for i, line in enumerate(text.splitlines()) if "Join" in line]
    distinct = next(i for i, line in enumerate(text.splitlines()) if "count(distinct transaction_id" in line)
    assert max(joins) < distinct  # the plan prints from the top: joins sit above the grouping

    assert "TakeOrderedAndProject" in plan(reports.top_products(marts.daily_sales(orders, product, customer)))
    profile = plan(quality.profile_orders(orders)).splitlines()
    expand = next(i for i, line in enumerate(profile) if "Expand" in line)
    assert any("HashAggregate" in line for line in profile[expand + 1:])  # what is expanded is grouped already


def test_hot_customer_with_dimensions_too_large_to_broadcast(spark, small):
    orders, product, customer = small
    expected = rows(marts.daily_sales(orders, product, customer))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mart = marts.daily_sales(orders, product, customer)
        assert "BroadcastHashJoin" not in plan(mart)
        assert rows(mart) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reports_are_cut_and_sorted(small):
    orders, product, customer = small
    daily, affinity = marts.daily_sales(orders, product, customer), marts.customer_affinity(customer, orders, product)
    revenue = [r.total_revenue for r in reports.top_products(daily, 2).collect()]
    assert len(revenue) == 2 and revenue == sorted(revenue, reverse=True)
    days = [r.transaction_date for r in reports.daily_trend(daily, 5).collect()]
    assert len(days) == 5 and days == sorted(days, reverse=True)
    repeat = reports.repeat_buyers(affinity, 3).collect()
    assert len(repeat) == 3 and all(r.purchase_count > 1 for r in repeat)
    assert [r.customer_type for r in reports.category_by_segment(affinity).collect()][-1] is None
    assert reports.monthly_trend(affinity).count() == 3
    assert reports.top_customers(affinity, 1).count() == 1
    assert reports.revenue_by_segment(daily).count() == 4


@pytest.mark.parametrize("money_type", [None, "decimal(18,2)"])
def test_distinct_counts_of_reports(spark, small, money_type):
    """Products of two names and customers of two types have several mart rows a month; some ids are missing."""
    orders, product, customer = small
    mart = marts.customer_affinity(customer, orders, product, money_type)
    missing = F.lit(None).cast("long")
    mart = mart.unionByName(mart.limit(5).withColumn("product_id", missing)).unionByName(
        mart.limit(5).withColumns({"customer_id": missing, "avg_purchase_amount": F.lit(None).cast("double")})).localCheckpoint()

    def expected(counted, *keys):
        groups = {}
        for r in mart.collect():
            groups.setdefault(tuple(r[k] for k in keys), []).append(r)
        for key, group in groups.items():
            means = [r.avg_purchase_amount for r in group if r.avg_purchase_amount is not None]
            yield key, (*[len({r[c] for r in group} - {None}) for c in counted],
                        sum(r.total_spent for r in group), pytest.approx(sum(means) / len(means)) if means else None)

    got = {r[:2]: (r[2], r[4], r[5]) for r in map(tuple, reports.top_customers(mart, 100, money_type).collect())}
    assert got == dict(expected(["product_id"], "customer_id", "customer_type"))
    got = {r[:1]: r[1:] for r in map(tuple, reports.monthly_trend(mart, money_type).collect())}
    assert got == dict(expected(["customer_id", "product_id"], "purchase_month"))
    assert reports.monthly_trend(mart, money_type).dtypes == [
        ("purchase_month", "date"), ("active_customers", "bigint"), ("products_purchased", "bigint"),
        ("monthly_revenue", "double"), ("avg_order_value", "double")]


def test_distinct_counts_do_not_hash_or_expand_the_mart(small):
    """Nearly every mart row has a customer and product of its own: hash tables of these took a task's memory."""
    orders, product, customer = small
    affinity = marts.customer_affinity(customer, orders, product)
    text = plan(reports.top_customers(affinity))
    assert "count(distinct product_id" not in text and "Window" in text
    hashed = [line for line in text.splitlines() if "HashAggregate(keys=[customer_id" in line and "customer_type" in line]
    assert hashed and not any("product_id" in line.split("functions=")[0] for line in hashed)
    assert "Expand" not in plan(reports.monthly_trend(affinity))


@pytest.mark.parametrize("days", [1, 3, 30, 500])
def test_daily_trend_equals_a_cut_of_all_days(spark, small, days):
    """With a day missing in some orders: no day sorts first and takes one of the places."""
    orders, product, customer = small
    undated = orders.limit(40).withColumn("transaction_date", F.lit(None).cast("date"))
    for extra in (orders, orders.unionByName(undated), undated):
        daily = marts.daily_sales(extra, product, customer)
        totals = {}
        for r in daily.collect():
            t = totals.setdefault(r.transaction_date, [0.0, None, 0])
            t[0] += r.total_sales
            t[1] = t[1] if r.total_quantity is None else (t[1] or 0) + r.total_quantity
            t[2] += r.num_transactions
        newest = sorted(totals, key=lambda d: (d is None, d or DAY), reverse=True)[:days]
        got = [(r[0], *r[1:]) for r in reports.daily_trend(daily, days).collect()]
        assert got == [(d, *totals[d]) for d in newest]


def test_daily_trend_scans_recent_orders_only(spark, small, tmp_path):
    orders, product, customer = small
    for month, part in enumerate(orders.randomSplit([0.5, 0.5], 1)):
        part.sort("transaction_date").coalesce(1).write.mode("append").parquet(str(tmp_path / "o"))
    stored = spark.read.parquet(str(tmp_path / "o"))
    text = plan(reports.daily_trend(marts.daily_sales(stored, product, customer), 3))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "transaction_id" in line)
    assert "transaction_date" in scan.split("DataFilters")[1] and "Subquery" in scan


@pytest.mark.parametrize("days", [1, 3, 500])
def test_daily_trend_backwards_is_the_same(spark, small, days):
    """Sales thin out, so that several looks are needed; the newest days have no sale of a known product at all."""
    orders, product, customer = small
    day = F.col("transaction_date")
    orders = orders.where((F.day(day) % 9 == 0) | (F.col("product_id") == 98))
    undated = orders.limit(9).withColumn("transaction_date", F.lit(None).cast("date"))
    for given in (orders, orders.unionByName(undated), undated, orders.limit(0)):
        looks, (first, last) = [], given.agg(F.min(day), F.max(day)).first()

        def since(start, given=given, looks=looks):
            looks.append(start)
            return given.where((day >= F.lit(start)) | day.isNull())

        got = reports.daily_trend_backwards(since, first and (first, last), product, customer, days).collect()
        assert got == reports.daily_trend(marts.daily_sales(given, product, customer), days).collect()
        assert looks[:-1] == sorted(looks[:-1], reverse=True) and (days > 3 or first is None or first not in looks[:-1])


def test_counters_are_null_when_nothing_is_bad(spark):
    orders = spark.createDataFrame([("a", 1, 1, 1, "Online", 2.0, DAY, "Card"), ("b", 1, 1, 1, "Online", 3.0, DAY, "Card")], schemas.ORDER)
    assert tuple(quality.profile_orders(orders).first()) == (2, None, None, 2.0, 3.0, DAY, DAY, 1, 1)
    empty = quality.profile_orders(orders.limit(0)).first()
    assert tuple(empty) == (0, None, None, None, None, None, None, 0, 0)
    product = spark.createDataFrame([(1, "n", "c", "b", 1.0, 1, 1.0, None)], schemas.PRODUCT)
    assert tuple(quality.profile_product(product).first()) == (1, None, None, None, 1.0, 1.0, 0)


def test_counters_count_bad_rows(spark):
    orders = spark.createDataFrame([
        (None, 1, 1, 1, None, -2.0, DAY, "Card"), ("b", 1, 1, 1, "Online", 0.0, DAY, "Pay"), ("c", 1, 1, 1, "Web", None, None, None),
    ], schemas.ORDER)
    assert tuple(quality.profile_orders(orders).first()) == (3, 1, 2, -2.0, 0.0, DAY, DAY, 2, 2)
