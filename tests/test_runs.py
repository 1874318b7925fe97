import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from checks.scenarios import Landing
from stratum.plans import marts, runs
from stratum.sources import files
from stratum.streaming import loads
from tests.conftest import SF, rows, shape

RAW = {"customer": "raw_customer", "product": "raw_product", "orders": "raw_order_unique"}


@pytest.fixture
def deliver(spark, landing):
    writer = Landing(spark, str(landing))

    def put(cut):
        for which in runs.CONFORMED:
            writer.write(which.source, cut(fixtures.derived(spark, SF, RAW[which.name]), which.name))
    return put


def silver(spark, layout, which):
    return runs.table(spark, layout, which).read().drop("last_updated_timestamp")


def test_two_runs_equal_the_expected_state(spark, landing, layout, deliver):
    runs.create_layers(spark, layout)
    assert {r.row_count for r in runs.counts(spark, layout).collect()} == {0}
    deliver(fixtures.first_delivery)
    first = runs.run_end_to_end(spark, layout, str(landing)).collect()
    assert [(r.layer, r.table_name) for r in first] == [
        ("Silver", "customer"), ("Silver", "orders"), ("Silver", "product"),
        ("Bronze", "raw_customer"), ("Bronze", "raw_order"), ("Bronze", "raw_product")]
    again = runs.run_end_to_end(spark, layout, str(landing)).collect()
    assert first == again  # nothing new, nothing changed
    deliver(fixtures.second_delivery)
    runs.run_end_to_end(spark, layout, str(landing))

    for which in runs.CONFORMED:
        assert runs.feed(spark, layout, which).pending().count() == 0
        # The same deliveries, merged without files, feeds or snapshots.
        raw = fixtures.derived(spark, SF, RAW[which.name])
        old = which.clean(fixtures.first_delivery(raw, which.name))
        new = which.clean(fixtures.second_delivery(raw, which.name))
        merged = old.join(new, which.key, "left_anti").unionByName(new)
        assert rows(silver(spark, layout, which).select(*merged.columns)) == rows(merged)
        assert shape(runs.table(spark, layout, which).read().schema) == shape(which.schema)

    customer = silver(spark, layout, runs.CUSTOMER)
    assert {r[0] for r in customer.select("customer_type").distinct().collect()} <= {"Regular", "Premium", "Unknown"}
    assert silver(spark, layout, runs.PRODUCT).where("price < 0 OR stock_quantity < 0 OR rating NOT BETWEEN 0 AND 5").count() == 0

    for _ in range(2):  # again after a change
        runs.register(spark, layout)
    for which in runs.CONFORMED:
        known = spark.table(f"silver.{which.name}").select(*which.schema.fieldNames())
        assert rows(known) == rows(runs.table(spark, layout, which).read())
        raw = loads.read_raw(spark, which.source, layout)
        assert spark.sql(f"SELECT count(*) FROM bronze.{which.source.table}").first()[0] == raw.count()
        assert shape(spark.table(f"bronze.{which.source.table}").schema) == shape(which.source.raw_schema)
    orders, product, customer = (runs.table(spark, layout, w).read() for w in (runs.ORDERS, runs.PRODUCT, runs.CUSTOMER))
    assert rows(spark.sql("SELECT * FROM gold.vw_daily_sales_analysis")) == rows(marts.daily_sales(orders, product, customer))
    assert spark.table("gold.vw_customer_product_affinity").count() == marts.customer_affinity(customer, orders, product).count()
    assert {t.name for t in spark.catalog.listTables("silver")} >= {"customer", "product", "orders"}
    assert {d.name for d in spark.catalog.listDatabases()} >= {"bronze", "silver", "gold"}
    for name in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_procedures_one_by_one(spark, landing, layout, deliver):
    deliver(fixtures.first_delivery)
    loads.load_customers(spark, str(landing), layout)
    loads.load_products(spark, str(landing), layout)
    loads.load_orders(spark, str(landing), layout)
    for process in (runs.process_customer_changes, runs.merge_product_to_silver, runs.merge_order_to_silver):
        (stats,) = process(spark, layout)
        assert stats.inserted > 0 and stats.updated == 0 and "processed" in stats.message
        assert process(spark, layout) == []


def test_crash_between_snapshot_and_checkpoint(spark, landing, layout, deliver, monkeypatch):
    deliver(fixtures.first_delivery)
    loads.load_products(spark, str(landing), layout)
    from stratum.streaming.changefeed import ChangeFeed

    monkeypatch.setattr(ChangeFeed, "_ledger", lambda self: 1 / 0)
    with pytest.raises(Exception, match="division by zero"):
        runs.merge_product_to_silver(spark, layout)
    monkeypatch.undo()
    before = rows(silver(spark, layout, runs.PRODUCT))
    (replay,) = runs.merge_product_to_silver(spark, layout)
    assert replay.replayed
    assert rows(silver(spark, layout, runs.PRODUCT)) == before
    assert runs.feed(spark, layout, runs.PRODUCT).pending().count() == 0


def test_null_product_ids_are_inserted_by_every_batch(spark, landing, layout):
    for name in ("a", "b"):
        (landing / f"Product/{name}.json").write_text('[{"name": "nil", "price": 1.0}]')
        loads.load_products(spark, str(landing), layout)
        runs.merge_product_to_silver(spark, layout)
    assert silver(spark, layout, runs.PRODUCT).where("product_id IS NULL").count() == 2


def test_duplicate_keys_in_one_feed(spark, landing, layout):
    def drop(name, *prices):
        items = ", ".join(f'{{"product_id": 1, "price": {p}}}' for p in prices)
        (landing / f"Product/{name}.json").write_text(f"[{items}]")
        loads.load_products(spark, str(landing), layout)

    drop("a", 1.0)
    runs.merge_product_to_silver(spark, layout)
    drop("b", 2.0, 3.0)
    with pytest.raises(Exception, match="several|2 incoming rows"):
        runs.merge_product_to_silver(spark, layout)
    runs.merge_product_to_silver(spark, layout, on_duplicate="latest")
    assert [r.price for r in silver(spark, layout, runs.PRODUCT).collect()] == [3.0]


def test_backfill_and_start_from_latest(spark, landing, layout, deliver):
    """History by plain insert, then only new rows by the feed."""
    deliver(fixtures.first_delivery)
    runs.run_loads(spark, layout, str(landing))
    for which in runs.CONFORMED:
        clean = which.clean(loads.read_raw(spark, which.source, layout))
        assert runs.backfill(spark, layout, which).inserted == clean.count()
        assert runs.merge(spark, layout, which, start_from="latest") == []
    deliver(fixtures.second_delivery)
    runs.run_loads(spark, layout, str(landing))
    stats = runs.run_merges(spark, layout, start_from="latest")
    assert len(stats) == 3 and all(s.updated > 0 for s in stats)
    second = fixtures.second_delivery(fixtures.derived(spark, SF, "raw_customer"), "customer")
    assert loads.read_raw(spark, files.CUSTOMERS, layout).count() > second.count()


def test_reconciliation_difference_is_the_rejected_rows(spark, landing, layout):
    header = "a,b,c,d,e,f,g,h,i\n"
    text = header + "1,n,e@x,US,R,2024-01-01,20,M,1\n2,n,,US,R,2024-01-01,20,M,1\n,n,e@x,US,R,2024-01-01,20,M,1\n"
    (landing / "Customer/a.csv").write_text(text)
    got = runs.run_end_to_end(spark, layout, str(landing))
    counts = {r.table_name: r.row_count for r in got.where(F.col("row_count") > 0).collect()}
    assert counts == {"raw_customer": 3, "customer": 1}


@pytest.fixture
def registered(spark, landing, layout):
    """Three months of orders, one without a day, known to SQL."""
    def order(number, day, product=1, amount=1.0):
        return (f"T{number}", 1, product, 1, "Online", amount, day and dt.date.fromisoformat(day), "Card")

    def put(name, *orders):
        spark.createDataFrame(list(orders), files.ORDERS.schema).coalesce(1).write.parquet(str(landing / f"Order/{name}"))
        runs.run_loads(spark, layout, str(landing))

    (landing / "Customer/a.csv").write_text("a,b,c,d,e,f,g,h,i\n1,n,e@x,US,Regular,2024-01-01,20,M,1\n")
    (landing / "Product/a.json").write_text('[{"product_id": 1, "name": "Pen", "category": "Office", "price": 1.0}]')
    put("a", order(1, "2024-01-10"), order(2, "2024-02-10"), order(3, "2024-03-10"))
    runs.run_merges(spark, layout)
    runs.register(spark, layout)
    yield put, order
    for name in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def spoil(folder):
    """Make the files of a folder unreadable, so that whoever opens one fails."""
    for file in folder.iterdir():
        file.unlink() if file.name.endswith(".crc") else file.write_text("spoilt")


@pytest.mark.parametrize("condition", [
    "transaction_date >= DATE'2024-02-01'", "transaction_date BETWEEN '2024-02-01' AND '2024-03-31'"])
def test_a_filter_by_day_opens_its_folders_only(spark, layout, registered, condition):
    from pathlib import Path

    data = Path(layout.conformed("orders")) / "data"
    (january,) = data.glob("commit=*/slice=2024-01")
    spoil(january)
    with pytest.raises(Exception, match="(?i)parquet"):
        spark.sql("SELECT sum(total_sales) FROM gold.vw_daily_sales_analysis").collect()
    shown = spark.sql(f"SELECT transaction_date FROM gold.vw_daily_sales_analysis WHERE {condition}")
    assert [str(r[0]) for r in shown.orderBy("transaction_date").collect()] == ["2024-02-10", "2024-03-10"]
    months = spark.sql("SELECT purchase_month FROM gold.vw_customer_product_affinity WHERE purchase_month >= DATE'2024-02-01'")
    assert months.count() == 2
    got = runs.daily_sales(spark, layout, dt.date(2024, 2, 1), dt.date(2024, 3, 31))
    assert got.count() == 2 and not any("slice=2024-01" in file for file in got.inputFiles())
    assert runs.customer_affinity(spark, layout, dt.date(2024, 3, 1)).count() == 1
    trend = runs.daily_trend(spark, layout, 2)
    assert [str(r[0]) for r in trend.collect()] == ["2024-03-10", "2024-02-10"]
    assert not any("slice=2024-01" in file for file in trend.inputFiles())


def test_readers_by_sql_see_one_version(spark, layout, registered, monkeypatch):
    """Before each statement of a refresh, readers see all the old rows or all the new ones."""
    put, order = registered
    text = "SELECT transaction_id, total_amount FROM silver.orders"
    old, began, seen, real = rows(spark.sql(text)), spark.sql(text), [], spark.sql

    def watching(statement, *args, **options):
        if statement.startswith(("ALTER", "CREATE")):
            seen.append(rows(real(text)))
            assert real("SELECT count(*) FROM silver.customer").first()[0] == 1
        return real(statement, *args, **options)

    put("b", order(2, "2024-02-10", amount=7.0), order(4, None), order(5, "2024-04-01"))
    monkeypatch.setattr(spark, "sql", watching)
    runs.run_merges(spark, layout)
    monkeypatch.undo()
    new = rows(runs.table(spark, layout, runs.ORDERS).read().select("transaction_id", "total_amount"))
    assert rows(spark.sql(text)) == new and new != old and len(new) == 5
    assert len(seen) > 2 and all(state in (old, new) for state in seen)
    assert rows(began) == old  # a reader that began before
    assert [r[0] for r in spark.sql("SELECT transaction_id FROM silver.orders WHERE transaction_date IS NULL").collect()] == ["T4"]
    assert rows(runs.daily_sales(spark, layout)) == rows(spark.sql("SELECT * FROM gold.vw_daily_sales_analysis"))
