"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder with the tables, BENCH_CPUS the number of threads, BENCH_REPEAT how often each
query runs (the best time counts).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import catalog, fixtures
from stratum.functions import cleaning
from stratum.operators.snapshot import SnapshotTable
from stratum.plans import runs
from stratum.session import build_session, work_root

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "2"))

PLANS = [
    "silver_customer", "silver_product", "silver_orders", "daily_sales", "customer_affinity",
    "top_products", "revenue_by_segment", "daily_trend", "top_customers", "category_by_segment", "repeat_buyers",
    "monthly_trend", "profile_customer", "profile_product", "profile_orders", "layer_counts",
    "upsert_customer", "upsert_product", "upsert_orders", "upsert_latest",
    "cast_or_reject_good", "json_field_extract", "parquet_typed_scan",
]
# These write files and run streams; once is enough.
FILE_RUNS = ["ingest_csv_roundtrip", "ingest_json_roundtrip", "ingest_parquet_roundtrip", "feed_incremental_upsert"]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def recent_percent(spark: SparkSession) -> float:
    """Merge the most recent hundredth of the orders, changed, into the stored table of all orders."""
    raw = fixtures.derived(spark, SF_DIR, "raw_order_unique")
    orders = cleaning.stamp(cleaning.clean_orders(raw))
    which = runs.ORDERS
    target = SnapshotTable(spark, f"{work_root(spark)}/orders", which.schema, which.key, which.slice_by)
    target.append(orders)
    cutoff = orders.select(F.percentile(F.unix_date("transaction_date"), 0.99)).first()[0]
    recent = orders.where(F.unix_date("transaction_date") >= cutoff).withColumn("quantity", F.col("quantity") + 1)
    return seconds(lambda: target.merge(recent))


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    run(catalog.QUERIES["top_products"](spark, SF_DIR))  # warm up
    times = {}
    for name in PLANS:
        query = catalog.QUERIES[name]
        times[name] = min(seconds(lambda: run(query(spark, SF_DIR))) for _ in range(REPEAT))
    for name in FILE_RUNS:
        times[name] = seconds(lambda: run(catalog.QUERIES[name](spark, SF_DIR)))
    times["merge_recent_percent"] = recent_percent(spark)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": {name: round(t, 3) for name, t in times.items()}, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
