"""Checked queries about what is kept beside the rows: lineage, positions of feeds, counters, stamps; and about how files
are written. Landing files come from the given tables, as in ``scenarios``."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures
from checks.scenarios import Workspace
from stratum.functions import casting
from stratum.functions.cleaning import utc_now
from stratum.plans import runs
from stratum.sources import files
from stratum.streaming import loads

UPDATED = "last_updated_timestamp"
DELIVERIES = (fixtures.first_delivery, fixtures.second_delivery)


def compressed_csv(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Files whose names fit the pattern are read, compressed ones too; plain ones beside them are not."""
    space, source = Workspace(spark), files.CUSTOMERS
    space.landing.write(source, rows)
    draft = f"{space.landing.root}/drafts/gz"
    rows.write.options(header=True, emptyValue="", compression="gzip", ignoreLeadingWhiteSpace=False,
                       ignoreTrailingWhiteSpace=False).csv(draft)
    space.landing._move(draft, source.location(space.landing.root), ".csv.gz")
    found = files.read_csv(
        spark, source.location(space.landing.root), source.schema, landing_root=space.landing.root, glob="*.csv.gz")
    return casting.cast_with_errors(found, source.schema).select(*source.schema.fieldNames())


def quoted_csv(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Quotes around a name are part of it, as no quote character is declared."""
    space, source = Workspace(spark), files.CUSTOMERS
    draft = f"{space.landing.root}/drafts/quoted"
    quoted = rows.withColumn("name", F.concat(F.lit('"'), "name", F.lit('"')))
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in rows.columns]
    space.landing._in_files(quoted, F.concat_ws(",", *fields), draft, ",".join(rows.columns) + "\n", "\n", "")
    space.landing._move(draft, source.location(space.landing.root), ".csv")
    space.load(source)
    return space.raw(source).select(*source.schema.fieldNames())


def json_not_utf8(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Each name ends in a byte that is no UTF-8."""
    space, source = Workspace(spark), files.PRODUCTS
    draft = f"{space.landing.root}/drafts/latin"
    rows.withColumn("name", F.concat("name", F.lit("é"))).write.option("encoding", "ISO-8859-1").json(draft)
    space.landing._move(draft, source.location(space.landing.root), ".json")
    space.load(source)
    return space.raw(source).select(*source.schema.fieldNames())


def lineage(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Files listed in the landing folder against files named in the raw table, and the times of the loads."""
    space, source = Workspace(spark), files.CUSTOMERS
    began = spark.range(1).select(utc_now().alias("now")).first().now
    for cut in DELIVERIES:
        space.landing.write(source, cut(rows, "customer"))
        space.load(source)
    name = functools.partial(F.regexp_extract, pattern="[^/]*$", idx=0)
    stamped = F.col("ingestion_timestamp").between(F.lit(began).cast("timestamp_ntz"), utc_now())
    raw = space.raw(source).groupBy(name(F.col("source_file_name")).alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(stamped).alias("stamped"))
    # A part without rows is a file with a header alone, or none at all: the raw table does not name it.
    listed = files.list_landing(spark, space.landing.root, source.folder, source.glob)
    header = len(",".join(rows.columns)) + 1
    listed = listed.where(F.col("length") > header).select(name(F.col("path")).alias("file"), F.lit(True).alias("listed"))
    return raw.join(listed, "file", "full").agg(
        F.sum("n").alias("row_count"), F.count_if(F.col("n").isNull() | F.col("listed").isNull()).alias("unmatched_files"),
        F.bool_and("stamped").alias("stamped"))


def recreated(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """A raw table that is made anew holds each file once again."""
    space, source = Workspace(spark), files.PRODUCTS
    space.landing.write(source, rows)
    for recreate in (False, False, True):
        loads.load(spark, source, space.landing.root, space.layout, recreate=recreate)
    return space.raw(source).select(*source.schema.fieldNames())


def feed_positions(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """What two consumers of one table get: each has a position, which moves when its function returns and not before."""
    space, which, got = Workspace(spark), runs.ORDERS, []

    def deliver(cut) -> None:
        space.landing.write(which.source, cut(rows, which.name))
        space.load(which.source)

    def keep(step: str, rows: DataFrame) -> None:
        got.append(rows.agg(
            F.lit(step).alias("step"), F.count(F.lit(1)).alias("row_count"), F.sum("quantity").alias("quantity"),
            F.min("transaction_id").alias("lowest"), F.max("transaction_id").alias("highest")))

    def consume(feed, step: str) -> None:
        feed.consume(lambda rows, delivery: keep(step, rows))

    def fail(rows: DataFrame, delivery) -> None:
        keep("one, failing", rows)
        raise InterruptedError

    one, two = (runs.feed(spark, space.layout, which, consumer) for consumer in ("one", "two"))
    deliver(fixtures.first_delivery)
    consume(one, "one, first")
    deliver(fixtures.second_delivery)
    keep("one, looking", one.pending())
    try:
        one.consume(fail)
    except InterruptedError:
        pass
    consume(one, "one, again")
    consume(one, "one, more than there is")
    consume(two, "two, all")
    one.reset()
    keep("one, reset", one.pending())
    return functools.reduce(DataFrame.unionByName, got)


def messages(spark: SparkSession, raw: dict[str, DataFrame]) -> DataFrame:
    """What the three merges say of each of two deliveries."""
    space, said = Workspace(spark), []
    calls = {"customer": runs.process_customer_changes, "product": runs.merge_product_to_silver, "orders": runs.merge_order_to_silver}
    sources = {which.name: which.source for which in runs.CONFORMED}
    for number, cut in enumerate(DELIVERIES, 1):
        for name, call in calls.items():
            space.landing.write(sources[name], cut(raw[name], name))
            space.load(sources[name])
            said += [(number, stats.message) for stats in call(spark, space.layout)]
    return spark.createDataFrame(said, "delivery int, message string")


def stamps(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """How many rows the second merge stamped anew; those beside them in a slice keep their time."""
    space, which, first = Workspace(spark), runs.CUSTOMER, None
    for cut in DELIVERIES:
        space.landing.write(which.source, cut(rows, which.name))
        space.load(which.source)
        runs.merge(spark, space.layout, which)
        table = runs.table(spark, space.layout, which).read()
        if first is None:
            first = table.agg(F.max(UPDATED).alias("last")).first().last
    newer = F.col(UPDATED) > F.lit(first).cast("timestamp_ntz")
    return table.agg(F.count_if(newer).alias("stamped_again"), F.count_if(~newer).alias("as_before"))


def replayed(spark: SparkSession, rows: DataFrame, which: runs.Conformed) -> DataFrame:
    """Each merge is cut short after its commit, before the feed knows of it, and run again."""
    space = Workspace(spark)
    for cut in DELIVERIES:
        space.landing.write(which.source, cut(rows, which.name))
        space.load(which.source)
        target = runs.table(spark, space.layout, which)
        target.ensure()

        def merge_and_stop(pending: DataFrame, delivery) -> None:
            target.merge(runs.cleaning.stamp(which.clean(pending, keep=runs.ARRIVAL_ORDER)), delivery, "error", runs.ARRIVAL_ORDER)
            raise InterruptedError

        try:
            runs.feed(spark, space.layout, which).consume(merge_and_stop)
        except InterruptedError:
            pass
        runs.merge(spark, space.layout, which)
    return runs.table(spark, space.layout, which).read().drop(UPDATED)
