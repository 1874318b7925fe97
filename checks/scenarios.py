"""Checked queries that need files: landing folders are written from the given tables, loaded, merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures
from stratum import storage
from stratum.layout import Layout
from stratum.plans import runs
from stratum.session import work_root
from stratum.sources import files
from stratum.streaming import loads

ELEMENTS_PER_FILE = 2_000


class Landing:
    """Writes rows as landing files of the three kinds."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.drops = spark, root, 0

    def write(self, source: files.Source, rows: DataFrame) -> None:
        self.drops += 1
        folder, draft = source.location(self.root), f"{self.root}/drafts/{self.drops:03d}"
        if source is files.CUSTOMERS:
            rows.write.options(header=True, emptyValue="", ignoreLeadingWhiteSpace=False,
                               ignoreTrailingWhiteSpace=False).csv(draft)
        elif source is files.PRODUCTS:
            self._json_arrays(rows, draft)
        else:
            rows.write.parquet(draft)
        extension = source.glob.removeprefix("*")
        self._move(draft, folder, extension)

    def _json_arrays(self, rows: DataFrame, path: str, broken: Column | None = None, spread: Column | None = None) -> None:
        """One array of a bounded number of objects per file; those that are ``broken`` lack their end, ``spread`` ones
        go over several lines."""
        row = F.struct(*rows.columns)
        text = F.to_json(row)
        if spread is not None:
            text = F.when(spread, F.to_json(row, {"pretty": "true"})).otherwise(text)
        if broken is not None:
            text = F.when(broken, F.substring(text, 1, 15)).otherwise(text)
        self._in_files(rows, text, path, "[", ",\n", "]")

    @staticmethod
    def _in_files(rows: DataFrame, text: Column, path: str, before: str, between: str, behind: str) -> None:
        chunks = rows.count() // ELEMENTS_PER_FILE + 1
        chunk = F.pmod(F.xxhash64(*rows.columns), F.lit(chunks)).alias("chunk")
        rows.select(text.alias("one"), chunk).groupBy("chunk").agg(
            F.concat(F.lit(before), F.concat_ws(between, F.collect_list("one")), F.lit(behind)).alias("value")
        ).write.partitionBy("chunk").text(path)

    def _move(self, draft: str, folder: str, extension: str) -> None:
        found = files.list_files(self.spark, draft).select("path").toLocalIterator()
        for number, row in enumerate(sorted(r.path for r in found)):
            storage.rename(self.spark, row, f"{folder}/drop{self.drops:03d}-{number:05d}{extension}")

    def write_json(self, rows: DataFrame, broken: Column | None = None, spread: Column | None = None) -> None:
        """Products, some of them cut off, some over several lines, the others one per line."""
        self.drops += 1
        draft = f"{self.root}/drafts/{self.drops:03d}"
        self._json_arrays(rows, draft, broken, spread)
        self._move(draft, files.PRODUCTS.location(self.root), ".json")

    def write_ragged_csv(self, rows: DataFrame) -> None:
        """Customers; some lines end after five fields, some have two more than they should."""
        self.drops += 1
        draft = f"{self.root}/drafts/{self.drops:03d}"
        fields = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in rows.columns]
        kind = F.coalesce(F.col("customer_id") % 4, F.lit(0))
        line = F.when(kind == 1, F.concat_ws(",", *fields[:5])).when(kind == 2, F.concat_ws(",", *fields, F.lit("x"), F.lit("y")))
        self._in_files(rows, line.otherwise(F.concat_ws(",", *fields)), draft, ",".join(rows.columns) + "\n", "\n", "")
        self._move(draft, files.CUSTOMERS.location(self.root), ".csv")


class Workspace:
    """A fresh warehouse and landing folder below the working folder."""

    def __init__(self, spark: SparkSession):
        root = work_root(spark)
        self.spark = spark
        self.landing = Landing(spark, f"{root}/landing")
        self.layout = Layout(f"{root}/warehouse")

    def load(self, source: files.Source) -> None:
        loads.load(self.spark, source, self.landing.root, self.layout)

    def raw(self, source: files.Source) -> DataFrame:
        return loads.read_raw(self.spark, source, self.layout)


def round_trip(spark: SparkSession, rows: DataFrame, which: runs.Conformed) -> DataFrame:
    """Write the rows as landing files in two parts, load after each, return the raw table."""
    space, source = Workspace(spark), which.source
    odd = F.pmod(F.xxhash64(*rows.columns), F.lit(2)) == 1
    for part in (rows.where(odd), rows.where(~odd)):
        space.landing.write(source, part)
        space.load(source)
        space.load(source)  # nothing new: must add nothing
    return space.raw(source).select(*source.schema.fieldNames())


def mixed_types(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Orders in files of three kinds, loaded at once: as declared; all text; other types, columns in another order."""
    space, source = Workspace(spark), files.ORDERS
    kind = F.pmod(F.xxhash64(*rows.columns), F.lit(3))
    as_text = [F.col(c).cast("string").alias(c) for c in rows.columns]
    other = {"quantity": "long", "product_id": "string", "transaction_date": "timestamp"}
    as_other = [F.col(c).cast(other[c]).alias(c) if c in other else F.col(c) for c in reversed(rows.columns)]
    space.landing.write(source, rows.where(kind == 0))
    space.landing.write(source, rows.where(kind == 1).select(*as_text))
    space.landing.write(source, rows.where(kind == 2).select(*as_other))
    space.load(source)
    return space.raw(source).select(*source.schema.fieldNames())


def spread_products() -> Column:
    """Which products go over several lines."""
    return F.coalesce(F.col("product_id") % 3 == 1, F.lit(True))


def row_numbers(spark: SparkSession, rows: DataFrame, which: runs.Conformed) -> DataFrame:
    """Per file of the raw table, whether its row numbers are exactly 1..n; then rows in all."""
    space, source = Workspace(spark), which.source
    if source is files.PRODUCTS:
        space.landing.write_json(rows, spread=spread_products())
    else:
        space.landing.write(source, rows)
    space.load(source)
    number = F.col("source_file_row_number")
    per_file = space.raw(source).groupBy("source_file_name").agg(
        F.count(number).alias("n"), F.countDistinct(number).alias("d"), F.min(number).alias("lo"), F.max(number).alias("hi")
    )
    good = (F.col("n") == F.col("d")) & (F.col("lo") == 1) & (F.col("hi") == F.col("n"))
    return per_file.agg(F.sum("n").alias("row_count"), F.bool_and(good).alias("numbered_from_one"))


def two_deliveries(spark: SparkSession, raw: dict[str, DataFrame], consume_last: bool = True) -> Workspace:
    """Load and merge the first delivery of each table, then the second."""
    space = Workspace(spark)
    by_name = {which.name: which for which in runs.CONFORMED}
    for number, cut in enumerate((fixtures.first_delivery, fixtures.second_delivery)):
        for name, rows in raw.items():
            which = by_name[name]
            space.landing.write(which.source, cut(rows, name))
            space.load(which.source)
            if number == 0 or consume_last:
                runs.merge(spark, space.layout, which)
    return space


def pending(spark: SparkSession, raw: dict[str, DataFrame]) -> DataFrame:
    """Rows of the second delivery, not merged yet, as each change feed counts them."""
    space = two_deliveries(spark, raw, consume_last=False)
    counts = [
        runs.feed(spark, space.layout, which).pending()
        .agg(F.count(F.lit(1)).alias("pending_rows")).select(F.lit(which.source.table).alias("table_name"), "pending_rows")
        for which in runs.CONFORMED if which.name in raw
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def backfilled_twice(spark: SparkSession, raw: DataFrame, which: runs.Conformed) -> DataFrame:
    space = Workspace(spark)
    space.landing.write(which.source, raw)
    space.load(which.source)
    runs.backfill(spark, space.layout, which)
    runs.backfill(spark, space.layout, which)
    return runs.table(spark, space.layout, which).read().drop("last_updated_timestamp")


def json_with_broken_elements(spark: SparkSession, rows: DataFrame, spread: Column | None = None) -> Workspace:
    space = Workspace(spark)
    space.landing.write_json(rows, F.col("product_id") % 10 == 0, spread)
    space.load(files.PRODUCTS)
    return space


def rejects(space: Workspace, source: files.Source) -> DataFrame:
    return loads.read_rejects(space.spark, source, space.layout)


def ragged_csv(spark: SparkSession, rows: DataFrame) -> DataFrame:
    space, source = Workspace(spark), files.CUSTOMERS
    space.landing.write_ragged_csv(rows)
    space.load(source)
    return space.raw(source).select(*source.schema.fieldNames())


def live_views(spark: SparkSession, raw: dict[str, DataFrame]) -> Workspace:
    """Registered before the first load; both deliveries are loaded and merged afterwards."""
    space = Workspace(spark)
    runs.register(spark, space.layout)
    by_name = {which.name: which for which in runs.CONFORMED}
    for cut in (fixtures.first_delivery, fixtures.second_delivery):
        for name, rows in raw.items():
            space.landing.write(by_name[name].source, cut(rows, name))
        runs.run_loads(spark, space.layout, space.landing.root)
        runs.run_merges(spark, space.layout)
    return space
