"""Readers for the landing files.

CSV and JSON are read as text columns and cast afterwards, so that one bad field costs one row. Parsing
straight into types would lose more: dropping malformed lines, for one, gives counts that depend on which columns a
query happens to read.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum import schemas
from stratum.functions import casting, lineage
from stratum.sources import elements, footers
from stratum.storage import literal, qualified

# Texts that stand for NULL in the customer files.
NULL_MARKERS = ("NULL", "null", "")
FILE_INFO = "path string, modificationTime timestamp, length long, content binary"

EXCERPT = elements.EXCERPT

Paths = str | Sequence[str]


def _paths(spark: SparkSession, paths: Paths, landing_root: str | None) -> list[str]:
    listed = [paths] if isinstance(paths, str) else list(paths)
    if landing_root is not None:
        for path in listed:
            require_inside(spark, path, landing_root)
    return [literal(p) for p in listed]


def require_inside(spark: SparkSession, path: str, landing_root: str) -> None:
    """Refuse a source path that is not below the allowed root."""
    allowed = qualified(spark, landing_root).rstrip("/")
    actual = qualified(spark, path)
    if actual != allowed and not actual.startswith(allowed + "/"):
        raise PermissionError(f"{path} is outside {landing_root}")


def _folder_options(glob: str) -> dict[str, object]:
    return {"pathGlobFilter": glob, "recursiveFileLookup": True}


def _text_columns(schema: T.StructType) -> T.StructType:
    return schemas.as_text(schema).add(casting.CORRUPT, T.StringType())


def read_csv(
    spark: SparkSession, paths: Paths, schema: T.StructType, *, landing_root: str | None = None,
    quote: str = "", glob: str = "*.csv", null_markers: Sequence[str] = NULL_MARKERS, positions: bool = False,
    exact_width: bool = False,
) -> DataFrame:
    """Comma-separated text with one header line; columns are bound by position, whatever the header says.

    Quoting is off unless ``quote`` is given. In a line with too few fields the others are NULL; in one with
    too many the last ones are not looked at. With ``exact_width`` such lines carry the line in
    ``_corrupt_record``.
    """
    df = (
        spark.read.schema(_text_columns(schema) if exact_width else schemas.as_text(schema))
        .options(header=True, enforceSchema=True, sep=",", quote=quote, encoding="UTF-8",
                 mode="PERMISSIVE", columnNameOfCorruptRecord=casting.CORRUPT, **_folder_options(glob))
        # With pruning, whether a line counts as malformed depends on the columns a query reads.
        .option("columnPruning", False)
        .csv(_paths(spark, paths, landing_root))
    )
    if positions:
        df = df.select("*", *lineage.split_position())
    return casting.null_if(df, null_markers, schema.fieldNames())


def read_json_array(
    spark: SparkSession, paths: Paths, schema: T.StructType, *, landing_root: str | None = None,
    glob: str = "*.json", positions: bool = False,
) -> DataFrame:
    """Files that hold a JSON array: one row per element, fields bound by name, as text.

    Files whose lines hold whole objects (an array written line by line, or objects without an array around them) are
    parsed line by line. In other files elements may lie over any number of lines, whole lines among them; their lines
    are brought together first (see ``elements``). Both are read by many tasks. A broken element is one row with its
    text in ``_corrupt_record``, lines of junk in a row are one with the beginning of the text, and a broken line with
    several elements in it costs the line. The brackets around the elements may be missing, and the separators between
    whole lines. Bytes that are not UTF-8 become U+FFFD.
    """
    def scan(files: list[str]) -> DataFrame:
        return spark.read.options(**_folder_options(glob)).text(files)

    listed = _paths(spark, paths, landing_root)
    file, line = F.col("_metadata.file_path"), F.col("value")
    spread = ~elements.says_nothing(line) & ~elements.is_whole(line)
    by_file = scan(listed).groupBy(file.alias("file")).agg(F.max(spread).alias("spread")).where("spread").collect()
    names = [row.file for row in by_file]  # of the files of one batch
    *where, running = lineage.split_position()
    by_line = scan(listed).where(~file.isin(names)) if names else scan(listed)
    found = _elements(by_line.select("value", *(where if positions else [])), schema)
    found = found.select("*", running) if positions else found
    if not names:
        return found.drop(_AT)
    texts = elements.put_together(scan([literal(unquote(f)) for f in names]).select("value", *lineage.split_position()))
    rest = _elements(texts, schema)
    rest = elements.numbered(rest, "part", "piece", _AT) if positions else rest
    return found.drop(_AT).unionByName(rest.select(*[c for c in found.columns if c != _AT]))


_AT = "__at"


def _elements(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per element of each text; a text that is not JSON is one row, marked corrupt. Other columns stay."""
    kind = _text_columns(schema)
    kept = [c for c in texts.columns if c != "value"]
    # Step by step, so that each text is parsed once however often the result is used.
    pieces = texts.select("value", elements.inside_array(F.col("value")).alias("array"), *kept)
    parsed = pieces.select(
        "value", F.json_array_length("array").alias("count"),
        F.from_json("array", T.ArrayType(kind)).alias("parsed"), *kept,
    )
    # The parser leaves out what it cannot fit into rows; then the text counts as corrupt as a whole.
    complete = F.coalesce(F.size("parsed") == F.col("count"), F.lit(False))
    corrupt = F.struct(*[
        (F.col("value") if f.name == casting.CORRUPT else F.lit(None).cast("string")).alias(f.name)
        for f in kind
    ])
    found = F.when(complete, F.col("parsed")).otherwise(F.array(corrupt))
    return parsed.select(F.posexplode(found).alias(_AT, "element"), *kept).select("element.*", _AT, *kept)


def read_parquet(
    spark: SparkSession, paths: Paths, schema: T.StructType, *, landing_root: str | None = None,
    glob: str = "*.parquet", positions: bool = False,
) -> DataFrame:
    """Columns of ``schema`` that the files have, by name, in the files' own types.

    Footers are merged by a Spark job. If files disagree on a type, another one tells the files' kinds apart; files whose
    kinds agree are read together, and the parts are brought together as text. So the number of jobs follows that of
    kinds that disagree, however many files there are and in whatever order.
    """
    reader = spark.read.options(mergeSchema=True, **_folder_options(glob))
    listed = _paths(spark, paths, landing_root)

    def pick(df: DataFrame, as_text: bool = False) -> DataFrame:
        columns = [
            casting.convert(F.col(f.name), df.schema[f.name].dataType, T.StringType()).alias(f.name)
            if as_text else F.col(f.name)
            for f in schema.fields if f.name in df.columns
        ]
        return df.select(*columns, *(lineage.indexed_position() if positions else []))

    def agreeing(files: list[str]) -> list[DataFrame]:
        try:
            return [reader.parquet(*files)]
        except (PySparkException, Py4JJavaError) as error:
            if len(files) == 1 or not _cannot_merge(error):
                raise
        return agreeing(files[: len(files) // 2]) + agreeing(files[len(files) // 2 :])

    try:
        return pick(reader.parquet(*listed))
    except (PySparkException, Py4JJavaError) as error:
        if not _cannot_merge(error):
            raise
    groups = footers.groups_that_agree(list_files(spark, listed, glob).select("path"))
    parts = [pick(part, as_text=True) for files in groups for part in agreeing([literal(f) for f in files])]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _cannot_merge(error: Exception) -> bool:
    """Whether the files' footers disagree, by the name of the error's condition."""
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    cause = getattr(error, "java_exception", None)
    while condition is None and cause is not None:
        condition = cause.getCondition() if hasattr(cause, "getCondition") else None
        cause = cause.getCause()
    return "CANNOT_MERGE_SCHEMAS" in (condition or "")


def read_parquet_cast(
    spark: SparkSession, paths: Paths, schema: T.StructType, *, landing_root: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) rows of Parquet files, cast to ``schema`` whatever types the files have."""
    return casting.cast_or_reject(read_parquet(spark, paths, schema, landing_root=landing_root), schema)


def list_files(spark: SparkSession, paths: Paths, glob: str = "*") -> DataFrame:
    listed = [paths] if isinstance(paths, str) else list(paths)
    return (
        spark.read.format("binaryFile").schema(FILE_INFO).options(**_folder_options(glob))
        .load(listed).drop("content")
    )


def list_landing(spark: SparkSession, landing_root: str, folder: str = "", glob: str = "*") -> DataFrame:
    """Path, size and time of the files in a landing folder; contents are not read."""
    path = f"{landing_root.rstrip('/')}/{folder}".rstrip("/")
    require_inside(spark, path, landing_root)
    return list_files(spark, path, glob)


@dataclass(frozen=True)
class Source:
    """One kind of landing file and the raw table it feeds."""

    table: str
    folder: str
    glob: str
    schema: T.StructType
    read: Callable[..., DataFrame]
    row_index: bool = False

    def location(self, landing_root: str) -> str:
        return f"{landing_root.rstrip('/')}/{self.folder}"

    @property
    def raw_schema(self) -> T.StructType:
        return schemas.extend(self.schema, schemas.LINEAGE, schemas.BATCH)

    @property
    def reject_schema(self) -> T.StructType:
        return schemas.extend(self.schema, schemas.LINEAGE, schemas.ERRORS, schemas.BATCH)


CUSTOMERS = Source("raw_customer", "Customer", "*.csv", schemas.CUSTOMER, read_csv)
PRODUCTS = Source("raw_product", "Product", "*.json", schemas.PRODUCT, read_json_array)
ORDERS = Source("raw_order", "Order", "*.parquet", schemas.ORDER, read_parquet, row_index=True)
SOURCES = (CUSTOMERS, PRODUCTS, ORDERS)


def preview(spark: SparkSession, source: Source, landing_root: str, n: int = 10, files: int = 10) -> DataFrame:
    """First rows of some landing files, uncast. Only these files are opened."""
    location = source.location(landing_root)
    some = [row.path for row in list_files(spark, location, source.glob).select("path").orderBy("path").limit(files).collect()]
    if not some:
        return spark.createDataFrame([], schemas.as_text(source.schema))
    return source.read(spark, some, source.schema, landing_root=landing_root).limit(n)
