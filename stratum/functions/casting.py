"""Typed values out of text, and the rows that have none."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
ERRORS = "errors"

_TIME = r"(?:[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?)?\s*$"
# Spellings of a date, and how to read what the pattern finds.
DATE_FORMATS = (
    (r"^\s*(\d{4}-\d{1,2}-\d{1,2})" + _TIME, "y-M-d"),
    (r"^\s*(\d{1,2}/\d{1,2}/\d{4})" + _TIME, "M/d/y"),
    (r"^\s*(?i)(\d{1,2}-(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)-\d{4})" + _TIME, "d-MMM-y"),
)


def null_if(df: DataFrame, markers: Iterable[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Replace marker texts by NULL; by default in every string column."""
    markers = list(markers)
    chosen = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(*markers), F.col(c)) for c in chosen})


def convert(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """``value`` as ``target``, or NULL where it has no such value.

    A fraction becomes the nearest whole number, halves away from zero. A date is a full date in one of
    ``DATE_FORMATS``, a time behind it is cut off; a bare number or a year alone is none.
    """
    if source == target:
        return value
    if isinstance(target, T.StringType):
        return F.hex(value) if isinstance(source, T.BinaryType) else value.cast(target)
    if isinstance(target, T.IntegralType):
        if isinstance(source, T.IntegralType):
            return value.try_cast(target)
        whole = F.round(value.try_cast("decimal(38,18)"), 0).try_cast(target)
        # Plain digits, the usual case, never reach the decimal path.
        return F.coalesce(value.try_cast(target), whole) if isinstance(source, T.StringType) else whole
    if isinstance(target, T.FractionalType) and isinstance(source, T.StringType):
        # The JVM reads "1.5d" and "1.5f" as numbers; a data file does not mean that.
        return F.when(~value.rlike(r"[0-9.][dDfF]\s*$"), value.try_cast(target))
    if isinstance(target, T.DateType) and isinstance(source, T.NumericType):
        return F.lit(None).cast(target)
    if isinstance(target, T.DateType) and isinstance(source, T.StringType):
        return F.coalesce(*[
            F.when(value.rlike(pattern), F.try_to_date(F.regexp_extract(value, pattern, 1), form))
            for pattern, form in DATE_FORMATS
        ])
    direct = isinstance(source, T.StringType) or (
        isinstance(target, (T.FractionalType, T.BooleanType)) and isinstance(source, T.NumericType)
    ) or (isinstance(target, T.DateType) and isinstance(source, (T.TimestampType, T.TimestampNTZType)))
    return (value if direct else value.cast("string")).try_cast(target)


def cast_with_errors(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns of ``schema``, keep all others, and add ``errors``: NULL for a good row,
    else one entry per value that could not be cast. A column the input lacks is NULL."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    present = [f for f in schema.fields if f.name in kinds]
    typed_name = {f.name: f"__{f.name}" for f in schema.fields}
    carried = [c for c in df.columns if c not in typed_name and c != CORRUPT]

    typed = df.withColumns({
        typed_name[f.name]: convert(F.col(f.name), kinds[f.name], f.dataType) if f.name in kinds
        else F.lit(None).cast(f.dataType) for f in schema.fields
    })
    faults = [
        (F.col(f.name).isNotNull() & F.col(typed_name[f.name]).isNull(),
         F.lit(f.name), F.col(f.name).cast("string"), F.lit(f"not a valid {f.dataType.simpleString()}"))
        for f in present if kinds[f.name] != f.dataType
    ]
    if CORRUPT in kinds:
        faults.append((F.col(CORRUPT).isNotNull(), F.lit("*"), F.col(CORRUPT), F.lit("malformed record")))

    errors = F.lit(None).cast("array<struct<column:string,value:string,reason:string>>")
    if faults:
        entries = [
            F.when(test, F.struct(name.alias("column"), value.alias("value"), reason.alias("reason")))
            for test, name, value, reason in faults
        ]
        any_fault = faults[0][0]
        for test, *_ in faults[1:]:
            any_fault = any_fault | test
        errors = F.when(any_fault, F.array_compact(F.array(*entries)))
    return typed.select(
        *[F.col(typed_name[f.name]).alias(f.name) for f in schema.fields],
        *carried,
        errors.alias(ERRORS),
    )


def cast_or_reject(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their errors). Every input row is in exactly one of them."""
    checked = cast_with_errors(df, schema)
    return checked.where(F.col(ERRORS).isNull()).drop(ERRORS), checked.where(F.col(ERRORS).isNotNull())


def json_fields(df: DataFrame, column: str, fields: dict[str, tuple[str, T.DataType]]) -> DataFrame:
    """Add typed columns from a JSON text column: ``{name: (path, type)}``; absent or unfit is NULL.

    When all paths are top-level keys the text is parsed once for all of them.
    """
    keys = {name: re.fullmatch(r"\$\.([A-Za-z_]\w*)", path) for name, (path, _) in fields.items()}
    if all(keys.values()):
        wanted = sorted({m.group(1) for m in keys.values()})
        record = F.from_json(column, T.StructType([T.StructField(k, T.StringType()) for k in wanted]))
        texts = {name: record.getField(m.group(1)) for name, m in keys.items()}
    else:
        texts = {name: F.get_json_object(column, path) for name, (path, _) in fields.items()}
    return df.withColumns({
        name: convert(texts[name], T.StringType(), kind) for name, (_, kind) in fields.items()
    })
