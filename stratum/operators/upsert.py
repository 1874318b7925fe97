"""Merge incoming rows into a keyed table: update where the key matches, insert where it does not.

Semantics are those of SQL MERGE. NULL keys match nothing, so such rows are always inserted. A target row
matched by several incoming rows is an error, unless ``on_duplicate="latest"`` picks one first. A key that
is repeated among the incoming rows but absent from the target is simply inserted as often as it comes.

The merge finds the keys that are on both sides, marks the incoming rows that have one, and joins those to the target
from the left; the others are added as they are. One full outer join could neither broadcast a small batch nor be split
where a key is hot, while these joins can. The incoming rows are shuffled by key once.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ON_DUPLICATE = ("error", "latest")


class DuplicateSourceKey(ValueError):
    """Several incoming rows match one target row."""


@dataclass(frozen=True)
class UpsertStats:
    table: str
    inserted: int = 0
    updated: int = 0
    version: int = 0
    replayed: bool = False

    @property
    def message(self) -> str:
        if self.replayed:
            return f"{self.table}: already applied"
        return f"{self.table} processed: {self.inserted} inserted, {self.updated} updated"


def latest_per_key(source: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order_by``; rows without a key all stay.

    Aggregates before it shuffles, so a key that comes a billion times is a few rows per task.
    """
    columns = source.columns
    picked = (
        source.where(F.col(key).isNotNull()).groupBy(key)
        .agg(F.max_by(F.struct(*columns), F.struct(*order_by)).alias("row"))
        .select(*[F.col("row").getField(c).alias(c) for c in columns])
    )
    return picked.unionByName(source.where(F.col(key).isNull()))


def copies_of(source: DataFrame, key: str) -> DataFrame:
    """Each key and how often it comes."""
    return source.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("copies"))


def matched_keys(target: DataFrame, copies: DataFrame, key: str, *carry: str, grouped: bool = True) -> DataFrame:
    """Keys on both sides, with ``carry`` columns of the target, the number of target rows (``rows``) and
    of source rows (``copies``).

    Reads no other column of the target. Its keys are ``grouped`` before they are joined, so that one that is repeated
    there is a row per task before anything moves. Where the incoming keys are few enough to be broadcast the join
    comes first, and no other key moves at all.
    """
    keys = target.where(F.col(key).isNotNull()).select(key, *carry)
    one = F.lit(1).cast("long").alias("n")
    keys = keys.groupBy(key, *carry).agg(F.count(F.lit(1)).alias("n")) if grouped else keys.select("*", one)
    return keys.join(_own_stage(copies, key), key).groupBy(key, *carry).agg(F.sum("n").alias("rows"), F.max("copies").alias("copies"))


_HIT = "__hit"


def marked(source: DataFrame, key: str, matched: DataFrame) -> DataFrame:
    """The rows with ``__hit``: whether their key is among the matched ones. Rows without a key go around the join."""
    hits = _own_stage(matched.select(F.col(key).alias("__key")).distinct(), "__key").withColumn(_HIT, F.lit(True))
    keyed = source.where(F.col(key).isNotNull()).join(hits, F.col(key) == F.col("__key"), "left").drop("__key")
    keyed = keyed.withColumn(_HIT, F.coalesce(_HIT, F.lit(False)))
    return keyed.unionByName(source.where(F.col(key).isNull()).withColumn(_HIT, F.lit(False)))


def merge_rows(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """All rows after the merge. ``source`` is the result of ``marked``, with single copies of matched keys."""
    new = source.where(_HIT).select(F.col(key).alias("__key"), F.struct(*[c for c in target.columns if c != key]).alias("__new"))
    hit = F.col("__new").isNotNull()
    updated = target.where(F.col(key).isNotNull()).join(_own_stage(new, "__key"), F.col(key) == F.col("__key"), "left").select(*[
        F.col(key) if c == key else F.when(hit, F.col("__new").getField(c)).otherwise(F.col(c)).alias(c)
        for c in target.columns
    ])
    parts = [
        updated,
        source.where(~F.col(_HIT)).select(*target.columns),
        # Rows without a key match nothing. In a join they would all meet in one task.
        target.where(F.col(key).isNull()),
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def _own_stage(df: DataFrame, key: str) -> DataFrame:
    """Let a computed join side end in a shuffle of its own. AQE splits a hot key on the other side only
    when both sides are finished stages. What moves here is never more than the batch."""
    return df.repartition(F.xxhash64(key))


def deduplicate(source: DataFrame, key: str, on_duplicate: str, order_by: Sequence[str]) -> DataFrame:
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"on_duplicate must be one of {ON_DUPLICATE}")
    if on_duplicate == "error":
        return source
    if not order_by:
        raise ValueError("on_duplicate='latest' needs order_by")
    return latest_per_key(source, key, order_by)


def _single_copies(matched: DataFrame, key: str) -> DataFrame:
    text = F.concat(F.lit("several incoming rows match key "), F.col(key).cast("string"))
    single = F.when(F.col("copies") > 1, F.raise_error(text).cast("boolean")).otherwise(F.lit(True))
    return matched.where(single)


def _prepared(target, source, key, on_duplicate, order_by) -> tuple[DataFrame, DataFrame]:
    source = deduplicate(source, key, on_duplicate, order_by)
    return source, _single_copies(matched_keys(target, copies_of(source, key), key), key)


def upsert(
    target: DataFrame, source: DataFrame, key: str, on_duplicate: str = "error", order_by: Sequence[str] = (),
) -> DataFrame:
    """The target after the merge, as a plan. A duplicate match raises when the plan runs."""
    source, matched = _prepared(target, source, key, on_duplicate, order_by)
    return merge_rows(target, marked(source.select(*target.columns), key, matched), key)


def upsert_stats(
    target: DataFrame, source: DataFrame, key: str, on_duplicate: str = "error", order_by: Sequence[str] = (),
) -> DataFrame:
    """One row: how many rows the merge inserts and updates."""
    source, matched = _prepared(target, source, key, on_duplicate, order_by)
    keyed = source.where(F.col(key).isNotNull()).join(_own_stage(matched.select(key), key), key, "left_anti")
    inserts = keyed.unionByName(source.where(F.col(key).isNull()))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    parts = inserts.select(one.alias("i"), zero.alias("u")).union(matched.select(zero, F.col("rows")))
    total = {"rows_inserted": "i", "rows_updated": "u"}
    return parts.agg(*[F.coalesce(F.sum(c), zero).alias(name) for name, c in total.items()])
