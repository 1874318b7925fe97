"""A keyed Parquet table that changes in whole, atomic commits.

Rows lie in ``data/commit=<id>/slice=<s>/``; a small JSON file per version lists the folders that are live.
A merge looks for the slices that hold matching keys (reading only the key column), rewrites those, and
adds new rows beside the others. Files in use are never overwritten, so readers and retries are safe.
A table with a ``day`` column keeps the first and last day of each folder beside the list, so that a range of days
opens, and even lists, no other folder.
One writer per table is assumed. Of two that commit the same version one fails at the commit, and nothing of
it is seen.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum import storage
from stratum.operators import upsert as merging
from stratum.operators.upsert import DuplicateSourceKey, UpsertStats
from stratum.streaming.arrivals import Delivery

SLICE = "slice"
# A commit that is not finished after so long will not be.
ABANDONED_AFTER = 86_400


def one_slice() -> Column:
    """For tables small enough to rewrite whole."""
    return F.lit("all")


def by_date(column: str, pattern: str = "yyyy-MM") -> Callable[[], Column]:
    """For tables whose changes are mostly recent: a merge leaves the slices of old dates alone.

    Months by default; a finer ``pattern`` makes merges rewrite less and the table have more folders.
    """
    return lambda: F.coalesce(F.date_format(column, pattern), F.lit("undated"))


def by_hash(key: str, slices: int) -> Callable[[], Column]:
    """For large tables without a date: a merge of a few keys rewrites only the slices they fall into."""
    return lambda: F.coalesce(F.pmod(F.xxhash64(key), F.lit(slices)), F.lit(0)).cast("string")


class Folder(NamedTuple):
    """A live folder. ``days`` is None where no days are known, else the first and the last day of its rows (None if no
    row has one) in ISO form, and whether some rows have none."""

    commit: str
    slice: str
    days: tuple[str | None, str | None, bool] | None = None

    @property
    def path(self) -> str:
        return f"commit={self.commit}/{SLICE}={self.slice}"

    def meets(self, first: dt.date | None, last: dt.date | None) -> bool:
        """Whether it may hold rows of the days from ``first`` to ``last``."""
        if self.days is None:
            return True
        low, high, _ = self.days
        return low is not None and (last is None or low <= last.isoformat()) and (first is None or high >= first.isoformat())


class SnapshotTable:
    FOLDERS = T.StructType([T.StructField("commit", T.StringType()), T.StructField(SLICE, T.StringType())])

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str,
        slice_by: Callable[[], Column] = one_slice, day: str | None = None,
    ):
        self.spark, self.path, self.schema, self.key, self.slice_by = spark, path, schema, key, slice_by
        self.day = day
        self.name = path.rstrip("/").rsplit("/", 1)[-1]

    # -- reading -----------------------------------------------------------------------------------

    def ensure(self) -> None:
        """Create the empty table if it is absent."""
        if not self._versions():
            self._publish({"version": 0, "live": [], "applied": {}})

    def version(self) -> int:
        return self._current()["version"]

    def read(self, first: dt.date | None = None, last: dt.date | None = None, undated: bool = False) -> DataFrame:
        """All rows. With ``first`` or ``last``, those of the days from the one to the other, and with ``undated`` those
        without a day as well; folders of other days are left out before anything is listed."""
        if first is None and last is None:
            return self._scan(self._current()["live"]).select(*self.schema.fieldNames())
        if self.day is None:
            raise ValueError(f"{self.name} has no day column")
        chosen = [f for f in self.folders() if f.meets(first, last) or undated and f.days[2]]
        day = F.col(self.day)
        wanted = F.lit(True) if first is None else day >= F.lit(first)
        wanted = wanted if last is None else wanted & (day <= F.lit(last))
        wanted = wanted | day.isNull() if undated else wanted & day.isNotNull()
        return self._scan([[f.commit, f.slice] for f in chosen]).where(wanted).select(*self.schema.fieldNames())

    def live(self) -> list[tuple[str, str]]:
        """(commit, slice) of the folders that make up the current version."""
        return [(commit, part) for commit, part in self._current()["live"]]

    def folders(self, back: int = 0) -> list[Folder]:
        """The folders of the current version, or of one ``back`` versions ago; none if that is no longer known."""
        versions = self._versions()
        if back and len(versions) <= back:
            return []
        state = json.loads(storage.read_text(self.spark, f"{self.path}/log/{versions[-1 - back]}")) if back else self._current()
        days = state.get("days", {})
        return [Folder(commit, part, tuple(days[f"{commit}/{part}"]) if f"{commit}/{part}" in days else None)
                for commit, part in state["live"]]

    def span(self) -> tuple[dt.date, dt.date] | None:
        """First and last day of all rows; None if no row has one. Reads rows only where the days of a folder are unknown."""
        folders = self.folders()
        ends = [dt.date.fromisoformat(day) for f in folders if f.days and f.days[0] for day in f.days[:2]]
        unknown = [[f.commit, f.slice] for f in folders if f.days is None]
        if unknown:
            ends += [d for d in self._scan(unknown).agg(F.min(self.day), F.max(self.day)).first() if d is not None]
        return (min(ends), max(ends)) if ends else None

    def _versions(self) -> list[str]:
        return storage.names(self.spark, f"{self.path}/log")

    def _current(self) -> dict:
        self.ensure()
        return json.loads(storage.read_text(self.spark, f"{self.path}/log/{self._versions()[-1]}"))

    def _scan(self, live: list) -> DataFrame:
        schema = T.StructType([*self.schema.fields, *self.FOLDERS.fields])
        if not live:
            return self.spark.createDataFrame([], schema).drop("commit")
        folders = [f"{self.path}/data/commit={commit}/{SLICE}={part}" for commit, part in live]
        return (
            self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
            .parquet(*folders).drop("commit")
        )

    # -- writing -----------------------------------------------------------------------------------

    def append(self, rows: DataFrame) -> UpsertStats:
        """Plain insert: no key is looked at, repeating it repeats the rows."""
        state = self._current()
        commit, written = self._write(rows, state)
        version = self._commit(state, commit, rewritten=set(), delivery=None)
        return UpsertStats(self.name, written, 0, version)

    def merge(
        self, source: DataFrame, delivery: Delivery | None = None, on_duplicate: str = "error",
        order_by: Sequence[str] = (),
    ) -> UpsertStats:
        """Upsert. A ``delivery`` that an earlier commit holds already is skipped."""
        state = self._current()
        if delivery and state["applied"].get(delivery.feed, -1) >= delivery.epoch:
            return UpsertStats(self.name, version=state["version"], replayed=True)
        source = merging.deduplicate(source, self.key, on_duplicate, order_by)
        source = source.select(*self.schema.fieldNames())

        stored = self._scan(state["live"])
        work = f"{self.path}/work/{uuid.uuid4().hex}"
        try:
            # Stored: the batch is worked out once, and true sizes let Spark broadcast what is small.
            source = self._kept(source, f"{work}/batch")
            copies = self._kept(merging.copies_of(source, self.key), f"{work}/keys")
            grouped = not self._is_small(copies)
            matched = self._kept(merging.matched_keys(stored, copies, self.key, SLICE, grouped=grouped), f"{work}/matched")
            totals = matched.groupBy(SLICE).agg(
                F.sum("rows").alias("rows"), F.max_by(self.key, "copies").alias("key"), F.max("copies").alias("copies")
            ).collect()  # one row per slice
            for row in totals:
                if row.copies > 1:
                    raise DuplicateSourceKey(f"{self.name}: {row.copies} incoming rows match key {row.key}")
            rewrite = {row[SLICE] for row in totals}
            # The same scan, its files listed once; only the folders of these slices are read.
            touched = stored.where(F.col(SLICE).isin(*rewrite) if rewrite else F.lit(False)).drop(SLICE)
            marked = self._kept(merging.marked(source, self.key, matched), f"{work}/marked", "__hit") if rewrite else source.withColumn("__hit", F.lit(False))
            commit, written = self._write(merging.merge_rows(touched, marked, self.key), state)
            # Row counts come from Parquet footers; they stay exact when tasks are retried.
            inserted = written - touched.count()
            version = self._commit(state, commit, rewrite, delivery)
        finally:
            storage.remove(self.spark, work)
        return UpsertStats(self.name, inserted, sum(row.rows for row in totals), version)

    def _kept(self, rows: DataFrame, path: str, *folders: str) -> DataFrame:
        rows.write.partitionBy(*folders).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _is_small(self, rows: DataFrame) -> bool:
        """Whether Spark, which knows the size of stored rows, broadcasts them."""
        size = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        most = self.spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        return int(size) <= most

    def compact(self, folders: int = 24) -> int:
        """Rewrite the slices that lie in at least so many folders as one each; return how many there were.

        Merges that only add rows to a slice leave one more folder each. When to compact is up to an outside
        scheduler, like everything else; the rows do not change.
        """
        state = self._current()
        held = Counter(part for _, part in state["live"])
        rewrite = {part for part, n in held.items() if n >= folders and n > 1}
        if rewrite:
            rows = self._scan(state["live"]).where(F.col(SLICE).isin(*rewrite)).drop(SLICE)
            commit, _ = self._write(rows, state)
            self._commit(state, commit, rewrite, delivery=None)
        return len(rewrite)

    def _slice(self) -> Column:
        """The slice of a row, in characters that a folder name holds as they are."""
        return F.coalesce(F.regexp_replace(self.slice_by(), "[^A-Za-z0-9._-]", "_"), F.lit("none"))

    def _write(self, rows: DataFrame, state: dict) -> tuple[str, int]:
        commit = f"{state['version'] + 1:09d}-{uuid.uuid4().hex[:8]}"
        path = f"{self.path}/data/commit={commit}"
        (
            rows.select(*self.schema.fieldNames(), self._slice().alias(SLICE))
            # Few files per slice, and several tasks for a slice that is large.
            .hint("rebalance", SLICE)
            .write.partitionBy(SLICE).parquet(path)
        )
        return commit, self.spark.read.schema(self.schema).parquet(path).count()

    def _commit(self, state: dict, commit: str, rewritten: set[str], delivery: Delivery | None) -> int:
        written = storage.names(self.spark, f"{self.path}/data/commit={commit}")
        live = [entry for entry in state["live"] if entry[1] not in rewritten]
        live += [[commit, folder.removeprefix(f"{SLICE}=")] for folder in written]
        applied = dict(state["applied"])
        if delivery:
            applied[delivery.feed] = delivery.epoch
        days = {**state.get("days", {}), **self._days(commit)}
        days = {folder: days[folder] for folder in map("/".join, live) if folder in days}
        self._publish({"version": state["version"] + 1, "live": live, "applied": applied, "days": days})
        return state["version"] + 1

    def _days(self, commit: str) -> dict[str, list]:
        """First and last day of each folder that was just written, and whether rows without one are there. Reads this one
        column; the result is a row per folder."""
        folder = f"{self.path}/data/commit={commit}"
        if self.day is None or not storage.names(self.spark, folder):
            return {}
        day = F.col(self.day)
        found = (
            self.spark.read.schema(T.StructType([self.schema[self.day], self.FOLDERS[SLICE]])).parquet(folder)
            .groupBy(SLICE).agg(F.min(day).alias("first"), F.max(day).alias("last"), F.max(day.isNull()).alias("undated"))
        )
        return {f"{commit}/{row[SLICE]}": [row["first"] and row["first"].isoformat(), row["last"] and row["last"].isoformat(), row["undated"]]
                for row in found.collect()}

    def _publish(self, state: dict) -> None:
        try:
            storage.write_text(self.spark, f"{self.path}/log/{state['version']:09d}.json", json.dumps(state))
        except FileExistsError:
            raise RuntimeError(f"{self.name}: version {state['version']} was committed by another writer") from None

    def drop_history(self, older_than: float = 0) -> int:
        """Delete what the current version does not use and is at least ``older_than`` seconds old; return how
        many folders. Commits and merges that may still be at work are left alone."""
        state = self._current()
        live = {f"commit={commit}/{SLICE}={part}" for commit, part in state["live"]}
        dropped = 0
        for commit in storage.names(self.spark, f"{self.path}/data"):
            done = int(commit.removeprefix("commit=").split("-")[0]) <= state["version"]
            least = older_than if done else max(older_than, ABANDONED_AFTER)
            for part in storage.names(self.spark, f"{self.path}/data/{commit}"):
                folder = f"{self.path}/data/{commit}/{part}"
                if f"{commit}/{part}" not in live and storage.age(self.spark, folder) >= least:
                    storage.remove(self.spark, folder)
                    dropped += 1
        # The last two versions stay: readers by SQL may still look at the one before. A writer that began from an older one
        # must find the next version taken, so that is not removed before the writer counts as abandoned.
        for name in self._versions()[:-2]:
            if storage.age(self.spark, f"{self.path}/log/{name}") >= max(older_than, ABANDONED_AFTER):
                storage.remove(self.spark, f"{self.path}/log/{name}")
        for name in storage.names(self.spark, f"{self.path}/work"):
            if storage.age(self.spark, f"{self.path}/work/{name}") >= max(older_than, ABANDONED_AFTER):
                storage.remove(self.spark, f"{self.path}/work/{name}")
        return dropped
