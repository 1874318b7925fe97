"""Rows appended to a raw table since a consumer last looked.

Rows that are appended together lie in one folder, which appears in one step. So what is pending is the difference of two
lists of folders: those of the table, and those that earlier deliveries took. Only pending folders are listed and opened.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum import storage
from stratum.sources.files import list_files
from stratum.streaming.arrivals import Arrivals, Delivery

# The folder of rows that were appended together.
BATCH = "batch_id"
SEEN = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("epoch", T.LongType()),
    T.StructField("modificationTime", T.TimestampType()),
])
PLANNED = T.StructType([T.StructField("folders", T.ArrayType(T.StringType()))])


class ChangeFeed:
    """Append-only change feed of one table for one consumer.

    Consumers have positions of their own. A delivery is planned first: a small file names its folders. The consumer's
    function gets their rows, and when it has returned the files are entered in a ledger. If it fails, the same rows come
    again under the same ``(feed, epoch)``, so a sink that stores that pair with its commit can tell.
    ``start_from="latest"`` skips what the table holds already.
    """

    def __init__(
        self, spark: SparkSession, table_path: str, schema: T.StructType, state: str,
        consumer: str = "default", start_from: str = "earliest",
    ):
        if start_from not in ("earliest", "latest"):
            raise ValueError(f"start_from must be earliest or latest, not {start_from}")
        self.spark, self.table_path, self.schema = spark, table_path, schema
        self.position = Arrivals(spark, table_path, "*.parquet", f"{state}/{consumer}")
        if start_from == "latest" and not storage.names(spark, f"{state}/{consumer}"):
            self.skip_to_end()

    def consume(self, apply: Callable[[DataFrame, Delivery], None], batches_per_call: int | None = None) -> int:
        """Give all pending rows to ``apply``; return the number of calls (0 when nothing is pending).

        By default everything pending is one call, as one merge of the whole feed needs it; a delivery that failed
        before is repeated as it was and comes first.
        """
        calls, feed, epoch = 0, self.position.feed(), self._last_epoch()
        open_folders = self._unfinished()
        if open_folders:
            calls += self._deliver(feed, epoch, open_folders, apply)
        # A batch of which no row could be cast is an empty folder.
        new = [folder for folder in self._unplanned() if storage.names(self.spark, self._path(folder))]
        size = batches_per_call or max(len(new), 1)
        for start in range(0, len(new), size):
            epoch += 1
            folders = new[start:start + size]
            storage.write_text(self.spark, f"{self._plans()}/{epoch:09d}.json", json.dumps({"folders": folders}))
            calls += self._deliver(feed, epoch, folders, apply)
        return calls

    def _deliver(self, feed: str, epoch: int, folders: list[str], apply: Callable[[DataFrame, Delivery], None]) -> int:
        # A table that was recreated in the meantime has lost the folders of a failed delivery.
        held = [folder for folder in folders if storage.exists(self.spark, self._path(folder))]
        files = list_files(self.spark, [self._path(folder) for folder in held], "*.parquet") if held else None
        if held:
            apply(self._rows(held), Delivery(feed, epoch, files.select("path")))
        # After the sink's commit: a crash in between only repeats what follows.
        entries = (
            files.select("path", F.lit(epoch).cast("long").alias("epoch"), "modificationTime")
            if held else self.spark.createDataFrame([], SEEN)
        )
        entries.write.mode("overwrite").parquet(f"{self._ledger()}/epoch={epoch}")
        return 1 if held else 0

    def skip_to_end(self) -> None:
        self.consume(lambda rows, delivery: None)

    def reset(self) -> None:
        """Start over; rows that were consumed before will come again."""
        self.position.reset()

    def pending(self) -> DataFrame:
        """Rows not consumed yet; looking does not consume them. Only their files are opened."""
        return self._rows([f for f in (*self._unfinished(), *self._unplanned()) if storage.exists(self.spark, self._path(f))])

    def offset(self) -> DataFrame:
        """One row: the last consumed epoch, files consumed, and the write time of the newest of them."""
        return self._seen().agg(
            F.max("epoch").alias("epoch"),
            F.count("path").alias("files"),
            F.max("modificationTime").alias("table_timestamp"),
        )

    def _plans(self) -> str:
        return f"{self.position.generation()}/planned"

    def _ledger(self) -> str:
        return self._consumed()

    def _consumed(self) -> str:
        return f"{self.position.generation()}/consumed"

    def _seen(self) -> DataFrame:
        path = self._consumed()
        if not storage.exists(self.spark, path):
            return self.spark.createDataFrame([], SEEN)
        return self.spark.read.schema(SEEN).parquet(path)

    def _last_epoch(self) -> int:
        plans = storage.names(self.spark, self._plans())
        if plans:
            return int(plans[-1].removesuffix(".json"))
        done = [int(name.removeprefix("epoch=")) for name in storage.names(self.spark, self._consumed())]
        # The one after the last may have reached the sink; its number is not given to other rows.
        return max(done, default=-1) + 1 if self._was_streamed() else -1

    def _was_streamed(self) -> bool:
        """Whether the position began as that of a file stream, as in earlier releases; only the ledger has its files."""
        return storage.exists(self.spark, f"{self.position.generation()}/checkpoint")

    def _unfinished(self) -> list[str]:
        """Folders of the last planned delivery, if it did not come to its end."""
        epoch = self._last_epoch()
        planned = f"{self._plans()}/{epoch:09d}.json"
        if not storage.exists(self.spark, planned) or storage.exists(self.spark, f"{self._consumed()}/epoch={epoch}/_SUCCESS"):
            return []
        return json.loads(storage.read_text(self.spark, planned))["folders"]

    def _unplanned(self) -> list[str]:
        """Folders of the table that no delivery has taken. One listing gives the folders; those taken are looked up by
        Spark, and the driver keeps what is left."""
        held = [name for name in storage.names(self.spark, self.table_path) if name.startswith(f"{BATCH}=")]
        if not held or self._last_epoch() < 0:
            return held
        taken = self.spark.createDataFrame([], "folder string")
        if storage.exists(self.spark, self._plans()):
            taken = self.spark.read.schema(PLANNED).json(self._plans()).select(F.explode("folders").alias("folder"))
        if self._was_streamed():
            taken = taken.union(self._seen().select(F.regexp_extract("path", f"/({BATCH}=[^/]*)/", 1)))
        folders = self.spark.createDataFrame([(name,) for name in held], "folder string")
        return sorted(row.folder for row in folders.join(taken, "folder", "left_anti").collect())

    def _path(self, folder: str) -> str:
        return f"{self.table_path}/{folder}"

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        paths = [self._path(folder) for folder in folders]
        rows = self.spark.read.schema(self.schema).option("basePath", self.table_path).parquet(*paths)
        return rows.select(*self.schema.fieldNames())
