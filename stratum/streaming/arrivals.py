"""Deliver each file of a folder once.

A run lists the folder, leaves out what earlier runs took by an anti-join with a table of their names, and hands over the
rest, oldest first. The handler reads the files with the ordinary batch reader, where column pruning, filter pushdown and
adaptive planning all work. One run handles what is there and stops; when to run is up to an outside scheduler.

The driver holds the listing of the folder and one entry per hand-over, never the names of all files ever seen: files
that were loaded may be moved away, and what came before stays known.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum import storage
from stratum.sources.files import list_files

# Hand-overs after which their names are brought together in one folder.
FOLD_AFTER = 200


@dataclass(frozen=True)
class Delivery:
    """One hand-over. ``feed`` and ``epoch`` are the same again when it is replayed after a failure."""

    feed: str
    epoch: int
    names: DataFrame

    @property
    def batch_id(self) -> str:
        return f"{self.feed}-{self.epoch:09d}"

    def paths(self) -> list[str]:
        """File names, on the driver: for deliveries whose size is bounded by ``files_per_batch``."""
        return [row.path for row in self.names.collect()]


class Arrivals:
    """The position of one reader in one folder, kept in ``state``."""

    def __init__(self, spark: SparkSession, folder: str, glob: str, state: str):
        self.spark, self.folder, self.glob, self.state = spark, folder, glob, state

    def generation(self) -> str:
        """Folder of the current position. A reset opens a new one, which counts once its feed is named."""
        for name in reversed(storage.names(self.spark, self.state)):
            if storage.exists(self.spark, f"{self.state}/{name}/feed"):
                return f"{self.state}/{name}"
        return self.reset()

    def feed(self) -> str:
        """The name that this position gives to its deliveries."""
        return storage.read_text(self.spark, f"{self.generation()}/feed")

    def reset(self) -> str:
        """Forget the position, in one step: the next run starts over."""
        found = storage.names(self.spark, self.state)
        number = int(found[-1].removeprefix("g")) + 1 if found else 1
        path = f"{self.state}/g{number:06d}"
        # A random name, so that epochs of different generations never look alike downstream.
        storage.write_text(self.spark, f"{path}/feed", uuid.uuid4().hex[:16])
        return path

    def run(self, handle: Callable[[Delivery], None], files_per_batch: int | None = None) -> int:
        """Hand over all new files; return how many hand-overs there were.

        The names of a hand-over are fixed before it begins, and it counts when ``handle`` has returned. If that raises,
        the same files come again under the same epoch. Files count as the same by path, whatever their time or content.
        """
        spark, generation = self.spark, self.generation()
        feed = storage.read_text(spark, f"{generation}/feed")
        if not storage.exists(spark, self.folder):
            return 0
        offers, done = _Offers(spark, generation), 0

        def deliver(epoch: int, names: DataFrame) -> None:
            nonlocal done
            handle(Delivery(feed, epoch, names))
            offers.take(epoch)
            done += 1

        offers.import_stream()
        unfinished = offers.unfinished()
        if unfinished is not None:
            deliver(unfinished, offers.names(unfinished))
        offers.fold()

        path = f"{generation}/arrived/{uuid.uuid4().hex}"
        listed = list_files(spark, self.folder, self.glob).select("path", "modificationTime")
        listed.join(offers.seen(), "path", "left_anti").write.parquet(path)
        arrived = left = spark.read.schema(listed.schema).parquet(path)
        age = F.struct(F.unix_micros("modificationTime").alias("time"), "path")
        waiting = arrived.count()
        while waiting:
            # At most ``files_per_batch`` names pass through the driver.
            batch = left.orderBy(age).limit(files_per_batch) if files_per_batch else left
            epoch = offers.last() + 1
            names = offers.offer(epoch, batch)
            held = names.agg(F.count("path").alias("files"), F.max(age).alias("newest")).first()
            deliver(epoch, names.select("path"))
            waiting -= held.files
            left = arrived.where(age > F.struct(F.lit(held.newest.time).cast("long"), F.lit(held.newest.path)))
        storage.remove(spark, path)
        return done


class _Offers:
    """The hand-overs of one position: what each holds, and which came to their end.

    ``names/offer=<name>`` holds the files of one hand-over, ``offered/<epoch>`` says which name it has and is written in
    one step, ``taken/<epoch>`` that it is done. ``folded/<epoch>`` names a folder with all files up to that epoch.
    """

    NAMES = "path string, modificationTime timestamp, offer string"
    ENTRY = "epoch long, offer string"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _epochs(self, kind: str) -> list[int]:
        return [int(name) for name in storage.names(self.spark, f"{self.root}/{kind}")]

    def _entry(self, kind: str, epoch: int) -> dict:
        return json.loads(storage.read_text(self.spark, f"{self.root}/{kind}/{epoch:09d}"))

    def _folder(self, offer: str) -> str:
        return f"{self.root}/names/offer={offer}"

    def _publish(self, kind: str, epoch: int, files: DataFrame) -> None:
        offer = f"o{uuid.uuid4().hex}"
        files.select("path", "modificationTime").write.parquet(self._folder(offer))
        storage.write_text(self.spark, f"{self.root}/{kind}/{epoch:09d}", json.dumps({"epoch": epoch, "offer": offer}))

    def _folded(self) -> int:
        return max(self._epochs("folded"), default=-1)

    def last(self) -> int:
        return max(self._epochs("offered"), default=self._folded())

    def unfinished(self) -> int | None:
        """The epoch of a hand-over that did not come to its end."""
        epoch = self.last()
        return epoch if epoch > self._folded() and epoch not in self._epochs("taken") else None

    def offer(self, epoch: int, files: DataFrame) -> DataFrame:
        """Fix what the next hand-over holds. Of two runs at once one fails here."""
        self._publish("offered", epoch, files)
        return self.names(epoch)

    def names(self, epoch: int) -> DataFrame:
        return self.spark.read.schema(self.NAMES).parquet(self._folder(self._entry("offered", epoch)["offer"])).drop("offer")

    def take(self, epoch: int) -> None:
        storage.write_text(self.spark, f"{self.root}/taken/{epoch:09d}", "")

    def seen(self) -> DataFrame:
        """The paths of all hand-overs. Names of one that was never published are no part of them."""
        spark, base = self.spark, self._folded()
        if self.last() < 0:
            return spark.createDataFrame([], "path string")
        valid = spark.createDataFrame([self._entry("folded", base)] if base >= 0 else [], self.ENTRY)
        if storage.exists(spark, f"{self.root}/offered"):
            offered = spark.read.schema(self.ENTRY).json(f"{self.root}/offered")
            valid = valid.union(offered.where(F.col("epoch") > base))
        names = spark.read.schema(self.NAMES).parquet(f"{self.root}/names")
        return names.join(valid, "offer", "left_semi").select("path")

    def fold(self) -> None:
        """Bring the names of many hand-overs together, so that opening them does not take longer with each."""
        base, last = self._folded(), self.last()
        offered = [epoch for epoch in self._epochs("offered") if epoch > base]
        if len(offered) < FOLD_AFTER:
            return
        old = [self._entry("offered", epoch)["offer"] for epoch in offered]
        old += [self._entry("folded", base)["offer"]] if base >= 0 else []
        self._publish("folded", last, self.seen().withColumn("modificationTime", F.lit(None).cast("timestamp")))
        # From here on the new folder counts; what a crash leaves of the old ones is not looked at.
        for offer in old:
            storage.remove(self.spark, self._folder(offer))
        for epoch in offered:
            for kind in ("offered", "taken"):
                storage.remove(self.spark, f"{self.root}/{kind}/{epoch:09d}")

    def import_stream(self) -> None:
        """Go on where a file stream was, as which positions of earlier releases began.

        Files of its finished batches count as seen; a batch that it did not finish comes again as it was.
        """
        spark, stream = self.spark, f"{self.root}/checkpoint"
        if not storage.exists(spark, f"{stream}/sources/0") or storage.exists(spark, f"{self.root}/imported"):
            return

        def end(epoch: int) -> int:
            return json.loads(storage.read_text(spark, f"{stream}/offsets/{epoch}").splitlines()[-1])["logOffset"]

        log = spark.read.schema("path string, batchId long").json(f"{stream}/sources/0").where("path IS NOT NULL")
        decoded = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
        log = log.distinct().select(
            F.regexp_replace(decoded, "^file:///", "file:/").alias("path"), "batchId",
            F.lit(None).cast("timestamp").alias("modificationTime"))
        done = max((int(n) for n in storage.names(spark, f"{stream}/commits")), default=-1)
        begun = max((int(n) for n in storage.names(spark, f"{stream}/offsets")), default=-1)
        finished = end(done) if done >= 0 else -1
        if begun > done and not self._epochs("offered"):
            self._publish("offered", begun, log.where(F.col("batchId").between(finished + 1, end(begun))))
        if done >= 0 and not self._epochs("folded"):
            self._publish("folded", done, log.where(F.col("batchId") <= finished))
        storage.write_text(spark, f"{self.root}/imported", "")
