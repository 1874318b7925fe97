import pytest
from pyspark.sql import functions as F

from stratum import schemas, storage
from stratum.streaming import changefeed
from stratum.streaming.changefeed import ChangeFeed

SCHEMA = schemas.struct(id=schemas.LONG, batch_id=schemas.TEXT)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "raw")

    def add(start, end, batch):
        spark.range(start, end).coalesce(1).write.parquet(f"{path}/batch_id={batch}")

    return path, add


@pytest.fixture
def feed_of(spark, table, tmp_path):
    return lambda consumer="a", **options: ChangeFeed(
        spark, table[0], SCHEMA, str(tmp_path / "state"), consumer, **options)


def drain(feed):
    got = []
    feed.consume(lambda rows, d: got.extend((r.id, r.batch_id) for r in rows.collect()))
    return sorted(got)


def test_each_row_once(table, feed_of):
    path, add = table
    feed = feed_of()
    assert drain(feed) == []  # no table yet
    add(0, 3, "x")
    assert feed.pending().count() == 3
    assert feed.pending().limit(2).count() == 2
    assert feed.pending().count() == 3  # looking consumes nothing
    assert drain(feed) == [(0, "x"), (1, "x"), (2, "x")]
    assert feed.pending().count() == 0
    calls = feed.consume(lambda rows, d: pytest.fail("nothing is pending"))
    assert calls == 0
    add(3, 5, "y")
    assert [r.id for r in feed.pending().orderBy("id").collect()] == [3, 4]
    assert drain(feed_of()) == [(3, "y"), (4, "y")]


def test_consumers_are_independent(table, feed_of):
    table[1](0, 3, "x")
    assert len(drain(feed_of("a"))) == 3
    assert feed_of("b").pending().count() == 3
    assert len(drain(feed_of("b"))) == 3


def test_failure_in_the_consumer_brings_the_same_rows_again(table, feed_of):
    table[1](0, 3, "x")
    feed, seen = feed_of(), []

    def fail(rows, delivery):
        seen.append((delivery.feed, delivery.epoch))
        raise ValueError("not today")

    with pytest.raises(Exception, match="not today"):
        feed.consume(fail)
    assert feed.pending().count() == 3
    table[1](3, 5, "y")  # arrives in between: must not slip into the replayed delivery
    got = []
    feed.consume(lambda rows, d: got.append(((d.feed, d.epoch), rows.count())))
    assert got[0] == (seen[0], 3)
    assert [n for _, n in got] == [3, 2]


def test_crash_after_the_sink_commit(table, feed_of, monkeypatch):
    table[1](0, 3, "x")
    feed, seen = feed_of(), []
    monkeypatch.setattr(ChangeFeed, "_ledger", lambda self: 1 / 0)
    with pytest.raises(Exception, match="division by zero"):
        feed.consume(lambda rows, d: seen.append((d.feed, d.epoch)))
    monkeypatch.undo()
    feed.consume(lambda rows, d: seen.append((d.feed, d.epoch)))
    assert seen[0] == seen[1]  # by this the sink can tell a replay
    assert feed.pending().count() == 0


def test_offset_and_reset(table, feed_of):
    feed = feed_of()
    assert tuple(feed.offset().first()) == (None, 0, None)
    table[1](0, 3, "x")
    drain(feed)
    offset = feed.offset().first()
    assert (offset.epoch, offset.files) == (0, 1) and offset.table_timestamp is not None
    feed.reset()
    assert feed.pending().count() == 3
    assert len(drain(feed)) == 3


def test_start_from_latest(table, feed_of):
    table[1](0, 3, "x")
    feed = feed_of(start_from="latest")
    assert feed.pending().count() == 0
    table[1](3, 5, "y")
    assert drain(feed_of(start_from="latest")) == [(3, "y"), (4, "y")]
    with pytest.raises(ValueError):
        feed_of(start_from="tomorrow")


def test_pending_counts_without_reading_columns(table, feed_of):
    table[1](0, 3, "x")
    plan = feed_of().pending().agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_only_pending_folders_are_listed(spark, table, feed_of, monkeypatch):
    path, add = table
    feed = feed_of()
    for batch in "abcd":
        add(0, 2, batch)
        drain(feed)
    add(2, 4, "e")
    touched, names, lister = [], storage.names, changefeed.list_files
    monkeypatch.setattr(storage, "names", lambda s, p: touched.append(p) or names(s, p))
    monkeypatch.setattr(changefeed, "list_files", lambda s, paths, *rest: touched.extend(paths) or lister(s, paths, *rest))
    opened = []
    feed.consume(lambda rows, d: opened.extend(rows.inputFiles()))
    assert len(opened) >= 1 and all("batch_id=e" in file for file in opened)
    assert {p for p in touched if p.startswith(f"{path}/")} == {f"{path}/batch_id=e"}
    assert tuple(feed.offset().first())[:2] == (4, 5)


def test_some_batches_at_a_time(table, feed_of):
    for i, batch in enumerate("abc"):
        table[1](i, i + 1, batch)
    got = []
    assert feed_of().consume(lambda rows, d: got.append((d.epoch, rows.count())), batches_per_call=2) == 2
    assert got == [(0, 2), (1, 1)]


def test_folders_without_files_and_folders_that_vanish(spark, table, feed_of, monkeypatch):
    path, add = table
    feed = feed_of()
    storage.make_dir(spark, f"{path}/batch_id=empty")
    assert drain(feed) == [] and feed.pending().count() == 0
    add(0, 3, "x")
    with pytest.raises(ZeroDivisionError):
        feed.consume(lambda rows, d: 1 / 0)
    storage.remove(spark, f"{path}/batch_id=x")  # as when the raw table is recreated
    add(5, 6, "y")
    assert feed.pending().count() == 1
    assert drain(feed) == [(5, "y")] and drain(feed) == []


def test_a_position_of_an_earlier_release_goes_on(spark, table, feed_of):
    """Its ledger says what was consumed; the number after the last one may be in use."""
    path, add = table
    feed = feed_of()
    generation = feed.position.generation()
    add(0, 3, "x")
    files = changefeed.list_files(spark, path, "*.parquet")
    files.select("path", F.lit(0).cast("long").alias("epoch")).write.parquet(f"{generation}/consumed/epoch=0")
    storage.make_dir(spark, f"{generation}/checkpoint")
    add(3, 5, "y")
    assert feed.pending().count() == 2
    got = []
    feed.consume(lambda rows, d: got.append((d.epoch, rows.count())))
    add(5, 6, "z")
    feed.consume(lambda rows, d: got.append((d.epoch, rows.count())))
    assert got == [(2, 2), (3, 1)] and feed.pending().count() == 0
