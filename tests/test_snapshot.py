import datetime as dt
import json

import pytest

from stratum import schemas, storage
from stratum.operators import snapshot
from stratum.operators.snapshot import SnapshotTable, by_date, by_hash
from stratum.operators.upsert import DuplicateSourceKey
from stratum.streaming.arrivals import Delivery
from tests.conftest import rows

SCHEMA = schemas.struct(k=schemas.TEXT, day=schemas.DAY, v=schemas.INT)


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "orders"), SCHEMA, "k", by_date("day"))


@pytest.fixture
def frame(spark):
    def make(*data):
        return spark.createDataFrame([(k, d, v) for k, d, v in data], "k string, d string, v int").selectExpr(
            "k", "CAST(d AS DATE) AS day", "v")
    return make


def content(table):
    return [(k, d and d.isoformat(), v) for k, d, v in rows(table.read())]


def delivery(epoch, feed="f"):
    return Delivery(feed, epoch, None)


def live(table):
    return {part: commit for commit, part in table._current()["live"]}


def test_empty_table(table):
    table.ensure()
    table.ensure()
    assert (table.version(), content(table)) == (0, [])
    assert [(f.name, f.dataType) for f in table.read().schema] == [(f.name, f.dataType) for f in SCHEMA]


def test_merge_updates_and_inserts(table, frame):
    one = table.merge(frame(("a", "2024-01-05", 1), ("b", "2024-02-05", 2), ("c", None, 3)))
    assert (one.inserted, one.updated, one.version) == (3, 0, 1)
    two = table.merge(frame(("a", "2024-01-05", 9), ("d", "2024-03-05", 4)))
    assert (two.inserted, two.updated, two.version) == (1, 1, 2)
    assert two.message == "orders processed: 1 inserted, 1 updated"
    assert content(table) == [("a", "2024-01-05", 9), ("b", "2024-02-05", 2), ("c", None, 3), ("d", "2024-03-05", 4)]


def test_only_slices_with_matches_are_rewritten(table, frame):
    table.merge(frame(("a", "2024-01-05", 1), ("b", "2024-02-05", 2), ("c", None, 3)))
    before = live(table)
    table.merge(frame(("a", "2024-01-06", 9)))
    after = live(table)
    assert after["2024-02"] == before["2024-02"] and after["undated"] == before["undated"]
    assert after["2024-01"] != before["2024-01"]


def test_a_row_can_move_to_another_slice(table, frame):
    table.merge(frame(("a", "2024-01-05", 1), ("b", "2024-01-06", 2), ("c", "2024-02-01", 3)))
    stats = table.merge(frame(("a", "2024-02-05", 9)))
    assert (stats.inserted, stats.updated) == (0, 1)
    assert content(table) == [("a", "2024-02-05", 9), ("b", "2024-01-06", 2), ("c", "2024-02-01", 3)]


def test_null_and_repeated_target_keys(table, frame):
    table.append(frame((None, "2024-01-05", 0), ("a", "2024-01-05", 1), ("a", "2024-02-05", 2)))
    stats = table.merge(frame((None, "2024-01-05", 5), ("a", "2024-03-05", 7)))
    assert (stats.inserted, stats.updated) == (1, 2)
    assert content(table) == [
        (None, "2024-01-05", 0), (None, "2024-01-05", 5), ("a", "2024-03-05", 7), ("a", "2024-03-05", 7)]


def test_append_repeats_rows(table, frame):
    batch = frame(("a", "2024-01-05", 1))
    assert (table.append(batch).inserted, table.append(batch).inserted) == (1, 1)
    assert content(table) == [("a", "2024-01-05", 1)] * 2


def test_replay_is_not_applied_twice(table, frame):
    batch = frame((None, "2024-01-05", 1))
    table.merge(batch, delivery(0))
    replay = table.merge(batch, delivery(0))
    assert replay.replayed and replay.message == "orders: already applied"
    assert table.merge(batch, delivery(0, "other")).inserted == 1  # another feed's epoch 0 is another batch
    assert len(content(table)) == 2


def test_crash_before_the_commit_leaves_the_old_version(table, frame, monkeypatch):
    table.merge(frame(("a", "2024-01-05", 1)), delivery(0))
    real = SnapshotTable._publish
    monkeypatch.setattr(SnapshotTable, "_publish", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.merge(frame(("a", "2024-01-05", 2)), delivery(1))
    monkeypatch.setattr(SnapshotTable, "_publish", real)
    assert content(table) == [("a", "2024-01-05", 1)]
    table.merge(frame(("a", "2024-01-05", 2)), delivery(1))
    assert content(table) == [("a", "2024-01-05", 2)]


def test_duplicates(table, frame):
    table.merge(frame(("a", "2024-01-05", 1)))
    twice = frame(("a", "2024-01-05", 2), ("a", "2024-01-05", 3), ("n", "2024-01-05", 1), ("n", "2024-01-05", 2))
    with pytest.raises(DuplicateSourceKey, match="2 incoming rows match key a"):
        table.merge(twice)
    assert content(table) == [("a", "2024-01-05", 1)]
    stats = table.merge(twice, on_duplicate="latest", order_by=["v"])
    assert (stats.inserted, stats.updated) == (1, 1)
    assert content(table) == [("a", "2024-01-05", 3), ("n", "2024-01-05", 2)]


def test_second_writer_fails_at_the_commit(table, frame, spark, monkeypatch):
    table.merge(frame(("a", "2024-01-05", 1)))
    stale = table._current()
    other = SnapshotTable(spark, table.path, SCHEMA, "k", by_date("day"))
    other.merge(frame(("b", "2024-01-05", 2)))
    monkeypatch.setattr(table, "_current", lambda: stale)
    with pytest.raises(RuntimeError, match="another writer"):
        table.merge(frame(("c", "2024-01-05", 3)))
    assert content(other) == [("a", "2024-01-05", 1), ("b", "2024-01-05", 2)]


@pytest.mark.parametrize("step", ["_write", "_commit", "_publish"])
def test_two_writers_interleave(table, frame, spark, monkeypatch, step):
    """Another writer does a whole merge right before this one's next step."""
    table.merge(frame(("a", "2024-01-05", 1)))
    other = SnapshotTable(spark, table.path, SCHEMA, "k", by_date("day"))
    original = getattr(table, step)

    def late(*args, **options):
        monkeypatch.setattr(table, step, original)
        other.merge(frame(("b", "2024-01-05", 2)))
        return original(*args, **options)

    monkeypatch.setattr(table, step, late)
    with pytest.raises(RuntimeError, match="another writer"):
        table.merge(frame(("c", "2024-01-05", 3)))
    assert content(other) == [("a", "2024-01-05", 1), ("b", "2024-01-05", 2)]
    assert storage.names(spark, f"{table.path}/work") == []


def test_drafts_of_two_writers_do_not_meet(spark, tmp_path, monkeypatch):
    path, publish = f"{tmp_path}/log/1.json", storage._publish

    def late(*args):
        monkeypatch.setattr(storage, "_publish", publish)
        storage.write_text(spark, path, "second")
        publish(*args)

    monkeypatch.setattr(storage, "_publish", late)
    with pytest.raises(FileExistsError):
        storage.write_text(spark, path, "first")
    assert storage.read_text(spark, path) == "second"
    assert [p.name for p in (tmp_path / "log").iterdir() if not p.name.startswith(".")] == ["1.json"]


def test_many_small_commits_are_brought_together(table, frame):
    for i in range(5):
        table.merge(frame((f"k{i}", "2024-01-05", i)))
    before = content(table)
    folders = len(table.live())
    assert folders == 5 and table.compact(6) == 0 and table.compact(3) == 1
    assert len(table.live()) == 1 and content(table) == before
    table.merge(frame(("k0", "2024-01-05", 9)))
    assert ("k0", "2024-01-05", 9) in content(table) and len(before) == 5


def test_drop_history(table, frame, spark):
    table.merge(frame(("a", "2024-01-05", 1), ("b", "2024-02-05", 1)))
    table.merge(frame(("a", "2024-01-05", 2)))
    assert table.drop_history() == 1
    assert content(table) == [("a", "2024-01-05", 2), ("b", "2024-02-05", 1)]
    assert json.loads(storage.read_text(spark, f"{table.path}/log/000000002.json"))["version"] == 2
    assert storage.names(spark, f"{table.path}/work") == []


def test_hash_slices(spark, tmp_path, frame):
    table = SnapshotTable(spark, str(tmp_path / "t"), SCHEMA, "k", by_hash("k", 8))
    table.merge(frame(*[(f"k{i}", "2024-01-05", i) for i in range(200)], (None, None, 0)))
    before = live(table)
    assert len(before) == 8
    table.merge(frame(("k3", "2024-01-05", 99)))
    after = live(table)
    assert sum(before[s] != after[s] for s in before) == 1
    assert len(content(table)) == 201 and ("k3", "2024-01-05", 99) in content(table)


def test_slice_names_are_safe_folder_names(spark, tmp_path, frame):
    table = SnapshotTable(spark, str(tmp_path / "t"), SCHEMA, "k", by_date("day", "yyyy/MM 'a:b='"))
    table.merge(frame(("a", "2024-01-05", 1), ("b", None, 2)))
    table.merge(frame(("a", "2024-01-05", 3)))
    assert content(table) == [("a", "2024-01-05", 3), ("b", None, 2)]
    assert set(live(table)) == {"2024_01_a_b_", "undated"}


@pytest.fixture
def dated(spark, tmp_path, frame):
    table = SnapshotTable(spark, str(tmp_path / "orders"), SCHEMA, "k", by_date("day"), "day")
    table.merge(frame(("a", "2024-01-05", 1), ("b", "2024-02-05", 2), ("c", "2024-03-07", 3), ("d", "2024-03-09", 4), ("e", None, 5)))
    return table


def folders_listed(df):
    return {file.split("slice=")[1].split("/")[0] for file in df.inputFiles()}


def test_a_range_of_days_lists_its_folders_only(dated, frame):
    day = dt.date.fromisoformat
    got = dated.read(day("2024-02-01"), day("2024-03-08"))
    assert folders_listed(got) == {"2024-02", "2024-03"} and {r.k for r in got.collect()} == {"b", "c"}
    assert {r.k for r in dated.read(day("2024-03-08")).collect()} == {"d"}
    assert {r.k for r in dated.read(last=day("2024-02-05")).collect()} == {"a", "b"}
    late = dated.read(day("2024-03-08"), undated=True)
    assert folders_listed(late) == {"2024-03", "undated"} and {r.k for r in late.collect()} == {"d", "e"}
    assert dated.read(day("2025-01-01")).count() == 0
    # A merge moves a row to another month, and days follow.
    dated.merge(frame(("a", "2024-06-30", 9)))
    assert {r.k for r in dated.read(day("2024-06-01")).collect()} == {"a"}
    assert dated.read(last=day("2024-01-31")).count() == 0
    assert {f.slice: f.days for f in dated.folders()}["2024-03"] == ("2024-03-07", "2024-03-09", False)


def test_folders_of_unknown_days_are_read(dated, spark, tmp_path, frame):
    """As written before days were kept."""
    plain = SnapshotTable(spark, str(tmp_path / "plain"), SCHEMA, "k", by_date("day"))
    plain.merge(frame(("a", "2024-01-05", 1), ("b", "2024-02-05", 2)))
    later = SnapshotTable(spark, plain.path, SCHEMA, "k", by_date("day"), "day")
    later.merge(frame(("c", "2024-03-05", 3)))
    got = later.read(dt.date(2024, 2, 1), dt.date(2024, 2, 28))
    assert [r.k for r in got.collect()] == ["b"] and folders_listed(got) == {"2024-01", "2024-02"}
    with pytest.raises(ValueError, match="no day"):
        plain.read(dt.date(2024, 2, 1))


def test_old_versions_are_dropped_in_time(table, frame, spark, monkeypatch):
    for i in range(4):
        table.merge(frame(("a", "2024-01-05", i)))
    table.drop_history()
    assert len(storage.names(spark, f"{table.path}/log")) == 5  # a writer may still be at work
    monkeypatch.setattr(snapshot, "ABANDONED_AFTER", 0)
    table.drop_history()
    assert storage.names(spark, f"{table.path}/log") == ["000000003.json", "000000004.json"]
    assert content(table) == [("a", "2024-01-05", 3)] and table.version() == 4
