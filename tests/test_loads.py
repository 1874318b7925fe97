import gzip
import json
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stratum import storage
from stratum.sources import files
from stratum.streaming import arrivals, loads
from stratum.streaming.arrivals import Arrivals

HEADER = "a,b,c,d,e,f,g,h,i\n"


def line(i, name="n", age="30"):
    return f"{i},{name},{i}@x,US,R,2024-01-15,{age},F,5\n"


def customers(landing, name, ids):
    (landing / "Customer" / name).write_text(HEADER + "".join(line(i) for i in ids))


def load(spark, landing, layout, **options):
    return loads.load_customers(spark, str(landing), layout, **options)


def raw(spark, layout, source=files.CUSTOMERS):
    return loads.read_raw(spark, source, layout)


def test_each_file_once(spark, landing, layout):
    customers(landing, "a.csv", [1, 2])
    (landing / "Customer/skip.txt").write_text(HEADER + line(99))
    first = load(spark, landing, layout)
    assert (first.batches, first.files, first.loaded, first.rejected) == (1, 1, 2, 0)
    assert load(spark, landing, layout).batches == 0
    customers(landing, "b.csv", [2, 3])
    customers(landing, "a.csv", [7, 8, 9])  # same name, new content: not read again
    assert load(spark, landing, layout).loaded == 2
    assert sorted(r.customer_id for r in raw(spark, layout).collect()) == [1, 2, 2, 3]


def test_old_file_that_arrives_late_is_loaded(spark, landing, layout):
    customers(landing, "new.csv", [1])
    load(spark, landing, layout)
    customers(landing, "old.csv", [2])
    past = time.time() - 30 * 86400
    os.utime(landing / "Customer/old.csv", (past, past))
    assert load(spark, landing, layout).loaded == 1


def test_bad_rows_are_recorded_with_file_row_and_reason(spark, landing, layout):
    (landing / "Customer/a.csv").write_text(HEADER + line(1) + line("x") + line(3, age="old") + "5,short\n" + line(6))
    stats = load(spark, landing, layout)
    assert (stats.loaded, stats.rejected) == (3, 2)
    bad = loads.read_rejects(spark, files.CUSTOMERS, layout)
    got = {r.source_file_row_number: (r.source_file_name, r.errors[0].column, r.errors[0].value) for r in bad.collect()}
    assert {n: v[1:] for n, v in got.items()} == {2: ("customer_id", "x"), 3: ("age", "old")}
    assert all(v[0].endswith("/Customer/a.csv") for v in got.values())
    good = {r.customer_id: r.source_file_row_number for r in raw(spark, layout).collect()}
    assert good == {1: 1, 5: 4, 6: 5}


def test_file_with_only_bad_rows(spark, landing, layout):
    (landing / "Customer/a.csv").write_text(HEADER + line("x"))
    stats = load(spark, landing, layout)
    assert (stats.loaded, stats.rejected) == (0, 1)
    assert raw(spark, layout).count() == 0
    assert load(spark, landing, layout).batches == 0


def test_row_numbers_follow_file_order_over_many_splits(spark, landing, layout):
    for name in ("big1.csv", "big2.csv"):
        with open(landing / "Customer" / name, "w") as f:
            f.write(HEADER)
            for i in range(20_000):
                f.write(line(i) + ("\n" if i % 1000 == 0 else ""))  # some blank lines
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        scan = files.read_csv(spark, str(landing / "Customer"), files.CUSTOMERS.schema)
        assert scan.rdd.getNumPartitions() > 20
        assert load(spark, landing, layout).loaded == 40_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    wrong = raw(spark, layout).where(F.col("source_file_row_number") != F.col("customer_id") + 1)
    assert wrong.count() == 0
    assert raw(spark, layout).select("source_file_name", "source_file_row_number").distinct().count() == 40_000


def test_json_rows_are_numbered_and_broken_files_rejected(spark, landing, layout):
    items = [{"product_id": i, "name": f"p{i}", "price": 1.5} for i in range(50)]
    (landing / "Product/a.json").write_text(json.dumps(items))
    (landing / "Product/broken.json").write_text('[{"product_id":7},{"product_id":}]')
    stats = loads.load_products(spark, str(landing), layout)
    assert (stats.files, stats.loaded, stats.rejected) == (2, 50, 1)
    got = {r.product_id: r.source_file_row_number for r in raw(spark, layout, files.PRODUCTS).collect()}
    assert got == {i: i + 1 for i in range(50)}
    assert loads.read_rejects(spark, files.PRODUCTS, layout).first().errors[0].reason == "malformed record"


def order_file(path, ids):
    n = len(ids)
    pq.write_table(pa.table({
        "payment_method": ["Card"] * n, "quantity": [1] * n, "transaction_id": [f"T{i}" for i in ids],
        "transaction_date": ["2024-01-15"] * n, "customer_id": [1] * n, "product_id": [2] * n,
        "total_amount": [1.5] * n, "store_type": ["Online"] * n,
    }), path, row_group_size=100)


def test_parquet_rows_are_numbered(spark, landing, layout):
    order_file(landing / "Order/a.parquet", range(1000))
    assert loads.load_orders(spark, str(landing), layout).loaded == 1000
    wrong = raw(spark, layout, files.ORDERS).where(
        F.concat(F.lit("T"), F.col("source_file_row_number") - 1) != F.col("transaction_id"))
    assert wrong.count() == 0


def test_lineage_columns(spark, landing, layout):
    customers(landing, "a.csv", [1])
    load(spark, landing, layout)
    row = raw(spark, layout).first()
    assert row.source_file_name.endswith("/Customer/a.csv")
    assert row.ingestion_timestamp is not None and row.batch_id
    assert raw(spark, layout).schema["ingestion_timestamp"].dataType.simpleString() == "timestamp_ntz"


def test_batches_of_limited_size(spark, landing, layout):
    for i in range(5):
        customers(landing, f"{i}.csv", [i])
    stats = load(spark, landing, layout, files_per_batch=2)
    assert (stats.batches, stats.loaded) == (3, 5)


def test_recreate_starts_over(spark, landing, layout):
    customers(landing, "a.csv", [1, 2])
    load(spark, landing, layout)
    assert load(spark, landing, layout, recreate=True).loaded == 2
    assert raw(spark, layout).count() == 2


@pytest.mark.parametrize("step", ["reset", "remove"])
def test_recreate_that_is_cut_short(spark, landing, layout, monkeypatch, step):
    """Before the new feed is published nothing has changed; after it the old rows are gone, deleted or not."""
    customers(landing, "a.csv", [1, 2])
    load(spark, landing, layout)

    def stop(*args):
        raise InterruptedError

    with monkeypatch.context() as patch:
        patch.setattr(*((Arrivals, "reset") if step == "reset" else (storage, "remove")), stop)
        with pytest.raises(InterruptedError):
            load(spark, landing, layout, recreate=True)
    assert raw(spark, layout).count() == (2 if step == "reset" else 0)
    assert load(spark, landing, layout).loaded == (0 if step == "reset" else 2)
    assert raw(spark, layout).count() == 2
    assert len(storage.names(spark, layout.raw(files.CUSTOMERS.table))) == 1


def test_gz_with_matching_pattern_name(spark, landing, layout):
    with gzip.open(landing / "Customer/a.csv.gz", "wt") as f:
        f.write(HEADER + line(1))
    assert load(spark, landing, layout).batches == 0


@pytest.mark.parametrize("step", [1, 2, 3])
def test_crash_while_publishing_then_replay(spark, landing, layout, monkeypatch, step):
    """Stop before the rejects, between rejects and rows, and after both: one copy of each row results."""
    (landing / "Customer/a.csv").write_text(HEADER + line(1) + line("x") + line(3))
    real, calls = loads._publish, []

    def flaky(*args):
        calls.append(args)
        if len(calls) == step:
            raise OSError("lost")
        real(*args)
        if step == 3 and len(calls) == 2:
            raise OSError("lost after publishing")

    monkeypatch.setattr(loads, "_publish", flaky)
    with pytest.raises(Exception, match="lost"):
        load(spark, landing, layout)
    monkeypatch.setattr(loads, "_publish", real)
    load(spark, landing, layout)
    assert load(spark, landing, layout).batches == 0
    assert sorted(r.customer_id for r in raw(spark, layout).collect()) == [1, 3]
    assert loads.read_rejects(spark, files.CUSTOMERS, layout).count() == 1


def test_crash_after_staging_then_replay(spark, landing, layout, monkeypatch):
    customers(landing, "a.csv", [1, 2])

    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(loads.lineage, "number_rows", fail)
    with pytest.raises(Exception, match="lost"):
        load(spark, landing, layout)
    monkeypatch.undo()
    assert load(spark, landing, layout).loaded == 2
    assert raw(spark, layout).count() == 2
    assert storage.names(spark, layout.staging("raw_customer")) == []


def names_of(spark, folder, state, **options):
    """Names handed over by one run, per hand-over."""
    got = []
    Arrivals(spark, str(folder), "*.csv", str(state)).run(
        lambda d: got.append((d.epoch, sorted(os.path.basename(p) for p in d.paths()))), **options)
    return got


def aged(folder, name, seconds):
    (folder / name).write_text(HEADER)
    os.utime(folder / name, (seconds, seconds))


def test_batches_go_by_age_and_name(spark, landing, tmp_path):
    folder = landing / "Customer"
    for name, seconds in [("c.csv", 100), ("a.csv", 300), ("d.csv", 200), ("b.csv", 200), ("e f+%41.csv", 200)]:
        aged(folder, name, seconds)
    got = names_of(spark, folder, tmp_path / "state", files_per_batch=2)
    assert got == [(0, ["b.csv", "c.csv"]), (1, ["d.csv", "e f+%41.csv"]), (2, ["a.csv"])]
    assert names_of(spark, folder, tmp_path / "state") == []


def test_files_that_were_moved_away_stay_known(spark, landing, tmp_path):
    folder = landing / "Customer"
    aged(folder, "a.csv", 100)
    assert names_of(spark, folder, tmp_path / "state") == [(0, ["a.csv"])]
    os.rename(folder / "a.csv", tmp_path / "a.csv")
    assert names_of(spark, folder, tmp_path / "state") == []
    os.rename(tmp_path / "a.csv", folder / "a.csv")
    aged(folder, "b.csv", 50)
    assert names_of(spark, folder, tmp_path / "state") == [(1, ["b.csv"])]


def test_failed_batch_comes_again_as_it_was(spark, landing, tmp_path):
    folder = landing / "Customer"
    aged(folder, "a.csv", 100)
    position = Arrivals(spark, str(folder), "*.csv", str(tmp_path / "state"))

    def fail(delivery):
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        position.run(fail)
    aged(folder, "b.csv", 50)
    assert names_of(spark, folder, tmp_path / "state") == [(0, ["a.csv"]), (1, ["b.csv"])]


@pytest.mark.parametrize("kind", ["offered", "taken"])
def test_crash_around_the_record_of_a_batch(spark, landing, tmp_path, monkeypatch, kind):
    """Names that were written but not offered are no part of what is seen; a batch not marked as taken is repeated."""
    folder = landing / "Customer"
    aged(folder, "a.csv", 100)
    real = storage.write_text

    def stop(spark, path, text):
        if f"/{kind}/" in path:
            raise OSError("lost")
        real(spark, path, text)

    with monkeypatch.context() as patch:
        patch.setattr(storage, "write_text", stop)
        with pytest.raises(OSError, match="lost"):
            names_of(spark, folder, tmp_path / "state")
    aged(folder, "b.csv", 200)
    got = names_of(spark, folder, tmp_path / "state")
    assert got == ([(0, ["a.csv", "b.csv"])] if kind == "offered" else [(0, ["a.csv"]), (1, ["b.csv"])])
    assert names_of(spark, folder, tmp_path / "state") == []


def test_names_of_many_batches_are_folded(spark, landing, tmp_path, monkeypatch):
    monkeypatch.setattr(arrivals, "FOLD_AFTER", 2)
    folder, state = landing / "Customer", tmp_path / "state"
    for i in range(7):
        aged(folder, f"{i}.csv", 100 + i)
        assert names_of(spark, folder, state) == [(i, [f"{i}.csv"])]
    assert names_of(spark, folder, state) == []
    [generation] = storage.names(spark, str(state))
    assert len(storage.names(spark, f"{state}/{generation}/names")) <= 3
    assert len(storage.names(spark, f"{state}/{generation}/offered")) <= 2
    assert storage.names(spark, f"{state}/{generation}/arrived") == []


@pytest.mark.parametrize("crash", [False, True])
def test_position_of_a_file_stream_goes_on(spark, landing, tmp_path, crash):
    folder, position = landing / "Customer", Arrivals(spark, str(landing / "Customer"), "*.csv", str(tmp_path / "state"))

    def stream(handle):
        (
            spark.readStream.format("binaryFile").schema(files.FILE_INFO).options(pathGlobFilter="*.csv", recursiveFileLookup=True)
            .load(str(folder)).select("path").writeStream.option("checkpointLocation", f"{position.generation()}/checkpoint")
            .trigger(availableNow=True).foreachBatch(handle).start().awaitTermination()
        )

    def fail(names, epoch):
        raise OSError("lost")

    for i, name in enumerate(["a.csv", "b c+%41.csv"]):
        aged(folder, name, 100 + i)
        stream(lambda names, epoch: names.count())
    if crash:
        aged(folder, "c.csv", 300)
        with pytest.raises(Exception, match="lost"):
            stream(fail)
    aged(folder, "d.csv", 10)
    got = names_of(spark, folder, tmp_path / "state")
    assert got == ([(2, ["c.csv"]), (3, ["d.csv"])] if crash else [(2, ["d.csv"])])
    assert names_of(spark, folder, tmp_path / "state") == []
