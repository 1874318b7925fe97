import random

import pytest
from pyspark.sql import functions as F

from stratum.operators import upsert as merging
from tests.conftest import rows


def frame(spark, data):
    return spark.createDataFrame(data, "k long, a string, b int")


@pytest.mark.parametrize("seed", range(6))
def test_equals_sql_merge(spark, duck, seed):
    """Random tables: NULL and repeated keys in the target, NULL keys in the source."""
    rnd = random.Random(seed)

    def value():
        return rnd.choice(["x", "y", None]), rnd.choice([1, 2, None])

    target = [(rnd.choice([None, *range(12)]), *value()) for _ in range(rnd.randint(0, 30))]
    keys = rnd.sample(range(20), rnd.randint(0, 12))
    source = [(k, *value()) for k in [*keys, *[None] * rnd.randint(0, 3)]]
    got = merging.upsert(frame(spark, target), frame(spark, source), "k")

    for name, data in (("t", target), ("s", source)):
        duck.execute(f"CREATE TABLE {name} (k BIGINT, a VARCHAR, b INTEGER)")
        if data:
            duck.executemany(f"INSERT INTO {name} VALUES (?, ?, ?)", data)
    matched = duck.execute("SELECT count(*) FROM t SEMI JOIN s USING (k)").fetchone()[0]
    fresh = duck.execute("SELECT count(*) FROM s ANTI JOIN t USING (k)").fetchone()[0]
    duck.execute("""MERGE INTO t USING s ON t.k = s.k
        WHEN MATCHED THEN UPDATE SET a = s.a, b = s.b
        WHEN NOT MATCHED THEN INSERT VALUES (s.k, s.a, s.b)""")
    expected = sorted(duck.execute("SELECT * FROM t").fetchall(), key=lambda r: [(v is not None, str(v)) for v in r])
    assert rows(got) == expected
    stats = merging.upsert_stats(frame(spark, target), frame(spark, source), "k").first()
    assert tuple(stats) == (fresh, matched)


def test_several_source_rows_for_one_target_row_fail(spark):
    target, source = frame(spark, [(1, "a", 1)]), frame(spark, [(1, "b", 2), (1, "c", 3)])
    with pytest.raises(Exception, match="several incoming rows match key 1"):
        merging.upsert(target, source, "k").collect()


def test_repeated_new_keys_are_all_inserted(spark):
    target, source = frame(spark, [(1, "a", 1)]), frame(spark, [(2, "b", 2), (2, "c", 3)])
    assert rows(merging.upsert(target, source, "k")) == [(1, "a", 1), (2, "b", 2), (2, "c", 3)]


def test_latest_wins(spark):
    target = frame(spark, [(1, "a", 1), (5, "e", 5)])
    source = frame(spark, [(1, "b", 2), (1, None, 9), (1, "c", 3), (2, "d", 4), (None, "n", 1), (None, "n", 2)])
    got = merging.upsert(target, source, "k", "latest", ["b"])
    assert rows(got) == [(None, "n", 1), (None, "n", 2), (1, None, 9), (2, "d", 4), (5, "e", 5)]


def test_latest_needs_an_order(spark):
    target = frame(spark, [])
    with pytest.raises(ValueError):
        merging.upsert(target, target, "k", "latest")
    with pytest.raises(ValueError):
        merging.upsert(target, target, "k", "whatever")


def test_latest_aggregates_before_the_shuffle(spark):
    """A hot key is a few rows per task before anything moves."""
    source = spark.range(1000).select(F.lit(1).cast("long").alias("k"), F.lit("x").alias("a"), F.col("id").cast("int").alias("b"))
    plan = merging.latest_per_key(source, "k", ["b"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    assert rows(merging.latest_per_key(source, "k", ["b"])) == [(1, "x", 999)]


def test_no_full_outer_or_nested_loop_join(spark, tmp_path):
    frame(spark, [(1, "a", 1)]).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    plan = merging.upsert(target, frame(spark, [(1, "b", 2)]), "k")._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert "ReadSchema: struct<k:bigint>" in plan  # the search for matches reads the key alone


def test_incoming_rows_are_not_grouped_whole(spark, tmp_path):
    """Only keys are aggregated, by hash; whole rows go through joins alone, and one shuffle by key serves both uses."""
    frame(spark, [(1, "a", 1)]).write.parquet(str(tmp_path / "t"))
    frame(spark, [(1, "b", 2)]).write.parquet(str(tmp_path / "s"))
    target, source = (spark.read.parquet(str(tmp_path / n)) for n in "ts")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merging.upsert(target, source, "k")
        merged.collect()
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert "Reused" in plan
