import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import forest, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(rows, queries, k):
    """All candidates of each query, best first."""
    out = {}
    for q, x in queries:
        scores = [(-float(np.dot(np.array(x, "f8"), np.array(y, "f8"))), i) for i, y in rows if i != q]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def by_query(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(found, expected):
    return np.mean([len({i for i, _ in found.get(q, [])} & {i for i, _ in e}) / len(e) for q, e in expected.items()])


def test_recall_on_given_tables(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found = by_query(queries.op7_random_projection_forest(spark, sf))
    expected = exact(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert set(found) == set(expected) and all(len(v) == 20 for v in found.values())
    assert recall(found, expected) >= 0.95
    vectors = dict(rows)
    for q, near in found.items():
        assert near == sorted(near, key=lambda p: (-p[1], p[0]))
        for i, score in near:
            assert score == pytest.approx(float(np.dot(np.array(vectors[q], "f8"), np.array(vectors[i], "f8"))), abs=1e-12)


def odd_rows():
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype("f4").tolist(), i) for i in range(300)]
    rows += [(300 + i, rows[7][1], 0) for i in range(40)]  # one vector with many ids
    rows += [(400, None, 0), (420, [0.0] * 8, 0), (440, [float("nan")] + [1.0] * 7, 0), (460, [None] + [1.0] * 7, 0),
             (480, [float("inf")] + [1.0] * 7, 0), (500, [1.0] * 3, 0), (None, [1.0] * 8, 0), (520, [], 0)]
    return rows + [rows[0], rows[20], rows[20]]


def test_all_leaves_give_the_exact_answer(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("query", F.lit(1)).withColumn("score", F.lit("s"))
    good = sorted({(i, tuple(v)) for i, v, _ in rows if i is not None and i < 400})
    expected = exact(good, [r for r in good if r[0] % 20 == 0], 5)
    for options in ({"leaf": 8, "share": 100.0}, {"leaf": 8, "share": 100.0, "vectors_per_task": 50, "queries_per_task": 3}, {"leaf": 1000}):
        found = by_query(forest.search(df, F.col("vec_id") % 20 == 0, 5, trees=3, **options))
        assert {q: [i for i, _ in v] for q, v in found.items()} == {q: [i for i, _ in v] for q, v in expected.items()}


def test_fewer_rows_than_asked_for(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [0.5, 0.5], 1)], SCHEMA)
    assert by_query(forest.search(df, F.col("vec_id") == 0, 20)) == {0: [(1, 0.5), (2, 0.5)]}
    alone = spark.createDataFrame([(0, [1.0, 0.0], 1)], SCHEMA)
    assert forest.search(alone, F.col("vec_id") == 0, 20).collect() == []
    assert forest.search(df.limit(0), F.col("vec_id") == 0, 20).collect() == []
    assert forest.search(df, F.col("vec_id") == 99, 20).collect() == []


def test_sampled_trees_index_every_row(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] + 0.1 * rng.normal(size=16)).astype("f4").tolist(), 0) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = by_query(forest.search(df, F.col("vec_id") % 100 == 0, 10, sample=400, leaf=16, share=0.6))
    expected = exact([r[:2] for r in rows], [r[:2] for r in rows if r[0] % 100 == 0], 10)
    assert recall(found, expected) >= 0.9
