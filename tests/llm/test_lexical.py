import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import lexical
from tests.llm.helpers import DOCS, documents, letters_digits

ITEMS = "item_id long, text string"


def plain(rows, items, k=10):
    """Every item against every document."""
    docs = [(i, Counter(letters_digits(t))) for i, t in rows]
    docs = [(i, c, c.total()) for i, c in docs if c]
    n_docs, n_words = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in docs:
            m = 25 + 75 * n * n_docs // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in letters_digits(text) if t in c)
            if score:
                found.append((-score, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def got(docs, items, **how):
    return sorted((tuple(r) for r in lexical.search(docs, items, **how).collect()), key=str)


def case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(150)] + ["É", "9", "été", "X"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    draw = lambda n: " ".join(rng.choices(vocabulary, weights, k=n))
    rows = [(i, draw(rng.choice([0, 1, 5, 40, 300]))) for i in range(300)]
    items = [(i, draw(rng.choice([1, 3, 20, 60]))) for i in range(30)]
    rows += [(i, rows[7][1]) for i in range(1000, 1040)] + [rows[3], rows[3], (None, draw(30)), (None, rows[7][1]), (2000, None), (2001, " ?! ")]
    rows += [(3000 + i, f"{draw(5)}; {items[i][1].upper()}") for i in range(10)]
    items += [items[2], (77, None), (78, ""), (79, "nowhere at-all"), (None, draw(12)), (80, rows[7][1])]
    return rows, items


@pytest.mark.parametrize("seed,block", [(1, 1 << 20), (2, 1 << 20), (3, 300)])
def test_against_every_pair(spark, seed, block):
    rows, items = case(seed)
    found = got(documents(spark, rows).repartition(3), spark.createDataFrame(items, ITEMS), block_bytes=block)
    assert found == plain(rows, items)


@pytest.mark.parametrize("k", [1, 3, 1000])
def test_any_number_and_small_trees(spark, k, monkeypatch):
    rows, items = case(4)
    monkeypatch.setattr(lexical, "TREE_DOCUMENTS", 50)
    assert got(documents(spark, rows), spark.createDataFrame(items, ITEMS), k=k) == plain(rows, items, k)


def test_empty_tables_and_clashing_columns(spark):
    rows, items = [(1, "a b"), (2, "b c")], [(5, "b c d")]
    docs = documents(spark, rows, item_id=F.lit(3), rank=F.lit("r"), n=F.lit(0), terms=F.lit("t"), score=F.lit(1.5))
    some = spark.createDataFrame(items, ITEMS).withColumn("doc_id", F.lit(9)).withColumn("item", F.lit("x"))
    assert got(docs, some) == plain(rows, items)
    assert got(spark.createDataFrame([], DOCS), some) == []
    assert got(docs, spark.createDataFrame([], ITEMS)) == []
    assert got(documents(spark, [(1, None)]), some) == []


def test_one_very_long_text(spark):
    rows = [(1, "a b c " * 200_000), (2, "a"), (3, "c d")]
    items = [(1, "a " * 50_000), (2, "d c")]
    assert got(documents(spark, rows), spark.createDataFrame(items, ITEMS)) == plain(rows, items)


def test_whole_batches_are_left_out():
    """Bounds of node pairs decide most pairs of items and documents, and lose none."""
    rng = np.random.default_rng(0)
    n, terms = 4000, 500
    pick = [np.unique(rng.integers(0, 40, 12) + 40 * (i % 12)) for i in range(n)]
    rows = lexical.Vectors(np.cumsum([0] + [len(p) for p in pick]), np.concatenate(pick), rng.integers(1, 10**6, sum(map(len, pick))))
    items = [np.sort(rng.choice(40, 10, replace=False)) + 40 * (i % 12) for i in range(48)]
    counts = lexical.Vectors(np.arange(49) * 10, np.concatenate(items), rng.integers(1, 3, 480))
    search = lexical.Search(lexical.Items(list(range(48)), np.arange(terms, dtype=np.uint64), counts), 10)
    search.run(rows, np.arange(n))
    dense = np.zeros((n, terms), np.int64)
    dense[np.repeat(np.arange(n), np.diff(rows.first)), rows.terms] = rows.values
    for i in range(48):
        weights = np.zeros(terms, np.int64)
        weights[items[i]] = counts.values[10 * i : 10 * i + 10]
        scores = dense @ weights
        order = np.lexsort((np.arange(n), -scores))[:10]
        assert search.best.scores[i].tolist() == scores[order].tolist() and search.best.ids[i].tolist() == order.tolist()
    assert search.pairs < 0.5 * 48 * n
