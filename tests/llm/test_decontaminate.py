import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import decontaminate
from tests.llm.helpers import DOCS, documents, letters_digits

ITEMS = "item_id long, text string"


def plain(rows, items, window):
    """Every run of words of every text, looked up among all windows."""
    windows = {}
    for item, phrase in items:
        own = letters_digits(phrase)
        for i in range(max(1, len(own) - window + 1) if own else 0):
            windows.setdefault(tuple(own[i : i + window]), set()).add(item)
    out = []
    for doc, text in rows:
        words, hit, ids = letters_digits(text), set(), set()
        for size in {len(w) for w in windows}:
            for j in range(len(words) - size + 1):
                found = windows.get(tuple(words[j : j + size]))
                if found is not None:
                    hit |= set(range(j, j + size))
                    ids |= found - {None}
        out.append((doc, len(words), len(hit), len(ids), tuple(sorted(ids)), bool(hit) and 20 * len(hit) >= len(words)))
    return out


def got(found):
    names = ("n_words", "n_hit", "n_items", "items", "contaminated")
    return [(r[0], *(tuple(v) if isinstance(v, list) else v for v in r[1:])) for r in found.select("row.doc_id", *names).collect()]


def order(rows):
    return sorted(rows, key=str)


def case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "9", "été"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 6, 7, 15, 40])))) for i in range(25)]
    items += [(-1, "minus One"), (50, items[9][1]), (51, None), (52, " -- "), (None, "no id at all here"), items[3]]
    rows = []
    for i in range(50):
        words = rng.choices(vocabulary, k=rng.choice([0, 2, 30, 400]))
        for _ in range(rng.choice([0, 1, 2])):
            phrase = letters_digits(rng.choice(items)[1])
            a = rng.randint(0, len(phrase))
            words[len(words) // 2 : len(words) // 2] = phrase[a:] if rng.random() < 0.5 else phrase
        rows.append((i, rng.choice([" ", "-", ".\n", " ; "]).join(words).upper()))
    rows += [(90, None), (91, ""), (92, "?!"), (None, items[10][1]), (93, "and MINUS-one."), (94, "no id at all here")]
    return rows + [rows[0], rows[1], (95, rows[7][1])], items


@pytest.mark.parametrize("seed,block", [(1, 1 << 20), (2, 1 << 20), (3, 150)])
def test_against_every_place(spark, seed, block):
    rows, items = case(seed)
    found = decontaminate.contamination(documents(spark, rows), spark.createDataFrame(items, ITEMS), 6, block_bytes=block)
    assert order(got(found)) == order(plain(rows, items, 6))


def test_given_tables(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("documents", "benchmark"))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    expected = plain(rows, [tuple(r) for r in bench.select("item_id", "text").collect()], 13)
    assert order(got(decontaminate.contamination(docs, bench))) == order(expected)
    assert any(r[-1] for r in expected)


def test_spans_and_what_stays(spark):
    items = spark.createDataFrame([(1, "a b c"), (2, "c d e")], ITEMS).withColumn("row", F.lit(1))
    rows = [(1, "x A b; c D e y a b c"), (2, "clean"), (3, "a b c " + "z " * 200), (4, None)]
    docs = documents(spark, rows, hits=F.lit("h"), n_hit=F.lit(5))
    found = {r.row.doc_id: r for r in decontaminate.contamination(docs, items, 3).collect()}
    assert [(s.start, s.end) for s in found[1].spans] == [(1, 6), (7, 10)] and found[1].items == [1, 2]
    kept = decontaminate.clean(docs, items, 3)
    assert kept.columns == docs.columns
    assert {(r.doc_id, r.text, r.hits, r.n_hit) for r in kept.collect()} == {(i, t, "h", 5) for i, t in rows if i != 1}


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], ITEMS), spark.createDataFrame([(1, "a b")], ITEMS)
    assert decontaminate.contamination(spark.createDataFrame([], DOCS), items).collect() == []
    assert [r.n_hit for r in decontaminate.contamination(documents(spark, [(1, "a b")]), none).collect()] == [0]


def test_very_long_texts(spark):
    """Two megabytes each: words without a window, and one window over and over with something between."""
    phrase = " ".join(f"q{i}" for i in range(13))
    filler = " ".join(f"w{i % 977}" for i in range(300_000))
    rows = [(1, f"{filler} {phrase} {filler} {phrase}"), (2, f"{phrase} x " * 40_000), (3, "a" * 2_000_000), (4, "a " * 1_000_000), (5, phrase)]
    items = [(7, phrase), (8, "a a a")]
    found = {r.row.doc_id: r for r in decontaminate.contamination(documents(spark, rows), spark.createDataFrame(items, ITEMS)).collect()}
    assert {i: (r.n_words, r.n_hit, list(r.items), r.contaminated) for i, r in found.items()} == {
        1: (600_026, 26, [7], False), 2: (560_000, 520_000, [7], True), 3: (1, 0, [], False),
        4: (1_000_000, 1_000_000, [8], True), 5: (13, 13, [7], True)}


def test_suffixes_are_in_order():
    rng = np.random.default_rng(0)
    for _ in range(30):
        symbols = np.append(rng.integers(1, rng.integers(2, 6), rng.integers(1, 200)), 0)
        text = symbols.tolist()
        assert decontaminate.suffix_array(symbols).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_ranks_and_symbols():
    values = np.random.default_rng(1).integers(0, 37, 500)
    matrix = decontaminate.WaveletMatrix(values, 36)
    wanted, ends = np.arange(200) % 37, np.random.default_rng(2).integers(0, 501, 200)
    assert matrix.rank(wanted, ends).tolist() == [int((values[:e] == v).sum()) for v, e in zip(wanted, ends)]
    assert matrix.access(np.arange(500)).tolist() == values.tolist()
