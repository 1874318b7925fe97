import random

import pytest
from pyspark.sql import functions as F

from stratum.llm import substring
from tests.llm.helpers import DOCS, documents, spaced


def plain(rows, length):
    """Words that stay, and how many go, with a count of every window."""
    split = [spaced(t) for _, t in rows]
    count = {}
    for words in split:
        for i in range(len(words) - length + 1):
            key = tuple(words[i : i + length])
            count[key] = count.get(key, 0) + 1
    out = []
    for (doc, _), words in zip(rows, split):
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            if count[tuple(words[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        out.append((doc, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=str)


def got(df, length, **kw):
    found = substring.dedup_substrings(df, length, joined=True, **kw)
    return found.select(F.col("row.doc_id"), "n_words", "n_removed", "kept").collect()


def corpus(seed, length):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "W1", "the"]
    passages = [rng.choices(vocabulary, k=rng.randint(length - 2, 3 * length)) for _ in range(6)]
    rows = []
    for i in range(70):
        words = rng.choices(vocabulary, k=rng.choice([0, 3, length - 1, length, 90, 300]))
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(passages)
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
    rows += [(100 + i, rows[i][1]) for i in range(5)]
    rows += [(200, "a " * 200), (201, "x y z " * 60), (202, None), (203, ""), (None, rows[7][1]), (204, " \n ")]
    return rows + [rows[3], rows[69]]


@pytest.mark.parametrize("length", [4, 12, 35])
def test_against_counted_windows(spark, length):
    rows = corpus(length, length)
    assert order(got(documents(spark, rows), length)) == order(plain(rows, length))


def test_hot_anchors_go_window_by_window(spark):
    rng = random.Random(1)
    passage = [f"p{i}" for i in range(20)]
    rows = []
    for i in range(60):
        words = [f"u{rng.randrange(30)}" for _ in range(20)]
        rows.append((i, " ".join(words[:10] + passage + words[10:])))
    expected = order(plain(rows, 12))
    for hot in (0, 3, 1000):
        assert order(got(documents(spark, rows), 12, hot_segments=hot)) == expected
    assert sum(r[2] for r in expected) > 1000


def test_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    expected = order(plain(rows, 35))
    assert order(got(docs, 35)) == expected
    assert sum(r[2] > 0 for r in expected) > 3


def test_only_what_recurs_changes(spark):
    unique, shared = " ".join(f"a{i}" for i in range(50)), " ".join(f"s{i}" for i in range(40))
    rows = [(1, f"  {unique}\n\n tail "), (2, f"head\t {shared}\n  rest x "), (3, f"{shared} other"), (4, f"\n{shared}"), (5, None)]
    docs = documents(spark, rows, n_removed=F.lit(7), c1=F.lit("c"), key=F.lit(3), marks=F.lit("m"))
    kept = substring.shortened(docs)
    assert kept.columns == docs.columns
    found = {r.doc_id: r for r in kept.collect()}
    assert found[1].text == rows[0][1] and found[5].text is None and found[5].n_chars is None
    assert found[2].text == "head\t rest x " and found[3].text == "other" and found[4].text == "\n"
    assert found[2].n_chars == 13 and (found[2].n_removed, found[2].c1, found[2].key, found[2].marks) == (7, "c", 3, "m")


def test_empty_table_and_very_long_text(spark):
    assert substring.dedup_substrings(spark.createDataFrame([], DOCS)).collect() == []
    long = " ".join(str(i) for i in range(150_000))
    rows = [(1, long), (2, "x " * 50_000), (3, long + " y")]
    assert [r[:3] for r in order(got(documents(spark, rows), 35))] == [(1, 150_000, 150_000), (2, 50_000, 50_000), (3, 150_001, 150_000)]


def test_automaton_counts_every_substring():
    rng = random.Random(9)
    for _ in range(60):
        sequences = [[rng.randrange(3) for _ in range(rng.randint(1, 12))] for _ in range(rng.randint(1, 6))]
        weights = [rng.randint(1, 2) for _ in sequences]
        automaton = substring.SuffixAutomaton()
        for sequence, weight in zip(sequences, weights):
            automaton.add(sequence, weight)
        automaton.count()
        for length in (1, 2, 3, 5):
            for sequence in sequences:
                expected = 0
                for i in range(len(sequence) - length + 1):
                    part = sequence[i : i + length]
                    places = sum(w * sum(s[j : j + length] == part for j in range(len(s) - length + 1)) for s, w in zip(sequences, weights))
                    expected |= (places > 1) << i
                assert automaton.repeated(sequence, length) == expected
