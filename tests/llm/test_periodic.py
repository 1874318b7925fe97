import hashlib
import random
import zlib

import pyarrow as pa
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.llm import periodic, queries
from tests.llm.helpers import DOCS, documents, spaced


def plain(words, least=12):
    """Every lag at every place; of equal stretches the smallest period. By start and period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def got(texts):
    found = periodic._found(pa.array(texts, pa.string()), 12).to_pylist()
    return [([(r["start"], r["length"], r["period"]) for r in f["runs"]], f["collapsed"], f["n_words"]) for f in found]


def check(texts):
    words = [spaced(t) for t in texts]
    assert got(texts) == [(plain(w), collapsed(w, plain(w)), len(w)) for w in words]


def nested(rng, depth):
    """Repeats of repeats: runs that begin, end and overlap everywhere."""
    if depth == 0:
        return [rng.choice("ab") for _ in range(rng.randint(1, 5))]
    part = nested(rng, depth - 1)
    out = part * rng.randint(1, 9)
    out += part[: rng.randint(0, len(part))]
    return (out + nested(rng, depth - 1) if rng.random() < 0.4 else out)[:500]


@pytest.mark.parametrize("seed", range(4))
def test_repeats_of_repeats(seed):
    rng = random.Random(seed)
    for _ in range(60):
        check([" ".join(nested(rng, rng.randint(1, 4))) for _ in range(4)])


@settings(max_examples=150, deadline=None)
@cases(st.lists(st.text("ab ", max_size=150).map(" ".join), max_size=3))
def test_any_words_of_two_letters(texts):
    check(texts)


def test_known_words():
    fibonacci, other = "a", "ab"
    for _ in range(11):
        fibonacci, other = other, other + fibonacci
    morse = "0"
    for _ in range(9):
        morse += morse.translate({48: "1", 49: "0"})
    side = ["a", "b"] * 30 + ["a"]  # a square whose halves are runs of period two
    check([" ".join(fibonacci), " ".join(morse), " ".join(side * 2), " ".join(side * 2 + ["b"] + side)])


def test_long_periods_and_planted_copies():
    rng = random.Random(5)
    prose = [f"w{rng.randrange(3000)}" for _ in range(3000)]
    for q, at, length in ((1, 10, 40), (31, 200, 70), (32, 500, 64), (333, 800, 700), (12, 2000, 24)):
        prose[at : at + length] = [prose[at + i % q] for i in range(length)]
    check([" ".join(prose), " ".join(prose[:1000] * 2), " ".join(prose[:700] * 3 + prose[:20])])


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "é\x0bé " * 6), (4, "é\x0bé " * 6), (None, "x " * 12), (6, "x " * 11), (7, "long words " * 60_000)]
    docs = documents(spark, rows, runs=F.lit("clash"), n_words=F.lit(-1), row=F.lit(0))
    found = sorted(periodic.collapse_runs(docs).collect(), key=lambda r: (str(r.row.doc_id), r.n_words))
    assert [(r.row.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found] == [
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 12, [(0, 12, 1)], "é"), (4, 12, [(0, 12, 1)], "é"),
        (6, 11, [], " ".join("x" * 11)), (7, 120_000, [(0, 120_000, 2)], "long words"), (None, 12, [(0, 12, 1)], "x")]
    assert found[0].row.runs == "clash" and found[0].row.row == 0
    assert periodic.collapse_runs(spark.createDataFrame([], DOCS)).collect() == []
    with pytest.raises(ValueError):
        periodic.find_runs(periodic.word_names(periodic.Words(*periodic.text_bytes(pa.array(["a"])))), 5)


def made(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, made(r.doc_id, spaced(r.text))) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = []
    for doc_id, words in rows:
        runs = plain(words)
        first = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        expected.append((doc_id, len(runs), *first, 1000 * first[1] // first[2] if runs else None,
                         sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(collapsed(words, runs))))
    found = [tuple(r) for r in queries.op13_periodic_runs(spark, sf).collect()]
    assert sorted(found) == sorted(expected) and sum(r[1] > 0 for r in found) > 10
