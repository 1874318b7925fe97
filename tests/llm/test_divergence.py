import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratum.llm import divergence
from tests.llm.helpers import DOCS, spaced


def base(text):
    words = spaced(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if spaced(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit),
            len(words) < 10 or 100 * len(hit) > 20 * len(words))


def classes(text):
    kinds = [lambda c: "a" <= c <= "z", lambda c: "A" <= c <= "Z", lambda c: "0" <= c <= "9", lambda c: c in " \t\n\x0b\f\r",
             lambda c: c in "#*$%&|<>", lambda c: c in ".,;:!?'\"()-", lambda c: c > "\x7f"]
    out = [sum(map(k, text)) for k in kinds]
    return [*out, len(text) - sum(out)]


def jsd(counts, shares):
    n = sum(counts)
    part = lambda x, m: x * math.log2(x / m) if x else 0
    return math.sqrt(max(0, sum(part(c / n, (c / n + q) / 2) + part(q, (c / n + q) / 2) for c, q in zip(counts, shares)) / 2))


def plain(rows):
    """(doc_id, lang, text) to (doc_id, base..., class distance, word distance)."""
    known = {}
    for lang in {r[1] for r in rows if r[1] is not None}:
        texts = [r[2] or "" for r in rows if r[1] == lang]
        words = Counter(w for t in texts for w in spaced(t))
        if words.total() < divergence.MIN_REFERENCE:
            continue
        beyond = sorted(words.values(), reverse=True)[divergence.COMMON :][:1] or [0]
        top = [w for w in words if words[w] > beyond[0]]
        shares = [words[w] / words.total() for w in top]
        sums = [sum(x) for x in zip(*map(classes, texts))]
        known[lang] = top, [*shares, 1 - sum(shares)], [x / sum(sums) for x in sums]
    out = []
    for doc, lang, text in rows:
        against = [known[lang]] if lang in known else list(known.values())
        words, text = spaced(text), text or ""
        one = two = None
        if against and len(text) >= divergence.MIN_CHARS:
            one = min(jsd(classes(text), c) for *_, c in against)
        if against and len(words) >= divergence.MIN_COMMON:
            counts = lambda top: [*(n := [words.count(w) for w in top]), len(words) - sum(n)]
            two = min(jsd(counts(top), shares) for top, shares, _ in against)
        out.append((doc, *base(text), one, two))
    return out


def corpus(seed):
    rng = random.Random(seed)
    own = {"en": ["the", "of", "and", "to", "a"], "fr": ["le", "la", "de", "é", "et"], "xx": ["zu"]}
    rows = []
    for i in range(120):
        lang = rng.choice(["en", "en", "fr", "xx", None] if i % 20 == 0 else ["en", "en", "fr"])
        vocabulary = own[lang or "en"] * 20 + [f"{lang}{k}" for k in range(200)]
        words = rng.choices(vocabulary, k=rng.choice([3, 12, 45, 60, 300]))
        if rng.random() < 0.2:
            words = [w + rng.choice(["###", "$$$", "|"]) for w in words]
        if rng.random() < 0.2:
            words += words[:20] * 2
        text = "".join(w + rng.choice([" ", " ", "\n", "\t\x0b"]) for w in words)
        rows.append((i, lang, text + rng.choice(["", "\na line\n\na line \na line"])))
    rows += [(200, "en", None), (201, "en", ""), (202, None, None), (203, "yy", "Ünknown tongue " * 30), rows[5], rows[5],
             (None, "fr", rows[8][2]), (204, "en", "the of 42 " * 60_000), (205, "en", "THE OF AND " * 40), (206, "fr", "a b c d e a b c d e")]
    return rows


def table(spark, rows, **extra):
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    for name, value in extra.items():
        df = df.withColumn(name, value)
    return df


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_counts(spark, seed):
    rows = corpus(seed)
    found = divergence.divergence(table(spark, rows).repartition(4)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    key = lambda r: str(r[:7])
    exact = sorted(((r.row.doc_id, *(r[n] for n in names), r.class_distance, r.word_distance) for r in found), key=key)
    expected = sorted(plain(rows), key=key)
    assert [r[:7] for r in exact] == [r[:7] for r in expected]
    for mine, theirs in zip(exact, expected):
        assert mine[7:] == pytest.approx(theirs[7:], abs=1e-9)
    for r in found:
        far = (r.class_distance or 0) > divergence.MAX_CLASS_DISTANCE or (r.word_distance or 0) > divergence.MAX_WORD_DISTANCE
        assert r.kept == (not r.base_failed and not far)
    assert 0 < sum(r.kept for r in found) < len(found)


def test_junk_goes_and_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    found = divergence.divergence(spark.read.parquet(f"{sf}/documents.parquet")).select("row.doc_id", "base_failed", "kept")
    labels = spark.read.parquet(f"{sf}/labels.parquet").join(found, "doc_id").where("not base_failed")
    kept = {r.quality: r.share for r in labels.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1] > 0.98 and kept[0] < 0.2


def test_clashing_columns_and_empty_tables(spark):
    rows = corpus(3)[:40]
    names = ["hashes", "bare", "classes", "own", "row", "known", "n_words", "kept", "c0", "lower", "every"]
    found = divergence.divergence(table(spark, rows, **{n: F.lit(n) for n in names}))
    assert found.count() == len(rows)
    first = found.first().row
    assert all(first[n] == n for n in names)
    assert divergence.divergence(spark.createDataFrame([], DOCS)).collect() == []


def test_no_reference_no_verdict(spark):
    found = divergence.divergence(table(spark, [(1, "en", "a b c d e f g h i j " + "k l m " * 3 + "###" * 100)])).first()
    assert (found.class_distance, found.word_distance, found.base_failed) == (None, None, True)


def test_no_python_in_the_plan(spark):
    df = divergence.divergence(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_common_words_that_share_a_slot(spark):
    """Hashes of either sign; common words of one slot, and other words that fall into the slots of common ones."""
    common = [5, 5 + divergence.SLOTS, -3, 7]
    own = [5, 5, 5 + divergence.SLOTS, -3, -3 - divergence.SLOTS, 7 + 8 * divergence.SLOTS, 100, -(1 << 63), 5]
    rows = spark.createDataFrame([(own, common), ([], common), (own, [])], "own array<long>, common array<long>")
    taken = divergence._taken(F.col("common"))
    got = rows.select(divergence._word_counts(F.col("own"), F.col("common"), taken).alias("n"), F.size(F.filter(taken, lambda t: t)).alias("slots"))
    assert [tuple(r) for r in got.collect()] == [([3, 1, 1, 0, 4], 3), ([0, 0, 0, 0, 0], 3), ([len(own)], 0)]
