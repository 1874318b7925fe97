import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stratum.llm import simhash
from tests.llm.helpers import DOCS, documents, lower, spaced


def plain_fingerprint(text, size=4):
    words = spaced(lower(text))
    parts = [words[i : i + size] for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(p).encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, max_bits=4):
    """Of each row the fingerprint, the number of its component, and the component's smallest doc_id."""
    prints = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                parent[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(i)] = min(ids.get(find(i), doc), doc)
    return [(f"{prints[i]:016x}", find(i), ids.get(find(i))) for i in range(len(rows))]


def plain_classes(rows, max_bits=4):
    return [(doc, fp, c) for (doc, _), (fp, _, c) in zip(rows, plain_components(rows, max_bits))]


def order(rows):
    return sorted(map(tuple, rows), key=str)


def texts(seed=5):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(200)]
    rows = []
    for i in range(60):
        words = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 4, 30, 250]))
        rows.append((len(rows), " ".join(words)))
        for _ in range(rng.choice([0, 0, 1, 4])):
            near = list(words)
            near[rng.randrange(len(near))] = rng.choice(vocabulary)
            rows.append((len(rows), "\n ".join(near).upper()))
    return rows


def test_against_every_pair(spark):
    rows = texts() + [(900, None), (901, ""), (902, " \t\n"), (None, "a b c d e"), (None, "A b C d e"), (3, "q w e r t")]
    rows += [rows[0], rows[0], (903, "long " * 40_000)]
    got = simhash.near_duplicates(documents(spark, rows)).select("doc_id", "fingerprint", "component_id").collect()
    assert order(got) == order(plain_classes(rows))
    assert len({r.component_id for r in got}) < len(rows) - 10


def test_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert order(got) == order(plain_classes(rows))


@pytest.mark.parametrize("bits", [0, 1, 3, 4])
def test_no_link_is_lost(spark, bits):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    prints = [base]
    for _ in range(5):
        flip = np.zeros(len(base), np.uint64)
        for k in range(len(base)):
            for b in rng.choice(64, rng.integers(1, 7), replace=False):
                flip[k] ^= np.uint64(1) << np.uint64(b)
        prints.append(base ^ flip)
    prints = np.unique(np.concatenate(prints))
    signed = np.sort(prints.view(np.int64))
    apart = np.bitwise_count(signed.view(np.uint64)[:, None] ^ signed.view(np.uint64)[None, :])
    a, b = np.nonzero(np.triu(apart <= bits, 1))
    frame = spark.createDataFrame([(int(x),) for x in signed], "fp long")
    got = {tuple(r) for r in simhash.links(frame, bits).collect()}
    assert got == set(zip(signed[a].tolist(), signed[b].tolist()))


def test_more_bits_than_the_keys_cover(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "fp long"), 5)


def test_code_is_perfect():
    words = np.arange(1 << 23)
    index = simhash.Golay.decode(words)
    assert np.bincount(index).tolist() == [2048] * 4096


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.keep_one(empty).columns == empty.columns


def test_one_of_each_class_stays(spark):
    rows = texts() + [(None, "a b c d e"), (500, None), (501, ""), (None, "z y x w v u")]
    rows += [rows[0], rows[0]]
    docs = documents(spark, rows, fp=F.lit("x"), k=F.lit(1), root=F.lit(2.5))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    # Components without any doc_id are several, though they share the null component_id.
    classes = dict((number, c) for _, number, c in plain_components(rows))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(classes.values(), key=str)


def test_clashing_columns(spark):
    docs = documents(spark, [(1, "a b c d e"), (2, "A B c d e")], fp=F.lit(1), fingerprint=F.lit("x"), component_id=F.lit(9))
    assert {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()} == {(1, 1), (2, 1)}
