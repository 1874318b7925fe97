import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.llm import packing
from tests.llm.helpers import DOCS, documents


@pytest.fixture(scope="module")
def tokenizer():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, found, tokenizer, length=2048):
    """Every document is there whole, in pieces as asked for, and sequences are filled without gaps."""
    expected = []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % length or length
        for k, a in enumerate([0, *range(first, len(ids), length)]):
            part = ids[a : first if k == 0 else a + length]
            expected.append((doc, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found), key=str) == sorted(expected, key=str)
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for inside in places.values():
        at = 0
        for offset, size in sorted(inside):
            assert offset == at
            at += size
        assert at <= length
    return len(places), math.ceil(sum(r.length for r in found) / length)


def test_given_tables(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    used, least = check(rows, packing.packed(docs, with_ids=False).collect(), tokenizer)
    assert used <= least + 2


def test_odd_documents(spark, tokenizer):
    rows = [(1, None), (2, ""), (3, "a <|endoftext|> b"), (None, "x"), (4, "é世😀 \n\t  it's 12"), (5, "word " * 9000), (6, "y " * 2047)]
    rows += [(4, "é世😀 \n\t  it's 12")] * 2
    docs = documents(spark, rows, length=F.lit("l"), shard=F.lit(1), order=F.lit(2), ids=F.lit(3))
    found = packing.packed(docs)
    kept = found.collect()
    check(rows, kept, tokenizer)
    assert all(len(r.ids) == 4 * r.length for r in kept)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200) | st.text(alphabet="ab' \n1é<|endoftext|>", max_size=80))
def test_ids_are_those_of_the_other_library(tokenizer, text):
    text = text.encode("utf-8", "ignore").decode()
    assert packing.byte_bpe()()(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_empty_table(spark):
    found = packing.packed(spark.createDataFrame([], DOCS))
    assert found.collect() == [] and found.columns[-2:] == ["sequence_id", "offset"]


def test_rule_takes_the_smallest_sum_of_squares():
    rng = random.Random(2)
    rule, gaps = packing.SumOfSquares(12), {}
    for _ in range(400):
        size = rng.randint(1, 12)

        def after(gap):
            count = list(gaps.values())
            if gap != 12:
                count.remove(gap)
            count.append(gap - size)
            return sum(count.count(g) ** 2 for g in range(1, 12))

        options = {after(g) for g in {12, *gaps.values()} if g >= size}
        number, offset = rule.place(size)
        assert 12 - offset == gaps.get(number, 12) and after(12 - offset) == min(options)
        gaps[number] = 12 - offset - size


def test_no_piece_gets_lost_in_the_second_round():
    rng = np.random.default_rng(4)
    for n in (0, 1, 7, 300):
        sizes = rng.integers(1, 65, n)
        number, offset = packing.pack_pieces(sizes, 64)
        assert len(set(zip(number.tolist(), offset.tolist()))) == n
        for sequence in set(number.tolist()):
            rows = np.flatnonzero(number == sequence)
            rows = rows[np.argsort(offset[rows])]
            assert offset[rows].tolist() == [0, *np.cumsum(sizes[rows])[:-1]] and sizes[rows].sum() <= 64


def test_many_shards_waste_little(spark):
    rng = random.Random(3)
    rows = [(i, 0, 0, rng.choice([rng.randint(1, 400), rng.randint(1, 2048)])) for i in range(20_000)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long")
    found = packing.pack(pieces, 4).collect()
    assert len({r.sequence_id for r in found}) <= sum(r[3] for r in rows) / 2048 + 8
