"""Ranked search of items in documents with two trees, one over the items and one over the documents.

A document is a vector with a coordinate for each term of any item: the term's weight times how much its occurrences
count in a document of that length. An item is a vector of how often it holds each term. The score is their inner product.

Each node of a tree holds the largest value of every coordinate below it. For a node of items and a node of documents the
inner product of these maxima bounds every score between them, so the pair goes, with all it stands for, if it cannot beat
the weakest ``k``-th score any of the items has so far. What is left of a pair is split on both sides, and items meet
their last documents in order of bounds, best first. No score is estimated: the result is exact.

Items come in blocks of bounded size, each a search of its own:

1. One pass over the texts keeps of each document its length and the terms of the block it holds. This table, a small part
   of the corpus, is stored.
2. Lengths and document frequencies are summed up by Spark.
3. The documents of one small part are searched, only for ``k``-th scores to begin with.
4. Each task builds trees over some thousand documents at a time, keeps the best of all it has seen for each item, and
   hands on at most ``k`` rows for each. Nothing else is shuffled.

Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.tables import stored
from stratum.llm.words import LETTERS_DIGITS, Words, slices, text_bytes

K = 10
BLOCK_BYTES = 1 << 20
FAN = 8
#: Documents of the first small search, on average.
FIRST = 4_096
TREE_DOCUMENTS = 16_384
TREE_ENTRIES = 1 << 21
#: Groups of documents whose scores are worked out before the next look at the bounds.
AT_ONCE = 64
_LAST = np.iinfo(np.int64).max


class Vectors(NamedTuple):
    """Sparse rows: ``first[i]:first[i + 1]`` are the entries of row ``i``."""

    first: np.ndarray
    terms: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the entries of some rows, and where each row's begin among them."""
        sizes = self.first[rows + 1] - self.first[rows]
        starts = np.cumsum(sizes) - sizes
        return np.repeat(self.first[rows] - starts, sizes) + np.arange(sizes.sum()), starts

    def taken(self, rows: np.ndarray) -> Vectors:
        at, starts = self.entries(rows)
        return Vectors(np.append(starts, len(at)), self.terms[at], self.values[at])

    def products(self, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Inner product of each of some rows, none of them empty, with a dense vector."""
        at, starts = self.entries(rows)
        return np.add.reduceat(self.values[at] * weights[self.terms[at]], starts)


class Items(NamedTuple):
    ids: list
    #: Hashes of all their terms, in order. Vectors have their numbers.
    terms: np.ndarray
    counts: Vectors


def items_of(ids: list, texts: pa.Array) -> Items:
    words = Words(*text_bytes(texts), LETTERS_DIGITS, lower=True)
    terms, which = np.unique(words.hashes(), return_inverse=True)
    pairs, counts = np.unique(words.owners() * max(1, len(terms)) + which, return_counts=True)
    first = np.searchsorted(pairs, np.arange(len(ids) + 1) * max(1, len(terms)))
    return Items(ids, terms, Vectors(first, pairs % max(1, len(terms)), counts))


# --- trees ----------------------------------------------------------------------------------------------------------


def alike(rows: Vectors) -> np.ndarray:
    """An order that brings rows of about one size, and of the same largest entries, together."""
    sizes = np.diff(rows.first)
    order = np.lexsort((-rows.values, np.repeat(np.arange(len(rows)), sizes)))
    largest = [rows.terms[order[np.minimum(rows.first[:-1] + k, rows.first[1:] - 1)]] for k in range(3)]
    return np.lexsort([*largest[::-1], np.floor(4 * np.log2(sizes))])


def maxima(rows: Vectors, fan: int) -> Vectors:
    """The largest value of each coordinate over every ``fan`` rows."""
    owner = np.repeat(np.arange(len(rows)) // fan, np.diff(rows.first))
    order = np.lexsort((rows.terms, owner))
    owner, terms = owner[order], rows.terms[order]
    new = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(terms, prepend=-1) != 0))
    nodes = -(-len(rows) // fan)
    return Vectors(np.searchsorted(owner[new], np.arange(nodes + 1)), terms[new], np.maximum.reduceat(rows.values[order], new))


class Tree:
    """Levels of nodes over rows, the rows themselves first; node ``j`` stands for ``FAN`` nodes from ``FAN * j`` on."""

    def __init__(self, rows: Vectors, fan: int = FAN):
        self.fan, self.levels = fan, [rows]
        while len(self.levels[-1]) > fan:
            self.levels.append(maxima(self.levels[-1], fan))

    def below(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """The nodes one level down."""
        down = (nodes[:, None] * self.fan + np.arange(self.fan)).ravel()
        return down[down < len(self.levels[level - 1])]


class Best:
    """The ``k`` best (score, id) of each item so far. Scores start at 0, which is never beaten by 0."""

    def __init__(self, n_items: int, k: int):
        self.scores = np.zeros((n_items, k), np.int64)
        self.ids = np.full((n_items, k), np.iinfo(np.int64).min)
        #: What has to be beaten or equalled, from this table or from elsewhere.
        self.least, self.least_id = self.scores[:, -1].copy(), self.ids[:, -1].copy()

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.append(self.scores[item], scores), np.append(self.ids[item], ids)
        order = np.lexsort((ids, -scores))[: self.scores.shape[1]]
        self.scores[item], self.ids[item] = scores[order], ids[order]
        score, last = self.scores[item, -1], self.ids[item, -1]
        if score > self.least[item] or score == self.least[item] and last < self.least_id[item]:
            self.least[item], self.least_id[item] = score, last


class Search:
    """All items of a block against trees of documents, one after another."""

    def __init__(self, items: Items, k: int, least: tuple[np.ndarray, np.ndarray] | None = None):
        self.order = np.flatnonzero(np.diff(items.counts.first))
        self.n_terms = len(items.terms)
        rows = items.counts.taken(self.order)
        self.order = self.order[similar := alike(rows)] if len(rows) else self.order
        self.items = Tree(rows.taken(similar)) if len(rows) else None
        self.best = Best(len(items.ids), k)
        if least is not None:
            self.best.least, self.best.least_id = least[0].copy(), least[1].copy()
        self.pairs = 0

    def run(self, rows: Vectors, ids: np.ndarray) -> None:
        """Searches documents; each has a term."""
        if self.items is None or not len(rows):
            return
        order = alike(rows)
        self.docs, self.ids = Tree(rows.taken(order)), ids[order]
        #: The smallest id below each node, for ties.
        self.first_id = [self.ids]
        for level in self.docs.levels[1:]:
            self.first_id.append(np.minimum.reduceat(self.first_id[-1], np.arange(len(level)) * FAN))
        top, items = len(self.docs.levels) - 1, len(self.items.levels) - 1
        for node in range(len(self.items.levels[items])):
            self._visit(items, node, top, np.arange(len(self.docs.levels[top])))

    def _members(self, level: int, node: int) -> np.ndarray:
        return self.order[node * FAN**level : (node + 1) * FAN**level]

    def _weights(self, level: int, node: int) -> np.ndarray:
        weights, rows = np.zeros(self.n_terms, np.int64), self.items.levels[level]
        own = slice(rows.first[node], rows.first[node + 1])
        weights[rows.terms[own]] = rows.values[own]
        return weights

    def _open(self, members: np.ndarray, bounds: np.ndarray, first_ids: np.ndarray) -> np.ndarray:
        """Which nodes of documents may still hold something for one of the items."""
        score = self.best.least[members].min()
        tied = self.best.least_id[members][self.best.least[members] == score].max()
        return (bounds > score) | (bounds == score) & (first_ids <= tied)

    def _visit(self, level: int, node: int, at: int, nodes: np.ndarray) -> None:
        weights, members = self._weights(level, node), self._members(level, node)
        while True:
            bounds = self.docs.levels[at].products(nodes, weights)
            self.pairs += len(nodes)
            left = self._open(members, bounds, self.first_id[at][nodes])
            nodes, bounds = nodes[left], bounds[left]
            if not len(nodes):
                return
            if level == 0 and at <= 1:
                return self._finish(int(members[0]), weights, at, nodes, bounds)
            if at > 0:
                at, nodes = at - 1, self.docs.below(at, nodes)
            if level > 0:
                for child in range(node * FAN, min((node + 1) * FAN, len(self.items.levels[level - 1]))):
                    self._visit(level - 1, child, at, nodes)
                return

    def _finish(self, item: int, weights: np.ndarray, at: int, nodes: np.ndarray, bounds: np.ndarray) -> None:
        """Scores the documents of one item's last nodes, best bounds first."""
        if at == 0:
            return self.best.add(item, bounds, self.ids[nodes])
        order = np.argsort(-bounds, kind="stable")
        nodes, bounds = nodes[order], bounds[order]
        while len(nodes):
            rows = self.docs.below(1, nodes[:AT_ONCE])
            self.pairs += len(rows)
            scores = self.docs.levels[0].products(rows, weights)
            good = self._open(np.array([item]), scores, self.ids[rows])
            if good.any():
                self.best.add(item, scores[good], self.ids[rows[good]])
            nodes, bounds = nodes[AT_ONCE:], bounds[AT_ONCE:]
            left = self._open(np.array([item]), bounds, self.first_id[1][nodes])
            nodes, bounds = nodes[left], bounds[left]


# --- tasks ----------------------------------------------------------------------------------------------------------

VECTOR = pa.struct([("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])


def _vectors_of(items):
    @F.arrow_udf("n long, terms array<int>, tfs array<int>")
    def of(texts: pa.Array) -> pa.Array:
        known, parts = items.value.terms, []
        for part in slices(pa.RecordBatch.from_arrays([texts], ["text"])):
            words = Words(*text_bytes(part.column("text")), LETTERS_DIGITS, lower=True)
            hashes = words.hashes()
            at = np.minimum(np.searchsorted(known, hashes), max(0, len(known) - 1))
            hit = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
            pairs, counts = np.unique(words.owners()[hit] * max(1, len(known)) + at[hit], return_counts=True)
            first = pa.array(np.searchsorted(pairs, np.arange(part.num_rows + 1) * max(1, len(known))), pa.int32())
            parts.append(pa.StructArray.from_arrays(
                [pa.array(words.counts(), pa.int64()),
                 pa.ListArray.from_arrays(first, pa.array(pairs % max(1, len(known)), pa.int32())),
                 pa.ListArray.from_arrays(first, pa.array(counts, pa.int32()))], fields=list(VECTOR)))
        return pa.concat_arrays(parts) if parts else pa.array([], VECTOR)

    return of


def _impacts(tfs: np.ndarray, lengths: np.ndarray, weights: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    size = 100 - 75 + 75 * lengths * n_docs // n_words
    return weights * (1_000_000_000 * tfs // (1000 * tfs + 8 * size))


class Statistics(NamedTuple):
    n_docs: int
    n_words: int
    weights: np.ndarray


def _trees(batches: Iterator[pa.RecordBatch], stats: Statistics) -> Iterator[tuple[Vectors, np.ndarray]]:
    """Documents as vectors and their ids, as many at a time as a tree holds."""
    held, docs, entries = [], 0, 0
    for batch in batches:
        for start in range(0, batch.num_rows, TREE_DOCUMENTS):
            part = batch.slice(start, TREE_DOCUMENTS)
            sizes = part.column("terms").value_lengths().to_numpy(zero_copy_only=False)
            tfs = part.column("tfs").flatten().to_numpy().astype(np.int64)
            terms = part.column("terms").flatten().to_numpy()
            lengths = np.repeat(part.column("n").to_numpy(), sizes)
            ids = part.column("doc_id").fill_null(_LAST).to_numpy()
            held.append((sizes, terms, _impacts(tfs, lengths, stats.weights[terms], stats.n_docs, stats.n_words), ids))
            docs, entries = docs + len(sizes), entries + len(terms)
            if docs >= TREE_DOCUMENTS or entries >= TREE_ENTRIES:
                yield _together(held)
                held, docs, entries = [], 0, 0
    if held:
        yield _together(held)


def _together(held: list) -> tuple[Vectors, np.ndarray]:
    sizes, terms, values, ids = (np.concatenate(x) for x in zip(*held))
    return Vectors(np.concatenate([[0], np.cumsum(sizes)]), terms, values), ids


RANKED = "item long, doc_id long, score long"


def _searcher(block, stats: Statistics, k: int, least):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Search(block.value, k, least)
        for rows, ids in _trees(batches, stats):
            found.run(rows, ids)
        item, place = np.nonzero(found.best.scores)
        ids = found.best.ids[item, place]
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array(ids, pa.int64(), mask=ids == _LAST),
             pa.array(found.best.scores[item, place], pa.int64())], ["item", "doc_id", "score"])

    return search


# --- operator -------------------------------------------------------------------------------------------------------


def _first_scores(vectors: DataFrame, block, stats: Statistics, k: int, n_items: int) -> tuple[np.ndarray, np.ndarray]:
    """What the ``k``-th of each item reaches among some documents: it is at least that good among all."""
    some = vectors.sample(min(1.0, FIRST / max(1, stats.n_docs)), seed=FIRST).repartition(1)
    rows = some.mapInArrow(_searcher(block, stats, k, None), RANKED).toArrow()
    item, score = rows["item"].to_numpy(), rows["score"].to_numpy()
    ids = rows["doc_id"].combine_chunks().fill_null(_LAST).to_numpy()
    order = np.lexsort((ids, -score, item))
    item, score, ids = item[order], score[order], ids[order]
    least, least_id = np.zeros(n_items, np.int64), np.full(n_items, np.iinfo(np.int64).min)
    kth = np.searchsorted(item, np.arange(n_items)) + k - 1
    full = np.flatnonzero(kth < np.searchsorted(item, np.arange(n_items), "right"))
    least[full], least_id[full] = score[kth[full]], ids[kth[full]]
    return least, least_id


def _weights(vectors: DataFrame, n_docs: int, n_terms: int) -> np.ndarray:
    rows = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()
    df = np.zeros(n_terms, np.int64)
    df[rows["term"].to_numpy()] = rows["df"].to_numpy()
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


def _ranked(docs: DataFrame, rows: pa.Table, k: int) -> DataFrame:
    """One block of items."""
    spark = docs.sparkSession
    items = items_of(list(range(rows.num_rows)), rows["text"].combine_chunks())
    block = spark.sparkContext.broadcast(items)
    vectors = stored(docs.select("doc_id", _vectors_of(block)("text").alias("v")).select("doc_id", "v.*").where("n > 0"))
    n_docs, n_words = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    vectors = vectors.where(F.size("terms") > 0)
    stats = Statistics(n_docs, n_words, _weights(vectors, n_docs, len(items.terms)))
    least = _first_scores(vectors, block, stats, k, rows.num_rows)
    found = vectors.mapInArrow(_searcher(block, stats, k, least), RANKED)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame(rows.select(["item_id"]).append_column("item", pa.array(range(rows.num_rows), pa.int64())))
    return stored(found).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` documents with the highest scores for each row of ``items(item_id, text)``: ``item_id, rank, doc_id, score``.

    Terms are runs of ASCII letters and digits and of anything that is not ASCII, A-Z in lower case. The score is a sum
    over the item's terms, repeats included, in whole numbers: a term's weight, ``floor(1000 ln((2N + 2) / (2df + 1)))``,
    times ``10^9 tf div (1000 tf + 8m)``, with ``m = 25 + 75 n N div L``. ``N`` counts the documents with a term, ``L``
    their terms, ``n`` those of the document. Equal scores are in order of doc_id, without one last. Documents of score
    0 are not returned.

    A missing text holds no terms: such a document is not counted, such an item finds nothing. Repeated documents are
    documents each, and so repeated items. Empty tables give an empty result. Other columns are not looked at. Items are
    searched in blocks of about ``block_bytes`` of text, or one long item, in the order of their blocks; that bounds
    what is broadcast and what the driver holds.
    """
    items = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // block_bytes + 1
    of = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    docs = docs.select("doc_id", "text")
    return functools.reduce(DataFrame.unionByName, [_ranked(docs, items.where(of == b).toArrow(), k) for b in range(blocks)])
