"""Approximate nearest neighbours by inner product with a forest of random-projection trees.

Trees are fitted on a bounded sample: a node splits its vectors at the median of their projections on the difference of
two of them. Every vector is then routed to one leaf of each tree. A query keeps one priority queue over all trees; the
node whose splits the query clears by the most is opened next, until the leaves opened hold a given share of the
sample. Vectors of a leaf meet the queries that opened it, and inner products are taken in double precision.

Equal vectors are one vector with several ids, of which no query can return more than its ``k`` smallest besides its
own. Trees and queries are worked on in blocks, so a task holds a bounded number of vectors and of queries.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.tables import stored

TREES = 12
LEAF = 64
SAMPLE = 20_000
#: Leaves are opened until they hold as many vectors as this share of the sample, vectors counted once per tree.
SHARE = 1.6
VECTORS_PER_TASK = 50_000
QUERIES_PER_TASK = 50_000
SEED = 7


# --- trees ----------------------------------------------------------------------------------------------------------


@dataclass
class Tree:
    """Inner nodes, the root first. A child below 0 is the leaf ``-1 - child``."""

    normals: np.ndarray
    cuts: np.ndarray
    children: np.ndarray
    sizes: np.ndarray  # sampled vectors per leaf

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        at = np.zeros(len(vectors), np.int64) if len(self.cuts) else np.full(len(vectors), -1)
        while len(inner := np.flatnonzero(at >= 0)):
            node = at[inner]
            over = np.einsum("ij,ij->i", vectors[inner], self.normals[node]) > self.cuts[node]
            at[inner] = self.children[node, over.astype(int)]
        return -1 - at


def grow(vectors: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    normals, cuts, children, sizes = [], [], [], []
    todo = [(np.arange(len(vectors)), None, 0)]
    while todo:
        rows, parent, side = todo.pop()
        split = _split(vectors[rows], rng) if len(rows) > leaf else None
        if split is None:
            name = -1 - len(sizes)
            sizes.append(len(rows))
        else:
            name = len(cuts)
            normal, cut, over = split
            normals.append(normal)
            cuts.append(cut)
            children.append([0, 0])
            todo += [(rows[over], name, 1), (rows[~over], name, 0)]
        if parent is not None:
            children[parent][side] = name
    dim = vectors.shape[1]
    return Tree(np.array(normals, np.float32).reshape(-1, dim), np.array(cuts, np.float32), np.array(children, np.int64).reshape(-1, 2),
                np.array(sizes, np.int64))


def _split(vectors: np.ndarray, rng: np.random.Generator) -> tuple | None:
    """A direction, a cut and who lies above it; None if a few directions fail to tell these vectors apart."""
    for _ in range(5):
        a, b = rng.choice(len(vectors), 2, replace=False)
        normal = (vectors[a] - vectors[b]).astype(np.float32)
        length = np.linalg.norm(normal)
        if length > 0:
            normal /= length
            side = np.einsum("ij,j->i", vectors, normal)
            cut = np.float32(np.median(side))
            over = side > cut
            if over.any() and not over.all():
                return normal, cut, over
    return None


class Search:
    """The trees of a forest side by side."""

    def __init__(self, trees: list[Tree], share: float):
        self.trees = trees
        self.normals = np.concatenate([t.normals for t in trees])
        self.cuts = np.concatenate([t.cuts for t in trees])
        self.first = np.cumsum([0] + [len(t.cuts) for t in trees])
        self.budget = share * trees[0].sizes.sum()

    def leaves(self, queries: np.ndarray) -> Iterator[list[tuple[int, int]]]:
        """For each query the leaves (tree, leaf) that it opens."""
        margins = queries.astype(np.float32) @ self.normals.T - self.cuts
        children = [t.children.tolist() for t in self.trees]
        sizes = [t.sizes.tolist() for t in self.trees]
        first = self.first.tolist()
        for row in margins.tolist() if len(self.cuts) else [[]] * len(queries):
            heap = [(float("-inf"), tree, 0 if len(children[tree]) else -1) for tree in range(len(self.trees))]
            heapq.heapify(heap)
            found, seen = [], 0
            while heap and seen < self.budget:
                miss, tree, node = heapq.heappop(heap)
                if node < 0:
                    found.append((tree, -1 - node))
                    seen += sizes[tree][-1 - node]
                else:
                    margin = row[first[tree] + node]
                    under, over = children[tree][node]
                    heapq.heappush(heap, (max(miss, margin), tree, under))
                    heapq.heappush(heap, (max(miss, -margin), tree, over))
            yield found


# --- tables ---------------------------------------------------------------------------------------------------------


def _usable(vector: Column, dim: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (F.size(vector) == dim) & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _blocks(trees: list[Tree], blocks: int) -> list[np.ndarray]:
    """The task of each leaf; a task has leaves of one tree only, so it never sees a vector twice."""
    return [number * blocks + np.arange(len(t.sizes)) * blocks // len(t.sizes) for number, t in enumerate(trees)]


def _index_rows(shared, blocks: int):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value.trees
        tasks = _blocks(trees, blocks)
        for batch in batches:
            vectors = _matrix(batch.column("vector")).astype(np.float32)
            for tree, task in zip(trees, tasks):
                leaf = tree.leaves(vectors)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(task[leaf]), pa.array(leaf), batch.column("first_id"), batch.column("vector")],
                    ["task", "leaf", "first_id", "vector"])

    return rows


def _probe_rows(shared, blocks: int):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = shared.value
        tasks = _blocks(search.trees, blocks)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                row, task, leaves = [], [], []
                for i, found in enumerate(search.leaves(_matrix(part.column("vector")))):
                    by_task: dict[int, list[int]] = {}
                    for tree, leaf in found:
                        by_task.setdefault(int(tasks[tree][leaf]), []).append(leaf)
                    for name, inside in by_task.items():
                        row.append(i)
                        task.append(name)
                        leaves.append(inside)
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(task, pa.int64()), part.column("block").take(take), part.column("query").take(take),
                     part.column("vector").take(take), pa.array(leaves, pa.list_(pa.int64()))],
                    ["task", "block", "query", "vector", "leaves"])

    return rows


def _nearest(keep: int):
    """Per query the best vectors of the leaves that it opened here."""

    def nearest(index: pa.Table, probes: pa.Table) -> pa.Table:
        out = {"query": [], "first_id": [], "score": []}
        if index.num_rows and probes.num_rows:
            leaf = index.column("leaf").to_numpy()
            order = np.argsort(leaf, kind="stable")
            names, starts = np.unique(leaf[order], return_index=True)
            ends = np.append(starts[1:], len(order))
            vectors, ids = _matrix(index.column("vector")).astype(np.float64), index.column("first_id").to_numpy()
            queries, number = _matrix(probes.column("vector")).astype(np.float64), probes.column("query").to_numpy()
            lists = probes.column("leaves").combine_chunks()
            opened = lists.flatten().to_numpy()
            who = np.repeat(np.arange(len(queries)), np.diff(lists.offsets.to_numpy()))
            by_leaf = np.argsort(opened, kind="stable")
            opened, who = opened[by_leaf], who[by_leaf]
            best = _Best(len(queries), keep)
            for name, a, b in zip(names, starts, ends):
                rows = order[a:b]
                asked = who[np.searchsorted(opened, name) : np.searchsorted(opened, name, "right")]
                if len(asked):
                    best.offer(asked, rows, queries[asked] @ vectors[rows].T)
            q, v, score = best.result()
            out = {"query": number[q], "first_id": ids[v], "score": score}
        return pa.table(out, pa.schema([("query", pa.int64()), ("first_id", pa.int64()), ("score", pa.float64())]))

    return nearest


class _Best:
    """The best offers per query. Whatever cannot be among them is dropped as soon as it is known."""

    def __init__(self, queries: int, keep: int):
        self.keep, self.held = keep, 0
        self.least = np.full(queries, -np.inf)
        self.parts: list[tuple] = []

    def offer(self, queries: np.ndarray, vectors: np.ndarray, scores: np.ndarray) -> None:
        row, column = np.nonzero(scores >= self.least[queries][:, None])
        self.parts.append((queries[row], vectors[column], scores[row, column]))
        self.held += len(row)
        if self.held > 1 << 20:
            self.parts = [self.result()]
            self.held = len(self.parts[0][0])

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        q, v, s = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((-s, q))
        q, v, s = q[order], v[order], s[order]
        first = np.flatnonzero(np.diff(q, prepend=-1))
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        last = place == self.keep - 1
        self.least[q[last]] = s[last]
        # Equal scores at the end stay, as ids decide between them.
        stay = (place < self.keep) | (s >= self.least[q])
        return q[stay], v[stay], s[stay]


# --- operator -------------------------------------------------------------------------------------------------------


def fit(vectors: DataFrame, count: int, trees: int, leaf: int, sample: int, seed: int) -> list[Tree]:
    """Trees over about ``sample`` different vectors chosen by hash."""
    share = min(1.0, sample / max(1, count))
    draw = F.pmod(F.xxhash64("vector", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    rows = vectors.where(draw < share).select("vector", "first_id").toArrow()
    matrix = _matrix(rows["vector"]).astype(np.float32) if rows.num_rows else np.zeros((0, 1), np.float32)
    matrix = matrix[np.argsort(rows["first_id"].to_numpy(), kind="stable")]
    return [grow(matrix, leaf, np.random.default_rng([seed, number])) for number in range(trees)]


def search(table: DataFrame, queries: Column, k: int, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, share: float = SHARE,
           vectors_per_task: int = VECTORS_PER_TASK, queries_per_task: int = QUERIES_PER_TASK, seed: int = SEED) -> DataFrame:
    """Nearest rows of ``table(vec_id, embedding)`` for those of its rows that satisfy ``queries`` (on ``vec_id``).

    ``query_id, rank, vec_id, score``: the ``k`` found with the largest inner product (all, if there are fewer), ties to
    the smaller id. Rows take no part without vec_id, without vector, with a vector of another length than most, with a
    component that is null or not finite, or with zeros only. A row is not a candidate for its own id; repeated rows
    count once. Of an id with several different vectors each asks and each is a candidate: the id may take several ranks,
    and as a query get fewer than ``k`` rows. An empty table, or no query, gives no row. Extra columns are not looked at.
    """
    spark = table.sparkSession
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector")).where("vec_id IS NOT NULL")
    dim = rows.where("vector IS NOT NULL").agg(F.mode(F.size("vector"), True)).first()[0] or 0
    rows = rows.where(_usable(F.col("vector"), dim))
    # With equal vectors only the smallest ids count; the window drops the others before they are shuffled.
    ranked = rows.distinct().withColumn("place", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id")))
    kinds = stored(ranked.where(F.col("place") <= k + 1).groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                   .select(F.col("ids")[0].alias("first_id"), "vector", "ids"))
    count = kinds.count()
    asked = rows.where(queries).select(F.col("vec_id").alias("query"), "vector").distinct()
    n_queries = asked.count()
    if not count or not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(Search(fit(kinds, count, trees, leaf, sample, seed), share))
    per_tree, blocks = count // vectors_per_task + 1, n_queries // queries_per_task + 1
    vector_type = table.schema["embedding"].dataType.simpleString()
    index = kinds.select("first_id", "vector").mapInArrow(
        _index_rows(shared, per_tree), f"task long, leaf long, first_id long, vector {vector_type}")
    index = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
    probes = asked.mapInArrow(
        _probe_rows(shared, per_tree), f"task long, block int, query long, vector {vector_type}, leaves array<long>")
    found = index.groupBy("task", "block").cogroup(probes.groupBy("task", "block")).applyInArrow(
        _nearest(k + 1), "query long, first_id long, score double")
    found = found.groupBy("query", "first_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "first_id")
    found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    each = found.join(kinds.select("first_id", "ids"), "first_id").select("query", "score", F.explode("ids").alias("vec_id"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return each.where("vec_id <> query").withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
