"""Language-model scores by Brown's class-based bigrams.

Every word belongs to a class, and a text has the probability

    product of P(class of the word | class of the word before) * P(word | class of the word).

Words that occur at least ``MIN_COUNT`` times in training, however large it is, are assigned to classes by exchange
clustering, in rounds as in Uszkoreit and Brants (2008): the counts of word pairs lie in a stored table by words and
their neighbours, each task works out for some of the words which class they would best move to, and only words
and classes travel. The map of words to
classes is held by the driver and by each worker, so their memory grows with the vocabulary. All rarer words form one
class, in which a word's share follows its count in the whole corpus; texts meet these counts in a join of narrow rows,
one per text and rare word. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from stratum.llm.tables import row_key, stored
from stratum.llm.words import SPACED, Words, signed, slices, text_bytes

#: Words with fewer occurrences are not clustered. A count and not a share, so that no word loses its class in a larger corpus.
MIN_COUNT = 5
CLASSES = 64
ROUNDS = 6
#: Weight of the plain class frequencies behind the counted transitions.
PRIOR = 20.0
#: Added to the counts of rare words, and given to unknown ones.
RARE = 0.5

#: Keys that a task holds before it adds them up and sends them on.
HELD_KEYS = 500_000
END_HASH = 0
_END, _RARE, _FIRST = 0, 1, 2  # symbols; the classes of the first two are their own


@dataclass
class Vocabulary:
    """Sums over all training tokens, and the words that are clustered, by hash."""

    tokens: int
    kinds: int
    ends: int
    hashes: np.ndarray
    counts: np.ndarray

    @property
    def rare_tokens(self) -> int:
        return self.tokens - self.ends - int(self.counts.sum())

    @property
    def rare_kinds(self) -> int:
        return self.kinds - (self.ends > 0) - len(self.counts)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), _RARE)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at + _FIRST, _RARE)


def _sequence(words: Words, symbols: np.ndarray) -> np.ndarray:
    """The symbols of all texts, each text between end symbols."""
    texts = len(words.first) - 1
    out = np.full(len(words) + texts + 1, _END)
    out[np.arange(len(words)) + words.owners() + 1] = symbols
    return out


# --- counting -------------------------------------------------------------------------------------------------------


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    kinds, at = np.unique(np.concatenate(keys), return_inverse=True)
    return kinds, np.bincount(at, np.concatenate(counts), len(kinds)).astype(np.int64)


def _counted(batches: Iterable[pa.RecordBatch], keys_of) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of all texts with their counts, put together over several slices before they are sent."""
    keys, counts, held = [], [], 0
    for batch in batches:
        for part in slices(batch):
            words = Words(*text_bytes(part.column("text")), SPACED, lower=True)
            found, n = np.unique(keys_of(words), return_counts=True)
            keys.append(found)
            counts.append(n)
            held += len(found)
            if held > HELD_KEYS:
                yield _summed(keys, counts)
                keys, counts, held = [], [], 0
    if keys:
        yield _summed(keys, counts)


def _word_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def words_and_ends(words: Words) -> np.ndarray:
        return np.concatenate([signed(words.hashes()), np.full(len(words.first) - 1, END_HASH)])

    for keys, counts in _counted(batches, words_and_ends):
        yield pa.RecordBatch.from_pydict({"h": keys, "n": counts})


WORDS_PER_BLOCK = 128
#: Some pairs of symbols with their counts, as bytes of three arrays in order of ``words``: int32, int32, int32 or int64.
_PACKED = "block int, words binary, others binary, counts binary"


def _pack(words: np.ndarray, others: np.ndarray, counts: np.ndarray, **more) -> pa.RecordBatch:
    """One row per block of words, which are in order."""
    blocks = words // WORDS_PER_BLOCK
    cuts = np.flatnonzero(np.diff(blocks, prepend=-1))
    kind = np.int32 if not len(counts) or counts.max() < 1 << 31 else np.int64
    arrays = words.astype(np.int32), others.astype(np.int32), counts.astype(kind)
    parts = [[x[i:j].tobytes() for i, j in zip(cuts, np.append(cuts[1:], len(words)))] for x in arrays]
    return pa.RecordBatch.from_pydict({
        "block": pa.array(blocks[cuts], pa.int32()), **{name: pa.array(part, pa.binary()) for name, part in zip(("words", "others", "counts"), parts)},
        **{name: pa.array([value] * len(cuts)) for name, value in more.items()}})


def _unpack(words: pa.Scalar, others: pa.Scalar, counts: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words, others, counts = words.as_buffer(), others.as_buffer(), counts.as_buffer()
    kind = np.int32 if counts.size == words.size else np.int64
    return np.frombuffer(words, np.int32), np.frombuffer(others, np.int32), np.frombuffer(counts, kind)


def _each(rows: pa.RecordBatch | pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    return map(_unpack, *(rows.column(c) for c in ("words", "others", "counts")))


def _pair_rows(shared):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        size = len(vocabulary.hashes) + _FIRST

        def pairs(words: Words) -> np.ndarray:
            symbols = _sequence(words, vocabulary.symbols(signed(words.hashes())))
            return symbols[:-1] * size + symbols[1:]

        for keys, counts in _counted(batches, pairs):
            yield _pack(keys // size, keys % size, counts)

    return rows


def _added_up(group: pa.Table) -> pa.Table:
    """The pairs of a block, each once."""
    words, others, counts = (np.concatenate(x) for x in zip(*_each(group)))
    keys, at = np.unique(words.astype(np.int64) << 32 | others, return_inverse=True)
    return pa.Table.from_batches([_pack(keys >> 32, keys & 0xFFFFFFFF, np.bincount(at, counts, len(keys)).astype(np.int64))])


def count_pairs(training: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Pairs of symbols in a row, by block of the first one; stored, as two Python steps in one stage would take twice the memory."""
    shared = training.sparkSession.sparkContext.broadcast(vocabulary)
    rows = training.select("text").mapInArrow(_pair_rows(shared), _PACKED)
    return stored(rows.groupBy("block").applyInArrow(_added_up, _PACKED))


def count_words(training: DataFrame) -> DataFrame:
    """``h, n`` for every word of all texts, and for the end of a text."""
    rows = training.select("text").mapInArrow(_word_rows, "h long, n long")
    return stored(rows.groupBy("h").agg(F.sum("n").alias("n")))


def vocabulary_of(counts: DataFrame, min_count: int) -> Vocabulary:
    row = counts.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("kinds"),
                     F.sum(F.when(F.col("h") == END_HASH, F.col("n"))).alias("ends")).first()
    tokens = row["tokens"] or 0
    head = counts.where((F.col("n") >= min_count) & (F.col("h") != END_HASH)).toArrow()
    hashes, n = head["h"].to_numpy(), head["n"].to_numpy()
    order = np.argsort(hashes)
    return Vocabulary(tokens, row["kinds"], row["ends"] or 0, hashes[order], n[order])


# --- exchange clustering --------------------------------------------------------------------------------------------


def _gain(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(table: np.ndarray) -> float:
    """What the classes contribute to the log likelihood of the training text."""
    return float(_gain(table).sum() - _gain(table.sum(0)).sum() - _gain(table.sum(1)).sum())


def best_classes(own: np.ndarray, right: np.ndarray, left: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each word, taken out of its class, the class where it adds most.

    ``right[w, c]`` and ``left[w, c]`` count the class after and before the word; ``table`` counts pairs of classes.
    """
    out = own.copy()
    for k in range(0, len(own), 256):
        c, r, l = own[k : k + 256], right[k : k + 256], left[k : k + 256]
        word = np.arange(len(c))
        added = np.zeros((len(c), len(table)))
        # Only cells of classes next to the word change: columns for those after it, rows for those before it.
        for cells, mine, other in ((table.T, r, l), (table, l, r)):
            of, near = np.nonzero(mine)
            n = mine[of, near]
            rest = cells[near].astype(float)
            rest[np.arange(len(of)), c[of]] -= n
            at_own = np.flatnonzero(near == c[of])
            rest[at_own] -= other[of[at_own]]
            rest = np.maximum(rest, 0)
            first = np.flatnonzero(np.diff(of, prepend=-1))
            if len(first):
                added[of[first]] += np.add.reduceat(_gain(rest + n[:, None]) - _gain(rest), first, axis=0)
        short = np.maximum(r[word, c] + l[word, c] - table[c, c], 0)  # what a cell would be below 0
        for sums, mine, other in ((table.sum(1), r, l), (table.sum(0), l, r)):
            rest = sums - other
            rest[word, c] += short - mine.sum(1)
            added -= _gain(rest + mine.sum(1)[:, None]) - _gain(rest)
        added[:, :_FIRST] = -np.inf
        out[k : k + 256] = added.argmax(1)
    return out


def _both_ways(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each pair by its first word, and again by its second if that can move. The latter go to all blocks, so many are held before they are dealt out."""
    held, size = [], 0

    def dealt() -> pa.RecordBatch:
        words, others, counts = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(others, kind="stable")
        return _pack(others[order], words[order], counts[order], after=False)

    for batch in batches:
        for words, others, counts in _each(batch):
            yield _pack(words, others, counts, after=True)
            moves = others >= _FIRST
            held.append((words[moves], others[moves], counts[moves]))
            size += len(held[-1][0])
            if size > HELD_KEYS:
                yield dealt()
                held, size = [], 0
    if size:
        yield dealt()


_NEIGHBOURS = f"{_PACKED}, n_after long"


def _gathered(group: pa.Table) -> pa.Table:
    """One row per block: all pairs by their first words, then those by their second ones."""
    after = group.column("after").to_numpy()
    parts = list(_each(group))
    words, others, counts = (np.concatenate(x) for x in zip(*parts))
    n_after = np.repeat(after, [len(p[0]) for p in parts])
    order = np.lexsort((words, ~n_after))
    return pa.Table.from_batches([_pack(words[order], others[order], counts[order], n_after=int(n_after.sum()))])


def neighbours_of(pairs: DataFrame) -> DataFrame:
    """The pairs by either word, stored. A row holds a block of words; no more than so many times the vocabulary twice."""
    rows = pairs.mapInArrow(_both_ways, f"{_PACKED}, after boolean")
    return stored(rows.groupBy("block").applyInArrow(_gathered, _NEIGHBOURS))


def _class_pairs(shared, size: int):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, classes = np.zeros(size * size, np.int64), shared.value
        for batch in batches:
            for (a, b, n), k in zip(_each(batch), batch.column("n_after").to_pylist()):
                # Counts are whole numbers far below 2^53.
                cells = classes[a[:k]] * np.int64(size) + classes[b[:k]]
                table += np.bincount(cells, n[:k], size * size).astype(np.int64)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_pydict({"a": at // size, "b": at % size, "n": table[at]})

    return rows


def _moves(shared, table: np.ndarray, turn: int):
    size = len(table)

    def moves(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = shared.value
        for batch in batches:
            for (word, other, n), k in zip(_each(batch), batch.column("n_after").to_pylist()):
                after = np.arange(len(word)) < k
                chosen = (word >= _FIRST) & (word % 2 == turn % 2)
                words, at = np.unique(word[chosen], return_inverse=True)
                cells = at * size + classes[other[chosen]]
                right, left = (np.bincount(cells[side], n[chosen][side], len(words) * size).reshape(-1, size)
                               for side in (after[chosen], ~after[chosen]))
                best = best_classes(classes[words].astype(np.int64), right, left, table)
                yield pa.RecordBatch.from_pydict({"word": words, "class": best.astype(np.int32)})

    return moves


def _table_of(neighbours: DataFrame, shared, size: int) -> np.ndarray:
    rows = neighbours.mapInArrow(_class_pairs(shared, size), "a long, b long, n long")
    found = rows.groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((size, size), np.int64)
    table[found["a"].to_numpy(), found["b"].to_numpy()] = found["n"].to_numpy()
    return table


def exchange(neighbours: DataFrame, counts: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The class of each symbol, and the counts of pairs of classes.

    In each round one half of the words may move, all seen from the classes before the round. The best classes seen
    are kept. A round reads the stored table twice and shuffles a class table per task.
    """
    context = neighbours.sparkSession.sparkContext
    size = _FIRST + classes
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    current = np.concatenate([[_END, _RARE], _FIRST + rank % classes]).astype(np.min_scalar_type(size))
    best = None
    for turn in range(rounds + 1):
        shared = context.broadcast(current)
        table = _table_of(neighbours, shared, size)
        if best is None or likelihood(table) > best[0]:
            best = (likelihood(table), current, table)
        if turn == rounds or not len(counts):
            break
        moved = neighbours.mapInArrow(_moves(shared, table, turn), "word int, class int").toArrow()
        current = current.copy()
        current[moved["word"].to_numpy()] = moved["class"].to_numpy()
    return best[1], best[2]


# --- scores ---------------------------------------------------------------------------------------------------------


@dataclass
class Model:
    """What a worker needs: 17 bytes per clustered word, and the transitions."""

    vocabulary: Vocabulary
    classes: np.ndarray
    transitions: np.ndarray  # log10, [before, after]
    class_totals: np.ndarray

    @property
    def base_total(self) -> float:
        return self.vocabulary.tokens + 0.5 * (self.vocabulary.kinds + 1)

    @property
    def rare_total(self) -> float:
        return self.vocabulary.rare_tokens + RARE * (self.vocabulary.rare_kinds + 1)

    def counts(self, symbols: np.ndarray) -> np.ndarray:
        """Occurrences in training; none for rare words, which are looked up."""
        own = self.vocabulary.counts if len(self.vocabulary.counts) else np.zeros(1, np.int64)
        n = own[np.maximum(symbols - _FIRST, 0)]
        return np.where(symbols >= _FIRST, n, np.where(symbols == _END, self.vocabulary.ends, 0))

    def emission(self, symbols: np.ndarray) -> np.ndarray:
        """log10 of a word's share of its class; nothing for ends and rare words."""
        word = symbols >= _FIRST
        return np.log10(np.where(word, self.counts(symbols) / np.maximum(self.class_totals[self.classes[symbols]], 1), 1))

    @property
    def emissions(self) -> np.ndarray:
        return self.emission(np.arange(len(self.classes)))

    def base(self, symbols: np.ndarray) -> np.ndarray:
        """log10 of the smoothed frequency; nothing for rare words."""
        return np.where(symbols == _RARE, 0, np.log10((self.counts(symbols) + 0.5) / self.base_total))


def model_of(vocabulary: Vocabulary, classes: np.ndarray, table: np.ndarray) -> Model:
    total = table.sum(0)
    plain = (total + 1) / (total.sum() + len(total))
    transitions = np.log10((table + PRIOR * plain) / (table.sum(1, keepdims=True) + PRIOR))
    return Model(vocabulary, classes, transitions, total)


def train(training: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS, min_count: int = MIN_COUNT) -> tuple[Model, DataFrame]:
    """A model of all texts of ``training(text)``, and the stored table ``h, n`` of all its words."""
    counts = count_words(training)
    vocabulary = vocabulary_of(counts, min_count)
    neighbours = neighbours_of(count_pairs(training, vocabulary))
    return model_of(vocabulary, *exchange(neighbours, vocabulary.counts, classes, rounds)), counts


def _score_rows(shared, part: pa.DataType):
    schema = pa.schema([("key", pa.int64()), ("h", pa.int64()), ("k", pa.int32()), ("part", part)])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows in slices(batch):
                words = Words(*text_bytes(rows.column("text")), SPACED, lower=True)
                hashes = signed(words.hashes())
                symbols = model.vocabulary.symbols(hashes)
                sequence = _sequence(words, symbols)
                classes = model.classes[sequence]
                after = sequence[1:]
                first = words.first[:-1] + np.arange(rows.num_rows)
                score = np.add.reduceat(model.transitions[classes[:-1], classes[1:]] + model.emission(after), first)
                base = np.add.reduceat(model.base(after), first)
                known = np.add.reduceat((model.counts(after) > 0).astype(np.int64), first)
                key = rows.column("key").to_numpy()
                sums = pa.StructArray.from_arrays(
                    [rows.column("doc_id"), rows.column("held_out"), pa.array(words.counts() + 1), pa.array(known),
                     pa.array(base), pa.array(score)], fields=list(part))
                # The row of a text looks up a word as well, so that these rows are spread; nothing comes of it.
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(key), pa.array(np.zeros(len(key), np.int32)), sums], schema=schema)
                rare = np.flatnonzero(symbols == _RARE)
                owner, h = words.owners()[rare], hashes[rare]
                order = np.lexsort((h, owner))
                owner, h = owner[order], h[order]
                new = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(h, prepend=0) != 0))
                count = np.diff(np.append(new, len(h))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[owner[new]]), pa.array(h[new]), pa.array(count), pa.nulls(len(new), part)], schema=schema)

    return rows


def scores(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, held_out, text)``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity``.

    Words are runs of anything but ASCII white space, A-Z in lower case; the end of a text counts as one more token,
    so a missing or empty text has one. ``n_known`` are the tokens that occur in training. ``base_score`` is the log10
    probability by smoothed word frequencies, ``score`` that of the class model, ``perplexity`` the latter per token.
    All unknown words count as one word. Repeated rows are returned as often as they come. An empty table gives no row.
    Extra columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    part = pa.struct([("doc_id", to_arrow_type(docs.schema["doc_id"].dataType)), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()),
                      ("base", pa.float64()), ("score", pa.float64())])
    part_sql = T.StructType([
        docs.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("known", T.LongType()), T.StructField("base", T.DoubleType()), T.StructField("score", T.DoubleType())])
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("h", T.LongType()),
                           T.StructField("k", T.IntegerType()), T.StructField("part", part_sql)])
    rows = docs.select("doc_id", "held_out", "text", row_key().alias("key")).mapInArrow(_score_rows(shared, part), schema)
    rows = rows.join(counts, "h", "left")
    n = F.coalesce("n", F.lit(0))
    times = F.count("part")  # equal rows come together
    found = rows.groupBy("key").agg(
        times.alias("times"), F.max("part.doc_id").alias("doc_id"), F.max("part.held_out").alias("held_out"),
        F.sum("part.n_tokens").alias("n_tokens"),
        (F.coalesce(F.sum("part.known"), F.lit(0)) + F.sum(F.when(n > 0, F.col("k")).otherwise(0))).alias("n_known"),
        (F.sum("part.base") + F.sum(F.col("k") * F.log10((n + 0.5) / model.base_total))).alias("base_score"),
        (F.sum("part.score") + F.sum(F.col("k") * F.log10((n + RARE) / model.rare_total))).alias("score"))
    each = found.select(
        "doc_id", "held_out", (F.col("n_tokens") / F.col("times")).cast("long").alias("n_tokens"),
        (F.col("n_known") / F.col("times")).cast("long").alias("n_known"),
        F.lit(model.vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") / F.col("times")).alias("base_score"), (F.col("score") / F.col("times")).alias("score"),
        F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    return each.drop("copy").withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
