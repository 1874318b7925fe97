"""Benchmark decontamination with an FM-index of each shard of documents.

A shard is a few megabytes of texts as one sequence of word numbers, with a mark of its own after each text. Its index
is the Burrows-Wheeler transform in a wavelet matrix, and the places of every 16th suffix. All windows of the benchmark
are searched backwards at once, one word a step; what is left of them are ranges of suffixes, whose places are found by
walking back to the next known one. The index lives as long as its shard is worked on, so memory does not depend on
the corpus.

The benchmark comes in blocks of bounded size; each is broadcast and searched for on its own. Words are compared by
64-bit hashes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.words import LETTERS_DIGITS, Words, slices, text_bytes

WINDOW = 13
BLOCK_BYTES = 4 << 20
SAMPLE = 16
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20
NO_ID = np.iinfo(np.int64).min


# --- index ----------------------------------------------------------------------------------------------------------


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Places of the suffixes in order, by prefix doubling of those that are not told apart yet.

    Each suffix must differ from the others before it ends, as the last symbol occurs nowhere else.
    """
    n = len(symbols)
    places = np.argsort(symbols, kind="stable")
    slots = np.arange(n)
    key = symbols[places]
    rank = np.empty(n, np.int64)
    a, span = places, 0
    while True:
        new = np.diff(key, prepend=-1) != 0
        first = slots[np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))]
        rank[a] = first
        open_ = ~(new & np.append(new[1:], True))
        if not open_.any():
            return places
        a, group = a[open_], first[open_]
        span = 2 * span or 1
        key = group * n + rank[a + span]
        order = np.argsort(key)  # groups stay together and in place
        a, key, group = a[order], key[order], group[order]
        start = np.diff(group, prepend=-1) != 0
        within = np.arange(len(a)) - np.maximum.accumulate(np.where(start, np.arange(len(a)), 0))
        slots = group + within
        places[slots] = a


class WaveletMatrix:
    """Ranks and symbols of a sequence, bit by bit from the top."""

    def __init__(self, values: np.ndarray, top: int):
        self.bits = range(max(1, int(top).bit_length()) - 1, -1, -1)
        self.ones, self.zeros = [], []
        for bit in self.bits:
            one = (values >> bit & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(one, dtype=np.int32)]))
            self.zeros.append(len(values) - int(self.ones[-1][-1]))
            values = np.concatenate([values[~one], values[one]])

    def rank(self, values: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each value occurs before each end."""
        start = np.zeros(len(ends), np.int64)
        for bit, ones, zeros in zip(self.bits, self.ones, self.zeros):
            up = (values >> bit & 1).astype(bool)
            start = np.where(up, zeros + ones[start], start - ones[start])
            ends = np.where(up, zeros + ones[ends], ends - ones[ends])
        return ends - start

    def access(self, at: np.ndarray) -> np.ndarray:
        value = np.zeros(len(at), np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            up = ones[at + 1] > ones[at]
            value = value << 1 | up
            at = np.where(up, zeros + ones[at], at - ones[at])
        return value


class FMIndex:
    def __init__(self, symbols: np.ndarray, n_symbols: int):
        places = suffix_array(symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols))])
        self.transform = WaveletMatrix(symbols[places - 1], n_symbols - 1)
        known = places % SAMPLE == 0
        self.known = known
        self.number = np.cumsum(known) - 1
        self.samples = places[known]

    def search(self, patterns: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that start with each pattern; patterns end at the right edge of their row."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.before[-1])
        for step in range(1, patterns.shape[1] + 1):
            on = np.flatnonzero((sizes >= step) & (low < high))
            symbol = patterns[on, -step]
            low[on] = self.before[symbol] + self.transform.rank(symbol, low[on])
            high[on] = self.before[symbol] + self.transform.rank(symbol, high[on])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        found = np.empty(len(rows), np.int64)
        left, walked = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(left):
            there = self.known[rows]
            found[left[there]] = self.samples[self.number[rows[there]]] + walked
            left, rows = left[~there], rows[~there]
            symbol = self.transform.access(rows)
            rows = self.before[symbol] + self.transform.rank(symbol, rows)
            walked += 1
        return found


# --- phrases --------------------------------------------------------------------------------------------------------


class Phrases(NamedTuple):
    """The different windows of some benchmark items."""

    words: np.ndarray  # hashes, one row each, flush right
    sizes: np.ndarray
    first: np.ndarray  # items of window w: item[first[w]:first[w + 1]]
    item: np.ndarray  # NO_ID: an item without id


def phrases_of(item_ids: list[int | None], texts: pa.Array, window: int) -> Phrases:
    words = Words(*text_bytes(texts), LETTERS_DIGITS, lower=True)
    hashes = words.hashes()
    items: dict[tuple, set] = {}
    for d, item in enumerate(item_ids):
        own = hashes[words.first[d] : words.first[d + 1]].tolist()
        for i in range(max(1, len(own) - window + 1) if own else 0):
            items.setdefault(tuple(own[i : i + window]), set()).add(NO_ID if item is None else item)
    table = np.zeros((len(items), window), np.uint64)
    sizes = np.array([len(w) for w in items], np.int64)
    for row, key in zip(table, items):
        row[window - len(key) :] = key
    counts = [len(v) for v in items.values()]
    return Phrases(table, sizes, np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]),
                   np.array([i for v in items.values() for i in sorted(v)], np.int64))


class Hits(NamedTuple):
    hit: np.ndarray  # per word
    pairs: np.ndarray  # rows (text, item), sorted, different


def find(words: Words, phrases: Phrases) -> Hits:
    """All words inside an occurrence of a phrase, and which items have one in which text."""
    none = Hits(np.zeros(len(words), bool), np.zeros((0, 2), np.int64))
    if not len(words) or not len(phrases.sizes):
        return none
    texts = len(words.first) - 1
    vocabulary, number = np.unique(words.hashes(), return_inverse=True)
    # Texts follow one another, each with its own mark (a number below all words) behind it.
    owners = words.owners()
    symbols = np.empty(len(words) + texts, np.int64)
    at = np.arange(len(words)) + owners
    symbols[at] = number + texts
    symbols[words.first[1:] + np.arange(texts)] = np.arange(texts)
    place = np.minimum(np.searchsorted(vocabulary, phrases.words), len(vocabulary) - 1)
    inside = np.arange(phrases.words.shape[1]) >= phrases.words.shape[1] - phrases.sizes[:, None]
    possible = np.flatnonzero(((vocabulary[place] == phrases.words) | ~inside).all(axis=1))
    if not len(possible):
        return none
    index = FMIndex(symbols, texts + len(vocabulary))
    low, high = index.search(place[possible] + texts, phrases.sizes[possible])
    counts = high - low
    which = np.repeat(possible, counts)
    rows = np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    found = index.locate(rows)
    owner = np.searchsorted(words.first[1:] + np.arange(texts), found, "right")
    start = found - owner
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + phrases.sizes[which], -1)
    several = phrases.first[which + 1] - phrases.first[which]
    item = np.repeat(phrases.first[which], several) + np.arange(several.sum()) - np.repeat(np.cumsum(several) - several, several)
    pairs = np.unique(np.stack([np.repeat(owner, several), phrases.item[item]], axis=1), axis=0)
    return Hits(np.cumsum(change)[:-1] > 0, pairs)


# --- operator -------------------------------------------------------------------------------------------------------

HITS = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                  ("items", pa.list_(pa.int64())),
                  ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
HITS_SQL = "n_words long, n_hit long, n_items long, items array<long>, spans array<struct<start: long, end: long>>"


def _spans(hit: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"start": a, "end": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]


def _searcher(block):
    @F.arrow_udf(HITS_SQL)
    def search(texts: pa.Array) -> pa.Array:
        out = []
        for part in slices(pa.RecordBatch.from_arrays([texts], ["text"])):
            words = Words(*text_bytes(part.column("text")), LETTERS_DIGITS, lower=True)
            hits = find(words, block.value)
            counts = words.counts()
            touched = np.concatenate([[0], np.cumsum(hits.hit)])
            n_hit = np.diff(touched[words.first]).tolist()
            where = np.searchsorted(hits.pairs[:, 0], np.arange(len(counts) + 1))
            for d, n in enumerate(counts.tolist()):
                row = {"n_words": n, "n_hit": n_hit[d], "n_items": 0, "items": [], "spans": []}
                if n_hit[d]:
                    row["items"] = [i for i in hits.pairs[where[d] : where[d + 1], 1].tolist() if i != NO_ID]
                    row["n_items"] = len(row["items"])
                    row["spans"] = _spans(hits.hit[words.first[d] : words.first[d + 1]])
                out.append(row)
        return pa.array(out, HITS)

    return search


def _merged(blocks: pa.Array) -> pa.Array:
    """What several blocks found in each text, as one."""
    out = []
    for parts in blocks.to_pylist():
        hit = np.zeros(parts[0]["n_words"], bool)
        for part in parts:
            for span in part["spans"]:
                hit[span["start"] : span["end"]] = True
        items = sorted({i for part in parts for i in part["items"]})
        out.append({"n_words": len(hit), "n_hit": int(hit.sum()), "n_items": len(items), "items": items, "spans": _spans(hit)})
    return pa.array(out, HITS)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = ONE_IN,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of the documents as a struct ``row``, and what of them is in ``benchmark(item_id, text)``.

    Words are runs of ASCII letters and digits and of anything that is not ASCII, A-Z in lower case. A window is
    ``window`` words of an item in a row, or all of a shorter item; an item without words has none. ``n_words`` and
    ``n_hit`` count the words of a document and those inside any occurrence of a window, ``spans`` are the latter as
    merged ranges of word numbers, ``items`` the ids of items with windows there in order, ``n_items`` their number.
    ``contaminated``: at least one word is hit, and at least one in ``one_in``.

    A missing text has no words. Windows of items without id are searched for but not listed. Repeated items count
    once, repeated documents each. With an empty benchmark nothing is hit, and an empty table of documents gives no row.
    Other columns of either table are not looked at.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // block_bytes + 1
    of = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = []
    for number in range(blocks):
        rows = items.where(of == number).toArrow()
        phrases = phrases_of(rows["item_id"].to_pylist(), rows["text"].combine_chunks(), window)
        found.append(_searcher(spark.sparkContext.broadcast(phrases))(F.col("row.text")))
    whole = docs.select(F.struct("*").alias("row"))
    hits = found[0] if blocks == 1 else F.arrow_udf(_merged, HITS_SQL)(F.array(*found))
    hit = (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))
    return whole.select("row", hits.alias("hits")).select("row", "hits.*").withColumn("contaminated", hit)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = ONE_IN) -> DataFrame:
    """The documents that are not contaminated, unchanged."""
    return contamination(docs, benchmark, window, one_in).where(~F.col("contaminated")).select("row.*")
