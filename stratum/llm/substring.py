"""Substring dedup by suffix automata of reference shards.

A window is a run of ``length`` consecutive words. A window that occurs at two places of the corpus is cut from both.

Broadcasting an automaton of every shard to every document would be quadratic, so documents meet only the shards that
can hold a match. The *anchor* of a window is the run of ``length // 4`` words in it with the smallest hash, the last
one among equals: a function of the window's words, so equal windows have equal anchors. Consecutive windows with one
anchor form a *segment*, and each window lies in exactly one segment. Segments whose anchor occurs once are done. The
others go, each different segment once and with its number of copies, to the shard of their anchor. There they are
the reference: a suffix automaton of them is built, and every segment is streamed through it. The number of places of
the state that holds the last ``length`` words says whether that window occurs again. Windows of an anchor with very
many different segments (a passage in a third of all documents, with something else around it each time) are sent one
by one, to the shard of the window instead, so no shard depends on how often an anchor occurs.

Words are compared as strings inside a shard; anchors, segments and documents meet by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.tables import row_key, stored
from stratum.llm.words import Words, signed, slices, stretch_hashes, text_bytes

LENGTH = 35
#: More different segments than this under one anchor, and their windows are compared one by one.
HOT_SEGMENTS = 1000
DOCUMENTS_PER_SHARD = 400


# --- segments -------------------------------------------------------------------------------------------------------


def anchor_words(length: int) -> int:
    """Words of an anchor; at most 63 windows may share one, so that a long holds a bit for each."""
    return max(1, length // 4, length - 62)


class Segments(NamedTuple):
    anchor: np.ndarray  # hash of the anchor
    seg: np.ndarray  # hash of the segment's words
    first: np.ndarray  # first word
    windows: np.ndarray  # number of windows; the segment has length - 1 words more
    owner: np.ndarray  # text


def last_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest of ``values[i : i + width]`` is, for each i; the last place among equals."""
    at, span = np.arange(len(values)), 1
    while span < width and len(at):
        step = min(span, width - span)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] <= values[left], right, left)
        span += step
    return at


def segments_of(words: Words, length: int = LENGTH) -> Segments:
    size = anchor_words(length)
    n, owners = len(words), words.owners()
    if n < length:
        none = np.zeros(0, np.int64)
        return Segments(none, none, none, none, none)
    hashes = words.hashes()
    runs = np.arange(n - size + 1)
    runs = stretch_hashes(hashes, runs, runs + size)
    start = np.arange(n - length + 1)
    start = start[owners[start] == owners[start + length - 1]]
    anchor = last_smallest(runs, length - size + 1)[start]
    new = np.flatnonzero(np.diff(anchor, prepend=-1))
    windows = np.diff(np.append(new, len(start)))
    first = start[new]
    seg = stretch_hashes(hashes, first, first + windows + length - 1)
    return Segments(signed(runs[anchor[new]]), signed(seg), first, windows, owners[first])


def _segment_rows(length: int):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = segments_of(Words(*text_bytes(part.column("text"))), length)
                key = part.column("key").to_numpy()
                yield pa.RecordBatch.from_pydict({"key": key[found.owner], "anchor": found.anchor, "seg": found.seg})

    return rows


# --- reference shards -----------------------------------------------------------------------------------------------


class SuffixAutomaton:
    """All substrings of weighted sequences, and how often each occurs."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.size = [0]
        self.places = [0]

    def _state(self, size: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.size.append(size)
        self.places.append(0)
        return len(self.size) - 1

    def _split(self, p: int, symbol: int, q: int) -> int:
        """A state for the part of ``q`` that is reached from ``p``."""
        clone = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list[int], weight: int) -> None:
        follow, link, size, last = self.next, self.link, self.size, 0
        for symbol in sequence:
            q = follow[last].get(symbol)
            if q is not None:
                last = q if size[q] == size[last] + 1 else self._split(last, symbol, q)
            else:
                new, p = self._state(size[last] + 1, {}, 0), last
                while p >= 0 and symbol not in follow[p]:
                    follow[p][symbol] = new
                    p = link[p]
                if p >= 0:
                    q = follow[p][symbol]
                    link[new] = q if size[q] == size[p] + 1 else self._split(p, symbol, q)
                last = new
            self.places[last] += weight

    def count(self) -> None:
        """To be called once, after the last sequence: a state occurs wherever one that it is a suffix of does."""
        for state in np.argsort(np.array(self.size), kind="stable")[:0:-1].tolist():
            self.places[self.link[state]] += self.places[state]

    def repeated(self, sequence: list[int], length: int) -> int:
        """Bit i is set if the ``length`` symbols from i on occur twice. The sequence is one of those added."""
        state, found = 0, 0
        for end, symbol in enumerate(sequence, 1):
            state = self.next[state][symbol]
            while self.size[self.link[state]] >= length:
                state = self.link[state]
            if end >= length and self.places[state] > 1:
                found |= 1 << (end - length)
        return found


def _shard_marks(length: int):
    def marks(table: pa.Table) -> pa.Table:
        rows = {}
        for anchor, seg, offset, n, text in zip(*(table.column(c).to_pylist() for c in ("anchor", "seg", "offset", "n", "text"))):
            rows[seg, offset] = (anchor, text, n)
        copies: dict[tuple, int] = {}  # windows sent one by one can be equal though their segments differ
        kinds: dict[int, set] = {}
        for anchor, text, n in rows.values():
            copies[anchor, text] = copies.get((anchor, text), 0) + n
            kinds.setdefault(anchor, set()).add(text)
        ids: dict[str, int] = {}
        sequences = {}
        automaton = SuffixAutomaton()
        for (anchor, text), n in copies.items():
            if len(kinds[anchor]) > 1:
                sequences[text] = sequence = [ids.setdefault(w, len(ids)) for w in text.split(" ")]
                automaton.add(sequence, n)
        automaton.count()
        out = {"seg": [], "mask": []}
        for (seg, offset), (anchor, text, _) in rows.items():
            if copies[anchor, text] > 1:  # every window of it occurs as often
                mask = (1 << (text.count(" ") + 2 - length)) - 1
            else:
                mask = automaton.repeated(sequences[text], length) if text in sequences else 0
            if mask:
                out["seg"].append(seg)
                out["mask"].append(mask << offset)
        return pa.table(out, pa.schema([("seg", pa.int64()), ("mask", pa.int64())]))

    return marks


def _reference_rows(length: int, shards: int):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = Words(*text_bytes(part.column("text")))
                found = segments_of(words, length)
                hashes = words.hashes()
                joined, starts, ends = words.joined()
                wanted = [{w["seg"]: w for w in row} for row in part.column("wanted").to_pylist()]
                out = {name: [] for name in ("shard", "anchor", "seg", "offset", "n", "text")}
                for anchor, seg, first, windows, owner in zip(*(x.tolist() for x in found)):
                    want = wanted[owner].pop(seg, None)
                    if want is None:
                        continue
                    pieces = [(0, windows, anchor)]
                    if want["hot"]:
                        each = first + np.arange(windows)
                        own = signed(stretch_hashes(hashes[first : first + windows + length - 1], each - first, each - first + length))
                        pieces = [(i, 1, int(h)) for i, h in enumerate(own)]
                    for offset, count, home in pieces:
                        a = first + offset
                        text = joined[starts[a] : ends[a + count + length - 2]].decode("utf-8", "surrogatepass")
                        for name, value in zip(out, (home % shards, home, seg, offset, want["n"], text)):
                            out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, REFERENCE)

    return emit


REFERENCE = pa.schema([("shard", pa.int64()), ("anchor", pa.int64()), ("seg", pa.int64()), ("offset", pa.int32()),
                       ("n", pa.int64()), ("text", pa.string())])


# --- operator -------------------------------------------------------------------------------------------------------


def covered(words: Words, marks: list, length: int) -> np.ndarray:
    """Which words lie in a repeated window, from the marks (segment, windows) of each text."""
    found = segments_of(words, length)
    change = np.zeros(len(words) + 1, np.int64)
    by_text = [{m["seg"]: m["mask"] for m in row} if row else None for row in marks]
    for seg, first, owner in zip(found.seg.tolist(), found.first.tolist(), found.owner.tolist()):
        mask = by_text[owner].get(seg, 0) if by_text[owner] else 0
        while mask:
            start = (mask & -mask).bit_length() - 1
            run = ((mask >> start) + 1 & ~(mask >> start)).bit_length() - 1  # windows in a row
            change[first + start] += 1
            change[first + start + run + length - 1] -= 1
            mask &= ~(((1 << run) - 1) << start)
    return np.cumsum(change)[:-1] > 0


def _cut(texts: pa.Array, marks: pa.Array, length: int, joined: bool) -> pa.Array:
    out = {"n_words": [], "n_removed": [], "kept": []}
    batch = pa.RecordBatch.from_arrays([texts, marks], ["text", "marks"])
    for part in slices(batch):
        data, bounds = text_bytes(part.column("text"))
        words = Words(data, bounds)
        gone = covered(words, part.column("marks").to_pylist(), length)
        removed = np.concatenate([[0], np.cumsum(gone)])
        out["n_words"] += words.counts().tolist()
        out["n_removed"] += np.diff(removed[words.first]).tolist()
        if joined:
            line, starts, ends = words.joined()
            line = np.frombuffer(line, np.uint8)
            stay = np.repeat(~gone, ends - starts + 1)
            at = np.concatenate([[0], np.cumsum(stay)])
            left, edges = line[stay].tobytes(), at[np.append(starts, len(line))[words.first]]
            out["kept"] += [left[a : max(a, b - 1)].decode() for a, b in zip(edges, edges[1:])]
        else:
            # A removed word takes the space behind it along.
            change = np.zeros(len(data) + 1, np.int64)
            behind = np.append(words.starts, len(data))[1:]
            last = words.first[1:][words.counts() > 0] - 1
            behind[last] = bounds[1:][words.counts() > 0]
            change[words.starts[gone]] += 1
            change[behind[gone]] -= 1
            stay = np.cumsum(change)[:-1] == 0
            at = np.concatenate([[0], np.cumsum(stay)])[bounds]
            left = data[stay].tobytes()
            out["kept"] += [left[a:b].decode() for a, b in zip(at, at[1:])]
    return pa.StructArray.from_arrays(
        [pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["kept"], pa.string())],
        ["n_words", "n_removed", "kept"])


def _cutter(length: int, joined: bool):
    @F.arrow_udf("n_words long, n_removed long, kept string")
    def cut(texts: pa.Array, marks: pa.Array) -> pa.Array:
        return _cut(texts, marks, length, joined)

    return cut


def repeated_windows(keyed: DataFrame, length: int, n_documents: int, hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """For ``keyed(key, text, ...)`` the ``marks`` of each key that has any: segments and which windows of them recur."""
    rows = keyed.select("key", "text").mapInArrow(_segment_rows(length), "key long, anchor long, seg long")
    # A stored side, or one with a shuffle of its own, lets Spark split the other side where a key is hot.
    twice = stored(rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"))
    rows = stored(rows.join(twice, "anchor"))
    kinds = stored(rows.groupBy("anchor", "seg").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("key")))
    hot = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > hot_segments)
    kinds = kinds.join(hot, "anchor", "left")
    wanted = kinds.groupBy("key").agg(
        F.collect_list(F.struct("seg", "n", F.col("kinds").isNotNull().alias("hot"))).alias("wanted"))
    shards = n_documents // DOCUMENTS_PER_SHARD + 1
    schema = "shard long, anchor long, seg long, offset int, n long, text string"
    reference = keyed.join(wanted, "key").mapInArrow(_reference_rows(length, shards), schema)
    marks = reference.groupBy("shard").applyInArrow(_shard_marks(length), "seg long, mask long")
    marks = marks.groupBy("seg").agg(F.bit_or("mask").alias("mask")).repartition(F.xxhash64("seg"))
    return rows.join(marks, "seg").groupBy("key").agg(F.collect_set(F.struct("seg", "mask")).alias("marks"))


def dedup_substrings(docs: DataFrame, length: int = LENGTH, joined: bool = False,
                     hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """All columns of the documents as a struct ``row``, and ``n_words``, ``n_removed`` and ``kept``.

    Words are runs of anything but ASCII white space, case kept. Each word covered by a window of ``length`` words
    that occurs at another place, of the same document or another one, is removed. ``kept`` is the text without these
    words and the space behind each, otherwise unchanged; with ``joined`` it is the words that stay, joined by one
    space. Repeated rows are places of their own, so they remove one another. A missing text has no words and an empty
    ``kept``. Documents shorter than a window stay as they are. An empty table gives no row.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index("text")]
    keyed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)],
                        row_key().alias("key")).withColumnRenamed(text, "text")
    marks = repeated_windows(keyed, length, docs.count(), hot_segments)
    cut = _cutter(length, joined)(F.col("text"), F.col("marks")).alias("cut")
    row = F.struct(*[F.col("text" if n == text else n).alias(c) for c, n in zip(docs.columns, names)]).alias("row")
    return keyed.join(marks, "key", "left").select(row, cut).select("row", "cut.*")


def shortened(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with what recurs cut from their texts; a text of which nothing is cut does not change."""
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    columns = [F.when(F.col("n_removed") > 0, new[c]).otherwise(F.col(f"row.{c}")).alias(c) if c in new
               else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return dedup_substrings(docs, length).select(*columns)
