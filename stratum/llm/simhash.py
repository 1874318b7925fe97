"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into segments of 22, 21 and 21 bits, each read as a word of the perfect binary Golay
code (23, 12, 7). Every word lies within three bits of one codeword. The *keys* of a segment are the codewords of the
word itself and of its 23 neighbours at one bit: one key or six. Two words one bit apart: the codeword of either is a
key of the other. Two words two bits apart share a key, that of a word between them.

Four differing bits over three segments leave, in rising order of their errors, either a segment without error and one
with at most two, or two segments with one error each. So a pair meets under

* an exact segment and a key of another one (ordered pairs of segments), or
* two segments' keys at once, the smaller fingerprint with its two codewords, the larger with all its keys.

Keys find candidates; the join itself checks the true bit distance and lets a pair through under one of its keys only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.components import components
from stratum.llm.tables import row_key, stored
from stratum.llm.words import SPACED, Words, slices, text_bytes
from stratum.llm.xxh64 import xxh64

SHINGLE = 4
MAX_BITS = 4
SEED = 42

# Fixed value: the generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 of the code.
GENERATOR = 0b101011100011
CODE_BITS = 23
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
EXACT_CASES = tuple((i, j) for i in range(3) for j in range(3) if i != j)
PAIR_CASES = ((0, 1), (0, 2), (1, 2))


# --- fingerprints ---------------------------------------------------------------------------------------------------


def shingle_hashes(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle, and how many each text has. A shorter text is one shingle, one without words none."""
    joined, starts, ends = words.joined()
    counts = words.counts()
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.repeat(words.first[:-1], shingles) + _within(shingles)
    last = np.minimum(first + size, np.repeat(words.first[1:], shingles)) - 1
    return xxh64(joined, starts[first], ends[last], SEED), shingles


def _within(counts: np.ndarray) -> np.ndarray:
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per run of ``counts`` hashes the word of bits that are set in over half of them; 0 for an empty run."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    counts = counts[full]
    # Eight bits at a time are counted side by side in the bytes of a word, which hold up to 255.
    parts = -(-counts // 255)
    starts = np.repeat(np.cumsum(counts) - counts, parts) + 255 * _within(parts)
    bits = np.empty((len(starts), 8, 8), np.int64)
    for j in range(8):
        lanes = (hashes >> np.uint64(j)) & np.uint64(0x0101010101010101)
        bits[:, :, j] = np.add.reduceat(lanes, starts).astype("<u8").view(np.uint8).reshape(-1, 8)
    sums = np.add.reduceat(bits.reshape(-1, 64), np.cumsum(parts) - parts, axis=0)
    out[full] = np.packbits(2 * sums > counts[:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints_of(texts: pa.Array, size: int = SHINGLE) -> np.ndarray:
    found = [np.zeros(0, np.uint64)]
    for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]), size=1 << 20):
        words = Words(*text_bytes(part.column("text")), SPACED, lower=True)
        found.append(majority(*shingle_hashes(words, size)))
    return np.concatenate(found)


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """The 64-bit SimHash of a text as a long. A missing or empty text has fingerprint 0."""

    @F.arrow_udf(T.LongType())
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(fingerprints_of(texts, size).view(np.int64))

    return of(text)


# --- Golay keys -----------------------------------------------------------------------------------------------------


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder modulo the generator, bit by bit from the top."""
    rest = words.astype(np.int64)
    for bit in range(CODE_BITS - 1, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


def _error_table() -> np.ndarray:
    """The lightest error of each of the 2,048 syndromes; all errors of up to three bits have different ones."""
    one = 1 << np.arange(CODE_BITS)
    two = (one[:, None] | one[None, :]).ravel()
    three = (two[:, None] | one[None, :]).ravel()
    errors = np.unique(np.concatenate([[0], one, two, three]))
    table = np.zeros(2048, np.int64)
    table[_syndromes(errors)] = errors
    return table


class Golay:
    errors = _error_table()
    #: Syndromes are linear: that of a word is the exclusive or of those of its parts.
    low = _syndromes(np.arange(1 << 12))
    high = _syndromes(np.arange(1 << 11) << 12)

    @classmethod
    def decode(cls, words: np.ndarray) -> np.ndarray:
        """Index (12 bits) of the codeword within three bits."""
        return (words ^ cls.errors[cls.low[words & 0xFFF] ^ cls.high[words >> 12]]) >> 11

    @classmethod
    def keys(cls, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of up to six different keys, the word's own codeword first, and which of them count."""
        own = cls.decode(words)
        flips = words[:, None] ^ (1 << np.arange(CODE_BITS))
        others = np.sort(cls.decode(flips.ravel()).reshape(-1, CODE_BITS), axis=1)
        new = (others != own[:, None]) & (np.diff(others, axis=1, prepend=-1) != 0)
        order = np.argsort(~new, axis=1, kind="stable")[:, :5]
        keys = np.concatenate([own[:, None], np.take_along_axis(others, order, 1)], axis=1)
        used = np.concatenate([np.ones((len(words), 1), bool), np.take_along_axis(new, order, 1)], axis=1)
        return keys, used


def key_rows(fingerprints: np.ndarray) -> dict[str, np.ndarray]:
    """All rows ``key, fp, lead, own`` of these fingerprints.

    The upper bits of a key are its case. ``lead`` rows may stand on the smaller side of a pair; ``own`` rows hold the
    codeword of the segment itself.
    """
    values = [(fingerprints >> np.uint64(a)).astype(np.int64) & ((1 << n) - 1) for a, n in SEGMENTS]
    golay = [Golay.keys(v) for v in values]
    key, fp, lead, own = [], [], [], []
    for case, (i, j) in enumerate(EXACT_CASES):
        keys, used = golay[j]
        rows, column = np.nonzero(used)
        key.append(case << 40 | values[i][rows] << 12 | keys[rows, column])
        fp.append(rows)
        lead.append(np.ones(len(rows), bool))
        own.append(column == 0)
    for case, (i, j) in enumerate(PAIR_CASES, len(EXACT_CASES)):
        both = golay[i][1][:, :, None] & golay[j][1][:, None, :]
        rows, ci, cj = np.nonzero(both)
        key.append(case << 40 | golay[i][0][rows, ci] << 12 | golay[j][0][rows, cj])
        fp.append(rows)
        lead.append((ci == 0) & (cj == 0))
        own.append(lead[-1])
    rows = np.concatenate(fp)
    return {"key": np.concatenate(key), "fp": fingerprints[rows].view(np.int64), "lead": np.concatenate(lead),
            "own": np.concatenate(own)}


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column("fp").to_numpy().view(np.uint64)
        for k in range(0, len(fps), 4096):
            yield pa.RecordBatch.from_pydict(key_rows(fps[k : k + 4096]))


def _found_here(max_bits: int) -> Column:
    """True for a pair under exactly one case (and for two errors beside an exact segment under few keys of it)."""
    x = F.col("l.fp").bitwiseXOR(F.col("r.fp"))
    e = []
    for a, n in SEGMENTS:
        mask = ((1 << n) - 1) << a
        e.append(F.bit_count(x.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))))
    case = F.shiftright(F.col("l.key"), 40)
    here = F.lit(False)
    for number, (i, j) in enumerate(EXACT_CASES):
        ok = (case == number) & (e[i] == 0) & (e[j] <= 2) & (F.col("l.own") | (e[j] == 2))
        for earlier in range(i):
            ok &= e[earlier] > 0
        other = 3 - i - j
        if other < j:
            ok &= e[other] > 2
        here |= ok
    for number, (i, j) in enumerate(PAIR_CASES, len(EXACT_CASES)):
        ok = (case == number) & (e[i] == 1) & (e[j] == 1)
        if j == 2:
            ok &= e[1 - i] > 1  # else the two first segments already have one error each
        here |= ok & (e[0] > 0) & (e[1] > 0) & (e[2] > 0)
    return (F.col("l.fp") < F.col("r.fp")) & (F.bit_count(x) <= max_bits) & here


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """All pairs ``a < b`` of different fingerprints (column ``fp``, unique) at most ``max_bits`` apart.

    The keys guarantee every pair up to four bits, so ``max_bits`` may be 0 to 4.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the keys are complete for up to 4 bits")
    keys = stored(fingerprints.select("fp").mapInArrow(_key_batches, "key long, fp long, lead boolean, own boolean"))
    left, right = keys.where("lead").alias("l"), keys.select("key", "fp").alias("r")
    pairs = left.join(right, (F.col("l.key") == F.col("r.key")) & _found_here(max_bits))
    return pairs.select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b")).distinct()


# --- operator -------------------------------------------------------------------------------------------------------


def classes(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """For ``rows(doc_id, fp)`` each fingerprint with its ``root`` (a fingerprint) and ``component_id``, the smallest doc_id there."""
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes, max_bits))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    Fingerprints at most ``max_bits`` apart are linked; ``component_id`` is the smallest doc_id reachable over links.
    Texts that are missing, empty or without words have fingerprint 0, which links like any other. Rows without doc_id
    take part and get the smallest id of their component (null if there is none). Repeated rows are returned as often
    as they come. An empty table gives no row. Extra columns are not looked at.
    """
    rows = stored(docs.select("doc_id", fingerprint(F.col("text"), size).alias("fp")))
    return rows.join(classes(rows, max_bits), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents, one of each component: that with the smallest doc_id (then by a hash of id and text).

    All columns stay as they are. Rows without doc_id are kept only if their component has none with one. An empty table
    gives no row.
    """
    whole = docs.select(F.struct("*").alias("row"))
    keyed = whole.select("row", row_key("row.doc_id", "row.text").alias("k"))
    rows = stored(keyed.select(F.col("row.doc_id").alias("doc_id"), "k", fingerprint(F.col("row.text"), size).alias("fp")))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k")).alias("best")
    kept = rows.groupBy("fp").agg(best).join(classes(rows, max_bits), "fp")
    kept = kept.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.k").alias("k"))
    left = keyed.join(kept, "k", "left_semi")
    return left.groupBy("k").agg(F.first("row").alias("row")).select("row.*")
