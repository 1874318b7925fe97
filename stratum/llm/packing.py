"""Packing of tokenized documents into sequences by the sum-of-squares rule.

A document longer than a sequence is cut into full pieces, the first one shorter. Pieces are dealt over shards of
bounded size, as the rule places one piece after another, and each shard is packed in one task: a piece goes where the
sum, over all residual gaps, of the squared number of open sequences with that gap becomes smallest. The rule needs
only how many sequences are open per gap, so a step costs one look at the gaps.

The rule keeps sequences of all gaps open for pieces to come. When the last piece is placed nothing comes any more: the
sequences of the shard that are still open are emptied and their pieces placed anew by best fit, the largest first.
"""

from __future__ import annotations

import bisect
import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.words import slices

LENGTH = 2048
END = 0
PIECES_PER_SHARD = 16_384
#: With their ids, of 4 bytes each, shards are smaller.
PIECES_WITH_IDS = 4_096
BYTES_PER_TOKEN = 4


# --- tokens ---------------------------------------------------------------------------------------------------------


@functools.cache
def encoder(ranks: str, pattern: str, specials: tuple[tuple[str, int], ...]):
    """A byte-level BPE from a file of ranks; one per worker. Special strings in a text become their ids."""
    import base64

    import tiktoken

    with open(ranks, "rb") as file:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=table, special_tokens=dict(specials))


def _token_rows(load, length: int, end: int):
    """Pieces of each text. ``load()`` gives a function from a text to its ids."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load()
        for batch in batches:
            others = [c for c in batch.schema.names if c != "text"]
            for part in slices(batch):
                source, piece, start, ids = [], [], [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    tokens = np.append(encode(text or ""), end).astype("<u4")
                    edges = [0, *range(len(tokens) % length or length, len(tokens) + 1, length)]
                    for k, (a, b) in enumerate(zip(edges, edges[1:])):
                        source.append(i)
                        piece.append(k)
                        start.append(a)
                        ids.append(tokens[a:b].tobytes())
                take = pa.array(source, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).take(take) for c in others] + [
                        pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    [*others, "piece", "start", "length", "ids"])

    return rows


def byte_bpe(name: str = "byte_bpe_50k.tiktoken", specials: tuple[tuple[str, int], ...] = (("<|endoftext|>", 50256),)):
    """Encoder of a public vocabulary; the ids are those that the ``tokenizers`` library gives for the same vocabulary."""

    def load():
        import public_tokenizers

        found = encoder(public_tokenizers.path(name), public_tokenizers.PATTERN, specials)
        return lambda text: found.encode_to_numpy(text, allowed_special="all")

    return load


def tokenized(docs: DataFrame, load=None, length: int = LENGTH, end: int = END) -> DataFrame:
    """``doc_id, piece, start, length, ids`` of every document; ``ids`` are little-endian unsigned 32-bit numbers.

    ``load`` is called once per task and returns a function from text to ids; the end id follows each document. A
    missing or empty text is the end id alone.
    """
    schema = T.StructType([docs.schema["doc_id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())])
    return docs.select("doc_id", "text").mapInArrow(_token_rows(load or byte_bpe(), length, end), schema)


# --- packing --------------------------------------------------------------------------------------------------------


class SumOfSquares:
    """Open sequences by gap. Sequences are numbered from 0 as they are opened."""

    def __init__(self, length: int):
        self.length = length
        self.open: list[list[int]] = [[] for _ in range(length + 1)]
        self.count = np.zeros(length + 1, np.int64)  # index: gap; full sequences are not counted
        self.sequences = 0

    def place(self, size: int) -> tuple[int, int]:
        """The sequence for a piece, and its place there. Ties go to the smallest gap, a new sequence comes last."""
        length, count = self.length, self.count
        # What changes: the gap g loses a sequence, the gap g - size gets one (none, if that is 0).
        gaps = np.flatnonzero(count[size:]) + size
        best, gap = (2 * count[length - size] + 1 if size < length else 0), length
        if len(gaps):
            left = count[gaps - size]
            change = np.where(gaps == size, 0, 2 * left + 1) - 2 * count[gaps] + 1
            k = int(change.argmin())
            if change[k] <= best:
                gap = int(gaps[k])
        if gap == length:
            number = self.sequences
            self.sequences += 1
        else:
            number = self.open[gap].pop()
            count[gap] -= 1
        if gap > size:
            self.open[gap - size].append(number)
            count[gap - size] += 1
        return number, length - gap


def best_fit(sizes: list[int], length: int, number: int) -> Iterator[tuple[int, int]]:
    """Sequence (from ``number`` on) and place of each piece: the smallest gap that holds it, else a new sequence."""
    gaps: list[tuple[int, int]] = []
    for size in sizes:
        at = bisect.bisect_left(gaps, (size, -1))
        if at < len(gaps):
            gap, sequence = gaps.pop(at)
        else:
            gap, sequence, number = length, number, number + 1
        if gap > size:
            bisect.insort(gaps, (gap - size, sequence))
        yield sequence, length - gap


def pack_pieces(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and place of each piece. Long pieces go first and leave short ones for the gaps."""
    order = np.argsort(-sizes, kind="stable")
    rule = SumOfSquares(length)
    number, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for row in order.tolist():
        number[row], offset[row] = rule.place(int(sizes[row]))
    left = np.bincount(number, weights=sizes)[number] < length if len(sizes) else np.zeros(0, bool)
    again = order[left[order]]
    places = list(best_fit(sizes[again].tolist(), length, rule.sequences))
    if len({sequence for sequence, _ in places}) <= len(set(number[again].tolist())):
        for row, place in zip(again.tolist(), places):
            number[row], offset[row] = place
    return number, offset


def _pack_shard(length: int):
    def pack(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("order").to_numpy(), kind="stable")  # the result must not depend on arrival
        table = table.take(pa.array(order))
        number, offset = pack_pieces(table.column("length").to_numpy(), length)
        shard = table.column("shard").to_numpy()
        names = [c for c in table.schema.names if c not in ("shard", "order")]
        return table.select(names).append_column("sequence_id", pa.array(shard << 32 | number)).append_column(
            "offset", pa.array(offset))

    return pack


def pack(pieces: DataFrame, shards: int, length: int = LENGTH) -> DataFrame:
    """The pieces, of 1 to ``length`` tokens, with ``sequence_id`` and ``offset``.

    Numbers of sequences are unique but not dense. Offsets have no gaps from 0. Repeated rows are pieces of their own.
    """
    columns = [f"`{c}`" for c in pieces.columns]
    order = F.xxhash64("doc_id", "piece", "start", "length")
    keyed = pieces.select(*columns, order.alias("order"), F.pmod(order, F.lit(shards)).alias("shard"))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return keyed.groupBy("shard").applyInArrow(_pack_shard(length), schema)


def shards_for(docs: DataFrame, length: int = LENGTH, pieces: int = PIECES_PER_SHARD) -> int:
    """How many shards keep a shard near ``pieces`` pieces: one piece a document, and more for long ones."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
    return int((row["n"] + (row["size"] or 0) // (BYTES_PER_TOKEN * length)) // pieces + 1)


def packed(docs: DataFrame, load=None, length: int = LENGTH, end: int = END, with_ids: bool = True) -> DataFrame:
    """The documents' pieces in sequences: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).

    Missing and empty texts are documents of one token. Rows without doc_id and repeated rows are packed like others. An
    empty table gives no row.
    Extra columns are not looked at.
    """
    pieces = tokenized(docs, load, length, end).withColumn("ids_crc32", F.crc32("ids"))
    shards = shards_for(docs, length, PIECES_WITH_IDS if with_ids else PIECES_PER_SHARD)
    return pack(pieces if with_ids else pieces.drop("ids"), shards, length)
