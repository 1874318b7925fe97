"""Words of whole texts as numpy arrays, for operators that run inside Arrow batches.

A batch of texts is one run of UTF-8 bytes. Both word rules used here look at ASCII bytes only, so a table of 256
entries finds every word without decoding. Words and word sequences are compared by 64-bit hashes: sums of table
values times powers of an odd number, so the hash of any stretch is the difference of two prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240501))
_BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # 5 modulo 8, so its powers have the longest period
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _space_rule() -> np.ndarray:
    """True for bytes of ``[^\\x20\\x09-\\x0D]+``."""
    rule = np.ones(256, bool)
    rule[[0x20, *range(0x09, 0x0E)]] = False
    return rule


def _letter_digit_rule() -> np.ndarray:
    """True for bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, that is 0-9, a-z and everything above ASCII."""
    rule = np.zeros(256, bool)
    rule[0x30:0x3A] = rule[0x61:0x7B] = rule[0x80:] = True
    return rule


SPACED = _space_rule()
LETTERS_DIGITS = _letter_digit_rule()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits, one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, grown on demand and kept per worker."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def reach(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 16)
            for name, factor in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))
        return cls.up, cls.down


def stretch_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``values[s:e]`` for each stretch; equal stretches have equal hashes wherever they lie."""
    up, down = _Powers.reach(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True within each text, and the first run of each text (one more at the end)."""
    padded = np.zeros(len(inside) + 2, bool)
    padded[1:-1] = inside
    starts = inside & ~padded[:-2]
    ends = inside & ~padded[2:]
    cut = bounds[(bounds > 0) & (bounds < len(inside))]
    starts[cut] |= inside[cut]
    ends[cut - 1] |= inside[cut - 1]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, bounds)


class Words:
    """The words of some texts. ``first[d]:first[d + 1]`` are the words of text ``d``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, rule: np.ndarray = SPACED, lower: bool = False):
        self.data = LOWER[data] if lower else data
        self.starts, self.ends, self.first = runs(rule[self.data], bounds)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        return stretch_hashes(_BYTE_VALUES[self.data], self.starts, self.ends)

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The words with one space after each, and where each word then starts and ends."""
        lengths = self.ends - self.starts
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, np.uint8)
        if len(ends):
            source = np.arange(len(out)) + np.repeat(self.starts - starts, lengths + 1)
            inside = np.ones(len(out), bool)
            inside[ends] = False
            out[inside] = self.data[source[inside]]
        return out.tobytes(), starts, ends


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts behind one another, and the byte at which each starts (one more at the end)."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts take about ``size`` bytes; a longer text is a run of its own."""
    _, bounds = text_bytes(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + size, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
