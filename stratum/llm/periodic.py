"""Periodic runs of words, found by minimizers at several scales.

A *run* is a stretch of words with smallest period ``q`` (words ``q`` apart are equal) that holds at least two periods
and can be extended on neither side. All runs of a text are found:

* Stretches of 1, 2, 4, ... words get *names*: equal stretches of one text have equal names, and a stretch that occurs
  only once in its text has none. What has no name at one scale is not looked at again at the next, so for ordinary prose
  little is left after a few scales.
* Periods below ``2 * SMALLEST`` come from a direct scan of each lag over the names of four words.
* At scale ``L = SMALLEST, 2 * SMALLEST, ...``, for periods from ``2L`` to ``4L``, the first smallest (shuffled) name of
  every window of ``L`` places is a minimizer. A run's first window and the same window one period on have the same
  minimizer, so that pairs of equal minimizers at a distance of the scale's periods are the seeds.
* Inside a run of period at most ``L / 4`` every place looks alike, and nearly all pairs are equal. Places in such runs,
  known from smaller scales, are no minimizers; the first place behind them is one. Equal minimizers then lie more than
  ``L / 4`` apart, so that a minimizer's partner is among the next ``NEXT`` equal ones.
* What that leaves out are runs of exponent about two whose halves are themselves long runs of one small period, side by
  side. Pairs of such neighbours give their seeds: the lags that bring their phases together.

A seed, a place and a lag, is extended to both sides by halving steps over the names. Seeds with a multiple of the
period end up at the same stretch as those with the period itself, so of equal stretches the smallest lag counts.

A text is worked on as a whole inside one task, in time n log n and a few dozen bytes per word and scale; nothing is
shuffled. Words are compared by 64-bit hashes, longer stretches by names only.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.words import Words, mix, slices, text_bytes

LEAST = 12
SMALLEST = 16
#: Equal minimizers lie over L / 4 apart and periods are below 4L.
NEXT = 16
_DIRECT = 2  # scale of the direct scans: names of four words
_NONE = np.iinfo(np.int64).max


class Runs(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    periods: np.ndarray

    def where(self, chosen: np.ndarray) -> Runs:
        return Runs(*(x[chosen] for x in self))


# --- names ----------------------------------------------------------------------------------------------------------


def _named(keys: np.ndarray) -> np.ndarray:
    """Numbers from 0 for keys that occur twice or more, -1 for the others."""
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    often = counts > 1
    return np.where(often, np.cumsum(often) - 1, -1).astype(np.int32)[which]


def word_names(words: Words) -> np.ndarray:
    """Names of all words, each text followed by one place without a name."""
    owners = words.owners()
    names = np.full(len(words) + len(words.first) - 1, -1, np.int32)
    with np.errstate(over="ignore"):
        names[np.arange(len(words)) + owners] = _named(words.hashes() + mix(owners.astype(np.uint64)))
    return names


def scales(names: np.ndarray) -> list[np.ndarray]:
    """Names of the stretches of 1, 2, 4, ... words that begin at each place, as long as any occurs twice."""
    out, span = [names], 1
    while True:
        at = np.flatnonzero(names[: max(0, len(names) - span)] >= 0)
        at = at[names[at + span] >= 0]
        found = _named(names[at] * np.int64(len(names)) + names[at + span])
        if not (found >= 0).any():
            return out
        names = np.full(len(names), -1, np.int32)
        names[at] = found
        out.append(names)
        span *= 2


# --- seeds and their extension --------------------------------------------------------------------------------------


def _extended(levels: list[np.ndarray], at: np.ndarray, lags: np.ndarray) -> Runs:
    """The longest stretches around each place whose words equal those one lag on, with that lag behind them."""
    left, right = at.copy(), at.copy()
    for k in range(len(levels) - 1, -1, -1):
        names, step = levels[k], 1 << k
        here = names[right]
        right += step * ((here >= 0) & (here == names[right + lags]))
        back = np.maximum(left - step, 0)
        here = names[back]
        left -= step * ((left >= step) & (here >= 0) & (here == names[back + lags]))
    return Runs(left, right + lags, lags)


def _distinct(runs: Runs, least: int) -> Runs:
    """Those that are long enough, one for each stretch, with its smallest period; in order."""
    runs = runs.where(runs.ends - runs.starts >= np.maximum(least, 2 * runs.periods))
    runs = runs.where(np.lexsort((runs.periods, runs.ends, runs.starts)))
    new = (np.diff(runs.starts, prepend=-1) != 0) | (np.diff(runs.ends, prepend=-1) != 0)
    return runs.where(new)


def _joined(parts: list[Runs]) -> Runs:
    return Runs(*(np.concatenate(x) for x in zip(*parts)))


def _direct(levels: list[np.ndarray]) -> Runs:
    """Runs of periods below ``2 * SMALLEST``."""
    parts = [Runs(*(np.zeros(0, np.int64),) * 3)]
    if len(levels) > _DIRECT:
        names, width = levels[_DIRECT], 1 << _DIRECT
        places = np.flatnonzero(names >= 0)
        for lag in range(1, 2 * SMALLEST):
            places = places[: np.searchsorted(places, len(names) - lag)]
            same = places[names[places] == names[places + lag]]
            new = np.diff(same, prepend=-2) != 1
            last = np.append(new[1:], True)[: len(new)]
            parts.append(Runs(same[new], same[last] + width + lag, np.full(new.sum(), lag)))
    return _joined(parts)


def _minimizers(names: np.ndarray, scale: int, known: Runs) -> np.ndarray:
    """Places of the first smallest name in every window of ``scale`` named places, and behind runs of small period."""
    at = np.flatnonzero(names >= 0)
    alike = known.where((4 * known.periods <= scale) & (known.ends - known.starts >= scale))
    change = np.zeros(len(names) + 1, np.int64)
    np.add.at(change, alike.starts, 1)
    np.add.at(change, alike.ends - scale + 1, -1)
    usable = (np.cumsum(change)[:-1] == 0)[at]
    shuffled = (mix(names[at].astype(np.uint64)) >> np.uint64(33)).astype(np.int64)
    keys = np.where(usable, shuffled << 32 | np.arange(len(at)), _NONE)
    step = 1
    while step < scale and len(keys) > step:
        keys = np.minimum(keys[:-step], keys[step:])
        step *= 2
    if step < scale:
        keys = keys[:0]
    whole = at[len(at) - len(keys):] - at[: len(keys)] == scale - 1
    chosen = keys[whole & (keys != _NONE)] & 0xFFFFFFFF
    behind = np.flatnonzero(usable[1:] & ~usable[:-1] & (np.diff(at) == 1)) + 1
    return at[np.unique(np.concatenate([chosen, behind]))]


def _pairs(names: np.ndarray, places: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags of equal minimizers ``2 * scale`` to ``4 * scale`` apart."""
    places = places[np.lexsort((places, names[places]))]
    own = names[places]
    at, lags = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(1, min(NEXT, len(places) - 1) + 1):
        lag = places[k:] - places[:-k]
        good = (own[k:] == own[:-k]) & (lag >= 2 * scale) & (lag < 4 * scale)
        at.append(places[:-k][good])
        lags.append(lag[good])
    return np.concatenate(at), np.concatenate(lags)


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``counts`` its number so many times, and 0, 1, ... within."""
    which = np.repeat(np.arange(len(counts)), counts)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)


def _neighbours(levels: list[np.ndarray], known: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags that bring two runs of one small period, side by side, into phase."""
    heavy = known.where(known.ends - known.starts >= 8 * known.periods)
    heavy = heavy.where(np.lexsort((heavy.starts, heavy.periods)))
    side = np.flatnonzero((heavy.periods[1:] == heavy.periods[:-1]) & (heavy.starts[1:] <= heavy.ends[:-1]))
    one, two = heavy.where(side), heavy.where(side + 1)
    which, phase = _spread(one.periods)
    at, lag = one.starts[which] + phase, two.starts[which] - one.starts[which] - phase
    alike = _extended(levels, at, lag)
    alike = alike.ends - lag - at >= one.periods[which]
    which, at = which[alike], at[alike]
    period, to = one.periods[which], two.starts[which]
    again, k = _spread((to - at - 1) // period + 1)
    inside = at[again] + k * period[again]
    # The longest lag leads from the first period of one to the second of the other.
    return np.concatenate([at, inside]), np.concatenate([to + period - at, to[again] - inside])


def find_runs(names: np.ndarray, least: int = LEAST) -> Runs:
    """All runs of at least ``least`` words, by start and period. Each text ends with one place without a name."""
    if not 8 <= least <= SMALLEST:
        raise ValueError(f"least must be 8 to {SMALLEST}")
    levels = scales(names)
    known = _distinct(_direct(levels), least)
    for k in range(SMALLEST.bit_length() - 1, len(levels)):
        seeds = _pairs(levels[k], _minimizers(levels[k], 1 << k, known), 1 << k)
        known = _distinct(_joined([known, _extended(levels, *seeds)]), least)
    found = _distinct(_joined([known, _extended(levels, *_neighbours(levels, known))]), least)
    return found.where(np.lexsort((found.periods, found.starts)))


# --- operator -------------------------------------------------------------------------------------------------------

RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
FOUND = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _collapsed(words: Words, kept: np.ndarray) -> pa.Array:
    """The words that stay, joined by one space, of each text."""
    line, starts, ends = words.joined()
    line = np.frombuffer(line, np.uint8)[np.repeat(kept, ends - starts + 1)]
    sizes = np.concatenate([[0], np.cumsum(np.where(kept, ends - starts + 1, 0))])[words.first]
    raw = line.tobytes()
    return pa.array([raw[a : max(a, b - 1)].decode("utf-8", "replace") for a, b in zip(sizes[:-1], sizes[1:])], pa.string())


def _found(texts: pa.Array, least: int) -> pa.RecordBatch:
    words = Words(*text_bytes(texts))
    found = find_runs(word_names(words), least)
    owners = np.searchsorted(words.first[1:] + np.arange(1, len(words.first)), found.starts, "right")
    starts = found.starts - owners  # without the places between texts
    ends = found.ends - owners
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts + found.periods, 1)
    np.add.at(change, ends, -1)
    offsets = pa.array(np.searchsorted(owners, np.arange(len(words.first))), pa.int32())
    each = pa.StructArray.from_arrays(
        [pa.array(starts - words.first[owners]), pa.array(ends - starts), pa.array(found.periods)], ["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [pa.array(words.counts(), pa.int64()), pa.ListArray.from_arrays(offsets, each, type=RUN),
         _collapsed(words, np.cumsum(change)[:-1] == 0)], ["n_words", "runs", "collapsed"])


def periodic(text: Column, least: int = LEAST) -> Column:
    """``n_words``, ``runs`` and ``collapsed`` of a text, as a struct."""

    @F.arrow_udf(FOUND)
    def of(texts: pa.Array) -> pa.Array:
        parts = [_found(part.column("text"), least) for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]))]
        return pa.concat_arrays([p.to_struct_array() for p in parts]) if parts else pa.array([], pa.struct(
            [("n_words", pa.int64()), ("runs", RUN), ("collapsed", pa.string())]))

    return of(text)


def collapse_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """All columns of the documents as a struct ``row``, and ``n_words``, ``runs`` and ``collapsed``.

    Words are runs of anything but ASCII white space, case kept. ``runs`` has ``start`` (word number from 0), ``length``
    and ``period`` of every run of at least ``least`` words, by start and period. ``collapsed`` is the text's words without
    those that any run contains after its first period, joined by one space.

    A missing or empty text has no words, no runs and an empty ``collapsed``. Repeated rows are worked on each. An empty
    table gives an empty one. Other columns are not looked at, whatever their names.
    """
    whole = docs.select(F.struct("*").alias("row"))
    return whole.select("row", periodic(F.col("row.text"), least).alias("found")).select("row", "found.*")
