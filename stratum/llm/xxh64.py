"""XXH64 of many short byte ranges at once, after the published algorithm."""

from __future__ import annotations

import numpy as np
import xxhash

# Fixed values of the algorithm.
_P1 = np.uint64(0x9E3779B185EBCA87)
_P2 = np.uint64(0xC2B2AE3D27D4EB4F)
_P3 = np.uint64(0x165667B19E3779F9)
_P4 = np.uint64(0x85EBCA77C2B2AE63)
_P5 = np.uint64(0x27D4EB2F165667C5)

LONG = 1024  # longer ranges are hashed one by one


def _rotate(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotate(acc + lane * _P2, 31) * _P1


def _stripes(lanes: np.ndarray, at: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """What the 32-byte stripes of ranges with at least one of them come to."""
    with np.errstate(over="ignore"):
        s = np.uint64(seed)
        acc = [np.full(len(at), v, np.uint64) for v in (s + _P1 + _P2, s + _P2, s, s - _P1)]
    for k in range(int(size.max()) // 32):
        on = np.flatnonzero(size >= 32 * (k + 1))
        for j in range(4):
            acc[j][on] = _round(acc[j][on], lanes[at[on] + 32 * k + 8 * j])
    h = _rotate(acc[0], 1) + _rotate(acc[1], 7) + _rotate(acc[2], 12) + _rotate(acc[3], 18)
    for a in acc:
        h = (h ^ _round(np.uint64(0), a)) * _P1 + _P4
    return h


def _ranges(padded: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    lanes = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    size, at = ends - starts, starts.copy()
    with np.errstate(over="ignore"):
        h = np.full(len(at), np.uint64(seed) + _P5, np.uint64)
    if len(big := np.flatnonzero(size >= 32)):
        h[big] = _stripes(lanes, at[big], size[big], seed)
        at[big] += size[big] // 32 * 32
    h += size.astype(np.uint64)
    for k in range(3):
        on = np.flatnonzero(ends - at >= 8)
        h[on] = _rotate(h[on] ^ _round(np.uint64(0), lanes[at[on]]), 27) * _P1 + _P4
        at[on] += 8
    on = np.flatnonzero(ends - at >= 4)
    h[on] = _rotate(h[on] ^ ((lanes[at[on]] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
    at[on] += 4
    for k in range(3):
        on = np.flatnonzero(ends > at)
        h[on] = _rotate(h[on] ^ (padded[at[on]].astype(np.uint64) * _P5), 11) * _P1
        at[on] += 1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def xxh64(data: bytes, starts: np.ndarray, ends: np.ndarray, seed: int, chunk: int = 1 << 16) -> np.ndarray:
    """XXH64 of ``data[s:e]`` for each range."""
    padded = np.frombuffer(data + bytes(8), np.uint8)
    out = np.empty(len(starts), np.uint64)
    for k in range(0, len(starts), chunk):
        out[k : k + chunk] = _ranges(padded, starts[k : k + chunk], np.minimum(ends, starts + LONG)[k : k + chunk], seed)
    for k in np.flatnonzero(ends - starts > LONG):
        out[k] = xxhash.xxh64_intdigest(data[starts[k] : ends[k]], seed)
    return out
