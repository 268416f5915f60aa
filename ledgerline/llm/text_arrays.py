"""Texts of an Arrow batch as byte arrays, their words, and hashes of words and windows, by NumPy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240501)
#: One random odd base and one random value per byte for each of two independent hashes.
_BASES = [int(x) | 1 for x in _RNG.integers(1 << 62, size=2, dtype=np.uint64)]
_VALUES = [_RNG.integers(1 << 63, size=256, dtype=np.uint64) for _ in range(2)]
_POWERS: dict[tuple[int, bool], np.ndarray] = {}

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and where each begins and ends; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, size: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``size`` bytes: first text, and the one after the last."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = max(last, first + 1)
        yield first, last
        first = last


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word; words end at white space and at the end of a text."""
    inside = ~IS_SPACE[raw]
    before = np.concatenate([[False], inside[:-1]]) if len(raw) else inside.copy()
    after = np.concatenate([inside[1:], [False]]) if len(raw) else inside.copy()
    edges = offsets[:-1]
    before[edges[edges < len(raw)]] = False
    ends = offsets[1:] - 1
    after[ends[(ends >= 0) & (np.diff(offsets) > 0)]] = False
    starts = np.flatnonzero(inside & ~before)
    stops = np.flatnonzero(inside & ~after) + 1
    return starts, stops, np.searchsorted(offsets, starts, "right") - 1


def _powers(n: int, which: int, inverse: bool) -> np.ndarray:
    have = _POWERS.get((which, inverse))
    if have is None or len(have) < n:
        base = pow(_BASES[which], -1, 1 << 64) if inverse else _BASES[which]
        factors = np.full(max(n, 1 << 16), base, np.uint64)
        factors[0] = 1
        have = _POWERS[which, inverse] = np.cumprod(factors, dtype=np.uint64)
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64 over all others."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _span_hashes(values: np.ndarray, starts: np.ndarray, stops: np.ndarray, which: int) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(len(values), which, False), out=sums[1:])
    return mixed((sums[stops] - sums[starts]) * _powers(len(values) + 1, which, True)[starts])


def byte_hashes(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each span of bytes; equal spans have equal hashes wherever they are."""
    return _span_hashes(_VALUES[which][raw], starts, stops, which)


def window_hashes(items: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """A hash of each ``width`` consecutive items, by the first one's place."""
    n = max(0, len(items) - width + 1)
    starts = np.arange(n)
    return _span_hashes(items, starts, starts + width, which)
