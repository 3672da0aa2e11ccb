"""Words, word n-grams and their 64-bit hashes for whole columns of text, by array operations.

A word is a run without the bytes 0x20 and 0x09 to 0x0D. Text is worked on in slices that end between words, so a
very long text needs no more memory than its words.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 16  # bytes, so that the arrays stay in a core's cache

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_U = np.uint64


@lru_cache(maxsize=2)
def _byte_values(fold: bool) -> np.ndarray:
    out = np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)
    if fold:
        out[65:91] = out[97:123]
    out[_SPACE] = 0
    return out


_powers = np.ones(1, _U)


def _power(n: int) -> np.ndarray:
    """Powers of an odd base, at least n."""
    global _powers
    if len(_powers) < n:
        base = np.full(max(n, 4096), 0x9E3779B97F4A7C15, _U)
        base[0] = 1
        _powers = np.multiply.accumulate(base)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and where each starts (and the last ends); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


@dataclass
class Words:
    """hashes of all words; of document d, those from first[d] to first[d + 1]."""

    hashes: np.ndarray
    first: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of n words of one document, and the place of its first word."""
        total = len(self.hashes)
        if total < n:
            return np.zeros(0, _U), np.zeros(0, np.int64)
        out = np.zeros(total - n + 1, _U)
        for j in range(n):
            out += self.hashes[j : total - n + 1 + j] * _power(64)[j + 1]
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(total)  # words from here to the document's end
        whole = np.flatnonzero(left[: total - n + 1] >= n)
        return mix(out[whole] + _U(n)), whole


def _slices(buf: np.ndarray, breaks: np.ndarray):
    """Ends of slices of about SLICE bytes, between words."""
    at = 0
    while at < len(buf):
        end = at + SLICE
        if end >= len(buf):
            end = len(buf)
        else:
            gaps = np.flatnonzero(_SPACE[buf[at + 1 : end + 1]])
            if len(gaps):
                end = at + 1 + int(gaps[-1])
            else:
                k = np.searchsorted(breaks, at, side="right")
                stop = int(breaks[k]) if k < len(breaks) else len(buf)
                more = np.flatnonzero(_SPACE[buf[end:stop]])
                end = end + int(more[0]) if len(more) else stop
        yield at, end
        at = end


def words(column: pa.Array | pa.ChunkedArray, fold: bool = False) -> Words:
    """Words of a column of texts; fold: A-Z count as a-z."""
    buf, starts_of = flat(column)
    values = _byte_values(fold)
    hashes, starts = [], []
    breaks = np.unique(starts_of)
    for a, b in _slices(buf, breaks):
        part = buf[a:b]
        inside = ~_SPACE[part]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        cut = breaks[np.searchsorted(breaks, a) : np.searchsorted(breaks, b)] - a
        begins[cut] |= inside[cut]
        at = np.flatnonzero(begins)
        if not len(at):
            continue
        stops = np.append(at[1:], len(part))
        tail = int(at[0])
        power = _power(int((stops - at).max()) + 2)
        place = np.arange(1, len(part) - tail + 1) - np.repeat(at - tail, stops - at)
        h = np.add.reduceat(values[part[tail:]] * power[place], at - tail)
        hashes.append(mix(h))
        starts.append(at + a)
    all_starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return Words(np.concatenate(hashes) if hashes else np.zeros(0, _U), np.searchsorted(all_starts, starts_of).astype(np.int64))
