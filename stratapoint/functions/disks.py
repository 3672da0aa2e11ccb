"""Aggregates over the points within a radius of many places at once, in numpy.

Points lie in strips along x, sorted by x within each. A disk covers one run of rows of each strip it meets, so a sum is a
difference of prefix sums, an extreme a look into a table of powers of two, and an order statistic a walk down a wavelet
matrix: the work follows the number of strips, not of neighbours. Rows at a run's ends, which the strip's height leaves
open, are tested one by one. Strips hold a single y each where the points lie in few enough rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np

RUNS = 1 << 20  # runs, or pairs of a place and a point, that are looked at together
ROWS = 24  # rows of equal y within a radius, up to which each is a strip of its own
SLACK = 1e-6  # rows nearer to a run's ends than this are tested


def expand(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo, lo + 1, ... for each run of n rows, one after the other."""
    return np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)


def cuts(n: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of items whose n sum to about the limit, an item at least."""
    upto = np.cumsum(n)
    start = 0
    while start < len(n):
        before = upto[start - 1] if start else 0
        stop = max(int(np.searchsorted(upto, before + limit, side="right")), start + 1)
        yield start, stop
        start = stop


class Strips:
    """Points in strips; rows are numbered by strip, then x."""

    def __init__(self, x: np.ndarray, y: np.ndarray, z: np.ndarray, radius: float):
        self.radius = radius
        levels = np.unique(y)
        span = max(float(np.ptp(y)), radius) if len(y) else radius
        if len(levels) * radius <= ROWS * span:
            strip = np.searchsorted(levels, y)
        else:  # as many strips as balance their number against the rows left open
            area = max(float(np.ptp(x)) * span, radius * radius)
            parts = np.clip(0.25 * np.sqrt(len(x) * np.pi * radius * radius / area), 1, 16)
            strip = np.unique(np.floor((y - y.min()) * (parts / radius)), return_inverse=True)[1] if len(y) else np.zeros(0, np.int64)
        order = np.lexsort((x, strip))
        self.x, self.y, self.z, strip = x[order], y[order], z[order], strip[order]
        starts = np.flatnonzero(np.r_[True, strip[1:] != strip[:-1]]) if len(strip) else np.zeros(0, np.int64)
        self.ymin = np.minimum.reduceat(self.y, starts) if len(starts) else np.zeros(0)
        self.ymax = np.maximum.reduceat(self.y, starts) if len(starts) else np.zeros(0)
        self.left = float(x.min()) if len(x) else 0.0
        self.width = (float(np.ptp(x)) if len(x) else 0.0) + 4 * radius + 1
        self.key = strip * self.width + (self.x - self.left)

    @cached_property
    def sums(self) -> np.ndarray:
        return np.append(0.0, np.cumsum(self.z))

    @cached_property
    def middle(self) -> float:
        return float(np.round(self.z.mean())) if len(self.z) else 0.0  # a whole number keeps sums of short fractions exact

    @cached_property
    def moments(self) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums of the heights less their middle, and of those squared."""
        off = self.z - self.middle
        return np.append(0.0, np.cumsum(off)), np.append(0.0, np.cumsum(off * off))

    def table(self, how: np.ufunc) -> list[np.ndarray]:
        """how over the 1, 2, 4, ... rows from each row on."""
        out = [self.z]
        while len(out[-1]) > (step := 1 << (len(out) - 1)):
            out.append(how(out[-1][:-step], out[-1][step:]))
        return out

    @cached_property
    def least(self) -> list[np.ndarray]:
        return self.table(np.minimum)

    @cached_property
    def most(self) -> list[np.ndarray]:
        return self.table(np.maximum)

    @cached_property
    def ranks(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Distinct heights, and by bit of their rank from the highest on: zeros before each row, rows being sorted by the bits above."""
        values, rank = np.unique(self.z, return_inverse=True)
        levels = []
        for bit in range(max(len(values) - 1, 1).bit_length() - 1, -1, -1):
            one = (rank >> bit) & 1 == 1
            levels.append(np.append(0, np.cumsum(~one)))
            rank = np.concatenate([rank[~one], rank[one]])
        return values, levels

    def around(self, qx: np.ndarray, qy: np.ndarray) -> Iterator[tuple[slice, Disks]]:
        """Disks around places, a run of them at a time."""
        reach = self.radius + SLACK
        first = np.searchsorted(self.ymax, qy - reach)
        n = np.maximum(np.searchsorted(self.ymin, qy + reach, side="right") - first, 0)
        for a, b in cuts(n, RUNS):
            yield slice(a, b), Disks(self, qx[a:b], qy[a:b], first[a:b], n[a:b])


class Disks:
    """Runs lo to hi of rows of the places q that are surely inside, and rows (one) of places (one_q) found so by a test."""

    def __init__(self, strips: Strips, qx: np.ndarray, qy: np.ndarray, first: np.ndarray, n: np.ndarray):
        self.strips, self.qx, self.qy = strips, qx, qy
        r = strips.radius
        q, strip = np.repeat(np.arange(len(qx)), n), expand(first, n)
        y = qy[q]
        below, above = strips.ymin[strip] - y, strips.ymax[strip] - y
        near = np.maximum(np.maximum(below, -above), 0.0)
        far = np.maximum(np.abs(below), np.abs(above))
        outer = np.sqrt(np.maximum(r * r - near * near, 0.0)) + SLACK
        inner = np.sqrt(np.maximum(r * r - far * far, 0.0)) - SLACK
        at = strip * strips.width + (qx[q] - strips.left)
        edge = strip * strips.width
        clip = lambda v: np.clip(v, edge - r, edge + strips.width - 2 * r)  # noqa: E731  a run stays in its strip
        lo, hi = np.searchsorted(strips.key, clip(at - outer)), np.searchsorted(strips.key, clip(at + outer), side="right")
        sure = (inner > 0) & (hi > lo)
        a, b = lo.copy(), lo.copy()
        a[sure] = np.searchsorted(strips.key, clip(at - inner)[sure])
        b[sure] = np.maximum(np.searchsorted(strips.key, clip(at + inner)[sure], side="right"), a[sure])
        for_test = [(q, expand(lo, a - lo), a - lo), (q, expand(b, hi - b), hi - b)]
        one_q = np.concatenate([np.repeat(who, m) for who, _, m in for_test])
        one = np.concatenate([rows for _, rows, _ in for_test])
        dx, dy = strips.x[one] - qx[one_q], strips.y[one] - qy[one_q]
        inside = dx * dx + dy * dy <= r * r
        one_q, one = one_q[inside], one[inside]
        order = np.argsort(one_q, kind="stable")
        self.one_q, self.one = one_q[order], one[order]
        full = b > a
        self.q, self.lo, self.hi = q[full], a[full], b[full]

    def __len__(self) -> int:
        return len(self.qx)

    def total(self, upto: np.ndarray) -> np.ndarray:
        """Sums by place, from prefix sums over the rows."""
        runs = np.bincount(self.q, upto[self.hi] - upto[self.lo], len(self))
        return runs + np.bincount(self.one_q, upto[self.one + 1] - upto[self.one], len(self))

    @cached_property
    def n(self) -> np.ndarray:
        return (np.bincount(self.q, self.hi - self.lo, len(self)) + np.bincount(self.one_q, minlength=len(self))).astype(np.int64)

    def mean(self) -> np.ndarray:
        with np.errstate(invalid="ignore", divide="ignore"):
            return self.total(self.strips.sums) / self.n

    def variance(self) -> np.ndarray:
        """Of the population; NaN for fewer than two."""
        first, second = (self.total(upto) for upto in self.strips.moments)
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(self.n > 1, np.maximum((second * self.n - first * first) / (self.n * self.n), 0.0), np.nan)

    def extreme(self, how: np.ufunc, table: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(self), np.inf if how is np.minimum else -np.inf)
        if len(self.q):
            level = np.frexp(self.hi - self.lo)[1] - 1
            value = np.empty(len(self.q))
            for k in np.unique(level):
                mine = level == k
                value[mine] = how(table[k][self.lo[mine]], table[k][self.hi[mine] - (1 << int(k))])
            _by_place(how, self.q, value, out)
        _by_place(how, self.one_q, self.strips.z[self.one], out)
        return np.where(np.isinf(out), np.nan, out)

    def median(self) -> np.ndarray:
        """The mean of the middle two for an even number."""
        out = np.full(len(self), np.nan)
        some = np.flatnonzero(self.n)
        if len(some):
            low = self.ranked((self.n - 1) // 2, self.n > 0)
            even = (self.n > 0) & (self.n % 2 == 0)
            high = low.copy()
            high[even] = self.ranked(self.n // 2, even)[even]
            out[some] = (low[some] + high[some]) / 2
        return out

    def ranked(self, k: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """The k-th least height (from 0) of the wanted places."""
        values, levels = self.strips.ranks
        q = np.concatenate([self.q, self.one_q])
        lo, hi = np.concatenate([self.lo, self.one]), np.concatenate([self.hi, self.one + 1])
        mine = wanted[q]
        q, lo, hi = q[mine], lo[mine], hi[mine]
        left, rank = k.copy(), np.zeros(len(self), np.int64)
        for zeros in levels:
            a, b = zeros[lo], zeros[hi]
            n = np.bincount(q, b - a, len(self)).astype(np.int64)
            up = left >= n
            left -= np.where(up, n, 0)
            rank = 2 * rank + up
            ups = up[q]
            lo, hi = np.where(ups, zeros[-1] + lo - a, a), np.where(ups, zeros[-1] + hi - b, b)
            kept = hi > lo
            q, lo, hi = q[kept], lo[kept], hi[kept]
        return values[np.minimum(rank, len(values) - 1)]

    def pairs(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """From and to which place, and the place (from 0) and row of each pair, sorted by place; a bounded number at a time."""
        for a, b in cuts(self.n, RUNS):
            runs = slice(*np.searchsorted(self.q, [a, b]))
            ones = slice(*np.searchsorted(self.one_q, [a, b]))
            n = (self.hi - self.lo)[runs]
            who = np.concatenate([np.repeat(self.q[runs], n), self.one_q[ones]]) - a
            rows = np.concatenate([expand(self.lo[runs], n), self.one[ones]])
            order = np.argsort(who, kind="stable")
            yield a, b, who[order], rows[order]


def _by_place(how: np.ufunc, q: np.ndarray, value: np.ndarray, out: np.ndarray) -> None:
    """out[q] = how(out[q], value), q being sorted."""
    if len(q):
        starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        at = q[starts]
        out[at] = how(out[at], how.reduceat(value, starts))


def merged(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct places with the sum of their heights and their number of points."""
    order = np.lexsort((x, y))
    x, y, z = x[order], y[order], z[order]
    starts = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])]) if len(x) else np.zeros(0, np.int64)
    return x[starts], y[starts], np.add.reduceat(z, starts) if len(starts) else z, np.diff(np.append(starts, len(x)))


def by_place(qx: np.ndarray, qy: np.ndarray, value: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """value(x, y) of distinct places in order of y and x, given to all queries there."""
    order = np.lexsort((qx, qy))
    x, y = qx[order], qy[order]
    new = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])]
    out = np.empty(len(qx))
    out[order] = value(x[new], y[new])[np.cumsum(new) - 1]
    return out


def nearest2(x: np.ndarray, y: np.ndarray, qx: np.ndarray, qy: np.ndarray, cell: float) -> np.ndarray:
    """Squared distance to the nearest point of the 3 x 3 cells around each place's; infinite where they are empty.

    Smaller cells are tried first: what they find within their own size is the nearest of all.
    """
    out = np.full(len(qx), np.inf)
    asked = np.arange(len(qx))
    for part in (16, 4, 1):
        size = cell / part
        got = _in_cells(x, y, qx[asked], qy[asked], size)
        if part > 1:
            done = got <= (size * (1 - 1e-9)) ** 2
            out[asked[done]] = got[done]
            asked = asked[~done]
        else:
            out[asked] = got
    return out


def _in_cells(x: np.ndarray, y: np.ndarray, qx: np.ndarray, qy: np.ndarray, cell: float) -> np.ndarray:
    out = np.full(len(qx), np.inf)
    if not len(x) or not len(qx):
        return out
    cx, cy, gx, gy = (np.floor(v / cell).astype(np.int64) for v in (x, y, qx, qy))
    low_x, low_y = min(cx.min(), gx.min()) - 2, min(cy.min(), gy.min()) - 2
    width = int(max(cx.max(), gx.max()) - low_x) + 4
    code = (cy - low_y) * width + cx - low_x
    order = np.argsort(code, kind="stable")
    code, x, y = code[order], x[order], y[order]
    base = (gy - low_y) * width + gx - low_x
    lo = np.stack([np.searchsorted(code, base + i * width - 1) for i in (-1, 0, 1)], axis=1)
    n = np.stack([np.searchsorted(code, base + i * width + 1, side="right") for i in (-1, 0, 1)], axis=1) - lo
    for a, b in cuts(n.sum(axis=1), RUNS):
        rows = expand(lo[a:b].ravel(), n[a:b].ravel())
        who = np.repeat(np.arange(a, b), n[a:b].sum(axis=1))
        dx, dy = x[rows] - qx[who], y[rows] - qy[who]
        _by_place(np.minimum, who, dx * dx + dy * dy, out)
    return out
