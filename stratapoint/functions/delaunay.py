"""Delaunay triangulation in numpy: many points go in at once, and many edges flip at once.

Coordinates are whole numbers of 0.1 mm, or of a larger unit that divides them all. The first triangle has its corners
infinitely far away, in three directions (weight 0 where real points have 1), so the hull needs no special case. Each round
puts a point into every triangle that holds some, splits it, and flips edges until no corner lies inside a circle.
Of corners on one circle, the diagonal from the first in order of x and y is taken: the triangles depend on the points alone.
"""

from __future__ import annotations

import math

import numpy as np

UNIT = 1e-4
EXACT = 2.0**52
NEXT, LAST = np.array([1, 2, 0]), np.array([2, 0, 1])
AWAY = [(math.cos(v), math.sin(v)) for v in (0.7, 0.7 + 2 * math.pi / 3, 0.7 + 4 * math.pi / 3)]


def triangulate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Counter-clockwise triangles, as rows of three places in the input. Repeated points are used once; fewer than three
    distinct points, or points all on one line, give none."""
    if len(x) < 3:
        return np.zeros((0, 3), np.int64)
    at = np.stack([np.round((v - v.min()) / UNIT).astype(np.int64) for v in (x, y)], axis=1)
    order = np.lexsort((at[:, 1], at[:, 0]))
    keep = order[np.r_[True, (np.diff(at[order], axis=0) != 0).any(axis=1)]]
    if len(keep) < 3:
        return np.zeros((0, 3), np.int64)
    at = at[keep] // max(int(np.gcd.reduce(at[keep], axis=None)), 1)
    return keep[_Mesh(at).run()]


class _Mesh:
    """Triangles v (corners) with n (neighbours, across from each corner); points not yet in lie in the triangle `where`."""

    def __init__(self, at: np.ndarray):
        self.count = len(at)
        self.x, self.y = (np.append(at[:, k].astype(float), [d[k] for d in AWAY]) for k in (0, 1))
        self.w = np.append(np.ones(self.count), [0.0, 0.0, 0.0])
        size = 2 * self.count + 8
        self.v, self.n = np.zeros((size, 3), np.int64), np.full((size, 3), -1)
        self.v[0] = self.count + np.arange(3)
        self.used = 1
        self.heirs = np.repeat(np.arange(size)[:, None], 3, axis=1)  # the triangles that a changed one has turned into
        self.spare = np.zeros(size, np.int64)
        self.flag, self.asked = np.zeros(size, bool), np.zeros((size, 3), bool)
        self.out = np.random.default_rng(0).permutation(self.count)  # points not in yet
        self.where = np.zeros(self.count, np.int64)  # of each of them

    def run(self) -> np.ndarray:
        while len(self.out):
            self.settle(self.insert())
        done = self.v[: self.used]
        return done[(done < self.count).all(axis=1)]

    def side(self, a: np.ndarray, b: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Positive where the real point p lies left of the line from a to b, exactly."""
        x, y, w = self.x, self.y, self.w
        ax, ay, bx, by = x[a] - w[a] * x[p], y[a] - w[a] * y[p], x[b] - w[b] * x[p], y[b] - w[b] * y[p]
        return ax * by - ay * bx

    def bad(self, a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Whether the edge between b and c of the triangles a, b, c and d, c, b is to be flipped."""
        swap = d >= self.count  # the point that is asked for must be real; the question is the same from both sides
        a, b, c, d = np.where(swap, d, a), np.where(swap, c, b), np.where(swap, b, c), np.where(swap, a, d)
        far = (a >= self.count).astype(int) + (b >= self.count) + (c >= self.count)
        out = np.zeros(len(a), bool)
        real = far == 0
        out[real] = self.in_circle(a[real], b[real], c[real], d[real])
        one = np.flatnonzero((far == 1) & (d < self.count))
        if len(one):  # the circle is the half plane beyond the other two
            tri = np.stack([a, b, c])[:, one]
            k = (tri >= self.count).argmax(axis=0)
            p, q, r = tri[NEXT[k], np.arange(len(one))], tri[LAST[k], np.arange(len(one))], d[one]
            s = self.side(p, q, r)
            between = (self.x[p] - self.x[r]) * (self.x[q] - self.x[r]) + (self.y[p] - self.y[r]) * (self.y[q] - self.y[r]) < 0
            out[one] = (s > 0) | ((s == 0) & between)
        two = np.flatnonzero((far == 2) & (d < self.count))
        if len(two):
            tri = np.stack([a, b, c])[:, two]
            k = (tri < self.count).argmax(axis=0)
            p, q, r = (tri[s[k], np.arange(len(two))] for s in (np.arange(3), NEXT, LAST))
            ax, ay = self.x[p] - self.x[d[two]], self.y[p] - self.y[d[two]]
            out[two] = ax * (self.y[q] - self.y[r]) - ay * (self.x[q] - self.x[r]) > 0
        return out

    def in_circle(self, a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
        (ax, ay), (bx, by), (cx, cy) = ((self.x[p] - self.x[d], self.y[p] - self.y[d]) for p in (a, b, c))
        aa, bb, cc = ax * ax + ay * ay, bx * bx + by * by, cx * cx + cy * cy
        det = aa * (bx * cy - by * cx) + bb * (cx * ay - cy * ax) + cc * (ax * by - ay * bx)
        most = aa * (abs(bx * cy) + abs(by * cx)) + bb * (abs(cx * ay) + abs(cy * ax)) + cc * (abs(ax * by) + abs(ay * bx))
        unsure = np.flatnonzero((most >= EXACT) & (np.abs(det) <= most * 2.0**-48))
        if len(unsure):  # whole numbers of any length
            (ax, ay), (bx, by), (cx, cy) = ((np.array([int(v) for v in u[unsure]], object) for u in p) for p in ((ax, ay), (bx, by), (cx, cy)))
            full = (ax * ax + ay * ay) * (bx * cy - by * cx) + (bx * bx + by * by) * (cx * ay - cy * ax) + (cx * cx + cy * cy) * (ax * by - ay * bx)
            det[unsure] = np.sign(full).astype(float)
        return (det > 0) | ((det == 0) & (np.minimum(a, d) < np.minimum(b, c)))

    def link(self, me: np.ndarray, slot: np.ndarray, old: np.ndarray) -> None:
        """Makes what the old neighbours have become and the triangles me neighbours, across from each one's slot."""
        some = old >= 0
        me, slot, old = me[some], slot[some], old[some]
        u, w = self.v[me, NEXT[slot]], self.v[me, LAST[slot]]
        now = self.heirs[old, 0]
        for k in (1, 2):  # of an old neighbour that has changed: the heir with both ends of the edge
            heir = self.heirs[old, k]
            more = np.flatnonzero(heir != self.heirs[old, 0])
            corners = self.v[heir[more]]
            has = ((corners == u[more, None]) | (corners == w[more, None])).sum(axis=1) == 2
            now[more[has]] = heir[more[has]]
        self.n[me, slot] = now
        corners = self.v[now]
        across = ((corners != u[:, None]) & (corners != w[:, None])).argmax(axis=1)
        self.n[now, across] = me

    def insert(self) -> tuple[np.ndarray, np.ndarray]:
        """Puts points in; edges (triangle, slot) to look at."""
        first = self.spare
        first[self.where[::-1]] = np.arange(len(self.out))[::-1]
        tri = np.unique(self.where)
        place = first[tri]
        p = self.out[place]
        on = np.stack([self.side(self.v[tri, NEXT[k]], self.v[tri, LAST[k]], p) == 0 for k in range(3)], axis=1)
        edge = on.any(axis=1)
        slot = on.argmax(axis=1)
        other = np.where(edge, self.n[tri, slot], tri)
        claim = self.spare  # a point on an edge takes both triangles; the last of the points that want one gets it
        claim[np.stack([tri, other], axis=1).ravel()] = np.repeat(np.arange(len(tri)), 2)
        free = (claim[tri] == np.arange(len(tri))) & (claim[other] == np.arange(len(tri)))
        a, b = self.split(tri[free & ~edge], p[free & ~edge]), self.split_edges(tri[free & edge], slot[free & edge], p[free & edge])
        left = np.ones(len(self.out), bool)
        left[place[free]] = False
        self.out, self.where = self.out[left], self.where[left]
        self.move(*a[2:])
        self.move(*b[2:])
        return np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])

    def split(self, t: np.ndarray, p: np.ndarray):
        """Three triangles each; then the triangles changed, their parts, and the lines through p that part them."""
        m = len(t)
        s, u = self.used + np.arange(m), self.used + m + np.arange(m)
        self.used += 2 * m
        a, b, c = self.v[t].T
        na, nb, nc = self.n[t].T
        self.v[t], self.v[s], self.v[u] = (np.stack(k, axis=1) for k in ((a, b, p), (b, c, p), (c, a, p)))
        self.n[t], self.n[s], self.n[u] = (np.stack(k, axis=1) for k in ((s, u, nc), (u, t, na), (t, s, nb)))
        self.heirs[t] = np.stack([t, s, u], axis=1)
        return self._outer([t, s, u], [2, 2, 2], [nc, na, nb], t) + (t, np.stack([t, s, u], axis=1), p, np.stack([a, b, c], axis=1))

    def split_edges(self, t: np.ndarray, k: np.ndarray, p: np.ndarray):
        """Two and two triangles for points on the edges across from corner k."""
        m = len(t)
        o = self.n[t, k]
        s, u = self.used + np.arange(m), self.used + m + np.arange(m)
        self.used += 2 * m
        a, b, c = self.v[t, k], self.v[t, NEXT[k]], self.v[t, LAST[k]]
        j = (self.n[o] == t[:, None]).argmax(axis=1)
        d = self.v[o, j]
        nca, nab, nbd, ndc = self.n[t, NEXT[k]], self.n[t, LAST[k]], self.n[o, NEXT[j]], self.n[o, LAST[j]]
        for tri, corners, across in ((t, (a, b, p), (u, s, nab)), (s, (a, p, c), (o, nca, t)), (o, (d, c, p), (s, u, ndc)), (u, (d, p, b), (t, nbd, o))):
            self.v[tri], self.n[tri] = np.stack(corners, axis=1), np.stack(across, axis=1)
        self.heirs[t] = np.stack([t, s, s], axis=1)
        self.heirs[o] = np.stack([o, u, u], axis=1)
        edges = self._outer([t, s, o, u], [2, 1, 2, 1], [nab, nca, ndc, nbd], np.concatenate([t, o]))
        whole = np.concatenate([t, o])
        parts = np.concatenate([np.stack([t, s, s], axis=1), np.stack([o, u, u], axis=1)])
        ends = np.concatenate([np.stack([b, a, c], axis=1), np.stack([c, d, b], axis=1)])
        return edges + (whole, parts[:, [1, 0, 0]], np.concatenate([p, p]), ends[:, [1, 1, 1]])

    def _outer(self, tris: list, slots: list, olds: list, changed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links the outer edges of changed triangles; they are to be looked at."""
        me, old = np.concatenate(tris), np.concatenate(olds)
        slot = np.repeat(slots, [len(t) for t in tris])
        self.link(me, slot, old)
        self.heirs[changed] = changed[:, None]
        return me, slot

    def move(self, whole: np.ndarray, parts: np.ndarray, p: np.ndarray, ends: np.ndarray) -> None:
        """Points of the triangles `whole` to the parts they lie in. With three ends: those between lines from p to two ends each;
        with one end throughout: on the left (the first part) or the right of the line from the end to p."""
        row = self.spare
        self.flag[whole] = True
        row[whole] = np.arange(len(whole))
        mine = np.flatnonzero(self.flag[self.where])
        self.flag[whole] = False
        if not len(mine):
            return
        r, q = row[self.where[mine]], self.out[mine]
        turn = [self.side(p[r], ends[r, k], q) for k in range(3)]
        two = ends[r, 0] == ends[r, 1]
        third = np.where((turn[0] >= 0) & (turn[1] <= 0), 0, np.where((turn[1] >= 0) & (turn[2] <= 0), 1, 2))
        self.where[mine] = parts[r, np.where(two, np.where(turn[0] <= 0, 0, 1), third)]

    def settle(self, edges: tuple[np.ndarray, np.ndarray]) -> None:
        """Flips edges until none is bad."""
        t, k = edges
        while len(t):
            o = self.n[t, k]
            t, k, o = t[o >= 0], k[o >= 0], o[o >= 0]
            j = (self.n[o] == t[:, None]).argmax(axis=1)
            self.asked[t, k] = True
            once = (o > t) | ~self.asked[o, j]  # an edge may be in the list from both sides
            self.asked[t, k] = False
            t, k, o, j = t[once], k[once], o[once], j[once]
            a, b, c = self.v[t, k], self.v[t, NEXT[k]], self.v[t, LAST[k]]
            d = self.v[o, j]
            bad = self.bad(a, b, c, d)
            t, k, o, j, a, b, c, d = (q[bad] for q in (t, k, o, j, a, b, c, d))
            if not len(t):
                return
            claim = self.spare
            number = np.arange(len(t))
            claim[np.stack([t, o], axis=1).ravel()] = np.repeat(number, 2)
            win = (claim[t] == number) & (claim[o] == number)
            late_t, late_k, late_o = t[~win], k[~win], o[~win]
            t, k, o, j, a, b, c, d = (q[win] for q in (t, k, o, j, a, b, c, d))
            nca, nab, nbd, ndc = self.n[t, NEXT[k]], self.n[t, LAST[k]], self.n[o, NEXT[j]], self.n[o, LAST[j]]
            self.v[t], self.v[o] = np.stack([a, b, d], axis=1), np.stack([a, d, c], axis=1)
            self.n[t], self.n[o] = np.stack([nbd, o, nab], axis=1), np.stack([ndc, nca, t], axis=1)
            pair = np.stack([t, o, o], axis=1)
            self.heirs[t], self.heirs[o] = pair, pair
            both = np.concatenate([t, o])
            me, slot = self._outer([t, t, o, o], [0, 2, 0, 1], [nbd, nab, ndc, nca], both)
            # points left of the line from a to d lie in o
            self.move(both, np.concatenate([np.stack([o, t, t], axis=1)] * 2), np.concatenate([d, d]), np.repeat(np.concatenate([a, a])[:, None], 3, axis=1))
            self.flag[both] = True
            still = ~self.flag[late_t] & ~self.flag[late_o]
            self.flag[both] = False
            t, k = np.concatenate([me, late_t[still]]), np.concatenate([slot, late_k[still]])
