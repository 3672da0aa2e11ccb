"""Model fits on the points of one feature: roof planes, ridges, wall lines, and projective maps. numpy only.

Planes come from random samples of three nearby points: the sample that most points agree with is refined by least squares,
its points are set aside, and the rest is searched again. Lines are total least squares. Samples are drawn from a fixed seed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

# Tilts of roofs that are searched, in degrees, and how far a wall may turn from its side of the outline.
TILTS = (18.0, 60.0)
WALL_TURN = 3.0

SAMPLES = 400  # of three points, for each plane
NEAR = 0.1  # metres from a plane within which points belong to it
SHARE = 0.1  # of all points, that a plane needs
OPPOSED = 150.0  # degrees at least between the directions in which the two sides of a gable fall
CELLS = 1 << 22  # distances that are held at a time


@dataclass(frozen=True)
class Plane:
    """z = slope . (x, y) + base, held by a share of the points."""

    slope: np.ndarray
    base: float
    share: float

    @property
    def tilt(self) -> float:
        return math.degrees(math.atan(float(np.hypot(*self.slope))))

    def at(self, xy: np.ndarray) -> np.ndarray:
        return xy @ self.slope + self.base


def _samples(xy: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Rows of three points of one neighbourhood each: neighbours in an order of small cells, row by row."""
    side = max(float(np.ptp(xy, axis=0).max()), 1e-6) / 6
    cell = np.floor((xy - xy.min(axis=0)) / side)
    order = np.lexsort((rng.random(len(xy)), cell[:, 0], cell[:, 1]))
    reach = max(len(xy) // 12, 3)
    first = rng.integers(0, len(xy), SAMPLES)
    others = first[:, None] + rng.integers(1, reach + 1, (SAMPLES, 2))
    return order[np.c_[first, others] % len(xy)]


def _through(xyz: np.ndarray, triples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit normals (upwards) of the planes through triples, and their distances from the origin; flat triples are left out."""
    p, q, r = xyz[triples].transpose(1, 0, 2)
    normal = np.cross(q - p, r - p)
    length = np.linalg.norm(normal, axis=1)
    fit = (length > 1e-9) & (np.abs(normal[:, 2]) > 1e-9)
    normal = normal[fit] / (length[fit] * np.sign(normal[fit, 2]))[:, None]
    return normal, (normal * p[fit]).sum(axis=1)


def _refined(xyz: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Slope and base by least squares on the points inside, then on those near the result; and which these are."""
    for _ in range(3):
        a, b, c = np.linalg.lstsq(np.c_[xyz[inside, :2], np.ones(inside.sum())], xyz[inside, 2], rcond=None)[0]
        inside = np.abs(xyz[:, 2] - a * xyz[:, 0] - b * xyz[:, 1] - c) <= NEAR * math.sqrt(a * a + b * b + 1)
        if inside.sum() < 3:
            break
    return np.array([a, b]), float(c), inside


def find_planes(xyz: np.ndarray) -> list[Plane]:
    """Tilted planes of a roof, those of most points first. Flat and very steep ones are set aside and not returned."""
    rng = np.random.default_rng(0)
    left, planes, least = xyz, [], max(SHARE * len(xyz), 3)
    while len(left) >= least:
        normal, distance = _through(left, _samples(left[:, :2], rng))
        support = np.zeros(len(normal))
        for k in range(0, len(left), max(CELLS // SAMPLES, 1)):
            support += (np.abs(left[k : k + CELLS // SAMPLES] @ normal.T - distance) <= NEAR).sum(axis=0)
        if not len(support) or support.max() < least:
            break
        best = int(support.argmax())
        slope, base, inside = _refined(left, np.abs(left @ normal[best] - distance[best]) <= NEAR)
        if inside.sum() < least:
            break
        plane = Plane(slope, base, float(inside.sum() / len(xyz)))
        if TILTS[0] <= plane.tilt <= TILTS[1]:
            planes.append(plane)
        left = left[~inside]
    return planes


def ridge_pair(planes: list[Plane]) -> tuple[Plane, Plane] | None:
    """The two planes that fall in opposed directions and hold the most points together."""
    limit = math.cos(math.radians(OPPOSED))
    facing = lambda p, q: float(p.slope @ q.slope) / float(np.hypot(*p.slope) * np.hypot(*q.slope))
    pairs = [(p.share + q.share, k, p, q) for k, p in enumerate(planes) for q in planes[:k] if facing(p, q) <= limit]
    return max(pairs, key=lambda pair: (pair[0], -pair[1]))[2:] if pairs else None


def ridge_line(pair: tuple[Plane, Plane]) -> np.ndarray:
    """a, b, c of the line a x + b y = c on which both planes have one height."""
    one, two = pair
    return np.append(one.slope - two.slope, two.base - one.base)


def ridge_on_outline(ring: np.ndarray, line: np.ndarray, least_turn: float = 20.0) -> list[tuple[np.ndarray, float, float]]:
    """Where the ridge meets sides that are not nearly parallel to it: point, distance from the side's middle, and the degrees
    by which the ridge is turned from the side's normal."""
    heights = ring @ line[:2] - line[2]  # of the vertices over the ridge; its sign changes along a side that is met
    along = np.array([-line[1], line[0]]) / np.hypot(*line[:2])
    out = []
    for k in np.flatnonzero(heights[:-1] * heights[1:] < 0):
        start, side = ring[k], ring[k + 1] - ring[k]
        side_way = side / np.hypot(*side)
        across = abs(float(side_way[0] * along[1] - side_way[1] * along[0]))
        if across < math.sin(math.radians(least_turn)):
            continue
        part = heights[k] / (heights[k] - heights[k + 1])
        turn = math.degrees(math.asin(float(np.clip(side_way @ along, -1, 1)))) * np.sign(side_way[0] * along[1] - side_way[1] * along[0])
        out.append((start + part * side, float(abs(part - 0.5) * np.hypot(*side)), float(turn)))
    return out


def wall_line(p: np.ndarray, q: np.ndarray, xy: np.ndarray, most: float = WALL_TURN) -> tuple[np.ndarray, float]:
    """a, b, c of the line a x + b y = c nearest to the points, turned from the side p to q by `most` degrees at most; its turn."""
    middle = xy.mean(axis=0)
    _, axes = np.linalg.eigh(np.cov((xy - middle).T, bias=True))
    way = axes[:, 1]
    side = (q - p) / np.hypot(*(q - p))
    way = way if way @ side >= 0 else -way
    turn = math.atan2(side[0] * way[1] - side[1] * way[0], float(side @ way))
    turn = float(np.clip(turn, -math.radians(most), math.radians(most)))
    cos, sin = math.cos(turn), math.sin(turn)
    way = np.array([cos * side[0] - sin * side[1], sin * side[0] + cos * side[1]])
    normal = np.array([-way[1], way[0]])
    return np.append(normal, normal @ middle), math.degrees(turn)


def corner(one: np.ndarray, two: np.ndarray) -> np.ndarray | None:
    """Where two lines meet, unless they are nearly parallel."""
    det = one[0] * two[1] - one[1] * two[0]
    if abs(det) < 0.1 * np.hypot(*one[:2]) * np.hypot(*two[:2]):
        return None
    return np.array([one[2] * two[1] - one[1] * two[2], one[0] * two[2] - one[2] * two[0]]) / det


SQUARE = np.array([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)])


def projective(corners: np.ndarray) -> np.ndarray:
    """The 3 x 3 matrix that maps four corners, in order, on the unit square: the inverse of the map of the square on them,
    whose last row follows from how far the fourth corner is from completing a parallelogram."""
    origin, size = corners[0], float(np.ptp(corners, axis=0).max())
    p = (corners - origin) / max(size, 1e-12)
    cross = lambda u, v: float(u[0] * v[1] - u[1] * v[0])
    turns = [cross(p[(k + 1) % 4] - p[k], p[(k + 2) % 4] - p[(k + 1) % 4]) for k in range(4)]
    if min(abs(t) for t in turns) < 1e-6:
        raise ValueError("the corners are too nearly in line")
    u, v, gap = p[1] - p[2], p[3] - p[2], p[0] - p[1] + p[2] - p[3]
    g, h = cross(gap, v) / cross(u, v), cross(u, gap) / cross(u, v)
    onto = np.array([[*(p[1] - p[0] + g * p[1])], [*(p[3] - p[0] + h * p[3])], [*p[0]]]).T
    square_to_corners = np.vstack([onto, [g, h, 1.0]])
    back = np.linalg.inv(square_to_corners)
    move = np.array([[1 / size, 0, -origin[0] / size], [0, 1 / size, -origin[1] / size], [0, 0, 1]])
    return back @ move


def apply_projective(h: np.ndarray, xy: np.ndarray) -> np.ndarray:
    out = np.c_[xy, np.ones(len(xy))] @ h.T
    return out[:, :2] / out[:, 2:]
