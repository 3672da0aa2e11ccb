"""Kernels that fit models to the points of one feature at a time; a feature that fails gives a row with its message."""

from __future__ import annotations

import json
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fitting
from ..functions.delaunay import triangulate as delaunay


def per_feature(points: DataFrame, rings: DataFrame, fit: Callable[[np.ndarray, list[np.ndarray]], list[dict]], schema: pa.Schema, extra: tuple[str, ...] = ()) -> DataFrame:
    """fit(xyz, rings) on the points (x, y, z) of each feature, which a task holds alone; rows with feat_id, status, msg.

    A feature's points are those in one polygon, so their number is bounded by its area and the density.
    """
    shapes = rings.groupBy("feat_id").agg(F.sort_array(F.collect_list(F.struct("ring", "seq", "x", "y"))).alias("v")).select("feat_id", F.to_json("v").alias("shape"))
    out_schema = pa.schema([("feat_id", pa.int32()), *[(e, pa.int32()) for e in extra], *schema, ("status", pa.string()), ("msg", pa.string())])

    def run(table: pa.Table, shape: pa.Table) -> pa.Table:
        if not table.num_rows or not shape.num_rows:
            return out_schema.empty_table()
        head = {"feat_id": shape["feat_id"][0].as_py()} | {e: table[e][0].as_py() for e in extra}
        vertices = json.loads(shape["shape"][0].as_py())
        outline = [np.array([(v["x"], v["y"]) for v in vertices if v["ring"] == r]) for r in sorted({v["ring"] for v in vertices})]
        try:
            found = [head | row | {"status": "ok", "msg": None} for row in fit(np.stack([table[a].to_numpy() for a in "xyz"], axis=1), outline)]
        except Exception as error:  # one feature must not end the job
            found = [head | {"status": "failed", "msg": f"{type(error).__name__}: {error}"[:200]}]
        return pa.Table.from_pylist(found, schema=out_schema)

    names = {pa.int32(): "int", pa.int64(): "long", pa.float64(): "double", pa.string(): "string"}
    ddl = ", ".join(f"{f.name} {names[f.type]}" for f in out_schema)
    cols = ["feat_id", *extra, "x", "y", "z"]
    if extra:
        groups = points.select(F.col("feat_id").alias("_f"), *[F.col(e).alias(f"_{e}") for e in extra]).distinct()
        shapes = shapes.join(groups, F.col("feat_id") == F.col("_f")).select("feat_id", *[F.col(f"_{e}").alias(e) for e in extra], "shape")
    return points.select(*cols).groupBy("feat_id", *extra).cogroup(shapes.groupBy("feat_id", *extra)).applyInArrow(run, ddl)


RIDGE = pa.schema([(n, pa.float64()) for n in ("rotation", "dist1", "dist2", "z", "x1", "y1", "x2", "y2")])


def ridge(xyz: np.ndarray, rings: list[np.ndarray], least: int = 10) -> list[dict]:
    """The ridge of a roof of two planes against the sides of its outline."""
    if len(xyz) < least:
        return []
    origin = rings[0].mean(axis=0)
    local = xyz - [*origin, 0]
    pair = fitting.ridge_pair(fitting.find_planes(local))
    if pair is None:
        return []
    hits = fitting.ridge_on_outline(rings[0] - origin, fitting.ridge_line(pair))
    if len(hits) != 2:
        return []
    (p, d1, rotation), (q, d2, _) = hits
    z = float(pair[0].at(np.array([p, q])).mean())
    return [{"rotation": rotation, "dist1": d1, "dist2": d2, "z": z, "x1": p[0] + origin[0], "y1": p[1] + origin[1], "x2": q[0] + origin[0], "y2": q[1] + origin[1]}]


CORNERS = pa.schema([("vertex", pa.int32()), *[(n, pa.float64()) for n in ("x", "y", "u", "v")]])


def _triangles(xyz: np.ndarray) -> np.ndarray:
    """Corners of the triangles; of points with equal x and y the lowest is used, as in tin.triangulate."""
    p = xyz[np.lexsort((xyz[:, 2], xyz[:, 1], xyz[:, 0]))]
    p = p[np.r_[True, (p[1:, :2] != p[:-1, :2]).any(axis=1)]] if len(p) else p
    return p[delaunay(p[:, 0], p[:, 1])]


def well_covered(xyz: np.ndarray, rings: list[np.ndarray], least: int, size: float = 1.5) -> bool:
    """Whether the outline holds that many points, in triangles that are small on the whole and of even size."""
    within = np.zeros(len(xyz), bool)
    for a, b in ((a, b) for ring in rings for a, b in zip(ring, ring[1:], strict=False) if a[1] != b[1]):
        within ^= ((a[1] > xyz[:, 1]) != (b[1] > xyz[:, 1])) & (xyz[:, 0] < (b[0] - a[0]) * (xyz[:, 1] - a[1]) / (b[1] - a[1]) + a[0])
    if within.sum() < max(least, 3):
        return False
    sizes = np.ptp(_triangles(xyz[within])[:, :, :2], axis=1).max(axis=1)
    return len(sizes) > 0 and sizes.mean() <= size and 0.5 * sizes.std() <= sizes.mean()


def wall_points(xyz: np.ndarray, ring: np.ndarray, distance: float = 1.2, angle: float = 45.0, drop: float = 2.0) -> np.ndarray:
    """x, y of the upper ends of walls: corners of triangles steeper than the angle whose heights span over `drop`, that lie over
    `drop` above the lowest point and within the distance of the outline."""
    tri = _triangles(xyz)
    normal = np.cross(tri[:, 1] - tri[:, 0], tri[:, 2] - tri[:, 0])
    steep = (normal[:, 0] ** 2 + normal[:, 1] ** 2 > math.tan(math.radians(angle)) ** 2 * normal[:, 2] ** 2) & (np.ptp(tri[:, :, 2], axis=1) > drop)
    ends = np.unique(tri[steep].reshape(-1, 3), axis=0)
    ends = ends[ends[:, 2] > xyz[:, 2].min() + drop]
    near = np.zeros(len(ends), bool)
    for a, b in zip(ring, ring[1:], strict=False):
        e = b - a
        t = np.clip((ends[:, :2] - a) @ e / max(e @ e, 1e-9), 0, 1)
        near |= np.hypot(*(ends[:, :2] - a - t[:, None] * e).T) < distance
    return ends[near, :2]


def evenly_along(a: np.ndarray, b: np.ndarray, xy: np.ndarray, distance: float = 1.0, least: int = 10) -> np.ndarray | None:
    """The points beside a side and nearer than the distance; none where they are few, or where over 3 of 10 parts of their
    stretch have less than 5 % of them."""
    length = np.linalg.norm(b - a)
    e = (b - a) / max(length, 1e-9)
    along = (xy - a) @ e
    mine = (along >= 0) & (along <= length) & (np.linalg.norm(xy - a - along[:, None] * e, axis=1) < distance)
    if mine.sum() * 2 < least:  # counted by coordinates, two for each point, as the kernel does
        return None
    parts = np.histogram(along[mine], 10)[0] / mine.sum()
    return xy[mine] if (parts < 0.05).sum() <= 3 else None


def wall_corners(xyz: np.ndarray, rings: list[np.ndarray], least: int = 500) -> list[dict]:
    """Corners (x, y) of an outline with those (u, v) of the lines fitted to the wall points along its sides; xyz: the points in the
    outline and 2 m around it. An outline with fewer than `least` points, or large or uneven triangles, has none."""
    if not well_covered(xyz, rings, least):
        return []
    ring = rings[0]
    walls = wall_points(xyz, ring)
    sides = []
    for a, b in zip(ring, ring[1:], strict=False):
        beside = evenly_along(a, b, walls)
        sides.append(None if beside is None else fitting.wall_line(a, b, beside)[0])
    out = []
    for k in range(len(sides)):
        one, two = sides[k - 1], sides[k]
        at = fitting.corner(one, two) if one is not None and two is not None else None
        if at is not None:
            out.append({"vertex": k, "x": float(ring[k, 0]), "y": float(ring[k, 1]), "u": float(at[0]), "v": float(at[1])})
    return out


def ridges_by_strip(found: DataFrame, max_dz: float = 0.5, max_angle: float = 15.0, max_dist: float = 5.0) -> DataFrame:
    """Pairs of a feature's ridges from exactly two strips: distance and rotation between them, mean height."""
    ok = found.where("status = 'ok' and x1 is not null")
    two = ok.groupBy("feat_id").agg(F.countDistinct("pid").alias("strips"), F.sort_array(F.collect_list(F.struct("pid", "z", "x1", "y1", "x2", "y2"))).alias("r")).where("strips = 2 and size(r) = 2")
    a, b = F.col("r")[0], F.col("r")[1]
    ux, uy, vx, vy = a["x2"] - a["x1"], a["y2"] - a["y1"], b["x2"] - b["x1"], b["y2"] - b["y1"]
    cosine = F.try_divide(F.abs(ux * vx + uy * vy), F.sqrt((ux * ux + uy * uy) * (vx * vx + vy * vy)))
    rotation = F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))))
    mid = lambda s, c: (s[f"{c}1"] + s[f"{c}2"]) / 2
    distance = F.sqrt((mid(a, "x") - mid(b, "x")) ** 2 + (mid(a, "y") - mid(b, "y")) ** 2)
    out = two.select("feat_id", a["pid"].cast("string").alias("id1"), b["pid"].cast("string").alias("id2"), distance.alias("pair_dist"), rotation.alias("pair_rot"), ((a["z"] + b["z"]) / 2).alias("z"), F.abs(a["z"] - b["z"]).alias("dz"))
    return out.where((F.col("dz") <= max_dz) & (F.col("pair_rot") < max_angle) & (F.col("pair_dist") < max_dist)).drop("dz")


def burn_patch(cells: DataFrame, corners: np.ndarray, heights: tuple[float, float], xmin: float, ymax: float, cell: float) -> DataFrame:
    """Cells whose centre lies in a quadrilateral get the height between its two ends, along the projective map of the unit
    square; never more than they have."""
    h = fitting.projective(corners)
    x, y = xmin + (F.col("col") + 0.5) * cell, ymax - (F.col("row") + 0.5) * cell
    w = h[2, 0] * x + h[2, 1] * y + h[2, 2]
    u, v = (h[0, 0] * x + h[0, 1] * y + h[0, 2]) / w, (h[1, 0] * x + h[1, 1] * y + h[1, 2]) / w
    inside = u.between(0, 1) & v.between(0, 1)
    burned = heights[0] + (heights[1] - heights[0]) * v
    return cells.withColumn("value", F.when(inside, F.least(F.col("value"), burned)).otherwise(F.col("value")))


def utm(lon: Column, lat: Column, zone: int = 32) -> tuple[Column, Column]:
    """Easting and northing (UTM, GRS80) of degrees, by Krueger's series to the third order: columns in, columns out."""
    a, f = 6378137.0, 1 / 298.257222101
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    e = 2 * math.sqrt(n) / (1 + n)
    phi, lam = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    atanh = lambda v: F.log((1 + v) / (1 - v)) / 2
    t = F.sinh(atanh(F.sin(phi)) - e * atanh(e * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east = eta + sum((alpha[j - 1] * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j in (1, 2, 3)), F.lit(0.0))
    north = xi + sum((alpha[j - 1] * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j in (1, 2, 3)), F.lit(0.0))
    return 500000 + 0.9996 * radius * east, 0.9996 * radius * north
