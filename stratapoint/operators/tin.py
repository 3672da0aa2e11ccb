"""Triangulated surfaces: rows of triangles with the three corners' coordinates."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.delaunay import triangulate as delaunay

CORNERS = [f"{a}{k}" for k in range(3) for a in "xyz"]
EDGE = 1e-7


def triangulate(points: DataFrame, keys: Sequence[str] = (), block: float = 80.0, halo: float = 12.0) -> DataFrame:
    """keys, tri (an id), x0, y0, z0, ... of the Delaunay triangles of each group of points.

    Space is cut into blocks, and each block's points are triangulated with those of a halo around it; a block keeps the
    triangles whose centre lies in it. So a triangle is right where its circle lies within the halo, which holds for all
    that the validity tolerances accept; those along wide gaps may differ from a triangulation of everything at once.
    Of points with equal x and y the lowest is used.
    """
    span = lambda a: F.sequence(F.floor((F.col(a) - halo) / block).cast("int"), F.floor((F.col(a) + halo) / block).cast("int"))
    flat = points.groupBy(*keys, "x", "y").agg(F.min("z").alias("z"))
    spread = flat.withColumn("bx", F.explode(span("x"))).withColumn("by", F.explode(span("y")))
    types = dict(points.dtypes)
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keys], "tri string", *[f"{c} double" for c in CORNERS]])

    def build(table: pa.Table) -> pa.Table:
        bx, by = table["bx"][0].as_py(), table["by"][0].as_py()
        xyz = np.stack([table[a].to_numpy() for a in "xyz"], axis=1)
        tri = delaunay(xyz[:, 0], xyz[:, 1])
        corners = xyz[tri]
        centre = corners[:, :, :2].mean(axis=1)
        mine = (np.floor(centre[:, 0] / block) == bx) & (np.floor(centre[:, 1] / block) == by)
        corners = corners[mine]
        n = len(corners)
        columns = {k: pa.array([table[k][0].as_py()] * n, table[k].type) for k in keys}
        columns["tri"] = pa.array([f"{bx}_{by}_{k}" for k in range(n)], pa.string())
        columns |= {f"{a}{k}": pa.array(corners[:, k, j]) for k in range(3) for j, a in enumerate("xyz")}
        return pa.table(columns)

    return spread.groupBy(*keys, "bx", "by").applyInArrow(build, schema)


def _c(name: str) -> Column:
    return F.col(name)


def geometry(tin: DataFrame) -> DataFrame:
    """tin with tan2 (of the slope, squared), xy_size (the longer side of its box) and z_range."""
    ux, uy, uz, vx, vy, vz = (_c(f"{a}{k}") - _c(f"{a}0") for k in (1, 2) for a in "xyz")
    nx, ny, nz = uy * vz - uz * vy, uz * vx - ux * vz, ux * vy - uy * vx
    size = lambda a: F.greatest(*[_c(f"{a}{k}") for k in range(3)]) - F.least(*[_c(f"{a}{k}") for k in range(3)])
    return tin.withColumns({"tan2": (nx * nx + ny * ny) / F.when(nz != 0, nz * nz), "xy_size": F.greatest(size("x"), size("y")), "z_range": size("z")})


def valid(max_angle: float = 45.0, tol_xy: float = 2.0, tol_z: float = 1.0) -> Column:
    """Whether a triangle with its geometry is to be trusted; strictly under all tolerances."""
    return (F.col("tan2") < math.tan(math.radians(max_angle)) ** 2) & (F.col("xy_size") < tol_xy) & (F.col("z_range") < tol_z)


def centers(tin: DataFrame) -> DataFrame:
    return tin.withColumns({f"c{a}": (_c(f"{a}0") + _c(f"{a}1") + _c(f"{a}2")) / 3 for a in "xy"})


def locate(queries: DataFrame, tin: DataFrame, qkeys: Sequence[str], on: Sequence[str] = (), block: float = 50.0) -> DataFrame:
    """qkeys, on, and the columns of the triangle that holds each query, with b0, b1, b2; of several on an edge, the first by id.

    Triangles go to the blocks that their box touches, queries to their own. A block's task lays a grid over its triangles, of
    about their own size, and tests each query against those of its cell. on: columns that must be equal, such as the strip
    whose surface is meant.
    """
    box = lambda a, f: f(*[_c(f"{a}{k}") for k in range(3)])
    span = lambda a: F.sequence(F.floor(box(a, F.least) / block).cast("int"), F.floor(box(a, F.greatest) / block).cast("int"))
    rest = [c for c in tin.columns if c not in on]
    # other names than the queries': both sides may come from one table
    spread = tin.withColumn("_nx", F.explode(span("x"))).withColumn("_ny", F.explode(span("y"))).select(*[F.col(c).alias(f"t_{c}") for c in [*rest, *on]], "_nx", "_ny")
    names = list(dict.fromkeys([*qkeys, *on]))
    placed = queries.select(*dict.fromkeys([*names, "x", "y"])).withColumns({"_bx": F.floor(F.col("x") / block).cast("int"), "_by": F.floor(F.col("y") / block).cast("int")})
    struct = T.StructType([*[queries.schema[n] for n in names], *[tin.schema[c] for c in rest if c not in names], *[T.StructField(f"b{k}", T.DoubleType()) for k in range(3)]])
    out_schema = to_arrow_schema(struct)
    extra = [c for c in rest if c not in names]

    def run(asked: pa.Table, given: pa.Table) -> pa.Table:
        if not asked.num_rows or not given.num_rows:  # a side without rows comes without columns
            return out_schema.empty_table()
        given = given.sort_by("t_tri")
        tri = np.stack([np.stack([given[f"t_{a}{k}"].to_numpy() for a in "xy"], axis=1) for k in range(3)])
        q, t = _candidates(np.stack([asked[a].to_numpy() for a in "xy"], axis=1), tri)
        b = _weights(np.stack([asked[a].to_numpy() for a in "xy"], axis=1)[q], tri[:, t])
        hit = (b > -EDGE).all(axis=0)
        q, t, b = q[hit], t[hit], b[:, hit]
        order = np.lexsort((t, q))
        q, t, b = q[order], t[order], b[:, order]
        first = np.r_[True, q[1:] != q[:-1]] if len(q) else np.zeros(0, bool)
        q, t, b = pa.array(q[first]), pa.array(t[first]), b[:, first]
        columns = [asked[n].take(q) for n in names] + [given[f"t_{c}"].take(t) for c in extra] + [pa.array(w) for w in b]
        return pa.Table.from_arrays(columns, names=out_schema.names)

    left = placed.groupBy("_bx", "_by", *on)
    right = spread.groupBy("_nx", "_ny", *[f"t_{c}" for c in on])
    return left.cogroup(right).applyInArrow(run, struct)


def in_blocks(points: DataFrame, block: float, halo: float) -> DataFrame:
    """points once for each block (bx, by) that they lie in, or within the halo of."""
    span = lambda a: F.sequence(F.floor((F.col(a) - halo) / block).cast("int"), F.floor((F.col(a) + halo) / block).cast("int"))
    return points.withColumn("bx", F.explode(span("x"))).withColumn("by", F.explode(span("y")))


BLOCK, HALO = 40.0, 12.0


def over(queries: DataFrame, points: DataFrame, qkeys: Sequence[str], on: Sequence[str] = (), tolerances: tuple[float, float, float] | None = None, prune: bool = False, block: float = BLOCK, halo: float = HALO) -> DataFrame:
    """qkeys, on, the corners of the triangle over points (x, y, z; of the same on) that holds each query, and its weights b0, b1, b2.

    One step instead of triangulate and locate, for surfaces that are not wanted themselves. A block's task triangulates only
    what lies near its queries, and looks further around those whose triangle's circle leaves that ground, up to the halo: the
    triangle is that of all points wherever its circle lies within the halo. tolerances (angle, size, height): a triangle must
    be valid(). Of several triangles at an edge the first counts, by the place of their centres. prune: points of blocks without
    queries are left out before they move.
    """
    names = list(dict.fromkeys([*qkeys, *on]))
    at = {"_bx": F.floor(F.col("x") / block).cast("int"), "_by": F.floor(F.col("y") / block).cast("int")}
    placed = queries.select(*dict.fromkeys([*names, "x", "y"])).withColumns(at)
    spread = in_blocks(points.select(*on, "x", "y", "z"), block, halo).select(*[F.col(c).alias(f"t_{c}") for c in [*on, *"xyz"]], F.col("bx").alias("_nx"), F.col("by").alias("_ny"))
    if prune:
        asked_blocks = queries.withColumns(at).select(F.col("_bx").alias("_nx"), F.col("_by").alias("_ny")).distinct()
        spread = spread.join(asked_blocks, ["_nx", "_ny"], "left_semi")
    struct = T.StructType([*[queries.schema[n] for n in names], *[T.StructField(c, T.DoubleType()) for c in [*[c for c in CORNERS if c not in names], *[f"b{k}" for k in range(3)]]]])
    out_schema = to_arrow_schema(struct)

    def run(asked: pa.Table, given: pa.Table) -> pa.Table:
        if not asked.num_rows or not given.num_rows:  # a side without rows comes without columns
            return out_schema.empty_table()
        q, corners, b = _surface_at(np.stack([asked[a].to_numpy() for a in "xy"], axis=1), np.stack([given[f"t_{a}"].to_numpy() for a in "xyz"], axis=1), halo, tolerances)
        columns = [asked[n].take(pa.array(q)) for n in names] + [pa.array(corners[:, k, j]) for k in range(3) for j in range(3)] + [pa.array(w) for w in b]
        return pa.Table.from_arrays(columns, names=out_schema.names)

    return placed.groupBy("_bx", "_by", *on).cogroup(spread.groupBy("_nx", "_ny", *[f"t_{c}" for c in on])).applyInArrow(run, struct)


def _surface_at(xy: np.ndarray, xyz: np.ndarray, halo: float, tolerances: tuple[float, float, float] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which queries a valid triangle holds, its corners and the weights."""
    order = np.lexsort((xyz[:, 2], xyz[:, 1], xyz[:, 0]))
    xyz = xyz[order]
    xyz = xyz[np.r_[True, (xyz[1:, :2] != xyz[:-1, :2]).any(axis=1)]]
    area = max(float(np.ptp(xyz[:, 0]) * np.ptp(xyz[:, 1])), 1e-6)
    reach = 6 * float(np.sqrt(area / len(xyz)))  # six mean distances
    pending = np.arange(len(xy))
    out_q, out_c, out_b = [], [], []
    while len(pending):
        near = _beside(xyz, xy[pending], reach) if reach < halo else np.ones(len(xyz), bool)
        last = near.mean() > 0.7
        used = xyz if last else xyz[near]
        corners = used[delaunay(used[:, 0], used[:, 1])]
        corners = corners[np.lexsort(corners[:, :, :2].mean(axis=1).T)] if len(corners) else corners
        q, t = _candidates(xy[pending], corners[:, :, :2].transpose(1, 0, 2)) if len(corners) else (np.zeros(0, np.int64),) * 2
        b = _weights(xy[pending][q], corners[t, :, :2].transpose(1, 0, 2))
        hit = (b > -EDGE).all(axis=0)
        q, t, b = q[hit], t[hit], b[:, hit]
        sure = np.ones(len(pending), bool) if last else np.bincount(q, minlength=len(pending)) > 0
        if not last:  # a circle through the triangle lies within its diameter of the query
            sure[q[2 * _radius(corners[t, :, :2]) > reach]] = False
        if tolerances is not None:
            fit = _valid(corners, *tolerances)[t]
            q, t, b = q[fit], t[fit], b[:, fit]
        taken = sure[q]
        q, t, b = q[taken], t[taken], b[:, taken]
        first = np.lexsort((t, q))
        q, t, b = q[first], t[first], b[:, first]
        new = np.r_[True, q[1:] != q[:-1]] if len(q) else np.zeros(0, bool)
        out_q.append(pending[q[new]])
        out_c.append(corners[t[new]])
        out_b.append(b[:, new])
        pending, reach = pending[~sure], reach * 3
    return np.concatenate(out_q), np.concatenate(out_c).reshape(-1, 3, 3), np.concatenate(out_b, axis=1)


def _beside(xyz: np.ndarray, xy: np.ndarray, reach: float) -> np.ndarray:
    """Points in the 3 x 3 cells of the size `reach` around the queries': all that are nearer, at least."""
    low = np.minimum(xyz[:, :2].min(axis=0), xy.min(axis=0)) - reach
    cell = lambda p: np.floor((p - low) / reach).astype(np.int64)
    mine, asked = cell(xyz[:, :2]), cell(xy)
    shape = np.maximum(mine.max(axis=0), asked.max(axis=0)) + 2
    marked = np.zeros(shape, bool)
    asked = np.unique(asked, axis=0)
    for i in (-1, 0, 1):
        for j in (-1, 0, 1):
            marked[asked[:, 0] + i, asked[:, 1] + j] = True
    return marked[mine[:, 0], mine[:, 1]]


def _radius(tri: np.ndarray) -> np.ndarray:
    """Radii of the circles through the corners."""
    a, b, c = tri.transpose(1, 0, 2)
    sides = np.hypot(*(b - a).T) * np.hypot(*(c - b).T) * np.hypot(*(a - c).T)
    cross = (b - a)[:, 0] * (c - a)[:, 1] - (b - a)[:, 1] * (c - a)[:, 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(cross == 0, np.inf, sides / (2 * np.abs(cross)))


def _valid(tri: np.ndarray, max_angle: float, tol_xy: float, tol_z: float) -> np.ndarray:
    """valid() of corners."""
    n = np.cross(tri[:, 1] - tri[:, 0], tri[:, 2] - tri[:, 0])
    flat = n[:, 0] ** 2 + n[:, 1] ** 2 < math.tan(math.radians(max_angle)) ** 2 * n[:, 2] ** 2
    size = np.ptp(tri, axis=1)
    return flat & (size[:, :2].max(axis=1) < tol_xy) & (size[:, 2] < tol_z)


def _candidates(xy: np.ndarray, tri: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query and a triangle whose box lies in the query's cell of a grid."""
    low, high = tri.min(axis=0), tri.max(axis=0)
    cell = float(np.clip(np.median(high - low) * 1.5, 0.1, 10.0))
    base = xy.min(axis=0)
    last = np.floor((xy.max(axis=0) - base) / cell).astype(np.int64)
    lo, hi = np.floor((low - base) / cell).astype(np.int64), np.floor((high - base) / cell).astype(np.int64)
    near = ((hi >= 0) & (lo <= last)).all(axis=1)
    which = np.flatnonzero(near)
    lo, hi = np.clip(lo[near], 0, last), np.clip(hi[near], 0, last)
    wide = hi - lo + 1
    n = wide.prod(axis=1)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    w = np.repeat(wide[:, 0], n)
    cells = (np.repeat(lo[:, 1], n) + k // w) * (last[0] + 1) + np.repeat(lo[:, 0], n) + k % w
    order = np.argsort(cells, kind="stable")
    cells, owner = cells[order], np.repeat(which, n)[order]
    at = np.floor((xy - base) / cell).astype(np.int64)
    code = at[:, 1] * (last[0] + 1) + at[:, 0]
    a, b = np.searchsorted(cells, code), np.searchsorted(cells, code, side="right")
    pick = np.arange((b - a).sum()) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + np.repeat(a, b - a)
    return np.repeat(np.arange(len(xy)), b - a), owner[pick]


def _weights(xy: np.ndarray, tri: np.ndarray) -> np.ndarray:
    """Barycentric weights of points in triangles; -1 where a triangle has no area."""
    (ax, ay), (bx, by), (cx, cy) = (tri[k].T for k in range(3))
    x, y = xy.T
    det = (bx - ax) * (cy - ay) - (cx - ax) * (by - ay)
    with np.errstate(divide="ignore", invalid="ignore"):
        b1 = ((x - ax) * (cy - ay) - (cx - ax) * (y - ay)) / det
        b2 = ((bx - ax) * (y - ay) - (x - ax) * (by - ay)) / det
    return np.where(det == 0, -1.0, np.stack([1 - b1 - b2, b1, b2]))


def height(cut_off: float | None = None) -> Column:
    """The height that weights and corners give. With a cut_off, corners that lie higher than that above the lowest count only
    very near to them."""
    if cut_off is None:
        return sum((_c(f"b{k}") * _c(f"z{k}") for k in range(3)), F.lit(0.0))
    low = F.least(*[_c(f"z{k}") for k in range(3)])
    keep = [~((_c(f"z{k}") - low > cut_off) & (_c(f"b{k}") < 0.99)) for k in range(3)]
    kept = lambda v: sum((F.when(keep[k], v(k)).otherwise(0.0) for k in range(3)), F.lit(0.0))
    return F.try_divide(kept(lambda k: _c(f"b{k}") * _c(f"z{k}")), kept(lambda k: _c(f"b{k}")))


def interpolate(queries: DataFrame, tin: DataFrame, qkeys: Sequence[str], value: str = "h", on: Sequence[str] = (), cut_off: float | None = None) -> DataFrame:
    """Queries that a triangle of the tin holds, with its height there."""
    found = locate(queries, tin, qkeys, on)
    return found.withColumn(value, height(cut_off)).drop(*CORNERS, *[f"b{k}" for k in range(3)], "tan2", "xy_size", "z_range")


def heights(queries: DataFrame, points: DataFrame, qkeys: Sequence[str], value: str = "h", on: Sequence[str] = (), cut_off: float | None = None, tolerances: tuple[float, float, float] | None = None, prune: bool = False) -> DataFrame:
    """Queries that a triangle over the points holds, with its height there; see over()."""
    return over(queries, points, qkeys, on, tolerances, prune).select(*dict.fromkeys([*qkeys, *on]), height(cut_off).alias(value))


def boundary_vertices(tin: DataFrame, bad: Column, points: DataFrame | None = None) -> DataFrame:
    """Distinct corners of the triangles for which bad holds; of points, where given."""
    corners = tin.where(bad).select(F.explode(F.array(*[F.struct(*[_c(f"{a}{k}").alias(a) for a in "xyz"]) for k in range(3)])).alias("v")).select("v.*").distinct()
    return corners if points is None else points.join(corners, ["x", "y", "z"], "left_semi")


def lower_steep(tin: DataFrame, cut_off: float) -> DataFrame:
    """x, y, z, low of corners: the least height that an edge with a drop over cut_off gives them. Within a triangle a
    corner lowered by the next counts lowered for the one before."""
    z = [_c(f"z{k}") for k in range(3)]
    first = F.when(z[0] - z[1] > cut_off, z[1]).otherwise(z[0])
    second = F.when(z[1] - z[2] > cut_off, z[2]).otherwise(z[1])
    third = F.when(z[2] - first > cut_off, first).otherwise(z[2])
    rows = [F.struct(_c(f"x{k}").alias("x"), _c(f"y{k}").alias("y"), z[k].alias("z"), low.alias("low")) for k, low in enumerate((first, second, third))]
    return tin.select(F.explode(F.array(*rows)).alias("v")).select("v.*").groupBy("x", "y", "z").agg(F.min("low").alias("low"))
