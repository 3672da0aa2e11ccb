"""Focal operators on points: aggregates over the neighbours within a radius.

measure() has the built-in ones: blocks of cells with a rim of neighbours, where functions/disks.py answers without listing
pairs unless a measure weighs them. around() takes any SQL aggregate: the data points are repeated to the 3 x 3 cells (of a
size not under the radius) around theirs and joined with the query points of each cell, so that the aggregation needs no
second shuffle. There the number of pairs grows with the density, not with the size of the table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import disks


def around(queries: DataFrame, data: DataFrame, radius: float, aggregates: Sequence[Column], keys: Sequence[str], cell: float | None = None, within_radius: bool = True) -> DataFrame:
    """For each query row (told apart by keys, which include x and y): aggregates over the data points near it.

    Aggregates see the query's columns and the neighbour's as n_x, n_y, n_z, ... and d2, the squared distance; d2 is null
    where there is none. Membership is d2 <= radius**2, a point is its own neighbour; without within_radius all points of
    the 3 x 3 cells count.
    """
    cell = cell or radius
    if radius > cell:
        raise ValueError("the radius exceeds the cells that are searched")
    gx, gy = F.floor(F.col("x") / cell).cast("int"), F.floor(F.col("y") / cell).cast("int")
    mine = queries.select(*dict.fromkeys([*keys, *queries.columns])).withColumns({"gx": gx, "gy": gy})
    offsets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    spread = data.select(*[F.col(c).alias(f"n_{c}") for c in data.columns], gx.alias("cx"), gy.alias("cy"), F.explode(offsets).alias("o"))
    spread = spread.withColumns({"gx": F.col("cx") + F.col("o.i"), "gy": F.col("cy") + F.col("o.j")}).drop("o", "cx", "cy")
    d2 = (F.col("n_x") - F.col("x")) ** 2 + (F.col("n_y") - F.col("y")) ** 2
    near = (mine["gx"] == spread["gx"]) & (mine["gy"] == spread["gy"])
    if within_radius:
        near = near & (d2 <= radius * radius)
    pairs = mine.join(spread, near, "left").drop(spread["gx"]).drop(spread["gy"]).withColumn("d2", d2)
    return pairs.groupBy("gx", "gy", *keys).agg(*aggregates).drop("gx", "gy")


BLOCK = 16  # cells along the side of a block

Measure = Callable[[disks.Strips, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _run_by_run(value: Callable[[disks.Disks], np.ndarray]) -> Measure:
    """A measure of the height-free query places, taken once where several queries share a place."""

    def run(strips: disks.Strips, qx: np.ndarray, qy: np.ndarray, own: np.ndarray) -> np.ndarray:
        def places(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            out = np.empty(len(x))
            for at, near in strips.around(x, y):
                out[at] = value(near)
            return out

        return disks.by_place(qx, qy, places)

    return run


def measure(queries: DataFrame, data: DataFrame, radius: float, keys: Sequence[str], how: Measure, cell: float | None = None, within_radius: bool = True) -> DataFrame:
    """keys and the value of `how` for each query row, told apart by keys, which include x and y (and z where it is used).

    Space is cut into blocks of BLOCK cells; a block's task gets its queries and the data points up to the radius beyond it
    (without within_radius: up to two cells). A block's size follows from the density alone.
    """
    cell = cell or radius
    if radius > cell:
        raise ValueError("the radius exceeds the cells that are searched")
    side = cell * BLOCK
    rim = radius * 1.001 if within_radius else 2 * cell
    at = lambda c, d=0.0: F.floor((F.col(c) + d) / side).cast("int")
    mine = queries.select(*keys).withColumns({"_bx": at("x"), "_by": at("y")})
    span = lambda c: F.sequence(at(c, -rim), at(c, rim))
    # other names than the queries': both sides may come from one table
    spread = data.select(*[F.col(c).alias(f"n_{c}") for c in "xyz"]).withColumn("_nx", F.explode(span("n_x"))).withColumn("_ny", F.explode(span("n_y")))

    out_schema = to_arrow_schema(queries.select(*keys).schema.add("value", "double"))

    def run(asked: pa.Table, given: pa.Table) -> pa.Table:
        if not asked.num_rows:  # a side without rows comes without columns
            return out_schema.empty_table()
        if not given.num_rows:
            given = pa.table({f"n_{c}": pa.array([], pa.float64()) for c in "xyz"})
        qx, qy = asked["x"].to_numpy(), asked["y"].to_numpy()
        own = asked["z"].to_numpy() if "z" in keys else np.zeros(len(qx))
        strips = disks.Strips(*(given[f"n_{c}"].to_numpy() for c in "xyz"), radius)
        return asked.select(list(keys)).append_column("value", pa.array(how(strips, qx, qy, own), from_pandas=True))

    types = dict(queries.dtypes)
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keys], "value double"])
    return mine.groupBy("_bx", "_by").cogroup(spread.groupBy("_nx", "_ny")).applyInArrow(run, schema)


def min_filter(queries, data, radius, keys, cell=None):
    return measure(queries, data, radius, keys, _run_by_run(lambda p: p.extreme(np.minimum, p.strips.least)), cell)


def max_filter(queries, data, radius, keys, cell=None):
    return measure(queries, data, radius, keys, _run_by_run(lambda p: p.extreme(np.maximum, p.strips.most)), cell)


def mean_filter(queries, data, radius, keys, cell=None):
    return measure(queries, data, radius, keys, _run_by_run(lambda p: p.mean()), cell)


def median_filter(queries, data, radius, keys, cell=None):
    """The mean of the middle two for an even number."""
    return measure(queries, data, radius, keys, _run_by_run(lambda p: p.median()), cell)


def var_filter(queries, data, radius, keys, cell=None):
    """Population variance; null for fewer than two neighbours."""
    return measure(queries, data, radius, keys, _run_by_run(lambda p: p.variance()), cell)


def idw_filter(queries, data, radius, keys, cell=None):
    """Mean weighted by the inverse squared distance, which counts as 1e-8 at least."""

    def weighted(strips: disks.Strips, qx: np.ndarray, qy: np.ndarray, own: np.ndarray) -> np.ndarray:
        x, y, total, count = disks.merged(strips.x, strips.y, strips.z)
        one = disks.Strips(x, y, np.arange(len(x), dtype=float), radius)  # a row for each place; its height says which
        which = one.z.astype(np.int64)
        total, count = total[which], count[which]

        def value(near: disks.Disks) -> np.ndarray:
            out = np.empty(len(near))
            for a, b, who, rows in near.pairs():
                dx, dy = one.x[rows] - near.qx[a:b][who], one.y[rows] - near.qy[a:b][who]
                w = 1 / np.maximum(dx * dx + dy * dy, 1e-8)
                with np.errstate(invalid="ignore", divide="ignore"):
                    out[a:b] = np.bincount(who, w * total[rows], b - a) / np.bincount(who, w * count[rows], b - a)
            return out

        return _run_by_run(value)(one, qx, qy, own)

    return measure(queries, data, radius, keys, weighted, cell)


def density_filter(queries, data, radius, keys, cell=None):
    """Points per area of the circle; 0 where there are none."""
    return measure(queries, data, radius, keys, _run_by_run(lambda p: p.n / (math.pi * radius * radius)), cell)


def distance_filter(queries, data, cell, keys, max_dist: float | None = None):
    """Distance to the nearest point of the 3 x 3 cells, whatever the radius; with max_dist only within it."""

    def nearest(strips: disks.Strips, qx: np.ndarray, qy: np.ndarray, own: np.ndarray) -> np.ndarray:
        x, y, _, _ = disks.merged(strips.x, strips.y, strips.z)
        d = np.sqrt(disks.by_place(qx, qy, lambda px, py: disks.nearest2(x, y, px, py, cell)))
        return np.where(d <= (np.finfo(float).max if max_dist is None else max_dist), d, np.nan)

    return measure(queries, data, cell, keys, nearest, cell, within_radius=False)


def spike_filter(queries: DataFrame, data: DataFrame, radius: float, tan2: float, z_limit: float, keys: Sequence[str], cell: float | None = None) -> DataFrame:
    """Mean height difference of local extremes with steep neighbours all around; 0 elsewhere.

    dz is the neighbour's height less the query's. A neighbour with abs(dz) over z_limit and dz**2 / d2 over tan2 is steep;
    the others must lie within a fifth of the radius. All quadrants need a steep one, four neighbours (the point itself
    among them) are needed, and dz must not take both signs.
    """
    if "z" not in keys:
        raise ValueError("z must be among the keys")

    def extremes(strips: disks.Strips, qx: np.ndarray, qy: np.ndarray, own: np.ndarray) -> np.ndarray:
        out = np.zeros(len(qx))
        order = np.lexsort((qx, qy))
        at, x, y, z = order, qx[order], qy[order], own[order]
        for share in (0.25, 1.0):  # a smaller disk rules most out: a point of it that is not steep, or dz of both signs
            part = strips if share == 1.0 else disks.Strips(strips.x, strips.y, strips.z, radius * share)
            value = np.zeros(len(at))
            for span, near in part.around(x, y):
                mine = z[span]
                for a, b, who, rows in near.pairs():
                    dx, dy = part.x[rows] - near.qx[a:b][who], part.y[rows] - near.qy[a:b][who]
                    value[span][a:b] = _spike(who, b - a, dx, dy, part.z[rows] - mine[a:b][who], radius, tan2, z_limit, share == 1.0)
            left = value != 0 if share < 1.0 else np.ones(len(at), bool)
            if share == 1.0:
                out[at] = value
            at, x, y, z = at[left], x[left], y[left], z[left]
        return out

    return measure(queries, data, radius, keys, extremes, cell)


def _spike(who: np.ndarray, n: int, dx: np.ndarray, dy: np.ndarray, dz: np.ndarray, radius: float, tan2: float, z_limit: float, whole: bool) -> np.ndarray:
    """The mean dz of places that are spikes, else 0; unless `whole`, 1 of places that may be one, judged by a part of the disk."""
    d2 = dx * dx + dy * dy
    some = lambda mask: np.bincount(who[mask], minlength=n) > 0
    steep = (np.abs(dz) > z_limit) & (dz * dz > tan2 * d2)
    ok = ~some(~steep & (d2 > (0.2 * radius) ** 2)) & ~(some(dz > 1e-6) & some(dz < -1e-6))
    if not whole:
        return ok.astype(float)
    right, up = dx >= 0, dy >= 0
    for quadrant in (right & up, right & ~up, ~right & up, ~right & ~up):
        ok &= some(steep & quadrant)
    count = np.bincount(who, minlength=n)
    ok &= count >= 4
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(ok, np.bincount(who, dz, n) / count, 0.0)


def spatial_sort(points: DataFrame, cell: float) -> DataFrame:
    """Points with their cell, in ranges of cells: nearby points lie together in the written files."""
    keyed = points.withColumns({"gx": F.floor(F.col("x") / cell).cast("int"), "gy": F.floor(F.col("y") / cell).cast("int")})
    return keyed.repartitionByRange("gy", "gx").sortWithinPartitions("gy", "gx")
