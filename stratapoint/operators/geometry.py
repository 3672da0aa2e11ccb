"""Vector predicates. Rings and lines are tables of segments; points meet the segments or features of their own cell."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BROADCAST_SEGMENTS = 200_000  # segments up to which a feature table is sent to all tasks (about 16 MB)
PARALLEL = 1e-10
EDGE = 1e-9


def segments(vertices: DataFrame) -> DataFrame:
    """Segments of rings or lines from vertices (feat_id, ring, seq, x, y[, z])."""
    order = Window.partitionBy("feat_id", "ring").orderBy("seq")
    nxt = [F.lead(c).over(order).alias(f"{c}2") for c in ("x", "y", "z") if c in vertices.columns]
    first = [F.col(c).alias(f"{c}1") for c in ("x", "y", "z") if c in vertices.columns]
    return vertices.select("feat_id", "ring", "seq", *first, *nxt).where("x2 is not null")


def unclosed_rings(vertices: DataFrame) -> DataFrame:
    """Rings whose first and last vertex differ: not polygons."""
    ends = vertices.groupBy("feat_id", "ring").agg(F.min_by(F.struct("x", "y"), "seq").alias("a"), F.max_by(F.struct("x", "y"), "seq").alias("b"))
    return ends.where("a <> b").select("feat_id", "ring")


def boxes(vertices: DataFrame, outer_only: bool = False, grow: float = 0.0) -> DataFrame:
    """Bounding box of each feature."""
    rows = vertices.where("ring = 0") if outer_only else vertices
    return rows.groupBy("feat_id").agg((F.min("x") - grow).alias("xmin"), (F.min("y") - grow).alias("ymin"), (F.max("x") + grow).alias("xmax"), (F.max("y") + grow).alias("ymax"))


def to_cells(df: DataFrame, xmin: Column, ymin: Column, xmax: Column, ymax: Column, cell: float) -> DataFrame:
    """A row for each cell (gx, gy) that the box touches."""
    span = lambda a, b: F.sequence(F.floor(a / cell).cast("int"), F.floor(b / cell).cast("int"))
    return df.withColumn("gx", F.explode(span(xmin, xmax))).withColumn("gy", F.explode(span(ymin, ymax)))


def small_enough(df: DataFrame, limit: int) -> DataFrame:
    """df with a broadcast hint if it has at most limit rows; counting stops there."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def candidates(points: DataFrame, vertices: DataFrame, cell: float, grow: float = 0.0) -> DataFrame:
    """Points beside each feature whose (grown, inclusive) bounding box they lie in: an equi-join on cells."""
    box = boxes(vertices, outer_only="ring" in vertices.columns and grow == 0.0, grow=grow)
    cells = to_cells(box, F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"), cell)
    keyed = points.withColumn("gx", F.floor(F.col("x") / cell).cast("int")).withColumn("gy", F.floor(F.col("y") / cell).cast("int"))
    inside = F.col("x").between(F.col("xmin"), F.col("xmax")) & F.col("y").between(F.col("ymin"), F.col("ymax"))
    return keyed.join(small_enough(cells, BROADCAST_SEGMENTS), ["gx", "gy"]).where(inside).drop("gx", "gy")


def ray_crosses(x: Column, y: Column, far_x: Column, far_y: Column, s) -> Column:
    """Whether the segment s (a struct of x1, y1, x2, y2) meets that from (x, y) to (far_x, far_y)."""
    dx, dy = far_x - x, far_y - y
    ex, ey = s["x2"] - s["x1"], s["y2"] - s["y1"]
    det = dx * ey - dy * ex
    px, py = s["x1"] - x, s["y1"] - y
    safe = F.when(F.abs(det) >= PARALLEL, det)  # else null, and no crossing
    t, u = (px * ey - py * ex) / safe, (px * dy - py * dx) / safe
    within = lambda v: (v > -EDGE) & (v < 1 + EDGE)
    return F.coalesce(within(t) & within(u), F.lit(False))


UNROLLED = 3  # segments of an array that compiled code goes through; a function called for each, several times slower, takes the rest


def _rest(segments: Column) -> Column:
    return F.slice(segments, UNROLLED + 1, F.greatest(F.size(segments), F.lit(1)))


def crossings(segments: Column, crosses: Callable[[Column], Column]) -> Column:
    """How many segments of an array the ray crosses."""
    few = [F.coalesce(crosses(F.get(segments, F.lit(k))), F.lit(False)).cast("int") for k in range(UNROLLED)]
    more = F.aggregate(_rest(segments), F.lit(0), lambda n, s: n + crosses(s).cast("int"))
    return reduce(add, few) + F.when(F.size(segments) > UNROLLED, more).otherwise(0)


def any_segment(segments: Column, holds: Callable[[Column], Column]) -> Column:
    few = [F.coalesce(holds(F.get(segments, F.lit(k))), F.lit(False)) for k in range(UNROLLED)]
    return reduce(or_, few) | ((F.size(segments) > UNROLLED) & F.exists(_rest(segments), holds))


def points_in_polygons(points: DataFrame, vertices: DataFrame, cell: float = 50.0) -> DataFrame:
    """Points with the feat_id of each polygon that holds them.

    A ray to (xmax + 10, y + 8.1234) crosses the segments of all rings an odd number of times. Each polygon's segments
    are one array beside its box, so a point is tested where it lies, without a shuffle per segment.
    """
    rings = segments(vertices).groupBy("feat_id").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("ring_segments"))
    near = candidates(points, vertices, cell)
    both = near.join(small_enough(rings, BROADCAST_SEGMENTS // 50), "feat_id")
    met = crossings(F.col("ring_segments"), lambda s: ray_crosses(F.col("x"), F.col("y"), F.col("xmax") + 10, F.col("y") + 8.1234, s))
    return both.where(met % 2 == 1).drop("ring_segments", "xmin", "ymin", "xmax", "ymax")


def distance2(x: Column, y: Column, s) -> Column:
    """Squared distance from a point to a segment."""
    ex, ey = s["x2"] - s["x1"], s["y2"] - s["y1"]
    size = ex * ex + ey * ey
    t = F.when(size > 0, ((x - s["x1"]) * ex + (y - s["y1"]) * ey) / size).otherwise(0.0)
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    dx, dy = x - s["x1"] - t * ex, y - s["y1"] - t * ey
    return dx * dx + dy * dy


def points_near_lines(points: DataFrame, vertices: DataFrame, distance: float, cell: float | None = None) -> DataFrame:
    """Points with the feat_id of each line nearer than distance (strictly), once for each line."""
    cell = cell or max(distance * 2, 10.0)
    lines = vertices if "ring" in vertices.columns else vertices.withColumn("ring", F.lit(0))
    seg = segments(lines).select("feat_id", "x1", "y1", "x2", "y2")
    lo = lambda a: F.least(F.col(f"{a}1"), F.col(f"{a}2")) - distance
    hi = lambda a: F.greatest(F.col(f"{a}1"), F.col(f"{a}2")) + distance
    cells = to_cells(seg, lo("x"), lo("y"), hi("x"), hi("y"), cell)
    by_cell = cells.groupBy("gx", "gy", "feat_id").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("near"))
    keyed = points.withColumn("gx", F.floor(F.col("x") / cell).cast("int")).withColumn("gy", F.floor(F.col("y") / cell).cast("int"))
    both = keyed.join(small_enough(by_cell, BROADCAST_SEGMENTS // 4), ["gx", "gy"])
    return both.where(any_segment(F.col("near"), lambda s: distance2(F.col("x"), F.col("y"), s) < distance * distance)).drop("near", "gx", "gy")


def clip_segment(s: Column, box: Column) -> Column:
    """The part of a segment (x1, y1, x2, y2) inside a box; null where there is none (Liang-Barsky)."""
    dx, dy = s["x2"] - s["x1"], s["y2"] - s["y1"]
    t0, t1, outside = F.lit(0.0), F.lit(1.0), F.lit(False)
    for p, q in ((-dx, s["x1"] - box["xmin"]), (dx, box["xmax"] - s["x1"]), (-dy, s["y1"] - box["ymin"]), (dy, box["ymax"] - s["y1"])):
        r = q / F.when(p != 0, p)
        t0 = F.greatest(t0, F.when(p < 0, r))
        t1 = F.least(t1, F.when(p > 0, r))
        outside = outside | ((p == 0) & (q < 0))
    part = F.struct((s["x1"] + t0 * dx).alias("x1"), (s["y1"] + t0 * dy).alias("y1"), (s["x1"] + t1 * dx).alias("x2"), (s["y1"] + t1 * dy).alias("y2"))
    return F.when(~outside & (t0 <= t1), part)


def polygon_area(vertices: DataFrame) -> DataFrame:
    """Area of each polygon: its outer ring without its holes, by the shoelace formula."""
    ring = segments(vertices).groupBy("feat_id", "ring").agg((F.abs(F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1"))) / 2).alias("a"))
    return ring.groupBy("feat_id").agg(F.sum(F.when(F.col("ring") == 0, F.col("a")).otherwise(-F.col("a"))).alias("area"))


def polygon_wkt(vertices: DataFrame) -> DataFrame:
    """WKT of each polygon."""
    ring = vertices.groupBy("feat_id", "ring").agg(F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("v"))
    text = ring.select("feat_id", "ring", F.concat(F.lit("("), F.array_join(F.transform("v", lambda p: F.format_string("%.2f %.2f", p["x"], p["y"])), ","), F.lit(")")).alias("t"))
    rings = text.groupBy("feat_id").agg(F.sort_array(F.collect_list(F.struct("ring", "t"))).alias("r"))
    return rings.select("feat_id", F.concat(F.lit("POLYGON("), F.array_join("r.t", ","), F.lit(")")).alias("wkt"))


def clip_polygons(vertices: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Rings (feat_id, ring, seq, x, y) of the parts of polygons inside a box, closed; rings without area there are dropped.

    Each ring is cut by one side of the box after the other, in the task that holds it.
    """
    import pyarrow as pa

    schema = pa.schema([("feat_id", pa.int32()), ("ring", pa.int32()), ("seq", pa.int32()), ("x", pa.float64()), ("y", pa.float64())])
    sides = [(0, xmin, 1), (0, xmax, -1), (1, ymin, 1), (1, ymax, -1)]

    def cut(table: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        ring = list(zip(table["x"].to_pylist(), table["y"].to_pylist(), strict=True))[:-1]
        for axis, limit, sign in sides:
            kept = []
            for a, b in zip(ring, ring[1:] + ring[:1], strict=True):
                in_a, in_b = sign * (a[axis] - limit) >= 0, sign * (b[axis] - limit) >= 0
                if in_a:
                    kept.append(a)
                if in_a != in_b:
                    t = (limit - a[axis]) / (b[axis] - a[axis])
                    at = [a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])]
                    at[axis] = limit
                    kept.append(tuple(at))
            ring = kept
        area = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) if ring else 0.0
        ring = [*ring, ring[0]] if ring and abs(area) > 1e-9 else []
        n = len(ring)
        head = [pa.array([table[c][0].as_py()] * n, pa.int32()) for c in ("feat_id", "ring")]
        return pa.Table.from_arrays([*head, pa.array(range(n), pa.int32()), *[pa.array([p[k] for p in ring], pa.float64()) for k in (0, 1)]], schema=schema)

    return vertices.select("feat_id", "ring", "seq", "x", "y").groupBy("feat_id", "ring").applyInArrow(cut, "feat_id int, ring int, seq int, x double, y double")
