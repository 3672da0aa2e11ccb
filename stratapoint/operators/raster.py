"""Raster operators on cells (row, col, value).

A stencil gives every cell to the cells around it and gathers them in one aggregation: one shuffle, combined first, and
no join. Cells without a value have no row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Offset = tuple[int, int]
EIGHT = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
FOUR = [(0, 0), (-1, 0), (1, 0), (0, -1), (0, 1)]


def mesh(spark, rows: int, cols: int, keys: DataFrame | None = None) -> DataFrame:
    """All cells of a raster; the rows of keys (such as tiles) each get one."""
    base = keys if keys is not None else spark.range(1).drop("id")
    return base.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))))


def mesh_points(cells: DataFrame, xmin: float, ymax: float, cell: float) -> DataFrame:
    """Cells with the coordinates of their centres."""
    return cells.withColumns({"x": xmin + (F.col("col") + 0.5) * cell, "y": ymax - (F.col("row") + 0.5) * cell})


def as_points(cells: DataFrame, xmin: float, ymax: float, cell: float) -> DataFrame:
    """x, y, z of the cells that have a value."""
    return mesh_points(cells.where("value is not null"), xmin, ymax, cell).select("x", "y", F.col("value").alias("z"))


def stencil(cells: DataFrame, offsets: Sequence[Offset], aggregates: Sequence[Column], keys: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Aggregates over the cells at the offsets from each; they see di, dj and value. Only cells with a row get one."""
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("di"), F.lit(j).alias("dj")) for i, j in offsets]))
    spread = cells.select(*keys, "row", "col", F.col(value).alias("value"), steps.alias("s"))
    moved = spread.select(*keys, (F.col("row") - F.col("s.di")).alias("row"), (F.col("col") - F.col("s.dj")).alias("col"), F.col("s.di").alias("di"), F.col("s.dj").alias("dj"), "value")
    own = F.bool_or((F.col("di") == 0) & (F.col("dj") == 0)).alias("_own")
    return moved.groupBy(*keys, "row", "col").agg(*aggregates, own).where("_own").drop("_own")


def at(i: int, j: int, value: str = "value") -> Column:
    """The value at an offset, within a stencil's aggregates."""
    return F.max(F.when((F.col("di") == i) & (F.col("dj") == j), F.col(value)))


def hillshade(cells: DataFrame, cell: float, azimuth: float = 315.0, height: float = 45.0, z_factor: float = 1.0, horn: bool = True, keys: Sequence[str] = ()) -> DataFrame:
    """Shade from 1 (dark) to 255; null beside cells without a value and at the edge, so give tiles a halo.

    Slopes by Horn, or by Zevenbergen and Thorne.
    """
    angle, up = math.radians(360 - azimuth + 90), math.radians(height)
    light = (math.cos(angle) * math.cos(up), math.sin(angle) * math.cos(up), math.sin(up))
    kernel = {(-1, -1): -1, (-1, 1): 1, (0, -1): -2, (0, 1): 2, (1, -1): -1, (1, 1): 1} if horn else {(0, -1): -1, (0, 1): 1}
    transposed = {(j, i): w for (i, j), w in kernel.items()}
    scale = z_factor / (cell * (8 if horn else 2))
    used = sorted(set(kernel) | set(transposed))
    got = stencil(cells, sorted({(0, 0), *used}), [at(i, j).alias(f"v_{k}") for k, (i, j) in enumerate(used)], keys)
    v = {o: F.col(f"v_{k}") for k, o in enumerate(used)}
    dx = sum((v[o] * w for o, w in kernel.items()), F.lit(0.0)) * scale
    dy = sum((v[o] * w for o, w in transposed.items()), F.lit(0.0)) * -scale
    lit = (-dx * light[0] - dy * light[1] + light[2]) / F.sqrt(dx * dx + dy * dy + 1)
    shade = F.floor(F.least(F.lit(255.0), F.greatest(F.lit(0.0), lit) * 254 + 1)).cast("int")
    return got.select(*keys, "row", "col", F.when(dx.isNotNull() & dy.isNotNull(), shade).alias("value"))


def bilinear(queries: DataFrame, cells: DataFrame, x_centre: float, cx: float, y_centre: float, cy: float, keys: Sequence[str], value: str = "h") -> DataFrame:
    """queries with the interpolated value of the four cells around each; null outside or where the upper left has none.

    A missing corner takes the value of the one before it, clockwise. x_centre, y_centre: the centre of cell (0, 0).
    """
    px, py = (F.col("x") - x_centre) / cx, (F.lit(y_centre) - F.col("y")) / cy
    placed = queries.withColumns({"_j": F.floor(px).cast("int"), "_i": F.floor(py).cast("int")}).withColumns({"_dx": px - F.col("_j"), "_dy": py - F.col("_i")})
    quads = stencil(cells, [(0, 0), (0, 1), (1, 1), (1, 0)], [at(0, 0).alias("_a"), at(0, 1).alias("_b"), at(1, 1).alias("_c"), at(1, 0).alias("_d"), F.max("di").alias("_down"), F.max("dj").alias("_right")])
    quads = quads.where("_down = 1 and _right = 1 and _a is not null").select(F.col("row").alias("_i"), F.col("col").alias("_j"), "_a", "_b", "_c", "_d")
    b = F.coalesce("_b", "_a")
    c = F.coalesce("_c", b)
    d = F.coalesce("_d", c)
    a, dx, dy = F.col("_a"), F.col("_dx"), F.col("_dy")
    mixed = a + dx * (b - a) + dy * (d - a) + dx * dy * (a - b - d + c)
    return placed.join(quads, ["_i", "_j"], "left").withColumn(value, mixed).drop("_i", "_j", "_dx", "_dy", "_a", "_b", "_c", "_d")


def to_ellipsoidal(points: DataFrame, geoid: DataFrame, x_centre: float, cx: float, y_centre: float, cy: float, back: bool = False) -> DataFrame:
    """z plus (back: minus) the geoid's height; a point that it does not cover is an error."""
    warped = bilinear(points, geoid, x_centre, cx, y_centre, cy, [], "_h")
    known = F.when(F.col("_h").isNull(), F.raise_error(F.lit("the geoid does not cover a point")).cast("double")).otherwise(F.col("_h"))
    return warped.withColumn("z", F.col("z") - known if back else F.col("z") + known).drop("_h")


def resample(cells: DataFrame, out: DataFrame, source: tuple[float, float, float, float], target: tuple[float, float, float, float]) -> DataFrame:
    """Bilinear values at the centres of other cells; the georeferences are (x centre, cx, y centre, cy) of cell (0, 0)."""
    x0, cx, y0, cy = target
    centres = out.select("row", "col", (x0 + F.col("col") * cx).alias("x"), (y0 - F.col("row") * cy).alias("y"))
    return bilinear(centres, cells, *source, ["row", "col"], "value").select("row", "col", "value")


def shift(cells: DataFrame, rows: int = 0, cols: int = 0) -> DataFrame:
    """Cells of a raster that was expanded (or, negative, shrunk) at its upper left."""
    return cells.withColumns({"row": F.col("row") + rows, "col": F.col("col") + cols})


def crop(cells: DataFrame, row: int, col: int, rows: int, cols: int) -> DataFrame:
    """The part of a raster that starts at (row, col), numbered from 0."""
    part = cells.where(F.col("row").between(row, row + rows - 1) & F.col("col").between(col, col + cols - 1))
    return shift(part, -row, -col)


def difference(a: DataFrame, b: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """a - b where both have a value."""
    left, right = a.withColumnRenamed("value", "a"), b.withColumnRenamed("value", "b")
    return left.join(right, [*keys, "row", "col"]).select(*keys, "row", "col", (F.col("a") - F.col("b")).alias("value"))


def burn(cells: DataFrame, mask: DataFrame, value: Column, condition: Column | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Cells of the mask, where the condition holds, get a value; both may use the mask's columns."""
    joined = cells.join(mask.withColumn("_in", F.lit(True)), [*keys, "row", "col"], "left")
    hit = F.col("_in") & (condition if condition is not None else F.lit(True))
    return joined.select(*keys, "row", "col", F.when(hit, value).otherwise(F.col("value")).alias("value"))


def masked_mean(cells: DataFrame, mask: DataFrame, radius: int, keys: Sequence[str] = ()) -> DataFrame:
    """Cells of the mask get the mean over the mask's cells in a square around them; others stay.

    A square's sum is that of rows of sums: two passes of 2 * radius + 1 cells.
    """
    inside = cells.join(mask.select(*keys, "row", "col"), [*keys, "row", "col"], "left_semi")
    span = range(-radius, radius + 1)
    along = lambda df, offs: _spread_sums(df, offs, keys)
    first = along(inside.select(*keys, "row", "col", F.col("value").alias("s"), F.lit(1).alias("n")), [(0, j) for j in span])
    both = along(first, [(i, 0) for i in span]).select(*keys, "row", "col", (F.col("s") / F.col("n")).alias("mean"))
    out = cells.join(inside.select(*keys, "row", "col").withColumn("_in", F.lit(True)), [*keys, "row", "col"], "left").join(both, [*keys, "row", "col"], "left")
    return out.select(*keys, "row", "col", F.when(F.col("_in"), F.col("mean")).otherwise(F.col("value")).alias("value"))


def _spread_sums(df: DataFrame, offsets: Sequence[Offset], keys: Sequence[str]) -> DataFrame:
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("di"), F.lit(j).alias("dj")) for i, j in offsets]))
    moved = df.select(*keys, "row", "col", "s", "n", steps.alias("o")).select(*keys, (F.col("row") + F.col("o.di")).alias("row"), (F.col("col") + F.col("o.dj")).alias("col"), "s", "n")
    return moved.groupBy(*keys, "row", "col").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def flood_step(cells: DataFrame, mask: DataFrame, cut_off: float) -> DataFrame:
    """Cells beside the mask (4-connected), not in it, that rise at most cut_off above their neighbour in it."""
    wet = cells.join(mask.select("row", "col"), ["row", "col"], "left_semi").select("row", "col", F.col("value").alias("v"))
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("di"), F.lit(j).alias("dj")) for i, j in FOUR[1:]]))
    beside = wet.select("v", "row", "col", steps.alias("s")).groupBy((F.col("row") + F.col("s.di")).alias("row"), (F.col("col") + F.col("s.dj")).alias("col")).agg(F.max("v").alias("v"))
    low = cells.join(beside, ["row", "col"]).where(F.col("value") - F.col("v") <= cut_off)
    return low.join(mask.select("row", "col"), ["row", "col"], "left_anti").select("row", "col")


def dilate(mask: DataFrame, offsets: Sequence[Offset] = FOUR, keys: Sequence[str] = ()) -> DataFrame:
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("di"), F.lit(j).alias("dj")) for i, j in offsets]))
    return mask.select(*keys, "row", "col", steps.alias("s")).select(*keys, (F.col("row") + F.col("s.di")).alias("row"), (F.col("col") + F.col("s.dj")).alias("col")).distinct()


def erode(mask: DataFrame, offsets: Sequence[Offset] = FOUR, keys: Sequence[str] = ()) -> DataFrame:
    """Cells all of whose neighbours are in the mask; beyond the raster none are."""
    got = stencil(mask.withColumn("value", F.lit(1)), offsets, [F.count("value").alias("n")], keys)
    return got.where(F.col("n") == len(offsets)).select(*keys, "row", "col")


def maximum(cells: DataFrame, size: int = 5, keys: Sequence[str] = ()) -> DataFrame:
    half = size // 2
    return stencil(cells, [(i, j) for i in range(-half, half + 1) for j in range(-half, half + 1)], [F.max("value").alias("value")], keys)


def fill_gaps(mask: DataFrame, rows: int, cols: int) -> DataFrame:
    """The mask with gaps of one cell closed: between two cells in line, or, with the cells left and right, on a diagonal."""
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("di"), F.lit(j).alias("dj")) for i, j in EIGHT]))
    near = mask.select("row", "col", steps.alias("s")).select((F.col("row") - F.col("s.di")).alias("row"), (F.col("col") - F.col("s.dj")).alias("col"), F.col("s.di").alias("di"), F.col("s.dj").alias("dj"))
    has = lambda i, j: F.bool_or((F.col("di") == i) & (F.col("dj") == j))
    got = near.groupBy("row", "col").agg(has(0, 0).alias("own"), (has(0, -1) & has(0, 1)).alias("h"), (has(-1, 0) & has(1, 0)).alias("v"), ((has(-1, -1) & has(1, 1)) | (has(-1, 1) & has(1, -1))).alias("d"))
    got = got.where(F.col("row").between(0, rows - 1) & F.col("col").between(0, cols - 1))
    line = F.col("own") | (F.col("h") & F.col("col").between(1, cols - 2)) | (F.col("v") & F.col("row").between(1, rows - 2))
    cross = got.where(~F.coalesce(line, F.lit(False)) & F.col("d") & F.col("row").between(1, rows - 2) & F.col("col").between(1, cols - 2))
    sides = cross.withColumn("col", F.explode(F.array(F.col("col") - 1, F.col("col"), F.col("col") + 1))).select("row", "col")
    return got.where(line).select("row", "col").union(sides).distinct()


def gaussian(cells: DataFrame, sigma: float, size: int, keys: Sequence[str] = ()) -> DataFrame:
    """Weighted mean with Gaussian weights over a square of size cells, over the cells that have a value."""
    half = size // 2
    weights = {d: math.exp(-0.5 * (d / sigma) ** 2) for d in range(-half, half + 1)}
    steps = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.lit(w).alias("w")) for d, w in weights.items()]))
    one = cells.where("value is not null").select(*keys, "row", "col", F.col("value").alias("s"), F.lit(1.0).alias("n"))
    for axis in ("row", "col"):
        moved = one.select(*keys, "row", "col", "s", "n", steps.alias("k")).withColumns({axis: F.col(axis) + F.col("k.d"), "s": F.col("s") * F.col("k.w"), "n": F.col("n") * F.col("k.w")})
        one = moved.groupBy(*keys, "row", "col").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    out = one.select(*keys, "row", "col", (F.col("s") / F.col("n")).alias("value"))
    return out.join(cells.where("value is not null").select(*keys, "row", "col"), [*keys, "row", "col"], "left_semi")


def roughness(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Greatest less least value of the 3 x 3 cells; null where one is missing."""
    got = stencil(cells, EIGHT, [F.max("value").alias("hi"), F.min("value").alias("lo"), F.count("value").alias("n")], keys)
    return got.select(*keys, "row", "col", F.when(F.col("n") == 9, F.col("hi") - F.col("lo")).alias("value"))


def blend(rough: DataFrame, sharp: DataFrame, smooth: DataFrame, low: float = 5.0, high: float = 10.0) -> DataFrame:
    """smooth where the roughness is under low, sharp where it is over high, a mix between."""
    a, b, c = rough.withColumnRenamed("value", "a"), sharp.withColumnRenamed("value", "b"), smooth.withColumnRenamed("value", "c")
    w = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("a") - low) / (high - low)))
    return a.join(b, ["row", "col"]).join(c, ["row", "col"]).where("a is not null").select("row", "col", (w * F.col("b") + (1 - w) * F.col("c")).alias("value"))


def contours(cells: DataFrame, interval: float, xmin: float, ymax: float, cell: float) -> DataFrame:
    """Contour pieces (level, x1, y1, x2, y2): each square of four centres is two triangles, each cut by every level."""
    quad = stencil(cells, [(0, 0), (0, 1), (1, 1), (1, 0)], [at(0, 0).alias("a"), at(0, 1).alias("b"), at(1, 1).alias("c"), at(1, 0).alias("d")]).where("a is not null and b is not null and c is not null and d is not null")
    x, y = xmin + (F.col("col") + 0.5) * cell, ymax - (F.col("row") + 0.5) * cell
    corner = {"a": (x, y), "b": (x + cell, y), "c": (x + cell, y - cell), "d": (x, y - cell)}
    point = lambda n: F.struct(corner[n][0].alias("x"), corner[n][1].alias("y"), F.col(n).alias("z"))
    tri = quad.select(F.explode(F.array(*[F.struct(*[point(n).alias(m) for n, m in zip(t, "pqr", strict=True)]) for t in ("abc", "acd")])).alias("t")).select("t.*")
    z = [F.col(f"{m}.z") for m in "pqr"]
    low, high = F.least(*z), F.greatest(*z)
    levels = F.sequence(F.floor(low / interval) + 1, F.floor(high / interval))
    cut = tri.where(F.floor(low / interval) + 1 <= F.floor(high / interval)).withColumn("level", F.explode(levels)).withColumn("level", F.col("level") * interval)
    lev = F.col("level")

    def crossing(m: str, n: str) -> Column:
        u, v = F.col(m), F.col(n)
        t = F.try_divide(lev - u["z"], v["z"] - u["z"])
        across = ((u["z"] < lev) & (v["z"] >= lev)) | ((v["z"] < lev) & (u["z"] >= lev))
        return F.when(across, F.struct((u["x"] + t * (v["x"] - u["x"])).alias("x"), (u["y"] + t * (v["y"] - u["y"])).alias("y")))

    ends = F.filter(F.array(crossing("p", "q"), crossing("q", "r"), crossing("r", "p")), lambda e: e.isNotNull())
    pieces = cut.withColumn("e", ends).where(F.size("e") == 2)
    return pieces.select("level", *[F.col("e")[k][a].alias(f"{a}{k + 1}") for k in (0, 1) for a in "xy"])


FLOW_LIMITS = (1, 10, 25, 50, 100, *(10**k for k in range(3, 10)))


def flow_to_byte(cells: DataFrame) -> DataFrame:
    """The number of limits (1, 10, 25, 50, 100 and the decades to 1e9) that a value reaches; 0: none."""
    return cells.withColumn("value", sum((F.when(F.col("value") >= lim, 1).otherwise(0) for lim in FLOW_LIMITS), F.lit(0)).cast("int"))


def fill_down(surface: DataFrame) -> DataFrame:
    """Voxels (i, j, k) from 0 to below the height k of each column of a surface (i, j, k)."""
    return surface.where("k > 0").withColumn("k", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))


def floating_voxels(voxels: DataFrame, ground: DataFrame) -> DataFrame:
    """Voxels (i, j, k) with how far they lie above the highest ground voxel below them; over no ground, above -1."""
    top = ground.groupBy("i", "j").agg(F.sort_array(F.collect_set("k")).alias("levels"))
    joined = voxels.join(top, ["i", "j"], "left")
    below = F.array_max(F.filter(F.coalesce("levels", F.array().cast("array<int>")), lambda g: g <= F.col("k")))
    return joined.select("i", "j", "k", (F.col("k") - F.coalesce(below, F.lit(-1))).alias("above"))


def grid_extent(xmin: float, ymax: float, cell: float, rows: int, cols: int) -> tuple[float, float, float, float]:
    return xmin, ymax - rows * cell, xmin + cols * cell, ymax


def intersect_extents(a: tuple[float, float, float, float, float], b: tuple[float, float, float, float, float]) -> tuple[float, float, float, float]:
    """Common extent of two rasters (xmin, ymin, xmax, ymax, cell) of one cell size."""
    if abs(a[4] - b[4]) > 1e-9:
        raise ValueError("the cell sizes differ")
    out = max(a[0], b[0]), max(a[1], b[1]), min(a[2], b[2]), min(a[3], b[3])
    if out[0] >= out[2] or out[1] >= out[3]:
        raise ValueError("the extents do not meet")
    return out


def rasterize(spark, vertices: DataFrame, xmin: float, ymax: float, cell: float, rows: int, cols: int, all_touched: bool = False) -> DataFrame:
    """Cells (feat_id, row, col) whose centre a polygon holds; all_touched: also those that its outline passes."""
    from .geometry import points_in_polygons, segments

    centres = mesh_points(mesh(spark, rows, cols), xmin, ymax, cell)
    inside = points_in_polygons(centres, vertices).select("feat_id", "row", "col")
    if not all_touched:
        return inside
    return inside.union(_touched(segments(vertices), xmin, ymax, cell, rows, cols).select("feat_id", "row", "col")).distinct()


def _touched(seg: DataFrame, xmin: float, ymax: float, cell: float, rows: int, cols: int) -> DataFrame:
    """Cells that segments pass: between neighbouring crossings with the lines of the raster a segment lies in one cell. Where it
    passes a corner of cells, two crossings may differ by rounding; such a part counts for none."""
    px = lambda a: (F.col(a) - xmin) / cell
    py = lambda a: (F.lit(ymax) - F.col(a)) / cell
    s = seg.withColumns({"ax": px("x1"), "bx": px("x2"), "ay": py("y1"), "by": py("y2")})
    cuts = lambda a, b: F.when(
        F.floor(F.greatest(a, b)) > F.floor(F.least(a, b)), F.transform(F.sequence(F.floor(F.least(a, b)) + 1, F.floor(F.greatest(a, b))), lambda g: F.try_divide(g - a, b - a))
    ).otherwise(F.array().cast("array<double>"))
    ts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), cuts(F.col("ax"), F.col("bx")), cuts(F.col("ay"), F.col("by")))))
    parts = s.withColumn("ts", ts).withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ts") - 1))).where(F.col("ts")[F.col("k")] - F.col("ts")[F.col("k") - 1] > 1e-9).withColumn("t", (F.col("ts")[F.col("k") - 1] + F.col("ts")[F.col("k")]) / 2)
    out = parts.withColumns({"row": F.floor(F.col("ay") + F.col("t") * (F.col("by") - F.col("ay"))).cast("int"), "col": F.floor(F.col("ax") + F.col("t") * (F.col("bx") - F.col("ax"))).cast("int")})
    return out.where(F.col("row").between(0, rows - 1) & F.col("col").between(0, cols - 1))


def burn_lines(vertices: DataFrame, xmin: float, ymax: float, cell: float, rows: int, cols: int) -> DataFrame:
    """Cells that 3-D lines pass, with the height at the middle of the passage; the mean where several pass."""
    from .geometry import segments

    seg = segments(vertices if "ring" in vertices.columns else vertices.withColumn("ring", F.lit(0)))
    hit = _touched(seg, xmin, ymax, cell, rows, cols)
    return hit.groupBy("row", "col").agg(F.avg(F.col("z1") + F.col("t") * (F.col("z2") - F.col("z1"))).alias("value"))
