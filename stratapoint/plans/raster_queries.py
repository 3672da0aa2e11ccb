"""Queries over rasters: hillshade, interpolation, morphology, regions, contours, rasterising."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import focal, geometry, raster, regions
from ..operators import points as P
from . import derived as D
from .derived import sql
from .point_queries import _RAY, _SPIKE, _around_sql

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
SIDE = 20  # cells of the 10 m grid; the points' lower edge adds a row
GEO = (D.GEOID[0] + 25, 50.0, D.GEOID[2] - 25, 50.0)  # centre of the geoid's first cell


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def square(s: SparkSession, d: str) -> DataFrame:
    """The 10 m grid without the row below its extent."""
    return D.grid(s, d).where(f"row < {SIDE}")


_G = "g AS (SELECT row, col, value FROM grid WHERE row < 20)"


def _grid_sql(text: str, *more: str) -> str:
    return sql(text, "points", "grid", *more).replace(D.SQL["grid"], D.SQL["grid"] + ",\n" + _G, 1)


@query("mesh_as_points", f"SELECT r::INT AS row, c::INT AS col, {D.X0}::DOUBLE + (c + 0.5) * 10 AS x, {D.Y1}::DOUBLE - (r + 0.5) * 10 AS y FROM range(20) a(r), range(20) b(c)")
def mesh_as_points(s, d):
    return raster.mesh_points(raster.mesh(s, SIDE, SIDE), D.X0, D.Y1, 10.0)


@query("grid_to_points", _grid_sql(f"SELECT {D.X0}::DOUBLE + (col + 0.5) * 10 AS x, {D.Y1}::DOUBLE - (row + 0.5) * 10 AS y, value AS z FROM g"))
def grid_to_points(s, d):
    return raster.as_points(square(s, d), D.X0, D.Y1, 10.0)


@query("density_check", _grid_sql(f"""SELECT '1km_6173_632' AS km_name, min(n) / 100 AS min_point_density, avg(n) / 100 AS mean_point_density, 10.0::DOUBLE AS cell_size FROM (
  SELECT m.row, m.col, count(p.k) AS n FROM (SELECT r::INT AS row, c::INT AS col FROM range(20) a(r), range(20) b(c)) m
  LEFT JOIN (SELECT *, CASE WHEN y = {D.Y0}::DOUBLE THEN 19 ELSE floor(({D.Y1}::DOUBLE - y) / 10)::INT END AS row, CASE WHEN x = {D.X1}::DOUBLE THEN 19 ELSE floor((x - {D.X0}::DOUBLE) / 10)::INT END AS col FROM points) p USING (row, col)
  WHERE (m.row, m.col) NOT IN (SELECT (row, col) FROM g WHERE value < 28) GROUP BY ALL)"""))
def density_check(s, d):
    counts = A.in_cells(D.points(s, d), D.X0, D.Y1, 10.0, (SIDE, SIDE), closed=True).groupBy("row", "col").agg(F.count(F.lit(1)).alias("n"))
    every = raster.mesh(s, SIDE, SIDE).join(counts, ["row", "col"], "left").select("row", "col", (F.coalesce("n", F.lit(0)) / 100).alias("value"))
    dry = every.join(square(s, d).where("value < 28").select("row", "col"), ["row", "col"], "left_anti")
    return dry.agg(F.coalesce(F.min("value"), F.lit(-2.0)).alias("min_point_density"), F.coalesce(F.avg("value"), F.lit(-2.0)).alias("mean_point_density")).select(
        F.lit("1km_6173_632").alias("km_name"), "min_point_density", "mean_point_density", F.lit(10.0).alias("cell_size")
    )


def _shade_sql(kernel: dict, factor: int) -> str:
    ang, up = math.radians(360 - 315 + 90), math.radians(45)
    lx, ly, lz = math.cos(ang) * math.cos(up), math.sin(ang) * math.cos(up), math.sin(up)
    used = sorted(set(kernel) | {(j, i) for i, j in kernel})
    joins = " ".join(f"JOIN g v{k} ON v{k}.row = o.row + {i} AND v{k}.col = o.col + {j}" for k, (i, j) in enumerate(used))
    dx = " + ".join(f"{w} * v{used.index(o)}.value" for o, w in kernel.items())
    dy = " + ".join(f"{w} * v{used.index((o[1], o[0]))}.value" for o, w in kernel.items())
    return _grid_sql(
        f"""SELECT row, col, floor(least(255.0::DOUBLE, greatest(0.0::DOUBLE, (-dx * {lx}::DOUBLE - dy * {ly}::DOUBLE + {lz}::DOUBLE) / sqrt(dx * dx + dy * dy + 1)) * 254 + 1))::INT AS value
 FROM (SELECT o.row, o.col, ({dx}) / {10.0 * factor}::DOUBLE AS dx, ({dy}) / {-10.0 * factor}::DOUBLE AS dy FROM g o {joins})"""
    )


_HORN = {(-1, -1): -1, (-1, 1): 1, (0, -1): -2, (0, 1): 2, (1, -1): -1, (1, 1): 1}


@query("hillshade_horn", _shade_sql(_HORN, 8))
def hillshade_horn(s, d):
    return raster.hillshade(square(s, d), 10.0).where("value is not null")


@query("hillshade_zevenbergen_thorne", _shade_sql({(0, -1): -1, (0, 1): 1}, 2))
def hillshade_zt(s, d):
    return raster.hillshade(square(s, d), 10.0, horn=False).where("value is not null")


_BILIN = f"""SELECT k, x, y, z, c, pid, rn, a.value + dx * (b.value - a.value) + dy * (d.value - a.value) + dx * dy * (a.value - b.value - d.value + c4.value) AS h FROM (
 SELECT *, floor(px)::INT AS j, floor(py)::INT AS i, px - floor(px) AS dx, py - floor(py) AS dy FROM (SELECT *, (x - {GEO[0]}::DOUBLE) / 50.0::DOUBLE AS px, ({GEO[2]}::DOUBLE - y) / 50.0::DOUBLE AS py FROM points)) p
 LEFT JOIN geoid a ON a.row = i AND a.col = j LEFT JOIN geoid b ON b.row = i AND b.col = j + 1 LEFT JOIN geoid c4 ON c4.row = i + 1 AND c4.col = j + 1 LEFT JOIN geoid d ON d.row = i + 1 AND d.col = j"""


@query("bilinear_interpolation", sql(_BILIN, "points", "geoid"))
def bilinear_interpolation(s, d):
    key = ["k", "x", "y", "z", "c", "pid", "rn"]
    return raster.bilinear(D.points(s, d).select(*key), D.geoid(s), *GEO, key)


@query("to_ellipsoidal", sql(f"SELECT k, x, y, z + h AS z FROM ({_BILIN})", "points", "geoid"))
def to_ellipsoidal(s, d):
    return raster.to_ellipsoidal(D.points(s, d).select("k", "x", "y", "z"), D.geoid(s), *GEO)


@query("dvr90", sql(f"SELECT k, x, y, z - h AS z FROM ({_BILIN})", "points", "geoid"))
def dvr90(s, d):
    return raster.to_ellipsoidal(D.points(s, d).select("k", "x", "y", "z"), D.geoid(s), *GEO, back=True).select("k", "x", "y", "z")


@query("resample_grid", f"WITH {D.SQL['geoid']} SELECT r::INT AS row, q::INT AS col, 36 + (({GEO[2]} - (6174090.0 - r * 20)) / 50.0::DOUBLE) / 8 + (((632910.0 + q * 20) - {GEO[0]}) / 50.0::DOUBLE) / 16 AS value FROM range(10) a(r), range(10) b(q)")
def resample_grid(s, d):
    return raster.resample(D.geoid(s), raster.mesh(s, 10, 10), GEO, (632910.0, 20.0, 6174090.0, 20.0))


@query("crop_grid", _grid_sql("SELECT row - 5 AS row, col - 4 AS col, value FROM g WHERE row BETWEEN 5 AND 14 AND col BETWEEN 4 AND 11"))
def crop_grid(s, d):
    return raster.crop(square(s, d), 5, 4, 10, 8)


@query("demdiff", _grid_sql(f"SELECT row, col, g.value - o.value AS value FROM g JOIN (SELECT floor(({D.Y1}::DOUBLE - y) / 10)::INT AS row, floor((x - {D.X0}::DOUBLE) / 10)::INT AS col, avg(z) AS value FROM points_old GROUP BY 1, 2) o USING (row, col)", "points_old"))
def demdiff(s, d):
    old = A.aggregate_grid(D.points_old(s, d), D.X0, D.Y1, 10.0, F.avg("z"))
    return raster.difference(square(s, d), old)


@query("burn_lakes", _grid_sql("SELECT row, col, CASE WHEN col BETWEEN 5 AND 9 AND value > 29 THEN 29.0 ELSE value END AS value FROM g"))
def burn_lakes(s, d):
    mask = raster.mesh(s, SIDE, SIDE).where("col between 5 and 9")
    return raster.burn(square(s, d), mask, F.lit(29.0), F.col("value") > 29)


@query("masked_mean_filter", _grid_sql("""SELECT g.row, g.col, round(CASE WHEN g.value > 29 THEN avg(n.value) ELSE any_value(g.value) END, 9) AS value FROM g LEFT JOIN g n ON n.value > 29 AND abs(n.row - g.row) <= 2 AND abs(n.col - g.col) <= 2 GROUP BY g.row, g.col, g.value"""))
def masked_mean_filter(s, d):
    g = square(s, d)
    return raster.masked_mean(g, g.where("value > 29"), 2).withColumn("value", F.round("value", 9))


@query("flood_cells", _grid_sql("SELECT DISTINCT g.row, g.col FROM g JOIN g m ON m.value < 28 AND abs(m.row - g.row) + abs(m.col - g.col) = 1 WHERE g.value >= 28 AND g.value - m.value <= 1"))
def flood_cells(s, d):
    g = square(s, d)
    return raster.flood_step(g, g.where("value < 28"), 1.0)


@query("maximum_filter", _grid_sql("SELECT g.row, g.col, max(n.value) AS value FROM g JOIN g n ON abs(n.row - g.row) <= 2 AND abs(n.col - g.col) <= 2 GROUP BY 1, 2"))
def maximum_filter(s, d):
    return raster.maximum(square(s, d), 5)


@query("binary_dilation", _grid_sql("SELECT DISTINCT m.row + i AS row, m.col + j AS col FROM g m, (VALUES (0, 0), (-1, 0), (1, 0), (0, -1), (0, 1)) o(i, j) WHERE m.value > 31"))
def binary_dilation(s, d):
    return raster.dilate(square(s, d).where("value > 31"))


@query("binary_erosion", _grid_sql("SELECT m.row, m.col FROM g m JOIN g n ON n.value > 29 AND abs(n.row - m.row) + abs(n.col - m.col) <= 1 WHERE m.value > 29 GROUP BY 1, 2 HAVING count(*) = 5"))
def binary_erosion(s, d):
    return raster.erode(square(s, d).where("value > 29"))


_GAPS = """, m AS (SELECT row, col FROM g WHERE value > 30), e AS (SELECT r::INT AS row, c::INT AS col FROM range(20) a(r), range(20) b(c)),
h AS (SELECT e.row, e.col, (e.row, e.col) IN (SELECT (row, col) FROM m) AS own,
 e.col BETWEEN 1 AND 18 AND (e.row, e.col - 1) IN (SELECT (row, col) FROM m) AND (e.row, e.col + 1) IN (SELECT (row, col) FROM m) AS h,
 e.row BETWEEN 1 AND 18 AND (e.row - 1, e.col) IN (SELECT (row, col) FROM m) AND (e.row + 1, e.col) IN (SELECT (row, col) FROM m) AS v,
 e.row BETWEEN 1 AND 18 AND e.col BETWEEN 1 AND 18 AND (((e.row - 1, e.col - 1) IN (SELECT (row, col) FROM m) AND (e.row + 1, e.col + 1) IN (SELECT (row, col) FROM m)) OR ((e.row - 1, e.col + 1) IN (SELECT (row, col) FROM m) AND (e.row + 1, e.col - 1) IN (SELECT (row, col) FROM m))) AS d FROM e)
SELECT row, col FROM h WHERE own OR h OR v UNION SELECT row, col + o FROM h, (VALUES (-1), (0), (1)) x(o) WHERE d AND NOT (own OR h OR v)"""


@query("binary_fill_gaps", _grid_sql("").rstrip() + _GAPS)
def binary_fill_gaps(s, d):
    return raster.fill_gaps(square(s, d).where("value > 30"), SIDE, SIDE)


_W = {k: math.exp(-0.5 * (k / 3.0) ** 2) for k in range(-6, 7)}


@query("gaussian_smoothing", _grid_sql(f"""SELECT g.row, g.col, round(sum(n.value * a.w * b.w) / sum(a.w * b.w), 6) AS value FROM g JOIN (VALUES {", ".join(f"({k}, {w}::DOUBLE)" for k, w in _W.items())}) a(i, w) ON TRUE
 JOIN (VALUES {", ".join(f"({k}, {w}::DOUBLE)" for k, w in _W.items())}) b(j, w) ON TRUE JOIN g n ON n.row = g.row + a.i AND n.col = g.col + b.j GROUP BY 1, 2"""))
def gaussian_smoothing(s, d):
    return raster.gaussian(square(s, d), 3.0, 13).withColumn("value", F.round("value", 6))


@query("roughness", _grid_sql("SELECT g.row, g.col, CASE WHEN count(*) = 9 THEN max(n.value) - min(n.value) END AS value FROM g JOIN g n ON abs(n.row - g.row) <= 1 AND abs(n.col - g.col) <= 1 GROUP BY 1, 2"))
def roughness(s, d):
    return raster.roughness(square(s, d))


@query("flow_to_byte", _grid_sql("SELECT row, col, (v >= 1)::INT + (v >= 10)::INT + (v >= 25)::INT + (v >= 50)::INT + (v >= 100)::INT + (v >= 1000)::INT + (v >= 10000)::INT + (v >= 100000)::INT + (v >= 1000000)::INT + (v >= 10000000)::INT + (v >= 100000000)::INT + (v >= 1000000000)::INT AS value FROM (SELECT row, col, pow(value / 10, 3.0) * pow(col, 4.0) AS v FROM g)"))
def flow_to_byte(s, d):
    return raster.flow_to_byte(square(s, d).withColumn("value", F.pow(F.col("value") / 10, F.lit(3.0)) * F.pow("col", F.lit(4.0))))


@query("contours")
def contours(s, d):
    smooth = raster.gaussian(square(s, d), 3.0, 13)
    joined = raster.blend(raster.roughness(square(s, d)), square(s, d), smooth)
    return raster.contours(joined, 0.5, D.X0, D.Y1, 10.0)


_CENTRES = f"points AS (SELECT r * 1000 + q AS k, {D.X0}::DOUBLE + (q + 0.5) * 5 AS x, {D.Y1}::DOUBLE - (r + 0.5) * 5 AS y, 0 AS z, 0 AS c, 0 AS pid, 0 AS rn, '' AS tile FROM range(40) a(r), range(40) b(q))"


@query("rasterize_polygons", "WITH " + _CENTRES + ",\n" + D.SQL["polygons"] + ",\n" + _RAY + " SELECT feat_id, (k // 1000)::INT AS row, (k % 1000)::INT AS col FROM hit")
def rasterize_polygons(s, d):
    return raster.rasterize(s, D.polygons(s), D.X0, D.Y1, 5.0, 40, 40)


def _touched_sql(name: str) -> str:
    """Segments of a feature table clipped to each 5 m cell of their box: sid, z1, z2, row, col and the middle t of what is left."""
    return f"""sg AS (SELECT *, row_number() OVER () AS sid FROM (SELECT feat_id, z AS z1, lead(z) OVER w AS z2, (x - {D.X0}::DOUBLE) / 5 AS ax, ({D.Y1}::DOUBLE - y) / 5 AS ay,
  (lead(x) OVER w - {D.X0}::DOUBLE) / 5 AS bx, ({D.Y1}::DOUBLE - lead(y) OVER w) / 5 AS yb FROM {name} WINDOW w AS (PARTITION BY feat_id, ring ORDER BY seq)) WHERE bx IS NOT NULL),
 cells AS (SELECT r::INT AS row, q::INT AS col FROM range(40) a(r), range(40) b(q)),
 cl AS (SELECT sg.*, row, col, greatest(0, CASE WHEN bx = ax THEN CASE WHEN floor(ax) = col THEN 0 ELSE 2 END ELSE least((col - ax) / (bx - ax), (col + 1 - ax) / (bx - ax)) END,
   CASE WHEN yb = ay THEN CASE WHEN floor(ay) = row THEN 0 ELSE 2 END ELSE least((row - ay) / (yb - ay), (row + 1 - ay) / (yb - ay)) END) AS t0,
  least(1, CASE WHEN bx = ax THEN 1 ELSE greatest((col - ax) / (bx - ax), (col + 1 - ax) / (bx - ax)) END, CASE WHEN yb = ay THEN 1 ELSE greatest((row - ay) / (yb - ay), (row + 1 - ay) / (yb - ay)) END) AS t1
  FROM sg JOIN cells ON col BETWEEN floor(least(ax, bx)) AND floor(greatest(ax, bx)) AND row BETWEEN floor(least(ay, yb)) AND floor(greatest(ay, yb))),
 touched AS (SELECT *, (t0 + t1) / 2 AS t FROM cl WHERE t1 - t0 > 1e-9)"""


@query("rasterize_all_touched", "WITH " + _CENTRES + ",\n" + D.SQL["polygons"] + ",\n" + _RAY + ",\n" + _touched_sql("polygons") + " SELECT feat_id, (k // 1000)::INT AS row, (k % 1000)::INT AS col FROM hit UNION SELECT feat_id, row, col FROM touched")
def rasterize_all_touched(s, d):
    return raster.rasterize(s, D.polygons(s), D.X0, D.Y1, 5.0, 40, 40, all_touched=True)


@query("burn_3d_lines", "WITH " + D.SQL["lines"] + ",\n" + _touched_sql("lines") + " SELECT row, col, round(avg(z1 + t * (z2 - z1)), 6) AS value FROM touched GROUP BY 1, 2")
def burn_3d_lines(s, d):
    return raster.burn_lines(D.lines(s), D.X0, D.Y1, 5.0, 40, 40).withColumn("value", F.round("value", 6))


_COMP = """, m AS (SELECT row, col FROM g WHERE value > 30), r(row, col, root) AS (SELECT row, col, row * 100 + col FROM m UNION
 SELECT n.row, n.col, r.root FROM r JOIN m n ON abs(n.row - r.row) + abs(n.col - r.col) = 1)
SELECT row, col, (min(root) // 100)::VARCHAR || '_' || (min(root) % 100)::VARCHAR AS label FROM r GROUP BY 1, 2"""


@query("connected_components", _grid_sql("").rstrip().replace("WITH ", "WITH RECURSIVE ", 1) + _COMP)
def connected_components(s, d):
    return regions.label(square(s, d).where("value > 30").select("row", "col"))


@query("expand_water", _grid_sql("").rstrip().replace("WITH ", "WITH RECURSIVE ", 1) + """, m AS (SELECT row, col FROM g WHERE value > 30), w AS (SELECT row, col FROM g WHERE col < 8 AND value > 29),
r(row, col, root) AS (SELECT row, col, row * 100 + col FROM m UNION SELECT n.row, n.col, r.root FROM r JOIN m n ON abs(n.row - r.row) + abs(n.col - r.col) = 1),
lab AS (SELECT row, col, min(root) AS label FROM r GROUP BY 1, 2), wet AS (SELECT lab.*, (row, col) IN (SELECT (row, col) FROM w) AS inw FROM lab),
mixed AS (SELECT label FROM wet GROUP BY 1 HAVING bool_or(inw) AND NOT bool_and(inw))
SELECT row, col FROM w UNION SELECT row, col FROM lab WHERE label IN (SELECT label FROM mixed)""")
def expand_water(s, d):
    g = square(s, d)
    return regions.expand_water(g.where("value > 30").select("row", "col"), g.where("col < 8 and value > 29").select("row", "col"))


@query("polygonize")
def polygonize(s, d):
    lab = regions.label(square(s, d).where("value > 30").select("row", "col"))
    return regions.region_polygons(regions.outlines(lab, D.X0, D.Y1, 10.0))


@query("hillshade_with_halo")
def hillshade_with_halo(s, d):
    """Per tile, with the bordering cells of its neighbours: the same shades as over the whole."""
    g = square(s, d).withColumn("tile", F.when(F.col("col") < 10, "w").otherwise("e"))
    other = g.where("(tile = 'w' and col >= 9) or (tile = 'e' and col <= 10)").withColumn("tile", F.when(F.col("tile") == "w", "e").otherwise("w"))
    shaded = raster.hillshade(g.withColumn("own", F.lit(True)).drop("own").unionByName(other), 10.0, keys=["tile"])
    return shaded.where("value is not null and ((tile = 'w' and col < 10) or (tile = 'e' and col >= 10))").select("row", "col", "value")


ORACLES["hillshade_with_halo"] = ORACLES["hillshade_horn"]


def voxels(s: SparkSession, d: str) -> DataFrame:
    p = D.points(s, d)
    return p.select(F.floor((F.col("x") - D.X0) / 5).cast("int").alias("i"), F.floor((F.col("y") - D.Y0) / 5).cast("int").alias("j"), F.floor((F.col("z") - 10) / 5).cast("int").alias("k"), "c").distinct()


_VOX = f"vox AS (SELECT DISTINCT floor((x - {D.X0}::DOUBLE) / 5)::INT AS i, floor((y - {D.Y0}::DOUBLE) / 5)::INT AS j, floor((z - 10) / 5)::INT AS k, c FROM points)"


@query("floating_voxels", sql("SELECT v.i, v.j, v.k, v.k - coalesce(max(g.k), -1) AS above FROM (SELECT DISTINCT i, j, k FROM vox) v LEFT JOIN (SELECT DISTINCT i, j, k FROM vox WHERE c = 2) g ON g.i = v.i AND g.j = v.j AND g.k <= v.k GROUP BY 1, 2, 3", "points").replace(D.SQL["points"], D.SQL["points"] + ",\n" + _VOX))
def floating_voxels(s, d):
    v = voxels(s, d)
    return raster.floating_voxels(v.select("i", "j", "k").distinct(), v.where("c = 2").select("i", "j", "k"))


@query("fill_it_up", sql("SELECT i, j, unnest(range(0, t))::INT AS k FROM (SELECT i, j, max(k) AS t FROM vox GROUP BY 1, 2) WHERE t > 0", "points").replace(D.SQL["points"], D.SQL["points"] + ",\n" + _VOX))
def fill_it_up(s, d):
    return raster.fill_down(voxels(s, d).groupBy("i", "j").agg(F.max("k").alias("k")))


# Kernels that are built on these


@query("point_distance", sql(f"SELECT m.row, m.col, round(sqrt(min((p.x - m.x) * (p.x - m.x) + (p.y - m.y) * (p.y - m.y))), 9) AS value FROM (SELECT r::INT AS row, c::INT AS col, {D.X0}::DOUBLE + (c + 0.5) * 2 AS x, {D.Y1}::DOUBLE - (r + 0.5) * 2 AS y FROM range(100) a(r), range(100) b(c)) m LEFT JOIN (SELECT x, y, floor(x / 4)::INT + i AS gx, floor(y / 4)::INT + j AS gy FROM points, range(-1, 2) a(i), range(-1, 2) b(j) WHERE c IN (2, 9, 17)) p ON floor(m.x / 4)::INT = gx AND floor(m.y / 4)::INT = gy GROUP BY 1, 2", "points"))
def point_distance(s, d):
    centres = raster.mesh_points(raster.mesh(s, 100, 100), D.X0, D.Y1, 2.0)
    ground = P.cut_to_class(D.points(s, d), [2, 9, 17]).select("x", "y", "z")
    return focal.distance_filter(centres, ground, 4.0, ["row", "col", "x", "y"]).select("row", "col", F.round("value", 9).alias("value"))


_W2 = "greatest((n.x - q.x) * (n.x - q.x) + (n.y - q.y) * (n.y - q.y), 1e-8)"


@query("pointcloud_diff", sql(f"""SELECT m.row, m.col, round(avg(a.z), 6) AS value FROM (SELECT r::INT AS row, c::INT AS col, {D.X0}::DOUBLE + (c + 0.5) * 10 AS x, {D.Y1}::DOUBLE - (r + 0.5) * 10 AS y FROM range(20) a(r), range(20) b(c)) m
 LEFT JOIN (SELECT q.k, q.x, q.y, sum(n.z / {_W2}) / sum(1 / {_W2}) - q.z AS z FROM (SELECT *, floor(x / 2)::INT AS gx, floor(y / 2)::INT AS gy FROM points_old) q
  JOIN (SELECT x, y, z, floor(x / 2)::INT + i AS gx, floor(y / 2)::INT + j AS gy FROM points, range(-1, 2) a(i), range(-1, 2) b(j)) n
  ON q.gx = n.gx AND q.gy = n.gy AND (n.x - q.x) * (n.x - q.x) + (n.y - q.y) * (n.y - q.y) <= 4 GROUP BY q.k, q.x, q.y, q.z, q.c, q.pid, q.rn) a
 ON (a.x - m.x) * (a.x - m.x) + (a.y - m.y) * (a.y - m.y) <= 36 GROUP BY 1, 2""", "points", "points_old"))
def pointcloud_diff(s, d):
    """Height of the new cloud (inverse distance, 2 m) less the old one's at its points; means within 6 m of 10 m cells."""
    old = D.points_old(s, d).select("k", "x", "y", "z", "c", "pid", "rn")
    at_old = focal.idw_filter(old, D.points(s, d).select("x", "y", "z"), 2.0, old.columns)
    dz = at_old.where("value is not null").select("x", "y", (F.col("value") - F.col("z")).alias("z"))
    centres = raster.mesh_points(raster.mesh(s, SIDE, SIDE), D.X0, D.Y1, 10.0)
    return focal.mean_filter(centres, dz, 6.0, ["row", "col", "x", "y"]).select("row", "col", F.round("value", 6).alias("value"))


@query("las2polygons")
def las2polygons(s, d):
    """Building polygons: 5 m cells with at least two building points."""
    counts = A.cell_counts(P.cut_to_class(D.points(s, d), 6), D.X0, D.Y1, 5.0).where("n >= 2")
    return regions.region_polygons(regions.outlines(regions.label(counts.select("row", "col")), D.X0, D.Y1, 5.0))


@query("clouds_to_polygons")
def clouds_to_polygons(s, d):
    counts = A.cell_counts(D.points(s, d).where("z > 45"), D.X0, D.Y1, 4.0).where("n >= 4")
    return regions.region_polygons(regions.outlines(regions.label(counts.select("row", "col")), D.X0, D.Y1, 4.0))


@query("wobbly_water")
def wobbly_water(s, d):
    """Regions of water points that stand off the mean within 1 m by over 0.2 m."""
    key = ["k", "x", "y", "z", "c", "pid", "rn"]
    water = P.cut_to_class(D.points(s, d), 9).select(*key)
    off = focal.mean_filter(water, water.select("x", "y", "z"), 1.0, key).withColumn("diff", F.col("z") - F.col("value")).where("abs(diff) > 0.2")
    cells = raster.dilate(A.in_cells(off, D.X0, D.Y1, 1.0).select("row", "col"), [(i, j) for i in range(-2, 3) for j in range(-2, 3)])
    lab = regions.label(cells)
    stats = A.in_cells(off, D.X0, D.Y1, 1.0).join(lab, ["row", "col"]).groupBy("label").agg(F.count(F.lit(1)).alias("npoints"), F.min("diff").alias("min_diff"), F.max("diff").alias("max_diff"))
    shapes = regions.region_polygons(regions.outlines(lab, D.X0, D.Y1, 1.0))
    return shapes.join(stats, "label").select(F.lit(9).alias("class"), F.lit(1.0).alias("frad"), "npoints", "min_diff", "max_diff", "wkt")


@query("levitating_plants")
def levitating_plants(s, d):
    """Vegetation in voxel regions that touch no voxel under the ground or surface, over 3 voxels above it and almost alone."""
    p = D.points(s, d).where("c in (3, 4, 5)").withColumns({"i": F.floor((F.col("x") - D.X0) / 1).cast("int"), "j": F.floor((F.col("y") - D.Y0) / 1).cast("int"), "k": F.floor(F.col("z") - 10).cast("int")})
    ground = D.points(s, d).where("c in (2, 9)").select(F.floor(F.col("x") - D.X0).cast("int").alias("i"), F.floor(F.col("y") - D.Y0).cast("int").alias("j"), F.floor(F.col("z") - 10 + 1.5).cast("int").alias("k"))
    filled = raster.fill_down(ground.groupBy("i", "j").agg(F.max("k").alias("k")))
    near = [(a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) if (a, b, c) != (0, 0, 0)]
    around = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip("abc", o, strict=True)]) for o in [*near, (0, 0, 0)]]))
    moved = [(F.col(n) + F.col(f"s.{m}")).alias(n) for n, m in zip("ijk", "abc", strict=True)]
    lab = regions.label(p.select("i", "j", "k"), ["i", "j", "k"], near)
    grounded = lab.withColumn("s", around).select("label", *moved).join(filled, ["i", "j", "k"], "left_semi").select("label").distinct()
    floating = raster.floating_voxels(lab.join(grounded, "label", "left_anti").select("i", "j", "k"), filled).where("above > 3").select("i", "j", "k")
    crowd = floating.withColumn("s", around).select(*moved).groupBy("i", "j", "k").agg(F.count(F.lit(1)).alias("n"))
    lone = floating.join(crowd, ["i", "j", "k"]).where("n < 6").select("i", "j", "k")
    return p.join(lone, ["i", "j", "k"]).select("x", "y", "z", "c")


@query("find_holes")
def find_holes(s, d):
    """Regions where the new cloud is thin (under 1 a square metre within 3 m, or over 1.8 m to the next point) and the old is not."""
    centres = raster.mesh_points(raster.mesh(s, 100, 100), D.X0, D.Y1, 2.0)
    key = ["row", "col", "x", "y"]
    new = D.points(s, d).where("c in (2, 6, 9, 17)").select("x", "y", "z")
    old = D.points_old(s, d).where("c in (2, 6, 9, 17)").select("x", "y", "z")
    thin = focal.density_filter(centres, new, 3.0, key).where("value < 1").select("row", "col")
    far = focal.distance_filter(centres, new, 3.0, key).where("value > 1.8 or value is null").select("row", "col")
    had = focal.density_filter(centres, old, 3.0, key).where("value > 0").select("row", "col")
    mask = raster.fill_gaps(thin.union(far).distinct().join(had, ["row", "col"], "left_semi"), 100, 100)
    lab = regions.label(mask)
    inside = A.in_cells(old, D.X0, D.Y1, 2.0).join(lab, ["row", "col"])
    rim = raster.dilate(lab.withColumnRenamed("label", "lab").select("lab", "row", "col"), keys=["lab"]).join(lab.select("row", "col"), ["row", "col"], "left_anti")
    border = A.in_cells(new, D.X0, D.Y1, 2.0).join(rim, ["row", "col"]).groupBy(F.col("lab").alias("label")).agg(F.percentile("z", F.lit(0.5)).alias("z1"))
    old_border = A.in_cells(old, D.X0, D.Y1, 2.0).join(rim, ["row", "col"]).groupBy(F.col("lab").alias("label")).agg(F.percentile("z", F.lit(0.5)).alias("z2"), F.stddev_pop("z").alias("sd"))
    holes = inside.groupBy("label").agg(F.count(F.lit(1)).alias("n_old")).join(border, "label", "left").join(old_border, "label", "left")
    area = lab.groupBy("label").agg((F.count(F.lit(1)) * 4.0).alias("area"))
    return holes.join(area, "label").select("label", "z1", "z2", (F.col("z1") - F.col("z2")).alias("dz"), "sd", "n_old", "area")


@query("road_node_outliers", "WITH " + D.SQL["points"] + ",\n" + D.SQL["lines"] + """ SELECT feat_id, seq, round(l.z - sum(p.z / greatest((p.x - l.x) ** 2 + (p.y - l.y) ** 2, 1e-8)) / sum(1 / greatest((p.x - l.x) ** 2 + (p.y - l.y) ** 2, 1e-8)), 6) AS dz
 FROM lines l JOIN points p ON (p.x - l.x) ** 2 + (p.y - l.y) ** 2 <= 4 AND p.c IN (2, 9, 17) GROUP BY feat_id, seq, l.z HAVING abs(l.z - sum(p.z / greatest((p.x - l.x) ** 2 + (p.y - l.y) ** 2, 1e-8)) / sum(1 / greatest((p.x - l.x) ** 2 + (p.y - l.y) ** 2, 1e-8))) >= 1""")
def road_node_outliers(s, d):
    nodes = D.lines(s).select("feat_id", "seq", "x", "y", "z")
    ground = P.cut_to_class(D.points(s, d), [2, 9, 17]).select("x", "y", "z")
    got = focal.idw_filter(nodes, ground, 2.0, nodes.columns).withColumn("dz", F.col("z") - F.col("value"))
    return got.where("abs(dz) >= 1").select("feat_id", "seq", F.round("dz", 6).alias("dz"))


_GROUND = _around_sql(_SPIKE, 1.5).replace("FROM points) q", "FROM points WHERE c = 2) q").replace("FROM points, range", "FROM (SELECT * FROM points WHERE c = 2), range")


@query("spike_check", f"SELECT 1.5::DOUBLE AS filter_rad, value AS mean_dz, x, y, z, c, pid FROM ({_GROUND}) WHERE value <> 0")
def spike_check(s, d):
    key = ["k", "x", "y", "z", "c", "pid", "rn"]
    ground = P.cut_to_class(D.points(s, d), 2).select(*key)
    got = focal.spike_filter(ground, ground.select("x", "y", "z"), 1.5, math.tan(math.radians(25)) ** 2, 0.1, key)
    return got.where("value <> 0").select(F.lit(1.5).alias("filter_rad"), F.round("value", 9).alias("mean_dz"), "x", "y", "z", "c", "pid")


@query("colorize", sql(f"SELECT k, x, y, z, (p.r0 % 256)::INT AS r, (p.c0 % 256)::INT AS g, ((p.r0 + p.c0) % 256)::INT AS b FROM (SELECT *, floor(({D.Y1}::DOUBLE - y) / 2)::INT AS r0, floor((x - {D.X0}::DOUBLE) / 2)::INT AS c0 FROM points) p WHERE r0 < 100", "points"))
def colorize(s, d):
    """Points with the colours of the image cell they lie in."""
    image = raster.mesh(s, 100, 100).select("row", "col", (F.col("row") % 256).alias("r"), (F.col("col") % 256).alias("g"), ((F.col("row") + F.col("col")) % 256).alias("b"))
    placed = A.in_cells(D.points(s, d).select("k", "x", "y", "z"), D.X0, D.Y1, 2.0, (100, 100))
    return placed.join(image, ["row", "col"]).select("k", "x", "y", "z", "r", "g", "b")


@query("polygon_wkt", "WITH " + D.SQL["polygons"] + """, ring AS (SELECT feat_id, ring, '(' || string_agg(format('{:.2f} {:.2f}', x, y), ',' ORDER BY seq) || ')' AS t FROM polygons GROUP BY 1, 2)
SELECT feat_id, 'POLYGON(' || string_agg(t, ',' ORDER BY ring) || ')' AS wkt FROM ring GROUP BY 1""")
def polygon_wkt(s, d):
    return geometry.polygon_wkt(D.polygons(s))
