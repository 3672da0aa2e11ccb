"""Queries over triangulated surfaces, fits to buildings, and the result views."""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from ..model import tile_name
from ..operators import buildings, elevation, geometry, raster, tin
from ..operators import points as P
from . import derived as D
from . import point_queries as Q
from .derived import sql
from .point_queries import _RAY
from .raster_queries import _grid_sql, square

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
ALL = list(range(11)) + [17, 32]


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def ground(s: SparkSession, d: str) -> DataFrame:
    return P.cut_to_class(D.points(s, d), 2).select("x", "y", "z")


@query("triangulate")
def triangulate(s, d):
    return tin.triangulate(ground(s, d))


@query("triangle_geometry")
def triangle_geometry(s, d):
    return tin.geometry(tin.triangulate(ground(s, d))).select("tri", "tan2", "xy_size", "z_range", tin.valid().alias("valid"))


@query("triangle_centers")
def triangle_centers(s, d):
    return tin.centers(tin.triangulate(ground(s, d))).select("tri", "cx", "cy")


@query("find_triangles")
def find_triangles(s, d):
    key = ["k", "x", "y", "z", "c", "pid", "rn"]
    other = P.cut_to_class(D.points(s, d), 5).select(*key)
    return tin.locate(other, tin.triangulate(ground(s, d)), key).select(*key, "tri")


@query("interpolate")
def interpolate(s, d):
    key = ["k", "x", "y", "z", "c", "pid", "rn"]
    return tin.heights(P.cut_to_class(D.points(s, d), 5).select(*key), ground(s, d), key)


@query("controlled_interpolation")
def controlled_interpolation(s, d):
    key = ["k", "x", "y", "z", "c", "pid", "rn"]
    return tin.heights(P.cut_to_class(D.points(s, d), 5).select(*key), D.points(s, d), key, tolerances=(85.0, 2.0, 30.0))


def centres(s: SparkSession) -> DataFrame:
    return raster.mesh_points(raster.mesh(s, 100, 100), D.X0, D.Y1, 2.0)


@query("tin_grid")
def tin_grid(s, d):
    return tin.heights(centres(s), ground(s, d), ["row", "col"], "value")


@query("tin_grid_low")
def tin_grid_low(s, d):
    return tin.heights(centres(s), ground(s, d), ["row", "col"], "value", cut_off=5.0)


@query("triangle_size_grid")
def triangle_size_grid(s, d):
    return tin.geometry(tin.over(centres(s), ground(s, d), ["row", "col"])).select("row", "col", F.col("xy_size").alias("value"))


@query("boundary_vertices")
def boundary_vertices(s, d):
    return tin.boundary_vertices(tin.geometry(tin.triangulate(ground(s, d))), ~tin.valid(45.0, 5.0, 5.0), ground(s, d))


@query("tri_filter_low")
def tri_filter_low(s, d):
    return tin.lower_steep(tin.triangulate(ground(s, d)), 5.0)


# Checks of surfaces


@query("steep_triangles")
def steep_triangles(s, d):
    water = P.cut_to_class(D.points(s, d), 9).select("x", "y", "z")
    t = tin.centers(tin.geometry(tin.triangulate(water)))
    steep = t.where((F.col("xy_size") < 2) & (F.col("z_range") > 0.05) & (F.col("tan2") > np.tan(np.radians(15)) ** 2))
    return steep.select(F.lit(9).alias("class"), F.degrees(F.atan(F.sqrt("tan2"))).alias("slope"), F.col("xy_size").alias("xybox"), F.col("z_range").alias("zbox"), "cx", "cy")


@query("road_delta_check")
def road_delta_check(s, d):
    small = tin.centers(tin.geometry(tin.triangulate(D.points(s, d).where("c in (2, 17)").select("x", "y", "z")))).where("xy_size < 1.5 and z_range > 0.4")
    at = small.select("tri", F.col("cx").alias("x"), F.col("cy").alias("y"), "z_range")
    near = geometry.points_near_lines(at, D.lines(s), 1.0)
    return near.groupBy("feat_id").agg(F.max("z_range").alias("z_step_max"), F.min("z_range").alias("z_step_min"), F.count(F.lit(1)).alias("n"))


LOOSE = (89.0, 10.0, 40.0)  # the derived heights are noise: the kernels' own tolerances pass little of them


@query("z_accuracy")
def z_accuracy(s, d):
    around = elevation.beside(D.points(s, d), D.lines(s))
    return elevation.accuracy(D.lines(s), elevation.strip_points(around, ALL), LOOSE)


@query("z_accuracy_gcp")
def z_accuracy_gcp(s, d):
    """Height of the surface of the points around each control point, less its own; slope and size there."""
    return _gcps(s, D.points(s, d))


def _gcps(s, points):
    around = elevation.beside(P.cut_to_class(points, [2, 9, 17]), D.gcps(s), 30.0)
    got = tin.geometry(tin.over(D.gcps(s), around, ["id", "x", "y", "z"], prune=True))
    return got.select("id", "z", (tin.height() - F.col("z")).alias("dz"), F.degrees(F.atan(F.sqrt("tan2"))).alias("t_angle"), F.col("xy_size").alias("t_size"))


REACH = 2.0 + 2 * 12.0  # how far from a feature points can shape the surface over it: its buffer, and a circle as wide as the halo allows


def _by_roads(p, lines, classes):
    """Points near lines, and those that can shape a surface there."""
    return elevation.near_lines(p, lines, classes, 2.0), geometry.points_near_lines(p, lines, REACH).drop("feat_id").distinct()


def _in_houses(p, houses, classes):
    inside = elevation.near_polygons(p, houses, classes)
    around = inside.unionByName(geometry.points_near_lines(p, houses.select("feat_id", "ring", "seq", "x", "y"), REACH)).drop("feat_id").distinct()
    return inside, around


def _roads(s, d, classes=ALL, tolerances=LOOSE):
    near, around = _by_roads(D.points(s, d).select("pid", "x", "y", "z", "c"), D.lines(s), classes)
    return elevation.precision(near, elevation.strip_points(around, classes), tolerances)


def _houses(s, d, classes=ALL, tolerances=LOOSE):
    inside, around = _in_houses(D.points(s, d).select("pid", "x", "y", "z", "c"), D.polygons(s).where("ptype = 'building'"), classes)
    return elevation.precision(inside, elevation.strip_points(around, classes), tolerances)


@query("z_precision_roads")
def z_precision_roads(s, d):
    return _roads(s, d)


@query("z_precision_buildings")
def z_precision_buildings(s, d):
    return _houses(s, d)


# The same operators on points laid on a plane, each strip half a metre above the one before: what they must find is known.

PLANE = "20 + 0.25 * (x - 632900) + 0.125 * (y - 6173900)"


def on_plane(points: DataFrame, by_strip: float = 0.5) -> DataFrame:
    return points.withColumn("z", F.expr(PLANE) + by_strip * F.col("pid"))


@query("interpolate_plane", sql(f"SELECT k, x, y, c, pid, rn, round({PLANE}, 6) AS h FROM points WHERE c = 5 AND x BETWEEN 632920 AND 633080 AND y BETWEEN 6173920 AND 6174080", "points"))
def interpolate_plane(s, d):
    """A surface over points of a plane gives the plane back, away from the hull."""
    key = ["k", "x", "y", "c", "pid", "rn"]
    asked = P.cut_to_class(D.points(s, d), 5).where("x between 632920 and 633080 and y between 6173920 and 6174080").select(*key)
    return tin.heights(asked, on_plane(ground(s, d).withColumn("pid", F.lit(0))), key).withColumn("h", F.round("h", 6))


@query("locate_plane", ORACLES["interpolate_plane"])
def locate_plane(s, d):
    """The same by triangles that are kept, and a lookup in them."""
    key = ["k", "x", "y", "c", "pid", "rn"]
    asked = P.cut_to_class(D.points(s, d), 5).where("x between 632920 and 633080 and y between 6173920 and 6174080").select(*key)
    surface = tin.triangulate(on_plane(ground(s, d).withColumn("pid", F.lit(0))).select("x", "y", "z"))
    return tin.interpolate(asked, surface, key).select(*key, F.round("h", 6).alias("h"))


@query("tin_empty_circles", sql("SELECT count(*) AS n_points, 0::BIGINT AS n_unused, 0::BIGINT AS n_inside FROM (SELECT DISTINCT x, y FROM points WHERE c = 2 AND x BETWEEN 632940 AND 633060 AND y BETWEEN 6173940 AND 6174060)", "points"))
def tin_empty_circles(s, d):
    """Away from the hull: points, those that no triangle uses, and points strictly inside a triangle's circle (both none; circles
    that surely lie within the halo)."""
    inner = "x between 632940 and 633060 and y between 6173940 and 6174060"
    t = tin.triangulate(ground(s, d))
    points = ground(s, d).select("x", "y").distinct()
    corners = t.select(F.explode(F.array(*[F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y")) for k in range(3)])).alias("v")).select("v.*").distinct()
    bx, by, cx, cy = (F.col(f"{a}{k}") - F.col(f"{a}0") for k in (1, 2) for a in "xy")
    det = 2 * (bx * cy - by * cx)
    ux, uy = (cy * (bx * bx + by * by) - by * (cx * cx + cy * cy)) / det, (bx * (cx * cx + cy * cy) - cx * (bx * bx + by * by)) / det
    circles = t.select((F.col("x0") + ux).alias("ox"), (F.col("y0") + uy).alias("oy"), F.sqrt(ux * ux + uy * uy).alias("r")).where("ox between 632940 and 633060 and oy between 6173940 and 6174060 and r < 6")
    cells = geometry.to_cells(circles, F.col("ox") - F.col("r"), F.col("oy") - F.col("r"), F.col("ox") + F.col("r"), F.col("oy") + F.col("r"), 10.0)
    keyed = points.withColumns({"gx": F.floor(F.col("x") / 10).cast("int"), "gy": F.floor(F.col("y") / 10).cast("int")})
    inside = cells.join(keyed, ["gx", "gy"]).where("(x - ox) * (x - ox) + (y - oy) * (y - oy) < r * r - 1e-6").agg(F.count(F.lit(1)).alias("n_inside"))
    mine = points.where(inner)
    return mine.agg(F.count(F.lit(1)).alias("n_points")).crossJoin(mine.join(corners, ["x", "y"], "left_anti").agg(F.count(F.lit(1)).alias("n_unused"))).crossJoin(inside)  # a row each


_BOTH = "(SELECT DISTINCT a.pid AS id1, b.pid AS id2 FROM (SELECT DISTINCT pid FROM points) a JOIN (SELECT DISTINCT pid FROM points) b ON a.pid <> b.pid)"


def _differences(near: DataFrame, ground: DataFrame) -> DataFrame:
    """Before trimming, which leaves nothing of equal differences: their least and greatest by feature and ordered pair of strips."""
    dz = elevation.strip_differences(near, ground, LOOSE)
    return dz.groupBy("feat_id", "id1", "id2").agg(F.round(F.min("dz"), 6).alias("least"), F.round(F.max("dz"), 6).alias("greatest"))


@query("strip_differences_roads_plane", sql(f"SELECT DISTINCT feat_id, id1, id2, 0.5 * (id1 - id2) AS least, 0.5 * (id1 - id2) AS greatest FROM lines, {_BOTH}", "points", "lines"))
def strip_differences_roads_plane(s, d):
    near, around = _by_roads(on_plane(D.points(s, d).select("pid", "x", "y", "z", "c")), D.lines(s), ALL)
    return _differences(near, elevation.strip_points(around, ALL))


@query("strip_differences_buildings_plane", sql(f"SELECT DISTINCT feat_id, id1, id2, 0.5 * (id1 - id2) AS least, 0.5 * (id1 - id2) AS greatest FROM polygons, {_BOTH} WHERE ptype = 'building'", "points", "polygons"))
def strip_differences_buildings_plane(s, d):
    near, around = _in_houses(on_plane(D.points(s, d).select("pid", "x", "y", "z", "c")), D.polygons(s).where("ptype = 'building'"), ALL)
    return _differences(near, elevation.strip_points(around, ALL))


@query("v_tile_z_precision_plane", sql(f"""SELECT tilename, avg(id2 - id1) / 2 AS abs_avg12, avg(id2 - id1) / 2 AS abs_avg21, 0.0::DOUBLE AS sigma12, 0.0::DOUBLE AS sigma21
 FROM (SELECT * FROM {_BOTH} WHERE id1 < id2), (SELECT feat_id, '1km_' || floor(y / 1000)::BIGINT || '_' || floor(x / 1000)::BIGINT AS tilename FROM lines WHERE seq = 0) GROUP BY 1""", "points", "lines"))
def v_tile_z_precision_plane(s, d):
    """The view by tile over the differences' means."""
    found = strip_differences_roads_plane(s, d)
    back = found.select("feat_id", F.col("id2").alias("id1"), F.col("id1").alias("id2"), F.col("least").alias("mean21"))
    report = found.where("id1 < id2").withColumnRenamed("least", "mean12").join(back, ["feat_id", "id1", "id2"])
    return _tile_view(report.withColumns({"sigma12": F.lit(0.0), "sigma21": F.lit(0.0)}), D.lines(s))


@query("z_accuracy_plane", sql(f"SELECT feat_id, pid, round(avg({PLANE} + 0.5 * pid - z), 6) AS mean, count(*) AS npoints FROM (SELECT feat_id, x, y, z FROM lines WHERE x BETWEEN 632920 AND 633080 AND y BETWEEN 6173920 AND 6174080), (SELECT DISTINCT pid FROM points) GROUP BY 1, 2", "points", "lines"))
def z_accuracy_plane(s, d):
    inner = D.lines(s).where("x between 632920 and 633080 and y between 6173920 and 6174080")
    around = elevation.beside(D.points(s, d), inner)
    return elevation.accuracy(inner, elevation.strip_points(on_plane(around), ALL), (89.0, 100.0, 100.0)).select("feat_id", "pid", F.round("mean", 6).alias("mean"), "npoints")


@query("z_accuracy_gcp_plane", "WITH " + D.SQL["gcps"] + f" SELECT id, z, round({PLANE} - z, 6) AS dz, round(degrees(atan(sqrt(0.25 * 0.25 + 0.125 * 0.125))), 6) AS t_angle FROM gcps")
def z_accuracy_gcp_plane(s, d):
    return _gcps(s, on_plane(D.points(s, d), 0.0)).select("id", "z", F.round("dz", 6).alias("dz"), F.round("t_angle", 6).alias("t_angle"))


def sea(s: SparkSession) -> DataFrame:
    """A sea along the east of the extent, a little above the lowest derived heights (SEA_Z)."""
    at = [(633070.0, 6173905.0), (633099.0, 6173905.0), (633099.0, 6173975.0), (633080.0, 6173970.0), (633070.0, 6173905.0)]
    return D.local(s, [(1, 0, q, x, y) for q, (x, y) in enumerate(at)], "feat_id int, ring int, seq int, x double, y double")


SEA_Z = 12.0


def _elevation(s: SparkSession, d: str, first_returns: bool) -> DataFrame:
    """Heights and features are in one height system, so nothing is warped."""
    layer = lambda ptype: D.polygons(s).where(F.col("ptype") == ptype)
    return elevation.elevation_model(
        D.points(s, d), 2.0, D.X0, D.Y1, 100, 100, [2, 9, 17], [2, 3, 4, 5, 6, 9, 17], first_returns,
        houses=layer("building"), lakes=layer("lake"), sea=sea(s), flatten=4, smooth=4, sea_z=SEA_Z,
    )


@query("dem_gen_dtm")
def dem_gen_dtm(s, d):
    return _elevation(s, d, False)


@query("dem_gen_dsm")
def dem_gen_dsm(s, d):
    return _elevation(s, d, True)


# Buildings. The derived points fill no roofs, so gabled roofs are laid over small houses: z follows from the place.


def houses(s: SparkSession) -> DataFrame:
    """Footprints of 16 m by 12 m."""
    at = [(632910.0, 6173920.0), (632960.0, 6174030.0), (633030.0, 6173950.0), (633060.0, 6174060.0)]
    rows = [(k + 1, 0, q, x + dx, y + dy) for k, (x, y) in enumerate(at) for q, (dx, dy) in enumerate([(0, 0), (16, 0), (16, 12), (0, 12), (0, 0)])]
    return D.local(s, [(f, r, q, float(x), float(y)) for f, r, q, x, y in rows], "feat_id int, ring int, seq int, x double, y double")


def roofs(s: SparkSession, d: str) -> DataFrame:
    """Points in the houses, their heights on two planes that meet in a ridge along x, nearly."""
    inside = geometry.points_in_polygons(D.points(s, d), houses(s))
    mid = houses(s).groupBy("feat_id").agg(((F.min("y") + F.max("y")) / 2).alias("mid"))
    return inside.join(F.broadcast(mid), "feat_id").withColumn("z", 30 - F.abs(F.col("y") - F.col("mid")) * 0.6 + F.col("z") / 5000)


def _outlines(s):
    return D.polygons(s).where("ptype = 'building'").select("feat_id", "ring", "seq", "x", "y")


@query("roof_ridge_alignment")
def roof_ridge_alignment(s, d):
    return buildings.per_feature(roofs(s, d), houses(s), buildings.ridge, buildings.RIDGE)


@query("roof_ridge_strip")
def roof_ridge_strip(s, d):
    two = roofs(s, d).withColumn("pid", (F.col("pid") % 2).cast("int"))
    return buildings.ridges_by_strip(buildings.per_feature(two, houses(s), buildings.ridge, buildings.RIDGE, ("pid",)))


def _walls(s, d):
    """Points in the outlines and 2 m around them. Flat roofs of 20 m are laid on ground of 10 m, 0.25 m off in x and y."""
    key = ["feat_id", "k", "x", "y", "z", "c", "pid", "rn"]
    inside = geometry.points_in_polygons(D.points(s, d), _outlines(s)).select(*key)
    around = geometry.points_near_lines(D.points(s, d), _outlines(s).where("ring = 0"), 2.0).select(*key).join(inside, key, "left_anti")
    both = inside.withColumn("base", F.lit(20.0)).unionByName(around.withColumn("base", F.lit(10.0)))
    return both.withColumns({"x": F.col("x") + 0.25, "y": F.col("y") + 0.25, "z": F.col("base") + F.col("z") / 5000}).drop("base")


@query("xy_accuracy_buildings")
def xy_accuracy_buildings(s, d):
    found = buildings.per_feature(_walls(s, d), _outlines(s), buildings.wall_corners, buildings.CORNERS).where("status = 'ok'")
    local = found.select("feat_id", *[(F.col(a) - o).alias(a) for a, o in (("x", D.X0), ("u", D.X0), ("y", D.Y0), ("v", D.Y0))])
    return P.helmert(local, ["feat_id"])


@query("xy_precision_buildings")
def xy_precision_buildings(s, d):
    """Corners that two strips find within 1 m of the outline's, matched by their vertex; features with more than one such corner."""
    found = buildings.per_feature(_walls(s, d), _outlines(s), partial(buildings.wall_corners, least=300), buildings.CORNERS, ("pid",))
    corners = found.where("status = 'ok' and (u - x) * (u - x) + (v - y) * (v - y) < 1")
    a = corners.select("feat_id", "vertex", F.col("pid").alias("id1"), F.col("u").alias("ax"), F.col("v").alias("ay"))
    b = corners.select("feat_id", "vertex", F.col("pid").alias("id2"), F.col("u").alias("bx"), F.col("v").alias("by"))
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    pairs = a.join(b, ["feat_id", "vertex"]).where("id1 < id2").withColumns({"dx": dx, "dy": dy, "dist": F.sqrt(dx * dx + dy * dy)})
    return pairs.groupBy("feat_id", "id1", "id2").agg(F.avg("dx").alias("dx"), F.avg("dy").alias("dy"), F.avg("dist").alias("dist"), F.count(F.lit(1)).alias("n_points")).where("n_points > 1")


# Corrections burned into a terrain model


SHOE = np.array([(632950.0, 6173950.0), (632990.0, 6173955.0), (632992.0, 6174020.0), (632948.0, 6174015.0)])


def _patch_sql(corners: np.ndarray, low: float, high: float) -> str:
    """The grid g with a patch burned."""
    (ax, ay), (bx, by), (cx, cy), (dx, dy) = corners - corners[0]
    x, y = f"({D.X0} + (col + 0.5) * 10 - {corners[0][0]})", f"({D.Y1} - (row + 0.5) * 10 - {corners[0][1]})"
    # a projective map is fixed by its four corners: solved from the eight equations, apart from the operator's closed form
    rows = [[*e] for (px, py), (u, v) in zip(((ax, ay), (bx, by), (cx, cy), (dx, dy)), ((0, 0), (1, 0), (1, 1), (0, 1)), strict=True) for e in ((px, py, 1, 0, 0, 0, -u * px, -u * py), (0, 0, 0, px, py, 1, -v * px, -v * py))]
    h = np.linalg.solve(np.array(rows, float), np.array([0, 0, 1, 0, 1, 1, 0, 1], float))
    w = f"({h[6]}::DOUBLE * {x} + {h[7]}::DOUBLE * {y} + 1)"
    u, v = (f"(({h[3 * k]}::DOUBLE * {x} + {h[3 * k + 1]}::DOUBLE * {y} + {h[3 * k + 2]}::DOUBLE) / {w})" for k in (0, 1))
    return f"SELECT row, col, round(CASE WHEN {u} BETWEEN 0 AND 1 AND {v} BETWEEN 0 AND 1 THEN least(value, {low} + {high - low} * {v}) ELSE value END, 6) AS value FROM g"


@query("burn_horse_shoes", _grid_sql(_patch_sql(SHOE, 20.0, 24.0)))
def burn_horse_shoes(s, d):
    return buildings.burn_patch(square(s, d), SHOE, (20.0, 24.0), D.X0, D.Y1, 10.0).withColumn("value", F.round("value", 6))


@query("burn_horse_shoes_lines")
def burn_horse_shoes_lines(s, d):
    lines = raster.burn_lines(D.lines(s), D.X0, D.Y1, 10.0, 20, 20).withColumnRenamed("value", "low")
    return raster.burn(square(s, d), lines, F.least(F.col("value"), F.col("low")))


@query("burn_baby_burn")
def burn_baby_burn(s, d):
    corners = np.array([(633000.0, 6173920.0), (633060.0, 6173925.0), (633055.0, 6173990.0), (633005.0, 6173985.0)])
    patch = buildings.burn_patch(square(s, d), corners, (18.0, 22.0), D.X0, D.Y1, 10.0)
    lines = raster.burn_lines(D.lines(s), D.X0, D.Y1, 10.0, 20, 20).withColumnRenamed("value", "low")
    return raster.burn(patch, lines, F.least(F.col("value"), F.col("low")))


_N = (1 / 298.257222101) / (2 - 1 / 298.257222101)
_R = 0.9996 * 6378137.0 / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_ECC = 2 * np.sqrt(_N) / (1 + _N)
_UTM = sql(f"""SELECT k, round(500000 + {_R} * (eta + {" + ".join(f"{a} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(_ALPHA, 1))}), 4) AS easting,
 round({_R} * (xi + {" + ".join(f"{a} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(_ALPHA, 1))}), 4) AS northing
 FROM (SELECT k, atan2(t, cos(l)) AS xi, atanh(sin(l) / sqrt(1 + t * t)) AS eta FROM (SELECT k, l, sinh(atanh(sin(p)) - {_ECC} * atanh({_ECC} * sin(p))) AS t
 FROM (SELECT k, radians(y / 111300) AS p, radians((x - 500000) / 63000) AS l FROM points)))""", "points")


@query("reproject", _UTM)
def reproject(s, d):
    """UTM coordinates of geographic ones (here: laid out from the tile coordinates)."""
    p = D.points(s, d).select("k", (9 + (F.col("x") - 500000) / 63000).alias("lon"), (F.col("y") / 111300).alias("lat"))
    e, n = buildings.utm(F.col("lon"), F.col("lat"))
    return p.select("k", F.round(e, 4).alias("easting"), F.round(n, 4).alias("northing"))


# Result views


def classification(s: SparkSession, d: str) -> DataFrame:
    """The classification report with the area of its polygons."""
    return Q.classification_check(s, d).join(F.broadcast(geometry.polygon_area(D.polygons(s))), "feat_id")


_CLS = ("WITH " + D.SQL["points"] + ",\n" + D.SQL["polygons"] + ",\n" + _RAY + """,
ar AS (SELECT feat_id, ring, abs(sum(x1 * y2 - x2 * y1)) / 2 AS a FROM seg WHERE x2 IS NOT NULL GROUP BY 1, 2), area AS (SELECT feat_id, sum(CASE WHEN ring = 0 THEN a ELSE -a END) AS area FROM ar GROUP BY 1),
f AS (SELECT feat_id, ptype, area, count(*) AS n_points_total, """ + ", ".join(f"count(*) FILTER (c = {v}) / count(*)::DOUBLE AS {n}" for n, v in (("f_terrain_2", 2), ("f_low_veg_3", 3), ("f_med_veg_4", 4), ("f_high_veg_5", 5), ("f_building_6", 6), ("f_water_9", 9), ("f_bridge_17", 17))) + " FROM hit JOIN area USING (feat_id) GROUP BY 1, 2, 3)\n")


@query("v_classi_buildpoints", _CLS + "SELECT feat_id, f_building_6 FROM f WHERE ptype = 'building' AND f_building_6 < 0.4 AND f_high_veg_5 < 0.5 AND area > 25 AND n_points_total / area > 0.1")
def v_classi_buildpoints(s, d):
    return classification(s, d).where("ptype = 'building' and f_building_6 < 0.4 and f_high_veg_5 < 0.5 and area > 25 and n_points_total / area > 0.1").select("feat_id", "f_building_6")


@query("v_classi_terrain_in_buildings", _CLS + "SELECT feat_id, f_terrain_2, n_points_total, round(area, 1) AS area FROM f WHERE ptype = 'building' AND area > 800 AND n_points_total > 200 AND f_terrain_2 > 0.03")
def v_classi_terrain_in_buildings(s, d):
    return classification(s, d).where("ptype = 'building' and area > 800 and n_points_total > 200 and f_terrain_2 > 0.03").select("feat_id", "f_terrain_2", "n_points_total", F.round("area", 1).alias("area"))


@query("v_classi_bridgepoints", _CLS + "SELECT feat_id, f_bridge_17 FROM f WHERE ptype = 'bridge' AND f_bridge_17 < 0.2")
def v_classi_bridgepoints(s, d):
    return classification(s, d).where("ptype = 'bridge' and f_bridge_17 < 0.2").select("feat_id", "f_bridge_17")


@query("v_classi_lakepoints", _CLS + "SELECT feat_id, f_water_9 FROM f WHERE ptype = 'lake' AND f_water_9 < 0.2")
def v_classi_lakepoints(s, d):
    return classification(s, d).where("ptype = 'lake' and f_water_9 < 0.2").select("feat_id", "f_water_9")


@query("v_classi_plants_under_building", "WITH " + D.SQL["points"] + ",\n" + D.SQL["polygons"] + ",\n" + _RAY + """, m AS (SELECT feat_id, avg(z) AS mz FROM polygons WHERE ring = 0 GROUP BY 1)
SELECT feat_id, count(*) FILTER (c = 5) / count(*)::DOUBLE AS f_high_veg_5 FROM hit JOIN m USING (feat_id) WHERE z BETWEEN -999 AND mz AND mz BETWEEN 10 AND 230 GROUP BY 1 HAVING count(*) FILTER (c = 5) / count(*)::DOUBLE > 0.03""")
def v_classi_plants_under_building(s, d):
    return Q.classification_below_polygon(s, d).where("ptype = 'below_poly' and n_points_total > 0 and f_high_veg_5 > 0.03").select("feat_id", "f_high_veg_5")


@query("v_classes_distribution", sql("SELECT tile, " + ", ".join(f"(100 * count(*) FILTER (c = {v}) // count(*))::DOUBLE AS pct_{n}" for n, v in (("terrain_2", 2), ("building_6", 6), ("water_9", 9))) + ", count(*) AS n_points_total FROM points GROUP BY tile", "points"))
def v_classes_distribution(s, d):
    counts = Q.count_classes(s, d).where("n_points_total > 0")
    parts = [F.expr(f"cast(100 * n_{n} div n_points_total as double)").alias(f"pct_{n}") for n in ("terrain_2", "building_6", "water_9")]
    return counts.select("tile", *parts, "n_points_total")


@query("v_relevant_holes", sql("SELECT row, col, n_old, dz, sd FROM (SELECT n.row, n.col, count(*) AS n_old, round(avg(n.z) - 30, 6) AS dz, round(stddev_pop(n.z) / 100, 6) AS sd FROM (SELECT *, floor((y - 6173900) / 20)::INT AS row, floor((x - 632900) / 20)::INT AS col FROM points_old) n GROUP BY 1, 2) WHERE n_old > 10 AND abs(dz) < 0.2 AND (abs(sd) < abs(dz) OR abs(sd) < 0.05) AND sd < 0.1 ORDER BY n_old", "points_old"))
def v_relevant_holes(s, d):
    """The view's conditions on a report of old points by cell."""
    cells = D.points_old(s, d).groupBy(F.floor((F.col("y") - D.Y0) / 20).cast("int").alias("row"), F.floor((F.col("x") - D.X0) / 20).cast("int").alias("col"))
    report = cells.agg(F.count(F.lit(1)).alias("n_old"), F.round(F.avg("z") - 30, 6).alias("dz"), F.round(F.stddev_pop("z") / 100, 6).alias("sd"))
    return report.where("n_old > 10 and abs(dz) < 0.2 and (abs(sd) < abs(dz) or abs(sd) < 0.05) and sd < 0.1").orderBy("n_old").select("row", "col", "n_old", "dz", "sd")


def feature_tiles(features: DataFrame) -> DataFrame:
    """feat_id and km_name, the tile of the feature's first vertex."""
    first = features.groupBy("feat_id").agg(F.min_by(F.struct("x", "y"), F.struct("ring", "seq")).alias("v"))
    return first.select("feat_id", tile_name(F.col("v.x"), F.col("v.y")).alias("km_name"))


def _tile_view(report: DataFrame, features: DataFrame) -> DataFrame:
    """A precision report, put on the tile of its feature's first vertex, averaged by tile."""
    placed = report.join(F.broadcast(feature_tiles(features)), "feat_id").withColumnRenamed("km_name", "tilename")
    return placed.groupBy("tilename").agg(F.avg(F.abs("mean12")).alias("abs_avg12"), F.avg(F.abs("mean21")).alias("abs_avg21"), F.avg("sigma12").alias("sigma12"), F.avg("sigma21").alias("sigma21"))


@query("v_tile_z_precision_roads")
def v_tile_z_precision_roads(s, d):
    return _tile_view(_roads(s, d), D.lines(s))


@query("v_tile_z_precision_buildings")
def v_tile_z_precision_buildings(s, d):
    return _tile_view(_houses(s, d), D.polygons(s))



