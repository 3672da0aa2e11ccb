"""Queries over points: scans, filters, projections, joins with features, statistics, neighbourhoods."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import CLASS_CODES, REPORTED, tile_extent, tile_index, tile_name, tile_wkt
from ..operators import aggregates as A
from ..operators import focal, geometry
from ..operators import points as P
from . import derived as D
from .derived import sql

KEY = ["k", "x", "y", "z", "c", "pid", "rn"]
KEYS = ", ".join(KEY)
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


# Filters and projections


@query("scan_filtered", sql(f"SELECT {KEYS} FROM points WHERE c IN (2, 5, 9) AND x BETWEEN 632950 AND 633050 AND y BETWEEN 6173950 AND 6174050 AND z > 15 AND z < 40", "points"))
def scan_filtered(s: SparkSession, d: str) -> DataFrame:
    return P.read_filtered(D.points(s, d), [2, 5, 9], (632950.0, 6173950.0, 633050.0, 6174050.0), (15.0, 40.0)).select(*KEY)


@query("cut_to_class", sql(f"SELECT {KEYS} FROM points WHERE c IN (2, 6)", "points"))
def cut_to_class(s, d):
    return P.cut_to_class(D.points(s, d), [2, 6]).select(*KEY)


@query("cut_to_class_exclude", sql(f"SELECT {KEYS} FROM points WHERE c NOT IN (2, 6)", "points"))
def cut_to_class_exclude(s, d):
    return P.cut_to_class(D.points(s, d), [2, 6], exclude=True).select(*KEY)


@query("cut_to_return_number", sql(f"SELECT {KEYS} FROM points WHERE rn = 1", "points"))
def cut_to_return_number(s, d):
    return P.cut_to_return_number(D.points(s, d), 1).select(*KEY)


@query("cut_to_z_interval", sql(f"SELECT {KEYS} FROM points WHERE z BETWEEN 20 AND 30", "points"))
def cut_to_z_interval(s, d):
    return P.cut_to_z_interval(D.points(s, d), 20.0, 30.0).select(*KEY)


@query("cut_to_strip", sql(f"SELECT {KEYS} FROM points WHERE pid = 2", "points"))
def cut_to_strip(s, d):
    return P.cut_to_strip(D.points(s, d), 2).select(*KEY)


@query("cut_to_box", sql(f"SELECT {KEYS} FROM points WHERE x BETWEEN 632990 AND 633010 AND y BETWEEN 6173990 AND 6174010", "points"))
def cut_to_box(s, d):
    return P.cut_to_box(D.points(s, d), 632990.0, 6173990.0, 633010.0, 6174010.0).select(*KEY)


@query(
    "cut_to_grid_mask",
    sql(
        f"SELECT {KEYS} FROM points WHERE (floor(({D.Y1}::DOUBLE - y) / 10)::INT, floor((x - {D.X0}::DOUBLE) / 10)::INT) IN (SELECT (row, col) FROM grid WHERE value > 30)",
        "points", "grid",
    ),
)
def cut_to_grid_mask(s, d):
    return P.cut_to_mask(D.points(s, d), D.grid(s, d).where("value > 30"), D.X0, D.Y1, 10.0).select(*KEY)


@query("affine_transformation", sql("SELECT k, c, pid, rn, 0.5 * x - 0.25 * y + 10 AS x, 0.25 * x + 0.5 * y - 20 AS y, 2 * z + 1 AS z FROM points", "points"))
def affine_transformation(s, d):
    return P.transform(D.points(s, d), [[0.5, -0.25, 0.0], [0.25, 0.5, 0.0], [0.0, 0.0, 2.0]], [10.0, -20.0, 1.0]).select("k", "c", "pid", "rn", "x", "y", "z")


@query("set_class", sql("SELECT k, x, y, z, 2::INT AS c FROM points", "points"))
def set_class(s, d):
    return P.set_class(D.points(s, d), 2).select("k", "x", "y", "z", "c")


@query("extend_least_common", sql("SELECT x, y, z, c FROM points UNION ALL SELECT x, y, z, c FROM points_old", "points", "points_old"))
def extend_least_common(s, d):
    return P.extend(D.points(s, d).select("x", "y", "z", "c", "pid"), D.points_old(s, d).select("x", "y", "z", "c"), least_common=True)


@query("tile_names", sql("SELECT tile, count(*) AS n, 6200 - floor(min(y) / 1000)::INT AS row, floor(min(x) / 1000)::INT - 600 AS col, floor(min(x) / 1000) * 1000 AS xmin, (floor(min(y) / 1000) + 1) * 1000 AS ymax FROM points GROUP BY tile", "points"))
def tile_names(s, d):
    t = D.points(s, d).groupBy("tile").agg(F.count(F.lit(1)).alias("n"))
    i, b = tile_index(F.col("tile")), tile_extent(F.col("tile"))
    return t.select("tile", "n", i["row"].alias("row"), i["col"].alias("col"), b["xmin"].alias("xmin"), b["ymax"].alias("ymax"))


_TILES = "tiles AS (SELECT DISTINCT tile, floor(x / 1000) * 1000 AS xmin, floor(y / 1000) * 1000 AS ymin FROM points)"
_DISP = """, n AS (SELECT *, lead(x) OVER w - x AS ax, lead(y) OVER w - y AS ay, x - lag(x) OVER w AS bx, y - lag(y) OVER w AS byy FROM lines WINDOW w AS (PARTITION BY feat_id ORDER BY seq)),
u AS (SELECT *, -ay / sqrt(ax * ax + ay * ay) AS n2x, ax / sqrt(ax * ax + ay * ay) AS n2y, -byy / sqrt(bx * bx + byy * byy) AS n1x, bx / sqrt(bx * bx + byy * byy) AS n1y FROM n)
SELECT feat_id, seq, round(coalesce((n1x + n2x) / (1 + n1x * n2x + n1y * n2y), n1x, n2x), 9) AS dx, round(coalesce((n1y + n2y) / (1 + n1x * n2x + n1y * n2y), n1y, n2y), 9) AS dy FROM u"""


@query("linestring_displacements", "WITH " + D.SQL["lines"] + _DISP)
def linestring_displacements(s, d):
    return P.line_displacements(D.lines(s)).select("feat_id", "seq", F.round("dx", 9).alias("dx"), F.round("dy", 9).alias("dy"))


@query(
    "helmert2d",
    sql(
        """SELECT tile, round(sc, 6) AS scale, n FROM (SELECT tile, count(*) AS n,
  (sum(x0 * u0 + y0 * v0) - count(*) * (avg(x0) * avg(u0) + avg(y0) * avg(v0))) / (sum(x0 * x0 + y0 * y0) - count(*) * (avg(x0) * avg(x0) + avg(y0) * avg(y0))) AS sc
  FROM (SELECT *, x - 633000 AS x0, y - 6174000 AS y0, 1.5 * (x - 633000) + z / 16 AS u0, 1.5 * (y - 6174000) - z / 16 AS v0 FROM points) GROUP BY tile)""",
        "points",
    ),
)
def helmert2d(s, d):
    p = D.points(s, d).select("tile", (F.col("x") - 633000).alias("x"), (F.col("y") - 6174000).alias("y"), "z")
    p = p.withColumns({"u": 1.5 * F.col("x") + F.col("z") / 16, "v": 1.5 * F.col("y") - F.col("z") / 16})
    return P.helmert(p, ["tile"]).select("tile", F.round("scale", 6).alias("scale"), "n")


# Joins with features

_RAY = """seg AS (SELECT feat_id, ring, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM polygons WINDOW w AS (PARTITION BY feat_id, ring ORDER BY seq)),
bb AS (SELECT feat_id, min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax, any_value(ptype) AS ptype FROM polygons WHERE ring = 0 GROUP BY feat_id),
near AS (SELECT p.*, b.feat_id, b.ptype, b.xmax + 10 - p.x AS dx FROM points p JOIN bb b ON p.x BETWEEN b.xmin AND b.xmax AND p.y BETWEEN b.ymin AND b.ymax),
cr AS (SELECT n.*, dx * (s.y2 - s.y1) - 8.1234::DOUBLE * (s.x2 - s.x1) AS det, ((s.x1 - n.x) * (s.y2 - s.y1) - (s.y1 - n.y) * (s.x2 - s.x1)) AS tn, ((s.x1 - n.x) * 8.1234::DOUBLE - (s.y1 - n.y) * dx) AS un
  FROM near n JOIN seg s ON s.feat_id = n.feat_id AND s.x2 IS NOT NULL),
hit AS (SELECT k, x, y, z, c, pid, rn, tile, feat_id, ptype FROM cr WHERE abs(det) >= 1e-10 AND tn / det > -1e-9 AND tn / det < 1 + 1e-9 AND un / det > -1e-9 AND un / det < 1 + 1e-9
  GROUP BY ALL HAVING count(*) % 2 = 1)"""


def in_polygons(s: SparkSession, d: str) -> DataFrame:
    return geometry.points_in_polygons(D.points(s, d), D.polygons(s))


@query("points_in_polygons", "WITH " + D.SQL["points"] + ",\n" + D.SQL["polygons"] + ",\n" + _RAY + f" SELECT {KEYS}, feat_id FROM hit")
def points_in_polygons(s, d):
    return in_polygons(s, d).select(*KEY, "feat_id")


_NEAR = """seg AS (SELECT feat_id, x AS x1, y AS y1, z AS z1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM lines WINDOW w AS (PARTITION BY feat_id ORDER BY seq)),
pr AS (SELECT p.*, s.feat_id, s.x1, s.y1, s.x2 - s.x1 AS ex, s.y2 - s.y1 AS ey FROM points p JOIN seg s ON s.x2 IS NOT NULL
  AND p.x BETWEEN least(s.x1, s.x2) - 2 AND greatest(s.x1, s.x2) + 2 AND p.y BETWEEN least(s.y1, s.y2) - 2 AND greatest(s.y1, s.y2) + 2),
tt AS (SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE, ((x - x1) * ex + (y - y1) * ey) / (ex * ex + ey * ey))) AS t FROM pr),
buf AS (SELECT DISTINCT k, x, y, z, c, pid, rn, tile, feat_id FROM tt WHERE (x - x1 - t * ex) * (x - x1 - t * ex) + (y - y1 - t * ey) * (y - y1 - t * ey) < 4.0::DOUBLE)"""


@query("points_in_line_buffer", "WITH " + D.SQL["points"] + ",\n" + D.SQL["lines"] + ",\n" + _NEAR + f" SELECT {KEYS}, feat_id FROM buf")
def points_in_line_buffer(s, d):
    return geometry.points_near_lines(D.points(s, d), D.lines(s), 2.0).select(*KEY, "feat_id")


@query("polygon_area", "WITH " + D.SQL["polygons"] + """, seg AS (SELECT feat_id, ring, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM polygons WINDOW w AS (PARTITION BY feat_id, ring ORDER BY seq)),
a AS (SELECT feat_id, ring, abs(sum(x1 * y2 - x2 * y1)) / 2 AS a FROM seg WHERE x2 IS NOT NULL GROUP BY 1, 2) SELECT feat_id, round(sum(CASE WHEN ring = 0 THEN a ELSE -a END), 1) AS area FROM a GROUP BY 1""")
def polygon_area(s, d):
    return geometry.polygon_area(D.polygons(s)).select("feat_id", F.round("area", 1).alias("area"))


@query("strip_pairs", sql("""SELECT a.pid AS id1, b.pid AS id2, greatest(a.x0, b.x0) AS xmin, least(a.x1, b.x1) AS xmax FROM
 (SELECT pid, min(x) x0, max(x) x1, min(y) y0, max(y) y1 FROM points GROUP BY pid) a JOIN (SELECT pid, min(x) x0, max(x) x1, min(y) y0, max(y) y1 FROM points GROUP BY pid) b
 ON a.pid < b.pid AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1""", "points"))
def strip_pairs(s, d):
    box = F.struct(F.min("x").alias("xmin"), F.min("y").alias("ymin"), F.max("x").alias("xmax"), F.max("y").alias("ymax"))
    strips = D.points(s, d).groupBy("pid").agg(box.alias("box"))
    a, b = strips.select(F.col("pid").alias("id1"), F.col("box").alias("a")), strips.select(F.col("pid").alias("id2"), F.col("box").alias("b"))
    pairs = a.join(b, (F.col("id1") < F.col("id2")) & P.boxes_overlap(F.col("a"), F.col("b")))
    return pairs.withColumn("i", P.box_intersection(F.col("a"), F.col("b"))).select("id1", "id2", F.col("i.xmin").alias("xmin"), F.col("i.xmax").alias("xmax"))


@query("tile_reference_join", sql("SELECT a.tile, a.n AS n_new, b.n AS n_old FROM (SELECT tile, count(*) n FROM points GROUP BY tile) a JOIN (SELECT tile, count(*) n FROM points_old GROUP BY tile) b USING (tile)", "points", "points_old"))
def tile_reference_join(s, d):
    new, old = (f(s, d).groupBy("tile").agg(F.count(F.lit(1)).alias(n)) for f, n in ((D.points, "n_new"), (D.points_old, "n_old")))
    return new.join(old.dropDuplicates(["tile"]), "tile")


@query("tiles_not_in_reference", sql("SELECT DISTINCT tile FROM points WHERE z > 49.5 AND tile NOT IN (SELECT tile FROM points_old WHERE x > 633000)", "points", "points_old"))
def tiles_not_in_reference(s, d):
    return D.points(s, d).where("z > 49.5").select("tile").distinct().join(D.points_old(s, d).where("x > 633000").select("tile"), "tile", "left_anti")


@query("tile_neighbours", "WITH " + D.SQL["points"] + ",\n" + _TILES + " SELECT a.tile, b.tile AS other FROM tiles a JOIN tiles b ON abs(a.xmin - b.xmin) <= 1000 AND abs(a.ymin - b.ymin) <= 1000")
def tile_neighbours(s, d):
    t = D.points(s, d).select("tile").distinct().withColumn("i", tile_index(F.col("tile"))).select("tile", "i.row", "i.col")
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    near = t.withColumn("o", steps).select("tile", (F.col("row") + F.col("o.i")).alias("row"), (F.col("col") + F.col("o.j")).alias("col"))
    return near.join(t.select(F.col("tile").alias("other"), "row", "col"), ["row", "col"]).select("tile", "other")


@query("gcp_neighbourhood", sql("SELECT id, count(*) AS n, avg(p.z) AS mean_z FROM gcps g JOIN points p ON p.x BETWEEN g.x - 30 AND g.x + 30 AND p.y BETWEEN g.y - 30 AND g.y + 30 GROUP BY id", "points", "gcps"))
def gcp_neighbourhood(s, d):
    box = D.gcps(s).select("id", *[(F.col(a) + g).alias(f"{a}{n}") for a in "xy" for g, n in ((-30.0, "0"), (30.0, "1"))])
    cells = geometry.to_cells(box, F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), 60.0)
    keyed = D.points(s, d).withColumns({"gx": F.floor(F.col("x") / 60).cast("int"), "gy": F.floor(F.col("y") / 60).cast("int")})
    both = keyed.join(geometry.small_enough(cells, 50_000), ["gx", "gy"]).where("x between x0 and x1 and y between y0 and y1")
    return both.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.avg("z").alias("mean_z"))


# Statistics


@query("count_classes", sql("SELECT tile, " + ", ".join(f"count(*) FILTER (c = {v})::BIGINT AS n_{k}_{v}" for k, v in CLASS_CODES.items()) + ", count(*) AS n_points_total FROM points GROUP BY tile", "points"))
def count_classes(s, d):
    return A.count_classes(D.points(s, d))


@query("inventory", sql("SELECT tile, count(*) AS n_points, array_to_string(list_sort(list(DISTINCT c)), ';') AS classes, array_to_string(list_sort(list(DISTINCT pid)), ';') AS strips, min(x) AS xmin, max(x) AS xmax, min(z) AS zmin, max(z) AS zmax FROM points GROUP BY tile", "points"))
def inventory(s, d):
    t = A.inventory(D.points(s, d), ["tile"])
    return t.select("tile", "n_points", F.array_join("classes", ";").alias("classes"), F.array_join("strips", ";").alias("strips"), "xmin", "xmax", "zmin", "zmax")


@query("density_grid", sql(f"SELECT floor(({D.Y1}::DOUBLE - y) / 1)::INT AS row, floor((x - {D.X0}::DOUBLE) / 1)::INT AS col, count(*) AS n FROM points WHERE c IN (2, 5, 6, 9) GROUP BY 1, 2", "points"))
def density_grid(s, d):
    return A.cell_counts(P.cut_to_class(D.points(s, d), [2, 5, 6, 9]), D.X0, D.Y1, 1.0)


_CLASS = "floor(({0}::DOUBLE - y) / {2})::INT AS row, floor((x - {1}::DOUBLE) / {2})::INT AS col".format(D.Y1, D.X0, 1.0)


@query("class_grid", sql(f"SELECT row, col, c FROM (SELECT row, col, c, row_number() OVER (PARTITION BY row, col ORDER BY count(*) DESC, c) AS r FROM (SELECT {_CLASS}, c FROM points) GROUP BY row, col, c) WHERE r = 1", "points"))
def class_grid(s, d):
    return A.most_frequent(A.in_cells(D.points(s, d), D.X0, D.Y1, 1.0), "c", ["row", "col"])


@query("strip_grid", sql(f"SELECT row, col, pid FROM (SELECT row, col, pid, row_number() OVER (PARTITION BY row, col ORDER BY count(*) DESC, pid) AS r FROM (SELECT {_CLASS}, pid FROM points) GROUP BY row, col, pid) WHERE r = 1", "points"))
def strip_grid(s, d):
    return A.most_frequent(A.in_cells(D.points(s, d), D.X0, D.Y1, 1.0), "pid", ["row", "col"])


@query("mean_grid", sql("SELECT row, col, value FROM grid", "points", "grid"))
def mean_grid(s, d):
    return A.aggregate_grid(D.points(s, d), D.X0, D.Y1, 10.0, F.avg("z"))


@query("classification_check", "WITH " + D.SQL["points"] + ",\n" + D.SQL["polygons"] + ",\n" + _RAY + " SELECT feat_id, ptype, " + ", ".join(f"count(*) FILTER (c = {v}) / count(*)::DOUBLE AS f_{k}_{v}" for k, v in CLASS_CODES.items() if v in REPORTED) + f", count(*) FILTER (c NOT IN {REPORTED}) / count(*)::DOUBLE AS f_other, count(*) AS n_points_total FROM hit GROUP BY 1, 2")
def classification_check(s, d):
    types = D.polygons(s).select("feat_id", "ptype").distinct()
    return A.class_fractions(in_polygons(s, d).join(F.broadcast(types), "feat_id"), ["feat_id", "ptype"])


@query("classification_below_polygon", "WITH " + D.SQL["points"] + ",\n" + D.SQL["polygons"] + ",\n" + _RAY + f""", m AS (SELECT feat_id, avg(z) AS mz FROM polygons WHERE ring = 0 GROUP BY 1)
SELECT feat_id, 'below_poly' AS ptype, count(*) FILTER (c = 5) / count(*)::DOUBLE AS f_high_veg_5, count(*) AS n_points_total FROM hit JOIN m USING (feat_id) WHERE z BETWEEN -999 AND mz AND mz BETWEEN 10 AND 230 GROUP BY 1""")
def classification_below_polygon(s, d):
    mean = D.polygons(s).where("ring = 0").groupBy("feat_id").agg(F.avg("z").alias("mz")).where("mz between 10 and 230")
    below = in_polygons(s, d).join(F.broadcast(mean), "feat_id").where("z between -999 and mz")
    return A.class_fractions(below, ["feat_id"]).select("feat_id", F.lit("below_poly").alias("ptype"), "f_high_veg_5", "n_points_total")


@query("poly_z_stats", "WITH " + D.SQL["points"] + ",\n" + D.SQL["polygons"] + ",\n" + _RAY + " SELECT feat_id, c AS class, count(*) AS npoints, min(z) AS zmin, max(z) AS zmax, avg(z) AS zmean, round(stddev_pop(z), 6) AS sd, round(quantile_cont(z, 0.05), 5) AS f5 FROM hit GROUP BY 1, 2")
def poly_z_stats(s, d):
    return A.z_statistics(in_polygons(s, d).withColumnRenamed("c", "class"), ["feat_id", "class"]).withColumns({"sd": F.round("sd", 6), "f5": F.round("f5", 5)})


@query("time_stats", sql("SELECT tile, strftime(min(t), '%Y-%m-%d %H:%M:%S') AS min_time, strftime(max(t), '%Y-%m-%d %H:%M:%S') AS max_time, array_to_string(list_sort(list(DISTINCT strftime(t, '%Y%m%d'))), ';') AS unique_days, count(DISTINCT strftime(t, '%Y%m%d')) AS n_unique_days FROM (SELECT tile, make_timestamp(((gps_time + 1000000000 + 315964800) * 1000000)::BIGINT) AS t FROM points) GROUP BY tile", "points"))
def time_stats(s, d):
    return A.acquisition_days(D.points(s, d))


@query("moving_bins", sql("SELECT a.tile, a.z, sum(b.m)::BIGINT AS n_near FROM (SELECT tile, z, count(*) m FROM points GROUP BY 1, 2) a JOIN (SELECT tile, z, count(*) m FROM points GROUP BY 1, 2) b ON a.tile = b.tile AND abs(a.z - b.z) < 0.5 GROUP BY 1, 2", "points"))
def moving_bins(s, d):
    return A.moving_bins(D.points(s, d), 0.5)


@query("z_histogram", sql("SELECT tile, coalesce(least(floor((z - lo) / (hi - lo) * 20), 19), 0)::INT AS bin, count(*) AS n FROM points JOIN (SELECT tile, min(z) lo, max(z) hi FROM points GROUP BY tile) USING (tile) GROUP BY 1, 2", "points"))
def z_histogram(s, d):
    return A.histogram(D.points(s, d), 20)


def _trim_sql(turns: int = 5) -> str:
    steps = ["t0 AS (SELECT tile, pid, z - 30 AS v, FALSE AS done FROM points)"]
    for k in range(turns):
        lim = 2.5 if k == 0 else 2.0
        steps.append(f"m{k} AS (SELECT tile, pid, v, done, abs(v - avg(v) OVER w) < {lim} * stddev_pop(v) OVER w AS ok FROM t{k} WINDOW w AS (PARTITION BY tile, pid))")
        steps.append(f"t{k + 1} AS (SELECT tile, pid, v, done OR a AS done FROM (SELECT *, bool_and(ok) OVER (PARTITION BY tile, pid) AS a FROM m{k}) WHERE done OR a OR ok)")
    return ",\n".join(steps) + f" SELECT tile, pid, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS sd, round(avg(abs(v)), 6) AS l1, round(sqrt(avg(v * v)), 6) AS rms, count(*) AS n FROM t{turns} GROUP BY 1, 2"


@query("dz_statistics", "WITH " + D.SQL["points"] + ",\n" + _trim_sql())
def dz_statistics(s, d):
    values = D.points(s, d).select("tile", "pid", (F.col("z") - 30).alias("dz"))
    return A.dz_statistics(values, ["tile", "pid"]).select("tile", "pid", *[F.round(c, 6).alias(c) for c in ("mean", "sd", "l1", "rms")], "n")


@query("set_lake_z", "WITH " + D.SQL["points"] + ",\n" + D.SQL["polygons"] + ",\n" + _RAY + """, b AS (SELECT feat_id, tile, quantile_cont(z, 0.125) AS p, median(z) AS m, count(*) AS n FROM hit GROUP BY 1, 2),
o AS (SELECT *, sum(n) OVER w AS tot, sum(p * n) OVER w / sum(n) OVER w AS mean FROM b WINDOW w AS (PARTITION BY feat_id)),
j AS (SELECT *, abs(p - mean) > 0.2 AS dev, n > 0.2 * (tot - n) OR n > 1000 AS heavy, m - p > 0.2 AS inner_dev FROM o)
SELECT feat_id, round(sum(p * n) FILTER (NOT (dev AND NOT heavy)) / sum(n) FILTER (NOT (dev AND NOT heavy)), 6) AS burn_z, coalesce(sum(n) FILTER (NOT (dev AND NOT heavy)), 0)::BIGINT AS n_used,
 NOT bool_or(((dev AND heavy) OR inner_dev) AND NOT (dev AND NOT heavy)) AS is_valid FROM j GROUP BY 1""")
def set_lake_z(s, d):
    return A.lake_heights(in_polygons(s, d), ["feat_id"]).withColumn("burn_z", F.round("burn_z", 6))


# Neighbourhoods


def _around_sql(select: str, r: float, within: bool = True, other: str = "points", having: str = "") -> str:
    names = ["points"] + [other] * (other != "points")
    limit = f"AND (n.nx - q.x) * (n.nx - q.x) + (n.ny - q.y) * (n.ny - q.y) <= {r * r}" if within else ""
    return sql(
        f"""SELECT {", ".join("q." + k for k in KEY)}, {select} FROM (SELECT *, floor(x / {r})::INT AS gx, floor(y / {r})::INT AS gy FROM points) q
 LEFT JOIN (SELECT x AS nx, y AS ny, z AS nz, floor(x / {r})::INT + i AS gx, floor(y / {r})::INT + j AS gy FROM {other}, range(-1, 2) a(i), range(-1, 2) b(j)) n
 ON q.gx = n.gx AND q.gy = n.gy {limit} GROUP BY {", ".join("q." + k for k in KEY)} {having}""",
        *names,
    )


R = 2.0
_D2 = "((n.nx - q.x) * (n.nx - q.x) + (n.ny - q.y) * (n.ny - q.y))"


def _around(f, other=D.points, **kw):
    def run(s: SparkSession, d: str) -> DataFrame:
        return f(D.points(s, d).select(*KEY), other(s, d).select("x", "y", "z"), R, KEY, **kw)

    return run


query("min_filter", _around_sql("min(n.nz) AS value", R))(_around(focal.min_filter))
query("max_filter", _around_sql("max(n.nz) AS value", R))(_around(focal.max_filter))
query("mean_filter", _around_sql("avg(n.nz) AS value", R))(_around(focal.mean_filter))
query("median_filter", _around_sql("median(n.nz) AS value", R))(_around(focal.median_filter))
query("density_filter", _around_sql(f"count(n.nx) / {math.pi * R * R}::DOUBLE AS value", R))(_around(focal.density_filter))


@query("var_filter", _around_sql("round(CASE WHEN count(n.nz) > 1 THEN var_pop(n.nz) END, 6) AS value", R))
def var_filter(s, d):
    return _around(focal.var_filter)(s, d).withColumn("value", F.round("value", 6))


@query("idw_filter", _around_sql(f"round(sum(n.nz / greatest({_D2}, 1e-8)) / sum(1 / greatest({_D2}, 1e-8)), 5) AS value", R, other="points_old"))
def idw_filter(s, d):
    return _around(focal.idw_filter, D.points_old)(s, d).withColumn("value", F.round("value", 5))


@query("distance_filter", _around_sql(f"sqrt(min({_D2})) AS value", R, within=False, other="points_old"))
def distance_filter(s, d):
    return focal.distance_filter(D.points(s, d).select(*KEY), D.points_old(s, d).select("x", "y", "z"), R, KEY)


_TAN2 = math.tan(math.radians(25)) ** 2
_STEEP = f"(abs(n.nz - q.z) > 0.1 AND (n.nz - q.z) * (n.nz - q.z) > {_TAN2}::DOUBLE * {_D2})"
_SPIKE = f"""CASE WHEN count(*) FILTER ({_STEEP} AND n.nx >= q.x AND n.ny >= q.y) > 0 AND count(*) FILTER ({_STEEP} AND n.nx >= q.x AND n.ny < q.y) > 0 AND count(*) FILTER ({_STEEP} AND n.nx < q.x AND n.ny >= q.y) > 0
 AND count(*) FILTER ({_STEEP} AND n.nx < q.x AND n.ny < q.y) > 0 AND bool_and({_STEEP} OR {_D2} <= {(0.2 * 1.5) ** 2}::DOUBLE) AND NOT (count(*) FILTER (n.nz - q.z > 1e-6) > 0 AND count(*) FILTER (n.nz - q.z < -1e-6) > 0)
 AND count(n.nx) >= 4 THEN round(avg(n.nz - q.z), 9) ELSE 0.0::DOUBLE END AS value"""


@query("spike_filter", _around_sql(_SPIKE, 1.5))
def spike_filter(s, d):
    got = focal.spike_filter(D.points(s, d).select(*KEY), D.points(s, d).select("x", "y", "z"), 1.5, _TAN2, 0.1, KEY)
    return got.withColumn("value", F.round("value", 9))


@query("spatial_sort", sql(f"SELECT {KEYS}, floor(x / 2)::INT AS gx, floor(y / 2)::INT AS gy FROM points", "points"))
def spatial_sort(s, d):
    return focal.spatial_sort(D.points(s, d).select(*KEY), 2.0)


@query("tile_wkt", sql("SELECT DISTINCT tile, format('POLYGON(({:.2f} {:.2f},{:.2f} {:.2f},{:.2f} {:.2f},{:.2f} {:.2f},{:.2f} {:.2f}))', e, n, e, n + 1000, e + 1000, n + 1000, e + 1000, n, e, n) AS wkt FROM (SELECT tile, floor(x / 1000) * 1000 AS e, floor(y / 1000) * 1000 AS n FROM points)", "points"))
def tile_wkt_(s, d):
    return D.points(s, d).select("tile").distinct().withColumn("wkt", tile_wkt(F.col("tile")))


@query("repeat_tile_name", sql("SELECT k, '1km_' || floor((y + 500) / 1000)::BIGINT || '_' || floor((x + 500) / 1000)::BIGINT AS moved FROM points", "points"))
def repeat_tile_name(s, d):
    return D.points(s, d).select("k", tile_name(F.col("x") + 500, F.col("y") + 500).alias("moved"))
