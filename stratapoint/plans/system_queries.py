"""Queries over what surrounds the operators: streams, the tile catalogue, jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..model import tile_index, tile_of_path
from ..operators import focal, geometry, raster
from ..sources import tiles
from ..streaming.arrivals import daily_counts
from . import derived as D
from . import reports
from .derived import sql
from .point_queries import count_classes
from .surface_queries import _roads, feature_tiles

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


query("stream_daily_counts", "SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")(daily_counts)


@query("tile_catalogue_upsert", sql("SELECT tile AS tile_name, '/new/' || tile || '.las' AS path, 2 AS mtime FROM (SELECT DISTINCT tile FROM points WHERE x < 633000) UNION ALL SELECT tile, '/old/' || tile || '.las', 1 FROM (SELECT DISTINCT tile FROM points WHERE x >= 633000)", "points"))
def tile_catalogue_upsert(s, d):
    t = D.points(s, d).select("x", F.col("tile").alias("tile_name"))
    path = lambda where: F.concat(F.lit(f"/{where}/"), "tile_name", F.lit(".las"))
    old = t.select("tile_name").distinct().select("tile_name", path("old").alias("path"), F.lit(1).alias("mtime"))
    new = t.where("x < 633000").select("tile_name").distinct().select("tile_name", path("new").alias("path"), F.lit(2).alias("mtime"))
    return tiles.upsert(old, new)


@query("tile_of_path", sql("SELECT DISTINCT '/a/b/' || tile || '_extra.las' AS path, tile AS tile_name, 6200 - split_part(tile, '_', 2)::INT AS row, split_part(tile, '_', 3)::INT - 600 AS col FROM points", "points"))
def tile_of_path_(s, d):
    p = D.points(s, d).select(F.concat(F.lit("/a/b/"), "tile", F.lit("_extra.las")).alias("path")).distinct()
    return p.withColumn("tile_name", tile_of_path(F.col("path"))).select("path", "tile_name", tile_index(F.col("tile_name"))["row"].alias("row"), tile_index(F.col("tile_name"))["col"].alias("col"))


@query("report_classes_in_tiles", sql("SELECT tile AS km_name, count(*) FILTER (c = 2)::INT AS n_terrain_2, count(*)::INT AS n_points_total, 7::INT AS run_id FROM points GROUP BY tile", "points"))
def report_classes_in_tiles(s, d):
    """The report as it is stored: cast to the result table's schema."""
    return reports.conform(count_classes(s, d).withColumnRenamed("tile", "km_name"), "f_classes_in_tiles", 7).select("km_name", "n_terrain_2", "n_points_total", "run_id")


@query("report_z_precision_roads")
def report_z_precision_roads(s, d):
    return reports.conform(_roads(s, d).join(F.broadcast(feature_tiles(D.lines(s))), "feat_id"), "f_z_precision_roads", 7).drop("t_stamp")


@query("clip_lines_to_tile", "WITH " + D.SQL["lines"] + f""", seg AS (SELECT feat_id, seq, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM lines WINDOW w AS (PARTITION BY feat_id ORDER BY seq))
SELECT feat_id, seq, round(greatest(0, CASE WHEN x2 > x1 THEN (632950 - x1) / (x2 - x1) ELSE (633050 - x1) / (x2 - x1) END), 9) AS t0 FROM seg WHERE x2 IS NOT NULL AND least(x1, x2) < 633050 AND greatest(x1, x2) > 632950""")
def clip_lines_to_tile(s, d):
    """Where each segment enters a box that spans all of y."""
    seg = geometry.segments(D.lines(s)).withColumn("s", F.struct("x1", "y1", "x2", "y2"))
    box = F.struct(F.lit(632950.0).alias("xmin"), F.lit(0.0).alias("ymin"), F.lit(633050.0).alias("xmax"), F.lit(1e9).alias("ymax"))
    cut = seg.withColumn("p", geometry.clip_segment(F.col("s"), box)).where("p is not null and p.x1 <> p.x2")
    return cut.select("feat_id", "seq", F.round((F.col("p.x1") - F.col("x1")) / (F.col("x2") - F.col("x1")), 9).alias("t0"))


@query("clip_polygons_to_box")
def clip_polygons_to_box(s, d):
    return geometry.clip_polygons(D.polygons(s), 632930.0, 6173930.0, 633065.0, 6174065.0)


@query("lake_voids", "WITH " + D.SQL["points"] + ",\n" + D.SQL["polygons"] + """, m AS (SELECT r::INT AS row, q::INT AS col, 632900.0::DOUBLE + (q + 0.5) * 2 AS x, 6174100.0::DOUBLE - (r + 0.5) * 2 AS y FROM range(100) a(r), range(100) b(q)),
seg AS (SELECT x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM polygons WHERE ptype = 'lake' WINDOW w AS (PARTITION BY feat_id, ring ORDER BY seq)),
i AS (SELECT row, col, x, y FROM m JOIN seg ON x2 IS NOT NULL AND (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY 1, 2, 3, 4 HAVING count(*) % 2 = 1),
h AS (SELECT x AS px, y AS py, floor(x / 1.5)::INT + i AS gx, floor(y / 1.5)::INT + j AS gy FROM points, range(-1, 2) a(i), range(-1, 2) b(j)),
e AS (SELECT row, col, count(px) AS n FROM i LEFT JOIN h ON gx = floor(x / 1.5)::INT AND gy = floor(y / 1.5)::INT AND (px - x) ** 2 + (py - y) ** 2 <= 2.25 GROUP BY 1, 2)
SELECT 2 AS feat_id, bool_or(n = 0) AS has_voids FROM e""")
def lake_voids(s, d):
    """Lakes with a place inside that no point lies within 1.5 m of."""
    lakes = D.polygons(s).where("ptype = 'lake'")
    centres = raster.mesh_points(raster.mesh(s, 100, 100), D.X0, D.Y1, 2.0)
    inside = geometry.points_in_polygons(centres, lakes).select("feat_id", "row", "col", "x", "y")
    density = focal.density_filter(inside, D.points(s, d).select("x", "y", "z"), 1.5, ["feat_id", "row", "col", "x", "y"])
    return density.groupBy("feat_id").agg(F.bool_or(F.col("value") == 0).alias("has_voids"))
