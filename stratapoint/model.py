"""The data model: schemas, class codes and tile expressions.

Points, raster cells, triangles and vector features are rows. No-data is NULL; sentinels appear only at sinks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Classification codes by name.
CLASS_CODES = {
    "created_unused": 0, "surface": 1, "terrain": 2, "low_veg": 3, "med_veg": 4, "high_veg": 5, "building": 6, "outliers": 7, "mod_key": 8, "water": 9, "ignored": 10,
    "power_line": 14, "bridge": 17, "high_noise": 18, "terrain_in_buildings": 19, "low_veg_in_buildings": 20, "man_excl": 32,
}
REPORTED = (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 17, 32)  # the classes whose fractions are reported
SENSIBLE_Z = (10.0, 230.0)
TILE = 1000.0
EPSG = 25832

POINT = T.StructType(
    [T.StructField("tile", T.StringType())]
    + [T.StructField(n, T.DoubleType()) for n in "xyz"]
    + [T.StructField(n, T.IntegerType()) for n in ("c", "pid", "rn")]
    + [T.StructField("gps_time", T.DoubleType())]
    + [T.StructField(n, T.IntegerType()) for n in ("r", "g", "b")]
)
CELL = T.StructType([T.StructField("tile", T.StringType()), T.StructField("row", T.IntegerType()), T.StructField("col", T.IntegerType()), T.StructField("value", T.DoubleType())])
SEGMENT = T.StructType([T.StructField("feat_id", T.IntegerType()), T.StructField("ring", T.IntegerType()), T.StructField("seq", T.IntegerType())] + [T.StructField(n, T.DoubleType()) for n in ("x1", "y1", "x2", "y2")])


def tile_name(x: Column, y: Column, size: float = TILE) -> Column:
    """Name of the 1 km tile of a point, by the floor of its coordinates."""
    return F.format_string("1km_%d_%d", F.floor(y / size), F.floor(x / size))


def tile_of_path(path: Column) -> Column:
    """The tile name in a path; the file's bare name where there is none."""
    found = F.regexp_extract(path, r"1km_(\d+)_(\d+)", 0)
    return F.when(found != "", found).otherwise(F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1))


def tile_extent(name: Column, size: float = TILE) -> Column:
    """xmin, ymin, xmax, ymax of a tile name."""
    n, e = (F.regexp_extract(name, r"1km_(\d+)_(\d+)", k).cast("double") for k in (1, 2))
    return F.struct((e * size).alias("xmin"), (n * size).alias("ymin"), ((e + 1) * size).alias("xmax"), ((n + 1) * size).alias("ymax"))


def tile_index(name: Column) -> Column:
    """Row and column of a tile in the national scheme: 6200 - N, E - 600."""
    n, e = (F.regexp_extract(name, r"1km_(\d+)_(\d+)", k).cast("int") for k in (1, 2))
    return F.struct((6200 - n).alias("row"), (e - 600).alias("col"))


def tile_wkt(name: Column) -> Column:
    """The tile's extent as a closed WKT polygon."""
    b = tile_extent(name)
    corners = [("xmin", "ymin"), ("xmin", "ymax"), ("xmax", "ymax"), ("xmax", "ymin"), ("xmin", "ymin")]
    return F.concat(F.lit("POLYGON(("), F.concat_ws(",", *[F.format_string("%.2f %.2f", b[x], b[y]) for x, y in corners]), F.lit("))"))
