"""Point clouds, features and rasters derived from the driver's tables, as DataFrames and as DuckDB SQL.

A point is a lineitem row: coordinates in eighths and heights in sixteenths of a metre, so sums are exact.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import REPORTED, tile_name
from ..operators.points import spread

X0, Y0, SIDE = 632900.0, 6173900.0, 200.0
X1, Y1 = X0 + SIDE, Y0 + SIDE

# feat_id, ptype, ring, vertices: convex, concave and with a hole; closed.
POLYGONS = [
    (1, "building", 0, [(632910.0, 6173910.0, 24.0), (632960.0, 6173912.0, 26.0), (632955.0, 6173960.0, 25.0), (632908.0, 6173955.0, 25.0), (632910.0, 6173910.0, 24.0)]),
    (2, "lake", 0, [(632980.0, 6173980.0, 15.0), (633040.0, 6173985.0, 15.0), (633005.0, 6174005.0, 15.0), (633045.0, 6174040.0, 15.0), (632985.0, 6174035.0, 15.0), (632980.0, 6173980.0, 15.0)]),
    (3, "building", 0, [(633050.0, 6174050.0, 30.0), (633090.0, 6174050.0, 30.0), (633090.0, 6174090.0, 30.0), (633050.0, 6174090.0, 30.0), (633050.0, 6174050.0, 30.0)]),
    (3, "building", 1, [(633060.5, 6174060.5, 30.0), (633080.5, 6174060.5, 30.0), (633080.5, 6174080.5, 30.0), (633060.5, 6174080.5, 30.0), (633060.5, 6174060.5, 30.0)]),
    (4, "bridge", 0, [(632920.3, 6174020.3, 20.0), (632970.7, 6174022.1, 20.0), (632969.2, 6174045.9, 20.0), (632920.3, 6174020.3, 20.0)]),
]
LINES = [
    (1, [(632905.0, 6173925.0, 20.0), (633000.0, 6173995.0, 22.0), (633095.0, 6174010.0, 24.0)]),
    (2, [(632950.0, 6174095.0, 18.0), (632999.0, 6174000.0, 21.0), (633001.0, 6173905.0, 25.0)]),
]
GCPS = [(1, 632950.3, 6173950.2, 21.5), (2, 633000.1, 6174000.1, 24.0), (3, 633060.7, 6174020.9, 30.25), (4, 632930.4, 6174070.6, 18.0)]


def _points(spark: SparkSession, sf_dir: str, x=(131, 17, 389), y=(197, 29, 541)) -> DataFrame:
    li = spread(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_orderkey", "l_linenumber")
    o, p, s, n = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    return li.select(
        (o * 8 + n).alias("k"),
        (F.lit(X0) + ((p * x[0] + o * x[1] + n * x[2]) % 1600) / F.lit(8.0)).alias("x"),
        (F.lit(Y0) + ((s * y[0] + o * y[1] + n * y[2]) % 1600) / F.lit(8.0)).alias("y"),
        (F.lit(10.0) + (F.round(F.col("l_extendedprice") * 100).cast("long") % 640) / F.lit(16.0)).alias("z"),
        F.element_at(F.lit(list(REPORTED)), (p % 13 + 1).cast("int")).alias("c"),
        (s % 4).cast("int").alias("pid"),
        (1 + n % 3).cast("int").alias("rn"),
        (F.unix_timestamp("l_shipdate") - F.unix_timestamp(F.lit("1980-01-06 00:00:00").cast("timestamp")) - 1_000_000_000).cast("double").alias("gps_time"),
    )


_TYPES = {"int": pa.int32(), "double": pa.float64(), "string": pa.string()}


def local(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A few rows as part of the plan: reading them starts no job."""
    schema = pa.schema([(name, _TYPES[kind]) for name, kind in (c.split() for c in ddl.split(", "))])
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, x, y, z, c, pid, rn, gps_time, tile."""
    return _points(spark, sf_dir).withColumn("tile", tile_name(F.col("x"), F.col("y")))


def points_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second epoch: the same rows, elsewhere."""
    return _points(spark, sf_dir, (113, 23, 421), (211, 31, 577)).withColumn("tile", tile_name(F.col("x"), F.col("y")))


def polygons(spark: SparkSession) -> DataFrame:
    rows = [(f, t, r, q, *v) for f, t, r, vs in POLYGONS for q, v in enumerate(vs)]
    return local(spark, rows, "feat_id int, ptype string, ring int, seq int, x double, y double, z double")


def lines(spark: SparkSession) -> DataFrame:
    rows = [(f, 0, q, *v) for f, vs in LINES for q, v in enumerate(vs)]
    return local(spark, rows, "feat_id int, ring int, seq int, x double, y double, z double")


def gcps(spark: SparkSession) -> DataFrame:
    return local(spark, GCPS, "id int, x double, y double, z double")


def geoid(spark: SparkSession) -> DataFrame:
    """Heights on a 50 m grid whose cell (0, 0) is centred at the upper left corner, one cell beyond each side."""
    n = int(SIDE / 50) + 3
    side = spark.range(n).select(F.col("id").cast("int").alias("row")).crossJoin(F.broadcast(spark.range(n).select(F.col("id").cast("int").alias("col"))))
    return side.withColumn("value", 36 + F.col("row") / 8 + F.col("col") / 16)


GEOID = (X0 - 75.0, 50.0, Y1 + 75.0, 50.0)  # x of the left edge, cell width, y of the upper edge, cell height


def grid(spark: SparkSession, sf_dir: str, cell: float = 10.0) -> DataFrame:
    """Mean height by cell, rows from the top of the extent."""
    p = points(spark, sf_dir)
    keyed = p.select(F.floor((F.lit(Y1) - F.col("y")) / cell).cast("int").alias("row"), F.floor((F.col("x") - X0) / cell).cast("int").alias("col"), "z")
    return keyed.groupBy("row", "col").agg(F.avg("z").alias("value"))


def _sql_points(name: str, x: tuple[int, int, int], y: tuple[int, int, int]) -> str:
    return f"""{name} AS (SELECT *, '1km_' || floor(y / 1000)::BIGINT || '_' || floor(x / 1000)::BIGINT AS tile FROM (
  SELECT l_orderkey * 8 + l_linenumber AS k,
    {X0}::DOUBLE + ((l_partkey * {x[0]} + l_orderkey * {x[1]} + l_linenumber * {x[2]}) % 1600) / 8.0::DOUBLE AS x,
    {Y0}::DOUBLE + ((l_suppkey * {y[0]} + l_orderkey * {y[1]} + l_linenumber * {y[2]}) % 1600) / 8.0::DOUBLE AS y,
    10.0::DOUBLE + (round(l_extendedprice * 100)::BIGINT % 640) / 16.0::DOUBLE AS z,
    ([{", ".join(map(str, REPORTED))}])[(l_partkey % 13)::INT + 1]::INT AS c, (l_suppkey % 4)::INT AS pid, (1 + l_linenumber % 3)::INT AS rn,
    (epoch(l_shipdate) - epoch(TIMESTAMP '1980-01-06 00:00:00') - 1000000000)::DOUBLE AS gps_time
  FROM lineitem))"""


def _values(name: str, columns: str, rows: list[tuple]) -> str:
    text = lambda v: f"'{v}'" if isinstance(v, str) else f"{v}::DOUBLE" if isinstance(v, float) else str(v)
    return f"{name}({columns}) AS (VALUES {', '.join('(' + ', '.join(map(text, r)) + ')' for r in rows)})"


SQL = {
    "points": _sql_points("points", (131, 17, 389), (197, 29, 541)),
    "points_old": _sql_points("points_old", (113, 23, 421), (211, 31, 577)),
    "polygons": _values("polygons", "feat_id, ptype, ring, seq, x, y, z", [(f, t, r, q, *v) for f, t, r, vs in POLYGONS for q, v in enumerate(vs)]),
    "lines": _values("lines", "feat_id, ring, seq, x, y, z", [(f, 0, q, *v) for f, vs in LINES for q, v in enumerate(vs)]),
    "gcps": _values("gcps", "id, x, y, z", GCPS),
    "geoid": f"geoid AS (SELECT r::INT AS row, q::INT AS col, 36 + r / 8.0::DOUBLE + q / 16.0::DOUBLE AS value FROM range({int(SIDE / 50) + 3}) a(r), range({int(SIDE / 50) + 3}) b(q))",
    "grid": f"grid AS (SELECT floor(({Y1}::DOUBLE - y) / 10.0)::INT AS row, floor((x - {X0}::DOUBLE) / 10.0)::INT AS col, avg(z) AS value FROM points GROUP BY 1, 2)",
}


def sql(query: str, *names: str) -> str:
    """query after the named relations."""
    return "WITH " + ",\n".join(SQL[n] for n in names) + "\n" + query
