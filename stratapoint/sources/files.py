"""Readers of point, raster and feature files; Parquet is the canonical form.

Files without a splittable format (LAS, npy, raw doubles, ASCII grids) are read whole, one per task, in slices.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import tile_of_path

SLICE = 1 << 20  # points in a batch
COLUMNS = pa.schema([("path", pa.string()), *[(n, pa.float64()) for n in "xyz"], *[(n, pa.int32()) for n in ("c", "pid", "rn")], ("gps_time", pa.float64()), *[(n, pa.int32()) for n in ("r", "g", "b")]])
DDL = "path string, x double, y double, z double, c int, pid int, rn int, gps_time double, r int, g int, b int"

# Place of gps time and of red, green, blue in the records of LAS point formats.
LAS_TIME = {1: 20, 3: 20, 4: 20, 5: 20, 6: 22, 7: 22, 8: 22, 9: 22, 10: 22}
LAS_RGB = {2: 20, 3: 28, 5: 28, 7: 30, 8: 30, 10: 30}


def parse_las(data: bytes) -> dict[str, np.ndarray]:
    """Columns of an uncompressed LAS file, version 1.0 to 1.4."""
    if data[:4] != b"LASF":
        raise ValueError("not a LAS file")
    offset = struct.unpack_from("<I", data, 96)[0]
    form, size, count = struct.unpack_from("<BHI", data, 104)
    if form & 0x80:
        raise ValueError("compressed points (LAZ) are not supported")
    if data[25] >= 4 and not count:
        count = struct.unpack_from("<Q", data, 247)[0]
    scale, shift = struct.unpack_from("<3d", data, 131), struct.unpack_from("<3d", data, 155)
    raw = np.frombuffer(data, np.uint8, count * size, offset).reshape(count, size)
    take = lambda at, kind: np.ascontiguousarray(raw[:, at : at + np.dtype(kind).itemsize]).view(kind)[:, 0]
    out = {n: take(4 * k, "<i4") * scale[k] + shift[k] for k, n in enumerate("xyz")}
    if form < 6:
        out |= {"c": raw[:, 15] & 31, "pid": take(18, "<u2"), "rn": raw[:, 14] & 7}
    else:
        out |= {"c": raw[:, 16], "pid": take(20, "<u2"), "rn": raw[:, 14] & 15}
    if form in LAS_TIME:
        out["gps_time"] = take(LAS_TIME[form], "<f8")
    if form in LAS_RGB:
        out |= {n: take(LAS_RGB[form] + 2 * k, "<u2") for k, n in enumerate("rgb")}
    return out


def _columns(array: np.ndarray, names: str) -> dict[str, np.ndarray]:
    return {n: array[:, k] for k, n in enumerate(names.split()) if n != "-"}


PARSERS: dict[str, Callable[[bytes], dict[str, np.ndarray]]] = {
    "las": parse_las,
    "npy": lambda data: _columns(np.load(io.BytesIO(data)), "x y z"),
    "bin": lambda data: _columns(np.frombuffer(data, "<f8").reshape(-1, 5), "x y z c pid"),
    "patch": lambda data: _columns(np.frombuffer(data, "<f8").reshape(-1, 6), "x y z - pid c"),
}


def _read_binary(spark: SparkSession, path: str, kind: str) -> DataFrame:
    parse = PARSERS[kind]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                got = parse(data)
                for a in range(0, len(got["x"]), SLICE):
                    z = slice(a, a + SLICE)
                    n = len(got["x"][z])
                    arrays = [pa.array([name] * n)] + [pa.array(got[f.name][z].astype(f.type.to_pandas_dtype())) if f.name in got else pa.nulls(n, f.type) for f in list(COLUMNS)[1:]]
                    yield pa.RecordBatch.from_arrays(arrays, schema=COLUMNS)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(read, DDL)


def read_text_points(spark: SparkSession, path: str, delimiter: str | None = None) -> DataFrame:
    """x, y, z of a text file; without a delimiter the columns are parted by white space. Lines that are not numbers are dropped."""
    parts = F.split(F.trim("value"), r"\s+" if delimiter is None else f"\\Q{delimiter}\\E")
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), *[F.try_element_at(parts, F.lit(k + 1)).try_cast("double").alias(n) for k, n in enumerate("xyz")])
    return rows.where("x is not null and y is not null and z is not null")


GEOJSON = T.StructType([T.StructField("features", T.ArrayType(T.StructType([T.StructField("properties", T.MapType(T.StringType(), T.StringType())), T.StructField("geometry", T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]))])))])
_POSITION = "array<double>"
_DEPTH = {"Point": 0, "MultiPoint": 1, "LineString": 1, "MultiLineString": 2, "Polygon": 2, "MultiPolygon": 3}


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Vertices (feat_id, kind, part, ring, seq, x, y, z, properties) of GeoJSON files, multi-geometries taken apart.

    feat_id counts the features of a file. Geometries of other kinds are an error.
    """
    feature = spark.read.schema(GEOJSON).json(path, multiLine=True).select(F.posexplode("features").alias("feat_id", "f"))
    base = feature.select("feat_id", F.col("f.properties").alias("properties"), F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("text"))
    known = F.when(F.col("kind").isin(*_DEPTH), F.col("kind")).otherwise(F.raise_error(F.concat(F.lit("unsupported geometry "), F.coalesce("kind", F.lit("null")))).cast("string"))
    deep = F.when(known.isin("MultiPolygon"), F.col("text"))
    for kinds, wrap in ((("Polygon", "MultiLineString"), 1), (("LineString", "MultiPoint"), 2), (("Point",), 3)):
        deep = deep.when(F.col("kind").isin(*kinds), F.concat(F.lit("[" * wrap), F.col("text"), F.lit("]" * wrap)))
    cast = F.from_json(deep, f"array<array<array<{_POSITION}>>>")
    parts = base.select("feat_id", "kind", "properties", F.posexplode(cast).alias("part", "rings"))
    rings = parts.select("feat_id", "kind", "properties", "part", F.posexplode("rings").alias("ring", "vertices"))
    flat = rings.select("feat_id", "kind", "properties", "part", "ring", F.posexplode("vertices").alias("seq", "v"))
    return flat.select("feat_id", "kind", "part", "ring", "seq", *[F.try_element_at("v", F.lit(k + 1)).alias(n) for k, n in enumerate("xyz")], "properties")


def read_ascii_grid(spark: SparkSession, path: str) -> DataFrame:
    """path, row, col, value, and the header (xmin, ymax of the outer edge, cell) of ESRI ASCII grids; no-data has no row."""
    schema = pa.schema([("path", pa.string()), ("row", pa.int32()), ("col", pa.int32()), ("value", pa.float64()), ("xmin", pa.float64()), ("ymax", pa.float64()), ("cell", pa.float64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = data.split()
                head, at = {}, 0
                while at < len(words) and words[at][:1].isalpha():
                    head[words[at].decode().lower()] = float(words[at + 1])
                    at += 2
                rows, cols, cell = int(head["nrows"]), int(head["ncols"]), head["cellsize"]
                values = np.array(words[at : at + rows * cols], np.float64).reshape(rows, cols)
                i, j = np.nonzero(values != head.get("nodata_value", np.nan))
                half = cell / 2
                xmin = head["xllcorner"] if "xllcorner" in head else head["xllcenter"] - half
                ymin = head["yllcorner"] if "yllcorner" in head else head["yllcenter"] - half
                n = len(i)
                yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(values[i, j]), *[pa.array(np.full(n, v)) for v in (xmin, ymin + rows * cell, cell)]], schema=schema)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(read, "path string, row int, col int, value double, xmin double, ymax double, cell double")


def read_points(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """Points of a file or folder, by its extension or the given kind, with the tile of their path."""
    kind = (kind or path.rstrip("/*").rpartition(".")[2]).lower()
    if kind == "parquet":
        return spark.read.parquet(path)
    if kind == "laz":
        raise ValueError("LAZ needs a decompressor; convert to LAS or Parquet")
    if kind in PARSERS:
        out = _read_binary(spark, path, kind)
    elif kind in ("txt", "xyz", "csv"):
        out = read_text_points(spark, path, "," if kind == "csv" else None)
    elif kind in ("geojson", "json"):
        out = read_features(spark, path).withColumn("path", F.lit(path)).select("path", "x", "y", "z")
    elif kind == "asc":
        out = read_ascii_grid(spark, path).select("path", (F.col("xmin") + (F.col("col") + 0.5) * F.col("cell")).alias("x"), (F.col("ymax") - (F.col("row") + 0.5) * F.col("cell")).alias("y"), F.col("value").alias("z"))
    else:
        raise ValueError(f"unknown kind of file: {kind}")
    return out.withColumn("tile", tile_of_path(F.col("path")))


def layer(spark: SparkSession, name: str | None = None, sql: str | None = None, extent: tuple[float, float, float, float] | None = None, first: DataFrame | None = None) -> DataFrame:
    """A feature layer: by SQL, where WKT_EXT stands for the extent's polygon; else by name of a view; else the first."""
    if sql is not None:
        if extent is not None:
            a, b, c, d = extent
            sql = sql.replace("WKT_EXT", f"'POLYGON(({a} {b},{a} {d},{c} {d},{c} {b},{a} {b}))'")
        return spark.sql(sql)
    if name is not None:
        return spark.table(name)
    if first is None:
        raise ValueError("no layer is named")
    return first
