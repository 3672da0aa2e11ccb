"""The tile catalogue: which files hold which tile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..model import tile_index, tile_of_path, tile_wkt


def walk(spark: SparkSession, folder: str, ext: str = "las", depth: int | None = None, include: str | None = None, exclude: str | None = None, name: str | None = None) -> DataFrame:
    """tile_name, path, mtime, row, col, geom of the files under a folder.

    depth: most folders between; include and exclude: patterns of the folder below the root; name: one of the file name.
    Files whose name tells no tile are left out. Only the listing is read, not the files.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{ext}").option("recursiveFileLookup", "true").load(folder).select("path", F.col("modificationTime").alias("mtime"))
    root = folder.rstrip("/").split(":")[-1].lstrip("/")
    below = F.regexp_replace(F.col("path"), rf"^.*\Q{root}\E/", "")
    inner = F.regexp_replace(below, r"[^/]*$", "")
    out = found.withColumns({"_dir": inner, "_name": F.regexp_extract(below, r"[^/]*$", 0)})
    if depth is not None:
        out = out.where(F.size(F.split("_dir", "/")) - 1 <= depth)
    if include is not None:
        out = out.where(F.col("_dir").rlike(include))
    if exclude is not None:
        out = out.where(~F.col("_dir").rlike(exclude))
    if name is not None:
        out = out.where(F.col("_name").rlike(name))
    tile = tile_of_path(F.col("path"))
    out = out.withColumn("tile_name", tile).where(F.col("tile_name").rlike(r"^1km_\d+_\d+$"))
    i = tile_index(F.col("tile_name"))
    return out.select("tile_name", "path", "mtime", i["row"].alias("row"), i["col"].alias("col"), tile_wkt(F.col("tile_name")).alias("geom"))


def upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """The newest row of each tile name."""
    latest = Window.partitionBy("tile_name").orderBy(F.desc("mtime"), F.desc("path"))
    return old.unionByName(new, allowMissingColumns=True).withColumn("_r", F.row_number().over(latest)).where("_r = 1").drop("_r")


def refresh(catalogue: DataFrame, listing: DataFrame) -> DataFrame:
    """The catalogue with the times of a new listing; files that are gone keep theirs."""
    now = listing.select("path", F.col("mtime").alias("_now"))
    return catalogue.join(now, "path", "left").withColumn("mtime", F.coalesce("_now", "mtime")).drop("_now").select(*catalogue.columns)


def without(catalogue: DataFrame, other: DataFrame) -> DataFrame:
    """Tiles that the other catalogue does not have."""
    return catalogue.join(other.select("tile_name"), "tile_name", "left_anti")


def match_reference(tiles: DataFrame, reference: DataFrame) -> DataFrame:
    """Tiles with the path of their reference tile (the first by path); those without one are dropped."""
    first = reference.groupBy("tile_name").agg(F.min("path").alias("ref_path"))
    return tiles.join(first, "tile_name")
