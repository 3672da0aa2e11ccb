"""Accuracy and precision of surfaces, and the elevation model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import aggregates, focal, geometry, raster, regions, tin
from .points import cut_to_class

POINT = ["k", "x", "y", "z", "c", "pid", "rn"]


def strip_points(points: DataFrame, classes: Sequence[int], least: int = 50) -> DataFrame:
    """pid, x, y, z of the strips with more than `least` points of the classes; a parameter: smaller ones give no surface.

    They are written once, as counts, strips by block and surfaces all read them: points should be cut to the features first."""
    ground = regions.cut(cut_to_class(points, classes).select("pid", "x", "y", "z"), "strips")
    enough = ground.groupBy("pid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least).select("pid")
    return ground.join(enough, "pid", "left_semi")


def beside(points: DataFrame, places: DataFrame, reach: float = 2 * tin.HALO) -> DataFrame:
    """Points of the cells, as wide as the reach, at and around a place's: all that are nearer, at least."""
    cells = tin.in_blocks(places.select("x", "y"), reach, reach).select("bx", "by").distinct()
    at = {"bx": F.floor(F.col("x") / reach).cast("int"), "by": F.floor(F.col("y") / reach).cast("int")}
    return points.withColumns(at).join(geometry.small_enough(cells, geometry.BROADCAST_SEGMENTS), ["bx", "by"], "left_semi").drop("bx", "by")


def _asked(queries: DataFrame, ground: DataFrame) -> DataFrame:
    """Each query once for every strip with points in its block, or beside it."""
    at = {"bx": F.floor(F.col("x") / tin.BLOCK).cast("int"), "by": F.floor(F.col("y") / tin.BLOCK).cast("int")}
    strips = tin.in_blocks(ground, tin.BLOCK, tin.HALO).select("pid", "bx", "by").distinct()
    return queries.withColumns(at).join(strips, ["bx", "by"]).drop("bx", "by")


def strip_differences(near: DataFrame, ground: DataFrame, tolerances: tuple[float, float, float]) -> DataFrame:
    """Points near features (feat_id, pid, x, y, z) against the surfaces of the other strips' ground: id1 (surface), id2, dz."""
    mine = near.select("feat_id", F.col("pid").alias("id2"), "x", "y", "z")
    asked = _asked(mine, ground).where("pid <> id2")
    got = tin.heights(asked, ground, ["feat_id", "id2", "x", "y", "z"], on=["pid"], tolerances=tolerances, prune=True)
    return got.select("feat_id", F.col("pid").alias("id1"), "id2", (F.col("h") - F.col("z")).alias("dz"))


def precision(near: DataFrame, ground: DataFrame, tolerances: tuple[float, float, float], least: int = 2) -> DataFrame:
    """Per feature and pair of strips: trimmed statistics both ways, and the combined precision. least: differences that a
    direction must have to count, a parameter."""
    stats = aggregates.dz_statistics(strip_differences(near, ground, tolerances), ["feat_id", "id1", "id2"]).where(F.col("n") >= least)
    lo, hi = F.least("id1", "id2"), F.greatest("id1", "id2")
    way = F.when(F.col("id1") < F.col("id2"), "12").otherwise("21")
    both = stats.select("feat_id", lo.alias("id1"), hi.alias("id2"), way.alias("way"), "mean", "sd", "rms", "n")
    pick = lambda c, w, n: F.max(F.when(F.col("way") == w, F.col(c))).alias(f"{n}{w}")
    wide = both.groupBy("feat_id", "id1", "id2").agg(*[pick(c, w, n) for c, n in (("mean", "mean"), ("sd", "sigma"), ("rms", "rms"), ("n", "npoints")) for w in ("12", "21")])
    n12, n21 = F.coalesce("npoints12", F.lit(0)), F.coalesce("npoints21", F.lit(0))
    combined = (F.coalesce(F.col("rms12") * n12, F.lit(0.0)) + F.coalesce(F.col("rms21") * n21, F.lit(0.0))) / (n12 + n21)
    return wide.withColumn("combined_precision", combined)


def accuracy(vertices: DataFrame, ground: DataFrame, tolerances: tuple[float, float, float]) -> DataFrame:
    """Strips' surfaces against control features: mean and deviation of height less the feature's, per strip and feature."""
    asked = _asked(vertices.select("feat_id", "seq", "x", "y", "z"), ground)
    got = tin.heights(asked, ground, ["feat_id", "seq", "x", "y", "z"], on=["pid"], tolerances=tolerances, prune=True)
    dz = F.col("h") - F.col("z")
    return got.groupBy("feat_id", "pid").agg(F.avg(dz).alias("mean"), F.stddev_pop(dz).alias("sigma"), F.count(F.lit(1)).alias("npoints"), F.avg("x").alias("x"), F.avg("y").alias("y"))


def elevation_model(
    points: DataFrame, cell: float, xmin: float, ymax: float, rows: int, cols: int, terrain: Sequence[int], surface: Sequence[int], first_returns: bool = False, *,
    houses: DataFrame | None = None, lakes: DataFrame | None = None, rivers: DataFrame | None = None, sea: DataFrame | None = None, warp: tuple | None = None,
    large: float = 3.0, drop: float = 1.0, flatten: int = 0, smooth: int = 0, sea_z: float | None = None, sea_tolerance: float = 0.8, lake_tolerance: float = 0.45,
) -> DataFrame:
    """Heights (row, col, value) on cell centres: of terrain, or with first_returns of the surface. terrain, surface: classes.

    Steps: warp the heights (geoid, x_centre, cx, y_centre, cy: its heights are taken off); leave out terrain points inside houses
    that lie over 1 m below a point within 2 m; triangulate; spread the water over the regions of triangles longer than `large`
    that cross its shore; fill wet cells of such triangles from corners lowered by edges that drop over `drop`, and level them by
    a mean over `flatten` cells; smooth under houses by one over `smooth` cells; burn sea_z into the sea and the lakes' own height
    (z of their vertices) into lakes. The surface takes wet cells of its large triangles from the terrain, then sea and lakes are
    burned. Steps whose layer, radius or height is not given are left out.
    """
    spark = points.sparkSession
    frame = (xmin, ymax, cell, rows, cols)
    burned = lambda layer: None if layer is None else raster.rasterize(spark, layer, *frame, all_touched=True)
    points = points.where(F.col("c").isin(*surface)).select("x", "y", "z", "c", "rn")
    if warp is not None:
        points = raster.to_ellipsoidal(points, *warp, back=True)
    empty = raster.mesh(spark, 1, 1).select("row", "col").where("false")
    built = empty if houses is None else regions.cut(burned(houses).select("row", "col").distinct(), "dem-houses")
    if houses is not None:
        points = _clean_houses(points, built, terrain, xmin, ymax, cell)
    sea_cells = empty if sea is None else regions.cut(burned(sea).select("row", "col").distinct(), "dem-sea")
    lake_cells = None
    water = sea_cells
    if lakes is not None:
        heights = lakes.groupBy("feat_id").agg(F.avg("z").alias("lake"))
        lake_cells = regions.cut(burned(lakes).join(F.broadcast(heights), "feat_id").groupBy("row", "col").agg(F.max_by("lake", "feat_id").alias("lake")), "dem-lakes")
        water = water.union(lake_cells.select("row", "col"))
    if rivers is not None:
        water = water.union(burned(rivers).select("row", "col"))

    def burn_water(cells: DataFrame) -> DataFrame:
        if sea is not None and sea_z is not None:
            cells = regions.cut(burn_sea(cells, sea_cells, sea_z, sea_tolerance), "dem-sea-burned")
        return cells if lake_cells is None else burn_lakes(cells, lake_cells, lake_tolerance)

    found, lowered = _gridded(cut_to_class(points, terrain), frame, large, drop)
    wide = found.where("wide").select("row", "col")
    wet = regions.cut(regions.expand_water(wide, water.distinct()).join(built, ["row", "col"], "left_anti"), "dem-water")
    fill = wide.join(wet, ["row", "col"], "left_semi")
    cells = found.join(lowered.join(fill, ["row", "col"], "left_semi"), ["row", "col"], "left").select("row", "col", F.coalesce("low", "value").alias("value"))
    if flatten:
        cells = raster.masked_mean(cells, fill, flatten)
    if smooth:
        under = wide.join(built, ["row", "col"], "left_semi")
        around = raster.dilate(under).join(wet, ["row", "col"], "left_anti")
        cells = regions.cut(cells, "dem-filled")
        level = raster.masked_mean(cells.where("value is not null"), around, smooth).withColumnRenamed("value", "level")
        dry = under.join(wet, ["row", "col"], "left_anti")
        cells = raster.burn(cells.join(level, ["row", "col"], "left"), dry, F.col("level"))
    dtm = burn_water(regions.cut(cells.join(found.select("row", "col", "wide"), ["row", "col"]), "dem-terrain")).select("row", "col", "value")
    if not first_returns:
        return dtm.where("value is not null")
    seen, _ = _gridded(points.where("rn = 1"), frame, large, None)
    from_terrain = dtm.join(wet, ["row", "col"], "left_semi").withColumnRenamed("value", "ground")
    filled = seen.join(from_terrain, ["row", "col"], "left").withColumn("value", F.when(F.col("wide"), F.coalesce("ground", "value")).otherwise(F.col("value")))
    dsm = burn_water(regions.cut(filled.select("row", "col", "value", "wide"), "dem-surface"))
    return dsm.select("row", "col", "value").where("value is not null")


def _clean_houses(points: DataFrame, built: DataFrame, terrain: Sequence[int], xmin: float, ymax: float, cell: float) -> DataFrame:
    """Points without terrain that lies over 1 m below a point within 2 m, both in houses less their border cells."""
    at = {"row": F.floor((F.lit(ymax) - F.col("y")) / cell).cast("int"), "col": F.floor((F.col("x") - xmin) / cell).cast("int")}
    inside = points.withColumns(at).join(raster.erode(built), ["row", "col"], "left_semi").select("x", "y", "z", "c")
    asked = cut_to_class(inside, terrain).select("x", "y", "z").distinct()
    low = focal.max_filter(asked, inside.select("x", "y", "z"), 2.0, ["x", "y", "z"]).where("value - z > 1").select("x", "y", "z")
    gone = low.crossJoin(F.broadcast(points.sparkSession.createDataFrame([(int(c),) for c in terrain], "c int")))
    return points.join(gone, ["x", "y", "z", "c"], "left_anti")


def _gridded(points: DataFrame, frame: tuple, large: float, drop: float | None) -> tuple[DataFrame, DataFrame | None]:
    """All cells (row, col, value, wide), value null where no triangle is, and with a drop the heights (row, col, low) of wide
    cells over the lowered corners."""
    xmin, ymax, cell, rows, cols = frame
    surface = regions.cut(tin.geometry(tin.triangulate(points.select("x", "y", "z"))), "dem-tin")
    mesh = raster.mesh(points.sparkSession, rows, cols)
    found = regions.cut(tin.locate(raster.mesh_points(mesh, xmin, ymax, cell), surface, ["row", "col", "x", "y"]), "dem-found")
    height = lambda z: sum((F.col(f"b{k}") * F.col(f"{z}{k}") for k in range(3)), F.lit(0.0))
    cells = mesh.select("row", "col").join(found.select("row", "col", height("z").alias("value"), (F.col("xy_size") > large).alias("wide")), ["row", "col"], "left")
    cells = regions.cut(cells.withColumn("wide", F.coalesce("wide", F.lit(False))), "dem-cells")
    if drop is None:
        return cells, None
    corners = regions.cut(tin.lower_steep(surface, drop), "dem-low")
    low = found.where(F.col("xy_size") > large)
    for k in range(3):
        low = low.join(corners.select(*[F.col(a).alias(f"{a}{k}") for a in "xyz"], F.col("low").alias(f"low{k}")), [f"{a}{k}" for a in "xyz"])
    return cells, low.select("row", "col", height("low").alias("low"))


def burn_sea(cells: DataFrame, sea: DataFrame, sea_z: float, tolerance: float) -> DataFrame:
    """Cells (row, col, value, wide) with sea_z in the sea: cells of the layer that rise less than the tolerance above it, lie in
    large triangles or have no height; regions not above sea_z that cross from those; and single cells between."""
    mask = cells.where((F.col("value") - sea_z < tolerance) | F.col("wide") | F.col("value").isNull()).join(sea, ["row", "col"], "left_semi").select("row", "col")
    low = cells.where((F.col("value") - sea_z <= 0) | F.col("value").isNull()).select("row", "col")
    return _burn(cells, _enclosed(regions.expand_water(low, mask)), F.lit(sea_z))


def burn_lakes(cells: DataFrame, lakes: DataFrame, tolerance: float) -> DataFrame:
    """Cells (row, col, value, wide) with the height of lakes (row, col, lake) where they rise less than the tolerance above it, lie in
    large triangles or have no height, and in single cells between."""
    known = cells.join(lakes, ["row", "col"], "left")
    mask = known.where((F.col("value") - F.col("lake") < tolerance) | F.col("wide") | F.col("value").isNull()).select("row", "col")
    return _burn(known, _enclosed(mask).join(lakes, ["row", "col"], "left_semi"), F.col("lake"))


def _burn(cells: DataFrame, mask: DataFrame, value: Column) -> DataFrame:
    joined = cells.join(mask.withColumn("_in", F.lit(True)), ["row", "col"], "left")
    return joined.select("row", "col", F.when(F.col("_in"), value).otherwise(F.col("value")).alias("value"), "wide")


def _enclosed(mask: DataFrame) -> DataFrame:
    """The mask with the cells whose eight neighbours are all in it."""
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("di"), F.lit(j).alias("dj")) for i, j in raster.EIGHT]))
    moved = mask.select("row", "col", steps.alias("s")).select((F.col("row") + F.col("s.di")).alias("row"), (F.col("col") + F.col("s.dj")).alias("col"), ((F.col("s.di") == 0) & (F.col("s.dj") == 0)).alias("own"))
    return moved.groupBy("row", "col").agg(F.bool_or("own").alias("own"), F.count(F.lit(1)).alias("n")).where("own or n = 8").select("row", "col")


def near_polygons(points: DataFrame, polygons: DataFrame, classes: Sequence[int]) -> DataFrame:
    return geometry.points_in_polygons(cut_to_class(points, classes), polygons)


def near_lines(points: DataFrame, lines: DataFrame, classes: Sequence[int], distance: float) -> DataFrame:
    return geometry.points_near_lines(cut_to_class(points, classes), lines, distance)
