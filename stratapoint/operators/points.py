"""Operators on points that are filters, projections and unions: plain column expressions, pushed to the scan."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df over as many partitions as there are cores where its files make fewer (a row group is not split); else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores else df.repartition(cores, *keys)


def read_filtered(points: DataFrame, classes: Iterable[int] | None = None, xy_box: Sequence[float] | None = None, z_box: Sequence[float] | None = None) -> DataFrame:
    """The filters of a load: classes are alternatives, the xy box is inclusive, the z box strict."""
    out = points
    if classes is not None:
        out = out.where(F.col("c").isin(*classes))
    if xy_box is not None:
        out = cut_to_box(out, *xy_box)
    if z_box is not None:
        out = out.where((F.col("z") > z_box[0]) & (F.col("z") < z_box[1]))
    return out


def cut_to_class(points: DataFrame, c: int | Iterable[int], exclude: bool = False) -> DataFrame:
    if "c" not in points.columns:
        raise ValueError("points have no class")
    found = F.col("c").isin(*([c] if isinstance(c, int) else c))
    return points.where(~found if exclude else found)


def cut_to_return_number(points: DataFrame, rn: int) -> DataFrame:
    return points.where(F.col("rn") == rn)


def cut_to_z_interval(points: DataFrame, low: float, high: float) -> DataFrame:
    """Inclusive at both ends."""
    return points.where(F.col("z").between(low, high))


def cut_to_strip(points: DataFrame, pid: int) -> DataFrame:
    return points.where(F.col("pid") == pid)


def cut_to_box(points: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Inclusive on all sides."""
    return points.where(F.col("x").between(xmin, xmax) & F.col("y").between(ymin, ymax))


def grid_cell(x: Column, y: Column, xmin: float, ymax: float, cell: float) -> tuple[Column, Column]:
    """Row (from the top) and column of a raster cell, by floor."""
    return F.floor((F.lit(ymax) - y) / cell).cast("int"), F.floor((x - xmin) / cell).cast("int")


def cut_to_mask(points: DataFrame, mask: DataFrame, xmin: float, ymax: float, cell: float) -> DataFrame:
    """Points whose cell is in the mask (row, col)."""
    row, col = grid_cell(F.col("x"), F.col("y"), xmin, ymax, cell)
    return points.withColumns({"row": row, "col": col}).join(mask.select("row", "col").distinct(), ["row", "col"], "left_semi").drop("row", "col")


def boxes_overlap(a: Column, b: Column) -> Column:
    """Closed boxes of fields xmin, ymin, xmax, ymax."""
    return (a["xmin"] <= b["xmax"]) & (b["xmin"] <= a["xmax"]) & (a["ymin"] <= b["ymax"]) & (b["ymin"] <= a["ymax"])


def box_intersection(a: Column, b: Column) -> Column:
    """Their common box; null where it is empty or has no area."""
    box = F.struct(
        F.greatest(a["xmin"], b["xmin"]).alias("xmin"), F.greatest(a["ymin"], b["ymin"]).alias("ymin"), F.least(a["xmax"], b["xmax"]).alias("xmax"), F.least(a["ymax"], b["ymax"]).alias("ymax")
    )
    return F.when((box["xmin"] < box["xmax"]) & (box["ymin"] < box["ymax"]), box)


def transform(points: DataFrame, rotation: Sequence[Sequence[float]], shift: Sequence[float]) -> DataFrame:
    """xyz (or xy, by the size of shift) = rotation . xyz + shift."""
    names = "xyz"[: len(shift)]
    new = {n: sum((F.col(m) * float(rotation[i][j]) for j, m in enumerate(names)), F.lit(float(shift[i]))) for i, n in enumerate(names)}
    return points.withColumns(new)


def set_class(points: DataFrame, c: int) -> DataFrame:
    return points.withColumn("c", F.lit(c).cast("int"))


def extend(points: DataFrame, other: DataFrame, least_common: bool = False) -> DataFrame:
    """Union. other must have all columns, or, with least_common, columns missing on either side are dropped."""
    missing = [c for c in points.columns if c not in other.columns]
    if missing and not least_common:
        raise ValueError(f"other lacks {', '.join(missing)}")
    common = [c for c in points.columns if c in other.columns]
    return points.select(*common).unionByName(other.select(*common))


def empty_like(points: DataFrame) -> DataFrame:
    return points.limit(0)


def thin(points: DataFrame, keep: Column) -> DataFrame:
    return points.where(keep)


def line_displacements(vertices: DataFrame) -> DataFrame:
    """Unit-offset displacement of each line vertex (feat_id, seq, x, y): the left normal at ends, the mitre inside."""
    order = Window.partitionBy("feat_id").orderBy("seq")
    out = vertices
    for name, step in (("n2", 1), ("n1", -1)):
        ox, oy = (F.lead(c, 1).over(order) if step == 1 else F.lag(c, 1).over(order) for c in ("x", "y"))
        dx, dy = ((ox - F.col("x")) * step, (oy - F.col("y")) * step)
        size = F.sqrt(dx * dx + dy * dy)
        out = out.withColumn(name, F.when(size > 0, F.struct(F.try_divide(-dy, size).alias("x"), F.try_divide(dx, size).alias("y"))))
    dot = F.col("n1.x") * F.col("n2.x") + F.col("n1.y") * F.col("n2.y")
    inner = [F.try_divide(F.col(f"n1.{a}") + F.col(f"n2.{a}"), 1 + dot) for a in "xy"]
    return out.select("feat_id", "seq", "x", "y", *[F.coalesce(inner[k], F.col(f"n1.{a}"), F.col(f"n2.{a}")).alias(f"d{a}") for k, a in enumerate("xy")])


def helmert(pairs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Scale and two shifts (no rotation) that map (x, y) on (u, v) with least squares, for each group."""
    sums = pairs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"), F.avg("u").alias("mu"), F.avg("v").alias("mv"),
        F.sum(F.col("x") * F.col("u") + F.col("y") * F.col("v")).alias("cross"), F.sum(F.col("x") ** 2 + F.col("y") ** 2).alias("square"),
    )
    n = F.col("n")
    top = F.col("cross") - n * (F.col("mx") * F.col("mu") + F.col("my") * F.col("mv"))
    bottom = F.col("square") - n * (F.col("mx") ** 2 + F.col("my") ** 2)
    scaled = sums.withColumn("scale", F.when(bottom > 0, F.try_divide(top, bottom)))
    return scaled.select(*keys, "scale", (F.col("mu") - F.col("scale") * F.col("mx")).alias("dx"), (F.col("mv") - F.col("scale") * F.col("my")).alias("dy"), "n")


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
