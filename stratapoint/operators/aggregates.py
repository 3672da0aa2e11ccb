"""Statistics of points by tile, cell or feature. All combine before the shuffle unless a rank statistic is asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..model import CLASS_CODES, REPORTED


def inventory(points: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Size, distinct classes, strips and return numbers, and the 3-D extent."""
    distinct = [F.sort_array(F.collect_set(c)).alias(n) for c, n in (("c", "classes"), ("pid", "strips"), ("rn", "returns")) if c in points.columns]
    extent = [f(a).alias(f"{a}{n}") for a in "xyz" for f, n in ((F.min, "min"), (F.max, "max"))]
    return points.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_points"), *distinct, *extent)


def cell_counts(points: DataFrame, xmin: float, ymax: float, cell: float, keys: Sequence[str] = ()) -> DataFrame:
    """Points by raster cell; cells without points have no row."""
    return in_cells(points, xmin, ymax, cell).groupBy(*keys, "row", "col").agg(F.count(F.lit(1)).alias("n"))


def in_cells(points: DataFrame, xmin: float, ymax: float, cell: float, shape: tuple[int, int] | None = None, closed: bool = False) -> DataFrame:
    """Points with row and col. With a shape, those outside are dropped; closed: the outer edges belong to the last cells."""
    row, col = F.floor((F.lit(ymax) - F.col("y")) / cell).cast("int"), F.floor((F.col("x") - xmin) / cell).cast("int")
    out = points.withColumns({"row": row, "col": col})
    if shape is None:
        return out
    rows, cols = shape
    if closed:
        out = out.withColumns({
            "row": F.when(F.col("y") == ymax - rows * cell, F.lit(rows - 1)).otherwise(F.col("row")),
            "col": F.when(F.col("x") == xmin + cols * cell, F.lit(cols - 1)).otherwise(F.col("col")),
        })
    return out.where(F.col("row").between(0, rows - 1) & F.col("col").between(0, cols - 1))


def most_frequent(points: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """The most frequent value by group, the lowest of equally frequent ones."""
    counts = points.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("n", (-F.col(value)).alias("low"))).alias(value))


def aggregate_grid(points: DataFrame, xmin: float, ymax: float, cell: float, value: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Any aggregate by cell: a built-in one, or a pandas UDAF of the caller's."""
    return in_cells(points, xmin, ymax, cell).groupBy(*keys, "row", "col").agg(value.alias("value"))


def count_classes(points: DataFrame, keys: Sequence[str] = ("tile",)) -> DataFrame:
    """Points of each of the 17 classes and in all."""
    counts = [F.count_if(F.col("c") == code).alias(f"n_{name}_{code}") for name, code in CLASS_CODES.items()]
    return points.groupBy(*keys).agg(*counts, F.count(F.lit(1)).alias("n_points_total"))


def class_fractions(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fractions of the reported classes, of all others, and the number of points."""
    n = F.count(F.lit(1))
    names = {code: name for name, code in CLASS_CODES.items()}
    parts = [(F.count_if(F.col("c") == code) / n).alias(f"f_{names[code]}_{code}") for code in REPORTED]
    return points.groupBy(*keys).agg(*parts, (F.count_if(~F.col("c").isin(*REPORTED)) / n).alias("f_other"), n.alias("n_points_total"))


def dz_statistics(values: DataFrame, keys: Sequence[str], value: str = "dz", first: float = 2.5, later: float = 2.0, most: int = 5) -> DataFrame:
    """mean, sd (population), l1, rms, n of each group after trimming.

    Values not nearer to the mean than 2.5 sd go first, then up to four more times those not nearer than 2 sd; a group in
    which nothing goes is done. Each pass is one aggregation; the groups' bounds are joined back to the values.
    """
    stats = [F.avg("v").alias("mean"), F.stddev_pop("v").alias("sd"), F.avg(F.abs("v")).alias("l1"), F.sqrt(F.avg(F.col("v") * F.col("v"))).alias("rms"), F.count("v").alias("n")]
    kept = values.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("v"), F.lit(False).alias("done"))
    for turn in range(most):
        by = Window.partitionBy(*keys)
        limit = (first if turn == 0 else later) * F.stddev_pop("v").over(by)
        marked = kept.withColumn("ok", F.abs(F.col("v") - F.avg("v").over(by)) < limit)
        all_ok = F.bool_and("ok").over(by)
        kept = marked.withColumn("done", F.col("done") | all_ok).where(F.col("done") | F.col("ok")).select(*keys, "v", "done")
    return kept.groupBy(*keys).agg(*stats)


def z_statistics(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """n, least, greatest, mean, population deviation and 5th percentile (linear) of heights."""
    return points.groupBy(*keys).agg(
        F.count("z").alias("npoints"), F.min("z").alias("zmin"), F.max("z").alias("zmax"), F.avg("z").alias("zmean"), F.stddev_pop("z").alias("sd"), F.percentile("z", F.lit(0.05)).alias("f5")
    )


def lake_heights(points: DataFrame, keys: Sequence[str], part: str = "tile", least_points: int = 1, deviation: float = 0.2) -> DataFrame:
    """burn_z, n_used and is_valid by lake: the 12.5th percentile of each part, weighted by its points.

    A lake is invalid where a part's median lies more than deviation above its percentile, or a part with over a fifth of
    the other points, or over 1000, deviates from the weighted mean by more; a small deviating part is left out. The
    result does not depend on the order of the parts.
    """
    by_part = points.groupBy(*keys, part).agg(F.percentile("z", F.lit(0.125)).alias("p"), F.percentile("z", F.lit(0.5)).alias("m"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_points)
    lake = Window.partitionBy(*keys)
    total = F.sum("n").over(lake)
    off = by_part.withColumn("mean", F.sum(F.col("p") * F.col("n")).over(lake) / total).withColumn("others", total - F.col("n"))
    deviates = F.abs(F.col("p") - F.col("mean")) > deviation
    weighty = (F.col("n") > 0.2 * F.col("others")) | (F.col("n") > 1000)
    judged = off.withColumns({"left_out": deviates & ~weighty, "bad": (deviates & weighty) | (F.col("m") - F.col("p") > deviation)})
    used = F.when(~F.col("left_out"), F.col("n"))
    return judged.groupBy(*keys).agg(
        (F.sum(F.col("p") * used) / F.sum(used)).alias("burn_z"), F.coalesce(F.sum(used), F.lit(0)).cast("long").alias("n_used"), (~F.bool_or(F.col("bad") & ~F.col("left_out"))).alias("is_valid")
    )


def moving_bins(points: DataFrame, radius: float, keys: Sequence[str] = ("tile",), value: str = "z") -> DataFrame:
    """For each distinct value of a group: how many points have one nearer than radius (strictly), itself included."""
    counts = points.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("m"))

    def frame(low: str, high: str) -> Column:  # the DataFrame API takes whole numbers only
        return F.expr(f"sum(m) over (partition by {', '.join(keys)} order by {value} range between {low} and {high})")

    before, after = f"{radius!r}D preceding", f"{radius!r}D following"
    at_edges = [F.coalesce(frame(e, e), F.lit(0)) for e in (before, after)]
    return counts.select(*keys, value, (frame(before, after) - at_edges[0] - at_edges[1]).alias("n_near"))


def histogram(points: DataFrame, bins: int, keys: Sequence[str] = ("tile",), value: str = "z") -> DataFrame:
    """Counts in equal bins between a group's least and greatest value; the last bin is closed."""
    ends = points.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    at = F.floor(F.try_divide(F.col(value) - F.col("lo"), F.col("hi") - F.col("lo")) * bins)
    return points.join(ends, list(keys)).groupBy(*keys, F.coalesce(F.least(at, F.lit(bins - 1)), F.lit(0)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def acquisition_days(points: DataFrame, keys: Sequence[str] = ("tile",), time: str = "gps_time") -> DataFrame:
    """First and last time and the distinct days, from adjusted GPS seconds (leap seconds are not counted)."""
    seconds = F.col(time) + F.lit(1_000_000_000 + 315_964_800)
    stamp = F.timestamp_seconds(seconds)
    day = F.date_format(stamp, "yyyyMMdd")
    clock = lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss")
    days = points.groupBy(*keys, day.alias("day")).agg(F.min(stamp).alias("lo"), F.max(stamp).alias("hi"))
    return days.groupBy(*keys).agg(
        clock(F.min("lo")).alias("min_time"), clock(F.max("hi")).alias("max_time"), F.array_join(F.sort_array(F.collect_set("day")), ";").alias("unique_days"), F.count(F.lit(1)).alias("n_unique_days")
    )


def combined_precision(stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Root mean squares weighted by their numbers of points, over both directions."""
    n = F.col("n12") + F.col("n21")
    return stats.groupBy(*keys).agg((F.sum(F.col("rms12") * F.col("n12") + F.col("rms21") * F.col("n21")) / F.sum(n)).alias("combined_precision"))
