"""Jobs: a kernel by name, its parameters, the tiles it is asked for, a result table and a log of tiles."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import reports

DEFAULTS = {"run_id": 1, "schema": None, "tiles": None, "table": None}
STATES = {"waiting": 0, "running": 1, "finished": 2, "failed": 3}


@dataclass(frozen=True)
class Kernel:
    """run(points, reference, **parameters) gives rows with the column km_name."""

    run: Callable[..., DataFrame]
    needs_reference: bool = False
    table: str | None = None
    parameters: dict = field(default_factory=dict)


KERNELS: dict[str, Kernel] = {}


def register(name: str, table: str | None = None, needs_reference: bool = False, **parameters) -> Callable:
    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        KERNELS[name] = Kernel(f, needs_reference, table, parameters)
        return f

    return add


def definition(file: str | None = None, **given) -> dict:
    """Defaults, then a JSON file, then what is given; unknown names and kernels are errors."""
    merged = dict(DEFAULTS)
    if file:
        with open(file) as f:
            merged |= json.load(f)
    merged |= {k: v for k, v in given.items() if v is not None}
    if merged.get("kernel") not in KERNELS:
        raise ValueError(f"no such kernel: {merged.get('kernel')}")
    kernel = KERNELS[merged["kernel"]]
    unknown = set(merged) - {*DEFAULTS, "kernel"} - set(kernel.parameters)
    if unknown:
        raise ValueError(f"unknown parameters: {', '.join(sorted(unknown))}")
    return merged


def run(spark: SparkSession, job: dict, points: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """Run a job over the tiles it names (all, if none) and append its result; the log has a row per tile.

    Spark schedules, repeats and balances the work; a job that fails leaves nothing of its run and marks its tiles failed.
    """
    kernel = KERNELS[job["kernel"]]
    if kernel.needs_reference and reference is None:
        raise ValueError(f"{job['kernel']} needs reference data")
    asked = points if job["tiles"] is None else points.where(F.col("tile").isin(*job["tiles"]))
    tiles = asked.select("tile").distinct()
    options = {k: job.get(k, v) for k, v in kernel.parameters.items()}
    table = job["table"] or kernel.table
    status, message = STATES["finished"], ""
    try:
        result = kernel.run(asked, reference, **options)
        if job["schema"] and table:
            reports.reset(spark, table, job["schema"], job["run_id"])
            reports.append(result, table, job["schema"], job["run_id"])
        else:
            result.write.format("noop").mode("overwrite").save()
    except Exception as error:
        status, message = STATES["failed"], f"{type(error).__name__}: {error}"[:500]
        if job["schema"] and table:
            reports.reset(spark, table, job["schema"], job["run_id"])
    return tiles.select(F.col("tile").alias("tile_name"), F.lit(job["kernel"]).alias("kernel"), F.lit(job["run_id"]).alias("run_id"), F.lit(status).alias("status"), F.lit(message).alias("msg"))


@register("count_classes", table="f_classes_in_tiles")
def _count_classes(points, reference):
    from ..operators.aggregates import count_classes

    out = count_classes(points)
    short = {"n_created_unused_0": "n_created_00", "n_terrain_in_buildings_19": "n_terr_in_build_19", "n_low_veg_in_buildings_20": "n_low_veg_in_buld_20"}
    return out.withColumnsRenamed({**short, "tile": "km_name"})


@register("poly_z_stats", table="f_poly_z_stats", needs_reference=True, c=6)
def _poly_z_stats(points, reference, c):
    from ..operators.aggregates import z_statistics
    from ..operators.geometry import points_in_polygons

    inside = points_in_polygons(points.where(F.col("c") == c), reference)
    return z_statistics(inside, ["tile", "feat_id"]).withColumn("class", F.lit(c)).withColumnRenamed("tile", "km_name")


@register("spike_check", table="f_spikes", radius=1.5, slope=25.0, z_limit=0.1, c=2)
def _spike_check(points, reference, radius, slope, z_limit, c):
    import math

    from ..operators.focal import spike_filter

    key = ["tile", "x", "y", "z", "c", "pid"]
    ground = points.where(F.col("c") == c).select(*key)
    got = spike_filter(ground, ground.select("x", "y", "z"), radius, math.tan(math.radians(slope)) ** 2, z_limit, key)
    return got.where("value <> 0").withColumnsRenamed({"value": "mean_dz", "tile": "km_name"}).withColumn("filter_rad", F.lit(radius))


@register("time_stats", table="f_time_stats")
def _time_stats(points, reference):
    from ..operators.aggregates import acquisition_days

    return acquisition_days(points).withColumnRenamed("tile", "km_name")
