"""Result tables: their schemas, and appending, resetting and dropping them by run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fields of the result tables. s: string, i: integer, r: real. run_id and the time follow in all but the last four.
_PAIR = "id1:i id2:i mean12:r mean21:r sigma12:r sigma21:r rms12:r rms21:r npoints12:i npoints21:i combined_precision:r"
_CLASSES = "created_00 surface_1 terrain_2 low_veg_3 med_veg_4 high_veg_5 building_6 outliers_7 mod_key_8 water_9 ignored_10"
TABLES = {
    "f_z_precision_roads": f"km_name:s {_PAIR}",
    "f_z_precision_buildings": f"km_name:s {_PAIR}",
    "f_z_accuracy": "km_name:s id:i f_type:s mean:r sigma:r npoints:i",
    "f_z_accuracy_gcp": "km_name:s z:r dz:r t_angle:r t_size:r",
    "f_z_3dline_outliers": "km_name:s line_id:s z_line:r dz:r tolerance:r",
    "f_point_density": "km_name:s min_point_density:r mean_point_density:r cell_size:r",
    "f_classification": "km_name:s " + " ".join(f"f_{c}:r" for c in [*_CLASSES.split(), "bridge_17", "man_excl_32", "other"]) + " n_points_total:i ptype:s",
    "f_classes_in_tiles": "km_name:s " + " ".join(f"n_{c}:i" for c in [*_CLASSES.split(), "power_line_14", "bridge_17", "high_noise_18", "terr_in_build_19", "low_veg_in_buld_20", "man_excl_32", "points_total"]),
    "f_roof_ridge_alignment": "km_name:s rotation:r dist1:r dist2:r",
    "f_roof_ridge_strips": "km_name:s id1:s id2:s stripids:s pair_dist:r pair_rot:r z:r",
    "f_xy_accuracy_buildings": "km_name:s scale:r dx:r dy:r n_points:i",
    "f_xy_precision_buildings": "km_name:s id1:s id2:s dx:r dy:r dist:r h_scale:r h_dx:r h_dy:r h_sdx:r h_sdy:r n_points:i",
    "f_auto_building": "km_name:s",
    "f_clouds": "km_name:s",
    "f_delta_roads": "km_name:s z_step_max:r z_step_min:r",
    "f_spikes": "km_name:s filter_rad:r mean_dz:r x:r y:r z:r c:i pid:i",
    "f_steep_triangles": "km_name:s class:i slope:r xybox:r zbox:r",
    "f_fill_holes": "km_name:s z1:r z2:r dz:r sd:r n_old:i area:r dump_name:s accepted:i comment:s",
    "f_hole_points": "km_name:s z1:r z2:r dz:r n_old:i",
    "f_wobbly_water": "km_name:s class:i frad:r npoints:i min_diff:r max_diff:r",
    "f_poly_z_stats": "km_name:s class:i npoints:i zmin:r zmax:r zmean:r sd:r f5:r",
    "f_time_stats": "km_name:s min_time:s max_time:s unique_days:s n_unique_days:i",
    "f_comment_points": "comment:s action:s",
    "f_comment_polygons": "comment:s action:s",
    "f_contours": "kote:r km_name:s",
}
_TYPES = {"s": T.StringType(), "i": T.IntegerType(), "r": T.DoubleType()}
_BARE = ("f_comment_points", "f_comment_polygons", "f_contours")


def schema(table: str) -> T.StructType:
    """Fields, the geometry as WKT, and run_id and t_stamp where the table has them."""
    fields = [T.StructField(n, _TYPES[k]) for n, k in (f.split(":") for f in TABLES[table].split())]
    fields.append(T.StructField("wkt", T.StringType()))
    return T.StructType(fields if table in _BARE else [*fields, T.StructField("run_id", T.IntegerType()), T.StructField("t_stamp", T.TimestampType())])


def conform(df: DataFrame, table: str, run_id: int | None = None) -> DataFrame:
    """df cast to the table's schema; missing columns are null, others are dropped."""
    given = {"run_id": F.lit(run_id), "t_stamp": F.current_timestamp()}
    cols = [(given[f.name] if f.name in given else F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(table)]
    return df.select(*cols)


def append(df: DataFrame, table: str, base: str, run_id: int) -> str:
    """Append a run's rows; a failure leaves no part of them. Running it again after reset() is safe."""
    path = f"{base.rstrip('/')}/{table}"
    writer = conform(df, table, run_id).write.mode("append")
    (writer if table in _BARE else writer.partitionBy("run_id")).parquet(path)
    return path


def read(spark: SparkSession, table: str, base: str) -> DataFrame:
    return spark.read.schema(schema(table)).parquet(f"{base.rstrip('/')}/{table}")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, table: str, base: str) -> bool:
    system, target = _fs(spark, f"{base.rstrip('/')}/{table}")
    return system.exists(target)


def create(spark: SparkSession, base: str, tables: list[str] | None = None) -> None:
    """Empty tables where there are none."""
    for table in tables or TABLES:
        if not exists(spark, table, base):
            spark.createDataFrame([], schema(table)).write.parquet(f"{base.rstrip('/')}/{table}")


def reset(spark: SparkSession, table: str, base: str, run_id: int) -> bool:
    """Remove one run's rows."""
    system, target = _fs(spark, f"{base.rstrip('/')}/{table}/run_id={run_id}")
    return system.delete(target, True)


def drop(spark: SparkSession, table: str, base: str) -> bool:
    system, target = _fs(spark, f"{base.rstrip('/')}/{table}")
    return system.delete(target, True)


def create_views(spark: SparkSession) -> list[str]:
    """The result views, over temp views of the tables' names (with an area column in f_classification) and tiles."""
    classes = ", ".join(f"round(100 * n_{c} div n_points_total) AS pct_{c}" for c in [*_CLASSES.split(), "bridge_17", "man_excl_32"])
    by_tile = "SELECT t.tile_name AS tilename, avg(abs(z.mean12)) AS abs_avg12, avg(abs(z.mean21)) AS abs_avg21, avg(z.sigma12) AS sigma12, avg(z.sigma21) AS sigma21 FROM {0} z JOIN tiles t ON t.tile_name = z.km_name GROUP BY t.tile_name"
    views = {
        "v_classi_buildpoints": "SELECT km_name, f_building_6, wkt FROM f_classification WHERE ptype = 'building' AND f_building_6 < 0.4 AND f_high_veg_5 < 0.5 AND area > 25 AND n_points_total / area > 2.5",
        "v_classi_terrain_in_buildings": "SELECT km_name, f_terrain_2, n_points_total, area, wkt FROM f_classification WHERE ptype = 'building' AND area > 800 AND n_points_total > 2000 AND f_terrain_2 > 0.3",
        "v_classi_bridgepoints": "SELECT km_name, f_bridge_17, wkt FROM f_classification WHERE ptype = 'bridge' AND f_bridge_17 < 0.01",
        "v_classi_plants_under_building": "SELECT km_name, f_terrain_2, f_low_veg_3, f_med_veg_4, f_high_veg_5, f_building_6, wkt FROM f_classification WHERE ptype = 'below_poly' AND n_points_total > 0 AND (f_low_veg_3 > 0.10 OR f_med_veg_4 > 0.10 OR f_high_veg_5 > 0.03)",
        "v_classi_lakepoints": "SELECT km_name, f_water_9, wkt FROM f_classification WHERE ptype = 'lake' AND f_water_9 < 0.015",
        "v_relevant_holes": "SELECT * FROM f_fill_holes WHERE n_old > 10 AND abs(dz) < 0.20 AND (abs(sd) < abs(dz) OR abs(sd) < 0.05) AND sd < 0.1 ORDER BY n_old",
        "v_classes_distribution": f"SELECT km_name, {classes}, n_points_total, wkt FROM f_classes_in_tiles WHERE n_points_total > 0",
        "v_tile_z_precision_roads": by_tile.format("f_z_precision_roads"),
        "v_tile_z_precision_buildings": by_tile.format("f_z_precision_buildings"),
    }
    made = []
    names = {t.name for t in spark.catalog.listTables()}
    for name, text in views.items():
        source = text.split(" FROM ")[1].split()[0]
        if source in names:
            spark.sql(text).createOrReplaceTempView(name)
            made.append(name)
    return made
