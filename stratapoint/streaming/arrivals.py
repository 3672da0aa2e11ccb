"""Tiles and events that arrive as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.regions import work_dir

EVENTS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def arrivals(spark: SparkSession, path: str, schema: T.StructType = EVENTS, files_at_once: int = 64) -> DataFrame:
    """A stream of the Parquet files of a folder; `path` may also match files in it."""
    folder, _, name = path.rstrip("/").rpartition("/")
    single = name.endswith(".parquet") and "*" not in name
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once)
    return reader.option("pathGlobFilter", name).parquet(folder) if single else reader.parquet(path)


def daily(stream: DataFrame, late: str | None = "1 day") -> DataFrame:
    """Count and sum by day and type. With `late`, state older than that is dropped and days are final when it passes."""
    held = stream.withWatermark("ts", late) if late else stream
    by = held.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return by.select(F.col("window.start").alias("day"), "event_type", "n", "total")


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "complete") -> None:
    """Process all that has arrived and end. Every batch overwrites (complete) or adds (append) its own folder, so a batch
    that is repeated after a failure changes nothing."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(path if mode == "complete" else f"{path}/batch={number}")

    stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of a table as a stream, to the end."""
    import uuid

    base = f"{work_dir(spark)}/arrivals-{uuid.uuid4().hex}"
    run_to_table(daily(arrivals(spark, f"{sf_dir}/events.parquet"), late=None), f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select("day", "event_type", "n", F.round("total", 4).alias("total"))
