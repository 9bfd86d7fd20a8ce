"""Structured Streaming over volumes: files that arrive are voxels that arrive. Results match the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import readers, slabs


def voxel_stream(spark: SparkSession, path: str, kind: str, glob: str | None = None, **options) -> DataFrame:
    """A stream of voxels from NIfTI or VTK image files that appear under path."""
    decode = slabs.decoder(kind, options)
    schema = spark.read.format("binaryFile").load(path).schema
    files = spark.readStream.schema(schema).format("binaryFile").option("recursiveFileLookup", "true")
    files = (files.option("pathGlobFilter", glob) if glob else files).load(path).select("path", "content")

    def run(frames):
        for f in frames:
            for name, body in zip(f["path"], f["content"], strict=True):
                yield from slabs.rows(name, decode(body).values)

    return files.mapInPandas(run, readers.VOXELS)


def running_ranges(voxels: DataFrame) -> DataFrame:
    """Value range and voxel count per volume, kept up to date (output mode update or complete)."""
    return voxels.groupBy("volume_id").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"))


def event_windows(events: DataFrame, minutes: int = 60, late: str = "2 hours") -> DataFrame:
    """Counts and sums of event values per window and type; rows later than the watermark are left out."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    w = F.window("ts", f"{minutes} minutes")
    return timed.groupBy(w, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def closed_windows(spark: SparkSession, source: str, target: str, minutes: int = 60, late: str = "2 hours") -> DataFrame:
    """The windows of new event files that the watermark has closed, appended to Parquet at target as they close; all that is there so far. Windows that are
    still open stay in the stream's state, which its checkpoint (below the target) keeps for the next run; events later than the watermark are left out."""
    events = spark.readStream.schema("ts timestamp_ntz, event_type string, value double").parquet(source)
    done = event_windows(events, minutes, late)
    done.writeStream.outputMode("append").option("checkpointLocation", f"{target}/checkpoint").trigger(availableNow=True).start(f"{target}/windows", format="parquet").awaitTermination()
    return spark.read.schema(done.schema).parquet(f"{target}/windows")


def per_batch(voxels: DataFrame, plan: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str):
    """Runs a batch plan on each micro-batch and appends its result to Parquet at sink; a batch that is run again replaces itself."""

    def write(df: DataFrame, batch_id: int) -> None:
        plan(df).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    return voxels.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
