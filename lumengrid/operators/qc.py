"""Quality control of rendered frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FRAME = ["tf_name", "split", "frame"]


def gray(r: Column, g: Column, b: Column) -> Column:
    return (r + g + b) / 3.0


def frame_metrics(pixels: DataFrame, threshold: float = 0.02) -> DataFrame:
    """Per frame of pixels (tf_name, split, frame, row, col, gray): mean, share above the threshold, population deviation."""
    return pixels.groupBy(*FRAME).agg(F.avg("gray").alias("mean"), F.avg(F.when(F.col("gray") > threshold, 1.0).otherwise(0.0)).alias("nonzero"), F.stddev_pop("gray").alias("std"))


def tf_metrics(frames: DataFrame) -> DataFrame:
    """Plain means over each TF's frames."""
    return frames.groupBy("tf_name").agg(F.count("*").alias("images"), *[F.avg(c).alias(c) for c in ("mean", "nonzero", "std")])


def verdict(tfs: DataFrame, metrics: DataFrame, mean: float = 0.01, nonzero: float = 0.01, std: float = 0.005, segmentation: DataFrame | None = None) -> DataFrame:
    """Per TF of the list: status and reasons, in the order sparse, dark, flat, segmentation; without images that alone, and metrics of 0."""
    rows = tfs.select("tf_name").join(metrics, "tf_name", "left")
    failed = F.lit(False)
    if segmentation is not None:
        rows = rows.join(segmentation.select("tf_name", F.col("passed").alias("_seg")), "tf_name", "left")
        failed = F.coalesce(~F.col("_seg"), F.lit(False))
    tests = [(F.col("nonzero") < nonzero, "too_sparse"), (F.col("mean") < mean, "too_dark"), (F.col("std") < std, "low_contrast"), (failed, "segmentation_failed")]
    none = F.coalesce("images", F.lit(0)) == 0
    reasons = F.when(none, F.array(F.lit("no_images"))).otherwise(F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in tests])))
    out = rows.withColumn("reasons", reasons).withColumn("status", F.when(F.size("reasons") > 0, "fail").otherwise("pass"))
    return out.select("tf_name", "status", "reasons", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("images", "mean", "nonzero", "std")])


def totals(verdicts: DataFrame) -> DataFrame:
    names = lambda s: F.array_sort(F.collect_list(F.when(F.col("status") == s, F.col("tf_name"))))
    return verdicts.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "pass").alias("passed"), F.count_if(F.col("status") == "fail").alias("failed"), names("pass").alias("passed_names"), names("fail").alias("failed_names"))


def segmentation_frames(probs: DataFrame, threshold: float = 0.5, least_ratio: float = 0.001, least_confidence: float = 0.5) -> DataFrame:
    """Per frame of (tf_name, split, frame, row, col, p): share of foreground, mean p there (0 without any), detected."""
    fg = F.col("p") >= threshold
    out = probs.groupBy(*FRAME).agg(F.avg(F.when(fg, 1.0).otherwise(0.0)).alias("ratio"), F.coalesce(F.avg(F.when(fg, F.col("p"))), F.lit(0.0)).alias("confidence"))
    return detected(out, least_ratio, least_confidence)


def detected(frames: DataFrame, least_ratio: float = 0.001, least_confidence: float = 0.5) -> DataFrame:
    """Frames (ratio, confidence) with whether something was found in them; not in those without figures."""
    return frames.withColumn("detected", F.coalesce((F.col("ratio") >= least_ratio) & (F.col("confidence") >= least_confidence), F.lit(False)))


def segmentation_verdict(frames: DataFrame, min_frames: int = 1, min_ratio: float = 0.1) -> DataFrame:
    """Per TF: frames, frames detected and their share, means of the frames' foreground ratio and confidence, passed."""
    means = [F.avg(c).alias(f"mean_{n}") for c, n in (("ratio", "foreground_ratio"), ("confidence", "confidence"))]
    out = frames.groupBy("tf_name").agg(F.count("*").alias("total"), F.count_if("detected").alias("detected_frames"), *means)
    share = F.col("detected_frames") / F.col("total")
    return out.withColumn("ratio", share).withColumn("passed", (F.col("total") > 0) & (F.col("detected_frames") >= min_frames) & (share >= min_ratio))


def keep_passed(tasks: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Tasks whose TF passed; tasks without a TF stay if any passed; if none did, no task is left."""
    passed = verdicts.where("status = 'pass'").select("tf_name")
    with_tf = tasks.join(passed, "tf_name", "left_semi")
    any_passed = passed.limit(1).select(F.lit(1).alias("_any"))
    without = tasks.where("tf_name is null").join(F.broadcast(any_passed), F.lit(True), "left_semi")  # one row at most
    return with_tf.unionByName(without)
