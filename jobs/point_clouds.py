"""Checked point clouds of many volumes: the batch job of a splat data set.

Every volume of a table is normalised, coloured by each transfer function, looked at along the axes, checked, and sampled by
opacity, in one plan for all volumes and functions: a volume that fails its check leaves the others alone, and no number of jobs grows
with the volumes.

    python -m jobs.point_clouds --input TABLE --output FOLDER [--config FILE] [--batches batch_0001 ...]

Reads a table with a whole-number id and a flat array of voxels (z, y, x order; sides from the config or the cube root). Writes

    OUTPUT/clouds/tf_name=.../batch_id=...   volume_id, status, reasons and metrics of each volume, and of those that
                                             passed the drawn voxels: point_id, wx, wy, wz, r, g, b, a (null where it failed)

as Parquet. A run for all batches replaces the output. A run for some batches overwrites their partitions alone; as each volume has a row
whether it passed or not, no partition keeps rows of an earlier run. Repeated runs, also after one that broke off, give the same
rows. Batches are dealt by hashed ids over all volumes of the table. Volumes that are null, of another length or hold a value that is
null or not finite are left out (the log tells how many rows and volumes there were); of volumes with the same id one is taken, the one
whose values sort first. Without any volume the output has no rows.
"""

from __future__ import annotations

import argparse
import json
import logging
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumengrid.operators import batch, geometry, normalize, qc, render, sampling, transfer

log = logging.getLogger("jobs.point_clouds")
DEFAULT = Path(__file__).with_suffix(".json")
CASE = ["volume_id", "tf_name"]
CLOUDS = "volume_id long, status string, reasons string, images long, mean double, nonzero double, std double, point_id int, wx double, wy double, wz double, r double, g double, b double, a double, tf_name string, batch_id string"


def read(spark: SparkSession, path: str, id_col: str, vec_col: str, shape: tuple[int, int, int] | None) -> tuple[DataFrame, dict]:
    """(volume_id, i, v): the voxels of the usable volumes of a table; and how many rows there were, and how many were used."""
    v = F.col("values")
    rows = spark.read.parquet(path).select(F.col(id_col).cast("long").alias("volume_id"), F.col(vec_col).cast("array<double>").alias("values"))
    side = F.round(F.cbrt(F.size(v))).cast("int")
    good = v.isNotNull() & F.col("volume_id").isNotNull() & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # NaN counts as larger
    fits = (F.size(v) == shape[0] * shape[1] * shape[2]) if shape else (F.size(v) > 0) & (side * side * side == F.size(v))
    usable = rows.where(good & fits)
    if shape is None:
        sides = [r[0] for r in usable.select(side).distinct().limit(2).collect()]
        if len(sides) > 1:
            raise ValueError("volumes of several sizes: give `shape` in the config")
        shape = (sides[0] if sides else 1,) * 3
    one = usable.groupBy("volume_id").agg(F.min("values").alias("values"))
    return one, {"shape": shape, "rows": rows.count(), "volumes": one.count()}


def voxels(volumes: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    cells = volumes.select("volume_id", F.posexplode("values").alias("i", "v"))
    return cells.select("volume_id", *geometry.from_linear(F.col("i"), shape[1], shape[2]), "v")


def checked(rgba: DataFrame, axes: list[str], limits: dict) -> DataFrame:
    """(volume_id, tf_name, status, reasons, images, mean, nonzero, std): verdicts on the views of each volume along the axes."""
    views = None
    for axis in axes:
        one = render.composite(rgba, axis).withColumn("frame", F.lit(axis))
        views = one if views is None else views.unionByName(one)
    px = views.select(F.struct(*CASE).alias("tf_name"), F.lit("train").alias("split"), "frame", qc.gray(F.col("r"), F.col("g"), F.col("b")).alias("gray"))
    metrics = qc.tf_metrics(qc.frame_metrics(px, limits["pixel_threshold"]))
    done = qc.verdict(metrics.select("tf_name"), metrics, limits["min_mean_intensity"], limits["min_nonzero_ratio"], limits["min_intensity_std"])
    return done.select("tf_name.volume_id", "tf_name.tf_name", "status", F.array_join("reasons", ",").alias("reasons"), "images", "mean", "nonzero", "std")


def run(spark: SparkSession, source: str, target: str, config: dict, id_col: str = "vec_id", vec_col: str = "embedding", batches: list[str] | None = None) -> dict:
    """The whole job; what it read and wrote."""
    tfs = [transfer.TransferFunction(n, tuple(map(tuple, p))) for n, p in config["transfer_functions"].items()]
    volumes, seen = read(spark, source, id_col, vec_col, tuple(config["shape"]) if config.get("shape") else None)
    log.info("read %s: %d rows, %d volumes of %s", source, seen["rows"], seen["volumes"], seen["shape"])
    dealt = batch.assign(volumes.select(F.col("volume_id").alias("case_id")), config["batch_size"], True, config["seed"]).select(F.col("case_id").alias("volume_id"), "batch_id")
    if batches:
        dealt = dealt.where(F.col("batch_id").isin(batches))
        volumes = volumes.join(dealt, "volume_id", "left_semi")
    scaled = normalize.normalize(voxels(volumes, seen["shape"]), config["normalize"], **({"constant": "zero"} if config["normalize"] == "minmax" else {}))
    rgba = transfer.bake(scaled, tfs)
    place = geometry.Geometry(tuple(config["spacing"]))
    to = geometry.render_transform(geometry.bounds(scaled, place), config["target_bbox_size"])

    verdicts = checked(rgba, config["axes"], config["qc"])
    passed = verdicts.where("status = 'pass'").select(*CASE)
    drawn = sampling.opacity(rgba.join(passed, CASE, "left_semi"), config["n_points"], config["seed"])
    world = geometry.apply_transform(geometry.index_to_world(drawn, place), to)
    clouds = verdicts.join(dealt, "volume_id").join(world.select(*CASE, "point_id", "wx", "wy", "wz", *"rgba"), CASE, "left")
    columns = [c.split()[0] for c in CLOUDS.split(", ")]
    # One task writes a partition, however many tasks made its rows; large ones are split by AQE.
    out = clouds.select(*columns).hint("rebalance", "tf_name", "batch_id").write.mode("overwrite")
    out.option("partitionOverwriteMode", "dynamic" if batches else "static").partitionBy("tf_name", "batch_id").parquet(f"{target}/clouds")
    count = lambda c: F.coalesce(F.count_if(c), F.lit(0))
    first = F.coalesce("point_id", F.lit(0)) == 0
    totals = output(spark, target).agg(count(first).alias("verdicts"), count(first & (F.col("status") == "pass")).alias("passed"), count(F.col("point_id").isNotNull()).alias("points")).first().asDict()
    log.info("wrote %s: %s", target, totals)
    return seen | totals


def output(spark: SparkSession, target: str) -> DataFrame:
    """All that the job has written."""
    return spark.read.schema(CLOUDS).parquet(f"{target}/clouds")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="jobs.point_clouds")
    for name in ("--input", "--output"):
        p.add_argument(name, required=True)
    p.add_argument("--config", default=str(DEFAULT))
    p.add_argument("--id", default="vec_id")
    p.add_argument("--values", default="embedding")
    p.add_argument("--batches", nargs="*")
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("point clouds").getOrCreate()
    try:
        done = run(spark, a.input, a.output, json.loads(Path(a.config).read_text()), a.id, a.values, a.batches)
    finally:
        spark.stop()
    print(json.dumps(done))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
