"""Voxel tables (volume_id, z, y, x, v) made from other tables, and the same as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def embedding_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each 64-number embedding as a volume of 4 x 4 x 4."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("volume_id"), F.posexplode("embedding").alias("i", "v"))
    i = F.col("i")
    return e.select("volume_id", F.shiftright(i, 4).alias("z"), (F.shiftright(i, 2) % 4).alias("y"), (i % 4).alias("x"), F.col("v").cast("double").alias("v"))


def lineitem_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items counted on a grid of tax, discount and quantity."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_tax", "l_discount", "l_quantity")
    c = lambda e: e.cast("int")
    cells = li.groupBy(c(F.bround(F.col("l_tax") * 100)).alias("z"), c(F.bround(F.col("l_discount") * 100)).alias("y"), c(F.col("l_quantity") - 1).alias("x"))
    return cells.agg(F.count("*").cast("double").alias("v")).select(F.lit(0).cast("long").alias("volume_id"), "z", "y", "x", "v")


def grid(spark: SparkSession, nz: int, ny: int, nx: int) -> DataFrame:
    """All cells of a grid, with their linear index (x fastest)."""
    i = F.col("id")
    return spark.range(nz * ny * nx).select(i, F.floor(i / (ny * nx)).cast("int").alias("z"), (F.floor(i / nx) % ny).cast("int").alias("y"), (i % nx).cast("int").alias("x"))


def gaussian_volume(spark: SparkSession, n: int, k: float) -> DataFrame:
    """exp(-k d^2) around the centre of a unit cube of n^3 voxels."""
    d = lambda c: F.pow(F.col(c) / float(n - 1) - 0.5, F.lit(2.0))
    return grid(spark, n, n, n).select(F.lit(0).cast("long").alias("volume_id"), "z", "y", "x", F.exp(F.lit(-k) * (d("x") + d("y") + d("z"))).alias("v"))


def ramp_volume(spark: SparkSession, n: int = 4) -> DataFrame:
    """0, 1, 2, ... along the linear index."""
    return grid(spark, n, n, n).select(F.lit(0).cast("long").alias("volume_id"), "z", "y", "x", F.col("id").cast("double").alias("v"))


SQL = {
    "emb": "emb as (select vec_id as volume_id, (i // 16)::int as z, ((i // 4) % 4)::int as y, (i % 4)::int as x, embedding[i + 1]::double as v from embeddings, range(0, 64) t(i))",
    "li": "li as (select 0::bigint as volume_id, round_even(l_tax * 100, 0)::int as z, round_even(l_discount * 100, 0)::int as y, (l_quantity - 1)::int as x, count(*)::double as v from lineitem group by all)",
    "ramp": "ramp as (select 0::bigint as volume_id, (i // 16)::int as z, ((i // 4) % 4)::int as y, (i % 4)::int as x, i::double as v from range(0, 64) t(i))",
}


def gaussian_sql(n: int, k: float) -> str:
    d = lambda c: f"power({c} / {n - 1}.0::double - 0.5, 2)"
    return f"gauss as (select 0::bigint as volume_id, z, y, x, exp(-{k}::double * ({d('x')} + {d('y')} + {d('z')})) as v from (select (i // {n * n})::int as z, ((i // {n}) % {n})::int as y, (i % {n})::int as x from range(0, {n**3}) t(i)))"
