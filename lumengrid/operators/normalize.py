"""Value ranges of volumes and rescaling to [0, 1]; per volume a partial aggregate and an equi-join, so no large volume meets in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import selection

KEY = "volume_id"


def value_range(voxels: DataFrame) -> DataFrame:
    return voxels.groupBy(KEY).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))


def minmax(voxels: DataFrame, constant: str = "keep") -> DataFrame:
    """(v - min) / (max - min) per volume; a constant volume keeps its values ("keep") or becomes 0 ("zero")."""
    if constant not in ("keep", "zero"):
        raise ValueError(f"constant: {constant}")
    flat = F.col("v") if constant == "keep" else F.lit(0.0)
    scaled = F.when(F.col("hi") > F.col("lo"), (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(flat)
    return voxels.join(value_range(voxels), KEY).withColumn("v", scaled).drop("lo", "hi")


def percentile(voxels: DataFrame, low: float = 1.0, high: float = 99.0) -> DataFrame:
    """Rescale between two percentiles (linear interpolation), cut to [0, 1]; where they are equal, 0."""
    at = selection.quantiles(voxels, [low / 100, high / 100], [KEY]).select(KEY, F.col("q0").alias("lo"), F.col("q1").alias("hi"))
    cut = F.least(F.greatest((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")), F.lit(0.0)), F.lit(1.0))
    return voxels.join(at, KEY).withColumn("v", F.when(F.col("hi") > F.col("lo"), cut).otherwise(0.0)).drop("lo", "hi")


def normalize(voxels: DataFrame, method: str = "minmax", **params) -> DataFrame:
    if method == "minmax":
        return minmax(voxels, **params)
    if method == "percentile":
        return percentile(voxels, **params)
    raise ValueError(f"unknown normalisation: {method}")


def scalar_range(voxels: DataFrame, override: str | None = None) -> tuple[float, float]:
    """The range a renderer maps: an override "lo,hi", else the finite range of the values; (0, 255) if that is empty."""
    if override:
        lo, hi = (float(x) for x in override.split(","))
    else:
        row = voxels.where(~F.isnan("v")).agg(F.min("v"), F.max("v")).first()
        lo, hi = (float("nan") if x is None else float(x) for x in row)
    ok = all(abs(x) < float("inf") for x in (lo, hi)) and lo != hi  # NaN compares false
    return (lo, hi) if ok else (0.0, 255.0)


def mad_threshold(values: DataFrame, col: str = "v", lam: float = 1.0, eps: float = 1e-12) -> DataFrame:
    """lam * sigma with sigma = (lower) median of absolute deviations / 0.6745, per volume."""
    v = values.select(KEY, F.col(col).cast("double").alias("v"))
    mid = selection.quantiles(v, [0.5], [KEY], between=False)
    off = v.join(mid, KEY).select(KEY, F.abs(F.col("v") - F.col("q0")).alias("v"))
    mad = selection.quantiles(off, [0.5], [KEY], between=False)
    return mad.select(KEY, (F.lit(lam) * F.greatest(F.col("q0") / 0.6745, F.lit(eps))).alias("threshold"))


def inspect(voxels: DataFrame) -> DataFrame:
    """Shape and value range per volume."""
    size = lambda c: (F.max(c) + 1).cast("int").alias(f"n{c}")
    return voxels.groupBy(KEY).agg(size("z"), size("y"), size("x"), F.count("*").alias("n_voxels"), F.min("v").alias("v_min"), F.max("v").alias("v_max"))
