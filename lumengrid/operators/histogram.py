"""Histograms, equalised band edges and statistics of value bands."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = "volume_id"


def histogram(voxels: DataFrame, lo: float, hi: float, bins: int = 2048) -> DataFrame:
    """(volume_id, bin, n): equal bins on [lo, hi], the last one closed; values outside are dropped, empty bins absent."""
    at = F.least(F.floor((F.col("v") - lo) * (bins / (hi - lo))), F.lit(bins - 1)).cast("int")
    return voxels.where((F.col("v") >= lo) & (F.col("v") <= hi)).groupBy(KEY, at.alias("bin")).agg(F.count("*").alias("n"))


def equalised_edges(hist: DataFrame, lo: float, hi: float, bands: int, bins: int = 2048) -> DataFrame:
    """(volume_id, edge, x) for edges 0..bands: the left edge of the first bin whose running sum exceeds each quantile."""
    run = Window.partitionBy(KEY).orderBy("bin")
    cdf = hist.withColumn("cdf", F.sum("n").over(run)).withColumn("total", F.sum("n").over(Window.partitionBy(KEY)))  # at most `bins` rows a volume
    q = F.explode(F.sequence(F.lit(1), F.lit(bands - 1))).alias("edge")
    over = cdf.select("*", q).where(F.col("cdf") > F.col("total") * F.col("edge") / float(bands)).groupBy(KEY, "edge").agg(F.min("bin").alias("bin"))
    inner = over.select(KEY, "edge", (F.lit(lo) + F.col("bin") * ((hi - lo) / bins)).alias("x"))
    ends = hist.select(KEY).distinct().select(KEY, F.explode(F.array(F.struct(F.lit(0).alias("edge"), F.lit(lo).alias("x")), F.struct(F.lit(bands).alias("edge"), F.lit(hi).alias("x")))).alias("e")).select(KEY, "e.edge", "e.x")
    return inner.union(ends)


def linear_edges(lo: float, hi: float, bands: int) -> list[float]:
    width = (hi - lo if hi > lo else 1.0) / bands
    return [lo + i * width for i in range(bands)] + [hi]


def band_statistics(voxels: DataFrame, edges: list[float], least: float = 1e-4, most: float = 1.0) -> DataFrame:
    """Per volume and band (1..): n, share of the voxels, status, centre and radius of the bounding box (unit spacing)."""
    bands = len(edges) - 1
    band = None
    for i in range(bands):
        inside = (F.col("v") >= edges[i]) & ((F.col("v") <= edges[i + 1]) if i == bands - 1 else (F.col("v") < edges[i + 1]))
        band = (F.when if band is None else band.when)(inside, F.lit(i + 1))
    span = [a for c in "xyz" for a in (F.min(c).alias(f"{c}0"), F.max(c).alias(f"{c}1"))]
    got = voxels.select(KEY, band.alias("band"), "z", "y", "x").groupBy(KEY, "band").agg(F.count("*").alias("n"), *span)
    totals = voxels.groupBy(KEY).agg(F.count("*").alias("total")).withColumn("band", F.explode(F.sequence(F.lit(1), F.lit(bands))))
    share = F.coalesce("n", F.lit(0)) / F.col("total")
    status = F.when(share < least, "SKIP (Sparse)").when(share > most, "SKIP (Dense)").otherwise("KEEP")
    radius = 0.5 * F.sqrt(sum((F.pow((F.col(f"{c}1") - F.col(f"{c}0")).cast("double"), F.lit(2.0)) for c in "xyz"), F.lit(0.0)))
    keep = status == "KEEP"
    return totals.join(got, [KEY, "band"], "left").select(
        KEY, "band", F.coalesce("n", F.lit(0)).alias("n"), share.alias("share"), status.alias("status"),
        *[F.when(keep, (F.col(f"{c}0") + F.col(f"{c}1")) / 2.0).alias(f"c{c}") for c in "xyz"], F.when(keep, radius).alias("radius"),
    )
