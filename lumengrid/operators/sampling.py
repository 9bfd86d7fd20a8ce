"""Point sampling: by opacity, uniform, and even sub-samples. Randomness is hashed from seed and cell, so a lost task redraws the same points."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from . import grid

GROUP = ["volume_id", "tf_name"]


def opacity(rgba: DataFrame, n: int = 50_000, seed: int = 0, strict: bool = False) -> DataFrame:
    """n voxels per (volume_id, tf_name), drawn without replacement with weights max(a, 0) (all alike if these are 0
    throughout): the least -ln(u) / weight. Fewer voxels with weight than n: all of them, or with `strict` an error."""
    weighed = rgba.withColumn("w", F.greatest(F.col("a"), F.lit(0.0)))
    sums = weighed.groupBy(*GROUP).agg(F.sum("w").alias("sum_w"), F.count_if(F.col("w") > 0).alias("usable"), F.count("*").alias("all"))
    if strict and not sums.where((F.col("sum_w") > 1e-12) & (F.col("usable") < n) & (F.col("all") >= n)).isEmpty():
        raise ValueError("fewer voxels with weight than points")
    even = F.col("sum_w") <= 1e-12
    key = -F.log(C.uniform(seed, *[F.col(c) for c in ("volume_id", "z", "y", "x")])) / F.when(even, 1.0).otherwise(F.col("w"))
    drawn = weighed.join(sums, GROUP).where(even | (F.col("w") > 0)).withColumn("key", key)
    return top(drawn, GROUP, ["key", "z", "y", "x"], n, "point_id").drop("w", "sum_w", "usable", "all", "key")


def top(rows: DataFrame, by: list[str], order: list, n: int, rank: str) -> DataFrame:
    """The first n rows of each group with their place from 0. Tasks cut the groups to their first n rows before the shuffle (a window group
    limit of the plan), so that the last sort sees n rows of a group and task at most, however large the group is."""
    placed = rows.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return placed.where(F.col(rank) <= n).withColumn(rank, (F.col(rank) - 1).cast("int"))


def running(rows: DataFrame, col: str, to: str) -> DataFrame:
    """The running sum of col over each (volume_id, tf_name) in the order z, y, x: sums of planes, of rows of cells and of cells, so
    that no window is longer than a side of the grid."""
    planes = rows.groupBy(*GROUP, "z").agg(F.sum(col).alias("_s"))
    lines = rows.groupBy(*GROUP, "z", "y").agg(F.sum(col).alias("_s"))
    before = lambda by, order: F.sum("_s").over(Window.partitionBy(*by).orderBy(order)) - F.col("_s")
    planes = planes.select(*GROUP, "z", before(GROUP, "z").alias("_plane"))
    lines = lines.select(*GROUP, "z", "y", before([*GROUP, "z"], "y").alias("_line"))
    within = rows.withColumn("_cell", F.sum(col).over(Window.partitionBy(*GROUP, "z", "y").orderBy("x")))
    placed = within.join(lines, [*GROUP, "z", "y"]).join(planes, [*GROUP, "z"])
    return placed.withColumn(to, F.col("_plane") + F.col("_line") + F.col("_cell")).drop("_plane", "_line", "_cell")


def opacity_with_replacement(rgba: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n draws with replacement (more points than voxels): the voxel whose running weight first exceeds u * total. Draws and
    voxels meet by equal shares of the total, of which there are as many as draws."""
    weighed = rgba.withColumn("_w", F.greatest(F.col("a"), F.lit(0.0)))
    total = weighed.groupBy(*GROUP).agg(F.sum("_w").alias("total"))
    upto = running(weighed.where("_w > 0"), "_w", "to").withColumn("from", F.col("to") - F.col("_w")).join(total, GROUP)
    share = lambda x: F.floor(x / F.col("total") * n)
    # One share more on either side: sums in another order differ in their last bits.
    upto = upto.withColumn("_share", F.explode(F.sequence(share(F.col("from")) - 1, share(F.col("to")) + 1))).drop("total", "_w")
    draws = grid.numbered(total.select(*GROUP, "total"), n, "point_id").withColumn("point_id", F.col("point_id").cast("int")).withColumn("at", C.uniform(seed, F.col("volume_id"), F.col("point_id")) * F.col("total"))
    draws = draws.withColumn("_share", share(F.col("at"))).drop("total")
    return draws.join(upto, [*GROUP, "_share"]).where((F.col("at") >= F.col("from")) & (F.col("at") < F.col("to"))).drop("at", "from", "to", "_share")


def uniform(voxels: DataFrame, shape: tuple[int, int, int], n: int = 1000, seed: int = 0) -> DataFrame:
    """(volume_id, point_id, px, py, pz, v): n continuous places in the grid of each volume with the nearest voxel's value."""
    draws = grid.numbered(voxels.select("volume_id").distinct(), n, "point_id").withColumn("point_id", F.col("point_id").cast("int"))
    places = {f"p{c}": C.uniform(seed * 3 + i, F.col("volume_id"), F.col("point_id")) * float(m - 1) for i, (c, m) in enumerate(zip("zyx", shape, strict=True))}
    return grid.lookup(draws.withColumns(places), voxels, shape).select("volume_id", "point_id", "px", "py", "pz", "v")


def even_indices(length: int, limit: int) -> list[int]:
    """Places of an even sub-sample: the rounded (half to even) points of an even division of 0..length-1."""
    if limit <= 0 or length <= limit:
        return list(range(length))
    return [round(i * (length - 1) / (limit - 1)) if limit > 1 else 0 for i in range(limit)]


def even_subsample(rows: DataFrame, by: list[str], order: list[str], limit: int) -> DataFrame:
    """At most `limit` rows of each group, evenly spaced in its order."""
    w = Window.partitionBy(*by)
    placed = rows.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    k = F.sequence(F.lit(0), F.lit(limit - 1))
    wanted = F.transform(k, lambda i: F.bround(i * (F.col("_n") - 1) / F.lit(float(max(limit - 1, 1)))).cast("int"))
    return placed.where((F.col("_n") <= limit) | F.array_contains(wanted, F.col("_i"))).drop("_i", "_n")
