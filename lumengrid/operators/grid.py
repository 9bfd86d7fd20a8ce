"""Dense-grid operators on voxel rows: resampling, padding, tiling, lookups. All joins are equi-joins on cells."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import normalize as N
from .geometry import from_linear

CELL = ["volume_id", "z", "y", "x"]


def target_shape(shape: tuple[int, int, int], spacing: tuple[float, ...], target: tuple[float, ...]) -> tuple[int, ...]:
    """New size per axis: size * spacing / target, half to even, at least 1 (all in z, y, x)."""
    return tuple(max(1, round(n * s / t)) for n, s, t in zip(shape, spacing, target, strict=True))


def target_shapes(volumes: DataFrame, target: tuple[float, float, float]) -> DataFrame:
    """The same for a table (nz, ny, nx, sz, sy, sx): tz, ty, tx."""
    return volumes.withColumns({f"t{c}": F.greatest(F.lit(1), F.bround(F.col(f"n{c}") * F.col(f"s{c}") / t).cast("int")) for c, t in zip("zyx", target, strict=True)})


def _taps(n: int, m: int, corners: bool) -> list[tuple[int, int, float]]:
    """(from, to, weight) of linear resampling of n cells to m."""
    out = []
    for o in range(m):
        src = (o * (n - 1) / (m - 1) if m > 1 else 0.0) if corners else max(0.0, (o + 0.5) * n / m - 0.5)
        lo = min(int(math.floor(src)), n - 1)
        w = src - lo
        out.append((lo, o, 1 - w))
        if w > 0:
            out.append((min(lo + 1, n - 1), o, w))
    return out


def _axis_map(df: DataFrame, axis: str, taps: list[tuple[int, int, float]]) -> DataFrame:
    """Each voxel to the cells it weighs in along one axis, then a sum; taps are a table of the axis's length only."""
    spark = df.sparkSession
    table = spark.createDataFrame(taps, "src int, dst int, w double")
    moved = df.join(F.broadcast(table), F.col(axis) == F.col("src"))  # as many rows as the axis has cells, times two
    other = [c for c in CELL if c != axis]
    return moved.groupBy(*other, "dst").agg(F.sum(F.col("v") * F.col("w")).alias("v")).withColumnRenamed("dst", axis).select(*CELL, "v")


def trilinear(voxels: DataFrame, shape: tuple[int, ...], to: tuple[int, ...], align_corners: bool = True) -> DataFrame:
    """Linear resampling, one axis after the other: three sums of two taps, instead of one of eight."""
    out = voxels.select(*CELL, F.col("v").cast("double").alias("v"))
    for axis, n, m in zip("zyx", shape, to, strict=True):
        if n != m:
            out = _axis_map(out, axis, _taps(n, m, align_corners))
    return out


def nearest(voxels: DataFrame, shape: tuple[int, ...], to: tuple[int, ...], ends: bool = False) -> DataFrame:
    """Nearest cell: floor(o * n / m), or with `ends` the rounded place on a grid whose end points are kept."""
    out = voxels
    for axis, n, m in zip("zyx", shape, to, strict=True):
        if n != m:
            pick = [(min(n - 1, round(o * (n - 1) / (m - 1)) if ends and m > 1 else 0 if ends else o * n // m), o) for o in range(m)]
            table = voxels.sparkSession.createDataFrame(pick, "src int, dst int")  # as many rows as the axis has cells
            out = out.join(F.broadcast(table), F.col(axis) == F.col("src")).drop(axis, "src").withColumnRenamed("dst", axis)
    return out.select(*CELL, "v")


def resample(voxels: DataFrame, shape, to, mode: str = "trilinear", backend: str = "auto", align_corners: bool = True) -> DataFrame:
    """mode nearest or (any other name) linear; backend "zoom" keeps the end points for both, "auto" and "interpolate" don't for nearest."""
    if backend not in ("auto", "interpolate", "zoom"):
        raise ValueError(f"unknown resampling backend: {backend}")
    if mode == "nearest":
        return nearest(voxels, shape, to, ends=backend == "zoom")
    return trilinear(voxels, shape, to, True if backend == "zoom" else align_corners)


#: Rows or cells that one input row becomes in a task.
RUN = 1 << 16


def numbered(rows: DataFrame, n, name: str, run: int = RUN) -> DataFrame:
    """Every row once for each number 0..n-1 (n: a number or a column of long), as column `name` (long). Runs of numbers are dealt over the tasks first, so
    that no row becomes more than `run` rows where it stands."""
    n = F.lit(n).cast("long") if isinstance(n, int) else n
    runs = rows.where(n > 0).withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / run))))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = runs.repartition(parts, F.xxhash64("_run", *[c for c, t in rows.dtypes if not t.startswith("map")]))  # by number, so that small partitions aren't put together
    return dealt.withColumn(name, F.explode(F.sequence(F.col("_run") * run, F.least((F.col("_run") + 1) * run, n) - 1))).drop("_run")


def dense(voxels: DataFrame, shape: tuple[int, int, int], fill: float = 0.0, fills: DataFrame | None = None) -> DataFrame:
    """The voxels, and a voxel of `fill` (of each volume its own: fills of volume_id, fill) for every cell of the grid without one.

    Cells are numbered and dealt in runs. A run gathers the numbers of the voxels in it, RUN at most, and makes the others; voxels go
    through as they are, so nothing is joined by cell."""
    nz, ny, nx = shape
    ids = voxels.select("volume_id").distinct().withColumn("fill", F.lit(float(fill))) if fills is None else fills.select("volume_id", "fill")
    total = nz * ny * nx
    i = (F.col("z").cast("long") * ny + F.col("y")) * nx + F.col("x")
    runs = ids.select("volume_id", "fill", F.explode(F.sequence(F.lit(0).cast("long"), F.lit((total - 1) // RUN).cast("long"))).alias("run"), F.lit(None).cast("long").alias("i"))
    there = voxels.select("volume_id", F.lit(None).cast("double").alias("fill"), F.floor(i / RUN).alias("run"), i.alias("i"))
    each = runs.unionByName(there).groupBy("volume_id", "run").agg(F.max("fill").alias("fill"), F.collect_set("i").alias("has"))
    every = F.sequence(F.col("run") * RUN, F.least((F.col("run") + 1) * RUN, F.lit(total)) - 1)
    cell = F.col("i")
    lack = each.select("volume_id", "fill", F.explode(F.array_except(every, "has")).alias("i")).select("volume_id", *from_linear(cell, ny, nx), F.col("fill").alias("v"))
    return voxels.select(*CELL, F.col("v").cast("double").alias("v")).unionByName(lack)


def shell(ids: DataFrame, inner: tuple[int, int, int], offset: tuple[int, int, int], n: int) -> DataFrame:
    """The cells of a cube of side n around a box (at `offset`) for each row of ids: six slabs, numbered and dealt in runs; with ids' columns."""
    (oz, oy, ox), (mz, my, mx) = offset, inner
    ends = (oz + mz, oy + my, ox + mx)
    slabs = [(0, oz, 0, n, 0, n), (ends[0], n, 0, n, 0, n), (oz, ends[0], 0, oy, 0, n), (oz, ends[0], ends[1], n, 0, n), (oz, ends[0], oy, ends[1], 0, ox), (oz, ends[0], oy, ends[1], ends[2], n)]
    some = [F.struct(*[F.lit(int(x)).alias(c) for c, x in zip(("z0", "z1", "y0", "y1", "x0", "x1"), s, strict=True)]) for s in slabs if s[0] < s[1] and s[2] < s[3] and s[4] < s[5]]
    if not some:
        return ids.select("*", *[F.lit(0).alias(c) for c in "zyx"]).where(F.lit(False))
    each = ids.withColumn("_s", F.explode(F.array(*some)))
    side = {c: (F.col(f"_s.{c}1") - F.col(f"_s.{c}0")).cast("long") for c in "zyx"}
    cells = numbered(each, side["z"] * side["y"] * side["x"], "_i")
    at = from_linear(F.col("_i"), side["y"], side["x"])
    return cells.select(*ids.columns, *[(a + F.col(f"_s.{c}0")).cast("int").alias(c) for c, a in zip("zyx", at, strict=True)])


def pad_to_cube(voxels: DataFrame, shape: tuple[int, int, int], size: int = 0, mode: str = "zero", value: float | None = None) -> DataFrame:
    """Centre the grid in a cube of max(size, longest side); what is new, and cells that the grid lacks, get `value`, or 0, or the
    volume's minimum."""
    if value is None and mode not in ("zero", "min"):
        raise ValueError(f"unknown pad mode: {mode}")
    n = max(size, *shape)
    offset = tuple((n - s) // 2 for s in shape)
    fill = F.min("v").cast("double") if value is None and mode == "min" else F.first(F.lit(float(value or 0.0)))
    fills = voxels.groupBy("volume_id").agg(fill.alias("fill"))
    inside = dense(voxels, shape, fills=fills)
    moved = inside.select("volume_id", *[(F.col(c) + o).cast("int").alias(c) for c, o in zip("zyx", offset, strict=True)], "v")
    around = shell(fills, shape, offset, n)
    return moved.unionByName(around.select(*CELL, F.col("fill").alias("v")))


def as_dtype(v: Column, dtype: str) -> Column:
    """v as a number of that numpy type holds it, as a double again."""
    kind = np.dtype(dtype)
    if kind.kind == "f":
        return v.cast("float").cast("double") if kind.itemsize <= 4 else v.cast("double")
    if kind.kind not in "iu" or kind.itemsize == 8:
        return F.when(v >= 0, F.floor(v)).otherwise(F.ceil(v)).cast("double")
    span = 1 << 8 * kind.itemsize
    low = -(span >> 1) if kind.kind == "i" else 0
    whole = F.when(v >= 0, F.floor(v)).otherwise(F.ceil(v))
    return (F.pmod(whole - low, F.lit(span)) + low).cast("double")


@dataclass
class Canonical:
    """What canonicalize made: voxels, the grid's size, and where they come from."""

    voxels: DataFrame
    shape: tuple[int, int, int]
    lineage: dict = field(default_factory=dict)


def canonicalize(voxels: DataFrame, shape, spacing=(1.0, 1.0, 1.0), target=1.0, normalise: str | None = "minmax", cube: bool = True, cube_size: int = 0, pad: str | None = None, pad_value: float | None = None, mode: str = "trilinear", align_corners: bool = True, keep_dtype: bool = False, dtype: str | None = None) -> Canonical:
    """Resample to the target spacing (None: keep), scale to [0, 1] (constant: 0), pad to a cube. The result has unit
    spacing, origin 0 and no rotation; the lineage keeps what it was.

    With keep_dtype, values that are not scaled become numbers of the source's `dtype` (a numpy name) again: whole numbers are cut off towards 0
    and wrap around at the ends of their range."""
    if normalise not in (None, "minmax"):
        raise ValueError(f"unknown normalisation: {normalise}")
    goal = spacing if target is None else (target,) * 3 if isinstance(target, (int, float)) else tuple(target)
    to = target_shape(shape, tuple(reversed(spacing)), tuple(reversed(goal)))
    out = resample(voxels, shape, to, mode, align_corners=align_corners)
    if normalise:
        out = N.minmax(out, "zero")
    final = to
    if cube:
        out = pad_to_cube(out, to, cube_size, pad or ("zero" if normalise else "min"), pad_value)
        final = (max(cube_size, *to),) * 3
    kind = dtype if keep_dtype and not normalise else None
    if kind:
        out = out.withColumn("v", as_dtype(F.col("v"), kind))
    return Canonical(out, final, {"dtype": kind or "float64", "source_shape_zyx": tuple(shape), "source_spacing": tuple(spacing), "resampled_shape_zyx": to, "normalise": normalise, "padded_shape_zyx": final})


def tile_starts(n: int, tile: int, stride: int) -> list[int]:
    """Starts along an axis; the last tile is moved back so that it ends with the axis."""
    if n <= tile:
        return [0]
    return sorted({*range(0, n - tile + 1, stride), n - tile})


def tile_starts_of(n: Column, tile: Column, stride: Column) -> Column:
    """The same as a column (array of int) over columns."""
    last = n - tile
    return F.when(last <= 0, F.array(F.lit(0))).otherwise(F.array_sort(F.array_distinct(F.concat(F.sequence(F.lit(0), F.greatest(last, F.lit(0)), stride), F.array(last)))))


def tiles(shape: tuple[int, int, int], tile: tuple[int, int, int], stride: tuple[int, int, int] | None = None) -> list[tuple]:
    """(name, z0, y0, x0, dz, dy, dx) in z, y, x order."""
    steps = stride or tile
    starts = [tile_starts(n, t, s) for n, t, s in zip(shape, tile, steps, strict=True)]
    return [(f"tile_z{z:04d}_y{y:04d}_x{x:04d}", z, y, x, *(min(t, n) for t, n in zip(tile, shape, strict=True))) for z in starts[0] for y in starts[1] for x in starts[2]]


def split_tiles(voxels: DataFrame, shape, tile, stride=None, pad: bool = False, fill: float = 0.0) -> DataFrame:
    """(volume_id, tile_name, z, y, x, v) with coordinates within the tile; voxels in overlaps come in each tile. Each voxel
    finds its starts per axis by a small table, so the cost follows the voxels, not voxels times tiles."""
    spark = voxels.sparkSession
    out = voxels
    for axis, n, t, s in zip("zyx", shape, tile, stride or tile, strict=True):
        hits = [(i, st) for st in tile_starts(n, t, s) for i in range(st, min(st + t, n))]
        table = spark.createDataFrame(hits, f"{axis} int, {axis}0 int")
        out = out.join(F.broadcast(table), axis)  # one row for each cell of the axis and tile over it
    name = F.format_string("tile_z%04d_y%04d_x%04d", "z0", "y0", "x0")
    got = out.select("volume_id", name.alias("tile_name"), *[(F.col(c) - F.col(f"{c}0")).cast("int").alias(c) for c in "zyx"], "v")
    if not pad:
        return got
    keyed = got.select(F.struct("volume_id", "tile_name").alias("volume_id"), "z", "y", "x", "v")
    return dense(keyed, tile, fill).select("volume_id.volume_id", "volume_id.tile_name", "z", "y", "x", "v")


def needs_tiles(shape, tile, max_voxels: int | None = None, max_dim: int | None = None, max_shape_xyz=None) -> bool:
    """With limits: any of them is exceeded; without: any side is longer than the tile."""
    limits = []
    if max_voxels is not None:
        limits.append(math.prod(shape) > max_voxels)
    if max_dim is not None:
        limits.append(max(shape) > max_dim)
    if max_shape_xyz is not None:
        limits.append(any(n > m for n, m in zip(reversed(tuple(shape)), max_shape_xyz, strict=True)))
    return any(limits) if limits else any(n > t for n, t in zip(shape, tile, strict=True))


def needs_tiles_of(tile: tuple[int, int, int], max_voxels: int | None = None, max_dim: int | None = None, max_shape_xyz=None) -> Column:
    """The same over a table of sizes nz, ny, nx."""
    n = [F.col(f"n{c}").cast("long") for c in "zyx"]
    limits = []
    if max_voxels is not None:
        limits.append(n[0] * n[1] * n[2] > max_voxels)
    if max_dim is not None:
        limits.append(F.greatest(*n) > max_dim)
    if max_shape_xyz is not None:
        limits += [a > m for a, m in zip(reversed(n), max_shape_xyz, strict=True)]
    limits = limits or [a > t for a, t in zip(n, tile, strict=True)]
    out = limits[0]
    for x in limits[1:]:
        out |= x
    return out


def lookup(points: DataFrame, voxels: DataFrame, shape, cols: tuple[str, str, str] = ("pz", "py", "px"), values: tuple[str, ...] = ("v",), by: tuple[str, ...] = ("volume_id",)) -> DataFrame:
    """points with the values (v, or r, g, b, a) of the nearest voxel (half to even, cut to the grid) of the same `by`."""
    at = {f"_{c}": F.least(F.greatest(F.bround(F.col(p)), F.lit(0.0)), F.lit(float(n - 1))).cast("int") for c, p, n in zip("zyx", cols, shape, strict=True)}
    v = voxels.select(*by, *[F.col(c).alias(f"_{c}") for c in "zyx"], *values)
    return points.withColumns(at).join(v, [*by, "_z", "_y", "_x"], "left").drop("_z", "_y", "_x")
