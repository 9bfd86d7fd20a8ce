"""3-D orthonormal wavelets on voxel rows and the sampler built on them.

The periodic Haar wavelet (odd sides wrap) groups 2 x 2 x 2 cells and forms eight signed sums in one aggregate a level. Other wavelets and
modes are filter banks, applied axis by axis: a voxel meets the taps that read it (a table as long as the axis, times the filter), and
sums by cell give both halves at once. Voxels go once to the blocks of results that read them, so that the sums of all three axes are made
where they lie: only voxels are shuffled, never the wider sums. Bands are named by axis (z, y, x), a for the sum and d for the difference. The approximation has
j = 0, details of the coarsest level j = levels. inverse() gives the voxels back.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache
from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import grid, sampling, selection

BANDS = ["".join(b) for b in product("ad", repeat=3)]
SCALE = 0.5**1.5


def level(voxels: DataFrame, shape: tuple[int, int, int], values: tuple[str, ...] = ("v",)) -> tuple[DataFrame, tuple[int, ...]]:
    """One level: columns volume_id, z, y, x and one for each band (of several values: <band>_<value>); and the new size."""
    v = voxels
    for axis, n in zip("zyx", shape, strict=True):
        if n % 2:  # the missing neighbour of the last cell is the first one
            v = v.unionByName(v.where(F.col(axis) == 0).withColumn(axis, F.lit(n)))
    sign = lambda b: F.lit(1.0) if b == "aaa" else F.when(
        sum(((F.col(c) % 2) for k, c in zip(b, "zyx", strict=True) if k == "d"), F.lit(0)) % 2 == 0, 1.0
    ).otherwise(-1.0)
    half = [F.floor(F.col(c) / 2).cast("int").alias(c) for c in "zyx"]
    name = {(b, c): b if values == ("v",) else f"{b}_{c}" for b in BANDS for c in values}
    signed = v.select("volume_id", *half, *[(F.col(c) * sign(b)).alias(x) for (b, c), x in name.items()])
    return signed.groupBy("volume_id", "z", "y", "x").agg(*[(F.sum(x) * SCALE).alias(x) for x in name.values()]), tuple((n + 1) // 2 for n in shape)


#: The scaling filter (decomposition) of the least asymmetric wavelet with four vanishing moments.
SYM4 = (
    -0.07576571478927333, -0.02963552764599851, 0.49761866763201545, 0.8037387518059161,
    0.29785779560527736, -0.09921954357684722, -0.012603967262037833, 0.0322231006040427,
)
MODES = ("periodic", "zero", "symmetric", "reflect")


@lru_cache(maxsize=16)
def filters(name: str) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Low and high decomposition filters of haar, db1 to db8 and sym4; reversed they are the ones of the reconstruction.

    A Daubechies filter of n vanishing moments is the factor ((1 + z) / 2)^n times the roots within the unit circle of the polynomial
    with coefficients C(n - 1 + k, k) in (2 - z - 1 / z) / 4, scaled to a sum of sqrt(2)."""
    if name == "sym4":
        low = np.array(SYM4)
    elif (m := re.fullmatch(r"db([1-8])", "db1" if name == "haar" else name)) is not None:
        n = int(m[1])
        inside = []
        for y in np.roots([math.comb(n - 1 + k, k) for k in range(n - 1, -1, -1)]):
            z = np.roots([1, 4 * y - 2, 1])
            inside.append(z[np.argmin(np.abs(z))])
        low = np.real(np.poly([-1.0] * n + inside))[::-1]
        low = low * (math.sqrt(2) / low.sum())
    else:
        raise ValueError(f"unknown wavelet: {name}; there are haar, db1 to db8 and sym4")
    high = low[::-1] * np.where(np.arange(len(low)) % 2, 1.0, -1.0)
    return tuple(map(float, low)), tuple(map(float, high))


def _outside(m: int, n: int, mode: str) -> int | None:
    """The cell that stands for place m of an axis of n cells; None for a zero."""
    if 0 <= m < n:
        return m
    if mode == "zero":
        return None
    if mode == "periodic":
        return m % n
    if mode == "symmetric":  # the last cell comes twice
        m %= 2 * n
        return m if m < n else 2 * n - 1 - m
    m %= max(2 * n - 2, 1)
    return m if m < n else 2 * n - 2 - m


def taps(n: int, wavelet: str, mode: str) -> list[tuple[int, int, float, float]]:
    """(from, to, low, high) for an axis of n cells: coefficient i reads the places 2 i + 1 - k, k along the filter."""
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}; there are {', '.join(MODES)}")
    low, high = filters(wavelet)
    out: dict[tuple[int, int], list[float]] = {}
    for i in range((n + len(low) - 1) // 2):
        for k, (a, d) in enumerate(zip(low, high, strict=True)):
            src = _outside(2 * i + 1 - k, n, mode)
            if src is not None:
                w = out.setdefault((src, i), [0.0, 0.0])
                w[0] += a
                w[1] += d
    return [(src, i, a, d) for (src, i), (a, d) in out.items()]


#: Results along an axis of a block, whose sums are made in one task.
BLOCK = 32


def _blocked(cells: DataFrame, tables: dict[str, list[tuple]]) -> tuple[DataFrame, dict[str, DataFrame], list[str]]:
    """The cells dealt by volume and block of results, a cell to every block that reads it; for each axis its taps (from, to, ...) as a table
    _src, _dst, _low, _high, and the block of the result where an axis has several; and the names of the blocks' columns.

    Partitions are given by number: put together by their bytes they would hold too many sums, as a cell becomes many of these."""
    spark, taps, blocks = cells.sparkSession, {}, []
    for axis, table in tables.items():
        several, name = max((dst for _, dst, *_ in table), default=0) >= BLOCK, f"_b{axis}"
        taps[axis] = spark.createDataFrame([(*t, t[1] // BLOCK) for t in table], f"_src int, _dst int, _low double, _high double, {name} int")
        if several:
            read = spark.createDataFrame(sorted({(src, dst // BLOCK) for src, dst, *_ in table}), f"_src int, {name} int")
            cells = cells.join(F.broadcast(read), F.col(axis) == F.col("_src")).drop("_src")
            blocks.append(name)
        else:
            taps[axis] = taps[axis].drop(name)
    return cells.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "volume_id", *blocks), taps, blocks


def _along(cells: DataFrame, axis: str, taps: DataFrame, blocks: list[str], sums: list[Column]) -> DataFrame:
    """The sums of the taps along one axis, for each cell of the others. Grouping by volume and block first needs no shuffle after _blocked()."""
    name = f"_b{axis}"
    on = F.col(axis) == F.col("_src")
    if name in blocks:
        taps = taps.withColumnRenamed(name, "_to")
        on = on & (F.col(name) == F.col("_to"))
    both = cells.join(F.broadcast(taps), on)  # as many rows as the axis has cells, times half a filter
    return both.groupBy("volume_id", *blocks, *[c for c in "zyx" if c != axis], F.col("_dst").alias(axis)).agg(*sums)


def bank(voxels: DataFrame, shape: tuple[int, int, int], wavelet: str, mode: str = "periodic", values: tuple[str, ...] = ("v",)) -> tuple[DataFrame, tuple[int, ...]]:
    """One level of a filter bank: as level()."""
    now, tables, blocks = _blocked(
        voxels.select("volume_id", "z", "y", "x", *[F.col(c).alias(f"_{c}") for c in values]), {axis: taps(n, wavelet, mode) for axis, n in zip("zyx", shape, strict=True)}
    )
    names = {f"_{c}": c for c in values}
    for axis in "zyx":
        now = _along(now, axis, tables[axis], blocks, [F.sum(F.col(c) * F.col(w)).alias(f"{c}{b}") for c in names for b, w in (("a", "_low"), ("d", "_high"))])
        names = {f"{c}{b}": v for c, v in names.items() for b in "ad"}
    wide = [F.col(c).alias(c[-3:] if values == ("v",) else f"{c[-3:]}_{v}") for c, v in names.items()]
    size = len(filters(wavelet)[0])
    return now.select("volume_id", "z", "y", "x", *wide), tuple((n + size - 1) // 2 for n in shape)


def _level(voxels: DataFrame, shape, wavelet: str, mode: str, values: tuple[str, ...] = ("v",)) -> tuple[DataFrame, tuple[int, ...]]:
    return level(voxels, shape, values) if wavelet in ("haar", "db1") and mode == "periodic" else bank(voxels, shape, wavelet, mode, values)


def sides(shape: tuple[int, int, int], levels: int, wavelet: str) -> list[tuple[int, ...]]:
    """The grid's size and that of each level's coefficients."""
    size, out = len(filters(wavelet)[0]), [tuple(shape)]
    for _ in range(levels):
        out.append(tuple((n + size - 1) // 2 for n in out[-1]))
    return out


def inverse(coeffs: DataFrame, shape: tuple[int, int, int], levels: int = 1, wavelet: str = "haar") -> DataFrame:
    """The voxels (volume_id, z, y, x, v) that transform() has made the coefficients of, in any mode."""
    low, high = filters(wavelet)
    size, sizes = len(low), sides(shape, levels, wavelet)
    now = coeffs.where("j = 0").select("volume_id", "z", "y", "x", F.col("c").alias("aaa"))
    for j in range(levels, 0, -1):
        wide = coeffs.where((F.col("j") == j)).select("volume_id", "z", "y", "x", *[F.when(F.col("band") == b, F.col("c")).alias(b) for b in BANDS[1:]])
        back = {}
        for axis, n in zip("zyx", sizes[j - 1], strict=True):
            m = (n + size - 1) // 2
            back[axis] = [(i, o, low[2 * i + 1 - o], high[2 * i + 1 - o]) for i in range(m) for o in range(n) if 0 <= 2 * i + 1 - o < size]
        cells = wide.unionByName(now, allowMissingColumns=True).groupBy("volume_id", "z", "y", "x").agg(*[F.coalesce(F.sum(b), F.lit(0.0)).alias(b) for b in BANDS])
        cells, tables, blocks = _blocked(cells, back)
        names = list(BANDS)
        for axis in "xyz":  # the last axis of a name first
            short = sorted({b[:-1] for b in names})
            cells = _along(cells, axis, tables[axis], blocks, [F.sum(F.col(f"{b}a") * F.col("_low") + F.col(f"{b}d") * F.col("_high")).alias(b or "v") for b in short])
            names = short
        now = cells.select("volume_id", "z", "y", "x", F.col("v").alias("aaa"))
    return now.withColumnRenamed("aaa", "v")


def transform(voxels: DataFrame, shape: tuple[int, int, int], levels: int = 1, wavelet: str = "haar", mode: str = "periodic") -> DataFrame:
    """(volume_id, j, band, z, y, x, c): all coefficients of a multilevel transform. Cells outside the grid are as those of the other end
    ("periodic"), 0 ("zero"), or mirrored with the last cell twice ("symmetric") or once ("reflect")."""
    out, now = None, voxels.select("volume_id", "z", "y", "x", "v")
    for j in range(1, levels + 1):
        wide, shape = _level(now, shape, wavelet, mode)
        bands = BANDS[1:] if j < levels else BANDS
        each = F.explode(F.array(*[F.struct(F.lit(0 if b == "aaa" else j).alias("j"), F.lit(b).alias("band"), F.col(b).alias("c")) for b in bands])).alias("e")
        one = wide.select("volume_id", "z", "y", "x", each).select("volume_id", "e.j", "e.band", "z", "y", "x", "e.c")
        out = one if out is None else out.unionByName(one)
        now = wide.select("volume_id", "z", "y", "x", F.col("aaa").alias("v"))
    return out if out is not None else now.select("volume_id", F.lit(0).alias("j"), F.lit("aaa").alias("band"), "z", "y", "x", F.col("v").alias("c"))


def transform_rgba(rgba: DataFrame, shape: tuple[int, int, int], levels: int = 1, wavelet: str = "haar", mode: str = "periodic") -> DataFrame:
    """(volume_id, tf_name, j, band, z, y, x, r, g, b, a, c): channels transformed together, a level by one aggregate of all bands'
    and channels' sums; c is their Euclidean norm."""
    out, now = None, rgba.select(F.struct("volume_id", "tf_name").alias("volume_id"), "z", "y", "x", *"rgba")
    for j in range(1, levels + 1):
        wide, shape = _level(now, shape, wavelet, mode, tuple("rgba"))
        bands = BANDS[1:] if j < levels else BANDS
        each = F.explode(F.array(*[F.struct(F.lit(0 if b == "aaa" else j).alias("j"), F.lit(b).alias("band"), *[F.col(f"{b}_{ch}").alias(ch) for ch in "rgba"]) for b in bands])).alias("e")
        one = wide.select("volume_id", "z", "y", "x", each).select("volume_id", "e.j", "e.band", "z", "y", "x", *[f"e.{ch}" for ch in "rgba"])
        out = one if out is None else out.unionByName(one)
        now = wide.select("volume_id", "z", "y", "x", *[F.col(f"aaa_{ch}").alias(ch) for ch in "rgba"])
    norm = F.sqrt(sum((F.col(ch) * F.col(ch) for ch in "gba"), F.col("r") * F.col("r")))
    return out.select("volume_id.*", "j", "band", "z", "y", "x", *"rgba", norm.alias("c"))


def budgets(coeffs: DataFrame, n: int, alpha: float = 1.0, beta: float = 1.0, gamma: float = 1.2, least: int = 100, by: tuple[str, ...] = ("volume_id",), smooth: bool = True, channels: int = 1) -> DataFrame:
    """(by, j, band, energy, size, k): points for each band, by its energy, size and level; at least `least`. With c the norm
    of several channels, energy and size are sums over these."""
    bands = coeffs.groupBy(*by, "j", "band").agg(F.sum(F.col("c") * F.col("c")).alias("energy"), (F.count("*") * channels).alias("size"))
    e = F.log1p("energy") if smooth else F.col("energy")
    score = F.pow(e, F.lit(alpha)) * F.pow(F.col("size").cast("double"), F.lit(beta))
    if smooth:
        score = score * F.pow(F.col("j") + 1.0, F.lit(-gamma))
    w = Window.partitionBy(*by)  # seven bands a level and one
    scored = bands.withColumn("score", score)
    k = F.greatest(F.floor(F.col("score") / (F.sum("score").over(w) + 1e-12) * n), F.lit(least if smooth else max(1, least)))
    return scored.withColumn("k", k.cast("int")).drop("score")


def band_top(coeffs: DataFrame, budget: DataFrame, by: tuple[str, ...] = ("volume_id",), most: int | None = None) -> DataFrame:
    """The k largest |c| of each band; ties by z, y, x. Large bands are cut to about k rows by a threshold before they are sorted. most:
    coefficients of a band at most, if that is known."""
    keys = [*by, "j", "band"]
    rows = coeffs.join(budget.select(*keys, "k"), keys)
    if most is None or most > selection.SMALL:
        rows = selection.firsts(rows, keys, [-F.abs("c"), F.col("z"), F.col("y"), F.col("x")], F.col("k"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.abs("c").desc(), "z", "y", "x"))
    return rows.withColumn("_r", place).where(F.col("_r") <= F.col("k")).drop("_r", "k")


def centres(points: DataFrame, shape: tuple[int, int, int], levels: int, centred: bool = False) -> DataFrame:
    """Grid place of each coefficient: pz, py, px. With `centred` the middle of its block, else half a block's offset as in
    (N - 1) / 2 + (index - (N div 2^j) / 2) 2^j."""
    j = F.when(F.col("j") == 0, levels).otherwise(F.col("j"))
    step = F.pow(F.lit(2.0), j)
    place = lambda c, n: F.col(c) * step + (step - 1) / 2 if centred else (n - 1) / 2.0 + (F.col(c) - F.floor(F.lit(n) / step) * 0.5) * step
    return points.withColumns({f"p{c}": place(c, n) for c, n in zip("zyx", shape, strict=True)})


def sample(voxels: DataFrame, shape: tuple[int, int, int], n: int = 10_000, levels: int = 1, least: int = 100, centred: bool = False, alpha: float = 1.0, beta: float = 1.0, wavelet: str = "haar", mode: str = "periodic") -> DataFrame:
    """Points at the largest coefficients: (volume_id, point_id, px, py, pz, coeff_abs, level, band), n at most per volume."""
    return _best(transform(voxels, shape, levels, wavelet, mode), shape, n, levels, least, centred, ("volume_id",), 1, alpha, beta)


def sample_rgba(rgba: DataFrame, shape: tuple[int, int, int], n: int = 10_000, levels: int = 1, least: int = 100, centred: bool = False, alpha: float = 1.0, beta: float = 1.0, wavelet: str = "haar", mode: str = "periodic") -> DataFrame:
    """The same for each volume and transfer function, by the norm of the four channels' coefficients: (volume_id, tf_name,
    point_id, px, py, pz, coeff_abs, level, band, r, g, b, a), the colours those of the nearest voxel."""
    by = ("volume_id", "tf_name")
    return grid.lookup(_best(transform_rgba(rgba, shape, levels, wavelet, mode), shape, n, levels, least, centred, by, 4, alpha, beta), rgba, shape, values=tuple("rgba"), by=by)


def _best(coeffs: DataFrame, shape: tuple[int, int, int], n: int, levels: int, least: int, centred: bool, by: tuple[str, ...], channels: int, alpha: float, beta: float) -> DataFrame:
    top = band_top(coeffs, budgets(coeffs, n, alpha, beta, least=least, by=by, channels=channels), by, math.prod(shape))
    best = sampling.top(top, list(by), [F.abs("c").desc(), "j", "band", "z", "y", "x"], n, "point_id")
    return centres(best, shape, levels, centred).select(*by, "point_id", "px", "py", "pz", F.abs("c").alias("coeff_abs"), F.col("j").alias("level"), "band")
