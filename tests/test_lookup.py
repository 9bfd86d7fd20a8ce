"""Lookups of any number of points, and stored number types."""

import bisect
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumengrid.functions import columns as C
from lumengrid.operators import grid, transfer

RNG = np.random.default_rng(3)
POINTS = {
    "even": np.linspace(-1, 2, 64), "random": np.sort(RNG.uniform(-1, 1, 2048)), "ties": np.sort(RNG.integers(0, 30, 100) / 10.0), "close": np.concatenate([[0.0], 1 + np.arange(50) * 2.0**-52, [1e6]]),
    "two": np.array([0.25, 0.75]), "one value": np.full(20, 0.5), "single": np.array([0.5]), "seventeen": np.linspace(0, 1, 17),
}


def values(xs):
    some = np.concatenate([xs[:40], np.nextafter(xs[:40], 9e9), np.nextafter(xs[:40], -9e9), RNG.uniform(xs[0] - 1, xs[-1] + 1, 200)])
    return [None, math.nan, math.inf, -math.inf, *map(float, some)]


@pytest.mark.parametrize("name", POINTS)
def test_upto(spark, name):
    xs = POINTS[name].tolist()
    df = spark.createDataFrame([(v,) for v in values(xs)], "v double")
    for strict, find in ((False, bisect.bisect_right), (True, bisect.bisect_left)):
        for v, n in df.select("v", C.upto(F.col("v"), xs, strict).alias("n")).collect():
            assert n == (None if v is None else len(xs) if v != v else find(xs, v)), v


@pytest.mark.parametrize("name", POINTS)
def test_interpolate_is_the_same_with_and_without_an_index(spark, monkeypatch, name):
    xs = POINTS[name].tolist()[:300]
    ys = RNG.normal(size=len(xs)).tolist()
    df = spark.createDataFrame([(v,) for v in values(np.array(xs))], "v double")
    got = {}
    for many in (0, 10_000):
        monkeypatch.setattr(C, "MANY", many)
        left = C.interpolate_left(F.col("v"), xs, ys) if len(xs) > 1 else F.lit(0.0)
        got[many] = df.select(C.interpolate(F.col("v"), xs, ys).alias("a"), left.alias("b")).collect()
    for p, q in zip(got[0], got[10_000]):
        for a, b in zip(p, q):
            assert a is None and b is None or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12) or math.isnan(a)


def plan_size(df):
    plan = df._jdf.queryExecution().analyzed().toString()
    return plan.count("CASE") + plan.count("get(")


def test_bake_of_many_points(spark):
    v = spark.range(200).select(F.lit(1).alias("volume_id"), *[F.lit(0).alias(c) for c in "zy"], F.col("id").cast("int").alias("x"), (F.col("id") / 190.0 - 0.02).alias("v"))
    sizes = []
    for n in (64, 2048):
        xs = np.linspace(0, 1, n)
        tf = transfer.TransferFunction("T", tuple((float(x), float(x * x), float(1 - x), 0.5, float(np.sin(x))) for x in xs))
        df = transfer.bake(v, [tf, transfer.TransferFunction("S", ((0.0, 0, 0, 0, 0), (1.0, 1, 1, 1, 1)))])
        sizes.append(plan_size(df))
        got = {r["x"]: r for r in df.where("tf_name = 'T'").collect()}
        for i in range(200):
            want = [np.interp(i / 190.0 - 0.02, xs, ys) for ys in (xs * xs, 1 - xs, np.full(n, 0.5), np.sin(xs))]
            assert np.allclose([got[i][c] for c in "rgba"], want, atol=1e-12)
        assert df.where("tf_name = 'S'").count() == 200
    assert sizes[0] == sizes[1]


def test_bell_bands_bake(spark):
    """Ten bells of 64 points each, which no CASE chain of that size could hold in one method."""
    edges = [i / 10 for i in range(11)]
    tfs = [transfer.TransferFunction(f"B{b}", tuple((x, 1.0, 1.0, 1.0, a) for x, a in transfer.band_points(b, edges, 0.0, 1.0, "gaussian"))) for b in range(1, 11)]
    v = spark.range(1000).select(F.lit(1).alias("volume_id"), *[F.lit(0).alias(c) for c in "zy"], F.col("id").cast("int").alias("x"), (F.col("id") / 1000.0).alias("v"))
    top = {r[0]: r[1] for r in transfer.bake(v, tfs).groupBy("tf_name").agg(F.max_by("x", "a")).collect()}
    assert all(abs(top[f"B{b}"] - (100 * b - 50)) <= 2 for b in range(1, 11))


@pytest.mark.parametrize("dtype", ["uint8", "int8", "uint16", "int16", "uint32", "int32", "float32", "float64"])
def test_keep_dtype(spark, dtype):
    x = np.array([-40000.7, -129.5, -1.5, -0.4, 0.0, 0.6, 1.5, 127.9, 128.2, 255.9, 256.1, 40000.3, 70000.9])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(grid.as_dtype(F.col("v"), dtype)).collect()]
    kind = np.dtype(dtype)
    want = x.astype(kind) if kind.kind == "f" else np.trunc(x).astype(np.int64).astype(kind)
    assert got == want.astype(float).tolist()


def test_canonicalize_keeps_dtype(spark):
    v = spark.createDataFrame([(1, z, y, x, float(7 * z + 3 * y + x)) for z in range(2) for y in range(2) for x in range(2)], "volume_id long, z int, y int, x int, v double")
    same = grid.canonicalize(v, (2, 2, 2), target=None, normalise=None, cube=False, keep_dtype=True, dtype="uint8")
    assert sorted(map(tuple, same.voxels.collect())) == sorted(map(tuple, v.collect())) and same.lineage["dtype"] == "uint8"
    finer = grid.canonicalize(v, (2, 2, 2), (1.0, 1.0, 1.0), 0.5, normalise=None, cube=False, keep_dtype=True, dtype="uint8").voxels
    assert finer.where("v <> floor(v)").isEmpty()
    scaled = grid.canonicalize(v, (2, 2, 2), target=None, cube=False, keep_dtype=True, dtype="uint8")
    assert scaled.lineage["dtype"] == "float64" and not scaled.voxels.where("v > 0 and v < 1").isEmpty()
