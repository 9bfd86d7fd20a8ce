"""Filter banks: against direct sums, their known filters, and reconstruction."""

import itertools
import math
import re

import numpy as np
import pytest

from lumengrid.operators import transfer, wavelet
from lumengrid.plans import catalog

NAMES = ["haar", *(f"db{n}" for n in range(1, 9)), "sym4"]


@pytest.mark.parametrize("name", NAMES)
def test_filters_are_orthonormal(name):
    low, high = map(np.array, wavelet.filters(name))
    assert math.isclose(low.sum(), math.sqrt(2), rel_tol=1e-12)
    for s in range(0, len(low), 2):
        want = float(s == 0)
        assert abs(low[s:] @ low[: len(low) - s] - want) < 1e-9 and abs(high[s:] @ high[: len(low) - s] - want) < 1e-9
        assert abs(low[s:] @ high[: len(low) - s]) < 1e-9 and abs(high[s:] @ low[: len(low) - s]) < 1e-9
    moments = 4 if name == "sym4" else int(name[2:] or 1) if name != "haar" else 1
    for p in range(moments):
        assert abs(high @ np.arange(len(high)) ** p) < 1e-5 * len(high) ** p


def test_known_filters():
    assert np.allclose(wavelet.filters("db2")[0], catalog.DB2, atol=1e-14) and np.allclose(wavelet.filters("db4")[0], catalog.DB4, atol=1e-12)
    assert np.allclose(wavelet.filters("haar")[1], [-(0.5**0.5), 0.5**0.5])
    for bad in ("db9", "coif1", ""):
        with pytest.raises(ValueError):
            wavelet.filters(bad)
    with pytest.raises(ValueError):
        wavelet.taps(8, "db2", "smooth")


def padded(x, n, mode):
    """numpy's extension of axis 0 by n cells on both sides."""
    how = {"periodic": "wrap", "zero": "constant", "symmetric": "symmetric", "reflect": "reflect"}[mode]
    return np.pad(x, [(n, n)] + [(0, 0)] * (x.ndim - 1), mode=how)


def brute(x, name, mode):
    """Bands of one level by numpy."""
    bands = {"": x}
    for axis in range(3):
        out = {}
        for b, v in bands.items():
            v = np.moveaxis(v, axis, 0)
            low, high = wavelet.filters(name)
            n, size = len(v), len(low)
            ext = padded(v, size, mode)
            for letter, f in (("a", low), ("d", high)):
                c = [sum(f[k] * ext[size + 2 * i + 1 - k] for k in range(size)) for i in range((n + size - 1) // 2)]
                out[b + letter] = np.moveaxis(np.array(c), 0, axis)
        bands = out
    return bands


def table(spark, x):
    return spark.createDataFrame([(1, *map(int, c), float(x[c])) for c in np.ndindex(*x.shape)], "volume_id long, z int, y int, x int, v double").repartition(3)


@pytest.mark.parametrize("name,mode,shape", [("db2", "periodic", (6, 5, 8)), ("db2", "zero", (3, 4, 5)), ("sym4", "symmetric", (4, 9, 6)), ("db3", "reflect", (5, 7, 4)), ("haar", "symmetric", (3, 4, 5)), ("db4", "zero", (1, 2, 3))])
def test_one_level(spark, name, mode, shape):
    x = np.random.default_rng(1).normal(size=shape)
    got = wavelet.transform(table(spark, x), shape, 1, name, mode).collect()
    want = brute(x, name, mode)
    assert len(got) == sum(v.size for v in want.values())
    for _, _, band, z, y, x_, c in got:
        assert abs(want[band][z, y, x_] - c) < 1e-12


@pytest.mark.parametrize("name,mode,shape,levels", [("db2", "periodic", (8, 6, 5), 2), ("db4", "zero", (7, 8, 9), 2), ("sym4", "symmetric", (5, 6, 8), 1), ("db3", "reflect", (9, 5, 6), 2), ("haar", "periodic", (8, 4, 8), 2), ("haar", "periodic", (5, 3, 6), 2)])
def test_reconstruction(spark, name, mode, shape, levels):
    x = np.random.default_rng(2).normal(size=shape)
    coeffs = wavelet.transform(table(spark, x), shape, levels, name, mode)
    back = np.full(shape, np.nan)
    for _, *c, v in wavelet.inverse(coeffs, shape, levels, name).collect():
        back[tuple(c)] = v
    assert np.abs(back - x).max() < 1e-9


@pytest.mark.parametrize("name,mode,shape", [("db2", "periodic", (9, 4, 7)), ("db4", "symmetric", (10, 11, 3)), ("db3", "reflect", (4, 9, 8)), ("sym4", "zero", (8, 3, 12))])
def test_blocks_give_the_same(spark, monkeypatch, name, mode, shape):
    monkeypatch.setattr(wavelet, "BLOCK", 3)  # several along two axes at least, and taps that reach over their ends
    x = np.random.default_rng(7).normal(size=shape)
    coeffs = wavelet.transform(table(spark, x), shape, 1, name, mode)
    got, want = coeffs.collect(), brute(x, name, mode)
    assert len(got) == sum(v.size for v in want.values()) == len({tuple(r)[:6] for r in got})
    for _, _, band, z, y, x_, c in got:
        assert abs(want[band][z, y, x_] - c) < 1e-12
    back = {tuple(c): v for _, *c, v in wavelet.inverse(coeffs, shape, 1, name).collect()}
    assert len(back) == x.size and all(abs(x[c] - v) < 1e-9 for c, v in back.items())


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if re.search(r"[-+:] Exchange ", line)]


def test_only_voxels_are_shuffled(spark):
    """Sums of the axes are made where the voxels were dealt to: one shuffle a level, of the voxels; the inverse brings bands together and deals them."""
    v = table(spark, np.random.default_rng(8).normal(size=(4, 4, 4)))
    coeffs = wavelet.transform(v, (4, 4, 4), 1, "db4", "symmetric")
    assert len(exchanges(coeffs)) == len(exchanges(v)) + 1
    rows = spark.createDataFrame([], coeffs.schema)
    stored = spark.createDataFrame(rows.rdd, rows.schema)
    assert len(exchanges(wavelet.inverse(stored, (4, 4, 4), 1, "db4"))) <= 2


def test_sampler_with_other_wavelets(spark):
    x = np.random.default_rng(3).normal(size=(6, 6, 6))
    v = table(spark, x)
    drawn = wavelet.sample(v, (6, 6, 6), 20, 1, least=2, wavelet="db2", mode="symmetric").orderBy("point_id").collect()
    mags = [r["coeff_abs"] for r in drawn]
    every = sorted((abs(r["c"]) for r in wavelet.transform(v, (6, 6, 6), 1, "db2", "symmetric").collect()), reverse=True)
    assert 15 <= len(drawn) <= 20 and mags == sorted(mags, reverse=True) and math.isclose(mags[0], every[0])
    rgba = transfer.bake(v, [transfer.TransferFunction("T", ((-3, 0, 0, 0, 0), (3, 1, 0.5, 0.2, 1)))])
    assert wavelet.sample_rgba(rgba, (6, 6, 6), 15, 1, least=2, wavelet="db2").count() <= 15


def test_energy_is_kept(spark):
    x = np.random.default_rng(5).normal(size=(8, 8, 8))
    for name in ("haar", "db1"):
        c = wavelet.transform(table(spark, x), (8, 8, 8), 2, name).selectExpr("sum(c * c)").first()[0]
        assert math.isclose(c, (x**2).sum())
    assert list(itertools.islice(wavelet.BANDS, 2)) == ["aaa", "aad"]
