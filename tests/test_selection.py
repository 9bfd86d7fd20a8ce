"""Ranks, quantiles and firsts of groups, by passes and by sorting, against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumengrid.operators import normalize, selection


def groups():
    rng = np.random.default_rng(4)
    return {
        "normal": rng.normal(0, 1, 3001), "ties": rng.integers(0, 3, 2000).astype(float), "constant": np.full(500, 7.25), "one": np.array([-3.5]), "two": np.array([2.0, -1.0]),
        "wide": np.concatenate([10.0 ** rng.uniform(-300, 300, 1500), -(10.0 ** rng.uniform(-300, 300, 1500)), [0.0, 5e-324 * 7, -5e-324]]),
        "close": 1.0 + rng.integers(0, 5000, 3000) * 2.0**-52, "huge": rng.uniform(-1, 1, 2000) * 1.7e308, "inf": np.array([math.inf, -math.inf, 1.0, 2.0] * 300), "nan": np.array([math.nan, 1.0, 2.0, -4.0] * 300),
        "tiny": rng.integers(1, 900, 2000) * 5e-324, "steps": np.repeat(2.0 ** np.arange(-200, 200), 7),
    }


def frame(spark, data):
    return spark.createDataFrame([(k, float(x)) for k, v in data.items() for x in v] + [("normal", None), ("none", None)], "volume_id string, v double").repartition(4)


@pytest.mark.parametrize("small", [0, 1000, 1 << 16])
def test_ranks(spark, monkeypatch, small):
    monkeypatch.setattr(selection, "SMALL", small)
    data = groups()
    wanted = [(k, r) for k, v in data.items() for r in {-1, 0, 1, len(v) // 3, len(v) // 2, len(v) - 2, len(v) - 1, len(v)}] + [("none", 0), ("absent", 0)]
    got = selection.at_ranks(frame(spark, data), spark.createDataFrame(wanted, "volume_id string, rank int"), ["volume_id"]).collect()
    want = {(k, r): np.sort(data[k])[r] for k, r in wanted if k in data and 0 <= r < len(data[k])}
    assert len(got) == len(want)
    for k, r, x in got:
        assert x == want[k, r] or math.isnan(x) and math.isnan(want[k, r]), (k, r)


@pytest.mark.parametrize("small", [0, 1 << 16])
def test_quantiles(spark, monkeypatch, small):
    monkeypatch.setattr(selection, "SMALL", small)
    data = {k: v for k, v in groups().items() if k not in ("inf", "nan", "huge")}
    q = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    for between, method in ((True, "linear"), (False, "inverted_cdf")):
        got = {r[0]: r[1:] for r in selection.quantiles(frame(spark, data), q, ["volume_id"], between).collect()}
        assert got.keys() == data.keys()
        for k, v in data.items():
            assert np.allclose(got[k], np.quantile(v, q, method=method), rtol=1e-12, atol=1e-320), k
    assert selection.quantiles(frame(spark, {}), q, ["volume_id"]).collect() == []


def test_percentiles_and_mad_by_passes(spark, monkeypatch):
    v = frame(spark, {k: x for k, x in groups().items() if k in ("normal", "ties", "close", "constant")}).where("v is not null")
    keyed = v.withColumns({c: F.lit(0) for c in "zyx"})
    one = [sorted(map(tuple, df.collect())) for df in (normalize.percentile(keyed, 1, 99), normalize.mad_threshold(keyed))]
    monkeypatch.setattr(selection, "SMALL", 0)
    assert [sorted(map(tuple, df.collect())) for df in (normalize.percentile(keyed, 1, 99), normalize.mad_threshold(keyed))] == one


def test_a_pass_holds_counts_only(spark, monkeypatch):
    """No aggregate of the passes gathers values: all are counts and extremes."""
    monkeypatch.setattr(selection, "SMALL", 0)
    plans = []
    real = selection.store.saved
    monkeypatch.setattr(selection.store, "saved", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    selection.quantiles(frame(spark, groups()), [0.5], ["volume_id"]).collect()
    assert len(plans) > 3 and not any("collect_list" in p or "collect_set" in p for p in plans)


def test_firsts(spark, monkeypatch):
    """By thresholds, with ties in all keys but the last, and rows that repeat."""
    rng = np.random.default_rng(8)
    rows = []
    for g, n, need in (("ties", 3000, 700), ("flat", 2500, 123), ("spread", 3000, 5), ("all", 2000, 2000), ("few", 10, 3), ("copies", 2000, 50)):
        for i in range(n):
            c = {"ties": float(rng.integers(0, 4)), "flat": 1.0, "spread": float(rng.normal())}.get(g, 2.0)
            z, y, x = (1, 1, 1) if g == "copies" else (i // 400, i // 20 % 20, i % 20)
            rows.append((g, c, z, y, x, need))
    df = spark.createDataFrame(rows, "g string, c double, z int, y int, x int, need int").repartition(4)
    keys = [-F.abs("c"), F.col("z"), F.col("y"), F.col("x")]
    want = {}
    for g, c, z, y, x, need in rows:
        want.setdefault((g, need), []).append((-abs(c), z, y, x))
    for small in (0, 200):
        monkeypatch.setattr(selection, "SMALL", small)
        got = {}
        for g, c, z, y, x, _ in selection.firsts(df, ["g"], keys, F.col("need")).collect():
            got.setdefault(g, []).append((-abs(c), z, y, x))
        for (g, need), v in want.items():
            assert sorted(got[g])[:need] == sorted(v)[:need], g
            assert len(got[g]) <= (len(v) if g in ("copies", "few") else need + small)


def test_band_top_by_thresholds(spark, monkeypatch):
    from lumengrid.operators import wavelet

    rng = np.random.default_rng(9)
    x = np.where(rng.random((16, 16, 16)) < 0.7, 0.0, rng.normal(size=(16, 16, 16)))  # many equal coefficients
    v = spark.createDataFrame([(1, *map(int, c), float(x[c])) for c in np.ndindex(*x.shape)], "volume_id long, z int, y int, x int, v double")
    c = wavelet.transform(v, (16, 16, 16), 1)
    b = wavelet.budgets(c, 900, least=400)
    want = sorted(map(tuple, wavelet.band_top(c, b).collect()))
    monkeypatch.setattr(selection, "SMALL", 50)
    assert sorted(map(tuple, wavelet.band_top(c, b).collect())) == want


def test_top_is_cut_before_the_shuffle(spark):
    from lumengrid.operators import sampling

    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.rand(1).alias("k"))
    got = sampling.top(df, ["g"], ["k"], 5, "r")
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString() and got.count() == 15
