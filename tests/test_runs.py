"""Cells, shells and draws that are made in runs: against loops, and spread over tasks."""

import itertools

import pytest
from pyspark.sql import functions as F

from lumengrid.operators import geometry, grid, sampling


def voxels(spark, cells, shape=None):
    return spark.createDataFrame([(v, z, y, x, float(10 * v + z - y * x)) for v, z, y, x in cells], "volume_id long, z int, y int, x int, v double").repartition(3)


SOME = [(1, 0, 0, 0), (1, 1, 2, 3), (1, 0, 1, 1), (2, 1, 0, 0)]


@pytest.mark.parametrize("run", [1, 5, 7, 1 << 16])
def test_dense(spark, monkeypatch, run):
    monkeypatch.setattr(grid, "RUN", run)
    have = {c: 10.0 * c[0] + c[1] - c[2] * c[3] for c in SOME}
    want = sorted((v, *c, have.get((v, *c), -1.5)) for v in (1, 2) for c in itertools.product(range(2), range(3), range(4)))
    assert sorted(map(tuple, grid.dense(voxels(spark, SOME), (2, 3, 4), -1.5).collect())) == want
    assert grid.dense(voxels(spark, []), (2, 3, 4)).collect() == []


@pytest.mark.parametrize("shape,size", [((2, 3, 4), 0), ((2, 3, 4), 7), ((3, 3, 3), 0), ((1, 1, 5), 6)])
def test_pad_to_cube(spark, monkeypatch, shape, size):
    monkeypatch.setattr(grid, "numbered", lambda rows, n, name, f=grid.numbered: f(rows, n, name, run=11))
    n = max(size, *shape)
    cells = [c for c in SOME if all(i < s for i, s in zip(c[1:], shape))]
    have = {(c[0], *[i + (n - s) // 2 for i, s in zip(c[1:], shape)]): 10.0 * c[0] + c[1] - c[2] * c[3] for c in cells}
    low = {v: min(x for c, x in have.items() if c[0] == v) for v in {c[0] for c in cells}}
    for args, fill in (((), lambda v: 0.0), (("min",), low.get), (("min", 4.5), lambda v: 4.5)):
        want = sorted((v, *c, have.get((v, *c), fill(v))) for v in low for c in itertools.product(range(n), repeat=3))
        assert sorted(map(tuple, grid.pad_to_cube(voxels(spark, cells), shape, size, *args).collect())) == want
    with pytest.raises(ValueError):
        grid.pad_to_cube(voxels(spark, cells), shape, size, "mean")


def test_padding_is_shared_out(spark):
    """The shell of one large volume is made by many tasks, and nothing is joined by cell."""
    one = voxels(spark, [(1, z, y, x) for z, y, x in itertools.product(range(8), repeat=3)])
    out = grid.pad_to_cube(one, (8, 8, 8), 128)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    per_task = out.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r[1] for r in per_task) == 128**3
    assert sorted(r[1] for r in per_task)[-1] < 0.6 * 128**3 and sum(r[1] > 128**3 // 16 for r in per_task) >= 3


def test_numbered(spark):
    rows = spark.createDataFrame([(1, 7), (2, 0), (3, 1), (4, 30)], "id int, n long")
    got = sorted(map(tuple, grid.numbered(rows, F.col("n"), "k", run=4).select("id", "k").collect()))
    assert got == [(i, k) for i, n in ((1, 7), (2, 0), (3, 1), (4, 30)) for k in range(n)]
    tasks = grid.numbered(spark.range(1).withColumnRenamed("id", "v"), 1 << 20, "k").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and sum(r[1] for r in tasks) == 1 << 20


def test_draws_are_shared_out(spark):
    v = voxels(spark, [(1, z, y, x) for z, y, x in itertools.product(range(4), repeat=3)])
    drawn = sampling.uniform(v, (4, 4, 4), 300_000, 1)
    assert drawn.count() == 300_000 and drawn.select("point_id").distinct().count() == 300_000
    rgba = v.select("volume_id", F.lit("T").alias("tf_name"), "z", "y", "x", (F.col("z") + 1.0).alias("a"))
    more = sampling.opacity_with_replacement(rgba, 200_000, 1).groupBy("z").count().collect()
    assert sum(r[1] for r in more) == 200_000
    assert all(abs(r[1] / 200_000 - (r[0] + 1) / 10) < 0.01 for r in more)


def test_linear_indices_are_exact(spark):
    big = 3_000_000_019 * 7
    row = spark.range(1).select(F.lit(big).alias("i")).select(*geometry.from_linear(F.col("i"), 100_003, 50_021)).first()
    assert tuple(row) == (big // (100_003 * 50_021), big // 50_021 % 100_003, big % 50_021)
