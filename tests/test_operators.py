import hashlib
import math

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumengrid.functions import columns as C
from lumengrid.functions import fields
from lumengrid.operators import batch, camera, geometry, grid, histogram, normalize, qc, render, sampling, transfer, wavelet


def cube(spark, values, volume=0):
    a = np.asarray(values, float)
    rows = [(volume, *map(int, i), float(v)) for i, v in np.ndenumerate(a)]
    return spark.createDataFrame(rows, "volume_id long, z int, y int, x int, v double")


def array(df, shape):
    out = np.full(shape, np.nan)
    for r in df.select("z", "y", "x", "v").collect():
        out[r[0], r[1], r[2]] = r[3]
    return out


def test_constant_volume(spark):
    v = cube(spark, np.full((2, 2, 2), 7.0))
    assert {r.v for r in normalize.minmax(v).collect()} == {7.0}
    assert {r.v for r in normalize.minmax(v, "zero").collect()} == {0.0}
    assert {r.v for r in normalize.percentile(v).collect()} == {0.0}
    with pytest.raises(ValueError):
        normalize.normalize(v, "other")


def test_percentile_matches_numpy(spark):
    a = np.random.default_rng(1).normal(size=(4, 5, 6))
    lo, hi = np.percentile(a, [1, 99])
    assert np.allclose(array(normalize.percentile(cube(spark, a)), a.shape), np.clip((a - lo) / (hi - lo), 0, 1))


def test_scalar_range(spark):
    v = cube(spark, [[[1.0, 3.0]]])
    assert normalize.scalar_range(v) == (1.0, 3.0)
    assert normalize.scalar_range(v, "2,9") == (2.0, 9.0)
    assert normalize.scalar_range(v.where("false")) == (0.0, 255.0)


def test_histogram_edges(spark):
    a = np.random.default_rng(2).random((8, 8, 8)) ** 3
    counts, edges = np.histogram(a, 64, (0.0, 1.0))
    got = histogram.equalised_edges(histogram.histogram(cube(spark, a), 0.0, 1.0, 64), 0.0, 1.0, 4, 64).orderBy("edge").collect()
    at = np.searchsorted(np.cumsum(counts), np.linspace(0, a.size, 5)[1:-1], side="right")
    assert np.allclose([r.x for r in got], [0.0, *edges[at], 1.0])


@given(st.lists(st.tuples(st.floats(0, 1), st.floats(0, 1)), min_size=2, max_size=8), st.floats(-0.5, 1.5))
def test_transfer_function_sorts(points, _):
    t = transfer.TransferFunction("t", tuple((x, a, a, a, a) for x, a in points))
    assert [p[0] for p in t.points] == sorted(x for x, _ in points)


def test_interpolate(spark):
    xs, ys = [0.0, 0.5, 0.5, 1.0], [0.0, 1.0, 3.0, 2.0]
    v = np.linspace(-0.2, 1.2, 29)
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    got = [r.y for r in df.select(C.interpolate(F.col("v"), xs, ys).alias("y")).collect()]
    assert np.allclose(got, np.interp(v, xs, ys))
    first = spark.range(1).select(C.interpolate_left(F.lit(0.5), xs, ys).alias("y")).first().y
    assert abs(first - 1.0) < 1e-6


@pytest.mark.parametrize("mode", ["unit", "linear", "gaussian"])
def test_band_points(mode):
    for edges in ([0.0, 0.25, 0.5, 1.0], [0.0, 0.5, 0.5, 1.0]):
        for b in (1, 2, 3):
            pts = transfer.band_points(b, edges, 0.0, 1.0, mode)
            assert all(p[0] < q[0] or p[0] == q[0] for p, q in zip(pts, pts[1:]))
            assert pts[0] == (0.0, 0.0) and len(transfer.flat_points(pts)) == 4 * len(pts)
    assert transfer.band_points(1, [0, 1], 0, 1, "odd") == []


def test_tf_set():
    assert [m for _, m, _ in transfer.tf_set("A,B\nA", 3)] == ["A", "B", "A"]
    assert len(transfer.tf_set(None, 0)) == 5


def test_trilinear_identity_and_ramp(spark):
    a = np.arange(27, dtype=float).reshape(3, 3, 3)
    up = array(grid.trilinear(cube(spark, a), (3, 3, 3), (5, 5, 5)), (5, 5, 5))
    z, y, x = np.meshgrid(*[np.linspace(0, 2, 5)] * 3, indexing="ij")
    assert np.allclose(up, 9 * z + 3 * y + x)
    assert np.allclose(array(grid.trilinear(cube(spark, a), (3, 3, 3), (3, 3, 3)), (3, 3, 3)), a)
    half = array(grid.trilinear(cube(spark, [[[0.0, 1.0, 2.0, 3.0]]]), (1, 1, 4), (1, 1, 2), False), (1, 1, 2))
    assert np.allclose(half, [[[0.5, 2.5]]])
    with pytest.raises(ValueError):
        grid.resample(cube(spark, a), (3, 3, 3), (5, 5, 5), backend="other")


def test_canonicalize(spark):
    a = np.arange(64, dtype=float).reshape(4, 4, 4)
    got = grid.canonicalize(cube(spark, a), (4, 4, 4), (0.5, 1.0, 2.0), 1.0)
    assert got.shape == (8, 8, 8) and got.lineage["resampled_shape_zyx"] == (8, 4, 2)
    v = array(got.voxels, got.shape)
    assert v.min() == 0.0 and v.max() == 1.0 and not np.isnan(v).any()
    assert grid.canonicalize(cube(spark, a), (4, 4, 4), (0.5, 1.0, 2.0), None, None, False).shape == (4, 4, 4)


def test_padding_values(spark):
    a = np.arange(2, 10, dtype=float).reshape(2, 2, 2)
    for kw, fill in (({}, 0.0), ({"mode": "min"}, 2.0), ({"value": -5.0}, -5.0)):
        v = array(grid.pad_to_cube(cube(spark, a), (2, 2, 2), 5, **kw), (5, 5, 5))
        assert v[0, 0, 0] == fill and np.array_equal(v[1:3, 1:3, 1:3], a)


def test_tiles(spark):
    assert grid.tile_starts(10, 4, 4) == [0, 4, 6] and grid.tile_starts(10, 2, 5) == [0, 5, 8] and grid.tile_starts(3, 4, 4) == [0]
    names = [t[0] for t in grid.tiles((4, 4, 4), (2, 2, 2))]
    assert len(names) == 8 and names[0] == "tile_z0000_y0000_x0000"
    v = fields.ramp_volume(spark)
    got = grid.split_tiles(v, (4, 4, 4), (2, 2, 2))
    assert got.count() == 64 and got.groupBy("tile_name").count().where("count = 8").count() == 8
    assert grid.split_tiles(v, (4, 4, 4), (3, 3, 3), pad=True).groupBy("tile_name").count().where("count = 27").count() == 8
    assert grid.needs_tiles((4, 4, 4), (2, 2, 2)) and not grid.needs_tiles((4, 4, 4), (2, 2, 2), max_voxels=100)


def test_opacity_sampling(spark):
    a = np.zeros((2, 2, 2))
    a[0, 0, 0], a[1, 1, 1] = 1.0, 0.5
    rgba = cube(spark, a).select("volume_id", F.lit("T").alias("tf_name"), "z", "y", "x", *[F.col("v").alias(c) for c in "rgba"])
    assert sampling.opacity(rgba, 5).count() == 2  # all that have weight
    assert sampling.opacity(rgba.withColumn("a", F.lit(0.0)), 5).count() == 5  # none has: all alike
    with pytest.raises(ValueError):
        sampling.opacity(rgba, 5, strict=True)
    assert sampling.opacity_with_replacement(rgba, 30).count() == 30
    same = [tuple(r) for r in sampling.opacity(rgba, 1, 3).select("z", "y", "x").collect()]
    assert same == [tuple(r) for r in sampling.opacity(rgba, 1, 3).select("z", "y", "x").collect()]


def test_uniform(spark):
    assert sampling.uniform(cube(spark, np.zeros((10, 10, 10))), (10, 10, 10), 50).where("v = 0").count() == 50
    assert sampling.even_indices(10, 4) == [0, 3, 6, 9] and sampling.even_indices(3, 5) == [0, 1, 2]


@pytest.mark.parametrize("shape", [(4, 4, 4), (5, 4, 3)])
def test_haar_energy(spark, shape):
    a = np.random.default_rng(3).normal(size=shape)
    co = wavelet.transform(cube(spark, a), shape, 1)
    want = a
    for ax, n in enumerate(shape):
        if n % 2:
            want = np.concatenate([want, np.take(want, [0], ax)], ax)
    assert math.isclose(co.select(F.sum(F.col("c") ** 2)).first()[0], (want**2).sum(), rel_tol=1e-9)


def test_wavelet_sample(spark):
    got = wavelet.sample(fields.gaussian_volume(spark, 16, 16.0), (16, 16, 16), 300, 2)
    assert got.count() == 300 and set(got.columns) >= {"coeff_abs", "level"}
    rgba = transfer.bake(fields.ramp_volume(spark), [transfer.TransferFunction("T", ((0, 0, 0, 0, 0), (64, 1, 1, 1, 1)))])
    assert wavelet.transform_rgba(rgba, (4, 4, 4), 2).count() == 64


def test_wavelet_sampler_takes_rgba(spark):
    from lumengrid.plans import pipeline

    tfs = [transfer.TransferFunction(n, ((0, 0, 0, 0, 0), (64, *top))) for n, top in (("T", (1, 0.5, 0.25, 1)), ("U", (1, 1, 1, 0)))]
    v = fields.ramp_volume(spark)
    s = pipeline.State(v, (4, 4, 4), tfs=tfs, rgba=transfer.bake(v, tfs))
    got = pipeline.find("sampler", "wavelet")(s, {"n_points": 8, "k_min": 1, "centered": True}).toPandas()
    assert set(got["tf_name"]) == {"T", "U"} and (got.groupby("tf_name").size() <= 8).all()
    for t in got.itertuples():
        at = lambda c: int(min(max(np.round(c), 0), 3))
        value = (at(t.z) * 16 + at(t.y) * 4 + at(t.x)) / 64
        assert np.allclose([t.red, t.green, t.blue, t.alpha], np.multiply(value, tfs["TU".index(t.tf_name)].points[1][1:]))
    # The largest coefficient is the mean of the last block, in the norm over the channels.
    block = np.arange(64).reshape(4, 4, 4)[2:, 2:, 2:].sum() * wavelet.SCALE / 64
    top = got.groupby("tf_name")["coeff_abs"].max()
    assert math.isclose(top["T"], block * math.sqrt(2.3125), rel_tol=1e-9) and math.isclose(top["U"], block * math.sqrt(3), rel_tol=1e-9)
    sizes = wavelet.budgets(wavelet.transform_rgba(s.rgba, (4, 4, 4), 1), 8, by=("volume_id", "tf_name"), channels=4)
    assert {r["size"] for r in sizes.collect()} == {32}


def test_geometry_round_trip(spark):
    g = geometry.Geometry((0.5, 2.0, 3.0), (1.0, 2.0, 3.0), ((0.0, -1.0, 0.0), (1.0, 0.0, 0.0), (0.0, 0.0, 1.0)))
    df = geometry.world_to_index(geometry.index_to_world(fields.ramp_volume(spark), g), g)
    assert df.where("abs(ix - x) + abs(iy - y) + abs(iz - z) > 1e-9").count() == 0
    affine = [[g.direction[r][k] * g.spacing[k] for k in range(3)] + [g.origin[r]] for r in range(3)]
    assert geometry.Geometry.from_affine(affine) == g


def test_cameras(spark):
    c = camera.camera_to_world(camera.fibonacci(spark, 20, (1.0, 2.0, 3.0), 5.0)).toPandas()
    for r in c.to_dict("records"):
        m = np.array([[r[f"m{i}{k}"] for k in range(3)] for i in range(3)])
        assert np.allclose(m.T @ m, np.eye(3), atol=1e-9)
        assert np.allclose([r["ex"] - 5 * m[0, 2], r["ey"] - 5 * m[1, 2], r["ez"] - 5 * m[2, 2]], [1.0, 2.0, 3.0])


def test_splits(spark):
    assert camera.split_sizes(10, 20, 5) == (10, 0) and camera.split_sizes(10, 8, 5) == (8, 2) and camera.split_sizes(10, -1, -1) == (0, 0)
    ids = spark.range(10).withColumnRenamed("id", "pose_id")
    assert camera.split_frames(ids, 10, 3, 2, "interleave").where("split = 'test'").count() == 3


def test_verdicts(spark):
    px = [("TF01", "train", "f", r, c, 1.0 if c < 8 else 0.0) for r in range(16) for c in range(16)] + [("TF02", "train", "f", r, c, 0.0) for r in range(16) for c in range(16)]
    px = spark.createDataFrame(px, "tf_name string, split string, frame string, row int, col int, gray double")
    names = spark.createDataFrame([("TF01",), ("TF02",), ("TF03",)], "tf_name string")
    got = {r.tf_name: (r.status, r.reasons) for r in qc.verdict(names, qc.tf_metrics(qc.frame_metrics(px))).collect()}
    assert got == {"TF01": ("pass", []), "TF02": ("fail", ["too_sparse", "too_dark", "low_contrast"]), "TF03": ("fail", ["no_images"])}
    tasks = spark.createDataFrame([(1, "TF01"), (2, "TF02"), (3, None)], "id int, tf_name string")
    v = qc.verdict(names, qc.tf_metrics(qc.frame_metrics(px)))
    assert {r.id for r in qc.keep_passed(tasks, v).collect()} == {1, 3}
    assert qc.keep_passed(tasks, v.where("tf_name <> 'TF01'")).count() == 0


def test_segmentation(spark):
    px = spark.createDataFrame([("TF01", "train", "f", r, c, float(c < 2), 0.0, 0.0, 1.0) for r in range(4) for c in range(4)], "tf_name string, split string, frame string, row int, col int, r double, g double, b double, a double")
    probs = render.segment(px, lambda image: image[0])
    v = qc.segmentation_verdict(qc.segmentation_frames(probs, 0.5, 0.1)).first()
    assert v.passed and v.detected_frames == 1
    assert render.resize(np.ones((4, 4, 3)), 2, 2).shape == (2, 2, 3)


def test_composite_opaque_front(spark):
    rgba = spark.createDataFrame([(0, "T", z, 0, 0, float(z == 0), float(z == 1), 0.0, 1.0) for z in range(2)], "volume_id long, tf_name string, z int, y int, x int, r double, g double, b double, a double")
    r = render.composite(rgba).first()
    assert (r.r, r.g, r.a) == pytest.approx((1.0, 0.0, 1.0))


def test_batches(spark):
    got = batch.assign_list([f"s{i:04d}" for i in range(205)], 100, True, 7)
    assert [got[i][1] for i in (0, 99, 100, 204)] == ["batch_0001", "batch_0001", "batch_0002", "batch_0003"]
    rows = batch.assign(spark.range(205).withColumnRenamed("id", "case_id"), 100, True, 7).groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in rows) == [5, 100, 100]


@pytest.mark.parametrize("shuffle", [True, False])
def test_batches_of_more_cases_than_are_sampled(spark, shuffle):
    """Every place is taken once and in order, whatever ranges another run of the plan would draw."""
    ids = [(i * 7919) % 30_011 for i in range(30_000)]
    cases = spark.createDataFrame([(i,) for i in ids], "case_id long").repartition(7)
    whole = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(whole, "false")  # small parts would become one
    try:
        got = sorted((r.batch_index, r.batch_case_index, r.case_id) for r in batch.assign(cases, 100, shuffle, 7).collect())
    finally:
        spark.conf.unset(whole)
    want = sorted(ids, key=lambda i: (hashlib.md5(f"7:{i}".encode()).hexdigest(), i) if shuffle else i)
    assert got == [(i // 100 + 1, i % 100 + 1, c) for i, c in enumerate(want)]


def test_small_parsers():
    from lumengrid.functions import text

    assert text.vec3("1, 2 3", (0, 0, 0)) == (1.0, 2.0, 3.0) and text.vec3("1 2", (0, 1, 0)) == (0, 1, 0)
    assert text.safe_name(" A / b(c) ") == "A_b_c" and text.safe_name("//") == "cmap"
    assert text.has_sha256(b"", "E3B0C44298FC1C149AFBF4C8996FB92427AE41E4649B934CA495991B7852B855") and not text.has_sha256(b"a", "00")
    pts = transfer.grouped_points([1, 2], [0.0, 0.5, 1.0], 0.0, 1.0)
    assert pts == sorted(pts, key=lambda p: p[0])
