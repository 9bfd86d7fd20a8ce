import gzip
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumengrid.operators.geometry import Geometry
from lumengrid.plans import config, pipeline
from lumengrid.sources import codecs, listing, readers, sinks
from lumengrid.streaming import cases as streams


def grid():
    return codecs.Grid(np.arange(24, dtype=np.float32).reshape(2, 3, 4), Geometry((0.5, 1.0, 2.0), (1.0, 2.0, 3.0)))


def test_vti_round_trip():
    got = codecs.decode_vti(codecs.encode_vti(grid()))
    assert np.array_equal(got.values, grid().values) and got.geometry == grid().geometry
    with pytest.raises(ValueError):
        codecs.encode_vti(codecs.Grid(np.zeros((4, 2, 2, 2))))


@pytest.mark.parametrize("zipped", [False, True])
def test_nifti_round_trip(zipped):
    body = codecs.encode_nifti(grid(), zipped)
    got = codecs.decode_nifti(body)
    assert np.array_equal(got.values, grid().values)
    assert np.allclose(got.geometry.spacing, (0.5, 1.0, 2.0)) and np.allclose(got.geometry.origin, (1.0, 2.0, 3.0))
    if zipped:
        assert gzip.decompress(body)[:4] == b"\x5c\x01\0\0"


def test_png_round_trip():
    px = np.random.default_rng(0).integers(0, 256, (7, 5, 4)).astype(np.uint8)
    assert np.array_equal(codecs.decode_png(codecs.encode_png(px)), px)
    assert codecs.unit_scale(np.ones((1, 1, 4), np.uint8)).max() == 1.0


def test_raw(spark, tmp_path):
    a = np.arange(60, dtype=">u2").reshape(3, 4, 5)
    (tmp_path / "a.raw").write_bytes(b"head" + a.tobytes())
    got = readers.read_raw(spark, str(tmp_path / "a.raw"), (3, 4, 5), endian=">", offset=4, slab=2)
    assert got.count() == 60 and got.where(F.col("v") != (F.col("z") * 4 + F.col("y")) * 5 + F.col("x")).count() == 0
    (tmp_path / "b.raw").write_bytes(a.transpose(2, 1, 0).tobytes())
    other = readers.read_raw(spark, str(tmp_path / "b.raw"), (3, 4, 5), endian=">", order="xyz")
    assert other.where(F.col("v") != (F.col("z") * 4 + F.col("y")) * 5 + F.col("x")).count() == 0
    with pytest.raises(ValueError):
        codecs.decode_raw(b"1234", (3, 4, 5))
    with pytest.raises(ValueError):
        codecs.parse_direction([1, 2])


def test_volumes_and_headers(spark, tmp_path):
    (tmp_path / "v.vti").write_bytes(codecs.encode_vti(grid()))
    assert readers.read_volumes(spark, str(tmp_path), "vti").agg(F.sum("v")).first()[0] == 276.0
    h = readers.read_headers(spark, str(tmp_path), "vti").first()
    assert (h.nz, h.ny, h.nx) == (2, 3, 4) and readers.geometry_of(h) == grid().geometry
    cells = readers.cell_to_point(readers.read_volumes(spark, str(tmp_path), "vti"))
    assert cells.count() == 3 * 4 * 5


def test_points_files(spark, tmp_path):
    pts = spark.createDataFrame([(0.0, 1.0, 2.0, [0.1, 0.2], 5, "a")], "x double, y double, z double, rgb array<double>, k int, name string")
    assert sinks.write_ply(pts, str(tmp_path / "p.ply")) == 1
    lines = (tmp_path / "p.ply").read_text().splitlines()
    assert [x for x in lines if x.startswith("property")] == [f"property float {c}" for c in ("x", "y", "z", "k", "rgb_0", "rgb_1")]
    assert lines[-1] == "0.000000 1.000000 2.000000 5.000000 0.100000 0.200000"
    sinks.write_npz(pts, str(tmp_path / "p.npz"))
    with np.load(tmp_path / "p.npz") as z:
        assert z["xyz"].shape == (1, 3) and z["rgb"].shape == (1, 2) and "name" not in z


def test_cases(spark, tmp_path):
    for name in ("s0001", "s0002", "s0003"):
        (tmp_path / name).mkdir()
    (tmp_path / "s0001" / "ct.nii.gz").write_bytes(b"")
    (tmp_path / "s0002" / "other.nii.gz").write_bytes(b"")
    (tmp_path / "s0002" / "ct.nii").write_bytes(b"")
    got = listing.cases(spark, str(tmp_path), "nii")
    assert [(c["case_id"], c["input_name"], c["input_stem"]) for c in got] == [("s0001", "ct.nii.gz", "ct"), ("s0002", "ct.nii", "ct")]
    assert got[0]["input_path"] == str(tmp_path / "s0001" / "ct.nii.gz") and got[0]["case_dir"] == str(tmp_path / "s0001")
    (tmp_path / "s0003" / "b.nii").write_bytes(b"")
    (tmp_path / "s0003" / "a.nii").write_bytes(b"")
    assert [c["input_name"] for c in listing.cases(spark, str(tmp_path), "nii", "s0003")] == ["a.nii"]
    assert [c["case_id"] for c in listing.cases(spark, str(tmp_path), "nii", filename="other.nii.gz")] == ["s0002"]
    assert listing.cases(spark, str(tmp_path), "vti") == [] and listing.cases(spark, str(tmp_path), "nii", "t*") == []
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.cases.link./in", f"file://{tmp_path}")
    assert [c["input_path"] for c in listing.cases(spark, "viewfs://cases/in", "nii", "s0001")] == ["viewfs://cases/in/s0001/ct.nii.gz"]


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("io: {reader: vti, path: a}\nsampling: {name: uniform}\n")
    assert config.parse(config.load(str(tmp_path / "c.yaml"))).sampling.name == "uniform"
    with pytest.raises(config.ConfigError):
        config.parse({"io": {"reader": "vti", "path": "a"}})
    with pytest.raises(config.ConfigError):
        config.load(str(tmp_path / "none.json"))
    assert config.tiling({"tile_size": 4})["stride"] == (4, 4, 4)
    with pytest.raises(config.ConfigError):
        config.tiling({"tiling": {"enabled": True}})
    assert config.fill({"a": ["{x}/{y}"]}, {"x": 1}) == {"a": ["1/{y}"]}
    assert config.flags({"a": None, "b": True, "c": False, "d": [1, 2]}) == ["--b", "--d", "1,2"]


TF = [{"data_range": [0, 1], "control_points": [[0, 0, 0, 0, 0], [1, 1, 1, 1, 1]]}]


def document(tmp_path, **more):
    a = np.random.default_rng(0).random((6, 6, 6)).astype(np.float32)
    (tmp_path / "v.vti").write_bytes(codecs.encode_vti(codecs.Grid(a)))
    return {"io": {"reader": "vti", "path": str(tmp_path / "v.vti")}, "preprocess": [{"name": "normalize"}], "sampling": {"name": "uniform", "params": {"n_points": 10}}, "export": {"name": "ply", "path": str(tmp_path / "out")}, **more}


def vertices(path):
    return int(next(x for x in open(path) if x.startswith("element")).split()[-1])


def test_run_to_folder(spark, tmp_path):
    (r,) = pipeline.run(spark, document(tmp_path))
    assert r["outputs"] == [str(tmp_path / "out" / "points.ply")] and vertices(r["outputs"][0]) == 10


def test_run_many_tfs(spark, tmp_path):
    for k in (1, 2):
        (tmp_path / "tfs" / f"TF0{k}").mkdir(parents=True)
        (tmp_path / "tfs" / f"TF0{k}" / "tf_config.json").write_text(json.dumps(TF[0]))
    doc = document(tmp_path, sampling={"name": "opacity", "params": {"n_points": 7}}, render={"name": "composite", "params": {"tf_dir": str(tmp_path / "tfs")}, "qc": {"thresholds": {"mean": 0.0}, "report": str(tmp_path / "qc.json")}})
    (r,) = pipeline.run(spark, doc)
    assert r["outputs"] == [str(tmp_path / "out" / f"TF0{k}" / "points.ply") for k in (1, 2)] and all(vertices(p) == 7 for p in r["outputs"])
    assert json.loads((tmp_path / "qc.json").read_text())["passed"] == 2
    doc["render"]["qc"]["thresholds"]["mean"] = 2.0  # none passes: no task is left
    assert pipeline.run(spark, doc)[0]["outputs"] == []


def test_run_opacity_density_is_the_scalar(spark, tmp_path):
    points = [[0, 0, 0, 0, 0.2], [1, 1, 1, 1, 0.8]]
    doc = document(tmp_path, sampling={"name": "opacity", "params": {"n_points": 9, "points": points}})
    (r,) = pipeline.run(spark, doc)
    got = r["points"].collect()
    assert len(got) == 9 and all(abs(p.opacity - (0.2 + 0.6 * p.density)) < 1e-9 for p in got)
    doc["preprocess"].append({"name": "tf", "params": {"points": points, "premultiply_alpha": False}})
    got = pipeline.run(spark, doc)[0]["points"].collect()
    assert all(p.density == p.opacity and abs(p.rgb[0] - (p.opacity - 0.2) / 0.6) < 1e-9 for p in got)
    doc["preprocess"][-1]["params"]["premultiply_alpha"] = True
    got = pipeline.run(spark, doc)[0]["points"].collect()
    assert all(abs(p.rgb[0] - p.opacity * (p.opacity - 0.2) / 0.6) < 1e-9 for p in got)
    drawn = pipeline.sample_canonical(spark, doc["io"]["path"], {"n_points": 9, "points": points})
    assert drawn.count() == 9 and set(drawn.columns) >= {"density", "opacity", "rgba"}


def test_check_samples_and_segments(spark):
    frames = spark.range(20).select(F.lit("TF01").alias("tf_name"), F.when(F.col("id") < 15, "train").otherwise("test").alias("split"), F.format_string("%02d", "id").alias("frame"), F.explode(F.array(F.lit(0), F.lit(1))).alias("row"), F.lit(0).alias("col"), *[(F.col("id") / 20).alias(c) for c in "rgb"], F.lit(1.0).alias("a"))
    one = pipeline.check(spark, frames, ["TF01", "TF02"], {}).orderBy("tf_name").collect()
    order = [*range(15), *range(15, 20)]
    assert one[0].images == 12 and abs(one[0]["mean"] - np.mean([order[round(i * 19 / 11)] / 20 for i in range(12)])) < 1e-12
    assert one[1].reasons == ["no_images"] and one[1]["mean"] == 0.0
    assert pipeline.check(spark, frames, ["TF01"], {"sample_limit": 0}).first().images == 20
    pipeline.SEGMENTERS["bright"] = lambda cfg: lambda image: image[0]
    try:
        seg = {"enabled": True, "backend": "bright", "input_size": [4, 4], "in_channels": 4, "mask_threshold": 0.5}
        how = {"segmentation": seg, "min_intensity_std": 0.0}
        assert pipeline.check(spark, frames, ["TF01"], how).first().status == "pass"
        seg["min_detected_ratio"] = 0.9
        assert pipeline.check(spark, frames, ["TF01"], how).first().reasons == ["segmentation_failed"]
    finally:
        del pipeline.SEGMENTERS["bright"]
    with pytest.raises(KeyError):
        pipeline.check(spark, frames, ["TF01"], {"segmentation": {"enabled": True}})


def test_run_tiles(spark, tmp_path):
    doc = document(tmp_path)
    doc["io"]["tile_size"] = 4
    got = pipeline.run(spark, doc)
    assert len(got) == 8 and got[0]["outputs"][0].endswith("points__tile_z0000_y0000_x0000.ply") and got[-1]["tile_origin_index_xyz"] == (2, 2, 2)


def test_batch(spark, tmp_path):
    doc = document(tmp_path)
    for c in ("s0001", "s0002"):
        (tmp_path / "raw" / c).mkdir(parents=True)
        (tmp_path / "raw" / c / "volume.vti").write_bytes((tmp_path / "v.vti").read_bytes() if c == "s0001" else b"broken")
    doc["io"] = {"reader": "vti", "path": "{input_path}"}
    doc["export"]["path"] = str(tmp_path / "out" / "{case_id}.ply")
    got = pipeline.run_batch(spark, doc, str(tmp_path / "raw"), size=1, shuffle=False, report=str(tmp_path / "report.json"))
    assert (got["succeeded"], got["failed"], got["total_batches"]) == (1, 1, 2)
    assert (tmp_path / "out" / "s0001.ply").exists() and "s0002" in (tmp_path / "report.md").read_text()


def test_stream_matches_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "v.vti").write_bytes(codecs.encode_vti(grid()))
    s = streams.voxel_stream(spark, str(tmp_path / "in"), "vti")
    q = streams.running_ranges(s).writeStream.format("memory").queryName("ranges").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    r = spark.table("ranges").first()
    assert (r.lo, r.hi, r.n) == (0.0, 23.0, 24)
    streams.per_batch(s, lambda v: v, str(tmp_path / "sink"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "sink")).count() == 24


def test_transforms(spark, tmp_path):
    from lumengrid.functions.columns import intrinsics

    cams = pipeline.plan_cameras(spark, (0, 1, 0, 1, 0, 1), 12, test=3).withColumn("file_path", F.format_string("./%s/r_%04d", "split", "pose_id"))
    k = intrinsics(45, 800, 800)
    assert [p.rsplit("_", 1)[1] for p in sinks.write_transforms(cams, str(tmp_path), k, 800, 800)] == ["train.json", "test.json"]
    doc = json.loads(open(sinks.write_flat_scene(cams, str(tmp_path), "scene0001", k, 800, 800)).read())
    assert len(doc["frames"]) == 12 and "camera_angle_x" not in doc
