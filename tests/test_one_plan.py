"""Tiles and cases in one plan: the same as one by one, jobs that don't grow with them, errors that stay where they are."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumengrid.operators.geometry import Geometry
from lumengrid.plans import pipeline
from lumengrid.sources import codecs

POINTS = [[0.0, 0.1, 0.2, 0.3, 0.1], [1.0, 0.9, 0.8, 0.7, 0.9]]


def write(path, seed=0, shape=(6, 6, 6), origin=(0.0, 0.0, 0.0)):
    path.parent.mkdir(parents=True, exist_ok=True)
    a = np.random.default_rng(seed).random(shape).astype(np.float32)
    path.write_bytes(codecs.encode_vti(codecs.Grid(a, Geometry((0.5, 1.0, 2.0), origin))))
    return a


def document(tmp_path, **more):
    return {
        "io": {"reader": "vti", "path": "{input_path}"}, "preprocess": [{"name": "normalize"}], "sampling": {"name": "opacity", "params": {"n_points": 7}},
        "render": {"name": "composite", "params": {"points": POINTS}, "qc": {"thresholds": {"mean": 0.0}, "report": str(tmp_path / "out" / "{case_id}-qc.json")}},
        "export": {"name": "ply", "path": str(tmp_path / "out" / "{case_id}.ply")}, **more,
    }


def jobs(spark, name, f):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        out = f()
        return out, len(sc.statusTracker().getJobIdsForGroup(name))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def vertices(path):
    lines = open(path).read().splitlines()
    return np.array([x.split() for x in lines[lines.index("end_header") + 1 :]], float)


def test_cases_share_plans(spark, tmp_path):
    took = {}
    for n in (2, 6):
        root = tmp_path / f"raw{n}"
        for k in range(n):
            write(root / f"s{k:03d}" / "volume.vti", k, origin=(10.0 * k, 0.0, -5.0 * k))
        doc = document(tmp_path / f"n{n}")
        got, took[n] = jobs(spark, f"cases{n}", lambda: pipeline.run_batch(spark, doc, str(root), shuffle=False))
        assert (got["succeeded"], got["failed"]) == (n, 0)
        for k, c in enumerate(got["cases"]):
            assert c["outputs"] == [str(tmp_path / f"n{n}" / "out" / f"s{k:03d}.ply")] and len(vertices(c["outputs"][0])) == 7
            assert json.loads((tmp_path / f"n{n}" / "out" / f"s{k:03d}-qc.json").read_text())["passed"] == 1
    assert took[6] <= took[2] + 12  # adaptive plans differ by some


def test_a_case_alone_is_the_case_among_others(spark, tmp_path):
    root = tmp_path / "raw"
    for k in range(3):
        write(root / f"s{k}" / "volume.vti", k, origin=(10.0 * k, 1.0, -5.0))
    doc = document(tmp_path)
    doc.pop("render")
    doc["sampling"]["params"]["points"] = POINTS
    pipeline.run_batch(spark, doc, str(root), shuffle=False)
    together = vertices(tmp_path / "out" / "s2.ply")
    pipeline.run_batch(spark, doc, str(root), shuffle=False, pattern="s2")
    assert np.allclose(np.sort(together, axis=0), np.sort(vertices(tmp_path / "out" / "s2.ply"), axis=0))
    assert 20 <= together[:, 0].min() and together[:, 0].max() <= 20 + 5 * 0.5  # its own place in the world


def test_failing_cases_leave_the_others(spark, tmp_path):
    root = tmp_path / "raw"
    for k in range(3):
        write(root / f"s{k}" / "volume.vti", k)
    write(root / "s3" / "volume.vti", 3, shape=(4, 5, 6))  # a plan of its own
    (root / "s4").mkdir()
    (root / "s4" / "volume.vti").write_bytes(b"broken")
    whole = (root / "s1" / "volume.vti").read_bytes()
    doc = document(tmp_path)
    got = pipeline.run_batch(spark, doc, str(root), shuffle=False, report=str(tmp_path / "r.json"))
    assert {c["case_id"]: c["status"] for c in got["cases"]} == {"s0": "succeeded", "s1": "succeeded", "s2": "succeeded", "s3": "succeeded", "s4": "failed"}
    # Fails as it is read, after its header: the plan's cases are tried one by one.
    (root / "s1" / "volume.vti").write_bytes(whole[: whole.index(b"_") + 9] + whole[whole.index(b"_") + 200 :])
    got = pipeline.run_batch(spark, doc, str(root), shuffle=False)
    assert {c["case_id"] for c in got["cases"] if c["status"] == "failed"} == {"s1", "s4"} and all(c["error"] for c in got["cases"] if c["status"] == "failed")
    with pytest.raises(Exception, match="."):
        pipeline.run_batch(spark, doc, str(root), shuffle=False, stop_on_error=True)
    assert pipeline.run_batch(spark, {"io": {"reader": "vti", "path": "{input_path}"}}, str(root))["failed"] == 5  # a document that can't be read


def test_tiles_are_one_plan(spark, tmp_path):
    write(tmp_path / "v.vti", 1, shape=(8, 8, 8), origin=(1.0, 2.0, 3.0))
    took = {}
    for size in (4, 2):
        doc = document(tmp_path)
        doc["io"] = {"reader": "vti", "path": str(tmp_path / "v.vti"), "tile_size": size}
        doc["export"]["path"] = str(tmp_path / f"t{size}" / "p.ply")
        doc["render"]["qc"]["report"] = str(tmp_path / f"t{size}" / "qc.json")
        got, took[size] = jobs(spark, f"tiles{size}", lambda: pipeline.run(spark, doc))
        assert len(got) == (8 // size) ** 3
        for r in got:
            assert len(vertices(r["outputs"][0])) == 7 and r["points"].count() == 7
            assert (tmp_path / f"t{size}" / f"qc__{r['tile']}.json").exists()
    assert took[2] <= took[4] + 12  # 64 tiles and 8


def test_tiles_with_canonical_files(spark, tmp_path):
    a = write(tmp_path / "v.vti", 1, shape=(4, 4, 4), origin=(1.0, 2.0, 3.0))
    doc = {
        "io": {"reader": "vti", "path": str(tmp_path / "v.vti"), "tile_size": 2}, "preprocess": [{"name": "canonicalize", "params": {"target_spacing": None, "normalise": None, "vti_path": str(tmp_path / "c.vti")}}],
        "sampling": {"name": "uniform", "params": {"n_points": 3}},
    }
    got = pipeline.run(spark, doc)
    for r in got:
        x, y, z = r["tile_origin_index_xyz"]
        back = codecs.decode_vti(open(r["canonical_vti_path"], "rb").read())
        assert np.allclose(back.values, a[z : z + 2, y : y + 2, x : x + 2]) and back.geometry == Geometry()


def test_uniform_points_lie_in_their_tiles(spark, tmp_path):
    write(tmp_path / "v.vti", 1, shape=(4, 4, 4), origin=(1.0, 2.0, 3.0))
    got = pipeline.run(spark, {"io": {"reader": "vti", "path": str(tmp_path / "v.vti"), "tile_size": 2}, "sampling": {"name": "uniform", "params": {"n_points": 50}}})
    for r in got:
        low = [o + s * i for o, s, i in zip((1.0, 2.0, 3.0), (0.5, 1.0, 2.0), r["tile_origin_index_xyz"], strict=True)]
        ends = r["points"].agg(*[f(c) for c in "xyz" for f in (F.min, F.max)]).first()
        for i, s in enumerate((0.5, 1.0, 2.0)):
            assert low[i] <= ends[2 * i] and ends[2 * i + 1] <= low[i] + s
