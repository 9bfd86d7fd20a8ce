"""Single files from many tasks: round trips, order, retries and failures."""

import struct
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumengrid.operators.geometry import Geometry
from lumengrid.sources import codecs, readers, sinks, writers


def points(spark, n=1000, parts=5):
    i = F.col("id")
    return spark.range(0, n, 1, parts).select((i * 0.5).alias("x"), (i + 1.0).alias("y"), F.lit(2.0).alias("z"), F.array(i * 1.0, i * 2.0).alias("rgb"), i.cast("int").alias("k"), (i % 2 == 0).alias("even"), F.lit("name").alias("name"))


def left_over(folder):
    return [p for p in Path(folder).rglob("*") if ".parts-" in str(p)]


def test_ply(spark, tmp_path):
    assert sinks.write_ply(points(spark), str(tmp_path / "d" / "p.ply")) == 1000
    lines = (tmp_path / "d" / "p.ply").read_text().splitlines()
    head = lines.index("end_header")
    assert lines[:3] == ["ply", "format ascii 1.0", "element vertex 1000"] and [x.split()[-1] for x in lines[3:head]] == ["x", "y", "z", "even", "k", "rgb_0", "rgb_1"]
    body = np.array([x.split() for x in lines[head + 1 :]], float)
    assert body.shape == (1000, 7) and np.array_equal(body[:, 4], np.arange(1000)) and np.array_equal(body[:, 0], np.arange(1000) / 2)
    assert not left_over(tmp_path)
    nulls = spark.createDataFrame([(1.0, None, 2.0)], "x double, y double, z double")
    sinks.write_ply(nulls, str(tmp_path / "n.ply"))
    assert (tmp_path / "n.ply").read_text().splitlines()[-1] == "1.000000 nan 2.000000"
    assert sinks.write_ply(points(spark).limit(0), str(tmp_path / "d" / "p.ply")) == 0  # replaces the first
    assert "element vertex 0" in (tmp_path / "d" / "p.ply").read_text()


def test_npz(spark, tmp_path):
    assert sinks.write_npz(points(spark), str(tmp_path / "p.npz")) == 1000
    with np.load(tmp_path / "p.npz") as z:
        assert sorted(z.files) == ["even", "k", "rgb", "xyz"]
        assert z["xyz"].dtype == np.float32 and np.array_equal(z["xyz"][:, 1], np.arange(1000) + 1) and np.array_equal(z["rgb"], np.stack([np.arange(1000), np.arange(1000) * 2.0], 1))
        assert z["k"].dtype == np.int32 and z["even"].dtype == bool and z["even"].sum() == 500
    assert not left_over(tmp_path)
    sinks.write_npz(points(spark).limit(0), str(tmp_path / "none.npz"))
    with np.load(tmp_path / "none.npz") as z:
        assert len(z["xyz"]) == 0 and len(z["k"]) == 0
    for bad in (points(spark).withColumn("rgb", F.when(F.col("k") == 700, F.array(F.lit(1.0))).otherwise(F.col("rgb"))), points(spark).withColumn("k", F.when(F.col("k") > 5, F.col("k")))):
        with pytest.raises(Exception, match="arrays of different lengths|nulls among"):
            sinks.write_npz(bad, str(tmp_path / "p.npz"))
    with np.load(tmp_path / "p.npz") as z:
        assert len(z["k"]) == 1000  # as it was


@pytest.mark.parametrize("dtype", ["float32", "uint16", "float64"])
def test_vti(spark, tmp_path, monkeypatch, dtype):
    monkeypatch.setattr(writers, "SLAB", 400)
    a = np.random.default_rng(1).integers(0, 60_000, (11, 5, 7)).astype(dtype)
    a[4:6] = 0
    cells = [(*map(int, c), float(a[c])) for c in np.ndindex(*a.shape) if a[c]]  # what is 0 has no row
    v = spark.createDataFrame(cells, "z int, y int, x int, v double").repartition(4)
    g = Geometry((0.5, 1.0, 2.0), (1.0, -2.0, 3.25), ((0.0, -1.0, 0.0), (1.0, 0.0, 0.0), (0.0, 0.0, 1.0)))
    sinks.write_vti(v, a.shape, str(tmp_path / "v.vti"), g, dtype=dtype)
    got = codecs.decode_vti((tmp_path / "v.vti").read_bytes())
    assert np.array_equal(got.values, a) and got.geometry == g and got.meta["original_dtype"] == np.dtype(dtype).str[1:]
    back = readers.read_volumes(spark, str(tmp_path / "v.vti"), "vti", slab=2)
    assert back.count() == a.size and back.agg(F.sum("v")).first()[0] == float(a.astype(float).sum())
    assert not left_over(tmp_path)


def test_tasks_that_fail_and_are_run_again(tmp_path):
    """Parts of a try that was not reported don't count, and a failed write leaves the target alone."""
    (tmp_path / "p.ply").write_text("before")
    w = writers.PlyWriter({"path": str(tmp_path / "p.ply"), "columns": "x"})
    folder = Path(writers.system(w.folder)[1])
    folder.mkdir()
    for name, text in (("lost", "9.000000\n"), ("one", "1.000000\n"), ("two", "2.000000\n")):
        (folder / name).write_text(text)
    w.commit([writers.Parts([(0, 1, "", str(folder / "two"), 1)]), None, writers.Parts([(0, 0, "", str(folder / "one"), 1)])])
    assert (tmp_path / "p.ply").read_text().splitlines()[-2:] == ["1.000000", "2.000000"] and "element vertex 2" in (tmp_path / "p.ply").read_text()
    other = writers.PlyWriter({"path": str(tmp_path / "p.ply"), "columns": "x"})
    Path(writers.system(other.folder)[1]).mkdir()
    other.abort([])
    assert "element vertex 2" in (tmp_path / "p.ply").read_text() and not left_over(tmp_path)


def test_frames(spark, tmp_path):
    px = spark.range(3 * 4 * 5).select(F.lit("TF01").alias("tf_name"), F.lit("train").alias("split"), (F.col("id") / 20).cast("int").alias("frame"), (F.col("id") / 5 % 4).cast("int").alias("row"), (F.col("id") % 5).cast("int").alias("col"), (F.col("id") / 59.0).alias("r"), F.lit(0.5).alias("g"), F.lit(1.5).alias("b"), F.lit(1.0).alias("a"))
    done = sinks.write_frames(px.repartition(3), f"file://{tmp_path}/frames").collect()
    assert {(r["width"], r["height"]) for r in done} == {(5, 4)} and len(done) == 3
    back = codecs.decode_png((tmp_path / "frames" / "TF01" / "train" / "1.png").read_bytes())
    assert back.shape == (4, 5, 4) and back[0, 0].tolist() == [round(20 / 59 * 255), 128, 255, 255]
    again = readers.read_pixels(spark, str(tmp_path / "frames"))
    assert again.count() == 60 and again.select("tf_name", "split", "frame").distinct().count() == 3


def test_head_of_images():
    head, tail = codecs.vti_frame((2, 3, 4), "<f4", Geometry())
    assert head.endswith(b"_" + struct.pack("<Q", 96)) and tail.strip().endswith(b"</VTKFile>")


def test_many_files_in_one_write(spark, tmp_path):
    df = points(spark, 100).withColumn("volume_id", F.when(F.col("k") % 3 == 0, "a").when(F.col("k") % 3 == 1, "b")).withColumn("tf_name", F.lit(None).cast("string"))
    files = [("a", None, str(tmp_path / "one" / "p.ply")), (None, None, str(tmp_path / "two" / "p.ply")), ("c", None, str(tmp_path / "none.ply"))]
    rows, paths = sinks.numbered(df, files, ("volume_id", "tf_name"))
    assert sinks.write_ply(rows.drop("volume_id", "tf_name"), paths, F.col("_file")) == 34 + 33
    count = lambda p: int(next(x for x in open(p) if x.startswith("element")).split()[-1])
    assert [count(p) for p in paths] == [34, 33, 0] and not left_over(tmp_path)
    sinks.write_npz(rows.drop("volume_id", "tf_name"), [p.replace(".ply", ".npz") for p in paths], F.col("_file"))
    with np.load(tmp_path / "two" / "p.npz") as z:
        assert np.array_equal(np.sort(z["k"]), np.arange(2, 100, 3)) and "_file" not in z.files
