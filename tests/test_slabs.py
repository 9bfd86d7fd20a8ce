"""Volume files read slab by slab."""

import base64
import gzip
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumengrid.operators.geometry import Geometry
from lumengrid.sources import codecs, readers, slabs

GEO = Geometry((0.5, 1.0, 2.0), (1.0, 2.0, 3.0))
A = np.random.default_rng(2).normal(size=(12, 5, 7)).astype(np.float32)


def array(df, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        assert np.isnan(out[r["z"], r["y"], r["x"]])
        out[r["z"], r["y"], r["x"]] = r["v"]
    return out


def nifti(values, order="<", code=16, slope=1.0, inter=0.0):
    """A header by hand, in either byte order."""
    head = bytearray(352)
    struct.pack_into(f"{order}i", head, 0, 348)
    struct.pack_into(f"{order}8h", head, 40, 3, *values.shape[::-1], 1, 1, 1, 1)
    struct.pack_into(f"{order}2h", head, 70, code, values.dtype.itemsize * 8)
    struct.pack_into(f"{order}8f", head, 76, 1, 0.5, 1.0, 2.0, 0, 0, 0, 0)
    struct.pack_into(f"{order}3f", head, 108, 352, slope, inter)
    return bytes(head) + values.astype(values.dtype.newbyteorder(order)).tobytes()


FILES = {
    "plain.nii": ("nii", codecs.encode_nifti(codecs.Grid(A, GEO)), A), "zipped.nii.gz": ("nii", codecs.encode_nifti(codecs.Grid(A, GEO), True), A),
    "scaled.nii": ("nii", nifti((A * 50).astype(np.int16), ">", 4, 0.5, 3.0), (A * 50).astype(np.int16) * np.float32(0.5) + np.float32(3.0)),
    "plain.vti": ("vti", codecs.encode_vti(codecs.Grid(A, GEO)), A),
    "inline.vti": ("vti", codecs.encode_vti(codecs.Grid(A, GEO)).split(b"<AppendedData")[0].replace(b'format="appended" offset="0"/>', b'format="binary">' + base64.b64encode(struct.pack("<Q", A.nbytes) + A.tobytes()) + b"</DataArray>") + b"</VTKFile>", A),
}


@pytest.mark.parametrize("name", FILES)
def test_files(spark, tmp_path, name):
    kind, body, want = FILES[name]
    (tmp_path / name).write_bytes(body)
    got = array(readers.read_volumes(spark, str(tmp_path), kind, slab=5), A.shape)
    assert np.array_equal(got.astype(np.float32), want)
    part = array(readers.read_volumes(spark, str(tmp_path), kind, slab=5, z=(4, 6)), A.shape)
    assert np.array_equal(part[4:7].astype(np.float32), want[4:7]) and np.isnan(part[:4]).all() and np.isnan(part[7:]).all()
    h = readers.read_headers(spark, str(tmp_path), kind).first()
    assert (h.nz, h.ny, h.nx) == A.shape and np.allclose(h.spacing, (0.5, 1.0, 2.0))


@pytest.mark.parametrize("order", ["zyx", "xyz"])
def test_raw_of_both_orders(spark, tmp_path, order):
    a = np.arange(12 * 5 * 7, dtype=">u2").reshape(12, 5, 7)
    (tmp_path / "a.raw").write_bytes(b"four" + (a if order == "zyx" else a.transpose(2, 1, 0)).tobytes())
    read = lambda **k: readers.read_raw(spark, str(tmp_path / "a.raw"), a.shape, endian=">", order=order, offset=4, **k)
    assert np.array_equal(array(read(slab=2), a.shape), a)
    part = array(read(slab=2, z=(3, 3)), a.shape)
    assert np.array_equal(part[3], a[3]) and np.isnan(part).sum() == 11 * 35
    with pytest.raises(Exception, match="expected"):
        readers.read_raw(spark, str(tmp_path / "a.raw"), (13, 5, 7), offset=4).collect()


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    """More than 2 GB (sparse), of which a range of z opens one slab and the header nothing else."""
    shape = (300, 2048, 2048)
    path = tmp_path / "large.raw"
    with open(path, "wb") as f:
        f.truncate(int(np.prod(shape)) * 2)
        f.seek(2 * (200 * 2048 * 2048 + 5))
        f.write(struct.pack("<H", 77))
    plan = slabs.plan(spark, str(path), "raw", shape=shape)
    assert plan.count() == 150 and plan.where("hi - lo > 2").isEmpty()
    tasks = plan.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "lo").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1
    assert slabs.plan(spark, str(path), "raw", z=(200, 200), shape=shape).count() == 1
    got = readers.read_raw(spark, str(path), shape, slab=1, z=(200, 200)).where("v <> 0").collect()
    assert [(r.z, r.y, r.x, r.v) for r in got] == [(200, 0, 5, 77.0)]


def test_a_filter_on_z_reads_nothing_else(spark, tmp_path, monkeypatch):
    body = codecs.encode_nifti(codecs.Grid(A, GEO))
    (tmp_path / "v.nii").write_bytes(body)
    at = slabs.nifti_layout(body)
    broken = body[: at.offset + 6 * at.plane] + b"\xff" * (len(body) - at.offset - 6 * at.plane)  # NaNs from plane 6 on
    (tmp_path / "v.nii").write_bytes(broken)
    got = readers.read_volumes(spark, str(tmp_path), "nii", slab=3, z=(0, 5))
    assert np.array_equal(array(got, A.shape)[:6].astype(np.float32), A[:6])
    assert slabs.plan(spark, str(tmp_path), "nii", slab=3, z=(0, 5)).count() == 2


def test_paths_that_only_spark_opens(spark, tmp_path, monkeypatch):
    (tmp_path / "v.nii").write_bytes(codecs.encode_nifti(codecs.Grid(A, GEO)))
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.vol.link./in", f"file://{tmp_path}")
    path = "viewfs://vol/in"
    assert not slabs.can_open(path) and slabs.can_open("file:/a") and slabs.can_open("/a") and slabs.can_open("s3://b/a")
    got = readers.read_volumes(spark, path, "nii", z=(2, 4))
    assert np.array_equal(array(got, A.shape)[2:5].astype(np.float32), A[2:5]) and got.count() == 3 * 35
    assert readers.read_headers(spark, path, "nii").first().nz == 12


def vti(arrays):
    """An image of 2 x 3 x 2 points (x, y, z) with ascii arrays (association, name, components, values)."""
    part = lambda kind: "".join(f'<DataArray type="Float64" Name="{n}" NumberOfComponents="{c}" format="ascii">{" ".join(map(str, v))}</DataArray>' for k, n, c, v in arrays if k == kind)
    return f'<VTKFile type="ImageData"><ImageData WholeExtent="0 1 0 2 0 1" Spacing="1 1 1" Origin="0 0 0"><Piece Extent="0 1 0 2 0 1"><PointData Scalars="b">{part("point")}</PointData><CellData>{part("cell")}</CellData></Piece></ImageData></VTKFile>'.encode()


def test_choice_of_arrays(spark, tmp_path):
    points = [("point", "a", 1, range(12)), ("point", "b", 1, range(100, 112)), ("point", "w", 3, range(36)), ("cell", "c", 1, (5, 9))]
    body = vti(points)
    assert [codecs.decode_vti(body, n).meta["array"] for n in ("a", "b", "c", "none", None)] == ["a", "b", "c", "b", "b"]
    c = codecs.decode_vti(body, "c")
    assert c.meta["association"] == "cell" and c.values[0, :, 0].tolist() == [5, 7, 9] and c.values.shape == (2, 3, 2)
    w = codecs.decode_vti(body, "w", magnitude=True).values
    assert np.allclose(w.ravel()[1], (3**2 + 4**2 + 5**2) ** 0.5)
    assert codecs.decode_vti(vti(points[3:])).meta["array"] == "c"
    with pytest.raises(ValueError):
        codecs.decode_vti(vti([]))
    (tmp_path / "v.vti").write_bytes(body)
    got = array(readers.read_volumes(spark, str(tmp_path), "vti", array="c"), (2, 3, 2))
    assert np.array_equal(got, c.values)


def test_many_files_and_unknown_kinds(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.nii").write_bytes(codecs.encode_nifti(codecs.Grid(A + i, GEO)))
        (tmp_path / f"{i}.nii.gz").write_bytes(gzip.compress(codecs.encode_nifti(codecs.Grid(A + i, GEO))))
    got = readers.read_volumes(spark, str(tmp_path), "nii", slab=4).groupBy("volume_id").agg(F.count("*").alias("n"), F.min("v").alias("lo")).collect()
    assert len(got) == 10 and {r.n for r in got} == {A.size}
    assert np.allclose(sorted(r.lo for r in got), sorted([float(A.min()) + i for i in range(5)] * 2), atol=1e-5)
    with pytest.raises(ValueError):
        readers.read_volumes(spark, str(tmp_path), "dcm")
