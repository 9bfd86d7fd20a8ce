"""Volume files as voxels, cut into slabs: a task reads the bytes of its own.

Spark lists the files (without their contents), tasks read their headers, and a slab of the slowest axis becomes a row of a plan that is dealt over
the tasks. A filter on z drops slabs before anything of them is read. A header costs HEAD bytes, a slab SLAB bytes of memory, whatever the file's size.

Files that can't be cut (gzip, base64 or compressed VTK data) are decoded whole by the task that gets them. Where Python can't open a path that
Spark can (a scheme that pyarrow doesn't know), contents come through Spark's `binaryFile`, whole, up to its 2 GB.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.geometry import Geometry
from . import codecs

VOXELS = "volume_id string, z int, y int, x int, v double"
HEAD, SLAB = 1 << 20, 16 << 20
#: Schemes that tasks can open themselves.
SCHEMES = ("", "file", "s3", "gs")
PLAN = "path string, lo int, hi int, layout string"


@dataclass
class Layout:
    """Where the numbers of a file are. axis: the slowest one, z or x. cut: whether a part of the bytes can be read by itself."""

    shape: tuple[int, int, int]
    dtype: str
    offset: int
    geometry: Geometry
    axis: str = "z"
    slope: float = 1.0
    inter: float = 0.0
    single: bool = False
    cut: bool = True

    def dumps(self) -> str:
        g = self.geometry
        return json.dumps({**self.__dict__, "geometry": [g.spacing, g.origin, g.direction]})

    @staticmethod
    def loads(text: str) -> Layout:
        d = json.loads(text)
        s, o, m = d.pop("geometry")
        return Layout(**{**d, "shape": tuple(d["shape"]), "geometry": Geometry(tuple(s), tuple(o), tuple(map(tuple, m)))})

    @property
    def side(self) -> int:
        return self.shape[0 if self.axis == "z" else 2]

    @property
    def plane(self) -> int:
        """Bytes of one cell of the slowest axis."""
        return int(np.prod(self.shape)) // max(self.side, 1) * np.dtype(self.dtype).itemsize


def opened(path: str):
    """A path as a file that can be read from any place."""
    if re.match(r"^(?!file:)[a-z][a-z0-9+.-]*://", path):
        from pyarrow import fs

        system, name = fs.FileSystem.from_uri(path)
        return system.open_input_file(name)
    return open(re.sub(r"^file:(//)?", "", path), "rb")


def nifti_layout(head: bytes, orientation: bool = True) -> Layout:
    h = codecs.nifti_header(head, orientation)
    return Layout(h.shape, h.order + codecs.NIFTI_TYPES[h.code], h.offset, h.geometry, slope=h.slope, inter=h.inter, single=True)


def vti_layout(head: bytes, array: str | None = None) -> Layout | None:
    """Of raw appended data without compression and one component; None for other files."""
    at = head.find(b"<AppendedData")
    if at < 0 or (mark := head.find(b"_", head.find(b">", at))) < 0 or b'"raw"' not in head[at:mark]:
        return None
    image = codecs.vti_header(head[:at] + b"</VTKFile>")
    a = image.choose(array)
    if image.compressed or a.association != "point" or a.components != 1 or a.format != "appended":
        return None
    return Layout(image.shape, image.order + codecs.VTK_TYPES[a.type], mark + 1 + a.offset + image.head_bytes, image.geometry)


def raw_layout(shape, dtype: str = "uint16", endian: str = "<", order: str = "zyx", offset: int = 0, geometry: Geometry | None = None) -> Layout:
    if shape is None or len(tuple(shape)) != 3:
        raise ValueError("shape needs three sizes: z, y, x")
    return Layout(tuple(map(int, shape)), np.dtype(dtype).newbyteorder(endian).str, int(offset), geometry or Geometry(), axis="z" if order == "zyx" else "x")


def layout(path: str, kind: str, size: int, options: dict) -> Layout:
    """From the first bytes of a file."""
    if kind == "raw":
        got = raw_layout(**options)
    else:
        with opened(path) as f:
            head = f.read(HEAD)
        got = None
        if kind == "nii" and head[:2] != b"\x1f\x8b":
            got = nifti_layout(head, **options)
        elif kind == "vti":
            got = vti_layout(head, **options)
    if got is None:
        with opened(path) as f:
            grid = decoder(kind, options)(f.read())
        nz, ny, nx = grid.values.shape[:3]
        return Layout((nz, ny, nx), grid.meta["original_dtype"], 0, grid.geometry, cut=False)
    need = got.offset + got.side * got.plane
    if size < need:
        raise ValueError(f"{path}: expected {need} bytes, there are {size}")
    return got


def decoder(kind: str, options: dict):
    if kind == "nii":
        return lambda b: codecs.decode_nifti(b, **options)
    if kind == "vti":
        return lambda b: codecs.decode_vti(b, **options)
    if kind == "raw":
        own = {k: v for k, v in options.items() if k != "geometry"}
        return lambda b: codecs.Grid(codecs.decode_raw(b, **own), options.get("geometry") or Geometry(), {"original_dtype": np.dtype(options.get("dtype", "uint16")).str[1:]})
    raise ValueError(f"unknown volume format: {kind}")


def numbers(path: str, at: Layout, lo: int, hi: int) -> np.ndarray:
    """The values from lo to hi along the slowest axis, in z, y, x order."""
    with opened(path) as f:
        f.seek(at.offset + lo * at.plane)
        flat = np.frombuffer(f.read((hi - lo) * at.plane), at.dtype)
    nz, ny, nx = at.shape
    if len(flat) * np.dtype(at.dtype).itemsize != (hi - lo) * at.plane:
        raise ValueError(f"{path}: the file ends within {lo} to {hi} of {at.axis}")
    part = flat.reshape(hi - lo, ny, nx) if at.axis == "z" else flat.reshape(hi - lo, ny, nz).transpose(2, 1, 0)
    part = part.astype(np.float32) if at.single else part
    return part * np.float32(at.slope or 1.0) + np.float32(at.inter) if at.slope not in (0.0, 1.0) or at.inter else part


def rows(name: str, values: np.ndarray, z0: int = 0, x0: int = 0, z: tuple[int, int] | None = None):
    """A plane of z at a time."""
    nz, ny, nx = values.shape[:3]
    y, x = np.divmod(np.arange(ny * nx, dtype=np.int32), nx)
    for k in range(nz):
        if z is None or z[0] <= k + z0 <= z[1]:
            yield pd.DataFrame({"volume_id": name, "z": np.int32(k + z0), "y": y, "x": x + np.int32(x0), "v": values[k].reshape(-1).astype(np.float64)})


def files(spark: SparkSession, path: str | list[str], glob: str | None, *columns: str) -> DataFrame:
    """(path, length and perhaps content) of the files under a path or several; contents are read only if they are asked for."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (r.option("pathGlobFilter", glob) if glob else r).load(path).select(*columns)


def can_open(path: str | list[str]) -> bool:
    if not isinstance(path, str):
        return all(map(can_open, path))
    m = re.match(r"^([a-z][a-z0-9+.-]*):", path)
    return (m[1] if m else "") in SCHEMES


def plan(spark: SparkSession, path: str | list[str], kind: str, glob: str | None = None, slab: int | None = None, z: tuple[int, int] | None = None, **options) -> DataFrame:
    """(path, lo, hi, layout): the slabs of the files, hi left out; those that a range of z (both ends in it) doesn't touch are left out. slab: cells of the
    slowest axis, by default as many as have SLAB bytes."""
    decoder(kind, {})

    def run(frames):
        for f in frames:
            out = []
            for name, size in zip(f["path"], f["length"], strict=True):
                at = layout(name, kind, size, options)
                step = (slab or max(1, SLAB // max(at.plane, 1))) if at.cut else max(at.side, 1)
                ends = [(lo, min(lo + step, at.side)) for lo in range(0, at.side, step)]
                out += [(name, lo, hi, at.dumps()) for lo, hi in ends if z is None or at.axis != "z" or (lo <= z[1] and hi > z[0])]
            yield pd.DataFrame(out, columns=["path", "lo", "hi", "layout"])

    return files(spark, path, glob, "path", "length").mapInPandas(run, PLAN)


def read(spark: SparkSession, path: str | list[str], kind: str, glob: str | None = None, slab: int | None = None, z: tuple[int, int] | None = None, **options) -> DataFrame:
    """(volume_id, z, y, x, v): the voxels of all files of a kind (raw, nii, vti) under path; volume_id is the file's path. z: first and last."""
    if not can_open(path):
        whole = decoder(kind, options)

        def decode(frames):
            for f in frames:
                for name, body in zip(f["path"], f["content"], strict=True):
                    yield from rows(name, whole(body).values, z=z)

        return files(spark, path, glob, "path", "content").mapInPandas(decode, VOXELS)

    def run(frames):
        for f in frames:
            for name, lo, hi, text in zip(f["path"], f["lo"], f["hi"], f["layout"], strict=True):
                at = Layout.loads(text)
                if at.cut:
                    yield from rows(name, numbers(name, at, lo, hi), *((lo, 0) if at.axis == "z" else (0, lo)), z)
                else:
                    with opened(name) as body:
                        yield from rows(name, decoder(kind, options)(body.read()).values, z=z)

    slabs = plan(spark, path, kind, glob, slab, z, **options)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return slabs.repartition(parts, "path", "lo").mapInPandas(run, VOXELS)


def headers(spark: SparkSession, path: str | list[str], kind: str, glob: str | None = None, strict: bool = True, **options) -> DataFrame:
    """Size, geometry and number type of each file, and why a file can't be read (strict: raise); of those that can be cut only the first bytes are read."""
    schema = "volume_id string, nz int, ny int, nx int, spacing array<double>, origin array<double>, direction array<array<double>>, original_dtype string, error string"
    names = ["volume_id", "nz", "ny", "nx", "spacing", "origin", "direction", "original_dtype", "error"]
    opens = can_open(path)

    def header(name, second):
        if opens:
            at = layout(name, kind, second, options)
            return at.shape, at.geometry, np.dtype(at.dtype).str[1:]
        grid = decoder(kind, options)(second)
        return grid.values.shape[:3], grid.geometry, grid.meta["original_dtype"]

    def run(frames):
        for f in frames:
            for name, second in zip(f.iloc[:, 0], f.iloc[:, 1], strict=True):
                try:
                    shape, g, dtype = header(name, second)
                    row = (name, *map(int, shape), list(g.spacing), list(g.origin), [list(r) for r in g.direction], dtype, None)
                except Exception as e:
                    if strict:
                        raise
                    row = (name, *[None] * 7, f"{type(e).__name__}: {e}")
                yield pd.DataFrame([row], columns=names).astype({c: "Int32" for c in ("nz", "ny", "nx")})

    return files(spark, path, glob, "path", "length" if opens else "content").mapInPandas(run, schema)
