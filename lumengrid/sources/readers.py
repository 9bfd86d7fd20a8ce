"""Files to voxel, pixel and transfer-function tables. Volumes are read slab by slab (see slabs), images and transfer functions whole through Spark's
`binaryFile` source, so any path Spark can list works."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.geometry import Geometry
from . import codecs, slabs

VOXELS = slabs.VOXELS


def _files(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    return slabs.files(spark, path, glob, "path", "content")


def read_volumes(spark: SparkSession, path: str | list[str], kind: str, glob: str | None = None, slab: int | None = None, z: tuple[int, int] | None = None, **options) -> DataFrame:
    """Voxels of all NIfTI ("nii") or VTK image ("vti") files under path; volume_id is the file's path. z: first and last plane that are wanted; slabs
    without such planes are not read."""
    return slabs.read(spark, path, kind, glob, slab, z, **options)


def read_headers(spark: SparkSession, path: str | list[str], kind: str, glob: str | None = None, strict: bool = True, **options) -> DataFrame:
    """Size and geometry of each file; unless strict, with the error of those that can't be read."""
    return slabs.headers(spark, path, kind, glob, strict, **options)


def geometry_of(header) -> Geometry:
    return Geometry(tuple(header["spacing"]), tuple(header["origin"]), tuple(tuple(r) for r in header["direction"]))


def read_raw(spark: SparkSession, path: str, shape: tuple[int, int, int], dtype: str = "uint16", endian: str = "<", order: str = "zyx", offset: int = 0, slab: int | None = None, z: tuple[int, int] | None = None) -> DataFrame:
    """Voxels of files of plain numbers; with order "xyz" z runs fastest."""
    return slabs.read(spark, path, "raw", None, slab, z, shape=tuple(shape), dtype=dtype, endian=endian, order=order, offset=int(offset))


def read_pixels(spark: SparkSession, path: str, glob: str = "*.png") -> DataFrame:
    """(path, tf_name, split, frame, row, col, r, g, b, a) of frames at .../<tf>/<split>/<name>.png."""

    def run(frames):
        for f in frames:
            for name, body in zip(f["path"], f["content"], strict=True):
                px = codecs.unit_scale(codecs.decode_png(body))
                h, w = px.shape[:2]
                row, col = np.divmod(np.arange(h * w, dtype=np.int32), w)
                yield pd.DataFrame({"path": name, "row": row, "col": col, **{c: px[..., i].ravel().astype(np.float64) for i, c in enumerate("rgba")}})

    out = _files(spark, path, glob).mapInPandas(run, "path string, row int, col int, r double, g double, b double, a double")
    return out.select("path", *frame_of("path"), "row", "col", "r", "g", "b", "a")


def read_images(spark: SparkSession, path: str, glob: str = "*.png") -> DataFrame:
    """(path, content, tf_name, split, frame) of image files at .../<tf>/<split>/<name>.png, a row each."""
    return _files(spark, path, glob).select("path", "content", *frame_of("path"))


def frame_of(path: str) -> list[Column]:
    """tf_name, split and frame from a column of paths."""
    part = lambda i: F.element_at(F.split(path, "/"), i)
    return [part(-3).alias("tf_name"), part(-2).alias("split"), F.regexp_replace(part(-1), r"\.[^.]*$", "").alias("frame")]


def read_tf_json(spark: SparkSession, path: str, glob: str = "tf_config.json") -> DataFrame:
    """(path, tf_name, ord, x, r, g, b, a, lo, hi) of fused transfer-function files, points in (stable) order of x."""

    def run(frames):
        for f in frames:
            for name, body in zip(f["path"], f["content"], strict=True):
                doc = json.loads(body)
                pts = doc["control_points"]
                if not pts or any(len(p) != 5 for p in pts):
                    raise ValueError(f"{name}: control points are (x, r, g, b, a)")
                pts = sorted(pts, key=lambda p: p[0])
                lo, hi = doc.get("data_range") or (pts[0][0], pts[-1][0])
                yield pd.DataFrame([(name, name.rsplit("/", 2)[-2], i, *map(float, p), float(lo), float(hi)) for i, p in enumerate(pts)], columns=["path", "tf_name", "ord", "x", "r", "g", "b", "a", "lo", "hi"])

    return _files(spark, path, glob).mapInPandas(run, "path string, tf_name string, ord int, x double, r double, g double, b double, a double, lo double, hi double")


def cell_to_point(cells: DataFrame) -> DataFrame:
    """Point values as means of the (up to eight) cells around: each cell goes to its corners, then one aggregate."""
    out = cells
    for c in "zyx":
        out = out.withColumn(c, F.explode(F.array(F.col(c), F.col(c) + 1)))
    return out.groupBy("volume_id", "z", "y", "x").agg(F.avg("v").alias("v"))
