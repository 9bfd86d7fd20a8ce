"""Tables to files. Point clouds and grids of one volume are single files that tasks write in parts (see writers); reports and camera lists, of
a row for each transfer function or camera, are written by the driver."""

from __future__ import annotations

import json
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import codecs, writers

XYZ = ("x", "y", "z")


def point_columns(points: DataFrame) -> list[str]:
    """Attributes in order of name; arrays of k numbers become name_0.. (their length is the first row's)."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double", "boolean"}
    kinds = dict(points.dtypes)
    arrays = [c for c, t in points.dtypes if t.startswith("array<") and t[6:-1] in numeric]
    sizes = points.select(*[F.max(F.size(c)).alias(c) for c in arrays]).first().asDict() if arrays else {}
    out = []
    for c in sorted(kinds):
        if c in XYZ:
            continue
        if kinds[c] in numeric or kinds[c].startswith("decimal"):
            out.append((c, F.col(c)))
        elif c in arrays:
            out += [(f"{c}_{i}" if sizes[c] != 1 else c, F.get(F.col(c), i)) for i in range(sizes[c] or 0)]
    return [e.cast("double").alias(n) for n, e in out]


def _number(file: Column | None) -> Column:
    return (F.lit(0) if file is None else file).alias("_file")


def numbered(points: DataFrame, files: list[tuple], by: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """The points with the number of their file: files lists the values of `by` and the path; points of no file are left out. As many rows as files."""
    kinds = [points.schema[c].dataType.simpleString() for c in by]
    table = points.sparkSession.createDataFrame([(*f[:-1], i) for i, f in enumerate(files)], ", ".join([*(f"`_{c}` {t}" for c, t in zip(by, kinds, strict=True)), "_file int"]))
    match = F.lit(True)
    for c in by:
        match &= points[c].eqNullSafe(table[f"_{c}"])
    return points.join(F.broadcast(table), match).drop(*[f"_{c}" for c in by]), [f[-1] for f in files]


def write_ply(points: DataFrame, path: str | list[str], file: Column | None = None) -> int:
    """ASCII PLY with x, y, z and the numeric attributes, six decimals each, nulls as nan. Many paths: `file` is the number of a point's path."""
    cols = [F.col(c).cast("double").alias(c) for c in XYZ] + point_columns(points.drop("_file"))
    rows = points.select(_number(file), *cols)
    return writers.save(rows, "ply_file", path, columns="\n".join(rows.columns[1:]))


def write_npz(points: DataFrame, path: str | list[str], file: Column | None = None) -> int:
    """xyz and every numeric attribute."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double", "boolean"}
    kinds = {c: t for c, t in points.dtypes if c not in (*XYZ, "_file") and (t[6:-1] if t.startswith("array<") else t) in numeric}
    rows = points.select(_number(file), F.array(*[F.col(c).cast("float") for c in XYZ]).alias("xyz"), *kinds)
    specs = [f"{c}|{writers.npy_width(t)}" for c, t in {"xyz": "array<float>", **kinds}.items()]
    return writers.save(rows, "npz_file", path, columns="\n".join(specs))


def write_vti(voxels: DataFrame, shape, path: str | list[str], geometry=None, array: str = "Scalars", dtype: str = "float32", file: Column | None = None) -> None:
    """VTK images of raw appended data; a task writes slabs of z."""
    from ..operators.geometry import Geometry

    g, deep = geometry or Geometry(), writers.planes(tuple(shape), dtype)
    parts = min(-(-shape[0] // deep) * (1 if isinstance(path, str) else len(path)), 10_000)
    cells = voxels.select(_number(file), F.floor(F.col("z") / deep).cast("int").alias("slab"), *[F.col(c).cast("int").alias(c) for c in "zyx"], F.col("v").cast("double").alias("v"))
    rows = cells.repartition(parts, "_file", "slab").sortWithinPartitions("_file", "slab")
    text = ",".join(repr(float(x)) for x in (*g.spacing, *g.origin, *(x for r in g.direction for x in r)))
    writers.save(rows, "vti_file", path, shape=",".join(map(str, shape)), planes=str(deep), dtype=np.dtype(dtype).str, geometry=text, array=array)


def write_frames(pixels: DataFrame, folder: str) -> DataFrame:
    """PNG files <folder>/<tf_name>/<split>/<frame>.png of frames (tf_name, split, frame, row, col, r, g, b, a; 0 to 1), one task a frame at a time; returns
    (path, width, height), which writes them as it is run. A frame that is written again is the same file."""

    def run(key, t):
        col = {c: t.column(c).to_numpy() for c in ("row", "col", *"rgba")}
        h, w = int(col["row"].max()) + 1, int(col["col"].max()) + 1
        px = np.zeros((h, w, 4), np.uint8)
        px[col["row"], col["col"]] = np.rint(np.clip(np.stack([col[c] for c in "rgba"], -1), 0, 1) * 255)
        tf, split, frame = (k.as_py() for k in key)
        fs, path = writers.system(f"{folder}/{tf}/{split}/{frame}.png")
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        part = f"{path}.{uuid.uuid4().hex}"
        with fs.open_output_stream(part) as f:
            f.write(codecs.encode_png(px))
        fs.move(part, path)
        return pa.table({"path": [f"{folder}/{tf}/{split}/{frame}.png"], "width": pa.array([w], pa.int32()), "height": pa.array([h], pa.int32())})

    some = pixels.select(F.col("tf_name"), F.col("split"), F.col("frame").cast("string").alias("frame"), F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), *[F.col(c).cast("double").alias(c) for c in "rgba"])
    return some.groupBy("tf_name", "split", "frame").applyInArrow(run, "path string, width int, height int")


def export_points(points: DataFrame, apply: bool = True, scale: float = 1.0, offset: tuple[float, float, float] = (0.0, 0.0, 0.0)) -> DataFrame:
    """Coordinates for export: points already in render space stay, others are moved there unless apply is False."""
    if not apply:
        return points
    there = F.col("world_space") == "render_world"
    return points.withColumns({c: F.when(there, F.col(c)).otherwise(F.col(c) * scale + o) for c, o in zip(XYZ, offset, strict=True)})


def write_tf_json(points: DataFrame, path: str, lo: float, hi: float) -> None:
    rows = [list(map(float, r)) for r in points.select("x", "r", "g", "b", "a").orderBy("x").collect()]  # a TF's few points
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps({"data_range": [lo, hi], "control_points": rows}, indent=2))


def matrix(r) -> list[list[float]]:
    return [[r[f"m{i}{k}"] for k in range(4)] for i in range(3)] + [[0.0, 0.0, 0.0, 1.0]]


def write_transforms(frames: DataFrame, folder: str, intrinsics: dict, w: int, h: int, bounds=None, transform: dict | None = None) -> list[str]:
    """transforms_<split>.json for each split that has frames (file_path, m00..m23)."""
    base = {"camera_angle_x": intrinsics["hfov"], "w": w, "h": h, "fl_x": intrinsics["fx"], "fl_y": intrinsics["fy"], "cx": intrinsics["cx"], "cy": intrinsics["cy"], "camera_model": "OPENCV", "render_bounds": bounds, "render_world_transform": transform}
    out = []
    rows = frames.orderBy("pose_id").collect()  # a few hundred cameras
    Path(folder).mkdir(parents=True, exist_ok=True)
    for split in ("train", "test", "val"):
        own = [{"file_path": r["file_path"], "transform_matrix": matrix(r)} for r in rows if r["split"] == split]
        if own:
            out.append(f"{folder}/transforms_{split}.json")
            Path(out[-1]).write_text(json.dumps({**base, "frames": own}, indent=2))
    return out


def write_flat_scene(frames: DataFrame, root: str, scene: str, intrinsics: dict, w: int, h: int) -> str | None:
    """<root>/<scene>/transforms.json with train, validation and test frames in that order; None without frames."""
    rank = {"train": 0, "val": 1, "test": 2}
    rows = sorted(frames.collect(), key=lambda r: (rank[r["split"]], r["pose_id"]))
    if not rows:
        return None
    doc = {"fl_x": intrinsics["fx"], "fl_y": intrinsics["fy"], "cx": intrinsics["cx"], "cy": intrinsics["cy"], "w": w, "h": h, "frames": [{"file_path": r["file_path"], "transform_matrix": matrix(r)} for r in rows]}
    path = Path(root) / scene / "transforms.json"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(doc, indent=2))
    return str(path)


def write_scene_index(root: str, scenes: list[str]) -> None:
    """The same list for training and testing."""
    for name in ("train_index.json", "test_index.json"):
        (Path(root) / name).write_text(json.dumps(scenes, indent=2))


def write_qc_report(verdicts: DataFrame | list[dict], json_path: str, md_path: str | None = None) -> dict:
    """Of a volume's verdicts, a row for each TF."""
    rows = sorted(verdicts, key=lambda r: r["tf_name"]) if isinstance(verdicts, list) else [r.asDict() for r in verdicts.orderBy("tf_name").collect()]
    names = lambda s: [r["tf_name"] for r in rows if r["status"] == s]
    report = {"total": len(rows), "passed": len(names("pass")), "failed": len(names("fail")), "passed_names": names("pass"), "failed_names": names("fail"), "items": rows}
    Path(json_path).parent.mkdir(parents=True, exist_ok=True)
    Path(json_path).write_text(json.dumps(report, indent=2))
    if md_path:
        num = lambda x: "-" if x is None else f"{x:.4f}"
        lines = ["| TF | status | mean | nonzero | std | reasons |", "|-|-|-|-|-|-|"]
        lines += [f"| {r['tf_name']} | {r['status']} | {num(r['mean'])} | {num(r['nonzero'])} | {num(r['std'])} | {','.join(r['reasons']) or '-'} |" for r in rows]
        Path(md_path).write_text("\n".join(lines) + "\n")
    return report
