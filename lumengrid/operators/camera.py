"""Camera poses, look-at matrices and train/validation/test splits."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from . import grid


def fit_distance(extent: tuple[float, float, float], vfov: float, hfov: float | None, scale: float) -> float:
    """Distance at which the box's sphere fills the narrower field of view (of the vertical one alone if hfov is None), times scale."""
    r = 0.5 * math.sqrt(sum(e * e for e in extent))
    return scale * max(r / max(math.sin(a / 2), 1e-6) for a in (vfov, hfov) if a is not None)


def fit(boxes: DataFrame, vfov: float, hfov: float | None, scale: float) -> DataFrame:
    """The same for a table of boxes (xmin .. zmax): cx, cy, cz and distance."""
    r = 0.5 * F.sqrt(sum((F.pow(F.col(f"{c}max") - F.col(f"{c}min"), F.lit(2.0)) for c in "xyz"), F.lit(0.0)))
    wide = max(1 / max(math.sin(a / 2), 1e-6) for a in (vfov, hfov) if a is not None)
    return boxes.withColumns({**{f"c{c}": (F.col(f"{c}min") + F.col(f"{c}max")) / 2 for c in "xyz"}, "distance": r * wide * scale})


def focus(parts: DataFrame, vfov: float, scale: float = 1.0) -> DataFrame:
    """distance for parts of volumes (cx, cy, cz, radius, side: the volume's longest), such as bands' bounding spheres, which count as 5 % of
    the side at least; it fits the vertical view."""
    return parts.withColumn("distance", F.greatest(F.col("radius"), 0.05 * F.col("side")) * (scale / max(math.sin(vfov / 2), 1e-6)))


def orbit(targets: DataFrame, n: int, up: tuple[float, float, float] = (0.0, 1.0, 0.0)) -> DataFrame:
    """(columns of targets but for cx, cy, cz, distance; pose_id, ex, ey, ez, fx, fy, fz, ux, uy, uz): around each target n eyes on a golden-angle
    sphere that look at its centre."""
    i = F.col("pose_id")
    z = 2.0 * ((i + 0.5) / float(n)) - 1.0
    ring = F.sqrt(F.greatest(F.lit(0.0), 1.0 - z * z))
    turn = i * (2.0 * math.pi * (1.0 - 2.0 / (1.0 + math.sqrt(5.0))))
    d = [ring * F.cos(turn), ring * F.sin(turn), z]
    keys = [c for c in targets.columns if c not in ("cx", "cy", "cz", "distance")]
    poses = grid.numbered(targets, n, "pose_id").withColumn("pose_id", i.cast("int"))
    eyes = poses.select(*keys, "pose_id", *[(F.col(f"c{c}") + d[k] * F.col("distance")).alias(f"e{c}") for k, c in enumerate("xyz")], *[F.col(f"c{c}").alias(f"f{c}") for c in "xyz"])
    return with_up(eyes, up)


def fibonacci(spark: SparkSession, n: int, centre: tuple[float, float, float] = (0.0, 0.0, 0.0), distance: float = 1.0, up: tuple[float, float, float] = (0.0, 1.0, 0.0)) -> DataFrame:
    """The same around one centre."""
    return orbit(spark.createDataFrame([(*map(float, centre), float(distance))], "cx double, cy double, cz double, distance double"), n, up)


def focused(spark: SparkSession, n: int, centre: tuple[float, float, float], radius: float, extent: tuple[float, float, float], vfov: float, scale: float = 1.0) -> DataFrame:
    """Poses around one part of a volume."""
    one = spark.createDataFrame([(*map(float, centre), float(radius), float(max(extent)))], "cx double, cy double, cz double, radius double, side double")
    return orbit(focus(one, vfov, scale).drop("radius", "side"), n)


def with_up(poses: DataFrame, up: tuple[float, float, float]) -> DataFrame:
    """An up vector at right angles to the view; another axis stands in where the hint is nearly parallel to it."""
    f = C.unit([F.col(f"f{c}") - F.col(f"e{c}") for c in "xyz"], 1e-12)
    hint = C.unit([F.lit(float(x)) for x in up], 1e-12)
    with_f = poses.withColumns({f"_f{c}": x for c, x in zip("xyz", f, strict=True)})
    f = [F.col(f"_f{c}") for c in "xyz"]
    steep = F.abs(C.dot(f, hint)) > 0.98
    other = [F.lit(0.0), F.when(F.abs(f[2]) < 0.9, 0.0).otherwise(1.0), F.when(F.abs(f[2]) < 0.9, 1.0).otherwise(0.0)]
    base = [F.when(steep, o).otherwise(h) for o, h in zip(other, hint, strict=True)]
    flat = [b - C.dot(base, f) * x for b, x in zip(base, f, strict=True)]
    stage = with_f.withColumns({f"_u{c}": x for c, x in zip("xyz", flat, strict=True)})
    u = C.unit([F.col(f"_u{c}") for c in "xyz"], 1e-12)
    return stage.withColumns({f"u{c}": x for c, x in zip("xyz", u, strict=True)}).drop(*[f"_{k}{c}" for k in "fu" for c in "xyz"])


def camera_to_world(poses: DataFrame) -> DataFrame:
    """m00..m23: columns right, up, backward and eye of the camera-to-world matrix."""
    fwd = C.unit([F.col(f"f{c}") - F.col(f"e{c}") for c in "xyz"])
    s = poses.withColumns({f"_f{c}": x for c, x in zip("xyz", fwd, strict=True)})
    f = [F.col(f"_f{c}") for c in "xyz"]
    s = s.withColumns({f"_r{c}": x for c, x in zip("xyz", C.unit(C.cross(f, C.unit([F.col(f"u{c}") for c in "xyz"]))), strict=True)})
    r = [F.col(f"_r{c}") for c in "xyz"]
    s = s.withColumns({f"_v{c}": x for c, x in zip("xyz", C.unit(C.cross(r, f)), strict=True)})
    cols = {f"m{i}{k}": e for i, c in enumerate("xyz") for k, e in enumerate((F.col(f"_r{c}"), F.col(f"_v{c}"), -F.col(f"_f{c}"), F.col(f"e{c}")))}
    return s.withColumns(cols).drop(*[f"_{k}{c}" for k in "frv" for c in "xyz"])


def split_sizes(n: int, test: int, val: int) -> tuple[int, int]:
    """Test and validation numbers that fit: negatives are 0, test goes first."""
    test, val = max(0, test), max(0, val)
    return (n, 0) if test > n else (test, min(val, n - test))


def spread(total: int, k: int) -> list[int]:
    """k even places in 0..total-1, the last one left out, rounded half to even; equal ones count once."""
    if k <= 0 or total <= 0:
        return []
    return list(range(total)) if k >= total else sorted({round(i * ((total - 1) / k)) for i in range(k)})


def split_frames(poses: DataFrame, n: int, test: int, val: int, strategy: str = "tail") -> DataFrame:
    """poses with `split`: test last and validation before it ("tail"), or both spread evenly ("interleave")."""
    test, val = split_sizes(n, test, val)
    i = F.col("pose_id")
    if strategy == "interleave":
        chosen = spread(n, test)
        rest = [k for k in range(n) if k not in set(chosen)]
        more = [rest[k] for k in spread(len(rest), val)]
        out = F.when(i.isin(chosen), "test").when(i.isin(more), "val").otherwise("train") if chosen or more else F.lit("train")
    else:
        out = F.when(i >= n - test, "test").when(i >= n - test - val, "val").otherwise("train")
    return poses.withColumn("split", out)


def frame_manifest(tfs: DataFrame, cameras: DataFrame, flat: bool = False) -> DataFrame:
    """One row for each TF and camera: file_path and the camera's columns; the camera table is a few hundred rows."""
    both = tfs.select("tf_name").crossJoin(F.broadcast(cameras))
    name = F.format_string("r_%04d", "pose_id")
    return both.withColumn("file_path", F.concat(F.lit("images/"), name, F.lit(".png")) if flat else F.concat(F.lit("./"), F.col("split"), F.lit("/"), name))
