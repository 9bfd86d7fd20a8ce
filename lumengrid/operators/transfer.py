"""Transfer functions: control points, baking scalars to RGBA, bands of opacity, fusing colour tables with opacity."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

#: Default colour maps: fixed names of presets.
MAPS = ("Viridis (matplotlib)", "Inferno (matplotlib)", "Plasma (matplotlib)", "Magma (matplotlib)", "Turbo")


@dataclass(frozen=True)
class TransferFunction:
    """points: (x, r, g, b, a), kept in order of x."""

    name: str
    points: tuple[tuple[float, float, float, float, float], ...]

    def __post_init__(self):
        if not self.points or any(len(p) != 5 for p in self.points):
            raise ValueError("control points are (x, r, g, b, a)")
        object.__setattr__(self, "points", tuple(sorted((tuple(map(float, p)) for p in self.points), key=lambda p: p[0])))

    def index(self, v, left: bool = False):
        """Where a function of many points is to be looked up for v; None for few points, which need no index."""
        return C.upto(v, [p[0] for p in self.points], strict=left) if len(self.points) > C.MANY else None

    def columns(self, v, left: bool = False, premultiply: bool = False, at=None):
        look = C.interpolate_left if left else C.interpolate
        xs = [p[0] for p in self.points]
        r, g, b, a = (look(v, xs, [p[i] for p in self.points], at) for i in range(1, 5))
        return [r * a, g * a, b * a, a] if premultiply else [r, g, b, a]


def bake(voxels: DataFrame, tfs: list[TransferFunction], left: bool = False, premultiply: bool = False) -> DataFrame:
    """(volume_id, tf_name, z, y, x, r, g, b, a): every voxel under every transfer function, in one pass without a join. The place in a function of
    many points is worked out once for its four channels."""
    if not tfs:
        raise ValueError("no transfer function")
    v, places = F.col("v"), {f"_at{k}": t.index(F.col("v"), left) for k, t in enumerate(tfs)}
    found = voxels.select("volume_id", "z", "y", "x", "v", *[c.alias(n) for n, c in places.items() if c is not None])
    each = [F.struct(F.lit(t.name).alias("tf_name"), *[c.alias(n) for c, n in zip(t.columns(v, left, premultiply, F.col(p) if places[p] is not None else None), "rgba", strict=True)]) for t, p in zip(tfs, places, strict=True)]
    out = found.select("volume_id", "z", "y", "x", F.explode(F.array(*each)).alias("t"))
    return out.select("volume_id", "t.tf_name", "z", "y", "x", "t.r", "t.g", "t.b", "t.a")


def from_table(points: DataFrame) -> list[TransferFunction]:
    """Transfer functions of a table (tf_name, ord, x, r, g, b, a); control points are few by nature and read to the driver."""
    rows = points.select("tf_name", "ord", "x", "r", "g", "b", "a").orderBy("tf_name", "x", "ord").collect()
    names = dict.fromkeys(r["tf_name"] for r in rows)
    return [TransferFunction(n, tuple(tuple(r[2:]) for r in rows if r["tf_name"] == n)) for n in names]


def fuse(colours: DataFrame, opacity: DataFrame) -> DataFrame:
    """Colours (x, r, g, b) and opacity (x, a) at the union of their x, each interpolated where it has no point."""
    lut = [tuple(r) for r in colours.select("x", "r", "g", "b").orderBy("x").collect()]
    pwf = [tuple(r) for r in opacity.select("x", "a").orderBy("x").collect()]
    xs = colours.select("x").union(opacity.select("x")).distinct()
    look = lambda pts, i: C.interpolate(F.col("x"), [p[0] for p in pts], [p[i] for p in pts])
    return xs.select("x", look(lut, 1).alias("r"), look(lut, 2).alias("g"), look(lut, 3).alias("b"), look(pwf, 1).alias("a"))


def ascending(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Points with x made strictly increasing by steps of 1e-9; one that cannot move replaces its forerunner."""
    out: list[tuple[float, float]] = []
    for x, a in points:
        floor = out[-1][0] + 1e-9 if out else -math.inf
        x = max(x, floor)
        if out and not x - out[-1][0] > 1e-9 and x == out[-1][0]:
            out[-1] = (x, a)
        else:
            out.append((x, a))
    return out


def band_points(index: int, edges: list[float], lo: float, hi: float, mode: str = "unit") -> list[tuple[float, float]]:
    """Opacity over value for band `index` (from 1): a plateau, a triangle with shoulders, or a bell; [] for other modes."""
    low, high = edges[index - 1], edges[index]
    width, mid = high - low, (low + high) / 2
    gap = (hi - lo) * 1e-4
    shapes = {
        "unit": (0.0, [(low + width * 1e-3, 0.2), (high - width * 1e-3, 0.2)]),
        "linear": (0.0, [(low + max(0.05 * width, 1e-9), 0.08), (mid, 0.2), (high - max(0.05 * width, 1e-9), 0.08)]),
        "gaussian": (gap, [(x, math.exp(-0.5 * ((x - mid) / max(width / 4, 1e-9)) ** 2)) for x in (low + width * i / 63 for i in range(64))]),
    }
    if mode not in shapes:
        return []
    off, body = shapes[mode]
    before = [(low - off, 0.0)] if low > lo else []
    after = [(high + off, 0.0)] if high < hi else []
    return ascending([(lo, 0.0), *before, *body, *after, (hi, 0.0)])


def grouped_points(indices: list[int], edges: list[float], lo: float, hi: float, mode: str = "linear") -> list[tuple[float, float]]:
    """The points of several bands in one list, in order of x."""
    return sorted((p for i in indices for p in band_points(i, edges, lo, hi, mode)), key=lambda p: p[0])


def flat_points(points: list[tuple[float, float]]) -> list[float]:
    """x, opacity, midpoint 0.5 and sharpness 0 of each point, end to end."""
    return [y for x, a in points for y in (x, a, 0.5, 0.0)]


def parse_maps(text: str | None) -> list[str]:
    """Names split at commas and line ends, trimmed, without empties and repeats, in order."""
    return list(dict.fromkeys(t for t in (p.strip() for p in (text or "").replace("\n", ",").split(",")) if t))


def tf_set(maps: str | None, bands: int, skipped: frozenset[int] = frozenset()) -> list[tuple[int, str, str]]:
    """(index, colour map, TF name) for each band, maps taken in turn; without bands one for each map."""
    names = parse_maps(maps) or list(MAPS)
    chosen = [names[i % len(names)] for i in range(bands)] if bands > 0 else names
    return [(i, m, f"TF{i:02d}") for i, m in enumerate(chosen, 1) if i not in skipped]
