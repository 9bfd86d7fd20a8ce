"""Index, world and render coordinates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IDENTITY = ((1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0))


@dataclass(frozen=True)
class Geometry:
    """spacing and origin in x, y, z; direction: rows of a 3 x 3 matrix."""

    spacing: tuple[float, float, float] = (1.0, 1.0, 1.0)
    origin: tuple[float, float, float] = (0.0, 0.0, 0.0)
    direction: tuple[tuple[float, ...], ...] = IDENTITY

    def inverse(self) -> tuple[tuple[float, ...], ...]:
        (a, b, c), (d, e, f), (g, h, i) = self.direction
        det = a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)
        if det == 0:
            raise ValueError("the direction matrix is singular")
        return tuple(tuple(x / det for x in row) for row in ((e * i - f * h, c * h - b * i, b * f - c * e), (f * g - d * i, a * i - c * g, c * d - a * f), (d * h - e * g, b * g - a * h, a * e - b * d)))

    @staticmethod
    def from_affine(m: list[list[float]]) -> Geometry:
        """Spacing: lengths of the matrix's columns (1 where it has none); direction: the columns by it; origin: its last column."""
        norms = [sum(m[r][c] ** 2 for r in range(3)) ** 0.5 for c in range(3)]
        size = [n if n > 1e-12 else 1.0 for n in norms]
        return Geometry(tuple(size), tuple(m[r][3] for r in range(3)), tuple(tuple(m[r][c] / size[c] for c in range(3)) for r in range(3)))


def index_to_world(df: DataFrame, g: Geometry, src: tuple[str, ...] = ("x", "y", "z"), dst: tuple[str, ...] = ("wx", "wy", "wz")) -> DataFrame:
    s = [F.col(c) * float(g.spacing[i]) for i, c in enumerate(src)]
    return df.withColumns({d: sum((s[j] * float(g.direction[i][j]) for j in range(1, 3)), s[0] * float(g.direction[i][0])) + float(g.origin[i]) for i, d in enumerate(dst)})


def world_to_index(df: DataFrame, g: Geometry, src: tuple[str, ...] = ("wx", "wy", "wz"), dst: tuple[str, ...] = ("ix", "iy", "iz")) -> DataFrame:
    inv = g.inverse()
    s = [F.col(c) - float(g.origin[i]) for i, c in enumerate(src)]
    return df.withColumns({d: (s[0] * float(inv[i][0]) + s[1] * float(inv[i][1]) + s[2] * float(inv[i][2])) / float(g.spacing[i]) for i, d in enumerate(dst)})


def bounds(voxels: DataFrame, g: Geometry) -> DataFrame:
    """World bounds of each volume's voxel centres: the extremes of its eight corners."""
    top = voxels.groupBy("volume_id").agg(*[F.max(c).cast("double").alias(c) for c in "xyz"])
    corner = F.explode(F.array(*[F.struct(*[(F.col(c) if k >> i & 1 else F.lit(0.0)).alias(c) for i, c in enumerate("xyz")]) for k in range(8)])).alias("c")
    world = index_to_world(top.select("volume_id", corner).select("volume_id", "c.*"), g)
    return world.groupBy("volume_id").agg(*[a for c in "xyz" for a in (F.min(f"w{c}").alias(f"{c}min"), F.max(f"w{c}").alias(f"{c}max"))])


def render_transform(box: DataFrame, size: float) -> DataFrame:
    """scale and offsets that centre each box at 0 with its longest side `size`; tiny boxes count as of side 1."""
    longest = F.greatest(*[F.col(f"{c}max") - F.col(f"{c}min") for c in "xyz"])
    scale = F.lit(float(size)) / F.when(longest < 1e-6, 1.0).otherwise(longest)
    out = box.withColumn("scale", scale)
    return out.withColumns({f"o{c}": -(F.col(f"{c}min") + F.col(f"{c}max")) * 0.5 * F.col("scale") for c in "xyz"})


def apply_transform(points: DataFrame, transform: DataFrame, cols: tuple[str, ...] = ("wx", "wy", "wz")) -> DataFrame:
    """Points in render space where their volume has a transform, and the space they are in."""
    t = transform.select("volume_id", "scale", "ox", "oy", "oz")
    both = points.join(t, "volume_id", "left")
    moved = {c: F.when(F.col("scale").isNull(), F.col(c)).otherwise(F.col(c) * F.col("scale") + F.col(f"o{a}")) for c, a in zip(cols, "xyz", strict=True)}
    return both.withColumns({**moved, "world_space": F.when(F.col("scale").isNull(), "canonical_world").otherwise("render_world")}).drop("scale", "ox", "oy", "oz")


def linear_index(ny: int, nx: int) -> Column:
    return (F.col("z") * ny + F.col("y")) * nx + F.col("x")


def from_linear(i: Column, ny: int | Column, nx: int | Column) -> list[Column]:
    """z, y and x of a linear index; whole-number division, exact at any size."""
    i = i.cast("long")
    line = F.call_function("div", i, F.lit(nx) if isinstance(nx, int) else nx)
    return [F.call_function("div", line, F.lit(ny) if isinstance(ny, int) else ny).cast("int").alias("z"), (line % ny).cast("int").alias("y"), (i % nx).cast("int").alias("x")]
