"""Scalar column functions: piecewise-linear lookup, transfer functions, hash-based random numbers, vectors."""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(seed: int, *ids: Column) -> Column:
    """A reproducible uniform number in (0, 1) from a seed and identifying columns: 52 bits of an MD5 digest."""
    key = F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in ids])
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)


#: Points from which a lookup goes by an index instead of a CASE chain.
MANY = 16
#: Comparisons after the index at most.
STEPS = 3


def numbers(values) -> Column:
    """A constant array of doubles; one expression, however long it is."""
    text = ",".join("NaN" if v != v else "Infinity" if v == math.inf else "-Infinity" if v == -math.inf else repr(float(v)) for v in values)
    return F.split(F.lit(text), ",").cast("array<double>")


def upto(v: Column, xs: list[float], strict: bool = False) -> Column:
    """How many of the ascending xs are at most v (below it, if strict): null for null, all for NaN (none are below it but all count).

    A uniform grid over the xs holds the number of points in the cells before; of those in the cell of v itself, STEPS at most, each is
    compared. Points that lie too close for such a grid are searched by halves. Either is an expression of a size that doesn't follow the number of points."""
    n, lo, hi = len(xs), xs[0], xs[-1]
    under = (lambda x: x < v) if strict else (lambda x: x <= v)
    cells = n
    while hi > lo and cells <= 64 * n:
        scale = cells / (hi - lo)
        at = [min(cells - 1, math.floor((x - lo) * scale)) for x in xs] if math.isfinite(scale) else [0] * n
        count = [0] * (cells + 1)
        for g in at:
            count[g + 1] += 1
        if max(count) <= STEPS:
            before = list(accumulate(count))
            g = F.least(F.greatest(F.floor((v - F.lit(lo)) * F.lit(scale)), F.lit(0)), F.lit(cells - 1)).cast("int")
            base = F.get(F.split(F.lit(",".join(map(str, before))), ",").cast("array<int>"), g)
            ends = numbers([*xs, *[math.nan] * STEPS])  # NaN is above all numbers
            found = sum((F.when(under(F.get(ends, base + k)), 1).otherwise(0) for k in range(1, max(count))), base + F.when(under(F.get(ends, base)), 1).otherwise(0))
            return F.when(F.isnan(v), n).when(v.isNotNull(), found)
        cells *= 2
    halves = [1 << k for k in range(max(n - 1, 1).bit_length(), -1, -1)]
    each = F.array(*map(F.lit, halves))
    search = F.aggregate(each, F.lit(0), lambda i, h: F.when((i + h <= n) & under(F.get(numbers(xs), F.least(i + h, F.lit(n)) - 1)), i + h).otherwise(i))
    return F.when(F.isnan(v), n).when(v.isNotNull(), search)


def interpolate(v: Column, xs: list[float], ys: list[float], at: Column | None = None) -> Column:
    """Piecewise-linear lookup, constant outside; of equal xs the last one counts. Few points are a CASE chain, many are found by upto()
    (`at`, if it is there already)."""
    if len(xs) > MANY:
        i = (upto(v, xs) if at is None else at) - 1
        slopes = [(ys[k + 1] - ys[k]) / (xs[k + 1] - xs[k]) if xs[k + 1] > xs[k] else 0.0 for k in range(len(xs) - 1)]
        inside = F.get(numbers(ys), i) + (v - F.get(numbers(xs), i)) * F.get(numbers([*slopes, 0.0]), i)
        return F.when(v >= xs[-1], F.lit(float(ys[-1]))).when(i >= 0, inside).otherwise(F.when(v.isNotNull(), F.lit(float(ys[0]))))
    out = F.when(v >= xs[-1], F.lit(float(ys[-1])))
    for i in range(len(xs) - 2, -1, -1):
        if xs[i + 1] > xs[i]:
            out = out.when(v >= xs[i], F.lit(float(ys[i])) + (v - F.lit(float(xs[i]))) * F.lit((ys[i + 1] - ys[i]) / (xs[i + 1] - xs[i])))
    return out.otherwise(F.when(v.isNotNull(), F.lit(float(ys[0]))))


def interpolate_left(v: Column, xs: list[float], ys: list[float], at: Column | None = None) -> Column:
    """As interpolate, but of equal xs the first one counts, and a segment's width is taken as 1e-9 wider. `at`: upto(v, xs, strict=True)."""
    if len(xs) > MANY:
        i = F.least(F.greatest(upto(v, xs, strict=True) if at is None else at, F.lit(1)), F.lit(len(xs) - 1))
        x, y = numbers(xs), numbers(ys)
        t = F.least(F.greatest((v - F.get(x, i - 1)) / (F.get(x, i) - F.get(x, i - 1) + 1e-9), F.lit(0.0)), F.lit(1.0))
        return F.when(v.isNotNull(), F.get(y, i - 1) + t * (F.get(y, i) - F.get(y, i - 1)))
    out = None
    for i in range(1, len(xs)):
        t = F.least(F.greatest((v - F.lit(float(xs[i - 1]))) / F.lit(xs[i] - xs[i - 1] + 1e-9), F.lit(0.0)), F.lit(1.0))
        y = F.lit(float(ys[i - 1])) + t * F.lit(float(ys[i] - ys[i - 1]))
        last = i == len(xs) - 1
        out = (F.when if out is None else out.when)(v.isNotNull() if last else v <= xs[i], y)
    return out if out is not None else F.when(v.isNotNull(), F.lit(float(ys[0])))


def gaussian_rgba(v: Column, mean: float, sigma: float, rgb: tuple[float, float, float], k: float) -> list[Column]:
    """r, g, b scaled by a Gaussian window over the value, and the opacity 1 - exp(-k w)."""
    w = F.exp(F.lit(-0.5) * F.pow((v - F.lit(mean)) / F.lit(sigma), F.lit(2.0)))
    return [(F.lit(c) * w).alias(n) for c, n in zip(rgb, "rgb", strict=True)] + [(F.lit(1.0) - F.exp(F.lit(-k) * w)).alias("a")]


def dot(a: list[Column], b: list[Column]) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: list[Column], b: list[Column]) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def unit(a: list[Column], eps: float = 0.0) -> list[Column]:
    """The vector scaled to length one (with eps added to its length); a zero vector stays."""
    n = F.sqrt(dot(a, a)) + F.lit(eps)
    return [F.when(n == 0, x).otherwise(x / n) for x in a]


def magnitude(v: Column) -> Column:
    """Euclidean length of an array column."""
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def intrinsics(vfov_deg: float, w: int, h: int) -> dict[str, float]:
    """Pinhole parameters from the vertical field of view (focal lengths scale by the aspect ratio)."""
    half = math.radians(vfov_deg) / 2
    fy = h / 2 / math.tan(half)
    return {"fx": fy * w / h, "fy": fy, "cx": (w - 1) / 2, "cy": (h - 1) / 2, "vfov": 2 * half, "hfov": 2 * math.atan(w / h * math.tan(half))}


def intrinsic_columns(vfov_deg: float, w: Column, h: Column) -> list[Column]:
    """The same for columns of widths and heights."""
    t = math.tan(math.radians(vfov_deg) / 2)
    fy = h / 2.0 / t
    out = {"fx": fy * w / h, "fy": fy, "cx": (w - 1) / 2.0, "cy": (h - 1) / 2.0, "vfov": F.lit(math.radians(vfov_deg)), "hfov": 2.0 * F.atan(w / h * t)}
    return [c.alias(n) for n, c in out.items()]
