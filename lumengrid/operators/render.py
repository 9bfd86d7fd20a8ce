"""Axis-aligned ray compositing as an ordered window, and segmentation models for frames: of pixel rows, or of image files with a model that is sent to the workers."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..sources import codecs


def composite(rgba: DataFrame, axis: str = "z", unit: float = 1.0) -> DataFrame:
    """(volume_id, tf_name, row, col, r, g, b, a): straight colours seen along an axis, front to back.

    A sample's share is its opacity (for a step of `unit`) times what those before it let through; the running product is
    a sum of logarithms. A ray is a group of its own, so the window's groups are as long as the axis.
    """
    row, col = {"z": ("y", "x"), "y": ("z", "x"), "x": ("z", "y")}[axis]
    clear = F.greatest(F.pow(F.lit(1.0) - F.least(F.greatest("a", F.lit(0.0)), F.lit(1.0)), F.lit(unit)), F.lit(1e-300))
    ray = Window.partitionBy("volume_id", "tf_name", row, col).orderBy(axis).rowsBetween(Window.unboundedPreceding, -1)
    seen = rgba.withColumn("_clear", clear).withColumn("_before", F.exp(F.coalesce(F.sum(F.log("_clear")).over(ray), F.lit(0.0))))
    share = (F.lit(1.0) - F.col("_clear")) * F.col("_before")
    return seen.groupBy("volume_id", "tf_name", F.col(row).alias("row"), F.col(col).alias("col")).agg(*[F.sum(share * F.col(c)).alias(c) for c in "rgb"], F.sum(share).alias("a"))


def opacity_unit(spacing: tuple[float, ...], shape: tuple[int, ...], given: float | None = None) -> float:
    """A positive given distance; else the mean spacing; else diagonal over the cube root of the voxel count; else 1."""
    if given and given > 0:
        return float(given)
    mean = sum(spacing) / len(spacing)
    if mean > 0:
        return float(mean)
    n = float(np.prod(shape)) ** (1 / 3)
    diagonal = float(np.linalg.norm([s * max(k - 1, 0) for s, k in zip(spacing, shape, strict=False)]))
    return diagonal / n if diagonal > 0 and n > 0 else 1.0


@dataclass(frozen=True)
class ModelFile:
    """A model stored in a file that every executor gets: load makes of the file's bytes a function from images (n x channels x height x
    width, float32) to probabilities (n x height x width). sha256: what the bytes must be, in either case; None: anything."""

    path: str
    load: Callable[[bytes], Callable[[np.ndarray], np.ndarray]]
    sha256: str | None = None

    def send(self, spark: SparkSession) -> Callable[[], Callable]:
        """Sends the file; what comes back gives a worker the model, which it loads once."""
        spark.sparkContext.addFile(self.path)
        name, load, digest = self.path.rstrip("/").rsplit("/", 1)[-1], self.load, self.sha256

        def model():
            with open(SparkFiles.get(name), "rb") as f:
                body = f.read()
            if not text.has_sha256(body, digest):
                raise ValueError(f"{name}: not the file with digest {digest}")
            key = hashlib.sha256(body).hexdigest(), name
            if key not in _models:
                _models.clear()
                _models[key] = load(body)
            return _models[key]

        return model


#: The model that a worker has loaded, by digest and name of its file.
_models: dict[tuple[str, str], Callable] = {}


def prepared(rgba: np.ndarray, channels: int, mean=None, std=None, size=None) -> np.ndarray:
    """An image (rows x columns x RGBA) as a model gets it: channels x height x width."""
    if size:
        rgba = resize(rgba, *((int(size),) * 2 if np.isscalar(size) else map(int, size)))
    planes = np.moveaxis(rgba, -1, 0)
    image = planes[:3].mean(axis=0)[None] if channels == 1 else planes[:channels]
    each = lambda v: np.asarray(v, float).reshape(-1, 1, 1)
    if mean is not None and std is not None:
        image = (image - each(mean)) / np.maximum(each(std), 1e-6)
    return image.astype(np.float32)


def segment_images(images: DataFrame, model: ModelFile, channels: int = 3, mean=None, std=None, size=None, threshold: float = 0.5, batch: int = 16) -> DataFrame:
    """(path, ratio, confidence, error) of PNG images (path, content): the share of pixels whose probability reaches the threshold, and their mean
    probability (0 without any). An image is a row and stays where it is read; a worker loads the model once and gives it up to `batch` images of one
    size at a time. An image that can't be decoded has an error and no figures."""
    get = model.send(images.sparkSession)

    def run(batches):
        net = get()
        for b in batches:
            paths, shapes, failed = b.column(0).to_pylist(), {}, {}
            for i, body in enumerate(b.column(1)):
                try:
                    x = prepared(codecs.unit_scale(codecs.decode_png(body.as_py() or b"")), channels, mean, std, size)
                    shapes.setdefault(x.shape, []).append((i, x))
                except Exception as e:
                    failed[i] = f"{type(e).__name__}: {e}"
            ratio, confidence = [None] * len(paths), [None] * len(paths)
            for own in shapes.values():
                for k in range(0, len(own), batch):
                    some = own[k : k + batch]
                    for (i, _), p in zip(some, np.asarray(net(np.stack([x for _, x in some])), float), strict=True):
                        found = p >= threshold
                        ratio[i], confidence[i] = float(found.mean()), float(p[found].mean()) if found.any() else 0.0
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(ratio, pa.float64()), pa.array(confidence, pa.float64()), pa.array([failed.get(i) for i in range(len(paths))], pa.string())], names=["path", "ratio", "confidence", "error"])

    return images.select("path", "content").mapInArrow(run, "path string, ratio double, confidence double, error string")


def segment(frames: DataFrame, model: Callable[[np.ndarray], np.ndarray], channels: int = 3, mean=None, std=None, size=None) -> DataFrame:
    """Probabilities (tf_name, split, frame, row, col, p) of a model (channels x height x width -> height x width) over pixel rows.

    A frame is a group of its own; images are a bounded size. `mean` and `std` (both or none): a number or one for each channel; `size`: the
    model's input, a number or (height, width).
    """

    def run(key, pdf):
        h, w = int(pdf["row"].max()) + 1, int(pdf["col"].max()) + 1
        order = pdf.sort_values(["row", "col"])
        rgba = [order[c].to_numpy().reshape(h, w) if c in order else np.ones((h, w)) for c in "rgba"]
        if size:
            h, w = (int(size),) * 2 if np.isscalar(size) else map(int, size)
            rgba = list(np.moveaxis(resize(np.stack(rgba, -1), h, w), -1, 0))
        p = np.asarray(model(prepared(np.stack(rgba, -1), channels, mean, std)), float)
        row, col = np.divmod(np.arange(h * w, dtype=np.int32), w)
        return pd.DataFrame({"tf_name": key[0], "split": key[1], "frame": key[2], "row": row, "col": col, "p": p.ravel()})

    return frames.groupBy("tf_name", "split", "frame").applyInPandas(run, "tf_name string, split string, frame string, row int, col int, p double")


def resize(image: np.ndarray, h: int, w: int) -> np.ndarray:
    """Bilinear, through 8 bits as image files would: cut to 0..1, times 255, resized, over 255."""
    x = np.clip(image, 0, 1) * 255
    x = x.astype(np.uint8).astype(np.float32)
    at = lambda n, m: np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
    r, c = at(x.shape[0], h), at(x.shape[1], w)
    r0, c0 = np.floor(r).astype(int), np.floor(c).astype(int)
    r1, c1 = np.minimum(r0 + 1, x.shape[0] - 1), np.minimum(c0 + 1, x.shape[1] - 1)
    fr, fc = (r - r0)[:, None, None], (c - c0)[None, :, None]
    x = x if x.ndim == 3 else x[..., None]
    out = (x[r0][:, c0] * (1 - fr) + x[r1][:, c0] * fr) * (1 - fc) + (x[r0][:, c1] * (1 - fr) + x[r1][:, c1] * fr) * fc
    return np.round(out) / 255
