"""Segmentation of image files by a model that is sent to the workers."""

import hashlib
import io
import json
import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest

from lumengrid.operators import qc, render
from lumengrid.sources import codecs, readers


def loader():
    def load(body):
        """A model of one layer: the weighted sum of the channels, cut to 0..1."""
        w = np.load(io.BytesIO(body))["w"]
        return lambda images: np.clip(np.tensordot(w, images, axes=(0, 1)), 0, 1)

    return load


load = loader()  # workers don't import this module


@pytest.fixture
def place(tmp_path):
    rng = np.random.default_rng(1)
    images = {}
    for tf, split, name, shape in (("TF01", "train", "a", (6, 8)), ("TF01", "train", "b", (6, 8)), ("TF01", "test", "c", (5, 5)), ("TF02", "train", "a", (6, 8))):
        px = rng.integers(0, 256, (*shape, 4)).astype(np.uint8) if tf == "TF01" else np.zeros((*shape, 4), np.uint8)
        (tmp_path / "frames" / tf / split).mkdir(parents=True, exist_ok=True)
        (tmp_path / "frames" / tf / split / f"{name}.png").write_bytes(codecs.encode_png(px))
        images[tf, split, name] = px
    (tmp_path / "frames" / "TF02" / "train" / "b.png").write_bytes(b"broken")
    np.savez(tmp_path / "model.npz", w=np.array([0.5, 0.3, 0.2]))
    return tmp_path, images


def test_images_are_segmented_where_they_are(spark, place):
    folder, images = place
    body = (folder / "model.npz").read_bytes()
    model = render.ModelFile(str(folder / "model.npz"), load, hashlib.sha256(body).hexdigest().upper())
    got = render.segment_images(readers.read_images(spark, str(folder / "frames")), model, threshold=0.5, batch=2)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    rows = {(r["tf_name"], r["split"], r["frame"]): r for r in got.select(*readers.frame_of("path"), "ratio", "confidence", "error").collect()}
    assert len(rows) == 5 and "ValueError" in rows["TF02", "train", "b"]["error"] and rows["TF02", "train", "b"]["ratio"] is None
    for key, px in images.items():
        p = np.clip((px[..., :3] / 255.0) @ [0.5, 0.3, 0.2], 0, 1)
        assert abs(rows[key]["ratio"] - (p >= 0.5).mean()) < 0.05 and (p < 0.5).all() == (rows[key]["confidence"] == 0.0)
    frames = qc.detected(got.select(*readers.frame_of("path"), "ratio", "confidence"), 0.1, 0.5)
    verdict = {r["tf_name"]: r for r in qc.segmentation_verdict(frames).collect()}
    assert verdict["TF01"]["detected_frames"] == 3 and not verdict["TF02"]["passed"] and verdict["TF02"]["total"] == 2


def test_it_is_what_pixel_rows_give(spark, place):
    folder, _ = place
    (folder / "frames" / "TF02" / "train" / "b.png").unlink()
    model = render.ModelFile(str(folder / "model.npz"), load)
    one = load((folder / "model.npz").read_bytes())
    for how in ({}, {"size": (4, 4)}, {"mean": [0.4, 0.5, 0.6], "std": 0.5}):
        a = render.segment_images(readers.read_images(spark, str(folder / "frames")), model, **how).select(*readers.frame_of("path"), "ratio", "confidence")
        b = qc.segmentation_frames(render.segment(readers.read_pixels(spark, str(folder / "frames")), lambda x: one(x[None])[0], **how), 0.5)
        rows = [sorted((r["tf_name"], r["split"], r["frame"], round(r["ratio"], 6), round(r["confidence"], 5)) for r in df.collect()) for df in (a, b)]
        assert rows[0] == rows[1]


def test_a_wrong_digest_raises(spark, place):
    folder, _ = place
    (folder / "other.npz").write_bytes((folder / "model.npz").read_bytes())
    with pytest.raises(Exception, match="not the file with digest"):
        render.segment_images(readers.read_images(spark, str(folder / "frames")), render.ModelFile(str(folder / "other.npz"), load, "0" * 64)).collect()


def test_command_line(place):
    folder, _ = place
    root = Path(__file__).resolve().parents[1]
    args = ["test-seg", str(folder / "frames"), "--model", "tests.test_models:load", "--checkpoint", str(folder / "model.npz"), "--output", str(folder / "seg.json")]
    done = subprocess.run([sys.executable, "-m", "lumengrid.cli", *args], cwd=root, env=os.environ | {"PYTHONPATH": str(root)}, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert {r["tf_name"]: r["total"] for r in json.loads((folder / "seg.json").read_text())} == {"TF01": 3, "TF02": 2}
