"""The declarative pipeline document: JSON or YAML with io, preprocess, sampling and optional render, export and batch."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path


class ConfigError(ValueError):
    """The document can't be read or lacks something."""


@dataclass
class Part:
    """A plugin's name and its parameters."""

    name: str
    params: dict = field(default_factory=dict)


@dataclass
class Config:
    reader: Part
    path: str
    preprocess: list[Part]
    sampling: Part
    render: Part | None = None
    export: Part | None = None
    export_path: str | None = None
    tiling: dict | None = None
    qc: dict | None = None


def load(path: str) -> dict:
    """A mapping from a .json file, or YAML under any other name."""
    try:
        text = Path(path).read_text(encoding="utf-8")
        if path.endswith(".json"):
            doc = json.loads(text)
        else:
            import yaml

            doc = yaml.safe_load(text)
    except Exception as e:
        raise ConfigError(f"{path}: {e}") from e
    if not isinstance(doc, dict):
        raise ConfigError(f"{path}: a mapping is expected")
    return doc


def _need(doc: dict, key: str, where: str):
    if not isinstance(doc, dict) or not doc.get(key):
        raise ConfigError(f"{where}.{key} is required")
    return doc[key]


def tiling(io: dict) -> dict | None:
    """Nested `tiling` or `tile`, or flat keys; a size alone turns it on; the stride defaults to the size. Triples are x, y, z as
    in the document and are returned in z, y, x."""
    own = io.get("tiling") or io.get("tile") or {k.removeprefix("tile_") if k != "tile_size" else k: v for k, v in io.items() if k.startswith("tile_")}
    size = own.get("tile_size", own.get("size"))
    if not own.get("enabled", size is not None):
        return None
    if size is None:
        raise ConfigError("tiling needs tile_size")
    three = lambda v: tuple(reversed([int(v)] * 3 if isinstance(v, int) else [int(x) for x in v]))
    limits = {k: own[k] for k in ("max_voxels", "max_dim", "max_shape_xyz") if own.get(k) is not None}
    return {"tile": three(size), "stride": three(own.get("stride", size)), "pad": bool(own.get("pad", False)), "limits": limits}


def parse(doc: dict) -> Config:
    io = _need(doc, "io", "config")
    sampling = _need(doc, "sampling", "config")
    stages = []
    for i, s in enumerate(doc.get("preprocess") or []):
        stages.append(Part(_need(s, "name", f"preprocess[{i}]"), dict(s.get("params") or {})))
    render = doc.get("render")
    export = doc.get("export")
    return Config(
        reader=Part(_need(io, "reader", "io"), dict(io.get("params") or {})),
        path=_need(io, "path", "io") if "path" in io else _need(io, "input", "io"),
        preprocess=stages,
        sampling=Part(_need(sampling, "name", "sampling"), dict(sampling.get("params") or {})),
        render=Part(render.get("renderer") or _need(render, "name", "render"), dict(render.get("params") or {})) if render else None,
        export=Part(export.get("exporter") or _need(export, "name", "export"), dict(export.get("params") or {})) if export else None,
        export_path=(export or {}).get("path"),
        tiling=tiling(io),
        qc=(render or {}).get("qc"),
    )


class _Known(dict):
    def __missing__(self, key):
        return "{" + key + "}"


def fill(value, names: dict):
    """Templates filled in throughout a document; names that are not known stay as they are."""
    if isinstance(value, str):
        return value.format_map(_Known(names))
    if isinstance(value, dict):
        return {k: fill(v, names) for k, v in value.items()}
    if isinstance(value, list):
        return [fill(v, names) for v in value]
    return value


def flags(params: dict) -> list[str]:
    """Command-line flags: None and False left out, True alone, lists joined by commas."""
    out: list[str] = []
    for k, v in params.items():
        if v is None or v is False:
            continue
        out.append(f"--{k}")
        if v is not True:
            out.append(",".join(map(str, v)) if isinstance(v, (list, tuple)) else str(v))
    return out
