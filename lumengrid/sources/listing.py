"""What is in a folder: transfer-function files and frames (local or mounted folders, small listings), and cases (any file system that Spark knows)."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import SparkSession

#: File patterns of each reader.
PATTERNS = {"nii": ("*.nii.gz", "*.nii"), "vti": ("*.vti",), "raw": ("*.raw",)}
PATTERNS["nii.gz"] = PATTERNS["nifti"] = PATTERNS["nii"]
PREFERRED = ("ct.nii.gz", "ct.nii", "volume.vti")


def stem(name: str) -> str:
    return name[: -len(".nii.gz")] if name.endswith(".nii.gz") else Path(name).stem


def tf_files(folder: str) -> list[str]:
    """A folder's own tf_config.json, then those of its TF* folders in order."""
    own = Path(folder) / "tf_config.json"
    return [*([str(own)] if own.is_file() else []), *(str(p) for p in sorted(Path(folder).glob("TF*/tf_config.json")))]


def tf_outputs(folder: str) -> list[dict]:
    return [{"tf_name": Path(p).parent.name, "tf_json": p, "tf_dir": str(Path(p).parent)} for p in tf_files(folder)]


def frames(tf_dir: str) -> list[str]:
    """Frames of train, test and val, each sorted."""
    return [str(p) for s in ("train", "test", "val") for p in sorted((Path(tf_dir) / s).glob("*.png"))]


def plain(path: str) -> str:
    """A path as Spark lists it, without the scheme if that is of local files."""
    return re.sub(r"^file:/+", "/", path)


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Files that a pattern matches, in any file system that Spark knows."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return [plain(f.getPath().toString()) for f in found or [] if f.isFile()]


def cases(spark: SparkSession, root: str, reader: str, pattern: str = "s*", filename: str | None = None) -> list[dict]:
    """Case folders below root, sorted, with their input: the named file, or of the matches of the reader's patterns, by path, the first with a preferred
    name, else the first. Folders without an input are left out."""
    inputs: dict[str, list[str]] = {}
    for g in [filename] if filename else PATTERNS.get(str(reader).lower(), ("*",)):
        for path in matches(spark, f"{root.rstrip('/')}/{pattern}/{g}"):
            inputs.setdefault(path.rsplit("/", 1)[0], []).append(path)
    out = []
    for folder, own in sorted(inputs.items()):
        path = min(set(own), key=lambda p: (p.rsplit("/", 1)[1] not in PREFERRED, p))
        name = path.rsplit("/", 1)[1]
        out.append({"case_id": folder.rsplit("/", 1)[1], "case_dir": folder, "input_path": path, "input_name": name, "input_stem": stem(name)})
    return out
