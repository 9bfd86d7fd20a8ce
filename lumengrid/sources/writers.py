"""Files written by many tasks each, one or many in a write: point clouds (PLY, NPZ) and grids (VTK image), as Spark data sources. The first column
of the rows says which of the files a row belongs to.

A task encodes its rows into part files of its own names beside the target and reports them; the commit puts a head and the reported parts
together, byte by byte in some MB at a time, and moves the result to its place. No row passes the driver. A task that is run again writes new
parts, which replace those of its first try in what is reported; parts nobody reported go with the folder. A write that fails leaves the
target as it was (a task that still runs when the write is given up may leave its part in <target>.parts-...).

The target's folder must be one that driver and tasks share.
"""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from . import codecs

COPY = 8 << 20
#: Bytes of a slab of a grid that a task holds.
SLAB = 16 << 20


def system(path: str):
    """The file system of a path, and the path in it."""
    from pyarrow import fs

    if re.match(r"^(?!file:)[a-z][a-z0-9+.-]*://", path):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), re.sub(r"^file:(//)?", "", path)


@dataclass
class Parts(WriterCommitMessage):
    """Of a task: (number of the file, order, name of the stream, part, items) for each part."""

    parts: list[tuple[int, int, str, str, int]]


class FileWriter(DataSourceArrowWriter):
    """encode() makes (file, order, stream, bytes, items) of a task's batches, join() writes a file from its parts in order."""

    def __init__(self, options: dict):
        self.options, self.paths = options, options["path"].split("\n")
        self.folder = f"{self.paths[0]}.parts-{uuid.uuid4().hex}"

    def encode(self, batches, task: int):
        raise NotImplementedError

    def join(self, out, parts: list[tuple[int, str, str, int]], copy) -> None:
        raise NotImplementedError

    def write(self, batches):
        fs, folder = system(self.folder)
        fs.create_dir(folder, recursive=True)
        done: list[tuple[int, int, str, str, int]] = []
        open_: dict[tuple[int, int, str], tuple] = {}
        try:
            for *key, body, items in self.encode(batches, TaskContext.get().partitionId()):
                key = tuple(key)
                if key not in open_:
                    name = f"{folder}/{uuid.uuid4().hex}"
                    open_[key] = (fs.open_output_stream(name), name, [0])
                open_[key][0].write(body)
                open_[key][2][0] += items
        finally:
            for key, (f, name, items) in open_.items():
                f.close()
                done.append((*key, name, items[0]))
        return Parts(done)

    def commit(self, messages) -> None:
        fs, folder = system(self.folder)
        fs.create_dir(folder, recursive=True)
        parts: list[list] = [[] for _ in self.paths]
        for m in messages:
            for file, *part in m.parts if m is not None else ():
                parts[file].append(tuple(part))

        def copy(out, name: str) -> None:
            with fs.open_input_stream(name) as f:
                while body := f.read(COPY):
                    out.write(body)

        for i, own in enumerate(parts):
            with fs.open_output_stream(f"{folder}/whole-{i}") as out:
                self.join(out, sorted(own), copy)
        for i, path in enumerate(self.paths):
            fs.move(f"{folder}/whole-{i}", system(path)[1])
        fs.delete_dir(folder)

    def abort(self, messages) -> None:
        fs, folder = system(self.folder)
        if fs.get_file_info(folder).type.name == "Directory":
            fs.delete_dir(folder)


def by_file(b: pa.RecordBatch):
    """(file, its rows without the first column) of a batch."""
    if b.num_rows:
        file = b.column(0).to_numpy()
        rest = b.select(b.schema.names[1:])
        kinds = np.unique(file).tolist()
        for k in kinds:
            yield k, rest if len(kinds) == 1 else rest.filter(pa.array(file == k))


class PlyWriter(FileWriter):
    """ASCII, six decimals."""

    def encode(self, batches, task):
        for whole in batches:
            for file, b in by_file(whole):
                cols = [c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in b.columns]
                text = io.StringIO()
                np.savetxt(text, np.column_stack(cols), "%.6f")
                yield file, task, "", text.getvalue().encode("ascii"), b.num_rows

    def join(self, out, parts, copy):
        names = self.options["columns"].split("\n")
        head = f"ply\nformat ascii 1.0\nelement vertex {sum(p[3] for p in parts)}\n" + "".join(f"property float {c}\n" for c in names) + "end_header\n"
        out.write(head.encode("ascii"))
        for p in parts:
            copy(out, p[2])


class NpzWriter(FileWriter):
    """An array for each column; those of arrays have as many columns as the arrays have numbers, which must be as many in all rows."""

    def encode(self, batches, task):
        for whole in batches:
            for file, b in by_file(whole):
                for name, col in zip(b.schema.names, b.columns, strict=True):
                    width = ""
                    if pa.types.is_list(col.type):
                        flat = col.flatten()
                        if col.null_count or len(flat) % len(col) or len(set(np.diff(col.offsets.to_numpy()).tolist())) > 1:
                            raise ValueError(f"{name}: arrays of different lengths")
                        width, col = str(len(flat) // len(col)), flat
                    if col.null_count and not pa.types.is_floating(col.type):
                        raise ValueError(f"{name}: nulls among whole numbers")
                    values = col.to_numpy(zero_copy_only=False)
                    yield file, task, f"{name}\n{values.dtype.str}\n{width}", np.ascontiguousarray(values).tobytes(), b.num_rows

    def join(self, out, parts, copy):
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, allowZip64=True) as z:
            for spec in self.options["columns"].split("\n"):
                column, dtype, width = spec.split("|")
                own = [p for p in parts if p[1].split("\n")[0] == column]
                kinds = {tuple(p[1].split("\n")[1:]) for p in own} or {(dtype, width)}
                if len(kinds) > 1:
                    raise ValueError(f"{column}: arrays of different lengths")
                dtype, width = kinds.pop()
                rows = sum(p[3] for p in own)
                with z.open(f"{column}.npy", "w", force_zip64=True) as f:
                    np.lib.format.write_array_header_1_0(f, {"descr": dtype, "fortran_order": False, "shape": (rows, int(width)) if width else (rows,)})
                    for p in own:
                        copy(f, p[2])


class VtiWriter(FileWriter):
    """Rows (file, slab, z, y, x, v), sorted by file and slab in a task, which has slabs whole: raw appended data, slab after slab; cells without a row are 0."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.shape = tuple(int(n) for n in options["shape"].split(","))
        self.planes, self.dtype = int(options["planes"]), np.dtype(options["dtype"])

    def encode(self, batches, task):
        nz, ny, nx = self.shape
        held, grid = None, None

        def flush():
            return *held, "", grid.astype(self.dtype.newbyteorder("<")).tobytes(), len(grid)

        for b in batches:
            file, slab, z, y, x, v = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            cuts = [0, *(np.flatnonzero((np.diff(slab) != 0) | (np.diff(file) != 0)) + 1).tolist(), len(slab)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if (now := (int(file[lo]), int(slab[lo]))) != held:
                    if held is not None:
                        yield flush()
                    held = now
                    grid = np.zeros((min(self.planes, nz - held[1] * self.planes), ny, nx), self.dtype)
                grid[z[lo:hi] - held[1] * self.planes, y[lo:hi], x[lo:hi]] = v[lo:hi]
        if held is not None:
            yield flush()

    def join(self, out, parts, copy):
        from ..operators.geometry import Geometry

        nz, ny, nx = self.shape
        g = [float(x) for x in self.options["geometry"].split(",")]
        head, tail = codecs.vti_frame(self.shape, self.dtype, Geometry(tuple(g[:3]), tuple(g[3:6]), (tuple(g[6:9]), tuple(g[9:12]), tuple(g[12:]))), self.options["array"])
        out.write(head)
        own = {p[0]: p[2] for p in parts}
        for s in range(-(-nz // self.planes)):
            if s in own:
                copy(out, own[s])
            else:
                out.write(bytes(min(self.planes, nz - s * self.planes) * ny * nx * self.dtype.itemsize))
        out.write(tail)


def _source(kind: str, writer_class: type) -> type:
    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return kind

        def writer(self, schema, overwrite):
            return writer_class(dict(self.options))

    return Source


SOURCES = {"ply_file": PlyWriter, "npz_file": NpzWriter, "vti_file": VtiWriter}


def save(rows: DataFrame, kind: str, paths: str | list[str], **options: str) -> int:
    """Write the rows (first column: number of the file, from 0) as files; how many rows there were."""
    spark = rows.sparkSession
    paths = [paths] if isinstance(paths, str) else paths
    spark.dataSource.register(_source(kind, SOURCES[kind]))
    for path in paths:
        fs, name = system(path)
        if "/" in name:
            fs.create_dir(name.rsplit("/", 1)[0], recursive=True)
    seen = Observation()
    w = rows.observe(seen, F.count(F.lit(1)).alias("n")).write.format(kind).mode("append").option("path", "\n".join(paths))
    for k, v in options.items():
        w = w.option(k, v)
    w.save()
    return seen.get["n"]


def planes(shape: tuple[int, int, int], dtype: str) -> int:
    """Planes of z that a slab has."""
    return max(1, min(shape[0], SLAB // max(1, shape[1] * shape[2] * np.dtype(dtype).itemsize)))


def npy_width(kind: str) -> str:
    """How an empty column of a Spark type is written."""
    base = kind[6:-1] if kind.startswith("array<") else kind
    return {"tinyint": "|i1", "smallint": "<i2", "int": "<i4", "bigint": "<i8", "float": "<f4", "boolean": "|b1"}.get(base, "<f8").replace("|", "") + ("|0" if kind.startswith("array<") else "|")

