"""Shared pieces of the training-data operators: inputs, shared scratch tables, hashing."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
BATCH_ROWS = 2000
GOLDEN = U64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under the names the operators use; other columns, however named, go."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for dst, src in cols.items()])


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); set to a temporary one only where unset."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if sc.getCheckpointDir() is None and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = sc.getCheckpointDir() or f"file://{tempfile.mkdtemp(prefix='lumengrid-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/lumengrid/{name}-{uuid.uuid4().hex}"


#: Settings that hold while a table is written: Python workers hold a batch at a time (texts can be long), and a table's
#: shuffle files go as soon as it is there.
_ROWS, _FILES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths of the tables written within each open tables() block, innermost last.
_open: list[set[str]] = []


def written(df: DataFrame, name: str, compression: str | None = None, by: str | None = None, rows: int = BATCH_ROWS) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors. by: a column whose
    values have folders of their own, which discard() can delete one by one. rows: of a batch to a Python worker at most."""
    spark = df.sparkSession
    path, before = scratch(spark, name), {k: spark.conf.get(k) for k in (_ROWS, _FILES)}
    usual = int(before[_ROWS])
    spark.conf.set(_ROWS, min(usual, rows) if usual > 0 else rows)
    spark.conf.set(_FILES, "true")
    try:
        to = df.write.option("compression", compression) if compression else df.write
        (to.partitionBy(by) if by else to).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    if _open:
        _open[-1].add(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def discard(*tables: DataFrame, only: str | None = None) -> None:
    """Delete tables made by written() that nothing reads any more, or only a folder of theirs (column=value)."""
    for t in tables:
        if only:
            _delete(t.sparkSession, f"{t.scratch_path}/{only}")
            continue
        _delete(t.sparkSession, t.scratch_path)
        for held in _open:
            held.discard(t.scratch_path)


@contextmanager
def tables(spark: SparkSession):
    """Tables written within the block are deleted at its end, but for those given to the function that it yields."""
    mine: set[str] = set()
    kept: set[str] = set()
    _open.append(mine)
    try:
        yield lambda *keep: kept.update(t.scratch_path for t in keep)
    finally:
        _open.remove(mine)
        if _open:
            _open[-1].update(mine & kept)
        for path in mine - kept:
            _delete(spark, path)


def clean(spark: SparkSession) -> None:
    """Delete all tables that operators have written to the shared folder; results that read them must be saved first."""
    _delete(spark, f"{shared_dir(spark).rstrip('/')}/lumengrid")


#: Rows of a table of numbers up to which it is broadcast; larger ones are shuffled.
BROADCAST_ROWS = 1_000_000


def bounded(df: DataFrame) -> DataFrame:
    """Broadcast if it has been counted to be small; else Spark's own choice, which for large tables is to shuffle both sides."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def release() -> None:
    """Give memory that a worker no longer uses back to the system; workers live on from stage to stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, text: str = "text", most: int = 2 << 20):
    """Cut an Arrow batch into slices of about `most` text bytes (one row at least)."""
    n = batch.num_rows
    if n == 0:
        return
    col = batch.column(batch.schema.get_field_index(text))
    size = np.concatenate([[0], np.cumsum(lengths(col))])
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(size, size[lo] + most, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def lengths(col: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each value; null counts as 0."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n+1 offsets; null is empty."""
    import pyarrow.compute as pc

    col = pc.fill_null(col, "") if col.null_count else col
    col = col.cast(pa.large_string())
    off = np.frombuffer(col.buffers()[1], dtype=np.int64, count=len(col) + 1 + col.offset)[col.offset :]
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ODD = U64(0xD6E8FEB86659FD93)
#: Of 8 bytes the first n.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)
#: Bytes of a word that are hashed 8 at a time with those of all others; longer words are hashed one by one.
LONG = 256


def eights(raw: np.ndarray) -> np.ndarray:
    """The 8 bytes from each byte on as a little-endian number, zeros after the end; a view, not a copy for each byte."""
    padded = np.concatenate([raw, np.zeros(16 - len(raw) % 8, np.uint8)])
    return np.lib.stride_tricks.as_strided(padded.view(U64), shape=(len(raw),), strides=(1,))


def words_of(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each maximal run outside [\\x20\\x09-\\x0D], and the first word of each text (n+1)."""
    if not len(raw):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    word = ~_SPACE[raw]
    before = np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    at = off[:-1][off[:-1] < len(raw)]
    before[at] = False
    after = np.empty_like(word)
    after[-1], after[:-1] = False, word[1:]
    after[at[at > 0] - 1] = False
    start, end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return start, end, np.searchsorted(start, off)


def _stirred(x: np.ndarray) -> np.ndarray:
    x ^= x >> U64(29)
    x *= _ODD
    x ^= x >> U64(32)
    return x


def _long_hash(word: np.ndarray, piece: int = 1 << 16) -> np.uint64:
    """Of one word by the sum of a value for each byte and its place."""
    h = 0
    for lo in range(0, len(word), piece):
        part = word[lo : lo + piece]
        h += int(_stirred(mix(np.arange(lo, lo + len(part), dtype=U64) * GOLDEN) + part.astype(U64) * _ODD).sum())
    return U64(h % (1 << 64))


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word, which is not empty, by default with A-Z lower-cased; scratch memory of some bytes a word.

    Eight bytes after the other are mixed into it by more than sums and products, so that no pattern of bytes cancels out, as there
    are some that do in every polynomial modulo 2 ** 64; words of one length up to 8 bytes have different hashes."""
    raw = _LOWER[raw] if lower else raw
    size = end - start
    out = size.astype(U64) * GOLDEN
    at = eights(raw)
    live = np.flatnonzero(size <= LONG)
    for done in range(0, LONG, 8):
        if not len(live):
            break
        left = size[live] - done
        out[live] = _stirred(out[live] ^ (at[start[live] + done] & _FIRST[np.minimum(left, 8)]))
        live = live[left > 8]
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] ^= _long_hash(raw[start[i] : end[i]])
    return mix(out)


def shingle_sets(col: pa.Array, k: int = 5) -> list[np.ndarray]:
    """Of each text the sorted distinct 64-bit hashes of its k-word shingles; all its words as one where it has fewer; empty without words."""
    raw, off = text_bytes(col)
    start, end, first = words_of(raw, off)
    w = word_hashes(raw, start, end)
    n = len(w)
    s = np.zeros(max(0, n - k + 1), U64)
    for j in range(k):
        s = s * U64(0x2545F4914F6CDD1D) + w[j : n - k + 1 + j] if n >= k else s
    s = mix(s + U64(k))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(s[a : b - k + 1]))
        elif b > a:
            h = U64(0)
            with np.errstate(over="ignore"):
                for x in w[a:b]:
                    h = h * U64(0x2545F4914F6CDD1D) + x
                out.append(mix(np.array([h + U64(b - a)], U64)))
        else:
            out.append(np.zeros(0, U64))
    return out


#: Characters below U+0100 of which `re` and every Unicode regex library think alike: no control characters but \t \n \r, no U+0085 or U+00A0.
_PLAIN = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x100)])


def plain(text: str) -> bytes | None:
    """The text's Latin-1 bytes if it has only characters of _PLAIN, else None."""
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return None
    return None if raw.translate(None, _PLAIN) else raw


def spelt(pattern: str, names: dict[str, str]) -> str:
    """The pattern with named classes written out as their characters, within brackets or, elsewhere, in new ones."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        name = next((n for n in names if pattern.startswith(n, i)), None)
        if name:
            out.append(names[name] if inside else f"[{names[name]}]")
            i += len(name)
        elif pattern[i] == "\\":
            out.append(pattern[i : i + 2])
            i += 2
        else:
            inside = pattern[i] == "[" or inside and pattern[i] != "]"
            out.append(pattern[i])
            i += 1
    return "".join(out)
