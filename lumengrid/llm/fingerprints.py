"""Document fingerprints: one-permutation MinHash with optimal densification, packed low-order bits.

A text's 5-word shingles are hashed once; the high bits of a hash name its bin, and a bin keeps its smallest hash. An
empty bin takes the value of the first filled bin in a random order of its own (the order is fixed for each bin, so
equal sets agree). Only the low `bits` bits of each bin are stored. Two fingerprints agree by chance in a share 2**-bits
of the bins, which `likeness` corrects.

Edge cases: null text counts as empty; a text without words has the fingerprint "" (alike 1 to another such one, 0 to any
other); fewer than five words are one shingle. Rows are ordered by descending doc_id (null last), rows of equal ids by a
hash of their text; ids may be numbers or strings. Texts of any length are read whole. A table of one row has itself as the next document; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

BINS, BITS = 512, 4
#: Ids that are not numbers, for each bucket, by which such rows are dealt to buckets.
SAMPLE = 20


@lru_cache(maxsize=4)
def _orders(bins: int) -> tuple[np.ndarray, np.ndarray]:
    """For each bin a random order of all bins, and each bin's place in that order."""
    order = np.argsort(np.random.default_rng(20240229).random((bins, bins)), axis=1).astype(np.int32)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(bins, dtype=np.int32), (bins, bins)), axis=1)
    return order, place


def sketch(shingles: np.ndarray, bins: int = BINS, bits: int = BITS) -> np.ndarray:
    """The low bits of each bin's smallest hash, empty bins filled; shingles: sorted distinct hashes, not none."""
    which = (shingles >> np.uint64(65 - bins.bit_length())).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]]))
    filled = which[first]
    source = np.zeros(bins, np.int64)  # of each bin, the shingle whose value it takes
    source[filled] = first

    def low() -> np.ndarray:
        # The bin's number is mixed in, so that bins with one source don't agree by chance together.
        return (common.mix(shingles[source] + np.arange(bins, dtype=np.uint64) * common.GOLDEN) & np.uint64((1 << bits) - 1)).astype(np.uint8)

    if len(filled) == bins:
        return low()
    order, place = _orders(bins)
    has = np.zeros(bins, bool)
    has[filled] = True
    empty = np.flatnonzero(~has)
    if len(filled) <= 64:
        source[empty] = source[filled[place[empty][:, filled].argmin(axis=1)]]
        return low()
    t = 0
    while len(empty):
        at = order[empty, t]
        ok = has[at]
        source[empty[ok]] = source[at[ok]]
        empty = empty[~ok]
        t += 1
    return low()


def pack(values: np.ndarray, bits: int = BITS) -> str:
    """Hex of the values' low bits, most significant first."""
    if bits == 4:
        return (values[0::2] << 4 | values[1::2]).astype(np.uint8).tobytes().hex()
    wide = np.unpackbits(values[:, None], axis=1)[:, 8 - bits :]
    return np.packbits(wide.ravel()).tobytes().hex()


def unpack(text: str, bins: int = BINS, bits: int = BITS) -> np.ndarray:
    raw = np.unpackbits(np.frombuffer(bytes.fromhex(text), np.uint8))[: bins * bits].reshape(bins, bits)
    return raw @ (1 << np.arange(bits - 1, -1, -1))


def _alike(a: np.ndarray | None, b: np.ndarray | None, bits: int = BITS) -> float:
    if a is None or b is None:
        return float(a is b)
    chance = 0.5**bits
    return float(min(1.0, max(0.0, (np.mean(a == b) - chance) / (1 - chance))))


def likeness(a: str, b: str, bins: int = BINS, bits: int = BITS) -> float:
    """Bias-corrected estimate of the Jaccard similarity of two fingerprints' shingle sets."""
    return _alike(unpack(a, bins, bits) if a else None, unpack(b, bins, bits) if b else None, bits)


def _sketches(texts: list[str], bins: int, bits: int) -> list[np.ndarray | None]:
    return [sketch(s, bins, bits) if len(s) else None for s in common.shingle_sets(pa.array(texts, pa.large_string()))]


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS, bits: int = BITS) -> DataFrame:
    """doc_id and fingerprint of every row."""

    def run(batches):
        for batch in batches:
            for part in common.slices(batch):
                got = [pack(x, bits) if x is not None else "" for x in _sketches([x or "" for x in part.column(1).to_pylist()], bins, bits)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(got, pa.string())], names=["doc_id", "fingerprint"])

    rows = common.pick(docs, doc_id=id_col, text=text_col)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def _bucket(x: Column, bounds: list) -> Column:
    """How many of the sorted bounds are below x, found in two steps of about the square root of their number."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    below = lambda part: F.size(F.filter(part, lambda b: b < x))
    chunk = F.greatest(below(F.lit(bounds[::step])) - 1, F.lit(0))
    return chunk * step + below(F.slice(F.lit(bounds), chunk * step + 1, F.lit(step)))


def _bounds(docs: DataFrame, buckets: int) -> list:
    """Ids that cut the rows into about as many buckets; only the dealing of rows hangs on them. Numbers: approximate
    quantiles. Other ids: quantiles of the SAMPLE ids for each bucket with the least hashes."""
    probs = [i / buckets for i in range(1, buckets)]
    if not probs:
        return []
    if isinstance(docs.schema["doc_id"].dataType, T.NumericType):
        return sorted(set(docs.agg(F.percentile_approx("doc_id", probs, 20 * buckets)).first()[0] or []))
    few = docs.select("doc_id").where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE * buckets)
    ids = sorted(r[0] for r in few.collect())  # SAMPLE for each bucket at most
    return sorted({ids[int(p * len(ids))] for p in probs}) if ids else []


def _with_next(docs: DataFrame, buckets: int, parts: int) -> DataFrame:
    """Rows (bucket, halo, doc_id, text), dealt by ranges of doc_id and sorted within each by descending doc_id; each
    bucket ends with a halo row: the first row of the bucket that follows it, so that every row's successor is at hand."""
    bounds = _bounds(docs, buckets)
    # Rows without an id follow all others by the hash of their text, of which equal ranges are buckets too, counted down from -1.
    part = F.shiftright(F.xxhash64(F.coalesce("text", F.lit(""))), 40) + (1 << 23)
    none = -1 - F.shiftright(part * max(1, buckets), 24).cast("int")
    rows = docs.select(F.when(F.col("doc_id").isNull(), none).otherwise(_bucket(F.col("doc_id"), bounds)).alias("bucket"), "doc_id", "text")
    # One row for each bucket: there are twice as many as asked for at most.
    tops = sorted(((r[0], r[1]) for r in rows.groupBy("bucket").agg(F.max("doc_id")).collect()), reverse=True)
    before = {b: tops[i - 1][0] for i, (b, _) in enumerate(tops)}
    ids = [x for _, x in tops if x is not None]
    first = rows.where(F.col("doc_id").isin(ids) | F.col("doc_id").isNull()) if any(x is None for _, x in tops) else rows.where(F.col("doc_id").isin(ids))
    to = F.create_map(*[F.lit(v) for kv in before.items() for v in kv]) if before else F.lit(None)
    halo = (
        first.groupBy("bucket", "doc_id").agg(F.min(F.struct(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")).alias("m"))
        .select((to[F.col("bucket")] if before else F.lit(0)).alias("bucket"), F.lit(True).alias("halo"), "doc_id", F.col("m.text").alias("text"))
    )
    both = rows.select("bucket", F.lit(False).alias("halo"), "doc_id", "text").unionByName(halo)
    return both.repartition(parts, "bucket").sortWithinPartitions(
        "bucket", "halo", F.col("doc_id").desc_nulls_last(), F.xxhash64(F.coalesce("text", F.lit("")))
    )


def edited_text(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by the first as many (or all) of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Fingerprints of every row and of its edited text, and their likeness to each other and to the next document's."""
    spark = docs.sparkSession
    parts = common.shuffle_parts(spark)
    rows = common.pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        held: tuple | None = None  # the last row so far: it waits for its successor
        for batch in batches:
            for part in common.slices(batch):
                halo, ids = part.column(1).to_pylist(), part.column(2).to_pylist()
                texts = [x or "" for x in part.column(3).to_pylist()]
                marks = _sketches(texts, bins, bits)
                if held:
                    halo, ids, texts, marks = [held[0], *halo], [held[1], *ids], [held[2], *texts], [held[3], *marks]
                held = halo[-1], ids[-1], texts[-1], marks[-1]
                own = [i for i in range(len(ids) - 1) if not halo[i]]
                edits = [edited_text(texts[i], texts[i + 1]) for i in own]
                made = _sketches(edits, bins, bits)
                hexed = lambda x: pack(x, bits) if x is not None else ""
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[i] for i in own], part.column(2).type),
                        pa.array([len(texts[i]) for i in own], pa.int64()),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edits], pa.string()),
                        pa.array([hexed(marks[i]) for i in own], pa.string()),
                        pa.array([hexed(x) for x in made], pa.string()),
                        pa.array([_alike(marks[i], x, bits) for i, x in zip(own, made, strict=True)], pa.float64()),
                        pa.array([_alike(marks[i], marks[i + 1], bits) for i in own], pa.float64()),
                    ],
                    names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    return _with_next(rows, 4 * parts, parts).mapInArrow(
        run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10 over the whole of documents."""
    return compare_with_edits(common.table(spark, sf_dir, "documents"))
