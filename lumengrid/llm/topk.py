"""Exact top-k search by inner product over a bit-sliced index.

Components are quantised to floor(scale * x). Rows are packed into blocks; in a block, bit j of component d of all its rows is
one bitmap (a slice), component values counted from the block's least one. For a query, the slices of every component are
added up, weighted with the query's digits (non-adjacent form: fewest non-zero digits), by carry-save adders over whole bitmaps:
positive and negative terms each give a sum in bit slices, and their difference is the score of all rows at once. The k best are
taken from the most significant slice downward: a slice either holds more of the rows still in question than are wanted, which
rules out the others, or its rows are in. Rows that are alike in all slices are ties at the boundary; as rows of a block are
ordered by id, the first of them are taken. Blocks' results meet by query, where the k best are kept.

Nothing is estimated, so results are exact. Building the index shuffles nothing; blocks and packs of queries are written to the
shared folder. Packs are dealt into chunks of some CHUNK bytes, measured, each of which is broadcast to the workers: the work of the
query set against all rows goes block by block. No join puts a block beside its packs, as a row of the join would be a copy of the
block and Spark holds all rows that one block makes; a worker gets a block once for each of its shares and chunks, and one at a time.

Edge cases: vectors that are null, or hold a null or non-finite component, take no part. Vectors meet those of their own length
only. Quantised components and scores saturate at the range of a long (sums are exact before that). A row with a null id is a
candidate that comes after all ids among ties, and no query. Rows that repeat are rows of their own: each is a query if its id
says so, and a candidate of the other. Fewer candidates than k give fewer rows, none give none; an empty table gives an empty one; other
columns, however named, are ignored. Ids are integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

U = np.uint64
ONE = U(1)
#: Rows of a block at most, and bits of its slices, by which long vectors get fewer rows.
ROWS, BITS = 1 << 16, 1 << 26
#: Queries of a pack at most, and bytes.
PACK, PACK_BYTES = 32, 1 << 20
#: Bytes of packs that are broadcast at a time.
CHUNK = 32 << 20
LO, HI = -(1 << 63), (1 << 63) - 1

PARTS = "block long, pack int, dims int, n int, ids binary, at binary, body binary, bits binary, least binary"
FOUND = "q_block long, q_at int, query_id long, vec_id long, score long"


def quantise(values: np.ndarray, scale: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * values), -(2.0**63), 2.0**63 - 1024).astype(np.int64)


def slices_of(q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bitmaps (slices x words) of the columns of q (rows x components) counted from their least values, component by component
    and least bit first; slices of each component; the least values."""
    least = q.min(axis=0)
    up = q.astype(U) - least.astype(U)
    bits = np.array([int(x).bit_length() for x in up.max(axis=0)], np.int32)
    words = -(-len(q) // 64)
    out = np.zeros((int(bits.sum()), words), U)
    row = 0
    for d, b in enumerate(bits.tolist()):
        col = np.ascontiguousarray(up[:, d])
        for j in range(b):
            packed = np.packbits(((col >> U(j)) & ONE).astype(bool), bitorder="little")
            out[row].view(np.uint8)[: len(packed)] = packed
            row += 1
    return out, bits, least


def digits(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the positive and of the negative digits of each value's non-adjacent form."""
    size = np.where(q < 0, (~q).astype(U) + ONE, q.astype(U))
    half = size >> ONE
    both = size + half
    differ = half ^ both
    plus, minus = both & differ, half & differ
    return np.where(q < 0, minus, plus), np.where(q < 0, plus, minus)


def added(slices: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Slices of the sum of 2 ** weight times the bitmap for each (row, weight), by carry-save adders."""
    order = np.argsort(weights, kind="stable")
    rows = rows[order]
    top = int(weights.max(initial=-1))
    start = np.searchsorted(weights[order], np.arange(top + 2))
    out, carry, w = [], slices[:0], 0
    while w <= top or len(carry):
        now = slices[rows[start[w] : start[w + 1]]] if w <= top else slices[:0]
        now = np.concatenate([now, carry]) if len(carry) else now
        over = []
        while len(now) > 2:
            t = len(now) // 3
            a, b, c = now[:t], now[t : 2 * t], now[2 * t : 3 * t]
            x = a ^ b
            over.append((a & b) | (x & c))
            now = np.concatenate([x ^ c, now[3 * t :]])
        if len(now) == 2:
            over.append((now[0] & now[1])[None])
        out.append(np.bitwise_xor.reduce(now, axis=0))
        carry = np.concatenate(over) if over else slices[:0]
        w += 1
    return out


def scores(slices: np.ndarray, bits: np.ndarray, q: np.ndarray) -> list[np.ndarray]:
    """Two's-complement slices, sign last, of the sum over components of q times the value counted from the least."""
    first = np.cumsum(bits) - bits
    bit = np.arange(64, dtype=U)
    sums = []
    for mask in digits(q):
        d, i = np.nonzero((mask[:, None] >> bit) & ONE)
        j = np.arange(int(bits[d].max(initial=0)))
        there = j < bits[d][:, None]
        sums.append(added(slices, (first[d][:, None] + j)[there], (i[:, None] + j)[there]))
    none = np.zeros(slices.shape[1], U)
    out, borrow = [], none
    for w in range(max(map(len, sums))):
        p, m = (s[w] if w < len(s) else none for s in sums)
        out.append(p ^ m ^ borrow)
        borrow = (~p & (m | borrow)) | (m & borrow)
    return [*out, borrow]


def best(slices: list[np.ndarray], rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest (two's-complement slices, sign last) among the rows of a bitmap; of equal ones the first."""
    sure, left = np.zeros_like(rows), rows.copy()
    lack = k
    for w in range(len(slices) - 1, -1, -1):
        high = left & (~slices[w] if w == len(slices) - 1 else slices[w])
        n = int(np.bitwise_count(high).sum())
        if n > lack:
            left = high
        else:
            sure |= high
            left &= ~high
            lack -= n
        if not lack:
            break
    tied = np.flatnonzero(np.unpackbits(left.view(np.uint8), bitorder="little"))[:lack]
    return np.concatenate([np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little")), tied])


def search(block: dict, pack: dict, k: int):
    """(query's position in the pack, row of the block, score) of the k best rows for each query of a pack."""
    slices, bits, least, n = block["slices"], block["bits"], block["least"], block["n"]
    rows = np.zeros(slices.shape[1], U)
    packed = np.packbits(np.ones(n, bool), bitorder="little")
    rows.view(np.uint8)[: len(packed)] = packed
    for i, q in enumerate(pack["q"]):
        among = rows
        at = int(pack["at"][i])
        if pack["block"] == block["block"] and at >= 0:
            among = rows.copy()
            among[at // 64] &= ~(ONE << U(at % 64))
        got = scores(slices, bits, q)
        base = sum(a * b for a, b in zip(q.tolist(), least.tolist(), strict=True))
        for row in best(got, among, k).tolist():
            word, bit = row // 64, U(row % 64)
            value = sum(int((s[word] >> bit) & ONE) << w for w, s in enumerate(got[:-1])) - (int((got[-1][word] >> bit) & ONE) << (len(got) - 1))
            yield i, row, min(max(base + value, LO), HI)


def _parts(scale: float):
    """Rows (id, vector, is it a query, is it a candidate, partition) to blocks (pack -1) and packs of their queries."""

    def emit(ids: np.ndarray, null: np.ndarray, q: np.ndarray, ask: np.ndarray, has: np.ndarray, block: int):
        dims = q.shape[1]
        order = np.lexsort((ids, null, ~has))
        ids, null, q, ask, has = (x[order] for x in (ids, null, q, ask, has))
        n = int(has.sum())
        if n:
            s, bits, least = slices_of(q[:n]) if dims else (np.zeros((0, -(-n // 64)), U), np.zeros(0, np.int32), np.zeros(0, np.int64))
            known = np.packbits(null[:n], bitorder="little")
            yield block, -1, dims, n, ids[:n].tobytes(), known.tobytes(), s.tobytes(), bits.tobytes(), least.tobytes()
        at = np.flatnonzero(ask)
        size = max(1, min(PACK, PACK_BYTES // max(1, 8 * dims)))
        for i in range(0, len(at), size):
            mine = at[i : i + size]
            own = np.where(has[mine], mine, -1).astype(np.int32)
            yield block, i // size, dims, len(mine), ids[mine].tobytes(), own.tobytes(), q[mine].tobytes(), b"", b""

    def run(batches):
        held: dict[int, list] = {}
        count: dict[int, int] = {}
        made, base = 0, 0

        def flush(dims):
            nonlocal made
            cols = [np.concatenate(x) for x in zip(*held.pop(dims), strict=True)]
            count[dims] = 0
            got = list(emit(*cols, (base << 32) + made))
            made += 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got, strict=True), _PARTS_ARROW, strict=True)], schema=_PARTS_ARROW) if got else None

        for batch in batches:
            if not batch.num_rows:
                continue
            base = batch.column(4)[0].as_py()
            vec = batch.column(1)
            size = pc.list_value_length(vec).to_numpy(zero_copy_only=False)
            for dims in np.unique(size[~np.isnan(size)] if size.dtype.kind == "f" else size).astype(int).tolist():
                some = pa.array(np.flatnonzero(size == dims))
                part = batch.take(some)
                flat = part.column(1).flatten()
                values = pc.cast(flat, pa.float64()).to_numpy(zero_copy_only=False).reshape(len(some), dims)
                good = np.isfinite(values).all(axis=1)
                if not good.any():
                    continue
                ids = part.column(0)
                cols = [pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), quantise(values, scale), part.column(2).to_numpy(zero_copy_only=False), part.column(3).to_numpy(zero_copy_only=False)]
                cols = [c[good] for c in cols]
                most = max(64, min(ROWS, BITS // max(1, 10 * dims) // 64 * 64))
                lo = 0
                while lo < len(cols[0]):
                    hi = min(len(cols[0]), lo + most - count.get(dims, 0))
                    held.setdefault(dims, []).append([c[lo:hi] for c in cols])
                    count[dims] = count.get(dims, 0) + hi - lo
                    lo = hi
                    if count[dims] >= most and (out := flush(dims)) is not None:
                        yield out
        for dims in list(held):
            if (out := flush(dims)) is not None:
                yield out

    return run


_PARTS_ARROW = pa.schema(
    [("block", pa.int64()), ("pack", pa.int32()), ("dims", pa.int32()), ("n", pa.int32()), *[(c, pa.binary()) for c in ("ids", "at", "body", "bits", "least")]]
)


def build(vectors: DataFrame, is_query: Column | None, scale: float, queries: DataFrame | None = None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The index: a row for each block (pack -1) and each pack of queries, written to the shared folder."""

    def rows(df: DataFrame, ask: Column, has: bool) -> DataFrame:
        own = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").alias("vec"), F.coalesce(ask, F.lit(False)).alias("ask"))
        # Small files are read by few tasks, so that blocks are full; tables of many blocks stay as they are. No shuffle.
        return own.select("*", F.lit(has).alias("has")).coalesce(max(1, own.select("id").count() // ROWS))

    all_rows = rows(vectors, F.lit(False) if is_query is None else is_query, True)
    if queries is not None:
        all_rows = all_rows.union(rows(queries, F.lit(True), False))
    got = all_rows.select("id", "vec", "ask", "has", F.spark_partition_id().cast("long").alias("part")).mapInArrow(_parts(scale), PARTS)
    return common.written(got, "bit-slices")


def _copies(split: int):
    """Each block once for each of its shares, one after the other, so that nothing holds them all."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                for share in range(split):
                    yield pa.RecordBatch.from_arrays([*batch.slice(i, 1).columns, pa.array([share], pa.int32())], names=[*batch.schema.names, "share"])

    return run


def _found(k: int, asked: Broadcast):
    """asked: packs by share and components."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                words, dims = -(-r["n"] // 64), r["dims"]
                body = np.frombuffer(r["body"], U).reshape(-1, words)
                block = {"block": r["block"], "n": r["n"], "slices": body, "bits": np.frombuffer(r["bits"], np.int32), "least": np.frombuffer(r["least"], np.int64)}
                ids, null = np.frombuffer(r["ids"], np.int64), np.unpackbits(np.frombuffer(r["at"], np.uint8), bitorder="little")
                for q_block, q_pack, n, names, at, q in asked.value.get((r["share"], dims), ()):
                    pack = {"block": q_block, "q": np.frombuffer(q, np.int64).reshape(n, dims), "at": np.frombuffer(at, np.int32)}
                    name = np.frombuffer(names, np.int64)
                    out = [(q_block, q_pack * PACK + i, int(name[i]), None if null[row] else int(ids[row]), score) for i, row, score in search(block, pack, k)]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), *[pa.int64()] * 3), strict=True)], names=["q_block", "q_at", "query_id", "vec_id", "score"])

    return run


def top_k(
    vectors: DataFrame, k: int = 5, is_query: Column | None = None, queries: DataFrame | None = None, scale: float = 256, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: of each query the k rows of `vectors` with the highest integer inner product, ties to
    the smaller id. Queries are the rows of `vectors` for which is_query holds, without themselves as candidates, and all rows of `queries`."""
    spark = vectors.sparkSession
    with common.tables(spark) as keep:
        index = build(vectors, is_query, scale, queries, id_col, vec_col)
        size = F.length("body") + F.length("ids") + F.length("at")
        blocks = index.where("pack < 0")
        total = index.groupBy((F.col("pack") < 0).alias("is_block")).agg(F.count("*").alias("rows"), F.sum(size).alias("bytes")).collect()
        n_blocks, chunks = sum(r["rows"] for r in total if r["is_block"]), max(1, sum(-(-r["bytes"] // CHUNK) for r in total if not r["is_block"]))
        # Few blocks are split over the cores by their queries.
        split = max(1, -(-2 * spark.sparkContext.defaultParallelism // max(1, n_blocks)))
        chunk, share = F.pmod(F.xxhash64("block", "pack"), F.lit(chunks)), F.pmod(F.pmod(F.xxhash64("block"), F.lit(split)) + F.col("pack"), F.lit(split))
        packs = index.where("pack >= 0").withColumns({"chunk": chunk, "share": share.cast("int")})
        theirs = blocks.withColumn("share", F.lit(0))
        if n_blocks and split > 1:
            # By ranges each copy has a task of its own, those of the largest blocks first.
            theirs = blocks.mapInArrow(_copies(split), f"{PARTS}, share int").repartitionByRange(n_blocks * split, F.desc("n"), "block", "share")
        parts = []
        for c in range(chunks):
            mine: dict[tuple[int, int], list[tuple]] = {}
            for r in packs.where(F.col("chunk") == c).select("share", "dims", "block", "pack", "n", "ids", "at", "body").collect():
                mine.setdefault((r["share"], r["dims"]), []).append((r["block"], r["pack"], r["n"], bytes(r["ids"]), bytes(r["at"]), bytes(r["body"])))
            if not mine or not n_blocks:
                continue
            asked = spark.sparkContext.broadcast(mine)
            # Rows are megabytes: a worker gets one at a time.
            parts.append(common.written(theirs.mapInArrow(_found(k, asked), FOUND), "found", rows=1))
            asked.destroy()
        if not parts:
            parts = [common.written(spark.createDataFrame([], FOUND), "found")]
        keep(*parts)
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    rank = F.row_number().over(Window.partitionBy("q_block", "q_at").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """with v as (select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: case when isfinite(x) then floor(256 * x::double)::bigint end) as q from embeddings where embedding is not null),
ok as (select * from v where len(list_filter(q, lambda x: x is null)) = 0),
s as (select a.rid, a.vec_id as query_id, b.vec_id, coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])), 0)::bigint as score
    from ok a join ok b on a.vec_id % 50 = 0 and a.rid <> b.rid and len(a.q) = len(b.q)),
r as (select *, row_number() over (partition by rid order by score desc, vec_id nulls last) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 5"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11 over the whole of embeddings: the queries are the rows whose vec_id is divisible by 50."""
    return top_k(common.table(spark, sf_dir, "embeddings"), 5, F.col("vec_id") % 50 == 0)
