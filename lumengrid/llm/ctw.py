"""Language-model scores by context-tree weighting over bytes, beside a word-unigram base.

A byte is eight binary decisions, each with a tree of its own over the DEPTH bytes before it. A node (context of d bytes,
bits of the byte so far) has counts of zeros and ones and the Krichevsky-Trofimov estimate of its block, Pe. Weighting
gives Pw = (Pe + product of the children's Pw) / 2, and Pe / (2 Pw) is the weight with which a prediction stops at the
node instead of going deeper; a prediction mixes the estimates of all depths on its path with these weights. Where
training has not seen the path's next context, the deepest node that it has seen takes all the weight that is left. A
text is coded from a context of zero bytes and ends with the byte FF, which UTF-8 never has, so that texts' probabilities
sum to 1.

Everything is learned from all training rows, and all nodes count. Of the nodes only those of the upper levels are broadcast, and no task holds
more than a chunk of texts or a bucket of distinct grams:
1. Each chunk of texts lists its distinct (context, byte) grams and words with their training counts, in packed rows, one for each bucket.
   Buckets go by a hash of the last TOP bytes of the context, so a bucket has whole subtrees below depth TOP - 1.
2. A bucket sums its rows, works out its subtrees and stores for each gram what they predict for its eight bits. The nodes
   above (depth TOP - 1: at most 2^16 contexts of 255 nodes) are summed, and their mixtures go to all tasks.
3. A bucket answers each chunk's row by the grams' log probabilities and the words' counts, in the row's order.
4. A chunk scores its texts by the answers.

Edge cases: null text counts as empty (the end alone); a null doc_id is training; without training rows all nodes are
unknown (each bit 1/2) and the base is log10(0.5 / 0.5) for each token; null ids and repeated rows are kept, one
output row per input row; an empty table gives an empty table; other columns are ignored; texts of any length are read
whole, a piece at a time.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

DEPTH, TOP, END = 5, 3, 255
#: Bytes of text in a chunk (one document at least), and of a piece of it that is sorted at once.
CHUNK, PIECE = 4 << 20, 4 << 20
#: Buckets of grams and of words, for each shuffle partition and at most; a row of counts goes from each chunk to each bucket.
SPREAD, BUCKETS = 4, 4096
#: Entries that a bucket gathers before it merges equal ones.
MERGE = 2_000_000
WORD, GRAM, DOC = 0, 1, 2

U64 = np.uint64
_SMALL = 4096
_LG_HALF = np.array([math.lgamma(n + 0.5) for n in range(_SMALL)])
_LG_ONE = np.array([math.lgamma(n + 1.0) for n in range(_SMALL)])


def _lgamma(n: np.ndarray, plus: float, table: np.ndarray) -> np.ndarray:
    """lgamma(n + plus) for counts, by table or, beyond it, Stirling's series."""
    x = np.maximum(n, 1) + plus
    far = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return np.where(n < _SMALL, table[np.minimum(n, _SMALL - 1)], far)


def kt_block(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of a block with n0 zeros and n1 ones."""
    return _lgamma(n0, 0.5, _LG_HALF) + _lgamma(n1, 0.5, _LG_HALF) - math.log(math.pi) - _lgamma(n0 + n1, 1.0, _LG_ONE)


def gram_codes(raw: np.ndarray, off: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the bytes lo to hi: the code (context bytes, the last one first, then the byte) and the text each belongs to."""
    first, last = int(np.searchsorted(off, lo, side="right")) - 1, int(np.searchsorted(off, hi, side="left"))
    size = np.maximum(np.minimum(off[first + 1 : last + 1], hi) - np.maximum(off[first:last], lo), 0)
    owner = np.repeat(np.arange(first, last), size)
    age = np.arange(lo, hi) - off[owner]
    code = raw[lo:hi].astype(U64)
    for j in range(1, DEPTH + 1):
        before = np.zeros(hi - lo, np.uint8)
        skip = max(0, j - lo)
        before[skip:] = raw[lo + skip - j : max(0, hi - j)]
        before[age < j] = 0
        code |= before.astype(U64) << U64(48 - 8 * j)
    return code, owner


def end_codes(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The code of each text's end."""
    code = np.full(len(off) - 1, END, U64)
    for j in range(1, DEPTH + 1):
        at = off[1:] - j
        has = at >= off[:-1]
        code[has] |= raw[at[has]].astype(U64) << U64(48 - 8 * j)
    return code


def pieces(raw: np.ndarray, off: np.ndarray):
    """Codes of the texts' bytes and ends, with the text of each, at most about PIECE at once."""
    for lo in range(0, len(raw), PIECE):
        yield gram_codes(raw, off, lo, min(lo + PIECE, len(raw)))
    yield end_codes(raw, off), np.arange(len(off) - 1)


def _runs(sorted_: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(sorted_) else np.zeros(0, np.int64)


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    if not keys:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    k, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, n = k[order], n[order]
    at = _runs(k)
    return k[at], np.add.reduceat(n, at) if len(at) else n


def _tally(keys: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys below 2^63 and how many of each are not held out."""
    x = np.sort(keys << U64(1) | held.astype(U64))
    at = _runs(x >> U64(1))
    return x[at] >> U64(1), np.add.reduceat((x & U64(1) == 0).astype(np.int64), at) if len(at) else np.zeros(0, np.int64)


@lru_cache(maxsize=1)
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _pack(x: np.ndarray) -> bytes:
    """Numbers as planes of bytes (the high ones are mostly alike), compressed."""
    return _zstd()[0].compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes())


def _unpack(b: bytes, kind=np.int64) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(_zstd()[1].decompress(b), np.uint8).reshape(size, -1).T).view(kind).ravel()


def _pack_keys(k: np.ndarray) -> bytes:
    return _pack(np.diff(k, prepend=U64(0)))


def _unpack_keys(b: bytes) -> np.ndarray:
    return np.cumsum(_unpack(b, U64), dtype=U64)


def _words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash (63 bits) and text of each word."""
    start, end, at = common.words_of(raw, off)
    return common.word_hashes(raw, start, end) >> U64(1), np.repeat(np.arange(len(off) - 1), np.diff(at))


def _bucket(kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each word hash or gram code."""
    return ((keys if kind == WORD else common.mix(keys >> U64(48 - 8 * TOP))) % U64(buckets)).astype(np.int64)


def _by_bucket(kind: int, keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by bucket, and the bucket of each in it; sorted keys stay sorted within a bucket."""
    b = _bucket(kind, keys, buckets)
    order = np.argsort(b, kind="stable")
    return order, b[order]


def _listed(buckets: int):
    """Rows of documents, and of the counts that each of their chunks has for each bucket."""
    names = ["kind", "chunk", "slot", "doc_id", "learn", "text", "keys", "counts"]

    def run(batches):
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in common.slices(batch, most=CHUNK):
                n = part.num_rows
                nulls = lambda kind, size: pa.nulls(size, kind)
                of = lambda v, kind, size: pa.array(np.full(size, v), kind)
                yield pa.RecordBatch.from_arrays([of(DOC, pa.int8(), n), of(chunk, pa.int64(), n), of(0, pa.int32(), n), part.column(0), part.column(2), part.column(1), nulls(pa.binary(), n), nulls(pa.binary(), n)], names=names)
                raw, off = common.text_bytes(part.column(1))
                held = ~part.column(2).to_numpy(zero_copy_only=False).astype(bool)
                word, owner = _words(raw, off)
                grams = [_tally(code, held[who]) for code, who in pieces(raw, off)]
                for kind, (keys, counts) in ((WORD, _tally(word, held[owner])), (GRAM, _merge(*zip(*grams, strict=True)))):
                    order, b = _by_bucket(kind, keys, buckets)
                    at = np.append(_runs(b), len(b)).tolist()
                    rows = [(int(b[x]) + kind * buckets, _pack_keys(keys[order[x:y]]), _pack(counts[order[x:y]])) for x, y in zip(at, at[1:], strict=False)]
                    if rows:
                        slot, k, c = zip(*rows, strict=True)
                        m = len(rows)
                        yield pa.RecordBatch.from_arrays([of(kind, pa.int8(), m), of(chunk, pa.int64(), m), pa.array(slot, pa.int32()), nulls(part.schema.field(0).type, m), nulls(pa.bool_(), m), nulls(pa.string(), m), pa.array(k, pa.binary()), pa.array(c, pa.binary())], names=names)
                chunk += 1
        common.release()

    return run


def subtrees(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Of the grams of whole contexts of TOP bytes: what their subtrees predict for each of a gram's bits (rows of eight; nan if the
    context of TOP bytes has no such node), and for the nodes above (context of TOP - 1 bytes, bits so far) zeros, ones and log Pw."""
    seen = n > 0
    out = np.full((len(keys), 8), np.nan)
    top: list[tuple] = []
    k, count = keys[seen], n[seen]
    sym, all_sym = k & U64(255), keys & U64(255)
    for b in range(8):
        one = (sym >> U64(7 - b) & U64(1)).astype(bool)
        node = k >> U64(8) << U64(8) | U64(1 << b) | sym >> U64(8 - b)  # in order, as the grams are
        levels, up = {}, {}
        for d in range(DEPTH, TOP - 1, -1):
            if d == DEPTH:
                at = _runs(node)
                own = node[at]
                n1 = np.add.reduceat(np.where(one, count, 0), at) if len(at) else np.zeros(0, np.int64)
                n0 = (np.add.reduceat(count, at) if len(at) else np.zeros(0, np.int64)) - n1
                pw, w = kt_block(n0, n1), np.ones(len(at))
            else:
                low = levels[d + 1]
                own, up[d + 1] = np.unique(low[0] >> U64(16) << U64(8) | low[0] & U64(255), return_inverse=True)
                add = lambda x: np.bincount(up[d + 1], weights=x, minlength=len(own))  # noqa: B023, E731
                n0, n1 = add(low[1]).astype(np.int64), add(low[2]).astype(np.int64)
                pe = kt_block(n0, n1)
                pw = np.logaddexp(pe, add(low[4])) - math.log(2)
                w = np.exp(pe - math.log(2) - pw)
            levels[d] = own, n0, n1, w, pw
        low = levels[TOP]
        own, at = np.unique(low[0] >> U64(16) << U64(8) | low[0] & U64(255), return_inverse=True)
        top.append((own, *(np.bincount(at, weights=x, minlength=len(own)) for x in (low[1], low[2], low[4]))))
        # Downwards, for a zero and a one: what is found if the path ends here, and what has been mixed so far.
        found, mixed, left = {}, None, None
        for d in range(TOP, DEPTH + 1):
            own, n0, n1, w, _ = levels[d]
            p = np.stack([n0 + 0.5, n1 + 0.5]) / (n0 + n1 + 1)
            if d == TOP:
                mixed, left = np.zeros_like(p), np.ones(len(own))
            else:
                mixed, left = mixed[:, up[d]], left[up[d]]
            found[d] = mixed + left * p
            mixed, left = mixed + left * w * p, left * (1 - w)
        bit = (all_sym >> U64(7 - b) & U64(1)).astype(np.int64)
        open_ = np.arange(len(keys))
        for d in range(DEPTH, TOP - 1, -1):
            own = levels[d][0]
            if not len(open_) or not len(own):
                break
            want = keys[open_] >> U64(48 - 8 * d) << U64(8) | U64(1 << b) | all_sym[open_] >> U64(8 - b)
            at = np.minimum(np.searchsorted(own, want), len(own) - 1)
            hit = own[at] == want
            out[open_[hit], b] = found[d][bit[open_[hit]], at[hit]]
            open_ = open_[~hit]
    return out.astype(np.float32), tuple(np.concatenate(x) for x in zip(*top, strict=True))


class Top:
    """Mixtures of the nodes above the subtrees: from sums of zeros, ones and log Pw of the subtrees below each node of depth TOP - 1."""

    def __init__(self, node: np.ndarray, n0: np.ndarray, n1: np.ndarray, kids: np.ndarray):
        self.levels = []
        for d in range(TOP - 1, -1, -1):
            own, back = np.unique(node, return_inverse=True)
            n0, n1, kids = (np.bincount(back, weights=x, minlength=len(own)) for x in (n0, n1, kids))
            pe = kt_block(n0.astype(np.int64), n1.astype(np.int64))
            pw = np.logaddexp(pe, kids) - math.log(2)
            self.levels.append((own, np.stack([n0 + 0.5, n1 + 0.5]) / (n0 + n1 + 1), np.exp(pe - math.log(2) - pw)))
            node, kids = own >> U64(16) << U64(8) | own & U64(255), pw
        self.levels.reverse()
        self.tables = []  # for each depth: nodes, what is found if the path ends there, what has been mixed, what is left
        for d, (own, p, w) in enumerate(self.levels):
            mixed, left = np.zeros_like(p), np.ones(len(own))
            if d:
                above, _, m, rest = self.tables[-1]
                at = np.searchsorted(above, own >> U64(16) << U64(8) | own & U64(255))
                mixed, left = m[:, at], rest[at]
            self.tables.append((own, mixed + left * p, mixed + left * w * p, left * (1 - w)))
        del self.levels

    def log10(self, keys: np.ndarray, below: np.ndarray) -> np.ndarray:
        """log10 P(byte | context) of grams, from what the subtrees predict for their bits."""
        out = np.zeros(len(keys))
        sym = keys & U64(255)
        for b in range(8):
            bit = (sym >> U64(7 - b) & U64(1)).astype(np.int64)
            p = np.full(len(keys), 0.5)
            for d, (own, found, mixed, left) in enumerate(self.tables):
                if not len(own):
                    continue
                want = keys >> U64(48 - 8 * d) << U64(8) | U64(1 << b) | sym >> U64(8 - b)
                at = np.minimum(np.searchsorted(own, want), len(own) - 1)
                hit = own[at] == want
                p[hit] = found[bit[hit], at[hit]]
                if d == TOP - 1:
                    deep = hit & ~np.isnan(below[:, b])
                    p[deep] = mixed[bit[deep], at[deep]] + left[at[deep]] * below[deep, b]
            out += np.log10(p)
        return out


def _summed(buckets: int):
    """Of the rows of a bucket, one after the other: its distinct keys with counts (words) or predictions (grams), and the sums for
    the nodes above."""
    names = ["slot", "keys", "body", "total", "known", "node", "n0", "n1", "pw"]

    def done(slot: int, keys: list, counts: list):
        k, n = _merge(keys, counts)
        body, top = (_pack(n), None) if slot < buckets else subtrees(k, n)
        one = [pa.array([slot], pa.int32()), pa.array([_pack_keys(k)], pa.binary()), pa.array([body if top is None else _pack(body.ravel())], pa.binary()), pa.array([int(n.sum())]), pa.array([int((n > 0).sum())])]
        yield pa.RecordBatch.from_arrays([*one, pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.float64())], names=names)
        if top is not None and len(top[0]):
            node, n0, n1, pw = top
            m = len(node)
            yield pa.RecordBatch.from_arrays([pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), *map(pa.array, (node.astype(np.int64), n0.astype(np.int64), n1.astype(np.int64), pw))], names=names)

    def run(batches):
        place, keys, counts, held = None, [], [], 0
        for batch in batches:
            for slot, k, c in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if slot != place:
                    if place is not None:
                        yield from done(place, keys, counts)
                    place, keys, counts, held = slot, [], [], 0
                keys.append(_unpack_keys(k))
                counts.append(_unpack(c))
                held += len(keys[-1])
                if held > max(MERGE, 2 * len(keys[0])):
                    k, n = _merge(keys, counts)
                    keys, counts, held = [k], [n], len(k)
        if place is not None:
            yield from done(place, keys, counts)
        common.release()

    return run


def _answered(buckets: int, top):
    """For each chunk's row: the log probabilities of its grams or the counts of its words; the bucket's own row comes first."""

    def run(batches):
        known, value = None, None
        for batch in batches:
            out = []
            for slot, chunk, k, body in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                keys = _unpack_keys(k)
                if chunk is None:
                    known = keys
                    value = _unpack(body) if slot < buckets else top.value.log10(keys, _unpack(body, np.float32).reshape(-1, 8)).astype(np.float32)
                    continue
                got = value[np.searchsorted(known, keys)]
                out.append((slot, chunk, _pack(got)))
            if out:
                slot, chunk, body = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(chunk, pa.int64()), pa.array(slot, pa.int32()), pa.array(body, pa.binary())], names=["chunk", "slot", "body"])
        common.release()

    return run


def _scored(buckets: int, log_denominator: float, n_docs: int):
    """A chunk's texts by its answers, which come first and in the order of their buckets."""
    end_log, end_known = math.log10(n_docs + 0.5) - log_denominator, int(n_docs > 0)

    def finish(answers: dict, docs: list):
        ids, learn, text = (pa.chunked_array(x).combine_chunks() for x in zip(*docs, strict=True))
        n = len(ids)
        raw, off = common.text_bytes(text)
        word, owner = _words(raw, off)
        keys, back = np.unique(word, return_inverse=True)
        count = np.zeros(len(keys), np.int64)
        count[_by_bucket(WORD, keys, buckets)[0]] = np.concatenate([*map(_unpack, answers[WORD]), np.zeros(0, np.int64)])
        logs, size = np.log10(count + 0.5) - log_denominator, np.bincount(owner, minlength=n)
        base = np.bincount(owner, weights=logs[back], minlength=n) + end_log
        known = np.bincount(owner, weights=(count > 0)[back], minlength=n).astype(np.int64) + end_known
        parts = []
        for code, who in pieces(raw, off):
            x = np.sort(code << U64(16) | who.astype(U64))  # fewer than 2^16 documents a chunk
            at = _runs(x >> U64(16))
            parts.append((x[at] >> U64(16), np.diff(np.append(at, len(x))), (x & U64(0xFFFF)).astype(np.uint16)))
        keys = np.unique(np.concatenate([x[0] for x in parts]))
        value = np.zeros(len(keys))
        value[_by_bucket(GRAM, keys, buckets)[0]] = np.concatenate([_unpack(x, np.float32) for x in answers[GRAM]])
        score = np.zeros(n)
        for code, times, who in parts:
            score += np.bincount(who, weights=np.repeat(value[np.searchsorted(keys, code)], times), minlength=n)
        bits = -score / math.log10(2) / (np.diff(off) + 1)  # the end is coded too
        return pa.RecordBatch.from_arrays([ids, learn, pa.array(size + 1), pa.array(known), pa.array(base), pa.array(score), pa.array(bits)], names=["doc_id", "learn", "n_tokens", "n_known", "base_score", "score", "bits_per_byte"])

    def run(batches):
        place, answers, docs = None, {WORD: [], GRAM: []}, []
        for batch in batches:
            chunk, kind = (batch.column(i).to_numpy() for i in range(2))
            at = np.append(_runs(chunk * 4 + kind), len(chunk)).tolist()
            for x, y in zip(at, at[1:], strict=False):
                if chunk[x] != place:
                    if place is not None:
                        yield finish(answers, docs)
                    place, answers, docs = chunk[x], {WORD: [], GRAM: []}, []
                if kind[x] == DOC:
                    docs.append(tuple(batch.column(i).slice(x, y - x) for i in range(2, 5)))
                else:
                    answers[kind[x]] += batch.column(5).slice(x, y - x).to_pylist()
        if place is not None:
            yield finish(answers, docs)
        common.release()

    return run


def score(docs: DataFrame, training, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte (code length of the text and its end by their
    bytes); training: a Column of doc_id, true for the rows to learn from."""
    spark = docs.sparkSession
    rows = common.pick(docs, doc_id=id_col, text=text_col).withColumn("learn", F.coalesce(training, F.lit(True)))
    kind = rows.schema["doc_id"].dataType.simpleString()
    parts = common.shuffle_parts(spark)
    buckets = min(BUCKETS, SPREAD * parts)
    dealt = lambda df, by, *order: df.repartitionById(parts, F.pmod(F.col(by), F.lit(parts)).cast("int")).sortWithinPartitions(*order)
    with common.tables(spark) as keep:
        listed = common.written(
            rows.select("doc_id", "text", "learn").mapInArrow(_listed(buckets), f"kind byte, chunk long, slot int, doc_id {kind}, learn boolean, text string, keys binary, counts binary"), "ctw-chunks", compression="zstd", by="kind"
        )
        lists = listed.where(F.col("kind") != DOC)
        summed = common.written(
            dealt(lists.select("slot", "keys", "counts"), "slot", "slot").mapInArrow(_summed(buckets), "slot int, keys binary, body binary, total long, known long, node long, n0 long, n1 long, pw double"), "ctw-sums"
        )
        n_docs = listed.where((F.col("kind") == DOC) & F.col("learn")).count()
        total, distinct = summed.where(F.col("slot") < buckets).agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
        total, distinct = total + n_docs, distinct + (n_docs > 0)
        # At most 2^16 contexts of 255 nodes.
        nodes = summed.where("node is not null").groupBy("node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("pw").alias("pw")).toArrow()
        node, n0, n1, pw = (nodes.column(i).to_numpy() for i in range(4))
        top = spark.sparkContext.broadcast(Top(node.astype(U64), n0, n1, pw))
        own = summed.where("slot is not null").select("slot", F.lit(None).cast("long").alias("chunk"), "keys", "body")
        asked = own.union(lists.select("slot", "chunk", "keys", F.lit(None).cast("binary")))
        answers = common.written(dealt(asked, "slot", "slot", F.col("chunk").asc_nulls_first()).mapInArrow(_answered(buckets, top), "chunk long, slot int, body binary"), "ctw-answers")
        common.discard(summed)
        for x in (WORD, GRAM):
            common.discard(listed, only=f"kind={x}")
        both = answers.select("chunk", F.when(F.col("slot") < buckets, F.lit(WORD)).otherwise(F.lit(GRAM)).cast("byte").alias("kind"), F.lit(None).cast(kind).alias("doc_id"), F.lit(None).cast("boolean").alias("learn"), F.lit(None).cast("string").alias("text"), "body", "slot")
        both = both.union(listed.where(F.col("kind") == DOC).select("chunk", "kind", "doc_id", "learn", "text", F.lit(None).cast("binary"), "slot"))
        log_denominator = math.log10(total + 0.5 * (distinct + 1))
        done = both.repartition(parts, "chunk").sortWithinPartitions("chunk", "kind", "slot").drop("slot")
        out = common.written(done.mapInArrow(_scored(buckets, log_denominator, n_docs), f"doc_id {kind}, learn boolean, n_tokens long, n_known long, base_score double, score double, bits_per_byte double"), "ctw-scores")
        keep(out)
    return out.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score", "bits_per_byte")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5 over the whole of documents: learns from those whose crc32(doc_id as text) mod 5 is not 1."""
    return score(common.table(spark, sf_dir, "documents"), F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 1)
