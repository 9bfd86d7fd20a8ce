"""Token-ID files: each document's ids compressed on their own against one shared zstandard dictionary.

Layout of a data set at `path`:
  dictionary/  one row: hash (of the bytes), body, width (bytes of an id, little-endian)
  blocks/      a row for each block of about BLOCK bytes: shard, seq, first_id, last_id, n_docs, n_tokens, shard_start
               (ids of the shard before the block), dict_hash, payload (the compressed documents end to end) and index
               (array of doc_id, offset, length, n_tokens). Shards, blocks and documents are in ascending doc_id order.
A reader of one document prunes blocks by first_id/last_id and decompresses only its bytes of the payload.

The dictionary is fitted on the ids of at most SAMPLE documents (those of the smallest id hashes); it changes sizes, never results. Without
enough material there is none.

Edge cases: null text is empty (the end id alone); null ids come first; rows of equal ids follow each other in the order
of a hash of their text; an empty table gives an empty data set; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, pieces

END_ID = 0
SAMPLE, DICT_BYTES, SAMPLE_IDS, BLOCK = 1000, 64 << 10, 20_000, 1 << 20


class Encoder:
    """Texts to ids, by the tokenizers library. Plain texts go to it in distinct pieces (see `pieces`), others whole."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        self.vocab = tok.get_vocab_size(with_added_tokens=True)
        added = tuple(t.content for t in tok.get_added_tokens_decoder().values())

        def ids(texts: list[str]) -> list[list[int]]:
            return [x.ids for x in tok.encode_batch_fast(texts, add_special_tokens=False)]

        def whole(texts: list[str]) -> list[np.ndarray]:
            return [np.array(x, "<u4") for x in ids(texts)]

        # Pieces stand alone only in plain byte-level BPE.
        level = str(tok.pre_tokenizer)
        own = type(tok.model).__name__ == "BPE" and tok.normalizer is None and level.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in level
        self.encode = pieces.PieceEncoder(ids, whole, added).encode if own else whole


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def dict_hash(body: bytes) -> str:
    return hashlib.sha256(body).hexdigest()[:16] if body else ""


def train_dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A zstandard dictionary; empty where the samples are too few for one."""
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(size, max(1024, total // 8)), samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def _fit(docs: DataFrame, path: str, end_id: int) -> tuple[bytes, int]:
    """Dictionary and id width. The sample: documents with the smallest hashes of their ids, SAMPLE at most."""
    key = F.xxhash64("doc_id")
    ids = [r[0] for r in docs.select("doc_id").where("doc_id is not null").orderBy(key, "doc_id").limit(SAMPLE).collect()]
    enc = encoder(path)
    width = 2 if max(enc.vocab, end_id) < 1 << 16 else 4
    if not ids:
        return b"", width

    def run(batches):
        e = encoder(path)
        for batch in batches:
            for part in common.slices(batch):
                got = [x[:SAMPLE_IDS].astype(f"<u{width}").tobytes() for x in e.encode([x or "" for x in part.column(1).to_pylist()])]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(got, pa.binary())], names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.where(F.col("doc_id").isin(ids)).mapInArrow(run, f"doc_id {kind}, ids binary").orderBy("doc_id", "ids").limit(SAMPLE).collect()
    return train_dictionary([bytes(r[1]) for r in rows if r[1]]), width


_BLOCK_SCHEMA = (
    "shard int, seq int, first_id {k}, last_id {k}, n_docs int, n_tokens long, shard_start long, dict_hash string, payload binary, "
    "index array<struct<doc_id:{k},offset:long,length:long,n_tokens:long>>"
)


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append end_id, and write the data set described above."""
    spark = docs.sparkSession
    rows = common.pick(docs, doc_id=id_col, text=text_col)
    body, width = _fit(rows, tokenizer_path, end_id)
    kind = rows.schema["doc_id"].dataType.simpleString()
    spark.createDataFrame([(dict_hash(body), bytearray(body), width)], "hash string, body binary, width int").coalesce(1).write.parquet(f"{path}/dictionary")
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(kind, pa.int64())
    index_type = pa.list_(pa.struct([("doc_id", id_type), ("offset", pa.int64()), ("length", pa.int64()), ("n_tokens", pa.int64())]))

    def run(batches):
        from pyspark import TaskContext

        shard, enc = TaskContext.get().partitionId(), encoder(tokenizer_path)
        press = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(body) if body else None)
        seq = at = tokens = 0
        blobs: list[bytes] = []
        index: list[dict] = []
        end = np.array([end_id], "<u4")

        def block():
            cols = [shard, seq, index[0]["doc_id"], index[-1]["doc_id"], len(index), sum(x["n_tokens"] for x in index), tokens, dict_hash(body), b"".join(blobs)]
            types = [pa.int32(), pa.int32(), id_type, id_type, pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            names = ["shard", "seq", "first_id", "last_id", "n_docs", "n_tokens", "shard_start", "dict_hash", "payload", "index"]
            return pa.RecordBatch.from_arrays([*(pa.array([c], t) for c, t in zip(cols, types, strict=True)), pa.array([index], index_type)], names=names)

        for batch in batches:
            for part in common.slices(batch):
                ids = part.column(0).to_pylist()
                for doc, got in zip(ids, enc.encode([x or "" for x in part.column(1).to_pylist()]), strict=True):
                    blob = press.compress(np.concatenate([got, end]).astype(f"<u{width}").tobytes())
                    if blobs and at + len(blob) > BLOCK:
                        yield block()
                        seq, tokens, at, blobs, index = seq + 1, tokens + sum(x["n_tokens"] for x in index), 0, [], []
                    index.append({"doc_id": doc, "offset": at, "length": len(blob), "n_tokens": len(got) + 1})
                    blobs.append(blob)
                    at += len(blob)
        if blobs:
            yield block()

    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(run, _BLOCK_SCHEMA.format(k=kind)).write.parquet(f"{path}/blocks")


def _opener(body: bytes, known: str, width: int):
    press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body) if body else None)

    def ids(payload: memoryview, entry: dict, used: str) -> np.ndarray:
        if used != known:
            raise ValueError(f"block needs dictionary {used}, the data set has {known}")
        raw = press.decompress(payload[entry["offset"] : entry["offset"] + entry["length"]])
        return np.frombuffer(raw, f"<u{width}").astype("<u4")

    return ids


def _open(spark: SparkSession, path: str):
    r = spark.read.parquet(f"{path}/dictionary").first()
    if dict_hash(bytes(r["body"])) != r["hash"]:
        raise ValueError(f"the dictionary at {path} is damaged")
    return bytes(r["body"]), r["hash"], r["width"]


def read_ids(spark: SparkSession, path: str, doc_ids: list | None = None) -> DataFrame:
    """(doc_id, ids) of all documents, or of the few asked for (None: those without an id): only their blocks are read, only
    their bytes opened. Null ids come first, so a block that begins with them has no first_id."""
    body, known, width = _open(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["first_id"].dataType.simpleString()
    if doc_ids is not None:
        some = [x for x in doc_ids if x is not None]
        first, last = F.col("first_id"), F.col("last_id")
        holds = F.lit(False) if not some else (last >= min(some)) & (first.isNull() | (first <= max(some)))
        blocks = blocks.where(holds | first.isNull() if None in doc_ids else holds)
    want = None if doc_ids is None else set(doc_ids)

    def run(batches):
        ids = _opener(body, known, width)
        for batch in batches:
            for row in range(batch.num_rows):
                payload, used = memoryview(batch.column(0)[row].as_py()), batch.column(1)[row].as_py()
                for e in batch.column(2)[row].as_py():
                    if want is None or e["doc_id"] in want:
                        yield pa.RecordBatch.from_pydict({"doc_id": pa.array([e["doc_id"]], batch.schema.field(2).type.value_type.field(0).type), "ids": pa.array([ids(payload, e, used)], pa.list_(pa.int64()))})

    return blocks.select("payload", "dict_hash", "index").mapInArrow(run, f"doc_id {kind}, ids array<long>")


def summarise(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    body, known, width = _open(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["first_id"].dataType.simpleString()
    # One row for each file of the data set.
    sums = sorted((r[0], r[1]) for r in blocks.groupBy("shard").agg(F.sum("n_tokens")).collect())
    ends = np.cumsum([0, *(n for _, n in sums)]).tolist()
    base = {shard: at for (shard, _), at in zip(sums, ends, strict=False)}

    def run(batches):
        ids = _opener(body, known, width)
        for batch in batches:
            for row in range(batch.num_rows):
                payload, used, index = memoryview(batch.column(0)[row].as_py()), batch.column(1)[row].as_py(), batch.column(2)[row].as_py()
                at = base[batch.column(3)[row].as_py()] + batch.column(4)[row].as_py()
                n = np.array([e["n_tokens"] for e in index], np.int64)
                crc = [zlib.crc32(ids(payload, e, used).tobytes()) for e in index]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([e["doc_id"] for e in index], batch.schema.field(2).type.value_type.field(0).type), pa.array(at + np.cumsum(n) - n), pa.array(n), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return blocks.select("payload", "dict_hash", "index", "shard", "shard_start").mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1 over the whole of documents."""
    import public_tokenizers

    path = common.scratch(spark, "token-files")
    write(common.table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return summarise(spark, path)
