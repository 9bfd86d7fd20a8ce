"""Token counts through a digest cache.

A content digest (SHA-256 of the text, null as the empty text) and a tokenizer-version digest (SHA-256 of the
vocabulary file and the library's name and version) key a stored table of counts. Rows whose keys are stored are
answered by a join; of the others each distinct text is encoded once, and its count is appended to the cache.

Content is normalised only so far as no tokenizer can see a difference: null becomes the empty text. Anything
stronger (Unicode forms, white space) would change counts.

Edge cases: null text counts as empty (0 bytes, 0 tokens); null ids and repeated rows are kept, one output row per
input row; an empty table gives an empty table; other columns are ignored. Writers that run at the same time can store
a key twice; reading takes one count per key (equal keys have equal counts), so results don't change.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

CACHE_SCHEMA = "digest binary, version string, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file and of the library that reads it."""
    with open(path, "rb") as f:
        body = f.read()
    if path.endswith(".model"):
        import sentencepiece as lib
    else:
        import tokenizers as lib
    return hashlib.sha256(body + f"|{lib.__name__}|{lib.__version__}".encode()).hexdigest()


@lru_cache(maxsize=2)
def counter(path: str):
    """A function from a list of texts to their token counts."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return lambda texts: [len(x.ids) for x in t.encode_batch_fast(texts, add_special_tokens=False)]


def _encode(path: str):
    def run(batches):
        count = counter(path)
        for batch in batches:
            for part in common.slices(batch, most=2 << 20):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(count(part.column(1).to_pylist()), pa.int64())], names=["digest", "n_tokens"]
                )

    return run


def read_cache(spark: SparkSession, cache_dir: str, version: str) -> DataFrame:
    """The stored counts of one tokenizer version; an empty table if nothing is stored yet."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{cache_dir}/version={version}")
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    return spark.read.schema("digest binary, n_tokens long").parquet(f"{cache_dir}/version={version}")


def token_counts(
    docs: DataFrame, tokenizer_path: str, cache_dir: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096
) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer_path)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = common.pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text")
    )
    stored = read_cache(spark, cache_dir, version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    # The partial aggregate keeps one text of each digest and map task, so copies don't meet in one task.
    missing = keyed.groupBy("digest").agg(F.first("text").alias("text")).join(stored, "digest", "left_anti")
    missing.select("digest", "text").mapInArrow(_encode(tokenizer_path), "digest binary, n_tokens long").write.mode("append").parquet(
        f"{cache_dir}/version={version}"
    )
    # Written, so that the join reads two plain shuffles, whose large partitions (a hot digest) Spark can split.
    counts = common.written(read_cache(spark, cache_dir, version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    return keyed.select("doc_id", "n_bytes", "digest").join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9 over the whole of documents, with a cache of its own that starts empty."""
    import public_tokenizers

    return token_counts(
        common.table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), common.scratch(spark, "token-cache")
    )
