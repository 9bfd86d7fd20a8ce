"""A training-corpus pipeline over `documents`: five stages, each of which calls an operator of lumengrid.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's
docs. All but the last return the columns that they get.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumengrid.llm import bpe, common, decontam, language, near_dup, secrets

#: Similarity from which documents are near duplicates: 80 of 100.
SIMILAR = (80, 100)
MASK = "[SECRET]"


def _own(docs: DataFrame) -> list:
    """The columns of docs, however named."""
    return [F.col(f"`{c}`") for c in docs.columns]


def _back(docs: DataFrame) -> list:
    """The columns of docs, from an operator's result that keeps them as keep_<name>."""
    return [F.col("doc_id" if c == "doc_id" else "text" if c == "text" else f"`keep_{c}`").alias(c) for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told (their text has letters); a missing label is filled in."""
    keep = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    known = language.identify(docs, keep=keep).where(F.col("lang_pred") != language.UNKNOWN)
    return known.withColumn("keep_lang", F.coalesce("keep_lang", "lang_pred")).select(*_back(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id; of rows that repeat id and text one. A null id comes
    before all others; rows that share an id that stays, null too, stay with each of their texts."""
    key, times, h = "id that is kept", "rows of the id", "hash of the text"
    with common.tables(spark) as keep:
        kept = near_dup.near_duplicates(docs, *SIMILAR).where("kept").groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias(times))
        kept = common.written(kept, "kept")
        keep(kept)
    one = docs.join(common.bounded(kept), F.col("doc_id").eqNullSafe(F.col(key)))
    again = one.where(F.col(times) > 1).withColumn(h, F.xxhash64("text")).dropDuplicates(["doc_id", h])
    return one.where(F.col(times) == 1).select(*_own(docs)).union(again.select(*_own(docs)))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; a row is known by its id and text, so rows that repeat both go or stay together."""
    leak = "hash of a leak"
    with common.tables(spark) as keep:
        leaks = common.written(decontam.search(docs, common.table(spark, sf_dir, "benchmark")).select(F.col("rid").alias(leak)).distinct(), "leaks")
        keep(leaks)
    return docs.join(common.bounded(leaks), F.xxhash64("doc_id", "text") == F.col(leak), "left_anti").select(*_own(docs))


#: Spans that are masked one after the other; a text grows by copying, so runs of spans are masked by themselves.
RUN = 256


def _masked(text: Column, found: Column) -> Column:
    """The text with its spans (by start) replaced by MASK, those that overlap by one."""

    def split(acc: Column, spans: Column) -> Column:
        end = F.greatest(acc["at"], F.array_max(F.transform(spans, lambda x: x["end"])))
        return F.struct(end.alias("at"), F.concat(acc["of"], F.array(F.struct(acc["at"].alias("start"), end.alias("end"), spans.alias("spans")))).alias("of"))

    def mask(run: Column) -> Column:
        """A run's part of the text, from its start to the end of its last span."""

        def step(acc: Column, x: Column) -> Column:
            gap = F.concat(acc["out"], F.substring(run["part"], acc["at"] - run["start"] + 1, x["start"] - acc["at"]), F.lit(MASK))
            return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(x["start"] >= acc["at"], gap).otherwise(acc["out"]).alias("out"))

        return F.aggregate(run["spans"], F.struct(run["start"].alias("at"), F.lit("").alias("out")), step)["out"]

    def whole(of: Column) -> Column:
        n = F.floor((F.size(of["found"]) - 1) / RUN).cast("int")
        runs = F.transform(F.sequence(F.lit(0), n), lambda i: F.slice(of["found"], i * RUN + 1, F.lit(RUN)))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,spans:array<struct<start:int,ord:int,end:int,kind:string>>>>").alias("of"))
        parts = lambda r: F.struct(r["start"].alias("start"), r["spans"].alias("spans"), F.substring(of["text"], r["start"] + 1, r["end"] - r["start"]).alias("part"))
        cut = F.transform(F.array(F.aggregate(runs, start, split)), lambda a: F.concat(F.array_join(F.transform(F.transform(a["of"], parts), mask), ""), F.substring(of["text"], a["at"] + 1, F.length(of["text"]))))
        return F.element_at(cut, 1)

    # One-element arrays give a name to what is used more than once, which is then worked out once.
    return F.element_at(F.transform(F.array(F.struct(text.alias("text"), found.alias("found"))), lambda of: F.when(F.size(of["found"]) > 0, whole(of)).otherwise(of["text"])), 1)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by MASK (spans that overlap by one) and n_chars of the new text. Null text stays null;
    rows with a null id or that repeat stay, each by its own text."""
    keep = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    found = secrets.scan(docs, keep=keep)
    out = found.withColumn("text", _masked(F.col("text"), F.col("found")))
    if "n_chars" in docs.columns:
        out = out.withColumn("keep_n_chars", F.when(F.size("found") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("keep_n_chars")))
    return out.select(*_back(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (array<int>) and the digests of ids and decoded bytes; decoding gives the text back. Rows that
    repeat stay, null text has no ids, an empty table gives an empty one; written here, so that workers get small batches."""
    return common.written(bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, digests=True, keep=False), "ids")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("secret_scan", mask_secrets),
    ("byte_bpe", encode),
]

#: The first stage fits a classifier, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = common.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with common.tables(spark) as keep:
            docs = common.written(stage(spark, docs, sf_dir), name)
            keep(docs)
        if before is not None:
            common.discard(before)
        before = docs
    return docs
