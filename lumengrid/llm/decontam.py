"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment;
DataFrame functions only.

Words are runs of letters and digits, lower-cased; an item's shingles are its distinct runs of five words (all its words
as one where it has fewer). A MinHash of a whole long document says nothing of a short item in it, and of every window of
the item's length would be costly; but an item's smallest hash under a permutation is the smallest of the window that
holds the item, so the test "is it the minimum of some window" becomes "does the document have the shingle". Items are
partitioned by size, and each class has its own number of permutations. The share of the
minima that a document has estimates the containment, and pairs of at least NEED (far below THRESHOLD, so that a pair
above it is not lost) are candidates. For these the shingles of the item that the document has are counted.

Edge cases: null text counts as empty; items and documents without words match nothing; a document's row is known by the
hash of its id and text, so rows that repeat both count once, and rows that share only an id are judged apart; null ids
are kept; empty tables give an empty result; other columns are ignored. Whole texts of any length are searched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

WORDS, THRESHOLD, PER_CLASS, NEED = 5, 0.8, 8, 0.3


def _word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    return F.transform(words, lambda x: F.xxhash64(x))


def _runs(w: Column, n: int) -> Column:
    """Distinct hashes of the runs of n words; empty where there are fewer."""
    one = lambda i: F.xxhash64(F.lit(n), *[F.get(w, i + j) for j in range(n)])
    return F.when(F.size(w) >= n, F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(w) - n), one))).otherwise(F.array().cast("array<bigint>"))


def item_shingles(items: DataFrame, item_id: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, words of a shingle, n_shingles, h), one row for each distinct shingle of each item."""
    w = common.pick(items, item_id=item_id, text=text_col).select("item_id", _word_hashes(F.col("text")).alias("w"))
    by_size = F.when(F.size("w") >= WORDS, _runs(F.col("w"), WORDS))
    for n in range(WORDS - 1, 0, -1):
        by_size = by_size.when(F.size("w") == n, _runs(F.col("w"), n))
    sets = w.where(F.size("w") > 0).select("item_id", F.least(F.size("w"), F.lit(WORDS)).alias("words"), by_size.alias("s")).dropDuplicates(["item_id", "s"])
    return sets.select("item_id", "words", F.size("s").alias("n_shingles"), F.explode("s").alias("h"))


def minima(shingles: DataFrame) -> DataFrame:
    """(item_id, n_shingles, h, weight, k): each item's minima; weight: permutations whose minimum h is, of k.

    Size classes go from a power of two to the next; the larger the class, the more permutations (PER_CLASS for each
    doubling), as one miss of a long passage weighs more."""
    sized = shingles.withColumn("size_class", F.greatest(F.lit(1), F.ceil(F.log2("n_shingles")).cast("int")))
    out = None
    for (size_class,) in sorted(sized.select("size_class").distinct().collect()):  # one for each power of two at most
        k = PER_CLASS * size_class
        picks = sized.where(F.col("size_class") == size_class).groupBy("item_id", "n_shingles").agg(
            F.array(*[F.min_by("h", F.xxhash64("h", F.lit(j))) for j in range(k)]).alias("m")
        )
        of = picks.select("item_id", "n_shingles", F.explode("m").alias("h")).groupBy("item_id", "n_shingles", "h").agg(F.count("*").cast("int").alias("weight"))
        of = of.withColumn("k", F.lit(k))
        out = of if out is None else out.unionByName(of)
    return sized.select("item_id", "n_shingles", "h", F.lit(0).alias("weight"), F.lit(0).alias("k")).limit(0) if out is None else out


def _document_shingles(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """(rid, doc_id, h): the distinct shingles of each document, for the given lengths."""
    w = docs.select("rid", "doc_id", _word_hashes(F.col("text")).alias("w"))
    return w.select("rid", "doc_id", F.explode(F.concat(*[_runs(F.col("w"), n) for n in lengths])).alias("h"))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, doc_id, text): rid is the hash of id and text."""
    return common.pick(docs, doc_id=id_col, text=text_col).select(F.xxhash64("doc_id", "text").alias("rid"), "doc_id", "text")


def search(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id") -> DataFrame:
    """(rid, doc_id, item_id, n_shared, n_shingles, containment) of each pair with at least the threshold."""
    rows = keyed(docs, id_col, text_col)
    with common.tables(docs.sparkSession) as keep:
        index = common.written(item_shingles(items, item_id), "item-shingles")
        lengths = [r[0] for r in index.select("words").distinct().orderBy("words").collect()] or [WORDS]  # five values at most
        mins = common.written(minima(index), "item-minima")
        pairs = _document_shingles(rows, lengths).join(common.bounded(mins), "h").groupBy("rid", "item_id").agg(F.sum("weight").alias("hits"), F.max("k").alias("k"))
        found = common.written(pairs.where(F.col("hits") >= F.ceil(F.col("k") * (NEED * threshold / THRESHOLD))).select("rid", "item_id"), "candidates")
        keep(index, found)
    few = rows.join(found.select("rid").distinct(), "rid", "left_semi").dropDuplicates(["rid"])
    shared = _document_shingles(few, lengths).join(common.bounded(index), "h").groupBy("rid", "doc_id", "item_id", "n_shingles").agg(F.count("*").alias("n_shared"))
    # Only pairs that the search has found.
    return shared.join(found, ["rid", "item_id"], "left_semi").withColumn("containment", F.col("n_shared") / F.col("n_shingles")).where(
        F.col("containment") >= threshold
    ).select("rid", "doc_id", "item_id", "n_shared", F.col("n_shingles").cast("long").alias("n_shingles"), "containment")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: the benchmark's items in the whole of documents."""
    return search(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")).drop("rid")


ORACLE = rf"""with dw as (select doc_id, text, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') as w from documents),
bw as (select item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') as w from benchmark),
d as (select distinct doc_id, text, array_to_string(w[i:i + {WORDS - 1}], ' ') as s from (select doc_id, text, w, unnest(range(1, len(w) - {WORDS - 2})) as i from dw)),
b as (select distinct item_id, array_to_string(w[i:i + {WORDS - 1}], ' ') as s from (select item_id, w, unnest(range(1, len(w) - {WORDS - 2})) as i from bw)),
n as (select item_id, count(*) as n_shingles from b group by item_id)
select d.doc_id, b.item_id, count(*)::bigint as n_shared, n.n_shingles::bigint as n_shingles, count(*)::double / n.n_shingles as containment
from d join b using (s) join n on n.item_id = b.item_id group by d.doc_id, d.text, b.item_id, n.n_shingles having count(*) >= {THRESHOLD} * n.n_shingles"""
