"""Density volumes of a text corpus, kept up to date as files arrive: the incremental job.

Those who look at volumes look at a corpus in the same way: documents are counted on a grid of

    x  bits of the number of characters           0..31
    y  characters of a word on average            0..15 (what is longer counts as 15)
    z  tenths of the words that are different     0..10

for each language, and the counts are a scalar volume, which is normalised, cut into bands of equal weight and sampled by opacity like
any other.

    python -m jobs.corpus_volumes --input FOLDER --output FOLDER [--config FILE]

Reads new Parquet files of documents (text, lang) in a folder (or one file) with a file stream; its checkpoint, below the output, knows those that were read. Each
micro-batch is counted where its rows are (whole texts, no shuffle of texts) and its counts are written as a partition of its own, which
a batch that is run again overwrites. Then the volumes are put together from all counts and written partitioned by language, each
partition overwritten. So a run that broke off at any place is made good by the next, a run without new files changes nothing, and the cost of
a run follows the new files (and the grid, not the corpus).

    counts/batch_id=...    volume_id, z, y, x, n
    volumes/volume_id=...  z, y, x, n, v (0 to 1), band, and the point drawn there: point_id, r, g, b, a (null where none is)
    edges/volume_id=...    edge, x: value where a band begins

Null text counts as empty, and lies at 0, 0, 0 as a text without words does; a null or empty language is "und". Documents that come twice, in
one file or in two, count twice, as they are rows of their own. Other columns are not read.
"""

from __future__ import annotations

import argparse
import json
import logging
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumengrid.operators import grid, histogram, normalize, sampling, transfer

log = logging.getLogger("jobs.corpus_volumes")
DEFAULT = Path(__file__).with_suffix(".json")
SHAPE = (11, 16, 32)
DOCUMENTS = "text string, lang string"
COUNTS = "volume_id string, z int, y int, x int, n long, batch_id long"
SPACE = r"[\x20\x09-\x0D]"
#: Bins of the histogram whose equal parts are the bands.
BINS = 1024


def bits(n: Column) -> Column:
    """Binary digits of a whole number, none for 0."""
    return F.when(n > 0, F.length(F.bin(n))).otherwise(0)


def located(docs: DataFrame) -> DataFrame:
    """(volume_id, z, y, x): the cell of each document."""
    text = F.coalesce("text", F.lit(""))
    parts = docs.select(F.coalesce(F.nullif("lang", F.lit("")), F.lit("und")).alias("volume_id"), F.length(text).alias("chars"), F.regexp_extract_all(text, F.lit(SPACE.replace("[", "[^") + "+"), F.lit(0)).alias("words"))
    many = parts.select("volume_id", "chars", F.size("words").alias("words"), F.size(F.array_distinct("words")).alias("different"), F.length(F.array_join("words", "")).alias("letters"))
    of = lambda a: F.when(F.col("words") > 0, F.floor(a / F.col("words"))).otherwise(0).cast("int")
    return many.select("volume_id", of(F.col("different") * 10).alias("z"), F.least(of(F.col("letters")), F.lit(SHAPE[1] - 1)).alias("y"), F.least(bits(F.col("chars").cast("long")), F.lit(SHAPE[2] - 1)).cast("int").alias("x"))


def count(docs: DataFrame) -> DataFrame:
    return located(docs).groupBy("volume_id", "z", "y", "x").agg(F.count("*").alias("n"))


def pattern(path: str) -> str:
    """The path as a pattern that only it matches; a file stream takes a pattern for a single file as well as for a folder."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]" if path[-1].isalnum() else path


def take_new(spark: SparkSession, source: str, target: str, max_files: int) -> None:
    """Counts of the files that no earlier run has read, a partition for each micro-batch."""

    def write(df: DataFrame, batch_id: int) -> None:
        count(df).write.mode("overwrite").parquet(f"{target}/counts/batch_id={batch_id}")

    files = spark.readStream.schema(DOCUMENTS).option("maxFilesPerTrigger", max_files).parquet(pattern(source))
    files.writeStream.foreachBatch(write).option("checkpointLocation", f"{target}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def batches(spark: SparkSession, target: str) -> DataFrame:
    """The counts of all batches so far."""
    try:
        return spark.read.schema(COUNTS).parquet(f"{target}/counts")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # nothing has arrived yet
            raise
        return spark.createDataFrame([], COUNTS)


def seen(spark: SparkSession, target: str) -> tuple[int, int]:
    """Documents and batches that have been counted."""
    return tuple(batches(spark, target).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_distinct("batch_id")).first())


def counted(spark: SparkSession, target: str) -> DataFrame:
    """The counts as voxels (volume_id, z, y, x, n)."""
    return batches(spark, target).groupBy("volume_id", "z", "y", "x").agg(F.sum("n").alias("n"))


def build(cells: DataFrame, config: dict) -> tuple[DataFrame, DataFrame]:
    """Volumes with values, bands and drawn points; and the bands' edges."""
    tf = transfer.TransferFunction("density", tuple(map(tuple, config["transfer_function"])))
    whole = grid.dense(cells.select("volume_id", "z", "y", "x", F.col("n").cast("double").alias("v")), SHAPE, 0.0)
    scaled = normalize.minmax(whole, "zero")
    # Empty cells weigh nothing: bands divide the cells that hold documents.
    edges = histogram.equalised_edges(histogram.histogram(scaled.where("v > 0"), 0.0, 1.0, BINS), 0.0, 1.0, config["bands"], BINS)
    full = scaled.join(cells, ["volume_id", "z", "y", "x"])
    inner = edges.where((F.col("edge") > 0) & (F.col("edge") < config["bands"])).groupBy("volume_id").agg(F.array_sort(F.collect_list("x")).alias("inner"))  # a few numbers a volume
    band = F.coalesce(F.size(F.filter("inner", lambda e: e <= F.col("v"))), F.lit(0)) + 1
    drawn = sampling.opacity(transfer.bake(scaled, [tf]), config["n_points"], config["seed"]).drop("tf_name")
    rows = full.join(inner, "volume_id", "left").join(drawn, ["volume_id", "z", "y", "x"], "left")
    return rows.select("z", "y", "x", "n", "v", band.alias("band"), "point_id", *"rgba", "volume_id"), edges.select("edge", "x", "volume_id")


def run(spark: SparkSession, source: str, target: str, config: dict) -> dict:
    """Take what is new and bring the volumes up to date; what was read and written."""
    before = seen(spark, target)
    take_new(spark, source, target, config["max_files"])
    new = dict(zip(("documents", "batches"), (a - b for a, b in zip(seen(spark, target), before, strict=True)), strict=True))
    log.info("read %s: %d documents in %d batches", source, new["documents"], new["batches"])
    cells = counted(spark, target)
    volumes, edges = build(cells, config)
    for name, df in (("volumes", volumes), ("edges", edges)):
        df.hint("rebalance", "volume_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("volume_id").parquet(f"{target}/{name}")
    total = cells.agg(F.count_distinct("volume_id").alias("volumes"), F.count("*").alias("cells"), F.coalesce(F.sum("n"), F.lit(0)).alias("counted")).first().asDict()
    log.info("wrote %s: %s", target, total)
    return new | total


def output(spark: SparkSession, target: str) -> DataFrame:
    """All volumes as they stand, with the edge where each voxel's band begins."""
    volumes = spark.read.schema("z int, y int, x int, n long, v double, band int, point_id int, r double, g double, b double, a double, volume_id string").parquet(f"{target}/volumes")
    edges = spark.read.schema("edge int, x double, volume_id string").parquet(f"{target}/edges")
    begins = edges.select("volume_id", (F.col("edge") + 1).alias("band"), F.col("x").alias("band_from"))
    return volumes.join(begins, ["volume_id", "band"], "left")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="jobs.corpus_volumes")
    for name in ("--input", "--output"):
        p.add_argument(name, required=True)
    p.add_argument("--config", default=str(DEFAULT))
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("corpus volumes").getOrCreate()
    try:
        done = run(spark, a.input, a.output, json.loads(Path(a.config).read_text()))
    finally:
        spark.stop()
    print(json.dumps(done))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
