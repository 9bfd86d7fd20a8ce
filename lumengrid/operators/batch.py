"""Cases and batches."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import store

#: Hexadecimal digits of a case's hash that name its part: 4096 parts.
DIGITS = 3


def _width(batches: int) -> int:
    return max(4, len(str(max(batches, 1))))


def assign(cases: DataFrame, size: int = 100, shuffle: bool = True, seed: int = 0, prefix: str = "batch_") -> DataFrame:
    """cases (case_id) with batch_index, batch_id and batch_case_index (both from 1), batch_size, batch_shuffle and batch_seed:
    chunks of `size` in a hashed order (or by id).

    Places come from a sort within parts and the parts' sizes, so no task sees all cases. A case's part hangs on the case alone, as sizes and
    places are worked out by two runs of the plan: it is the beginning of its hash. Ranges of ids are drawn anew by every run, so in the order of
    ids they are written once and read by both.
    """
    if size < 1:
        raise ValueError("batch size must be positive")
    spark = cases.sparkSession
    if shuffle:
        key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("case_id").cast("string")))
        placed = cases.withColumn("_key", key).withColumn("_part", F.conv(F.substring("_key", 1, DIGITS), 16, 10).cast("int"))
    else:
        placed = store.saved(cases.repartitionByRange("case_id").withColumn("_part", F.spark_partition_id())).withColumn("_key", F.lit(""))
    sizes = {r[0]: r[1] for r in placed.groupBy("_part").count().collect()}  # one row for each part
    first, at = {}, 0
    for p in sorted(sizes):
        first[p] = at
        at += sizes[p]
    base = spark.createDataFrame(list(first.items()) or [(0, 0)], "_part int, _first long")
    rank = F.row_number().over(Window.partitionBy("_part").orderBy("_key", "case_id")) - 1
    place = F.col("_first") + rank
    out = placed.join(F.broadcast(base), "_part").withColumn("_i", place)
    index = F.floor(F.col("_i") / size).cast("int") + 1
    return out.select(
        *cases.columns, index.alias("batch_index"), F.format_string(f"{prefix.replace('%', '%%')}%0{_width(-(-at // size))}d", index).alias("batch_id"),
        (F.col("_i") % size + 1).cast("int").alias("batch_case_index"), F.lit(size).alias("batch_size"), F.lit(shuffle).alias("batch_shuffle"), F.lit(seed).cast("long").alias("batch_seed"),
    )


def assign_list(cases: list[str], size: int = 100, shuffle: bool = True, seed: int | None = 0, prefix: str = "batch_") -> list[tuple[int, str, int, str]]:
    """(batch_index, batch_id, batch_case_index, case) of a list of names, with Python's seeded shuffle; places count from 1."""
    if size < 1:
        raise ValueError("batch size must be positive")
    order = list(cases)
    if shuffle:
        random.Random(seed).shuffle(order)
    width = _width(-(-len(order) // size))
    return [(i // size + 1, f"{prefix}{i // size + 1:0{width}d}", i % size + 1, c) for i, c in enumerate(order)]
