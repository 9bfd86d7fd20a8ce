"""Tables written in between, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder where that is unset and all is one machine."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"file://{tempfile.mkdtemp(prefix='lumengrid-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def stored(rows: DataFrame, *by: str) -> DataFrame:
    """The rows written once, in folders by the given columns, and read back: what follows reads only the folders it asks for, and
    lost executors cost no more than these. The table stays, as results may read it later."""
    path = f"{shared_folder(rows.sparkSession)}/lumengrid/stored-{uuid.uuid4().hex}"
    rows.write.partitionBy(*by).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path).select(*rows.columns)


def saved(rows: DataFrame) -> DataFrame:
    """The same without folders of its own: cuts the lineage where a loop goes on with its result."""
    path = f"{shared_folder(rows.sparkSession)}/lumengrid/saved-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
