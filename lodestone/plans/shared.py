"""Scratch tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, label: str) -> str:
    """A new folder under spark.checkpoint.dir. Where none is set, a local master gets a temporary one and a cluster is refused."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="lodestone-checkpoints-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def is_shared(spark: SparkSession, path: str) -> bool:
    """Does a path without a scheme lie in the checkpoint folder or the warehouse, which all executors share wherever they are?"""
    context = spark.sparkContext.getConf()
    bases = [spark.conf.get("spark.checkpoint.dir", None), context.get("spark.checkpoint.dir"), spark.conf.get("spark.sql.warehouse.dir", None)]
    return any(path.startswith(b.removeprefix("file://").removeprefix("file:").rstrip("/") + "/") for b in bases if b)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write df to a scratch folder and read it again: lineage is cut, and lost executors cost nothing that is written."""
    path = folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
