"""Outputs of many resources that are written again only where they changed.

A folder holds `data`, one subfolder of lines for each resource, and `manifest`, a table of the resources
with a digest of their lines. A run digests what it has, compares that with the last manifest by one
join, overwrites the subfolders that are new or changed, removes those whose resource is gone, and
writes the new manifest last. A run that is cut short leaves the old manifest, so the next one
writes the same subfolders again; a run without changes writes nothing. One writer at a time.

Lines are a set: order and repetitions don't count. A null line is none, a null resource an error.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.shared import stored

STATES = ("new", "changed", "same", "gone")


def _digests(lines: DataFrame) -> DataFrame:
    """(resource, n, digest): sums of two hashes of the lines, so that a resource of any size is added up in parts."""
    h = lambda seed: F.sum(F.xxhash64(F.lit(seed), "value").cast("decimal(20,0)"))
    sums = lines.groupBy("resource").agg(F.count("*").alias("n"), h(1).alias("a"), h(2).alias("b"))
    return sums.select("resource", "n", F.concat_ws(":", "a", "b").alias("digest"))


def last(spark: SparkSession, path: str) -> tuple[int, DataFrame]:
    """(version, manifest) of the last complete run; version 0 and no rows before the first."""
    try:
        every = spark.read.schema("resource string, n long, digest string, version int").parquet(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, spark.createDataFrame([], "resource string, n long, digest string")
    version = every.agg(F.max("version")).first()[0] or 0
    return version, every.where(F.col("version") == version).drop("version")


def _remove(spark: SparkSession, path) -> None:
    """Remove a folder, given as a text or (escaped, as file_path is) as a java.net.URI."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _data(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value string, resource string").text(f"{path}/data")


def sync(lines: DataFrame, path: str) -> DataFrame:
    """Bring the folder to these lines (resource, value); returns (resource, state) of all resources, old and new."""
    spark = lines.sparkSession
    checked = F.when(F.col("resource").isNull(), F.raise_error(F.lit("a line without resource"))).otherwise(F.col("resource"))
    lines = lines.where("value IS NOT NULL").select(checked.alias("resource"), "value").distinct()
    version, before = last(spark, path)
    old = before.select("resource", F.col("n").alias("n_before"), F.col("digest").alias("digest_before"))
    state = F.when(F.col("n_before").isNull(), "new").when(F.col("n").isNull(), "gone").when((F.col("n") == F.col("n_before")) & (F.col("digest") == F.col("digest_before")), "same").otherwise("changed")
    states = stored(_digests(lines).join(old, "resource", "full_outer").withColumn("state", state), "states")
    if states.where("state != 'same'").isEmpty():
        return states.select("resource", "state")
    dirty = lines.join(states.where("state IN ('new', 'changed')").select("resource"), "resource", "left_semi")
    # a resource in one file; the lines of one that is changed are sorted in its task, spilling if need be
    dirty.repartition("resource").sortWithinPartitions("resource", "value").write.option("partitionOverwriteMode", "dynamic").partitionBy("resource").mode("overwrite").text(f"{path}/data")
    if not (gone := states.where("state = 'gone'").select("resource")).isEmpty():
        files = _data(spark, path).select("resource", F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("at")).join(gone, "resource", "left_semi")
        for r in files.select("at").distinct().toLocalIterator():  # one at a time, and only what vanished
            _remove(spark, spark.sparkContext._jvm.java.net.URI(r.at))
    states.where("n IS NOT NULL").select("resource", "n", "digest").write.mode("overwrite").parquet(f"{path}/manifest/version={version + 1}")
    if version > 1:  # the last one stays beside the new one
        _remove(spark, f"{path}/manifest/version={version - 1}")
    return states.select("resource", "state")


def lines(spark: SparkSession, path: str, resources: list[str] | None = None) -> DataFrame:
    """(resource, value) of the folder, or of some resources, whose subfolders alone are opened."""
    out = _data(spark, path).select("resource", "value")
    return out if resources is None else out.where(F.col("resource").isin(resources))
