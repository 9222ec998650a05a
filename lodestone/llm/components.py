"""Connected components of a table of links, without collecting them.

Each task first contracts its own links to stars. Then stars alternate: each node links its
larger neighbours to its least one, then its smaller ones to its least one, until every node
has one parent that has none itself. The number of links doesn't grow, and a round at least
halves long paths. Each round is written to the shared folder, and the one before it removed.

A node may have a third of all links. What is known of such a node is broadcast to its links
(there can be only so many of them), so that they needn't meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, scratch


#: A key of more rows than this, and of more than this share of all rows, is joined by broadcast; so at most HUBS keys are.
HUB_ROWS, HUBS = 500, 10_000


def _save(df: DataFrame) -> tuple[DataFrame, str]:
    path = scratch(df.sparkSession, "components")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def attach(rows: DataFrame, key: str, facts: DataFrame, how: str = "inner") -> DataFrame:
    """rows with the facts of their key. facts has a row for each key, and as `weight` at most the number of its rows."""
    total = rows.count()
    plain = facts.drop("weight")
    if total <= HUB_ROWS:
        return rows.join(plain, key, how)
    # weights add up to no more than all rows, so fewer than HUBS keys exceed this
    cut = max(HUB_ROWS, total // HUBS)
    hubs = facts.where(F.col("weight") > cut).drop("weight").collect()
    if not hubs:
        return rows.join(plain, key, how)
    few = F.broadcast(rows.sparkSession.createDataFrame(hubs, plain.schema))
    return rows.join(few, key).unionByName(rows.join(few, key, "left_anti").join(facts.where(F.col("weight") <= cut).drop("weight"), key, how))


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links to stars around the least node of each component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        # hook each root of a link to the lesser one, then shorten paths
        p, q = root[x], root[y]
        low, high = np.minimum(p, q), np.maximum(p, q)
        before = root.copy()
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        if (root == before).all():
            break
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a = b = np.zeros(0, np.int64)
    for batch in batches:
        a, b = np.concatenate([a, np.asarray(batch.column(0))]), np.concatenate([b, np.asarray(batch.column(1))])
        if len(a) > 1_000_000:  # contracted links are at most as many as nodes
            a, b = contract(a, b)
            if len(a) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                a = b = np.zeros(0, np.int64)
    if len(a):
        a, b = contract(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _large(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.sum((F.col("b") > F.col("a")).cast("long")).alias("weight"))
    return attach(both.where("b > a"), "a", least).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("weight"))
    return attach(down, "a", least).select("b", "m").unionByName(least.select(F.col("a").alias("b"), "m")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _settled(links: DataFrame) -> bool:
    """Are all components stars: no node has two parents, or a parent and children?"""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up > 0 AND down > 0").isEmpty()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """links (a, b: long) -> (node, root) for every node that is linked; the root is the least node."""
    now, path = _save(links.where("a <> b").select("a", "b").mapInArrow(_local, "a long, b long"))
    for _ in range(rounds):
        if _settled(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        middle, between = _save(_large(now))
        then, after = _save(_small(middle))
        for old in (path, between):
            drop_scratch(links.sparkSession, old)
        now, path = then, after
    raise RuntimeError(f"links didn't settle in {rounds} rounds")
