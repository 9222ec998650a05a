"""Sharding by extendible hashing.

The directory is a binary trie over the leading bits of a row's hash. A bucket splits on its
next bit only while its rows exceed the byte limit and differ in their hashes, so the leaves
depend on the rows alone, not on their order. Ids, hashes and sizes (narrow rows) are written
once to the shared folder. A pass adds up the bytes of cells a few bits below the expected depth
(partial sums before the shuffle); cells add themselves to their ancestors; a node is a leaf if
it fits, or holds one hash only, and its parent doesn't. Only rows under a cell that isn't
settled go on to a deeper pass.

Cases: rows with the whole hash in common (repeated ids, null ids) can't be split by bits, nor
can a row that exceeds the limit by itself. Their bucket ends where they're alone in it and is
cut into pages: running bytes are added up inside each partition, partitions are offset by the
sums before them, and a page holds what starts within half a limit; a row of over half a limit
gets a page of its own (numbered from -1 downwards), `over_limit` if it exceeds the limit by
itself. Null ids and texts count as empty. An empty table gives no rows. Repeated rows are all kept.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, spare
from .components import attach

#: Bits of the hash kept: 15 hexadecimal digits of md5.
HASH_BITS = 60
#: Nodes down to this depth are broadcast; below it no node has more than its share of cells.
SHALLOW = 12
#: Bits that a pass looks below the depth where buckets are expected to fit.
AHEAD = 6


def text_bytes(text_col: str) -> Column:
    return F.coalesce(F.octet_length(F.col(f"`{text_col}`").cast("string")), F.lit(0)).cast("long")


def row_bytes(df: DataFrame) -> Column:
    """The bytes of a whole row, as JSON."""
    return F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).cast("long")


def hashed(id_col: str) -> Column:
    ident = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(ident.cast("binary")), 1, 15), 16, 10).cast("long")


def sized(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: Column | None = None) -> DataFrame:
    """id, n_bytes, h: what sharding needs of a row."""
    return df.select(F.col(f"`{id_col}`").alias("id"), (text_bytes(text_col) if size is None else size).alias("n_bytes"), hashed(id_col).alias("h"))


def _prefix(depth: str | int) -> F.Column:
    return F.expr(f"shiftright(h, {HASH_BITS} - {depth})")


def _leaves(rows: DataFrame, limit: int, low: int, high: int) -> DataFrame:
    """(cell, depth, prefix, shard_bytes): the leaf for each cell of `high` bits; depth is null where the cell isn't settled."""
    cells = rows.groupBy(_prefix(high).alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.min("h").alias("least"), F.max("h").alias("most"))
    path = scratch(rows.sparkSession, "cells")
    cells.write.parquet(path)
    cells = rows.sparkSession.read.parquet(path)

    def up(first: int) -> DataFrame:
        return cells.withColumn("depth", F.explode(F.sequence(F.lit(first), F.lit(high)))).withColumn("prefix", F.expr(f"shiftright(cell, {high} - depth)"))

    sums = up(low).groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.min("least").alias("least"), F.max("most").alias("most"))
    path = scratch(rows.sparkSession, "nodes")
    sums.where((F.col("shard_bytes") <= limit) | (F.col("least") == F.col("most"))).select("depth", "prefix", "shard_bytes").write.parquet(path)
    settled = rows.sparkSession.read.parquet(path)
    # above the first settled node there is no leaf, and few nodes that all cells would meet in
    first = settled.agg(F.min("depth")).first()[0]
    if first is None:
        return cells.select("cell", F.lit(None).cast("int").alias("depth"), F.lit(None).cast("long").alias("prefix"), F.lit(None).cast("long").alias("shard_bytes"))
    nodes = up(first).select("cell", "depth", "prefix")
    few = settled.where(F.col("depth") <= SHALLOW)  # fewer than 2^(SHALLOW + 1) nodes
    met = nodes.where(F.col("depth") <= SHALLOW).join(F.broadcast(few), ["depth", "prefix"]).unionByName(nodes.where(F.col("depth") > SHALLOW).join(settled.where(F.col("depth") > SHALLOW), ["depth", "prefix"]))
    # of the settled nodes above a cell the highest is the leaf
    leaf = met.groupBy("cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes")).alias("leaf"))
    return cells.select("cell").join(leaf, "cell", "left").select("cell", "leaf.depth", "leaf.prefix", "leaf.shard_bytes")


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Buckets that no bit can split (rows with their depth and prefix): pages of running bytes, never a whole bucket in one task."""
    keep = rows.columns
    rows = rows.withColumn("__part", F.spark_partition_id()).withColumn("__own", F.col("n_bytes") * 2 > limit).withColumn("__weight", F.when(F.col("__own"), 0).otherwise(F.col("n_bytes")))
    # the order inside a partition only has to be one order; ties are alike
    inside = Window.partitionBy("h", "__part").orderBy("__own", "n_bytes").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("h").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("h", "__part").agg(F.sum("__weight").alias("__w"), F.sum(F.col("__own").cast("long")).alias("__o"))
    parts = parts.select("h", "__part", F.coalesce(F.sum("__w").over(before), F.lit(0)).alias("__w0"), F.coalesce(F.sum("__o").over(before), F.lit(0)).alias("__o0"))
    run = rows.withColumn("__w1", F.sum("__weight").over(inside) - F.col("__weight")).withColumn("__o1", F.sum(F.col("__own").cast("long")).over(inside)).join(parts, ["h", "__part"])
    page = F.when(F.col("__own"), -(F.col("__o0") + F.col("__o1"))).otherwise(F.floor((F.col("__w0") + F.col("__w1")) / F.lit(max(1, limit // 2))))
    return run.select(*keep, page.cast("long").alias("page"))


def _placed(df: DataFrame, limit_bytes: int, id_col: str, text_col: str, size: Column | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(rows of leaves that fit: id, n_bytes, h, depth, prefix, shard_bytes; rows of leaves that no bit can split: id, n_bytes, h, depth, prefix)."""
    if limit_bytes < 1:
        raise ValueError("limit_bytes must be positive")
    spark = df.sparkSession
    path = scratch(spark, "sharding")
    sized(df, id_col, text_col, size).write.parquet(path)
    todo = spark.read.parquet(path)
    total = todo.agg(F.sum("n_bytes")).first()[0] or 0
    low, high = 0, min(HASH_BITS, AHEAD + max(0, math.ceil(math.log2(max(1, total / limit_bytes)))))
    done: list[DataFrame] = []
    alone: list[DataFrame] = []
    while True:
        leaves = _leaves(todo, limit_bytes, low, high)
        path = scratch(spark, "sharding")
        todo.withColumn("cell", _prefix(high)).join(leaves, "cell").drop("cell").write.parquet(path)
        placed = spark.read.parquet(path)
        fits = F.col("shard_bytes") <= limit_bytes
        done.append(placed.where("depth IS NOT NULL").where(fits).select("id", "n_bytes", "h", "depth", "prefix", "shard_bytes"))
        own = placed.where("depth IS NOT NULL").where(~fits).select("id", "n_bytes", "h", "depth", "prefix")
        if not own.isEmpty():
            alone.append(own)
        deeper = placed.where("depth IS NULL").select("id", "n_bytes", "h")
        if deeper.isEmpty():
            break
        # at the last bit a cell is one hash, so nothing is left after it
        todo, low, high = deeper, high + 1, min(HASH_BITS, high + 8)
    return reduce(DataFrame.unionByName, done), reduce(DataFrame.unionByName, alone) if alone else None


def shard(df: DataFrame, limit_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, depth, prefix (the leading `depth` bits), page (0 unless no bit can split), shard_bytes, over_limit."""
    out, alone = _placed(df, limit_bytes, id_col, text_col)
    out = out.withColumn("page", F.lit(0).cast("long"))
    if alone is not None:
        path = scratch(df.sparkSession, "sharding")
        _pages(alone, limit_bytes).write.parquet(path)
        paged = df.sparkSession.read.parquet(path)
        sums = paged.groupBy("h", "page").agg(F.sum("n_bytes").alias("shard_bytes"))
        out = out.unionByName(paged.join(sums, ["h", "page"]))
    return out.select(F.col("id").alias(id_col), "n_bytes", F.col("depth").cast("int").alias("depth"), "prefix", "page", "shard_bytes", (F.col("shard_bytes") > limit_bytes).alias("over_limit"))


def write(df: DataFrame, path: str, limit_bytes: int, id_col: str = "doc_id", text_col: str = "text", size: Column | None = None) -> None:
    """Write df's rows, all columns, as Parquet: a folder `shard=...` for each shard.

    `size` measures a row (the text's bytes, if none is given; `row_bytes(df)` for all columns).
    Whole rows travel twice, to their hash and to their shard, and a hash of very many rows is
    met by broadcast; so no task gets more than a shard and its share."""
    fits, alone = _placed(df, limit_bytes, id_col, text_col, size)
    of = fits.select("h", "depth", "prefix", F.lit(False).alias("paged"))
    if alone is not None:
        of = of.unionByName(alone.select("h", "depth", "prefix", F.lit(True).alias("paged")))
    of = of.groupBy("h", "depth", "prefix", "paged").agg(F.count("*").alias("weight"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), (text_bytes(text_col) if size is None else size).alias("n_bytes"), hashed(id_col).alias("h"))
    rows = attach(rows, "h", of)
    name = F.concat(F.col("depth").cast("string"), F.lit("-"), F.lower(F.hex("prefix")))
    out = rows.where("NOT paged").select("row", name.alias("shard"))
    if alone is not None:
        # pages count by partitions, which must be the same whenever they're looked at
        own = scratch(df.sparkSession, "sharding")
        rows.where("paged").drop("paged").write.parquet(own)
        out = out.unionByName(_pages(df.sparkSession.read.parquet(own), limit_bytes).select("row", F.concat(name, F.lit("-"), F.col("page").cast("string")).alias("shard")))
    shard_col = spare(df, "shard")
    out.select("row.*", F.col("shard").alias(shard_col)).repartition(shard_col).write.partitionBy(shard_col).parquet(path)
