"""Facet counts from bitmaps: one for each facet value and block of 32,768 records.

The bitmaps are made once; a question reads those instead of the records. Values of one facet are
united, facets intersected, and a facet's own choice is left out of its counts, all by Spark's bitmap
aggregates inside the blocks. Records are numbered from 0 within each task that wrote them, so
blocks are full whatever the keys are, and no block spans two tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.shared import stored

#: The name under which found keys count as a facet of their own.
_HITS = "\0hits"


@dataclass
class Bitmaps:
    key: str
    #: (key, number)
    numbers: DataFrame
    #: (facet, value, block, bits)
    maps: DataFrame


def _bits(rows: DataFrame, *by: str) -> DataFrame:
    """One bitmap for each group and block of the numbers in rows."""
    return rows.groupBy(*by, F.bitmap_bucket_number("number").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def build(indexed: DataFrame, key: str) -> Bitmaps:
    """Bitmaps of what facets.index made, as tables in the shared folder. Values that are null count as none."""
    numbered = stored(indexed.select(key, "facets", F.monotonically_increasing_id().alias("number")), "numbered")
    values = numbered.select("number", F.explode("facets").alias("facet", "list")).select("number", "facet", F.explode("list").alias("value")).where("value IS NOT NULL")
    return Bitmaps(key, numbered.select(key, "number"), stored(_bits(values, "facet", "value"), "bitmaps"))


def counts(index: Bitmaps, chosen: dict[str, list[str]] | None = None, hits: DataFrame | None = None) -> DataFrame:
    """(facet, value, n) as facets.counts gives it: choices of other facets apply, chosen values without records stay with 0.

    `hits` holds the keys that a text search found; without it all records count.
    """
    chosen = {f: v for f, v in (chosen or {}).items() if v}
    spark = index.maps.sparkSession
    picked = [(f, v) for f, values in chosen.items() for v in dict.fromkeys(values)]
    asked = []
    if picked:
        rows = spark.createDataFrame(picked, "facet string, value string")
        asked.append(index.maps.join(F.broadcast(rows), ["facet", "value"]).groupBy("facet", "block").agg(F.bitmap_or_agg("bits").alias("bits")))
    if hits is not None:
        found = index.numbers.join(hits.select(index.key), index.key, "left_semi")
        asked.append(_bits(found.withColumn("facet", F.lit(_HITS)), "facet"))
    if not asked:
        return index.maps.groupBy("facet", "value").agg(F.sum(F.bitmap_count("bits")).alias("n"))
    tests = asked[0] if len(asked) == 1 else asked[0].unionByName(asked[1])
    names = [*chosen, *([_HITS] if hits is not None else [])]
    # for each facet of its own choice, and "" for all others: the tests that apply to its values
    owners = spark.createDataFrame([(own, facet, len([n for n in names if n != own])) for own in ["", *chosen] for facet in names if facet != own], "own string, facet string, needed int")
    passed = tests.join(F.broadcast(owners), "facet").groupBy("own", "block", "needed").agg(F.bitmap_and_agg("bits").alias("passed"), F.count("*").alias("met")).where("met = needed").drop("met", "needed")
    own = F.when(F.col("facet").isin(list(chosen)), F.col("facet")).otherwise(F.lit(""))
    mapped = index.maps.withColumn("own", own)
    alone = [f for f in chosen if names == [f]]
    both = mapped.join(passed, ["own", "block"]).select("facet", "value", "block", F.explode(F.array("bits", "passed")).alias("bits"))
    kept = both.groupBy("facet", "value", "block").agg(F.bitmap_and_agg("bits").alias("bits"))
    if alone:  # the only test is the facet's own, which doesn't apply to it
        kept = kept.unionByName(index.maps.where(F.col("facet").isin(alone)).select("facet", "value", "block", "bits"))
    numbers = kept.select("facet", "value", F.bitmap_count("bits").alias("n")).where("n > 0")
    if picked:
        numbers = numbers.unionByName(rows.withColumn("n", F.lit(0).cast("long")))
    return numbers.groupBy("facet", "value").agg(F.sum("n").alias("n"))
