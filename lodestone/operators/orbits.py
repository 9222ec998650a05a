"""Chains and reachable nodes by pointers that double.

A table of steps leads from each node to one other. Its powers lead 1, 2, 4, ... steps on, each a
join of the last with itself, so a chain of a million nodes takes twenty rounds; what lies on
the chains of given nodes is found by going through the powers from the longest. Of many steps nodes are
left out first, a quarter at a time. No task or row holds a chain. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.shared import stored

#: Rounds of a search that goes one step at a time before chains without branches are taken by doubled pointers.
PLAIN_ROUNDS = 8
#: Steps whose doubled pointers are made without leaving nodes out first.
PLAIN_STEPS = 100_000


def powers(steps: DataFrame) -> list[DataFrame]:
    """(a, b) with one b for each a -> tables where b is 1, 2, 4, ... steps behind a, as far as chains go; a cycle ends with the number of nodes."""
    out = [stored(steps.select("a", "b"), "steps")]
    rows = out[0].count()
    while 1 << len(out) <= rows:
        last = out[-1]
        further = stored(last.alias("x").join(last.alias("y"), F.col("x.b") == F.col("y.a")).select("x.a", "y.b"), "steps")
        if further.isEmpty():
            break
        out.append(further)
    return out


def orbits(levels: list[DataFrame], starts: DataFrame) -> DataFrame:
    """(node): the starts and all that lies on their chains. A distance is a sum of powers, each taken or not."""
    found = starts.select("node").distinct()
    for level in reversed(levels):
        ahead = found.join(level, F.col("node") == F.col("a")).select(F.col("b").alias("node"))
        found = stored(found.union(ahead).distinct(), "orbits")
    return found


def _gone(edges: DataFrame, level: int) -> tuple[Column, Column]:
    """Does an edge's first node go at this level, and can its second: a node goes if its coin shows tails and that of the next heads, so no two neighbours go."""
    heads = lambda c: F.xxhash64(c, F.lit(level)) % 2 == 0
    return ~heads(F.col("a")) & heads(F.col("b")), ~heads(F.col("b"))


def contracted(steps: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """(levels of edges (a, b, via), powers of the last): at each level a quarter of the nodes goes, and an edge into one that goes leads past it, via it.

    So all levels together are a few times as long as the first, where powers of all steps would be as long for each doubling.
    """
    levels = [stored(steps.select("a", "b", F.lit(None).cast("string").alias("via")), "steps")]
    while levels[-1].count() > PLAIN_STEPS:
        edges, k = levels[-1].select("a", "b"), len(levels)
        goes, may = _gone(edges, k)
        gone = edges.where(goes).select(F.col("a").alias("via"), F.col("b").alias("past"))
        stay = edges.where(~goes)
        led = stay.where(may).join(gone, F.col("b") == F.col("via"), "left").select("a", F.coalesce("past", "b").alias("b"), "via")
        levels.append(stored(led.union(stay.where(~may).select("a", "b", F.lit(None).cast("string"))), "steps"))
    return levels, powers(levels[-1])


def on_chains(made: tuple[list[DataFrame], list[DataFrame]], starts: DataFrame) -> DataFrame:
    """(node): as `orbits`, by the levels of `contracted`: up with the starts, down with what was left out."""
    levels, last = made
    now, lost = starts.select("node").distinct(), []
    for k, edges in enumerate(levels[:-1], 1):
        gone = edges.where(_gone(edges, k)[0]).select("a", "b")
        met = stored(now.join(gone, F.col("node") == F.col("a"), "left"), "orbits")
        lost.append(met.where("a IS NOT NULL").select("node"))
        now = met.select(F.coalesce("b", "node").alias("node")).distinct()
    found = orbits(last, now)
    for edges, own in zip(reversed(levels[1:]), reversed(lost), strict=True):
        past = edges.where("via IS NOT NULL").select("a", F.col("via"))
        found = found.union(stored(found.join(past, F.col("node") == F.col("a")).select(F.col("via").alias("node")).union(own).distinct(), "orbits"))
    return found


def reached(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """(node): what paths of one step or more lead to from any of the starts, over edges (a, b).

    A breadth-first search by rounds, which never holds pairs of other sources. If it is not over
    after PLAIN_ROUNDS, nodes with one edge are followed by doubled pointers: then the rounds are
    as many as the branchings on a way, not as its edges.
    """
    edges = stored(edges.select("a", "b").distinct(), "edges")
    step = lambda nodes: nodes.join(edges, F.col("node") == F.col("a")).select(F.col("b").alias("node")).distinct()
    known = fresh = stored(step(starts.select("node").distinct()), "reached")
    rounds, levels = 1, None
    while not fresh.isEmpty():
        if rounds == PLAIN_ROUNDS:
            single = edges.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("b")).where("n = 1")
            levels = contracted(single)
        if levels:
            chains = on_chains(levels, fresh)
            ahead = step(chains).union(chains)
        else:
            ahead = step(fresh)
        fresh = stored(ahead.distinct().join(known, "node", "left_anti"), "reached")
        known = known.union(fresh)
        rounds += 1
    return known


def closure(edges: DataFrame) -> DataFrame:
    """(a, b) for each path of one step or more, of all sources.

    The pairs of up to 2^k steps, followed by those of exactly 2^k, give the pairs of up to
    2^(k + 1): rounds grow with the logarithm of the longest shortest path, and in a tree each pair
    is made once. Cycles end by themselves.
    """
    known = power = stored(edges.select("a", "b").distinct(), "edges")
    then = lambda x, y: x.alias("x").join(y.alias("y"), F.col("x.b") == F.col("y.a")).select(F.col("x.a").alias("a"), F.col("y.b").alias("b")).distinct()
    while True:
        fresh = stored(then(known, power).join(known, ["a", "b"], "left_anti"), "paths")
        if fresh.isEmpty():
            return known
        known = known.union(fresh)
        power = stored(then(power, power), "powers")
