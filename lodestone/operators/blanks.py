"""Canonical names of blank nodes: graphs that differ in these names only become the same triples.

Each blank node has a colour: a digest of its colour before and of the sum of two hashes over its
triples, with the other end's colour where that is a blank node too. Sums are added up in parts, so a
node of any degree is coloured without an array. Rounds go on until no class of equal colours is split
any more, ROUNDS at most. A colour that one node alone has is its name.

What is still tied falls into pieces: nodes that hang together through tied nodes. Nodes without tied
neighbours are told by one more colour. A larger piece is decided by trial in one task, so its links
are counted first and a piece beyond MOST_LINKS is refused; so is one that needs more than
MOST_TRIALS. Refusing is an error, never a wrong name. Pieces with equal results can be exchanged and are
numbered.

Triples are (s, p, o, o_kind, o_type, o_lang), a set. A blank node is an IRI that begins with "_:";
a literal with such a text stays one. An empty graph and one without blank nodes stay as they are; null
types and languages count as ''. Further columns go.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.shared import stored
from .triples import COLUMNS

#: Rounds of colouring over the whole graph; what is tied then is decided piece by piece.
ROUNDS = 32
#: Links of the largest piece that one task decides, and nodes that are tried in it.
MOST_LINKS = 100_000
MOST_TRIALS = 5_000
#: Parts in which pieces with equal results are numbered.
_PARTS = 512

Link = tuple[str, str, str]  # way, predicate, other node


def is_blank(c: Column) -> Column:
    return F.startswith(c, F.lit("_:"))


def _links(touching: DataFrame) -> DataFrame:
    """(node, way, p, other, linked): each triple once for each blank node in it."""
    s, o = is_blank(F.col("s")), is_blank(F.col("o")) & (F.col("o_kind") == "iri")
    written = F.when(o, F.col("o")).otherwise(F.concat_ws("\x1f", "o_kind", "o_type", "o_lang", "o"))
    ways = F.array(
        F.when(s, F.struct(F.col("s").alias("node"), F.lit(">").alias("way"), "p", written.alias("other"), o.alias("linked"))),
        F.when(o, F.struct(F.col("o").alias("node"), F.lit("<").alias("way"), "p", F.col("s").alias("other"), s.alias("linked"))),
    )
    return touching.select(F.inline(F.array_compact(ways)))


def _sums(*columns: str) -> list[Column]:
    """Two sums of hashes over a group's rows."""
    return [F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(20,0)")).alias(f"h{seed}") for seed in (1, 2)]


def _digest(*columns: str) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256), 1, 32)


def _next(links: DataFrame, colours: DataFrame) -> DataFrame:
    """(node, colour): one round of colouring."""
    seen = links.join(colours.select(F.col("node").alias("other"), F.col("colour").alias("seen")), "other")
    sums = seen.groupBy("node").agg(*_sums("way", "p", "seen"))
    return colours.join(sums, "node", "left").select("node", _digest("colour", "h1", "h2").alias("colour"))


def coloured(links: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(node, colour) of the blank nodes, coloured until no class is split, or for so many rounds."""
    own = links.groupBy("node").agg(*_sums("way", "p", "ground"))
    colours = stored(own.select("node", _digest("h1", "h2").alias("colour")), "colours")
    number, inner = colours.count(), links.where("linked").select("node", "way", "p", "other")
    classes = colours.select("colour").distinct().count()
    for _ in range(rounds):
        if classes == number:
            break
        colours = stored(_next(inner, colours), "colours")
        now = colours.select("colour").distinct().count()
        if now == classes:
            break
        classes = now
    return colours


def pieces(links: DataFrame) -> DataFrame:
    """(node, piece): connected components over links (node, other) of both ways, named by their least node.

    Each round links what a node sees to the least of it, first beyond the node and then up to it, so rounds
    grow with the logarithm of a component's width and not with its length.
    """
    least = F.least("m", "a")
    edges = stored(links.select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b")).where("a != b").distinct(), "pieces")
    state = None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", least.alias("m"))
        beyond = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        beyond = beyond.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        low = beyond.groupBy("a").agg(F.min("b").alias("m"))
        upto = beyond.join(low, "a").select("b", "m").union(low.select(F.col("a").alias("b"), "m")).where("b != m")
        edges = stored(upto.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "pieces")
        now = edges.agg(F.count("*"), *_sums("a", "b")).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("piece")).union(edges.select("b", "b")).distinct()
        state = now


# --- one piece, in one task --------------------------------------------------------------------
class _Trial:
    """The canonical order of a piece: colours are refined, nodes of one's own colour part the rest, and a class that stays tied is tried node by node."""

    def __init__(self, links: dict[str, list[Link]], outside: dict[str, str]):
        self.links, self.outside, self.left = links, outside, MOST_TRIALS

    def refined(self, nodes: list[str], colour: dict[str, str]) -> dict[str, str]:
        """Colours of all nodes, those of `nodes` refined until none of their classes is split, and once more."""
        colour, classes = dict(colour), len({colour[n] for n in nodes})
        while True:
            see = lambda x: self.outside.get(x) or colour[x]
            seen = {n: repr((colour[n], sorted((w, p, see(x)) for w, p, x in self.links[n]))) for n in nodes}
            colour |= {n: hashlib.sha256(t.encode()).hexdigest()[:32] for n, t in seen.items()}
            now = len({colour[n] for n in nodes})
            if now == classes:
                return colour
            classes = now

    def order(self, nodes: list[str], colour: dict[str, str]) -> tuple[tuple, list[str]]:
        """(what tells pieces apart, the nodes in order)."""
        colour = self.refined(nodes, colour)
        same = defaultdict(list)
        for n in nodes:
            same[colour[n]].append(n)
        alone = sorted(c for c, ns in same.items() if len(ns) == 1)
        tied = [n for n in nodes if len(same[colour[n]]) > 1]
        parts = self.parts(tied)
        head = [same[c][0] for c in alone]
        if alone or len(parts) > 1:
            found = sorted((self.order(p, colour) for p in parts), key=lambda x: x[0])
            return (tuple(alone), tuple(f[0] for f in found)), head + [n for _, ns in found for n in ns]
        if not tied:
            return ((), ()), []
        if len(tied) == 1:
            return ((colour[tied[0]],), ()), tied
        least = min(same)
        best = None
        for n in same[least]:
            self.left -= 1
            if self.left < 0:
                raise ValueError(f"blank nodes too much alike: more than {MOST_TRIALS} trials in one piece")
            tried = self.order(tied, colour | {n: hashlib.sha256((colour[n] + "!").encode()).hexdigest()[:32]})
            if best is None or tried[0] < best[0]:
                best = tried
        return best

    def parts(self, nodes: list[str]) -> list[list[str]]:
        """Nodes that hang together."""
        todo, out = set(nodes), []
        for n in nodes:
            if n not in todo:
                continue
            todo.discard(n)
            part = [n]
            for x in part:
                for _, _, y in self.links[x]:
                    if y in todo:
                        todo.discard(y)
                        part.append(y)
            out.append(part)
        return out


def ordered(rows: Iterable[tuple[str, str, str | None, str | None, str | None, str | None]]) -> tuple[str, list[str]]:
    """(digest, nodes in order) of a piece from (node, colour, way, p, other, the other's colour if it is no member)."""
    links, colour, outside = defaultdict(list), {}, {}
    for node, c, way, p, other, seen in rows:
        colour[node] = c
        links[node].append((way, p, other))
        if seen is not None:
            outside[other] = seen
    told, nodes = _Trial(links, outside).order(list(colour), colour)
    return hashlib.sha256(repr(told).encode()).hexdigest()[:32], nodes


def _decided(pdf):
    import pandas as pd

    rows = pdf[["node", "colour", "way", "p", "other", "seen"]].astype(object)
    digest, nodes = ordered(rows.where(rows.notna(), None).itertuples(index=False, name=None))
    return pd.DataFrame({"node": nodes, "digest": digest, "piece": pdf["piece"].iloc[0], "place": range(len(nodes))})


def _numbered(decided: DataFrame) -> DataFrame:
    """(node, name) of (node, digest, piece, place): pieces of one digest are numbered, in parts, however many they are."""
    from pyspark.sql import Window

    heads = decided.where("place = 0").select("digest", "piece", F.pmod(F.xxhash64("piece"), F.lit(_PARTS)).alias("part"))
    counts = heads.groupBy("digest", "part").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("digest").orderBy("part")) - F.col("n")).drop("n")
    numbers = heads.withColumn("k", F.row_number().over(Window.partitionBy("digest", "part").orderBy("piece"))).join(before, ["digest", "part"])
    named = decided.join(numbers.select("piece", (F.col("before") + F.col("k") - 1).alias("number")), "piece")
    return named.select("node", F.concat_ws("", F.lit("_:c"), "digest", F.lit("r"), F.col("number").cast("string"), F.lit("n"), F.col("place").cast("string")).alias("name"))


def names(triples: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(node, name): the canonical names of the blank nodes of a set of triples."""
    return _names(_touching(triples), rounds)


def _names(touching: DataFrame, rounds: int) -> DataFrame:
    """(node, name), of a set of triples with blank nodes."""
    every = _links(touching)
    links = stored(every.withColumn("ground", F.when(F.col("linked"), "").otherwise(F.col("other"))), "links")
    colours = coloured(links, rounds)
    ties = colours.groupBy("colour").agg(F.count("*").alias("n")).where("n > 1").select("colour")
    tied = stored(colours.join(ties, "colour", "left_semi"), "tied")
    alone = colours.join(ties, "colour", "left_anti").select("node", F.concat(F.lit("_:c"), "colour").alias("name"))
    if tied.isEmpty():
        return alone
    own = links.where("linked").select("node", "way", "p", "other").join(tied, "node")
    members = tied.select(F.col("node").alias("other"), F.lit(True).alias("member"))
    seen = colours.select(F.col("node").alias("other"), F.col("colour").alias("seen"))
    own = stored(own.join(seen, "other").join(members, "other", "left"), "own")
    within = own.where("member AND node != other").select("node", "other")
    piece = stored(pieces(within), "members")
    # nodes without tied neighbours: one more colour, with what they see now
    sums = own.groupBy("node").agg(*_sums("way", "p", "seen"))
    single = tied.join(piece, "node", "left_anti").join(sums, "node", "left").select("node", _digest("colour", "h1", "h2").alias("digest"), F.col("node").alias("piece"), F.lit(0).alias("place"))
    rows = own.join(piece, "node").select("piece", "node", "colour", "way", "p", "other", F.when(F.col("member"), None).otherwise(F.col("seen")).alias("seen"))
    widest = rows.groupBy("piece").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    if widest and widest > MOST_LINKS:
        raise ValueError(f"blank nodes too much alike: {widest} links hang together, more than {MOST_LINKS}")
    decided = single
    if widest:
        decided = single.unionByName(rows.groupBy("piece").applyInPandas(_decided, "node string, digest string, piece string, place int"))
    return alone.unionByName(_numbered(stored(decided, "decided")))


def _plain(triples: DataFrame) -> DataFrame:
    return triples.select("s", "p", "o", "o_kind", *[F.coalesce(c, F.lit("")).alias(c) for c in ("o_type", "o_lang")])


def _touches() -> Column:
    return F.coalesce(is_blank(F.col("s")) | (is_blank(F.col("o")) & (F.col("o_kind") == "iri")), F.lit(False))


def _touching(triples: DataFrame) -> DataFrame:
    return _plain(triples).where(_touches()).distinct()


def canonical(triples: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """The triples with canonical names of their blank nodes. Triples without any aren't moved."""
    touching = stored(_touching(triples), "touching")
    ground = _plain(triples).where(~_touches()).distinct()
    if touching.isEmpty():
        return ground
    named = stored(_names(touching, rounds), "names")

    def renamed(df: DataFrame, column: str, blank: Column) -> DataFrame:
        others = [F.col(c) for c in COLUMNS if c != column]
        moved = df.where(blank).join(named, F.col(column) == F.col("node")).select(*others, F.col("name").alias(column))
        return moved.unionByName(df.where(~blank))

    out = renamed(touching, "s", is_blank(F.col("s")))
    out = renamed(out, "o", is_blank(F.col("o")) & (F.col("o_kind") == "iri"))
    return out.select(COLUMNS).unionByName(ground.select(COLUMNS))
