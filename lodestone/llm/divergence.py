"""Source divergence audit: how far the words of the sources of a language lie apart.

Terms are runs of letters and of characters beyond ASCII. A language keeps the terms of at
least `LEAST` of its documents; a group is a source of a language. In parts of a thousand
millionth, a group's share of a term is p = 1 + floor(SCALE * (count + 1) / (N + V)), N its
occurrences of kept terms and V their number. Of two shares, floor((p - q) * (p - q) / q) is
the divergence; a pair's is the sum over all kept terms.

Method: words are counted where the texts lie and summed by one shuffle; a term is then one row
with the counts of its groups, and a run of rows a tile, a dense matrix of groups by terms. For
each tile the shares and the divergences of all pairs of groups are computed by broadcasting,
in 64-bit integers; a task adds its tiles up to one matrix of pairs and keeps a heap of the best
terms for each group. The matrices of the tasks are summed, the heaps merged in two levels.
Groups are dealt in bands, and a task holds the matrix of one pair of bands at a time, so
memory doesn't grow with the number of sources.

Cases: null text, lang and source are empty ones. Repeated rows and ids are documents of their
own. A language without a kept term has pairs of value 0 and no terms; a language of one source
has no pairs. Empty tables give no rows. Other columns play no part.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch

#: Documents of a language that a kept term is in, at least.
LEAST = 3
#: Shares are counted in parts of it.
SCALE = 1_000_000_000
#: Terms that are told of each group.
TERMS = 200
#: Sources of a band: a matrix of pairs has its square of numbers.
BAND = 256
#: Numbers of a tile of all pairs (groups by groups by terms) in memory.
TILE = 1 << 21
#: Groups whose counts and numbers of terms go to all tasks, 24 bytes each. Pairs are as many as their square.
GROUPS = 1_000_000
#: Different words of a task that are summed before they are sent.
PENDING = 200_000
#: Bytes of a text that are parted at once.
SLICE = 1 << 20

_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_TO_WORDS = bytes((b | 32 if 65 <= b <= 90 else b) if b in _LETTERS else 32 for b in range(256))


def words(raw: bytes) -> Counter:
    """How often each term is in a text of UTF-8 bytes; a slice at a time."""
    spaced = raw.translate(_TO_WORDS)
    if len(spaced) <= SLICE:
        return Counter(spaced.split())
    out, at = Counter(), 0
    while at < len(spaced):
        end = spaced.find(b" ", at + SLICE)
        end = len(spaced) if end < 0 else end
        out.update(spaced[at:end].split())
        at = end
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to (lang, source, term, n, docs); a group's row without a term says that it occurs."""
    sums: dict[tuple[bytes, bytes], dict[bytes, list[int]]] = {}
    pending = 0

    def out() -> pa.RecordBatch:
        langs, sources, terms, n, docs = [], [], [], [], []
        for (lang, source), own in sums.items():
            langs += [lang] * (len(own) + 1)
            sources += [source] * (len(own) + 1)
            terms += [None, *own]
            n += [0, *(x[0] for x in own.values())]
            docs += [0, *(x[1] for x in own.values())]
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.binary()), pa.array(sources, pa.binary()), pa.array(terms, pa.binary()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        lang, source, text = (batch.column(k) for k in range(3))
        for k in range(batch.num_rows):
            own = sums.setdefault((lang[k].as_py(), source[k].as_py()), {})
            before = len(own)
            for w, c in words(text[k].as_py()).items():
                x = own.get(w)
                if x is None:
                    own[w] = [c, 1]
                else:
                    x[0] += c
                    x[1] += 1
            pending += len(own) - before + (before == 0)
            if pending >= PENDING:
                yield out()
                sums, pending = {}, 0
    if sums:
        yield out()


def counted(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, term (null: the group occurs), n, docs: a row for each, whatever the number of tasks."""
    raw = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).cast("binary")
    parts = df.select(raw(lang_col).alias("lang"), raw(source_col).alias("source"), raw(text_col).alias("text")).mapInArrow(_count, "lang binary, source binary, term binary, n long, docs long")
    text = parts.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "source", "term")], "n", "docs")
    # by language and term only, so that what follows a term needs no other exchange
    return text.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), three digits at a time, so that no product leaves 64 bits."""
    whole, rest = np.divmod(count + 1, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digit
    return whole + 1


class _Bands:
    """The tiles of one language and pair of bands: a matrix of pairs, and heaps where the bands are the same."""

    def __init__(self, a: slice, b: slice, totals: np.ndarray, whole: int):
        self.a, self.b = a, b
        self.left, self.right, self.whole = totals[a], totals[b], np.int64(whole)
        self.pairs = np.zeros((len(self.left), len(self.right)), np.int64)
        self.heaps: list[list] = [[] for _ in self.left] if a == b else []
        self.width = max(1, TILE // max(1, self.pairs.size))

    def add(self, terms: list[str], groups: list[np.ndarray], counts: list[np.ndarray]) -> None:
        size = max(self.a.stop, self.b.stop)
        for k in range(0, len(terms), self.width):
            own = terms[k : k + self.width]
            tile = np.zeros((size, len(own)), np.int64)
            for t, (g, n) in enumerate(zip(groups[k : k + self.width], counts[k : k + self.width], strict=True)):
                here = g < size
                tile[g[here], t] = n[here]
            p = _share(tile[self.a], self.left[:, None])
            q = p if self.heaps else _share(tile[self.b], self.right[:, None])
            apart = p[:, None, :] - q[None, :, :]
            self.pairs += (apart * apart // q[None, :, :]).sum(axis=2)
            if self.heaps:
                every = np.array([int(n.sum()) for n in counts[k : k + self.width]], np.int64)
                base = _share(every, self.whole)[None, :]
                apart = p - base
                value = apart * apart // base
                told = (tile[self.a] > 0) & (apart > 0)
                for g, heap in enumerate(self.heaps):
                    (at,) = np.nonzero(told[g])
                    if len(at) > TERMS:  # those below the tile's own best, and ties of the last of them
                        at = at[value[g, at] >= np.partition(value[g, at], -TERMS)[-TERMS]]
                    for t in at:
                        _keep(heap, int(value[g, t]), own[t])

    def rows(self) -> Iterator[tuple]:
        """(part, group, other, term, value)"""
        for i, j in zip(*np.nonzero(np.ones_like(self.pairs, bool)), strict=True):
            if self.a.start + i != self.b.start + j:
                yield "pair", self.a.start + int(i), self.b.start + int(j), None, int(self.pairs[i, j])
        for g, heap in enumerate(self.heaps):
            for x in heap:
                yield "term", self.a.start + g, None, x.term, x.value


class _Entry:
    """Less is worse: a smaller value, then a greater term in UTF-8."""

    __slots__ = ("value", "raw", "term")

    def __init__(self, value: int, term: str):
        self.value, self.term, self.raw = value, term, term.encode()

    def __lt__(self, other: _Entry) -> bool:
        return (self.value, other.raw) < (other.value, self.raw)


def _keep(heap: list, value: int, term: str) -> None:
    if len(heap) < TERMS:
        heapq.heappush(heap, _Entry(value, term))
    elif value >= heap[0].value:
        heapq.heappushpop(heap, _Entry(value, term))


def _tiles(numbers: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of (lang, unit, term, groups, counts), those of a unit together, to sums and heaps of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.value
        now, bands, out = None, None, []
        names = ["lang", "part", "group", "other", "term", "value"]
        types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64()]

        def flushed() -> Iterator[pa.RecordBatch]:
            if bands is not None:
                rows = list(bands.rows())
                for k in range(0, len(rows), 50_000):
                    cols = list(zip(*rows[k : k + 50_000], strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array([now[0]] * len(cols[0]), types[0]), *(pa.array(c, t) for c, t in zip(cols, types[1:], strict=True))], names=names)

        for batch in batches:
            lang, unit, term, groups, counts = (batch.column(k) for k in range(5))
            keys = list(zip(lang.to_pylist(), unit.to_pylist(), strict=True))
            k = 0
            while k < len(keys):
                end = k + 1
                while end < len(keys) and keys[end] == keys[k]:
                    end += 1
                if keys[k] != now:
                    yield from flushed()
                    now = keys[k]
                    totals, whole = known[now[0]]
                    i, j = divmod(now[1], -(-len(totals) // BAND))
                    bands = _Bands(*(slice(x * BAND, min(len(totals), (x + 1) * BAND)) for x in (i, j)), totals, whole)
                own = [x for x in range(k, end) if term[x].is_valid]
                bands.add([term[x].as_py() for x in own], [groups[x].values.to_numpy() for x in own], [counts[x].values.to_numpy() for x in own])
                k = end
        yield from flushed()

    return run


def audit(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", top: int = TERMS) -> DataFrame:
    """lang, source, part, item, value, rank."""
    spark = df.sparkSession
    at = scratch(spark, "divergence-counts")
    all_docs = F.sum("docs").over(Window.partitionBy("lang", "term"))
    counted(df, lang_col, source_col, text_col).withColumn("d", all_docs).where(F.col("term").isNull() | (F.col("d") >= LEAST)).drop("d", "docs").write.parquet(at)
    kept = spark.read.parquet(at)
    # groups: their number within the language in order of the source, N and V
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = kept.where("term IS NOT NULL").select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("terms"))
    known = sums.join(sizes, "lang", "left").select("lang", "source", "total", F.coalesce("terms", F.lit(0)).alias("terms"))
    numbered = known.withColumn("group", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("int"))
    listed = scratch(spark, "divergence-groups")
    numbered.write.parquet(listed)
    numbered = spark.read.parquet(listed)
    if numbered.limit(GROUPS + 1).count() > GROUPS:
        raise ValueError(f"more than {GROUPS} groups: their pairs can't be told, nor written")
    table: dict[str, tuple[np.ndarray, int]] = {}
    for lang, own in numbered.select("lang", "group", "total", "terms").toPandas().groupby("lang"):
        own = own.sort_values("group")
        terms = int(own["terms"].iloc[0])
        # V = 0 leaves N = 0 too; no term is looked at then
        table[lang] = (np.maximum(own["total"].to_numpy(np.int64) + terms, 1), max(1, int(own["total"].sum()) + terms))
    bands = {lang: -(-len(totals) // BAND) for lang, (totals, _) in table.items()}
    # a term's row, with the numbers of its groups; the row without a term makes the matrix of a language without one
    numbers = F.broadcast(numbered.select("lang", "source", "group"))  # GROUPS rows at most
    placed = kept.join(numbers, ["lang", "source"])
    rows = placed.groupBy("lang", "term").agg(F.collect_list(F.struct("group", "n")).alias("x"))
    many = max(bands.values(), default=1)
    if many > 1:
        each = F.create_map(*[F.lit(x) for lang, k in bands.items() if k > 1 for x in (lang, k)])
        unit = F.explode(F.sequence(F.lit(0), F.coalesce(F.try_element_at(each, F.col("lang")), F.lit(1)) * F.coalesce(F.try_element_at(each, F.col("lang")), F.lit(1)) - 1))
    else:
        unit = F.lit(0)
    tiles = rows.select("lang", unit.alias("unit"), "term", F.col("x.group").alias("groups"), F.col("x.n").alias("counts")).sortWithinPartitions("lang", "unit")
    parts = tiles.mapInArrow(_tiles(spark.sparkContext.broadcast(table)), "lang string, part string, group int, other int, term string, value long")
    made = scratch(spark, "divergence-parts")
    parts.write.parquet(made)
    parts = spark.read.parquet(made)
    pairs = parts.where("part = 'pair'").groupBy("lang", "group", "other").agg(F.sum("value").alias("value"))
    names = numbered.select("lang", "group", "source")
    others = names.select("lang", F.col("group").alias("other"), F.col("source").alias("item"))
    pairs = pairs.join(F.broadcast(names), ["lang", "group"]).join(F.broadcast(others), ["lang", "other"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    best = lambda d, *by: d.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "group", *by).orderBy(F.desc("value"), "term"))).where(F.col("rank") <= top).drop("rank")
    heaps = best(parts.where("part = 'term'").select("lang", "group", "term", "value", F.pmod(F.xxhash64("term"), F.lit(64)).alias("deal")), "deal")
    terms = best(heaps).join(F.broadcast(names), ["lang", "group"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return pairs.unionByName(terms).withColumn("rank", place.cast("int"))


#: DuckDB SQL of `audit` with its defaults; HUGEINT keeps products exact.
def oracle(table: str = "documents") -> str:
    return f"""
        WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM {table}),
        w AS (SELECT row, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
        kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= {LEAST}),
        groups AS (SELECT DISTINCT lang, source FROM d), langs AS (SELECT DISTINCT lang FROM d),
        v AS (SELECT lang, count(kept.term)::HUGEINT AS v FROM langs LEFT JOIN kept USING (lang) GROUP BY lang),
        c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
        dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM groups g JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        s AS (SELECT lang, source, term, n, sum(n) OVER (PARTITION BY lang, source)::HUGEINT AS total, sum(n) OVER (PARTITION BY lang, term)::HUGEINT AS of_term, sum(n) OVER (PARTITION BY lang)::HUGEINT AS of_lang FROM dense),
        p AS (SELECT lang, source, term, n, 1 + ({SCALE}::HUGEINT * (n + 1)) // (total + v) AS p, 1 + ({SCALE}::HUGEINT * (of_term + 1)) // (of_lang + v) AS q FROM s JOIN v USING (lang)),
        pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
        every AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0)::BIGINT AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
                LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
            UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM every)
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TERMS}
    """
