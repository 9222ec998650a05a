"""Benchmark decontamination: an inverted index of test items, searched with block-max WAND.

Test items are indexed under BM25; impacts are divided by the item's score against itself, so
a passage scores 0 to 1: the share of the item's weight that it holds. Items are parted into
classes by their length, up to 32 words, 64, 128 and so on, each with an index and passages of
its own: every passage of every training text is a query, passages are twice the class's length
and begin every such length, so each span of an item's length lies in one, and what an item
matches doesn't depend on how long others are. A query first adds up, for each block of items,
the block maxima of its terms; blocks that can't reach the threshold are skipped. In the others
WAND retrieves all items at or above it: cursors are kept in item order, the pivot is the first
whose summed maxima reach the threshold, cursors before it move to it, and an item is scored
only when all stand there. An item found so is verified: the word trigrams of its question and
of its answer must both occur in the passage, at least `overlap` of each. Of a part of one or
two words it is that word or pair.

A pass over the texts searches the indexes of as many items as `PASS_POSTINGS` postings hold
(at least one, of any length), broadcast together; a larger benchmark needs more passes, not
more memory. Block maxima are kept for the blocks that a term occurs in only, so an index grows
with its postings. Weights are those of the whole benchmark: its number of items, their mean
length and the items that hold a word are counted over all of it first, and a pass only asks
for the counts of its own words. Items of one text, without separate answer, count their first
half as the question and the rest as the answer; up to three words are a question alone, whose
words must stand together.

Cases: a null or empty text has no passage; an item without words matches nothing; items with
equal texts are all found; a text in several of whose passages an item is found gives the
passage of highest score (the first of several). Repeated rows of a table give one row for each
pair of ids, and texts without id are told of together, under null.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, map_texts, scratch, spare, text_chunks
from .units import shingle_hashes

#: Distinct words of items, added up, that one pass searches for; a posting takes about 50 bytes of a worker.
PASS_POSTINGS = 1_000_000
K1, B = 1.2, 0.75
BLOCK = 4
SHORTEST_CLASS = 32
#: Sums of block maxima that are made at a time.
_SUMS = 1 << 22
_TOKEN = re.compile(r"\w+")
SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, start_word long"

Item = tuple[int, list[str], list[str]]


def words(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def grams(ids: np.ndarray, n: int = 3) -> np.ndarray:
    """Distinct n-grams of word numbers as hashes; those with an unknown word (-1) are left out. Fewer words are one gram."""
    n = min(n, len(ids))
    if not n:
        return np.zeros(0, np.uint64)
    known = np.lib.stride_tricks.sliding_window_view(ids >= 0, n).all(axis=1)
    return np.unique(shingle_hashes(ids.astype(np.uint64), n)[known])


class Statistics(NamedTuple):
    """Of a benchmark: items, words of all, and the items that hold a word."""

    n: int
    total: int
    df: dict[str, int]

    @classmethod
    def of(cls, items: list[Item]) -> Statistics:
        return cls(len(items), sum(len(q) + len(a) for _, q, a in items), Counter(t for _, q, a in items for t in {*q, *a}))


def length_class(n: int) -> int:
    """The least of 32, 64, 128, ... that isn't below n."""
    return max(SHORTEST_CLASS, 1 << (n - 1).bit_length())


class Index:
    """Postings of items of one length class, with block maxima. `vocabulary` numbers words; postings are kept by those numbers."""

    def __init__(self, items: list[Item], statistics: Statistics, vocabulary: dict[str, int], stride: int = SHORTEST_CLASS):
        # items that share rare words lie near each other, which keeps block maxima low
        items = sorted(items, key=lambda x: (min(({*x[1], *x[2]}), key=lambda t: (-statistics.df[t], t), default=""), x[0]))
        self.ids, self.stride, self.blocks = [i for i, _, _ in items], stride, -(-len(items) // BLOCK)
        mean = max(1.0, statistics.total / max(1, statistics.n))
        raw: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for k, (_, q, a) in enumerate(items):
            own = []
            for term, tf in Counter([*q, *a]).items():
                idf = np.log(1 + (statistics.n - statistics.df[term] + 0.5) / (statistics.df[term] + 0.5))
                own.append((vocabulary[term], idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * (len(q) + len(a)) / mean))))
            total = sum(w for _, w in own)
            for term, w in own:
                raw[term].append((k, w / total))
        #: number of a word of the vocabulary -> term of this index; the last entry stands for unknown words
        self.local = np.full(len(vocabulary) + 1, -1, np.int64)
        terms = sorted(raw)
        self.local[terms] = np.arange(len(terms))
        sizes = np.array([len(raw[t]) for t in terms], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)  # of a term's postings
        self.docs = np.array([k for t in terms for k, _ in raw[t]], np.int64)
        self.impacts = np.array([w for t in terms for _, w in raw[t]])
        # a block of a term: where its postings begin, and their greatest impact
        block, of = self.docs // BLOCK, np.repeat(np.arange(len(terms)), sizes)
        new = np.ones(len(block), bool)
        new[1:] = (block[1:] != block[:-1]) | (of[1:] != of[:-1])
        first = np.flatnonzero(new)
        self.block, self.block_begin = block[first], np.append(first, len(block))
        self.block_max = np.maximum.reduceat(self.impacts, first) if len(first) else np.zeros(0)
        self.block_of = np.searchsorted(first, self.begin)  # of a term's blocks
        self.term_max = np.maximum.reduceat(self.impacts, self.begin[:-1]) if len(terms) else np.zeros(0)
        number = lambda ws: np.array([vocabulary[w] for w in ws], np.int64)
        self.parts = [tuple((min(3, len(p)), grams(number(p))) for p in (q, a)) for _, q, a in items]

    def _blocks_of(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in `terms`, entry) of all blocks of the terms."""
        sizes = self.block_of[terms + 1] - self.block_of[terms]
        at = np.repeat(np.arange(len(terms)), sizes)
        return at, np.arange(len(at)) + np.repeat(self.block_of[terms] - np.cumsum(sizes) + sizes, sizes)

    def search(self, query: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """Block-max WAND: all (item position, score) with score >= threshold, for distinct terms."""
        bound = threshold - 1e-6
        at, entry = self._blocks_of(np.asarray(query, np.int64))
        block = self.block[entry]
        sums = np.bincount(block, self.block_max[entry], self.blocks)
        # blocks whose maxima add up to less than the threshold are never entered
        inside = sums[block] >= bound
        order = np.flatnonzero(inside)[np.argsort(block[inside], kind="stable")]
        out: list[tuple[int, float]] = []
        docs, impacts = self.docs, self.impacts
        for part in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
            # cursors: document, place, end, the block's maximum
            live = [(int(docs[b]), int(b), int(e), m) for b, e, m in zip(self.block_begin[entry[part]], self.block_begin[entry[part] + 1], self.block_max[entry[part]].tolist(), strict=True)]
            while live:
                live.sort()
                upper, pivot = 0.0, -1
                for k, (_, _, _, most) in enumerate(live):
                    upper += most
                    if upper >= bound:
                        pivot = k
                        break
                if pivot < 0:
                    break
                doc = live[pivot][0]
                while pivot + 1 < len(live) and live[pivot + 1][0] == doc:
                    pivot += 1
                if live[0][0] == doc:
                    score = float(sum(impacts[p] for _, p, _, _ in live[: pivot + 1]))
                    if score >= bound:
                        out.append((doc, score))
                    goal = doc + 1
                else:
                    goal = doc
                moved = []
                for d, p, end, most in live:
                    while d < goal:
                        p += 1
                        if p == end:
                            break
                        d = int(docs[p])
                    if p < end:
                        moved.append((d, p, end, most))
                live = moved
        return out

    def candidates(self, terms: np.ndarray, passage: np.ndarray, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
        """Passages (with their distinct terms) whose maxima reach the threshold in some block. terms, passage: of each indexed word."""
        if not len(terms):
            return
        key = np.sort(passage * len(self.term_max) + terms)
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
        where, term = key // len(self.term_max), key % len(self.term_max)
        cut = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
        ends = np.append(cut[1:], len(where))
        # a first bound over all items, then one for each block
        sure = np.flatnonzero(np.add.reduceat(self.term_max[term], cut) >= threshold - 1e-4)
        step = max(1, _SUMS // max(1, self.blocks))
        for i in range(0, len(sure), step):
            some = sure[i : i + step]
            sizes = ends[some] - cut[some]
            which = np.repeat(np.arange(len(some)), sizes)
            own = term[np.arange(len(which)) + np.repeat(cut[some] - np.cumsum(sizes) + sizes, sizes)]
            at, entry = self._blocks_of(own)
            sums = np.bincount(which[at] * self.blocks + self.block[entry], self.block_max[entry], len(some) * self.blocks)
            for k in np.flatnonzero(sums.reshape(len(some), self.blocks).max(axis=1) >= threshold - 1e-4).tolist():
                yield int(where[cut[some[k]]]), term[cut[some[k]] : ends[some[k]]]

    def overlaps(self, k: int, passage: np.ndarray, found: dict[int, np.ndarray]) -> tuple[float, float]:
        """Shares of the grams of question and answer in a passage of word numbers, whose own grams are kept in `found` by their length."""
        out = []
        for n, part in self.parts[k]:
            if n and n not in found:
                found[n] = grams(passage, n) if len(passage) >= n else np.zeros(0, np.uint64)
            out.append(len(np.intersect1d(part, found[n], assume_unique=True)) / len(part) if n else 1.0)
        return tuple(out)


class Pass:
    """The indexes that one pass over the texts searches."""

    def __init__(self, items: list[Item], statistics: Statistics):
        self.vocabulary: dict[str, int] = {}
        by: dict[int, list[Item]] = defaultdict(list)
        for item in items:
            by[length_class(len(item[1]) + len(item[2]))].append(item)
            for w in (*item[1], *item[2]):
                self.vocabulary.setdefault(w, len(self.vocabulary))
        self.indexes = [Index(part, statistics, self.vocabulary, stride) for stride, part in sorted(by.items())]

    def found(self, texts: list[str], threshold: float, overlap: float) -> Iterator[tuple[int, int, float, float, float, int]]:
        """(text, item id, score, overlaps, first word of the passage)."""
        get = self.vocabulary.get
        tokens = [words(t) for t in texts]
        sizes = np.array([len(t) for t in tokens], np.int64)
        known = np.concatenate([np.zeros(0, np.int64), *(np.fromiter((get(w, -1) for w in t), np.int64, len(t)) for t in tokens)])
        start = np.cumsum(sizes) - sizes
        text_of = np.repeat(np.arange(len(texts)), sizes)
        place = np.arange(len(known)) - start[text_of]
        for index in self.indexes:
            stride = index.stride
            # segments of `stride` words; passage s is segments s and s + 1 of a text, so a text of n segments has n (the last is short)
            segments = -(-sizes // stride)
            first = np.cumsum(segments) - segments
            term = index.local[known]
            hit = np.flatnonzero(term >= 0)
            seg, second = first[text_of[hit]] + place[hit] // stride, place[hit] >= stride
            for p, terms in index.candidates(np.concatenate([term[hit], term[hit][second]]), np.concatenate([seg, seg[second] - 1]), threshold):
                t = int(np.searchsorted(first, p, "right")) - 1
                while segments[t] == 0:
                    t -= 1
                at = (p - int(first[t])) * stride
                passage, grams_of = known[start[t] : start[t] + sizes[t]][at : at + 2 * stride], {}
                for k, score in index.search(terms, threshold):
                    q, a = index.overlaps(k, passage, grams_of)
                    if q >= overlap and a >= overlap:
                        yield t, index.ids[k], min(1.0, score), q, a, at


def _halves(tokens: list[str]) -> tuple[list[str], list[str]]:
    if len(tokens) <= 3:
        return tokens, []
    return tokens[: (len(tokens) + 1) // 2], tokens[(len(tokens) + 1) // 2 :]


def _split(with_answer: bool):
    """Rows (i, q, a) of texts as rows of words, without items that have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.string())
        for batch in batches:
            ids, qs, as_, ns = [], [], [], []
            for i, q, a in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                q, a = (words(q or ""), words(a or "")) if with_answer else _halves(words(q or ""))
                if q or a:
                    ids.append(i), qs.append(q), as_.append(a), ns.append(len({*q, *a}))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(qs, kind), pa.array(as_, kind), pa.array(ns, pa.int64())], names=["i", "q", "a", "n"])

    return run


def passes(items: DataFrame, id_col: str, question_col: str, answer_col: str | None, postings: int = PASS_POSTINGS) -> Iterator[Pass]:
    """The items of a pass at a time; no more than that, and the counts of their words, is on the driver."""
    spark = items.sparkSession
    name = lambda c: F.col(f"`{c}`").cast("string")
    cols = [F.col(f"`{id_col}`").cast("long").alias("i"), name(question_col).alias("q"), (name(answer_col) if answer_col else F.lit(None).cast("string")).alias("a")]
    path = scratch(spark, "benchmark")
    try:
        items.select(*cols).where("i IS NOT NULL").distinct().mapInArrow(_split(answer_col is not None), "i long, q array<string>, a array<string>, n long").write.parquet(f"{path}/items")
        held = spark.read.parquet(f"{path}/items")
        n, total = held.agg(F.count("*"), F.sum(F.size("q") + F.size("a"))).first()
        if not n:
            return
        held.select(F.explode(F.array_distinct(F.concat("q", "a"))).alias("t")).groupBy("t").agg(F.count("*").alias("df")).write.parquet(f"{path}/df")
        counts = spark.read.parquet(f"{path}/df")

        def made(part: list[Item]) -> Pass:
            own = pa.table({"t": pa.array(sorted({t for _, q, a in part for t in (*q, *a)}), pa.string())})
            df = {r.t: r.df for r in counts.join(F.broadcast(spark.createDataFrame(own)), "t").collect()}
            return Pass(part, Statistics(n, total, df))

        part, size = [], 0
        for r in held.orderBy("i", "q", "a").toLocalIterator():
            if part and size + r.n > postings:
                yield made(part)
                part, size = [], 0
            part.append((r.i, r.q, r.a))
            size += r.n
        yield made(part)
    finally:
        drop_scratch(spark, path)


def _search(shared, threshold: float, overlap: float):
    names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "start_word"]
    types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search: Pass = shared.value
        for batch in batches:
            ids = batch.column(0)
            out = [(ids[start + t].as_py(), *more) for start, texts in text_chunks(batch, 1, 4 << 20) for t, *more in search.found(texts, threshold, overlap)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return run


def contaminated(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", question_col: str = "text", answer_col: str | None = None, threshold: float = 0.6, overlap: float = 0.5, postings: int = PASS_POSTINGS) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, start_word): items whose question and answer occur in a text."""
    spark = df.sparkSession
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = spark.createDataFrame([], SCHEMA)
    for search in passes(items, item_id, question_col, answer_col, postings):
        found = found.unionByName(docs.mapInArrow(_search(spark.sparkContext.broadcast(search), threshold, overlap), SCHEMA))
    best = F.max_by(F.struct("score", "question_overlap", "answer_overlap", "start_word"), F.struct("score", -F.col("start_word")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select(F.col("doc_id").alias(id_col), "item_id", "b.*")


def clean(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", question_col: str = "text", answer_col: str | None = None, threshold: float = 0.6, overlap: float = 0.5, postings: int = PASS_POSTINGS) -> DataFrame:
    """df without the rows that hold a test item, whatever their ids."""
    spark, keep = df.sparkSession, list(df.columns)
    flag = spare(df, "holds")

    def without(rows: DataFrame, shared) -> DataFrame:
        def flags(texts: list[str]) -> list[tuple[bool]]:
            held = {t for t, *_ in shared.value.found(texts, threshold, overlap)}
            return [(k in held,) for k in range(len(texts))]

        return map_texts(rows, keep, text_col, f"`{flag}` boolean", flags).where(~F.col(f"`{flag}`")).select(*[F.col(f"`{c}`") for c in keep])

    for search in passes(items, item_id, question_col, answer_col, postings):
        df = without(df, spark.sparkContext.broadcast(search))
    return df
