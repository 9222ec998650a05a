"""Pairs of similar texts by their ratio of matching blocks, without comparing all pairs.

The ratio is 2 M / (|a| + |b|), where the M matched characters are a subsequence of both texts. So
of two texts that reach the least ratio, both keep most of their grams: a character without a
partner spoils as many grams as a gram has characters, a run that only the other text has one
less. Texts of such a pair share one of their rarest grams, as many as can be spoilt and one more;
they meet by an equi-join on these. Texts too short for grams meet by single characters in the
same way. What met is tested by sketches of the pairs of neighbouring characters (bits that one text lacks tell
pairs that it lacks) and by the characters that both have (M is at most their number), and only the rest is compared.

Null texts are similar to nothing, an empty text only to its equals (of its class). Equal texts are one class,
whose least key stands for it, so a title that occurs a million times is compared once.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import similarity

#: Grams are counted in this many slots to tell rare ones from frequent ones: what is broadcast.
SLOTS = 1 << 16
#: Longest grams that are tried.
LONGEST = 3
#: Known texts that new ones are all held against, at most; more meet by grams.
FEW = 10_000
#: Longs of a text's sketch.
WORDS = 32
_EPS = 1e-9


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def classes(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, id): for each row with a text, the least key of the rows with that text."""
    one = texts.where(F.col(text).isNotNull())
    return one.join(one.groupBy(text).agg(F.min(key).alias("id")), text).select(key, "id")


def _spoilt(least: float, q: int) -> float:
    """Of a text's length, the share that bounds how many of its q-grams a partner can lack.

    It's linear in the partner's length, so one of the two most unlike lengths decides.
    """

    def share(r: float) -> float:
        matched = least * (1 + r) / 2
        return q * (1 - matched) + (q - 1) * (r - matched)

    return max(share(least / (2 - least)), share((2 - least) / least))


def gram_size(least: float) -> tuple[int, int]:
    """(characters of a gram, length from which texts are found by grams) for a least ratio."""
    for q in range(LONGEST, 1, -1):
        if _spoilt(least, q) < 0.75:
            return q, math.ceil(q / (1 - _spoilt(least, q)))
    return 1, 1


def _tokens(texts: DataFrame, least: float) -> DataFrame:
    """(id, n, q, token): the grams of texts (id, text), repeated ones numbered, by families of gram sizes."""
    q, long = gram_size(least)
    chars = texts.repartition("id").select("id", F.regexp_extract_all("text", F.lit("(?s)."), F.lit(0)).alias("chars")).withColumn("n", F.size("chars"))

    def family(rows: DataFrame, size: int) -> DataFrame:
        grams = F.transform(F.sequence(F.lit(1), F.col("n") - size + 1), lambda i: F.array_join(F.slice("chars", i, size), ""))
        counted = rows.select("id", "n", F.explode(grams).alias("gram")).groupBy("id", "n", "gram").agg(F.count("*").alias("times"))
        numbered = counted.select("id", "n", "gram", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("nth"))
        return numbered.select("id", "n", F.lit(size).alias("q"), F.xxhash64(F.lit(size), "gram", "nth").alias("token"))

    if q == 1:
        return family(chars.where("n > 0"), 1)
    # a pair goes by the shorter text: a long one whose partners may be short is in both families
    return family(chars.where(F.col("n") >= long), q).unionByName(family(chars.where((F.col("n") > 0) & (F.col("n") * (least / (2 - least)) < long)), 1))


def _slot(token: Column) -> Column:
    return F.pmod(token, F.lit(SLOTS))


def _rarest(tokens: DataFrame, slots: DataFrame, least: float) -> DataFrame:
    """Each text's rarest tokens, as many as its partners can lack and one more."""
    found = tokens.join(F.broadcast(slots), _slot(F.col("token")) == F.col("slot"))
    sizes = sorted({1, gram_size(least)[0]})
    spoilt = reduce(lambda c, size: c.when(F.col("q") == size, F.floor(F.col("n") * _spoilt(least, size) + _EPS).cast("int")), sizes, F)
    order = found.groupBy("id", "n", "q").agg(F.array_sort(F.collect_list(F.struct("seen", "token"))).alias("order"))
    return order.select("id", "n", "q", F.explode(F.slice("order", F.lit(1), spoilt + 1)).alias("x")).select("id", "n", "q", F.col("x.token").alias("token"))


def _shared(a: Column, b: Column) -> Column:
    """Characters that both texts have, repeated ones as often as in both."""
    times = lambda t, c: F.length(t) - F.length(F.replace(t, c, F.lit("")))
    return F.aggregate(F.array_distinct(F.regexp_extract_all(a, F.lit("(?s)."), F.lit(0))), F.lit(0), lambda n, c: n + F.least(times(a, c), times(b, c)))


def _sketches(text: pd.Series) -> pd.Series:
    """The pairs of neighbouring characters of a text, repeated ones numbered, as bits of WORDS longs."""

    def bits(t: str) -> np.ndarray:
        u = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        g, at = np.sort(u[:-1] << np.uint64(32) | u[1:]), np.arange(max(0, len(u) - 1))
        nth = at - np.maximum.accumulate(np.where(np.diff(g, prepend=g[:1] + np.uint64(1)) != 0, at, 0))
        h = mixed(g ^ mixed(nth.astype(np.uint64)))
        out = np.zeros(WORDS, np.uint64)
        np.bitwise_or.at(out, (h % np.uint64(WORDS)).astype(np.int64), np.uint64(1) << (h >> np.uint64(32)) % np.uint64(64))
        return out.view(np.int64)

    return text.map(bits)


def _sketch(text: str) -> Column:
    return F.pandas_udf(_sketches, "array<long>")(F.col(text))


def _lacking(a: Column, b: Column) -> Column:
    """Bits of a sketch that another hasn't: at most the pairs of characters that are in one text only."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))), F.lit(0), lambda n, k: n + k)


def candidates(a: DataFrame, b: DataFrame | None, least: float) -> DataFrame:
    """(a, b): pairs of ids of texts (id, text) that may reach the least ratio; without b, pairs inside a."""
    if not 0 < least <= 1:
        raise ValueError("the least ratio must be above 0 and at most 1")
    _, long = gram_size(least)
    mine = _tokens(a, least)
    others = mine if b is None else _tokens(b, least)
    every = mine if b is None else mine.select("token").unionByName(others.select("token"))
    slots = every.groupBy(_slot(F.col("token")).alias("slot")).agg(F.count("*").alias("seen"))
    x = _rarest(mine, slots, least).select(F.col("id").alias("a"), F.col("n").alias("a_n"), "q", "token")
    y = _rarest(others, slots, least).select(F.col("id").alias("b"), F.col("n").alias("b_n"), "q", "token")
    short = F.least("a_n", "b_n")
    fits = (least * (F.col("a_n") + F.col("b_n")) <= 2 * short + _EPS) & ((F.col("q") > 1) == (short >= long) if long > 1 else F.lit(True))
    met = x.join(y, ["q", "token"]).where(fits if b is not None else fits & (F.col("a") < F.col("b")))
    return met.select("a", "b").distinct()


def _sides(a: DataFrame, b: DataFrame) -> list[DataFrame]:
    return [d.select(F.col("id").alias(s), F.col("text").alias(f"{s}_text"), _sketch("text").alias(f"{s}_bits")) for d, s in ((a, "a"), (b, "b"))]


def _like(least: float) -> Column:
    """Do the sketches allow two texts to reach the ratio? Of M matched characters each other one spoils two pairs of its own text and one of the other text."""
    n, m = F.length("a_text"), F.length("b_text")
    lacks = [_lacking(F.col(x), F.col(y)) <= k - 1.5 * least * (n + m) + _EPS for x, y, k in (("a_bits", "b_bits", 2 * n + m), ("b_bits", "a_bits", 2 * m + n))]
    return lacks[0] & lacks[1]


def _near(fits: Column, least: float) -> Column:
    """Cheap tests before dear ones; Spark keeps the order of WHEN, but not that of conditions."""
    shared = 2 * _shared(F.col("a_text"), F.col("b_text")) >= least * (F.length("a_text") + F.length("b_text")) - _EPS
    return F.when(fits, F.when(_like(least), shared))


def _close(close: DataFrame, least: float) -> DataFrame:
    return close.select("a", "b", similarity(F.col("a_text"), F.col("b_text")).alias("ratio")).where(F.col("ratio") >= least)


def _compared(pairs: DataFrame, a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    x, y = _sides(a, b)
    return _close(pairs.join(x, "a").join(y, "b").where(_near(F.lit(True), least)), least)


def similar(texts: DataFrame, key: str, text: str, least: float = 0.9) -> DataFrame:
    """(a, b, ratio): all pairs of unlike texts that reach the least ratio, each text by its class's least key, a < b.

    `classes` tells which rows have a class's text. The ratio is that of a's text against b's.
    """
    distinct = texts.where(F.col(text).isNotNull()).groupBy(F.col(text).alias("text")).agg(F.min(key).alias("id"))
    return _compared(candidates(distinct, None, least), distinct, distinct, least)


def similar_to(new: DataFrame, known: DataFrame, least: float = 0.9) -> DataFrame:
    """(a, b, ratio): each pair of a new and a known text (id, text) that reaches the least ratio, equal ones too; empty texts pair with nothing."""
    new, known = (d.where("text IS NOT NULL") for d in (new, known))
    # texts too short or too long for every known one aren't cut into grams
    ends = known.agg(F.min(F.length("text")).alias("least"), F.max(F.length("text")).alias("most"))
    near = F.length("text").between(F.col("least") * (least / (2 - least)) - _EPS, F.col("most") * ((2 - least) / least) + _EPS)
    new = new.crossJoin(F.broadcast(ends)).where(near).select("id", "text")
    if known.limit(FEW + 1).count() > FEW:
        return _compared(candidates(new, known, least), new, known, least)
    # few known texts meet all of fitting length: at high ratios long texts share rare grams with nearly all of these
    x, y = _sides(new.where("id IS NOT NULL").repartition("id"), known.where("id IS NOT NULL"))
    n, m = F.length("a_text"), F.length("b_text")
    fits = (F.least(n, m) > 0) & (least * (n + m) <= 2 * F.least(n, m) + _EPS)
    return _close(x.join(F.broadcast(y), _near(fits, least)), least)
