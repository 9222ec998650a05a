"""An index of the positions of trigrams: every typed word is found as a substring, without reading the texts.

Each task lays its texts end to end in chunks and writes a row for each gram of a chunk: where it begins
there, sorted, as differences of one byte to four. The last grams of a text are shorter, and a place
between texts keeps words from reaching over. A chunk's keys and where their texts begin are one row more,
in folder -1. Nothing is shuffled, neither texts nor grams. Files are sorted by gram, in folders by the
first character: a question opens the folders of its grams, and the statistics of the sorted files
leave the row groups that hold them. A word of three characters or more is there where grams that cover
it stand at their distances; a shorter one where a gram begins with it.

Null texts are in no answer. A question without words has every row with a text for an answer.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .facets import typed_words

SIZE = 3
#: Folders; a first character belongs to one of them.
FOLDERS = 64
#: A chunk's characters and texts; a longer text is a chunk of its own.
CHUNK_CHARS, CHUNK_TEXTS = 1 << 21, 1 << 16
#: The folder of the chunks' keys.
_KEYS = -1


def _folder(text: Column) -> Column:
    return F.pmod(F.xxhash64(F.substring(text, 1, 1)), F.lit(FOLDERS)).cast("int")


def _small(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 on in bytes of seven bits, the last below 128: (bytes, where each number ends)."""
    size = np.ones(len(x), np.int64)
    for k in range(7, 63, 7):
        size += x >= 1 << k
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(x) else 0, np.uint8)
    for k in range(int(size.max(initial=0))):
        more = np.flatnonzero(size > k)
        out[(ends - size)[more] + k] = (x[more] >> 7 * k & 127) | np.where(size[more] > k + 1, 128, 0)
    return out, ends


def places(raw: bytes) -> np.ndarray:
    """Where a gram begins in its chunk."""
    b = np.frombuffer(raw, np.uint8).astype(np.int64)
    last = np.flatnonzero(b < 128)
    first = np.append(0, last[:-1] + 1)
    shift = np.arange(len(b)) - np.repeat(first, last - first + 1)
    return np.cumsum(np.add.reduceat((b & 127) << 7 * shift, first))


def _grams(texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """(begins of the texts, grams, bytes of their places, where each gram's bytes end) of a chunk."""
    chars = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    begins = np.cumsum([0, *(len(c) + 1 for c in chars)])
    # a character is its number and one, so that 0 stands between texts
    line = np.zeros(begins[-1] + SIZE, np.int64)
    for a, c in zip(begins, chars, strict=False):
        line[a : a + len(c)] = c.astype(np.int64) + 1
    x, y, z = line[: begins[-1]], line[1 : begins[-1] + 1], line[2 : begins[-1] + 2]
    y = y.copy()
    code = x << 42 | y << 21 | np.where(y == 0, 0, z)
    at = np.flatnonzero(x)
    order = np.argsort(code[at], kind="stable")
    at, code = at[order], code[at][order]
    new = np.ones(len(at), bool)
    new[1:] = code[1:] != code[:-1]
    firsts = np.flatnonzero(new)
    apart = np.diff(at, prepend=0)
    apart[firsts] = at[firsts]
    data, ends = _small(apart)
    low = (1 << 21) - 1
    names = ["".join(chr(c - 1) for c in (g >> 42, g >> 21 & low, g & low) if c) for g in code[firsts].tolist()]
    return begins[:-1], names, data, ends[np.append(firsts[1:], len(at)) - 1] if len(at) else ends


def build(records: DataFrame, key: str, text: str, path: str) -> None:
    """Write the index of texts that are folded already (facets.index) to a folder."""
    rows = records.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def chunks(batches: Iterator) -> Iterator:
        import pyarrow as pa

        keys, texts, n, arrow = [], [], 0, None

        def closed() -> Iterator:
            name = uuid.uuid4().hex
            begins, grams, data, ends = _grams(texts)
            own = [pa.array([name]), pa.array([None], pa.string()), pa.array([None], pa.binary()), pa.array([keys], pa.list_(arrow)), pa.array([begins.tolist()], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(own, names=["chunk", "gram", "at", "keys", "begins"])
            for k in range(0, len(grams), 10_000):
                some, cut = grams[k : k + 10_000], np.append(ends[k - 1] if k else 0, ends[k : k + 10_000])
                at = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer((cut - cut[0]).astype("<i4").tobytes()), pa.py_buffer(data[cut[0] : cut[-1]].tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), pa.array(some), at, pa.nulls(len(some), pa.list_(arrow)), pa.nulls(len(some), pa.list_(pa.int64()))], names=["chunk", "gram", "at", "keys", "begins"])

        for b in batches:
            arrow = b.schema.field(0).type
            for k, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                t = t.as_py()
                if texts and (n + len(t) > CHUNK_CHARS or len(texts) >= CHUNK_TEXTS):
                    yield from closed()
                    keys, texts, n = [], [], 0
                keys.append(k)
                texts.append(t)
                n += len(t) + 1
        if texts:
            yield from closed()

    made = rows.mapInArrow(chunks, f"chunk string, gram string, at binary, keys array<{kind}>, begins array<bigint>")
    filed = made.withColumn("folder", F.when(F.col("gram").isNull(), _KEYS).otherwise(_folder(F.col("gram"))))
    filed.sortWithinPartitions("folder", "gram").write.mode("overwrite").partitionBy("folder").parquet(path)


def cover(word: str) -> list[tuple[int, str]]:
    """(offset, gram) of the grams that cover a word; of a short word itself."""
    last = max(len(word) - SIZE, 0)
    return [(i, word[i : i + SIZE]) for i in sorted({*range(0, last + 1, SIZE), last})]


def _texts_with(words: list[str], begins: np.ndarray, held: dict[str, np.ndarray]) -> np.ndarray:
    """Which texts of a chunk hold every word, by the places of its grams."""
    none, out = np.empty(0, np.int64), None
    for word in words:
        if len(word) < SIZE:
            at = np.concatenate([none, *(x for g, x in held.items() if g.startswith(word))])
        else:
            at = reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), (held.get(g, none) - i for i, g in cover(word)))
        there = np.unique(np.searchsorted(begins, at, "right") - 1)
        out = there if out is None else np.intersect1d(out, there, assume_unique=True)
    return out


def search(spark: SparkSession, path: str, query: str, key: str = "key") -> DataFrame:
    """Keys of the texts that hold every typed word. One shuffle, of the postings of the words' grams, by chunk."""
    postings = spark.read.parquet(path)
    words = list(dict.fromkeys(typed_words(query)))
    chunks = postings.where(F.col("folder") == _KEYS).select("chunk", "keys", "begins")
    if not words:
        return chunks.select(F.explode("keys").alias(key)).distinct()
    gram = F.col("gram")
    full = sorted({g for w in words if len(w) >= SIZE for _, g in cover(w)})
    short = [w for w in words if len(w) < SIZE]
    # folders as numbers, so that they are pruned before any file is opened
    firsts = spark.range(1).select([_folder(F.lit(g)) for g in [*full, *short]]).first()
    asked = reduce(lambda a, b: a | b, [*([gram.isin(full)] if full else []), *(F.startswith(gram, F.lit(w)) for w in short)])
    found = postings.where(F.col("folder").isin(sorted(set(firsts))) & asked)
    # a chunk has one row of each gram, so a group is no larger than a chunk
    held = found.groupBy("chunk").agg(F.collect_list("gram").alias("grams"), F.collect_list("at").alias("ats"))

    @F.pandas_udf("array<int>")
    def hits(begins: pd.Series, grams: pd.Series, ats: pd.Series) -> pd.Series:
        return pd.Series([_texts_with(words, b, {g: places(x) for g, x in zip(gs, xs, strict=True)}).tolist() for b, gs, xs in zip(begins, grams, ats, strict=True)])

    met = chunks.join(held, "chunk").select("keys", hits("begins", "grams", "ats").alias("hits"))
    return met.select(F.explode(F.transform("hits", lambda i: F.get("keys", i))).alias(key)).distinct()
