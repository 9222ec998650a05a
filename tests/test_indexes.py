"""Indexes against brute force: similar texts, trigrams, facet bitmaps; and what their plans read."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators import bitmaps, facets, postings, titles


def ratio(a, b):
    return difflib.SequenceMatcher(None, a, b).ratio()


def texts_like(rnd, n):
    """Texts of all lengths over few letters, with changed copies of each other."""
    out = ["", "a", "ab", "😀b", "😀😀", "x" * 240 + "abc" * 20, "x" * 230 + "abd" * 22]
    while len(out) < n:
        t = list(rnd.choice(out) if rnd.random() < 0.7 else "".join(rnd.choice("abcde ") for _ in range(rnd.choice([1, 3, 6, 12, 30]))))
        for _ in range(rnd.choice([0, 1, 1, 2, 5])):
            i = rnd.randrange(len(t) + 1)
            t[i : i + rnd.choice([0, 0, 1])] = rnd.choice(["", "a", "e", "😀"])
        out.append("".join(t))
    return out


@pytest.mark.parametrize("least", [0.5, 0.8, 0.9, 1.0])
def test_similar_against_all_pairs(spark, least):
    texts = texts_like(random.Random(int(least * 10)), 120)
    rows = [(i, t) for i, t in enumerate(texts)] + [(500, None), (501, None)]
    df = spark.createDataFrame(rows, "k int, title string").withColumn("id", F.lit("other"))
    first = {}
    for i, t in enumerate(texts):
        first.setdefault(t, i)
    ids = sorted((i, t) for t, i in first.items())
    expected = {(a, b): ratio(s, t) for a, s in ids for b, t in ids if a < b and ratio(s, t) >= least}
    assert {(r.a, r.b): r.ratio for r in titles.similar(df, "k", "title", least).collect()} == expected
    assert {(r.k, r.id) for r in titles.classes(df.drop("id"), "k", "title").collect()} == {(i, first[t]) for i, t in enumerate(texts)}


@pytest.mark.parametrize("few", [0, 10_000])
def test_similar_to_by_grams_and_by_lengths(spark, monkeypatch, few):
    monkeypatch.setattr(titles, "FEW", few)
    test_similar_to_against_all_pairs(spark)


def test_similar_to_against_all_pairs(spark):
    texts = texts_like(random.Random(3), 90)
    a, b = list(enumerate(texts[::2])), list(enumerate(texts[1::2]))
    frame = lambda rows: spark.createDataFrame([*rows, (999, None)], "id int, text string")
    expected = {(i, j, ratio(s, t)) for i, s in a for j, t in b if s and ratio(s, t) >= 0.8}
    assert {tuple(r) for r in titles.similar_to(frame(a), frame(b), 0.8).collect()} == expected
    assert titles.similar_to(frame([]), frame(b), 0.8).count() == 0


def test_few_pairs_are_compared(spark):
    """Names of one length that share an ending: candidates stay far below all pairs."""
    rnd = random.Random(5)
    names = [(i, "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(30)) + " of the society") for i in range(400)]
    df = spark.createDataFrame(names, "id int, text string")
    assert titles.candidates(df, None, 0.9).count() < 400 * 399 // 2 // 20
    with pytest.raises(ValueError):
        titles.similar(df, "id", "text", 0.0)


TEXTS = [None, "", "a", "Elle aime", "élle", "banana", "ananas", "ab ab ab", "😀 smile", "nan", "an an", "x" * 3000 + "needle", "ba nana"]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "k int, t string")
    folded = df.select("k", F.lower(F.translate("t", "é", "e")).alias("t"))
    path = str(tmp_path_factory.mktemp("postings"))
    postings.build(folded, "k", "t", path)
    return path


@pytest.mark.parametrize("query", ["", "a", "an", "nan", "anan", "nana", "banana", "ananas b", "élle", "elle a", "😀", "😀 s", "needle", "xxxxxxx", "xneedle", "zzz", "ab ab", "nanas ana"])
def test_search_against_contains(spark, index, query):
    words = facets.typed_words(query)
    expected = [i for i, t in enumerate(TEXTS) if t is not None and all(w in t.lower().replace("é", "e") for w in words)]
    assert sorted(r.k for r in postings.search(spark, index, query, "k").collect()) == expected


def test_search_reads_its_folders(spark, index):
    df = postings.search(spark, index, "needle", "k")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [folder" in plan.replace("isnotnull(folder#", "folder#") and "PushedFilters: [In(gram" in plan
    opened = spark.read.parquet(index).where(F.col("folder") == spark.range(1).select(postings._folder(F.lit("nee"))).first()[0]).select(F.input_file_name()).distinct().count()
    assert opened < spark.read.parquet(index).select(F.input_file_name()).distinct().count()


def test_search_in_no_texts(spark, tmp_path):
    postings.build(spark.createDataFrame([], "k int, t string"), "k", "t", str(tmp_path / "p"))
    assert spark.read.schema("key int, gram string, at array<int>, folder int").parquet(str(tmp_path / "p")).count() == 0


@pytest.fixture(scope="module")
def records(spark):
    rnd = random.Random(2)
    rows = [(f"r{i}", rnd.sample(["a", "b", "c", "d"], rnd.randrange(4)), rnd.choice([None, "x", "y"]), rnd.choice(["1", "2", "3"])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, many array<string>, one string, n string").repartition(5)
    return facets.index(df, "k", {"many": F.col("many"), "one": F.array("one"), "n": F.array("n")}, [F.col("k")]).persist()


CHOICES = [{}, {"many": ["a"]}, {"many": ["a", "b"], "one": ["x"]}, {"many": ["zz"]}, {"many": ["zz"], "n": ["1"]}, {"many": ["a"], "one": ["x", "y"], "n": ["1", "2"]}, {"one": []}]


@pytest.mark.parametrize("chosen", CHOICES)
@pytest.mark.parametrize("query", ["", "r1", "nothing"])
def test_bitmaps_against_records(spark, records, chosen, query):
    index = bitmaps.build(records, "k")
    hits = facets.search(records, query).select("k") if query else None
    count = lambda df: sorted(map(tuple, df.collect()))
    assert count(bitmaps.counts(index, chosen, hits)) == count(facets.counts(records, query, chosen))


def test_index_shuffles_nothing_and_is_small(spark, tmp_path):
    """Positions are packed where the texts lie: a few bytes a character, without an exchange."""
    rnd = random.Random(4)
    words = ["".join(rnd.choice("etaoinshr") for _ in range(rnd.randrange(2, 9))) for _ in range(2000)]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(400))) for i in range(300)]
    path = str(tmp_path / "p")
    tracker = spark.sparkContext.statusTracker()
    df = spark.createDataFrame(rows, "k int, t string").repartition(2).persist()
    df.count()
    spark.sparkContext.setJobGroup("postings", "build")
    postings.build(df, "k", "t", path)
    jobs = tracker.getJobIdsForGroup("postings")
    spark.sparkContext.setJobGroup("", "")
    assert sum(tracker.getStageInfo(s).numCompletedTasks > 0 for j in jobs for s in tracker.getJobInfo(j).stageIds) == 1
    size = sum(p.stat().st_size for p in (tmp_path / "p").rglob("*.parquet"))
    assert size < 4 * sum(len(t) for _, t in rows)
    assert {r.k for r in postings.search(spark, path, f"{words[0]} {words[1]}", "k").collect()} == {i for i, t in rows if words[0] in t and words[1] in t}


def test_words_do_not_reach_over_texts(spark, tmp_path, monkeypatch):
    texts = ["xabc", "defx", "abc", "", "def", "abcdef", "\0ab", "ab", "a\0", "😀ab"]
    for size in (1 << 21, 3):
        monkeypatch.setattr(postings, "CHUNK_CHARS", size)
        path = str(tmp_path / f"p{size}")
        postings.build(spark.createDataFrame(list(enumerate(texts)), "k int, t string").coalesce(1), "k", "t", path)
        for query in ("abcdef", "cde", "abc", "xab def", "ab", "😀ab"):
            expected = [i for i, t in enumerate(texts) if all(w in t for w in query.split())]
            assert sorted(r.k for r in postings.search(spark, path, query, "k").collect()) == expected


def test_small_numbers():
    import numpy as np

    x = np.array([0, 1, 127, 128, 16383, 16384, 2097151, 2097152, 1 << 40])
    data, ends = postings._small(x)
    assert postings.places(data.tobytes()).tolist() == np.cumsum(x).tolist() and ends.tolist() == [1, 2, 3, 5, 7, 10, 13, 17, 23]


def test_sketches_leave_few_pairs_to_compare(spark):
    """Texts over the same letters in unlike order: sketches part them, where the characters that both have don't."""
    rnd = random.Random(8)
    letters = list("the quick brown fox jumps over the lazy dog " * 4)
    texts = []
    for i in range(30):
        rnd.shuffle(letters)
        texts.append((i, "".join(letters)))
    texts.append((30, texts[0][1][:-3] + "xyz"))
    a = spark.createDataFrame(texts, "id int, text string").select("id", "text", titles._sketch("text").alias("bits"))
    b = a.select(*[F.col(c).alias(f"{c}2") for c in a.columns])
    both = a.join(b, F.col("id") < F.col("id2"))
    n = F.length("text")
    met = both.where(titles._lacking(F.col("bits"), F.col("bits2")) <= 3 * n - 1.5 * 0.9 * 2 * n).select("id", "id2").collect()
    assert {tuple(r) for r in met} == {(0, 30)}
    assert both.where(titles._shared(F.col("text"), F.col("text2")) >= 0.9 * n).count() == 31 * 30 // 2
