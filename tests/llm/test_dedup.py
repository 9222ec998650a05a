"""Duplicate removal and the join against brute force, with the cases of their docstrings."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrameWriter

import brute
from lodestone.llm import automaton_dedup, components, jaccard_join, suffix_dedup, units, windows
from lodestone.llm.common import CLEANUP

ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "x"), (5, "ab c dé \U0001d4ac " * 3), (None, "w " * 60), (6, "w " * 60), (6, "w " * 60)]


def texts(seed, n=60, words=400):
    """Copies, near copies, shared passages, repeated lines, ties and repeated rows."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["é", "ß𝒬"]
    base = [" ".join(r.choice(vocabulary) for _ in range(r.choice([5, 30, 120]))) for _ in range(8)]
    passage = " ".join(r.choice(vocabulary) for _ in range(45))
    out = []
    for i in range(n):
        t = r.choice(base).split(" ")
        for _ in range(r.choice([0, 0, 1, 3])):
            t[r.randrange(len(t))] = r.choice(vocabulary)
        if r.random() < 0.4:
            k = r.randrange(len(t))
            t[k:k] = passage.split(" ")
        if r.random() < 0.2:
            t = t[:12] * 6
        out.append((i, " ".join(t)))
    return out


def frame(spark, docs, parts=3):
    return spark.createDataFrame([(i, t, "a", "b") for i, t in docs], "doc_id long, text string, id string, h string").repartition(parts)


def check(rows, expected):
    assert len(rows) == len(expected)
    for r, e in zip(sorted(rows, key=repr), sorted(expected, key=repr), strict=True):
        assert tuple(r) == e


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("module, plain", [(suffix_dedup, brute.byte_dedup), (automaton_dedup, brute.word_dedup)])
def test_against_brute_force(spark, module, plain, seed):
    docs = texts(seed)
    want = plain(docs)
    check(module.dedup(frame(spark, docs)).collect(), [(i, *want[i, t]) for i, t in docs])


def test_what_is_kept(spark):
    docs = texts(3, 30)
    by_bytes, by_words = brute.byte_dedup(docs), brute.word_dedup(docs)
    for r in suffix_dedup.kept(frame(spark, docs)).collect():
        text = dict(docs)[r.doc_id].encode()
        assert hashlib.sha256(r.kept).hexdigest() == by_bytes[r.doc_id, dict(docs)[r.doc_id]][3] and len(r.spans) == by_bytes[r.doc_id, dict(docs)[r.doc_id]][2]
        assert len(text) - sum(s.end - s.begin for s in r.spans) == len(r.kept)
    for r in automaton_dedup.kept(frame(spark, docs)).collect():
        n, gone, sha = by_words[r.doc_id, dict(docs)[r.doc_id]]
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == sha and sum(s.end - s.begin for s in r.spans) == gone


@pytest.mark.parametrize("module, plain", [(suffix_dedup, brute.byte_dedup), (automaton_dedup, brute.word_dedup)])
def test_odd_rows(spark, module, plain):
    last = windows.LAST
    want = plain([(last if i is None else i, t) for i, t in ODD])
    check(module.dedup(frame(spark, ODD)).collect(), [(i, *want[last if i is None else i, t]) for i, t in ODD])
    assert module.dedup(frame(spark, ODD).limit(0)).collect() == []


@pytest.mark.parametrize("module, plain", [(suffix_dedup, brute.byte_dedup), (automaton_dedup, brute.word_dedup)])
def test_windows_one_by_one(spark, module, plain, monkeypatch):
    """Anchors with many kinds of run send each window on its own; pieces of long texts are cut."""
    monkeypatch.setattr(windows, "MANY_KINDS", 1)
    monkeypatch.setattr(windows, "PIECE", 300)
    monkeypatch.setattr(windows, "GATHER", 50)
    docs = texts(5)
    want = plain(docs)
    spec = module.spec()
    # the stages as a task runs them, in this process
    import pyarrow as pa

    def call(stage, names, rows):
        return [r for b in stage(iter([pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)])) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]

    told = [r for k in range(0, len(docs), 20) for r in call(windows._announce(spec, 3), ["id", "h", "text"], [(i, 0, t) for i, t in docs[k : k + 20]])]
    by = lambda rows: sorted(rows, key=lambda r: r[0])
    settled = call(windows._settle(spec, 3), ["bucket", "payload"], by(told))
    whole = {r[0]: r for r in call(windows._collect, ["bucket", "payload"], by(settled))}
    assert any((windows.unpacked(r[3])[2] == windows.ASK_SINGLY).any() for r in whole.values())
    asked = [(i, 0, t, whole[i][3]) for i, t in docs if i in whole and whole[i][2]]
    sent = [r for k in range(0, len(asked), 15) for r in call(windows._contents(spec, 3), ["id", "h", "text", "answer"], asked[k : k + 15])]
    part = {r[0]: r for r in call(windows._collect, ["bucket", "payload"], by(call(windows._compare(spec, 3), ["bucket", "payload"], by(sent))))}
    for i, t in docs:
        n = want[i, t][0]
        gone = windows.covered(n, spec.window, whole[i][3] if i in whole else None, part[i][3] if i in part else None)
        assert gone.sum() == want[i, t][1], i


def test_bucket_pointers():
    r = np.random.default_rng(1)
    data = r.integers(97, 99, 400).astype(np.uint8)
    for depth in (1, 3, 4, 7, 50):
        p = suffix_dedup.bucket_pointers(data, depth)
        seen = {}
        for i in range(len(data) - depth + 1):
            w = data[i : i + depth].tobytes()
            assert seen.setdefault(w, p[i]) == p[i]
        assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=14), max_size=5), st.lists(st.integers(0, 3), max_size=14))
def test_matching_statistics(reference, query):
    a = automaton_dedup.SuffixAutomaton()
    for x in reference:
        a.add(x)
    subs = {tuple(x[i:j]) for x in reference for i in range(len(x)) for j in range(i + 1, len(x) + 1)}
    want = [max((k for k in range(1, e + 1) if tuple(query[e - k : e]) in subs), default=0) for e in range(1, len(query) + 1)]
    assert a.statistics(query) == want


def test_against_a_reference(spark):
    ref = spark.createDataFrame([("a b c d e f",), (None,)], "text string")
    docs = spark.createDataFrame([(1, "x a b c d y b c d e f z"), (2, None), (3, "a b c")], "doc_id long, text string")
    assert {r.doc_id: r.kept_text for r in automaton_dedup.against(docs, ref, ["doc_id"], window=4).collect()} == {1: "x y z", 2: "", 3: "a b c"}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab \né ", max_size=12), max_size=6))
def test_words(raws):
    raws = [r.encode() for r in raws]
    words = units.many_word_units(raws)
    assert [len(w) for w in words] == [len(r.split()) for r in raws]
    seen = {}
    for r, ws in zip(raws, words, strict=True):
        for w, h in zip(r.split(), ws.tolist(), strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_long_texts_are_cut_at_words(monkeypatch):
    monkeypatch.setattr(units, "PIECE", 50)
    raw = " ".join(["word"] * 40 + ["x" * 200] + ["word"] * 3).encode()
    w = units.word_units(raw)
    assert len(w) == 44 and len(set(w.tolist())) == 2


# --- the join
def pairs_of(docs):
    want = brute.jaccard_components(docs)
    return [(i, *want[i]) for i, _ in docs]


@pytest.mark.parametrize("seed", [1, 2])
def test_join(spark, seed):
    docs = texts(seed, 80)
    check(jaccard_join.linked(frame(spark, docs)).collect(), pairs_of(docs))


@pytest.mark.parametrize("token_cost", [1.0, 0.0, 1e9])
def test_join_of_groups_larger_than_a_task(spark, monkeypatch, token_cost):
    monkeypatch.setattr(jaccard_join, "SLICE", 12)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 1)
    monkeypatch.setattr(jaccard_join, "TOKEN_COST", token_cost)
    r = random.Random(3)
    vocabulary = [f"v{i}" for i in range(2000)]
    docs = []
    for size in (40, 25, 3):
        chain = [r.choice(vocabulary) for _ in range(80)]
        for k in range(size):
            if k % 3 == 0:  # the text drifts, so that far members link only through others
                chain = list(chain)
                chain[r.randrange(len(chain))] = r.choice(vocabulary)
            docs.append((len(docs), " ".join(chain) + (f" tail{k}" if k % 2 else "")))
    check(jaccard_join.linked(frame(spark, docs)).collect(), pairs_of(docs))


def test_join_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "one"), (4, "ONE"), (5, "a b c d"), (6, "A B  c\td"), (7, "a b c d e"), (9, "É x y z q"), (8, "é x y z q")]
    want = {1: (0, 1), 2: (0, 2), 3: (1, 3), 4: (1, 3), 5: (1, 5), 6: (1, 5), 7: (1, 7), 8: (1, 8), 9: (1, 9)}
    check(jaccard_join.linked(frame(spark, docs)).collect(), [(i, *want[i]) for i, _ in docs])
    assert jaccard_join.linked(frame(spark, docs).limit(0)).collect() == []
    rows = jaccard_join.linked(frame(spark, [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, "q")])).collect()
    check(rows, [(None, 2, 3), (3, 2, 3), (3, 2, 3), (None, 1, None)])


def test_multi_match_prefixes_lose_no_pair():
    r = np.random.default_rng(4)
    for _ in range(300):
        n, m = r.integers(5, 60, 2)
        x = set(r.choice(80, n, replace=False).tolist())
        y = set(list(x)[: int(len(x) * 0.9)]) | set(r.choice(80, 3).tolist()) if r.random() < 0.7 else set(r.choice(80, m, replace=False).tolist())
        if 100 * len(x & y) < 80 * len(x | y):
            continue
        for lx in range(1, 5):
            for ly in range(1, 5):
                px = sorted(x)[: len(x) - jaccard_join.need(len(x), 80) + lx]
                py = sorted(y)[: len(y) - jaccard_join.need(len(y), 80) + ly]
                assert len(set(px) & set(py)) >= min(lx, ly)


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(40) if i % 9] + [(r.randrange(100, 160), r.randrange(100, 160)) for _ in range(50)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    got = {x.node: x.root for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-5, 25), st.integers(-5, 25)), max_size=40))
def test_contract(edges):
    edges = [(a, b) for a, b in edges if a != b]
    a, b = (np.array([e[i] for e in edges], np.int64) for i in (0, 1))
    child, root = components.contract(a, b)
    union = jaccard_join.Links(40)
    for x, y in edges:
        union.join(x + 5, y + 5)
    nodes = {x for e in edges for x in e}
    assert dict(zip(child.tolist(), root.tolist(), strict=True)) == {x: union.find(x + 5) - 5 for x in nodes if union.find(x + 5) - 5 != x}


# --- texts without id, or of one id
def crowd(i, n=3000):
    """n different short texts of one id, some of which share a passage with a text of id 1."""
    r = random.Random(9)
    vocabulary = [f"word{k}" for k in range(50)]
    shared = [f"part{k}" for k in range(25)]
    out = [(1, " ".join(["first", *shared, "last"]))]
    for k in range(n):
        words = [r.choice(vocabulary) for _ in range(14)]
        if k % 7 == 0:
            words[5:5] = shared
        if k % 11 == 0:  # linked with text 1
            words = ["first", *shared[: 24 + k % 2], "last"]
        out.append((i, " ".join([*words, f"own{k // 2}"])))
    return out


@pytest.mark.parametrize("i", [None, 5])
@pytest.mark.parametrize("module, plain", [(suffix_dedup, brute.byte_dedup), (automaton_dedup, brute.word_dedup)])
def test_crowds(spark, module, plain, i):
    docs = crowd(i)
    last = windows.LAST
    want = plain([(last if j is None else j, t) for j, t in docs])
    check(module.dedup(frame(spark, docs)).collect(), [(j, *want[last if j is None else j, t]) for j, t in docs])


@pytest.mark.parametrize("i", [None, 5])
def test_join_of_crowds(spark, i):
    docs = crowd(i)
    by_row = brute.jaccard_components(list(enumerate(t for _, t in docs)))
    least = {}
    for k, (j, _) in enumerate(docs):
        root = by_row[k][1]
        least[root] = min(least.get(root, windows.LAST), windows.LAST if j is None else j)
    none = lambda x: None if x == windows.LAST else x
    check(jaccard_join.linked(frame(spark, docs)).collect(), [(j, by_row[k][0], none(least[by_row[k][1]])) for k, (j, _) in enumerate(docs)])
    kept = jaccard_join.distinct_documents(frame(spark, docs)).collect()
    assert len({r.text for r in kept}) == len({r for _, r in by_row.values()}) and all(len(r) == 4 for r in kept)


def test_hubs_are_joined_apart(spark, monkeypatch):
    monkeypatch.setattr(components, "HUB_ROWS", 3)
    monkeypatch.setattr(components, "HUBS", 3)
    edges = [(0, k) for k in range(1, 40)] + [(50, 51), (51, 52), (39, 60), (60, 61)]
    got = {x.node: x.root for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: 50 if 50 <= x <= 52 else 0 for e in edges for x in e}
    rows = spark.createDataFrame([(1, "a")] * 9 + [(2, "b"), (None, "c"), (3, "d")], "k long, v string")
    facts = spark.createDataFrame([(1, "one", 9), (2, "two", 1)], "k long, f string, weight long")
    assert sorted(r.v + str(r.f) for r in components.attach(rows, "k", facts, "left").collect()) == ["aone"] * 9 + ["btwo", "cNone", "dNone"]


@pytest.mark.parametrize("spec", [suffix_dedup.spec(), automaton_dedup.spec()])
def test_shuffles_of_the_first_pass_are_dropped(spark, spec, monkeypatch):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    kept = lambda: {x for x in manager.getAllBlocks().mkString("\n").split("\n") if x.startswith("shuffle_")}
    df = spark.createDataFrame([(i, f"text {i} " + "the same words again and again " * 20) for i in range(50)], "doc_id long, text string")
    before, seen, write = kept(), [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a, **b: (seen.append(spark.conf.get(CLEANUP, "false")), write(*a, **b))[1])
    windows.repeated(df, spec, "doc_id", "text")
    assert seen == ["true"] and kept() <= before  # the JVM's garbage collector may drop them too, but needn't
    assert spark.conf.get(CLEANUP, "false") == "false"


@pytest.mark.parametrize("module, plain", [(suffix_dedup, brute.byte_dedup), (automaton_dedup, brute.word_dedup)])
def test_rounds_find_the_same(spark, module, plain, monkeypatch):
    """A larger input goes in rounds; each drops its shuffles, and only the results stay stored."""
    monkeypatch.setattr(windows, "ROUNDS_FROM", 0)
    labels, drop, own = {}, windows.drop_scratch, windows.scratch
    monkeypatch.setattr(windows, "scratch", lambda s, label: [p := own(s, label), labels.update({p: label})][0])
    monkeypatch.setattr(windows, "drop_scratch", lambda s, p: (labels.pop(p), drop(s, p)))
    docs = texts(1) + [(i, t) for i, t in ODD if i is not None and i > 3]
    docs = [(k, t) for k, (_, t) in enumerate(docs)] + [(0, "another text of one id " * 9)]
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    kept = lambda: {x for x in manager.getAllBlocks().mkString("\n").split("\n") if x.startswith("shuffle_")}
    df, want = frame(spark, docs), plain(docs)
    before = kept()
    out = module.dedup(df)
    assert kept() <= before and list(labels.values()) == ["found"] * windows.MET_ROUNDS
    check(out.collect(), [(i, *want[i, t]) for i, t in docs])
    assert module.dedup(frame(spark, ODD).limit(0)).collect() == []


def test_a_round_tells_its_buckets_only():
    import pyarrow as pa

    docs = texts(4, 80)
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs]), pa.array([0] * len(docs)), pa.array([t for _, t in docs])], names=["id", "h", "text"])
    told = lambda *turn: {r for b in windows._announce(suffix_dedup.spec(), 8, *turn)(iter([batch])) for r in zip(*(c.to_pylist() for c in b.columns), strict=True) if r[0] >= 0}
    one, parts = told(), [told(k, 2) for k in range(2)]
    assert parts[0] | parts[1] == one and not parts[0] & parts[1]
    assert max(sum(len(p) for _, p in x) for x in parts) < 0.8 * sum(len(p) for _, p in one)
