"""Embedding whitening, source divergence and license scan."""

import random
import re
import string

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestone.llm import divergence, licenses, queries, whitening

DATA = "/root/testdata"


def fetched(con, sql):
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    return sorted(repr(sorted(zip(names, r))) for r in cur.fetchall())


def told(df):
    return sorted(repr(sorted(r.asDict().items())) for r in df.collect())


@pytest.mark.parametrize("name", ["op12_divergence", "op13_license_scan"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/sf0.001/documents.parquet'")
    assert told(queries.QUERIES[name](spark, f"{DATA}/sf0.001")) == fetched(con, queries.ORACLE_SQL[name])


# --- whitening
def brute_whitening(vectors):
    x = np.floor(1024 * np.array(vectors, float)) + 100000
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    return s, c @ u / np.sqrt(e), e / np.trace(v), [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 7.0, "x") for i, v in rows], "vec_id long, embedding array<float>, whitened double, component string")


def test_whitening(spark):
    rng = np.random.default_rng(5)
    good = (rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(good)]
    odd = [(900, None), (901, [1.0] * 11 + [None]), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11), (904, []), (905, [1.0, 2.0]), (None, good[0].tolist()), (3, good[3].tolist())]
    _, w, explained, deviation = brute_whitening([*good, good[0], good[3]])
    out = whitening.whiten(vectors(spark, rows + odd).repartition(5)).collect()
    assert len(out) == 302 * 8 and {r.n for r in out} == {302} and {r.vec_id for r in out} == {*range(300), None}
    signs = {}
    for r in out:
        i = 300 if r.vec_id is None else r.vec_id
        expected = w[i, r.component - 1]
        if abs(expected) > 1e-3:
            assert signs.setdefault(r.component, np.sign(expected * r.whitened)) == np.sign(expected * r.whitened)
        assert abs(abs(r.whitened) - abs(expected)) < 1e-9 and r.deviation == int(r.deviation_exact) == deviation[i]
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9


def test_whitening_cases(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no variance
    assert whitening.whiten(vectors(spark, [(1, None), (2, [None])])).count() == 0
    flat = whitening.whiten(vectors(spark, [(k, [float(k), 0.0, 2.0]) for k in range(10)])).collect()
    assert {r.component for r in flat} == {1} and abs(sum(r.whitened**2 for r in flat) / 10 - 1) < 1e-12
    # of equally many, the longer
    assert {r.vec_id for r in whitening.whiten(vectors(spark, [(1, [1.0]), (2, [2.0]), (3, [1.0, 2.0]), (4, [2.0, 5.0])])).collect()} == {3, 4}
    huge = whitening.whiten(vectors(spark, [(k, [3e38 * (-1) ** k, float(k)]) for k in range(4)])).collect()
    assert {r.deviation for r in huge} == {None} and all(r.deviation_exact > 1 << 63 for r in huge)
    assert whitening.whiten(spark.createDataFrame([(k, [k, k * k]) for k in range(9)], "a string, b array<int>"), "a", "b").count() == 18


# --- divergence
def documents(spark, rows):
    return spark.createDataFrame([(1, *r, 1, "x") for r in rows], "doc_id long, lang string, source string, text string, term long, value string")


def divergences(spark, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(lang VARCHAR, source VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    out = told(divergence.audit(documents(spark, rows).repartition(3)))
    assert out == fetched(con, divergence.oracle())
    return out


def test_divergence_cases(spark):
    assert divergences(spark, []) == []
    words = ["aa", "Bb", "ç9d", "日本 日本", "eé", "ff1gg", "x" * 300]
    rng = random.Random(3)
    rows = [(rng.choice(["en", None, ""]), rng.choice(["a", "b", "é", None, "Z"]), " ".join(rng.choices(words, k=rng.randrange(9))) if rng.random() < 0.9 else None) for _ in range(120)]
    divergences(spark, rows + [("de", "alone", "eins zwei drei")] * 3 + [("fr", "a", "un"), ("fr", "b", None), ("xx", "a", ""), ("xx", "b", "1 2")])


def test_divergence_bands_and_slices(spark, monkeypatch):
    """Several bands of sources, many tiles and slices of a text give what one gives."""
    rng = random.Random(7)
    words = ["".join(rng.choices(string.ascii_lowercase, k=2)) for _ in range(400)]
    rows = [("en", f"s{rng.randrange(7)}", " ".join(rng.choices(words, k=60))) for _ in range(150)] + [("de", "only", "a b c " * 50)] * 4
    before = divergences(spark, rows)
    for name, value in (("BAND", 3), ("TILE", 64), ("PENDING", 50), ("SLICE", 16)):
        monkeypatch.setattr(divergence, name, value)
    # workers import the module anew, so the parts that run there are called here
    counts = divergence.words(b"ab c  d1e " * 40)
    assert counts == {b"ab": 40, b"c": 40, b"d": 40, b"e": 40}
    assert len(before) > 200


def test_shares_of_large_counts():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randrange(10 ** rng.randrange(1, 15))
        total = n + 1 + rng.randrange(10 ** rng.randrange(1, 15))
        assert divergence._share(np.array([n]), np.array([total]))[0] == 1 + 10**9 * (n + 1) // total


def test_bands_by_hand(monkeypatch):
    """Pairs of bands together hold each pair of groups once, with the values of a plain sum."""
    monkeypatch.setattr(divergence, "BAND", 2)
    monkeypatch.setattr(divergence, "TILE", 8)
    totals = np.array([7, 9, 20, 4, 11], np.int64)
    terms, groups, counts = ["a", "b", "c"], [np.array([0, 3]), np.array([1, 2, 4]), np.array([4])], [np.array([2, 1]), np.array([3, 5, 1]), np.array([2])]
    dense = {(g, t): int(n[list(x).index(g)]) if g in x else 0 for t, (x, n) in enumerate(zip(groups, counts)) for g in range(5)}
    p = {k: 1 + 10**9 * (n + 1) // int(totals[k[0]]) for k, n in dense.items()}
    found = {}
    for unit in range(9):
        i, j = divmod(unit, 3)
        b = divergence._Bands(*(slice(x * 2, min(5, x * 2 + 2)) for x in (i, j)), totals, 51)
        b.add(terms, groups, counts)
        for part, g, other, term, value in b.rows():
            assert (part, g, other, term) not in found
            found[part, g, other, term] = value
    assert {k: v for k, v in found.items() if k[0] == "pair"} == {("pair", g, h, None): sum((p[g, t] - p[h, t]) ** 2 // p[h, t] for t in range(3)) for g in range(5) for h in range(5) if g != h}
    assert {k[1:4:2] for k in found if k[0] == "term"} <= {(g, terms[t]) for (g, t), n in dense.items() if n}


# --- licenses
def brute_licenses(text, rules):
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))) if w]
    base = [(k, label) for k in range(len(words)) for phrase, label in licenses.BASE.items() if words[k : k + len(phrase.split())] == phrase.split()]
    found = []
    for k in range(len(words)):
        ahead = " ".join(words[k : k + licenses.REACH]) + " "
        for n, r in enumerate(rules):
            if m := re.match(f"(?:{r.pattern})(?= )", ahead):  # without the keywords
                v = re.search("[ a-z]([0-9]+(?: [0-9]+)?)$", m[0]) if r.versioned else None
                found.append((k, k + len(m[0].split()), r.priority, n, r.label + (f"-{v[1].replace(' ', '.')}" + ("" if " " in v[1] else ".0") if v else "")))
    rank = lambda d: (d[2], d[0] - d[1], d[3])
    best = [d for d in found if not any(e[0] <= d[0] and e[1] >= d[1] and rank(e) < rank(d) for e in found)]
    return len(words), sorted(base), sorted(best)


SAMPLES = [
    None, "", "   ", "1", "CC BY", "cc-by-nc-sa 4.0 and CC BY-SA", "All rights reserved. All rights reserved by all rights reserved",
    "SPDX-License-Identifier: GPL-2.0-only", "Licensed under the terms of the GNU Lesser General Public License, version 2.1 or later.",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "released into the public domain", "GPLv3 gpl 2 LGPLv2.1 apache2 agpl license",
    "Released under the Boost Software License - Version 1.0 - August 17th, 2003. Zlib licence.", "Neither the name of the University nor the names of its contributors may be used to endorse or promote",
    "Kverified mit Kit license İsc license MIT ſ licence", "mit license " * 60, "copyright (c) 2020, copyright 1999 copyright 9",
    "the gnu general public license " * 30 + "version 3", "a" * 5000 + " general public license", "use of this source code is governed by a BSD-style license", "cc0 1.0 universal cc0 license CC0-1.0",
]


def license_rows(spark, texts):
    return spark.createDataFrame([(k % 7 or None, t, 0, "x") for k, t in enumerate(texts)], "doc_id long, text string, n_words long, found string").coalesce(1)


def test_licenses_against_plain_search(spark):
    rules = licenses.rules()
    rng = random.Random(11)
    pieces = [w for r in rules for w in re.sub(r"\(\?:|[()?|{}\[\]^$.*+\\]|\d,\d", " ", r.pattern).split()] + ["x", "(c)", "2.0", "-", "version", "the"]
    texts = SAMPLES + [" ".join(rng.choices(pieces, k=rng.randrange(3, 40))) for _ in range(40)]
    texts += [rng.choice(["Licensed under the ", "released under ", "spdx license identifier ", ""]) + re.sub(r"\(\?:|[()?{}\[\]]", "", rng.choice(licenses.LICENSES[k][rng.randrange(2)].split("|"))).replace("licencs", "licens") + rng.choice([" 2.0", " license v3", " version 1", ""]) for k in licenses.LICENSES for _ in range(2)]
    for text, row in zip(texts, licenses.detections(license_rows(spark, texts), ["doc_id", "n_words"]).collect(), strict=True):
        n, base, best = brute_licenses(text, rules)
        assert (row[2], [tuple(x) for x in row.base], sorted(tuple(x) for x in row.found)) == (n, base, best), text


def test_license_rows(spark):
    out = licenses.scan(license_rows(spark, SAMPLES)).collect()
    assert [r.doc_id for r in out] == [k % 7 or None for k in range(len(SAMPLES))]
    by = dict(zip(SAMPLES, out, strict=True))
    assert tuple(by[None])[1:] == (0, 0, None, None, "", "", 0.0, 0) == tuple(by[""])[1:]
    assert (by["CC BY"].n_base, by["CC BY"].first_word, by["CC BY"].labels, by["CC BY"].score) == (1, 0, "cc-by", 0.4)
    r = by["All rights reserved. All rights reserved by all rights reserved"]
    assert (r.n_base, r.first_word, r.last_word, r.base_labels) == (3, 0, 7, "reserved")
    assert by["cc-by-nc-sa 4.0 and CC BY-SA"].labels == "cc-by,cc-by-nc-sa-4.0" and by["SPDX-License-Identifier: GPL-2.0-only"].labels == "gpl-2.0"
    assert licenses.scan(license_rows(spark, [])).count() == 0
    plan = licenses.scan(license_rows(spark, SAMPLES))._jdf.queryExecution().toString()
    assert "Python" not in plan.split("LogicalRDD")[0] and "Exchange hash" not in plan


def test_many_places_in_linear_time(spark):
    rows = spark.createDataFrame([(1, "mit license gpl version 2 " * 20_000), (2, "word " * 300_000 + "cc by")], "doc_id long, text string")
    a, b = sorted(licenses.scan(rows).collect())
    assert a.n_found == 40_000 and (b.n_words, b.first_word) == (300_002, 300_000)


@given(st.text(alphabet="ab Z9éß日K-\n", max_size=60))
@settings(max_examples=60, deadline=None)
def test_terms(text):
    found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))
    assert divergence.words(text.encode()) == {w.encode(): found.count(w) for w in found}


def test_rules_are_many_and_keyed():
    rules = licenses.rules()
    assert len({r.pattern for r in rules}) > 300 and all(r.keywords and "" not in r.keywords for r in rules)
    assert len(licenses.LICENSES) < 200  # names are listed, forms are made
