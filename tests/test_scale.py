"""Joins on unbound variables, terms, paths, clusters and persons: against plain searches, and their plans."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_graph import X, ask, graph

from lodestone import scale_queries
from lodestone.operators import events, orbits, resolve
from lodestone.plans import sparql
from lodestone.sources import readers, sinks, turtle

SMALL = "/root/testdata/sf0.001"
S = X


@pytest.fixture(scope="module")
def terms(spark):
    return graph(
        spark, ("a", "q", "5"), ("b", "q", ("5", "integer")), ("c", "q", ("abc", "@en")), ("d", "q", "abc"), ("e", "q", ("abc", "@de")), ("f", "q", "http://x/a"), ("g", "q", "x:a"), ("h", "q", ("5.0", "double")), ("i", "q", ("true", "boolean")), ("j", "q", ("2020-01-01", "date")),
        ("a", "w", "abc"), ("b", "w", "5"), ("k", "m", "one"), ("l", "m", "two"), ("k", "n", "one"), ("z", "v", "one"), ("y", "v", "two"), ("x", "v", "three"),
    )


@pytest.mark.parametrize(
    "text, expected",
    [
        ('SELECT ?s WHERE { ?s x:q "5" }', "a"), ("SELECT ?s WHERE { ?s x:q 5 }", "b"), ('SELECT ?s WHERE { ?s x:q "abc" }', "d"), ('SELECT ?s WHERE { ?s x:q "abc"@en }', "c"), ('SELECT ?s WHERE { ?s x:q "abc"@EN }', "c"),
        ('SELECT ?s WHERE { ?s x:q ?o FILTER(?o = "abc") }', "d"), ('SELECT ?s WHERE { ?s x:q ?o FILTER(?o = "abc"@de) }', "e"), ('SELECT ?s WHERE { ?s x:q ?o FILTER(?o = "5") }', "a"), ("SELECT ?s WHERE { ?s x:q ?o FILTER(?o = 5) }", "bh"), ('SELECT ?s WHERE { ?s x:q ?o FILTER(?o = "http://x/a") }', "f"),
        ("SELECT ?s WHERE { ?s x:q ?o FILTER(?o = x:a) }", "g"), ('SELECT ?s WHERE { ?s x:q ?o FILTER(?o IN ("abc", x:a)) }', "dg"), ("SELECT ?s WHERE { ?s x:q ?o FILTER(?o = true) }", "i"), ('SELECT ?s WHERE { ?s x:q ?o FILTER(?o = "2020-01-01"^^xsd:date) }', "j"), ('SELECT ?s WHERE { ?s x:q ?o FILTER(?o = "2020-01-01") }', ""),
        ('SELECT ?s WHERE { ?s x:q ?o FILTER(?s = "http://x/a") }', ""), ("SELECT ?s WHERE { ?s x:q ?o FILTER(SAMETERM(?o, 5)) }", ""), ("SELECT ?s WHERE { ?s x:q ?o FILTER(ISNUMERIC(?o)) }", "bh"), ('SELECT ?s WHERE { ?s x:q ?o FILTER(LANGMATCHES(LANG(?o), "*")) }', "ce"), ('SELECT ?s WHERE { ?s x:q ?o FILTER(?o = STRLANG("abc", "en")) }', "c"),
        ('SELECT ?s WHERE { ?s x:q ?o FILTER(?o = STRDT("2020-01-01", xsd:date)) }', "j"), ("SELECT ?s WHERE { ?s x:q ?o FILTER(?o < 6 && YEAR(NOW()) > 2000) }", "bh"),
    ],
)
def test_terms(terms, text, expected):
    assert ask(terms, text) == [(S + c,) for c in expected]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("SELECT ?s ?z WHERE { ?s x:m ?m OPTIONAL { ?s x:n ?k } ?z x:v ?k }", [("k", "z"), ("l", "x"), ("l", "y"), ("l", "z")]),
        ("SELECT ?s ?z WHERE { ?s x:m ?m BIND(IF(?m = 'two', ?m, ?none) AS ?k) ?z x:v ?k }", [("k", "x"), ("k", "y"), ("k", "z"), ("l", "y")]),
        ("SELECT ?s ?z WHERE { ?s x:m ?m BIND(STR(?m) AS ?k) ?z x:v ?k }", [("k", "z"), ("l", "y")]),
        ("SELECT ?s ?z WHERE { ?s x:m ?m OPTIONAL { ?s x:n ?k } OPTIONAL { ?z x:v ?k FILTER(?k != 'x') } }", [("k", "z"), ("l", "x"), ("l", "y"), ("l", "z")]),
        ("SELECT ?s ?z WHERE { ?s x:m ?m OPTIONAL { ?s x:n ?k } OPTIONAL { ?z x:nothing ?k } }", [("k", None), ("l", None)]),
        ("SELECT ?s WHERE { ?s x:m ?m OPTIONAL { ?s x:n ?k } MINUS { ?z x:v ?k } }", [("l",)]),
        ("SELECT ?s ?z WHERE { { ?s x:m ?m OPTIONAL { ?s x:n ?k } } { ?z x:v ?v OPTIONAL { ?z x:v ?k FILTER(?k = 'two') } } }", [("k", "x"), ("k", "z"), ("l", "x"), ("l", "y"), ("l", "z")]),
        ("SELECT ?s ?z WHERE { { ?s x:m ?m OPTIONAL { ?s x:n ?k } } OPTIONAL { ?z x:v ?v OPTIONAL { ?z x:v ?k FILTER(?k = 'two') } FILTER(?v = 'two') } }", [("k", None), ("l", "y")]),
    ],
)
def test_joins_by_masks(terms, text, expected):
    found = ask(terms, text)
    assert found == sorted((tuple(None if x is None else S + x for x in r) for r in expected), key=lambda r: [str(x) for x in r])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["sparql_bind_join", "sparql_optional_join", "sparql_minus_unbound"])
def test_no_products(spark, name):
    assert "CartesianProduct" not in plan(df := getattr(scale_queries, name)(spark, SMALL)) and "NestedLoop" not in plan(df)


@pytest.mark.parametrize("rows, most", [(200_000, 4_096), (1, 4_096), (200_000, 0)])
def test_pairs_in_tiles(spark, terms, monkeypatch, rows, most):
    """Tiles, slices of the side that is sent, and the way without tiles find the same pairs."""
    texts = ["SELECT ?s ?z WHERE { ?s x:m ?m OPTIONAL { ?s x:n ?k } ?z x:v ?k }", "SELECT ?s ?z WHERE { { ?s x:q ?q OPTIONAL { ?s x:w ?k } } { ?z x:q ?v OPTIONAL { ?z x:q ?k FILTER(?k != 'x') } } }"]
    names = ["sparql_bind_join", "sparql_optional_join"]
    want = [ask(terms, t) for t in texts], [sorted(getattr(scale_queries, n)(spark, SMALL).collect()) for n in names]
    for name, value in (("SPREAD_ROWS", 0), ("TILE", 2), ("TASK_ROWS", 3), ("BROADCAST_ROWS", rows), ("MOST_IN_TILE", most)):
        monkeypatch.setattr(sparql, name, value)
    assert [ask(terms, t) for t in texts] == want[0] and [sorted(getattr(scale_queries, n)(spark, SMALL).collect()) for n in names] == want[1]


def test_many_pairs_are_written_small(spark, tmp_path):
    name = lambda kind, c: F.concat(F.lit(f"http://example.org/{kind}/"), F.xxhash64(c).cast("string"))
    left = spark.range(20_000).select(name("a", "id").alias("a"), (F.col("id") % 7).alias("k"))
    right = spark.range(3_000).select(name("b", "id").alias("b"), (F.col("id") % 7).alias("k|r"))
    pairs = sparql._spread(left, right, F.col("k") == F.col("`k|r`"), ["k"], ["k|r"]).select("a", "b")
    pairs.write.parquet(str(tmp_path / "pairs"))
    found = spark.read.parquet(str(tmp_path / "pairs"))
    n = found.count()
    assert n == sum(len(range(k, 20_000, 7)) * len(range(k, 3_000, 7)) for k in range(7)) == found.distinct().count()
    assert sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet")) < 0.6 * n


# --- paths
def reach(edges, start):
    seen, todo = set(), [start]
    while todo:
        for b in edges.get(todo.pop(), ()):
            if b not in seen:
                seen.add(b)
                todo.append(b)
    return seen


@pytest.mark.parametrize("seed", (0, 3))
def test_reached_and_closure(spark, seed, monkeypatch):
    monkeypatch.setattr(orbits, "PLAIN_ROUNDS", 2)
    rng = random.Random(seed)
    pairs = {(f"n{a}", f"n{a + 1}") for a in range(12)} | {(f"n{rng.randrange(20)}", f"n{rng.randrange(20)}") for _ in range(seed * 4)}
    edges = {}
    for a, b in pairs:
        edges.setdefault(a, []).append(b)
    df = spark.createDataFrame(sorted(pairs), "a string, b string")
    for start in ("n0", "n7"):
        assert {r.node for r in orbits.reached(df, spark.createDataFrame([(start,)], "node string")).collect()} == reach(edges, start)
    got = [tuple(r) for r in orbits.closure(df).collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a in edges for b in reach(edges, a)}


def test_long_chain_in_few_rounds(spark, monkeypatch):
    written = []
    monkeypatch.setattr(orbits, "stored", lambda df, label, own=orbits.stored: written.append(label) or own(df, label))
    n = 3000
    df = spark.range(n).select(F.col("id").cast("string").alias("a"), (F.col("id") + 1).cast("string").alias("b"))
    assert orbits.reached(df, spark.createDataFrame([("10",)], "node string")).count() == n - 10
    assert len(written) < 60


def test_paths_with_ends(spark):
    g = graph(spark, ("a", "p", "x:b"), ("b", "p", "x:c"), ("c", "p", "x:a"), ("d", "p", "x:c"), ("c", "p", "text"))
    assert ask(g, "SELECT ?s WHERE { ?s x:p+ x:b }") == [(S + c,) for c in "abcd"] and ask(g, "SELECT ?o WHERE { x:d x:p* ?o }") == [(S + c,) for c in "abcd"]
    assert ask(g, "SELECT ?o WHERE { x:zz x:p* ?o }") == [(S + "zz",)] and ask(g, "ASK { x:a x:p+ x:d }") == [("False",)] and ask(g, "ASK { x:a x:p+ x:a }") == [("True",)]


# --- clusters
def numbered(days, most):
    """Missing days first; the fold of the definition."""
    anchor, n, out = None, 0, {}
    for d in sorted(set(days), key=lambda d: (d is not None, d)):
        if not (n and (d is None or anchor is None or d - anchor <= most)):
            n, anchor = n + 1, d
        out[d] = n
    return out


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["k", "l", None]), st.one_of(st.integers(-40, 300), st.integers(-5, 5))), min_size=1, max_size=60), st.booleans(), st.sampled_from([0, 3, 14]))
def test_pointed_clusters(spark, found, gap, most):
    found = found + [("k", None)] * gap
    df = spark.createDataFrame([(i, k, None if d is None else dt.date(1970, 2, 1) + dt.timedelta(d)) for i, (k, d) in enumerate(found)], "i int, k string, d date")
    expected = {k: numbered([d for key, d in found if key == k], most) for k in {k for k, _ in found}}
    for few in (0,):
        got = {r.i: r.cluster for r in events.anchored_by_day(df, ["k"], "d", most, few).collect()}
        assert got == {i: expected[k][d] for i, (k, d) in enumerate(found)}


def test_a_key_of_a_million_rows(spark):
    rows = spark.range(1_000_000).select(F.lit("k").alias("k"), F.date_from_unix_date((F.col("id") % 200_000 - 100_000).cast("int")).alias("d"))
    out = events.anchored_by_day(rows, ["k"], "d").agg(F.max("cluster"), F.count("*")).first()
    assert tuple(out) == (-(-200_000 // 15), 1_000_000)


# --- persons
def folded(people):
    """(id, initials, given) of one family by the definition."""
    done = []
    for i, init, given in sorted(people, key=lambda p: (-len(p[2]), p[2], p[0])):
        keeper = next((k for k, own, joins in done if joins is None and (own.startswith(init) or init.startswith(own))), None)
        done.append((i, init, keeper))
    return {i: keeper if keeper is not None else i for i, _, keeper in done}


@pytest.mark.parametrize("seed", (1,))
def test_classes_of_persons(spark, seed):
    rng = random.Random(seed)
    people = []
    for i in range(120):
        init = "".join(rng.choices("AB", k=rng.randrange(5)))
        people.append((i, f"f{rng.randrange(2)}", init, " ".join(c + rng.choice([".", "nn", "lbertina"]) for c in init)))
    df = spark.createDataFrame([(i, f, g) for i, f, _, g in people] + [(500, "f0", None), (501, None, "A."), (502, None, "A. B.")], "id int, family string, given string")
    expected = {500: 500, 501: 502, 502: 502} | {i: k for f in ("f0", "f1") for i, k in folded([(i, n, g) for i, own, n, g in people if own == f]).items()}
    assert {r.id: r.keeper for r in resolve.loose_persons(df).collect()} == expected
    known = spark.createDataFrame([(f"o{i}", f, g) for i, f, _, g in people[:9]], "orcid string, family string, given string")
    one, several = resolve.match_persons(df, known, known.select("orcid", "family"))
    got = {r.id: [r.orcid] for r in one.collect()} | {r.id: r.orcids for r in several.collect()}
    fits = {i: sorted(f"o{j}" for j, own, m, _ in people[:9] if own == f and (m.startswith(n) or n.startswith(m))) for i, f, n, _ in people}
    assert got == {i: v for i, v in fits.items() if v}


def test_a_family_of_many(spark):
    rows = spark.range(200_000).select("id", F.lit("Kim").alias("family"), F.concat(F.lit("J. "), F.chr(F.col("id") % 26 + 65), F.lit(".")).alias("given"))
    assert resolve.loose_persons(rows).select("keeper").distinct().count() == 26


# --- blank nodes
def test_blank_nodes_are_written_bare(spark, tmp_path):
    text = "@prefix x: <http://x/> . x:a x:p [ x:q '1' ], [ x:q 'a\\\\n\\r' ] ; x:list ( x:b 'c' ) ."
    df = spark.createDataFrame(turtle.turtle(text), "s string, p string, o string, o_kind string, o_type string, o_lang string")
    lines = [r.value for r in sinks.ntriples(df).collect()]
    assert not any("<_:" in x for x in lines) and any(x.startswith("_:") for x in lines)
    shape = lambda rows: sorted((r.s.startswith("_:"), r.p, "" if r.o.startswith("_:") else r.o, r.o_kind, r.o_type) for r in rows)
    sinks.ntriples(df).repartition(3).write.text(str(tmp_path / "n"))
    again = readers.read_ntriples(spark, str(tmp_path / "n"))
    assert shape(again.collect()) == shape(df.collect())
    assert {r.o for r in again.where("p = 'http://x/p'").collect()} == {r.s for r in again.where("p = 'http://x/q'").collect()}  # one node in several parts
    (tmp_path / "t.ttl").write_text(sinks.canonical_turtle(df, {"x": X}))
    assert shape(readers.read_turtle(spark, str(tmp_path / "t.ttl")).collect()) == shape(df.collect())


@pytest.mark.parametrize("small", [3, 1000])
def test_join_with_many_pairs_of_few_keys(spark, small, monkeypatch):
    """The smaller side is sent to all rows of the other, which are dealt to tasks whatever their keys are."""
    rows = lambda n, key: spark.range(n).select((F.col("id") % 2).alias(key), F.col("id").alias(f"{key}_id"))
    monkeypatch.setattr(sparql, "SPREAD_ROWS", 100)
    for a, b in ((rows(1000, "x"), rows(small, "y")), (rows(small, "x"), rows(1000, "y"))):
        on = F.col("x") == F.col("y")
        got = sparql._spread(a, b, on)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, a.join(b, on).collect()))
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(sizes) >= 16 and max(sizes) <= 2 * sum(sizes) / len(sizes)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_chains_with_nodes_left_out(spark, seed, monkeypatch):
    """Chains that meet, end and turn in circles; starts that are left out themselves."""
    monkeypatch.setattr(orbits, "PLAIN_STEPS", 10)
    rnd = random.Random(seed)
    to = {f"n{k}": f"n{k + 1}" for k in range(120)} | {f"m{k}": rnd.choice([f"m{k + 1}", f"n{rnd.randrange(120)}"]) for k in range(60)} | {f"c{k}": f"c{(k + 1) % 7}" for k in range(7)} | {"s": "s"}
    starts = rnd.sample(sorted(to), 4) + ["s", "elsewhere"]
    expected = set()
    for x in starts:
        while x not in expected:
            expected.add(x)
            x = to.get(x, x)
    made = orbits.contracted(spark.createDataFrame(list(to.items()), "a string, b string"))
    sizes = [df.count() for df in made[0]]
    assert len(sizes) > 5 and sum(sizes) < 6 * len(to)
    found = [r.node for r in orbits.on_chains(made, spark.createDataFrame([(x,) for x in starts], "node string")).collect()]
    assert set(found) == expected and len(found) == len(expected)
