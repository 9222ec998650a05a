"""Validation of changes against full runs, on random changes of a small graph."""

import random

import pytest

from pyspark.sql import functions as F

from lodestone.operators import changes, triples
from lodestone.operators.shacl import SUB_CLASS, Property, Shape, literal
from lodestone.operators.triples import RDF, Emit, Graph, View
from lodestone.operators.triples import a as class_of, iri as iri_of

X = "http://x/"
COLUMNS = "s string, p string, o string, o_kind string, o_type string, o_lang string"
TYPE = RDF + "type"


def iri(s, p, o):
    return (X + s, p if p == TYPE else X + p, X + o, "iri", "", "")


def text(s, p, o):
    return (X + s, X + p, o, "literal", "", "")


def graph(rng):
    out = set()
    for k in range(14):
        if rng.random() < 0.8:
            out.add(iri(f"a{k}", TYPE, "A"))
        out |= {iri(f"a{k}", "to", f"b{rng.randrange(8)}") for _ in range(rng.randrange(3))}
        out |= {text(f"a{k}", "name", rng.choice(["one", "two", "3"])) for _ in range(rng.randrange(3))}
    for k in range(8):
        out.add(iri(f"b{k}", TYPE, rng.choice("BC")))
        if rng.random() < 0.6:
            out.add(text(f"b{k}", "code", rng.choice(["x", "yy"])))
    return out


def altered(rng, triples):
    gone = set(rng.sample(sorted(triples), 4))
    return (triples - gone) | set(rng.sample(sorted(graph(rng)), 4))


SHAPES = [
    Shape(
        target_class=X + "A",
        properties=[
            Property(X + "name", min_count=1, max_count=1, pattern="^[a-z]+$"),
            Property(X + "to", class_=X + "B"),
            Property(X + "to", node=Shape(properties=[Property(X + "code", has_value=literal("x", ""))]), message="nested"),
        ],
        sparql=[("named like a value", "SELECT ?this WHERE { ?this x:name ?n . ?this x:to ?b . ?b x:code 'x' }")],
    ),
    Shape(target_class=X + "B", properties=[Property(X + "to", inverse=True, min_count=1)]),
    Shape(target_nodes=[X + "b0", X + "b1"], class_=X + "C"),
]
PREFIXES = {"x": X}


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_full_run(spark, seed):
    rng = random.Random(seed)
    a = graph(rng)
    b = altered(rng, a)
    before, after = spark.createDataFrame(sorted(a), COLUMNS), spark.createDataFrame(sorted(b), COLUMNS)
    delta = changes.changed(before, after)
    assert {tuple(r) for r in delta.collect()} == a ^ b
    state = changes.validate(SHAPES, before, PREFIXES)
    assert rows(changes.results(changes.revalidate(SHAPES, after, delta, state, PREFIXES))) == rows(changes.results(changes.validate(SHAPES, after, PREFIXES)))


def test_records_are_compared_as_their_triples_are(spark):
    """Views of the same templates: a row for each record is shuffled, and the changed triples are those of the sets."""
    def views(rows, others, **more):
        df, b = spark.createDataFrame(rows, "id string, name string, n int"), spark.createDataFrame(others, "id string, on boolean")
        told = (Emit(X + "name", F.col("name")), Emit(X + "n", F.col("n"), type="int", when=F.col("n") > 0), iri_of(X + "to", F.concat(F.lit(X), F.col("id"))))
        return Graph([View("a", df, F.concat(F.lit(X + "a"), F.col("id")), told, **more), View("b", b, F.concat(F.lit(X + "b"), F.col("id")), (class_of(X + "B", when=F.col("on")),))])

    rows = [("1", "one", 1), ("2", None, 2), ("3", "x", 3), ("4", "x", None), ("5", "gone", 1), (None, "no", 1)]
    new = [("1", "one", 1), ("2", "two", -2), ("3", None, 3), ("4", "y", 4), ("6", "came", 1), (None, "other", 2)]
    sides = [(rows, [("1", True), ("2", False)]), (new, [("1", None), ("2", True), ("3", True)])]
    before, after = (views(*x) for x in sides)
    a, b = ({tuple(r) for r in g.scan().collect()} for g in (before, after))
    got = changes.changed(before, after)
    assert rows_of(got) == sorted(a ^ b) and len(a ^ b) == 15
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 2 and "Aggregate" not in plan
    # what could be there twice is compared triple by triple
    twice = [views(rows * 2, others, key=False) for rows, others in sides]
    assert not changes.alike(*twice) and rows_of(changes.changed(*twice)) == sorted(a ^ b)
    assert not changes.alike(before, before + spark.createDataFrame([], COLUMNS)) and changes.changed(before, before).isEmpty()


def rows_of(df):
    return sorted(map(tuple, df.select(*triples.COLUMNS).collect()))


def test_only_neighbours_are_validated(spark):
    """Of the results before, marked, only those of what a change reaches are made again."""
    a = [iri(f"a{k}", TYPE, "A") for k in range(5)] + [iri(f"a{k}", "to", f"b{k % 2}") for k in range(5)] + [iri("b0", TYPE, "B")]
    b = [t for t in a if t != iri("b0", TYPE, "B")] + [iri("b1", TYPE, "B")]
    shapes = [Shape(target_class=X + "A", properties=[Property(X + "to", class_=X + "B"), Property(X + "name", min_count=1)])]
    before, after = spark.createDataFrame(a, COLUMNS), spark.createDataFrame([t for t in b if t[0] != X + "b1"], COLUMNS)
    state = changes.validate(shapes, before).selectExpr("rule", "focus", "path", "severity", "'old' AS message", "value")
    after_state = changes.revalidate(shapes, after, changes.changed(before, after), state)
    made = {r.focus for r in after_state.where("message != 'old'").collect()}
    assert made == {X + "a0", X + "a2", X + "a4"}
    assert {r.focus for r in after_state.where("message = 'old'").collect()} == {X + "a1", X + "a3"}


def test_no_change_and_a_changed_hierarchy(spark):
    a = [iri("a", TYPE, "A"), iri("a", "to", "b"), iri("b", TYPE, "C")]
    shapes = [Shape(target_class=X + "A", properties=[Property(X + "to", class_=X + "B")])]
    before = spark.createDataFrame(a, COLUMNS)
    state = changes.validate(shapes, before)
    assert rows(changes.revalidate(shapes, before, changes.changed(before, before), state)) == rows(state) != []
    after = spark.createDataFrame([*a, (X + "C", SUB_CLASS, X + "B", "iri", "", "")], COLUMNS)
    assert rows(changes.revalidate(shapes, after, changes.changed(before, after), state)) == []


def test_a_rule_with_a_variable_predicate_looks_at_all():
    assert changes._named("SELECT ?this WHERE { ?this ?p ?o }", PREFIXES) == set()
    assert X + "name" in changes._named("SELECT ?this WHERE { ?this x:name ?o FILTER(?o > 3) }", PREFIXES)
