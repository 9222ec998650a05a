"""Validation after a change: only focus nodes that a changed triple can reach are validated anew.

A state holds the results of each rule: (rule, focus, path, severity, message, value). A rule is the
constraints of a shape on its nodes and properties, or one of its SPARQL constraints. What a changed
triple (added or removed) reaches through a shape's paths: its subject, for a property of the
subject and for its types; its object, for an inverse property; and where the type of a value changed,
or something that a nested shape looks at, the nodes that have this value. Results of these nodes are dropped
and made again, all others stay, so the result equals that of a full run.

A change of rdfs:subClassOf makes all rules run anew. A SPARQL constraint can look anywhere: it
runs anew, over all its focus nodes, if a predicate named in it or a type has changed, or if one of its
predicates is a variable.
An empty set of changes keeps the state; changes that are null in s or p are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import sparql
from ..plans.shared import stored
from .shacl import RDF_TYPE, RESULT, SUB_CLASS, Property, Shape, Validator
from .triples import COLUMNS, Graph, View, _value

STATE = "rule int, focus string, path string, severity string, message string, value string"


def changed(before: Graph | DataFrame, after: Graph | DataFrame) -> DataFrame:
    """Triples that are in one of two sets only. Views of the same kinds and templates are compared record by record,
    each record's objects in a row and without what is the same for all; other triples from one shuffle of them all."""
    before, after = Graph.of(before), Graph.of(after)
    if alike(before, after):
        return _union([_of_records(v, w) for v, w in zip(before.views, after.views)])
    side = lambda g, n: g.scan().select(*[F.coalesce(c, F.lit("")).alias(c) for c in COLUMNS], F.lit(n).alias("side"))
    both = side(before, 1).unionByName(side(after, 2)).groupBy(COLUMNS).agg(F.bit_or("side").alias("side"))
    return both.where("side != 3").drop("side")


def alike(before: Graph, after: Graph) -> bool:
    """Are both graphs made of the same kinds of records with the same predicates, each once, so that a subject and a predicate have one object at most?"""

    def said(g: Graph) -> list[list] | None:
        if g.stored is not None or g.listed or len({v.kind for v in g.views}) < len(g.views):
            return None
        for v in g.views:
            if not v.key or len({t.p for t in v.templates}) < len(v.templates) or any(t.each or not (isinstance(t.type, str) and isinstance(t.lang, str)) for t in v.templates):
                return None
        return [[v.kind, *[(t.p, t.kind, t.type, t.lang) for t in v.templates]] for v in g.views]

    return (of := said(before)) is not None and of == said(after)


def _of_records(v: View, w: View) -> DataFrame:
    """The triples in which the records of two views of one kind differ."""
    told = lambda x, side: x.records.select(x.subject.alias(f"s{side}"), *[_value(t).cast("string").alias(f"o{side}{k}") for k, t in enumerate(x.templates)]).where(f"s{side} IS NOT NULL")
    both = told(v, "a").join(told(w, "b"), F.col("sa") == F.col("sb"), "full")
    differs = [~F.col(f"oa{k}").eqNullSafe(F.col(f"ob{k}")) for k in range(len(v.templates))]
    triple = lambda t, o: F.when(o.isNotNull(), F.struct(F.lit(t.p).alias("p"), o.alias("o"), F.lit(t.kind).alias("o_kind"), F.lit(t.type).alias("o_type"), F.lit(t.lang).alias("o_lang")))
    cases = [F.when(d, triple(t, F.col(f"o{side}{k}"))) for k, (t, d) in enumerate(zip(v.templates, differs)) for side in "ab"]
    rows = both.where(reduce(or_, differs)).select(F.coalesce("sa", "sb").alias("s"), F.array_compact(F.array(*cases)).alias("every"))
    return rows.select("s", F.inline("every"))


def rules(shapes: list[Shape]) -> list[tuple[int, Shape]]:
    """Each shape without its SPARQL constraints, and each of these alone, numbered."""
    out = []
    for s in shapes:
        same = {"target_class": s.target_class, "target_nodes": s.target_nodes, "id": s.id, "severity": s.severity}
        if s.properties or s.pattern or s.node_kind or s.class_:
            out.append(Shape(**same, properties=s.properties, pattern=s.pattern, node_kind=s.node_kind, class_=s.class_, message=s.message))
        out += [Shape(**same, sparql=[rule]) for rule in s.sparql]
    return list(enumerate(out))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def touched(shape: Shape, graph: Graph, delta: DataFrame) -> DataFrame:
    """(node): focus nodes whose results under the shape's own constraints the changes can alter; more nodes are no harm."""
    typed = delta.where(F.col("p") == RDF_TYPE).select(F.col("s").alias("node"))
    parts = [typed]
    forward, inverse = sorted({p.path for p in shape.properties if not p.inverse}), sorted({p.path for p in shape.properties if p.inverse})
    if forward:
        parts.append(delta.where(F.col("p").isin(forward)).select(F.col("s").alias("node")))
    if inverse:
        parts.append(delta.where(F.col("p").isin(inverse) & (F.col("o_kind") == "iri")).select(F.col("o").alias("node")))
    for p in shape.properties:
        if p.class_ or p.or_classes:
            parts.append(_holders(p, graph, typed))
        if p.node is not None:
            parts.append(_holders(p, graph, touched(p.node, graph, delta)))
    return _union(parts).distinct()


def _holders(p: Property, graph: Graph, values: DataFrame) -> DataFrame:
    """(node): what has one of these values on the property's path. A link that is gone is a change of its own."""
    links = graph.scan([p.path]).where("o_kind = 'iri'")
    node, value = ("o", "s") if p.inverse else ("s", "o")
    return links.join(values.distinct(), F.col(value) == F.col("node"), "left_semi").select(F.col(node).alias("node"))


def _told(rule: int, results: DataFrame) -> DataFrame:
    return results.distinct().select(F.lit(rule).alias("rule"), *RESULT)


def validate(shapes: list[Shape], graph: Graph | DataFrame, prefixes: dict[str, str] | None = None) -> DataFrame:
    """The state of a full run."""
    v = Validator(graph, prefixes)
    return _union([_told(k, v.shape(s, v.focus(s))) for k, s in rules(shapes)])


def revalidate(shapes: list[Shape], graph: Graph | DataFrame, delta: DataFrame, state: DataFrame, prefixes: dict[str, str] | None = None) -> DataFrame:
    """The state after the changes `delta` (triples added or removed) that led to `graph`, from the state before.

    Only the set of changed predicates comes to the driver; it is a schema's, not the data's."""
    graph = Graph.of(graph)
    delta = stored(delta.where("s IS NOT NULL AND p IS NOT NULL").select(*COLUMNS), "changes")
    predicates = {r.p for r in delta.select("p").distinct().toLocalIterator()}
    if not predicates:
        return state.select("rule", *RESULT)
    if SUB_CLASS in predicates:
        return validate(shapes, graph, prefixes)
    v, parts, whole = Validator(graph, prefixes), [], []
    reached = []
    for k, s in rules(shapes):
        if s.sparql:
            named = _named(s.sparql[0][1], prefixes or {})
            if not named or named & predicates or RDF_TYPE in predicates:
                whole.append(k)
                parts.append(_told(k, v.shape(s, v.focus(s))))
            continue
        if not _looks_at(s) & predicates:
            continue
        nodes = stored(touched(s, graph, delta), "touched")
        reached.append(nodes.select(F.lit(k).alias("rule"), F.col("node").alias("focus")))
        parts.append(_told(k, v.shape(s, v.focus(s).join(nodes, "node", "left_semi"))))
    kept = state.select("rule", *RESULT)
    if whole:
        kept = kept.where(~F.col("rule").isin(whole))
    if reached:
        kept = kept.join(_union(reached), ["rule", "focus"], "left_anti")
    return _union([kept.select("rule", *RESULT), *parts])


def _looks_at(s: Shape) -> set[str]:
    """Predicates that a shape's own constraints depend on."""
    out = {RDF_TYPE}
    for p in s.properties:
        out |= {p.path} | (_looks_at(p.node) if p.node is not None else set())
    return out


def _named(text: str, prefixes: dict[str, str]) -> set[str]:
    """IRIs that stand in a query; none where a predicate is a variable, as nothing is then known of what it looks at."""
    found, todo = set(), [sparql.parse(text, prefixes)]
    while todo:
        x = todo.pop()
        if isinstance(x, sparql.Triple) and isinstance(x.p, sparql.Var):
            return set()
        if isinstance(x, str):
            found.add(x)
        elif isinstance(x, dict):
            todo += [*x.keys(), *x.values()]
        elif isinstance(x, (list, tuple)):
            todo += x
        elif hasattr(x, "__dict__"):
            todo += vars(x).values()
    return found


def results(state: DataFrame) -> DataFrame:
    """The set of results of a state, without their rules."""
    return state.select(*RESULT).distinct()
