"""SHACL constraints as set-based queries.

Each constraint component yields its violations as rows (focus, path, severity, message,
value); a shape is a list of them over a set of focus nodes. Nothing is evaluated node by node:
counts are grouped, membership is an anti-join, a SPARQL constraint is compiled with $this
joined to the focus set.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import sparql
from . import orbits

from .triples import Graph

RDF_TYPE = sparql.RDF_TYPE
SUB_CLASS = "http://www.w3.org/2000/01/rdf-schema#subClassOf"
RESULT = ["focus", "path", "severity", "message", "value"]


@dataclass(frozen=True)
class Term:
    """An RDF term as a value to compare with: kind, datatype and language count."""

    value: str
    kind: str = "iri"
    type: str = ""
    lang: str = ""


def literal(value: str, type: str = sparql.XSD + "string", lang: str = "") -> Term:
    return Term(value, "literal", type, lang)


@dataclass
class Property:
    """Constraints on the values of a path (a predicate; inverse: towards the focus)."""

    path: str
    inverse: bool = False
    min_count: int | None = None
    max_count: int | None = None
    class_: str | None = None
    datatype: str | None = None
    node_kind: str | None = None
    pattern: str | None = None
    min_length: int | None = None
    in_: list[Term] | None = None
    has_value: Term | None = None
    or_datatypes: list[str] | None = None
    or_classes: list[str] | None = None
    language_in: list[str] | None = None
    unique_lang: bool = False
    node: "Shape | None" = None
    severity: str = "Violation"
    message: str = ""


@dataclass
class Shape:
    target_class: str | None = None
    target_nodes: list[str] | None = None
    properties: list[Property] = field(default_factory=list)
    pattern: str | None = None
    node_kind: str | None = None
    class_: str | None = None
    sparql: list[tuple[str, str]] = field(default_factory=list)  # (message, SELECT with $this)
    id: str = ""
    severity: str = "Violation"
    message: str = ""


def class_closure(triples: Graph | DataFrame) -> DataFrame | None:
    """(sub, super) along rdfs:subClassOf, without a class itself; None where no class has a superclass."""
    edges = Graph.of(triples).scan([SUB_CLASS]).select(F.col("s").alias("a"), F.col("o").alias("b")).distinct()
    if edges.isEmpty():
        return None
    return orbits.closure(edges).select(F.col("a").alias("sub"), F.col("b").alias("super"))


#: Pairs of a class and one below it that are told to scans as constants; more are joined.
FEW_CLASSES = 1000


def classes_below(closure: DataFrame | None) -> dict[str, list[str]] | None:
    """Each class with those below it, where they're few enough to be told to a scan; else None."""
    if closure is None:
        return {}
    rows = closure.limit(FEW_CLASSES + 1).collect()
    if len(rows) > FEW_CLASSES:
        return None
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r["super"], []).append(r["sub"])
    return out


def instances(triples: Graph | DataFrame, class_: str, closure: DataFrame | None = None, below: dict[str, list[str]] | None = None) -> DataFrame:
    """(node) of a class or of one below it."""
    typed = Graph.of(triples).scan([RDF_TYPE])
    known = classes_below(closure) if below is None else below
    if known is not None:
        below = known.get(class_, [])
        of = typed.where(F.col("o").isin([class_, *below]) if below else F.col("o") == class_).select(F.col("s").alias("node"))
        # a scan is a set: where types are all of one kind, a node has one class once
        return of if not below and Graph.of(triples).fixed([RDF_TYPE]) else of.distinct()
    every = closure.where(F.col("super") == class_).select("sub").union(closure.sparkSession.createDataFrame([(class_,)], "sub string"))
    return typed.join(every, F.col("o") == F.col("sub"), "left_semi").select(F.col("s").alias("node")).distinct()


class Validator:
    def __init__(self, triples: Graph | DataFrame, prefixes: dict[str, str] | None = None, closure: DataFrame | None = None):
        self.triples, self.prefixes = Graph.of(triples), prefixes or {}
        self.closure = closure if closure is not None else class_closure(self.triples)
        self.below = classes_below(self.closure)

    def focus(self, shape: Shape) -> DataFrame:
        parts = []
        if shape.target_class:
            parts.append(self.instances(shape.target_class))
        if shape.target_nodes:
            parts.append(self.triples.sparkSession.createDataFrame([(n,) for n in shape.target_nodes], "node string"))
        if not parts:
            raise ValueError("a shape needs a target")
        return parts[0] if len(parts) == 1 else parts[0].union(parts[1]).distinct()

    def validate(self, shapes: list[Shape]) -> DataFrame:
        """The set of results of all shapes."""
        out = None
        for shape in shapes:
            now = self.shape(shape, self.focus(shape))
            out = now if out is None else out.unionByName(now)
        return out.distinct()

    def shape(self, shape: Shape, focus: DataFrame) -> DataFrame:
        """The results of a shape on its focus nodes (node)."""
        parts = []
        forward, others = [p for p in shape.properties if not p.inverse], [p for p in shape.properties if p.inverse]
        if forward:
            parts += self.together(forward, self.values(forward, focus), focus)
        for p in others:
            parts += self.together([p], self.values([p], focus), focus)
        if shape.pattern:
            parts.append(self.rows(focus.where(~F.col("node").rlike(shape.pattern)), "", shape.severity, shape.message or "pattern", F.col("node")))
        if shape.node_kind:
            parts.append(self.rows(focus.where(~self.is_iri(shape.node_kind)), "", shape.severity, shape.message or "nodeKind", F.col("node")))
        if shape.class_:
            members = self.instances(shape.class_)
            parts.append(self.rows(focus.join(members, "node", "left_anti"), "", shape.severity, shape.message or "class", F.col("node")))
        parts += [self.select(message, text, focus, shape.severity) for message, text in shape.sparql]
        if not parts:
            return self.rows(focus.limit(0), "", shape.severity, "", F.lit(None))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def instances(self, class_: str) -> DataFrame:
        return instances(self.triples, class_, self.closure, self.below)

    @staticmethod
    def rows(df: DataFrame, path: str, severity: str, message: str | Column, value: Column) -> DataFrame:
        said = message if isinstance(message, Column) else F.lit(message)
        return df.select(F.col("node").alias("focus"), F.lit(path).alias("path"), F.lit(severity).alias("severity"), said.alias("message"), F.coalesce(value.cast("string"), F.lit("")).alias("value"))

    @staticmethod
    def is_iri(kind: str) -> Column:
        """Does a node that isn't a literal fit the kind? Names of blank nodes begin with "_:"."""
        blank = F.startswith(F.col("node"), F.lit("_:"))
        return (blank & F.lit("Blank" in kind)) | (~blank & F.lit("IRI" in kind))

    @staticmethod
    def equal(t: Term) -> Column:
        return (F.col("o") == t.value) & (F.col("o_kind") == t.kind) & (F.lit(t.kind == "iri") | (F.col("o_type") == t.type) & (F.col("o_lang") == t.lang))

    def values(self, properties: list[Property], focus: DataFrame) -> DataFrame:
        """(node, p, o, o_kind, o_type, o_lang) of the properties' paths, all forward or all inverse, from one scan."""
        t = self.triples.scan(sorted({p.path for p in properties}))
        if properties[0].inverse:
            t = t.where("o_kind = 'iri'").select(F.col("o").alias("s"), "p", F.col("s").alias("o"), F.lit("iri").alias("o_kind"), F.lit("").alias("o_type"), F.lit("").alias("o_lang"))
        return t.join(focus, t["s"] == focus["node"]).select("node", "p", "o", "o_kind", F.coalesce("o_type", F.lit("")).alias("o_type"), F.coalesce("o_lang", F.lit("")).alias("o_lang"))

    def by_value(self, p: Property) -> list[tuple[str, Column]]:
        """Constraints that look at one value: (name, is the value bad)."""
        literal, o = F.col("o_kind") == "literal", F.col("o")
        out = []
        if p.datatype:
            out.append(("datatype", ~(literal & (F.col("o_type") == p.datatype))))
        if p.or_datatypes and not p.or_classes:
            out.append(("or", ~(literal & F.col("o_type").isin(p.or_datatypes))))
        if p.node_kind:
            blank = F.startswith(o, F.lit("_:"))
            out.append(("nodeKind", ~F.when(literal, F.lit("Literal" in p.node_kind)).when(blank, F.lit("Blank" in p.node_kind)).otherwise(F.lit("IRI" in p.node_kind))))
        if p.pattern:
            out.append(("pattern", ~o.rlike(p.pattern)))
        if p.min_length is not None:
            out.append(("minLength", F.length(o) < p.min_length))
        if p.in_ is not None:
            among = F.lit(False)
            for x in p.in_:
                among = among | self.equal(x)
            out.append(("in", ~among))
        if p.language_in is not None:
            # a range also admits its regions: "en" fits "en-GB"
            spoken = F.lit(False)
            for x in p.language_in:
                spoken = spoken | (F.lower("o_lang") == x.lower()) | F.startswith(F.lower("o_lang"), F.lit(x.lower() + "-"))
            out.append(("languageIn", ~(literal & spoken)))
        return out

    def together(self, properties: list[Property], v: DataFrame, focus: DataFrame) -> list[DataFrame]:
        """Results of several properties on their values: what looks at one value from one scan, what counts from one aggregate, the rest by joins."""
        out: list[DataFrame] = []

        def found(p: Property, what: str, bad: Column, value: Column) -> Column:
            return F.when(bad, F.struct(F.lit(p.path).alias("path"), F.lit(p.severity).alias("severity"), F.lit(p.message or what).alias("message"), F.coalesce(value.cast("string"), F.lit("")).alias("value")))

        def told(df: DataFrame, cases: list[Column]) -> None:
            if cases:
                rows = df.select(F.col("node").alias("focus"), F.explode(F.array_compact(F.array(*cases))).alias("x"))
                out.append(rows.select("focus", "x.path", "x.severity", "x.message", "x.value"))

        of = lambda p: F.col("p") == p.path
        told(v, [found(p, what, of(p) & bad, F.col("o")) for p in properties for what, bad in self.by_value(p)])
        # counts, of nodes without values too
        counts, cases = [], []
        for k, p in enumerate(properties):
            n = F.coalesce(F.col(f"n{k}"), F.lit(0))
            if p.min_count is not None or p.max_count is not None:
                counts.append(F.count_if(of(p)).alias(f"n{k}"))
            if p.min_count is not None:
                cases.append(found(p, "minCount", n < p.min_count, F.lit(None)))
            if p.max_count is not None:
                cases.append(found(p, "maxCount", n > p.max_count, F.lit(None)))
            if p.has_value is not None:
                counts.append(F.count_if(of(p) & self.equal(p.has_value)).alias(f"h{k}"))
                cases.append(found(p, "hasValue", F.coalesce(F.col(f"h{k}"), F.lit(0)) == 0, F.lit(None)))
        if counts:
            told(focus.join(v.groupBy("node").agg(*counts), "node", "left"), cases)
        if unique := [p for p in properties if p.unique_lang]:
            twice = v.where((F.col("o_lang") != "") & F.col("p").isin([p.path for p in unique])).groupBy("node", "p", "o_lang").agg(F.count("*").alias("n")).where("n > 1")
            told(twice, [found(p, "uniqueLang", of(p), F.lit(None)) for p in unique])
        literal = F.col("o_kind") == "literal"
        for p in properties:
            own = v.where(of(p))
            bad = lambda df, what, p=p: out.append(self.rows(df, p.path, p.severity, p.message or what, F.col("o")))
            if p.class_:
                members = self.instances(p.class_).withColumnRenamed("node", "member")
                bad(own.join(members, (F.col("o") == F.col("member")) & ~literal, "left_anti"), "class")
            if p.or_classes:
                rest = own.where(~(literal & F.col("o_type").isin(p.or_datatypes or [])))
                for c in p.or_classes:
                    members = self.instances(c).withColumnRenamed("node", "member")
                    rest = rest.join(members, (F.col("o") == F.col("member")) & ~literal, "left_anti")
                bad(rest, "or")
            if p.node is not None:
                nested = self.shape(p.node, own.where(~literal).select(F.col("o").alias("node")).distinct()).select(F.col("focus").alias("o")).distinct()
                bad(own.join(nested, "o", "left_semi").select(own.columns).unionByName(own.where(literal)), "node")
        return out

    def select(self, message: str, text: str, focus: DataFrame, severity: str) -> DataFrame:
        """Solutions of a SELECT, with $this joined to the focus set: none is run node by node. Where no pattern binds $this, each solution holds for each focus node."""
        found = sparql.query(self.triples, text, self.prefixes)
        if "this" in sparql.variables(sparql.parse(text, self.prefixes).where):
            joined = found.join(focus, found["this"] == focus["node"])
        else:
            joined = found.crossJoin(F.broadcast(focus)) if focus.limit(FEW_CLASSES + 1).count() <= FEW_CLASSES else found.crossJoin(focus)
        value = F.col("value") if "value" in found.columns else F.lit(None)
        # {?value} and {$this} in a message stand for the solution's terms
        said = F.replace(F.replace(F.lit(message), F.lit("{?value}"), F.coalesce(value.cast("string"), F.lit(""))), F.lit("{$this}"), F.col("node"))
        return self.rows(joined, "", severity, said, value)


def without_dangling(references: DataFrame, properties: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(references to properties that have a path, those that have none)."""
    key = references["property"] == properties["id"]
    return references.join(properties, key, "left_semi"), references.join(properties, key, "left_anti")


def silent(expected: DataFrame, results: DataFrame) -> DataFrame:
    """Paths that a self-test expected to fail and that didn't: the rules that are silent."""
    return expected.join(results, expected["path"] == results["path"], "left_anti")


def histogram(results: DataFrame) -> DataFrame:
    """Results by severity."""
    return results.groupBy("severity").agg(F.count("*").alias("n"))


def grouped(results: DataFrame) -> DataFrame:
    """Results by (severity, path, message) with a number and the least focus as an example."""
    return results.groupBy("severity", "path", "message").agg(F.count("*").alias("n"), F.min("focus").alias("example"))


def listing(shapes: list[Shape]) -> list[tuple[str, str, list[str]]]:
    """(target, constraints, messages) of shapes for readers: messages where there are any, else counts in words."""
    out = []
    for s in shapes:
        target = s.target_class or ", ".join(s.target_nodes or [])
        words = [f"{p.path}: " + (f"at least {p.min_count}" if p.min_count is not None else "") + (" and " if p.min_count is not None and p.max_count is not None else "") + (f"at most {p.max_count}" if p.max_count is not None else "") for p in s.properties if p.min_count is not None or p.max_count is not None]
        messages = sorted({p.message for p in s.properties if p.message} | {m for m, _ in s.sparql} | ({s.message} if s.message else set()))
        out.append((target, f"{len(s.properties)} properties, {len(s.sparql)} rules", messages or words))
    return out
