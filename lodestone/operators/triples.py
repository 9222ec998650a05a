"""Records to triples: template lists, unions of views, subgraphs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"
COLUMNS = ["s", "p", "o", "o_kind", "o_type", "o_lang"]


@dataclass(frozen=True)
class Emit:
    """One template: a predicate and an object; nothing is emitted where the object or `when` is null or false. Arrays emit one triple an element."""

    p: str
    o: Column
    kind: str = "literal"
    type: str | Column = XSD + "string"
    lang: str | Column = ""
    when: Column | None = None
    each: bool = False
    #: the object, where it is the same for all records, and what all objects begin with
    const: str | None = None
    begins: str = ""


def iri(p: str, o: Column, **more) -> Emit:
    return Emit(p, o, "iri", "", **more)


def a(class_: str, when: Column | None = None) -> Emit:
    """The records' class."""
    return Emit(RDF + "type", F.lit(class_), "iri", "", when=when, const=class_)


def column(x: str | Column) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _struct(t: Emit, value: Column) -> Column:
    return F.struct(F.lit(t.p).alias("p"), value.cast("string").alias("o"), F.lit(t.kind).alias("o_kind"), column(t.type).alias("o_type"), column(t.lang).alias("o_lang"))


def _value(t: Emit) -> Column:
    return t.o if t.when is None else F.when(t.when, t.o)


def _emitted(records: DataFrame, subject: Column, templates: list[Emit]) -> DataFrame:
    """The triples of the records as a bag, from one scan; a single template needs no array."""
    if len(templates) == 1 and not templates[0].each:
        t = templates[0]
        values = [F.lit(t.p).alias("p"), _value(t).cast("string").alias("o"), F.lit(t.kind).alias("o_kind"), column(t.type).alias("o_type"), column(t.lang).alias("o_lang")]
        return records.select(subject.alias("s"), *values).where("s IS NOT NULL AND o IS NOT NULL")

    def all_of(t: Emit) -> Column:
        return F.transform(F.coalesce(_value(t), F.array()), lambda x: _struct(t, x)) if t.each else F.array(_struct(t, _value(t)))

    every = F.filter(F.concat(*map(all_of, templates)), lambda x: x["o"].isNotNull())
    return records.select(subject.alias("s"), every.alias("every")).where("s IS NOT NULL").select("s", F.inline("every"))


def project(records: DataFrame, subject: Column, templates: list[Emit]) -> DataFrame:
    """The triples of the records: one scan, one explode, then a set."""
    return _emitted(records, subject, templates).distinct()


# --- graphs that aren't written ------------------------------------------------------------
@dataclass(frozen=True)
class View:
    """Triples that are made of records when they are asked for.

    `kind` names the subjects: views of different kinds have none in common. `key`: each record
    has a subject of its own."""

    kind: str
    records: DataFrame
    subject: Column
    templates: tuple[Emit, ...]
    key: bool = True
    graph: str = ""

    def emits(self, predicates: list[str] | None) -> list[Emit]:
        return [t for t in self.templates if predicates is None or t.p in predicates]

    def answers(self, p: str, o: str | None) -> list[Emit]:
        """Templates that may emit this predicate, with this object if one is given."""
        return [t for t in self.templates if t.p == p and (o is None or t.const in (None, o) and o.startswith(t.begins))]


@dataclass(frozen=True)
class Listed:
    """Triples whose predicates are numbered: they begin with `prefix`."""

    kind: str
    triples: DataFrame
    prefix: str
    graph: str = ""


class Graph:
    """Views and stored triples as one set of triples.

    A scan makes the triples of the predicates asked for only, from the views that have them,
    and a set of them only where something could be there twice. `fold` gives a star of
    predicates on one subject as one projection of its view, without a join."""

    def __init__(self, views: list[View] | None = None, stored: DataFrame | None = None, listed: list[Listed] | None = None):
        if not views and stored is None:
            raise ValueError("a graph needs views or stored triples")
        self.views, self.stored, self.listed = list(views or []), stored, list(listed or [])
        self.sparkSession = (stored if stored is not None else self.views[0].records).sparkSession

    @staticmethod
    def of(triples: "Graph | DataFrame") -> "Graph":
        return triples if isinstance(triples, Graph) else Graph(stored=triples)

    def __add__(self, other: "Graph | DataFrame") -> "Graph":
        other = Graph.of(other)
        stored = [x for x in (self.stored, other.stored) if x is not None]
        return Graph(self.views + other.views, union(*stored) if len(stored) == 2 else stored[0] if stored else None, self.listed + other.listed)

    def scan(self, predicates: list[str] | None = None, graph: str | None = None) -> DataFrame:
        """(s, p, o, o_kind, o_type, o_lang) of these predicates, of one named graph if asked for."""
        parts, twice, seen = [], False, set()
        for v in self.views:
            templates = v.emits(predicates)
            if not templates or graph is not None and v.graph != graph:
                continue
            parts.append(_emitted(v.records, v.subject, templates))
            own = [(v.kind, t.p) for t in templates]
            twice |= not v.key or any(t.each for t in templates) or len(set(own)) < len(own) or bool(seen & set(own))
            seen |= set(own)
        for x in self.listed:
            own = None if predicates is None else [p for p in predicates if p.startswith(x.prefix)]
            if own == [] or graph is not None and x.graph != graph:
                continue
            twice |= any(k == x.kind for k, _ in seen) and own is None
            parts.append((x.triples if own is None else x.triples.where(F.col("p").isin(own))).select(*COLUMNS))
        if self.stored is not None:
            df = self.stored if predicates is None else self.stored.where(F.col("p").isin(predicates) if len(predicates) > 1 else F.col("p") == predicates[0])
            if graph is not None:
                df = df.where(F.col("graph") == graph) if "graph" in df.columns else df.limit(0)
            twice |= bool(parts) or graph is None and "graph" in df.columns
            parts.append(df.select(*COLUMNS))
        if not parts:
            return self.sparkSession.createDataFrame([], ", ".join(f"{c} string" for c in COLUMNS))
        out = parts[0]
        for x in parts[1:]:
            out = out.unionByName(x)
        if twice and (fixed := self.fixed(predicates)) and predicates is not None and len(predicates) == 1:
            # what is the same for all isn't shuffled
            kind, type_, lang = fixed
            return out.select("s", "o").distinct().select("s", F.lit(predicates[0]).alias("p"), "o", F.lit(kind).alias("o_kind"), F.lit(type_).alias("o_type"), F.lit(lang).alias("o_lang"))
        return out.distinct() if twice else out

    def fixed(self, predicates: list[str] | None) -> tuple[str, str, str] | None:
        """Kind, type and language of all objects of these predicates, where views alone make them and they are the same."""
        if self.stored is not None or self.listed:
            return None
        said = {(t.kind, t.type, t.lang) if isinstance(t.type, str) and isinstance(t.lang, str) else None for v in self.views for t in v.emits(predicates)}
        return said.pop() if len(said) == 1 else None

    def graphs(self) -> DataFrame:
        """(graph): the names of the named graphs."""
        own = self.sparkSession.createDataFrame([(g,) for g in sorted({v.graph for v in [*self.views, *self.listed] if v.graph})], "graph string")
        return own.union(self.stored.select("graph").where("graph <> ''").distinct()).distinct() if self.stored is not None and "graph" in self.stored.columns else own

    def fold(self, wanted: list[tuple[str, str | None]]) -> tuple[View, list[int]] | None:
        """Of a star of (predicate, constant object) on one subject: a view, and which of them it alone can answer, each once."""
        if self.stored is not None:
            return None

        def whose(p: str, o: str | None) -> list[View]:
            return [v for v in self.views if v.answers(p, o)]

        if any(p.startswith(x.prefix) for p, _ in wanted for x in self.listed):
            return None
        anchors = [vs[0] for p, o in wanted if len(vs := whose(p, o)) == 1]
        best: tuple[View, list[int]] | None = None
        for v in anchors:
            if not v.key:
                continue
            mine = [k for k, (p, o) in enumerate(wanted) if len(found := v.answers(p, o)) == 1 and not found[0].each and not any(w is not v and w.kind == v.kind for w in whose(p, o))]
            if len(mine) > 1 and (best is None or len(mine) > len(best[1])):
                best = v, mine
        return best


def union(*views: DataFrame) -> DataFrame:
    """Graphs as one set of triples."""
    out = views[0].select(*COLUMNS)
    for v in views[1:]:
        out = out.unionByName(v.select(*COLUMNS))
    return out.distinct()


def ordered_members(records: DataFrame, subject: Column, members: Column, kind: str = "iri") -> DataFrame:
    """The members of a list, rdf:_1 ... rdf:_n in order."""
    rows = records.select(subject.alias("s"), F.posexplode(members).alias("k", "o"))
    return rows.select("s", F.format_string(RDF + "_%d", F.col("k") + 1).alias("p"), F.col("o").cast("string").alias("o"), F.lit(kind).alias("o_kind"), F.lit("" if kind == "iri" else XSD + "string").alias("o_type"), F.lit("").alias("o_lang"))


def ordered_list(records: DataFrame, subject: Column, members: Column, kind: str = "iri") -> DataFrame:
    """An rdf:Seq: its class and its members."""
    seq = ordered_members(records, subject, members, kind)
    head = records.where(F.size(members) > 0).select(subject.alias("s"), F.lit(RDF + "type").alias("p"), F.lit(RDF + "Seq").alias("o"), F.lit("iri").alias("o_kind"), F.lit("").alias("o_type"), F.lit("").alias("o_lang"))
    return seq.unionByName(head)


def resource(term: Column) -> Column:
    """The resource that a subject belongs to: what stands before a fragment."""
    return F.substring_index(term, "#", 1)


def subgraphs(triples: DataFrame) -> DataFrame:
    """Triples with the resource in whose file they belong; write them partitioned by it."""
    return triples.withColumn("resource", resource(F.col("s")))


def neighbourhood(triples: DataFrame, seed: str, reverse: bool = False) -> DataFrame:
    """Edges of one node and of what it points to (with `reverse` also of what points to it)."""
    out = triples.where(F.col("s") == seed)
    nodes = out.where("o_kind = 'iri'").select(F.col("o").alias("node"))
    if reverse:
        back = triples.where((F.col("o") == seed) & (F.col("o_kind") == "iri"))
        out, nodes = out.unionByName(back), nodes.unionByName(back.select(F.col("s").alias("node")))
    return out.unionByName(triples.join(nodes.distinct(), triples["s"] == F.col("node"), "left_semi")).distinct()


def described(triples: DataFrame, label: str, captions: int = 2) -> DataFrame:
    """For each subject its first label and its first types in string order."""
    return triples.groupBy("s").agg(F.min(F.when(F.col("p") == label, F.col("o"))).alias("label"), F.slice(F.sort_array(F.collect_set(F.when(F.col("p") == RDF + "type", F.col("o")))), 1, captions).alias("types"))


def known_terms(triples: DataFrame) -> DataFrame:
    """Every IRI in any position, datatypes included."""
    parts = [triples.select(F.col("s").alias("term")), triples.select(F.col("p").alias("term")), triples.where("o_kind = 'iri'").select(F.col("o").alias("term")), triples.where("o_kind = 'literal' AND o_type <> ''").select(F.col("o_type").alias("term"))]
    out = parts[0]
    for x in parts[1:]:
        out = out.union(x)
    return out.distinct()


def predicate_counts(triples: DataFrame) -> DataFrame:
    return triples.groupBy("p").agg(F.count("*").alias("n"))


def prefix_numbers(triples: DataFrame, bound: dict[str, str]) -> DataFrame:
    """Invented prefixes ns01, ns02, ... for the namespaces of predicates and classes that have none, in the order of their IRIs."""
    from pyspark.sql import Window

    terms = triples.select(F.col("p").alias("t")).union(triples.where(F.col("p") == RDF + "type").select(F.col("o").alias("t")))
    spaces = terms.select(F.regexp_extract("t", "^(.*[#/])[^#/]*$", 1).alias("namespace")).where("namespace <> ''").distinct()
    free = spaces.where(~F.col("namespace").isin(list(bound.values()))) if bound else spaces
    # namespaces are few: a schema's, not the data's
    return free.select("namespace", F.format_string("ns%02d", F.row_number().over(Window.orderBy("namespace"))).alias("prefix"))
