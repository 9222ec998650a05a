"""SPARQL SELECT, ASK and CONSTRUCT on a graph of triples, compiled to DataFrames.

text -> tokens -> a small algebra -> DataFrame calls; Catalyst does the rest. A variable is up
to four columns: its lexical value, and kind, datatype and language where it may be a literal.
A variable that stands for subjects or predicates is an IRI and needs the value alone, so joins
on subjects compare one string. Basic graph patterns are ordered before compiling: constant
terms first, then patterns connected with what is bound, by the counts of their predicates
where those are given. A pattern that binds nothing new becomes a semi-join; an alternative of
predicates one scan with IN. Where the graph is made of views of records, only the triples of
the predicates asked for are made, and a star on one subject is one projection of its records.

EXISTS is Spark's own correlated subquery, wherever it stands; a filter inside may use
variables from outside. A variable that an OPTIONAL or BIND may have left unbound is
compatible with any value when joined on: each side is parted by what it binds, and the parts
are joined on what both bind; only rows that bind nothing in common meet as a product.
A path from or to a given term is searched from there; without one all pairs are made, by doubling.

Not supported, and refused: SERVICE, DESCRIBE, blank nodes, variables from outside below the
first level of an EXISTS. Transitive paths (+, *) take one predicate. Patterns without a common
variable are multiplied, as SPARQL means it; `product_rows` bounds the smaller side of that.
"""

from __future__ import annotations

import functools
import itertools
import operator
import re
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import orbits
from ..operators.triples import Graph, column

#: Rows of a side that may be broadcast in a join with many pairs, and rows of the other from which it is dealt anew.
BROADCAST_ROWS, SPREAD_ROWS = 200_000, 10_000
#: Slices of the broadcast side at most; rows of one key that are paired together, and rows that a task pairs, about; rows of a tile beyond which there are no tiles.
SLICES, TILE, TASK_ROWS, MOST_IN_TILE = 5, 64, 16_384, 4_096

XSD = "http://www.w3.org/2001/XMLSchema#"
LANG_STRING = "http://www.w3.org/1999/02/22-rdf-syntax-ns#langString"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
INTEGERS = [XSD + t for t in ("integer", "long", "int", "short", "byte", "positiveInteger", "nonNegativeInteger")]
NUMERIC = [XSD + t for t in ("integer", "decimal", "double", "float", "long", "int", "short", "byte", "positiveInteger", "nonNegativeInteger")]


class SparqlError(ValueError):
    pass


# --- algebra ------------------------------------------------------------------------------
@dataclass(frozen=True)
class Var:
    name: str


@dataclass(frozen=True)
class Iri:
    value: str


@dataclass(frozen=True)
class Literal:
    value: str
    type: str = XSD + "string"
    lang: str = ""


@dataclass
class Path:
    """op: "iri", "alt", "seq", "inv", "plus", "star"."""

    op: str
    parts: list
    name: str = ""


@dataclass
class Triple:
    s: object
    p: object
    o: object


@dataclass
class Expr:
    op: str
    args: list
    extra: dict = field(default_factory=dict)


@dataclass
class Group:
    """Elements in order: Triple, ("optional", Group), ("filter", Expr), ("bind", Expr, name), ("union", [Group]), ("minus", Group), ("values", names, rows), ("select", Select), ("graph", term, Group), Group."""

    parts: list


@dataclass
class Select:
    items: list  # (Expr or Var, name); empty for *
    distinct: bool
    where: Group
    group: list  # (Expr or Var, name)
    having: list
    order: list  # (Expr, ascending)
    limit: int | None
    offset: int | None
    #: "select", "ask" or "construct", and the triples of the last
    form: str = "select"
    template: list = field(default_factory=list)


# --- text to algebra ----------------------------------------------------------------------
_TOKEN = re.compile(
    r"""\s+|\#[^\n]*|(?P<iri><[^<>"{}|^`\\\s]*>)|(?P<var>[?$]\w+)|(?P<string>\"\"\"(?:[^\\]|\\.)*?\"\"\"|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)"""
    r"""|(?P<number>\d+\.\d+(?:[eE][+-]?\d+)?|\d+(?:[eE][+-]?\d+)?)|(?P<name>[A-Za-z_][\w.-]*?:[\w.-]*[\w-]|[A-Za-z_][\w-]*:|:[\w-]+)|(?P<word>[A-Za-z_]\w*)|(?P<op>\^\^|\|\||&&|!=|<=|>=|[{}()\[\].;,=<>!+\-*/|^])""",
    re.S,
)
_AGGREGATES = {"COUNT", "SUM", "MIN", "MAX", "AVG", "SAMPLE", "GROUP_CONCAT"}


def tokenise(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise SparqlError(f"unexpected text at {text[at : at + 20]!r}")
        at = m.end()
        if m.lastgroup:
            out.append((m.lastgroup, m[0]))
    return [*out, ("end", "")]


class Parser:
    def __init__(self, text: str, prefixes: dict[str, str] | None = None):
        self.tokens, self.at, self.prefixes, self.fresh = tokenise(text), 0, dict(prefixes or {}), 0

    # helpers
    def peek(self, k: int = 0) -> tuple[str, str]:
        return self.tokens[min(self.at + k, len(self.tokens) - 1)]

    def take(self) -> tuple[str, str]:
        self.at += 1
        return self.tokens[self.at - 1]

    def word(self, *words: str) -> bool:
        kind, text = self.peek()
        if kind == "word" and text.upper() in words:
            self.at += 1
            return True
        return False

    def op(self, *ops: str) -> str:
        kind, text = self.peek()
        if kind == "op" and text in ops:
            self.at += 1
            return text
        return ""

    def need(self, text: str) -> None:
        if not (self.op(text) or self.word(text)):
            raise SparqlError(f"expected {text}, found {self.peek()[1]!r}")

    def iri(self, kind: str, text: str) -> Iri:
        if kind == "iri":
            return Iri(text[1:-1])
        prefix, _, local = text.partition(":")
        if prefix not in self.prefixes:
            raise SparqlError(f"unknown prefix {prefix}:")
        return Iri(self.prefixes[prefix] + local)

    # query
    def query(self) -> Select:
        while self.word("PREFIX"):
            name = self.take()[1]
            self.prefixes[name.rstrip(":")] = self.take()[1][1:-1]
        if self.word("ASK"):
            self.word("WHERE")
            out = Select([], False, self.group(), [], [], [], 1, None, "ask")
        elif self.word("CONSTRUCT"):
            self.need("{")
            template = []
            while not self.op("}"):
                if not self.op("."):
                    template += self.triples()
            self.word("WHERE")
            out = self.modifiers(Select([], False, self.group(), [], [], [], None, None, "construct", template))
        else:
            out = self.select()
        if self.peek()[0] != "end":
            raise SparqlError(f"unexpected {self.peek()[1]!r} after the query")
        return out

    def select(self) -> Select:
        self.need("SELECT")
        distinct = self.word("DISTINCT")
        items = []
        if not self.op("*"):
            while True:
                if self.peek()[0] == "var":
                    name = self.take()[1][1:]
                    items.append((Var(name), name))
                elif self.op("("):
                    e = self.expr()
                    self.need("AS")
                    items.append((e, self.take()[1][1:]))
                    self.need(")")
                else:
                    break
            if not items:
                raise SparqlError("nothing is selected")
        self.word("WHERE")
        return self.modifiers(Select(items, distinct, self.group(), [], [], [], None, None))

    def modifiers(self, out: Select) -> Select:
        group, having, order, limit, offset = [], [], [], None, None
        if self.word("GROUP"):
            self.need("BY")
            while True:
                if self.peek()[0] == "var":
                    name = self.take()[1][1:]
                    group.append((Var(name), name))
                elif self.op("("):
                    e = self.expr()
                    name = self.take()[1][1:] if self.word("AS") else self.new()
                    group.append((e, name))
                    self.need(")")
                else:
                    break
        if self.word("HAVING"):
            while self.peek() == ("op", "("):
                having.append(self.primary())
        if self.word("ORDER"):
            self.need("BY")
            while True:
                if self.word("ASC", "DESC"):
                    up = self.tokens[self.at - 1][1].upper() == "ASC"
                    order.append((self.primary(), up))
                elif self.peek()[0] == "var" or self.peek() == ("op", "(") or self.peek()[0] == "name" or self.peek()[0] == "word" and self.peek()[1].upper() not in ("LIMIT", "OFFSET", "VALUES"):
                    order.append((self.primary(), True))
                else:
                    break
        for _ in range(2):
            if self.word("LIMIT"):
                limit = int(self.take()[1])
            elif self.word("OFFSET"):
                offset = int(self.take()[1])
        return replace(out, group=group, having=having, order=order, limit=limit, offset=offset)

    def new(self) -> str:
        self.fresh += 1
        return f".{self.fresh}"

    # patterns
    def group(self) -> Group:
        self.need("{")
        parts: list = []
        if self.peek()[0] == "word" and self.peek()[1].upper() == "SELECT":
            parts.append(("select", self.select()))
            self.need("}")
            return Group(parts)
        while not self.op("}"):
            if self.op("."):
                continue
            if self.word("OPTIONAL"):
                parts.append(("optional", self.group()))
            elif self.word("MINUS"):
                parts.append(("minus", self.group()))
            elif self.word("FILTER"):
                parts.append(("filter", self.primary()))
            elif self.word("BIND"):
                self.need("(")
                e = self.expr()
                self.need("AS")
                parts.append(("bind", e, self.take()[1][1:]))
                self.need(")")
            elif self.word("VALUES"):
                parts.append(self.values())
            elif self.word("GRAPH"):
                parts.append(("graph", self.term(), self.group()))
            elif self.word("SERVICE"):
                raise SparqlError("SERVICE isn't supported: nothing is fetched from elsewhere")
            elif self.peek() == ("op", "{"):
                branches = [self.group()]
                while self.word("UNION"):
                    branches.append(self.group())
                parts.append(("union", branches) if len(branches) > 1 else branches[0])
            else:
                parts += self.triples()
        return Group(parts)

    def values(self) -> tuple:
        many = bool(self.op("("))
        names = []
        while self.peek()[0] == "var":
            names.append(self.take()[1][1:])
            if not many:
                break
        if many:
            self.need(")")
        self.need("{")
        rows = []
        while not self.op("}"):
            row = []
            if many:
                self.need("(")
            while len(row) < len(names):
                row.append(None if self.word("UNDEF") else self.term())
            if many:
                self.need(")")
            rows.append(row)
        return "values", names, rows

    def term(self):
        kind, text = self.take()
        if kind == "var":
            return Var(text[1:])
        if kind in ("iri", "name"):
            return self.iri(kind, text)
        if kind == "string":
            quote = 3 if text.startswith('"""') else 1
            value = re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t", "r": "\r"}.get(m[1], m[1]), text[quote:-quote])
            if self.peek()[0] == "lang":
                return Literal(value, "http://www.w3.org/1999/02/22-rdf-syntax-ns#langString", self.take()[1][1:].lower())
            if self.op("^^"):
                return Literal(value, self.iri(*self.take()).value)
            return Literal(value)
        if kind == "number":
            return Literal(text, XSD + ("double" if "e" in text.lower() else "decimal" if "." in text else "integer"))
        if kind == "word" and text.lower() in ("true", "false"):
            return Literal(text.lower(), XSD + "boolean")
        raise SparqlError(f"a term was expected, found {text!r}")

    def triples(self) -> list[Triple]:
        s, out = self.term(), []
        while True:
            p = Var(self.take()[1][1:]) if self.peek()[0] == "var" else self.path()
            while True:
                out.append(Triple(s, p, self.term()))
                if not self.op(","):
                    break
            more = False
            while self.op(";"):
                more = True
            if not more or self.peek()[1] in (".", "}"):
                return out

    def path(self) -> Path:
        parts = [self.sequence()]
        while self.op("|"):
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else Path("alt", parts)

    def sequence(self) -> Path:
        parts = [self.step()]
        while self.op("/"):
            parts.append(self.step())
        return parts[0] if len(parts) == 1 else Path("seq", parts)

    def step(self) -> Path:
        if self.op("^"):
            return Path("inv", [self.step()])
        if self.op("("):
            out = self.path()
            self.need(")")
        else:
            kind, text = self.take()
            out = Path("iri", [], RDF_TYPE) if (kind, text) == ("word", "a") else Path("iri", [], self.iri(kind, text).value)
        if mark := self.op("+", "*"):
            out = Path("plus" if mark == "+" else "star", [out])
        return out

    # expressions
    def expr(self) -> Expr:
        return self.binary(0)

    LEVELS = [("||",), ("&&",), ("=", "!=", "<", ">", "<=", ">="), ("+", "-"), ("*", "/")]

    def binary(self, level: int):
        if level == len(self.LEVELS):
            return self.unary()
        left = self.binary(level + 1)
        while True:
            if level == 2 and self.peek()[0] == "word" and self.peek()[1].upper() in ("IN", "NOT"):
                negated = self.word("NOT")
                self.need("IN")
                self.need("(")
                args = [left]
                while not self.op(")"):
                    args.append(self.expr())
                    self.op(",")
                left = Expr("in", args)
                if negated:
                    left = Expr("!", [left])
            elif op := self.op(*self.LEVELS[level]):
                left = Expr(op, [left, self.binary(level + 1)])
            else:
                return left

    def unary(self):
        if self.op("!"):
            return Expr("!", [self.unary()])
        if self.op("-"):
            return Expr("-", [Literal("0", XSD + "integer"), self.unary()])
        return self.primary()

    def primary(self):
        if self.op("("):
            out = self.expr()
            self.need(")")
            return out
        kind, text = self.peek()
        upper = text.upper()
        if kind == "word" and upper in ("EXISTS", "NOT"):
            negated = self.word("NOT")
            self.need("EXISTS")
            return Expr("notexists" if negated else "exists", [self.group()])
        if kind == "word" and upper not in ("TRUE", "FALSE") or kind == "name" and self.peek(1) == ("op", "("):
            self.take()
            name = upper if kind == "word" else self.iri(kind, text).value
            self.need("(")
            extra: dict = {}
            if name in _AGGREGATES and self.word("DISTINCT"):
                extra["distinct"] = True
            args = []
            if name == "COUNT" and self.op("*"):
                pass
            while not self.op(")"):
                if self.op(";"):
                    self.need("SEPARATOR")
                    self.need("=")
                    extra["separator"] = self.term().value
                else:
                    args.append(self.expr())
                    self.op(",")
            return Expr(name, args, extra)
        return self.term()


# --- algebra to DataFrames ----------------------------------------------------------------
@dataclass
class Value:
    """A column with what is known of it: "iri", "string", "number", "boolean", or "term" with columns for kind, datatype and language."""

    what: str
    col: Column
    kind: Column | None = None
    type: Column | None = None
    lang: Column | None = None


@dataclass
class Bound:
    """what: as in Value; maybe: it may be unbound; at: what its columns' names begin with, where it belongs to the query around an EXISTS; outer: it is looked at from inside; fixed: kind, type and language, where they are the same for all rows."""

    what: str
    maybe: bool = False
    at: str = ""
    outer: bool = False
    fixed: tuple[str, str, str] | None = None


@dataclass
class Table:
    df: DataFrame
    vars: dict[str, Bound]
    #: rows may repeat
    bag: bool = True


_SUFFIX = ("", "|kind", "|type", "|lang")


def _cols(name: str, bound: Bound) -> list[str]:
    return [name + s for s in (_SUFFIX if bound.what == "term" else _SUFFIX[:1])]


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _same_kind(x: Literal, type_: Column, lang: Column) -> Column:
    """Has a literal with this datatype and language those of x? A language says all; a plain text may be stored without datatype."""
    if x.lang:
        return F.lower(lang) == x.lang.lower()
    return (lang == "") & (type_.isin("", x.type) if x.type == XSD + "string" else type_ == x.type)


class Compiler:
    def __init__(self, triples: Graph | DataFrame, counts: dict[str, int] | None = None, product_rows: int | None = None):
        self.triples, self.counts, self.fresh, self.product_rows = Graph.of(triples), counts or {}, 0, product_rows
        self.graph: Iri | Var | None = None  # of the GRAPH around a pattern

    def new(self) -> str:
        self.fresh += 1
        return f".v{self.fresh}"

    # patterns
    def pattern(self, t: Triple) -> Table:
        """One triple pattern as a table."""
        if isinstance(t.p, Path) and t.p.op not in ("iri", "alt"):
            return self.path(t)
        if isinstance(t.p, Path) and t.p.op == "alt" and any(x.op != "iri" for x in t.p.parts):
            return self.union([Group([Triple(t.s, x, t.o)]) for x in t.p.parts])
        cols, bound = [], {}
        names = ([x.name for x in t.p.parts] or [t.p.name]) if isinstance(t.p, Path) else [t.p.value] if isinstance(t.p, Iri) else None
        df = self.triples.scan(names, self.graph.value if isinstance(self.graph, Iri) else None)
        for position, term in (("s", t.s), ("p", t.p), ("o", t.o)):
            if isinstance(term, Path):
                continue
            if isinstance(term, Iri):
                df = df.where((F.col(position) == term.value) & ((F.col("o_kind") == "iri") if position == "o" else F.lit(True)))
            elif isinstance(term, Literal):
                if position != "o":
                    raise SparqlError("a literal can only be an object")
                df = df.where((F.col("o") == term.value) & (F.col("o_kind") == "literal") & _same_kind(term, F.coalesce("o_type", F.lit("")), F.coalesce("o_lang", F.lit(""))))
            elif term.name in bound:  # the same variable again
                df = df.where((F.col("o") == F.col("s" if isinstance(t.s, Var) and t.s.name == term.name else "p")) & (F.col("o_kind") == "iri"))
            elif position == "o":
                bound[term.name] = Bound("term", fixed=self.triples.fixed(names))
                cols += [F.col("o").alias(term.name), F.col("o_kind").alias(f"{term.name}|kind"), F.coalesce("o_type", F.lit("")).alias(f"{term.name}|type"), F.coalesce("o_lang", F.lit("")).alias(f"{term.name}|lang")]
            else:
                bound[term.name] = Bound("iri")
                cols.append(F.col(position).alias(term.name))
        one = isinstance(t.p, Var) or t.p.op == "iri"
        return Table(df.select(*cols, *([] if cols else [F.lit(1).alias(".one")])), bound, bag=not one)

    def path(self, t: Triple) -> Table:
        p = t.p
        if p.op == "inv":
            if isinstance(t.o, Literal):
                raise SparqlError("a literal has no inverse path")
            return self.pattern(Triple(t.o, p.parts[0], t.s))
        if p.op == "seq":
            ends = [t.s, *(Var(self.new()) for _ in p.parts[1:]), t.o]
            out = self.bgp([Triple(a, x, b) for a, x, b in zip(ends, p.parts, ends[1:], strict=False)], None)
            keep = [v for v in out.vars if not v.startswith(".v")]
            return Table(out.df.select(*[_c(c) for v in keep for c in _cols(v, out.vars[v])], *([] if keep else [F.lit(1).alias(".one")])), {v: out.vars[v] for v in keep})
        if p.parts[0].op != "iri":
            raise SparqlError("+ and * take a single predicate")
        edges = self.triples.scan([p.parts[0].name], self.graph.value if isinstance(self.graph, Iri) else None).where(F.col("o_kind") == "iri").select(F.col("s").alias("a"), F.col("o").alias("b")).distinct()
        given = next((k for k, x in (("a", t.s), ("b", t.o)) if isinstance(x, Iri)), None)
        if given:  # from the bound end, without the pairs of other sources
            end = t.s.value if given == "a" else t.o.value
            start = self.triples.sparkSession.createDataFrame([(end,)], "node string")
            nodes = orbits.reached(edges if given == "a" else edges.select(F.col("b").alias("a"), F.col("a").alias("b")), start)
            if p.op == "star":  # a path of no step is there for any term
                nodes = nodes.union(start).distinct()
            here, there = F.lit(end).alias(given), F.col("node").alias("b" if given == "a" else "a")
            reached = nodes.select(here, there)
        else:
            reached = orbits.closure(edges)
            if p.op == "star":
                nodes = edges.select("a").union(edges.select("b")).distinct()
                reached = reached.union(nodes.select("a", F.col("a").alias("b"))).distinct()
        out, bound = reached, {}
        for col, term in (("a", t.s), ("b", t.o)):
            if isinstance(term, Iri):
                out = out.where(F.col(col) == term.value)
            elif isinstance(term, Var):
                bound[term.name] = Bound("iri")
            else:
                raise SparqlError("a literal can't end a transitive path")
        cols = [F.col(c).alias(x.name) for c, x in (("a", t.s), ("b", t.o)) if isinstance(x, Var)]
        return Table(out.select(*cols, *([] if cols else [F.lit(1).alias(".one")])), bound)

    def weight(self, t: Triple, bound: set[str]) -> tuple:
        """Less is earlier: patterns connected with what is bound, then those with more constants, then rarer predicates."""
        names = {x.name for x in (t.s, t.p, t.o) if isinstance(x, Var)}
        fixed = sum(isinstance(x, (Iri, Literal)) for x in (t.s, t.o))
        rows = sum(self.counts.get(x.name, 0) for x in (t.p.parts or [t.p]) if x.op == "iri") if isinstance(t.p, Path) else sum(self.counts.values())
        return bool(bound) and not names & bound, -fixed, rows

    def folded(self, patterns: list[Triple]) -> list:
        """The patterns, with stars that one view answers as tables of one projection."""
        if self.graph is not None or not self.triples.views:
            return patterns
        out: list = []
        by: dict[str, list[Triple]] = {}
        for t in patterns:
            if isinstance(t.s, Var) and isinstance(t.p, Path) and t.p.op == "iri" and not (isinstance(t.o, Var) and t.o.name == t.s.name):
                by.setdefault(t.s.name, []).append(t)
            else:
                out.append(t)
        for name, star in by.items():
            while len(star) > 1:
                found = self.triples.fold([(t.p.name, t.o.value if isinstance(t.o, Iri) else None) for t in star])
                if found is None:
                    break
                view, which = found
                objects = [star[k].o.name for k in which if isinstance(star[k].o, Var)]
                if len(set(objects)) < len(objects):
                    break
                out.append(self.star(view, name, [star[k] for k in which]))
                star = [t for k, t in enumerate(star) if k not in which]
            out += star
        return sorted(out, key=lambda x: isinstance(x, Triple))

    def star(self, view, name: str, star: list[Triple]) -> Table:
        """Patterns on one subject as columns of a view's records: a triple is there where its value is."""
        cols, bound, keep = [view.subject.alias(name)], {name: Bound("iri")}, [F.col(f"`{name}`").isNotNull()]
        for k, t in enumerate(star):
            (e,) = view.answers(t.p.name, t.o.value if isinstance(t.o, Iri) else None)
            value = (e.o if e.when is None else F.when(e.when, e.o)).cast("string")
            if isinstance(t.o, Var):
                n = t.o.name
                bound[n] = Bound("term")
                cols += [value.alias(n), F.lit(e.kind).alias(f"{n}|kind"), column(e.type).alias(f"{n}|type"), column(e.lang).alias(f"{n}|lang")]
                keep.append(_c(n).isNotNull())
                continue
            if isinstance(t.o, Iri):
                fits = (value == t.o.value) & F.lit(e.kind == "iri")
            else:
                fits = (value == t.o.value) & F.lit(e.kind == "literal") & _same_kind(t.o, column(e.type), column(e.lang))
            if e.const is None or e.when is not None:
                cols.append(fits.alias(f".f{k}"))
                keep.append(_c(f".f{k}"))
        df = view.records.select(*cols)
        for c in keep:
            df = df.where(c)
        return Table(df.select(*[_c(c) for v in bound for c in _cols(v, bound[v])]), bound, bag=False)

    def later(self, out: Table, star: Table, todo: list[Triple]) -> Table:
        """Two stars without a common variable, joined through patterns that connect them where there are any."""
        while todo:
            links = [t for t in todo if {x.name for x in (t.s, t.p, t.o) if isinstance(x, Var)} & set(out.vars)]
            if not links:
                break
            best = min(links, key=lambda t: self.weight(t, set(out.vars)))
            todo.remove(best)
            out = self.join(out, self.pattern(best))
            if set(out.vars) & set(star.vars):
                break
        return self.join(out, star)

    def bgp(self, patterns: list[Triple], start: Table | None) -> Table:
        out, todo = start, []
        for x in self.folded(list(patterns)):
            if isinstance(x, Triple):
                todo.append(x)
            else:  # a star that is one projection of a view
                out = x if out is None else self.join(out, x) if set(out.vars) & set(x.vars) else self.later(out, x, todo)
        while todo:
            best = min(todo, key=lambda t: self.weight(t, set(out.vars) if out else set()))
            todo.remove(best)
            now = self.pattern(best)
            out = now if out is None else self.join(out, now)
        return out

    def keys(self, a: Table, b: Table, shared: list[str], outer: bool = False) -> tuple[DataFrame, list[Column]]:
        """b with its shared variables renamed, and the conditions of compatibility; with `outer` a is the query around an EXISTS."""
        right, on = b.df, []
        for v in shared:
            x, y = a.vars[v], b.vars[v]
            mine = (lambda n, x=x: _c(x.at + n).outer()) if outer else _c
            for c in _cols(v, y):
                right = right.withColumnRenamed(c, f"{c}|r")
            equal = [mine(v) == _c(f"{v}|r")]
            if x.what == y.what == "term":
                equal += [mine(v + s) == _c(f"{v}{s}|r") for s in _SUFFIX[1:]]
            elif "term" in (x.what, y.what):
                kind = mine(f"{v}|kind") if x.what == "term" else _c(f"{v}|kind|r")
                other = (y if x.what == "term" else x).what
                equal.append(kind == ("iri" if other == "iri" else "literal"))
            if x.maybe or y.maybe:  # what is unbound is compatible with anything
                both = equal[0]
                for c in equal[1:]:
                    both = both & c
                for bound, c in ((x, mine(v)), (y, _c(f"{v}|r"))):
                    both = both | c.isNull() if bound.maybe else both
                equal = [both]
            on += equal
        return right, on

    def widened(self, t: Table, names: list[str]) -> Table:
        """t with all that is known of these variables in four columns."""
        df, bound = t.df, dict(t.vars)
        for v in names:
            if bound[v].what != "term":
                value = self.value(Var(v), t)
                for c, s in zip(self.terms(value), _SUFFIX[1:], strict=True):
                    df = df.withColumn(v + s, c)
                df = df.withColumn(v, self.string(value))
                bound[v] = Bound("term", bound[v].maybe)
        return Table(df, bound, t.bag)

    def join(self, a: Table, b: Table, how: str = "inner") -> Table:
        shared = [v for v in a.vars if v in b.vars]
        loose = [v for v in shared if a.vars[v].maybe or b.vars[v].maybe]
        mixed = [v for v in loose if a.vars[v].what != b.vars[v].what]
        a, b = self.widened(a, mixed), self.widened(b, mixed)
        if loose:
            return self.join_by_masks(a, b, shared, loose, how)
        right, on = self.keys(a, b, shared)
        if not shared and how in ("left_semi", "left_anti"):
            on = [F.lit(True)]
        new = [v for v in b.vars if v not in a.vars]
        condition = on[0] if on else None
        for c in on[1:]:
            condition = condition & c
        if how == "inner" and not new and ".one" not in b.df.columns:
            # a triple matches a bound pattern once; of a bag (a path, a union) each row would count
            if not b.bag:
                return Table(a.df.join(right, condition, "left_semi"), a.vars)
            joined = a.df.join(right, condition)
            return Table(joined.select(*[_c(c) for v in a.vars for c in _cols(v, a.vars[v])]), a.vars)
        if condition is None:
            joined = self.product(a.df, right, ".one" in b.df.columns)
        else:
            joined = a.df.join(right, condition, how)
        if how in ("left_semi", "left_anti"):
            return Table(joined, a.vars)
        keep = [_c(c) for v in a.vars for c in _cols(v, a.vars[v])] + [_c(c) for v in new for c in _cols(v, b.vars[v])]
        bound = a.vars | {v: Bound(b.vars[v].what, b.vars[v].maybe or how == "left", fixed=b.vars[v].fixed if how == "inner" else None) for v in new}
        # sets that agree in all columns of what they share join to a set
        bag = how != "inner" or a.bag or b.bag or any(a.vars[v].what != b.vars[v].what for v in shared)
        return Table(joined.select(*keep, *([] if keep else [F.lit(1).alias(".one")])), bound, bag)

    def product(self, left: DataFrame, right: DataFrame, one: bool = False) -> DataFrame:
        """All pairs: patterns without a common variable, as SPARQL means it."""
        if not one and self.product_rows is not None and min(x.limit(self.product_rows + 1).count() for x in (left, right)) > self.product_rows:
            raise SparqlError(f"patterns without a common variable: both sides have more than {self.product_rows} rows")
        return left.crossJoin(F.broadcast(right) if one else right)

    def join_by_masks(self, a: Table, b: Table, shared: list[str], loose: list[str], how: str) -> Table:
        """A join on variables that a side may have left unbound, which are compatible with anything.

        Each side is parted by which of them its rows bind (their mask); of two masks the rows meet by
        an equi-join on what both bind. Where that is nothing there is a product, made only if there are
        such rows."""
        right, _ = self.keys(a, b, shared)
        masks = lambda t: itertools.product(*[(True, False) if t.vars[v].maybe else (True,) for v in loose])
        new = [v for v in b.vars if v not in a.vars]

        def part(df: DataFrame, t: Table, mask: tuple[bool, ...], end: str) -> DataFrame:
            for v, there in zip(loose, mask, strict=True):
                if t.vars[v].maybe:
                    df = df.where(_c(v + end).isNotNull() if there else _c(v + end).isNull())
            return df

        def met(x: tuple[bool, ...], y: tuple[bool, ...]) -> tuple[Column, list[str], list[str]] | None:
            both = [v for v in shared if v not in loose or (x[loose.index(v)] and y[loose.index(v)])]
            firm = Table(a.df, {v: replace(a.vars[v], maybe=False) for v in both}), Table(b.df, {v: replace(b.vars[v], maybe=False) for v in both})
            on = self.keys(*firm, both)[1]
            columns = [c for v in both for c in _cols(v, a.vars[v])], [f"{c}|r" for v in both for c in _cols(v, b.vars[v])]
            return (functools.reduce(operator.and_, on), *columns) if on else None

        keep = [F.coalesce(_c(c), _c(f"{c}|r")).alias(c) if v in loose else _c(c) for v in a.vars for c in _cols(v, a.vars[v])] + [_c(c) for v in new for c in _cols(v, b.vars[v])]
        parts = []
        for x in masks(a):
            left, alone = part(a.df, a, x, ""), None
            for y in masks(b):
                other, on = part(right, b, y, "|r"), met(x, y)
                if how == "left_anti":  # rows that have nothing in common take nothing away
                    left = left if on is None else left.join(other, on[0], "left_anti")
                    continue
                if on is None:
                    if left.isEmpty() or other.isEmpty():
                        continue
                    parts.append(self.product(left, other).select(*keep))
                    alone = left.limit(0) if alone is None else alone.limit(0)
                    continue
                parts.append(_spread(left, other, *on).select(*keep))
                if how == "left":
                    alone = (left if alone is None else alone).join(other, on[0], "left_anti")
            if how == "left_anti":
                parts.append(left)
            elif how == "left":
                missing = [F.lit(None).cast("string" if c != v else right.schema[c].dataType).alias(c) for v in new for c in _cols(v, b.vars[v])]
                parts.append((left if alone is None else alone).select(*[_c(c) for v in a.vars for c in _cols(v, a.vars[v])], *missing))
        if how == "left_anti":
            return Table(functools.reduce(DataFrame.unionByName, parts), a.vars)
        bound = a.vars | {v: Bound(b.vars[v].what, b.vars[v].maybe or how == "left") for v in new} | {v: Bound(a.vars[v].what, a.vars[v].maybe and (b.vars[v].maybe or how == "left")) for v in loose}
        empty = a.df.crossJoin(F.broadcast(right.limit(0))).limit(0).select(*keep) if not parts else None
        return Table(functools.reduce(DataFrame.unionByName, parts) if parts else empty, bound)

    def union(self, groups: list[Group]) -> Table:
        tables = [self.group(g) for g in groups]
        names = list(dict.fromkeys(v for t in tables for v in t.vars))
        bound = {v: Bound("iri" if all(t.vars.get(v, Bound("iri")).what == "iri" for t in tables) else "term", any(v not in t.vars or t.vars[v].maybe for t in tables)) for v in names}
        out = None
        for t in tables:
            cols = []
            for v in names:
                have = t.vars.get(v)
                value = self.value(Var(v), t)
                full = [value.col, *(self.terms(value))] if have else [F.lit(None).cast("string")] * 4
                cols += [c.alias(n) for c, n in zip(full, _cols(v, bound[v]), strict=False)]
            part = t.df.select(*cols)
            out = part if out is None else out.unionByName(part)
        return Table(out, bound)

    def group(self, g: Group, start: Table | None = None) -> Table:
        out, triples, filters = start, [], []

        def flush() -> None:
            nonlocal out, triples
            if triples:
                out = self.bgp(triples, out)
                triples = []

        for part in g.parts:
            if isinstance(part, Triple):
                triples.append(part)
                continue
            if isinstance(part, tuple) and part[0] == "filter":
                filters.append(part[1])
                continue
            flush()
            if isinstance(part, Group):
                now = self.group(part)
                out = now if out is None else self.join(out, now)
            elif part[0] == "graph":
                now = self.named(part[1], part[2])
                out = now if out is None else self.join(out, now)
            elif part[0] == "optional":
                out = self.optional(out or self.unit(), part[1])
            elif part[0] == "union":
                now = self.union(part[1])
                out = now if out is None else self.join(out, now)
            elif part[0] == "minus":
                now = self.group(part[1])
                if out and set(out.vars) & set(now.vars):
                    out = self.join(out, now, "left_anti")
            elif part[0] == "bind":
                out = self.bind(out or self.unit(), part[1], part[2])
            elif part[0] == "values":
                now = self.inline(part[1], part[2])
                out = now if out is None else self.join(out, now)
            elif part[0] == "select":
                now = self.select(part[1])
                out = now if out is None else self.join(out, now)
        flush()
        out = out or self.unit()
        for e in filters:
            out = self.filter(out, e)
        return out

    def named(self, name, g: Group) -> Table:
        """A group inside one named graph, or inside each in turn, whose name then is a variable."""
        before = self.graph
        try:
            if isinstance(name, Iri):
                self.graph = name
                return self.group(g)
            parts = []
            for row in self.triples.graphs().collect():  # graphs are few: a handful of files
                self.graph = Iri(row.graph)
                t = self.group(g)
                parts.append(self.join(t, self.inline([name.name], [[Iri(row.graph)]])))
        finally:
            self.graph = before
        if not parts:
            return Table(self.unit().df.limit(0).withColumn(name.name, F.lit("")), {name.name: Bound("iri")})
        out = parts[0]
        for t in parts[1:]:
            out = Table(out.df.unionByName(t.df), out.vars)
        return out

    def unit(self) -> Table:
        return Table(self.triples.sparkSession.range(1).select(F.lit(1).alias(".one")), {})

    def inline(self, names: list[str], rows: list[list]) -> Table:
        iri = {v: all(isinstance(r[i], Iri) for r in rows) for i, v in enumerate(names)}
        bound = {v: Bound("iri" if iri[v] else "term", any(r[i] is None for r in rows)) for i, v in enumerate(names)}
        data = []
        for r in rows:
            flat: list = []
            for v, x in zip(names, r, strict=True):
                four = [None] * 4 if x is None else [x.value, "iri", "", ""] if isinstance(x, Iri) else [x.value, "literal", x.type, x.lang]
                flat += four[: 1 if iri[v] else 4]
            data.append(tuple(flat))
        schema = ", ".join(f"`{c}` string" for v in names for c in _cols(v, bound[v]))
        return Table(self.triples.sparkSession.createDataFrame(data, schema), bound)

    def optional(self, out: Table, g: Group) -> Table:
        inner = [p for p in g.parts if not (isinstance(p, tuple) and p[0] == "filter")]
        now = self.group(Group(inner))
        tests = [p[1] for p in g.parts if isinstance(p, tuple) and p[0] == "filter"]
        if all(_names(e) <= set(now.vars) for e in tests):
            for e in tests:
                now = self.filter(now, e)
            return self.join(out, now, "left")
        # a filter that looks at the left side is part of the condition
        shared = [v for v in out.vars if v in now.vars]
        right, on = self.keys(out, now, shared)
        both = Table(out.df, out.vars | {v: b for v, b in now.vars.items() if v not in out.vars})
        on += [self.boolean(self.value(e, both)) for e in tests]
        condition = on[0]
        for c in on[1:]:
            condition = condition & c
        new = [v for v in now.vars if v not in out.vars]
        df = out.df.join(right, condition, "left").select(*[_c(c) for v in out.vars for c in _cols(v, out.vars[v])], *[_c(c) for v in new for c in _cols(v, now.vars[v])])
        return Table(df, out.vars | {v: Bound(now.vars[v].what, True) for v in new})

    def filter(self, out: Table, e) -> Table:
        if isinstance(e, Expr) and e.op == "&&":
            return self.filter(self.filter(out, e.args[0]), e.args[1])
        if not _asks(e):
            return Table(out.df.where(self.boolean(self.value(e, out))), out.vars, out.bag)
        # inside the subquery no column may be taken for one of this query: they get names of their own
        at = self.new() + "!"
        named = out.df.select(*[_c(c).alias(at + c) for c in out.df.columns])
        around = Table(named, {v: replace(b, at=at) for v, b in out.vars.items()})
        kept = named.where(self.boolean(self.value(e, around)))
        return Table(kept.select(*[_c(at + c).alias(c) for c in out.df.columns]), out.vars)

    def bind(self, out: Table, e, name: str) -> Table:
        if name in out.vars:
            raise SparqlError(f"?{name} is bound already")
        if _asks(e):
            raise SparqlError("EXISTS is supported in FILTER only")
        v = self.value(e, out)
        what = "term" if v.what == "term" else v.what
        bound = Bound(what, not _sure(e, out))
        df = out.df
        for c, n in zip([v.col, *self.terms(v)] if what == "term" else [v.col], _cols(name, bound), strict=True):
            df = df.withColumn(n, c)
        return Table(df, out.vars | {name: bound})

    def exists(self, g: Group, out: Table) -> Column:
        """Is there a solution of the group that fits this row? Filters at the group's first level may use the row's variables."""
        inner = Group([p for p in g.parts if not (isinstance(p, tuple) and p[0] == "filter")])
        tests = [p[1] for p in g.parts if isinstance(p, tuple) and p[0] == "filter"]
        now = self.group(inner)
        for name in _free(inner) - set(now.vars):
            if name in out.vars:
                raise SparqlError(f"?{name} belongs to the query around EXISTS and can't be used below its first level")
        for e in [e for e in tests if _names(e) <= set(now.vars) or not _names(e) & set(out.vars)]:
            now = self.filter(now, e)
        late = [e for e in tests if not (_names(e) <= set(now.vars) or not _names(e) & set(out.vars))]
        shared = [v for v in out.vars if v in now.vars]
        right, on = self.keys(out, now, shared, outer=True)
        both = Table(right, {v: replace(b, outer=True) for v, b in out.vars.items()} | {v: b for v, b in now.vars.items() if v not in out.vars})
        for c in [*on, *(self.boolean(self.value(e, both)) for e in late)]:
            right = right.where(c)
        return right.exists()

    # expressions
    def terms(self, v: Value) -> list[Column]:
        """Kind, datatype and language of a value; null where it is unbound."""
        if v.what == "term":
            return [v.kind, v.type, v.lang]
        kind = {"iri": "iri"}.get(v.what, "literal")
        type_ = {"iri": "", "string": XSD + "string", "number": XSD + "decimal", "boolean": XSD + "boolean"}[v.what]
        return [F.when(v.col.isNotNull(), F.lit(x)) for x in (kind, type_, "")]

    def number(self, v: Value) -> Column:
        return v.col if v.what == "number" else F.when(v.type.isin(NUMERIC), v.col.try_cast("double")) if v.what == "term" else v.col.try_cast("double")

    def string(self, v: Value) -> Column:
        return v.col if v.what in ("string", "iri", "term") else v.col.cast("string")

    def boolean(self, v: Value) -> Column:
        if v.what == "boolean":
            return v.col
        if v.what == "number":
            return v.col != 0
        if v.what == "term":
            return F.when(v.type == XSD + "boolean", v.col == "true").when(v.type.isin(NUMERIC), v.col.try_cast("double") != 0).otherwise(v.col != "")
        return v.col != ""

    def compare(self, op: str, a: Value, b: Value) -> Column:
        """Numbers by value; other literals are equal if text, datatype and language are, IRIs if both are such."""

        def apply(x: Column, y: Column) -> Column:
            return {"=": x == y, "!=": x != y, "<": x < y, ">": x > y, "<=": x <= y, ">=": x >= y}[op]

        def told(alike: Column) -> Column:
            return alike if op == "=" else ~alike

        equality, kinds = op in ("=", "!="), {a.what, b.what}
        if kinds == {"boolean"}:
            return apply(a.col, b.col)
        if "boolean" in kinds:
            x, y = (a, b) if a.what == "boolean" else (b, a)
            if equality and y.what == "term":
                return told((y.type == XSD + "boolean") & (y.col.isin("true", "1") == x.col))
            return apply(self.boolean(a), self.boolean(b))
        if "number" in kinds:
            if equality and "iri" in kinds:
                return told(F.when(a.col.isNotNull() & b.col.isNotNull(), F.lit(False)))
            return apply(self.number(a), self.number(b))
        if equality and kinds == {"iri", "string"}:
            return told(F.when(a.col.isNotNull() & b.col.isNotNull(), F.lit(False)))
        if kinds == {"term"}:
            numbers = a.type.isin(NUMERIC) & b.type.isin(NUMERIC)
            exact = F.when(numbers, apply(a.col.try_cast("double"), b.col.try_cast("double")))
            if equality:
                plain = lambda v: F.when(v.type == XSD + "string", "").otherwise(v.type)
                return exact.otherwise(told((a.col == b.col) & (a.kind == b.kind) & (F.lower(a.lang) == F.lower(b.lang)) & (plain(a) == plain(b))))
            # a number and something else have no order
            return exact.when(~a.type.isin(NUMERIC) & ~b.type.isin(NUMERIC), apply(a.col, b.col))
        if "term" in kinds and equality:
            t, other = (a, b) if a.what == "term" else (b, a)
            if other.what == "iri":
                return told((a.col == b.col) & (t.kind == "iri"))
            return told((a.col == b.col) & (t.kind == "literal") & (t.lang == "") & t.type.isin("", XSD + "string"))
        return apply(self.string(a), self.string(b))

    def value(self, e, t: Table) -> Value:
        if isinstance(e, Var):
            bound = t.vars.get(e.name)
            if bound is None:
                return Value("string", F.lit(None).cast("string"))
            mine = (lambda n: _c(bound.at + n).outer()) if bound.outer else lambda n: _c(bound.at + n)
            if bound.what == "term":
                return Value("term", *(mine(e.name + s) for s in _SUFFIX))
            return Value(bound.what, mine(e.name))
        if isinstance(e, Iri):
            return Value("iri", F.lit(e.value))
        if isinstance(e, Literal):
            if e.type in NUMERIC:
                return Value("number", F.lit(float(e.value)) if e.type != XSD + "integer" else F.lit(int(e.value)))
            if e.type == XSD + "boolean":
                return Value("boolean", F.lit(e.value == "true"))
            if e.lang or e.type != XSD + "string":
                return Value("term", F.lit(e.value), F.lit("literal"), F.lit(e.type), F.lit(e.lang))
            return Value("string", F.lit(e.value))
        op = e.op
        if op in ("exists", "notexists"):
            found = self.exists(e.args[0], t)
            return Value("boolean", found if op == "exists" else ~found)
        v = [self.value(a, t) for a in e.args]
        if op in ("&&", "||"):
            a, b = map(self.boolean, v)
            return Value("boolean", a & b if op == "&&" else a | b)
        if op == "!":
            return Value("boolean", ~self.boolean(v[0]))
        if op in ("=", "!=", "<", ">", "<=", ">="):
            return Value("boolean", self.compare(op, *v))
        if op == "in":
            out = self.compare("=", v[0], v[1])
            for x in v[2:]:
                out = out | self.compare("=", v[0], x)
            return Value("boolean", out)
        if op in ("+", "-", "*", "/"):
            a, b = map(self.number, v)
            return Value("number", {"+": a + b, "-": a - b, "*": a * b, "/": F.try_divide(a, b)}[op])
        if op in (XSD + "integer", XSD + "int", XSD + "long"):
            return Value("number", v[0].col.try_cast("bigint"))
        if op in (XSD + "decimal", XSD + "double", XSD + "float"):
            return Value("number", v[0].col.try_cast("double"))
        if op == "IF":
            test = self.boolean(v[0])
            if v[1].what == v[2].what != "term":
                return Value(v[1].what, F.when(test, v[1].col).otherwise(v[2].col))
            pairs = zip([self.string(v[1]), *self.terms(v[1])], [self.string(v[2]), *self.terms(v[2])], strict=True)
            return Value("term", *[F.when(test, a).otherwise(b) for a, b in pairs])
        if op == "COALESCE":
            if len({x.what for x in v}) == 1 and v[0].what != "term":
                return Value(v[0].what, F.coalesce(*[x.col for x in v]))
            # of several kinds: the first that is bound, with all that is known of it
            whole = F.coalesce(*[F.when(x.col.isNotNull(), F.struct(self.string(x).alias("v"), *[c.alias(n) for c, n in zip(self.terms(x), "ktl", strict=True)])) for x in v])
            return Value("term", whole["v"], whole["k"], whole["t"], whole["l"])
        if op == "BOUND":
            return Value("boolean", v[0].col.isNotNull())
        if op in ("STR", XSD + "string"):
            return Value("string", self.string(v[0]))
        if op == "LANG":
            return Value("string", v[0].lang if v[0].what == "term" else F.lit(""))
        if op == "DATATYPE":
            return Value("iri", self.terms(v[0])[1])
        if op in ("ISIRI", "ISURI"):
            return Value("boolean", (self.terms(v[0])[0] == "iri") & ~F.startswith(self.string(v[0]), F.lit("_:")))
        if op == "ISBLANK":
            return Value("boolean", (self.terms(v[0])[0] == "iri") & F.startswith(self.string(v[0]), F.lit("_:")))
        if op == "ISNUMERIC":
            return Value("boolean", self.terms(v[0])[1].isin(NUMERIC) & self.number(v[0]).isNotNull())
        if op == "SAMETERM":
            x, y = ([self.string(z), *self.terms(z)] for z in v)
            return Value("boolean", (x[0] == y[0]) & (x[1] == y[1]) & (x[2] == y[2]) & (x[3] == y[3]))
        if op in ("IRI", "URI"):
            return Value("iri", self.string(v[0]))
        if op == "STRDT":
            return Value("term", self.string(v[0]), *(F.when(v[0].col.isNotNull(), c) for c in (F.lit("literal"), v[1].col, F.lit(""))))
        if op == "STRLANG":
            return Value("term", self.string(v[0]), *(F.when(v[0].col.isNotNull(), c) for c in (F.lit("literal"), F.lit(LANG_STRING), F.lower(self.string(v[1])))))
        if op == "LANGMATCHES":
            tag, asked = F.lower(self.string(v[0])), F.lower(self.string(v[1]))
            return Value("boolean", F.when(asked == "*", tag != "").otherwise((tag == asked) | F.startswith(tag, F.concat(asked, F.lit("-")))))
        if op == "NOW":
            return Value("term", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("literal"), F.lit(XSD + "dateTime"), F.lit(""))
        if op == "ISLITERAL":
            return Value("boolean", self.terms(v[0])[0] == "literal")
        s = [self.string(x) for x in v]
        if op == "SUBSTR":
            start = v[1].col.cast("int")
            return Value("string", F.substring(s[0], start, v[2].col.cast("int") if len(v) > 2 else F.length(s[0])))
        if op == "STRLEN":
            return Value("number", F.length(s[0]))
        if op == "CONCAT":
            return Value("string", F.concat(*s))
        if op in ("STRSTARTS", "STRENDS", "CONTAINS"):
            return Value("boolean", {"STRSTARTS": F.startswith, "STRENDS": F.endswith, "CONTAINS": F.contains}[op](s[0], s[1]))
        if op in ("STRBEFORE", "STRAFTER"):
            at = F.position(s[1], s[0])
            cut = F.substring(s[0], F.lit(1), at - 1) if op == "STRBEFORE" else F.substring(s[0], at + F.length(s[1]), F.length(s[0]))
            return Value("string", F.when(at > 0, cut).when(at == 0, F.lit("")))
        if op == "ENCODE_FOR_URI":
            # Spark's encoder is a form's: a space is "+", and "~" is written out
            return Value("string", F.replace(F.replace(F.replace(F.url_encode(s[0]), F.lit("+"), F.lit("%20")), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A")))
        if op in ("LCASE", "UCASE"):
            return Value("string", F.lower(s[0]) if op == "LCASE" else F.upper(s[0]))
        if op == "REGEX":
            flags = e.args[2].value if len(e.args) > 2 else ""
            return Value("boolean", F.regexp_like(s[0], F.concat(F.lit(f"(?{flags})" if flags else ""), s[1])))
        if op == "REPLACE":
            return Value("string", F.regexp_replace(s[0], s[1], s[2]))
        if op in ("ROUND", "ABS", "CEIL", "FLOOR"):
            n = self.number(v[0])
            # XPath rounds halves up, towards positive infinity
            return Value("number", {"ROUND": F.floor(n + 0.5), "ABS": F.abs(n), "CEIL": F.ceil(n), "FLOOR": F.floor(n)}[op])
        if op in ("YEAR", "MONTH", "DAY", "HOURS", "MINUTES"):
            at = {"YEAR": (1, 4), "MONTH": (6, 2), "DAY": (9, 2), "HOURS": (12, 2), "MINUTES": (15, 2)}[op]
            return Value("number", F.substring(s[0], *at).try_cast("int"))
        if op == "SECONDS":
            return Value("number", F.regexp_extract(s[0], r"T\d\d:\d\d:(\d\d(?:\.\d+)?)", 1).try_cast("double"))
        raise SparqlError(f"{op} isn't supported here")

    # solution modifiers
    def aggregate(self, e: Expr, t: Table, keys: list[str]) -> tuple[Column, str]:
        """An aggregate's column; empty groups give 0, 0 and "" as SPARQL has it."""
        distinct = e.extra.get("distinct", False)
        if e.op == "COUNT":
            # of a set whose other variables are all grouped by, each value is counted once anyway
            if e.args and isinstance(e.args[0], Var) and not t.bag and set(t.vars) <= {*keys, e.args[0].name}:
                distinct = False
            if not e.args:
                return (F.count_distinct(*[_c(c) for v in t.vars for c in _cols(v, t.vars[v])]) if distinct else F.count(F.lit(1))), "number"
            v = self.value(e.args[0], t)
            parts = [v.col, *self.terms(v)] if v.what == "term" else [v.col]
            return (F.count_distinct(*parts) if distinct else F.count(v.col)), "number"
        v = self.value(e.args[0], t)
        if e.op == "GROUP_CONCAT":
            text = self.string(v)
            joined = F.array_join(F.sort_array((F.collect_set if distinct else F.collect_list)(text)), e.extra.get("separator", " "))
            return F.coalesce(joined, F.lit("")), "string"
        if e.op in ("SUM", "AVG"):
            n = self.number(v)
            if e.op == "SUM" and v.what == "term":
                # of integers an integer, else a double; what isn't a number makes no sum of the others wrong
                whole = F.coalesce(F.bool_and(F.when(n.isNotNull(), v.type.isin(INTEGERS))), F.lit(True))
                add = F.sum_distinct if distinct else F.sum
                exact = F.coalesce(add(F.when(v.type.isin(INTEGERS), v.col.try_cast("bigint"))), F.lit(0)).cast("string")
                total = F.when(whole, exact).otherwise(F.coalesce(add(n), F.lit(0.0)).cast("string"))
                return F.struct(total.alias("v"), F.when(whole, XSD + "integer").otherwise(XSD + "double").alias("t")), "sum"
            if e.op == "SUM":
                return F.coalesce((F.sum_distinct if distinct else F.sum)(n), F.lit(0)), "number"
            return (F.try_divide(F.sum_distinct(n), F.count_distinct(n)) if distinct else F.avg(n)), "number"
        if e.op == "SAMPLE":
            return F.min(self.string(v)), "string"
        least = e.op == "MIN"
        if v.what == "term":
            best = (F.min if least else F.max)(F.struct(v.type.isin(NUMERIC).alias("n"), F.when(v.type.isin(NUMERIC), v.col.try_cast("double")).alias("d"), v.col.alias("s")))
            return best["s"], "string"
        return (F.min if least else F.max)(v.col), v.what

    def select(self, q: Select) -> Table:
        t = self.group(q.where)
        grouped = bool(q.group) or any(_aggregates(e) for e, _ in q.items) or bool(q.having)
        if grouped:
            return self.modify(q, self.grouped(q, t))
        for e, name in q.items:
            if not isinstance(e, Var):
                t = self.bind(t, e, name)
        return self.modify(q, t)

    def grouped(self, q: Select, t: Table) -> Table:
        for e, name in q.group:
            if not isinstance(e, Var):
                t = self.bind(t, e, name)
        keys = [name for _, name in q.group]
        found: dict[str, tuple[Column, str]] = {}

        def lift(e):
            """Aggregates become variables of the grouped table."""
            if isinstance(e, Expr):
                if e.op in _AGGREGATES:
                    name = self.new()
                    found[name] = self.aggregate(e, t, keys)
                    return Var(name)
                return Expr(e.op, [lift(a) for a in e.args], e.extra)
            return e

        items = [(lift(e), name) for e, name in q.items]
        having = [lift(e) for e in q.having]
        order = [(lift(e), up) for e, up in q.order]
        # what is the same for all rows is told anew and neither shuffled nor held in the groups' keys
        known = {v + s: x for v in keys if t.vars[v].fixed and not t.vars[v].maybe for s, x in zip(_SUFFIX[1:], t.vars[v].fixed, strict=True)}
        columns = [_c(c) for v in keys for c in _cols(v, t.vars[v]) if c not in known]
        aggs = [c.alias(n) for n, (c, _) in found.items()] or [F.count(F.lit(1)).alias(".n")]
        df = t.df.groupBy(*columns).agg(*aggs).withColumns({c: F.lit(x) for c, x in known.items()})
        for n, (_, what) in found.items():
            if what == "sum":
                df = df.withColumn(f"{n}|kind", F.lit("literal")).withColumn(f"{n}|type", _c(n)["t"]).withColumn(f"{n}|lang", F.lit("")).withColumn(n, _c(n)["v"])
        out = Table(df, {v: t.vars[v] for v in keys} | {n: Bound("term" if what == "sum" else what, True) for n, (_, what) in found.items()})
        for e, name in items:
            if isinstance(e, Var) and e.name == name:
                if name not in out.vars:
                    raise SparqlError(f"?{name} is neither grouped nor aggregated")
            else:
                out = self.bind(out, e, name)
        for e in having:
            out = self.filter(out, e)
        q.order = order
        return out

    def modify(self, q: Select, t: Table) -> Table:
        names = [n for _, n in q.items] or [v for v in t.vars if not v.startswith(".")]
        for n in names:
            if n not in t.vars:
                t = Table(t.df.withColumn(n, F.lit(None).cast("string")), t.vars | {n: Bound("string", True)})
        keep = [c for n in names for c in _cols(n, t.vars[n])]
        df = t.df
        sort = []
        for e, up in q.order:
            v = self.value(e, t)
            for c in ([F.when(v.type.isin(NUMERIC), v.col.try_cast("double")), v.col] if v.what == "term" else [v.col]):
                sort.append(c.asc_nulls_first() if up else c.desc_nulls_last())
        if q.distinct:
            df = df.select(*[_c(c) for c in keep]).distinct()
        if sort:
            df = df.orderBy(*sort)
        if q.offset:
            df = df.offset(q.offset)
        if q.limit is not None:
            df = df.limit(q.limit)
        return Table(df.select(*[_c(c) for c in keep]), {n: t.vars[n] for n in names})


def _spread(left: DataFrame, right: DataFrame, on: Column, *keys: list[str]) -> DataFrame:
    """An inner join in which few keys may have very many pairs: a side of at most SLICES times BROADCAST_ROWS is sent to all rows of the other, dealt evenly, so that no task waits for one key. Sizes are counted, as bytes tell nothing of pairs.

    Where each side's key columns are given, the rows dealt are paired in tiles, rows of one key that lie in an
    array: for each row of the side sent come those of the tile. In what is written of the pairs one column stays
    the same for a tile's length and the other repeats its rows, and a task has few keys and rows, so that Parquet's
    dictionaries hold and its pages are compressed well."""
    rows = {"left": left.count(), "right": right.count()}
    small = min(rows, key=rows.get)
    if rows[small] > SLICES * BROADCAST_ROWS or max(rows.values()) < SPREAD_ROWS:
        return left.join(right, on)
    sent, dealt = (right, left) if small == "right" else (left, right)
    spark = left.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism, -(-max(rows.values()) // TASK_ROWS))
    slices = -(-rows[small] // BROADCAST_ROWS) or 1
    part = F.pmod(F.xxhash64(*map(_c, sent.columns)), F.lit(slices))
    some = [F.broadcast(sent if slices == 1 else sent.where(part == k)) for k in range(slices)]
    tiles = _tiles(dealt, keys[small == "left"], tasks) if keys else None
    if tiles is None:
        dealt, held = dealt.repartition(tasks), [_c(c) for c in dealt.columns]
    else:
        dealt, held = tiles, [F.inline(_c("|rows"))]
    pairs = [(dealt.join(x, on) if small == "right" else x.join(dealt, on)).select(*map(_c, sent.columns), *held) for x in some]
    return functools.reduce(DataFrame.unionByName, pairs).select(*map(_c, left.columns), *map(_c, right.columns))


def _tiles(df: DataFrame, keys: list[str], tasks: int) -> DataFrame | None:
    """The keys and `|rows`, arrays of about TILE rows of one key, dealt to tasks by ranges of keys; None where too many rows are alike."""
    by = [_c(c) for c in keys]
    biggest = lambda *of: of[0].groupBy(*of[1:]).count().agg(F.max("count")).first()[0] or 0
    tiles = df.withColumn("|tile", F.pmod(F.xxhash64(*map(_c, df.columns)), F.lit(-(-biggest(df, *by) // TILE) or 1)))
    if biggest(tiles, *by, "|tile") > MOST_IN_TILE:
        return None
    rows = tiles.groupBy(*by, "|tile").agg(F.collect_list(F.struct(*map(_c, df.columns))).alias("|rows"))
    # the number of tasks is kept, as bytes tell nothing of pairs
    return rows.repartitionByRange(tasks, *by, "|tile")


def _sure(e, t: Table) -> bool:
    """Is an expression bound in every row?"""
    if isinstance(e, (Iri, Literal)):
        return True
    if isinstance(e, Var):
        return e.name in t.vars and not t.vars[e.name].maybe
    if e.op == "COALESCE":
        return any(_sure(x, t) for x in e.args)
    return e.op in ("STR", "CONCAT", "LCASE", "UCASE", "STRLEN", "REPLACE", "STRBEFORE", "STRAFTER", "LANG", "DATATYPE", "IRI", "URI", "ENCODE_FOR_URI") and all(_sure(x, t) for x in e.args)


def _aggregates(e) -> bool:
    return isinstance(e, Expr) and (e.op in _AGGREGATES or any(map(_aggregates, e.args)))


def _asks(e) -> bool:
    """Is there an EXISTS in an expression?"""
    return isinstance(e, Expr) and (e.op in ("exists", "notexists") or any(map(_asks, e.args)))


def _names(e) -> set[str]:
    """Variables of an expression; of an EXISTS in it those that it takes from outside or shares."""
    return {e.name} if isinstance(e, Var) else _free(e) if isinstance(e, Group) else set().union(*map(_names, e.args)) if isinstance(e, Expr) else set()


def variables(g: Group) -> set[str]:
    """Variables that a group's patterns bind, at any depth."""
    out: set[str] = set()
    for p in g.parts:
        if isinstance(p, Triple):
            out |= {x.name for x in (p.s, p.p, p.o) if isinstance(x, Var)}
        elif isinstance(p, Group):
            out |= variables(p)
        elif p[0] in ("bind", "values"):
            out |= {p[2]} if p[0] == "bind" else set(p[1])
        elif p[0] == "select":
            out |= {n for _, n in p[1].items} or variables(p[1].where)
        elif p[0] in ("optional", "graph", "union"):
            for x in p[1] if p[0] == "union" else p[-1:]:
                out |= variables(x)
    return out


def _free(g: Group) -> set[str]:
    """Variables that filters and expressions of a group use, at any depth."""
    out: set[str] = set()
    for p in g.parts:
        if isinstance(p, Group):
            out |= _free(p)
        elif isinstance(p, tuple):
            for x in p[1:]:
                out |= _free(x) if isinstance(x, Group) else set().union(*map(_free, x)) if isinstance(x, list) and x and isinstance(x[0], Group) else _names(x) if isinstance(x, Expr) else set()
    return out


def constructed(compiler: Compiler, q: Select) -> DataFrame:
    """The template's triples for each solution, where all of their terms are bound and fit their places."""
    t = compiler.modify(q, compiler.group(q.where))

    def columns(x) -> list[Column]:
        if isinstance(x, Path):
            x = Iri(x.name)
        if isinstance(x, Literal):
            return [F.lit(x.value), F.lit("literal"), F.lit(x.type), F.lit(x.lang)]
        v = compiler.value(x, t)
        return [compiler.string(v), *compiler.terms(v)]

    out = None
    for triple in q.template:
        (s, s_kind, *_), (p, p_kind, *_), o = (columns(x) for x in (triple.s, triple.p, triple.o))
        part = t.df.where((s_kind == "iri") & (p_kind == "iri") & o[0].isNotNull()).select(s.alias("s"), p.alias("p"), *[c.alias(n) for c, n in zip(o, ("o", "o_kind", "o_type", "o_lang"), strict=True)])
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def parse(text: str, prefixes: dict[str, str] | None = None) -> Select:
    return Parser(text, prefixes).query()


def query(triples: Graph | DataFrame, text: str, prefixes: dict[str, str] | None = None, counts: dict[str, int] | None = None, as_strings: bool = False, product_rows: int | None = None) -> DataFrame:
    """Run a text on a Graph, or on triples (s, p, o, o_kind, o_type, o_lang, and `graph` where GRAPH is used).

    SELECT gives a column for each variable; values keep their types, with `as_strings` all are
    text. ASK gives one row (answer: boolean), CONSTRUCT a set of triples."""
    q, compiler = parse(text, prefixes), Compiler(triples, counts, product_rows=product_rows)
    if q.form == "ask":
        return compiler.group(q.where).df.limit(1).agg((F.count("*") > 0).alias("answer"))
    if q.form == "construct":
        return constructed(compiler, q)
    t = compiler.select(q)
    cols = [_c(v).cast("string").alias(v) if as_strings else _c(v) for v in t.vars]
    return t.df.select(*cols)
