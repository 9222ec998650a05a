"""Shapes from RDF: SHACL as triples (a Turtle file's, say) to the shapes that a Validator runs.

Shape graphs are a schema's, small, so they're read on the driver. Read are node shapes with
their targets (classes, nodes, classes that are shapes themselves), properties (in place or by
name) on a predicate or an inverse path, the constraints of shacl.Property, SPARQL constraints
with the prefixes that they declare, severities and messages. A deactivated shape is left out,
`sh:closed false` says nothing, and whatever else a shape asks for is refused, not ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from . import shacl

SH = "http://www.w3.org/ns/shacl#"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"

#: What describes a shape to readers.
_SPOKEN = {"name", "description", "order", "group", "defaultValue"}
_NODE = {"targetClass", "targetNode", "property", "pattern", "flags", "nodeKind", "class", "sparql", "severity", "message", "deactivated", "closed", "ignoredProperties", "or", "node"}
_PROPERTY = {"path", "minCount", "maxCount", "class", "datatype", "nodeKind", "pattern", "flags", "minLength", "in", "hasValue", "or", "node", "languageIn", "uniqueLang", "severity", "message", "deactivated", "sparql", "targetClass", "targetNode", "property", "closed", "ignoredProperties"}


class ShapeError(ValueError):
    pass


@dataclass
class Loaded:
    shapes: list[shacl.Shape]
    #: (shape, property) where the property has no path
    dangling: list[tuple[str, str]] = field(default_factory=list)
    #: declared prefixes
    prefixes: dict[str, str] = field(default_factory=dict)


class Loader:
    def __init__(self, triples: Iterable[tuple]):
        self.of: dict[str, dict[str, list[tuple[str, str, str, str]]]] = defaultdict(lambda: defaultdict(list))
        for s, p, *o in triples:
            if tuple(o) not in self.of[s][p]:
                self.of[s][p].append(tuple(o))
        self.made: dict[str, shacl.Shape] = {}
        self.dangling: list[tuple[str, str]] = []

    # reading
    def all(self, node: str, name: str) -> list[tuple[str, str, str, str]]:
        return self.of[node].get(SH + name, []) if node in self.of else []

    def one(self, node: str, name: str) -> str | None:
        found = self.all(node, name)
        return found[0][0] if found else None

    def number(self, node: str, name: str) -> int | None:
        value = self.one(node, name)
        return None if value is None else int(value)

    def list(self, head: str) -> list[tuple[str, str, str, str]]:
        out = []
        while head != RDF + "nil":
            out.append(self.of[head][RDF + "first"][0])
            head = self.of[head][RDF + "rest"][0][0]
        return out

    def known(self, node: str, names: set[str]) -> None:
        for p in self.of[node]:
            if p.startswith(SH) and p[len(SH) :] not in names | _SPOKEN:
                raise ShapeError(f"{node}: sh:{p[len(SH):]} isn't supported")
        if self.one(node, "closed") == "true":
            raise ShapeError(f"{node}: closed shapes aren't supported")

    def severity(self, node: str, default: str = "Violation") -> str:
        value = self.one(node, "severity")
        return value.removeprefix(SH) if value else default

    def regex(self, node: str) -> str | None:
        pattern, flags = self.one(node, "pattern"), self.one(node, "flags")
        return f"(?{flags}){pattern}" if pattern and flags else pattern

    def kind(self, node: str) -> str | None:
        value = self.one(node, "nodeKind")
        return value.removeprefix(SH) if value else None

    def prefixes(self, nodes: Iterable[str]) -> dict[str, str]:
        out = {}
        for node in nodes:
            for declared, *_ in self.all(node, "declare"):
                out[self.one(declared, "prefix")] = self.one(declared, "namespace")
        return out

    # shapes
    def alternatives(self, node: str) -> tuple[list[str], list[str]] | None:
        """Datatypes and classes of a sh:or; other alternatives are refused."""
        if not self.all(node, "or"):
            return None
        datatypes, classes = [], []
        for branch, *_ in self.list(self.one(node, "or")):
            own = {p.removeprefix(SH) for p in self.of[branch]}
            if own == {"datatype"}:
                datatypes.append(self.one(branch, "datatype"))
            elif own == {"class"}:
                classes.append(self.one(branch, "class"))
            elif own == {"or"}:
                more = self.alternatives(branch)
                datatypes += more[0]
                classes += more[1]
            else:
                raise ShapeError(f"{node}: an alternative of {sorted(own)} isn't supported")
        return datatypes, classes

    def properties(self, owner: str, node: str, severity: str) -> list[shacl.Property]:
        """A property shape; one for each class or node that its values must fit."""
        if self.one(node, "deactivated") == "true":
            return []
        if not self.all(node, "path"):
            self.dangling.append((owner, node))
            return []
        self.known(node, _PROPERTY)
        path, inverse = self.one(node, "path"), False
        if path in self.of and SH + "inversePath" in self.of[path]:
            path, inverse = self.one(path, "inversePath"), True
        if path.startswith("_:"):
            raise ShapeError(f"{node}: a path must be a predicate or its inverse")
        either = self.alternatives(node)
        out = shacl.Property(
            path, inverse, self.number(node, "minCount"), self.number(node, "maxCount"), datatype=self.one(node, "datatype"), node_kind=self.kind(node), pattern=self.regex(node), min_length=self.number(node, "minLength"),
            in_=[shacl.Term(*t) for t in self.list(self.one(node, "in"))] if self.all(node, "in") else None, or_datatypes=either[0] if either else None, or_classes=either[1] if either else None,
            language_in=[t[0] for t in self.list(self.one(node, "languageIn"))] if self.all(node, "languageIn") else None, unique_lang=self.one(node, "uniqueLang") == "true", severity=self.severity(node, severity), message=self.message(node),
        )
        bare = shacl.Property(path, inverse, severity=out.severity, message=out.message)
        every = [out]
        for name, values in (("class_", [c for c, *_ in self.all(node, "class")]), ("has_value", [shacl.Term(*t) for t in self.all(node, "hasValue")])):
            every += [replace(bare, **{name: v}) for v in values]
        for inner, *_ in self.all(node, "node"):
            only = self.alternatives(inner) if {p for p in self.of[inner] if p.startswith(SH)} <= {SH + "or", *(SH + x for x in _SPOKEN), SH + "message"} else None
            every.append(replace(bare, or_datatypes=only[0], or_classes=only[1]) if only else replace(bare, node=self.shape(inner)))
        # the values' own properties are a shape of theirs
        if self.all(node, "property"):
            every.append(replace(bare, node=shacl.Shape(properties=[x for p, *_ in self.all(node, "property") for x in self.properties(node, p, out.severity)])))
        return every

    def message(self, node: str) -> str:
        """The message in English where there are several."""
        found = self.all(node, "message")
        return next((m[0] for m in found if m[3] in ("", "en")), found[0][0] if found else "")

    def shape(self, node: str) -> shacl.Shape:
        if node in self.made:
            return self.made[node]
        self.known(node, _NODE)
        severity = self.severity(node)
        out = self.made[node] = shacl.Shape(id=node, severity=severity, message=self.message(node), pattern=self.regex(node), node_kind=self.kind(node), class_=self.one(node, "class"))
        out.properties = [x for p, *_ in self.all(node, "property") for x in self.properties(node, p, severity)]
        for other, *_ in self.all(node, "node"):  # what another shape asks is asked here too
            inner = self.shape(other)
            out.properties += inner.properties
            out.sparql += inner.sparql
        for constraint, *_ in self.all(node, "sparql"):
            head = "".join(f"PREFIX {k}: <{v}>\n" for k, v in self.prefixes(p for p, *_ in self.all(constraint, "prefixes")).items())
            out.sparql.append((self.message(constraint), head + self.one(constraint, "select")))
        if self.all(node, "or"):
            raise ShapeError(f"{node}: sh:or is read inside properties only")
        return out

    def load(self) -> Loaded:
        out = []
        for node in list(self.of):
            own = self.of[node]
            types = {t for t, *_ in own.get(RDF + "type", [])}
            if self.one(node, "deactivated") == "true":
                continue
            classes = [c for c, *_ in self.all(node, "targetClass")] + ([node] if RDFS + "Class" in types and SH + "NodeShape" in types else [])
            nodes = [n for n, *_ in self.all(node, "targetNode")]
            for name in ("targetSubjectsOf", "targetObjectsOf", "target"):
                if self.all(node, name):
                    raise ShapeError(f"{node}: sh:{name} isn't supported")
            if not classes and not nodes:
                continue
            # a property shape with a target of its own is a shape of that property
            shape = shacl.Shape(id=node, properties=self.properties(node, node, "Violation")) if self.all(node, "path") else self.shape(node)
            out += [replace(shape, target_class=c) for c in classes] + ([replace(shape, target_nodes=nodes)] if nodes else [])
        return Loaded(out, sorted(set(self.dangling)), self.prefixes(list(self.of)))


def shapes(triples: Iterable[tuple]) -> Loaded:
    """The shapes with targets of a shape graph: rows (s, p, o, kind, type, lang), as sources.turtle gives them."""
    return Loader(triples).load()
