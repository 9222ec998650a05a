"""Turtle: a tokenizer and a recursive parser, with blank nodes and collections.

A blank node is named "_:" and a label; anonymous ones get labels in the order of the text, so
that a text always gives the same triples. Triples are (s, p, o, kind, type, lang); blank nodes
are of kind "iri", told apart by their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import urljoin

XSD = "http://www.w3.org/2001/XMLSchema#"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"

Triple = tuple[str, str, str, str, str, str]
Term = tuple[str, str, str, str]  # value, kind, type, lang

_TOKEN = re.compile(
    r"""\s+|\#[^\n]*
    |(?P<iri><[^<>"{}|^`\\\s]*>)
    |(?P<text>\"{3}(?:[^"\\]|\\.|"(?!""))*\"{3}|'{3}(?:[^'\\]|\\.|'(?!''))*'{3}|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')
    |(?P<at>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)
    |(?P<type>\^\^)
    |(?P<blank>_:\w(?:[\w.-]*[\w-])?)
    |(?P<number>[-+]?(?:\d+(?:\.\d+)?|\.\d+)(?:[eE][-+]?\d+)?)(?![\w:])
    |(?P<name>(?:[^\W\d_](?:[\w.-]*[\w-])?)?:(?:(?:[\w:]|%[0-9A-Fa-f]{2}|\\[_~.!$&'()*+,;=/?\#@%-])(?:(?:[\w.:-]|%[0-9A-Fa-f]{2}|\\[_~.!$&'()*+,;=/?\#@%-])*(?:[\w:-]|%[0-9A-Fa-f]{2}|\\[_~.!$&'()*+,;=/?\#@%-]))?)?)
    |(?P<word>[A-Za-z]+)
    |(?P<mark>[.;,\[\]()])""",
    re.S | re.X,
)
_ESCAPE = re.compile(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", re.S)
_PLAIN = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}


def unescaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1][1:], 16)) if len(m[1]) > 1 else _PLAIN.get(m[1], m[1]), text)


def tokens(text: str) -> Iterator[tuple[str, str]]:
    at = 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"no Turtle at {text[at : at + 30]!r}")
        at = m.end()
        if m.lastgroup:
            yield m.lastgroup, m[0]
    yield "end", ""


class Parser:
    def __init__(self, text: str, base: str = ""):
        self.stream, self.base = tokens(text), base
        self.prefixes: dict[str, str] = {}
        self.triples: list[Triple] = []
        self.made = 0
        self.now = next(self.stream)

    def take(self) -> tuple[str, str]:
        was, self.now = self.now, next(self.stream, ("end", ""))
        return was

    def mark(self, text: str) -> bool:
        if self.now == ("mark", text):
            self.take()
            return True
        return False

    def need(self, text: str) -> None:
        if not self.mark(text):
            raise ValueError(f"expected {text!r}, found {self.now[1]!r}")

    def blank(self) -> str:
        self.made += 1
        return f"_:g{self.made}"

    def add(self, s: str, p: str, o: Term) -> None:
        self.triples.append((s, p, *o))

    # document
    def parse(self) -> Iterator[Triple]:
        """Triples, a statement at a time."""
        while self.now[0] != "end":
            kind, text = self.now
            directive = text.lstrip("@").lower()
            if kind in ("at", "word") and directive in ("prefix", "base"):
                self.take()
                if directive == "prefix":
                    name = self.take()[1].rstrip(":")
                    self.prefixes[name] = self.iri(self.take())
                else:
                    self.base = self.iri(self.take())
                if kind == "at":
                    self.need(".")
                continue
            anonymous = self.now == ("mark", "[")
            s = self.subject()
            if not (anonymous and self.now == ("mark", ".")):
                self.properties(s)
            self.need(".")
            yield from self.triples
            self.triples.clear()

    def subject(self) -> str:
        value, kind, *_ = self.object()
        if kind != "iri":
            raise ValueError(f"a literal can't be a subject: {value!r}")
        return value

    def properties(self, s: str) -> None:
        while True:
            p = RDF + "type" if self.now == ("word", "a") and self.take() else self.iri(self.take())
            while True:
                self.add(s, p, self.object())
                if not self.mark(","):
                    break
            if not self.mark(";"):
                return
            while self.mark(";"):
                pass
            if self.now[0] == "end" or self.now in (("mark", "."), ("mark", "]")):
                return

    # terms
    def iri(self, token: tuple[str, str]) -> str:
        kind, text = token
        if kind == "iri":
            return urljoin(self.base, unescaped(text[1:-1])) if self.base else unescaped(text[1:-1])
        if kind == "name":
            prefix, _, local = text.partition(":")
            if prefix in self.prefixes:
                return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local)
            raise ValueError(f"unknown prefix {prefix}:")
        raise ValueError(f"an IRI was expected, found {text!r}")

    def object(self) -> Term:
        kind, text = self.take()
        if kind in ("iri", "name"):
            return self.iri((kind, text)), "iri", "", ""
        if kind == "blank":
            return "_:n" + text[2:], "iri", "", ""
        if kind == "text":
            cut = 3 if text[:3] in ('"""', "'''") else 1
            value = unescaped(text[cut:-cut])
            if self.now[0] == "at":
                return value, "literal", RDF + "langString", self.take()[1][1:].lower()
            if self.now[0] == "type":
                self.take()
                return value, "literal", self.iri(self.take()), ""
            return value, "literal", XSD + "string", ""
        if kind == "number":
            return text, "literal", XSD + ("double" if "e" in text.lower() else "decimal" if "." in text else "integer"), ""
        if kind == "word" and text in ("true", "false"):
            return text, "literal", XSD + "boolean", ""
        if (kind, text) == ("mark", "["):
            node = self.blank()
            if not self.mark("]"):
                self.properties(node)
                self.need("]")
            return node, "iri", "", ""
        if (kind, text) == ("mark", "("):
            members = []
            while not self.mark(")"):
                members.append(self.object())
            return self.collection(members), "iri", "", ""
        raise ValueError(f"a term was expected, found {text!r}")

    def collection(self, members: list[Term]) -> str:
        if not members:
            return RDF + "nil"
        nodes = [self.blank() for _ in members]
        for node, member, rest in zip(nodes, members, [*nodes[1:], RDF + "nil"], strict=True):
            self.add(node, RDF + "first", member)
            self.add(node, RDF + "rest", (rest, "iri", "", ""))
        return nodes[0]


def turtle(text: str, base: str = "") -> list[Triple]:
    """The triples of a Turtle text, in the order of their appearance."""
    return list(stream(text, base))


def stream(text: str, base: str = "") -> Iterator[Triple]:
    """The same without holding all of them."""
    return Parser(text, base).parse()
