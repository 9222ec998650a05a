"""Secret scan: assignment-aware lexing.

Source code and configuration are lexed into name-literal pairs (`name = "literal"`,
`"name": "literal"`, `NAME=literal`, `name => 'literal'`, a literal in three quotes, a block
under `name: |`), with block comments, line ends after "+" and parentheses between their parts;
literals that stand side by side are one. Constants are propagated (`key = BASE + "tail"`,
`password = DEFAULT`), and a literal is scored by how sensitive the names are that it reaches
and by how random it looks. Three base patterns are searched beside it; their spans are always
kept.

A value keeps its own pieces and the values that it refers to, and what scoring needs of them
added up, so neither long chains nor doublings (`a = a + a`) outgrow the text.

Cases: a null or empty text has no spans. Offsets are code points, ends exclusive. Very
long texts, names and chains are scanned whole. A name is looked up among the assignments of its own
text only, without regard to scopes: the last one before a use counts, or the first after it if
there is none; names that only refer to each other hold nothing.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, spare

KINDS = ("assign", "access", "hex", "lexed", "propagated")
ORDER = {k: i for i, k in enumerate(KINDS)}

_BASE_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_BASE_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_BASE_HEX = re.compile(r"[0-9a-f]{16,}")

#: name, operator, then what is assigned: an indented block, or literals and names joined by "+".
_NAME = r"[A-Za-z_][A-Za-z0-9_.\-]*+"
_GAP = r"[\x20\t]*+"
_QUOTED = r"(?:[rRbBuUfF]{1,2}(?=[\"']))?(?:\"{3}(?:[^\"\\]|\\.|\"(?!\"\"))*+\"{3}|'{3}(?:[^'\\]|\\.|'(?!''))*+'{3}|\"(?:[^\"\\\n]|\\.)*+\"|'(?:[^'\\\n]|\\.)*+')|`[^`]*+`"
_ATOM = rf"{_QUOTED}|[^\s\"'`,;(){{}}\[\]+]+"
_JOIN = rf"{_GAP}(?:(?:\\?\n{_GAP})?\+(?:{_GAP}\\?\n)?{_GAP}|(?:\\?\n{_GAP})?(?=[\"']|[rRbBuUfF]{{1,2}}[\"']))"
_BLOCK = r"[|>][+\-]?[\x20\t]*\n(?:[\x20\t]+\S[^\n]*+(?:\n|\Z))++"
_PAIR = re.compile(rf"(?<![A-Za-z0-9_.\-])[\"']?({_NAME})[\"']?{_GAP}(=>|:=|[:=])(?!=){_GAP}(?:({_BLOCK})|(?:\({_GAP}(?:\n{_GAP})?)?((?:{_ATOM})(?:{_JOIN}(?:{_ATOM}))*))", re.S)
_PART = re.compile(_ATOM, re.S)
_LEXEME = re.compile(rf"{_QUOTED}|/\*", re.S)
_LITERAL = re.compile(r"[rRbBuUfF]{0,2}(\"{3}|'{3}|[\"'`])")
_LINE = re.compile(r"\S(?:[^\n]*\S)?")

#: Weights of words that make a name sensitive.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "private": 0.5, "access": 0.4, "auth": 0.6, "bearer": 0.8, "key": 0.5, "signing": 0.4, "encryption": 0.4, "api": 0.4}
#: A name of any weight holds one of these words once its separators are gone: a text without them has no such name.
_PRE = re.compile("|".join(SENSITIVE))
_SEPARATORS = str.maketrans("", "", "_.-")
_PLACEHOLDER = re.compile(r"^(?:x+|\*+|\.+|<.*>|\$\{.*\}|%.*%|changeme|example|placeholder|none|null|true|false|todo|your[_-].*)$", re.I | re.A)
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def name_weight(name: str) -> float:
    """How sensitive a name is, 0 to 1: its words (camelCase, snake_case, dotted) add up."""
    words = [w.lower() for w in _WORDS.findall(name)]
    return min(1.0, sum(SENSITIVE.get(w, 0.0) for w in set(words)) + (1.0 if "".join(words) in SENSITIVE else 0.0))


class Sums:
    """What `randomness` needs of a literal, however long: its length and characters (both times 2^-shift), first characters and last."""

    __slots__ = ("shift", "n", "counts", "head", "tail")
    HEAD, WIDE = 16, 1024

    def __init__(self, literal: str = ""):
        self.shift, self.n, self.counts, self.head, self.tail = 0, len(literal), Counter(literal), literal[: self.HEAD], literal[-1:]

    def add(self, other: Sums) -> None:
        """This literal becomes its concatenation with the other."""
        up, down = max(0, other.shift - self.shift), max(0, self.shift - other.shift)
        # doublings make numbers of many bits; what is far below the largest says nothing
        over = self.WIDE if max(self.n >> up, other.n >> down).bit_length() > 2 * self.WIDE else 0
        if up or over:
            self.counts = Counter({c: k >> up + over for c, k in self.counts.items()})
        for c, k in other.counts.items():
            self.counts[c] += k >> down + over
        self.n = (self.n >> up + over) + (other.n >> down + over)
        self.shift += up + over
        self.head = (self.head + other.head)[: self.HEAD]
        self.tail = other.tail or self.tail

    def sample(self) -> str:
        """A literal of the same characters, beginning and end; the same one if it is short."""
        return self.head if self.n == len(self.head) and not self.shift else self.head + "".join(self.counts) + self.tail


def randomness(literal: str | Sums) -> float:
    """0 to 1: entropy of the characters, with length and mixed classes, less for placeholders."""
    s = literal if isinstance(literal, Sums) else Sums(literal)
    n, sample = s.n, s.sample()
    if n < 8 or _PLACEHOLDER.match(sample):
        return 0.0
    bits = -sum(p * math.log2(p) for c in s.counts.values() if (p := c / n))
    classes = sum(bool(re.search(p, sample)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    prose = 0.5 if " " in s.counts else 1.0
    return prose * min(1.0, bits / 4) * min(1.0, n / 16 if n < 16 else 1.0) * (0.55 + 0.15 * classes)


class Value:
    """What a name holds: its pieces (start, end), the pieces of values before it, and its literal."""

    __slots__ = ("pieces", "literal")

    def __init__(self):
        # of a value before this one, its list of pieces; a list is emptied once its spans are out
        self.pieces: list = []
        self.literal: list[str | Sums] = []

    def sums(self) -> Sums:
        if len(self.literal) != 1 or isinstance(self.literal[0], str):
            total = Sums()
            for x in self.literal:
                total.add(Sums(x) if isinstance(x, str) else x)
            self.literal = [total]
        return self.literal[0]


def _comments(text: str) -> list[tuple[int, int]]:
    """Block comments outside of literals, in one pass: one that isn't closed ends the search."""
    out, at = [], text.find("/*")
    at = 0 if at >= 0 else len(text)
    while m := _LEXEME.search(text, at):
        at = m.end()
        if m[0] == "/*":
            end = text.find("*/", at)
            if end < 0:
                break
            at = end + 2
            out.append((m.start(), at))
    return out


def _pairs(text: str) -> list[tuple[str, list[tuple[int, int, bool]]]]:
    """(name, parts of what is assigned: begin, end, may it be a name), in text order.

    Comments are blank for what stands around them, and texts of their own for what is in them."""
    comments = _comments(text)
    if not comments:
        return [p for _, *p in _found(text, 0)]
    pieces, at, out = [], 0, []
    for a, b in comments:
        pieces += [text[at:a], " " * (b - a)]
        out += _found(text[a + 2 : b - 2], a + 2)
        at = b
    out += _found("".join([*pieces, text[at:]]), 0)
    return [p for _, *p in sorted(out, key=lambda p: p[0])]


def _found(text: str, base: int) -> list[tuple[int, str, list[tuple[int, int, bool]]]]:
    out = []
    for m in _PAIR.finditer(text):
        if m[3] is not None:
            at = m.start(3) + base
            parts = [(at + x.start(), at + x.end(), False) for x in _LINE.finditer(m[3], m[3].index("\n"))]
        else:
            parts, at = [], m.start(4) + base
            for x in _PART.finditer(m[4]):
                quote = _LITERAL.match(x[0])
                a, b = at + x.start(), at + x.end()
                parts.append((a + quote.end(), b - len(quote[1]), False) if quote else (a, b, True))
        out.append((m.start(1) + base, m[1], parts))
    return out


def _valued(text: str, pairs: list) -> list[Value]:
    """What each pair's name holds: names among the parts are replaced by their values."""
    places: dict[str, list[int]] = {}
    for k, (name, _) in enumerate(pairs):
        places.setdefault(name, []).append(k)

    def meant(k: int, word: str) -> int | None:
        own = places.get(word)
        if own is None:
            return None
        i = bisect_left(own, k)
        return own[i - 1] if i else None if own[0] == k else own[0]

    values: list[Value | None] = [None] * len(pairs)
    begun = [False] * len(pairs)
    for first in range(len(pairs)):
        waiting = [first] if values[first] is None else []
        while waiting:
            k = waiting[-1]
            targets = [meant(k, text[a:b]) if name else None for a, b, name in pairs[k][1]]
            if not begun[k]:
                begun[k] = True
                missing = [t for t in targets if t is not None and not begun[t]]
                if missing:
                    waiting += reversed(missing)
                    continue
            waiting.pop()
            if values[k] is not None:
                continue
            value, refers = Value(), False
            for (a, b, _), t in zip(pairs[k][1], targets, strict=True):
                if t is None:
                    value.pieces.append((a, b))
                    value.literal.append(text[a:b])
                elif values[t] is not None:
                    refers = True
                    value.pieces.append(values[t].pieces)
                    value.literal.append(values[t].sums())
            values[k] = value
            if refers:
                value.sums()
    return values


def lexed_spans(text: str, threshold: float = 0.45) -> list[tuple[str, int, int]]:
    """Spans of literals that reach a sensitive name, directly or through other names."""
    if not _PRE.search(text.translate(_SEPARATORS).lower()):
        return []
    pairs = _pairs(text)
    out: dict[tuple[int, int], str] = {}
    bad = [v for (name, _), v in zip(pairs, _valued(text, pairs), strict=True) if (weight := name_weight(name)) > 0 and weight * randomness(v.sums()) >= threshold]
    for value in bad:
        out.update(((x, "lexed") for x in value.pieces if isinstance(x, tuple) and x[0] < x[1]))
    pending = [v.pieces for v in bad]
    while pending:
        pieces = pending.pop()
        for x in pieces:
            if isinstance(x, list):
                pending.append(x)
            elif x[0] < x[1]:
                out.setdefault(x, "propagated")
        pieces.clear()
    return [(k, a, b) for (a, b), k in out.items()]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", m.start(), m.end()) for m in _BASE_ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", m.start(), m.end()) for m in _BASE_ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in _BASE_HEX.finditer(text)]
    return found


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], ORDER[s[0]], s[2])))


def scan_text(text: str, threshold: float = 0.45) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans)."""
    base = base_spans(text)
    return base, base + lexed_spans(text, threshold)


def redact(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """Each union of overlapping spans becomes one mark."""
    out, end = [], 0
    for _, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], mark]
            end = b
        elif b > end:
            end = b
    return "".join([*out, text[end:]])


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.45) -> DataFrame:
    """id, n_assign, n_access, n_hex, n_lexed, n_propagated, base_sha256, spans."""

    def rows(texts):
        for text in texts:
            base, every = scan_text(text, threshold)
            n = Counter(k for k, _, _ in every)
            yield (*(n[k] for k in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every))

    return map_texts(df, [id_col], text_col, "n_assign long, n_access long, n_hex long, n_lexed long, n_propagated long, base_sha256 string, spans string", rows)


def redacted(df: DataFrame, text_col: str = "text", threshold: float = 0.45) -> DataFrame:
    """The same rows and columns, each secret in the text replaced by a mark; null texts stay null."""
    others = [c for c in df.columns if c != text_col]
    null, made = spare(df, "null"), spare(df, "redacted")
    out = map_texts(df.withColumn(null, F.col(f"`{text_col}`").isNull()), [*others, null], text_col, f"`{made}` string", lambda texts: [(redact(t, scan_text(t, threshold)[1]),) for t in texts])
    return out.select(*[F.when(~F.col(null), F.col(made)).alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns])
