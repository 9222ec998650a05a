"""Substring dedup: suffix automata of reference shards, and documents streamed through them.

Words are what `bytes.split()` leaves of the UTF-8 text. A word goes if a window of `window`
words that covers it also starts earlier: in a document of smaller id, or earlier in the same.

The reference is the corpus itself, so it can't be broadcast: it grows with the input. Its
shards are the buckets of windows.py instead; contents that share an anchor meet in a bucket
in the order (id, start), each is streamed through the automaton of those before it (the
matching statistic at a word is the length of the longest suffix that occurs there; from
`window` on, the window that ends there is a repeat) and then joins the automaton.
`against` is the broadcast form for a separate reference of checked size.

Cases: a null or empty text has no words, a text of fewer than `window` words loses none.
Repeated rows (same id and text) count as one document and get the same answer; different texts
of one id, or without id, don't remove from each other; a null id counts as the largest. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts
from .units import many_word_units
from .windows import Spec, covered, finished, intervals, runs_of_texts


class SuffixAutomaton:
    """Of several sequences of hashable units; a sequence starts anew at the root."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, moves: dict) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _clone(self, p: int, unit, q: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(unit) == q:
            self.next[p][unit] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, sequence) -> None:
        last = 0
        for unit in sequence:
            q = self.next[last].get(unit)
            if q is not None:  # known from another sequence
                last = q if self.length[q] == self.length[last] + 1 else self._clone(last, unit, q)
                continue
            now = self._state(self.length[last] + 1, 0, {})
            p = last
            while p >= 0 and unit not in self.next[p]:
                self.next[p][unit] = now
                p = self.link[p]
            if p >= 0:
                q = self.next[p][unit]
                self.link[now] = q if self.length[q] == self.length[p] + 1 else self._clone(p, unit, q)
            last = now

    def statistics(self, sequence) -> list[int]:
        """At each unit the length of the longest suffix read so far that occurs in the reference."""
        out, state, n = [], 0, 0
        nexts, link, length = self.next, self.link, self.length
        for unit in sequence:
            to = nexts[state].get(unit)
            while to is None and state:
                state = link[state]
                n = length[state]
                to = nexts[state].get(unit)
            if to is not None:
                state, n = to, n + 1
            out.append(n)
        return out


def compare(spec: Spec, units: np.ndarray, sizes: np.ndarray, ids: np.ndarray, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which windows of the contents occur in a content of a smaller id, or earlier in their own text."""
    W = spec.window
    contents = np.split(units, np.cumsum(sizes)[:-1])
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(contents)
    anchors = np.zeros(len(contents), np.uint64)
    for owner, _, _, key, _ in runs_of_texts(spec, contents):
        anchors[owner] = key
    order = np.lexsort((starts, hashes, ids, anchors))
    cut = lambda *keys: np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
    automaton, of = SuffixAutomaton(), None
    for group in np.split(order, cut(anchors[order], ids[order])):
        if anchors[group[0]] != of:  # windows of other anchors can't be equal: a shard has an automaton for each
            automaton, of = SuffixAutomaton(), anchors[group[0]]
        texts = np.split(group, cut(hashes[group]))
        for text in texts:
            # texts that share an id don't see each other, only what has a smaller id, and themselves
            own = automaton if len(texts) == 1 else SuffixAutomaton()
            for k in text.tolist():
                words = contents[k].tolist()
                out[k] = np.array(automaton.statistics(words)[W - 1 :]) >= W
                if own is not automaton:
                    out[k] |= np.array(own.statistics(words)[W - 1 :]) >= W
                if not out[k].all():
                    own.add(words)
        if len(texts) > 1:
            for k in group.tolist():
                if not out[k].all():
                    automaton.add(contents[k].tolist())
    return np.concatenate(out)


def _words(texts: list[str]) -> list[np.ndarray]:
    return many_word_units([t.encode("utf-8", "surrogatepass") for t in texts])


def spec(window: int = 20, gram: int = 8) -> Spec:
    if not 2 <= window <= 256 or not 1 <= gram <= window:
        raise ValueError("window must lie between 2 and 256, gram between 1 and window")
    return Spec(window=window, gram=gram, within=True, units=_words, compare=compare)


def _cut(text: str, window: int, whole: bytes | None, part: bytes | None) -> tuple[list[bytes], list[tuple[int, int]], list[bytes]]:
    """Words of a text, the spans of words that go, and the words that stay."""
    words = text.encode("utf-8", "surrogatepass").split()
    if whole is None and part is None:
        return words, [], words
    gone = covered(len(words), window, whole, part)
    return words, intervals(gone), [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def kept(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """id, kept_text (words that stay, joined by a blank), spans (begin, end of removed runs of words)."""

    def row(text: str, whole: bytes | None, part: bytes | None) -> tuple:
        _, spans, rest = _cut(text, window, whole, part)
        return b" ".join(rest).decode("utf-8", "surrogatepass"), [{"begin": a, "end": b} for a, b in spans]

    s = spec(window)
    return finished(df, s, id_col, text_col, "kept_text string, spans array<struct<begin:long,end:long>>", row)


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """id, n_words, n_removed, kept_sha256."""

    def row(text: str, whole: bytes | None, part: bytes | None) -> tuple:
        words, _, rest = _cut(text, window, whole, part)
        return len(words), len(words) - len(rest), hashlib.sha256(b" ".join(rest)).hexdigest()

    s = spec(window)
    return finished(df, s, id_col, text_col, "n_words long, n_removed long, kept_sha256 string", row)


#: Words of a reference that may be broadcast as automata.
MAX_REFERENCE_WORDS = 2_000_000
MAX_REFERENCE_BYTES = 64 << 20


def against(df: DataFrame, reference: DataFrame, keep: list[str], text_col: str = "text", window: int = 20, out: str = "kept_text") -> DataFrame:
    """df's texts without the spans of `window` words or more that occur in `reference` (of checked size, broadcast)."""
    # rows and bytes are bounded before anything comes to the driver
    rows_, size = reference.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.col(text_col).cast("string"))), F.lit(0))).first()
    if rows_ > MAX_REFERENCE_WORDS or size > MAX_REFERENCE_BYTES:
        raise ValueError("the reference exceeds MAX_REFERENCE_WORDS or MAX_REFERENCE_BYTES; join it to the corpus and use dedup")
    units = _words([t or "" for t in reference.select(F.col(text_col).cast("string").alias("t")).toPandas()["t"]])
    if sum(map(len, units)) > MAX_REFERENCE_WORDS:
        raise ValueError("the reference exceeds MAX_REFERENCE_WORDS; join it to the corpus and use dedup")
    shared = df.sparkSession.sparkContext.broadcast(units)

    def build() -> SuffixAutomaton:
        automaton = SuffixAutomaton()
        for u in shared.value:
            automaton.add(u.tolist())
        return automaton

    def rows(found, automaton):
        for text, u in zip(found, _words(found), strict=True):
            n = np.array(automaton.statistics(u.tolist()), np.int64)
            edge = np.zeros(len(u) + 1, np.int32)
            for end in np.flatnonzero(n >= window).tolist():
                edge[end + 1 - n[end]] += 1
                edge[end + 1] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            yield (" ".join(w.decode("utf-8", "surrogatepass") for w, g in zip(text.encode("utf-8", "surrogatepass").split(), gone.tolist(), strict=True) if not g),)

    return map_texts(df, keep, text_col, f"`{out}` string", rows, build)
