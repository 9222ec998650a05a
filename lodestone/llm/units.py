"""Bytes and words of texts as 64-bit units, and rolling hashes over them, in numpy."""

from __future__ import annotations

import numpy as np

from .common import mix

#: Sequences are hashed in pieces of about so many units.
PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C55  # odd
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A unit for each byte value.
BYTE_UNITS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


class _Powers:
    """Powers of the base and of its inverse, made once a process and longer on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, PIECE + 4096)
            grown = []
            for base in (_BASE, _INVERSE):
                out = np.full(n, base, np.uint64)
                out[0] = 1
                grown.append(np.multiply.accumulate(out))
            self.up, self.down = grown
        return self.up, self.down


POWERS = _Powers()


class Rolling:
    """Hashes of spans of a sequence of units: equal spans have equal hashes wherever they are."""

    def __init__(self, units: np.ndarray):
        up, self.down = POWERS.of(len(units) + 1)
        self.sums = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(units * up[: len(units)], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return (self.sums[k:] - self.sums[:n]) * self.down[:n]


def _pieces(raw: bytes) -> list[bytes]:
    """Parts of about PIECE bytes, cut at white space; a longer word stays whole."""
    if len(raw) <= PIECE:
        return [raw]
    flags, out, start = _SPACE[np.frombuffer(raw, np.uint8)], [], 0
    spaces = np.flatnonzero(flags)
    while len(raw) - start > PIECE:
        at = np.searchsorted(spaces, start + PIECE, "right") - 1
        if at < 0 or spaces[at] <= start:
            at += 1
        if at >= len(spaces):
            break
        out.append(raw[start : spaces[at]])
        start = int(spaces[at])
    return [*out, raw[start:]]


def word_units(raw: bytes) -> np.ndarray:
    """A 64-bit hash for each word of `bytes.split()`, in order."""
    parts = []
    for piece in _pieces(raw):
        codes = np.frombuffer(piece, np.uint8)
        inside = np.zeros(len(codes) + 2, np.int8)
        inside[1:-1] = ~_SPACE[codes]
        edges = np.diff(inside)
        start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        if start.size:
            h = Rolling(BYTE_UNITS[codes]).spans(start, end)
            parts.append(mix(h + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def many_word_units(raws: list[bytes]) -> list[np.ndarray]:
    """word_units of each; short texts are hashed together."""
    if not raws:
        return []
    joined = word_units(b"\n".join(raws)) if sum(map(len, raws)) <= 4 * PIECE else None
    if joined is None:
        return [word_units(r) for r in raws]
    counts = np.fromiter((len(r.split()) for r in raws), np.int64, len(raws))
    return np.split(joined, np.cumsum(counts)[:-1])


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of each k consecutive words; a shorter text is one shingle, an empty one none."""
    n = len(words)
    if n == 0:
        return words
    k = min(k, n)
    acc = np.full(n - k + 1, n if n < k else k, np.uint64)
    for j in range(k):
        acc = mix(acc * np.uint64(_BASE) + words[j : n - k + 1 + j])
    return acc
