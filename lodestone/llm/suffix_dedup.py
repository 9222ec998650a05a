"""Suffix-array dedup: repeated byte strings, by bucket-pointer refinement.

Texts are UTF-8 bytes. A byte goes if a string of `length` bytes that covers it also starts in
a document of smaller id; matches never cross documents and are judged on the input.

Windows of `length` bytes are dealt to buckets by their anchor (see windows.py); in a bucket a
suffix array of the contents is made by bucket-pointer refinement: suffixes are put in buckets
by their first q bytes; the members of a bucket are then sorted by the bucket pointers of the
suffixes a depth further on, and the new pointers serve the next refinement, which so looks
twice as far. Only buckets of several members are refined. A last refinement looks `length`
minus the depth further on, so that windows share a bucket if and only if they're equal.

Cases: a null or empty text has no bytes; nothing goes from a text of fewer than `length`
bytes. Documents of one id don't remove from each other, so repeated rows are treated alike;
a null id counts as the largest. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from .units import BYTE_UNITS
from .windows import Spec, covered, finished, intervals

Q = 4


def _refine(pointer: np.ndarray, active: np.ndarray, offset: int) -> np.ndarray:
    """Sort the members of each bucket by the pointers `offset` further on; returns who still shares a bucket."""
    own, then = pointer[active], pointer[active + offset]
    order = np.lexsort((then, own))
    active, own, then = active[order], own[order], then[order]
    new = np.ones(len(active), bool)
    new[1:] = own[1:] != own[:-1]
    begin = np.flatnonzero(new)  # of old buckets
    split = new.copy()
    split[1:] |= then[1:] != then[:-1]
    first = np.flatnonzero(split)
    # a pointer is the place of the bucket's first member: the old bucket's, and how many of it come before
    place = own[first] + (first - begin[np.searchsorted(begin, first, "right") - 1])
    sizes = np.diff(np.append(first, len(active)))
    pointer[active] = np.repeat(place, sizes)
    return active[np.repeat(sizes > 1, sizes)]


def bucket_pointers(data: np.ndarray, depth: int) -> np.ndarray:
    """For each position of `data` (bytes) a pointer; positions with the same next `depth` bytes, and only they, share it. The last `depth` positions are padding's neighbours and of no meaning."""
    q = min(Q, depth)
    pad = np.concatenate([data, np.zeros(2 * depth + Q, np.uint8)])
    code = np.zeros(len(pad) - Q, np.uint64)
    for j in range(q):
        code = code << np.uint64(8) | pad[j : len(code) + j]
    order = np.argsort(code, kind="stable")
    sorted_ = code[order]
    new = np.ones(len(order), bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(order)))
    pointer = np.empty(len(code), np.int64)
    pointer[order] = np.repeat(first, sizes)
    active = order[np.repeat(sizes > 1, sizes)]
    active = active[active < len(data)]
    h = q
    while h < depth and len(active):
        step = min(h, depth - h)
        active = _refine(pointer, active, step)
        h += step
    return pointer[: len(data)]


def compare(spec: Spec, units: np.ndarray, sizes: np.ndarray, ids: np.ndarray, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which windows of the contents also start in a document of smaller id."""
    W = spec.window
    pointer = bucket_pointers(units, W)
    windows = sizes - W + 1
    owner = np.repeat(np.arange(len(sizes)), windows)
    at = np.arange(len(owner)) + (np.cumsum(sizes) - sizes - np.cumsum(windows) + windows)[owner]
    pointer, ids = pointer[at], ids[owner]
    least = np.full(len(units) + 2 * W + Q, np.iinfo(np.int64).max)
    np.minimum.at(least, pointer, ids)
    return least[pointer] < ids


def _bytes(texts: list[str]) -> list[np.ndarray]:
    return [np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8) for t in texts]


def spec(length: int = 50, gram: int = 20) -> Spec:
    if not 2 <= length <= 256 or not 1 <= gram <= length:
        raise ValueError("length must lie between 2 and 256, gram between 1 and length")
    return Spec(window=length, gram=gram, within=False, units=_bytes, compare=compare, wire="<u1", lift=BYTE_UNITS.__getitem__)


def _cut(text: str, length: int, whole: bytes | None, part: bytes | None) -> tuple[int, list[tuple[int, int]], bytes]:
    """Bytes of a text, the spans that go, and the bytes that stay."""
    raw = text.encode("utf-8", "surrogatepass")
    if whole is None and part is None:
        return len(raw), [], raw
    gone = covered(len(raw), length, whole, part)
    return len(raw), intervals(gone), np.frombuffer(raw, np.uint8)[~gone].tobytes()


def kept(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """id, kept (bytes that stay; a cut may part a character), spans (begin, end of removed runs of bytes)."""

    def row(text: str, whole: bytes | None, part: bytes | None) -> tuple:
        _, spans, rest = _cut(text, length, whole, part)
        return rest, [{"begin": a, "end": b} for a, b in spans]

    s = spec(length)
    return finished(df, s, id_col, text_col, "kept binary, spans array<struct<begin:long,end:long>>", row)


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256."""

    def row(text: str, whole: bytes | None, part: bytes | None) -> tuple:
        n, spans, rest = _cut(text, length, whole, part)
        return n, n - len(rest), len(spans), hashlib.sha256(rest).hexdigest()

    s = spec(length)
    return finished(df, s, id_col, text_col, "n_bytes long, n_removed long, n_spans long, kept_sha256 string", row)
