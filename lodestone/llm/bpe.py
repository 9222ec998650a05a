"""Byte-level BPE encoding and decoding.

A segment tree over the byte positions of a piece stores the leftmost minimum of the ranks of
neighbouring pairs. Each merge takes the root, joins two neighbours and does point updates on
the pairs left and right of it, each a walk from a leaf to the root. Pieces of one size are
merged side by side: the trees are rows of one array, a step does one merge in each. Pieces
that were met before come from a table of bounded size.

Cases: a null or empty text has no ids and decodes to no bytes. Text is encoded as UTF-8;
special tokens aren't recognised, their strings are ordinary text. Very long pieces are merged
by the same tree, alone.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

#: A node of a tree is rank << SHIFT | position.
SHIFT = 32
_POSITION = (1 << SHIFT) - 1
#: The rank of no pair.
NONE = np.int64(1) << 24
#: A rank file of more bytes isn't shipped with the tasks.
MAX_RANK_BYTES = 64 << 20
#: Pieces kept in a worker's table.
CACHE = 400_000


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        raw = f.read(MAX_RANK_BYTES + 1)
    if len(raw) > MAX_RANK_BYTES:
        raise ValueError(f"{path} exceeds {MAX_RANK_BYTES} bytes")
    return raw


class Codec:
    """Encodes pieces by the ranks of a file in "base64 rank" lines."""

    def __init__(self, raw: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append((left << 20 | right, rank))
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs] + [1 << 50], dtype=np.int64)
        self.pair_ranks = np.array([r for _, r in pairs] + [0], dtype=np.int64)
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def merge_rows(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids (little-endian, 32 bits) of pieces of 2 to `width` bytes; width is a power of two."""
        n = len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, n)
        ids = np.full((n, width), -1, np.int64)
        inside = np.arange(width) < sizes[:, None]
        ids[inside] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        col = np.arange(width)
        after = np.minimum(np.tile(col + 1, (n, 1)), width)  # the next live position; width is none
        before = np.tile(col - 1, (n, 1))
        after[col + 1 >= sizes[:, None]] = width
        # the minimum of nodes is the leftmost of the least ranks
        tree = np.full((n, 2 * width), NONE << SHIFT, np.int64)
        have = inside[:, 1:]
        first = np.full((n, width), NONE, np.int64)
        first[:, :-1][have] = self.rank_of(ids[:, :-1][have], ids[:, 1:][have])
        tree[:, width:] = first << SHIFT | col
        level = width // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2

        def put(rows: np.ndarray, at: np.ndarray, rank: np.ndarray) -> None:
            node = at + width
            tree[rows, node] = rank << SHIFT | at
            while node.size and node[0] > 1:
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        live = np.arange(n)
        while True:
            root = tree[live, 1]
            go = root >> SHIFT < NONE
            live, root = live[go], root[go]
            if not live.size:
                break
            at, rank = root & _POSITION, root >> SHIFT
            gone = after[live, at]
            ids[live, at] = rank
            ids[live, gone] = -1
            then = after[live, gone]
            after[live, at] = then
            inner = then < width
            before[live[inner], then[inner]] = at[inner]
            put(live, gone, np.full(live.size, NONE))
            right = np.full(live.size, NONE)
            right[inner] = self.rank_of(rank[inner], ids[live[inner], then[inner]])
            put(live, at, right)
            has = before[live, at] >= 0
            rows, here = live[has], at[has]
            prev = before[rows, here]
            put(rows, prev, self.rank_of(ids[rows, prev], ids[rows, here]))
        kept = ids >= 0
        flat = ids[kept].astype("<u4").tobytes()
        ends = np.cumsum(kept.sum(axis=1)) * 4
        return [flat[a:b] for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist(), strict=True)]

    def encode_pieces(self, pieces: list[str]) -> None:
        """Put pieces into the table."""
        by: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(raw)
            if whole is not None:
                self.known[piece] = whole.to_bytes(4, "little")
            else:
                by.setdefault(1 << (len(raw) - 1).bit_length(), []).append((piece, raw))
        for width, group in by.items():
            step = max(1, (1 << 19) // width)
            for i in range(0, len(group), step):
                part = group[i : i + step]
                self.known.update(zip((p for p, _ in part), self.merge_rows([r for _, r in part], width), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian 32-bit."""
        split = [self.split(t) for t in texts]
        known = self.known
        fresh = set().union(*split).difference(known)
        if len(known) + len(fresh) > CACHE:
            known.clear()
            fresh = set().union(*split)
        self.encode_pieces(list(fresh))
        return [b"".join(map(known.__getitem__, s)) for s in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(raw: bytes, pattern: str) -> Codec:
    """One for each worker; it outlives a task."""
    return Codec(raw, pattern)


def digests(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def rows(texts, state):
        for ids in state.encode(texts):
            yield len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(state.decode(ids)).hexdigest()

    return map_texts(df, [id_col], text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", rows, lambda: codec(shared.value, pattern))


def encoded(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_name: str = "input_ids", count_name: str = "n_tokens") -> DataFrame:
    """All columns, with the ids and their number; columns of those two names are replaced."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    keep = [c for c in df.columns if c not in (ids_name, count_name)]

    def rows(texts, state):
        for ids in state.encode(texts):
            yield np.frombuffer(ids, "<u4").astype(np.int32), len(ids) // 4

    return map_texts(df, keep, text_col, f"`{ids_name}` array<int>, `{count_name}` long", rows, lambda: codec(shared.value, pattern))


def decoded(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "input_ids", out: str = "decoded") -> DataFrame:
    """All columns, with the text of the ids; bytes that are no UTF-8 become U+FFFD. Null ids give null."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    @F.pandas_udf("string")
    def back(ids):
        c = codec(shared.value, pattern)
        return ids.map(lambda x: None if x is None else c.decode(np.asarray(x, "<u4").tobytes()).decode("utf-8", "replace"))

    return df.withColumn(out, back(F.col(f"`{ids_col}`")))
