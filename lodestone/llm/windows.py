"""Windows of units that occur more than once in a corpus, found without comparing texts with each other.

Every window of W consecutive units picks the k-gram of least hash inside it, its anchor; equal
windows pick equal anchors at equal offsets. The consecutive windows of a text that share an
anchor form a run, about (W - k) / 2 windows long.

1. announce: a task hashes its texts and tells the bucket of each anchor (a hash of the gram)
   the run's fingerprint. Runs that are alike inside a task are told once, by the earliest text.
2. settle: a bucket sees all runs of an anchor. Of alike runs the earliest stays, the others
   are repeats as wholes. Where one anchor has unlike runs, the first run of each kind is asked for its content.
3. compare: the contents asked for go to the bucket again, where `compare` (a suffix array, a
   suffix automaton) says which of their windows occur in earlier ones. The runs of an anchor
   with very many kinds are sent window by window, each to the bucket of its own hash.

Answers are intervals of window starts. They go to blocks of texts, are put together there for
each text, and meet the texts by a join on the id and 63 bits of the text's hash, which tell
apart texts that share an id or have none; the exchange of the texts is the same for both
joins, so Spark reuses it. A null id counts as the largest, as 2^63 - 1.

Larger inputs go in rounds, so that less lies on the disks at a time: the first pass tells and settles
a part of the buckets in each, and in each a part of the texts, dealt by their hash, meets its answers.
What a round found is stored, and its shuffles go before the next one's are written. All rounds together
do the same work, whatever their number; only the texts are read anew in each.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_scratch, mix, scratch, shuffles_dropped, text_chunks
from .units import PIECE, Rolling

#: Runs that a task gathers before it tells them.
GATHER = 800_000
#: Parts of a bucket that are worked on one after the other; a bucket's rows stay together, so that tasks x buckets rows travel.
PARTS = 4
#: Kinds of run of one anchor from which windows are routed one by one.
MANY_KINDS = 2_000
#: Rounds in which runs are told (each hashes all texts), and in which texts meet their answers.
TOLD_ROUNDS, MET_ROUNDS = 2, 4
#: Bytes of input from which there are rounds.
ROUNDS_FROM = 32 << 20
_LOW = np.uint64(0xFFFFFFFF)
_POS = np.uint64(0xFFFFF)
REPEAT, ASK, ASK_SINGLY = 0, 1, 2


@dataclass(frozen=True)
class Spec:
    window: int
    gram: int
    #: whether an earlier start in the same document counts
    within: bool
    #: texts -> units of each
    units: Callable[[list[str]], list[np.ndarray]]
    #: contents end to end, the size, id, hash and start of each -> for each of their windows: does it start earlier too
    compare: Callable[["Spec", np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
    #: type of the units
    wire: str = "<u8"
    #: units -> 64-bit hashes of them
    lift: Callable[[np.ndarray], np.ndarray] = np.asarray


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    done = 1
    while done * 2 <= w:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return x if done == w else np.minimum(x[: len(x) - (w - done)], x[w - done :])


def runs_of(spec: Spec, units: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """first window start, windows - 1, key and fingerprint of each run in texts laid end to end; ends: where the text of each unit ends."""
    W, k = spec.window, spec.gram
    if len(units) < W:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    roll = Rolling(spec.lift(units))
    grams = mix(roll.grams(k))
    order = (grams & ~_POS) | np.arange(len(grams), dtype=np.uint64)
    anchor = (sliding_min(order, W - k + 1) & _POS).astype(np.int64)
    start = np.arange(len(anchor))
    valid = start + W <= ends[: len(anchor)]
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    last = valid.copy()
    last[:-1] &= new[1:] | ~valid[1:]
    a, b = np.flatnonzero(new), np.flatnonzero(last)
    p = anchor[a]
    print_ = mix(roll.spans(a, b + W) + ((p - a) << 20 | (b - a)).astype(np.uint64) * np.uint64(0xC6A4A7935BD1E995))
    return a, b - a, mix(grams[p] ^ np.uint64(0x5851F42D4C957F2D)), print_


def runs_of_texts(spec: Spec, texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
    """(text index, first window start in its text, windows - 1, key, fingerprint), pieces of bounded size at a time."""
    W, room = spec.window, PIECE - 1
    pieces: list[tuple[int, int, np.ndarray]] = []
    size = 0

    def flush():
        lens = np.array([len(u) for _, _, u in pieces])
        ends = np.cumsum(lens)
        a, n, key, fp = runs_of(spec, np.concatenate([u for _, _, u in pieces]), np.repeat(ends, lens))
        which = np.searchsorted(ends, a, "right")
        owner = np.array([i for i, _, _ in pieces])[which]
        return owner, a - (ends - lens)[which] + np.array([o for _, o, _ in pieces])[which], n, key, fp

    for i, u in enumerate(texts):
        for o in range(0, max(1, len(u) - W + 1), room - W + 1):
            part = u[o : o + room]
            if len(part) < W:
                continue
            if pieces and size + len(part) > room:
                yield flush()
                pieces, size = [], 0
            pieces.append((i, o, part))
            size += len(part)
    if pieces:
        yield flush()


# --- packing -----------------------------------------------------------------------------
def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of non-negative integers, each in the narrowest type that holds it."""
    parts, head = [], [len(arrays)]
    for x in arrays:
        top = int(x.max()) if len(x) else 0
        width = 0 if top < 1 << 8 else 1 if top < 1 << 16 else 2 if top < 1 << 32 else 3
        parts.append(x.astype(f"<u{1 << width}").tobytes())
        head += [width, len(x)]
    return b"".join([np.array(head, "<u4").tobytes(), *parts])


def unpacked(raw: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    head = np.frombuffer(raw, "<u4", 2 * n, 4).tolist()
    at, out = 4 + 8 * n, []
    for width, size in zip(head[::2], head[1::2], strict=True):
        out.append(np.frombuffer(raw, f"<u{1 << width}", size, at))
        at += size << width
    return out


def pack_head(ids: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of entries sorted by (id, hash): each text once, its id as the step from the one before, with the number of its entries."""
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])
    own = np.flatnonzero(new)
    # ids are taken modulo 2^64, so that negative ones pack too
    return np.diff(ids[own].astype(np.uint64), prepend=np.uint64(0)), hashes[own], np.diff(np.append(own, len(ids)))


def unpack_head(steps: np.ndarray, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids = np.cumsum(steps.astype(np.uint64), dtype=np.uint64).astype(np.int64)
    return np.repeat(ids, counts), np.repeat(hashes.astype(np.int64), counts)


def _pack_entries(ids, hashes, a, n, *more) -> bytes:
    """Starts in two halves: the upper are mostly zero."""
    return packed(*pack_head(ids, hashes), a & 0xFFFF, a >> 16, n, *more)


def _unpack_entries(raw: bytes) -> tuple[np.ndarray, ...]:
    steps, hashes, counts, low, high, n, *more = unpacked(raw)
    return *unpack_head(steps, hashes, counts), high.astype(np.int64) << 16 | low, n.astype(np.int64), *more


def _pack_runs(ids, hashes, a, n, key, fp) -> bytes:
    return _pack_entries(ids, hashes, a, n, key & _LOW, fp & _LOW, fp >> np.uint64(48))


def _unpack_runs(raw: bytes) -> tuple[np.ndarray, ...]:
    *head, key, low, high = _unpack_entries(raw)
    return *head, key.astype(np.uint64), high.astype(np.uint64) << np.uint64(32) | low


def block_of(ids: np.ndarray, hashes: np.ndarray, blocks: int) -> np.ndarray:
    """Where a text's answers meet: by its id and hash, so that texts of one id or of none are spread."""
    return (mix(ids.astype(np.uint64) ^ mix(hashes.astype(np.uint64))) % np.uint64(blocks)).astype(np.int64)


def _replies(buckets: int, ids, hashes, a, n, kind, bucket) -> Iterator[tuple[int, bytes]]:
    """Rows (-1 - block, payload). Replies are short, so there is a block for four buckets."""
    if not len(ids):
        return
    blocks = -(-buckets // 4)
    block = block_of(ids, hashes, blocks)
    order = np.lexsort((a, hashes, ids, block))
    cut = np.searchsorted(block[order], np.arange(blocks + 1))
    for k in np.flatnonzero(np.diff(cut)).tolist():
        x = order[cut[k] : cut[k + 1]]
        yield -1 - k, _pack_entries(ids[x], hashes[x], a[x], n[x], kind[x], bucket[x])


_ROWS_DDL = "bucket int, payload binary"


def _batches(rows: Iterable[tuple[int, bytes]], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in held], pa.int32()), pa.array([r[1] for r in held], pa.binary())], names=["bucket", "payload"])

    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[1])
        if size > most:
            yield made()
            held, size = [], 0
    if held:
        yield made()


def _repeats(spec: Spec, ids, hashes, a, groups: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by (groups, id, hash, start); in it: does an entry repeat one of a smaller id (or of its own text), does a group begin."""
    order = np.lexsort((a, hashes, ids, *groups[::-1]))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for g in groups:
        s = g[order]
        new[1:] |= s[1:] != s[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    ids_s, a_s, h_s = ids[order], a[order], hashes[order]
    repeat = ids_s > ids_s[first]
    if spec.within:
        text = new.copy()
        text[1:] |= (ids_s[1:] != ids_s[:-1]) | (h_s[1:] != h_s[:-1])
        repeat |= a_s > a_s[np.maximum.accumulate(np.where(text, np.arange(len(order)), 0))]
    return order, repeat, new


# --- stages ------------------------------------------------------------------------------
Stage = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _announce(spec: Spec, buckets: int, turn: int = 0, rounds: int = 1) -> Stage:
    """(id, h, text) -> runs for the buckets whose turn it is, and replies for what is repeated inside the task."""

    def tell(held: list[tuple]) -> Iterator[tuple[int, bytes]]:
        ids, hashes, a, n, key, fp = (np.concatenate(x) for x in zip(*held, strict=True))
        order, repeat, _ = _repeats(spec, ids, hashes, a, [key, fp])
        gone, stay = order[repeat], order[~repeat]
        zero = np.zeros(len(gone), np.int64)
        yield from _replies(buckets, ids[gone], hashes[gone], a[gone], n[gone], zero, zero)
        bucket = ((key[stay] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        by = np.lexsort((a[stay], hashes[stay], ids[stay], bucket))
        cut = np.searchsorted(bucket[by], np.arange(buckets + 1))
        for k in np.flatnonzero(np.diff(cut)).tolist():
            x = stay[by[cut[k] : cut[k + 1]]]
            yield k, _pack_runs(ids[x], hashes[x], a[x], n[x], key[x], fp[x])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            ids, hashes = (np.asarray(batch.column(i)) for i in (0, 1))
            for start, texts in text_chunks(batch, 2):
                for owner, a, n, key, fp in runs_of_texts(spec, spec.units(texts)):
                    if rounds > 1:
                        x = (key >> np.uint64(32)) % np.uint64(buckets) % np.uint64(rounds) == np.uint64(turn)
                        owner, a, n, key, fp = owner[x], a[x], n[x], key[x], fp[x]
                    held.append((ids[start + owner], hashes[start + owner].astype(np.int64), a, n, key, fp))
                    count += len(a)
                if count >= GATHER:
                    yield from _batches(tell(held))
                    held, count = [], 0
        if count:
            yield from _batches(tell(held))

    return run


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """The payloads of one bucket after the other; rows come sorted by bucket."""
    now, rows = None, []
    for batch in batches:
        for bucket, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if bucket != now:
                if rows:
                    yield now, rows
                now, rows = bucket, []
            rows.append(payload)
    if rows:
        yield now, rows


def _each_bucket(of: Callable[[int, list[bytes]], Iterator[tuple[int, bytes]]]) -> Stage:
    """A stage on buckets; replies (negative buckets) are passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(r for bucket, rows in _by_bucket(batches) for r in (of(bucket, rows) if bucket >= 0 else ((bucket, p) for p in rows)))

    return run


def _settle(spec: Spec, buckets: int) -> Stage:
    def of(bucket: int, rows: list[bytes]) -> Iterator[tuple[int, bytes]]:
        every = [np.concatenate(x) for x in zip(*map(_unpack_runs, rows), strict=True)]
        part = every[4] % np.uint64(PARTS)
        for k in range(PARTS):
            x = part == np.uint64(k)
            if x.any():
                yield from settle(bucket + k * buckets, *(y[x] for y in every))

    def settle(to: int, ids, hashes, a, n, key, fp) -> Iterator[tuple[int, bytes]]:
        order, repeat, new = _repeats(spec, ids, hashes, a, [key, fp])
        ids, hashes, a, n, key = (x[order] for x in (ids, hashes, a, n, key))
        head = np.ones(len(key), bool)
        head[1:] = key[1:] != key[:-1]
        group, heads = np.cumsum(head) - 1, np.flatnonzero(head)
        kinds = np.bincount(group, weights=new)[group]
        several = np.minimum.reduceat(ids, heads) < np.maximum.reduceat(ids, heads)
        ask = ~repeat & (kinds > 1) & (spec.within | several[group])
        kind = np.where(repeat, REPEAT, np.where(kinds > MANY_KINDS, ASK_SINGLY, ASK))
        x = repeat | ask
        yield from _replies(buckets, ids[x], hashes[x], a[x], n[x], kind[x], np.full(int(x.sum()), to))

    return _each_bucket(of)


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The replies of a block of ids -> (id, h, answer), a row for each text."""
    names, types = ["id", "h", "asks", "answer"], [pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    for _, rows in _by_bucket(batches):
        ids, hashes, a, n, kind, bucket = (np.concatenate(x) for x in zip(*map(_unpack_entries, rows), strict=True))
        order = np.lexsort((a, hashes, ids))
        ids, hashes, a, n, kind, bucket = (x[order] for x in (ids, hashes, a, n, kind, bucket))
        cut = np.flatnonzero((ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])) + 1
        bounds = list(zip([0, *cut.tolist()], [*cut.tolist(), len(ids)], strict=True))
        for i in range(0, len(bounds), 2000):
            some = bounds[i : i + 2000]
            out = [(int(ids[s]), int(hashes[s]), bool((kind[s:e] != REPEAT).any()), packed(a[s:e], n[s:e], kind[s:e], bucket[s:e])) for s, e in some]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def _contents(spec: Spec, buckets: int) -> Stage:
    """(id, h, text, answer) -> the contents asked for, to their buckets; contents alike in a task are sent once, by the earliest text."""

    def asked(texts: list[str], rows: list[tuple]) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
        for units, (i, h, answer) in zip(spec.units(texts), rows, strict=True):
            a, n, kind, bucket = (x.tolist() for x in unpacked(answer))
            for s, m, how, to in zip(a, n, kind, bucket, strict=True):
                if how == ASK:
                    yield to, i, h, s, units[s : s + m + spec.window]
                elif how == ASK_SINGLY:
                    roll = Rolling(spec.lift(units[s : s + m + spec.window]))
                    at = np.arange(m + 1)
                    for t, k in enumerate((mix(roll.spans(at, at + spec.window)) % np.uint64(buckets * PARTS)).tolist()):
                        yield k, i, h, s + t, units[s + t : s + t + spec.window]

    def send(held: dict, repeats: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, bytes]]:
        by = defaultdict(list)
        for k, (i, h, starts) in held.items():
            by[k[0]].append((i, h, starts, k[1]))
        size, out = np.dtype(spec.wire).itemsize, defaultdict(list)
        for to, rows in by.items():
            ids, hashes, starts, raws = zip(*rows, strict=True)
            part = packed(np.array([to // buckets]), np.array(ids).astype(np.uint64), np.array(hashes), np.array([len(s) for s in starts]), np.concatenate(starts), np.array([len(r) // size for r in raws]), np.frombuffer(b"".join(raws), spec.wire))
            out[to % buckets] += [len(part).to_bytes(4, "little"), part]
        for bucket, parts in out.items():
            yield bucket, b"".join(parts)
        if repeats:
            ids, hashes, a, n = (np.array(x, np.int64) for x in zip(*repeats, strict=True))
            yield from _replies(buckets, ids, hashes, a, n, np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[int, int, list[int]]] = {}
        repeats: list[tuple[int, int, int, int]] = []

        def put(bucket: int, i: int, h: int, s: int, units: np.ndarray) -> None:
            key, more = (bucket, units.tobytes()), len(units) - spec.window
            first = held.get(key)
            if first is not None and first[0] == i and first[1] != h:  # another text of the same id
                key = (*key, h)
                first = held.get(key)
            if first is None:
                held[key] = (i, h, [s])
            elif first[0] == i and not spec.within:
                first[2].append(s)
            elif (i, s) < (first[0], first[2][0]):
                held[key] = (i, h, [s])
                repeats.extend((first[0], first[1], t, more) for t in first[2])
            elif (i, s) > (first[0], first[2][0]):
                repeats.append((i, h, s, more))

        for batch in batches:
            ids, hashes, answers = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for start, texts in text_chunks(batch, 2):
                stop = start + len(texts)
                for x in asked(texts, list(zip(ids[start:stop], hashes[start:stop], answers[start:stop], strict=True))):
                    put(*x)
                if len(held) + len(repeats) >= 200_000:
                    yield from _batches(send(held, repeats))
                    held.clear()
                    repeats.clear()
        yield from _batches(send(held, repeats))

    return run


def _compare(spec: Spec, buckets: int) -> Stage:
    def of(bucket: int, rows: list[bytes]) -> Iterator[tuple[int, bytes]]:
        parts: dict[int, list] = defaultdict(list)
        for p in rows:
            at = 0
            while at < len(p):
                n = int.from_bytes(p[at : at + 4], "little")
                which, *more = unpacked(p[at + 4 : at + 4 + n])
                parts[int(which[0])].append(more)
                at += 4 + n
        for part in parts.values():
            yield from compare(*(np.concatenate(x) for x in zip(*part, strict=True)))

    def compare(ids, hashes, counts, starts, sizes, units) -> Iterator[tuple[int, bytes]]:
        ids, hashes, counts, starts, sizes = (x.astype(np.int64) for x in (ids, hashes, counts, starts, sizes))
        begin = np.cumsum(counts) - counts
        hit = spec.compare(spec, units.astype(spec.wire), sizes, ids, hashes, starts[begin])
        windows = sizes - spec.window + 1
        owner = np.repeat(np.arange(len(sizes)), windows)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = np.flatnonzero(hit)
        if not len(at):
            return
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (owner[at[1:]] != owner[at[:-1]])
        first = np.flatnonzero(new)
        more = np.diff(np.append(first, len(at))) - 1
        k, offset = owner[at[first]], place[at[first]]
        # a content may stand at several starts of its text
        every = np.repeat(np.arange(len(k)), counts[k])
        nth = np.arange(len(every)) - np.repeat(np.cumsum(counts[k]) - counts[k], counts[k])
        k = k[every]
        zero = np.zeros(len(every), np.int64)
        yield from _replies(buckets, ids[k], hashes[k], starts[begin[k] + nth] + offset[every], more[every], zero, zero)

    return _each_bucket(of)


def _sorted(df: DataFrame, buckets: int) -> DataFrame:
    """Buckets meet, as many of them in a task as there are more than shuffle partitions; a worker holds one at a time."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(tasks, buckets // 8), "bucket").sortWithinPartitions("bucket")


_TEXT_DDL = "id long, h long, asks boolean, answer binary"
LAST = (1 << 63) - 1
#: Bytes of input for each bucket, about; a bucket is worked on in one worker's memory.
BUCKET_BYTES = 64 << 20
MOST_BUCKETS = 50_000


def identified(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, text): what tells a text from all others; equal rows are alike."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return df.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(text).bitwiseAND(F.lit(LAST)).alias("h"), text.alias("text"))


def known_bytes(df: DataFrame) -> int:
    """Bytes of the files that a table is read from, by the plan's estimate."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    return sum(x for x in sizes if x < 1 << 60)  # of other leaves nothing is known


def bucket_number(df: DataFrame) -> int:
    """Buckets for a table: a shuffle partition each, more where the bytes of the files that it is read from ask for it. Results don't depend on it."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, least, min(MOST_BUCKETS, known_bytes(df) // BUCKET_BYTES))


def _stored(df: DataFrame, label: str) -> str:
    """The folder that df is written to; its shuffles go when that is done."""
    path = scratch(df.sparkSession, label)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return path


def _in_rounds(spark: SparkSession, rounds: int, label: str, of: Callable[[int], DataFrame]) -> tuple[DataFrame, list[str]]:
    """The rows of all rounds, and the folders that they are stored in; a single round is left to be made when it is read."""
    if rounds == 1:
        return of(0), []
    paths = [_stored(of(k), label) for k in range(rounds)]
    return spark.read.parquet(*paths), paths


def _settled(docs: DataFrame, spec: Spec, buckets: int, rounds: int) -> list[str]:
    """Where the answers of the first pass are stored, a row for each text; blocks of texts are put together in as many rounds as buckets are told in."""
    spark = docs.sparkSession

    def settled(k: int) -> DataFrame:
        told = docs.select("id", "h", "text").mapInArrow(_announce(spec, buckets, k, rounds), _ROWS_DDL)
        return _sorted(told, buckets).mapInArrow(_settle(spec, buckets), _ROWS_DDL)

    # the runs told are most of what is shuffled; they go before the texts are
    replies, paths = _in_rounds(spark, rounds, "settled", settled)
    some = [replies if rounds == 1 else replies.where(F.pmod("bucket", F.lit(rounds)) == k) for k in range(rounds)]
    whole = [_stored(_sorted(x, buckets).mapInArrow(_collect, _TEXT_DDL), "windows") for x in some]
    for path in paths:
        drop_scratch(spark, path)
    return whole


def _dealt(df: DataFrame, k: int, rounds: int) -> DataFrame:
    """The texts (or answers) of a round."""
    return df if rounds == 1 else df.where(F.pmod(F.xxhash64("id", "h"), F.lit(rounds)) == k)


def _compared(docs: DataFrame, whole: DataFrame, spec: Spec, buckets: int, rounds: int) -> tuple[DataFrame, list[str]]:
    """The answers of the comparison, a row for each text, and the folder that they are stored in, if they are."""
    spark = docs.sparkSession

    def sent(k: int) -> DataFrame:
        asks = _dealt(whole, k, rounds).where("asks").select("id", "h", "answer")
        asked = _dealt(docs, k, rounds).join(asks, ["id", "h"]).select("id", "h", "text", "answer")
        return asked.mapInArrow(_contents(spec, buckets), _ROWS_DDL)

    contents, paths = _in_rounds(spark, rounds, "contents", sent)
    compared = _sorted(contents, buckets).mapInArrow(_compare(spec, buckets), _ROWS_DDL)
    part = _sorted(compared, buckets).mapInArrow(_collect, _TEXT_DDL)
    if rounds == 1:
        return part, []
    path = _stored(part, "compared")
    for p in paths:
        drop_scratch(spark, p)
    return spark.read.parquet(path), [path]


def repeated(df: DataFrame, spec: Spec, id_col: str, text_col: str, then: Callable[[DataFrame], DataFrame] = lambda found: found) -> DataFrame:
    """All rows of df as (orig, id, h, text, whole, part): packed intervals of repeated windows, null where there is none; or what `then` makes of these rows, each for itself."""
    spark = df.sparkSession
    buckets, large = bucket_number(df), known_bytes(df) >= ROUNDS_FROM
    rounds = MET_ROUNDS if large else 1
    # both joins of a round take the same columns of the texts, so that Spark reuses their exchange
    docs = identified(df, id_col, text_col)
    settled = _settled(docs, spec, buckets, TOLD_ROUNDS if large else 1)
    whole = spark.read.parquet(*settled)
    part, paths = _compared(docs, whole, spec, buckets, rounds)

    def found(k: int) -> DataFrame:
        answers = [_dealt(x, k, rounds).select("id", "h", F.col("answer").alias(name)) for name, x in (("whole", whole), ("part", part))]
        both = _dealt(docs, k, rounds).join(answers[0], ["id", "h"], "left").join(answers[1], ["id", "h"], "left")
        return then(both.select(F.when(F.col("id") != LAST, F.col("id")).alias("orig"), "id", "h", "text", "whole", "part"))

    rows, stored = _in_rounds(spark, rounds, "found", found)
    if stored:
        for p in (*settled, *paths):
            drop_scratch(spark, p)
    return rows


def covered(n: int, window: int, *answers: bytes | None) -> np.ndarray:
    """Which of n units lie in a repeated window."""
    edge = np.zeros(n + 1, np.int32)
    for raw in answers:
        if raw is not None:
            a, m, kind, _ = unpacked(raw)
            a, m = a[kind == REPEAT].astype(np.int64), m[kind == REPEAT].astype(np.int64)
            np.add.at(edge, a, 1)
            np.add.at(edge, a + m + window, -1)
    return np.cumsum(edge[:-1]) > 0


def intervals(gone: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def finished(df: DataFrame, spec: Spec, id_col: str, text_col: str, extra: str, row: Callable[[str, bytes | None, bytes | None], tuple]) -> DataFrame:
    """A row for each text of df: its id and what `row(text, whole, part)` returns."""
    from .common import spark_schema

    schema = f"`{id_col}` long, {extra}"
    fields = spark_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, part = batch.column(2), batch.column(3)
            for start, texts in text_chunks(batch, 1):
                rows = [row(t, whole[start + k].as_py(), part[start + k].as_py()) for k, t in enumerate(texts)]
                cols = [pa.array(list(c), type=fields.field(k + 1).type) for k, c in enumerate(zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), *cols], names=[f.name for f in fields])

    return repeated(df, spec, id_col, text_col, lambda found: found.select("orig", "text", "whole", "part").mapInArrow(run, schema))
