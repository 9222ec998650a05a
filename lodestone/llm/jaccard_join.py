"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct word shingles. Two link when 100 * |A & B| >=
`percent` * |A | B|.

1. Equal sets form a class; the least id stands for it.
2. Shingles are counted: documents tell the bucket of each shingle's hash 5 bytes of it, and
   the bucket tells back which of them occur in other documents too, and in how many. A shingle
   of one document can't match; it only takes a place in the prefix.
3. In the order (frequency, hash) a set's prefix for l matches has its first n - need + l
   shingles, need = ceil(percent n / 100): linked sets share at least l of them. A document
   with too few shared shingles for a prefix of one match links with nothing.
4. Documents that share a shingle of their one-match prefixes meet in a candidate group
   (components of stars, not pairs). A group is joined in tasks of bounded size; there each
   document lengthens its prefix while the estimated cost of its candidates falls, and a pair is
   verified once it shares as many prefix shingles as the smaller of the two lengths asks for.
   Documents known to be connected aren't compared again: components need no more.
5. Of a group that exceeds a task, members are compared with pivots (its most ordinary
   members) and inside slices. What then isn't connected to the group's largest part (a probe)
   is compared with the members that share a token of its one-match prefix with it, or with
   every slice of the group, whichever sends fewer rows; a token whose sets are connected
   already asks nothing.

Cases: a null or empty text has no shingles and is linked with nothing, its component is its
own id. A text of fewer than `k` words is one shingle. Repeated ids are kept as rows and linked
by their texts alone; different texts of one id, or without id, are told apart. A null id
counts as the largest id, as 2^63 - 1, and its component is null if no other is reached. An
empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, scratch, spare, text_chunks
from .components import attach, components
from .units import many_word_units, shingle_hashes
from .windows import LAST, _batches, _by_bucket, _sorted, block_of, bucket_number, identified, pack_head, packed, unpack_head, unpacked

#: Members of a candidate group that a task joins at most; a larger group is cut in slices.
SLICE = 128
#: A row of a token's task against one of a slice of the whole group.
TOKEN_COST = 1.0
PIVOTS = 6
LONGEST_MATCH = 4
#: Characters of texts that are hashed at a time.
CHUNK = 1 << 18
#: Parts of a bucket that are counted one after the other.
PARTS = 4
#: Frequencies are told apart up to here.
MOST_OFTEN = 255
#: Cost of verifying a candidate, in units of reading an entry of a list.
VERIFY = 25.0
_MASK = np.uint64((1 << 40) - 1)
_ROWS_DDL = "bucket int, payload binary"
#: What a payload for a block tells: sizes of sets, their shared shingles, who stands for a class.
SIZES, SHARED, STANDS = 0, 1, 2


def shingle_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes; A-Z are lowered."""
    return [np.unique(shingle_hashes(w, k)) for w in many_word_units([t.encode("utf-8", "surrogatepass").lower() for t in texts])]


def _print(s: np.ndarray) -> tuple[int, int]:
    """128 bits that tell a set from others."""
    return (int(mix(s).sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mix(s * np.uint64(0x9FB21C651E98DF25))))) if len(s) else (0, 0)


def need(n, percent: int):
    """Shingles that a linked set shares with one of n."""
    return (percent * n + 99) // 100


# --- 1: sets and their classes ------------------------------------------------------------
def _describe(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_chunks(batch, 2, CHUNK):
                sets = shingle_sets(texts, k)
                n = np.array([len(s) for s in sets], np.int64)
                one, two = (np.array(x, np.uint64).view(np.int64) for x in zip(*map(_print, sets), strict=True))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(start, len(texts)) for i in (0, 1)), pa.array(n), pa.array(one), pa.array(two)], names=["id", "h", "n", "s1", "s2"])

    return run


# --- 2: frequencies -----------------------------------------------------------------------
def _tell(k: int, buckets: int):
    """(id, h, text) -> shingles for their buckets, and set sizes for the blocks of ids; of equal sets in a task the least id speaks."""

    def send(held: dict) -> Iterator[tuple[int, bytes]]:
        docs = sorted(held.values(), key=lambda d: d[:2])
        ids, hashes = np.array([d[0] for d in docs]), np.array([d[1] for d in docs])
        n = np.array([len(d[2]) for d in docs])
        every, doc = np.concatenate([d[2] for d in docs]), np.repeat(np.arange(len(docs)), n)
        bucket = ((every >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket * len(docs) + doc, kind="stable")
        cut = np.searchsorted(bucket[by], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cut)).tolist():
            x = by[cut[b] : cut[b + 1]]
            key = every[x] & _MASK
            yield b, packed(*pack_head(ids[doc[x]], hashes[doc[x]]), key & np.uint64(0xFFFFFFFF), key >> np.uint64(32))
        block = block_of(ids, hashes, buckets)
        for b in np.unique(block).tolist():
            x = np.flatnonzero(block == b)
            yield -1 - b, packed(np.array([SIZES]), *pack_head(ids[x], hashes[x]), n[x])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[int, int, np.ndarray]] = {}
        size = 0
        for batch in batches:
            ids, hashes = (batch.column(i).to_pylist() for i in (0, 1))
            for start, texts in text_chunks(batch, 2, CHUNK):
                for i, s in enumerate(shingle_sets(texts, k)):
                    if len(s):
                        mine, key = (ids[start + i], hashes[start + i], s), (len(s), *_print(s))
                        if key not in held:
                            size += len(s)
                        if key not in held or mine[:2] < held[key][:2]:
                            held[key] = mine
                if size > 2_000_000:
                    yield from _batches(send(held))
                    held, size = {}, 0
        if held:
            yield from _batches(send(held))

    return run


def _count(buckets: int):
    """In a bucket: shingles of several documents, told to the blocks of those documents with their frequency."""

    def of(bucket: int, rows: list[bytes]) -> Iterator[tuple[int, bytes]]:
        ids, hashes, docs, keys, seen = [], [], [], [], 0
        while rows:  # what is unpacked is let go
            steps, hs, counts, low, high = unpacked(rows.pop())
            i, h = unpack_head(steps, hs, np.ones(len(steps), np.int64))
            ids.append(i)
            hashes.append(h)
            docs.append(np.repeat(np.arange(seen, seen + len(i), dtype=np.int32), counts))
            keys.append(high.astype(np.uint64) << np.uint64(32) | low)
            seen += len(i)
        ids, hashes, doc, key = (np.concatenate(x) for x in (ids, hashes, docs, keys))
        docs.clear()
        keys.clear()
        block = block_of(ids, hashes, buckets)
        # a part of the shingles at a time; of each the ones of several documents stay
        kept = []
        for k in range(PARTS):
            x = np.flatnonzero(key % np.uint64(PARTS) == np.uint64(k))
            x = x[np.argsort(key[x], kind="stable")]
            own = key[x]
            new = np.ones(len(own), bool)
            new[1:] = own[1:] != own[:-1]
            sizes = np.diff(np.append(np.flatnonzero(new), len(own)))
            often = np.repeat(sizes, sizes)
            several = often > 1
            kept.append((doc[x[several]], own[several], np.minimum(often[several], MOST_OFTEN).astype(np.uint8)))
        doc, key, often = (np.concatenate(x) for x in zip(*kept, strict=True))
        order = np.lexsort((hashes[doc], ids[doc], block[doc]))
        cut = np.searchsorted(block[doc[order]], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cut)).tolist():
            y = order[cut[b] : cut[b + 1]]
            yield -1 - b, packed(np.array([SHARED]), *pack_head(ids[doc[y]], hashes[doc[y]]), key[y] & np.uint64(0xFFFFFFFF), key[y] >> np.uint64(32), often[y], np.array([bucket]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(r for bucket, rows in _by_bucket(batches) for r in (of(bucket, rows) if bucket >= 0 else ((bucket, p) for p in rows)))

    return run


def _tell_classes(buckets: int):
    """(id, h, node) of the documents that stand for a class -> to their blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, nodes = (np.asarray(batch.column(i)).astype(np.int64) for i in (0, 1, 2))
            block = block_of(ids, hashes, buckets)
            order = np.lexsort((hashes, ids, block))
            cut = np.searchsorted(block[order], np.arange(buckets + 1))
            yield from _batches((-1 - b, packed(np.array([STANDS]), *pack_head(ids[x], hashes[x]), nodes[x])) for b in np.flatnonzero(np.diff(cut)).tolist() for x in [order[cut[b] : cut[b + 1]]])

    return run


def pack_tokens(token: np.ndarray, often: np.ndarray) -> bytes:
    """Tokens in the order (frequency, token): their halves lie apart, so that the upper ones compress."""
    return packed(token & np.uint64(0xFFFFFFFF), token >> np.uint64(32), often)


def unpack_tokens(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    low, high, often = unpacked(raw)
    return high.astype(np.uint64) << np.uint64(32) | low.astype(np.uint64), often.astype(np.int64)


_SETS_DDL = "node long, n int, r int, tokens binary, first array<long>"


def _gather(percent: int):
    """In a block of ids: of the documents that stand for a class those that have a prefix of one match -> (node, n, r: tokens, tokens in order, first: tokens of that prefix)."""
    names, types = ["node", "n", "r", "tokens", "first"], [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_bucket(batches):
            size: dict[tuple[int, int], int] = {}
            stands: dict[tuple[int, int], int] = {}
            parts = []
            while rows:
                kind, steps, hashes, counts, *more = unpacked(rows.pop())
                ids, hs = unpack_head(steps, hashes, counts)
                if kind[0] == STANDS:
                    stands.update(zip(zip(ids.tolist(), hs.tolist(), strict=True), more[0].tolist(), strict=True))
                elif kind[0] == SIZES:
                    size.update(zip(zip(ids.tolist(), hs.tolist(), strict=True), more[0].tolist(), strict=True))
                else:
                    low, high, often, bucket = more
                    parts.append((ids, hs, bucket.astype(np.uint64) << np.uint64(40) | high.astype(np.uint64) << np.uint64(32) | low.astype(np.uint64), often.astype(np.uint8)))
            if not parts:
                continue
            ids, hs, token, often = (np.concatenate(x) for x in zip(*parts, strict=True))
            parts.clear()
            order = np.lexsort((token, often, hs, ids))
            ids, hs, token, often = ids[order], hs[order], token[order], often[order]
            cut = np.flatnonzero((ids[1:] != ids[:-1]) | (hs[1:] != hs[:-1])) + 1
            out = []
            for s, e in zip([0, *cut.tolist()], [*cut.tolist(), len(ids)], strict=True):
                me = int(ids[s]), int(hs[s])
                if me not in stands:
                    continue
                n = size[me]
                first = e - s - need(n, percent) + 1  # of the n - need + 1 first, n - (e - s) are of one document
                if first > 0:
                    out.append((stands[me], n, e - s, pack_tokens(token[s:e], often[s:e]), token[s : s + first].view(np.int64)))
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return run


# --- 4: the join inside a task ------------------------------------------------------------
def match_length(n: int, often: np.ndarray, percent: int) -> int:
    """How many prefix shingles a document asks a partner to share: as long as the estimated cost falls.

    The lists of the prefix are read (their frequencies add up); of what is read, about a share
    that falls with the square of the length remains to be verified."""
    best, cost = 1, np.inf
    start = len(often) - need(n, percent)
    reads = np.cumsum(often)
    for l in range(1, min(LONGEST_MATCH, need(n, percent)) + 1):
        k = min(start + l, len(often))
        if k <= 0:
            continue
        now = float(reads[k - 1]) * (1 + VERIFY / l**2)
        if now >= cost:
            break
        best, cost = l, now
    return best


class Links:
    """Union-find that keeps the links which joined something; members of one part begin as one."""

    def __init__(self, n: int, parts: list | None = None):
        first: dict = {}
        self.root, self.found = [first.setdefault(p, i) for i, p in enumerate(parts if parts is not None else range(n))], []

    def find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def join(self, x: int, y: int) -> None:
        a, b = self.find(x), self.find(y)
        if a != b:
            self.root[max(a, b)] = min(a, b)
            self.found.append((x, y))


def join_members(sizes: list[int], tokens: list[np.ndarray], often: list[np.ndarray], percent: int, links: Links, against: int = 0) -> None:
    """Link members; with `against`, the first so many are pivots: the others are compared with them first, most ordinary pivot first."""
    sets: list[set | None] = [None] * len(sizes)

    def linked(x: int, y: int) -> bool:
        if 100 * min(sizes[x], sizes[y]) < percent * max(sizes[x], sizes[y]):
            return False
        for z in (x, y):
            if sets[z] is None:
                sets[z] = set(tokens[z].tolist())
        both = len(sets[x] & sets[y])
        return 100 * both >= percent * (sizes[x] + sizes[y] - both)

    for x in range(against, len(sizes)):
        for p in range(against):
            if links.find(x) != links.find(p) and linked(x, p):
                links.join(x, p)
                break
    asks = [match_length(n, o, percent) for n, o in zip(sizes, often, strict=True)]
    index: dict[int, dict[int, list[int]]] = defaultdict(dict)  # token -> root at the time -> members
    for x in sorted(range(len(sizes)), key=sizes.__getitem__):
        k = len(tokens[x]) - need(sizes[x], percent) + asks[x]
        prefix = tokens[x][: max(0, k)].tolist()
        met: dict[int, int] = defaultdict(int)
        own = links.find(x)
        for t in prefix:
            for root, members in index[t].items() if t in index else ():
                if links.find(root) == own:
                    continue
                for y in members:
                    met[y] += 1
                    if met[y] == min(asks[x], asks[y]) and linked(x, y):
                        links.join(x, y)
                        own = links.find(x)
                        break
        for t in prefix:
            index[t].setdefault(own, []).append(x)


def _join_slices(percent: int):
    """(slice, node, n, tokens, pivot, part), sorted by slice -> links (a, b); rows of one part are connected already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def flush() -> pa.RecordBatch:
            rows = sorted(held, key=lambda r: (-r[3], r[0]))
            links = Links(len(rows), [r[4] for r in rows])
            tokens, often = zip(*(unpack_tokens(r[2]) for r in rows), strict=True)
            join_members([r[1] for r in rows], tokens, often, percent, links, sum(r[3] > 0 for r in rows))
            return pa.RecordBatch.from_arrays([pa.array([rows[x][0] for x, _ in links.found], pa.int64()), pa.array([rows[y][0] for _, y in links.found], pa.int64())], names=["a", "b"])

        for batch in batches:
            for g, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if g != now:
                    if held:
                        yield flush()
                    now, held = g, []
                held.append(row)
        if held:
            yield flush()

    return run


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """sets (node, n, r, tokens, first), one a class -> links (a, b) that connect whatever is linked."""
    entries = sets.select(F.col("node").alias("id"), F.explode("first").alias("token"))
    stars = entries.groupBy("token").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    edges = entries.join(stars, "token").where("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b"))
    groups = components(edges)
    # narrow: which group a set is in, and how large it is
    sizes = groups.groupBy("root").agg(F.count("*").alias("size")).withColumn("weight", F.col("size"))
    placed = _stored(attach(groups, "root", sizes).select("node", "root", "size"), "groups")
    slices = F.ceil(F.col("size") / SLICE).cast("long")
    own = F.xxhash64("root", F.pmod(F.xxhash64("node"), slices)).alias("slice")
    large = placed.where(F.col("size") > SLICE)
    cut = not large.isEmpty()
    members = sets.select("node", "n", "tokens")
    if cut:
        # the most ordinary members: most of their shingles are shared; a maximum needs no group in one task
        ordinary = F.struct((F.col("r") / F.col("n")).alias("share"), "n", "node")
        narrow = sets.select("node", "n", "r").join(large, "node")
        best = narrow.groupBy("root", "size", F.pmod(F.xxhash64("node", F.lit(3)), F.lit(PIVOTS)).alias("k")).agg(F.max(ordinary).alias("best"))
        best = _stored(best.select("root", "size", (F.col("k") + 1).cast("int").alias("pivot"), F.col("best.node").alias("node")), "pivots")
        rest = placed.join(best.select("node"), "node", "left_anti").select("node", own, F.lit(0).alias("pivot"))
        every = F.explode(F.sequence(F.lit(0).cast("long"), slices - 1))
        roles = rest.unionByName(best.select("node", "root", "pivot", every.alias("k")).select("node", F.xxhash64("root", "k").alias("slice"), "pivot"))
    else:
        roles = placed.select("node", own, F.lit(0).alias("pivot"))
    found = _joined(members.join(roles.withColumn("part", F.col("node")), "node"), percent)
    if not cut:
        return found
    # of groups cut in slices, what isn't connected yet: all but the largest part of a group are probes
    done = components(found).withColumnRenamed("root", "part")
    parts = _stored(large.join(done, "node", "left").select("node", "root", "size", F.coalesce("part", "node").alias("part")), "parts")
    counted = parts.groupBy("root", "part").agg(F.count("*").alias("k"))
    main = counted.groupBy("root").agg(F.max_by("part", F.struct("k", "part")).alias("main"), (F.sum("k") - F.max("k")).alias("probes"), F.sum("k").alias("weight")).where("probes > 0")
    if main.isEmpty():
        return found
    left = _stored(attach(parts, "root", main).withColumn("probe", F.col("part") != F.col("main")), "left")
    # linked sets share a token of their one-match prefixes; a token whose sets are connected already asks nothing
    entries = _stored(sets.select("node", F.explode("first").alias("token")).join(left.select("node", "root", "part", "probe"), "node"), "entries")
    cut_in = lambda n: F.ceil(F.col(n) / SLICE).cast("long")
    cost = lambda n: F.col(n) * F.col("chunks") + F.col("probes") * (F.col("slices") - 1)
    shared = entries.groupBy("token", "root").agg(F.count("*").alias("weight"), F.count_if("probe").alias("probes"), F.min("part").alias("least"), F.max("part").alias("most")).where("probes > 0 AND least < most")
    shared = _stored(shared.select("token", "root", "weight", "probes", cut_in("weight").alias("slices"), cut_in("probes").alias("chunks")), "shared")
    # of the two ways (a group's slices, or its tokens) the one that sends fewer rows
    by_token = shared.groupBy("root").agg(F.sum(cost("weight")).alias("cost"))
    groups_ = main.select("root", "probes", "weight", cut_in("weight").alias("slices"), cut_in("probes").alias("chunks"))
    way = groups_.join(by_token, "root", "left").select("root", "slices", "chunks", (F.coalesce("cost", F.lit(0)) * TOKEN_COST < cost("weight")).alias("by_token"), "weight")
    way = _stored(way, "ways")
    tasks = attach(left.select("node", "root", "part", "probe"), "root", way.where("NOT by_token")).select("node", "part", "probe", "slices", "chunks", F.col("root").alias("of"))
    asked = attach(entries, "root", way.where("by_token").select("root", "weight")).drop("root")
    tasks = tasks.unionByName(attach(asked, "token", shared.drop("root", "probes")).select("node", "part", "probe", "slices", "chunks", F.xxhash64("token", F.lit("token")).alias("of")))
    return found.unionByName(_joined(members.join(_placed(tasks), "node"), percent))


def _placed(tasks: DataFrame) -> DataFrame:
    """tasks (node, part, probe, slices, chunks, of) -> (node, slice, pivot, part): a task has a slice of the members and a chunk of the probes, so that each probe meets each member once."""
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    slice_of, chunk_of = F.pmod(F.xxhash64("node"), F.col("slices")), F.pmod(F.xxhash64("node", F.lit(5)), F.col("chunks"))
    standing = tasks.select("node", "of", "part", slice_of.alias("k"), upto(F.col("chunks")).alias("c"))
    moving = tasks.where("probe AND slices > 1").select("node", "of", "part", slice_of.alias("own"), upto(F.col("slices")).alias("k"), chunk_of.alias("c")).where("k <> own").drop("own")
    return standing.unionByName(moving).select("node", F.xxhash64("of", "k", "c", F.lit("probe")).alias("slice"), F.lit(0).alias("pivot"), "part")


def _joined(rows: DataFrame, percent: int) -> DataFrame:
    """rows (slice, node, n, tokens, pivot, part) -> the links found in each slice."""
    picked = rows.select("slice", "node", "n", "tokens", "pivot", "part")
    return _stored(picked.repartition("slice").sortWithinPartitions("slice").mapInArrow(_join_slices(percent), "a long, b long"), "links")


def labelled(df: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """(id, h, n, least_id, least_h): a row for each row of df; the least text reached by links, by id and then hash. A null id is LAST."""
    if not 50 < percent <= 100:
        raise ValueError("percent must lie above 50 and not above 100")
    buckets = bucket_number(df)
    docs = identified(df, id_col, text_col)
    info = _stored(docs.mapInArrow(_describe(k), "id long, h long, n long, s1 long, s2 long"), "sets")
    # classes are numbered as they are written; ids may be null or repeated
    classes = info.where("n > 0").groupBy("n", "s1", "s2").agg(F.min(F.struct("id", "h")).alias("rep"))
    classes = _stored(classes.select("n", "s1", "s2", "rep", F.monotonically_increasing_id().alias("node")), "classes")
    told = docs.mapInArrow(_tell(k, buckets), _ROWS_DDL)
    counted = _sorted(told, buckets).mapInArrow(_count(buckets), _ROWS_DDL)
    reps = classes.select("rep.id", "rep.h", "node").mapInArrow(_tell_classes(buckets), _ROWS_DDL)
    sets = _stored(_sorted(counted.unionByName(reps), buckets).mapInArrow(_gather(percent), _SETS_DDL), "prefixes")
    roots = components(_links(sets, percent))
    joined = classes.join(roots, "node", "left").select("n", "s1", "s2", "rep", "root")
    least = joined.where("root IS NOT NULL").groupBy("root").agg(F.min("rep").alias("least"), F.count("*").alias("weight"))
    found = attach(joined, "root", least, "left").select("n", "s1", "s2", F.coalesce("least", "rep").alias("least"))
    return info.join(found, ["n", "s1", "s2"], "left").select("id", "h", "n", F.coalesce("least.id", "id").alias("least_id"), F.coalesce("least.h", "h").alias("least_h"))


def linked(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """id, n_shingles, component_id: a row for each row of df."""
    none = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return labelled(df, id_col, text_col, k, percent).select(none("id").alias(id_col), F.col("n").alias("n_shingles"), none("least_id").alias("component_id"))


def distinct_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """df with one document of each group, the one of least id (of texts of that id, or without id, the one of least hash); repeated rows, of one id and one text, are one document and stay together."""
    copies = labelled(df, id_col, text_col, k, percent).where("id <> least_id OR h <> least_h").select("id", "h").distinct()
    i, h = spare(df, "id"), spare(df, "h")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = df.withColumn(i, F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST))).withColumn(h, F.xxhash64(text).bitwiseAND(F.lit(LAST)))
    copies = copies.withColumnsRenamed({"id": i, "h": h})
    return rows.join(copies, [i, h], "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])
