"""Plain forms of the contracts, for small tables."""

import hashlib


def byte_dedup(docs, length=50):
    """docs: (id, text) -> {(id, text): (n_bytes, n_removed, n_spans, sha)}"""
    first = {}
    for i, t in docs:
        raw = (t or "").encode()
        for s in range(len(raw) - length + 1):
            w = raw[s : s + length]
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, t in docs:
        raw = (t or "").encode()
        gone = [False] * len(raw)
        for s in range(len(raw) - length + 1):
            if first[raw[s : s + length]] < i:
                gone[s : s + length] = [True] * length
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out[i, t] = (len(raw), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest())
    return out


def word_dedup(docs, window=20):
    first = {}
    for i, t in docs:
        words = (t or "").encode().split()
        for s in range(len(words) - window + 1):
            w = tuple(words[s : s + window])
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, t in docs:
        words = (t or "").encode().split()
        gone, own = [False] * len(words), set()
        for s in range(len(words) - window + 1):
            w = tuple(words[s : s + window])
            if first[w] < i or w in own:
                gone[s : s + window] = [True] * window
            own.add(w)
        out[i, t] = (len(words), sum(gone), hashlib.sha256(b" ".join(w for w, g in zip(words, gone) if not g)).hexdigest())
    return out


def jaccard_components(docs, k=5, percent=80):
    sets = []
    for i, t in docs:
        words = (t or "").encode().lower().split()
        sets.append((i, {tuple(words[j : j + k]) for j in range(max(1, len(words) - k + 1))} if words else set()))
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1 :]:
            both = len(x & y)
            if both and 100 * both >= percent * (len(x) + len(y) - both):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: (len(x), find(i)) for i, x in sets}
