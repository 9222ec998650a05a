"""Canonical names of blank nodes against renamings of random graphs, and brute force over all renamings."""

import itertools
import random

import pytest

from lodestone.operators import blanks
from lodestone.sources import sinks
from lodestone.sources.turtle import turtle

X = "http://x/"
COLUMNS = "s string, p string, o string, o_kind string, o_type string, o_lang string"


def frame(spark, triples):
    return spark.createDataFrame([tuple(t) for t in triples], COLUMNS)


def renamed(triples, seed):
    rng = random.Random(seed)
    names = sorted({x for s, _, o, k, *_ in triples for x in (s, *([o] if k == "iri" else [])) if x.startswith("_:")})
    new = dict(zip(names, rng.sample([f"_:q{i}" for i in range(len(names) * 3)], len(names)), strict=True))
    out = [(new.get(s, s), p, new.get(o, o) if k == "iri" else o, k, *more) for s, p, o, k, *more in triples]
    rng.shuffle(out)
    return out


def link(a, b, p="p"):
    return (f"_:{a}", X + p, f"_:{b}", "iri", "", "")


TWINS = [(X + "a", X + "p", f"_:t{i}", "iri", "", "") for i in range(7)] + [(f"_:t{i}", X + "q", "_:no", "literal", "", "") for i in range(7)]
RINGS = [link(f"a{i}", f"a{(i + 1) % 6}") for i in range(6)] + [link(f"{k}{i}", f"{k}{(i + 1) % 3}") for k in "bc" for i in range(3)]
FAMILIES = [x for k in range(3) for i in range(4) for x in (link(f"f{k}", f"k{k}.{i}", "r"), (f"_:k{k}.{i}", X + "q", "1", "literal", "", ""))]
CLIQUE = [link(a, b, "s") for a, b in itertools.permutations("vwxyz", 2)]
LOOPS = [link("m", "m", "t"), link("n", "n", "t"), link("o", "q", "t"), link("q", "o", "t")]
CASES = {
    "tree": [*turtle('@prefix x: <http://x/> . x:a x:p [ x:q "1", "1"@en ; x:r [ x:q 2 ] ] , [ x:q "1" ] . x:b x:l (1 1 1 [] []) .')],
    "alike": TWINS + RINGS + FAMILIES + CLIQUE + LOOPS + [*turtle("@prefix x: <http://x/> . x:a x:l (" + "1 " * 9 + ") . x:b x:l (" + "1 " * 9 + ") .")],
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_names_do_not_count(spark, case):
    """Triples are the same after a renaming, as many as before, and with as many blank nodes."""
    t = CASES[case]
    one, two = (blanks.canonical(frame(spark, x)).collect() for x in (t, renamed(t, 1)))
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))
    assert len(one) == len(set(t))
    count = lambda rows: len({x for r in rows for x in (r[0], *([r[2]] if r[3] == "iri" else [])) if x.startswith("_:")})
    assert count(one) == count(t)


def test_order_of_a_piece_against_all_renamings():
    """All graphs of four nodes and two to five links of one predicate: equal digests if, and only if, some renaming makes them equal."""
    nodes, digests = "abcd", {}
    for n in (2, 3, 4, 5):
        for g in itertools.combinations([(a, b) for a in nodes for b in nodes], n):
            rows = [row for a, b in g for row in ((a, "c", ">", "p", b, None), (b, "c", "<", "p", a, None))]
            used = sorted({x for e in g for x in e})
            key = len(used), min(tuple(sorted((m[a], m[b]) for a, b in g)) for m in (dict(zip(used, p, strict=True)) for p in itertools.permutations(range(len(used)))))
            digest, order = blanks.ordered(rows)
            assert sorted(order) == used
            # the order itself is one of the renamings: links written by it depend on the key alone
            digests.setdefault(key, set()).add((digest, tuple(sorted((order.index(a), order.index(b)) for a, b in g))))
    assert all(len(found) == 1 for found in digests.values())
    assert len({f for found in digests.values() for f in found}) == len(digests)


def test_turtle_of_two_files(spark):
    a = '@prefix x: <http://x/> . x:a x:p _:one . _:one x:q "1" ; x:r _:two . _:two x:q "2" .'
    b = '@prefix x: <http://x/> . _:y x:q "1" . x:a x:p _:y . _:y x:r [ x:q "2" ] .'
    assert sinks.canonical_turtle(frame(spark, turtle(a)), {"x": X}) == sinks.canonical_turtle(frame(spark, turtle(b)), {"x": X})


def test_empty_null_and_ground(spark):
    assert blanks.canonical(frame(spark, [])).count() == 0
    ground = [(X + "a", X + "p", "_:text", "literal", None, None), (X + "a", X + "p", X + "b", "iri", "", "")] * 2
    assert sorted(r.o for r in blanks.canonical(frame(spark, ground)).collect()) == ["_:text", X + "b"]


def test_too_much_alike_is_refused(spark, monkeypatch):
    monkeypatch.setattr(blanks, "MOST_LINKS", 5)
    with pytest.raises(ValueError, match="too much alike"):
        blanks.canonical(frame(spark, CLIQUE))


def test_trials_are_bounded(monkeypatch):
    monkeypatch.setattr(blanks, "MOST_TRIALS", 3)
    rows = [(a, "c", w, "p", b, None) for a, b in itertools.permutations("abcdefg", 2) for w in "<>"]
    with pytest.raises(ValueError, match="trials"):
        blanks.ordered(rows)
