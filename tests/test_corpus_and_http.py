import io
import json
import urllib.error

import pytest

from lodestone.operators import checks, triples
from lodestone.plans import corpus
from lodestone.sources import http, sinks
from test_graph import X, graph

TEXTS = {"en": "a", "de": "b"}


def config(**more):
    q = {"id": "names", "title": TEXTS, "intro": TEXTS, "sparql": "SELECT ?n (COUNT(DISTINCT ?s) AS ?k) WHERE { ?s x:name ?n } GROUP BY ?n", "crosscheck": {"facet": "name", "key": "n", "count": "k"}}
    return {"prefixes": {"x": X}, "queries": [q | more]}


def test_corpus(spark):
    t = graph(spark, ("a", "name", "N"), ("b", "name", "N"), ("c", "name", "M"))
    prefixes, queries = corpus.load(config())
    good = spark.createDataFrame([("name", "N", 2), ("name", "M", 1)], "facet string, value string, n long")
    assert corpus.gate(t, prefixes, queries, good) == {"names": 2}
    with pytest.raises(ValueError, match="N is 2 in the graph and 3 in the facets"):
        corpus.gate(t, prefixes, queries, spark.createDataFrame([("name", "N", 3), ("name", "M", 1)], "facet string, value string, n long"))
    empty = corpus.Query("none", TEXTS, TEXTS, "SELECT ?s WHERE { ?s x:nothing ?o }")
    broken = corpus.Query("bad", TEXTS, TEXTS, "SELECT")
    with pytest.raises(ValueError, match="none: no rows; bad: "):
        corpus.gate(t, prefixes, [empty, broken])
    rows, n = corpus.page(t, 2)
    assert len(rows) == 2 and n == 3


@pytest.mark.parametrize("bad, message", [({"title": {"en": "a"}}, "must be in"), ({"sparql": None}, None), ({"id": "names"}, None)])
def test_corpus_config(bad, message):
    c = config(**bad)
    if message:
        with pytest.raises(ValueError, match=message):
            corpus.load(c)
    with pytest.raises(ValueError, match="twice"):
        corpus.load({"prefixes": {}, "queries": config()["queries"] * 2})
    with pytest.raises(ValueError, match="no queries"):
        corpus.load({"prefixes": {}})


class Site:
    """Answers in turn: a dict, or an HTTP status."""

    def __init__(self, *answers):
        self.answers, self.asked = list(answers), 0

    def __call__(self, url, timeout=None):
        self.asked += 1
        a = self.answers.pop(0)
        if isinstance(a, int):
            raise urllib.error.HTTPError(url, a, "", {"Retry-After": "7"} if a == 429 else {}, io.BytesIO())
        if isinstance(a, Exception):
            raise a
        return io.BytesIO(json.dumps(a).encode())


def test_retries():
    waits = []
    site = Site(429, 503, urllib.error.URLError("x"), {"id": 1})
    assert http.get_json("http://x", site, pause=waits.append) == {"id": 1} and waits == [7.0, 2.0, 4.0]
    with pytest.raises(urllib.error.HTTPError):
        http.get_json("http://x", site := Site(404, {}), pause=waits.append)
    assert site.asked == 1
    with pytest.raises(urllib.error.HTTPError):
        http.get_json("http://x", Site(500, 500, 500, 500), pause=waits.append)


def test_harvest(tmp_path):
    site = Site({"id": 1, "stats": 5}, 404, urllib.error.URLError("down"))
    get = lambda url: http.get_json(url, site, tries=1)
    urls = {"1": "u1", "2": "u2", "3": "u3"}
    assert http.harvest(urls, tmp_path, get) == (["2"], ["3"]) and json.loads((tmp_path / "1.json").read_text()) == {"id": 1}
    site.answers = [{"id": 3}]
    assert http.harvest(urls, tmp_path, get) == (["2"], []) and site.asked == 4
    (tmp_path / "s.json").write_text(json.dumps({"terms": ["a"], "answers": {"a [en]": []}}))
    assert http.answers(tmp_path / "s.json", ["a"]) == {"a [en]": []} and http.answers(tmp_path / "s.json", ["b"]) is None
    assert list(http.batched(range(5), 2)) == [[0, 1], [2, 3], [4]]


def test_gates(spark, tmp_path):
    t = graph(spark, ("a", "name", "N"))
    docs = spark.createDataFrame([("see x:name and x:nope",)], "t string")
    assert [r.curie for r in checks.unknown_terms(docs, "t", triples.known_terms(t), {"x": X}).collect()] == ["x:nope"]
    assert checks.gate(docs, strict=False) == 1 and checks.gate(docs.limit(0), strict=True) == 0
    with pytest.raises(ValueError, match="1 findings"):
        checks.gate(docs, strict=True)
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_text("1")
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "old").write_text("1")
    assert sinks.sync_tree(tmp_path / "a", tmp_path / "b") == [tmp_path / "b" / "x"] and not (tmp_path / "b" / "old").exists()
