import json

from pyspark.sql import functions as F

from lodestone.operators import cite, shacl
from lodestone.sources import readers, records, sinks
from test_operators import MD, entry  # noqa: F401


def test_entries(spark, tmp_path):
    text = MD.replace("[10.1/x](y)", "[10.1234/x](https://doi.org/10.1234/x)").replace("* loose", "* **Event**: CAA (30 May - 2 June 2024)\n* **Location**: Online\n* **Repo**: [r](https://git.x/r)\n* **Mood**: good\n* https://a.b/c")
    text += "### Issue 5\n**λ4 [`Talk`] Bare**\n* F. Brandt; A.W. Voss et al.\n* DOI 10.5281/zenodo.7\n* Wikidata: Q42\n* ISBN: 978-1\n**λ5 Draft**\n"
    (tmp_path / "v.md").write_text(text)
    e = {r.n: r for r in records.entries(readers.entries_of(readers.volume_lines(readers.lines(spark, str(tmp_path / "v.md"))))).collect()}
    assert [p.name for p in e[1].creators] == ["F. Brandt", "A.W. Voss"] and e[1].doi == "10.1234/x"
    assert e[1].event.name == "CAA" and (e[1].event.start, e[1].event.end) == ("2024-05-30", "2024-06-02") and e[1].event.online is True and e[1].links.repository == "https://git.x/r" and e[1].links.link == "https://a.b/c"
    assert e[1].notes == ["mood: good"] and e[1].legacy_citation == "quoted" and not e[1].draft
    assert [p.name for p in e[4].creators] == ["F. Brandt", "A.W. Voss"] and e[4].et_al and e[4].doi == "10.5281/zenodo.7" and e[4].wikidata == "Q42" and e[4].isbn == "978-1" and not e[4].draft and e[5].draft


def test_entities(spark):
    claim = lambda q, rank="normal", ended=False: {"rank": rank, "qualifiers": {"P582": []} if ended else {}, "mainsnak": {"datavalue": {"value": {"id": q}}}}
    raw = {"id": "Q1", "labels": {"en": {"value": "Mainz"}, "fr": {"value": "Mayence"}}, "descriptions": {}, "claims": {"P17": [claim("Q2", ended=True), claim("Q3")], "P31": [claim("Q9"), claim("Q8")], "P625": [{"rank": "normal", "mainsnak": {"datavalue": {"value": {"latitude": 50.00000049, "longitude": 8.25}}}}]}}
    r = records.entities(spark.createDataFrame([(json.dumps(raw),)], "value string")).first()
    assert r.labels == {"en": "Mainz"} and r.country == ["Q2", "Q3"] and r.country_current == ["Q3"] and r.instance_of == ["Q8", "Q9"] and (r.coordinates.lat, r.coordinates.lon) == (50.0, 8.25)


def test_containers(spark):
    entries = spark.createDataFrame([("10.1/a", "1(1), #1"), ("10.1/b", "1(1), #2")], "doi string, label string")
    blocks = spark.createDataFrame([("10.1/a", "inproceedings", {"booktitle": "P", "editor": "A, B. and C, D.", "pages": "1(1), #9"}), ("10.1/z", "misc", {"title": "t"})], "doi string, type string, fields map<string,string>")
    joined, without, odd = records.with_containers(entries, blocks, F.col("label"))
    got = {r.doi: r.container for r in joined.collect()}
    assert got["10.1/b"] is None and got["10.1/a"].title == "P" and [x.name for x in got["10.1/a"].editors] == ["A, B.", "C, D."]
    assert [r.doi for r in without.collect()] == ["10.1/z"] and [r.doi for r in odd.collect()] == ["10.1/a"]


def test_schema_org_and_short_citation(entry):  # noqa: F811
    a, b = (json.loads(r.node) for r in cite.schema_org(entry, "J", "1", "http://x/").orderBy("id").collect())
    assert a["@type"] == "CreativeWork" and a["isPartOf"]["isPartOf"]["@id"] == "http://x/v7" and a["identifier"]["value"] == "10.1/a" and "identifier" not in b and b["datePublished"] == "2023"
    a, b = (r.text for r in cite.short_citation(entry, "J").orderBy("id").collect())
    assert a == "Voss, A., & Team (2024). A & B. J, 7(4), λ5. https://doi.org/10.1/a" and b.endswith("J, 7(5), 𝒬1. http://x/v7/i5/e1")


def test_products(spark, tmp_path):
    t = spark.createDataFrame([("http://x/a#b", "http://x/p", "v", "literal", "", ""), ("http://x/a", "http://x/p", "http://x/b", "iri", "", "")], "s string, p string, o string, o_kind string, o_type string, o_lang string")
    sinks.write_subgraphs(t, str(tmp_path / "g"))
    back = spark.read.text(str(tmp_path / "g"))
    assert back.count() == 2 and [r.resource for r in back.select("resource").distinct().collect()] == ["http://x/a"]
    f = spark.createDataFrame([('{"a":1}',)], "feature string")
    assert sinks.feature_collection(f, "EVENTS") == 'window.EVENTS = {"type":"FeatureCollection","features":[{"a":1}]};\n'
    assert sinks.query_text("T", "Why", {"x": "http://x/", "y": "http://y/"}, "SELECT ?s { ?s x:p ?o }") == "# T\n# Why\n\nPREFIX x: <http://x/>\n\nSELECT ?s { ?s x:p ?o }\n"
    assert "## k (1)" in sinks.report("R", {"k": f}) and "| {\"a\":1} |" in sinks.report("R", {"k": f})
    assert shacl.listing([shacl.Shape("C", properties=[shacl.Property("p", min_count=1, max_count=2)])])[0][2] == ["p: at least 1 and at most 2"]
