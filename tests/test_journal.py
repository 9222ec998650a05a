"""A whole build of an invented journal, from files to files."""

import json

from lodestone.operators import builders
from lodestone.plans import journal, steps

FILES = {
    "content/journal.yaml": """iri: http://j.example/
title: The Journal
description: {en: A journal, de: Ein Journal}
issn: "1234-5678"
wikidata: Q1
licence: http://l.example/by
languages: [en, de]
publisher: The Society
editor: {family: Editor, given: Eva, orcid: "0009"}
modified: "2024-01-01"
""",
    "content/vol1.yaml": """volume: 1
year: 2020
issues:
- issue: 1
  sigil: "#"
  title: {en: Maps, de: Karten}
  entries:
  - n: 1
    types: [talk]
    title: The use of maps
    creators:
    - {name: "Berg, Anna", orcid: "0001"}
    doi: 10.5281/zenodo.11
    event: {name: Map Days, start: "2020-05-01", end: "2020-05-02", place: city}
  - n: 2
    types: [software]
    title: A tool for maps
    creators:
    - {name: "Cole, Dora"}
    links: {repository: "http://git.example/r"}
  - n: 3
    title: Not yet
    draft: true
""",
    "content/places.yaml": "places:\n- {key: city, label: 'Old Hall, Mapton', coordinates: {lat: 50.5, lon: 8.25}}\n",
    "content/types.yaml": "concepts:\n- {slug: presentation, label: {en: Presentation, de: Vortrag}, aliases: [talk], fabio: Presentation}\n- {slug: software, label: {en: Software, de: Software}}\n",
    "content/queries.yaml": """prefixes:
  skos: http://www.w3.org/2004/02/skos/core#
queries:
- id: by-type
  title: {en: a, de: b}
  intro: {en: a, de: b}
  sparql: "SELECT ?type (COUNT(DISTINCT ?e) AS ?n) WHERE { ?e a bibo:Document ; dct:type ?c . ?c skos:notation ?type } GROUP BY ?type"
  crosscheck: {facet: type, key: type, count: n}
""",
    "content/shapes/own.ttl": """@prefix sh: <http://www.w3.org/ns/shacl#> . @prefix bibo: <http://purl.org/ontology/bibo/> . @prefix dct: <http://purl.org/dc/terms/> . @prefix foaf: <http://xmlns.com/foaf/0.1/> .
[] a sh:NodeShape ; sh:targetClass bibo:Document ; sh:property [ sh:path dct:creator ; sh:minCount 1 ; sh:class foaf:Person ] , [ sh:path bibo:doi ; sh:minCount 1 ; sh:severity sh:Warning ; sh:message "no DOI" ] .
""",
    "raw/archive/11.json": json.dumps({"id": 11, "doi": "10.5281/zenodo.11", "files": [{"key": "a.pdf", "size": 7, "checksum": "md5:00"}], "metadata": {"title": "The use of maps", "description": "<p>On maps", "publication_date": "2020-06-01", "keywords": ["maps"], "license": {"id": "mit"}, "creators": [{"name": "Berg, Anna", "orcid": "0001"}]}}),
}


def test_build(spark, tmp_path):
    for name, text in FILES.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    (tmp_path / "raw" / "items").mkdir()
    site = builders.Site("http://j.example/", "http://pages.example/", "The Journal", "society", ("jj", "http://j.example/ontology#"))
    out = tmp_path / "out"
    j = journal.Journal(spark, tmp_path / "content", tmp_path / "raw", out, site, {"germany": "Q183"}, "Q183", strict=True)
    manifest = lambda: steps.Manifest(tmp_path / "manifest.json")
    for _ in range(2):  # inputs of later steps are there once the first has run
        report = [r for s in range(len(j.steps())) for r in steps.run([j.steps()[s]], manifest())]
    assert [(n, how) for n, how, _ in report] == [(n, "skipped") for n in ("merge", "cite", "triples", "validate", "search", "map")]
    bib, ris = (out / "journal.bib").read_text(), (out / "journal.ris").read_text()
    assert bib.count("@article{") == 2 and bib.index("The use of maps") < bib.index("A tool for maps") and ris.count("ER  -") == 2 and len(json.loads((out / "journal.csl.json").read_text())) == 2
    nodes = json.loads((out / "schema.json").read_text())
    assert [n["@type"] for n in nodes] == ["PresentationDigitalDocument", "SoftwareSourceCode"] and nodes[0]["abstract"] == "On maps" and nodes[0]["recordedAt"]["location"]["geo"]["latitude"] == 50.5 and nodes[0]["license"].endswith("/MIT.html")
    features = json.loads((out / "events.geojson").read_text())["features"]
    assert len(features) == 1 and features[0]["geometry"]["coordinates"] == [8.25, 50.5] and features[0]["properties"]["entries"][0]["label"] == "1(1), #1"
    index = json.loads((out / "search.json").read_text())
    assert [r["id"] for r in index["records"]] == ["v1-i1-e1", "v1-i1-e2"] and index["records"][0]["facets"]["person"] == ["http://j.example/person/0001"] and "on maps" in index["records"][0]["text"]
    assert "no DOI" in (out / "validation.md").read_text() and "Violation" not in (out / "validation.md").read_text()
    before = (out / "graph.ttl").read_bytes()
    steps.run([s for s in j.steps() if s.name == "triples"], manifest(), fresh=True)
    assert (out / "graph.ttl").read_bytes() == before
