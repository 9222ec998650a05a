import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestone.operators import checks, cite, events, facets, resolve
from lodestone.plans import steps
from lodestone.sources import readers, sinks


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()), key=repr)


# --- facets
@pytest.fixture(scope="module")
def index(spark):
    d = spark.createDataFrame([(1, "Größe élan", ["en"], ["x", "y"]), (2, "elan vital", ["de"], ["x"]), (3, "other", ["en"], [])], "id int, t string, lang array<string>, tag array<string>")
    return facets.index(d, "id", {"lang": F.col("lang"), "tag": F.col("tag")}, [F.col("t")])


def test_facets(index):
    assert rows(facets.search(index, "ELAN"), "id") == [1, 2]
    assert rows(facets.search(index, "elan vit"), "id") == [2]
    assert rows(facets.search(index, "", {"lang": ["en"], "tag": ["x", "q"]}), "id") == [1]
    got = {(r.facet, r.value): r.n for r in facets.counts(index, "", {"lang": ["en"], "tag": ["q"]}).collect()}
    assert got == {("tag", "x"): 1, ("tag", "y"): 1, ("tag", "q"): 0, ("lang", "en"): 0}
    assert [r.value for r in facets.ordered(facets.counts(index), "lang").collect()] == ["en", "de"]


# --- resolution
def test_canonical(spark):
    s = spark.createDataFrame([("o", "Voss", "Albert", 8), ("o", "Voss", "Albert W.", 2), ("o", "Voss", "Albert Willem", 1), ("o", "Kasten", "K.", 1)], "orcid string, family string, given string, weight int")
    assert rows(resolve.canonical_names(s), "orcid", "family", "given") == [("o", "Voss", "Albert W.")]


def test_persons(spark):
    known = spark.createDataFrame([("o1", "Voss", "Albert W."), ("o2", "Smith", "Jo"), ("o3", "Smith", "Jan")], "orcid string, family string, given string")
    people = spark.createDataFrame([(1, "VOSS", "A."), (2, "Smith", "J."), (3, "Smith", "Jo"), (4, "Vossz", "A."), (5, "Old", "A.")], "id int, family string, given string")
    spelled = known.select("orcid", "family").union(spark.createDataFrame([("o1", "Old")], "orcid string, family string"))
    sure, unsure = resolve.match_persons(people, known, spelled)
    assert rows(sure, "id", "orcid") == [(1, "o1"), (5, "o1")] and rows(unsure, "id") == [2, 3]


def test_loose(spark):
    p = spark.createDataFrame([("a", "Lee", "Ann B."), ("b", "Lee", "A."), ("c", "Lee", "C."), ("d", "Lee", "A.B."), ("e", "Kim", "")], "id string, family string, given string")
    assert rows(resolve.loose_persons(p), "id", "keeper") == [("a", "a"), ("b", "a"), ("c", "c"), ("d", "a"), ("e", "e")]


def test_types(spark):
    concepts = spark.createDataFrame([("poster", ["Poster", "P"], ["poster"]), ("talk", ["Talk"], ["presentation", "other/talk"])], "slug string, aliases array<string>, zenodo array<string>")
    r = spark.createDataFrame([(1, ["Talk", "P", "Poster", "Nope"])], "id int, labels array<string>")
    known, unknown = resolve.type_slugs(r, "id", "labels", concepts)
    assert rows(known, "types") == [["talk", "poster"]] and rows(unknown, "label") == ["Nope"]
    z = spark.createDataFrame([(1, "other", "talk"), (2, "poster", None), (3, "odd", None)], "id int, t string, s string")
    assert rows(resolve.archive_type(z, "id", F.col("t"), F.col("s"), concepts), "id", "slug") == [(1, "talk"), (2, "poster"), (3, None)]


def test_enrich(spark):
    entries = spark.createDataFrame([("e1", "10", "mainz"), ("e2", None, "lost"), ("e3", "11", None)], "id string, record_id string, place_key string")
    archive = spark.createDataFrame([("10", "T")], "record_id string, title string")
    places = spark.createDataFrame([("mainz", "Mainz", "Q1", None)], "key string, label string, wikidata string, coordinates struct<lat:double,lon:double>")
    items = spark.createDataFrame([("Q1", {"en": "Mainz"}, (50.0000001, 8.25), ["Q183"], None), ("Q183", {"en": "Germany"}, None, None, None)], "id string, labels map<string,string>, coordinates struct<lat:double,lon:double>, country array<string>, country_current array<string>")
    out, lost = resolve.enrich(entries, archive, places, items)
    assert rows(out, "id", "title", "lat", "country_name") == [("e1", "T", 50.0, "Germany"), ("e2", None, None, None), ("e3", None, None, None)] and rows(lost, "text") == ["lost"]


def test_publications(spark):
    known = spark.createDataFrame([("k1", "10.1/a", "Old maps of Mainz", 2), ("k2", None, "Stone tools", 1), ("k3", "10.1/c", "Something else", 3)], "key string, doi string, title string, volume int")
    new = spark.createDataFrame([(1, "10.1/A", "Old maps of Mainz!"), (2, None, "STONE tools"), (3, "10.1/c", "A wholly unlike name"), (4, None, "New")], "id int, doi string, title string")
    assert rows(resolve.match_publications(new, known), "id", "key", "how") == [(1, "k1", "doi"), (2, "k2", "title"), (3, None, "rejected"), (4, None, None)]


def test_small_rules(spark):
    d = spark.createDataFrame([(1, "2016-02-01", 2018), (2, "2016-02-01", 2018), (2, "2018-02-01", 2018)], "v int, d string, y int")
    assert [r[0] for r in d.select(resolve.plausible_date(F.col("d"), F.col("v"), F.col("y"))).collect()] == ["2016-02-01", None, "2018-02-01"]
    c = spark.createDataFrame([([("Q1", "normal", False), ("Q2", "preferred", False), ("Q3", "deprecated", False)],), ([("Q1", "normal", True), ("Q2", "normal", False)],)], "c array<struct<id:string,rank:string,ended:boolean>>")
    assert [r[0] for r in c.select(resolve.current_claims(F.col("c"))).collect()] == [["Q2"], ["Q2"]]
    n = spark.createDataFrame([(1, 1, None, "o"), (2, 1, "Ann", "o"), (3, 1, "Ann", "o"), (4, 1, "A.", "o")], "id int, pos int, name string, orcid string")
    assert rows(resolve.named_by_identifier(n), "id", "name")[0] == (1, "Ann")
    e = spark.createDataFrame([("e2", 1, 2, 1, "p"), ("e1", 1, 1, 1, "p"), ("e1", 1, 1, 1, "p")], "entry string, volume int, issue int, n int, person string")
    assert resolve.person_index(e).first().entries == ["e1", "e2"]


def test_candidates(spark):
    h = spark.createDataFrame(
        [("p", "Q10", 0, 0, True, True, True, 0.9, False, 10.0, 2), ("p", "Q9", 0, 0, True, False, True, 0.9, False, 900.0, 2), ("p", "Q2", 1, 0, True, True, True, 1.0, False, 0.0, 2), ("p", "Q3", 1, 1, None, None, True, 0.1, True, None, 2)],
        "place string, id string, term_rank int, hit_rank int, has_coordinates boolean, same_country boolean, stated boolean, similarity double, is_station boolean, km_from_city double, n_terms int",
    )
    assert [r.id for r in resolve.rank_candidates(h).orderBy("rank").collect()] == ["Q10", "Q2", "Q9"]


# --- events
def fold(days, most=14):
    out, n, anchor = [], 0, None
    for d in days:
        if n and (d is None or anchor is None or (d - anchor).days <= most):
            pass
        else:
            n, anchor = n + 1, d
        out.append(n)
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(0, 60)), min_size=1, max_size=25))
def test_clusters(spark, offsets):
    days = [None if o is None else dt.date(2024, 1, 1) + dt.timedelta(o) for o in sorted(offsets, key=lambda o: (o is not None, o))]
    df = spark.createDataFrame([(1, i, d) for i, d in enumerate(days)], "k int, i int, d date")
    got = sorted((r.i, r.cluster) for r in events.anchored_clusters(df, ["k"], "d", ["i"]).collect())
    assert [c for _, c in got] == fold(days)
    twice = df.unionByName(df)
    assert sorted((r.i, r.cluster) for r in events.anchored_by_day(twice, ["k"], "d").collect()) == sorted(2 * got)


def test_anchor_is_the_first_date(spark):
    df = spark.createDataFrame([(1, i, dt.date(2024, 1, 1 + d)) for i, d in enumerate((0, 9, 19))], "k int, i int, d date")
    assert rows(events.anchored_clusters(df, ["k"], "d", ["d"]), "i", "cluster") == [(0, 1), (1, 1), (2, 2)]


def test_features(spark):
    columns = "event string, name string, start string, end string, lon double, lat double, place string, place_label string, entry string, label string, title string, issued string, volume int, issue int, n int"
    r = spark.createDataFrame([("e", "N", "2024-01-01", "2024-01-02", 8.0, 50.0, "p", "P", x, x, x, "2024", 1, 1, i) for i, x in ((2, "b"), (1, "a"), (1, "a"))], columns)
    f = json.loads(events.features(r).first().feature)
    assert f["geometry"]["coordinates"] == [8.0, 50.0] and [e["iri"] for e in f["properties"]["entries"]] == ["a", "b"]
    assert events.by_place(r).first().entries == 2
    assert spark.range(1).select(events.point(F.lit("POINT(8.2 -50.1)")).alias("p")).first().p.lat == -50.1
    with pytest.raises(Exception, match="no point"):
        spark.range(1).select(events.point(F.lit("LINE(1 2)"))).collect()
    assert events.inside_share(r, 0, 0, 10, 60).first().fits


# --- checks
def test_checks(spark):
    a, b = spark.createDataFrame([("x", 1), ("y", 2), ("y", 1), ("z", 3)], "key string, n int"), spark.createDataFrame([("x", 1), ("y", 3), ("w", 1)], "key string, n int")
    assert rows(checks.crosscheck(a, b), "key", "left_value", "right_value") == [("w", None, 1), ("y", 2, 3), ("z", 3, None)]
    assert checks.crosscheck(a, a).isEmpty()
    assert rows(checks.duplicates(a, ["key"]), "key") == ["y"]
    assert rows(checks.lost(a.select("key"), b.select("key"), spark.createDataFrame([("z",)], "key string")), "key") == []
    links = spark.createDataFrame([("a/index.html", "../b/"), ("a/index.html", "c.html#x"), ("a/index.html", "https://x"), ("a/index.html", "/d.html?q")], "page string, href string")
    files = spark.createDataFrame([("b/index.html",), ("d.html",)], "path string")
    assert rows(checks.broken_links(links, files), "path") == ["a/c.html"]
    n = spark.createDataFrame([("g", 1, 5), ("g", 2, None), ("g", 3, None)], "k string, i int, own int")
    assert rows(checks.next_numbers(n, ["k"], "own", "i"), "i", "assigned") == [(1, 5), (2, 6), (3, 7)]


# --- citations
@pytest.fixture(scope="module")
def entry(spark):
    ddl = "id string, iri string, volume int, issue int, n int, sigil string, title string, creators array<struct<family:string,given:string>>, editors array<struct<family:string,given:string>>, doi string, doi_url string, language string, date string, year int, keywords array<string>, genre string, type string, event struct<name:string,location:string,online:boolean>, container struct<bibtex_type:string,title:string,editors:array<struct<name:string>>,publisher:string,place:string>"
    plain = ("v7-i4-e5", "http://x/v7/i4/e5", 7, 4, 5, "λ", "A & B", [("Voss", "Albert"), ("Team", "")], None, "10.1/a", "https://doi.org/10.1/a", "de", "2024-05-08", 2024, ["k1", "k2"], "Poster", "poster", ("CAA", "Mainz", False), None)
    paper = ("v7-i5-e1", "http://x/v7/i5/e1", 7, 5, 1, "𝒬", "C", [("Lee", "A.")], None, None, None, None, None, 2023, None, "Paper", "conference-proceeding", ("CAA", "Online", True), ("inproceedings", "Proc", [("Kim, B.",)], None, "Bonn"))
    return spark.createDataFrame([plain, paper], ddl)


def test_bibtex(entry):
    a, b = (r.bibtex for r in cite.bibtex(entry, "J", "1").orderBy("id").collect())
    assert a.startswith("@article{sp_vol7_iss4_e5,\n  title = {A \\& B},\n  author = {Voss, Albert and {Team}},\n  journal = {J},\n") and "  month = may,\n" in a and "  language = {german},\n" in a and "  note = {Poster, CAA, Mainz}\n}\n" in a
    assert b.startswith("@inproceedings{") and "pages = {7(5), 𝒬1}" in b and "publisher = {J}" in b and "url = {http://x/v7/i5/e1}" in b and "note = {Paper, CAA}" in b and "month" not in b


def test_ris(entry):
    a, b = (r.ris for r in cite.ris(entry, "J", "1").orderBy("id").collect())
    assert a.startswith("TY  - JOUR\nID  - sp_vol7_iss4_e5\nTI  - A & B\nAU  - Voss, Albert\nAU  - Team\nPY  - 2024\nDA  - 2024/05/08\nJO  - J\n") and a.endswith("KW  - k1\nKW  - k2\nN1  - Poster\nER  -\n")
    assert b.startswith("TY  - CPAPER\n") and "A2  - Kim, B.\nPB  - J\nCY  - Bonn\nT3  - J\n" in b


def test_csl(entry):
    a, b = (json.loads(r.csl) for r in cite.csl(entry, "J", "1").orderBy("id").collect())
    assert a["issued"] == {"date-parts": [[2024, 5, 8]]} and a["author"] == [{"family": "Voss", "given": "Albert"}, {"literal": "Team"}] and a["event-place"] == "Mainz" and "URL" not in a
    assert b["type"] == "paper-conference" and "volume" not in b and b["editor"] == [{"family": "Kim", "given": "B."}] and b["publisher-place"] == "Bonn" and "event-place" not in b


# --- sources
MD = """# Volume
### Issue 4
*Special things*

**λ1 [`Talk`] [`Poster`] A **title****
* **`Authors`**: F. Brandt; A.W. Voss
* **DOI**: [10.1/x](y)
* DOI: 10.1/second
* loose
> quoted

**λ2 ![TYPE](https://img.shields.io/badge/TYPE-Data_Set-blue) ![Lang](https://img.shields.io/badge/LANGUAGE-German-red) Zwei**
### 2021:(3)1 => SI: Data
> **#3 [`Code`] Drei**
## End
orphan
"""


def test_markdown(spark, tmp_path):
    (tmp_path / "v.md").write_text(MD)
    placed = readers.volume_lines(readers.lines(spark, str(tmp_path / "v.md")))
    e = {r.n: r for r in readers.entries_of(placed).collect()}
    assert e[1].labels == ["Talk", "Poster"] and e[1].title == "A title" and e[1].issue == 4 and e[1].fields == {"authors": "F. Brandt; A.W. Voss", "doi": "[10.1/x](y)"} and e[1].plain == ["loose"] and e[1].quotes == ["quoted"]
    assert e[2].labels == ["Data Set"] and e[2].language == "de" and e[2].title == "Zwei" and e[3].issue == 1 and len(e) == 3
    assert rows(placed.where("issue_title IS NOT NULL"), "issue_title") == ["Special Issue on Data"]


def test_text_sources(spark, tmp_path):
    (tmp_path / "b.md").write_text("x\n@Article{key,\n  title = {A {B}},\n  doi = {https://doi.org/10.1/X},\n}\n@misc{k2,\n  title = {no}\n}\n")
    b = readers.bibtex_blocks(spark.read.text(str(tmp_path / "b.md"), wholetext=True)).collect()
    assert [(r.doi, r.type, r.fields["title"]) for r in b] == [("10.1/x", "article", "A B")]
    (tmp_path / "w.md").write_text("* Volume 4: Q11\n* V4, I2: Q12\n")
    assert rows(readers.identifier_lines(readers.lines(spark, str(tmp_path / "w.md"))), "volume", "issue", "item") == [(4, 2, "Q12"), (4, None, "Q11")]
    (tmp_path / "p.md").write_text("## 2018\n- ![gb](f) A. Lee (2018). _The title,_, CAA, Mainz, Germany, 14 June 2018. DOI: [10.1/a](b).\n## 2020\n- ![de](f) B (2020). _T_\n")
    p = readers.publication_lines(readers.lines(spark, str(tmp_path / "p.md"))).collect()
    assert [(r.year, r.language, r.authors, r.title, r.tail) for r in p] == [(2018, "en", "A. Lee", "The title", "CAA, Mainz, Germany, 14 June 2018")]


def test_json_and_yaml(spark, tmp_path):
    (tmp_path / "7.json").write_text('{"id": 8,\n "doi": "x"}')
    assert rows(readers.read_json(spark, str(tmp_path / "7.json"), "id long, doi string", "requested"), "id", "requested") == [(8, "7")]
    files = spark.createDataFrame([('[{"key":"a","size":1}]',), ('{"entries":{"a":{"key":"a","size":2}}}',)], "f string")
    assert [r.f[0].size for r in files.select(readers.archive_files(F.col("f")).alias("f")).collect()] == [1, 2]
    text = "# c\nvolume: 7\nyear: 2024\nissues:\n  - issue: 1\n    title: {en: One, de: \"Eins: x\"}\n    entries:\n      - n: 1\n        types: [a, 'b c']\n        title: Plain text   # note\n        draft: true\n      - n: 2\n        text: >\n          folded\n          lines\n  - issue: 2\n"
    doc = readers.plain_yaml(text)
    assert doc["issues"][0]["entries"][0] == {"n": 1, "types": ["a", "b c"], "title": "Plain text", "draft": True} and doc["issues"][0]["title"]["de"] == "Eins: x" and doc["issues"][0]["entries"][1]["text"] == "folded lines\n" and doc["issues"][1] == {"issue": 2}
    (tmp_path / "v.yaml").write_text(text)
    y = readers.read_yaml(spark, str(tmp_path / "v.yaml"), "volume int, issues array<struct<issue:int,entries:array<struct<n:int,draft:boolean>>>>").first()
    assert y.volume == 7 and y.issues[0].entries[0].draft is True


def test_files_and_steps(tmp_path):
    f = tmp_path / "a" / "x.txt"
    assert sinks.write_if_changed(f, b"1") and not sinks.write_if_changed(f, b"1") and sinks.write_if_changed(f, b"2")
    g = tmp_path / "a" / "old.txt"
    g.write_text("o")
    assert sinks.prune(tmp_path, {f}, "*.txt") == [g] and f.exists()
    source, out = tmp_path / "in", tmp_path / "out"
    source.write_text("1")
    calls = []

    def work():
        calls.append(1)
        out.write_text(source.read_text() * 2)
        return [out]

    step = steps.Step("double", work, [source])
    m = tmp_path / "manifest.json"
    go = lambda **k: [x[1] for x in steps.run([step], steps.Manifest(m), **k)]
    assert go() == ["ran"] and go() == ["skipped"] and go(fresh=True) == ["ran"] and go(dry=True) == ["planned"]
    out.write_text("tampered")
    assert go() == ["ran"]
    source.write_text("3")
    assert go() == ["ran"] and len(calls) == 4
    extra = steps.Step("extra", work, default=False)
    assert steps.chosen([step, extra]) == [step] and steps.chosen([step, extra], only=["extra"]) == [extra] and steps.chosen([step, extra], skip=["double"]) == []
    with pytest.raises(ValueError):
        steps.chosen([step], only=["nope"])
    assert sinks.canonical_json({"b": 1, "a": "ü"}) == '{\n "a": "ü",\n "b": 1\n}\n'


def test_similarity_pairs_against_all_pairs(spark, tmp_path):
    """From pairs of classes and their members follows every pair of a block, with copies and without names."""
    import difflib

    from lodestone import queries as Q

    names = ["oak chair", "oak chain", "Oak chair", None, "", "tide", "diet", "oak chair"]
    rows = [(k, names[k % 8], "b1" if k % 3 else None, f"t{k % 2}", 1 if k < 40 else 2) for k in range(64)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    got = [tuple(r) for r in Q.QUERIES["similarity_pairs"](spark, str(tmp_path)).collect()]
    of, ratios = {}, {}
    for a, b, ratio, back in got:
        if (a, b, ratio, back) == (a, b, 1.0, 1.0):
            of[b] = a
    plain = lambda x: (x or "").lower()
    for a, b, ratio, back in got:
        if b not in of:
            ratios[a, b], ratios[b, a] = ratio, back
    expected = {(a[0], b[0]): round(difflib.SequenceMatcher(None, plain(a[1]), plain(b[1])).ratio(), 6) for a in rows for b in rows if a[0] < b[0] and a[2] and a[2:] == b[2:]}
    rep = lambda k: of.get(k, k)
    assert {(a, b): 1.0 if rep(a) == rep(b) else ratios[rep(a), rep(b)] for a, b in expected} == expected
    assert len(got) < len(expected)
