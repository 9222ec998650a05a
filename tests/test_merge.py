"""The merge and the graph of its records, on a small invented journal."""

import pytest
from pyspark.sql import functions as F

from lodestone import schema
from lodestone.operators import builders, merge, shacl
from lodestone.plans import sparql

BASE = "http://j.example/"
SITE = builders.Site(BASE, "http://pages.example/", "The Journal", "society", ("jj", "http://j.example/ontology#"), {"en": "Types"}, "http://l.example/by")
P = SITE.prefixes()
ISSUE = f"struct<issue:int,sigil:string,special:boolean,title:struct<en:string,de:string>,wikidata:string,entries:array<struct<{schema.ENTRY.replace(' ', ':', 0)}>>>"


def entry_ddl():
    """schema.ENTRY ("name type, ...") as the inside of a struct."""
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema.ENTRY)


@pytest.fixture(scope="module")
def merged(spark):
    from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

    issue = StructType([StructField("issue", IntegerType()), StructField("sigil", StringType()), StructField("special", BooleanType()), StructField("title", StructType.fromDDL("en string, de string")), StructField("wikidata", StringType()), StructField("entries", ArrayType(entry_ddl()))])
    volume = StructType([StructField("volume", IntegerType()), StructField("year", IntegerType()), StructField("coverage", StringType()), StructField("wikidata", StringType()), StructField("issues", ArrayType(issue))])
    names = entry_ddl().names

    def e(n, title, **more):
        return tuple({"n": n, "title": title, **more}.get(k) for k in names)

    person = lambda name, orcid=None: (name, orcid)
    event = lambda name, start, end, place=None, online=False: (name, start, end, None, None, None, place, online)
    rows = [
        (1, None, "2014/2019", None, [(1, "#", None, None, None, [
            e(1, "The use of maps", types=["talk"], creators=[person("Berg, Anna Maria", "0001"), person("Cole, D.")], doi="10.5281/zenodo.11", event=event("Map Days", "2018-05-01", "2018-05-02", "city")),
            e(2, "Alte Karten und neue Daten", types=["paper", "talk", "unheard"], creators=[person("Berg, A."), person("Cole, Dora")], date="2017", event=event("Map Days", "2018-05-10", "2018-05-12", "nowhere")),
        ])]),
        (2, 2020, None, "Q2", [(1, None, True, ("Maps", "Karten"), "Q21", [
            e(1, "Quite another name", creators=[person("F. First")], et_al=True, doi="10.5281/zenodo.12"),
            e(2, "A tool", types=["software"], creators=[person("Berg, Anna", "0001")], links=("http://l.example/x", "http://git.example/r", None, None, None), event=event("Map Days", "2018-11-01", None, None, True), editors=[person("Gray, E.")]),
            e(3, "Not yet", draft=True),
        ])]),
    ]
    record = "key string, id long, conceptdoi string, doi string, files array<struct<key:string,size:long,checksum:string>>, metadata struct<title:string,description:string,publication_date:string,language:string,version:string,keywords:array<string>,license:struct<id:string>,resource_type:struct<type:string,subtype:string,title:string>,creators:array<struct<name:string,orcid:string,affiliation:string>>>"
    archive = [
        ("11", 110, "10.5281/zenodo.10", "10.5281/zenodo.110", [("z.txt", 5, "md5:aa"), ("a b.pdf", 2_000_000, "md5:bb")], ("The use of maps", "<p>About <em>maps</em></p><p>and more", "2018-06-01", "eng", "1.0", ["b", "A", "b"], ("cc-by-4.0",), ("presentation", None, None), [("Berg, Anna Maria", "0001", None), ("Cole, D.", None, None)])),
        ("12", 12, None, None, None, ("Something else", None, "2024-01-01", None, None, None, ("odd-1.0",), ("publication", "article", None), [("First, Frank", "0007", None), ("Second, Sam", None, None)])),
    ]
    places = [("city", "Old Hall, Mapton, Germany", "Q9", None), ("field", "A field", None, (1.5, 2.25))]
    items = [("Q9", {"en": "Old Hall"}, {}, ["Q183", "Q43287"], [], [], (50.1234567, 8.5)), ("Q183", {"en": "Germany"}, {}, [], [], ["Q6256"], None), ("Q43287", {"en": "Empire"}, {}, [], [], ["Q6256", "Q3024240"], None)]
    types = [("presentation", {"en": "Presentation", "de": "Vortrag"}, ["talk"], ["presentation"], "c_1", "Presentation", None, None), ("journal-article", {"en": "Article", "de": "Artikel"}, ["paper"], ["publication/article"], "c_2", None, "close", None), ("software", {"en": "Software", "de": "Software"}, [], [], None, "Computer", None, "journal-article"), ("other", {"en": "Other", "de": "Anderes"}, [], [], None, None, None, None)]
    return merge.merge(
        spark.createDataFrame(rows, volume), spark.createDataFrame(archive, record), spark.createDataFrame(places, "key string, label string, wikidata string, coordinates struct<lat:double,lon:double>"),
        spark.createDataFrame(items, schema.PLACE_ITEM), spark.createDataFrame(types, "slug string, label map<string,string>, aliases array<string>, zenodo array<string>, coar string, fabio string, match string, broader string"), BASE, {"germany": "Q183"}, "Q183",
    )


def test_entries(merged):
    e = {r.id: r for r in merged.entries.collect()}
    assert set(e) == {"v1-i1-e1", "v1-i1-e2", "v2-i1-e1", "v2-i1-e2", "v2-i1-e3"}
    one, two, three, four = (e[k] for k in ("v1-i1-e1", "v1-i1-e2", "v2-i1-e1", "v2-i1-e2"))
    assert one.iri == BASE + "v1/i1/e1" and one.citation_label == "1(1), #1" and one.types == ["presentation"] and two.types == ["journal-article", "presentation"] and three.types == ["journal-article"]
    assert [p.iri for p in one.creators] == [BASE + "person/0001", BASE + "person/cole-dora"] and one.creators[0].name == "Berg, Anna Maria" == two.creators[0].name and two.creators[1].name == "Cole, Dora"
    assert [(p.name, p.orcid) for p in three.creators] == [("First, Frank", "0007"), ("Second, Sam", None)] and four.creators[0].name == "Berg, Anna Maria" and [p.name for p in four.editors] == ["Gray, E."]
    assert one.doi_url == "https://doi.org/10.5281/zenodo.11" and one.zenodo.record == "110" and [f.key for f in one.files] == ["a b.pdf", "z.txt"] and one.pdf.key == "a b.pdf" and one.pdf.download.endswith("/records/110/files/a%20b.pdf?download=1")
    assert one.keywords == ["A", "b"] and one.licence.url.endswith("/by/4.0/") and one.abstract == "About maps\nand more" and one.version == "1.0" and one.title_archive is None and three.title_archive == "Something else"
    assert (one.language, one.language_guessed) == ("en", False) and (two.language, two.language_guessed) == ("de", True)
    assert (one.date, one.year) == ("2018-05-01", 2018) and (two.date, two.year) == ("2017", 2017) and (three.date, three.archive_date, three.year) == (None, "2024-01-01", 2020)
    assert one.event.place.country == "Q183" and one.event.place.lat == 50.123457 and two.event.place is None
    notes = {(r.where, r.kind) for r in merged.notes.collect()}
    assert {("1(1) #2", "unknown-type"), ("2(1) #1", "type-from-archive"), ("1(1) #2", "place-unknown"), ("2(1) #1", "archive-date-ignored"), ("2(1) #1", "licence-unmapped"), ("2(1) #1", "et-al-completed"), ("Cole, D.", "person-merged"), ("2(1) #2", "year-outside-volume")} <= notes
    assert not any(k in ("no-archive-record", "type-missing") for _, k in notes)
    people = merged.people.collect()
    assert [p.name for p in people] == ["Berg, Anna Maria", "Cole, Dora", "First, Frank", "Gray, E.", "Second, Sam"] and people[0].entries == ["v1-i1-e1", "v1-i1-e2", "v2-i1-e2"]


def test_ids_to_entries_in_order(merged, spark):
    lists = spark.createDataFrame([("x", ["v2-i1-e1", "none", "v1-i1-e2", "v1-i1-e1"])], "k string, ids array<string>")
    (row,) = merge.in_order(lists, "ids", merged.entries.select("id", "title"), ["k"]).collect()
    assert [x.id for x in row.entries] == ["v2-i1-e1", "v1-i1-e2", "v1-i1-e1"]


@pytest.fixture(scope="module")
def graph(merged, spark):
    journals = spark.createDataFrame([(BASE, "The Journal", {"en": " A journal ", "de": "Ein Journal"}, "1234-5678", "Q1", "http://l.example/by", ["en", "de"], "The Society", ("Editor", "Eva", "0009"), "2024-01-01")], "iri string, title string, description map<string,string>, issn string, wikidata string, licence string, languages array<string>, publisher string, editor struct<family:string,given:string,orcid:string>, modified string")
    return builders.graph(SITE, journals, merged.volumes, merged.issues, merged.entries, merged.types, BASE)


def rows(graph, text):
    return [tuple(r) for r in sparql.query(graph, text, P).collect()]


def test_graph(graph):
    t = {tuple(r) for r in graph.scan().collect()}
    at = lambda s, p: {(o, kind, type_.rpartition("#")[2], lang) for s_, p_, o, kind, type_, lang in t if s_ == BASE + s and p_ == P[p.split(":")[0]] + p.split(":")[1]}
    e = "v1/i1/e1"
    assert at(e, "dct:title") == {("The use of maps", "literal", "langString", "en")} and at(e, "jj:entryNumber") == {("1", "literal", "positiveInteger", "")} and at(e, "dct:issued") == {("2018-05-01", "literal", "date", "")} and at("v1/i1/e2", "dct:issued") == {("2017", "literal", "gYear", "")}
    assert {o for o, *_ in at(e, "rdf:type")} == {P["dcat"] + "Dataset", P["bibo"] + "Document", P["fabio"] + "Presentation", P["crm"] + "E73_Information_Object", P["lrmoo"] + "F2_Expression"}
    assert {o for o, *_ in at(e + "#authors", "rdf:_1")} == {BASE + "person/0001"} and {o for o, *_ in at(e + "#authors", "rdf:_2")} == {BASE + "person/cole-dora"} and {o for o, *_ in at(e + "#authors", "rdf:type")} == {P["rdf"] + "Seq"}
    assert at(e + "#pdf", "dcat:byteSize") == {("2000000", "literal", "nonNegativeInteger", "")} and at(e + "#pdf-checksum", "spdx:checksumValue") == {("bb", "literal", "hexBinary", "")} and {o for o, *_ in at("v2/i1/e2#landing", "dcat:accessURL")} == {"http://l.example/x"}
    assert {o for o, *_ in at(e, "bibo:presentedAt")} == {BASE + "event/map-days-2018"} == {o for o, *_ in at("v1/i1/e2", "bibo:presentedAt")} and {o for o, *_ in at("v2/i1/e2", "bibo:presentedAt")} == {BASE + "event/map-days-2018-11-01"}
    assert at("event/map-days-2018", "schema:endDate") == {("2018-05-12", "literal", "date", "")} and at("event/map-days-2018#time-span", "crm:P82b_end_of_the_end") == {("2018-05-12T23:59:59", "literal", "dateTime", "")} and at("v1/i1/e2#creation-time-span", "crm:P82a_begin_of_the_begin") == {("2017-01-01T00:00:00", "literal", "dateTime", "")}
    assert at("place/city#geometry", "geo:asWKT") == {("POINT(8.5 50.123457)", "literal", "wktLiteral", "")} and {o for o, *_ in at("place/city", "schema:addressCountry")} == {P["wd"] + "Q183"}
    assert ("The Journal, Band 2, Heft 1: Karten", "literal", "langString", "de") in at("v2/i1", "dct:title") and {o for o, *_ in at("v1", "dct:description")} == {"Volume 1 of the The Journal, covering 2014–2019."} and at("v2/i1", "jj:sigil") == {("#", "literal", "string", "")}
    assert {o for o, *_ in at("type/journal-article", "skos:closeMatch")} == {builders.COAR + "c_2"} and {o for o, *_ in at("type/journal-article", "skos:narrower")} == {BASE + "type/software"} and at("", "bibo:issn") == {("1234-5678", "literal", "string", "")} and {o for o, *_ in at("#issn", "crm:P190_has_symbolic_content")} == {"1234-5678"}
    assert not any("e3" in s for s, *_ in t) and {o for o, *_ in at("org/society", "foaf:name")} == {"The Society"} and (P["eulang"] + "ENG", P["rdf"] + "type", P["dct"] + "LinguisticSystem", "iri", "", "") in t
    assert {r.graph for r in graph.graphs().collect()} == {"main", "crm", "types"} and len(t) == graph.scan().count()


TEXTS = {
    "issues": "SELECT ?issue (COUNT(DISTINCT ?work) AS ?works) (COUNT(?kind) AS ?kinds) (MAX(?place) AS ?last) WHERE { ?work dcat:inSeries ?issue ; jj:entryNumber ?k ; prism:volume ?band BIND(xsd:integer(?k) AS ?place) FILTER(xsd:integer(?band) > 0) OPTIONAL { ?work dct:type ?sort . ?sort skos:notation ?kind } } GROUP BY ?issue ORDER BY ?issue",
    "people": "SELECT ?name (COUNT(DISTINCT ?entry) AS ?n) ?orcid WHERE { ?entry a bibo:Document ; dct:creator|dct:contributor|bibo:editor ?person . ?person foaf:name ?name OPTIONAL { ?person owl:sameAs ?orcid } } GROUP BY ?person ?name ?orcid ORDER BY DESC(?n) ?name",
    "coauthors": "SELECT ?a ?b (COUNT(DISTINCT ?entry) AS ?n) WHERE { ?entry a bibo:Document ; dct:creator ?p1, ?p2 FILTER(STR(?p1) < STR(?p2)) ?p1 foaf:name ?a . ?p2 foaf:name ?b } GROUP BY ?a ?b HAVING (COUNT(DISTINCT ?entry) > 1)",
    "events": "SELECT ?event ?start ?place ?wkt (COUNT(DISTINCT ?entry) AS ?n) WHERE { ?entry bibo:presentedAt ?e . ?e rdfs:label ?event ; schema:location ?p OPTIONAL { ?e schema:startDate ?start } ?p rdfs:label ?place ; geo:hasGeometry/geo:asWKT ?wkt } GROUP BY ?event ?start ?place ?wkt",
    "creation": "SELECT ?title ?person ?begin ?entry WHERE { ?creation a crm:E65_Creation ; crm:P94_has_created ?entry ; crm:P14_carried_out_by ?actor ; crm:P4_has_time-span/crm:P82a_begin_of_the_begin ?begin . ?entry crm:P102_has_title/crm:P190_has_symbolic_content ?title . ?actor rdfs:label ?person } ORDER BY DESC(?begin) ?title ?person LIMIT 200",
    "presented": "SELECT ?event ?place ?title ?pdf WHERE { ?activity a crm:E7_Activity ; crm:P1_is_identified_by/crm:P190_has_symbolic_content ?event ; crm:P16_used_specific_object ?entry ; crm:P7_took_place_at ?p . ?p crm:P168_place_is_defined_by ?wkt ; rdfs:label ?place . ?entry crm:P102_has_title/crm:P190_has_symbolic_content ?title OPTIONAL { ?pdf crm:P165_incorporates ?entry ; a crmdig:D1_Digital_Object } } ORDER BY ?title",
    "pdfs": "SELECT ?volume (COUNT(?file) AS ?n) (ROUND(SUM(?bytes) / 10485.76) / 100 AS ?size) WHERE { ?entry a bibo:Document ; prism:volume ?volume ; dcat:distribution ?file . ?file dcat:byteSize ?bytes } GROUP BY ?volume",
    "venues": "SELECT ?shape ?twin ?remark (COUNT(DISTINCT ?happening) AS ?held) (COUNT(DISTINCT ?talk) AS ?talks) WHERE { ?talk bibo:presentedAt ?happening . ?happening schema:location ?site . ?site geo:hasGeometry/geo:asWKT ?shape OPTIONAL { ?site owl:sameAs ?twin } OPTIONAL { ?happening schema:endDate ?till } OPTIONAL { ?site schema:description ?remark } OPTIONAL { ?happening schema:startDate ?from } FILTER(!BOUND(?till) || STR(?from) <= STR(?till)) } GROUP BY ?site ?shape ?twin ?remark",
}


def test_query_texts(graph):
    assert [(i, int(a), int(b), int(c)) for i, a, b, c in rows(graph, TEXTS["issues"])] == [(BASE + "v1/i1", 2, 3, 2), (BASE + "v2/i1", 2, 2, 2)]
    assert rows(graph, TEXTS["people"])[:2] == [("Anna Maria Berg", 3, "https://orcid.org/0001"), ("Dora Cole", 2, None)]
    assert rows(graph, TEXTS["coauthors"]) == [("Anna Maria Berg", "Dora Cole", 2)]
    assert rows(graph, TEXTS["events"]) == [("Map Days", "2018-05-01", "Old Hall", "POINT(8.5 50.123457)", 2)]
    assert len(rows(graph, TEXTS["creation"])) == 7 and rows(graph, TEXTS["creation"])[0][2] == "2020-01-01T00:00:00"
    assert rows(graph, TEXTS["presented"]) == [("Map Days", "Old Hall", "Alte Karten und neue Daten", None), ("Map Days", "Old Hall", "The use of maps", BASE + "v1/i1/e1#pdf")]
    assert rows(graph, TEXTS["pdfs"]) == [("1", 1, 1.91)]
    ((shape, _, _, held, talks),) = rows(graph, TEXTS["venues"])
    assert (shape, held, talks) == ("POINT(8.5 50.123457)", 1, 2)


def test_rules(graph):
    """A work's label begins with its volume, its title has a language where one is known, its IRI ends with its number; no event ends in a year before its own, no span before it begins."""
    label = "SELECT $this ?value WHERE { ?value prism:volume ?band ; jj:citationLabel ?shown FILTER(STRBEFORE(STR(?shown), '(') != STR(?band)) }"
    language = "SELECT $this ?value WHERE { ?value jj:entryNumber ?k ; dct:language ?speech ; dct:title ?words FILTER(LANG(?words) = '') }"
    iri = "SELECT $this ?value WHERE { ?value jj:entryNumber ?k FILTER(!STRENDS(STR(?value), CONCAT('e', STR(?k)))) }"
    order = "SELECT $this ?value WHERE { $this schema:endDate ?value . $this schema:startDate ?opened FILTER(SUBSTR(STR(?value), 1, 4) < SUBSTR(STR(?opened), 1, 4)) }"
    span = "SELECT $this WHERE { $this crm:P82a_begin_of_the_begin ?a ; crm:P82b_end_of_the_end ?b FILTER(?b < ?a) }"
    shapes = [
        shacl.Shape(target_nodes=[BASE], sparql=[("label", label), ("language", language), ("iri", iri)]), shacl.Shape(target_class=P["event"] + "Event", sparql=[("order", order)]), shacl.Shape(target_class=P["crm"] + "E52_Time-Span", sparql=[("span", span)]),
        shacl.Shape(target_class=P["bibo"] + "Document", pattern=f"^{BASE}v[0-9]+/i[0-9]+/e[0-9]+$", properties=[shacl.Property(P["dct"] + "creator", min_count=1, class_=P["foaf"] + "Person"), shacl.Property(P["bibo"] + "authorList", min_count=1, max_count=1, class_=P["rdf"] + "Seq")]),
    ]
    assert shacl.Validator(graph, P).validate(shapes).collect() == []
    spark = graph.sparkSession
    bad = [(BASE + "x", P["rdf"] + "type", P["bibo"] + "Document", "iri", "", ""), *((BASE + "x", P[p.split(":")[0]] + p.split(":")[1], o, "literal", builders.XSD + "string", "") for p, o in (("jj:citationLabel", "9(9), #8"), ("prism:volume", "1"), ("prism:number", "2"), ("jj:entryNumber", "3"), ("dct:title", "no language"))), (BASE + "x", P["dct"] + "language", P["eulang"] + "ENG", "iri", "", ""), (BASE + "x", P["dcat"] + "inSeries", BASE + "v1/i1", "iri", "", "")]
    stored = graph.scan().unionByName(spark.createDataFrame(bad, "s string, p string, o string, o_kind string, o_type string, o_lang string"))
    found = {(r.focus, r.message, r.value) for r in shacl.Validator(stored, P).validate(shapes[:1]).collect()}
    assert found == {(BASE, m, BASE + "x") for m in ("label", "language", "iri")}


def test_each_predicate_alone(graph):
    """What a scan of some predicates gives is what the whole graph has of them."""
    every = graph.scan().persist()
    for names in (["rdf:type"], ["crm:P1_is_identified_by", "crm:P190_has_symbolic_content"], ["dct:title", "rdf:_1"], ["owl:sameAs"]):
        ps = [P[n.split(":")[0]] + n.split(":")[1] for n in names]
        assert sorted(map(tuple, graph.scan(ps).collect())) == sorted(map(tuple, every.where(F.col("p").isin(ps)).collect()))
    every.unpersist()
