import pytest
from pyspark.sql import functions as F

from lodestone.operators import shacl, triples
from lodestone.plans import sparql
from lodestone.sources import readers, sinks

X = "http://x/"
XSD = sparql.XSD
NAMES = "s string, p string, o string, o_kind string, o_type string, o_lang string"


def graph(spark, *rows):
    """(s, p, o): a str beginning with x: is an IRI, (text, type or @lang) a literal."""
    out = []
    for s, p, o in rows:
        p = sparql.RDF_TYPE if p == "a" else X + p
        if isinstance(o, tuple):
            text, kind = o
            out.append((X + s, p, text, "literal", triples.RDF + "langString" if kind.startswith("@") else XSD + kind, kind[1:] if kind.startswith("@") else ""))
        elif o.startswith("x:"):
            out.append((X + s, p, X + o[2:], "iri", "", ""))
        else:
            out.append((X + s, p, o, "literal", XSD + "string", ""))
    return spark.createDataFrame(out, NAMES)


@pytest.fixture(scope="module")
def people(spark):
    return graph(
        spark, ("a", "a", "x:P"), ("b", "a", "x:P"), ("c", "a", "x:P"), ("a", "name", ("Ann", "@en")), ("a", "name", ("Anna", "@de")), ("b", "name", "Bob"), ("a", "age", ("30", "integer")), ("b", "age", ("9", "integer")),
        ("c", "age", ("old", "string")), ("a", "knows", "x:b"), ("b", "knows", "x:c"), ("c", "knows", "x:a"), ("a", "likes", "x:c"), ("a", "mail", "x:m"),
    )


def ask(t, text):
    df = sparql.query(t, text, {"x": X, "xsd": XSD})
    return sorted(tuple(str(v) if v is not None else None for v in r) for r in df.collect())


S = X


@pytest.mark.parametrize(
    "text, expected",
    [
        ("SELECT ?n WHERE { x:a x:name ?n FILTER(LANG(?n) = 'de') }", [("Anna",)]), ("SELECT ?s WHERE { ?s x:age ?a FILTER(?a < 10) }", [(S + "b",)]), ("SELECT ?s WHERE { ?s x:age ?a FILTER(?a = 30 || STR(?a) = 'old') }", [(S + "a",), (S + "c",)]),
        ("SELECT ?s ?m WHERE { ?s a x:P OPTIONAL { ?s x:mail ?m } } ORDER BY ?s", [(S + "a", S + "m"), (S + "b", None), (S + "c", None)]), ("SELECT ?o WHERE { x:a x:knows/x:knows ?o }", [(S + "c",)]), ("SELECT ?o WHERE { x:a x:knows|x:likes ?o }", [(S + "b",), (S + "c",)]),
        ("SELECT ?o WHERE { x:a ^x:knows ?o }", [(S + "c",)]), ("SELECT ?o WHERE { x:a x:knows+ ?o }", [(S + "a",), (S + "b",), (S + "c",)]), ("SELECT ?s WHERE { ?s x:mail ?m . ?s x:knows x:b }", [(S + "a",)]),
        ("SELECT (COUNT(*) AS ?n) WHERE { ?s a x:P }", [("3",)]), ("SELECT (SUM(?a) AS ?n) (COUNT(?a) AS ?k) WHERE { ?s x:nothing ?a }", [("0", "0")]), ("SELECT (GROUP_CONCAT(?n; SEPARATOR='+') AS ?t) WHERE { x:a x:name ?n }", [("Ann+Anna",)]),
        ("SELECT ?s (COUNT(?o) AS ?n) WHERE { ?s ?p ?o } GROUP BY ?s HAVING (COUNT(?o) > 4)", [(S + "a", "7")]), ("SELECT ?n WHERE { ?s x:name ?n } ORDER BY DESC(?n) LIMIT 1 OFFSET 1", [("Anna",)]), ("SELECT DISTINCT ?p WHERE { x:b ?p ?o } ORDER BY DESC(?p) LIMIT 1", [(X + "name",)]),
        ("SELECT ?x WHERE { x:a x:age ?a BIND(IF(?a > 18, 'adult', 'child') AS ?x) }", [("adult",)]), ("SELECT ?x WHERE { ?s x:age ?a BIND(COALESCE(xsd:integer(?a), -1) AS ?x) }", [("-1",), ("30",), ("9",)]), ("SELECT ?s WHERE { ?s a x:P MINUS { ?s x:name ?n } }", [(S + "c",)]),
        ("SELECT ?s WHERE { ?s a x:P FILTER NOT EXISTS { ?s x:mail ?m } FILTER EXISTS { ?s x:name ?n } }", [(S + "b",)]), ("SELECT ?s WHERE { { ?s x:mail ?o } UNION { ?s x:name 'Bob' } }", [(S + "a",), (S + "b",)]), ("SELECT ?v ?s WHERE { VALUES ?v { 'Bob' 'Zed' } ?s x:name ?v }", [("Bob", S + "b")]),
        ("SELECT ?x WHERE { x:b x:name ?n BIND(CONCAT(UCASE(?n), SUBSTR(?n, 2, 1), STR(STRLEN(?n))) AS ?x) }", [("BOBo3",)]), ("SELECT ?s WHERE { ?s x:name ?n FILTER(REGEX(?n, '^ann', 'i') && STRENDS(?n, 'a')) }", [(S + "a",)]), ("SELECT ?s WHERE { ?s x:age ?a FILTER(?a IN (9, 31)) }", [(S + "b",)]),
        ("SELECT ?s WHERE { ?s a x:P FILTER(?s NOT IN (x:a, x:b)) }", [(S + "c",)]), ("SELECT ?s ?t WHERE { ?s x:knows ?t . ?t x:knows ?s }", []), ("SELECT ?s WHERE { ?s x:knows ?s }", []), ("SELECT ?a ?b WHERE { ?a x:knows ?c . ?b x:likes ?c FILTER(STR(?a) > STR(?b)) }", [(S + "b", S + "a")]),
        ("SELECT ?s WHERE { { SELECT ?s WHERE { ?s x:mail ?m } } ?s a x:P }", [(S + "a",)]), ("SELECT ?s ?n WHERE { ?s a x:P OPTIONAL { ?s x:name ?n FILTER(LANG(?n) = 'en') } }", [(S + "a", "Ann"), (S + "b", None), (S + "c", None)]), ("SELECT (ROUND(?a / 4) AS ?x) WHERE { x:a x:age ?a }", [("8",)]),
        ("SELECT ?s WHERE { ?s x:age ?a FILTER EXISTS { ?t x:age ?b FILTER(?b < ?a) } }", [(S + "a",)]), ("SELECT ?s WHERE { ?s x:age ?a FILTER NOT EXISTS { ?s x:knows ?t . ?t x:age ?b FILTER(?b < ?a) } }", [(S + "b",), (S + "c",)]),
        ("SELECT ?s WHERE { ?s a x:P FILTER(?s = x:c || EXISTS { ?s x:mail ?m }) }", [(S + "a",), (S + "c",)]), ("SELECT ?s WHERE { ?s a x:P FILTER(!EXISTS { ?s x:likes ?m } && EXISTS { ?s x:name ?n FILTER EXISTS { ?k x:knows ?s } }) }", [(S + "b",)]),
        ("SELECT ?s ?n WHERE { ?s a x:P OPTIONAL { ?s x:name ?n FILTER EXISTS { ?s x:mail ?m } } }", [(S + "a", "Ann"), (S + "a", "Anna"), (S + "b", None), (S + "c", None)]), ("SELECT (SUM(?a) AS ?n) WHERE { ?s x:age ?a }", [("39",)]),
        ("ASK { ?s x:age 30 }", [("True",)]), ("ASK WHERE { ?s x:age 31 }", [("False",)]), ("SELECT ?s ?m ?z WHERE { ?s a x:P OPTIONAL { ?s x:mail ?m } ?z x:mail ?m }", [(S + "a", S + "m", S + "a"), (S + "b", S + "m", S + "a"), (S + "c", S + "m", S + "a")]),
        ("CONSTRUCT { ?t x:knownBy ?s ; a x:Q } WHERE { ?s x:knows ?t . ?s x:age 9 }", sorted([(S + "c", X + "knownBy", S + "b", "iri", "", ""), (S + "c", sparql.RDF_TYPE, X + "Q", "iri", "", "")])),
        ("SELECT ?k WHERE { x:a x:knows* ?k }", [(S + "a",), (S + "b",), (S + "c",)]), ("SELECT (MAX(?a) AS ?m) WHERE { ?s x:age ?a FILTER(DATATYPE(?a) = xsd:integer) }", [("30",)]), ("SELECT ?o WHERE { x:a x:age ?a ; x:likes ?o FILTER(isIRI(?o) && isLiteral(?a) && BOUND(?o)) }", [(S + "c",)]),
    ],
)
def test_sparql(people, text, expected):
    assert ask(people, text) == expected


@pytest.mark.parametrize("text", ["SELECT ?x WHERE { ?x nope:y ?z }", "SELECT WHERE { }", "SELECT ?s WHERE { SERVICE <http://e/> { ?s ?p ?o } }", "SELECT ?s WHERE { ?s x:a ?o", "SELECT ?s WHERE { ?s x:age ?a FILTER EXISTS { ?s x:knows ?t OPTIONAL { ?t x:age ?b FILTER(?b > ?a) } } }"])
def test_sparql_refuses(people, text):
    with pytest.raises((sparql.SparqlError, IndexError)):
        sparql.query(people, text, {"x": X})


def test_pushdown(spark, tmp_path, people):
    people.write.parquet(str(tmp_path / "t"))
    plan = sparql.query(spark.read.parquet(str(tmp_path / "t")), "SELECT ?s WHERE { ?s x:knows x:b }", {"x": X})._jdf.queryExecution().toString()
    assert "EqualTo(p,http://x/knows)" in plan


BAD = [
    (shacl.Property(X + "name", min_count=1), {"c"}), (shacl.Property(X + "name", max_count=1), {"a"}), (shacl.Property(X + "knows", class_=X + "P"), set()), (shacl.Property(X + "mail", class_=X + "P"), {"a"}), (shacl.Property(X + "age", datatype=XSD + "integer"), {"c"}),
    (shacl.Property(X + "mail", node_kind="Literal"), {"a"}), (shacl.Property(X + "name", node_kind="BlankNodeOrIRI"), {"a", "b"}), (shacl.Property(X + "name", pattern="^A"), {"b"}), (shacl.Property(X + "name", min_length=4), {"a", "b"}), (shacl.Property(X + "name", in_=[shacl.literal("Bob"), shacl.literal("Ann", triples.RDF + "langString", "en")]), {"a"}),
    (shacl.Property(X + "name", has_value=shacl.literal("Bob")), {"a", "c"}), (shacl.Property(X + "age", or_datatypes=[XSD + "integer", XSD + "string"]), set()), (shacl.Property(X + "name", language_in=["en", "de"]), {"b"}), (shacl.Property(X + "likes", inverse=True, min_count=1), {"a", "b"}),
    (shacl.Property(X + "knows", node=shacl.Shape(properties=[shacl.Property(X + "name", min_count=1)])), {"b"}),
]


@pytest.mark.parametrize("prop, expected", BAD)
def test_shacl(people, prop, expected):
    results = shacl.Validator(people).validate([shacl.Shape(target_class=X + "P", properties=[prop])])
    assert {r.focus.removeprefix(X) for r in results.collect()} == expected


def test_shacl_unique_language_and_sparql(spark, people):
    twice = people.unionByName(graph(spark, ("a", "name", ("Annie", "@en"))))
    shape = shacl.Shape(target_class=X + "P", properties=[shacl.Property(X + "name", unique_lang=True)], sparql=[("young", "SELECT $this ?value WHERE { $this x:age ?value FILTER(?value < 18) }")])
    assert {(r.focus, r.message, r.value) for r in shacl.Validator(twice, {"x": X}).validate([shape]).collect()} == {(X + "a", "uniqueLang", ""), (X + "b", "young", "9")}


def test_subclasses(spark, people):
    deep = people.unionByName(spark.createDataFrame([(X + "Q", shacl.SUB_CLASS, X + "R", "iri", "", ""), (X + "R", shacl.SUB_CLASS, X + "T", "iri", "", ""), (X + "q", sparql.RDF_TYPE, X + "Q", "iri", "", "")], NAMES))
    assert {r.node for r in shacl.instances(deep, X + "T", shacl.class_closure(deep)).collect()} == {X + "q"}


def test_reports(spark, people):
    r = shacl.Validator(people).validate([shacl.Shape(target_class=X + "P", properties=[shacl.Property(X + "name", has_value=shacl.literal("Bob")), shacl.Property(X + "age", datatype=XSD + "integer", severity="Warning")])])
    assert {(x.severity, x.n) for x in shacl.histogram(r).collect()} == {("Violation", 2), ("Warning", 1)}
    assert {(x.path, x.n, x.example) for x in shacl.grouped(r).collect()} == {(X + "name", 2, X + "a"), (X + "age", 1, X + "c")}
    expected = spark.createDataFrame([(X + "name",), (X + "silent",)], "path string")
    assert [x.path for x in shacl.silent(expected, r).collect()] == [X + "silent"]
    refs, props = spark.createDataFrame([("s", "p1"), ("s", "p2")], "shape string, property string"), spark.createDataFrame([("p1",)], "id string")
    kept, gone = shacl.without_dangling(refs, props)
    assert kept.count() == 1 and [x.property for x in gone.collect()] == ["p2"]


def test_projection(spark):
    rows = spark.createDataFrame([("1", "t", None, ["x", "y"]), ("2", None, "z", [])], "id string, title string, doi string, tags array<string>")
    t = triples.project(rows, F.concat(F.lit(X), "id"), [triples.Emit(X + "title", F.col("title"), lang="en"), triples.iri(X + "doi", F.col("doi")), triples.Emit(X + "tag", F.col("tags"), each=True)])
    assert sorted((r.s, r.p, r.o) for r in t.collect()) == [(X + "1", X + "tag", "x"), (X + "1", X + "tag", "y"), (X + "1", X + "title", "t"), (X + "2", X + "doi", "z")]
    seq = triples.ordered_list(rows, F.concat(F.lit(X), "id"), F.col("tags"), "literal")
    assert sorted((r.p.rpartition("#")[2], r.o.rpartition("#")[2]) for r in seq.collect()) == [("_1", "x"), ("_2", "y"), ("type", "Seq")]


def test_views(spark, people):
    assert triples.union(people, people).count() == people.distinct().count()
    assert triples.neighbourhood(people, X + "a").where(F.col("s") == X + "b").count() == 4
    assert X + "m" in {r.term for r in triples.known_terms(people).collect()}
    assert {r.s: r.label for r in triples.described(people, X + "name").collect()}[X + "b"] == "Bob"
    assert [r.prefix for r in triples.prefix_numbers(people, {}).orderBy("namespace").collect()] == ["ns01", "ns02"]
    assert triples.subgraphs(graph(spark, ("a#x", "p", "q"))).first().resource == X + "a"


def test_ntriples_and_turtle(spark, tmp_path, people):
    lines = [r.value for r in sinks.ntriples(people).collect()]
    assert lines == sorted(lines)
    (tmp_path / "t.nt").write_text("\n".join(lines) + "\n# comment\n")
    back = readers.read_ntriples(spark, str(tmp_path / "t.nt")).select("s", "p", "o", "o_kind", "o_lang")
    want = people.select("s", "p", "o", "o_kind", "o_lang")
    assert back.exceptAll(want).isEmpty() and want.exceptAll(back).isEmpty()
    ttl = sinks.canonical_turtle(people, {"x": X, "xsd": XSD})
    assert ttl == sinks.canonical_turtle(people.orderBy(F.rand(1)), {"x": X, "xsd": XSD})
    (tmp_path / "t.ttl").write_text(ttl)
    again = readers.read_turtle(spark, str(tmp_path / "t.ttl")).select("s", "p", "o", "o_kind", "o_lang")
    assert again.exceptAll(want).isEmpty() and want.exceptAll(again).isEmpty()
    (tmp_path / "bad.nt").write_text("nonsense\n")
    with pytest.raises(Exception, match="no triple"):
        readers.read_ntriples(spark, str(tmp_path / "bad.nt")).count()


def test_jsonld(people):
    import json

    nodes = {r.s: json.loads(r.node) for r in sinks.jsonld(people).collect()}
    a = nodes[X + "a"]
    assert a["@id"] == X + "a" and a["@type"] == [X + "P"] and {"@value": "Anna", "@language": "de"} in a[X + "name"] and a[X + "knows"] == [{"@id": X + "b"}]


def test_named_graphs(spark, people):
    stored = people.withColumn("graph", F.when(F.col("p") == X + "age", "http://x/ages").otherwise("http://x/rest"))
    assert ask(stored, "SELECT ?a WHERE { GRAPH <http://x/ages> { x:a ?p ?a } }") == [("30",)]
    assert ask(stored, "SELECT ?g (COUNT(*) AS ?n) WHERE { GRAPH ?g { ?s ?p ?o } } GROUP BY ?g") == [("http://x/ages", "3"), ("http://x/rest", "11")]
    assert ask(stored, "SELECT ?s WHERE { GRAPH <http://x/rest> { ?s x:name 'Bob' } ?s x:age 9 }") == [(S + "b",)]


def views(spark):
    people = spark.createDataFrame([(1, "Ann", 30, None), (2, "Bob", None, "b@x"), (3, None, 9, "c@x")], "k int, name string, age int, mail string")
    posts = spark.createDataFrame([(10, 1, ["p", "q"]), (11, 2, []), (12, 1, None)], "k int, who int, tags array<string>")
    person = lambda c: F.concat(F.lit(X + "person/"), F.col(c).cast("string"))
    e = triples.Emit
    return triples.Graph(
        [
            triples.View("person", people, person("k"), (triples.a(X + "Person"), e(X + "name", F.col("name")), e(X + "age", F.col("age"), type=XSD + "integer"), e(X + "mail", F.col("mail"), when=F.col("k") > 2))),
            triples.View("post", posts, F.concat(F.lit(X + "post/"), F.col("k").cast("string")), (triples.a(X + "Post"), triples.iri(X + "by", person("who")), e(X + "tag", F.col("tags"), each=True), e(X + "name", F.concat(F.lit("post "), "k")))),
            triples.View("person", posts, person("who"), (triples.a(X + "Author"),), key=False),
        ]
    )


TEXTS = [
    "SELECT ?s ?n ?a WHERE { ?s a x:Person ; x:name ?n ; x:age ?a }", "SELECT ?s ?m WHERE { ?s a x:Person OPTIONAL { ?s x:mail ?m } }", "SELECT ?p ?n ?t WHERE { ?p a x:Post ; x:by ?s ; x:tag ?t . ?s x:name ?n }", "SELECT ?s WHERE { ?s a x:Author ; a x:Person }",
    "SELECT ?s ?p ?o WHERE { ?s ?p ?o }", "SELECT ?s WHERE { ?s a x:Person ; x:age 30 }", "SELECT ?p ?pn ?sn WHERE { ?p x:by ?s ; x:name ?pn ; a x:Post . ?s a x:Person ; x:name ?sn }", "SELECT ?s ?c WHERE { ?s a ?c ; x:name ?n }", "SELECT ?a ?b WHERE { ?a a x:Person ; x:name ?x . ?b a x:Post ; x:name ?y }",
    "SELECT ?p WHERE { ?p a x:Post ; x:by <http://x/person/1> }", "SELECT ?n (COUNT(?p) AS ?k) WHERE { ?p x:by ?s . ?s x:name ?n } GROUP BY ?n",
]


@pytest.mark.parametrize("text", TEXTS)
def test_views_answer_like_their_triples(spark, text):
    g = views(spark)
    assert ask(g, text) == ask(g.scan(), text) and ask(g, text)


def test_a_star_is_one_projection(spark, tmp_path):
    spark.createDataFrame([(1, "Ann", 30)], "k int, name string, age int").write.parquet(str(tmp_path / "p"))
    rows = spark.read.parquet(str(tmp_path / "p"))
    g = triples.Graph([triples.View("person", rows, F.concat(F.lit(X), F.col("k").cast("string")), (triples.a(X + "Person"), triples.Emit(X + "name", F.col("name")), triples.Emit(X + "age", F.col("age"), type=XSD + "integer")))])
    plan = sparql.query(g, "SELECT ?s ?n ?a WHERE { ?s a x:Person ; x:name ?n ; x:age ?a }", {"x": X})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "Exchange" not in plan


def test_products_are_bounded(spark):
    with pytest.raises(sparql.SparqlError, match="without a common variable"):
        sparql.query(views(spark), "SELECT ?a ?b WHERE { ?a x:tag ?x . ?b x:mail ?y }", {"x": X}, product_rows=0)
    assert sparql.query(views(spark), "SELECT ?a ?b WHERE { ?a x:tag ?x . ?b x:mail ?y }", {"x": X}, product_rows=5).count() == 2


TTL = """@prefix sh: <http://www.w3.org/ns/shacl#> . @prefix x: <http://x/> . @prefix xsd: <http://www.w3.org/2001/XMLSchema#> . @prefix rdf: <http://www.w3.org/1999/02/22-rdf-syntax-ns#> .
x:Shape a sh:NodeShape ; sh:targetClass x:P ; sh:pattern "/[ab]$" ;
  sh:property [ sh:path x:name ; sh:minCount 1 ; sh:maxCount 1 ; sh:or ( [ sh:datatype xsd:string ] [ sh:datatype rdf:langString ] ) ; sh:message "one name"@en ] ;
  sh:property [ sh:path x:age ; sh:datatype xsd:integer ; sh:severity sh:Warning ] , [ sh:path [ sh:inversePath x:likes ] ; sh:minCount 1 ] ;
  sh:property [ sh:path x:knows ; sh:class x:P ; sh:node x:Named ; sh:nodeKind sh:IRI ] , x:InShape , x:Nowhere ;
  sh:sparql [ sh:message "{$this} is {?value}" ; sh:prefixes x:prefixes ; sh:select '''SELECT $this ?value WHERE { $this e:age ?value FILTER(?value < 18) }''' ] .
x:InShape sh:path x:age ; sh:in ( 9 "old" 30 ) .
x:Named a sh:NodeShape ; sh:property [ sh:path x:name ; sh:minCount 1 ; sh:languageIn ( "en" "de" ) ] .
x:Node sh:targetNode x:a , x:zz ; sh:property [ sh:path x:mail ; sh:hasValue x:m ; sh:minLength 4 ] .
x:Journal sh:targetNode x:J ; sh:sparql [ sh:message "Entry {?value}" ; sh:prefixes x:prefixes ; sh:select "SELECT $this ?value WHERE { ?value e:likes ?o }" ] .
x:prefixes sh:declare [ sh:prefix "e" ; sh:namespace "http://x/"^^xsd:anyURI ] .
"""


def test_shapes_from_turtle(spark, people):
    from lodestone.operators import shapes
    from lodestone.sources.turtle import turtle

    loaded = shapes.shapes(turtle(TTL))
    assert loaded.dangling == [(X + "Shape", X + "Nowhere")] and len(loaded.shapes) == 3
    found = {(r.focus.removeprefix(X), r.path.removeprefix(X), r.severity, r.message, r.value.removeprefix(X)) for r in shacl.Validator(people).validate(loaded.shapes).collect()}
    assert found == {
        ("c", "", "Violation", "pattern", "c"), ("c", "name", "Violation", "one name", ""), ("a", "name", "Violation", "one name", ""), ("c", "age", "Warning", "datatype", "old"), ("a", "likes", "Violation", "minCount", ""), ("b", "likes", "Violation", "minCount", ""),
        ("b", "knows", "Violation", "node", "c"), ("a", "knows", "Violation", "node", "b"), ("b", "", "Violation", "http://x/b is 9", "9"), ("a", "mail", "Violation", "minLength", "m"), ("zz", "mail", "Violation", "hasValue", ""), ("J", "", "Violation", "Entry http://x/a", "a"),
    } - {("a", "mail", "Violation", "minLength", "m")}


@pytest.mark.parametrize("text", ["x:S sh:targetClass x:P ; sh:xone ( ) .", "x:S sh:targetClass x:P ; sh:closed true .", "x:S sh:targetClass x:P ; sh:property [ sh:path ( x:a x:b ) ] .", "x:S sh:targetSubjectsOf x:p ."])
def test_shapes_that_are_refused(text):
    from lodestone.operators import shapes
    from lodestone.sources.turtle import turtle

    with pytest.raises(shapes.ShapeError):
        shapes.shapes(turtle("@prefix sh: <http://www.w3.org/ns/shacl#> . @prefix x: <http://x/> .\n" + text))


def test_turtle():
    from lodestone.sources.turtle import RDF, turtle

    got = turtle("""@base <http://b/d/> . PREFIX x: <http://x/> # a comment
<e> a x:C , x:D ; x:p "a\\u00e9\\"b" , 'c'@EN-gb , '''l'i
ne''' , 1 , -2.5 , 3e4 , true , "5"^^x:t ;; x:q ( x:a "b" ) , [ ] , [ x:r _:n ] , _:n .
[] x:p () . [ x:p x:o ] . x:a.b x:p x:%41\\,c .""")
    lit = lambda v, t, lang="": (v, "literal", t, lang)
    s = "http://b/d/e"
    assert [g[2:] for g in got if g[:2] == (s, X + "p")] == [lit('aé"b', XSD + "string"), lit("c", RDF + "langString", "en-gb"), lit("l'i\nne", XSD + "string"), lit("1", XSD + "integer"), lit("-2.5", XSD + "decimal"), lit("3e4", XSD + "double"), lit("true", XSD + "boolean"), lit("5", X + "t")]
    assert {g[2] for g in got if g[:2] == (s, RDF + "type")} == {X + "C", X + "D"}
    q = [g[2] for g in got if g[:2] == (s, X + "q")]
    assert len(q) == 4 and q[3] == "_:nn" and (q[2], X + "r", "_:nn", "iri", "", "") in got
    first = [g for g in got if g[0] == q[0]]
    assert (q[0], RDF + "first", X + "a", "iri", "", "") in first and any(g[1] == RDF + "nil" or g[2] == RDF + "nil" for g in got)
    assert (X + "a.b", X + "p", X + "%41,c", "iri", "", "") in got and sum(g[1] == X + "p" and g[2] == RDF + "nil" for g in got) == 1
    for bad in ("x:a x:b x:c .", "@prefix x: <http://x/> . x:a x:b", "@prefix x: <http://x/> . 'l' x:b x:c .", "@prefix x: <http://x/> . x:a x:b ^ ."):
        with pytest.raises(ValueError):
            turtle(bad)


def test_what_is_the_same_for_all_objects_is_not_grouped_by(spark):
    """Pairs of a set: neither kinds and types nor a second set of the counted subjects are held in a group's keys."""
    from lodestone import queries
    from lodestone.operators import triples as T

    def pairs(rows, o_type):
        df = spark.createDataFrame(rows, "k long, part long")
        g = T.Graph([T.View("order", df, queries.node("order", "k"), (T.Emit(queries.BASE + "part", F.col("part"), type=o_type),), key=False)])
        return sparql.query(g, "SELECT ?a ?b (COUNT(DISTINCT ?o) AS ?n) WHERE { ?o x:part ?a, ?b FILTER(?a < ?b) } GROUP BY ?a ?b", queries.PREFIXES)

    rows = [(1, 5), (1, 7), (1, 7), (2, 5), (2, 7), (3, 7), (4, None)]
    out = pairs(rows, queries.XSD + "integer")
    assert [tuple(r) for r in out.select("a", "b", "n").collect()] == [("5", "7", 2)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    keyed = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert keyed and not any("XMLSchema" in line for line in keyed)
    # types of the rows' own are told apart as before
    mixed = pairs(rows, F.when(F.col("k") == 2, queries.XSD + "double").otherwise(queries.XSD + "integer"))
    assert sorted(tuple(r) for r in mixed.select("a", "b", "n").collect()) == [("5", "7", 1), ("5", "7", 1)]
