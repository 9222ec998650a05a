"""Queries for joins on what may be unbound, terms of RDF, long chains and large keys, each with SQL.

Registered beside those of queries.py.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import blanks, changes, events, resolve, shacl, triples
from .plans import sparql
from .plans.shared import folder, stored
from .queries import BASE, PREFIXES, XSD, ask, graph, node, register, table
from .sources import formats, readers, sinks

_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _served(spark, sf_dir) -> triples.Graph:
    """Customers with their nation, segment and balance; suppliers with their nation and the segment that they serve."""
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    nation = lambda k: triples.iri(BASE + "nation", F.concat(F.lit(BASE + "nation/"), F.col(k).cast("string")))
    base = lambda k: triples.iri(BASE + "base", F.concat(F.lit(BASE + "nation/"), F.col(k).cast("string")))
    serves = F.element_at(F.array(*map(F.lit, _SEGMENTS)), (F.col("s_suppkey") % 5 + 1).cast("int"))
    return triples.Graph([
        triples.View("customer", c, node("customer", "c_custkey"), (nation("c_nationkey"), triples.Emit(BASE + "segment", F.col("c_mktsegment")), triples.Emit(BASE + "balance", F.col("c_acctbal"), type=XSD + "double"))),
        triples.View("supplier", s, node("supplier", "s_suppkey"), (base("s_nationkey"), triples.Emit(BASE + "serves", serves))),
    ])


_JOINED = f"SELECT 'http://example.org/customer/' || c_custkey AS c, 'http://example.org/supplier/' || s_suppkey AS s FROM customer JOIN supplier ON c_nationkey = s_nationkey AND (%s OR c_mktsegment = ({list(_SEGMENTS)})[s_suppkey %% 5 + 1])"


# --- joins on variables that may be unbound ---------------------------------------------------
@register(_JOINED % "c_acctbal <= 5000")
def sparql_bind_join(spark, sf_dir):
    """A pattern after a BIND that doesn't always bind."""
    return sparql.query(_served(spark, sf_dir), "SELECT ?c ?s WHERE { ?c x:segment ?g ; x:balance ?b ; x:nation ?k BIND(IF(?b > 5000, ?g, ?none) AS ?w) ?s x:base ?k ; x:serves ?w }", PREFIXES)


@register(_JOINED % "c_mktsegment >= 'F'")
def sparql_optional_join(spark, sf_dir):
    """A pattern after an OPTIONAL that doesn't always bind."""
    return sparql.query(_served(spark, sf_dir), "SELECT ?c ?s WHERE { ?c x:nation ?k OPTIONAL { ?c x:segment ?g FILTER(?g < 'F') } ?s x:base ?k ; x:serves ?g }", PREFIXES)


@register("""WITH s AS (SELECT s_suppkey, s_nationkey, ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'][s_suppkey % 5 + 1] AS g FROM supplier)
SELECT 'http://example.org/customer/' || c_custkey AS c FROM customer WHERE c_mktsegment >= 'F' OR NOT EXISTS (SELECT 1 FROM s WHERE g = c_mktsegment AND s_nationkey = c_nationkey)""")
def sparql_minus_unbound(spark, sf_dir):
    """MINUS takes away what has a bound variable in common and agrees; a row that binds less has nothing in common."""
    g = _served(spark, sf_dir)
    text = "SELECT ?c WHERE { ?c x:nation ?k OPTIONAL { ?c x:segment ?g FILTER(?g < 'F') BIND(CONCAT(STR(?k), ?g) AS ?w) } MINUS { ?s x:base ?b ; x:serves ?h BIND(CONCAT(STR(?b), ?h) AS ?w) } }"
    return sparql.query(g, text.replace("FILTER(?g < 'F') BIND", "?c x:nation ?k FILTER(?g < 'F') BIND"), PREFIXES)


# --- terms ------------------------------------------------------------------------------------
def _tagged(spark, sf_dir) -> triples.Graph:
    p = table(spark, sf_dir, "part")
    even = F.col("p_partkey") % 2 == 0
    label = triples.Emit(BASE + "label", F.col("p_brand"), type=F.when(even, XSD + "string").otherwise(triples.RDF + "langString"), lang=F.when(even, "").when(F.col("p_partkey") % 4 == 1, "en").otherwise("de"))
    code = triples.Emit(BASE + "code", F.col("p_size").cast("string"), type=F.when(even, XSD + "string").otherwise(XSD + "integer"))
    maker = BASE + "brand/1"
    made = (triples.Emit(BASE + "made", F.lit(maker), when=even), triples.iri(BASE + "made", F.lit(maker), when=~even))
    return triples.Graph([triples.View("part", p, node("part", "p_partkey"), (label, code, *made))])


@register("SELECT 'http://example.org/part/' || p_partkey AS p, CASE WHEN p_partkey % 2 = 0 THEN 'text' ELSE 'number' END AS kind FROM part WHERE p_size = 5 AND p_partkey % 2 = 0 UNION ALL SELECT 'http://example.org/part/' || p_partkey, 'number' FROM part WHERE p_size = 5 AND p_partkey % 2 = 1")
def sparql_plain_literal(spark, sf_dir):
    """ "5" and 5, in a pattern and in a filter."""
    return sparql.query(_tagged(spark, sf_dir), "SELECT ?p ?kind WHERE { { ?p x:code \"5\" BIND('text' AS ?kind) } UNION { ?p x:code ?o FILTER(?o = 5) BIND('number' AS ?kind) } }", PREFIXES)


@register("SELECT p_brand AS brand, count(*) FILTER (p_partkey % 2 = 0) AS plain, count(*) FILTER (p_partkey % 4 = 1) AS english, count(*) FILTER (p_partkey % 4 = 1) AS matched FROM part WHERE p_brand = (SELECT min(p_brand) FROM part) GROUP BY 1")
def sparql_tagged_literal(spark, sf_dir):
    """ "x", "x"@en and "x"@de are three terms."""
    least = table(spark, sf_dir, "part").agg(F.min("p_brand")).first()[0]
    text = """SELECT ?brand (SUM(?a) AS ?plain) (SUM(?b) AS ?english) (SUM(?c) AS ?matched) WHERE { ?p x:label ?l FILTER(STR(?l) = "@") BIND(STR(?l) AS ?brand)
        BIND(IF(?l = "@", 1, 0) AS ?a) BIND(IF(?l = "@"@en, 1, 0) AS ?b) BIND(IF(LANGMATCHES(LANG(?l), "EN"), 1, 0) AS ?c) } GROUP BY ?brand"""
    out = sparql.query(_tagged(spark, sf_dir), text.replace('"@"', f'"{least}"'), PREFIXES)
    return out.select("brand", *[F.col(c).cast("long").alias(c) for c in ("plain", "english", "matched")])


@register("SELECT CASE WHEN p_partkey % 2 = 0 THEN 'text' ELSE 'iri' END AS kind, count(*) AS n FROM part GROUP BY 1")
def sparql_iri_or_text(spark, sf_dir):
    """An IRI beside its text, told apart by = and by IN."""
    text = "SELECT ?kind (COUNT(?p) AS ?n) WHERE { { ?p x:made ?o FILTER(?o = <http://example.org/brand/1>) BIND('iri' AS ?kind) } UNION { ?p x:made ?o FILTER(?o IN ('http://example.org/brand/1', 'another')) BIND('text' AS ?kind) } } GROUP BY ?kind"
    return sparql.query(_tagged(spark, sf_dir), text, PREFIXES)


@register("SELECT n_name AS name, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey")
def blank_round_trip(spark, sf_dir):
    """Blank nodes written as N-Triples, read back, and asked for."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    blank = lambda c: F.concat(F.lit("_:r"), F.col(c).cast("string"))
    g = triples.Graph([triples.View("nation", n, node("nation", "n_nationkey"), (triples.Emit(BASE + "name", F.col("n_name")), triples.iri(BASE + "part", blank("n_regionkey")))), triples.View("region", r, blank("r_regionkey"), (triples.Emit(BASE + "called", F.col("r_name")),))])
    path = folder(spark, "blank")
    sinks.ntriples(g.scan()).write.text(path)
    return sparql.query(readers.read_ntriples(spark, path), "SELECT ?name ?region WHERE { ?n x:name ?name ; x:part ?b . ?b x:called ?region FILTER(ISBLANK(?b) && ISIRI(?n)) }", PREFIXES)


@register("SELECT c_mktsegment AS segment, c_nationkey AS nation, count(*) AS n FROM customer GROUP BY 1, 2")
def blank_names(spark, sf_dir):
    """Customers as blank nodes, told by segment, nation and orders, under two namings: how many have one canonical name in both graphs. Those alike in all are numbered."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")

    def named(name):
        told = (triples.Emit(BASE + "segment", F.col("c_mktsegment")), triples.iri(BASE + "nation", F.concat(F.lit(BASE + "nation/"), F.col("c_nationkey").cast("string"))))
        views = [triples.View("blank", c, name(F.col("c_custkey")), told), triples.View("order", o, node("order", "o_orderkey"), (triples.iri(BASE + "customer", name(F.col("o_custkey"))),))]
        return blanks.canonical(triples.Graph(views).scan())

    one, two = named(lambda k: F.concat(F.lit("_:a"), k.cast("string"))), named(lambda k: F.concat(F.lit("_:b"), F.sha2(k.cast("string"), 256)))
    both = one.intersect(two).where(blanks.is_blank(F.col("s")))
    is_ = lambda p: F.max(F.when(F.col("p") == BASE + p, F.col("o")))
    rows = both.groupBy("s").agg(is_("segment").alias("segment"), is_("nation").alias("nation"))
    return rows.groupBy("segment", F.regexp_extract("nation", r"(\d+)$", 1).cast("int").alias("nation")).agg(F.count("*").alias("n"))


@register("SELECT c_custkey AS id, split_part(c_name, '#', 1) AS before, split_part(c_name, '#', 2) AS after, 'a%20' || replace(c_mktsegment, '&', '%26') || '~' AS code FROM customer")
def sparql_text_parts(spark, sf_dir):
    """STRBEFORE, STRAFTER, ENCODE_FOR_URI."""
    out = ask(spark, sf_dir, ["customer"], "SELECT ?c ?before ?after ?code WHERE { ?c x:name ?n ; x:segment ?g BIND(STRBEFORE(?n, '#') AS ?before) BIND(STRAFTER(?n, '#') AS ?after) BIND(ENCODE_FOR_URI(CONCAT('a ', ?g, '~')) AS ?code) }")
    return out.select(F.regexp_extract("c", r"(\d+)$", 1).cast("long").alias("id"), "before", "after", "code")


# --- chains and large keys --------------------------------------------------------------------
@register("""WITH gap AS (SELECT min(a.o_orderkey) + 1 AS g FROM orders a WHERE a.o_orderkey >= 5 AND NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_orderkey = a.o_orderkey + 1))
SELECT 'http://example.org/order/' || k AS o FROM (SELECT unnest(range(6, g + 1)) AS k FROM gap)""")
def path_from_node(spark, sf_dir):
    """All that a chain of orders leads to from one of them: thousands of steps, and a few dozen rounds."""
    o = table(spark, sf_dir, "orders")
    after = triples.iri(BASE + "next", F.concat(F.lit(BASE + "order/"), (F.col("o_orderkey") + 1).cast("string")))
    g = triples.Graph([triples.View("order", o, node("order", "o_orderkey"), (after,))])
    return sparql.query(g, "SELECT ?o WHERE { <http://example.org/order/5> x:next+ ?o }", PREFIXES)


@register("""WITH RECURSIVE d AS (SELECT DISTINCT o_orderstatus AS k, o_orderdate::DATE AS day FROM orders), a AS (SELECT k, min(day) AS day FROM d GROUP BY k UNION ALL SELECT a.k, (SELECT min(d.day) FROM d WHERE d.k = a.k AND d.day > a.day + 10) FROM a WHERE a.day IS NOT NULL)
SELECT o_orderkey AS id, count(*) AS cluster FROM orders JOIN a ON a.k = o_orderstatus AND a.day <= o_orderdate::DATE GROUP BY 1""")
def event_cluster_pointers(spark, sf_dir):
    """Anchored clusters of keys with very many days, by pointers to the next anchor."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("k"), F.col("o_orderdate").cast("date").alias("d"))
    return events.anchored_by_day(o, ["k"], "d", 10, few=64).select("id", F.col("cluster").cast("long").alias("cluster"))


@register("""WITH p AS (SELECT c_custkey AS id, ['A.', 'A. B.', 'A. C.', 'A. B. C.', 'D.'][c_custkey % 5 + 1] AS given, c_nationkey AS f FROM customer),
k AS (SELECT f, min(id) FILTER (given = 'A. B. C.') AS abc, min(id) FILTER (given = 'A. C.') AS ac, min(id) FILTER (given = 'A. B.') AS ab, min(id) FILTER (given = 'A.') AS a, min(id) FILTER (given = 'D.') AS d FROM p GROUP BY f)
SELECT id, CASE given WHEN 'A. B. C.' THEN abc WHEN 'A. B.' THEN coalesce(abc, ab) WHEN 'A. C.' THEN ac WHEN 'A.' THEN coalesce(abc, ab, ac, a) ELSE d END AS keeper FROM p JOIN k USING (f)""")
def person_classes(spark, sf_dir):
    """Everyone of a nation is of one family; initials that begin others join the longest given name that fits."""
    given = F.element_at(F.array(*map(F.lit, ("A.", "A. B.", "A. C.", "A. B. C.", "D."))), (F.col("c_custkey") % 5 + 1).cast("int"))
    return resolve.loose_persons(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("family"), given.alias("given")))


# --- validation of changes --------------------------------------------------------------------
def builders_and_orders(spark, sf_dir, after: bool) -> triples.Graph:
    """Orders and the class of their customers; afterwards every tenth customer's class and every fiftieth order's status are others."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    builds = F.col("c_mktsegment") == "BUILDING"
    if after:
        builds = builds != (F.col("c_custkey") % 10 == 0)
        o = o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 50 == 0, "X").otherwise(F.col("o_orderstatus")))
    told = (triples.a(BASE + "Order"), triples.Emit(BASE + "status", F.col("o_orderstatus")), triples.Emit(BASE + "price", F.col("o_totalprice"), type=XSD + "double"), triples.iri(BASE + "customer", F.concat(F.lit(BASE + "customer/"), F.col("o_custkey").cast("string"))))
    return triples.Graph([triples.View("order", o, node("order", "o_orderkey"), told), triples.View("customer", c, node("customer", "c_custkey"), (triples.a(BASE + "Builder", when=builds),))])


ORDER_RULES = [
    shacl.Shape(
        target_class=BASE + "Order",
        properties=[shacl.Property(BASE + "status", in_=[shacl.literal("F"), shacl.literal("O")]), shacl.Property(BASE + "customer", class_=BASE + "Builder")],
        sparql=[("dear", "SELECT ?this WHERE { ?this x:price ?p FILTER(?p > 300000) }")],
    )
]


@register("""WITH o AS (SELECT 'http://example.org/order/' || o_orderkey AS focus, CASE WHEN o_orderkey % 50 = 0 THEN 'X' ELSE o_orderstatus END AS status, 'http://example.org/customer/' || o_custkey AS customer, o_totalprice,
o_custkey IN (SELECT c_custkey FROM customer WHERE (c_mktsegment = 'BUILDING') <> (c_custkey % 10 = 0)) AS builds FROM orders)
SELECT focus, 'in' AS message, status AS value FROM o WHERE status NOT IN ('F', 'O') UNION ALL SELECT focus, 'class', customer FROM o WHERE NOT builds UNION ALL SELECT focus, 'dear', '' FROM o WHERE o_totalprice > 300000""")
def shacl_changes(spark, sf_dir):
    """Results after a change, from those before it and the focus nodes that changed triples reach."""
    before, after = (builders_and_orders(spark, sf_dir, x) for x in (False, True))
    state = stored(changes.validate(ORDER_RULES, before, PREFIXES), "state")
    delta = changes.changed(before, after)
    return changes.results(changes.revalidate(ORDER_RULES, after, delta, state, PREFIXES)).select("focus", "message", "value")


# --- data sources -----------------------------------------------------------------------------
@register("SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY 1, 2")
def graph_source(spark, sf_dir):
    """Orders as canonical Turtle in sixteen files, or more where there are very many, read back by the data source with the predicates pushed into it."""
    path = folder(spark, "turtle")
    formats.write_turtle(graph(spark, sf_dir, "orders").scan(), path, PREFIXES, files=max(16, table(spark, sf_dir, "orders").count() // 25_000))
    of = lambda p: formats.read(spark, path, partition_bytes=str(8 << 20)).where(F.col("p") == BASE + p).select("s", F.col("o").alias(p))
    return of("status").join(of("priority"), "s").groupBy("status", "priority").agg(F.count("*").alias("n"))


@register("SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, c_nationkey AS nation FROM customer")
def yaml_source(spark, sf_dir):
    """Customers as YAML documents, several in a file, read back under a schema."""
    path = folder(spark, "yaml")
    quoted = lambda c: F.substring(F.to_json(F.array(c)), 2, 1 << 20)
    text = lambda c: F.regexp_replace(quoted(c), r"\]$", "")
    c = table(spark, sf_dir, "customer")
    document = F.concat(F.lit("---\nkey: "), F.col("c_custkey").cast("string"), F.lit("\nname: "), text("c_name"), F.lit("\nin:\n  segment: "), text("c_mktsegment"), F.lit("\n  nation: "), F.col("c_nationkey").cast("string"))
    c.select(document.alias("value")).repartition(1 + c.count() // 10_000).write.text(path)
    rows = formats.read_yaml(spark, path, "key long, name string, `in` struct<segment:string,nation:int>", partition_bytes=str(1 << 20))
    return rows.select("key", "name", "in.segment", "in.nation")
