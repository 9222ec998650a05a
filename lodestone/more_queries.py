"""More queries over the test tables: functions of texts, names and dates, resolution, facets, sinks read back, each with SQL.

Registered beside those of queries.py. Inputs are columns of the tables put into the shapes that
an operator reads (a list of authors, a date as it is written, a Markdown link).
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators import builders, checks, cite, events, facets, resolve, shacl, triples
from .plans import sparql
from .plans.shared import folder
from .queries import BASE, PREFIXES, XSD, ask, entries_of, graph, indexed, node, register, table
from .sources import formats, readers, sinks


#: Rows that a task may hold where an order's lines are put together.
TASK_ROWS = 250_000


def s(c: str) -> Column:
    return F.col(c).cast("string")


# --- texts --------------------------------------------------------------------------------
@register("SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name || ' ' || p_brand), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug FROM part")
def slugify(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.slug(F.concat_ws(" ", "p_name", "p_brand")).alias("slug"))


@register("SELECT o_orderkey, trim(regexp_replace('  ' || o_orderpriority || '   x  ' || o_orderstatus || ' ', '[ ]+', ' ', 'g')) AS t FROM orders")
def white_space(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", T.collapse(F.concat(F.lit("  "), "o_orderpriority", F.lit("   x \t"), "o_orderstatus", F.lit(" "))).alias("t"))


@register("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE p_type END AS family, CASE WHEN p_size % 2 = 0 THEN p_type ELSE 'Ann' END AS given FROM part")
def split_name(spark, sf_dir):
    """ "Family, Given" and "Given Family", with a title before."""
    p = table(spark, sf_dir, "part")
    name = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Dr. "), "p_brand", F.lit(", "), "p_type")).otherwise(F.concat("p_type", F.lit(", Ann, PhD")))
    return p.select("p_partkey", T.split_name(name).alias("n")).select("p_partkey", "n.family", "n.given")


@register("SELECT c_custkey, substr(c_mktsegment, 1, 1) || substr(n_name, 1, 1) AS initials FROM customer JOIN nation ON c_nationkey = n_nationkey")
def initials(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    title = lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.regexp_replace(F.substring(x, 2, 99), "[^A-Za-z]", "")))
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).select("c_custkey", T.initials(F.concat(title(F.col("c_mktsegment")), F.lit(" "), title(F.col("n_name")))).alias("initials"))


@register("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d1, strftime(o_orderdate, '%Y-%m-%d') AS d2, strftime(o_orderdate, '%Y-%m-') || '01' AS d3, strftime(o_orderdate, '%Y-%m-') || '28' AS d4 FROM orders")
def event_dates(spark, sf_dir):
    """Written dates: one day in English, one with full stops, a range in German."""
    o, d = table(spark, sf_dir, "orders"), F.col("o_orderdate")
    german = F.element_at(F.array(*[F.lit(m) for m in ("Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember")]), F.month(d))
    english, dotted = T.event_dates(F.date_format(d, "d MMMM yyyy")), T.event_dates(F.date_format(d, "dd.MM.yyyy"))
    span = T.event_dates(F.concat(F.lit("1. - 28. "), german, F.lit(" "), F.year(d).cast("string")))
    return o.select("o_orderkey", english["start"].alias("d1"), dotted["end"].alias("d2"), span["start"].alias("d3"), span["end"].alias("d4"))


@register("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y') || '-01-01T00:00:00' ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00' END AS b, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y') || '-12-31T23:59:59' ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T23:59:59' END AS e, CASE WHEN o_orderkey % 3 = 0 THEN 'xsd:gYear' ELSE 'xsd:date' END AS kind FROM orders")
def time_spans(spark, sf_dir):
    """A year lasts from January to December, a day to its last second."""
    value = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    span = T.time_span(value)
    return table(spark, sf_dir, "orders").select("o_orderkey", span["begin"].alias("b"), span["end"].alias("e"), T.date_type(value).alias("kind"))


@register("SELECT o_orderkey, day(o_orderdate) || ' ' || monthname(o_orderdate) || ' ' || year(o_orderdate) AS en, day(o_orderdate) || '. ' || (['Januar', 'Februar', 'März', 'April', 'Mai', 'Juni', 'Juli', 'August', 'September', 'Oktober', 'November', 'Dezember'])[month(o_orderdate)] || ' ' || year(o_orderdate) AS de FROM orders")
def dates_for_readers(spark, sf_dir):
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select("o_orderkey", T.format_date(d, "en").alias("en"), T.format_date(d, "de").alias("de"))


@register("SELECT o_custkey, string_agg(name, '|' ORDER BY o_orderkey) AS names, count(*) AS n FROM (SELECT o_custkey, o_orderkey, 'Order' || o_orderkey || ', P.' AS name FROM orders) GROUP BY 1")
def split_people(spark, sf_dir):
    """A customer's orders as a list of authors with semicolons, every third with an ORCID link, taken apart again."""
    o = table(spark, sf_dir, "orders")
    link = F.concat(F.lit(" [![ORCID ID](i.png)](https://orcid.org/0000-0000-0000-"), F.lpad((F.col("o_orderkey") % 10000).cast("string"), 4, "0"), F.lit(")"))
    name = F.concat(F.lit("Order"), s("o_orderkey"), F.lit(", P."), F.when(F.col("o_orderkey") % 3 == 0, link).otherwise(""))
    listed = o.groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", name.alias("name")))), lambda x: x["name"]), "; ").alias("t"))
    # a single author needs a separator too, to be told from "Family, Given"
    people = T.split_people(F.concat("t", F.lit(";")))["people"]
    return listed.select("o_custkey", F.array_join(F.transform(people, lambda p: p["name"]), "|").alias("names"), F.size(people).cast("long").alias("n"))


@register("SELECT p_partkey, p_brand || ' is ' || p_type AS t, 'https://e.org/' || p_partkey AS href FROM part")
def markdown_strip(spark, sf_dir):
    m = F.concat(F.lit("**["), "p_brand", F.lit("](https://e.org/"), s("p_partkey"), F.lit(")** is  `"), "p_type", F.lit("`"))
    return table(spark, sf_dir, "part").select("p_partkey", T.strip_markdown(m).alias("t"), T.first_href(m).alias("href"))


@register("SELECT p_partkey, '10.5281/zenodo.' || p_partkey || '|10.1234/' || p_size AS dois, '10.1234/' || p_size AS shown, p_partkey::VARCHAR AS record FROM part")
def doi_extraction(spark, sf_dir):
    """DOIs of a text: a doubled dot is repaired, closing marks and placeholders go; the one shown as a link's text counts."""
    t = F.concat(F.lit("see 10.5281/zenodo.."), s("p_partkey"), F.lit(", [10.1234/"), s("p_size"), F.lit("](https://doi.org/10.1234/"), s("p_size"), F.lit(") and 10.5281/zenodo.xxx."))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(T.dois(t), "|").alias("dois"), T.doi(t).alias("shown"), T.record_id(F.concat(F.lit("10.5281/zenodo."), s("p_partkey"))).alias("record"))


@register("SELECT r_regionkey, CASE WHEN r_regionkey % 2 = 0 THEN 'Q' || length(r_name) ELSE 'Q0' END AS country, r_regionkey % 2 = 0 AS stated FROM region")
def label_country(spark, sf_dir):
    """The country that a label names last, else a default."""
    r = table(spark, sf_dir, "region")
    known = {x.r_name.lower().split(" ")[0]: f"Q{len(x.r_name)}" for x in r.select("r_name").collect()}  # five regions
    label = F.concat(F.lit("Old hall, Town"), F.when(F.col("r_regionkey") % 2 == 0, F.concat(F.lit(", "), F.lower(F.substring_index("r_name", " ", 1)))).otherwise(""))
    return r.select("r_regionkey", T.label_country(label, known, "Q0").alias("c")).select("r_regionkey", "c.country", "c.stated")


@register("SELECT n_nationkey, 'Hall ' || n_nationkey || '|Town ' || n_regionkey || '|HT' AS terms FROM nation")
def search_terms(spark, sf_dir):
    label = F.concat(F.lit("Hall "), s("n_nationkey"), F.lit(" (HT), Town "), s("n_regionkey"), F.lit(", Germany"))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.array_join(T.search_terms(label, ["germany"]), "|").alias("terms"))


@register("SELECT c_custkey, 'x:customer/' || c_custkey AS short, 'http://other.org/' || c_custkey AS other FROM customer")
def short_iri(spark, sf_dir):
    """The CURIE of the longest namespace that fits."""
    p = {"e": "http://example.org/c", "x": BASE, "http": "http://nowhere.org/"}
    return table(spark, sf_dir, "customer").select("c_custkey", T.short_iri(node("customer", "c_custkey"), {k: v for k, v in p.items() if k != "e"}).alias("short"), T.short_iri(F.concat(F.lit("http://other.org/"), s("c_custkey")), p).alias("other"))


@register("SELECT doc_id, len(regexp_extract_all(replace(text, '%', ''), '[&#_$]')) AS escapes FROM documents")
def tex_escapes(spark, sf_dir):
    """LaTeX specials get a backslash each."""
    own = F.replace(F.regexp_replace("text", r"[\\{}~^%]", ""), F.lit("\\"), F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", F.regexp_count(T.tex(own), F.lit(r"\\[&#_$]")).cast("long").alias("escapes"))


@register("SELECT p_partkey, replace(p_name, ' ', '%20') || '/' || replace(p_brand, '#', '%23') AS path FROM part")
def quote_path(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.quote_path(F.concat("p_name", F.lit("/"), "p_brand")).alias("path"))


@register("SELECT p_partkey, 'x:' || maker || '|y:b' AS curies FROM (SELECT p_partkey, regexp_replace(p_type, '[^A-Za-z]', '', 'g') AS maker FROM part)")
def curies(spark, sf_dir):
    t = F.concat(F.lit("of x:"), F.regexp_replace("p_type", "[^A-Za-z]", ""), F.lit(", y:b (z:c) and y:b, http://x:80"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(T.curies(t, ["x", "y"]), "|").alias("curies"))


@register("SELECT o_orderkey, 'v' || (o_orderkey % 9) || '/i' || (o_orderkey % 4) || '/e' || o_orderkey AS path, 'v' || (o_orderkey % 9) || '-i' || (o_orderkey % 4) || '-e' || o_orderkey AS id, (o_orderkey % 9) || '(' || (o_orderkey % 4) || '), #' || o_orderkey AS label FROM orders")
def entry_ids(spark, sf_dir):
    v, i, n = F.col("o_orderkey") % 9, F.col("o_orderkey") % 4, F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", T.entry_path(v, i, n).alias("path"), T.entry_id(v, i, n).alias("id"), T.citation_label(v, i, F.lit("#"), n).alias("label"))


@register("SELECT s_suppkey, s_suppkey % 3 <> 0 AS online FROM supplier")
def online_venue(spark, sf_dir):
    place = F.when(F.col("s_suppkey") % 3 == 0, "Old Hall").when(F.col("s_suppkey") % 3 == 1, "ONLINE, Zoom").otherwise("Virtuell")
    return table(spark, sf_dir, "supplier").select("s_suppkey", T.is_online(place).alias("online"))


@register("SELECT p_partkey, p_name || 'x a b' AS t FROM part")
def html_text(spark, sf_dir):
    """Plain text of markup: a new line at a paragraph, the text of unknown tags stays."""
    html = F.concat(F.lit("<p>"), "p_name", F.lit("</p><script>x</script> a  b"))
    return table(spark, sf_dir, "part").select("p_partkey", T.clean_html(html)["text"].alias("t"))


@register("SELECT doc_id, strip_accents(lower(text)) AS t FROM documents")
def accent_fold(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.fold(F.col("text")).alias("t"))


@register("SELECT doc_id, sha256(text) AS h FROM documents")
def fingerprints(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("h"))


# --- patterns and expressions -------------------------------------------------------------
@register("SELECT upper(substr(c_mktsegment, 1, 3)) || '-' || length(c_name) AS code, count(*) AS n FROM customer WHERE regexp_matches(c_mktsegment, '^b', 'i') OR ends_with(c_mktsegment, 'Y') OR contains(c_mktsegment, 'OBIL') GROUP BY 1")
def sparql_strings(spark, sf_dir):
    """REGEX, STRENDS, CONTAINS, CONCAT, UCASE, STRLEN, SUBSTR."""
    return ask(spark, sf_dir, ["customer"], "SELECT ?code (COUNT(?c) AS ?n) WHERE { ?c x:segment ?s ; x:name ?m FILTER(REGEX(?s, '^b', 'i') || STRENDS(?s, 'Y') || CONTAINS(?s, 'OBIL')) BIND(CONCAT(UCASE(SUBSTR(?s, 1, 3)), '-', STR(STRLEN(?m))) AS ?code) } GROUP BY ?code")


@register("SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, count(*) AS n FROM orders WHERE day(o_orderdate) < 10 GROUP BY 1, 2")
def sparql_dates(spark, sf_dir):
    out = ask(spark, sf_dir, ["orders"], "SELECT ?y ?m (COUNT(?o) AS ?n) WHERE { ?o x:date ?d FILTER(DAY(?d) < 10) BIND(YEAR(?d) AS ?y) BIND(MONTH(?d) AS ?m) } GROUP BY ?y ?m")
    return out.select(F.col("y").cast("long").alias("y"), F.col("m").cast("long").alias("m"), "n")


@register("SELECT 'http://example.org/doc/' || doc_id AS d, n_chars::BIGINT AS size FROM documents ORDER BY n_chars DESC, 1 LIMIT 50")
def order_by_cast(spark, sf_dir):
    """A report in the order of a cast."""
    out = ask(spark, sf_dir, ["documents"], "SELECT ?d ?size WHERE { ?d a x:Document ; x:size ?size } ORDER BY DESC(xsd:integer(?size)) ?d LIMIT 50")
    return out.select("d", F.col("size").cast("long").alias("size"))


@register("SELECT c_mktsegment AS segment, min(n_name) AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def sparql_sample(spark, sf_dir):
    """SAMPLE, which here is the least."""
    return ask(spark, sf_dir, ["customer", "nation"], "SELECT ?segment (SAMPLE(?n) AS ?nation) WHERE { ?c x:segment ?segment ; x:nation ?k . ?k x:name ?n } GROUP BY ?segment")


@register("SELECT 'http://example.org/nation/' || n_nationkey AS k, count(c_custkey) AS n FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1")
def inverse_path(spark, sf_dir):
    return ask(spark, sf_dir, ["nation", "customer"], "SELECT ?k (COUNT(?c) AS ?n) WHERE { ?k a x:Nation ; ^x:nation ?c } GROUP BY ?k")


@register("SELECT 'http://example.org/' || p AS p, count(*) AS n FROM (SELECT unnest(['name', 'segment', 'balance', 'nation']) AS p FROM customer) GROUP BY 1")
def wildcard_pattern(spark, sf_dir):
    """A pattern with a variable predicate."""
    return ask(spark, sf_dir, ["customer"], "SELECT ?p (COUNT(?o) AS ?n) WHERE { ?s ?p ?o FILTER(STRSTARTS(STR(?p), 'http://example.org/')) } GROUP BY ?p")


@register("SELECT l_returnflag AS flag, sum(l_quantity)::BIGINT AS total FROM lineitem GROUP BY 1")
def sparql_sum(spark, sf_dir):
    """SUM of integers is an integer."""
    rows = table(spark, sf_dir, "lineitem").withColumn("k", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"))
    g = triples.Graph([triples.View("line", rows, node("line", "k"), (triples.Emit(BASE + "flag", F.col("l_returnflag")), triples.Emit(BASE + "q", F.col("l_quantity").cast("long"), type=XSD + "integer")))])
    out = sparql.query(g, "SELECT ?flag (SUM(?q) AS ?total) WHERE { ?l x:flag ?flag ; x:q ?q } GROUP BY ?flag", PREFIXES)
    return out.select("flag", F.col("total").cast("long").alias("total"))


@register("SELECT lang, count(*) AS n FROM documents WHERE lang <> 'en' GROUP BY 1")
def sparql_lang(spark, sf_dir):
    """LANG and DATATYPE of literals."""
    d = table(spark, sf_dir, "documents")
    g = triples.Graph([triples.View("doc", d, node("doc", "doc_id"), (triples.Emit(BASE + "label", F.col("source"), type=triples.RDF + "langString", lang=F.col("lang")),))])
    return sparql.query(g, "SELECT ?lang (COUNT(?d) AS ?n) WHERE { ?d x:label ?l FILTER(LANG(?l) != 'en' && DATATYPE(?l) = rdf:langString) BIND(LANG(?l) AS ?lang) } GROUP BY ?lang", PREFIXES)


@register("SELECT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'P') AS answer")
def sparql_ask(spark, sf_dir):
    return ask(spark, sf_dir, ["orders"], "ASK { ?o a x:Order ; x:status 'P' }")


@register("SELECT DISTINCT 'http://example.org/nation/' || c_nationkey AS s, 'http://example.org/has' AS p, c_mktsegment AS o FROM customer")
def sparql_construct(spark, sf_dir):
    return ask(spark, sf_dir, ["customer"], "CONSTRUCT { ?k x:has ?s } WHERE { ?c x:nation ?k ; x:segment ?s }").select("s", "p", "o")


@register("SELECT 'orders' AS g, count(*) * 2 AS n FROM orders UNION ALL SELECT 'customers', count(*) * 2 FROM customer")
def sparql_graph(spark, sf_dir):
    """GRAPH with a variable: each named graph in turn."""
    two = lambda name, kind, key, p, c: triples.View(kind, table(spark, sf_dir, name), node(kind, key), (triples.a(BASE + kind), triples.Emit(BASE + p, F.col(c))), graph=BASE + name)
    g = triples.Graph([two("orders", "order", "o_orderkey", "status", "o_orderstatus"), two("customer", "customer", "c_custkey", "segment", "c_mktsegment")])
    out = sparql.query(g, "SELECT ?g (COUNT(?s) AS ?n) WHERE { GRAPH ?g { ?s ?p ?o } } GROUP BY ?g", PREFIXES)
    return out.select(F.when(F.col("g") == BASE + "orders", "orders").otherwise("customers").alias("g"), "n")


@register("SELECT s_name AS a, r_name AS place FROM supplier LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey AND r_name < 'B') ON s_nationkey = n_nationkey")
def sparql_optional_chain(spark, sf_dir):
    """An OPTIONAL of a chain with a filter inside."""
    return ask(spark, sf_dir, ["supplier", "nation", "region"], "SELECT ?a ?place WHERE { ?s x:name ?a ; x:base ?k OPTIONAL { ?k x:region ?r . ?r x:name ?place FILTER(?place < 'B') } }")


# --- resolution ---------------------------------------------------------------------------
@register("SELECT c_custkey AS id, first_value(c_custkey) OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS keeper FROM customer")
def loose_persons(spark, sf_dir):
    """Persons of one family name and one initial join the first of them."""
    c = table(spark, sf_dir, "customer")
    return resolve.loose_persons(c.select(F.col("c_custkey").alias("id"), F.concat(F.lit("n"), s("c_nationkey")).alias("family"), F.concat(F.substring("c_mktsegment", 1, 1), F.lit(".")).alias("given")))


@register("SELECT p_partkey AS id, CASE WHEN p_size <= 10 THEN p_brand || '-' || p_size ELSE NULL END AS key, CASE WHEN p_size <= 10 THEN 'doi' END AS how FROM part")
def match_publications(spark, sf_dir):
    """New titles against known ones by DOI."""
    p = table(spark, sf_dir, "part")
    doi = F.concat(F.lit("10.1/"), "p_brand", F.lit("-"), s("p_size"))
    known = p.where("p_size <= 10").select(F.concat("p_brand", F.lit("-"), s("p_size")).alias("key"), doi.alias("doi"), F.lit("a title").alias("title"), F.lit(2).alias("volume")).distinct()
    return resolve.match_publications(p.select(F.col("p_partkey").alias("id"), F.upper(doi).alias("doi"), F.lit("A title!").alias("title")), known)


@register("""WITH h AS (SELECT l_orderkey AS place, 'Q' || l_partkey AS id, 10 - (l_linenumber - 1) + CASE WHEN l_quantity > 25 THEN 5 ELSE 0 END AS score FROM lineitem),
b AS (SELECT place, id, max(score) AS score FROM h GROUP BY 1, 2) SELECT place, id, score::DOUBLE AS score, row_number() OVER (PARTITION BY place ORDER BY score DESC, substr(id, 2)::BIGINT)::INTEGER AS rank FROM b QUALIFY rank <= 3""")
def rank_candidates(spark, sf_dir):
    """The three best candidates of each place."""
    l = table(spark, sf_dir, "lineitem")
    hits = l.select(F.col("l_orderkey").alias("place"), F.concat(F.lit("Q"), s("l_partkey")).alias("id"), (F.col("l_linenumber") - 1).alias("term_rank"), F.lit(0).alias("hit_rank"), (F.col("l_quantity") > 25).alias("has_coordinates"), F.lit(None).cast("boolean").alias("same_country"), F.lit(False).alias("stated"), F.lit(0.0).alias("similarity"), F.lit(False).alias("is_station"), F.lit(0.0).alias("km_from_city"), F.lit(1).alias("n_terms"))
    return resolve.rank_candidates(hits).select("place", "id", F.col("score").cast("double").alias("score"), "rank")


@register("SELECT o_custkey AS person, string_agg(o_orderkey::VARCHAR, '|' ORDER BY year(o_orderdate), month(o_orderdate), o_orderkey) AS entries FROM orders GROUP BY 1")
def person_index(spark, sf_dir):
    """Each person's entries in journal order, once."""
    o = table(spark, sf_dir, "orders")
    rows = o.select(F.col("o_orderkey").alias("entry"), F.year("o_orderdate").alias("volume"), F.month("o_orderdate").alias("issue"), F.col("o_orderkey").alias("n"), F.col("o_custkey").alias("person"))
    return resolve.person_index(rows.union(rows)).select("person", F.array_join(F.col("entries").cast("array<string>"), "|").alias("entries"))


@register("SELECT o_orderkey AS id, string_agg(l_returnflag || l_linestatus, '|' ORDER BY first, l_returnflag, l_linestatus) AS types FROM (SELECT l_orderkey AS o_orderkey, l_returnflag, l_linestatus, min(l_linenumber) AS first FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2, 3) GROUP BY 1")
def type_slugs(spark, sf_dir):
    """Labels to slugs through aliases, in the order they're first seen; unknown ones are left out."""
    l = table(spark, sf_dir, "lineitem")
    l = l.repartition(1 + l.count() // TASK_ROWS, "l_orderkey")  # tasks grow in number, not in size
    r = l.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", F.concat("l_returnflag", F.lit("|"), "l_linestatus").alias("t")))), lambda x: x["t"]).alias("labels"))
    concepts = spark.createDataFrame([(a + b, [f"{a}|{b}"]) for a in "AR" for b in "FO"], "slug string, aliases array<string>")
    return resolve.type_slugs(r.withColumnRenamed("l_orderkey", "id"), "id", F.col("labels"), concepts)[0].select("id", F.array_join("types", "|").alias("types"))


@register("SELECT p_partkey AS id, CASE WHEN p_size > 25 THEN p_type || '/big' ELSE p_type END AS slug FROM part")
def archive_type(spark, sf_dir):
    """ "type/subtype" first, then "type"."""
    p = table(spark, sf_dir, "part").withColumn("id", F.col("p_partkey"))
    makers = p.select("p_type").distinct()
    concepts = makers.select(F.concat("p_type", F.lit("/big")).alias("slug"), F.array(F.concat("p_type", F.lit("/big"))).alias("zenodo")).union(makers.select("p_type", F.array("p_type")))
    return resolve.archive_type(p, "id", F.col("p_type"), F.when(F.col("p_size") > 25, "big").otherwise("small"), concepts)


@register("""WITH u AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS seen FROM events WHERE event_id % 3 > 0 GROUP BY 1, 2), b AS (SELECT user_id, first(event_type ORDER BY n DESC, seen) AS usual FROM u GROUP BY 1)
SELECT event_id AS id, 0 AS pos, coalesce(CASE WHEN event_id % 3 > 0 THEN event_type END, usual) AS name FROM events LEFT JOIN b USING (user_id)""")
def named_by_identifier(spark, sf_dir):
    """Rows with an identifier and no name get its most frequent name, of several the one seen first."""
    e = table(spark, sf_dir, "events")
    rows = e.select(F.col("event_id").alias("id"), F.lit(0).alias("pos"), F.when(F.col("event_id") % 3 > 0, F.col("event_type")).alias("name"), s("user_id").alias("orcid"))
    return resolve.named_by_identifier(rows).select("id", "pos", "name")


@register("SELECT o_orderkey, CASE WHEN o_orderkey % 5 + 1 = 1 THEN CASE WHEN year(o_orderdate) BETWEEN 2014 AND 2019 THEN strftime(o_orderdate, '%Y-%m-%d') END WHEN year(o_orderdate) = 1995 THEN strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders")
def plausible_dates(spark, sf_dir):
    """An archive's date counts inside its volume's year only."""
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select("o_orderkey", resolve.plausible_date(d, F.col("o_orderkey") % 5 + 1, F.lit(1995)).alias("d"))


@register("SELECT l_orderkey AS id, string_agg(l_partkey::VARCHAR, '|' ORDER BY l_linenumber, l_partkey::VARCHAR) AS ids FROM (SELECT *, bool_or(l_returnflag = 'R') OVER (PARTITION BY l_orderkey) AS preferred FROM lineitem WHERE l_returnflag <> 'A') WHERE CASE WHEN preferred THEN l_returnflag = 'R' ELSE l_linestatus = 'O' END GROUP BY 1")
def current_claims(spark, sf_dir):
    """Preferred claims, else those that haven't ended; deprecated ones never."""
    l = table(spark, sf_dir, "lineitem")
    rank = F.when(F.col("l_returnflag") == "A", "deprecated").when(F.col("l_returnflag") == "R", "preferred").otherwise("normal")
    made = l.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", s("l_partkey").alias("id"), rank.alias("rank"), (F.col("l_linestatus") != "O").alias("ended")))).alias("claims"))
    return made.select(F.col("l_orderkey").alias("id"), resolve.current_claims(F.col("claims")).alias("ids")).where(F.size("ids") > 0).select("id", F.array_join("ids", "|").alias("ids"))


# --- facets -------------------------------------------------------------------------------
@register("SELECT source AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, source)::INTEGER AS place FROM documents GROUP BY 1 QUALIFY place <= 8 OR source = 'src19'")
def facet_shown(spark, sf_dir):
    """Eight values of a facet in their order, and the chosen one."""
    return facets.shown(facets.counts(indexed(spark, sf_dir)), "source", ["src19"]).select("value", "n", "place")


@register("SELECT lang AS value, count(*) AS n FROM documents GROUP BY 1")
def facet_order(spark, sf_dir):
    return facets.ordered(facets.counts(indexed(spark, sf_dir)), "lang").select("value", "n")


@register("SELECT DISTINCT year(o_orderdate) AS year FROM orders")
def year_list(spark, sf_dir):
    """Distinct years, falling."""
    return table(spark, sf_dir, "orders").agg(F.sort_array(F.collect_set(F.year("o_orderdate")), False).alias("years")).select(F.explode("years").alias("year")).select(F.col("year").cast("long").alias("year"))


# --- checks -------------------------------------------------------------------------------
@register("SELECT 'http://example.org/customer/' || c_custkey AS term FROM customer UNION SELECT 'http://example.org/nation/' || c_nationkey FROM customer UNION SELECT unnest(['http://example.org/Customer', 'http://example.org/name', 'http://example.org/segment', 'http://example.org/balance', 'http://example.org/nation', 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type', 'http://www.w3.org/2001/XMLSchema#string', 'http://www.w3.org/2001/XMLSchema#double'])")
def known_terms(spark, sf_dir):
    """Every IRI of a graph, in any position."""
    return triples.known_terms(graph(spark, sf_dir, "customer").scan())


@register("SELECT 'x:p' || p_size AS curie FROM part WHERE p_size > 20 GROUP BY 1")
def unknown_terms(spark, sf_dir):
    """CURIEs that no graph knows."""
    p = table(spark, sf_dir, "part")
    terms = p.where("p_size <= 20").select(F.concat(F.lit(BASE + "p"), s("p_size")).alias("term")).distinct()
    return checks.unknown_terms(p.select(F.concat(F.lit("see x:p"), s("p_size")).alias("t")), "t", terms, {"x": BASE})


@register("SELECT page_id::VARCHAR AS page, '../' || (page_id * 2) || '.html' AS href FROM pages WHERE page_id * 2 NOT IN (SELECT page_id FROM pages)")
def broken_links(spark, sf_dir):
    """Links to files that don't exist, after paths are walked."""
    p = table(spark, sf_dir, "pages")
    links = p.select(F.concat(F.lit("d/"), s("page_id"), F.lit(".html")).alias("page"), F.concat(F.lit("../"), (F.col("page_id") * 2).cast("string"), F.lit(".html")).alias("href"))
    out = checks.broken_links(links, p.select(F.concat(s("page_id"), F.lit(".html")).alias("path")))
    return out.select(F.regexp_extract("page", r"d/(\d+)\.html", 1).alias("page"), "href")


@register("SELECT o_orderkey AS shape, o_custkey AS property FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def dangling_references(spark, sf_dir):
    """References to properties that aren't there."""
    refs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("shape"), F.col("o_custkey").alias("property"))
    return shacl.without_dangling(refs, table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("id")))[1]


@register("SELECT c_nationkey AS nation, max(c_acctbal) AS best FROM customer GROUP BY 1")
def best_of_each(spark, sf_dir):
    """The most of each key."""
    return table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.max("c_acctbal").alias("best"))


@register("""WITH RECURSIVE o AS (SELECT o_custkey AS k, o_orderkey AS id, o_orderdate::DATE AS d, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders),
c AS (SELECT k, id, rn, d, d AS anchor, 1 AS cluster FROM o WHERE rn = 1 UNION ALL SELECT o.k, o.id, o.rn, o.d, CASE WHEN date_diff('day', c.anchor, o.d) <= 60 THEN c.anchor ELSE o.d END, CASE WHEN date_diff('day', c.anchor, o.d) <= 60 THEN c.cluster ELSE c.cluster + 1 END FROM c JOIN o ON o.k = c.k AND o.rn = c.rn + 1)
SELECT id, cluster FROM c""")
def event_cluster_ordered(spark, sf_dir):
    """Anchored clusters by an ordered fold."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("d"))
    return events.anchored_clusters(o, ["k"], "d", ["d", "id"], 60).select("id", "cluster")


@register("SELECT 'http://example.org/order/' || l_orderkey AS s, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#_' || row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS p, l_partkey::VARCHAR AS o FROM lineitem")
def list_positions(spark, sf_dir):
    """Members of an ordered list with their numbers."""
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("parts"))
    return triples.ordered_members(l, node("order", "l_orderkey"), F.col("parts")).select("s", "p", "o")


@register("SELECT 'http://e.org/' || lower(maker) || '/' AS namespace, 'ns' || lpad(row_number() OVER (ORDER BY lower(maker))::VARCHAR, 2, '0') AS prefix FROM (SELECT DISTINCT regexp_replace(p_type, '[^A-Za-z0-9]', '', 'g') AS maker FROM part)")
def prefix_numbers(spark, sf_dir):
    """Invented prefixes in the order of their namespaces."""
    p = table(spark, sf_dir, "part")
    t = p.select(node("part", "p_partkey").alias("s"), F.concat(F.lit("http://e.org/"), F.lower(F.regexp_replace("p_type", "[^A-Za-z0-9]", "")), F.lit("/p")).alias("p"), F.col("p_name").alias("o"))
    return triples.prefix_numbers(t, {"x": BASE})


@register("SELECT 'http://example.org/customer/' || c_custkey AS s, c_name AS label, 'http://example.org/Customer' AS types FROM customer")
def described_nodes(spark, sf_dir):
    """Each subject's label and first classes."""
    return triples.described(graph(spark, sf_dir, "customer").scan([BASE + "name", sparql.RDF_TYPE]), BASE + "name").select("s", "label", F.array_join("types", "|").alias("types"))


@register("SELECT count(*) AS n FROM (SELECT 1 FROM customer WHERE c_nationkey = 3 UNION ALL SELECT 1 FROM nation WHERE n_nationkey = 3)")
def neighbourhood(spark, sf_dir):
    """The edges around one node: of what points to it, each has five triples, and the nation and its region have three and two."""
    g = graph(spark, sf_dir, "customer", "nation", "region").scan()
    edges = triples.neighbourhood(g, BASE + "nation/3", reverse=True)
    return edges.where((F.col("p") == sparql.RDF_TYPE) & F.col("o").isin(BASE + "Customer", BASE + "Nation")).agg(F.count("*").alias("n"))


# --- citations ----------------------------------------------------------------------------
@register("SELECT p_partkey::VARCHAR AS id, p_brand || ', ' || CASE WHEN p_size > 10 THEN substr(p_type, 1, 1) || '.' ELSE '' END AS who, p_size > 25 AS has_doi FROM part")
def short_citation(spark, sf_dir):
    """Authors with initials, and the DOI or the address at the end."""
    e = entries_of(spark, sf_dir).withColumn("creators", F.transform("creators", lambda p: F.struct(p["family"].alias("family"), F.when(p["given"] != "", F.initcap(F.lower(F.regexp_extract(p["given"], "^([A-Za-z]+)", 1)))).otherwise("").alias("given"))))
    text = cite.short_citation(e, "J")
    who = F.regexp_extract("text", r"^(.*?) \(2024\)\. ", 1)
    return text.select("id", F.when(F.endswith(who, F.lit(".")), who).otherwise(F.concat(who, F.lit(", "))).alias("who"), F.contains("text", F.lit("https://doi.org/10.1/")).alias("has_doi"))


@register("SELECT p_partkey::VARCHAR AS id, 'Dataset' AS kind, p_name AS name, (p_size % 8 + 1)::VARCHAR AS volume, CASE WHEN p_size > 25 THEN '10.1/' || p_partkey END AS doi, p_brand || ' fair' AS event FROM part".replace("|| ' fair'", ""))
def schema_org(spark, sf_dir):
    """schema.org nodes, read back from their JSON."""
    out = cite.schema_org(entries_of(spark, sf_dir), "J", "1", BASE)
    get = lambda path: F.get_json_object("node", path)
    return out.select("id", get("$['@type']").alias("kind"), get("$.name").alias("name"), get("$.isPartOf.isPartOf.volumeNumber").alias("volume"), get("$.identifier.value").alias("doi"), get("$.recordedAt.name").alias("event"))


@register("SELECT p_partkey::VARCHAR AS id, 'article-journal' AS kind, p_name AS title, CASE WHEN p_size > 10 THEN p_brand END AS family, CASE WHEN p_size <= 10 THEN p_brand END AS literal, '#' || p_partkey AS page, '[[2024,5,8]]' AS issued, CASE WHEN p_size > 25 THEN '10.1/' || p_partkey END AS doi FROM part")
def csl_fields(spark, sf_dir):
    """CSL items, read back from their JSON."""
    get = lambda path: F.get_json_object("csl", path)
    out = cite.csl(entries_of(spark, sf_dir), "J", "1")
    return out.select("id", get("$.type").alias("kind"), get("$.title").alias("title"), get("$.author[0].family").alias("family"), get("$.author[0].literal").alias("literal"), get("$.page").alias("page"), get("$.issued.date-parts").alias("issued"), get("$.DOI").alias("doi"))


@register("SELECT p_partkey::VARCHAR AS id, '@article{sp_vol' || (p_size % 8 + 1) || '_iss' || (p_size % 4 + 1) || '_e' || p_partkey || ',' AS head, p_name AS title, '2024' AS year, 'may' AS month, CASE WHEN p_size > 25 THEN '10.1/' || p_partkey END AS doi FROM part")
def bibtex_fields(spark, sf_dir):
    """BibTeX entries, read back by their lines."""
    field = lambda n: F.nullif(F.regexp_extract("bibtex", rf"(?m)^  {n} = \{{?(.*?)\}}?,?$", 1), F.lit(""))
    return cite.bibtex(entries_of(spark, sf_dir), "J", "1").select("id", F.substring_index("bibtex", "\n", 1).alias("head"), F.replace(field("title"), F.lit("\\"), F.lit("")).alias("title"), field("year").alias("year"), field("month").alias("month"), F.replace(field("doi"), F.lit("\\"), F.lit("")).alias("doi"))


@register("SELECT n_name AS name, count(c_custkey) AS n, (n_nationkey * 3.0)::DOUBLE AS lon FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name, n_nationkey")
def geojson_fields(spark, sf_dir):
    """Map features, read back from their JSON."""
    from .queries import geojson_features

    kind = "struct<geometry:struct<coordinates:array<double>>,properties:struct<name:string,entries:array<struct<iri:string>>>>"
    out = geojson_features(spark, sf_dir).select(F.from_json("feature", kind).alias("f"))
    return out.select(F.col("f.properties.name").alias("name"), F.size("f.properties.entries").cast("long").alias("n"), F.col("f.geometry.coordinates")[0].alias("lon"))


@register("SELECT n_nationkey AS k, (n_nationkey * 2.0)::DOUBLE AS lon, n_nationkey::DOUBLE AS lat FROM nation")
def wkt_points(spark, sf_dir):
    """Coordinates of well-known texts."""
    k = F.col("n_nationkey").cast("double")
    p = events.point(F.concat(F.lit("POINT("), (k * 2).cast("string"), F.lit(" "), k.cast("string"), F.lit(")")))
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), p["lon"].alias("lon"), p["lat"].alias("lat"))


# --- sinks read back ----------------------------------------------------------------------
_NATIONS = "SELECT 'http://example.org/nation/' || n_nationkey AS s, 'http://example.org/name' AS p, n_name AS o FROM nation UNION ALL SELECT 'http://example.org/nation/' || n_nationkey, 'http://example.org/region', 'http://example.org/region/' || n_regionkey FROM nation UNION ALL SELECT 'http://example.org/nation/' || n_nationkey, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type', 'http://example.org/Nation' FROM nation"


@register(_NATIONS)
def turtle_round_trip(spark, sf_dir):
    """Canonical Turtle of a small graph, parsed again."""
    path = folder(spark, "turtle")
    formats.write_turtle(graph(spark, sf_dir, "nation").scan(), path, PREFIXES, files=4)
    return readers.read_turtle(spark, path).select("s", "p", "o")


@register(_NATIONS)
def ntriples_round_trip(spark, sf_dir):
    path = folder(spark, "ntriples")
    sinks.ntriples(graph(spark, sf_dir, "nation").scan()).write.text(path)
    return readers.read_ntriples(spark, path).select("s", "p", "o")


@register("SELECT 'http://example.org/customer/' || c_custkey AS s, c_name AS name, 'http://example.org/nation/' || c_nationkey AS nation FROM customer")
def jsonld_nodes(spark, sf_dir):
    """JSON-LD nodes, read back."""
    out = sinks.jsonld(graph(spark, sf_dir, "customer").scan())
    get = lambda path: F.get_json_object("node", path)
    return out.select("s", get(f"$['{BASE}name'][0]['@value']").alias("name"), get(f"$['{BASE}nation'][0]['@id']").alias("nation"))


@register("SELECT r_regionkey AS k, r_name AS name, string_agg(n_name, '|' ORDER BY n_nationkey) AS nations FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1, 2")
def yaml_round_trip(spark, sf_dir):
    """A YAML document for each region, read under a schema."""
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    lists = n.groupBy("n_regionkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"]).alias("nations"))
    rows = r.join(lists, r["r_regionkey"] == lists["n_regionkey"])
    path = folder(spark, "yaml")
    text = F.udf(lambda k, name, nations: sinks.yaml_text({"k": k, "name": name, "nations": list(nations)}), "string")
    rows.select(F.col("r_regionkey").alias("part"), text("r_regionkey", "r_name", "nations").alias("value")).repartition("part").write.partitionBy("part").text(path)
    return readers.read_yaml(spark, f"{path}/part=*", "k long, name string, nations array<string>").select("k", "name", F.array_join("nations", "|").alias("nations"))


@register("SELECT r_regionkey AS k, r_name AS name FROM region")
def json_round_trip(spark, sf_dir):
    """Canonical JSON documents, read under a schema."""
    path = folder(spark, "json")
    text = F.udf(lambda k, name: sinks.canonical_json({"name": name, "k": k}), "string")
    table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("part"), text("r_regionkey", "r_name").alias("value")).repartition("part").write.partitionBy("part").text(path)
    return readers.read_json(spark, f"{path}/part=*", "k long, name string").select("k", "name")


@register("SELECT n_nationkey::VARCHAR AS resource, count(*) * 3 AS n FROM nation GROUP BY 1")
def subgraph_files(spark, sf_dir):
    """The triples of each resource, written in a folder of its own and counted there."""
    path = folder(spark, "subgraphs")
    t = graph(spark, sf_dir, "nation").scan().withColumn("s", F.substring_index("s", "/", -1))
    sinks.write_subgraphs(t, path)
    return spark.read.option("basePath", path).text(path).groupBy(F.col("resource").cast("string").alias("resource")).agg(F.count("*").alias("n"))


@register("SELECT '10.1/' || p_partkey AS doi, 'article' AS kind, p_name AS title FROM part WHERE p_size > 25")
def bibtex_blocks(spark, sf_dir):
    """BibTeX written and scanned again."""
    blocks = cite.bibtex(entries_of(spark, sf_dir), "J", "1").select(F.col("bibtex").alias("value"))
    return readers.bibtex_blocks(blocks).select(F.replace("doi", F.lit("\\"), F.lit("")).alias("doi"), F.col("type").alias("kind"), F.replace(F.col("fields")["title"], F.lit("\\"), F.lit("")).alias("title"))


# --- a graph of records -------------------------------------------------------------------
def people_graph(spark: SparkSession, sf_dir: str) -> triples.Graph:
    """Customers as persons and nations as places, by the builders."""
    b = builders.Builder(builders.Site(BASE, BASE + "pages/", "The Journal", "society", ("own", BASE + "ontology#")))
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    people = c.select(node("person", "c_custkey").alias("iri"), F.col("c_name").alias("family"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("").alias("given"), F.when(F.col("c_custkey") % 3 == 0, s("c_custkey")).alias("orcid"))
    places = n.select(s("n_nationkey").alias("key"), F.col("n_name").alias("label"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("wikidata"), F.lit(None).cast("string").alias("country"), F.when(F.col("n_nationkey") > 0, F.col("n_nationkey") * 1.0).alias("lat"), F.when(F.col("n_nationkey") > 0, F.col("n_nationkey") * 2.0).alias("lon"))
    return triples.Graph([*b.people(people), *b.places(places)])


_P = builders.PREFIXES


@register("SELECT CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment || ' ' ELSE '' END || c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 'https://orcid.org/' || c_custkey END AS orcid FROM customer")
def person_nodes(spark, sf_dir):
    return sparql.query(people_graph(spark, sf_dir), "SELECT ?name ?orcid WHERE { ?p a foaf:Person ; foaf:name ?name OPTIONAL { ?p owl:sameAs ?orcid } }", _P)


@register("SELECT n_name AS label, 'POINT(' || (n_nationkey * 2.0)::DOUBLE || ' ' || (n_nationkey * 1.0)::DOUBLE || ')' AS wkt FROM nation WHERE n_nationkey > 0")
def place_nodes(spark, sf_dir):
    return sparql.query(people_graph(spark, sf_dir), "SELECT ?label ?wkt WHERE { ?p a schema:Place ; rdfs:label ?label ; geo:hasGeometry/geo:asWKT ?wkt }", _P)


@register("SELECT 'http://example.org/person/' || c_custkey AS owner, c_custkey::VARCHAR AS value FROM customer WHERE c_custkey % 3 = 0")
def identifier_nodes(spark, sf_dir):
    return sparql.query(people_graph(spark, sf_dir), "SELECT ?owner ?value WHERE { ?owner crm:P1_is_identified_by ?i . ?i a crm:E42_Identifier ; crm:P190_has_symbolic_content ?value }", _P)


@register("SELECT 'http://example.org/event/' || o_orderkey AS e, strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00' AS b, strftime(o_orderdate, '%Y') || '-12-31T23:59:59' AS f FROM orders")
def time_span_nodes(spark, sf_dir):
    """Time-spans from a day to the end of its year."""
    b = builders.Builder(builders.Site(BASE, BASE, "J", "s", ("own", BASE)))
    o = table(spark, sf_dir, "orders")
    g = triples.Graph(b.time_span(o, node("event", "o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "yyyy")))
    return sparql.query(g, "SELECT ?e ?b ?f WHERE { ?e crm:P4_has_time-span ?t . ?t crm:P82a_begin_of_the_begin ?b ; crm:P82b_end_of_the_end ?f }", _P)


@register("SELECT 'http://example.org/type/' || lower(maker) AS c, maker AS label FROM (SELECT DISTINCT regexp_replace(p_type, '[^A-Za-z0-9]', '', 'g') AS maker FROM part)")
def concept_nodes(spark, sf_dir):
    """A concept scheme of the makers."""
    b = builders.Builder(builders.Site(BASE, BASE, "J", "s", ("own", BASE)))
    name = F.regexp_replace("p_type", "[^A-Za-z0-9]", "")
    none = F.lit(None).cast("string")
    types = table(spark, sf_dir, "part").select(F.lower(name).alias("slug"), name.alias("n")).distinct().select("slug", F.create_map(F.lit("en"), F.col("n")).alias("label"), none.alias("fabio"), none.alias("coar"), none.alias("match"), none.alias("broader"))
    return sparql.query(triples.Graph(b.types(types)), "SELECT ?c ?label WHERE { ?c a skos:Concept ; skos:prefLabel ?label ; skos:topConceptOf ?s FILTER(LANG(?label) = 'en') }", _P)
