"""Queries that answer from indexes: facet bitmaps, positions of trigrams, grams of names, manifests.

Registered beside those of queries.py; where SQL can't express one, tests compare it with brute force.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import bitmaps, postings, titles
from .plans.shared import folder
from .queries import _FACETS, ORACLE_SQL, indexed, register, table
from .sources import manifest


# --- facets -----------------------------------------------------------------------------------
@register(ORACLE_SQL["facet_counts"])
def facet_counts_bitmaps(spark, sf_dir):
    """Facet value -> number of records, from bitmaps."""
    return bitmaps.counts(bitmaps.build(indexed(spark, sf_dir), "doc_id"))


@register(ORACLE_SQL["facet_skip"])
def facet_skip_bitmaps(spark, sf_dir):
    """Counts that leave out a facet's own choice, from bitmaps."""
    return bitmaps.counts(bitmaps.build(indexed(spark, sf_dir), "doc_id"), {"lang": ["en", "xx"], "source": ["src1", "src2"]})


# --- text -------------------------------------------------------------------------------------
@register(ORACLE_SQL["text_search"])
def text_search_index(spark, sf_dir):
    """Every typed word, accents folded, is a substring: from positions of trigrams."""
    path = folder(spark, "postings")
    postings.build(indexed(spark, sf_dir), "doc_id", "text", path)
    return postings.search(spark, path, "  Éllè ment", "doc_id")


_FOUND = "contains(strip_accents(lower(concat_ws(' ', text, source))), 'tion') AND contains(strip_accents(lower(concat_ws(' ', text, source))), 'e')"


@register(f"""WITH r AS (SELECT f.*, {_FOUND} AS found FROM ({_FACETS}) f JOIN documents USING (doc_id, source))
SELECT 'lang' AS facet, lang AS value, count(*) AS n FROM r WHERE found AND lang IS NOT NULL GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM r WHERE found AND lang = 'en' AND source IS NOT NULL GROUP BY 2
UNION ALL SELECT 'quality', quality, count(*) FROM r WHERE found AND lang = 'en' AND quality IS NOT NULL GROUP BY 2 UNION ALL SELECT 'toxic', toxic, count(*) FROM r WHERE found AND lang = 'en' AND toxic IS NOT NULL GROUP BY 2""")
def facet_hits_bitmaps(spark, sf_dir):
    """Facet counts of what a text search found, one language chosen: both from indexes."""
    records = indexed(spark, sf_dir)
    path = folder(spark, "postings")
    postings.build(records, "doc_id", "text", path)
    return bitmaps.counts(bitmaps.build(records, "doc_id"), {"lang": ["en"]}, postings.search(spark, path, "TION e", "doc_id"))


# --- names ------------------------------------------------------------------------------------
@register()
def similar_names(spark, sf_dir):
    """All pairs of unlike part names above 0.8, by the least keys of their classes."""
    return titles.similar(table(spark, sf_dir, "part"), "p_partkey", "p_name", 0.8)


@register()
def similar_questions(spark, sf_dir):
    """Turns of conversations that are nearly a benchmark item's text, 0.9 or more."""
    turns = table(spark, sf_dir, "conversations").select(F.concat_ws("/", "conv_id", "turn").alias("id"), "text")
    return titles.similar_to(turns, table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text"), 0.9)


@register("SELECT p_partkey, min(p_partkey) OVER (PARTITION BY p_name) AS id FROM part WHERE p_name IS NOT NULL")
def name_classes(spark, sf_dir):
    """The least key of the parts with the same name."""
    return titles.classes(table(spark, sf_dir, "part"), "p_partkey", "p_name")


# --- outputs ----------------------------------------------------------------------------------
_NATIONS = "SELECT n_regionkey::VARCHAR AS resource, n_nationkey, n_name FROM nation"


@register(f"""WITH a AS (SELECT resource, list(n_nationkey || n_name ORDER BY 1) AS l FROM ({_NATIONS}) WHERE resource != '4' GROUP BY 1),
b AS (SELECT resource, list(n_nationkey || CASE WHEN n_nationkey = 5 THEN 'X' ELSE n_name END ORDER BY 1) AS l FROM ({_NATIONS}) WHERE resource != '3' GROUP BY 1)
SELECT resource, CASE WHEN a.l IS NULL THEN 'new' WHEN b.l IS NULL THEN 'gone' WHEN a.l = b.l THEN 'same' ELSE 'changed' END AS state FROM a FULL JOIN b USING (resource)""")
def manifest_states(spark, sf_dir):
    """Nations by region, written twice: what the second run found new, changed, the same and gone."""
    path = folder(spark, "outputs")
    n = table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("resource"), "n_nationkey", "n_name")
    line = lambda name: F.concat(F.col("n_nationkey").cast("string"), name).alias("value")
    manifest.sync(n.where("resource != '4'").select("resource", line(F.col("n_name"))), path)
    return manifest.sync(n.where("resource != '3'").select("resource", line(F.when(F.col("n_nationkey") == 5, "X").otherwise(F.col("n_name")))), path)


@register("SELECT (o_custkey % 50)::VARCHAR AS resource, o_orderkey || ' ' || CASE WHEN o_orderkey % 50 = 7 AND o_custkey % 50 = 7 THEN 'new' ELSE o_orderstatus END AS value FROM orders WHERE o_custkey % 50 != 9")
def manifest_lines(spark, sf_dir):
    """Orders in fifty outputs, of which a second run changes one and drops one: what the folder then holds."""
    path = folder(spark, "outputs")
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).cast("string").alias("resource"), "o_orderkey", "o_orderstatus")
    line = lambda status: F.concat_ws(" ", F.col("o_orderkey").cast("string"), status).alias("value")
    manifest.sync(o.select("resource", line(F.col("o_orderstatus"))), path)
    changed = F.when((F.col("resource") == "7") & (F.col("o_orderkey") % 50 == 7), "new").otherwise(F.col("o_orderstatus"))
    manifest.sync(o.where("resource != '9'").select("resource", line(changed)), path)
    return manifest.lines(spark, path)
