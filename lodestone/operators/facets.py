"""Faceted and full-text search."""

from __future__ import annotations

import json
import re
import unicodedata
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapse, fold


def index(records: DataFrame, key: str, facets: dict[str, Column], text: list[Column]) -> DataFrame:
    """(key, facets: map<string, array<string>>, text): facet values as sorted sets, the text folded."""
    values = [x for name, c in facets.items() for x in (F.lit(name), F.sort_array(F.array_distinct(F.array_compact(c))))]
    return records.select(key, F.create_map(*values).alias("facets"), collapse(fold(F.concat_ws(" ", *text))).alias("text"))


def typed_words(query: str) -> list[str]:
    """The folded words of what was typed."""
    bare = "".join(c for c in unicodedata.normalize("NFD", query) if not unicodedata.combining(c))
    return [w for w in re.split(r"\s+", bare.lower()) if w]


def matches_text(text: Column, query: str) -> Column:
    """Every typed word is a substring."""
    out = F.lit(True)
    for word in typed_words(query):
        out = out & F.contains(text, F.lit(word))
    return out


def matches_facets(facets: Column, chosen: dict[str, list[str]], skip: str | None = None) -> Column:
    """OR inside a facet, AND across facets; `skip` is left out."""
    out = F.lit(True)
    for name, values in chosen.items():
        if values and name != skip:
            out = out & F.coalesce(F.arrays_overlap(F.element_at(facets, name), F.array(*map(F.lit, values))), F.lit(False))
    return out


def search(indexed: DataFrame, query: str = "", chosen: dict[str, list[str]] | None = None) -> DataFrame:
    return indexed.where(matches_text(F.col("text"), query) & matches_facets(F.col("facets"), chosen or {}))


def counts(indexed: DataFrame, query: str = "", chosen: dict[str, list[str]] | None = None) -> DataFrame:
    """(facet, value, n): each facet counted without its own choice; chosen values stay at zero.

    One scan and one shuffle: a record says for each facet whether it passes the others.
    """
    chosen = chosen or {}
    hit = indexed.where(matches_text(F.col("text"), query))
    names = F.map_keys("facets")
    passes = F.create_map(*[x for name in chosen for x in (F.lit(name), matches_facets(F.col("facets"), chosen, name))]) if chosen else F.create_map().cast("map<string,boolean>")
    whole = matches_facets(F.col("facets"), chosen)
    rows = hit.select("facets", passes.alias("passes"), whole.alias("whole"), F.explode(names).alias("facet")).where(F.coalesce(F.try_element_at("passes", F.col("facet")), F.col("whole")))
    out = rows.select("facet", F.explode(F.element_at("facets", F.col("facet"))).alias("value")).groupBy("facet", "value").agg(F.count("*").alias("n"))
    kept = [(f, v, 0) for f, values in chosen.items() for v in values]
    if kept:
        zero = indexed.sparkSession.createDataFrame(kept, "facet string, value string, n long")
        out = out.unionByName(zero).groupBy("facet", "value").agg(F.sum("n").alias("n"))
    return out


#: Values of a facet that are shown before the others are asked for.
SHOWN = 8


def shown(counted: DataFrame, facet: str, chosen: list[str] | None = None, most: int = SHOWN) -> DataFrame:
    """The first values of a facet in their order (as many as are chosen, if those are more), and every chosen one."""
    chosen = chosen or []
    rows = counted.where(F.col("facet") == facet)
    place = F.row_number().over(Window.partitionBy("facet").orderBy(*_order(facet)))
    return rows.withColumn("place", place).where((F.col("place") <= max(most, len(chosen))) | F.col("value").isin(chosen)).orderBy("place")


def to_hash(query: str, chosen: dict[str, list[str]], facets: list[str]) -> str:
    """The state of a search as the fragment of an address: "q=...", then each facet's choices."""
    parts = ([f"q={quote(query, safe=SAFE)}"] if query else []) + [f"{f}={','.join(quote(v, safe=SAFE) for v in chosen[f])}" for f in facets if chosen.get(f)]
    return "&".join(parts)


def from_hash(fragment: str, facets: list[str]) -> tuple[str, dict[str, list[str]]]:
    """(query, choices) of a fragment; unknown names are left out."""
    query, chosen = "", {}
    for part in fragment.removeprefix("#").split("&"):
        name, _, value = part.partition("=")
        if name == "q":
            query = unquote(value)
        elif name in facets and value:
            chosen[name] = [unquote(v) for v in value.split(",")]
    return query, chosen


#: Characters that an address's component keeps beside letters and digits.
SAFE = "-_.!~*'()"


def files(indexed: DataFrame, facets: list[str], variable: str | None = None) -> str:
    """The index as one JSON text, or as a script that sets a variable: what a page searches in, so small."""
    rows = [json.loads(r.value) for r in indexed.select(F.to_json(F.struct("*")).alias("value")).toLocalIterator()]
    body = json.dumps({"facets": facets, "records": rows}, ensure_ascii=False, sort_keys=True)
    return f"window.{variable} = {body};\n" if variable else body + "\n"


def ordered(counted: DataFrame, facet: str, years: str = "year", volumes: str = "volume") -> DataFrame:
    """The values of a facet as they are shown: years and volumes falling, others by count, then label."""
    return counted.where(F.col("facet") == facet).orderBy(*_order(facet, years, volumes))


def _order(facet: str, years: str = "year", volumes: str = "volume") -> list[Column]:
    if facet in (years, volumes):
        return [F.col("value").try_cast("int").desc_nulls_last(), F.col("value")]
    return [F.col("n").desc(), F.collate("value", "UNICODE"), F.col("value")]
