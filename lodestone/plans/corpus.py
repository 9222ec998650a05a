"""A corpus of SPARQL queries: its configuration, the gates it must pass, its pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.checks import crosscheck
from . import sparql

#: Rows of a result that are shown; the total is told beside them.
SHOWN = 500


@dataclass
class Query:
    id: str
    title: dict[str, str]
    intro: dict[str, str]
    sparql: str
    #: facet whose counts the query's must equal, and the query's key and number columns
    check: tuple[str, str, str] | None = None


def load(config: dict, languages: tuple[str, ...] = ("en", "de")) -> tuple[dict[str, str], list[Query]]:
    """(prefixes, queries); anything missing, doubled or untranslated is an error."""
    for key in ("prefixes", "queries"):
        if key not in config:
            raise ValueError(f"the corpus has no {key}")
    out, seen = [], set()
    for q in config["queries"]:
        for key in ("id", "title", "intro", "sparql"):
            if key not in q:
                raise ValueError(f"query {q.get('id', '?')} has no {key}")
        for key in ("title", "intro"):
            if set(q[key]) != set(languages):
                raise ValueError(f"query {q['id']}: {key} must be in {', '.join(languages)}")
        if q["id"] in seen:
            raise ValueError(f"query {q['id']} is there twice")
        seen.add(q["id"])
        check = q.get("crosscheck")
        out.append(Query(q["id"], q["title"], q["intro"], q["sparql"], (check["facet"], check["key"], check["count"]) if check else None))
    return dict(config["prefixes"]), out


def gate(triples: DataFrame, prefixes: dict[str, str], queries: list[Query], facets: DataFrame | None = None) -> dict[str, int]:
    """Rows of each query; after all were tried, an error names those that failed, were empty or disagree with the facet counts."""
    rows, wrong = {}, []
    for q in queries:
        try:
            df = sparql.query(triples, q.sparql, prefixes)
            rows[q.id] = df.count()
            if not rows[q.id]:
                wrong.append(f"{q.id}: no rows")
            elif q.check and facets is not None:
                facet, key, count = q.check
                a = df.selectExpr(f"CAST(`{key}` AS STRING) AS key", f"CAST(`{count}` AS BIGINT) AS n")
                b = facets.where(facets["facet"] == facet).selectExpr("value AS key", "CAST(n AS BIGINT) AS n")
                for r in crosscheck(a, b).limit(5).collect():
                    wrong.append(f"{q.id}: {r.key} is {r.left_value} in the graph and {r.right_value} in the facets")
        except Exception as e:
            wrong.append(f"{q.id}: {str(e).splitlines()[0]}")
    if wrong:
        raise ValueError("; ".join(wrong))
    return rows


def page(df: DataFrame, shown: int = SHOWN) -> tuple[list, int]:
    """The first rows and the number of all."""
    return df.limit(shown).collect(), df.count()
