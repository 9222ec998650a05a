"""A journal's build, as steps for plans.steps: merge, cite, graph, validate, search, map.

content/: vol*.yaml, journal.yaml, places.yaml, types.yaml, queries.yaml (optional), shapes/*.ttl (optional)
raw/: archive/*.json (the file's name is the id that was asked for), items/*.json
out/: merged/ (Parquet, a table each), journal.bib, .ris, .csl.json, schema.json, graph.ttl, crm.ttl, types.ttl, report.md, validation.md, search.json, events.geojson

The tables are Spark's; products that must be byte-stable are small texts, written by the driver
if their bytes change.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from .. import schema
from ..operators import builders, checks, cite, events, facets, shacl, shapes
from ..operators.merge import Merged, merge
from ..sources import readers, sinks
from ..sources.turtle import turtle
from . import corpus, sparql
from .steps import Step

JOURNAL = "iri string, title string, description map<string,string>, issn string, wikidata string, licence string, languages array<string>, publisher string, editor struct<family:string,given:string,orcid:string>, modified string"
PLACES = "places array<struct<key:string,label:string,wikidata:string,coordinates:struct<lat:double,lon:double>>>"
CONCEPTS = "concepts array<struct<slug:string,label:map<string,string>,aliases:array<string>,zenodo:array<string>,coar:string,fabio:string,match:string,broader:string>>"
TABLES = ["volumes", "issues", "entries", "people", "places", "types", "notes"]


def volume_schema() -> str:
    issue = StructType.fromDDL("issue int, sigil string, special boolean, title struct<en:string,de:string>, wikidata string").add("entries", ArrayType(StructType.fromDDL(schema.ENTRY)))
    whole = StructType.fromDDL("volume int, year int, coverage string, wikidata string").add("issues", ArrayType(issue))
    return whole.simpleString()


@dataclass
class Journal:
    spark: SparkSession
    content: Path
    raw: Path
    out: Path
    site: builders.Site
    countries: dict[str, str]
    home: str = ""
    strict: bool = False

    # inputs
    def yaml(self, name: str, ddl: str) -> DataFrame:
        return readers.read_yaml(self.spark, str(self.content / name), ddl)

    def json(self, folder: str, ddl: str, key: str | None = None) -> DataFrame:
        if not list((self.raw / folder).glob("*.json")):
            return self.spark.createDataFrame([], ddl + (f", {key} string" if key else ""))
        return readers.read_json(self.spark, str(self.raw / folder), ddl, key)

    def journals(self) -> DataFrame:
        return self.yaml("journal.yaml", JOURNAL).drop("path")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(str(self.out / "merged" / name))

    def merged(self) -> Merged:
        return Merged(*(self.table(n) for n in TABLES))

    def published(self) -> DataFrame:
        return self.table("entries").where("NOT draft")

    def graph(self) -> builders.Graph:
        m = self.merged()
        return builders.graph(self.site, self.journals(), m.volumes, m.issues, m.entries, m.types, self.journals().first().iri)

    def written(self, products: dict[str, str]) -> list[Path]:
        for name, text in products.items():
            sinks.write_if_changed(self.out / name, text.encode())
        return [self.out / name for name in products]

    # steps
    def merge(self) -> list[Path]:
        volumes = self.yaml("vol*.yaml", volume_schema()).drop("path")
        places = self.yaml("places.yaml", PLACES).select(F.explode("places").alias("x")).select("x.*")
        types = self.yaml("types.yaml", CONCEPTS).select(F.explode("concepts").alias("x")).select("x.*")
        m = merge(volumes, self.json("archive", schema.RECORD, "key"), places, self.json("items", schema.PLACE_ITEM), types, self.site.base, self.countries, self.home)
        checks.gate(m.notes.where("kind = 'unknown-type'"), self.strict, "unknown types")
        for name in TABLES:
            getattr(m, name).write.mode("overwrite").parquet(str(self.out / "merged" / name))
        report = sinks.report("Merge", {"Notes by kind": m.notes.groupBy("kind").agg(F.count("*").alias("n")).orderBy("kind"), "Notes": m.notes.orderBy("kind", "where", "text")})
        return [*sorted((self.out / "merged").rglob("*.parquet")), *self.written({"report.md": report})]

    def citable(self) -> DataFrame:
        label = self.table("types").select(F.col("slug").alias("type"), F.coalesce(F.try_element_at("label", F.lit("en")), "slug").alias("genre"))
        return self.published().withColumn("type", F.element_at("types", 1)).join(F.broadcast(label), "type", "left").withColumn("genre", F.coalesce("genre", "type"))

    def cite(self) -> list[Path]:
        j, e = self.journals().first(), self.citable()
        order = ["volume", "issue", "n"]

        def joined(made: DataFrame, column: str) -> str:
            """The journal's texts in order; of issues and volumes they are parts of it."""
            rows = made.join(e.select("id", *order), "id").orderBy(*order)
            return "\n".join(r[column] for r in rows.select(column).toLocalIterator())

        listed = lambda made, column: "[" + ",\n".join(r[column] for r in made.join(e.select("id", *order), "id").orderBy(*order).select(column).toLocalIterator()) + "]\n"
        return self.written({"journal.bib": joined(cite.bibtex(e, j.title, j.issn), "bibtex"), "journal.ris": joined(cite.ris(e, j.title, j.issn), "ris"), "journal.csl.json": listed(cite.csl(e, j.title, j.issn), "csl"), "schema.json": listed(cite.schema_org(e, j.title, j.issn, j.iri), "node")})

    def triples(self) -> list[Path]:
        g, prefixes = self.graph(), self.site.prefixes()
        return self.written({f"{name}.ttl": sinks.canonical_turtle(g.scan(graph=graph), prefixes) for name, graph in (("graph", builders.MAIN), ("crm", builders.CRM), ("types", builders.TYPES))})

    def stored_graph(self) -> DataFrame:
        """The graph as it was written, all of its files as one."""
        parts = [readers.read_turtle(self.spark, str(self.out / f"{name}.ttl")) for name in ("graph", "crm", "types")]
        return parts[0].unionByName(parts[1]).unionByName(parts[2]).drop("graph").distinct()

    def validate(self) -> list[Path]:
        """Every shape file on the written graph; violations stop a strict run, warnings never do."""
        data, tables = self.stored_graph().persist(), {}
        for path in sorted((self.content / "shapes").glob("*.ttl")):
            loaded = shapes.shapes(turtle(path.read_text()))
            if not loaded.shapes:
                continue
            found = shacl.Validator(data, self.site.prefixes() | loaded.prefixes).validate(loaded.shapes)
            tables[path.stem] = shacl.grouped(found).orderBy("severity", "path", "message")
            checks.gate(found.where("severity = 'Violation'"), self.strict, f"violations of {path.name}")
        out = self.written({"validation.md": sinks.report("Validation", tables)})
        data.unpersist()
        return out

    def search(self) -> list[Path]:
        e = self.published()
        names = lambda *roles: F.array_distinct(F.concat(*[F.transform(r, lambda p: p["iri"]) for r in roles]))
        values = {
            "type": F.col("types"), "year": F.array(F.col("year").cast("string")), "volume": F.array(F.col("volume").cast("string")), "person": names("creators", "editors", "contributors"), "language": F.array("language"), "event": F.array("event.name"), "keyword": F.coalesce("keywords", F.array().cast("array<string>")),
        }
        said = [F.col("title"), F.col("citation_label"), F.array_join(F.transform("creators", lambda p: p["name"]), " "), F.coalesce("event.name", F.lit("")), F.coalesce("abstract", F.lit("")), F.array_join(F.coalesce("keywords", F.array().cast("array<string>")), " ")]
        made = facets.index(e, "id", values, said)
        shown = e.select("id", "path", F.col("citation_label").alias("label"), "title", F.array("volume", "issue", "n").alias("sort"), F.transform("creators", lambda p: p["name"]).alias("authors"), "date")
        rows = shown.join(made, "id").orderBy("sort")
        out = self.written({"search.json": facets.files(rows, list(values))})
        self.check_counts(made)
        return out

    def check_counts(self, made: DataFrame) -> None:
        """The queries of the content must have rows and agree with the facets."""
        path = self.content / "queries.yaml"
        if path.is_file():
            config = readers.plain_yaml(path.read_text())
            prefixes, queries = corpus.load(config)
            corpus.gate(self.stored_graph().persist(), self.site.prefixes() | prefixes, queries, facets.counts(made))

    def map(self) -> list[Path]:
        """Events with a place as features; published entries of such events must all be there."""
        text = """SELECT ?event ?name ?start ?end ?place ?place_label ?wkt ?entry ?label ?title ?issued ?volume ?issue ?n WHERE {
            ?entry a bibo:Document ; bibo:presentedAt ?event ; own:citationLabel ?label ; dct:title ?title ; dct:issued ?issued ; prism:volume ?volume ; prism:number ?issue ; own:entryNumber ?n .
            ?event rdfs:label ?name ; schema:location ?place OPTIONAL { ?event schema:startDate ?start } OPTIONAL { ?event schema:endDate ?end }
            ?place rdfs:label ?place_label ; geo:hasGeometry/geo:asWKT ?wkt }"""
        own = self.site.prefixes()[self.site.own[0]]
        rows = sparql.query(self.stored_graph(), text, self.site.prefixes() | {"own": own}, as_strings=True)
        at = events.point(F.col("wkt"))
        rows = rows.select("*", at["lon"].alias("lon"), at["lat"].alias("lat")).withColumns({x: F.col(x).cast("int") for x in ("volume", "issue", "n")})
        expected = self.published().where(F.col("event.place.lat").isNotNull()).select(F.col("iri").alias("entry"))
        checks.gate(checks.missing(expected, rows.select("entry"), ["entry"]), True, "entries missing on the map")
        return self.written({"events.geojson": sinks.feature_collection(events.features(rows))})

    def steps(self) -> list[Step]:
        """The build, in order; each is skipped while its inputs and outputs are as they were."""
        content, raw = sorted(self.content.rglob("*.*")), sorted(self.raw.rglob("*.json"))
        package = sorted(Path(__file__).resolve().parent.parent.glob("[fops]*/*.py"))
        merged = lambda: sorted((self.out / "merged").rglob("*.parquet"))
        graph = [self.out / f"{n}.ttl" for n in ("graph", "crm", "types")]
        step: Callable[..., Step] = lambda run, inputs: Step(run.__name__, run, inputs, package)
        return [step(self.merge, [*content, *raw]), *(step(f, [*content, *raw, *merged()]) for f in (self.cite, self.triples)), *(step(f, [*content, *raw, *(p for p in graph if p.is_file())]) for f in (self.validate, self.search, self.map))]
