"""Old texts to volumes: parsed entries and publication lines become the documents that the merge reads.

entries: readers.volume_lines -> readers.entries_of -> records.entries, with `volume`
issues: volume, issue, line (of the header), title
publications: id, doi, title, kind, year, language, creators, event (name, start, end, date_text, location, online); types: kind -> type label
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.shared import stored
from . import checks, resolve

PERSONS = "array<struct<name:string,orcid:string>>"
KEY_LENGTH = 48


@dataclass
class Migrated:
    #: volume, issues (issue, sigil, special, title, wikidata, entries)
    volumes: DataFrame
    #: key, label, wikidata, entries
    places: DataFrame
    notes: DataFrame


def note(df: DataFrame, where: Column, kind: str, text: Column) -> DataFrame:
    return df.select(where.cast("string").alias("where"), F.lit(kind).alias("kind"), text.cast("string").alias("text"))


def with_names(entries: DataFrame) -> DataFrame:
    """Creators that have an identifier only get its most frequent name."""
    rows = entries.select("key", F.posexplode_outer("creators").alias("pos", "p")).where("pos IS NOT NULL").select(F.col("key").alias("id"), "pos", "p.name", "p.orcid")
    named = resolve.named_by_identifier(rows).groupBy(F.col("id").alias("key")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "name", "orcid"))), lambda x: F.struct(x["name"], x["orcid"])).alias("named"))
    return entries.join(named, "key", "left").withColumn("creators", F.coalesce(F.col("named").cast(PERSONS), F.array().cast(PERSONS))).drop("named")


def with_sigils(issues: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """issues with the sigil that most of their entries have, an empty one with that of the issue before it; and notes of mixed ones."""
    usual = checks.mode_first_seen(entries, ["volume", "issue"], "sigil", "line").select("volume", "issue", F.col("sigil").alias("own"))
    mixed = entries.groupBy("volume", "issue").agg(F.sort_array(F.collect_set("sigil")).alias("s")).where(F.size("s") > 1)
    filled = checks.forward_fill(issues.join(usual, ["volume", "issue"], "left"), ["volume"], "line", "own", "sigil")
    return filled.withColumn("sigil", F.coalesce("sigil", F.lit("#"))).drop("own"), note(mixed, F.concat_ws(" ", "volume", "issue"), "mixed-sigils", F.array_join("s", ", "))


def place_key(location: Column) -> Column:
    return T.cut_slug(T.slug(location), KEY_LENGTH)


def migrate(entries: DataFrame, issues: DataFrame, blocks: DataFrame, publications: DataFrame, identifiers: DataFrame, kinds: dict[str, str], issue_of_year: dict[int, int], known_places: DataFrame, volume: int = 1) -> Migrated:
    """The volumes, places and notes. Publications up to the first volume's years enrich an entry of `volume` that they match or become new ones there."""
    c = F.col
    spark = entries.sparkSession
    notes: list[DataFrame] = []
    e = with_names(entries.withColumn("key", F.concat_ws("-", "volume", "issue", "line")))
    issues, mixed = with_sigils(issues, e)
    notes.append(mixed)
    e = e.drop("sigil").join(issues.select("volume", "issue", "sigil"), ["volume", "issue"])
    at = F.concat("volume", F.lit("("), "issue", F.lit(") "), "sigil", "n")
    e = stored(e.withColumn("where", at), "migrated")
    notes.append(note(checks.duplicates(e.withColumnRenamed("n", "number"), ["volume", "issue", "number"]), F.concat_ws(" ", "volume", "issue"), "duplicate-number", c("number")))
    notes.append(note(checks.duplicates(issues, ["volume", "issue"]), c("volume"), "duplicate-issue", c("issue")))
    repeated = e.where("doi IS NOT NULL").groupBy("doi").agg(F.sort_array(F.collect_list("where")).alias("at")).where(F.size("at") > 1)
    notes.append(note(repeated, c("doi"), "doi-repeated", F.array_join("at", ", ")))
    # containers of proceedings
    from ..sources.records import with_containers

    e, unmatched, odd = with_containers(e, blocks, c("where"))
    notes += [note(unmatched, c("doi"), "bibtex-unmatched", F.lit("no entry")), note(odd, c("doi"), "bibtex-pages", F.concat_ws(" for ", "pages", "label"))]
    e = stored(e, "contained")
    # publications: each once, by DOI or title, then against the entries
    order = F.struct(F.coalesce("event.start", F.lit("")), "title", "id")
    same = F.coalesce(F.lower("doi"), T.norm(c("title")))
    first = publications.withColumn("same", same).withColumn("rank", F.row_number().over(Window.partitionBy("same").orderBy(order))).where("rank = 1").drop("same", "rank")
    found = stored(resolve.match_publications(first, e.select("key", "doi", "title", "volume"), volume), "matches")
    p = first.join(found, "id").join(e.select("key", F.col("volume").alias("v"), F.col("doi").alias("e_doi"), F.col("where").alias("e_where")), "key", "left")
    notes.append(note(p.where("how = 'rejected'"), c("id"), "doi-shared-different-title", c("doi")))
    notes.append(note(p.where(c("v") != volume), c("id"), "publication-elsewhere", c("e_where")))
    type_of = F.try_element_at(F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv]), c("kind"))
    other_doi = (c("how") == "title") & c("doi").isNotNull() & ~c("doi").eqNullSafe(c("e_doi"))
    more = p.where(c("v") == volume).groupBy("key").agg(F.collect_set(type_of).alias("p_types"), F.collect_set(F.when(other_doi, c("doi"))).alias("p_dois"), F.min_by("language", "id").alias("p_language"), F.min_by("event", "id").alias("p_event"))
    fields = ["name", "start", "end", "date_text", "session", "location", "online"]
    event = F.struct(*[F.coalesce(c(f"event.{x}"), c(f"p_event.{x}") if x != "session" else F.lit(None).cast("string")).alias(x) for x in fields])
    empty = F.array().cast("array<string>")
    rich = e.join(more, "key", "left").withColumn("types", F.array_union(F.coalesce("labels", empty), F.coalesce("p_types", empty))).withColumn("related_dois", F.array_union(F.coalesce("related_dois", empty), F.coalesce("p_dois", empty))).withColumn("language", F.coalesce("language", "p_language")).withColumn("event", event)
    # what matched nothing is new: the next numbers of its year's issue
    year = F.create_map(*[F.lit(x) for kv in issue_of_year.items() for x in kv]) if issue_of_year else F.create_map().cast("map<int,int>")
    new = p.where("how IS NULL OR how = 'rejected'").withColumn("target", F.try_element_at(year, c("year")))
    notes.append(note(new.where("target IS NULL"), c("id"), "publication-without-issue", c("year")))
    base = rich.where(c("volume") == volume).groupBy("issue").agg(F.max("n").alias("most"))
    own = issues.where(c("volume") == volume).select("issue", "sigil")
    numbered = new.where("target IS NOT NULL").withColumnRenamed("target", "issue").join(own, "issue").join(base, "issue", "left").withColumn("n", (F.coalesce("most", F.lit(0)) + F.row_number().over(Window.partitionBy("issue").orderBy(order))).cast("int"))
    wide = F.struct(*[(c(f"event.{x}") if x != "session" else F.lit(None).cast("string")).alias(x) for x in fields])
    columns = ["volume", "issue", "n", "types", "title", "creators", "et_al", "doi", "related_dois", "language", "date", "version", "release_label", "event", "editors", "contributors", "container", "wikidata", "isbn", "links", "context", "notes", "legacy_citation", "draft", "from"]
    rich = rich.withColumn("from", F.concat_ws(":", "source", c("line").cast("string"))).select(*columns)
    made = numbered.select(F.lit(volume).alias("volume"), "issue", "n", F.array(type_of).alias("types"), "title", c("creators").cast(PERSONS).alias("creators"), "doi", "language", wide.alias("event"), c("doi").isNull().alias("draft"), c("id").cast("string").alias("from"))
    every = stored(rich.unionByName(made, allowMissingColumns=True), "entries")
    # places of events that aren't online
    held = c("event.location").isNotNull() & ~F.coalesce("event.online", F.lit(False))
    every = every.withColumn("place", F.when(held, place_key(c("event.location"))))
    places = every.where("place IS NOT NULL").groupBy(c("place").alias("key")).agg(F.min_by("event.location", F.struct("volume", "issue", "n")).alias("label"), F.count("*").alias("entries"))
    places = places.join(known_places.select("key", "wikidata"), "key", "left").select("key", "label", "wikidata", "entries").orderBy("key")
    full = F.struct(*[c(f"event.{x}").alias(x) for x in fields[:6]], c("place").alias("place"), c("event.online").alias("online"))
    every = every.withColumn("event", F.when(c("event.name").isNotNull(), full)).drop("place")
    item = F.struct(*[x for x in columns if x not in ("volume", "issue")])
    grouped = every.groupBy("volume", "issue").agg(F.array_sort(F.collect_list(item), lambda a, b: a["n"] - b["n"]).alias("entries"))
    names = identifiers.where("issue IS NOT NULL").select("volume", "issue", F.col("item").alias("wikidata"))
    i = issues.join(grouped, ["volume", "issue"], "left").join(names, ["volume", "issue"], "left")
    notes.append(note(i.where("entries IS NULL"), F.concat_ws(" ", "volume", "issue"), "empty-issue", F.lit("no entries")))
    titled = F.when(c("title").isNotNull(), F.struct(c("title").alias("en"), F.lit(None).cast("string").alias("de")))
    parts = F.struct("issue", "sigil", c("title").isNotNull().alias("special"), titled.alias("title"), "wikidata", "entries")
    volumes = i.groupBy("volume").agg(F.array_sort(F.collect_list(parts), lambda a, b: a["issue"] - b["issue"]).alias("issues"))
    volumes = volumes.join(identifiers.where("issue IS NULL").select("volume", F.col("item").alias("wikidata")), "volume", "left")
    out = notes[0]
    for x in notes[1:]:
        out = out.unionByName(x)
    return Migrated(volumes, places, out.distinct() if notes else spark.createDataFrame([], "where string, kind string, text string"))


def lost_dois(texts: DataFrame, migrated: Migrated, rejected: DataFrame | None = None) -> DataFrame:
    """(doi): archive DOIs of the old texts (value) that no entry has, found without the parser."""
    old = texts.select(F.explode(F.regexp_extract_all(F.replace("value", F.lit("zenodo.."), F.lit("zenodo.")), F.lit(r"(10\.5281/zenodo\.[0-9]+)"), 1)).alias("doi")).distinct()
    entry = migrated.volumes.select(F.explode("issues").alias("i")).select(F.explode("i.entries").alias("e"))
    new = entry.select("e.doi").union(entry.select(F.explode("e.related_dois"))).where("doi IS NOT NULL")
    return checks.lost(old, new, rejected)


def published(lines: DataFrame, kind: str) -> DataFrame:
    """readers.publication_lines() as publications. What follows the title is, between commas, the event's name ("with ..." before it goes), its place in two parts and its date; less than three parts are no event."""
    parts = F.filter(F.transform(F.split("tail", ","), lambda x: F.trim(x)), lambda x: x != "")
    n = F.size(parts)
    there = n >= 3
    dates = T.event_dates(F.try_element_at(parts, F.lit(-1)))
    before = F.slice(parts, 1, F.greatest(n - 3, F.lit(0)))
    named = F.when(F.startswith(F.lower(F.try_element_at(before, F.lit(1))), F.lit("with ")), F.slice(before, 2, F.size(before))).otherwise(before)
    name, location = F.array_join(named, ", "), F.concat_ws(", ", F.try_element_at(parts, F.lit(-3)), F.try_element_at(parts, F.lit(-2)))
    text = F.when(dates["start"].isNull(), F.try_element_at(parts, F.lit(-1)))
    event = F.when(there, F.struct(name.alias("name"), dates["start"].alias("start"), dates["end"].alias("end"), text.alias("date_text"), location.alias("location"), (T.is_online(location) | T.is_online(name)).alias("online")))
    return lines.select(F.concat_ws(":", "source", F.col("line").cast("string")).alias("id"), T.doi(F.col("doi_text")).alias("doi"), "title", F.lit(kind).alias("kind"), "year", "language", T.split_people(F.col("authors"))["people"].alias("creators"), event.alias("event"))
