"""The merge: hand-written volumes, archive records, places and types become one dataset.

Each rule is a column or a join; what a rule notices goes to a table of notes (where, kind,
text). Persons of all roles are one long table while they're resolved, so that nothing is
looked up entry by entry.

volumes: volume, year, coverage, wikidata, issues (issue, sigil, special, title, wikidata, entries (schema.ENTRY))
archive: key (the id that was asked for), id, conceptdoi, doi, files (key, size, checksum), metadata (schema.RECORD)
places: key, label, wikidata, coordinates; items: schema.PLACE_ITEM; types: schema.CONCEPT
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.shared import stored
from . import resolve

# Licences of the archive and their addresses (one that is open has none); languages by their longer codes.
LICENCES = {
    "cc-by-4.0": "https://creativecommons.org/licenses/by/4.0/",
    "cc-by": "https://creativecommons.org/licenses/by/4.0/",
    "cc-by-sa-4.0": "https://creativecommons.org/licenses/by-sa/4.0/",
    "cc-zero": "https://creativecommons.org/publicdomain/zero/1.0/",
    "cc0-1.0": "https://creativecommons.org/publicdomain/zero/1.0/",
    "mit-license": "https://spdx.org/licenses/MIT.html",
    "mit": "https://spdx.org/licenses/MIT.html",
    "gpl-2.0": "https://spdx.org/licenses/GPL-2.0-only.html",
    "gpl-3.0": "https://spdx.org/licenses/GPL-3.0-only.html",
    "apache-2.0": "https://spdx.org/licenses/Apache-2.0.html",
    "other-open": None,
}
SHORT_LANGUAGES = {"eng": "en", "deu": "de", "ger": "de", "fra": "fr", "ita": "it", "spa": "es", "enc": "en"}
# Kinds of state by which a country is told to exist today.
STATES, HISTORICAL = ["Q6256", "Q3624078"], ["Q3024240"]
ROLES = ["creators", "editors", "contributors"]
RECORDS = "https://zenodo.org/records/"
RECORDS_API = "https://zenodo.org/api/records/"


@dataclass
class Merged:
    volumes: DataFrame
    issues: DataFrame
    entries: DataFrame
    people: DataFrame
    places: DataFrame
    types: DataFrame
    notes: DataFrame


def _table(values: dict[str, str | None], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key)


def flat(volumes: DataFrame, base: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(volumes, issues, entries) with their ids, paths and IRIs."""
    c = F.col
    path = lambda *parts: F.concat_ws("/", *[F.concat(F.lit(p), x.cast("string")) for p, x in parts])
    v = volumes.withColumn("path", path(("v", c("volume")))).withColumn("iri", F.concat(F.lit(base), "path"))
    i = v.select("volume", "year", F.col("iri").alias("volume_iri"), F.explode("issues").alias("i")).select("volume", "year", "volume_iri", "i.*")
    i = i.withColumn("sigil", F.coalesce("sigil", F.lit("#"))).withColumn("special", F.coalesce("special", F.lit(False))).withColumn("path", path(("v", c("volume")), ("i", c("issue")))).withColumn("iri", F.concat(F.lit(base), "path"))
    e = i.select("volume", "issue", "year", "sigil", F.col("iri").alias("issue_iri"), F.explode("entries").alias("e"))
    e = e.select("volume", "issue", F.col("year").alias("volume_year"), "sigil", "issue_iri", "e.*").withColumn("path", T.entry_path(c("volume"), c("issue"), c("n")))
    e = e.withColumn("id", T.entry_id(c("volume"), c("issue"), c("n"))).withColumn("iri", F.concat(F.lit(base), "path")).withColumn("citation_label", T.citation_label(c("volume"), c("issue"), c("sigil"), c("n")))
    e = e.withColumn("where", F.concat("volume", F.lit("("), "issue", F.lit(") "), "sigil", "n")).withColumn("draft", F.coalesce("draft", F.lit(False)))
    return v.drop("issues"), i.drop("entries"), e


def located(places: DataFrame, items: DataFrame, countries: dict[str, str], home: str) -> DataFrame:
    """places -> (key, label, wikidata, name, country (wikidata), country_name, lat, lon).

    A country is one that the place belongs to now: a current claim, else a state that exists
    today, else any; of several the one that the label names, else the first in string order."""
    item = items.select(F.col("id").alias("wikidata"), "labels", F.col("coordinates").alias("found"), F.coalesce("country_current", F.array().cast("array<string>")).alias("current"), F.coalesce("country", F.array().cast("array<string>")).alias("any"))
    states = items.where(resolve.not_historical(F.coalesce("instance_of", F.array().cast("array<string>")), STATES, HISTORICAL)).select(F.col("id").alias("state"))
    p = places.join(item, "wikidata", "left")
    living = p.select("key", F.explode("any").alias("state")).join(states, "state").groupBy("key").agg(F.collect_set("state").alias("living"))
    p = p.join(living, "key", "left")
    choice = F.when(F.size("current") > 0, F.col("current")).when(F.size("living") > 0, F.col("living")).otherwise(F.col("any"))
    named = T.label_country(F.col("label"), countries, home)["country"]
    country = F.when(F.array_contains(choice, named), named).otherwise(F.array_min(choice))
    label = lambda m: F.coalesce(F.try_element_at(m, F.lit("en")), F.try_element_at(m, F.lit("de")))
    p = p.withColumn("country", country)
    c_items = items.select(F.col("id").alias("country"), F.try_element_at("labels", F.lit("en")).alias("c_label"))
    at = lambda x: F.round(F.coalesce(F.col(f"coordinates.{x}"), F.col(f"found.{x}")), 6)
    out = p.join(c_items, "country", "left")
    return out.select("key", "label", "wikidata", F.when(F.col("wikidata").isNotNull(), F.coalesce(label(F.col("labels")), "label")).alias("name"), "country", F.when(F.col("country").isNotNull(), F.coalesce("c_label", "country")).alias("country_name"), at("lat").alias("lat"), at("lon").alias("lon"))


def from_archive(archive: DataFrame) -> DataFrame:
    """Archive records as the fields that entries take from them."""
    c = F.col
    m = "metadata."
    files = F.transform(F.array_sort(F.coalesce("files", F.array().cast("array<struct<key:string,size:long,checksum:string>>"))), lambda f: F.struct(f["key"].alias("key"), f["size"].alias("size"), f["checksum"].alias("checksum"), F.concat(F.lit(RECORDS), c("id").cast("string"), F.lit("/files/"), T.quote_path(f["key"]), F.lit("?download=1")).alias("url")))
    pdf = F.try_element_at(F.filter(files, lambda f: F.endswith(F.lower(f["key"]), F.lit(".pdf"))), F.lit(1))
    record = c("id").cast("string")
    quoted = T.quote_path(pdf["key"])
    made = F.struct(
        pdf["key"].alias("key"), F.concat(F.lit(RECORDS), record, F.lit("/preview/"), quoted).alias("preview"), pdf["url"].alias("download"), F.concat(F.lit(RECORDS_API), record, F.lit("/files/"), quoted, F.lit("/content")).alias("content")
    )
    words = F.array_sort(F.array_distinct(c(m + "keywords")), lambda a, b: F.when(F.lower(a) < F.lower(b), -1).when(F.lower(a) > F.lower(b), 1).otherwise(F.when(a < b, -1).when(a > b, 1).otherwise(0)))
    licence = c(m + "license.id")
    described = T.clean_html(c(m + "description"))
    return archive.select(
        F.col("key").alias("record_id"), F.struct(record.alias("record"), F.concat(F.lit(RECORDS), record).alias("url"), F.col("conceptdoi").alias("concept_doi"), F.col("doi").alias("version_doi")).alias("zenodo"), F.when(F.size(files) > 0, files).alias("files"), F.when(pdf.isNotNull(), made).alias("pdf"),
        c(m + "version").alias("a_version"), F.when(F.size(words) > 0, words).alias("keywords"), F.when(licence.isNotNull(), F.struct(licence.alias("id"), _table(LICENCES, licence).alias("url"))).alias("licence"), described.alias("described"), c(m + "title").alias("a_title"),
        c(m + "language").alias("a_language"), c(m + "publication_date").alias("a_date"), c(m + "resource_type.type").alias("a_type"), c(m + "resource_type.subtype").alias("a_subtype"), c(m + "creators").alias("a_creators"),
    )


def persons(entries: DataFrame) -> DataFrame:
    """The persons of all roles, in order: (id, role, pos, name, orcid, archived).

    Without creators of its own an entry has those of its archive record; after an "et al." come
    those that the record has beyond them."""
    kind = "array<struct<name:string,orcid:string>>"
    bare = lambda role: F.transform(F.coalesce(F.col(role), F.array().cast(kind)), lambda p: F.struct(p["name"].alias("name"), p["orcid"].alias("orcid"), F.lit(False).alias("archived")))
    theirs = F.transform(F.coalesce("a_creators", F.array().cast("array<struct<name:string,orcid:string,affiliation:string>>")), lambda p: F.struct(p["name"].alias("name"), p["orcid"].alias("orcid"), F.lit(True).alias("archived")))
    own = bare("creators")
    more = F.slice(theirs, F.size(own) + 1, F.greatest(F.size(theirs) - F.size(own), F.lit(0)))
    creators = F.when(F.size(own) == 0, theirs).when(F.coalesce("et_al", F.lit(False)), F.concat(own, more)).otherwise(own)
    out = None
    for role in ROLES:
        people = creators if role == "creators" else bare(role)
        part = entries.select("id", F.lit(role).alias("role"), F.posexplode(people).alias("pos", "p")).select("id", "role", "pos", "p.*")
        out = part if out is None else out.unionByName(part)
    return out


def resolved(entries: DataFrame, people: DataFrame, space: str) -> tuple[DataFrame, DataFrame]:
    """people -> (id, role, pos, person: struct(family, given, name, orcid, iri)), and who is ambiguous (id, name, orcids).

    An identifier that is known or that exactly one known person fits gives the canonical
    spelling; without one the record's fuller spelling counts."""
    split = T.split_name(F.coalesce("name", F.lit("")))
    taught = people.where("role = 'creators' AND NOT archived AND orcid IS NOT NULL").select("name", "orcid", F.lit(1).alias("weight"))
    archived = entries.select(F.explode("a_creators").alias("p")).where("p.orcid IS NOT NULL").select("p.name", "p.orcid", F.lit(2).alias("weight"))
    spellings = taught.unionByName(archived).where("name IS NOT NULL").withColumn("s", split).select("orcid", F.col("s.family").alias("family"), F.col("s.given").alias("given"), "weight")
    spellings = stored(spellings, "spellings")
    known = stored(resolve.canonical_names(spellings), "known")
    p = people.withColumn("s", split).select("*", F.col("s.family").alias("family"), F.col("s.given").alias("given"), F.concat_ws("|", "id", "role", F.col("pos").cast("string")).alias("key")).drop("s")
    p = stored(p, "persons")
    one, several = resolve.match_persons(p.where("orcid IS NULL").select(F.col("key").alias("id"), "family", "given"), known, spellings.select("orcid", "family").distinct())
    p = p.join(one.select(F.col("id").alias("key"), F.col("orcid").alias("matched")), "key", "left").withColumn("orcid", F.coalesce("orcid", "matched")).drop("matched")
    p = p.join(known.select("orcid", F.col("family").alias("k_family"), F.col("given").alias("k_given")), "orcid", "left")
    theirs = entries.select("id", F.transform("a_creators", lambda x: T.split_name(x["name"])).alias("spelled"))
    p = p.join(theirs, "id", "left")
    fits = F.filter("spelled", lambda x: (T.norm(x["family"]) == T.norm(F.col("family"))) & T.compatible(x["given"], F.col("given")) & (F.length(x["given"]) > F.length("given")))
    fuller = F.when(F.col("orcid").isNull() & ~F.col("archived"), F.try_element_at(fits, F.lit(1)))
    family, given = F.coalesce("k_family", fuller["family"], "family"), F.coalesce("k_given", fuller["given"], "given")
    iri = F.concat(F.lit(space), F.coalesce("orcid", T.slug(F.concat_ws(" ", family, given))))
    whole = F.when(F.length(given) > 0, F.concat(family, F.lit(", "), given)).otherwise(family)
    out = p.select("id", "role", "pos", F.struct(family.alias("family"), given.alias("given"), whole.alias("name"), "orcid", iri.alias("iri")).alias("person"))
    ambiguous = several.join(p.select(F.col("key").alias("id"), F.col("id").alias("entry"), "name"), "id").select(F.col("entry").alias("id"), "name", "orcids")
    return out, ambiguous


def joined_loose(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Persons without identifier of one family and compatible names become the one of the fullest name; and who was merged (name, into)."""
    loose = found.where("person.orcid IS NULL").groupBy("person.iri").agg(F.min("person").alias("p"))
    kept = resolve.loose_persons(loose.select(F.col("iri").alias("id"), "p.family", "p.given")).where("id <> keeper")
    moved = kept.join(loose.select(F.col("iri").alias("keeper"), F.col("p").alias("into")), "keeper").join(loose.select(F.col("iri").alias("id"), F.col("p.name").alias("was")), "id").select("id", "was", "into")
    moved = stored(moved, "moved")
    out = found.join(moved.select(F.col("id").alias("iri"), "into"), F.col("person.iri") == F.col("iri"), "left").select("id", "role", "pos", F.coalesce("into", "person").alias("person"))
    return out, moved.select(F.col("was").alias("name"), F.col("into.name").alias("into"))


def merge(volumes: DataFrame, archive: DataFrame, places: DataFrame, items: DataFrame, types: DataFrame, base: str, countries: dict[str, str] | None = None, home: str = "", least: float = 0.6) -> Merged:
    """The merged dataset."""
    c = F.col
    v, i, e = flat(volumes, base)
    archived = F.contains("doi", F.lit("zenodo."))
    e = stored(e.withColumn("record_id", F.when(archived, T.record_id(c("doi")))).join(from_archive(archive), "record_id", "left"), "entries")
    notes: list[DataFrame] = []

    def note(df: DataFrame, kind: str, text: Column) -> None:
        notes.append(df.select("where", F.lit(kind).alias("kind"), text.cast("string").alias("text")))

    at = e.select("id", "where", "draft")
    # types: own labels, else the archive's, else "other"
    own, unknown = resolve.type_slugs(e, "id", F.coalesce("types", F.array().cast("array<string>")), types)
    note(unknown.join(at, "id"), "unknown-type", c("label"))
    theirs = resolve.archive_type(e.where("a_type IS NOT NULL"), "id", c("a_type"), c("a_subtype"), types)
    typed = e.select("id", "where", "draft", "a_type", "a_subtype").join(own.withColumnRenamed("types", "own"), "id", "left").join(theirs, "id", "left")
    note(typed.where("own IS NULL AND slug IS NOT NULL"), "type-from-archive", F.concat(F.concat_ws("/", "a_type", "a_subtype"), F.lit(" -> "), "slug"))
    note(typed.where("own IS NULL AND slug IS NULL AND NOT draft"), "type-missing", F.lit("other"))
    typed = typed.select("id", F.coalesce("own", F.when(c("slug").isNotNull(), F.array("slug")), F.array(F.lit("other"))).alias("types"))
    # people
    found, ambiguous = resolved(e, persons(e), base + "person/")
    found, merged = joined_loose(stored(found, "resolved"))
    found = stored(found, "people")
    note(ambiguous.join(at, "id"), "person-ambiguous", F.concat("name", F.lit(" -> "), F.array_join("orcids", ", ")))
    notes.append(merged.select(F.col("name").alias("where"), F.lit("person-merged").alias("kind"), F.concat(F.lit("-> "), "into").alias("text")))
    n_own, n_theirs = F.size(F.coalesce("creators", F.array().cast("array<struct<name:string,orcid:string>>"))), F.coalesce(F.size("a_creators"), F.lit(0))
    et_al = F.coalesce("et_al", F.lit(False))
    note(e.where((n_own == 0) & (n_theirs > 0)), "creators-from-archive", n_theirs)
    note(e.where((n_own > 0) & (n_theirs > 0) & (n_own != n_theirs) & ~et_al), "creator-count", F.concat(n_own.cast("string"), F.lit(" and "), n_theirs.cast("string")))
    note(e.where(et_al & (n_theirs > n_own) & (n_own > 0)), "et-al-completed", n_theirs)
    grouped = found.groupBy("id", "role").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "person"))), lambda x: x["person"]).alias("people"))
    by_role = grouped.groupBy("id").pivot("role", ROLES).agg(F.first("people"))
    # places
    place = stored(located(places, items, countries or {}, home), "places")
    note(e.where(c("event.place").isNotNull()).join(place, c("event.place") == c("key"), "left_anti"), "place-unknown", c("event.place"))
    inside = F.struct("key", "label", "name", "wikidata", "country", "country_name", "lat", "lon")
    out = e.drop("types", *ROLES).join(typed, "id").join(by_role, "id", "left").join(place.select(F.col("key").alias("place_key"), inside.alias("place")), c("event.place") == c("place_key"), "left")
    # languages
    stated = F.coalesce("language", _table(SHORT_LANGUAGES, c("a_language")))
    guessed = T.guess_language(c("title"))
    # dates: the entry's, its event's, the archive's inside the volume's years
    plausible = resolve.plausible_date(c("a_date"), c("volume"), c("volume_year"))
    plausible = F.when(c("volume_year").isNull() & (c("volume") != 1), c("a_date")).otherwise(plausible)
    stated_date = F.coalesce("date", "event.start")
    ignored = stated_date.isNull() & c("a_date").isNotNull() & plausible.isNull()
    date = F.coalesce(stated_date, plausible)
    year = F.coalesce(F.substring(date, 1, 4).try_cast("int"), c("volume_year"))
    note(e.where(ignored), "archive-date-ignored", c("a_date"))
    note(e.where(date.isNull() & ~ignored & ~c("draft")), "no-date", F.lit("the volume's year"))
    note(e.where((c("volume") > 1) & (year != c("volume_year"))), "year-outside-volume", date)
    note(e.where(c("zenodo").isNull() & c("doi").isNotNull() & ~c("draft")), "no-archive-record", c("doi"))
    note(e.where(~c("licence.id").isin(list(LICENCES))), "licence-unmapped", c("licence.id"))
    unlike = c("a_title").isNotNull() & (T.similarity(T.norm(c("title")), T.norm(c("a_title"))) < least)
    event = F.when(c("event").isNotNull(), F.struct(*[c(f"event.{x}").alias(x) for x in ("name", "start", "end", "date_text", "session", "location", "online")], c("place").alias("place")))
    entries = out.select(
        "id", "iri", "path", "issue_iri", "volume", "issue", "n", "sigil", "citation_label", "title", "draft", "types", *[F.coalesce(r, F.array().cast("array<struct<family:string,given:string,name:string,orcid:string,iri:string>>")).alias(r) for r in ROLES], "doi", F.concat(F.lit("https://doi.org/"), "doi").alias("doi_url"),
        "related_dois", "wikidata", "isbn", F.coalesce("version", "a_version").alias("version"), "release_label", "context", "links", "container", "legacy_citation", "zenodo", F.col("zenodo.url").alias("zenodo_url"), "files", "pdf", "keywords", "licence", F.nullif("described.text", F.lit("")).alias("abstract"),
        F.when(F.length("described.text") > 0, c("described.html")).alias("abstract_html"), F.when(unlike, c("a_title")).alias("title_archive"), F.coalesce(stated, guessed).alias("language"), (stated.isNull() & guessed.isNotNull()).alias("language_guessed"), event.alias("event"), date.alias("date"), F.when(ignored, c("a_date")).alias("archive_date"), year.alias("year"),
    )
    entries = stored(entries, "merged")
    # people in order, with their entries in journal order
    mentions = found.join(entries.select(F.col("id"), "volume", "issue", "n"), "id")
    index = resolve.person_index(mentions.select(F.col("id").alias("entry"), "volume", "issue", "n", F.col("person.iri").alias("person")))
    who = found.groupBy("person.iri").agg(F.min("person").alias("p")).select("p.*")
    people = who.join(index.withColumnRenamed("person", "iri"), "iri").orderBy(*people_order())
    split = people.groupBy(T.norm(c("family")).alias("f")).agg(F.sort_array(F.collect_list(F.concat("name", F.when(c("orcid").isNotNull(), " (ORCID)").otherwise("")))).alias("names"), F.count("orcid").alias("known"), F.count("*").alias("n")).where("known > 0 AND known < n")
    notes.append(split.select(F.col("f").alias("where"), F.lit("person-split").alias("kind"), F.array_join("names", " / ").alias("text")))
    every = notes[0]
    for x in notes[1:]:
        every = every.unionByName(x)
    return Merged(v, i, entries, people, place, types, every)


def people_order() -> list[Column]:
    """People by family and given name in normal form, then by IRI."""
    return [T.norm(F.col("family")), T.norm(F.col("given")), F.col("iri")]


def in_order(lists: DataFrame, ids: str, entries: DataFrame, keys: list[str]) -> DataFrame:
    """lists (keys, ids: array) -> (keys, entries: array): the entries that the ids name, in the order of the ids; ids that name none are left out."""
    rows = lists.select(*keys, F.posexplode(ids).alias("pos", "id")).join(entries.select("id", F.struct(*entries.columns).alias("entry")), "id")
    return rows.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "entry")), lambda a, b: a["pos"] - b["pos"]), lambda x: x["entry"]).alias("entries"))
