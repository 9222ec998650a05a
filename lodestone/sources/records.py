"""Gathered lines and raw answers to typed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: Fields that a record's lines may name (fixed values).
FIELDS = ["authors", "doi", "event", "location", "session", "repository", "repo", "version", "release", "date", "link", "type", "editors", "contributors", "video", "youtube", "wikidata", "zenodo-community", "isbn"]
_HAS_DOI = r"10\.[0-9]{4,9}/|doi\.org"
_NO_DOI = r"(?i)^doi:?\s*(?:tbd|n/?a|-)?$"


def _field(*names: str) -> Column:
    return F.coalesce(*[F.try_element_at("fields", F.lit(n)) for n in names])


def entries(gathered: DataFrame) -> DataFrame:
    """readers.entries_of() to entries: one projection, each column from the fields and bare lines it is made of.

    Bare lines count by what they hold: a DOI, an item, an ISBN, a URL; the first of the others
    names the authors. A field's people win over a bare line's. An entry without DOI and link is a draft.
    """
    plain = F.coalesce("plain", F.array().cast("array<string>"))
    kind = lambda x: F.when(x.rlike(_NO_DOI), "none").when(x.rlike(_HAS_DOI), "doi").when(F.lower(x).startswith("wikidata") & x.rlike("Q[0-9]+"), "item").when(F.lower(x).startswith("isbn"), "isbn").when(F.trim(x).rlike(r"^https?://\S+$"), "url").otherwise("people")
    bare = lambda k: F.filter(plain, lambda x: kind(x) == k)
    first = lambda k: F.try_element_at(bare(k), F.lit(1))
    people = T.split_people(F.coalesce(_field("authors"), first("people")))
    named = F.array_compact(F.array(T.doi(_field("doi")), T.doi(_field("link"))))
    found = F.array_distinct(F.concat(F.filter(F.transform(bare("doi"), T.doi), lambda d: d.isNotNull()), named))
    doi = F.try_element_at(found, F.lit(1))
    href = lambda c: F.coalesce(T.first_href(c), F.nullif(T.strip_markdown(c), F.lit("")))
    target = T.first_href(F.coalesce(F.when(T.doi(_field("link")).isNull(), _field("link")), F.when(T.doi(_field("doi")).isNull(), _field("doi"))))
    link = F.coalesce(F.when(~F.contains(target, F.lit("doi.org/")), target), F.trim(first("url")))
    event = T.strip_markdown(_field("event"))
    inside = F.nullif(F.regexp_extract(event, r"\(([^()]*)\)\s*$", 1), F.lit(""))
    dates = T.event_dates(inside)
    location = F.nullif(T.strip_markdown(_field("location")), F.lit(""))
    session = T.strip_markdown(_field("session"))
    links = F.struct(link.alias("link"), href(_field("repository", "repo")).alias("repository"), href(_field("release")).alias("release"), href(_field("video", "youtube")).alias("video"), href(_field("zenodo-community")).alias("zenodo_community"))
    no_link = F.coalesce(*[links[n] for n in ("link", "repository", "release", "video", "zenodo_community")]).isNull()
    item = F.coalesce(F.nullif(F.regexp_extract(_field("wikidata"), r"\b(Q[0-9]+)\b", 1), F.lit("")), F.nullif(F.regexp_extract(first("item"), r"\b(Q[0-9]+)\b", 1), F.lit("")))
    unknown = F.map_filter("fields", lambda k, v: ~k.isin(FIELDS))
    return gathered.select(
        "source", "issue", "line", "sigil", "n", "labels", "title", "language", people["people"].alias("creators"), F.coalesce(people["et_al"], F.lit(False)).alias("et_al"),
        T.split_people(_field("editors"))["people"].alias("editors"), T.split_people(_field("contributors"))["people"].alias("contributors"), doi.alias("doi"), F.filter(found, lambda d: d != doi).alias("related_dois"),
        F.struct(
            F.nullif(F.trim(F.regexp_replace(event, r"\([^()]*\)\s*$", "")), F.lit("")).alias("name"), dates["start"].alias("start"), dates["end"].alias("end"), F.when(dates["start"].isNull(), inside).alias("date_text"),
            F.when(~F.lower(session).isin("n/a", "-", ""), session).alias("session"), location.alias("location"), T.is_online(location).alias("online"),
        ).alias("event"),
        links.alias("links"), T.strip_markdown(_field("version")).alias("version"), F.nullif(F.regexp_extract(_field("release"), r"\[([^\]]*)\]", 1), F.lit("")).alias("release_label"), T.event_dates(T.strip_markdown(_field("date")))["start"].alias("date"),
        T.strip_markdown(_field("type")).alias("context"), F.coalesce(T.strip_markdown(_field("isbn")), F.trim(F.regexp_replace(first("isbn"), "^[^:]*:", ""))).alias("isbn"), item.alias("wikidata"),
        F.nullif(F.array_join(F.transform(F.coalesce("quotes", F.array().cast("array<string>")), T.strip_markdown), " "), F.lit("")).alias("legacy_citation"),
        F.transform(F.map_entries(unknown), lambda e: F.concat(e["key"], F.lit(": "), T.strip_markdown(e["value"]))).alias("notes"), (doi.isNull() & no_link).alias("draft"),
    )


_CLAIM = "array<struct<rank:string,qualifiers:map<string,string>,mainsnak:struct<datavalue:struct<value:string>>>>"


def entities(raw: DataFrame, column: str = "value") -> DataFrame:
    """Entities as JSON texts -> (id, labels, descriptions, country, country_current, instance_of, coordinates): English and German labels, ids of claims, the first coordinate."""
    schema = f"struct<id:string,labels:map<string,struct<value:string>>,descriptions:map<string,struct<value:string>>,claims:map<string,{_CLAIM}>>"
    e = raw.select(F.from_json(column, schema).alias("e")).select("e.*")
    claims = lambda p: F.coalesce(F.try_element_at("claims", F.lit(p)), F.array().cast(_CLAIM))
    ids = lambda cs: F.sort_array(F.array_distinct(F.filter(F.transform(cs, lambda c: F.get_json_object(c["mainsnak"]["datavalue"]["value"], "$.id")), lambda x: x.isNotNull())))
    live = F.filter(claims("P17"), lambda c: F.coalesce(c["rank"], F.lit("")) != "deprecated")
    preferred = ids(F.filter(live, lambda c: c["rank"] == "preferred"))
    lasting = ids(F.filter(live, lambda c: ~F.coalesce(F.map_contains_key(c["qualifiers"], F.lit("P582")), F.lit(False))))
    texts = lambda m: F.transform_values(F.map_filter(m, lambda k, v: k.isin("en", "de")), lambda k, v: v["value"])
    at = F.try_element_at(claims("P625"), F.lit(1))["mainsnak"]["datavalue"]["value"]
    number = lambda path: F.round(F.get_json_object(at, path).try_cast("double"), 6)
    return e.select(
        "id", texts(F.col("labels")).alias("labels"), texts(F.col("descriptions")).alias("descriptions"), ids(claims("P17")).alias("country"), F.when(F.size(preferred) > 0, preferred).otherwise(lasting).alias("country_current"),
        ids(claims("P31")).alias("instance_of"), F.when(number("$.latitude").isNotNull(), F.struct(number("$.latitude").alias("lat"), number("$.longitude").alias("lon"))).alias("coordinates"),
    )


def with_containers(records: DataFrame, blocks: DataFrame, label: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entries with the container of the BibTeX block of their DOI; blocks without entry; entries whose label isn't in the block's pages."""
    field = lambda n: F.try_element_at("fields", F.lit(n))
    editors = F.transform(F.split(field("editor"), r"\s+and\s+"), lambda x: F.struct(F.trim(x).alias("name")))
    made = F.struct(F.col("type").alias("bibtex_type"), F.coalesce(field("booktitle"), field("journal")).alias("title"), editors.alias("editors"), field("publisher").alias("publisher"), field("address").alias("place"))
    block = blocks.select("doi", made.alias("container"), field("pages").alias("pages"))
    joined = records.join(block, "doi", "left")
    odd = joined.where(F.col("container").isNotNull() & F.col("pages").isNotNull() & (T.collapse(F.col("pages")) != label)).select("doi", "pages", label.alias("label"))
    return joined.drop("pages"), block.join(records, "doi", "left_anti"), odd
