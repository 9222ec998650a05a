"""Entity resolution: persons, types, places, publications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import compatible, initials, norm, similarity
from ..plans.shared import stored


def canonical_names(spellings: DataFrame, key: str = "orcid", share: int = 4) -> DataFrame:
    """spellings (key, family, given, weight) -> (key, family, given).

    The most frequent family (ties: the least in string order); of its given names those used at
    least 1/`share` as often as the most used, of these the longest (ties: the greatest).
    """
    used = spellings.groupBy(key, "family", "given").agg(F.sum("weight").alias("n"))
    family = used.groupBy(key, "family").agg(F.sum("n").alias("n"))
    best = family.groupBy(key).agg(F.min_by("family", F.struct(-F.col("n"), "family")).alias("family"))
    of_best = used.join(best, [key, "family"], "left_semi")
    top = of_best.groupBy(key).agg(F.max("n").alias("top"))
    often = of_best.join(top, key).where(F.col("n") * share >= F.col("top"))
    return often.groupBy(key).agg(F.first("family").alias("family"), F.max_by("given", F.struct(F.length("given"), "given")).alias("given"))


def _beginnings(i: Column, proper: bool = False) -> Column:
    """All beginnings of a text, from the empty one on."""
    every = F.transform(F.sequence(F.lit(0), F.length(i)), lambda k: F.substring(i, F.lit(1), k))
    return F.slice(every, F.lit(1), F.length(i)) if proper else every


def match_persons(persons: DataFrame, known: DataFrame, spellings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """persons (id, family, given) against known (orcid, family, given): (id, orcid) where exactly one fits, and (id, orcids) where several do.

    A family matches the canonical one or any known spelling of it; given names match where the
    initials of one begin the other's. People of one family and the same initials are one class; a
    class meets what its initials begin with, and what begins with them, by joins on equal texts.
    """
    names = known.select("orcid", norm(F.col("family")).alias("f")).union(spellings.select("orcid", norm(F.col("family")))).distinct().join(known.select("orcid", initials(F.col("given")).alias("i")), "orcid").where("i IS NOT NULL")
    own = persons.select("id", norm(F.col("family")).alias("f"), initials(F.col("given")).alias("i"))
    classes = own.select("f", "i").distinct()
    shorter = classes.select("f", "i", F.explode(_beginnings(F.col("i"))).alias("b")).join(names.select("f", F.col("i").alias("b"), "orcid"), ["f", "b"])
    longer = names.select("f", "orcid", F.explode(_beginnings(F.col("i"), proper=True)).alias("i")).join(classes, ["f", "i"])
    fits = shorter.select("f", "i", "orcid").union(longer.select("f", "i", "orcid")).groupBy("f", "i").agg(F.sort_array(F.collect_set("orcid")).alias("orcids"))
    hits = own.join(fits, ["f", "i"]).groupBy("id").agg(F.array_distinct(F.flatten(F.collect_set("orcids"))).alias("orcids"))
    return hits.where(F.size("orcids") == 1).select("id", F.col("orcids")[0].alias("orcid")), hits.where(F.size("orcids") > 1).select("id", F.sort_array("orcids").alias("orcids"))


def loose_persons(persons: DataFrame) -> DataFrame:
    """Persons without identifier (id, family, given) -> (id, keeper): each joins the first compatible one of its family in the order (longest given name, given, id).

    Not a transitive closure: who joined somebody doesn't attract others. People of one family with
    the same initials share their keeper, so what is decided are these classes: a class joins the
    first keeper among the classes before it whose initials begin its own or the other way round, and
    can be decided once these are. Initials are short, and so is a chain of classes that wait for
    each other: it passes each beginning of a text once.
    """
    order = F.struct((-F.length("given")).alias("l"), "given", "id")
    members = persons.select("id", F.coalesce(norm(F.col("family")), F.lit("\0")).alias("f"), initials(F.col("given")).alias("i"), order.alias("m"))
    classes = stored(members.where("i IS NOT NULL").groupBy("f", "i").agg(F.min("m").alias("m")), "persons")
    shorter = classes.select("f", F.explode(_beginnings(F.col("i"), proper=True)).alias("b"), "i", "m").join(classes.select("f", F.col("i").alias("b"), F.col("m").alias("bm")), ["f", "b"])
    first = F.col("bm") < F.col("m")
    later, earlier = F.when(first, F.col("i")).otherwise(F.col("b")), F.when(first, F.col("b")).otherwise(F.col("i"))
    waiting = stored(shorter.select("f", later.alias("i"), earlier.alias("e"), F.least("m", "bm").alias("em")), "persons")
    decided = stored(classes.join(waiting, ["f", "i"], "left_anti").select("f", "i", F.col("m.id").alias("keeper"), F.lit(True).alias("keeps")), "persons")
    while not waiting.isEmpty():
        told = waiting.join(decided.select("f", F.col("i").alias("e"), "keeps"), ["f", "e"], "left")
        ready = told.groupBy("f", "i").agg(F.bool_and(F.col("keeps").isNotNull()).alias("ready"), F.min(F.when(F.col("keeps"), F.col("em"))).alias("joins")).where("ready")
        fresh = stored(ready.join(classes, ["f", "i"]).select("f", "i", F.coalesce("joins.id", "m.id").alias("keeper"), F.col("joins").isNull().alias("keeps")), "persons")
        waiting = stored(waiting.join(fresh, ["f", "i"], "left_anti"), "persons")
        decided = decided.unionByName(fresh)
    return members.join(decided, ["f", "i"], "left").select("id", F.coalesce("keeper", "id").alias("keeper"))


def fuller_spelling(creators: Column, family: Column, given: Column) -> Column:
    """Of an archive's creators the first of the same family, compatible, with a longer given name."""
    fits = F.filter(creators, lambda c: (norm(c["family"]) == norm(family)) & compatible(c["given"], given) & (F.length(c["given"]) > F.length(given)))
    return F.coalesce(F.try_element_at(fits, F.lit(1))["given"], given)


def type_slugs(records: DataFrame, key: str, labels: str, concepts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labels to concept slugs through slugs and aliases: (key, types in first-seen order), (key, label) of the unknown.

    A vocabulary is small and its labels few, so it goes to the records: joined by label, all of one label would meet in one task.
    """
    alias = concepts.select("slug", F.explode(F.array_union(F.array("slug"), F.coalesce("aliases", F.array()))).alias("label"))
    rows = records.select(key, F.posexplode(labels).alias("pos", "label")).join(F.broadcast(alias), "label", "left")
    known = rows.where("slug IS NOT NULL").groupBy(key, "slug").agg(F.min("pos").alias("pos"))
    types = known.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "slug"))), lambda x: x["slug"]).alias("types"))
    return types, rows.where("slug IS NULL").select(key, "label")


def archive_type(records: DataFrame, key: str, type_: Column, subtype: Column, concepts: DataFrame) -> DataFrame:
    """(key, slug) of an archive's resource type: "type/subtype" first, then "type"."""
    table = concepts.select(F.explode("zenodo").alias("name"), "slug")
    both = table.select(F.col("name").alias("exact"), F.col("slug").alias("a"))
    one = table.select(F.col("name").alias("coarse"), F.col("slug").alias("b"))
    r = records.select(key, F.concat_ws("/", type_, subtype).alias("exact"), type_.alias("coarse"))
    return r.join(F.broadcast(both), "exact", "left").join(F.broadcast(one), "coarse", "left").select(key, F.coalesce("a", "b").alias("slug"))


def enrich(entries: DataFrame, archive: DataFrame, places: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Left joins of entries with their archive record, their place and the place's items; and notes of places that don't exist."""
    item = items.select(F.col("id").alias("wikidata"), F.col("labels").alias("item_labels"), "coordinates", F.try_element_at(F.coalesce("country_current", "country"), F.lit(1)).alias("country_id"))
    country = items.select(F.col("id").alias("country_id"), F.coalesce(F.try_element_at("labels", F.lit("en")), F.try_element_at("labels", F.lit("de"))).alias("country_name"))
    place = places.select(F.col("key").alias("place_key"), F.col("label").alias("place_label"), "wikidata", F.col("coordinates").alias("own")).join(item, "wikidata", "left").join(country, "country_id", "left")
    place = place.select("place_key", "place_label", "wikidata", "country_id", "country_name", F.round(F.coalesce("own.lat", "coordinates.lat"), 6).alias("lat"), F.round(F.coalesce("own.lon", "coordinates.lon"), 6).alias("lon"))
    out = entries.join(archive, "record_id", "left").join(place, "place_key", "left")
    lost = entries.where("place_key IS NOT NULL").join(places, F.col("place_key") == F.col("key"), "left_anti").select(F.col("id").alias("where"), F.lit("place-unknown").alias("kind"), F.col("place_key").alias("text"))
    return out, lost


def current_claims(claims: Column) -> Column:
    """Ids of claims (id, rank, ended): preferred ones if there are any, else those that haven't ended; deprecated never."""
    live = F.filter(claims, lambda c: c["rank"] != "deprecated")
    best = F.filter(live, lambda c: c["rank"] == "preferred")
    return F.transform(F.when(F.size(best) > 0, best).otherwise(F.filter(live, lambda c: ~F.coalesce(c["ended"], F.lit(False)))), lambda c: c["id"])


def not_historical(types: Column, current: list[str], historical: list[str]) -> Column:
    """Does a state exist today: it has a current type and no historical one."""
    return F.arrays_overlap(types, F.array(*map(F.lit, current))) & ~F.arrays_overlap(types, F.array(*map(F.lit, historical)))


def plausible_date(date: Column, volume: Column, year: Column, first_from: int = 2014, first_to: int = 2019) -> Column:
    """An archive's date, if it lies in its volume's year (volume 1 covers several)."""
    y = F.substring(date, 1, 4).try_cast("int")
    return F.when(F.when(volume == 1, y.between(first_from, first_to)).otherwise(y == year), date)


def match_publications(new: DataFrame, known: DataFrame, volume: int = 1, least: float = 0.6) -> DataFrame:
    """new (id, doi, title) against known (key, doi, title, volume): (id, key, how) where how is "doi", "title" or "rejected".

    A DOI matches anywhere; without one, an equal normal title in one volume; a match by DOI whose
    titles are too unlike is rejected. Of several candidates the least key counts.
    """
    by_doi = known.where("doi IS NOT NULL").groupBy(F.lower("doi").alias("d")).agg(F.min_by("key", "key").alias("key_d"), F.min_by("title", "key").alias("title_d"))
    by_title = known.where(F.col("volume") == volume).groupBy(norm(F.col("title")).alias("t")).agg(F.min("key").alias("key_t"))
    joined = new.withColumn("d", F.lower("doi")).withColumn("t", norm(F.col("title"))).join(by_doi, "d", "left").join(by_title, "t", "left")
    ratio = similarity(F.col("t"), norm(F.col("title_d")))
    scored = joined.withColumn("ratio", F.when(F.col("key_d").isNotNull(), ratio))
    how = F.when(F.col("key_d").isNotNull() & (F.col("ratio") < least), "rejected").when(F.col("key_d").isNotNull(), "doi").when(F.col("key_t").isNotNull(), "title")
    return scored.select("id", F.when(how == "title", F.col("key_t")).when(how == "doi", F.col("key_d")).alias("key"), how.alias("how"))


def rank_candidates(hits: DataFrame, most: int = 3) -> DataFrame:
    """hits (place, id, term_rank, hit_rank, has_coordinates, same_country, stated, similarity, is_station, km_from_city, n_terms) -> the best candidates of each place.

    The score falls with the ranks of the search term and of the hit; coordinates, the right
    country and a similar label add, stations and namesakes far from the city subtract.
    """
    venue = (F.col("term_rank") == 0) & (F.col("n_terms") > 1) & (F.col("similarity") >= 0.7) & F.col("has_coordinates")
    country = F.when(F.col("same_country"), F.when(F.col("stated"), 4).otherwise(2)).when(F.col("same_country").isNotNull() & F.col("stated"), -4).otherwise(0)
    add = lambda test, n: F.when(F.coalesce(test, F.lit(False)), n).otherwise(0)
    score = 10 - F.col("term_rank") - 0.5 * F.col("hit_rank") + add(F.col("has_coordinates"), 5) + country + 3 * F.col("similarity") + add(venue, 6) + add(F.col("is_station"), -8) + add(F.col("km_from_city") > 50, -8)
    best = hits.groupBy("place", "id").agg(F.max(score).alias("score"))
    rank = F.row_number().over(Window.partitionBy("place").orderBy(F.col("score").desc(), F.substring("id", 2, 20).cast("long")))
    return best.withColumn("rank", rank).where(F.col("rank") <= most)


def named_by_identifier(creators: DataFrame) -> DataFrame:
    """creators (id, pos, name, orcid): a creator with an identifier and no name gets the identifier's most frequent name (ties: the first seen)."""
    used = creators.where("name IS NOT NULL AND orcid IS NOT NULL").groupBy("orcid", "name").agg(F.count("*").alias("n"), F.min(F.struct("id", "pos")).alias("seen"))
    best = used.groupBy("orcid").agg(F.min_by("name", F.struct(-F.col("n"), "seen")).alias("usual"))
    return creators.join(best, "orcid", "left").select("id", "pos", F.coalesce("name", "usual").alias("name"), "orcid")


def person_index(entries: DataFrame) -> DataFrame:
    """entries (entry, volume, issue, n, person) -> (person, entries in journal order, each once)."""
    once = entries.select("person", "volume", "issue", "n", "entry").distinct()
    return once.groupBy("person").agg(F.transform(F.array_sort(F.collect_list(F.struct("volume", "issue", "n", "entry"))), lambda x: x["entry"]).alias("entries"))
