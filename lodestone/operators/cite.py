"""Citations: CSL-JSON, BibTeX and RIS as columns over merged entries.

entries: id, iri, volume, issue, n, sigil, title, creators (array of family, given), editors,
doi, doi_url, language, date, year, keywords, genre (the type's label), type (its slug),
event (name, location, online), container (bibtex_type, title, editors, publisher, place).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..functions.text import citation_label, tex

# RIS types by slug; BibTeX month macros; languages.
RIS_TYPES = {"conference-proceeding": "CPAPER", "data": "DATA", "ontology": "DATA", "software": "COMP"}
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
LANGUAGES = {"en": "english", "de": "german"}


def _c(name: str) -> Column:
    return F.col(name)


def in_proceedings() -> Column:
    return F.coalesce(_c("container.bibtex_type") == "inproceedings", F.lit(False))


def page() -> Column:
    """The full label in proceedings, sigil and number elsewhere."""
    return F.when(in_proceedings(), citation_label(_c("volume"), _c("issue"), _c("sigil"), _c("n"))).otherwise(F.concat("sigil", F.col("n").cast("string")))


def key() -> Column:
    """The citation key (a fixed format)."""
    return F.format_string("sp_vol%d_iss%d_e%d", _c("volume").cast("int"), _c("issue").cast("int"), _c("n").cast("int"))


def date_parts() -> Column:
    """Year, month and day as far as they are known."""
    own = F.transform(F.split("date", "-"), lambda x: x.try_cast("int"))
    return F.coalesce(own, F.when(_c("year").isNotNull(), F.array(_c("year").cast("int"))), F.array().cast("array<int>"))


def _given(p: Column) -> Column:
    return F.coalesce(F.length(p["given"]) > 0, F.lit(False))


def csl(entries: DataFrame, journal: str, issn: str) -> DataFrame:
    """(id, csl: JSON text); absent fields are left out."""
    name = lambda p: F.struct(F.when(_given(p), p["family"]).alias("family"), F.when(_given(p), p["given"]).alias("given"), F.when(~_given(p), p["family"]).alias("literal"))
    conference, event = in_proceedings(), F.length("event.name") > 0
    split = lambda e: F.struct(F.trim(F.substring_index(e["name"], ",", 1)).alias("family"), F.trim(F.when(F.instr(e["name"], ",") > 0, F.regexp_replace(e["name"], "^[^,]*,", "")).otherwise("")).alias("given"))
    own_editors = F.when(F.size("editors") > 0, F.transform("editors", name))
    their_editors = F.when(conference & (F.size("container.editors") > 0), F.transform("container.editors", lambda e: name(split(e))))
    parts = date_parts()
    item = F.struct(
        "id", F.when(conference, "paper-conference").otherwise("article-journal").alias("type"), "title", F.transform(F.coalesce("creators", F.array()), name).alias("author"),
        F.when(conference, F.coalesce("container.title", F.lit(journal))).otherwise(journal).alias("container-title"), F.lit(issn).alias("ISSN"),
        F.when(~conference, _c("volume").cast("string")).alias("volume"), F.when(~conference, _c("issue").cast("string")).alias("issue"), page().alias("page"), _c("genre"),
        F.when(F.size(parts) > 0, F.struct(F.array(parts).alias("date-parts"))).alias("issued"), F.col("doi").alias("DOI"), F.when(_c("doi").isNull(), _c("iri")).alias("URL"), "language",
        F.when(F.size("keywords") > 0, F.array_join("keywords", ", ")).alias("keyword"), F.when(event, _c("event.name")).alias("event-title"), F.when(event, _c("event.name")).alias("event"),
        F.when(event & ~F.coalesce("event.online", F.lit(False)), _c("event.location")).alias("event-place"), F.coalesce(own_editors, their_editors).alias("editor"),
        F.when(conference, _c("container.publisher")).alias("publisher"), F.when(conference, _c("container.place")).alias("publisher-place"),
    )
    return entries.select("id", F.to_json(item).alias("csl"))


def note() -> Column:
    event = F.when(F.length("event.name") > 0, F.concat(F.lit(", "), F.col("event.name"), F.coalesce(F.when(~F.coalesce("event.online", F.lit(False)) & (F.length("event.location") > 0), F.concat(F.lit(", "), F.col("event.location"))), F.lit(""))))
    return F.concat("genre", F.coalesce(event, F.lit("")))


def bibtex(entries: DataFrame, journal: str, issn: str) -> DataFrame:
    """(id, bibtex)."""
    conference, parts = in_proceedings(), date_parts()
    people = F.when(F.size("creators") > 0, F.array_join(F.transform("creators", lambda p: F.when(_given(p), F.concat(tex(p["family"]), F.lit(", "), tex(p["given"]))).otherwise(F.concat(F.lit("{"), tex(p["family"]), F.lit("}")))), " and "))
    j = tex(F.lit(journal))
    month = F.try_element_at(F.array(*map(F.lit, MONTHS)), F.try_element_at(parts, F.lit(2)))
    languages = F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])
    fields = [
        ("title", tex(_c("title"))), ("author", people), ("booktitle", F.when(conference, tex(F.coalesce("container.title", F.lit(journal))))),
        ("editor", F.when(conference & (F.size("container.editors") > 0), F.array_join(F.transform("container.editors", lambda e: tex(e["name"])), " and "))),
        ("publisher", F.when(conference, tex(F.coalesce("container.publisher", F.lit(journal))))), ("address", F.when(conference, tex(_c("container.place")))), ("series", F.when(conference, j)), ("journal", F.when(~conference, j)),
        ("volume", _c("volume").cast("string")), ("number", _c("issue").cast("string")), ("pages", tex(page())), ("year", F.try_element_at(parts, F.lit(1)).cast("string")), ("month", month),
        ("issn", F.lit(issn)), ("doi", tex(_c("doi"))), ("url", F.coalesce("doi_url", "iri")), ("language", F.coalesce(F.try_element_at(languages, _c("language")), _c("language"))),
        ("keywords", F.when(F.size("keywords") > 0, tex(F.array_join("keywords", ", ")))), ("note", tex(note())),
    ]
    # null fields are skipped; a month is a bare macro
    lines = [F.concat(F.lit(f"  {n} = " + ("" if n == "month" else "{")), v, F.lit("" if n == "month" else "}")) for n, v in fields]
    return entries.select("id", F.concat(F.lit("@"), F.when(conference, "inproceedings").otherwise("article"), F.lit("{"), key(), F.lit(",\n"), F.concat_ws(",\n", *lines), F.lit("\n}\n")).alias("bibtex"))


def ris(entries: DataFrame, journal: str, issn: str) -> DataFrame:
    """(id, ris)."""
    conference, parts = in_proceedings(), date_parts()
    kinds = F.create_map(*[F.lit(x) for kv in RIS_TYPES.items() for x in kv])

    def line(tag: str, value: Column) -> Column:
        return F.array(F.concat(F.lit(f"{tag}  - "), value))

    def lines(tag: str, values: Column) -> Column:
        return F.transform(F.coalesce(values, F.array()), lambda v: F.concat(F.lit(f"{tag}  - "), v))

    padded = F.transform(parts, lambda x, i: F.when(i == 0, x.cast("string")).otherwise(F.lpad(x.cast("string"), 2, "0")))
    every = F.concat(
        line("TY", F.when(conference, "CPAPER").otherwise(F.coalesce(F.try_element_at(kinds, _c("type")), F.lit("JOUR")))), line("ID", key()), line("TI", _c("title")),
        lines("AU", F.transform("creators", lambda p: F.when(_given(p), F.concat(p["family"], F.lit(", "), p["given"])).otherwise(p["family"]))),
        line("PY", F.try_element_at(parts, F.lit(1)).cast("string")), line("DA", F.when(F.size(parts) > 0, F.array_join(padded, "/"))),
        line("T2", F.when(conference, F.coalesce("container.title", F.lit(journal)))), lines("A2", F.when(conference, F.transform("container.editors", lambda e: e["name"]))),
        line("PB", F.when(conference, F.coalesce("container.publisher", F.lit(journal)))), line("CY", F.when(conference, _c("container.place"))), line("T3", F.when(conference, F.lit(journal))),
        line("JO", F.when(~conference, F.lit(journal))), line("VL", _c("volume").cast("string")), line("IS", _c("issue").cast("string")), line("SP", page()), line("SN", F.lit(issn)),
        line("DO", _c("doi")), line("UR", F.coalesce("doi_url", "iri")), line("LA", _c("language")), lines("KW", _c("keywords")), line("N1", _c("genre")), F.array(F.lit("ER  -")),
    )
    return entries.select("id", F.concat(F.array_join(F.transform(F.array_compact(every), lambda x: F.rtrim(x)), "\n"), F.lit("\n")).alias("ris"))


def rolled_up(cited: DataFrame, text: str, keys: list[str], order: list[str]) -> DataFrame:
    """Citation texts of each issue, volume or of all (no keys), joined in journal order."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, text))), lambda x: x[text]), "\n")
    return (cited.groupBy(*keys) if keys else cited.groupBy()).agg(joined.alias(text))


# Schema.org classes by type slug.
SCHEMA_TYPES = {
    "journal-article": "ScholarlyArticle", "conference-paper": "ScholarlyArticle", "conference-proceeding": "ScholarlyArticle", "preprint": "ScholarlyArticle", "working-paper": "ScholarlyArticle",
    "methodological-working-paper": "ScholarlyArticle", "position-paper": "ScholarlyArticle", "abstract": "ScholarlyArticle", "presentation": "PresentationDigitalDocument", "poster": "CreativeWork", "data": "Dataset",
    "ontology": "Dataset", "software": "SoftwareSourceCode", "book": "Book", "book-section": "Chapter", "report": "Report", "image": "ImageObject", "video": "VideoObject",
}
#: Characters of an abstract that a node carries.
ABSTRACT = 2000


def schema_org(entries: DataFrame, journal: str, issn: str, iri: str) -> DataFrame:
    """(id, node): a schema.org node as JSON text; absent fields are left out.

    Read beside the fields above, where the entries have them: creators.orcid, abstract, licence
    (url), event (start, end, place: name, label, wikidata, lat, lon)."""
    have = _paths(entries.schema)
    maybe = lambda path, kind="string": F.col(path) if path in have else F.lit(None).cast(kind)
    kinds = F.create_map(*[F.lit(x) for kv in SCHEMA_TYPES.items() for x in kv])
    people = F.transform(F.coalesce("creators", F.array()), lambda p: F.struct(F.lit("Person").alias("@type"), F.trim(F.concat_ws(" ", p["given"], p["family"])).alias("name"), (F.concat(F.lit("https://orcid.org/"), p["orcid"]) if "creators.orcid" in have else F.lit(None).cast("string")).alias("@id")))
    periodical = F.struct(F.lit("Periodical").alias("@type"), F.lit(iri).alias("@id"), F.lit(journal).alias("name"), F.lit(issn).alias("issn"))
    volume = F.struct(F.lit("PublicationVolume").alias("@type"), F.regexp_replace("iri", "/[^/]*/[^/]*$", "").alias("@id"), _c("volume").cast("string").alias("volumeNumber"), periodical.alias("isPartOf"))
    issue = F.struct(F.lit("PublicationIssue").alias("@type"), F.regexp_replace("iri", "/[^/]*$", "").alias("@id"), _c("issue").cast("string").alias("issueNumber"), volume.alias("isPartOf"))
    has_doi = _c("doi").isNotNull()
    lat, lon = maybe("event.place.lat", "double"), maybe("event.place.lon", "double")
    geo = F.when(lat.isNotNull(), F.struct(F.lit("GeoCoordinates").alias("@type"), lat.alias("latitude"), lon.alias("longitude")))
    place = F.coalesce(maybe("event.place.name"), maybe("event.place.label"))
    located = F.when(place.isNotNull(), F.struct(F.lit("Place").alias("@type"), place.alias("name"), F.concat(F.lit("http://www.wikidata.org/entity/"), maybe("event.place.wikidata")).alias("sameAs"), geo.alias("geo")))
    online = F.when(place.isNull() & F.coalesce("event.online", F.lit(False)), "https://schema.org/OnlineEventAttendanceMode")
    event = F.when(F.length("event.name") > 0, F.struct(F.lit("Event").alias("@type"), F.col("event.name").alias("name"), maybe("event.start").alias("startDate"), maybe("event.end").alias("endDate"), located.alias("location"), online.alias("eventAttendanceMode")))
    node = F.struct(
        F.lit("https://schema.org").alias("@context"), F.coalesce(F.try_element_at(kinds, _c("type")), F.lit("CreativeWork")).alias("@type"), F.col("iri").alias("@id"), F.col("title").alias("name"), F.concat("iri", F.lit("/")).alias("url"), people.alias("author"), issue.alias("isPartOf"), "genre",
        F.coalesce("date", _c("year").cast("string")).alias("datePublished"), F.when(has_doi, F.struct(F.lit("PropertyValue").alias("@type"), F.lit("DOI").alias("propertyID"), F.col("doi").alias("value"))).alias("identifier"), F.when(has_doi, F.array("doi_url")).alias("sameAs"),
        F.when(F.size("keywords") > 0, _c("keywords")).alias("keywords"), F.col("language").alias("inLanguage"), event.alias("recordedAt"),
        F.substring(maybe("abstract"), 1, ABSTRACT).alias("abstract"), maybe("licence.url").alias("license"),
    )
    return entries.select("id", F.to_json(node).alias("node"))


def _paths(kind: StructType, head: str = "") -> set[str]:
    """Dotted names of all fields, those of structs in arrays too."""
    out = set()
    for f in kind.fields:
        out.add(head + f.name)
        inner = f.dataType.elementType if isinstance(f.dataType, ArrayType) else f.dataType
        if isinstance(inner, StructType):
            out |= _paths(inner, f"{head}{f.name}.")
    return out


def short_citation(entries: DataFrame, journal: str) -> DataFrame:
    """(id, text): authors with initials, year or "n.d.", title, journal, label and link."""
    begun = lambda g: F.array_join(F.transform(F.regexp_extract_all(g, F.lit(r"([A-ZÄÖÜ][a-zäöüß]*\.?)"), 1), lambda w: F.concat(F.substring(w, 1, 1), F.lit("."))), " ")
    names = F.transform(F.coalesce("creators", F.array()), lambda p: F.regexp_replace(F.concat(p["family"], F.lit(", "), begun(F.coalesce(p["given"], F.lit("")))), r"^[, ]+|[, ]+$", ""))
    authors = F.when(F.size(names) > 1, F.concat(F.array_join(F.slice(names, 1, F.size(names) - 1), ", "), F.lit(", & "), F.element_at(names, -1))).otherwise(F.coalesce(F.try_element_at(names, F.lit(1)), F.lit("")))
    label = citation_label(_c("volume"), _c("issue"), _c("sigil"), _c("n"))
    parts = [F.nullif(authors, F.lit("")), F.concat(F.lit("("), F.coalesce(_c("year").cast("string"), F.lit("n.d.")), F.lit(").")), F.concat("title", F.lit(".")), F.concat(F.lit(f"{journal}, "), label, F.lit(".")), F.coalesce("doi_url", "iri")]
    return entries.select("id", F.concat_ws(" ", *parts).alias("text"))
