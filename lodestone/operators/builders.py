"""Node builders: merged records as the views of a graph.

One view for each kind of node, in three named graphs: "main" (catalogue terms), "crm" (the
event-centred view of the same nodes) and "types" (the concept scheme). Nothing is projected
before a query asks for its predicates; `Graph.scan()` gives all of it, for sinks.

Records are those of schema.py after the merge:

journals: iri, title, description (map by language), issn, wikidata, licence, languages, publisher (name), editor (family, given, orcid), modified
volumes: volume, iri, path, year, coverage, wikidata
issues: volume, issue, iri, path, volume_iri, sigil, special, title (en, de), wikidata
entries: id, iri, path, issue_iri, volume, issue, n, sigil, citation_label, title, types, language, language_guessed, abstract, date, year, doi, doi_url, related_dois, wikidata, version, keywords, licence (url),
  zenodo_url, links (repository, video, link, release), creators/editors/contributors (family, given, orcid, iri), event (name, start, end, online, place), pdf (key, download), files (key, size, checksum), draft
types: slug, label (map by language), fabio, coar, match, broader
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .events import anchored_clusters
from .triples import RDF, XSD, Emit, Graph, Listed, View, a, iri, ordered_members

# Namespaces of public vocabularies.
PREFIXES = {
    "bibo": "http://purl.org/ontology/bibo/",
    "crm": "http://www.cidoc-crm.org/cidoc-crm/",
    "crmdig": "http://www.ics.forth.gr/isl/CRMdig/",
    "dcat": "http://www.w3.org/ns/dcat#",
    "dct": "http://purl.org/dc/terms/",
    "eufiletype": "http://publications.europa.eu/resource/authority/file-type/",
    "eulang": "http://publications.europa.eu/resource/authority/language/",
    "event": "http://purl.org/NET/c4dm/event.owl#",
    "fabio": "http://purl.org/spar/fabio/",
    "foaf": "http://xmlns.com/foaf/0.1/",
    "geo": "http://www.opengis.net/ont/geosparql#",
    "iana": "http://www.iana.org/assignments/media-types/",
    "lrmoo": "http://iflastandards.info/ns/lrm/lrmoo/",
    "owl": "http://www.w3.org/2002/07/owl#",
    "prism": "http://prismstandard.org/namespaces/basic/2.0/",
    "prov": "http://www.w3.org/ns/prov#",
    "rdf": RDF,
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "schema": "https://schema.org/",
    "skos": "http://www.w3.org/2004/02/skos/core#",
    "spdx": "http://spdx.org/rdf/terms#",
    "wd": "http://www.wikidata.org/entity/",
    "xsd": XSD,
}
# Codes of the language authority.
LANGUAGES = {"en": "ENG", "de": "DEU", "fr": "FRA", "it": "ITA", "es": "SPA"}
# Words of made titles, by language.
WORDS = {"en": ("Volume", "Issue"), "de": ("Band", "Heft")}
COAR = "http://purl.org/coar/resource_type/"
DOI, ORCID = "https://doi.org/", "https://orcid.org/"
LANDING = "Landing page of the record"
MAIN, CRM, TYPES = "main", "crm", "types"


@dataclass(frozen=True)
class Site:
    """Where a journal's resources and pages live, and its name in made titles."""

    base: str
    pages: str
    title: str
    publisher: str
    #: prefix and namespace of the journal's own terms
    own: tuple[str, str] = ("own", "")
    type_titles: dict[str, str] = field(default_factory=dict)
    types_licence: str = ""

    def prefixes(self) -> dict[str, str]:
        return PREFIXES | {self.own[0]: self.own[1] or self.base + "ontology#"}

    def ns(self, kind: str) -> str:
        return f"{self.base}{kind}/"


class Builder:
    def __init__(self, site: Site):
        self.site, self.names = site, site.prefixes()

    # terms
    def n(self, curie: str) -> str:
        prefix, _, local = curie.partition(":")
        return self.names[self.site.own[0] if prefix == "own" else prefix] + local

    def r(self, p: str, o: Column | str, **more) -> Emit:
        """A triple to a resource: a column of IRIs, or a name."""
        return iri(self.n(p), F.lit(self.n(o)) if isinstance(o, str) else o, **more)

    def l(self, p: str, o: Column | str, type: str | Column = XSD + "string", **more) -> Emit:
        return Emit(self.n(p), F.lit(o) if isinstance(o, str) else o, type=self.n(type) if isinstance(type, str) and not type.startswith("http") else type, **more)

    def tagged(self, p: str, o: Column | str, lang: str | Column | None, **more) -> Emit:
        """A text with a language, or a plain one where the language is null."""
        if isinstance(lang, Column):
            return self.l(p, o, F.when(lang.isNull(), XSD + "string").otherwise(RDF + "langString"), lang=F.coalesce(lang, F.lit("")), **more)
        return self.l(p, o, RDF + "langString" if lang else XSD + "string", lang=lang or "", **more)

    def dated(self, p: str, o: Column) -> Emit:
        kind = T.date_type(o)
        return self.l(p, o, F.when(kind == "xsd:date", XSD + "date").when(kind == "xsd:gYear", XSD + "gYear").otherwise(XSD + "string"))

    def a(self, *classes: str) -> list[Emit]:
        return [a(self.n(c)) for c in classes]

    def view(self, kind: str, records: DataFrame, subject: Column, *templates: Emit, key: bool = True, graph: str = MAIN) -> View:
        return View(kind, records, subject, tuple(templates), key, graph)

    def typed(self, records: DataFrame, node: Column, class_: str) -> View:
        """The class of a resource that is only pointed to."""
        return self.view("external", records.select(node.alias("node")).where("node IS NOT NULL"), F.col("node"), *self.a(class_), key=False)

    def wikidata(self, item: Column) -> Column:
        return F.concat(F.lit(self.names["wd"]), item)

    def language(self, code: Column) -> Column:
        known = F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])
        return F.concat(F.lit(self.names["eulang"]), F.coalesce(F.try_element_at(known, code), F.upper(code)))

    # helper nodes of the crm graph
    def identifier(self, records: DataFrame, owner: Column, kind: str, value: Column) -> list[View]:
        rows = records.select(owner.alias("owner"), value.alias("value")).where("owner IS NOT NULL AND value IS NOT NULL")
        node = F.concat("owner", F.lit("#" + kind))
        return [
            self.view("owner", rows, F.col("owner"), self.r("crm:P1_is_identified_by", node), key=False, graph=CRM),
            self.view("identifier", rows, node, *self.a("crm:E42_Identifier"), self.l("crm:P190_has_symbolic_content", F.col("value")), self.r("crm:P2_has_type", F.lit(self.site.ns("identifier-type") + kind)), key=False, graph=CRM),
        ]

    def symbol(self, records: DataFrame, owner: Column, p: str, fragment: str, class_: str, value: Column) -> list[View]:
        """A name or title as a node of its own."""
        rows = records.select(owner.alias("owner"), value.alias("value")).where("owner IS NOT NULL AND value IS NOT NULL")
        node = F.concat("owner", F.lit("#" + fragment))
        return [self.view("owner", rows, F.col("owner"), self.r(p, node), key=False, graph=CRM), self.view(fragment, rows, node, *self.a(class_), self.l("crm:P190_has_symbolic_content", F.col("value")), graph=CRM)]

    def time_span(self, records: DataFrame, owner: Column, start: Column, end: Column) -> list[View]:
        """A node beside its owner: an IRI has one "#", so the owner's fragment comes before the node's."""
        rows = records.select(owner.alias("owner"), start.alias("start"), end.alias("end")).where("owner IS NOT NULL AND start IS NOT NULL")
        hashed = F.contains("owner", F.lit("#"))
        node = F.concat("owner", F.when(hashed, F.lit("-time-span")).otherwise(F.lit("#time-span")))
        # what is neither a day nor a year counts by its first four characters
        day = lambda c, tail: F.when(F.length(c) == 10, c).otherwise(F.concat(F.substring(c, 1, 4), F.lit(tail)))
        begin, finish = day(F.col("start"), "-01-01"), day(F.coalesce("end", "start"), "-12-31")
        span = self.view(
            "time-span", rows, node, *self.a("crm:E52_Time-Span"), self.l("crm:P82a_begin_of_the_begin", F.concat(begin, F.lit("T00:00:00")), "xsd:dateTime"), self.l("crm:P82b_end_of_the_end", F.concat(finish, F.lit("T23:59:59")), "xsd:dateTime"), graph=CRM
        )
        return [self.view("owner", rows, F.col("owner"), self.r("crm:P4_has_time-span", node), key=False, graph=CRM), span]

    # journals, volumes, issues
    def journals(self, journals: DataFrame) -> list[View]:
        c, pages = F.col, F.lit(self.site.pages)
        publisher = F.lit(self.site.ns("org") + self.site.publisher)
        texts = journals.select("iri", F.explode("description").alias("lang", "text"))
        tongues = journals.select("iri", F.explode("languages").alias("lang"))
        editor = F.concat(F.lit(self.site.ns("person")), c("editor.orcid"))
        main = self.view(
            "journal", journals, c("iri"), *self.a("dcat:Catalog", "fabio:Journal", "bibo:Periodical", "schema:Periodical"), self.tagged("dct:title", c("title"), "en"), self.l("bibo:issn", c("issn")), self.l("prism:issn", c("issn")),
            self.l("dct:identifier", F.concat(F.lit("ISSN "), c("issn"))), self.r("owl:sameAs", self.wikidata(c("wikidata"))), self.r("dcat:landingPage", pages), self.r("foaf:homepage", pages), self.r("dct:license", c("licence")),
            self.l("dct:modified", c("modified"), "xsd:date"), self.r("dcat:themeTaxonomy", F.lit(self.site.ns("type"))), self.r("dct:publisher", publisher), self.r("bibo:editor", editor), self.r("schema:editor", editor),
        )
        return [
            main,
            self.view("journal", texts, c("iri"), self.tagged("dct:description", F.trim("text"), c("lang")), key=False),
            self.view("journal", tongues, c("iri"), self.r("dct:language", self.language(c("lang"))), key=False),
            self.typed(tongues, self.language(c("lang")), "dct:LinguisticSystem"),
            self.typed(journals, pages, "foaf:Document"),
            self.view("organisation", journals, publisher, *self.a("foaf:Organization"), self.tagged("foaf:name", c("publisher"), "en"), key=False),
            self.view("journal", journals, c("iri"), *self.a("lrmoo:F18_Serial_Work", "crm:E73_Information_Object"), graph=CRM),
            *self.identifier(journals, c("iri"), "issn", c("issn")),
        ]

    def volumes(self, volumes: DataFrame, journal: str) -> list[View]:
        c, j = F.col, F.lit(journal)
        years = F.replace(F.coalesce("coverage", c("year").cast("string"), F.lit("")), F.lit("/"), F.lit("–"))
        page = F.concat(F.lit(self.site.pages), "path", F.lit("/"))
        number = c("volume").cast("string")
        titles = [self.tagged("dct:title", F.concat(F.lit(f"{self.site.title}, {words[0]} "), number, F.lit(" ("), years, F.lit(")")), lang) for lang, words in WORDS.items()]
        said = F.concat(F.lit("Volume "), number, F.lit(f" of the {self.site.title}, covering "), years, F.lit("."))
        main = self.view(
            "volume", volumes, c("iri"), *self.a("dcat:DatasetSeries", "fabio:JournalVolume"), *titles, self.tagged("dct:description", said, "en"), self.l("prism:volume", number), self.r("dct:isPartOf", j), self.r("dcat:landingPage", page), self.r("owl:sameAs", self.wikidata(c("wikidata")))
        )
        return [
            main,
            self.view("journal", volumes, j, self.r("dcat:dataset", c("iri")), key=False),
            self.typed(volumes, page, "foaf:Document"),
            self.view("volume", volumes, c("iri"), *self.a("crm:E73_Information_Object"), self.r("crm:P106i_forms_part_of", j), graph=CRM),
        ]

    def issues(self, issues: DataFrame) -> list[View]:
        c = F.col
        v, i = c("volume").cast("string"), c("issue").cast("string")
        page = F.concat(F.lit(self.site.pages), "path", F.lit("/"))

        def title(lang: str) -> Emit:
            volume, issue = WORDS[lang]
            own = c(f"title.{lang}")
            return self.tagged("dct:title", F.concat(F.lit(f"{self.site.title}, {volume} "), v, F.lit(f", {issue} "), i, F.when(F.length(own) > 0, F.concat(F.lit(": "), own)).otherwise("")), lang)

        said = F.coalesce(F.nullif(c("title.en"), F.lit("")), F.concat(F.lit("Issue "), i, F.lit(" of volume "), v, F.lit(f" of the {self.site.title}.")))
        main = self.view(
            "issue", issues, c("iri"), *self.a("dcat:DatasetSeries", "fabio:JournalIssue"), title("en"), title("de"), self.tagged("dct:description", said, "en"), self.l("prism:number", i), self.l("prism:volume", v), self.r("dcat:inSeries", c("volume_iri")),
            self.r("dct:isPartOf", c("volume_iri")), self.l("own:sigil", c("sigil")), self.l("own:specialIssue", F.coalesce("special", F.lit(False)), "xsd:boolean"), self.r("dcat:landingPage", page), self.r("owl:sameAs", self.wikidata(c("wikidata"))),
        )
        return [
            main,
            self.view("volume", issues, c("volume_iri"), self.r("dct:hasPart", c("iri")), key=False),
            self.typed(issues, page, "foaf:Document"),
            self.view("issue", issues, c("iri"), *self.a("crm:E73_Information_Object"), self.r("crm:P106i_forms_part_of", c("volume_iri")), graph=CRM),
        ]

    # people, places, events
    def people(self, people: DataFrame) -> list[View]:
        """people (iri, family, given, orcid), one row each."""
        c = F.col
        given = F.nullif(c("given"), F.lit(""))
        name, orcid = F.concat_ws(" ", given, "family"), F.concat(F.lit(ORCID), c("orcid"))
        return [
            self.view("person", people, c("iri"), *self.a("foaf:Person", "schema:Person"), self.l("foaf:name", name), self.l("foaf:familyName", c("family")), self.l("foaf:givenName", given), self.l("rdfs:label", name), self.r("owl:sameAs", orcid), self.r("schema:identifier", orcid)),
            self.view("person", people, c("iri"), *self.a("crm:E21_Person"), graph=CRM),
            *self.identifier(people, c("iri"), "orcid", c("orcid")),
        ]

    def places(self, places: DataFrame) -> list[View]:
        """places (key, label, name, wikidata, country (wikidata), lat, lon), one row each."""
        c = F.col
        node = F.concat(F.lit(self.site.ns("place")), "key")
        geometry = F.when(c("lat").isNotNull(), F.concat(node, F.lit("#geometry")))
        point = F.when(c("lat").isNotNull(), F.concat(F.lit("POINT("), c("lon").cast("string"), F.lit(" "), c("lat").cast("string"), F.lit(")")))
        return [
            self.view(
                "place", places, node, *self.a("dct:Location", "schema:Place", "geo:Feature"), self.l("rdfs:label", F.coalesce(F.nullif(c("name"), F.lit("")), "label")), self.l("schema:description", c("label")), self.r("owl:sameAs", self.wikidata(c("wikidata"))),
                self.r("schema:addressCountry", self.wikidata(c("country"))), self.r("geo:hasGeometry", geometry), self.r("geo:hasDefaultGeometry", geometry), self.l("dcat:centroid", point, "geo:wktLiteral"), self.l("schema:latitude", c("lat"), "xsd:double"), self.l("schema:longitude", c("lon"), "xsd:double"),
            ),
            self.view("geometry", places, geometry, *self.a("geo:Geometry"), self.l("geo:asWKT", point, "geo:wktLiteral")),
            self.view("place", places, node, *self.a("crm:E53_Place"), self.l("crm:P168_place_is_defined_by", point, "geo:wktLiteral"), graph=CRM),
        ]

    def events(self, events: DataFrame) -> list[View]:
        """events (iri, name, start, end, online, place_key), one row each, as `events_of` makes them."""
        c = F.col
        place = F.concat(F.lit(self.site.ns("place")), "place_key")
        online = F.when(c("online"), F.lit(self.n("schema:OnlineEventAttendanceMode")))
        return [
            self.view(
                "event", events, c("iri"), *self.a("event:Event", "schema:Event"), self.l("rdfs:label", c("name")), self.l("schema:name", c("name")), self.dated("schema:startDate", c("start")), self.dated("schema:endDate", c("end")), self.r("schema:eventAttendanceMode", online), self.r("schema:location", place), self.r("event:place", place)
            ),
            self.view("event", events, c("iri"), *self.a("crm:E7_Activity"), self.r("crm:P7_took_place_at", place), graph=CRM),
            *self.symbol(events, c("iri"), "crm:P1_is_identified_by", "name", "crm:E41_Appellation", c("name")),
            *self.time_span(events, c("iri"), c("start"), c("end")),
        ]

    # entries
    def entries(self, entries: DataFrame, types: DataFrame, of_event: DataFrame) -> list[View | Listed]:
        """entries as above, without drafts; of_event (id, event_iri)."""
        c = F.col
        kind = types.select(F.col("slug").alias("primary"), F.coalesce("fabio", F.lit("Expression")).alias("fabio"), F.coalesce(F.try_element_at("label", F.lit("en")), "slug").alias("type_label"))
        # types are a vocabulary: a table of a schema's size
        e = entries.withColumn("primary", F.element_at("types", 1)).join(F.broadcast(kind), "primary", "left").join(of_event, "id", "left")
        subject, own = c("iri"), lambda fragment: F.concat("iri", F.lit("#" + fragment))
        page = F.concat(F.lit(self.site.pages), "path", F.lit("/"))
        abstract = F.nullif(c("abstract"), F.lit(""))
        said = F.concat("type_label", F.lit(f" published in the {self.site.title} "), "citation_label", F.lit("."))
        issued = F.coalesce("date", c("year").cast("string"))
        concept = lambda p: iri(self.n(p), F.transform("types", lambda t: F.concat(F.lit(self.site.ns("type")), t)), each=True)
        people = lambda p, role: iri(self.n(p), F.transform(role, lambda x: x["iri"]), each=True)
        number = lambda x: c(x).cast("string")
        language = F.when(c("language").isNotNull(), self.language(c("language")))
        licence = c("licence.url")
        has_pdf = c("pdf.key").isNotNull()
        target = F.coalesce("zenodo_url", "doi_url", "links.link", "links.release", "links.repository")
        node = F.when(has_pdf, own("pdf")).when(target.isNotNull(), own("landing"))
        main = self.view(
            "entry", e, subject, *self.a("dcat:Dataset", "bibo:Document"), self.r("rdf:type", F.concat(F.lit(self.names["fabio"]), "fabio"), begins=self.names["fabio"]), self.tagged("dct:title", c("title"), c("language")), self.tagged("dct:description", F.coalesce(abstract, said), F.when(abstract.isNull(), "en").otherwise(c("language"))),
            self.tagged("bibo:abstract", abstract, c("language")), concept("dct:type"), concept("dcat:theme"), self.r("dcat:inSeries", c("issue_iri")), self.r("dct:isPartOf", c("issue_iri")), self.l("own:entryNumber", c("n"), "xsd:positiveInteger"), self.l("own:citationLabel", c("citation_label")),
            self.l("bibo:locator", F.concat("sigil", number("n"))), self.l("prism:volume", number("volume")), self.l("prism:number", number("issue")), self.r("dcat:landingPage", page), self.r("dct:publisher", F.lit(self.site.ns("org") + self.site.publisher)), self.dated("dct:issued", issued),
            self.r("dct:language", language), self.l("own:languageGuessed", F.when(c("language_guessed") & language.isNotNull(), F.lit(True)), "xsd:boolean"), self.l("bibo:doi", c("doi")), self.l("dct:identifier", c("doi_url")), self.r("owl:sameAs", c("doi_url")), self.r("owl:sameAs", self.wikidata(c("wikidata"))),
            iri(self.n("dct:relation"), F.transform("related_dois", lambda d: F.concat(F.lit(DOI), d)), each=True), self.l("dcat:version", number("version")), self.l("dcat:keyword", c("keywords"), each=True), self.r("dct:license", licence), self.r("prov:wasDerivedFrom", c("zenodo_url")),
            self.r("schema:codeRepository", c("links.repository")), *(self.r("rdfs:seeAlso", c(f"links.{k}")) for k in ("video", "link", "release")), people("dct:creator", "creators"), people("bibo:editor", "editors"), people("dct:contributor", "contributors"), self.r("bibo:authorList", F.when(F.size("creators") > 0, own("authors"))),
            self.r("bibo:presentedAt", c("event_iri")), self.r("dcat:distribution", node),
        )
        file = F.try_element_at(F.filter(F.coalesce("files", F.array()), lambda f: f["key"] == c("pdf.key")), F.lit(1))
        d = e.withColumn("file", file).withColumn("node", node).withColumn("has_pdf", has_pdf).withColumn("target", target).where("node IS NOT NULL")
        pdf = lambda x: F.when(c("has_pdf"), x)
        checksum = pdf(F.when(F.startswith("file.checksum", F.lit("md5:")), F.substring("file.checksum", 5, 1 << 30)))
        media, form = F.lit(self.names["iana"] + "application/pdf"), F.lit(self.names["eufiletype"] + "PDF")
        distribution = self.view(
            "distribution", d, c("node"), *self.a("dcat:Distribution"), self.l("dct:title", pdf(c("pdf.key"))), self.tagged("dct:title", F.when(~c("has_pdf"), LANDING), "en"), self.r("dcat:accessURL", F.when(c("has_pdf"), c("zenodo_url")).otherwise(c("target"))), self.r("dcat:downloadURL", pdf(c("pdf.download"))),
            self.r("dcat:mediaType", pdf(media)), self.r("dct:format", pdf(form)), self.l("dcat:byteSize", pdf(F.when(c("file.size") > 0, c("file.size"))), "xsd:nonNegativeInteger"), self.r("spdx:checksum", F.when(checksum.isNotNull(), own("pdf-checksum"))), self.r("dct:license", licence),
        )
        algorithm = F.lit(self.names["spdx"] + "checksumAlgorithm_md5")
        sums = d.withColumn("sum", checksum).where("sum IS NOT NULL")
        creation = own("creation")
        with_pdf = d.where("has_pdf")
        authors = e.where(F.size("creators") > 0).withColumn("list", own("authors"))
        return [
            main, distribution,
            self.view("issue", e, c("issue_iri"), self.r("dct:hasPart", subject), key=False),
            self.view("authors", authors, c("list"), *self.a("rdf:Seq")),
            Listed("authors", ordered_members(authors, c("list"), F.transform("creators", lambda p: p["iri"])), RDF + "_", MAIN),
            self.view("checksum", sums, own("pdf-checksum"), *self.a("spdx:Checksum"), self.r("spdx:algorithm", algorithm), self.l("spdx:checksumValue", c("sum"), "xsd:hexBinary")),
            self.typed(sums, algorithm, "spdx:ChecksumAlgorithm"), self.typed(e, page, "foaf:Document"), self.typed(e, language, "dct:LinguisticSystem"), self.typed(e, licence, "dct:LicenseDocument"), self.typed(with_pdf, media, "dct:MediaType"), self.typed(with_pdf, form, "dct:MediaTypeOrExtent"),
            # the event-centred view
            self.view("entry", e, subject, *self.a("crm:E73_Information_Object", "lrmoo:F2_Expression"), self.r("crm:P106i_forms_part_of", c("issue_iri")), concept("crm:P2_has_type"), graph=CRM),
            self.view("event", e.where("event_iri IS NOT NULL"), c("event_iri"), self.r("crm:P16_used_specific_object", subject), key=False, graph=CRM),
            self.view("distribution", with_pdf, c("node"), *self.a("crmdig:D1_Digital_Object"), self.r("crm:P165_incorporates", subject), graph=CRM),
            self.view("creation", e, creation, *self.a("crm:E65_Creation", "lrmoo:F28_Expression_Creation"), self.r("crm:P94_has_created", subject), self.r("lrmoo:R17_created", subject), people("crm:P14_carried_out_by", "creators"), graph=CRM),
            *self.symbol(e, subject, "crm:P102_has_title", "title", "crm:E35_Title", c("title")),
            *self.time_span(e, creation, issued, F.lit(None).cast("string")),
            *self.identifier(e, subject, "doi", c("doi")),
        ]

    # the concept scheme
    def types(self, types: DataFrame) -> list[View]:
        c, scheme = F.col, F.lit(self.site.ns("type"))
        node = lambda slug: F.concat(F.lit(self.site.ns("type")), slug)
        one = types.sparkSession.range(1)
        labels = types.select("slug", F.explode("label").alias("lang", "text"))
        top, coar = F.when(c("broader").isNull(), scheme), F.concat(F.lit(COAR), "coar")
        close = F.coalesce(c("match") == "close", F.lit(False))
        return [
            self.view("scheme", one, scheme, *self.a("skos:ConceptScheme"), *(self.tagged("dct:title", text, lang) for lang, text in self.site.type_titles.items()), self.r("dct:license", F.lit(self.site.types_licence or None)), graph=TYPES),
            self.view("scheme", types.where("broader IS NULL"), scheme, self.r("skos:hasTopConcept", node(c("slug"))), key=False, graph=TYPES),
            self.view(
                "concept", types, node(c("slug")), *self.a("skos:Concept", "crm:E55_Type"), self.r("skos:inScheme", scheme), self.l("skos:notation", c("slug")), self.r("skos:broader", node(c("broader"))), self.r("skos:topConceptOf", top), self.r("skos:closeMatch", F.when(close, coar)), self.r("skos:exactMatch", F.when(~close, coar)),
                self.r("rdfs:seeAlso", F.concat(F.lit(self.names["fabio"]), "fabio")), graph=TYPES,
            ),
            self.view("concept", labels, node(c("slug")), self.tagged("skos:prefLabel", c("text"), c("lang")), key=False, graph=TYPES),
            self.view("concept", types.where("broader IS NOT NULL"), node(c("broader")), self.r("skos:narrower", node(c("slug"))), key=False, graph=TYPES),
        ]


def events_of(entries: DataFrame, space: str, days: int = 14) -> tuple[DataFrame, DataFrame]:
    """Events of entries (id, event): (iri, name, start, end, online, place_key), and (id, event_iri).

    Talks of one name in one year that begin within `days` of the first are one event. Its IRI is
    the name's slug with the year; of several that would have the same, later ones have the day."""
    e = F.col("event")
    talks = entries.where(F.length("event.name") > 0).select("id", e["name"].alias("name"), F.coalesce(e["start"], F.lit("")).alias("start"), e["end"].alias("end"), e["online"].alias("online"), e["place"]["key"].alias("place_key"), T.cut_slug(T.slug(e["name"]), 70).alias("slug"))
    talks = talks.withColumn("year", F.substring("start", 1, 4)).withColumn("day", F.when(F.col("start") != "", F.col("start")))
    numbered = anchored_clusters(talks, ["slug", "year"], "day", ["name", "start", "id"], days)
    first = F.struct("name", "start", "id")
    keys = ["slug", "year", "cluster"]
    rolled = numbered.groupBy(*keys).agg(
        F.min(first).alias("first"), F.min(F.nullif("start", F.lit(""))).alias("start"), F.max("end").alias("end"), F.min_by("online", first).alias("online"), F.min_by("place_key", F.when(F.col("place_key").isNotNull(), first)).alias("place_key")
    )
    plain = F.concat(F.lit(space), "slug", F.when((F.col("year") == "") | F.endswith("slug", F.col("year")), F.lit("")).otherwise(F.concat(F.lit("-"), "year")))
    # events that would share an IRI are a handful
    place = F.row_number().over(Window.partitionBy("plain").orderBy("first"))
    named = rolled.withColumn("plain", plain).withColumn("iri", F.when(place == 1, F.col("plain")).otherwise(F.concat(F.lit(space), "slug", F.lit("-"), "first.start")))
    events = named.select("iri", F.col("first.name").alias("name"), "start", "end", "online", "place_key")
    return events, numbered.join(named.select(*keys, F.col("iri").alias("event_iri")), keys).select("id", "event_iri")


def people_of(entries: DataFrame) -> DataFrame:
    """The persons of all roles, each once: (iri, family, given, orcid)."""
    roles = [entries.select(F.explode(role).alias("p")).select("p.iri", "p.family", "p.given", "p.orcid") for role in ("creators", "editors", "contributors")]
    rows = roles[0].unionByName(roles[1]).unionByName(roles[2])
    return rows.groupBy("iri").agg(F.min(F.struct("family", "given", "orcid")).alias("p")).select("iri", "p.*")


def places_of(entries: DataFrame) -> DataFrame:
    """The places of events, each once."""
    rows = entries.where(F.col("event.place.key").isNotNull()).select("event.place.*")
    return rows.groupBy("key").agg(F.min(F.struct("label", "name", "wikidata", "country", "lat", "lon")).alias("p")).select("key", "p.*")


def graph(site: Site, journals: DataFrame, volumes: DataFrame, issues: DataFrame, entries: DataFrame, types: DataFrame, journal: str) -> Graph:
    """The graph of a journal's published records."""
    b = Builder(site)
    out = entries.where(~F.coalesce("draft", F.lit(False)))
    happened, of_event = events_of(out, site.ns("event"))
    editor = journals.select(F.concat(F.lit(site.ns("person")), "editor.orcid").alias("iri"), "editor.family", "editor.given", "editor.orcid")
    people = people_of(out)
    people = people.unionByName(editor.join(people, "iri", "left_anti"))
    views = [*b.journals(journals), *b.volumes(volumes, journal), *b.issues(issues), *b.people(people), *b.places(places_of(out)), *b.events(happened), *b.entries(out, types, of_event), *b.types(types)]
    return Graph([v for v in views if isinstance(v, View)], listed=[v for v in views if isinstance(v, Listed)])
