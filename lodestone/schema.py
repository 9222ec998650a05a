"""Schemas of the entities; none is inferred."""

TRIPLES = "graph string, s string, p string, o string, o_kind string, o_type string, o_lang string"
PERSON = "struct<name:string,orcid:string>"
EVENT = "struct<name:string,start:string,end:string,date_text:string,session:string,location:string,place:string,online:boolean>"
ENTRY = (
    f"n int, types array<string>, title string, creators array<{PERSON}>, et_al boolean, doi string, related_dois array<string>, language string, date string, version string, release_label string, "
    f"event {EVENT}, editors array<{PERSON}>, contributors array<{PERSON}>, container struct<bibtex_type:string,title:string,editors:array<struct<name:string>>,publisher:string,place:string>, "
    "wikidata string, isbn string, links struct<link:string,repository:string,release:string,video:string,zenodo_community:string>, context string, notes array<string>, legacy_citation string, draft boolean, `from` string"
)
RECORD = (
    "id long, conceptdoi string, doi string, files array<struct<key:string,size:long,checksum:string>>, "
    "metadata struct<title:string,description:string,publication_date:string,language:string,version:string,keywords:array<string>,license:struct<id:string>,"
    "resource_type:struct<type:string,subtype:string,title:string>,creators:array<struct<name:string,orcid:string,affiliation:string>>>"
)
PLACE_ITEM = "id string, labels map<string,string>, descriptions map<string,string>, country array<string>, country_current array<string>, instance_of array<string>, coordinates struct<lat:double,lon:double>"
SEARCH_ANSWER = "label string, terms array<string>, answers map<string,array<struct<id:string,label:string,description:string>>>"
CONCEPT = "slug string, label struct<en:string,de:string>, aliases array<string>, zenodo array<string>, coar string, fabio string, match string, broader string"
RESULT = "focus string, path string, severity string, message string, value string"
FACET_RECORD = "path string, label string, title string, sort array<int>, authors array<string>, date string, facets map<string,array<string>>, text string"
