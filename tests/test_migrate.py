"""From Markdown, BibTeX and publication lines to volumes."""

from pyspark.sql import functions as F

from lodestone.operators import migrate
from lodestone.sources import readers, records

VOLUME = """# Volume
### Issue 1
**#1 [`Talk`] Maps of old**
* **Authors**: [![ORCID ID](i)](https://orcid.org/0000-0001-0002-0003)
* **DOI**: [10.5281/zenodo..11](https://doi.org/10.5281/zenodo.11)
* **Event**: Map Days (1 May 2018)
* **Location**: Old Hall, Mapton
**#1 [`Poster`] Maps of new**
* **Authors**: A. Berg [![ORCID ID](i)](https://orcid.org/0000-0001-0002-0003); C. Cole
* **DOI**: 10.5281/zenodo.12
### Issue 2
### 2018:(1)3 => SI: Special maps
**λ4 [`Talk`] Third**
* **Authors**: C. Cole; D. Dorn
* **DOI**: 10.5281/zenodo.11
"""
PUBLICATIONS = """## 2018
- ![gb](f) C. Cole (2018). _Third_, Map Days, Mapton, Germany, 14 June 2018. DOI: [10.5281/zenodo.99](x).
- ![de](f) E. Ems (2018). _Ganz neu_, Kartentag, Online, Germany, 3 March 2018.
- ![de](f) E. Ems (2018). _Ganz neu!_, Kartentag, Online, Germany, 3 March 2018.
- ![gb](f) F. Fox (2018). _Something else entirely_, with G. Gnu, Map Days, Mapton, Germany, in spring. DOI: 10.5281/zenodo.12.
"""
BIBTEX = "@inproceedings{k,\n  title = {Maps of new},\n  booktitle = {Proc},\n  pages = {9(9), #9},\n  doi = {10.5281/zenodo.12}\n}\n@misc{z,\n  title = {z},\n  doi = {10.1234/z}\n}\n"


def test_migration(spark, tmp_path):
    for name, text in (("v.md", VOLUME), ("p.md", PUBLICATIONS), ("b.md", BIBTEX), ("w.md", "* Volume 1: Q11\n* V1, I3: Q13\n")):
        (tmp_path / name).write_text(text)
    placed = readers.volume_lines(readers.lines(spark, str(tmp_path / "v.md")))
    entries = records.entries(readers.entries_of(placed)).withColumn("volume", F.lit(1))
    issues = placed.where("what = 'issue'").select(F.lit(1).alias("volume"), "issue", "line", F.col("issue_title").alias("title"))
    blocks = readers.bibtex_blocks(spark.read.text(str(tmp_path / "b.md"), wholetext=True))
    talks = migrate.published(readers.publication_lines(readers.lines(spark, str(tmp_path / "p.md"))), "talk")
    m = migrate.migrate(entries, issues, blocks, talks, readers.identifier_lines(readers.lines(spark, str(tmp_path / "w.md"))), {"talk": "Talk"}, {2018: 2}, spark.createDataFrame([("old-hall-mapton", "Q7")], "key string, wikidata string"))
    (v,) = m.volumes.collect()
    assert v.volume == 1 and v.wikidata == "Q11" and [i.issue for i in v.issues] == [1, 2, 3] and [i.sigil for i in v.issues] == ["#", "#", "λ"] and v.issues[2].wikidata == "Q13" and v.issues[2].title.en == "Special Issue on Special maps" and v.issues[2].special
    one, two = v.issues[0].entries
    assert one.creators[0].name == "A. Berg" and one.creators[0].orcid == "0000-0001-0002-0003" and one.doi == "10.5281/zenodo.11" and one.event.place == "old-hall-mapton" and one.event.start == "2018-05-01" and two.container.title == "Proc"
    (third,) = v.issues[2].entries
    assert third.related_dois == ["10.5281/zenodo.99"] and third.language == "en" and third.event.start == "2018-06-14" and third.types == ["Talk"]
    new = v.issues[1].entries
    assert [(e.n, e.title, e.draft) for e in new] == [(1, "Something else entirely", False), (2, "Ganz neu", True)] and new[1].event.online and new[1].event.place is None and new[0].event.name == "Map Days" and new[0].event.date_text == "in spring"
    assert [(p.key, p.wikidata, p.entries) for p in m.places.collect()] == [("mapton-germany", None, 2), ("old-hall-mapton", "Q7", 1)]
    notes = {(n.where, n.kind) for n in m.notes.collect()}
    assert {("1 1", "duplicate-number"), ("10.5281/zenodo.11", "doi-repeated"), ("10.1234/z", "bibtex-unmatched"), ("10.5281/zenodo.12", "bibtex-pages"), ("p.md:5", "doi-shared-different-title")} <= notes and not any(k == "empty-issue" for _, k in notes)
    texts = spark.createDataFrame([(VOLUME + "see 10.5281/zenodo.77",)], "value string")
    assert [r.doi for r in migrate.lost_dois(texts, m).collect()] == ["10.5281/zenodo.77"]
