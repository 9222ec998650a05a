"""Sources: JSON, YAML, N-Triples and Turtle, line-oriented Markdown, BibTeX."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema
from ..functions.text import collapse, normalise_doi
from .turtle import turtle


def read_json(spark: SparkSession, path: str, ddl: str, key: str | None = None) -> DataFrame:
    """Whole-file JSON documents under a declared schema; `key` names a column for the file's name without ending."""
    df = spark.read.schema(ddl).option("multiLine", True).json(path)
    return df.withColumn(key, F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.[^.]*$", 1)) if key else df


def archive_files(files: Column) -> Column:
    """Files of a record as an array, whether they were stored as a list or as {"entries": {...}} (JSON text)."""
    item = "struct<key:string,size:bigint,checksum:string>"
    listed = F.from_json(files, f"array<{item}>")
    mapped = F.map_values(F.from_json(files, f"struct<entries:map<string,{item}>>")["entries"])
    return F.when(F.startswith(F.trim(files), F.lit("[")), listed).otherwise(mapped)


def read_yaml(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """YAML files, one document each: whole texts, turned into JSON on the executors and read under a declared schema."""

    def turn(batches: Iterator) -> Iterator:
        import pyarrow as pa

        try:
            import yaml
        except ImportError:
            yaml = None
        load = (lambda t: yaml.safe_load(t)) if yaml else plain_yaml
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([json.dumps(load(x), default=str) for x in b.column(1).to_pylist()])], names=["path", "json"])

    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return whole.mapInArrow(turn, "path string, json string").select("path", F.from_json("json", ddl).alias("doc")).select("path", "doc.*")


# --- a small YAML: block maps and lists, flow lists and maps, quoted and plain scalars, | and > blocks
def _scalar(text: str):
    text = text.strip()
    if not text:
        return None
    if text[0] in "\"'" and text[-1:] == text[:1] and len(text) > 1:
        return json.loads(text) if text[0] == '"' else text[1:-1].replace("''", "'")
    if text[0] in "[{":
        return _flow(text)
    if text in ("~", "null"):
        return None
    if text in ("true", "false"):
        return text == "true"
    if re.fullmatch(r"[-+]?(0|[1-9][0-9]*)", text):
        return int(text)
    if re.fullmatch(r"[-+]?[0-9]+\.[0-9]*(e[-+]?[0-9]+)?", text):
        return float(text)
    return text


def _flow(text: str):
    body, out, depth, quote, at = text[1:-1], [], 0, "", 0
    for i, c in enumerate(body + ","):
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'" and not body[at:i].strip():
            quote = c
        elif c in "[{":
            depth += 1
        elif c in "]}":
            depth -= 1
        elif c == "," and depth == 0:
            if part := body[at:i].strip():
                out.append(part)
            at = i + 1
    if text[0] == "[":
        return [_scalar(p) for p in out]
    return {str(_scalar(k)): _scalar(v) for k, _, v in (p.partition(":") for p in out)}


def plain_yaml(text: str):
    """The subset of YAML that curated records use; for where no YAML library is installed."""
    lines = []
    for raw in text.split("\n"):
        bare = raw.rstrip()
        lines.append((len(bare) - len(bare.lstrip()), bare.lstrip(), raw))
    at = 0

    def uncommented(s: str) -> str:
        if s and s[0] in "\"'":
            end = s.find(s[0], 1)
            while end > 0 and s[0] == '"' and s[end - 1] == "\\":
                end = s.find(s[0], end + 1)
            return s[: end + 1] + re.sub(r"\s+#.*$", "", s[end + 1 :])
        return re.sub(r"(^|\s)#.*$", "", s).rstrip()

    def skip() -> None:
        nonlocal at
        while at < len(lines) and (not lines[at][1] or lines[at][1].startswith("#") or lines[at][1] == "---"):
            at += 1

    def block(indent: int, style: str) -> str:
        nonlocal at
        rows = []
        while at < len(lines) and (not lines[at][1] or lines[at][0] > indent):
            rows.append(lines[at][2].rstrip())
            at += 1
        while rows and not rows[-1]:
            rows.pop()
        cut = min((len(r) - len(r.lstrip()) for r in rows if r), default=0)
        rows = [r[cut:] for r in rows]
        out = "\n".join(rows) if style[0] == "|" else re.sub(r"(?<!\n)\n(?!\n)", " ", "\n".join(rows)).replace("\n\n", "\n")
        return out + ("" if style.endswith("-") else "\n")

    def value(indent: int, rest: str):
        nonlocal at
        rest = uncommented(rest)
        if re.fullmatch(r"[|>][-+]?", rest):
            return block(indent, rest)
        if rest:
            while rest[0] in "[{" and rest.count("[") + rest.count("{") > rest.count("]") + rest.count("}") and at < len(lines):
                rest += " " + uncommented(lines[at][1])
                at += 1
            if rest[0] not in "[{\"'":  # a plain scalar may go on
                while at < len(lines) and lines[at][1] and lines[at][0] > indent and not re.match(r"(- |[^\s:]+:(\s|$))", lines[at][1]):
                    rest += " " + uncommented(lines[at][1])
                    at += 1
            return _scalar(rest)
        skip()
        if at < len(lines) and (lines[at][0] > indent or lines[at][0] == indent and lines[at][1].startswith("- ")):
            return node(lines[at][0])
        return None

    def node(indent: int):
        nonlocal at
        out: list | dict | None = None
        while True:
            skip()
            if at >= len(lines) or lines[at][0] < indent:
                return out
            here, body, _ = lines[at]
            if body.startswith("- ") or body == "-":
                if isinstance(out, dict) or here != indent:
                    return out
                out = [] if out is None else out
                item = body[2:]
                if re.match(r"[^\s\"'\[{][^:]*:(\s|$)", item):  # a map begins on the line of its dash
                    lines[at] = (here + 2, item, " " * (here + 2) + item)
                    out.append(node(here + 2))
                else:
                    at += 1
                    out.append(value(here, item))
            else:
                m = re.match(r"(\"[^\"]*\"|'[^']*'|[^:]+?)\s*:(?:\s+(.*))?$", body)
                if not m or here != indent:
                    return out
                out = {} if out is None else out
                at += 1
                out[str(_scalar(m[1]))] = value(here, m[2] or "")

    skip()
    return node(lines[at][0]) if at < len(lines) else None


def numbered_order(path: Column) -> Column:
    """Sort key of files like vol2, vol10: the number before the name."""
    return F.struct(F.regexp_extract(path, r"([0-9]+)[^0-9]*$", 1).try_cast("long").alias("number"), path.alias("path"))


# --- triples ------------------------------------------------------------------------------
def read_ntriples(spark: SparkSession, path: str, graph: str = "") -> DataFrame:
    """N-Triples, a line each; lines that are no triple are refused. Blank nodes are named by their document: a file, or a folder of parts that Spark wrote."""
    node = r"(?:<([^>]*)>|(_:[\p{L}\p{N}_](?:[\p{L}\p{N}_.\-]*[\p{L}\p{N}_\-])?))"
    pattern = rf'^\s*{node}\s+<([^>]*)>\s+(?:{node}|"((?:[^"\\]|\\.)*)"(?:@([A-Za-z0-9-]+)|\^\^<([^>]*)>)?)\s*\.\s*$'
    document = F.substring(F.sha2(F.regexp_replace("_metadata.file_path", "/part-[^/]*$", ""), 256), 1, 12)
    lines = spark.read.text(path).select("value", document.alias("document")).where(~F.col("value").rlike(r"^\s*(#.*)?$"))
    g = lambda k: F.regexp_extract("value", pattern, k)
    checked = lines.withColumn("value", F.when(F.col("value").rlike(pattern), F.col("value")).otherwise(F.raise_error(F.concat(F.lit("no triple: "), "value")).cast("string")))
    named = lambda k: F.when(g(k) != "", F.concat(F.lit("_:"), "document", F.lit("."), F.substr(g(k), F.lit(3))))
    blank, iri = g(5) != "", (g(4) != "") | (g(5) != "")
    mark = F.lit("\0")  # an escaped backslash is no beginning of another escape
    text = F.replace(g(6), F.lit("\\\\"), mark)
    for written, meant in (("\\n", "\n"), ("\\t", "\t"), ("\\r", "\r"), ('\\"', '"')):
        text = F.replace(text, F.lit(written), F.lit(meant))
    text = F.replace(text, mark, F.lit("\\"))
    lang = F.lower(g(7))
    kind = F.when(lang != "", "http://www.w3.org/1999/02/22-rdf-syntax-ns#langString").when(g(8) != "", g(8)).otherwise("http://www.w3.org/2001/XMLSchema#string")
    return checked.select(
        F.lit(graph).alias("graph"), F.coalesce(named(2), g(1)).alias("s"), g(3).alias("p"), F.when(blank, named(5)).when(iri, g(4)).otherwise(text).alias("o"), F.when(iri, "iri").otherwise("literal").alias("o_kind"),
        F.when(iri, "").otherwise(kind).alias("o_type"), F.when(iri, "").otherwise(lang).alias("o_lang"),
    ).distinct()


def read_turtle(spark: SparkSession, path: str, graph: str = "") -> DataFrame:
    """Turtle files to one set of triples; files are parsed on the executors, and blank nodes are named by the file."""

    def parse(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            rows = []
            for path_, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = hashlib.sha256(path_.encode()).hexdigest()[:12]
                named = lambda x, own=own: f"_:{own}.{x[2:]}" if x.startswith("_:") else x
                rows += [(named(s), p, named(o) if kind == "iri" else o, kind, *more) for s, p, o, kind, *more in turtle(text)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=["s", "p", "o", "o_kind", "o_type", "o_lang"])

    made = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value").mapInArrow(parse, schema.TRIPLES.replace("graph string, ", ""))
    return made.select(F.lit(graph).alias("graph"), "*").distinct()


# --- text ---------------------------------------------------------------------------------
def lines(spark: SparkSession, path: str) -> DataFrame:
    """(source, line, text) of text files."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("source"), F.split("value", "\r?\n").alias("ls"))
    return whole.select("source", F.posexplode("ls").alias("line", "text")).withColumn("line", F.col("line") + 1)


def bibtex_blocks(text: DataFrame, column: str = "value") -> DataFrame:
    """BibTeX blocks with a DOI -> (doi, type, fields: map)."""
    blocks = text.select(F.explode(F.regexp_extract_all(column, F.lit(r"(@[A-Za-z0-9_]+\{[^,]+,(?s:.*?)\n\})"), 1)).alias("b"))
    names = F.regexp_extract_all("b", F.lit(r"(?m)^\s*(\w+)\s*=\s*\{(.*)\},?\s*$"), 1)
    values = F.regexp_extract_all("b", F.lit(r"(?m)^\s*(\w+)\s*=\s*\{(.*)\},?\s*$"), 2)
    pairs = F.zip_with(names, values, lambda n, v: F.struct(F.lower(n).alias("k"), F.trim(F.regexp_replace(v, "[{}]", "")).alias("v")))
    # of a field written twice the last counts
    fields = F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda acc, p: F.map_concat(F.map_filter(acc, lambda k, v: k != p["k"]), F.create_map(p["k"], p["v"])))
    out = blocks.select(F.lower(F.regexp_extract("b", r"^@(\w+)", 1)).alias("type"), fields.alias("fields"))
    return out.where(F.try_element_at("fields", F.lit("doi")).isNotNull()).select(normalise_doi(F.col("fields")["doi"]).alias("doi"), "type", "fields")


def identifier_lines(rows: DataFrame) -> DataFrame:
    """Lookup lines "Volume 4: Q1" and "V4, I2: Q2" -> (volume, issue, item)."""
    v, i = r"Volume\s+([0-9]+):\s*(Q[0-9]+)", r"V([0-9]+),\s*I([0-9]+):\s*(Q[0-9]+)"
    t = F.col("text")
    volumes = rows.where(t.rlike(v)).select(F.regexp_extract(t, v, 1).cast("int").alias("volume"), F.lit(None).cast("int").alias("issue"), F.regexp_extract(t, v, 2).alias("item"))
    return volumes.unionByName(rows.where(t.rlike(i)).select(F.regexp_extract(t, i, 1).cast("int").alias("volume"), F.regexp_extract(t, i, 2).cast("int").alias("issue"), F.regexp_extract(t, i, 3).alias("item")))


# Fixed values, the format of a volume's Markdown: signs before an entry's number; the lines that
# begin an entry, an issue and a field; fields without marks; badges.
SIGILS = "#λ§𝒬"
_HEAD = rf"^(?:[>*\-]\s*)*\**\s*([{SIGILS}])([0-9]+)\s+(.*)$"
_ISSUE = r"^###\s+(?:Issue\s+([0-9]+)|([0-9]{4}):\(([0-9]+)\)([0-9]+)\s*(?:=>\s*SI:\s*(.+?))?)\s*$"
_FIELD = r"^[*-]\s+\*\*`?([A-Za-z][A-Za-z /-]*?)`?\*\*:?\s*(.*)$"
_BADGE = r"!\[[^\]]*\]\(https://img\.shields\.io/badge/([A-Z]+)-([^)]*?)-[a-z]+\)"
_PLAIN = r"(?i)^[*-]\s+(DOI|Wikidata|ISBN|Link)\s*:\s*(.*)$"


def volume_lines(rows: DataFrame) -> DataFrame:
    """Lines (source, line, text) of a volume's Markdown with their context.

    Adds issue and its title, entry (sigil and number), title, labels, language and what the line
    is: issue, head, field (name, value), quote, plain. The reader's state, the current issue and
    entry, is the last header before a line: a forward fill over each source.
    """
    t = F.trim("text")
    w = Window.partitionBy("source").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    issue = F.when(t.rlike(_ISSUE), F.coalesce(F.regexp_extract(t, _ISSUE, 1).try_cast("int"), F.regexp_extract(t, _ISSUE, 4).try_cast("int")))
    head = t.rlike(_HEAD) & t.rlike(r"^(?:\*\*|#|>|\* \*\*)") & ~F.contains(t, F.lit("Authors")) & issue.isNull()
    close = issue.isNotNull() | t.rlike("^##? ")
    marked = rows.withColumn("t", t).withColumn("at_issue", issue).withColumn("is_head", head).withColumn("closes", close)
    placed = marked.withColumn("issue", F.last("at_issue", True).over(w)).withColumn("entry_line", F.last(F.when(F.col("is_head"), F.col("line")).when(F.col("closes"), F.lit(-1)), True).over(w))
    rest = F.regexp_replace(F.replace(F.regexp_extract("t", _HEAD, 3), F.lit("<br>"), F.lit(" ")), r"\*\*\s*$", "")
    kinds, values = F.regexp_extract_all(rest, F.lit(_BADGE), 1), F.regexp_extract_all(rest, F.lit(_BADGE), 2)
    badges = F.zip_with(kinds, values, lambda k, v: F.struct(k.alias("k"), F.translate(F.replace(v, F.lit("%20"), F.lit(" ")), "_", " ").alias("v")))
    bare = F.trim(F.regexp_replace(rest, r"!\[[^\]]*\]\(https://img\.shields\.io/[^)]*\)\s*", ""))
    tags = F.regexp_extract(bare, r"^((?:\[`?[^\]`]+`?\]\s*)*)", 1)
    labels = F.concat(F.transform(F.filter(badges, lambda b: b["k"] == "TYPE"), lambda b: b["v"]), F.transform(F.regexp_extract_all(tags, F.lit(r"\[`?([^\]`]+)`?\]"), 1), lambda x: F.trim(x)))
    language = F.lower(F.try_element_at(F.transform(F.filter(badges, lambda b: b["k"] == "LANGUAGE"), lambda b: b["v"]), F.lit(1)))
    title = collapse(F.replace(F.regexp_replace(bare, r"^(?:\[`?[^\]`]+`?\]\s*)*", ""), F.lit("**"), F.lit("")))
    what = (
        F.when(F.col("at_issue").isNotNull(), "issue").when(F.col("is_head"), "head").when(F.col("closes"), "section").when((F.col("entry_line") > 0) & F.startswith("t", F.lit(">")), "quote")
        .when((F.col("entry_line") > 0) & (F.col("t").rlike(_FIELD) | F.col("t").rlike(_PLAIN)), "field").when((F.col("entry_line") > 0) & (F.col("t") != ""), "plain")
    )
    is_head = F.col("is_head")
    own = F.col("t").rlike(_FIELD)
    return placed.select(
        "source", "line", "issue", F.when(F.col("entry_line") > 0, F.col("entry_line")).alias("entry_line"), what.alias("what"), F.when(is_head, F.regexp_extract("t", _HEAD, 1)).alias("sigil"),
        F.when(is_head, F.regexp_extract("t", _HEAD, 2).cast("int")).alias("n"), F.when(is_head, labels).alias("labels"), F.when(is_head, F.coalesce(F.when(language == "german", "de").when(language == "english", "en"), language)).alias("language"),
        F.when(is_head, title).alias("title"), F.when(what == "field", F.lower(F.trim(F.when(own, F.regexp_extract("t", _FIELD, 1)).otherwise(F.regexp_extract("t", _PLAIN, 1))))).alias("field"),
        F.when(what == "field", F.trim(F.when(own, F.regexp_extract("t", _FIELD, 2)).otherwise(F.regexp_extract("t", _PLAIN, 2)))).when(what == "quote", F.trim(F.regexp_replace("t", "^[> ]+", ""))).when(what == "plain", F.regexp_replace("t", r"^[*-]\s+", "")).alias("value"),
        F.when(F.col("t").rlike(_ISSUE) & (F.regexp_extract("t", _ISSUE, 5) != ""), F.concat(F.lit("Special Issue on "), F.trim(F.regexp_extract("t", _ISSUE, 5)))).alias("issue_title"),
    )


def entries_of(placed: DataFrame) -> DataFrame:
    """volume_lines() gathered by entry: (source, issue, line, sigil, n, title, labels, language, fields: map, plain, quotes)."""
    inside = placed.where("entry_line IS NOT NULL")
    fields = F.array_sort(F.collect_list(F.when(F.col("what") == "field", F.struct("line", "field", "value"))))
    text = lambda kind: F.transform(F.array_sort(F.collect_list(F.when((F.col("what") == kind) & (F.col("value") != ""), F.struct("line", "value")))), lambda x: x["value"])
    first = lambda c: F.first(c, True).alias(c)
    grouped = inside.groupBy("source", "issue", F.col("entry_line").alias("line")).agg(*map(first, ("sigil", "n", "title", "labels", "language")), fields.alias("fs"), text("plain").alias("plain"), text("quote").alias("quotes"))
    # of a field that repeats the first counts
    unique = F.aggregate("fs", F.create_map().cast("map<string,string>"), lambda acc, f: F.when(F.map_contains_key(acc, f["field"]), acc).otherwise(F.map_concat(acc, F.create_map(f["field"], f["value"]))))
    return grouped.select("source", "issue", "line", "sigil", "n", "title", "labels", "language", unique.alias("fields"), "plain", "quotes")


# Fixed value, the format of a publication line: "- ![flag](picture) authors (year). _title_, rest".
_PUBLICATION = r"^-\s+!\[([a-z]{2})\]\([^)]*\)\s*(.+?)\s*\(([0-9]{4})\)\.?\s*(.*)$"


def publication_lines(rows: DataFrame, until_year: int = 2019) -> DataFrame:
    """One-line publications under "## year" headers, up to a year -> (source, line, year, flag, authors, title, tail, doi_text)."""
    w = Window.partitionBy("source").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = F.trim("text")
    years = rows.withColumn("t", t).withColumn("year", F.last(F.nullif(F.regexp_extract("t", r"^##\s+([0-9]{4})", 1), F.lit("")).cast("int"), True).over(w))
    found = years.where((F.col("year") <= until_year) & F.col("t").rlike(_PUBLICATION)).select("source", "line", "year", *[F.regexp_extract("t", _PUBLICATION, k).alias(n) for k, n in ((1, "flag"), (2, "authors"), (4, "rest"))])
    body = F.regexp_replace("rest", r"DOI:.*$", "")
    title = F.array_join(F.transform(F.regexp_extract_all(body, F.lit("_([^_]+)_"), 1), lambda x: F.regexp_replace(F.trim(x), ",+$", "")), " ")
    tail = F.regexp_replace(F.regexp_replace(body, "^.*_[^_]+_", ""), r"^[ ,.]+|[ ,.]+$", "")
    return found.select("source", "line", "year", F.when(F.col("flag") == "gb", "en").otherwise(F.col("flag")).alias("language"), "authors", title.alias("title"), tail.alias("tail"), F.nullif(F.regexp_extract("rest", r"DOI:\s*(.*)$", 1), F.lit("")).alias("doi_text"))
