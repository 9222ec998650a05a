"""Sinks: canonical Turtle and N-Triples, JSON-LD, canonical JSON, write-if-changed, pruning.

Distributed writers don't promise an order of bytes. Products that must be byte-stable are small
and are written from one sorted stream; everything else is written by Spark.
"""

from __future__ import annotations

import hashlib
import json
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resource(c: Column) -> Column:
    """An IRI in N-Triples form; a blank node as it is."""
    return F.when(F.startswith(c, F.lit("_:")), c).otherwise(F.concat(F.lit("<"), c, F.lit(">")))


def term(o: Column, kind: Column, type_: Column, lang: Column) -> Column:
    """A term in N-Triples form."""
    text = F.replace(F.replace(F.replace(F.replace(o, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit("\t"), F.lit("\\t"))
    text = F.replace(text, F.lit("\r"), F.lit("\\r"))
    plain = (type_ == "") | (type_ == "http://www.w3.org/2001/XMLSchema#string")
    literal = F.concat(F.lit('"'), text, F.lit('"'), F.when(lang != "", F.concat(F.lit("@"), lang)).when(plain, F.lit("")).otherwise(F.concat(F.lit("^^<"), type_, F.lit(">"))))
    return F.when(kind == "iri", resource(o)).otherwise(literal)


def ntriples(triples: DataFrame) -> DataFrame:
    """(value): sorted N-Triples lines."""
    o = term(F.col("o"), F.col("o_kind"), F.coalesce("o_type", F.lit("")), F.coalesce("o_lang", F.lit("")))
    return triples.select(F.concat(resource(F.col("s")), F.lit(" <"), "p", F.lit("> "), o, F.lit(" .")).alias("value")).distinct().orderBy("value")


def turtle_terms(triples: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """(s, p, subject, predicate, object): a set of triples with their terms as Turtle writes them."""
    return as_turtle(triples, prefixes).distinct()


def as_turtle(triples: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """The same for a bag of triples."""
    from ..functions.text import short_iri

    def short(c: Column) -> Column:
        s = short_iri(c, prefixes)
        return F.when((s != c) & s.rlike(r"^[\w-]*:[\w-]*$"), s).otherwise(resource(c))

    o = F.when(F.col("o_kind") == "iri", short(F.col("o"))).otherwise(term(F.col("o"), F.col("o_kind"), F.coalesce("o_type", F.lit("")), F.coalesce("o_lang", F.lit(""))))
    return triples.select("s", "p", short(F.col("s")).alias("subject"), short(F.col("p")).alias("predicate"), o.alias("object"))


def canonical_turtle(triples: DataFrame, prefixes: dict[str, str]) -> str:
    """Turtle with fixed prefixes and sorted triples, for a small graph: the same set gives the same bytes, whatever its blank nodes are called. For larger ones there is formats.write_turtle."""
    from ..operators import blanks
    from ..plans.shared import stored

    po = turtle_terms(blanks.canonical(stored(triples.select(*blanks.COLUMNS), "graph")), prefixes)
    nodes = po.groupBy("s", "subject").agg(F.array_sort(F.collect_list(F.struct("p", "predicate", "object"))).alias("xs"))
    body = nodes.select("s", F.concat("subject", F.lit(" "), F.array_join(F.transform("xs", lambda x: F.concat(x["predicate"], F.lit(" "), x["object"])), " ;\n    "), F.lit(" .\n")).alias("value"))
    head = "".join(f"@prefix {k}: <{v}> .\n" for k, v in sorted(prefixes.items()))
    return head + "\n" + "\n".join(r.value for r in body.orderBy("s").toLocalIterator())


def jsonld(triples: DataFrame) -> DataFrame:
    """(s, node): a JSON-LD node for each subject, values sorted."""
    rdf_type = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
    iri = F.col("o_kind") == "iri"
    value = F.struct(F.when(iri, F.col("o")).alias("@id"), F.when(~iri, F.col("o")).alias("@value"), F.when(~iri & (F.col("o_lang") != ""), F.col("o_lang")).alias("@language"), F.when(~iri & (F.col("o_lang") == "") & ~F.col("o_type").isin("", "http://www.w3.org/2001/XMLSchema#string"), F.col("o_type")).alias("@type"))
    types = triples.where(F.col("p") == rdf_type).groupBy("s").agg(F.sort_array(F.collect_set("o")).alias("t"))
    values = triples.where(F.col("p") != rdf_type).groupBy("s", "p").agg(F.sort_array(F.collect_set(value)).alias("vs"))
    parts = values.groupBy("s").agg(F.array_sort(F.collect_list(F.concat(F.to_json(F.array("p")), F.lit(":"), F.to_json("vs")))).alias("ps"))
    # a key is the text of a one-element array without its brackets
    pairs = F.transform(F.coalesce("ps", F.array()), lambda x: F.regexp_replace(x, r'^\["(.*?)"\]:', '"$1":'))
    head = F.array_compact(F.array(F.concat(F.lit('"@id":'), F.regexp_replace(F.to_json(F.array("s")), r"^\[|\]$", "")), F.concat(F.lit('"@type":'), F.to_json("t"))))
    return parts.join(types, "s", "full_outer").select("s", F.concat(F.lit("{"), F.array_join(F.concat(head, pairs), ","), F.lit("}")).alias("node"))


def canonical_json(value: object) -> str:
    """Sorted keys, UTF-8, one newline at the end."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, indent=1) + "\n"


def script_json(value: object) -> str:
    """JSON for a script element: no character of it can end the element."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True).translate({ord(c): f"\\u{ord(c):04x}" for c in "<>&"})


_PLAIN_YAML = re.compile(r"[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ0-9 _./()+-]*[A-Za-zÀ-ÿ0-9_./()+-]|[A-Za-zÀ-ÿ]")
#: Words that YAML readers take for something else than text.
_NO_TEXT = {"true", "false", "yes", "no", "on", "off", "null", "y", "n"}


def yaml_text(value: object, depth: int = 0) -> str:
    """YAML of nested dicts, lists and scalars with the keys in their order; texts of several lines are blocks."""
    pad = "  " * depth
    if isinstance(value, dict) and value:
        out = []
        for k, v in value.items():
            nested = isinstance(v, (dict, list)) and v
            out.append(f"{pad}{_yaml_scalar(str(k), depth)}:" + ("\n" + yaml_text(v, depth + 1) if nested else f" {_yaml_scalar(v, depth + 1)}\n"))
        return "".join(out)
    if isinstance(value, list) and value:
        out = []
        for v in value:
            if isinstance(v, (dict, list)) and v:
                out.append(f"{pad}- " + yaml_text(v, depth + 1)[2 * (depth + 1) :])
            else:
                out.append(f"{pad}- {_yaml_scalar(v, depth + 1)}\n")
        return "".join(out)
    return f"{pad}{_yaml_scalar(value, depth)}\n"


def _yaml_scalar(v: object, depth: int) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, (dict, list)):
        return "{}" if isinstance(v, dict) else "[]"
    text = str(v)
    if "\n" in text and text.strip() == text and all(line == line.rstrip() and "\t" not in line for line in text.split("\n")) and text.isprintable() is False and all(c.isprintable() or c == "\n" for c in text):
        pad = "  " * depth
        return "|-\n" + "\n".join(pad + line if line else "" for line in text.split("\n"))
    if _PLAIN_YAML.fullmatch(text) and text.lower() not in _NO_TEXT:
        return text
    return json.dumps(text, ensure_ascii=False)


def write_yaml(path: Path, value: object) -> bool:
    """A YAML file, written if its bytes change."""
    return write_if_changed(path, yaml_text(value).encode())


def write_if_changed(path: Path, data: bytes) -> bool:
    """Write unless the file has these bytes already; sizes are compared first."""
    path = Path(path)
    if path.is_file() and path.stat().st_size == len(data) and path.read_bytes() == data:
        return False
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)
    return True


def prune(root: Path, produced: set[Path], pattern: str) -> list[Path]:
    """Remove files of one kind that weren't produced this time; returns them."""
    gone = sorted(p for p in Path(root).rglob(pattern) if p.is_file() and p not in produced)
    for p in gone:
        p.unlink()
    return gone


def fingerprint(paths: list[Path]) -> str:
    """sha256 over the names and contents of files in the order of their names."""
    h = hashlib.sha256()
    for p in sorted(map(Path, paths)):
        h.update(str(p).encode() + b"\0" + hashlib.sha256(p.read_bytes()).digest())
    return h.hexdigest()


def write_subgraphs(triples: DataFrame, path: str) -> None:
    """N-Triples partitioned by the resource that a subject belongs to."""
    o = term(F.col("o"), F.col("o_kind"), F.coalesce("o_type", F.lit("")), F.coalesce("o_lang", F.lit("")))
    lines = triples.select(F.substring_index("s", "#", 1).alias("resource"), F.concat(resource(F.col("s")), F.lit(" <"), "p", F.lit("> "), o, F.lit(" .")).alias("value")).distinct()
    lines.repartition("resource").sortWithinPartitions("resource", "value").write.partitionBy("resource").mode("overwrite").text(path)


def feature_collection(features: DataFrame, variable: str | None = None) -> str:
    """Features (JSON texts, in order) as one GeoJSON collection, or as a script that sets a variable. For a map, so small."""
    body = '{"type":"FeatureCollection","features":[' + ",\n".join(r.feature for r in features.toLocalIterator()) + "]}"
    return f"window.{variable} = {body};\n" if variable else body + "\n"


def query_text(title: str, intro: str, prefixes: dict[str, str], sparql: str) -> str:
    """A query as a text of its own: title and introduction as comments, its prefixes, the query."""
    import textwrap

    used = {k: v for k, v in prefixes.items() if f"{k}:" in sparql}
    head = [f"# {title}", *(f"# {line}" for line in textwrap.wrap(intro, 76))]
    return "\n".join([*head, "", *(f"PREFIX {k}: <{v}>" for k, v in sorted(used.items())), "", sparql.strip(), ""])


def report(title: str, tables: dict[str, DataFrame], most: int = 500) -> str:
    """A Markdown report of small tables; of longer ones the first rows and their number."""
    out = [f"# {title}", ""]
    for name, df in tables.items():
        rows, n = df.limit(most).collect(), df.count()
        out += [f"## {name} ({n})", "", "| " + " | ".join(df.columns) + " |", "|" + "-|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|").replace("\n", " ") for v in r) + " |" for r in rows]
        out += ["" if n <= most else f"\n{n - most} more.\n"]
    return "\n".join(out)


def sync_tree(source: Path, target: Path, pattern: str = "*") -> list[Path]:
    """Copy a folder's files where they differ and remove what the source doesn't have; returns what the target then holds."""
    source, target = Path(source), Path(target)
    made = []
    for p in sorted(source.rglob(pattern)):
        if p.is_file():
            out = target / p.relative_to(source)
            write_if_changed(out, p.read_bytes())
            made.append(out)
    prune(target, set(made), pattern)
    return made
