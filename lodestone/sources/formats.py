"""Data sources for graphs (Turtle, N-Triples) and YAML: spark.read.format("lodestone_graph"), format("lodestone_yaml").

Call `register(spark)` first. Partitions are planned by bytes: small files are packed, N-Triples files are
cut at lines, Turtle and YAML files stay whole, as their beginning is needed to read their end. Tests for
equal s, p, o or graph (=, IN) are pushed into the source, which drops other triples before they reach
Spark and doesn't even parse most N-Triples lines of other predicates.

Read triples are a bag: a triple that a file, or several, state twice comes as often. Blank nodes belong
to a file, or to a folder of parts. Files whose names begin with "_" or "." are left out; a missing path
is an error, an empty folder gives no rows.

`write_turtle` writes canonical Turtle in a fixed number of files, dealt by the subject's resource and
sorted inside: the same set of triples gives the same bytes in each file, however it was partitioned.
Tasks write under names of their own and the driver moves these (as many as there are files) when all are done,
so a repeated task does no harm.

A path without a scheme belongs to Hadoop's default file system, as for Spark's own readers, if it goes
through `read` and `write_turtle`.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage

from ..plans.shared import is_shared
from ..schema import TRIPLES

#: Bytes of files that a partition reads, and rows of a batch that it sends.
PARTITION_BYTES, BATCH_ROWS = 64 << 20, 10_000
_COLUMNS = ["graph", "s", "p", "o", "o_kind", "o_type", "o_lang"]
_LINES = (".nt", ".ntriples", ".txt")


def register(spark: SparkSession) -> None:
    """Make both formats known to the session and allow filters to be pushed to them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (GraphFiles, YamlFiles):
        spark.dataSource.register(source)


def qualified(spark: SparkSession, path: str) -> str:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    if out.startswith("file:") and not path.startswith("file:") and not spark.sparkContext.master.startswith("local") and not is_shared(spark, path):
        raise ValueError(f"{path} is local to each machine; name a folder that all executors share")
    return out


def _store(path: str):
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


@dataclass
class Pieces(InputPartition):
    """(file, first byte, byte behind the last, whole?) that one task reads."""

    files: list[tuple[str, int, int, bool]]


def planned(files: list[tuple[str, int]], most: int, lines: tuple[str, ...] = _LINES) -> list[Pieces]:
    """Files (path, bytes) as partitions of about `most` bytes."""
    out, now, size = [], [], 0
    for path, n in sorted(files):
        cuts = range(0, n, most) if path.endswith(lines) and n > most else [0]
        for start in cuts:
            end = min(n, start + most) if len(cuts) > 1 else n
            if now and size + end - start > most:
                out.append(Pieces(now))
                now, size = [], 0
            now.append((path, start, end, len(cuts) == 1))
            size += end - start
    return [*out, Pieces(now)] if now else out


def _listed(path: str) -> list[tuple[str, int]]:
    from pyarrow import fs

    store, at = _store(path)
    info = store.get_file_info(at)
    if info.type == fs.FileType.File:
        return [(at, info.size)]
    if info.type != fs.FileType.Directory:
        raise FileNotFoundError(path)
    inner = lambda f: f.path[len(at) :].strip("/").split("/")
    found = store.get_file_info(fs.FileSelector(at, recursive=True))
    return [(f.path, f.size) for f in found if f.type == fs.FileType.File and not any(x[0] in "_." for x in inner(f))]


def line_blocks(file, start: int, end: int, block: int = 1 << 20) -> Iterator[list[bytes]]:
    """Lines that begin in bytes start to end of an open file, a block at a time."""
    file.seek(max(start - 1, 0))
    at, rest, skipping = max(start - 1, 0), b"", start > 0
    while at < end or rest or skipping:
        data = file.read(block)
        if not data:
            if rest and not skipping:
                yield [rest]
            return
        if skipping:
            cut = data.find(b"\n")
            at += len(data) if cut < 0 else cut + 1
            if cut < 0:
                continue
            data, skipping = data[cut + 1 :], False
            if at >= end:
                return
        data, begin = rest + data, at
        *whole, rest = data.split(b"\n")
        out = []
        for line in whole:
            if begin >= end:
                break
            out.append(line)
            begin += len(line) + 1
        at = begin
        if out:
            yield out
        if at >= end:
            return


class _Reader(DataSourceReader):
    lines: tuple[str, ...] = ()

    def __init__(self, options: dict):
        self.path, self.most = options["path"], int(options.get("partition_bytes", PARTITION_BYTES))

    def partitions(self) -> list[Pieces]:
        return planned(_listed(self.path), self.most, self.lines) or [Pieces([])]


class GraphReader(_Reader):
    lines = _LINES

    def __init__(self, options: dict):
        super().__init__(options)
        self.graph, self.base = options.get("graph", ""), options.get("base", "")
        self.tests: list[tuple[int, frozenset]] = []

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in _COLUMNS:
                values = [f.value] if isinstance(f, EqualTo) else f.value
                if all(isinstance(v, str) for v in values):
                    self.tests.append((_COLUMNS.index(f.attribute[0]), frozenset(values)))
                    continue
            yield f

    def read(self, partition: Pieces):
        import pyarrow as pa

        rows: list[tuple] = []
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=_COLUMNS)
        for row in self.triples(partition):
            if all(row[k] in values for k, values in self.tests):
                rows.append(row)
                if len(rows) >= BATCH_ROWS:
                    yield batch()
                    rows = []
        if rows:
            yield batch()

    def triples(self, partition: Pieces) -> Iterator[tuple]:
        from .turtle import stream

        store, _ = _store(self.path)
        marks = [[f"<{v}>".encode() for v in values] for k, values in self.tests if _COLUMNS[k] == "p"]
        for path, start, end, _ in partition.files:
            own = hashlib.sha256(re.sub("/part-[^/]*$", "", path).encode()).hexdigest()[:12]
            named = lambda x, own=own: f"_:{own}.{x[2:]}" if x.startswith("_:") else x
            with store.open_input_file(path) as f:
                if path.endswith(_LINES):
                    # an escaped predicate is written otherwise: such lines are always parsed
                    likely = lambda line: b"\\" in line or all(any(m in line for m in some) for some in marks)
                    texts = (b"\n".join(filter(likely, block)).decode() for block in line_blocks(f, start, end))
                else:
                    texts = iter([f.read().decode()])
                for text in texts:
                    for s, p, o, kind, *more in stream(text, self.base):
                        yield (self.graph, named(s), p, named(o) if kind == "iri" else o, kind, *more)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class TurtleWriter(DataSourceArrowWriter):
    """Rows (file, subject, predicate, object), sorted: each file's beginning has the prefixes, each subject is named once."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.head = "".join(f"@prefix {k}: <{v}> .\n" for k, v in sorted(json.loads(options.get("prefixes", "{}")).items())) + "\n"
        self.scratch = f"_making-{uuid.uuid4().hex}"

    def write(self, iterator) -> Written:
        store, root = _store(self.path)
        store.create_dir(f"{root}/{self.scratch}", recursive=True)
        made, out, file, subject = [], None, None, None
        try:
            for batch in iterator:
                for now, s, p, o in zip(*(batch.column(c).to_pylist() for c in ("file", "subject", "predicate", "object")), strict=True):
                    if now != file:
                        if out:
                            out.write(b" .\n")
                            out.close()
                        made.append((f"{root}/{self.scratch}/{uuid.uuid4().hex}", f"{root}/graph-{now:05d}.ttl"))
                        out, file, subject = store.open_output_stream(made[-1][0]), now, None
                        out.write(self.head.encode())
                    out.write((f" ;\n    {p} {o}" if s == subject else f"{s} {p} {o}" if subject is None else f" .\n{s} {p} {o}").encode())
                    subject = s
            if out:
                out.write(b" .\n")
        finally:
            if out:
                out.close()
        return Written(made)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        moves = [m for message in messages if message for m in message.files]
        old = {f.path for f in store.get_file_info(fs.FileSelector(root)) if re.search(r"/graph-\d+\.ttl$", f.path)}
        if old and not self.overwrite:
            raise ValueError(f"{self.path} has a graph already; overwrite it")
        for source, target in moves:
            if target in old:
                store.delete_file(target)
            store.move(source, target)
        for gone in old - {t for _, t in moves}:
            store.delete_file(gone)
        self._clear(store, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*_store(self.path))

    def _clear(self, store, root: str) -> None:
        from pyarrow import fs

        if store.get_file_info(f"{root}/{self.scratch}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/{self.scratch}")


class GraphFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lodestone_graph"

    def schema(self) -> str:
        return TRIPLES

    def reader(self, schema: T.StructType) -> GraphReader:
        return GraphReader(dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> TurtleWriter:
        return TurtleWriter(dict(self.options), overwrite)


# --- YAML --------------------------------------------------------------------------------------
def fitted(value, kind: T.DataType):
    """A value of a YAML document as a column's type asks for it; null where it doesn't fit."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return tuple(fitted(value.get(f.name), f.dataType) for f in kind) if isinstance(value, dict) else None
    if isinstance(kind, T.ArrayType):
        return [fitted(v, kind.elementType) for v in value] if isinstance(value, list) else None
    if isinstance(kind, T.MapType):
        return {str(k): fitted(v, kind.valueType) for k, v in value.items()} if isinstance(value, dict) else None
    if isinstance(kind, T.BooleanType):
        return value if isinstance(value, bool) else None
    if isinstance(kind, T.IntegralType):
        return value if isinstance(value, int) and not isinstance(value, bool) else None
    if isinstance(kind, T.FractionalType):
        return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None
    if isinstance(kind, T.StringType):
        return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, default=str)
    raise ValueError(f"no YAML value is of type {kind.simpleString()}")


class YamlReader(_Reader):
    def __init__(self, options: dict, schema: T.StructType):
        super().__init__(options)
        self.schema = schema

    def read(self, partition: Pieces):
        from .readers import plain_yaml

        try:
            from yaml import safe_load
        except ImportError:
            safe_load = plain_yaml
        store, _ = _store(self.path)
        for path, *_ in partition.files:
            with store.open_input_file(path) as f:
                text = f.read().decode()
            for document in re.split(r"(?m)^---[ \t]*$\n?", text):
                if document.strip():
                    yield fitted(safe_load(document), self.schema) or (None,) * len(self.schema)


class YamlFiles(DataSource):
    """YAML documents under a declared schema: a row for each, several in a file parted by lines of "---". What is no map gives nulls."""

    @classmethod
    def name(cls) -> str:
        return "lodestone_yaml"

    def schema(self) -> str:
        raise ValueError("lodestone_yaml needs a schema")

    def reader(self, schema: T.StructType) -> YamlReader:
        return YamlReader(dict(self.options), schema)


# --- entries -----------------------------------------------------------------------------------
def read(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Triples of Turtle and N-Triples files below a path."""
    register(spark)
    return spark.read.format("lodestone_graph").options(**options).load(qualified(spark, path))


def read_yaml(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    register(spark)
    return spark.read.format("lodestone_yaml").schema(schema).options(**options).load(qualified(spark, path))


def write_turtle(triples: DataFrame, path: str, prefixes: dict[str, str], files: int = 64) -> None:
    """Canonical Turtle in so many files; with `blanks.canonical` before it, whatever blank nodes are called."""
    from .sinks import as_turtle

    spark = triples.sparkSession
    register(spark)
    file = F.pmod(F.xxhash64(F.substring_index("s", "#", 1)), F.lit(files)).cast("int")
    # triples that are there twice belong to one file: they are made a set where they are sorted, so one exchange does
    rows = as_turtle(triples, prefixes).withColumn("file", file).repartition(files, "file").distinct().sortWithinPartitions("file", "s", "p", "object")
    rows.select("file", "subject", "predicate", "object").write.format("lodestone_graph").option("prefixes", json.dumps(prefixes)).mode("overwrite").save(qualified(spark, path))
