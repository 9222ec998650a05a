"""What the operators share: reading tables, walking Arrow batches, folds, scratch space."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are handled in runs of about so many characters, whatever the size of an Arrow batch.
CHUNK_CHARS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder under the shared checkpoint folder. Where none is configured a local master gets a temporary one; a cluster is refused, as its nodes would each write their own. What isn't dropped before goes when the process ends."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="lodestone-checkpoints-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not _KEPT:
        atexit.register(_drop_all)
    _KEPT[path] = (spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration())
    return path


_KEPT: dict[str, tuple] = {}


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    _drop(*_KEPT.pop(path, (spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration())), path)


def _drop(jvm, configuration, path: str) -> None:
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(configuration).delete(p, True)


def _drop_all() -> None:
    """Results are read lazily, so what they rest on stays until the driver's process ends."""
    for path, (jvm, configuration) in list(_KEPT.items()):
        with contextlib.suppress(Py4JError, OSError):  # the JVM may be gone
            _drop(jvm, configuration, path)
    _KEPT.clear()


#: Spark's own switch for it; versions without it keep shuffles until they are collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What runs inside removes its shuffles from the disks when it ends; else they lie there until the driver's JVM happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def spare(df: DataFrame, label: str) -> str:
    """A column name like `label` that df doesn't have."""
    taken, name, k = {c.lower() for c in df.columns}, label, 0
    while name.lower() in taken:
        k += 1
        name = f"{label}_{k}"
    return name


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5


def text_chunks(batch: pa.RecordBatch, column: int, size: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) in runs of about `size` characters; null is the empty text."""
    col = batch.column(column)
    start, run, n = 0, [], 0
    for i in range(len(col)):
        text = col[i].as_py() or ""
        run.append(text)
        n += len(text)
        if n >= size:
            yield start, run
            start, run, n = i + 1, [], 0
    if run:
        yield start, run


def map_texts(df: DataFrame, keep: list[str], text_col: str, extra: str, fn: Callable[[list[str]], Iterable[tuple]], make: Callable[[], object] | None = None) -> DataFrame:
    """Add the columns named in `extra` ("name type, ...") to `keep`.

    `fn(texts)` (or `fn(texts, state)` with `state = make()`, made once a task) returns a
    row for each text. Rows stay where they are: no shuffle, and a chunk of text at a time.
    """
    picked = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias(spare(df, "text")))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    schema = f"{kept}, {extra}" if kept else extra
    out_fields = spark_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = make() if make else None
        names = [f.name for f in out_fields]
        for batch in batches:
            for start, texts in text_chunks(batch, batch.num_columns - 1):
                rows = list(fn(texts, state) if make else fn(texts))
                cols = [batch.column(i).slice(start, len(texts)) for i in range(batch.num_columns - 1)]
                made = [pa.array(list(c), type=out_fields.field(len(cols) + i).type) for i, c in enumerate(zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays(cols + made, names=names)

    return picked.mapInArrow(run, schema)


def spark_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each output bit depends on each input bit."""
    x = x.copy()
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x
