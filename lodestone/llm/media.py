"""Media columns: archives of media members as a Spark data source.

`media_archive` is a custom data source. Writing rolls members into ZIP archives (stored, with
a central directory) under a folder; each commit adds a manifest of the archives of tasks that
succeeded, so what a lost attempt left behind is never read, and appending keeps what is there
(overwriting removes the manifests before it, and their archives). Reading plans partitions as
byte ranges over those archives from the manifests alone (the driver opens no archive); a task
reads its archive's directory, takes the members whose header starts in its range, and streams
them as Arrow batches of bounded size. A member is fetched by its offset, checked by its CRC
and retried alone; opening an archive and reading its directory are retried too.

A payload is a text's UTF-8 bytes with spaces up to a positive multiple of 192, stored as an
RGB image of 64 x n/192 pixels in PNG: lossless 8-bit samples.

Cases: a null or empty text is one row of spaces; null ids and repeated rows are kept, each a
member of its own; a very long text is one member, read whole by one task. An empty table
gives an archive without members and no rows. Equal texts give equal media and features.
"""

from __future__ import annotations

import hashlib
import json
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..plans.shared import is_shared
from .common import map_texts, scratch

ROW = 192
SCHEMA = "id long, n_bytes long, media binary"
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


# --- payloads and PNG ----------------------------------------------------------------------
def payload(raw: bytes) -> bytes:
    return raw.ljust(max(ROW, -(-len(raw) // ROW) * ROW))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_png(samples: bytes) -> bytes:
    rows = np.frombuffer(samples, np.uint8).reshape(-1, ROW)
    lines = np.zeros((len(rows), ROW + 1), np.uint8)  # each line begins with its filter, 0: none
    lines[:, 1:] = rows
    return _SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", ROW // 3, len(rows), 8, 2, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + _chunk(b"IEND", b"")


def from_png(media: bytes) -> bytes:
    """The samples of an image that to_png wrote."""
    if media[:8] != _SIGNATURE:
        raise ValueError("not a PNG")
    at, data, size = 8, [], None
    while at < len(media):
        n, kind = struct.unpack_from(">I4s", media, at)
        body = media[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", media, at + 8 + n)[0]:
            raise ValueError("damaged chunk")
        if kind == b"IHDR":
            size = struct.unpack(">II", body[:8])
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(-1, ROW + 1)
    if size != (ROW // 3, len(lines)) or lines[:, 0].any():
        raise ValueError("another size or filter")
    return lines[:, 1:].tobytes()


def feature(samples: bytes) -> str:
    """Mean and deviation of each channel, and the entropy of all samples."""
    x = np.frombuffer(samples, np.uint8)
    hist = np.bincount(x, minlength=256)
    p = hist[hist > 0] / len(x)
    channels = x.reshape(-1, 3)
    stats = [f"{v:.3f}" for v in (*channels.mean(axis=0), *channels.std(axis=0), abs((p * np.log2(p)).sum()))]
    return ":".join([f"{ROW // 3}x{len(x) // ROW}", *stats])


# --- archives ------------------------------------------------------------------------------
def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system: one without a scheme belongs to Hadoop's default file system, as it does for Spark's own readers. The source itself takes a path without a scheme for a local one, which a cluster can't share."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    if out.startswith("file:") and "://" not in path and not path.startswith("file:") and not spark.sparkContext.master.startswith("local") and not is_shared(spark, path):
        raise ValueError(f"{path} is local to each machine; name a folder that all executors share")
    return out


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


class _Retry:
    """Reads a member by its offset, again where it fails."""

    def __init__(self, uri: str, tries: int = 4, pause: float = 0.2):
        self.uri, self.tries, self.pause = uri, tries, pause
        self.file = None

    def _open(self):
        store, path = _at(self.uri)
        return store.open_input_file(path)

    def _tried(self, what: str, read: Callable[[], object]):
        for k in range(self.tries):
            try:
                if self.file is None:
                    self.file = self._open()
                return read()
            except (OSError, zipfile.BadZipFile) as e:
                self.file = None
                if k + 1 == self.tries:
                    raise OSError(f"{self.uri}, {what}: {e}") from e
                time.sleep(self.pause * 2**k)
        raise AssertionError

    def directory(self) -> list[zipfile.ZipInfo]:
        return self._tried("directory", lambda: zipfile.ZipFile(self.file).infolist())

    def member(self, info: zipfile.ZipInfo) -> bytes:
        def read() -> bytes:
            self.file.seek(info.header_offset)
            head = self.file.read(30)
            if head[:4] != b"PK\x03\x04":
                raise OSError("no member at this offset")
            name, extra = struct.unpack("<HH", head[26:30])
            self.file.seek(info.header_offset + 30 + name + extra)
            body = self.file.read(info.file_size)
            if len(body) != info.file_size or zlib.crc32(body) != info.CRC:
                raise OSError("a member was cut short or damaged")
            return body

        return self._tried(f"member {info.filename} at {info.header_offset}", read)


@dataclass
class Written(WriterCommitMessage):
    archives: list[tuple[str, int]]


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool = False):
        self.path, self.most, self.overwrite = options["path"].rstrip("/"), int(options.get("archivebytes", 64 << 20)), overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _at(self.path)
        store.create_dir(root, recursive=True)
        made: list[tuple[str, int]] = []
        out = pack = name = None

        def close() -> None:
            pack.close()
            made.append((name, out.tell()))
            out.close()

        for batch in iterator:
            for i, n, media in zip(*(batch.column(c) for c in range(3)), strict=True):
                if pack is None:
                    name = f"part-{uuid.uuid4().hex}.zip"
                    out = store.open_output_stream(f"{root}/{name}")
                    pack = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED)
                    k = 0
                # one time for all, so that equal members are equal
                info = zipfile.ZipInfo(f"{k}_{'' if not i.is_valid else i.as_py()}_{n.as_py()}.png", (1980, 1, 1, 0, 0, 0))
                body = media.as_py()
                info.CRC, info.file_size, info.compress_size = zlib.crc32(body), len(body), len(body)
                pack.writestr(info, body)
                k += 1
                if out.tell() >= self.most:
                    close()
                    pack = None
        if pack is not None:
            close()
        return Written(made)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _at(self.path)
        store.create_dir(root, recursive=True)
        before = _manifests(store, root) if self.overwrite else []
        gone = [name for m in before for name, _ in _listed(store, m)]
        name = f"{uuid.uuid4().hex}.json"
        # a manifest counts once it has its name, whole
        with store.open_output_stream(f"{root}/_unfinished-{name}") as f:
            f.write(json.dumps(sorted(a for m in messages if m for a in m.archives)).encode())
        store.move(f"{root}/_unfinished-{name}", f"{root}/_manifest-{name}")
        for path in [*before, *(f"{root}/{x}" for x in gone)]:
            store.delete_file(path)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _at(self.path)
        for m in messages:
            for name, _ in m.archives if m else ():
                store.delete_file(f"{root}/{name}")


def _manifests(store: fs.FileSystem, root: str) -> list[str]:
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(x.path for x in found if x.base_name.startswith("_manifest-"))


def _listed(store: fs.FileSystem, manifest: str) -> list[tuple[str, int]]:
    with store.open_input_stream(manifest) as f:
        return [tuple(x) for x in json.loads(f.read())]


class Range(InputPartition):
    """Bytes [begin, end) of an archive."""

    def __init__(self, uri: str, begin: int, end: int):
        self.uri, self.begin, self.end = uri, begin, end


class ArchiveReader(DataSourceReader):
    BATCH = 4 << 20

    def __init__(self, options: dict):
        self.path, self.step = options["path"].rstrip("/"), int(options.get("rangebytes", 16 << 20))

    def partitions(self) -> list[Range]:
        store, root = _at(self.path)
        manifests = _manifests(store, root)
        if not manifests:
            raise FileNotFoundError(f"no archive was written to {self.path}")
        archives = [a for m in manifests for a in _listed(store, m)]
        return [Range(f"{self.path}/{name}", a, min(size, a + self.step)) for name, size in archives for a in range(0, size, self.step)] or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.uri:
            return
        source = _Retry(partition.uri)
        members = [m for m in source.directory() if partition.begin <= m.header_offset < partition.end]
        ids, sizes, media, held = [], [], [], 0
        for m in sorted(members, key=lambda m: m.header_offset):
            _, i, n = m.filename.removesuffix(".png").split("_")
            ids.append(int(i) if i else None)
            sizes.append(int(n))
            media.append(source.member(m))
            held += len(media[-1])
            if held >= self.BATCH or len(ids) >= 4096:
                yield self._batch(ids, sizes, media)
                ids, sizes, media, held = [], [], [], 0
        if ids:
            yield self._batch(ids, sizes, media)

    @staticmethod
    def _batch(ids: list, sizes: list, media: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], names=["id", "n_bytes", "media"])


class MediaArchive(DataSource):
    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options, overwrite)


def store(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", archive_bytes: int = 64 << 20, overwrite: bool = False) -> None:
    """Write each text as a media member of archives under `path`, beside those that are there or instead of them."""
    df.sparkSession.dataSource.register(MediaArchive)

    def rows(texts):
        for t in texts:
            raw = t.encode("utf-8", "surrogatepass")
            yield len(raw), to_png(payload(raw))

    made = map_texts(df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")), ["id"], "text", "n_bytes long, media binary", rows)
    made.write.format("media_archive").option("archivebytes", archive_bytes).mode("overwrite" if overwrite else "append").save(path)


def load(spark: SparkSession, path: str, range_bytes: int = 16 << 20) -> DataFrame:
    """id, n_bytes, media: the members of the archives under `path`."""
    spark.dataSource.register(MediaArchive)
    return spark.read.format("media_archive").option("rangebytes", range_bytes).load(path)


def described(media: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What is read back of each member, with its features."""
    names = [id_col, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for m in batch.column(2):
                stored = m.as_py()
                samples = from_png(stored)
                out.append((len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(samples)))
            if out:
                types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True))], names=names)

    return media.mapInArrow(run, f"`{id_col}` long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store each text in archives in the shared folder, read the archives back and describe what they hold."""
    path = qualified(df.sparkSession, scratch(df.sparkSession, "media"))
    store(df, path, id_col, text_col)
    return described(load(df.sparkSession, path), id_col)
