"""Nested paper archives as a Spark data source.

``spark.read.format("paper_archives").load(dir)`` gives one row per paper (schema.PAPER). Each outer tar, or each
archive file where there are no tars, is one input partition, and rows are yielded while the tar is read, so one paper is
in memory at a time. Tars named by the option ``closed`` (a JSON list of file names) become no partition and are never
opened. Paths are local or URIs of any store that pyarrow reads (hdfs, s3, gs, ...).
"""

from __future__ import annotations

import gzip
import io
import json
import posixpath
import re
import tarfile
import zlib
from collections.abc import Iterable, Iterator

from pyarrow import fs as stores
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from paperlake.schema import PAPER

#: Most octets read from one compressed stream; more is cut off. Larger *declared* entries are refused.
MOST = 100_000_000
KEPT_MEMBERS = (".tex", ".bbl", ".ltx", ".latex")
GZIPPED = (".tar.gz", ".tgz", ".gz")
LISTED = (".tar", *GZIPPED, ".tex")
SUFFIXES = [re.compile(rf"(?:{re.escape(s)})+$") for s in (".tar.gz", ".tgz", ".gz", ".tex", ".pdf")]
READ_ERRORS = (OSError, EOFError, tarfile.TarError, zlib.error)


def paper_id(path: str) -> str:
    base = path.rsplit("/", 1)[-1]
    for suffix in SUFFIXES:
        base = suffix.sub("", base)
    return base


#: Windows-1252 with the bytes that it leaves undefined as C1 controls.
CP1252 = {b: bytes([b]).decode("cp1252", "replace") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in range(0x80, 0xA0)}


def decode(raw: bytes) -> str:
    """UTF-8 without its mark; failing that, what the byte order mark of UTF-16 says; failing that, Windows-1252."""
    try:
        return raw.removeprefix(b"\xef\xbb\xbf").decode("utf-8")
    except UnicodeDecodeError:
        pass
    for mark, encoding in ((b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be")):
        if raw.startswith(mark):
            return raw[2:].decode(encoding, "replace")
    return raw.decode("latin-1").translate(CP1252)


def sniff(raw: bytes) -> str:
    head = raw[:9].lower()
    if not raw:
        return "unknown"
    if raw.startswith(b"%PDF"):
        return "pdf"
    if raw.startswith(b"%!PS"):
        return "postscript"
    return "html" if head.startswith((b"<html", b"<!doctype")) else "tex"


def gunzip(raw: bytes) -> bytes:
    """At most MOST octets; what comes before a defect counts only if something came."""
    with gzip.GzipFile(fileobj=io.BytesIO(raw)) as stream:
        return stream.read(MOST)


def tar_members(raw: bytes, strict: bool = False) -> list[dict]:
    """Source files of a plain tar, in order. Unreadable entries are passed over unless ``strict``."""
    files = []
    with tarfile.open(fileobj=io.BytesIO(raw), mode="r:") as tar:
        for member in tar:
            if member.isfile() and member.name.lower().endswith(KEPT_MEMBERS):
                try:
                    content = tar.extractfile(member).read()
                except READ_ERRORS:
                    if strict:
                        raise
                    continue
                files.append({"name": member.name, "content": decode(content)})
    return files


def from_gzip(raw: bytes, one: str) -> tuple[str, list[dict]]:
    """(file type, files) of a compressed entry: a tar of sources, or a single compressed file."""
    try:
        plain = gunzip(raw)
    except READ_ERRORS:
        return "unknown", []
    try:
        if files := tar_members(plain):
            return "tex", files
    except READ_ERRORS:
        pass
    kind = sniff(plain)
    return kind, [{"name": f"{one}.tex", "content": decode(plain)}] if kind == "tex" else []


def entry(path: str, size: int, read) -> dict:
    """One entry of an outer tar; ``read`` gives its octets."""
    row = {"source_tar": None, "entry_name": path, "arxiv_id": paper_id(path), "file_type": "unknown", "tex_files": [], "error": None}
    if size > MOST:
        row["error"] = f"entry {path} has {size} bytes, exceeds 100MB limit"
        row["tex_files"] = None
    elif path.endswith(".pdf"):
        row["file_type"] = "pdf"
    elif path.endswith(GZIPPED):
        row["file_type"], row["tex_files"] = from_gzip(read(), row["arxiv_id"])
    elif path.endswith(".tex"):
        row["file_type"], row["tex_files"] = "tex", [{"name": path, "content": decode(read())}]
    return row


def papers_of_tar(path: str) -> Iterator[dict]:
    """Every paper of an outer tar; a defect of the tar itself ends it with a row without id."""
    name = posixpath.basename(path)
    try:
        store, place = locate(path)
        with store.open_input_stream(place, compression=None) as stream, tarfile.open(fileobj=stream, mode="r|") as tar:
            for member in tar:
                if member.name.endswith("/") or member.isdir():
                    continue
                if member.size > MOST:
                    yield entry(member.name, member.size, None) | {"source_tar": name}
                    continue
                try:
                    raw = tar.extractfile(member).read() if member.isfile() else b""
                except READ_ERRORS as defect:
                    yield _unknown(name, defect)
                    return
                yield entry(member.name, member.size, lambda raw=raw: raw) | {"source_tar": name}
    except READ_ERRORS as defect:
        yield _unknown(name, defect)


def _unknown(tar: str, defect: Exception) -> dict:
    return {"source_tar": tar, "entry_name": "unknown", "arxiv_id": "unknown", "file_type": "unknown", "tex_files": None, "error": str(defect) or type(defect).__name__}


def paper_of_file(path: str) -> dict:
    """An archive by itself: for compressed names a plain tar, a compressed tar or a compressed file, in this order."""
    row = {"source_tar": None, "entry_name": path, "arxiv_id": paper_id(path), "file_type": "tex", "tex_files": [], "error": None}
    try:
        store, place = locate(path)
        with store.open_input_stream(place, compression=None) as stream:
            raw = stream.read()
    except OSError as defect:
        return row | {"file_type": None, "tex_files": None, "error": str(defect)}
    if path.endswith(GZIPPED):
        try:
            if files := tar_members(raw, strict=True):
                return row | {"tex_files": files}
        except READ_ERRORS:
            pass
        row["file_type"], row["tex_files"] = from_gzip(raw, row["arxiv_id"])
    elif path.endswith(".tex"):
        row["tex_files"] = [{"name": posixpath.basename(path), "content": decode(raw)}]
    return row


def locate(path: str) -> tuple[stores.FileSystem, str]:
    """The store of a path or URI, and the path inside it."""
    return stores.FileSystem.from_uri(path) if "://" in path else (stores.LocalFileSystem(), path.removeprefix("file:"))


def listing(directory: str) -> tuple[list[str], bool]:
    """(paths in order, whether they are outer tars). One ``.tar`` among the names makes all others be left aside."""
    store, place = locate(directory)
    names = sorted(f.base_name for f in store.get_file_info(stores.FileSelector(place)) if f.type == stores.FileType.File and f.base_name.endswith(LISTED))
    tars = [n for n in names if n.endswith(".tar")]
    return [posixpath.join(directory, n) for n in tars or names], bool(tars)


class _Archive(InputPartition):
    def __init__(self, path: str, outer: bool):
        super().__init__(path)
        self.path, self.outer = path, outer


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.closed = options["path"], set(json.loads(options.get("closed", "[]")))

    def partitions(self) -> list[_Archive]:
        store, place = locate(self.path)
        if store.get_file_info(place).type == stores.FileType.File:
            return [_Archive(self.path, self.path.endswith(".tar"))]
        paths, outer = listing(self.path)
        return [_Archive(p, outer) for p in paths if not (outer and posixpath.basename(p) in self.closed)]

    def read(self, partition: _Archive | None) -> Iterator[tuple]:
        if partition is None:  # Spark's one empty partition where there is nothing to read
            return
        rows = papers_of_tar(partition.path) if partition.outer else [paper_of_file(partition.path)]
        for row in rows:
            files = None if row["tex_files"] is None else [(f["name"], f["content"]) for f in row["tex_files"]]
            yield (row["source_tar"], row["entry_name"], row["arxiv_id"], row["file_type"], files, row["error"])


class PaperArchives(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paper_archives"

    def schema(self):
        return PAPER

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def read_papers(spark: SparkSession, path: str, closed: Iterable[str] = ()) -> DataFrame:
    """Papers of a directory of archives or of a single one, but for tars named in ``closed``."""
    spark.dataSource.register(PaperArchives)
    return spark.read.format("paper_archives").option("closed", json.dumps(sorted(closed))).load(path)


def collect_papers(path: str) -> list[dict]:
    """All papers of one outer tar at once, without Spark (for small tars and tests)."""
    return list(papers_of_tar(path))
