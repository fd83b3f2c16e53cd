"""Zip archives of delimited text."""

from __future__ import annotations

import codecs
import csv
import re
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import BinaryIO
from urllib.parse import quote, urlencode

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epilake.functions.columns import quoted
from epilake.sources.dialect import CsvDialect
from epilake.sources.stores import open_store, session_setting, store_arguments, store_path, store_root

LINE_SCHEMA = "line_no BIGINT, line STRING"
ORIGIN_SCHEMA = "archive STRING, member STRING"
#: Tasks that inflate at most; beyond it a task has several members.
MOST_TASKS = 4096
_LINES_PER_BATCH = 20_000
_CHUNK = 1 << 20

#: Schemes of Hadoop paths and those of the same stores in PyArrow.
SCHEMES = {
    "file": "file",
    "hdfs": "hdfs",
    "viewfs": "viewfs",
    "s3": "s3",
    "s3a": "s3",
    "s3n": "s3",
    "gs": "gs",
    "abfs": "abfs",
    "abfss": "abfss",
}


@dataclass(frozen=True)
class ArchiveStore:
    """How tasks open an archive: by its path, through PyArrow, whatever its size.

    ``settings`` has, for each store (``scheme://authority``), the arguments of its
    file system; ``of_session`` takes them from the Hadoop settings of a session,
    so that credentials set once hold for archives, too. A store without any is
    opened by its URI, with ``options`` in it (for example ``region`` or
    ``endpoint_override``) and credentials from the executors' environment.
    """

    options: Mapping[str, str] = field(default_factory=dict)
    settings: Mapping[str, Mapping[str, object]] = field(default_factory=dict, repr=False)

    @staticmethod
    def of_session(spark: SparkSession, paths: Sequence[str]) -> ArchiveStore:
        """A store for some paths, with the Hadoop settings that the session has for each."""
        setting, found = session_setting(spark), {}
        for path in paths:
            if store_root(path)[0] == "file" and not path.startswith("file:"):
                path = f"{(setting('fs.defaultFS') or 'file:').rstrip('/')}/{path.lstrip('/')}"
            root = "://".join(store_root(path))
            if root not in found and (arguments := store_arguments(path, setting)):
                found[root] = arguments
        return ArchiveStore(settings=found)

    def uri(self, path: str) -> str:
        scheme, colon, rest = path.partition(":")
        if not colon or "/" in scheme:
            scheme, rest = "file", path
        if scheme not in SCHEMES:
            raise ValueError(f"archives cannot be opened in a {scheme!r} store; use one of {sorted(SCHEMES)}")
        if scheme == "file":
            return "/" + rest.lstrip("/")
        query = "?" + urlencode(self.options) if self.options else ""
        return f"{SCHEMES[scheme]}:{quote(rest, safe='/:@')}{query}"

    def open(self, path: str) -> BinaryIO | pa.NativeFile:
        uri = self.uri(path)
        if uri.startswith("/"):
            return open(uri, "rb")
        if arguments := self.settings.get("://".join(store_root(path))):
            return open_store(path, arguments).open_input_file(store_path(path))
        files, name = FileSystem.from_uri(uri)
        return files.open_input_file(name)


def archive_members(
    spark: SparkSession,
    paths: str | Sequence[str],
    recursive: bool = False,
    store: ArchiveStore | None = None,
) -> DataFrame:
    """The files inside archives: path, member, place. Only directories of archives are read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    store = store or ArchiveStore.of_session(spark, paths)
    for path in paths:
        store.uri(path)  # an unknown store is an error here, before any task

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with store.open(path) as file, zipfile.ZipFile(file) as archive:
                    found = [(k, i.filename) for k, i in enumerate(archive.infolist()) if not i.is_dir()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "path": [path] * len(found),
                        "member": [name for _, name in found],
                        "place": pa.array([place for place, _ in found], pa.int64()),
                    },
                    schema=pa.schema([("path", pa.string()), ("member", pa.string()), ("place", pa.int64())]),
                )

    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    files = reader.load(paths).select("path")
    return files.mapInArrow(members, "path STRING, member STRING, place BIGINT")


def _pieces(raw: BinaryIO, encoding: str) -> Iterator[str]:
    # Bytes that are no text become U+FFFD, as in scans of plain files.
    decoder = codecs.getincrementaldecoder(encoding)(errors="replace")
    while data := raw.read(_CHUNK):
        yield decoder.decode(data)
    yield decoder.decode(b"", final=True)


def _lines(raw: BinaryIO, dialect: CsvDialect) -> Iterator[str]:
    """Lines without their ends: the dialect's own, or any of the three usual ones."""
    # utf-8-sig is UTF-8 that tolerates a byte order mark.
    encoding = "utf-8-sig" if dialect.encoding.upper() == "UTF-8" else dialect.encoding
    end = re.compile(re.escape(dialect.line_sep) if dialect.line_sep else "\r\n|\r|\n")
    rest = ""
    for piece in _pieces(raw, encoding):
        parts = end.split(rest + piece)
        rest = parts.pop()
        if dialect.line_sep is None and not rest and parts and (piece or " ")[-1] == "\r":
            rest = parts.pop() + "\r"  # a line feed may follow
        yield from parts
    if rest:
        yield rest.removesuffix("\r") if dialect.line_sep is None else rest


def _turns(line: str, dialect: CsvDialect) -> bool:
    """Whether a line opens or closes a quoted value that goes on beyond it."""
    if dialect.escape != dialect.quote:
        line = re.sub(re.escape(dialect.escape) + ".", "", line)
    return line.count(dialect.quote) % 2 == 1


def _records(lines: Iterator[str], dialect: CsvDialect) -> Iterator[str]:
    """Lines, those joined that a quoted value with line breaks was spread over."""
    if not dialect.multi_line:
        yield from lines
        return
    held: list[str] = []
    inside = False
    for line in lines:
        held.append(line)
        inside ^= _turns(line, dialect)
        if not inside:
            yield "\n".join(held)
            held = []
    if held:
        yield "\n".join(held)


def inflate(
    members: DataFrame,
    dialect: CsvDialect,
    header: str | None = None,
    origin: bool = False,
    store: ArchiveStore | None = None,
) -> DataFrame:
    """The records of archive members (path, member, place), numbered from 0 in each member.

    Every member is inflated as a stream, by a task of its own while there are
    fewer than ``MOST_TASKS``, and leaves it in small batches, so neither the
    size of an archive nor that of its text matters to memory. With ``header``,
    a member that starts with another line fails the job, as its columns would
    be mixed up with the others'. ``origin`` adds the archive's path and the
    member's name without its folders, which are often longer than the line itself.
    """
    store = store or ArchiveStore()
    schema = f"{ORIGIN_SCHEMA}, {LINE_SCHEMA}" if origin else LINE_SCHEMA
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, place in zip(batch.column("path").to_pylist(), batch.column("place").to_pylist()):
                with store.open(path) as file, zipfile.ZipFile(file) as archive:
                    yield from inflated(path, archive, archive.infolist()[place])

    def inflated(path: str, archive: zipfile.ZipFile, info: zipfile.ZipInfo):
        member = info.filename.rsplit("/", 1)[-1]
        with archive.open(info) as raw:
            first, chunk = 0, []
            for line in _records(_lines(raw, dialect), dialect):
                if first == 0 and not chunk and header is not None and line != header:
                    raise ValueError(f"header of {info.filename} in {path} is not {header!r}")
                chunk.append(line)
                if len(chunk) == _LINES_PER_BATCH:
                    yield numbered(path, member, first, chunk)
                    first, chunk = first + len(chunk), []
            if chunk:
                yield numbered(path, member, first, chunk)

    def numbered(path: str, member: str, first: int, chunk: list[str]) -> pa.RecordBatch:
        count = len(chunk)
        columns = [pa.array(range(first, first + count), pa.int64()), pa.array(chunk, pa.string())]
        if origin:
            columns = [pa.repeat(path, count), pa.repeat(member, count), *columns]
        return pa.RecordBatch.from_arrays(columns, names=names)

    # A stated number of tasks: rows this small would else be merged into one.
    tasks = min(MOST_TASKS, max(1, members.count()))
    return members.repartition(tasks, "path", "place").mapInArrow(run, schema)


def first_line(members: DataFrame, dialect: CsvDialect, store: ArchiveStore | None = None) -> str:
    """The first line of the first member that has one; members are tried in the order of their paths."""
    ordered = members.orderBy("path", "place")
    first = inflate(ordered.limit(1), dialect, store=store).filter(F.col("line_no") == 0).head()
    if first is None:
        first = inflate(members, dialect, store=store).filter(F.col("line_no") == 0).head()
    if first is None:
        raise ValueError("no text in the archives")
    return first["line"]


def split_header(header: str, dialect: CsvDialect) -> list[str]:
    """Column names of a header line, made as scans of plain files make them.

    Blank names become ``_c`` and their place, repeated ones get their place at
    the end. A strict dialect takes neither, since parts could not be told apart.
    """
    names = next(csv.reader([header], delimiter=dialect.sep, quotechar=dialect.quote))
    lower = [name.lower() for name in names]
    safe = [
        f"_c{place}" if not name else f"{name}{place}" if lower.count(name.lower()) > 1 else name
        for place, name in enumerate(names)
    ]
    if dialect.strict_header and safe != names:
        raise ValueError(f"CSV header does not conform: blank or repeated names in {header!r}")
    return safe


def parse_lines(
    lines: DataFrame, columns: Sequence[str], dialect: CsvDialect, corrupt_column: str | None = None
) -> DataFrame:
    """Lines as records of text columns; header and blank lines are skipped.

    ``corrupt_column`` gets the text of records whose field count is wrong.
    """
    columns, options = list(columns), dialect.record_options()
    if corrupt_column is not None:
        columns.append(corrupt_column)
        options = options | {"columnNameOfCorruptRecord": corrupt_column}
    if dialect.header:
        lines = lines.filter(F.col("line_no") > 0)
    record = F.from_csv("line", _ddl(columns), options)
    return lines.filter(F.trim("line") != "").select(record.alias("record")).select("record.*")


def _ddl(columns: Sequence[str]) -> str:
    return ", ".join(f"{quoted(column)} STRING" for column in columns)


def read_zipped_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    dialect: CsvDialect,
    corrupt_column: str | None = None,
    recursive: bool = False,
    store: ArchiveStore | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Delimited text inside zip archives, every column as text.

    A member is inflated by one task. ``spread`` deals the lines to so many
    tasks for parsing and writing, for archives of few large members.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    store = store or ArchiveStore.of_session(spark, paths)
    members = archive_members(spark, paths, recursive, store)
    line = first_line(members, dialect, store)
    if dialect.header:
        columns = split_header(line, dialect)
    else:
        columns = [f"_c{place}" for place in range(len(next(csv.reader([line], delimiter=dialect.sep, quotechar=dialect.quote))))]
    lines = inflate(members, dialect, line if dialect.header and dialect.strict_header else None, store=store)
    if spread is not None:
        lines = lines.repartition(spread)
    return parse_lines(lines, columns, dialect, corrupt_column)
