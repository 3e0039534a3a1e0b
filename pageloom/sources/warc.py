"""WARC archives as a Spark data source: ``spark.read.format("warc")``.

One task reads one byte range of one archive and hands over Arrow batches that are
bounded by bytes. A range begins at the first record (plain archives) or gzip member that
starts in it and whose length leads to a next one; an archive that is one single member is
read by one task. An uncompressed archive inside a record of a plain one looks the same.

Damage is an error that names file, place and reason. With ``onError=reject`` reading goes on
at the next sound record or member instead, and each lost stretch is a row with ``path``,
``record_offset`` and ``error`` alone.

Options
    ``path``            file, folder or glob; ``manifest`` instead names a text file
                        (or folder of them) with one archive path per line; several names are
                        parted by line feeds
    ``root``            folder put before relative manifest paths
    ``tagManifest``     "true" adds the column ``manifest``, the name of the file that lists the
                        archive; one that two manifests list is read for each
    ``recType``         only records of this type
    ``pushdown``        "true" also takes the type from a filter on ``rec_type``; the session needs
                        ``spark.sql.python.filterPushdown.enabled``
    ``payload``         "false" leaves the payload out; then bodies are skipped unread
    ``headers``         "false" leaves the two header maps out
    ``maxSplitBytes``   size of a byte range
    ``batchBytes``      target size of an Arrow batch
    ``firstRecords``    only so many records, the first by path and place; one task opens one archive
                        after the other until it has them
    ``onError``         "fail" (default) or "reject"; then a missing archive is a row as well
"""

from __future__ import annotations

import fnmatch
import io
import posixpath
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import islice

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition
from pyspark.sql.types import (
    BinaryType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

_TEXT_MAP = MapType(StringType(), StringType())

WARC_SCHEMA = StructType(
    [
        StructField("path", StringType(), False),
        StructField("record_offset", LongType(), False),
        StructField("rec_type", StringType()),
        StructField("content_type", StringType()),
        StructField("rec_headers", _TEXT_MAP),
        StructField("http_status", StringType()),
        StructField("http_headers", _TEXT_MAP),
        StructField("payload", BinaryType()),
        StructField("error", StringType()),
    ]
)

_ARROW_MAP = pa.map_(pa.string(), pa.string())
_ARROW_TYPES = {
    "path": pa.string(),
    "record_offset": pa.int64(),
    "rec_type": pa.string(),
    "content_type": pa.string(),
    "rec_headers": _ARROW_MAP,
    "http_status": pa.string(),
    "http_headers": _ARROW_MAP,
    "payload": pa.binary(),
    "error": pa.string(),
}

_CHUNK = 1 << 20
# Archives have a gzip member per record; what is left of a piece when a member ends
# is copied, so pieces are not much larger than members.
_ZIPPED_PIECE = 1 << 16
_GZIP = b"\x1f\x8b\x08"
_RECORD = b"WARC/"
_PROOF = 1 << 17


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and inner path of a URI or plain path."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


@dataclass
class ArchiveSplit(InputPartition):
    path: str
    start: int
    end: int
    manifest: str | None = None
    error: str | None = None
    following: tuple[ArchiveSplit, ...] = ()


class _Damaged(Exception):
    """What stands here is no record, or not a whole one."""


class _Truncated(_Damaged):
    """The archive ends inside a record."""

    def __str__(self) -> str:
        return "the archive ends inside a record"


class _GzipStream(io.RawIOBase):
    """Reads concatenated gzip members as one stream, and notes where members start."""

    def __init__(self, raw, start: int) -> None:
        raw.seek(start)
        self._raw = raw
        self._read_to = start
        self._inflate = zlib.decompressobj(31)
        self._pending = b""
        self._position = 0
        # Inflated position and file offset of each member met and not yet passed.
        self.members = deque([(0, start)])

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while True:
            if self._inflate.eof:
                self._pending = self._inflate.unused_data
                self._inflate = zlib.decompressobj(31)
                self.members.append((self._position, self._read_to - len(self._pending)))
            if not self._pending:
                self._pending = self._raw.read(_ZIPPED_PIECE)
                self._read_to += len(self._pending)
            if not self._pending:
                if self._read_to > self.members[-1][1] and not self._inflate.eof:
                    raise _Truncated
                return 0
            try:
                out = self._inflate.decompress(self._pending, len(buffer))
            except zlib.error as broken:
                if not self._pending.strip(b"\0") and not any(self._raw.read(_CHUNK).strip(b"\0") for _ in range(2)):
                    return 0  # zeros may pad the end of a file
                raise _Damaged(f"gzip member: {broken}") from None
            self._pending = self._inflate.unconsumed_tail
            if out:
                buffer[: len(out)] = out
                self._position += len(out)
                return len(out)

    def member_at(self, position: int) -> tuple[int, int]:
        """Inflated start and file offset of the member that holds an inflated position."""
        while len(self.members) > 1 and self.members[1][0] <= position:
            self.members.popleft()
        return self.members[0]


def _member_end(raw, offset: int) -> int | None:
    """Where the gzip member that starts here ends, if it is whole and begins with a record."""
    raw.seek(offset)
    inflate, head = zlib.decompressobj(31), b""
    while not inflate.eof:
        data = inflate.unconsumed_tail or raw.read(_ZIPPED_PIECE)
        if not data:
            return None
        try:
            out = inflate.decompress(data, _CHUNK)
        except zlib.error:
            return None
        head += out[: len(_RECORD) - len(head)]
        if not _RECORD.startswith(head):
            return None
    return raw.tell() - len(inflate.unused_data) if head == _RECORD else None


def _members_follow(raw, offset: int) -> bool | None:
    """Whether a gzip member with a record starts here, and whole members follow it.

    A compressed archive inside a record can hold the same bytes, but only in stored
    pieces of at most 64 KiB with marks in between, so that its members do not follow
    one another for ``_PROOF`` bytes. None if they end earlier, which damage may also do.
    """
    at = offset
    while at - offset < _PROOF:
        end = _member_end(raw, at)
        if end is None:
            return False if at == offset else None
        at = end
        raw.seek(at)
        ahead = raw.read(len(_GZIP))
        if ahead != _GZIP:
            # Zeros may pad the end of a file.
            return True if not ahead.strip(b"\0") else None
    return True


def _by_walking(raw, start: int, end: int) -> int | None:
    """The first whole member in [start, end) found from the file's beginning, passing damaged ones by."""
    at = 0
    while at < end:
        after = _member_end(raw, at)
        if after is not None and at >= start:
            return at
        if after is None:
            after = _candidate(raw, at + 1, 1 << 62)
            if after is None:
                return None
        at = after
    return None


def _candidate(raw, start: int, end: int) -> int | None:
    """The first place in [start, end) where a whole member with a record starts."""
    position, kept = start, b""
    while position < end:
        raw.seek(position)
        window = kept + raw.read(min(_CHUNK, end - position + len(_GZIP)))
        if len(window) <= len(kept):
            return None
        base = position - len(kept)
        found = window.find(_GZIP)
        while found >= 0 and base + found < end:
            if _member_end(raw, base + found) is not None:
                return base + found
            found = window.find(_GZIP, found + 1)
        position = base + len(window)
        kept = window[-(len(_GZIP) - 1) :]
    return None


def _first_member(raw, start: int, end: int) -> int | None:
    """Offset of the first whole member with a record that starts in [start, end)."""
    at = start
    while (at := _candidate(raw, at, end)) is not None:
        follows = _members_follow(raw, at)
        if follows:
            return at
        if follows is None:  # damage or a stored archive: only the way from the beginning tells
            return _by_walking(raw, start, end)
        at += 1
    return None


def _record_end(raw, offset: int, size: int) -> int | None:
    """Where the record that starts here ends, if a record or the end of the file follows."""
    raw.seek(offset)
    source = io.BufferedReader(raw, 1 << 14)
    stream = _ByteStream(source)
    try:
        if not stream.line().startswith(_RECORD):
            return None
        headers = _header_lines(stream)
        end = offset + stream.position + _length(headers)
    except _Damaged:
        return None
    finally:
        source.detach()
    if "content-length" not in headers or end > size:
        return None
    raw.seek(end)
    ahead = raw.read(16).lstrip(b"\r\n\0")
    return end if not ahead or ahead.startswith(_RECORD[: len(ahead)]) else None


def _first_record(raw, start: int, end: int, size: int) -> int | None:
    """Offset of the first sound record of a plain archive that starts in [start, end)."""
    mark = b"\n" + _RECORD
    position, kept = max(0, start - 1), b""
    if start == 0 and _record_end(raw, 0, size) is not None:
        return 0
    while position < min(end, size):
        raw.seek(position)
        window = kept + raw.read(min(1 << 16, end - position + len(mark)))
        if len(window) <= len(kept):
            return None
        base = position - len(kept)
        found = window.find(mark)
        while found >= 0 and base + found + 1 < end:
            if _record_end(raw, base + found + 1, size) is not None:
                return base + found + 1
            found = window.find(mark, found + 1)
        position = base + len(window)
        kept = window[-(len(mark) - 1) :]
    return None


class _ByteStream:
    """Counts what is read; skips by seeking where the size of the file is known."""

    def __init__(self, handle, size: int | None = None, position: int = 0) -> None:
        self._handle = handle
        self._size = size
        self.position = position

    def line(self) -> bytes:
        data = self._handle.readline()
        self.position += len(data)
        return data

    def read(self, size: int) -> bytes:
        parts = []
        left = size
        while left:
            data = self._handle.read(min(left, _CHUNK))
            if not data:
                raise _Truncated
            parts.append(data)
            left -= len(data)
        self.position += size
        return b"".join(parts)

    def skip(self, size: int) -> None:
        if self._size is not None:
            if self.position + size > self._size:
                raise _Truncated
            self._handle.seek(size, io.SEEK_CUR)
            self.position += size
            return
        while size:
            data = self._handle.read(min(size, _CHUNK))
            if not data:
                raise _Truncated
            self.position += len(data)
            size -= len(data)


def _text(raw: bytes) -> str:
    return raw.decode("utf-8", errors="replace")


def _header_lines(stream: _ByteStream, until_end: bool = False) -> dict[str, str]:
    """Header block up to its blank line, or to the end; the first of repeated names counts."""
    headers: dict[str, str] = {}
    name = ""
    while True:
        line = stream.line()
        if not line and not until_end:
            raise _Truncated
        if not line.strip():
            return headers
        if line[:1] in b" \t" and name:
            headers[name] += " " + _text(line.strip())
            continue
        key, _, value = line.partition(b":")
        name = _text(key.strip()).lower()
        headers.setdefault(name, _text(value.strip()))


def _split_http(block: bytes) -> tuple[str | None, dict[str, str] | None, bytes]:
    """Status, headers and body of an HTTP message; no headers if it has no status line."""
    if not block[:5].upper() == b"HTTP/":
        return None, None, block
    inner = io.BytesIO(block)
    stream = _ByteStream(inner)
    status = _text(stream.line().strip()).split(" ", 2)
    headers = _header_lines(stream, until_end=True)
    return (status[1] if len(status) > 1 else None), headers, block[stream.position :]


def _is_http(rec_type: str | None, headers: dict[str, str]) -> bool:
    return rec_type == "response" and headers.get("warc-target-uri", "http").lower().startswith("http")


_HTTP_HEAD = 1 << 16


def _length(headers: dict[str, str]) -> int:
    text = headers.get("content-length") or "0"
    if not (text.isascii() and text.isdigit()):
        raise _Damaged(f"Content-Length is {text!r}")
    return int(text)


def _read_record(stream: _ByteStream, rec_type: str | None, payload: bool, headers: bool) -> dict | None:
    """The record whose first line has been read, or None if it is of another type."""
    rec_headers = _header_lines(stream)
    kind = rec_headers.get("warc-type")
    length = _length(rec_headers)
    if rec_type is not None and kind != rec_type:
        stream.skip(length)
        return None
    status, http_headers, body = None, None, None
    http = _is_http(kind, rec_headers)
    if payload:
        block = stream.read(length)
        status, http_headers, body = _split_http(block) if http else (None, None, block)
    elif headers and http:
        head = stream.read(min(length, _HTTP_HEAD))
        if b"\r\n\r\n" not in head and length > _HTTP_HEAD:
            head += stream.read(length - _HTTP_HEAD)
        else:
            stream.skip(length - len(head))
        status, http_headers, _ = _split_http(head)
    else:
        stream.skip(length)
    return {
        "rec_type": kind,
        "content_type": rec_headers.get("content-type"),
        "rec_headers": list(rec_headers.items()) if headers else None,
        "http_status": status,
        "http_headers": list(http_headers.items()) if headers and http_headers is not None else None,
        "payload": body,
        "error": None,
    }


def read_records(
    path: str, start: int, end: int, rec_type: str | None, payload: bool, headers: bool, on_error: str = "fail"
) -> Iterator[dict]:
    """Records of an archive that begin in [start, end).

    Of a gzip archive these are the records from the first member in the range up to the
    first one beyond it. A record's offset is its place in the file; in a gzip member of
    several records it is the member's place plus the inflated distance. Whoever reads up to
    the end of a range also looks whether the next range begins soundly, as that range only
    sees what is sound.
    """
    file_system_, inner = file_system(path)
    with file_system_.open_input_file(inner) as raw:
        size = raw.size()
        is_zipped = raw.read(2) == _GZIP[:2]
        if is_zipped:
            place = 0 if start == 0 else _first_member(raw, start, end)
        else:
            place = 0 if start == 0 else _first_record(raw, start, end, size)
        while place is not None and place < min(end, max(size, 1)):
            zipped = _GzipStream(raw, place) if is_zipped else None
            if zipped is None:
                raw.seek(place)
            # A small buffer suits hopping from header to header.
            source = io.BufferedReader(zipped, _CHUNK) if zipped else io.BufferedReader(raw, 1 << 16)
            stream = _ByteStream(source, None if zipped else size, 0 if zipped else place)
            at = place
            try:
                while True:
                    offset = stream.position
                    if zipped:
                        member, at = zipped.member_at(offset)
                        offset += at - member
                    else:
                        at = offset
                    line = stream.line()
                    if not line:
                        return
                    if not line.strip(b"\r\n\0"):
                        continue
                    if zipped:  # reading the line may have gone on to the next member
                        member, at = zipped.member_at(stream.position - len(line))
                        offset = at + stream.position - len(line) - member
                    if at >= end and (zipped is None or offset == at):
                        sound = _member_end(raw, at) if zipped else _record_end(raw, at, size)
                        if sound is None:
                            raise _Damaged("no whole record starts here")
                        return
                    if not line.startswith(_RECORD):
                        raise _Damaged("no record starts here")
                    found = _read_record(stream, rec_type, payload, headers)
                    if found is not None:
                        yield {"path": path, "record_offset": offset, **found}
            except _Damaged as damage:
                if zipped:
                    at = zipped.members[-1][1]
                if on_error != "reject":
                    raise OSError(f"{path}: damaged at byte {at}: {damage}") from None
                yield {**dict.fromkeys(_ARROW_TYPES), "path": path, "record_offset": at, "error": str(damage)}
                if at >= end:
                    return
                place = _candidate(raw, at + 1, end) if is_zipped else _first_record(raw, at + 1, end, size)
            finally:
                source.detach()


def _visible(path: str) -> bool:
    return posixpath.basename(path)[:1] not in "._"


def _matches(path: str, pattern: str) -> bool:
    """Whether a path fits a glob, segment by segment: a star does not cross folders."""
    names, globs = path.split("/"), pattern.split("/")
    return len(names) == len(globs) and all(fnmatch.fnmatchcase(n, g) for n, g in zip(names, globs))


def _listed(path: str) -> list[tuple[str, int]]:
    """Files and sizes of a path, folder or glob; names starting with '.' or '_' are hidden."""
    system, inner = file_system(path)
    prefix = path[: len(path) - len(inner)]
    wild = [inner.find(c) for c in "*?[" if c in inner]
    if wild:
        base = posixpath.dirname(inner[: min(wild)])
        found = system.get_file_info(pafs.FileSelector(base, recursive=True))
        found = [f for f in found if _matches(f.path, inner)]
    else:
        found = [system.get_file_info(inner)]
        if found[0].type == pafs.FileType.Directory:
            found = system.get_file_info(pafs.FileSelector(inner, recursive=True))
        elif found[0].type == pafs.FileType.NotFound:
            raise FileNotFoundError(path)
    return [(prefix + f.path, f.size) for f in found if f.is_file and _visible(f.path)]


def _manifest_paths(manifest: str, root: str | None) -> list[tuple[str, str]]:
    """(manifest file, archive path) of one manifest, or of all manifests of a folder."""
    paths = []
    names = [name for name, _ in _listed(manifest)]
    for name in names:
        system, inner = file_system(name)
        with system.open_input_stream(inner) as stream:
            lines = stream.read().decode("utf-8").splitlines()
        for line in filter(None, (line.strip() for line in lines)):
            relative = root and "://" not in line and not line.startswith("/")
            paths.append((manifest if len(names) == 1 else name, posixpath.join(root, line) if relative else line))
    return paths


def _sized(paths: list[str]) -> list[int | None]:
    """Sizes of files, asked for in one call; None for one that is not there."""
    if not paths:
        return []
    system, _ = file_system(paths[0])
    infos = system.get_file_info([file_system(p)[1] for p in paths])
    return [info.size if info.is_file else None for info in infos]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self._path = options.get("path")
        self._manifest = options.get("manifest")
        self._root = options.get("root")
        self._rec_type = options.get("rectype")
        self._payload = options.get("payload", "true").lower() == "true"
        self._headers = options.get("headers", "true").lower() == "true"
        self._split_bytes = int(options.get("maxsplitbytes", 256 << 20))
        self._batch_bytes = int(options.get("batchbytes", 8 << 20))
        self._on_error = options.get("onerror", "fail").lower()
        self._first = int(options["firstrecords"]) if "firstrecords" in options else None
        self._tag = options.get("tagmanifest", "false").lower() == "true"
        if self._on_error not in ("fail", "reject"):
            raise ValueError(f"onError is fail or reject, not {self._on_error}")

    def partitions(self) -> list[ArchiveSplit]:
        if self._manifest:
            named = [pair for m in self._manifest.split("\n") if m for pair in _manifest_paths(m, self._root)]
            listed = [(m, p, size) for (m, p), size in zip(named, _sized([p for _, p in named]))]
        else:
            listed = [(None, path, size) for path, size in _listed(self._path)]
        splits = []
        for manifest, path, size in listed:
            if size is None:
                if self._on_error != "reject":
                    raise FileNotFoundError(path)
                splits.append(ArchiveSplit(path, 0, 0, manifest, "no such archive"))
                continue
            # The last range may be half as long again as the others, and is open-ended.
            count = max(1, round(size / self._split_bytes))
            bounds = [i * self._split_bytes for i in range(count)] + [1 << 62]
            splits += [ArchiveSplit(path, *bound, manifest) for bound in zip(bounds, bounds[1:])]
        if self._first is not None and splits:
            splits.sort(key=lambda split: (split.path, split.start))
            return [ArchiveSplit("", 0, 0, following=tuple(splits))]
        return splits or [ArchiveSplit("", 0, 0)]

    def _rows(self, split: ArchiveSplit) -> Iterator[dict]:
        tag = {"manifest": split.manifest} if self._tag else {}
        if split.error:
            yield {**dict.fromkeys(_ARROW_TYPES), "path": split.path, "record_offset": 0, "error": split.error, **tag}
        elif split.path:
            for row in read_records(split.path, split.start, split.end, self._rec_type, self._payload, self._headers, self._on_error):
                yield {**row, **tag}
        for later in split.following:
            yield from self._rows(later)

    def read(self, partition: ArchiveSplit) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        size = 0
        for row in islice(self._rows(partition), self._first):
            rows.append(row)
            size += 512 + len(row["payload"] or b"")
            if size >= self._batch_bytes:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)


class PushdownWarcReader(WarcReader):
    """Also takes a filter on ``rec_type``; Spark wants filter pushdown switched on for it."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for item in filters:
            if isinstance(item, EqualTo) and item.attribute == ("rec_type",) and self._rec_type in (None, item.value):
                self._rec_type = item.value
            else:
                yield item


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {**_ARROW_TYPES, "manifest": pa.string()} if "manifest" in rows[0] else _ARROW_TYPES
    arrays = [pa.array([row[name] for row in rows], type=kind) for name, kind in kinds.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(kinds))


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> StructType:
        tagged = str(self.options.get("tagManifest", "false")).lower() == "true"
        return StructType([*WARC_SCHEMA.fields, StructField("manifest", StringType())]) if tagged else WARC_SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        options = {key.lower(): value for key, value in self.options.items()}
        pushdown = options.get("pushdown", "false").lower() == "true"
        return PushdownWarcReader(options) if pushdown else WarcReader(options)


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known to the session."""
    spark.dataSource.register(WarcDataSource)


def _stream_rows(options: dict[str, str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = WarcReader(options)
    for batch in batches:
        for path, start, end in zip(*(column.to_pylist() for column in batch.columns)):
            yield from reader.read(ArchiveSplit(path, start, end))


def record_stream(spark: SparkSession, folder: str, files_per_batch: int = 100, **options: str) -> DataFrame:
    """Stream of the records of archives that arrive in a folder; options as for the source.

    Which archives a batch has is in the checkpoint of the query that reads the stream, so a query
    that starts again gives every record once. An archive must have its name only when it is complete.
    """
    lowered = {key.lower(): str(value) for key, value in options.items()}
    size = int(lowered.get("maxsplitbytes", 256 << 20))
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    files = files.option("maxFilesPerTrigger", files_per_batch).load(folder).select("path", "length")
    count = F.greatest(F.lit(1), F.round(F.col("length") / size)).cast("long")
    ranges = files.select("path", count.alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("k"))
    ranges = ranges.select("path", (F.col("k") * size).alias("start"), F.when(F.col("k") == F.col("n") - 1, 1 << 62).otherwise((F.col("k") + 1) * size).alias("end"))
    return ranges.repartition("path", "start").mapInArrow(partial(_stream_rows, lowered), WARC_SCHEMA)
