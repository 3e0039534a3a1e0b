"""WARC archives written by Spark from the crawl pages, to read back."""

from __future__ import annotations

import gzip
import posixpath
import uuid
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.catalog import inputs
from pageloom.session import scratch_dir
from pageloom.sources.warc import file_system


def _record(kind: str, headers: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.0", f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers.items()]]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def response_head(server: str | None) -> bytes:
    lines = ["HTTP/1.1 200 OK", "Content-Type: text/html"]
    if server is not None:
        lines.append(f"Server: {server}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def _page_records(row) -> Iterator[bytes]:
    about = {"WARC-Target-URI": row.host}
    yield _record("request", {**about, "Content-Type": "application/http; msgtype=request"}, b"GET / HTTP/1.1\r\n\r\n")
    if row.ip != "-":
        about["WARC-IP-Address"] = row.ip
    block = response_head(row.server) + (row.html or "").encode()
    yield _record("response", {**about, "Content-Type": "application/http; msgtype=response"}, block)


def _spoilt(record: bytes, zipped: bool) -> bytes:
    """A record that cannot be read: bytes changed inside its gzip member, or a length that is no number."""
    if not zipped:
        return record.replace(b"Content-Length: ", b"Content-Length: x", 1)
    member = gzip.compress(record, 1)
    return member[:60] + bytes(255 - b for b in member[60:76]) + member[76:]


def write_archives(pages: DataFrame, folder: str) -> list[str]:
    """One archive per partition of ``pages``; every other one with a gzip member per record.

    With a column ``archive`` it numbers the archives, and each number lies in one partition,
    sorted. Where a column ``spoilt`` is true, the response of the page is damaged. An
    archive gets its name only when it is complete, so a task that runs again replaces it
    whole. Returns the paths.
    """
    system, inner = file_system(folder)
    system.create_dir(inner)
    numbered, damaged = "archive" in pages.columns, "spoilt" in pages.columns

    def write_one(number: int, rows: list) -> str:
        zipped = number % 2 == 1
        name = f"part-{number:05d}.warc" + (".gz" if zipped else "")
        worker_system, base = file_system(folder)
        hidden = posixpath.join(base, f".{name}.{uuid.uuid4().hex}")
        with worker_system.open_output_stream(hidden, compression=None) as out:

            def put(record: bytes) -> None:
                out.write(gzip.compress(record, 1) if zipped else record)

            put(_record("warcinfo", {"Content-Type": "application/warc-fields"}, b"software: pageloom\r\n"))
            for row in rows:
                request, response = _page_records(row)
                put(request)
                if damaged and row.spoilt:
                    out.write(_spoilt(response, zipped))
                else:
                    put(response)
        worker_system.move(hidden, posixpath.join(base, name))
        return posixpath.join(folder, name)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        rows = (row for batch in batches for row in batch.itertuples(index=False))
        for number, own in groupby(rows, lambda row: row.archive if numbered else part):
            yield pd.DataFrame({"path": [write_one(number, own)]})

    return sorted(row.path for row in pages.mapInPandas(write, "path string").collect())


#: Archives of the crawl; a page lies in the one that its number leaves as a remainder.
ARCHIVES = 8


_MADE: dict[tuple[str, str, str], tuple[str, list[str]]] = {}


def _there(paths: list[str]) -> bool:
    """Whether nobody has cleared the folder in the meantime."""
    return all(system.get_file_info(inner).is_file for system, inner in map(file_system, paths))


def crawl_archives(spark: SparkSession, sf_dir: str, spoilt: str = "false") -> tuple[str, list[str]]:
    """Folder and paths of archives that hold the crawl pages; ``spoilt`` tells whose responses are damaged.

    An application writes them once: they are an input, not a part of what reads them.
    """
    made = (spark.sparkContext.applicationId, sf_dir, spoilt)
    if made not in _MADE or not _there(_MADE[made][1]):
        folder = scratch_dir(spark, "archives")
        pages = inputs.pages(spark, sf_dir).withColumn("archive", F.expr(f"CAST(page_id % {ARCHIVES} AS int)")).withColumn("spoilt", F.expr(spoilt))
        _MADE[made] = folder, write_archives(pages.repartition(ARCHIVES, "archive").sortWithinPartitions("archive", "page_id"), folder)
    return _MADE[made]


def write_lines(path: str, lines: list[str]) -> None:
    """A small text file in the shared folder."""
    system, inner = file_system(path)
    system.create_dir(posixpath.dirname(inner))
    with system.open_output_stream(inner, compression=None) as out:
        out.write(("\n".join(lines) + "\n").encode())
