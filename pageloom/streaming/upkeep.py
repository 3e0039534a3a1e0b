"""Upkeep of published tables: small files become larger ones, and what nobody sees any more goes.

Both steps follow the ledger. Compaction writes the rows of a part's last complete attempt
again under an attempt of its own, and the ledger rows that follow make it the one that is
read; nothing of the old one is touched. Clean-up removes attempts that are not the ones
that are read, once both they and the attempt that took their place are older than a given age,
so a reader that planned before the change still finds its files.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.sources.tabular import write_parquet
from pageloom.sources.warc import file_system
from pageloom.streaming import ledger
from pageloom.streaming.publish import Outputs, _among, read_features, read_geo

_KEYS = ["attempt", "year", "part"]
#: Size of a file that compaction aims at.
FILE_BYTES = 256 << 20


def _value(path: Column, key: str) -> Column:
    """The value of a partition column in a path; what is escaped there becomes itself again."""
    raw = F.regexp_extract(path, f"/{key}=([^/]*)/", 1)
    return F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))


def attempt_files(spark: SparkSession, folder: str) -> DataFrame:
    """(attempt, year, part, folder, n_files, bytes, touched) of what lies in a table's folder, complete or not."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
    files = files.select(*[_value(F.col("path"), k).alias(k) for k in _KEYS], F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"),
                         "length", "modificationTime")
    return files.groupBy(*_KEYS, "folder").agg(
        F.count("*").alias("n_files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("touched"))


def compact(spark: SparkSession, outputs: Outputs, file_bytes: int = FILE_BYTES) -> int:
    """Write parts again that have more files than their bytes need; their number.

    A part that is published anew in the meantime wins: the new attempt counts as finished a
    microsecond after the one it was made from.
    """
    entries = ledger.read(spark, outputs.ledger)
    done = ledger.completed(entries).select(*_KEYS)
    tables = {outputs.features: read_features(spark, outputs), outputs.geo: read_geo(spark, outputs)}
    sizes = {folder: done.join(attempt_files(spark, folder), _KEYS).select(*_KEYS, "n_files", "bytes").collect() for folder in tables}
    needed = {folder: {tuple(r[k] for k in _KEYS): max(1, math.ceil(r["bytes"] / file_bytes)) for r in rows} for folder, rows in sizes.items()}
    # the list of parts is small by construction: the ledger has two rows for each
    todo = sorted({tuple(r[k] for k in _KEYS) for folder, rows in sizes.items() for r in rows if r["n_files"] > needed[folder][tuple(r[k] for k in _KEYS)]})
    if not todo:
        return 0
    attempt = f"compact-{uuid.uuid4().hex}"
    for folder, rows in tables.items():
        own = rows.where(_among(todo, *_KEYS))
        shares = spark.createDataFrame([(*key, needed[folder].get(key, 1)) for key in todo], "attempt string, year string, part string, files int")
        own = own.join(F.broadcast(shares), _KEYS)  # as many rows as parts, see above
        columns = [c for c in rows.columns if c not in _KEYS]
        share = F.pmod(F.xxhash64(*columns), F.col("files")).alias("share")
        dealt = own.withColumn("share", share).repartition("year", "part", "share").drop("share", "files")
        write_parquet(dealt.withColumn("attempt", F.lit(attempt)), folder, "append", _KEYS)
    moment = F.expr("INTERVAL 1 MICROSECOND")
    again = entries.where(_among(todo, *_KEYS)).withColumns(
        {"attempt": F.lit(attempt), "started_at": F.col("started_at") + moment, "finished_at": F.col("finished_at") + moment})
    ledger.append(again, outputs.ledger)
    return len(todo)


def unused(spark: SparkSession, outputs: Outputs, older_than: timedelta, now: datetime | None = None) -> DataFrame:
    """(attempt, year, part, folder) that no reader sees, and that are older than the age with what took their place."""
    before = F.lit((now or datetime.now(timezone.utc)) - older_than)
    found = attempt_files(spark, outputs.features).union(attempt_files(spark, outputs.geo))
    read = ledger.completed(ledger.read(spark, outputs.ledger)).select(*_KEYS)
    kept = found.join(read, _KEYS, "left_semi")
    young = kept.groupBy("year", "part").agg(F.max("touched").alias("replaced")).where(F.col("replaced") >= before)
    old = found.where(F.col("touched") < before).join(read, _KEYS, "left_anti")
    return old.join(young, ["year", "part"], "left_anti").select(*_KEYS, "folder")


def _delete(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for folder in batch["folder"]:
            system, inner = file_system(folder)
            if system.get_file_info(inner).type == pafs.FileType.Directory:  # a task that runs again finds it gone
                system.delete_dir(inner)
        yield batch


def clean_up(spark: SparkSession, outputs: Outputs, older_than: timedelta = timedelta(days=1), now: datetime | None = None) -> list[tuple[str, str, str]]:
    """Remove what ``unused`` finds; the (attempt, year, part) that went.

    Attempts without a complete ledger entry and attempts that others took the place of go.
    The age must be longer than a batch or a read takes. Ledger rows stay as a record.
    """
    gone = unused(spark, outputs, older_than, now)
    rows = gone.mapInPandas(_delete, gone.schema).select(*_KEYS).distinct().collect()
    return sorted(tuple(r) for r in rows)


def layout(spark: SparkSession, outputs: Outputs) -> DataFrame:
    """Per table, year and part: attempts that lie there, files of all of them, and files of the one that is read."""
    read = ledger.completed(ledger.read(spark, outputs.ledger)).select(*_KEYS, F.lit(1).alias("is_read"))
    names = {"features": outputs.features, "geo": outputs.geo}
    found = [attempt_files(spark, folder).withColumn("kind", F.lit(name)) for name, folder in names.items()]
    both = found[0].union(found[1]).join(read, _KEYS, "left")
    return both.groupBy("kind", "year", "part").agg(
        F.count("*").alias("n_attempts"), F.sum("n_files").alias("n_files"), F.coalesce(F.sum(F.col("n_files") * F.col("is_read")), F.lit(0)).alias("n_read"))
