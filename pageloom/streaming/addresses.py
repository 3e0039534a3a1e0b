"""One row per address over all published parts, kept up to date part by part.

The kept table holds minima: each merge adds only the rows of the new parts that are less
than what is known of their address, in slots by a hash of the address. Minima may be added
twice or in any order, so a merge that is run again, or that breaks off, spoils nothing. Reading
takes the least row of each address, and folding writes a slot anew without what is beaten.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.operators.profile import dedupe_by_ip
from pageloom.sources.tabular import write_parquet
from pageloom.sources.warc import file_system
from pageloom.streaming import ledger
from pageloom.streaming.publish import Outputs, _among, read_features

#: Folders that the addresses are dealt out to.
SLOTS = 64
KEPT_SCHEMA = "ip string, host string, server string, slot int"
_DONE_SCHEMA = "attempt string, year string, part string"
_ROW = ["ip", "host", "server"]


def _kept(spark: SparkSession, path: str) -> DataFrame:
    system, inner = file_system(path)
    if system.get_file_info(inner).type == pafs.FileType.NotFound:
        return spark.createDataFrame([], KEPT_SCHEMA)
    return spark.read.schema(KEPT_SCHEMA).parquet(path)


def merge(spark: SparkSession, path: str, hosts: DataFrame) -> None:
    """Add rows (ip, host, server) to the table of minima at ``path``.

    Read are ``hosts`` and, of the kept table, the slots and the addresses that ``hosts`` has.
    """
    slot = F.pmod(F.xxhash64("ip"), F.lit(SLOTS)).cast("int").alias("slot")
    new = dedupe_by_ip(hosts.select(*_ROW)).select(*_ROW, slot)
    met = _kept(spark, path).join(new.select("slot", "ip"), ["slot", "ip"], "left_semi")
    known = met.groupBy("slot", "ip").agg(F.min(F.struct("host", "server")).alias("known"))
    row = F.struct("host", "server")
    better = new.join(known, ["slot", "ip"], "left").where(F.col("known").isNull() | (row < F.col("known")))
    write_parquet(better.select(*_ROW, "slot"), path, "append", ["slot"])


def addresses(spark: SparkSession, path: str) -> DataFrame:
    """(ip, host, server), one row per address: the same as ``dedupe_by_ip`` over all rows that were merged."""
    return dedupe_by_ip(_kept(spark, path).select(*_ROW))


def merge_published(spark: SparkSession, outputs: Outputs, path: str) -> int:
    """Merge the complete parts that were not merged yet; their number.

    Which ones were is noted after the merge: if it breaks off they are merged again, which changes nothing.
    """
    noted = f"{path}-merged"
    system, inner = file_system(noted)
    there = system.get_file_info(inner).type != pafs.FileType.NotFound
    done = spark.read.schema(_DONE_SCHEMA).parquet(noted) if there else spark.createDataFrame([], _DONE_SCHEMA)
    keys = ["attempt", "year", "part"]
    todo = ledger.completed(ledger.read(spark, outputs.ledger)).select(*keys).join(done, keys, "left_anti").collect()
    if todo:
        merge(spark, path, read_features(spark, outputs).where(_among([tuple(r) for r in todo], *keys)))
        spark.createDataFrame(todo, _DONE_SCHEMA).coalesce(1).write.mode("append").parquet(noted)
    return len(todo)


def _delete(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["path"]:
            system, inner = file_system(path)
            if system.get_file_info(inner).is_file:
                system.delete_file(inner)
        yield batch


def fold(spark: SparkSession, path: str, files: int = 8, older_than: timedelta = timedelta(days=1), now: datetime | None = None) -> int:
    """Write the slots with more than ``files`` files anew, one file each, and remove their old files; the number of slots.

    The new file is there before an old one goes, and files younger than the age stay for readers that know them.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    found = found.select("path", "modificationTime", F.regexp_extract("path", "/slot=([0-9]+)/", 1).alias("slot")).where("slot <> ''")
    full = [r["slot"] for r in found.groupBy("slot").agg(F.count("*").alias("n")).where(F.col("n") > files).collect()]  # of SLOTS ones
    if not full:
        return 0
    before = F.lit((now or datetime.now(timezone.utc)) - older_than)
    old = found.where(F.col("slot").isin(full) & (F.col("modificationTime") < before)).select("path").collect()
    least = _kept(spark, path).where(F.col("slot").isin([int(s) for s in full])).repartition("slot")
    rows = least.groupBy("slot", "ip").agg(F.min(F.struct("host", "server")).alias("row")).select("ip", "row.*", "slot")
    write_parquet(rows, path, "append", ["slot"])
    gone = spark.createDataFrame(old, "path string")
    gone.mapInPandas(_delete, gone.schema).write.format("noop").mode("overwrite").save()
    return len(full)
