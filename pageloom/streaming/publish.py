"""Incremental publishing: manifests stream in, parts come out whole or not at all.

Each manifest file is one part. All manifests of a micro-batch are one attempt: one job reads
their archives and writes the page features of all parts, one writes the address tables of the
parts that were read without damage, and the ledger rows follow last. Damage is a row of the
part it belongs to and fails that part alone. Tables lie under ``attempt=/year=/part=``.
Readers see of each part the last attempt that the ledger has with both tasks as successes: a
half-written or failed attempt is never seen, and takes nothing away.
"""

from __future__ import annotations

import os
import re
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyarrow.fs import FileType
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.streaming import StreamingQuery

from pageloom.operators.geo import GEO_13
from pageloom.plans.enrichment import ip_geo_table
from pageloom.plans.extraction import responses, script_extraction
from pageloom.sources.tabular import write_parquet
from pageloom.sources.warc import file_system
from pageloom.streaming import ledger

_PARTITIONS = "attempt string, year string, part string"
_KEYS = ["attempt", "year", "part"]
FEATURES_SCHEMA = (
    f"ip string, host string, server string, emails array<string>, script_src_attrs array<string>, {_PARTITIONS}"
)
_WRITTEN_SCHEMA = f"error string, {FEATURES_SCHEMA}"
_PART_NAME = re.compile(r"(?P<part>.+?)(?:_(?P<year>[0-9]{4}))?\.txt")


@dataclass(frozen=True)
class Outputs:
    """Folders of one publishing target."""

    base: str

    @property
    def features(self) -> str:
        return os.path.join(self.base, "script_extraction")

    @property
    def geo(self) -> str:
        return os.path.join(self.base, "ip_geo")

    @property
    def ledger(self) -> str:
        return os.path.join(self.base, "ledger")

    @property
    def checkpoint(self) -> str:
        return os.path.join(self.base, "checkpoint")


def geo_schema() -> StructType:
    keys = StructType.fromDDL("ip string, host string, server string")
    fields = [StructField(name, kind) for name, kind in GEO_13.items()]
    return StructType([*keys.fields, *fields, *StructType.fromDDL(_PARTITIONS).fields])


def part_of(manifest: str, default_year: str) -> tuple[str, str]:
    """Part name and year of a manifest file such as ``warc_part_001_2024.txt``."""
    match = _PART_NAME.fullmatch(os.path.basename(manifest))
    if match is None:
        return os.path.basename(manifest), default_year
    return match["part"], match["year"] or default_year


def _part_columns(manifest: Column, default_year: str) -> tuple[Column, Column]:
    """``part_of`` of a column."""
    name = F.regexp_extract(manifest, "[^/]*$", 0)
    fits = f"^{_PART_NAME.pattern.replace('?P<', '?<')}$"
    part, year = F.regexp_extract(name, fits, 1), F.regexp_extract(name, fits, 2)
    return F.when(part == "", name).otherwise(part), F.when(year == "", F.lit(default_year)).otherwise(year)


def manifest_stream(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """Stream of (path, manifest) over the manifest files of a folder."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(folder)
    return lines.select(F.trim("value").alias("path"), F.col("_metadata.file_path").alias("manifest")).where(
        F.col("path") != ""
    )


class Publisher:
    """Runs both tasks for the parts of a batch and keeps the ledger."""

    def __init__(
        self,
        spark: SparkSession,
        outputs: Outputs,
        blocks: DataFrame,
        locations: DataFrame,
        default_year: str,
        archive_root: str | None = None,
    ) -> None:
        self._spark = spark
        self._outputs = outputs
        self._blocks = blocks
        self._locations = locations
        self._default_year = default_year
        self._source = {"root": archive_root} if archive_root else {}

    def _write_features(self, manifests: list[str], attempt: str) -> None:
        records = responses(self._spark, manifest="\n".join(manifests), tagManifest="true", onError="reject", **self._source)
        part, year = _part_columns(F.col("manifest"), self._default_year)
        where = F.concat(F.col("path"), F.lit(": "), F.col("error"), F.lit(", byte "), F.col("record_offset"))
        rows = script_extraction(records, year, part.alias("part"), F.lit(attempt).alias("attempt"), where.alias("error"))
        write_parquet(rows, self._outputs.features, "append", _KEYS)

    def _damaged(self, attempt: str) -> dict[tuple[str, str], str]:
        """The first error of each part that has one."""
        errors = _own(self._spark, self._outputs.features, _WRITTEN_SCHEMA, attempt).where("error IS NOT NULL")
        found = errors.groupBy("year", "part").agg(F.min("error").alias("error")).collect()
        return {(r.year, r.part): r.error for r in found}

    def _write_geo(self, sound: list[tuple[str, str]], attempt: str) -> None:
        # The addresses come from the table just written: archives are read once.
        hosts = _own(self._spark, self._outputs.features, FEATURES_SCHEMA, attempt).where(_among(sound, "year", "part"))
        rows = ip_geo_table(hosts, self._blocks, self._locations, by=("year", "part")).withColumn("attempt", F.lit(attempt))
        write_parquet(rows, self._outputs.geo, "append", _KEYS)

    def publish(self, manifests: list[str], batch_id: int = 0) -> None:
        """Both tasks for all manifests, then their ledger rows; a part that fails the first has no second."""
        attempt = f"{batch_id}-{uuid.uuid4().hex}"
        parts = sorted({part_of(m, self._default_year)[::-1] for m in manifests})
        rows: list[tuple] = []

        def note(task: str, started: datetime, errors: dict[tuple[str, str], str | None]) -> None:
            ended = datetime.now(timezone.utc)
            rows.extend((task, "failed" if e else "success", e, batch_id, started, ended, *key, attempt) for key, e in errors.items())

        started = datetime.now(timezone.utc)
        try:
            self._write_features(sorted(set(manifests)), attempt)
            damaged = self._damaged(attempt)
        except Exception as failure:  # what fails the whole batch belongs in the ledger for each of its parts
            damaged = dict.fromkeys(parts, str(failure))
        note("script", started, {p: damaged.get(p) for p in parts})
        sound = [p for p in parts if p not in damaged]
        if sound:
            started, error = datetime.now(timezone.utc), None
            try:
                self._write_geo(sound, attempt)
            except Exception as failure:
                error = str(failure)
            note("geo", started, dict.fromkeys(sound, error))
        ledger.append(self._spark.createDataFrame(rows, ledger.LEDGER_SCHEMA), self._outputs.ledger)

    def publish_batch(self, lines: DataFrame, batch_id: int) -> None:
        """All manifests of a micro-batch; their number is bounded by the stream's setting."""
        manifests = [row.manifest for row in lines.select("manifest").distinct().collect()]
        if manifests:
            self.publish(manifests, batch_id)

    def run(self, manifest_folder: str, files_per_batch: int = 1_000) -> StreamingQuery:
        """Publish the manifests that are there and not yet done, then stop."""
        return (
            manifest_stream(self._spark, manifest_folder, files_per_batch)
            .writeStream.foreachBatch(self.publish_batch)
            .option("checkpointLocation", self._outputs.checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def _among(keys: list[tuple], *columns: str) -> Column:
    """Whether the columns have one of the keys; over partition columns it chooses the folders that are read."""
    joined = F.concat_ws("\n", *columns)
    return joined.isin(["\n".join(key) for key in keys])


def _own(spark: SparkSession, folder: str, schema: str, attempt: str) -> DataFrame:
    """The rows of one attempt; only its folder is listed."""
    own = os.path.join(folder, f"attempt={attempt}")
    system, inner = file_system(own)
    if system.get_file_info(inner).type == FileType.NotFound:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", folder).parquet(own)


def read_features(spark: SparkSession, outputs: Outputs) -> DataFrame:
    written = spark.read.schema(_WRITTEN_SCHEMA).parquet(outputs.features)
    return written.where("error IS NULL").drop("error")


def read_geo(spark: SparkSession, outputs: Outputs) -> DataFrame:
    return spark.read.schema(geo_schema()).parquet(outputs.geo)


def published(spark: SparkSession, table: DataFrame, outputs: Outputs) -> DataFrame:
    """Rows of ``table`` that belong to complete parts, each of its last complete attempt.

    The ledger has two rows per part, so its list of parts is small by construction. It
    chooses folders when the plan is made: files of other attempts are never opened.
    """
    done = ledger.completed(ledger.read(spark, outputs.ledger)).select(*_KEYS).collect()
    return table.where(_among([tuple(key) for key in done], *_KEYS)).drop("attempt")
