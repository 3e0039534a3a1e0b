"""Queries on streaming, publishing and the ledger."""

from __future__ import annotations

import math
import posixpath
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.catalog import inputs
from pageloom.catalog.archives import ARCHIVES, crawl_archives, write_lines
from pageloom.catalog.extraction import features_oracle, piped, script_table
from pageloom.catalog.registry import query, with_inputs
from pageloom.catalog.scalars import IP_INT, RANGES
from pageloom.operators.joins import skew_join
from pageloom.operators.manifest import pending_parts
from pageloom.session import scratch_dir
from pageloom.sources.tabular import pipe_arrays, write_parquet
from pageloom.streaming import addresses, ledger, upkeep
from pageloom.streaming.publish import Outputs, Publisher, manifest_stream, published, read_features, read_geo

_LEDGER = {"ledger": inputs.LEDGER}
_STATUS = """
SELECT year, part, CASE WHEN count(DISTINCT task) = 2 AND bool_and(status = 'success') THEN 'success' ELSE 'failed' END
       AS status, count(*) AS n_tasks, min(error) AS error, CAST(sum(took) AS DOUBLE) AS seconds
FROM ledger GROUP BY year, part
"""


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit("2024-09-01 00:00:00").cast("timestamp")
    rows = inputs.derived(spark, sf_dir, inputs.LEDGER)
    rows = rows.withColumns({"attempt": F.lit("1"), "started_at": start})
    return rows.withColumn("finished_at", F.timestamp_seconds(F.unix_seconds(start) + F.col("took")))


@query("ledger_status", with_inputs(_STATUS, **_LEDGER))
def ledger_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.ledger_status(_ledger(spark, sf_dir))


@query(
    "ledger_summary",
    with_inputs(
        "SELECT year, status, count(*) AS n_parts, sum(seconds) AS seconds FROM parts GROUP BY year, status",
        **_LEDGER,
        parts=_STATUS,
    ),
)
def ledger_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.ledger_summary(_ledger(spark, sf_dir))


_PARTS_BY_YEAR = """
SELECT CAST(2018 + o_orderkey % 7 + shift AS STRING) AS year, concat('warc_part_', CAST(o_orderkey AS STRING)) AS part
FROM orders, (SELECT 0 AS shift UNION ALL SELECT 1) AS shifts
"""


@query(
    "ledger_pending_anti",
    with_inputs(
        "SELECT n.year, n.part FROM names n WHERE NOT EXISTS "
        "(SELECT 1 FROM parts p WHERE p.status = 'success' AND p.year = n.year AND p.part = n.part)",
        **_LEDGER,
        parts=_STATUS,
        names=_PARTS_BY_YEAR,
    ),
)
def ledger_pending_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part number stands in two years, and the ledger has it for one of them at most."""
    return pending_parts(inputs.derived(spark, sf_dir, _PARTS_BY_YEAR), _ledger(spark, sf_dir))


@query(
    "stream_manifest_batches",
    with_inputs("SELECT path FROM manifest", manifest=inputs.MANIFEST),
)
def stream_manifest_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, target = scratch_dir(spark, "manifests"), scratch_dir(spark, "batches")
    rows = inputs.derived(spark, sf_dir, inputs.MANIFEST)
    rows.write.text(folder)
    # About four micro-batches, however many files there are.
    n_files = spark.read.text(folder).select("_metadata.file_path").distinct().count()

    def keep(lines: DataFrame, batch_id: int) -> None:
        write_parquet(lines.withColumn("batch_id", F.lit(batch_id)), target, "overwrite", ["batch_id"])

    stream = manifest_stream(spark, folder, math.ceil(n_files / 4)).writeStream.foreachBatch(keep)
    run = stream.option("checkpointLocation", scratch_dir(spark, "checkpoint")).trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(target).select("path")


_PARTS = 4
_PUBLISHED = features_oracle(
    f"SELECT '2024' AS year, concat('warc_part_00', CAST(f.page_id % {ARCHIVES} // {ARCHIVES // _PARTS} + 1 AS VARCHAR)) AS part, f.ip, f.host, f.server, {piped('emails')} AS emails, "
    f"{piped('kept_srcs')} AS script_src_attrs, country_name FROM features f LEFT JOIN best USING (ip)",
    blocks=inputs.GEO_BLOCKS,
    locations=inputs.GEO_LOCATIONS,
    ranges=RANGES,
    best="SELECT ip, country_name FROM (SELECT ip, geoname_id, row_number() OVER (PARTITION BY ip "
    "ORDER BY cidr_end - cidr_start) AS nth FROM (SELECT ip, " + IP_INT + " AS ip_int FROM "
    "(SELECT DISTINCT ip FROM features)) JOIN ranges ON ip_int BETWEEN cidr_start AND cidr_end) "
    "LEFT JOIN locations USING (geoname_id) WHERE nth = 1",
)


def _publisher(spark: SparkSession, sf_dir: str) -> tuple[Publisher, Outputs, str]:
    """A publisher of the crawl archives, its target, and a folder with manifests of sound and of broken parts."""
    folder, paths = crawl_archives(spark, sf_dir)
    manifests = scratch_dir(spark, "manifests")
    size = len(paths) // _PARTS
    for i in range(_PARTS):
        names = [posixpath.basename(p) for p in paths[i * size : (i + 1) * size]]
        write_lines(posixpath.join(manifests, f"warc_part_{i + 1:03d}_2024.txt"), names)
    # One more part repeats an archive and names one that does not exist: none of it may appear.
    broken = [posixpath.basename(paths[0]), "no-such-archive.warc.gz"]
    write_lines(posixpath.join(manifests, f"warc_part_{_PARTS + 1:03d}_2024.txt"), broken)
    # And one has archives with a damaged record in each.
    _, damaged = crawl_archives(spark, sf_dir, "page_id % 8 = page_id % 25")
    write_lines(posixpath.join(manifests, f"warc_part_{_PARTS + 2:03d}_2024.txt"), damaged)
    outputs = Outputs(scratch_dir(spark, "published"))
    geo_inputs = inputs.blocks(spark, sf_dir), inputs.locations(spark, sf_dir)
    return Publisher(spark, outputs, *geo_inputs, default_year="2024", archive_root=folder), outputs, manifests


def _with_countries(spark: SparkSession, outputs: Outputs) -> DataFrame:
    features = published(spark, read_features(spark, outputs), outputs)
    countries = published(spark, read_geo(spark, outputs), outputs).select("year", "part", "ip", "country_name")
    return pipe_arrays(skew_join(features, countries, ["year", "part", "ip"], "left"))


@query("publish_atomic", _PUBLISHED)
def publish_atomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    publisher, outputs, manifests = _publisher(spark, sf_dir)
    publisher.run(manifests).awaitTermination()
    return _with_countries(spark, outputs)


@query("publish_upkeep", _PUBLISHED)
def publish_upkeep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows after parts were published twice, their files merged, and all other attempts removed."""
    publisher, outputs, manifests = _publisher(spark, sf_dir)
    publisher.run(manifests).awaitTermination()
    publisher.publish([posixpath.join(manifests, f"warc_part_{i:03d}_2024.txt") for i in (1, 2)], batch_id=1)
    upkeep.compact(spark, outputs)
    upkeep.clean_up(spark, outputs, timedelta(0))
    return _with_countries(spark, outputs)


@query("published_layout", features_oracle(
    "SELECT kind, '2024' AS year, concat('warc_part_00', CAST(part AS VARCHAR)) AS part, 1 AS n_attempts, 1 AS n_files, 1 AS n_read "
    f"FROM (SELECT DISTINCT page_id % {ARCHIVES} // {ARCHIVES // _PARTS} + 1 AS part FROM features), (VALUES ('features'), ('geo')) AS kinds (kind)"))
def published_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lies in the folders after upkeep: of each part one attempt, and one file of it."""
    publisher, outputs, manifests = _publisher(spark, sf_dir)
    publisher.run(manifests).awaitTermination()
    upkeep.compact(spark, outputs)
    upkeep.clean_up(spark, outputs, timedelta(0))
    return upkeep.layout(spark, outputs).withColumns({c: F.col(c).cast("int") for c in ("n_attempts", "n_files", "n_read")})


@query("published_addresses", features_oracle(
    "SELECT ip, host, server FROM (SELECT ip, host, server, row_number() OVER (PARTITION BY ip ORDER BY host, server NULLS FIRST) AS nth "
    "FROM features) WHERE nth = 1"))
def published_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per address of pages that came in five batches, each merged into a kept table."""
    path = scratch_dir(spark, "addresses")
    rows = inputs.pages(spark, sf_dir).select("page_id", "ip", "host", "server")
    for batch in range(5):
        addresses.merge(spark, path, rows.where(F.col("page_id") % 5 == batch))
    addresses.fold(spark, path, files=4, older_than=timedelta(0))
    return addresses.addresses(spark, path)


@query(
    "year_partitioned_scan",
    features_oracle(
        f"SELECT page_id, host, {piped('kept_srcs')} AS script_src_attrs, CAST(2013 + page_id % 12 AS INTEGER) AS year "
        "FROM features WHERE 2013 + page_id % 12 >= 2020"
    ),
)
def year_partitioned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "years")
    table = script_table(spark, sf_dir).withColumn("year", (2013 + F.col("page_id") % 12).cast("int"))
    write_parquet(table, path, "overwrite", ["year"])
    recent = spark.read.parquet(path).where("year >= 2020")
    return pipe_arrays(recent.select("page_id", "host", "script_src_attrs", "year"))
