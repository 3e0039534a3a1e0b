"""Queries that read the pages back from WARC archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.catalog import inputs
from pageloom.catalog.archives import ARCHIVES, crawl_archives, response_head
from pageloom.catalog.extraction import features_oracle, piped
from pageloom.catalog.registry import query, with_inputs
from pageloom.functions.headers import content_columns, record_columns
from pageloom.functions.html import payload_text
from pageloom.operators.profile import record_profile
from pageloom.plans.extraction import responses, script_extraction, wide_extraction
from pageloom.session import scratch_dir
from pageloom.sources import warc
from pageloom.sources.tabular import pipe_arrays

_CRAWL = {"crawl_pages": inputs.CRAWL_PAGES}
_HEAD_BYTES = len(response_head(None))
# "Server: name" and its line end.
_BLOCK_BYTES = f"{_HEAD_BYTES} + coalesce(strlen(server) + {len('Server: ') + 2}, 0) + strlen(html)"


@query(
    "warc_scan",
    with_inputs(
        "SELECT 'response' AS rec_type, host, '200' AS http_status, html FROM crawl_pages",
        **_CRAWL,
    ),
)
def warc_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = crawl_archives(spark, sf_dir)
    warc.register(spark)
    records = spark.read.format("warc").load(folder).where("rec_type = 'response'")
    return records.select(
        "rec_type", record_columns()[1], "http_status", payload_text(F.col("payload")).alias("html")
    )


_SPOILT = "page_id % 25 = 7"


@query(
    "warc_damaged",
    with_inputs(
        f"SELECT 'page' AS kind, host AS name, CAST(1 AS BIGINT) AS n FROM crawl_pages WHERE NOT ({_SPOILT}) "
        "UNION ALL SELECT 'lost', concat('part-', lpad(CAST(archive AS VARCHAR), 5, '0'), '.warc', "
        "CASE WHEN archive % 2 = 1 THEN '.gz' ELSE '' END), count(*) "
        f"FROM (SELECT page_id % {ARCHIVES} AS archive FROM crawl_pages WHERE {_SPOILT}) GROUP BY archive",
        **_CRAWL,
    ),
)
def warc_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives with damaged records: every other page, and what each archive has lost."""
    folder, _ = crawl_archives(spark, sf_dir, _SPOILT)
    warc.register(spark)
    records = spark.read.format("warc").options(payload="false", onError="reject").load(folder)
    pages = records.where("rec_type = 'response'").select(F.lit("page").alias("kind"), record_columns()[1].alias("name"), F.lit(1).cast("long").alias("n"))
    lost = records.where("error IS NOT NULL").groupBy(F.element_at(F.split("path", "/"), -1).alias("name")).agg(F.count("*").alias("n"))
    return pages.unionByName(lost.select(F.lit("lost").alias("kind"), "name", "n"))


@query(
    "warc_record_profile",
    "SELECT 'request' AS rec_type, 'application/http; msgtype=request' AS content_type, count(*) AS n_records FROM pages "
    "UNION ALL SELECT 'response', 'application/http; msgtype=response', count(*) FROM pages "
    f"UNION ALL SELECT 'warcinfo', 'application/warc-fields', count(DISTINCT page_id % {ARCHIVES}) FROM pages",
)
def warc_record_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = crawl_archives(spark, sf_dir)
    warc.register(spark)
    records = spark.read.format("warc").options(payload="false", headers="false").load(folder)
    return record_profile(records)


@query(
    "warc_head",
    with_inputs("SELECT host, ip FROM (SELECT host, nullif(ip, '-') AS ip FROM crawl_pages) ORDER BY host, ip LIMIT 20", **_CRAWL),
)
def warc_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = crawl_archives(spark, sf_dir)
    ip, host, _ = record_columns(default=None)
    return responses(spark, payload=False, path=folder).select(host, ip).orderBy("host", "ip").limit(20)


@query(
    "warc_first_records",
    with_inputs(
        f"SELECT host, nullif(ip, '-') AS ip FROM crawl_pages ORDER BY page_id % {ARCHIVES}, page_id LIMIT 40", **_CRAWL),
)
def warc_first_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 40 responses by archive and place; no archive behind them is opened."""
    folder, _ = crawl_archives(spark, sf_dir)
    ip, host, _ = record_columns(default=None)
    return responses(spark, payload=False, path=folder, firstRecords="40").select(host, ip)


@query("warc_stream", with_inputs("SELECT host, nullif(ip, '-') AS ip FROM crawl_pages", **_CRAWL))
def warc_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of archives that are read as a stream, three archives at a time."""
    folder, _ = crawl_archives(spark, sf_dir)
    target = scratch_dir(spark, "streamed")
    ip, host, _ = record_columns(default=None)
    rows = warc.record_stream(spark, folder, 3, recType="response", payload="false").select(host, ip)
    writer = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", scratch_dir(spark, "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(target)


@query(
    "header_projection",
    with_inputs(
        "SELECT ip, host, server, 'application/http; msgtype=response' AS content_type, "
        f"CAST({_BLOCK_BYTES} AS VARCHAR) AS content_length, CAST({_BLOCK_BYTES} AS BIGINT) AS content_bytes "
        "FROM crawl_pages",
        **_CRAWL,
    ),
)
def header_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = crawl_archives(spark, sf_dir)
    return responses(spark, payload=False, path=folder).select(*record_columns(), *content_columns())


@query(
    "script_extraction",
    features_oracle(
        f"SELECT '2024' AS year, ip, host, server, {piped('emails')} AS emails, "
        f"{piped('kept_srcs')} AS script_src_attrs FROM features"
    ),
)
def script_extraction_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = crawl_archives(spark, sf_dir)
    return pipe_arrays(script_extraction(responses(spark, path=folder), "2024"))


@query(
    "wide_extraction",
    features_oracle(
        "SELECT host AS warc_target_uri, nullif(ip, '-') AS warc_ip_address, "
        "'application/http; msgtype=response' AS content_type, server, page_title, page_description, keywords, "
        f"{piped('emails')} AS emails, {piped('srcs')} AS script_src_attrs, {piped('types')} AS script_type_attrs, "
        f"content_length FROM features JOIN (SELECT page_id, CAST({_BLOCK_BYTES} AS VARCHAR) AS content_length FROM crawl_pages) USING (page_id)"
    ),
)
def wide_extraction_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = crawl_archives(spark, sf_dir)
    return pipe_arrays(wide_extraction(responses(spark, path=folder)))
