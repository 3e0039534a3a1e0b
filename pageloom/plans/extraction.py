"""Page feature tables from archive records or from pages with their HTML text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import html
from pageloom.functions.headers import content_columns, record_columns
from pageloom.sources import warc

TAGS = "_tags"


def with_tags(pages: DataFrame, newline: str = "") -> DataFrame:
    """Replace the text column ``html`` by the tags the features are read from."""
    return pages.withColumn(TAGS, html.page_tags(html.normalize_html(F.col("html"), newline=newline))).drop("html")


def script_features(pages: DataFrame) -> DataFrame:
    """``pages`` with ``emails`` and ``script_src_attrs`` (no ``data:`` sources) for its ``html``."""
    return with_tags(pages).select(
        *[c for c in pages.columns if c != "html"],
        html.emails_of(F.col(TAGS)).alias("emails"),
        html.script_srcs_of(F.col(TAGS), keep_data_uris=False).alias("script_src_attrs"),
    )


def wide_features(pages: DataFrame) -> DataFrame:
    """``pages`` with title, description, keywords, e-mails, script sources and types."""
    tags = F.col(TAGS)
    return with_tags(pages).select(
        *[c for c in pages.columns if c != "html"],
        html.title_of(tags).alias("page_title"),
        html.meta_of(tags, "description").alias("page_description"),
        html.emails_of(tags).alias("emails"),
        html.meta_of(tags, "keywords").alias("keywords"),
        html.script_srcs_of(tags).alias("script_src_attrs"),
        html.script_types_of(tags).alias("script_type_attrs"),
    )


def distinct_emails(pages: DataFrame) -> DataFrame:
    """The different e-mail links of all pages; line feeds count as blanks here."""
    found = with_tags(pages, newline=" ").select(F.explode(html.emails_of(F.col(TAGS))).alias("email"))
    return found.distinct()


def responses(spark: SparkSession, payload: bool = True, **options: str) -> DataFrame:
    """Response records of archives; options as for the ``warc`` source."""
    warc.register(spark)
    reader = spark.read.format("warc").option("recType", "response").option("payload", str(payload).lower())
    return reader.options(**options).load()


def script_extraction(records: DataFrame, year: str | Column, *kept: Column) -> DataFrame:
    """(year, ip, host, server, emails, script_src_attrs) of response records, and other columns of them."""
    pages = records.select(
        F.lit(year).alias("year"), *kept, *record_columns(), html.payload_text(F.col("payload")).alias("html")
    )
    return script_features(pages)


def wide_extraction(records: DataFrame) -> DataFrame:
    """The eleven-column feature table of response records; absent headers are NULL."""
    columns = record_columns(default=None)
    pages = records.select(
        columns[1].alias("warc_target_uri"),
        columns[0].alias("warc_ip_address"),
        *content_columns()[:2],
        columns[2],
        html.payload_text(F.col("payload")).alias("html"),
    )
    return wide_features(pages)
