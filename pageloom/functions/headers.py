"""Record and HTTP header lookups on the maps of the ``warc`` source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def header(headers: Column, name: str, default: str | None = None) -> Column:
    """Value of a header by case-insensitive name (the source lower-cases the keys)."""
    value = F.try_element_at(headers, F.lit(name.lower()))
    return value if default is None else F.coalesce(value, F.lit(default))


def record_columns(default: str | None = "-") -> list[Column]:
    """ip, host (the full URL) and server of a response record.

    ``default`` stands for an absent address or URL (None: NULL); an absent ``Server`` is NULL.
    """
    return [
        header(F.col("rec_headers"), "WARC-IP-Address", default).alias("ip"),
        header(F.col("rec_headers"), "WARC-Target-URI", default).alias("host"),
        header(F.col("http_headers"), "Server").alias("server"),
    ]


def content_columns() -> list[Column]:
    """Content type and length of the record; the length also as a number."""
    length = header(F.col("rec_headers"), "Content-Length")
    return [
        header(F.col("rec_headers"), "Content-Type").alias("content_type"),
        length.alias("content_length"),
        length.try_cast("bigint").alias("content_bytes"),
    ]
