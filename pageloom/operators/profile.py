"""Counts over whole tables: shape, missing values, distinct values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType


def table_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def _missing(name: str, kind: DataType) -> Column:
    missing = F.col(name).isNull()
    if isinstance(kind, (ArrayType, MapType)):
        missing = missing | (F.size(name) == 0)
    return F.count_if(missing)


def null_profile(df: DataFrame) -> DataFrame:
    """One row: per column the number of NULLs, for arrays also of empty ones."""
    return df.agg(*[_missing(f.name, f.dataType).alias(f.name) for f in df.schema.fields])


def null_fraction(df: DataFrame) -> DataFrame:
    """The profile in per cent of the rows, to three places; NULL for an empty table."""
    total = F.count("*")
    return df.agg(
        *[
            F.round(_missing(f.name, f.dataType) / F.nullif(total, F.lit(0)) * 100, 3).alias(f.name)
            for f in df.schema.fields
        ]
    )


def null_fraction_long(df: DataFrame) -> DataFrame:
    """The per cent profile as rows (column_name, null_percent)."""
    wide = null_fraction(df)
    return wide.unpivot([], wide.columns, "column_name", "null_percent")


def record_profile(records: DataFrame) -> DataFrame:
    """Record and content types met in archives, with their counts."""
    return records.groupBy("rec_type", "content_type").agg(F.count("*").alias("n_records"))


def dedupe_by_ip(df: DataFrame, *by: str) -> DataFrame:
    """One row per ``ip``, of each ``by`` if given: the least by host, server and the remaining columns.

    A minimum over structs combines before the shuffle, so an address with very
    many rows sends one row per task.
    """
    keys = [*by, "ip"]
    others = [c for c in ("host", "server") if c in df.columns]
    others += [c for c in df.columns if c not in (*keys, "host", "server")]
    least = df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row"))
    return least.select(*keys, "_row.*").select(*df.columns)


def topic_count(df: DataFrame, column: str, topic: str) -> DataFrame:
    """Number of rows whose array ``column`` has ``topic``."""
    return df.where(F.array_contains(column, topic)).agg(F.count("*").alias("n_rows"))
