"""City block and location tables from their published CSV form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.operators.geo import GEO_18

# Location columns that go by another name in a lookup result.
_RENAMED = {"subdivision_1_iso_code": "subdivision_iso_code", "subdivision_1_name": "subdivision_name"}


def _typed(name: str) -> Column:
    kind = GEO_18.get(name)
    if name == "geoname_id":
        return F.col(name).try_cast("bigint").alias(name)
    return F.col(name) if kind is None else F.col(name).try_cast(kind).alias(name)


def read_geo_csv(spark: SparkSession, path: str) -> DataFrame:
    """Blocks or locations: columns by their header, lookup columns in their types.

    Text that does not fit a type is NULL; flags may be written 0/1 or true/false.
    """
    rows = spark.read.option("header", True).csv(path).withColumnsRenamed(_RENAMED)
    return rows.select(*[_typed(name) for name in rows.columns])
