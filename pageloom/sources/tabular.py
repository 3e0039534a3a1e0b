"""Flat files and tables: readers, writers and table rewrites."""

from __future__ import annotations

import csv
import io
import uuid
from datetime import datetime, timedelta, timezone

from pyarrow.fs import FileSelector, FileType
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from pageloom.functions.js import join_piped
from pageloom.sources.records import RECORD, read_records, records_of
from pageloom.sources.warc import file_system

CORRUPT = "_corrupt"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One archive path per line; blanks around it and empty lines dropped."""
    lines = spark.read.text(path).select(F.trim("value").alias("path"))
    return lines.where(F.col("path") != "")


def present_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and size of the files below a folder; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length")


# How text files are written and read: values with separators, quotes or line breaks are quoted, a quote in them is
# doubled, blanks stay, an empty text is "" and a NULL is nothing at all.
_DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_WRITTEN = {**_DIALECT, "nullValue": "", "emptyValue": '""', "header": "true"}
# Nothing at all is read as this, and then as NULL, which keeps it apart from "".
_NOTHING = "\0null\0"
_PARSED = {**_DIALECT, "nullValue": _NOTHING, "emptyValue": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "multiLine": "true"}


def _names(spark: SparkSession, path: str, sep: str) -> list[str]:
    """The column names in the first record of the first file."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    first = files.agg(F.min(F.struct("path", "length")).alias("f")).first()["f"]
    if first is None:
        return []
    _, record, _ = next(records_of(first["path"], 0, min(first["length"], 1 << 16), RECORD, True, sep))
    return next(csv.reader(io.StringIO(record, newline=""), delimiter=sep))


def _parsed(records: DataFrame, schema: StructType, sep: str) -> DataFrame:
    """Records with ``_row``, their values and the record itself in ``_corrupt`` if it does not fit."""
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    row = F.from_csv("record", ", ".join([*columns, f"{CORRUPT} string"]), {**_PARSED, "sep": sep})
    return records.select("record", "closed", row.alias("_row"))


def _data(spark: SparkSession, path: str, sep: str, header: bool) -> DataFrame:
    rows = read_records(spark, path, sep)
    return rows.where("record <> '' AND place > 0" if header else "record <> ''")


def read_tsv(spark: SparkSession, path: str, schema: StructType | None = None, sep: str = "\t") -> DataFrame:
    """Tab-separated files with a header; every column is a string unless a schema is given.

    Values in quotes may hold tabs and line feeds. What is not of its type, or missing, is NULL.
    """
    if schema is None:
        schema = StructType([StructField(name, StringType()) for name in _names(spark, path, sep)])
    return _parsed(_data(spark, path, sep, True), schema, sep).select("_row.*").drop(CORRUPT)


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Comma-separated files with a header; see ``read_tsv``."""
    return read_tsv(spark, path, schema, ",")


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated files with a header; types found by a pass over the files, each read by one task."""
    return spark.read.options(**_DIALECT).option("header", True).option("inferSchema", True).option("multiLine", True).csv(path)


def read_csv_tolerant(
    spark: SparkSession, path: str, schema: StructType, sep: str = "\t", header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows, and the text of the records that do not fit the schema.

    A record with too few or too many fields, with a field that is not of its type, or with a quote
    that nothing closes (then its first line), does not fit. With ``header`` the first record of every file is left out.
    """
    rows = _parsed(_data(spark, path, sep, header), schema, sep)
    fits = F.col("closed") & F.col(f"_row.{CORRUPT}").isNull()
    good = rows.where(fits).select("_row.*").drop(CORRUPT)
    rejected = rows.where(~fits).select(F.col("record").alias("line"))
    return good, rejected


def pipe_arrays(df: DataFrame) -> DataFrame:
    """String arrays as '|'-joined text, for formats without arrays."""
    return df.withColumns(
        {f.name: join_piped(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, ArrayType)}
    )


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: list[str] | None = None,
    max_rows_per_file: int = 5_000_000,
) -> None:
    """Parquet files; with ``overwrite`` and partitions only the partitions met are replaced."""
    writer = df.write.mode(mode).option("maxRecordsPerFile", max_rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def _written(df: DataFrame) -> DataFrame:
    """``df`` as text files can hold it: a NULL in the only column would be an empty line, which is no record."""
    flat = pipe_arrays(df)
    if len(flat.columns) > 1:
        return flat
    name = flat.columns[0]
    refused = F.raise_error(F.lit(f"a text file of one column cannot hold a NULL ({name})"))
    return flat.select(F.coalesce(F.col(f"`{name}`"), refused.cast(flat.schema[name].dataType)).alias(name))


def write_tsv(df: DataFrame, path: str, mode: str = "append") -> None:
    """Tab-separated files with a header; arrays are '|'-joined first."""
    _written(df).write.mode(mode).options(**_WRITTEN).option("sep", "\t").csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    """Comma-separated files with a header; arrays are '|'-joined first."""
    _written(df).write.mode(mode).options(**_WRITTEN).csv(path)


def convert_tsv_to_parquet(spark: SparkSession, source: str, target: str, max_rows_per_file: int = 5_000_000) -> None:
    """Tab-separated text to Parquet, task by task: as many tasks as the text has ranges, and no shuffle of rows."""
    read_tsv(spark, source).write.mode("append").option("maxRecordsPerFile", max_rows_per_file).parquet(target)


def create_table_if_absent(df: DataFrame, table: str, path: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS ... AS SELECT: an existing table stays as it is."""
    writer = df.write.mode("ignore").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def empty_clone(df: DataFrame) -> DataFrame:
    """No rows, the same columns."""
    return df.where(F.lit(False))


def swap_table(df: DataFrame, table: str, path: str) -> str:
    """Make ``df`` the rows of an existing table; the folder that it lies in from now on.

    The rows are written whole to a new folder below ``path``. The table's name points to a
    folder, and pointing it to the new one is the only change: whatever breaks off before leaves
    the old table, and there is no moment without one. Readers that have planned go on with the
    old folder, which stays until ``drop_versions``. ``df`` may read the table itself.
    """
    spark = df.sparkSession
    names = spark.table(table).columns
    version = f"{path.rstrip('/')}/version-{uuid.uuid4().hex}"
    df.select(*[F.col(f"`{n}`") for n in names]).write.parquet(version)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
    spark.catalog.refreshTable(table)
    return version


def table_location(spark: SparkSession, table: str) -> str:
    """The folder that a table's name points to."""
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def drop_versions(spark: SparkSession, table: str, path: str, older_than: timedelta = timedelta(days=1), now: datetime | None = None) -> int:
    """Remove folders that ``swap_table`` wrote below ``path``, that the table does not point to, and whose files are older; their number."""
    current = table_location(spark, table).rstrip("/").rsplit("/", 1)[-1]
    system, inner = file_system(path)
    before = (now or datetime.now(timezone.utc)) - older_than
    gone = 0
    for info in system.get_file_info(FileSelector(inner, allow_not_found=True)):
        if info.type == FileType.Directory and info.base_name.startswith("version-") and info.base_name != current:
            files = system.get_file_info(FileSelector(info.path, recursive=True))
            if all(f.mtime < before for f in files if f.is_file):
                system.delete_dir(info.path)
                gone += 1
    return gone


def rewrite_table(spark: SparkSession, table: str, columns: dict[str, Column], path: str) -> str:
    """Replace columns of a whole table by one projection of it; see ``swap_table``."""
    return swap_table(spark.table(table).withColumns(columns), table, path)


def schema_report(df: DataFrame) -> DataFrame:
    """Position, name and type of every column, and how many rows have a value there."""
    fields = df.schema.fields
    counted = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"_{i}") for i, f in enumerate(fields)])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"_{i}").alias("n_values"),
        )
        for i, f in enumerate(fields)
    ]
    return counted.select(F.inline(F.array(*rows)))


def list_tables(spark: SparkSession) -> DataFrame:
    """Tables and views of the current database."""
    return spark.sql("SHOW TABLES")
