"""Queries that write tables and files and read them back, and table reports."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from pageloom.catalog import inputs
from pageloom.catalog.extraction import features_oracle, piped, script_table
from pageloom.catalog.registry import query, with_inputs
from pageloom.catalog.scalars import KEPT_SRCS
from pageloom.functions import js
from pageloom.operators import profile
from pageloom.plans.extraction import wide_features
from pageloom.session import scratch_dir
from pageloom.sources import rows, tabular

_FLAT_ORACLE = features_oracle(
    f"SELECT page_id, ip, host, server, {piped('emails')} AS emails, {piped('kept_srcs')} AS script_src_attrs "
    "FROM features"
)
_FLAT_SCHEMA = StructType(
    [
        StructField("page_id", LongType()),
        *[StructField(c, StringType()) for c in ("host", "ip", "server", "emails", "script_src_attrs")],
    ]
)


@query("parquet_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem*.parquet").select("l_orderkey", "l_linenumber", "l_quantity")


@query("parquet_append", "SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 3 = 0")
def parquet_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "appended")
    rows = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    tabular.write_parquet(rows, path)
    tabular.write_parquet(rows.where("o_orderkey % 3 = 0"), path, "append")
    return spark.read.parquet(path)


@query("table_list", "SELECT 'orders' AS kind, count(*) AS n_rows FROM orders UNION ALL SELECT 'pages', count(*) FROM pages")
def table_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables that were just made are listed, each with the rows it has."""
    tag = uuid.uuid4().hex
    for kind in ("orders", "pages"):
        tabular.create_table_if_absent(inputs.table(spark, sf_dir, kind), f"{kind}_{tag}", scratch_dir(spark, "table"))
    names = [r["tableName"] for r in tabular.list_tables(spark).where(F.col("tableName").endswith(tag)).collect()]
    counted = [spark.table(n).agg(F.lit(n.split("_")[0]).alias("kind"), F.count("*").alias("n_rows")) for n in sorted(names)]
    return reduce(DataFrame.unionByName, counted)


@query("parquet_roundtrip", _FLAT_ORACLE)
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "parquet")
    table = script_table(spark, sf_dir).withColumn("part", F.col("page_id") % 2)
    # Written whole, then one partition again: only that one is replaced.
    tabular.write_parquet(table, path, "overwrite", ["part"])
    tabular.write_parquet(table.where("part = 1"), path, "overwrite", ["part"])
    return tabular.pipe_arrays(spark.read.parquet(path).drop("part"))


@query("tsv_roundtrip", _FLAT_ORACLE)
def tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tsv")
    table = script_table(spark, sf_dir)
    tabular.write_tsv(table.where("page_id % 2 = 0"), path, "overwrite")
    tabular.write_tsv(table.where("page_id % 2 = 1"), path, "append")
    return tabular.read_tsv(spark, path, _FLAT_SCHEMA)


@query("csv_roundtrip", _FLAT_ORACLE)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    table = script_table(spark, sf_dir)
    tabular.write_csv(table.where("page_id % 2 = 0"), path)
    tabular.write_csv(table.where("page_id % 2 = 1"), path)
    return tabular.read_csv(spark, path, _FLAT_SCHEMA)


# Texts that a flat file has to take care of: line breaks, separators, quotes, backslashes, outer blanks, nothing.
_AWKWARD = """
SELECT o_orderkey, CASE o_orderkey % 13
    WHEN 0 THEN concat('two', chr(10), 'lines') WHEN 1 THEN concat(chr(9), 'tab', chr(9), 'in it') WHEN 2 THEN concat('5', chr(34), ' pipe')
    WHEN 3 THEN concat(chr(34), 'quoted', chr(34)) WHEN 4 THEN concat('back', chr(92), 'slash', chr(92)) WHEN 5 THEN '  blanks  '
    WHEN 6 THEN '' WHEN 7 THEN NULL WHEN 8 THEN concat('ends in', chr(13)) WHEN 9 THEN concat(chr(34), chr(10), chr(34), ',', chr(13), chr(10))
    WHEN 10 THEN concat(chr(92), 'N') WHEN 11 THEN chr(34) ELSE o_orderpriority END AS note,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN '' ELSE concat(' ', o_orderstatus, chr(10)) END AS last_note
FROM orders
"""
_AWKWARD_SCHEMA = StructType([StructField("o_orderkey", LongType()), StructField("note", StringType()), StructField("last_note", StringType())])


@query("tsv_awkward_roundtrip", with_inputs("SELECT o_orderkey, note, last_note FROM awkward", awkward=_AWKWARD))
def tsv_awkward_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tsv")
    tabular.write_tsv(inputs.derived(spark, sf_dir, _AWKWARD), path)
    return tabular.read_tsv(spark, path, _AWKWARD_SCHEMA)


@query("csv_awkward_roundtrip", with_inputs("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, note, last_note FROM awkward", awkward=_AWKWARD))
def csv_awkward_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    tabular.write_csv(inputs.derived(spark, sf_dir, _AWKWARD), path)
    return tabular.read_csv(spark, path)


@query("tsv_awkward_to_parquet", with_inputs("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, note, last_note FROM awkward", awkward=_AWKWARD))
def tsv_awkward_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = scratch_dir(spark, "tsv"), scratch_dir(spark, "parquet")
    tabular.write_tsv(inputs.derived(spark, sf_dir, _AWKWARD), source)
    tabular.convert_tsv_to_parquet(spark, source, target)
    return spark.read.parquet(target)


_ORDER_LINES = "SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem"


@query(
    "tsv_scan",
    "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_returnflag, "
    "CAST(l_quantity AS DOUBLE) AS l_quantity FROM lineitem",
)
def tsv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tsv")
    tabular.write_tsv(inputs.derived(spark, sf_dir, _ORDER_LINES), path)
    back = tabular.read_tsv(spark, path)
    return back.withColumn("l_quantity", F.col("l_quantity").cast("double"))  # numbers have no common text form


@query("csv_infer_scan", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def csv_infer_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    parts = inputs.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    tabular.write_csv(parts, path)
    back = tabular.read_csv_inferred(spark, path)
    return back.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


_LINES = """
SELECT CASE WHEN o_orderkey % 13 = 0 THEN concat('x', CAST(o_orderkey AS STRING), chr(9), 'bad number', chr(9), '1.5')
            WHEN o_orderkey % 13 = 1 THEN concat(CAST(o_orderkey AS STRING), chr(9), 'a', chr(9), '1.5', chr(9), 'too many')
            ELSE concat(CAST(o_orderkey AS STRING), chr(9), o_orderpriority, chr(9), CAST(o_custkey AS STRING), '.5') END
       AS value
FROM orders
"""


@query(
    "csv_tolerant_scan",
    "SELECT o_orderkey AS id, o_orderpriority AS priority, o_custkey + CAST(0.5 AS DOUBLE) AS amount, "
    "CAST(NULL AS VARCHAR) AS line FROM orders WHERE o_orderkey % 13 > 1 "
    "UNION ALL SELECT NULL, NULL, NULL, concat('x', CAST(o_orderkey AS STRING), chr(9), 'bad number', chr(9), '1.5') "
    "FROM orders WHERE o_orderkey % 13 = 0 "
    "UNION ALL SELECT NULL, NULL, NULL, concat(CAST(o_orderkey AS STRING), chr(9), 'a', chr(9), '1.5', chr(9), 'too many') "
    "FROM orders WHERE o_orderkey % 13 = 1",
)
def csv_tolerant_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "lines")
    inputs.derived(spark, sf_dir, _LINES).write.text(path)
    schema = StructType(
        [StructField("id", LongType()), StructField("priority", StringType()), StructField("amount", DoubleType())]
    )
    good, rejected = tabular.read_csv_tolerant(spark, path, schema, header=False)
    return good.unionByName(rejected, allowMissingColumns=True)


# Records of two lines, some of them bad: a word for a number, a field too many.
_SPANNING = """
SELECT concat(CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE '' END, CAST(o_orderkey AS STRING), chr(9), chr(34), 'say ', chr(34), chr(34), o_orderpriority,
    chr(34), chr(34), chr(10), 'and go', chr(34), chr(9), '1.5', CASE WHEN o_orderkey % 11 = 1 THEN concat(chr(9), 'more') ELSE '' END) AS value
FROM orders
"""


@query(
    "csv_tolerant_spanning",
    with_inputs(
        "SELECT o_orderkey AS id, concat('say ', chr(34), o_orderpriority, chr(34), chr(10), 'and go') AS priority, CAST(1.5 AS DOUBLE) AS amount, "
        "CAST(NULL AS VARCHAR) AS line FROM orders WHERE o_orderkey % 11 > 1 "
        "UNION ALL SELECT NULL, NULL, NULL, value FROM spanning WHERE starts_with(value, 'x') OR ends_with(value, 'more')",
        spanning=_SPANNING,
    ),
)
def csv_tolerant_spanning(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "lines")
    inputs.derived(spark, sf_dir, _SPANNING).write.text(path)
    schema = StructType(
        [StructField("id", LongType()), StructField("priority", StringType()), StructField("amount", DoubleType())]
    )
    good, rejected = tabular.read_csv_tolerant(spark, path, schema, header=False)
    return good.unionByName(rejected, allowMissingColumns=True)


_LINE_SCHEMA = StructType(
    [
        StructField("l_orderkey", LongType(), False),
        StructField("l_quantity", DoubleType()),
        StructField("l_returnflag", StringType()),
    ]
)


def _line_rows(line: dict) -> Iterator[tuple | dict]:
    """A line as a row, and for some lines a row that does not fit as well."""
    number, flag = line["l_orderkey"], line["l_returnflag"]
    yield number, float(line["l_quantity"]), flag
    if number % 10 == 0:
        yield number, "many", flag
    if number % 10 == 1:
        yield {"l_orderkey": number, "l_color": "red"}
    if number % 10 == 2:
        yield None, 1.0, flag
    if number % 10 == 3:
        yield number, 1.0


@query("rows_explicit_schema", "SELECT l_orderkey, CAST(l_quantity AS DOUBLE) AS l_quantity, l_returnflag FROM lineitem")
def rows_explicit_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows made in Python, typed by a declared schema; those that do not fit it stay out."""
    lines = inputs.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    return rows.declared_rows(lines, _line_rows, _LINE_SCHEMA)[0]


@query(
    "rows_schema_rejects",
    "SELECT 1::BIGINT AS place, CASE l_orderkey % 10 WHEN 0 THEN 'row.l_quantity: str for double' WHEN 1 THEN 'row: no such field l_color' "
    "WHEN 2 THEN 'row.l_orderkey: missing' ELSE 'row: 2 values for 3 fields' END AS reason, count(*) AS n_rows "
    "FROM lineitem WHERE l_orderkey % 10 < 4 GROUP BY ALL",
)
def rows_schema_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    rejected = rows.declared_rows(lines, _line_rows, _LINE_SCHEMA)[1]
    return rejected.groupBy("place", "reason").agg(F.count("*").alias("n_rows"))


@query("rows_inferred_schema", with_inputs("SELECT ip, host FROM crawl_pages", crawl_pages=inputs.CRAWL_PAGES))
def rows_inferred_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    loose = inputs.pages(spark, sf_dir).select(F.to_variant_object(F.struct("ip", "host")).alias("row"))
    return rows.loose_rows(loose, "row").select("ip", "host")


@query(
    "rows_merged_schema",
    "SELECT o_orderkey AS key, CASE o_orderkey % 4 WHEN 0 THEN o_orderstatus WHEN 1 THEN CAST(o_custkey AS VARCHAR) END AS note, "
    "CASE WHEN o_orderkey % 4 = 2 THEN 1::BIGINT END AS a, CASE WHEN o_orderkey % 4 = 3 THEN o_orderstatus END AS b FROM orders",
)
def rows_merged_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON objects whose keys and types differ from row to row, under the one schema that holds them all."""
    kinds = {
        0: F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("note")),
        1: F.struct(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("note")),
        2: F.struct(F.col("o_orderkey").alias("key"), F.struct(F.lit(1).alias("a")).alias("more")),
        3: F.struct(F.col("o_orderkey").alias("key"), F.struct(F.array("o_orderstatus").alias("b")).alias("more")),
    }
    row = F.coalesce(*[F.when(F.col("o_orderkey") % 4 == k, F.to_json(kind)) for k, kind in kinds.items()])
    merged = rows.loose_rows(inputs.table(spark, sf_dir, "orders").select(row.alias("row")), "row")
    return merged.select("key", "note", F.col("more.a").alias("a"), F.col("more.b")[0].alias("b"))


@query(
    "tsv_to_parquet",
    "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_returnflag, "
    "CAST(l_quantity AS DOUBLE) AS l_quantity FROM lineitem",
)
def tsv_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = scratch_dir(spark, "tsv"), scratch_dir(spark, "parquet")
    tabular.write_tsv(inputs.derived(spark, sf_dir, _ORDER_LINES), source)
    tabular.convert_tsv_to_parquet(spark, source, target)
    return spark.read.parquet(target).withColumn("l_quantity", F.col("l_quantity").cast("double"))


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


@query("ctas_if_not_exists", "SELECT o_orderkey, o_custkey FROM orders")
def ctas_if_not_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _name("orders")
    rows = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    tabular.create_table_if_absent(rows, name, scratch_dir(spark, "table"))
    # The second call finds the table and leaves it alone.
    tabular.create_table_if_absent(rows.limit(0), name, scratch_dir(spark, "table"))
    return spark.table(name)


@query("empty_clone", "SELECT * FROM orders WHERE 1 = 0")
def empty_clone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tabular.empty_clone(inputs.table(spark, sf_dir, "orders"))


@query(
    "table_rewrite",
    with_inputs(
        f"SELECT l_orderkey, l_linenumber, {KEPT_SRCS} AS script_src_attrs FROM piped_srcs",
        piped_srcs=inputs.PIPED_SRCS,
    ),
)
def table_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _name("scripts")
    rows = inputs.derived(spark, sf_dir, inputs.PIPED_SRCS)
    tabular.create_table_if_absent(rows, name, scratch_dir(spark, "table"))
    cleaned = {"script_src_attrs": js.drop_data_uris(F.col("script_src_attrs"))}
    tabular.rewrite_table(spark, name, cleaned, scratch_dir(spark, "table"))
    return spark.table(name)


@query("repartition_preserves_rows", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
def repartition_preserves_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rows.repartition(10).coalesce(5)


_REPORTED = {
    "page_id": "bigint",
    "host": "string",
    "ip": "string",
    "server": "string",
    "emails": "array<string>",
    "script_src_attrs": "array<string>",
}


@query(
    "schema_report",
    features_oracle(
        " UNION ALL ".join(
            f"SELECT {i} AS position, '{c}' AS column_name, '{kind}' AS data_type, "
            f"count({'kept_srcs' if c == 'script_src_attrs' else c}) AS n_values FROM features"
            for i, (c, kind) in enumerate(_REPORTED.items())
        )
    ),
)
def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tabular.schema_report(script_table(spark, sf_dir))


@query(
    "table_shape",
    features_oracle("SELECT count(*) AS n_rows, 6 AS n_columns FROM features"),
)
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.table_shape(script_table(spark, sf_dir))


_PROFILED = ["host", "ip", "server", "page_title", "page_description", "keywords"]
_MISSING = {
    "page_id": "page_id IS NULL",
    **{c: f"{c} IS NULL" for c in _PROFILED},
    "emails": "emails IS NULL OR len(emails) = 0",
    "script_src_attrs": "srcs IS NULL OR len(srcs) = 0",
    "script_type_attrs": "types IS NULL OR len(types) = 0",
}


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_features(inputs.pages(spark, sf_dir))


@query(
    "null_profile",
    features_oracle(
        "SELECT " + ", ".join(f"count(*) FILTER (WHERE {test}) AS {c}" for c, test in _MISSING.items()) + " FROM features"
    ),
)
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_profile(_wide(spark, sf_dir))


@query(
    "null_fraction",
    features_oracle(
        "SELECT "
        + ", ".join(
            f"round(count(*) FILTER (WHERE {test}) / CAST(count(*) AS DOUBLE) * 100, 3) AS {c}"
            for c, test in _MISSING.items()
        )
        + " FROM features"
    ),
)
def null_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_fraction(_wide(spark, sf_dir))


@query("limit_rows", "SELECT page_id, url FROM pages ORDER BY page_id LIMIT 100")
def limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "pages").select("page_id", "url").orderBy("page_id").limit(100)


@query("page_offset", "SELECT page_id, url FROM pages ORDER BY page_id LIMIT 50 OFFSET 20")
def page_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "pages").select("page_id", "url")
    return rows.orderBy("page_id").offset(20).limit(50)
