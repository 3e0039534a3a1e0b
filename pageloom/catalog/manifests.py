"""Queries on archive lists: scans, samples, splits and audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.catalog import inputs
from pageloom.catalog.registry import query, with_inputs
from pageloom.operators import manifest
from pageloom.session import scratch_dir
from pageloom.sources.tabular import read_manifest

_LIST = {"manifest": inputs.MANIFEST}
_RANKED = "SELECT path, row_number() OVER (ORDER BY md5(concat('s1', path)), path) AS rank FROM manifest"


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.derived(spark, sf_dir, inputs.MANIFEST)


@query("manifest_scan", with_inputs("SELECT path FROM manifest", **_LIST))
def manifest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "manifest")
    # A blank before each path, and an empty line after it.
    lines = _manifest(spark, sf_dir).select(F.explode(F.array(F.concat(F.lit("  "), "path"), F.lit(""))))
    lines.write.text(path)
    return read_manifest(spark, path)


@query(
    "manifest_sample",
    with_inputs("SELECT path FROM ranked WHERE rank <= 900", **_LIST, ranked=_RANKED),
)
def manifest_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.sample_manifest(_manifest(spark, sf_dir), 900, seed="s1")


@query(
    "manifest_sample_share",
    with_inputs("SELECT path FROM ranked WHERE rank <= (SELECT count(*) // 100 FROM manifest)", **_LIST, ranked=_RANKED),
)
def manifest_sample_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.sample_share(_manifest(spark, sf_dir), 100, seed="s1")


@query(
    "manifest_split",
    with_inputs(
        "SELECT part, concat('warc_part_', CASE WHEN part < 1000 THEN lpad(CAST(part AS VARCHAR), 3, '0') "
        "ELSE CAST(part AS VARCHAR) END, '_2024.txt') AS part_file, path "
        "FROM (SELECT (rank - 1) // 20 + 1 AS part, path FROM ranked) "
        "WHERE part <= (SELECT count(*) // 20 FROM manifest)",
        **_LIST,
        ranked=_RANKED,
    ),
)
def manifest_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.split_manifest(_manifest(spark, sf_dir), 20, year="2024", seed="s1")


_PRESENT = "SELECT path FROM manifest WHERE path NOT LIKE '%7.warc.gz'"


def _present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _manifest(spark, sf_dir).where("path NOT LIKE '%7.warc.gz'")


@query("manifest_missing_anti", with_inputs("SELECT path FROM manifest WHERE path LIKE '%7.warc.gz'", **_LIST))
def manifest_missing_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.missing_paths(_manifest(spark, sf_dir), _present(spark, sf_dir))


@query("manifest_present_semi", with_inputs(_PRESENT, **_LIST))
def manifest_present_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.present_paths(_manifest(spark, sf_dir), _present(spark, sf_dir))
