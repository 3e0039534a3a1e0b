"""Sampling and splitting of archive lists."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pageloom.operators import manifest


@pytest.fixture(scope="module")
def paths(spark):
    # 105 different paths, one of them many times over.
    names = [f"crawl-data/CC-MAIN-2024-33/x/CC-MAIN-{i}.warc.gz" for i in range(105)]
    return names, spark.createDataFrame([(n,) for n in names], "path string")


def test_ranks_follow_the_hash(spark, paths):
    names, df = paths
    order = sorted(names, key=lambda n: hashlib.md5(("s" + n).encode()).hexdigest())
    got = {r["rank"]: r.path for r in manifest.shuffled(df, "s").collect()}
    assert [got[i + 1] for i in range(len(order))] == order


def test_copies_get_ranks_of_their_own(spark, paths):
    names, df = paths
    many = df.unionAll(spark.createDataFrame([(names[7],)] * 9000, "path string"))
    rows = manifest.shuffled(many).collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, 9106))
    assert Counter(r.path for r in rows)[names[7]] == 9001


def test_split(paths):
    names, df = paths
    parts = manifest.split_manifest(df, 20, year="2024").collect()
    assert Counter(r.part_file for r in parts) == {f"warc_part_{i:03d}_2024.txt": 20 for i in range(1, 6)}
    assert len({r.path for r in parts}) == 100
    rest = manifest.split_manifest(df, 20, keep_remainder=True).collect()
    assert Counter(r.part_file for r in rest)["warc_part_006.txt"] == 5 and len(rest) == 105
    some = manifest.split_manifest(df, 20, n_paths=50).collect()
    assert Counter(r.part for r in some) == {1: 20, 2: 20}


def test_samples(paths):
    _, df = paths
    sample = manifest.sample_manifest(df, 30, "a").collect()
    assert len(sample) == 30 and sample != manifest.sample_manifest(df, 30, "b").collect()
    assert {r.path for r in sample} == {r.path for r in manifest.sample_manifest(df, 30, "a").collect()}
    assert manifest.sample_share(df, 10).count() == 10
    assert manifest.sample_manifest(df, 1000).count() == 105


def test_part_numbers_beyond_three_digits(spark):
    df = spark.range(1500).selectExpr("CAST(id AS STRING) AS path")
    names = {r.part_file for r in manifest.split_manifest(df, 1).collect()}
    assert "warc_part_001.txt" in names and "warc_part_1500.txt" in names


def test_audits(paths):
    _, df = paths
    there = df.where("path LIKE '%3.warc.gz'")
    assert manifest.present_paths(df, there).count() == there.count()
    assert manifest.missing_paths(df, there).count() == 105 - there.count()


def test_a_sample_is_the_head_of_the_shuffled_list_without_a_window(spark):
    rows = [(f"p{k % 700}",) for k in range(1_000)]
    lines = spark.createDataFrame(rows, "path string").repartition(5)
    for n in (0, 1, 250, 1_000, 2_000):
        want = sorted(r.path for r in manifest.shuffled(lines, "s").where(F.col("rank") <= n).collect())
        assert sorted(r.path for r in manifest.sample_manifest(lines, n, "s").collect()) == want
    plan = manifest.sample_manifest(lines, 250, "s")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Window" not in plan
