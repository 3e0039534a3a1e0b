"""Skew-aware joins against the plain ones."""

import pytest
from pyspark.sql import functions as F

from pageloom.operators import joins


@pytest.fixture(scope="module")
def sides(spark):
    # One key holds a third of the rows, one is NULL, one has no partner.
    left = spark.range(600, numPartitions=6).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 17 = 0 THEN NULL ELSE concat('k', id % 50) END AS k", "id"
    )
    right = spark.range(45).selectExpr("CASE WHEN id = 0 THEN 'hot' ELSE concat('k', id) END AS k", "id * 10 AS v")
    return left, right.unionAll(right.where("id < 2"))


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", ["k = 'hot'", None])
def test_salted_join_equals_plain(sides, how, hot):
    left, right = sides
    assert rows(joins.salted_join(left, right, ["k"], how, hot and F.expr(hot), salts=4)) == rows(left.join(right, ["k"], how))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_salts_on_request_only(sides, how):
    left, right = sides
    plain = joins.skew_join(left, right, ["k"], how)
    salted = joins.skew_join(left, right, ["k"], how, F.col("k") == "hot")
    assert rows(plain) == rows(salted) == rows(left.join(right, ["k"], how))
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in plain._jdf.queryExecution().optimizedPlan().toString()


def test_clustered_hot_key_spreads_over_tasks(spark):
    """All rows of the key lie in one partition, as behind a shuffle or in a sorted table."""
    left = spark.range(100_000).selectExpr("CASE WHEN id < 99999 THEN 'hot' ELSE 'k' END AS k", "id").repartition(1)
    right = spark.createDataFrame([("hot", 1), ("k", 2)], "k string, v int")
    salted = joins.salted_join(left, right, ["k"], "inner", F.col("k") == "hot")
    assert salted.count() == 100_000
    salts = left.select(F.pmod(F.xxhash64("k", "id"), F.lit(joins.SALTS)).alias("s")).groupBy("s").count().collect()
    assert len(salts) >= 32 and max(r["count"] for r in salts) < 2_500


def test_no_job_while_a_plan_is_built(spark, sides):
    """A source that fails as soon as it is read must not be noticed."""
    left, right = sides
    broken = left.withColumn("k", F.coalesce("k", F.raise_error(F.lit("read"))))
    for how in joins.HOWS:
        joins.skew_join(broken, right, ["k"], how)
        joins.salted_join(broken, right, ["k"], how)
    joins.null_safe_join(broken, right, ["k"])


def test_null_safe_join(spark):
    a = spark.createDataFrame([("1", None, 1), ("1", "x", 2), (None, None, 3)], "p string, q string, n int")
    b = spark.createDataFrame([("1", None, 10), ("1", "", 20), (None, None, 30)], "p string, q string, m int")
    got = joins.null_safe_join(a, b, ["p", "q"])
    assert rows(got.select("p", "q", "n", "m")) == rows(
        spark.createDataFrame([("1", None, 1, 10), (None, None, 3, 30)], "p string, q string, n int, m int")
    )
    left = joins.null_safe_join(a, b, ["p", "q"], "left")
    assert left.count() == 3 and left.where("m IS NULL").count() == 1


def test_unknown_join_type(sides):
    with pytest.raises(ValueError):
        joins.skew_join(*sides, ["k"], "full")
