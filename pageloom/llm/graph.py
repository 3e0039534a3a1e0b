"""Connected components as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.session import written


def apart(key: str) -> tuple[Column, Column]:
    """``key`` and a column that follows from it, to group by before a join back on the key.

    Grouped by the key alone, the result would already lie where the join wants it, and the
    join's other side could not be split where one key has very many rows. Grouped by both,
    it gets an exchange of its own, and adaptive execution can split the other side.
    """
    return F.col(key), (F.col(key) % 16).alias("apart")


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node that ``edges`` (a, b; long) names; the root is the least node.

    Large and small stars by turns: neighbours above a node are tied to the least neighbour,
    then those below it, until nothing changes. Minima are aggregates that combine before the
    shuffle, and no neighbour list is ever built. Each round is written to the shared folder.
    """
    def canonical(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    def summary(pairs: DataFrame):
        return pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()

    current = written(canonical(edges), name)
    known = summary(current)
    while known["n"]:
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).union(current.select("b", "a"))
        least = both.groupBy(*apart("u")).agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = written(canonical(small.union(lowest.select("a", F.col("m").alias("b")))), name)
        now = summary(current)
        if now == known:
            break
        known = now
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(current.select(F.col("b"), F.col("b")).distinct())
