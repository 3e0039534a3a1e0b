"""JavaScript library popularity and co-occurrence over domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.js import js_lib_names
from pageloom.functions.url import url_domain
from pageloom.operators.joins import skew_join


def domain_lib_pairs(pages: DataFrame, drop_empty_domain: bool = False) -> DataFrame:
    """Distinct (domain, js_lib) of pages with ``host`` and the array ``script_src_attrs``.

    Pages without an authority in their URL form the domain '' unless dropped.
    """
    pairs = pages.select(
        url_domain(F.col("host")).alias("domain"),
        F.explode(js_lib_names(F.col("script_src_attrs"))).alias("js_lib"),
    ).dropna()
    if drop_empty_domain:
        pairs = pairs.where(F.col("domain") != "")
    return pairs.distinct()


def lib_domain_counts(pairs: DataFrame) -> DataFrame:
    """Number of domains per library, from distinct pairs."""
    return pairs.groupBy("js_lib").agg(F.count("*").alias("domain_count"))


def top_libs(pairs: DataFrame, k: int = 100) -> DataFrame:
    """The k libraries on most domains, ties by name."""
    return lib_domain_counts(pairs).orderBy(F.desc("domain_count"), "js_lib").limit(k)


def _spread(df: DataFrame, *columns: str) -> DataFrame:
    """Hash-partitioned into as many tasks as the session shuffles into.

    What follows makes many rows out of few bytes, so the partitions must not be
    merged by their size.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def _pairs_of_small_domains(pairs: DataFrame, domains: DataFrame) -> DataFrame:
    """Pairs within each domain of bounded size, out of its sorted list of libraries.

    Many domains load the same libraries, so each different list is paired up once, with
    the number of domains that have it as its weight.
    """
    lists = (
        skew_join(pairs, domains.select("domain"), ["domain"])
        .groupBy("domain")
        .agg(F.array_sort(F.collect_list("js_lib")).alias("_libs"))
    )
    weighted = _spread(lists.groupBy("_libs").agg(F.count("*").alias("weight")), "_libs")
    placed = weighted.select("weight", "_libs", F.posexplode("_libs").alias("_i", "_a"))
    later = F.slice("_libs", F.col("_i") + 2, F.size("_libs"))
    return placed.select("_a", F.explode(later).alias("_b"), "weight")


def _pairs_of_large_domains(pairs: DataFrame, domains: DataFrame, block_libs: int) -> DataFrame:
    """Pairs within each domain, with its libraries dealt into blocks of about ``block_libs``.

    Any two blocks meet under a key of their own (a cell), so that one domain is worked
    on by many tasks. Of the cells only those with row <= col are used: a member of
    block b is a first partner in row b and a second partner in column b.
    """
    blocks = F.ceil(F.col("n_libs") / block_libs).cast("int")
    dealt = skew_join(pairs, domains, ["domain"]).select(
        "domain", "js_lib", blocks.alias("_n"), F.pmod(F.xxhash64("js_lib"), blocks).cast("int").alias("_block")
    )
    first = dealt.select(
        "domain",
        F.col("_block").alias("_row"),
        F.explode(F.sequence(F.col("_block"), F.col("_n") - 1)).alias("_col"),
        F.col("js_lib").alias("_first"),
    )
    second = dealt.select(
        "domain",
        F.explode(F.sequence(F.lit(0), F.col("_block"))).alias("_row"),
        F.col("_block").alias("_col"),
        F.col("js_lib").alias("_second"),
    )
    cell = ["domain", "_row", "_col"]
    met = _spread(first, *cell).join(_spread(second, *cell), cell).where(
        (F.col("_row") < F.col("_col")) | (F.col("_first") < F.col("_second"))
    )
    return met.select(
        F.least("_first", "_second").alias("_a"),
        F.greatest("_first", "_second").alias("_b"),
        F.lit(1).cast("bigint").alias("weight"),
    )


def cooccurrence(pairs: DataFrame, min_domains: int | Column = 1, block_libs: int = 512) -> DataFrame:
    """Ordered pairs of different libraries and the number of domains having both.

    ``min_domains``, a number or a scalar subquery, keeps the pairs on at least that many
    domains; libraries on fewer domains cannot be in one and leave before the join. Each
    unordered pair is met once and mirrored at the end. ``pairs`` is read several times: pass
    a stored table (``session.written``) if it is costly to compute.
    """
    every = isinstance(min_domains, int) and min_domains <= 1
    if not every:
        frequent = lib_domain_counts(pairs).where(F.col("domain_count") >= min_domains).select("js_lib")
        pairs = pairs.join(frequent, "js_lib", "left_semi")
    domains = pairs.groupBy("domain").agg(F.count("*").alias("n_libs")).where(F.col("n_libs") > 1)
    small = _pairs_of_small_domains(pairs, domains.where(F.col("n_libs") <= block_libs))
    large = _pairs_of_large_domains(pairs, domains.where(F.col("n_libs") > block_libs), block_libs)
    met = small.unionByName(large)
    counted = met.groupBy("_a", "_b").agg(F.sum("weight").alias("domain_count"))
    if not every:
        counted = counted.where(F.col("domain_count") >= min_domains)
    both = F.array(
        F.struct(F.col("_a").alias("js_lib1"), F.col("_b").alias("js_lib2")),
        F.struct(F.col("_b").alias("js_lib1"), F.col("_a").alias("js_lib2")),
    )
    return counted.select(F.explode(both).alias("_pair"), "domain_count").select("_pair.*", "domain_count")


def _bound(pairs: DataFrame, k: int, probe_libs: int) -> DataFrame:
    """One row: a number of domains that the k best ordered pairs reach, from the most frequent libraries.

    A domain has at most ``probe_libs`` of these, so its list of them is bounded.
    """
    probe = lib_domain_counts(pairs).orderBy(F.desc("domain_count"), "js_lib").limit(probe_libs).select("js_lib")
    lists = pairs.join(F.broadcast(probe), "js_lib", "left_semi").groupBy("domain").agg(F.array_sort(F.collect_list("js_lib")).alias("_libs"))
    placed = lists.select("_libs", F.posexplode("_libs").alias("_i", "_a"))
    met = placed.select("_a", F.explode(F.slice("_libs", F.col("_i") + 2, F.size("_libs"))).alias("_b"))
    best = met.groupBy("_a", "_b").agg(F.count("*").alias("domain_count")).orderBy(F.desc("domain_count")).limit(-(-k // 2))
    return best.agg(F.when(F.count("*") * 2 >= k, F.min("domain_count")).otherwise(F.lit(1)).alias("bound"))


def top_cooccurrence(pairs: DataFrame, k: int = 50, probe_libs: int = 64) -> DataFrame:
    """The k library pairs on most domains, without counting all pairs.

    The pairs among the ``probe_libs`` most frequent libraries are counted first, as a scalar
    subquery of the same plan. Their k-th best count bounds the k-th best of all from below,
    and a library on fewer domains than that cannot be in one of the top pairs. ``pairs`` is
    read several times, as for ``cooccurrence``.
    """
    found = cooccurrence(pairs, min_domains=_bound(pairs, k, probe_libs).scalar())
    return found.orderBy(F.desc("domain_count"), "js_lib1", "js_lib2").limit(k)
