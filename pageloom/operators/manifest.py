"""Reproducible sampling and splitting of archive lists, and audits of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pageloom.operators.joins import skew_join
from pageloom.streaming.ledger import completed

_BUCKET_DIGITS = 3
_RUN = 4096


def _order_key(seed: str) -> Column:
    """A path's place in the shuffled order: its MD5, with the seed in front."""
    return F.md5(F.concat(F.lit(seed), F.col("path")))


def shuffled(manifest: DataFrame, seed: str = "") -> DataFrame:
    """Paths with their 1-based ``rank`` in a fixed shuffled order.

    Ranks come from two levels: counts of 4096 hash buckets, summed up over that
    small table, and an order within each bucket. Equal paths are counted before
    they are ranked and get consecutive ranks.
    """
    lines = manifest.groupBy("path").agg(F.count("*").alias("_copies")).withColumn("_key", _order_key(seed))
    lines = lines.withColumn("_bucket", F.substring("_key", 1, _BUCKET_DIGITS))
    totals = lines.groupBy("_bucket").agg(F.sum("_copies").alias("_lines"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_bucket", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_bucket").orderBy("_key", "path").rowsBetween(Window.unboundedPreceding, 0)
    placed = lines.withColumn("_upto", F.sum("_copies").over(within)).join(F.broadcast(starts), "_bucket")
    last = F.col("_start") + F.col("_upto")
    # Copies are written out in runs, so that no array is as long as their number.
    run = F.explode(F.sequence(last - F.col("_copies") + 1, last, F.lit(_RUN).cast("bigint"))).alias("_run")
    return placed.select("path", last.alias("_last"), run).select(
        "path", F.explode(F.sequence("_run", F.least("_last", F.col("_run") + _RUN - 1))).alias("rank")
    )


def sample_manifest(manifest: DataFrame, n: int, seed: str = "") -> DataFrame:
    """n paths at random, the same ones for the same seed: the first n of ``shuffled``.

    Each task keeps its n least keys and sends on no more than those.
    """
    return manifest.select("path").orderBy(_order_key(seed), "path").limit(n)


def sample_share(manifest: DataFrame, share_of: int = 100, seed: str = "") -> DataFrame:
    """One in ``share_of`` paths at random (1 % by default), rounded down."""
    wanted = manifest.agg(F.floor(F.count("*") / share_of)).scalar()
    return shuffled(manifest, seed).where(F.col("rank") <= wanted).select("path")


def split_manifest(
    manifest: DataFrame,
    lines_per_part: int = 20,
    n_paths: int | None = None,
    year: str | None = None,
    seed: str = "",
    keep_remainder: bool = False,
) -> DataFrame:
    """Disjoint random parts of ``lines_per_part`` paths: (part, part_file, path).

    ``n_paths`` is the number of paths to use, the whole list by default. What does
    not fill a part is left out unless ``keep_remainder``.
    """
    total = F.lit(n_paths).cast("bigint") if n_paths is not None else manifest.agg(F.count("*")).scalar()
    parts = total / lines_per_part
    parts = F.ceil(parts) if keep_remainder else F.floor(parts)
    number = F.floor((F.col("rank") - 1) / lines_per_part) + 1
    suffix = "" if year is None else f"_{year}"
    kept = shuffled(manifest, seed).withColumn("part", number.cast("bigint")).where(F.col("part") <= parts)
    if n_paths is not None:
        kept = kept.where(F.col("rank") <= n_paths)
    # At least three digits; more where the part number needs them.
    digits = F.lpad(F.col("part").cast("string"), F.greatest(F.lit(3), F.length(F.col("part").cast("string"))), F.lit("0"))
    return kept.select("part", F.concat(F.lit("warc_part_"), digits, F.lit(f"{suffix}.txt")).alias("part_file"), "path")


def missing_paths(manifest: DataFrame, present: DataFrame) -> DataFrame:
    """Paths of the manifest that are not among the files that are there."""
    return skew_join(manifest, present.select("path").distinct(), ["path"], "left_anti")


def present_paths(manifest: DataFrame, present: DataFrame) -> DataFrame:
    """Paths of the manifest that are there."""
    return skew_join(manifest, present.select("path").distinct(), ["path"], "left_semi")


def pending_parts(parts: DataFrame, ledger: DataFrame) -> DataFrame:
    """Parts (year, part, …) that the ledger of tasks does not have complete (see ``streaming.ledger``)."""
    return parts.join(completed(ledger).select("year", "part"), ["year", "part"], "left_anti")
