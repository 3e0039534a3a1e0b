"""Ranks of the elements of linked lists, without a task that sees a whole list.

Elements are named by two numbers (``c``, ``x``) and know their successor and predecessor. In
each round a coin is tossed for each element by a hash; one with heads whose predecessor has
tails is spliced out, and its neighbours are told. That takes a quarter of what is left, so all
rounds together shuffle a few times the list. When what is left fits a bound, one task walks
it; then the spliced elements come back, round by round, each behind its predecessor.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.session import written

#: A list of at most so many elements is walked by one task.
SMALL = 16_384


def _coin(c: str, x: str, turn: int) -> Column:
    return F.xxhash64(F.col(c), F.col(x), F.lit(turn)).bitwiseAND(F.lit(1))


def _spliced(turn: int) -> Column:
    return F.col("pc").isNotNull() & (_coin("c", "x", turn) == 1) & (_coin("pc", "px", turn) == 0)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    after, heads = {}, []
    for batch in batches:
        for r in batch.to_pylist():
            after[r["c"], r["x"]] = (None if r["sc"] is None else (r["sc"], r["sx"]), r["size"])
            if r["pc"] is None:
                heads.append((r["c"], r["x"]))
    rows = []
    for at in heads:
        place = 0
        while at is not None:
            rows.append((*at, place))
            at, size = after[at]
            place += size
    yield pa.RecordBatch.from_arrays([pa.array(col, pa.int64()) for col in (zip(*rows) if rows else ((), (), ()))], ["c", "x", "place"])


def linked(elements: DataFrame) -> DataFrame:
    """``elements`` (c, x, sc, sx, size) with the predecessor (pc, px) and its size (psize); null where there is none."""
    back = elements.where("sc IS NOT NULL").select(F.col("sc").alias("c"), F.col("sx").alias("x"), F.col("c").alias("pc"), F.col("x").alias("px"),
                                                   F.col("size").alias("psize"))
    return elements.join(back, ["c", "x"], "left")


def _round(now: DataFrame, turn: int) -> DataFrame:
    """The list without the elements that this turn splices out."""
    gone = now.where(_spliced(turn))
    none = F.lit(None).cast("long")
    stay = now.where(~F.coalesce(_spliced(turn), F.lit(False))).select(
        "c", "x", "sc", "sx", "size", "pc", "px", "psize", F.lit(0).alias("told"), none.alias("nsc"), none.alias("nsx"), F.lit(0).cast("long").alias("add"),
        none.alias("npc"), none.alias("npx"), none.alias("npsize"))
    ahead = gone.select(F.col("pc").alias("c"), F.col("px").alias("x"), *[none] * 6, F.lit(1), F.col("sc"), F.col("sx"), F.col("size"), *[none] * 3)
    behind = gone.where("sc IS NOT NULL").select(F.col("sc").alias("c"), F.col("sx").alias("x"), *[none] * 6, F.lit(0), none, none, F.lit(0).cast("long"),
                                                 F.col("pc"), F.col("px"), F.col("psize") + F.col("size"))
    all_of = [n for n in stay.columns if n not in ("c", "x", "add")]
    met = stay.union(ahead).union(behind).groupBy("c", "x").agg(*[F.max(n).alias(n) for n in all_of], F.sum("add").alias("add"))
    told = F.col("told") == 1
    return met.select(
        "c", "x", F.when(told, F.col("nsc")).otherwise(F.col("sc")).alias("sc"), F.when(told, F.col("nsx")).otherwise(F.col("sx")).alias("sx"),
        (F.col("size") + F.col("add")).alias("size"), F.coalesce("npc", "pc").alias("pc"), F.coalesce("npx", "px").alias("px"),
        F.coalesce("npsize", "psize").alias("psize"))


def places(elements: DataFrame, name: str, small: int | None = None) -> DataFrame:
    """(c, x, place): the summed-up ``size`` of all elements before each one in its list.

    ``elements`` has (c, x, sc, sx, size), all long; a null successor ends a list. An empty table gives none.
    """
    small = SMALL if small is None else small
    rounds = [written(linked(elements), name)]
    while rounds[-1].count() > small:
        rounds.append(written(_round(rounds[-1], len(rounds) - 1), name))
    found = written(rounds.pop().coalesce(1).mapInArrow(_walk, "c long, x long, place long"), name)
    while rounds:
        turn = len(rounds) - 1
        gone = rounds.pop().where(_spliced(turn)).select("c", "x", F.col("pc"), F.col("px"), "psize")
        known = found.select(F.col("c").alias("pc"), F.col("x").alias("px"), "place")
        back = gone.join(known, ["pc", "px"]).select("c", "x", (F.col("place") + F.col("psize")).alias("place"))
        found = written(found.union(back), name)
    return found
