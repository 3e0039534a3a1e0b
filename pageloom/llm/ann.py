"""Nearest neighbours by collision counting on single projections.

Every vector of a shard is projected on some random directions, and each direction keeps its
values in one sorted array. A query opens a window around its own value in every array and
widens all of them step by step, which is virtual rehashing: nothing is hashed again, the
windows only take in more of each array. A vector collides once for every window that holds it,
and is verified by its cosine when it reaches the collision threshold. The distance of two
vectors tells how their projections differ, so a query stops at the width at which a vector as near as
the last of its best ones so far would most likely have reached the threshold.

A shard is indexed whole and answers all queries, in blocks, so a task holds one shard and one
block. Every block meets every shard: the work is the product of queries and rows, of which
the windows leave out what is far on too many projections.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageloom.llm.jaccard import groups
from pageloom.llm.registry import query, table

#: Projections, and the share of their windows that a vector must lie in to be verified.
PROJECTIONS, THRESHOLD = 96, 0.7
#: The chance that a vector as near as the last of the best ones has reached the threshold when a query stops.
SURE = 0.9
#: The first window's half width, in standard deviations of a projection, and the factor of each step.
WIDTH, WIDER = 0.5, 1.35
#: Vectors of a shard and queries of a block.
SHARD, BLOCK = 8_192, 4_096
#: Queries whose windows are widened together.
TOGETHER = 256


def reach(projections: int = PROJECTIONS, threshold: float = THRESHOLD, sure: float = SURE) -> float:
    """The half width, in units of two vectors' distance, at which they share enough windows with the chance ``sure``."""
    normal = NormalDist()
    need, low, high = np.ceil(threshold * projections) - 0.5, 0.0, 1.0
    for _ in range(60):
        p = (low + high) / 2
        enough = projections * p - normal.inv_cdf(sure) * np.sqrt(projections * p * (1 - p)) >= need
        low, high = (low, p) if enough else (p, high)
    return normal.inv_cdf((1 + high) / 2) if high < 1 else np.inf


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors, each times a power of two that brings its largest component near 1: squares neither vanish nor overflow, and no digit changes."""
    if not vectors.size:
        return vectors
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


class Shard:
    """The sorted projections of some vectors of one dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int = 11):
        self.ids, self.vectors = ids, _scaled(vectors)
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        dim = vectors.shape[1]
        self.axes = np.random.default_rng([seed, dim]).standard_normal((dim, PROJECTIONS))
        values = (self.vectors / self.norms[:, None]) @ self.axes
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(values.T, self.order, axis=1)
        self.verified = 0

    def nearest(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> list[tuple[int, int, float]]:
        """(query, vector, cosine) of the ``k`` nearest of the vectors that are verified for each query."""
        out = []
        for at in range(0, len(ids), TOGETHER):
            out += self._nearest(ids[at : at + TOGETHER], _scaled(vectors[at : at + TOGETHER]), k)
        return out

    def _nearest(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> list[tuple[int, int, float]]:
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        places = (vectors / norms[:, None]) @ self.axes
        need, factor, count = int(np.ceil(THRESHOLD * PROJECTIONS)), reach(), len(self.ids)
        hits, done = np.zeros((len(ids), count), dtype=np.int16), np.zeros((len(ids), count), dtype=bool)
        known, cosines = [np.zeros(0, dtype=np.int64)] * len(ids), [np.zeros(0)] * len(ids)
        low = high = np.zeros((len(ids), PROJECTIONS), dtype=np.int64)
        opened = False
        widths, live = np.full(len(ids), WIDTH), np.arange(len(ids))
        out: list[list[tuple[int, int, float]]] = [[] for _ in ids]
        while len(live):
            new_low = np.stack([np.searchsorted(self.sorted[j], places[live, j] - widths[live]) for j in range(PROJECTIONS)], axis=1)
            new_high = np.stack([np.searchsorted(self.sorted[j], places[live, j] + widths[live], "right") for j in range(PROJECTIONS)], axis=1)
            stay = np.ones(len(live), dtype=bool)
            for n, q in enumerate(live.tolist()):
                if opened:
                    parts = [self.order[j, a:b] for j, (a, b) in enumerate(zip(new_low[n], low[n]))] + [self.order[j, a:b] for j, (a, b) in enumerate(zip(high[n], new_high[n]))]
                else:
                    parts = [self.order[j, a:b] for j, (a, b) in enumerate(zip(new_low[n], new_high[n]))]
                hits[q] += np.bincount(np.concatenate(parts), minlength=count).astype(np.int16)
                whole = bool((new_low[n] == 0).all() and (new_high[n] == count).all())
                reached = np.flatnonzero(~done[q] if whole else (hits[q] >= need) & ~done[q])
                done[q, reached] = True
                reached = reached[self.ids[reached] != ids[q]]
                # row by row, so that equal vectors get equal sums and ties stay ties
                cosines[q] = np.concatenate([cosines[q], (self.vectors[reached] * vectors[q]).sum(axis=1) / (self.norms[reached] * norms[q])])
                known[q] = np.concatenate([known[q], reached])
                self.verified += len(reached)
                far = factor * np.sqrt(2.0 * max(0.0, 1.0 - np.partition(cosines[q], -k)[-k])) if len(known[q]) >= k else np.inf
                if whole or widths[q] >= far:
                    stay[n] = False
                    best = np.lexsort((self.ids[known[q]], -cosines[q]))[:k]
                    out[q] = [(int(ids[q]), int(self.ids[known[q][b]]), float(cosines[q][b])) for b in best.tolist()]
                widths[q] = min(widths[q] * WIDER, far)
            live, low, high, opened = live[stay], new_low[stay], new_high[stay], True
        return [row for rows in out for row in rows]


def _answer(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in groups(batches, "key"):
        vectors = np.stack([np.asarray(v, dtype=np.float64) for v in group.column("vector").to_pylist()])
        ids = group.column("id").to_numpy(zero_copy_only=False)
        asks = group.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        if asks.all() or not asks.any():
            continue
        shard = Shard(ids[~asks], vectors[~asks])
        rows: list[tuple[int, int, float]] = []
        queries = np.flatnonzero(asks)
        rows += shard.nearest(ids[queries], vectors[queries], k)
        query_id, vec_id, score = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(query_id, pa.int64()), pa.array(vec_id, pa.int64()), pa.array(score, pa.float64())], ["query_id", "vec_id", "score"])


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, asks: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest by cosine of each row for which ``asks`` holds.

    ``asks`` is a condition on the column ``id``. Candidates are all rows but those with the
    query's id. Vectors that are null, empty, zero, or hold null or non-finite numbers take no
    part, nor do rows without an id; vectors of different length are not compared. Of rows
    that repeat an id the least vector counts. Ties go to the smaller id. Components may be as small or large as a
    number can be.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & _usable(F.col("vector"))).groupBy("id").agg(F.min("vector").alias("vector"))
    sizes = rows.agg(F.count("*").alias("n"), F.count(F.when(asks, 1)).alias("q")).first()
    shards, blocks = max(1, -(-sizes["n"] // SHARD)), max(1, -(-sizes["q"] // BLOCK))
    shard, block = (F.pmod(F.xxhash64("id"), F.lit(n)) for n in (shards, blocks))
    indexed = rows.select("id", "vector", F.lit(False).alias("asks"), shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    asked = rows.where(asks).select("id", "vector", F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block.alias("block"))
    both = indexed.union(asked).withColumn("key", F.xxhash64(F.size("vector"), F.col("shard").cast("long"), F.col("block").cast("long")))
    met = both.select("key", "id", "vector", "asks").repartition("key").sortWithinPartitions("key")
    found = met.mapInArrow(partial(_answer, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query("op9_neighbours")
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth vector, among all vectors."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
