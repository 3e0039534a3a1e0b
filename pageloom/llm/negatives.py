"""Hard negatives by a vertical scan of columnar vectors (BOND).

The vectors of a shard lie as columns, one per dimension. An anchor reads the columns in the
descending order of its own magnitudes and keeps a bitmap of the candidates that can still
matter: what the dimensions not yet read can add or take away is bounded by the least and
largest value of each column. First the most similar rows of the anchor's label are found,
its positives; each of them opens a window of scores, and a second scan shrinks the rows of
other labels to those whose bounds still meet a window, until the best of each are exact.

Components are whole numbers and sums of them are exact: floats where they hold every sum,
64-bit numbers beyond, Python's own numbers beyond those.

Every block of anchors meets every shard, so the work is the product of anchors and rows, of
which the bounds leave out most columns of most rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageloom.llm.jaccard import groups
from pageloom.llm.registry import query, table

#: Vectors of a shard, anchors of a block, and columns that are read between two looks at the bounds.
SHARD, BLOCK, STEP = 8_192, 4_096, 8
#: Components are this many times the number, rounded down.
SCALE = 256
_LONG = (1 << 63) - 1


class Columns:
    """The rows of one shard by column, in the order of their ids."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        self.exact = vectors[order]
        self.largest = max((abs(int(v)) for v in (vectors.min(), vectors.max())), default=0) if vectors.size else 0
        self.kinds: dict[object, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def columns(self, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The columns, and the least and largest value of each, as numbers that hold all sums exactly."""
        top = max(1, self.exact.shape[1]) * max(1, self.largest) * max(1, largest)
        kind = np.float64 if 4 * top < 1 << 53 else np.int64 if 4 * top < 1 << 63 else object
        if kind not in self.kinds:
            columns = np.ascontiguousarray(whole(self.exact, kind).T)
            self.kinds[kind] = columns, columns.min(axis=1), columns.max(axis=1)
        return self.kinds[kind]

    def scan(self, anchor: np.ndarray, live: np.ndarray, useful) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the candidates ``live`` that ``useful`` keeps to the end.

        ``useful`` gets the lowest and highest score each candidate can have, and tells which ones can matter.
        """
        columns, low, high = self.columns(max((abs(int(v)) for v in (anchor.min(), anchor.max())), default=0) if anchor.size else 0)
        anchor = whole(anchor, columns.dtype)
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.sort(np.stack([anchor * low, anchor * high]), axis=0)[:, order]
        least, most = (np.concatenate([np.cumsum(e[::-1])[::-1], np.zeros(1, e.dtype)]) for e in ends)
        scores = np.zeros(len(live), dtype=columns.dtype)
        for at in range(0, len(order), STEP):
            if not len(live):
                break
            some = order[at : at + STEP]
            scores = scores + anchor[some] @ (columns[some] if len(live) == columns.shape[1] else columns[np.ix_(some, live)])
            after = min(at + STEP, len(order))
            kept = useful(scores + least[after], scores + most[after])
            if not kept.all():
                live, scores = live[kept], scores[kept]
        return live, scores


def whole(values: np.ndarray, kind) -> np.ndarray:
    """Whole numbers held as floats, as numbers of another kind."""
    if kind == object and values.dtype != object:
        return np.array([int(v) for v in values.ravel().tolist()], dtype=object).reshape(values.shape)
    return values.astype(kind)


def _kth(values: np.ndarray, k: int):
    """The ``k``-th largest value, or None if there are fewer."""
    if len(values) < k:
        return None
    return np.sort(values)[-k] if values.dtype == object else np.partition(values, len(values) - k)[len(values) - k]


def best(shard: Columns, anchor: np.ndarray, label: int, own: int, k: int) -> list[tuple[int, int]]:
    """(id, score) of the ``k`` best rows of ``label`` but the id ``own``; ties go to the smaller id."""
    def useful(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        least = _kth(low, k)
        return np.ones(len(low), dtype=bool) if least is None else (high >= least).astype(bool)

    live, scores = shard.scan(anchor, np.flatnonzero((shard.labels == label) & (shard.ids != own)), useful)
    order = sorted(range(len(live)), key=lambda n: (-int(scores[n]), n))[:k]
    return [(int(shard.ids[live[n]]), int(scores[n])) for n in order]


def within(shard: Columns, anchor: np.ndarray, label: int, windows: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
    """For each window of scores (both ends in it), (id, score) of the ``k`` best rows of another label."""
    def useful(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        kept = np.zeros(len(low), dtype=bool)
        for least, most in windows:
            meets = ((high >= least) & (low <= most)).astype(bool)
            sure = low[((low >= least) & (high <= most)).astype(bool)]
            beaten = _kth(sure, k)
            kept |= meets if beaten is None else meets & (high >= beaten).astype(bool)
        return kept

    live, scores = shard.scan(anchor, np.flatnonzero(shard.labels != label), useful)
    out = []
    for least, most in windows:
        inside = np.flatnonzero(((scores >= least) & (scores <= most)).astype(bool))
        if len(inside) > k:
            inside = inside[(scores[inside] >= _kth(scores[inside], k)).astype(bool)]
        inside = sorted(inside.tolist(), key=lambda n: (-int(scores[n]), n))[:k]
        out.append([(int(shard.ids[live[n]]), int(scores[n])) for n in inside])
    return out


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The scores s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column("vector")
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat.reshape(len(lists), len(flat) // max(1, len(lists))) * float(SCALE))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Columns, Iterator[tuple[int, int, np.ndarray, list]]]]:
    for group in groups(batches, "key"):
        vectors = _vectors(group)
        ids, labels, asks = (group.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label", "asks"))
        asks = asks.astype(bool)
        rows = np.flatnonzero(~asks)
        if not len(rows) or not asks.any():
            continue
        # one row for each id: the least by label, then by vector
        rows = np.array(sorted(rows.tolist(), key=lambda n: (ids[n], labels[n], vectors[n].tolist())))
        rows = rows[np.concatenate([[True], ids[rows][1:] != ids[rows][:-1]])]
        wanted = group.column("wanted")
        asked = ((int(ids[n]), int(labels[n]), vectors[n], wanted[n].as_py()) for n in np.flatnonzero(asks).tolist())
        yield Columns(ids[rows], labels[rows], vectors[rows]), asked


def _fits(score: int) -> int:
    return max(-_LONG - 1, min(_LONG, score))


def _positives(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for shard, asked in _shards(batches):
        rows = [(own, other, _fits(score)) for own, label, vector, _ in asked for other, score in best(shard, vector, label, own, k)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ((), (), ()))], ["id", "other", "score"])


def _negatives(k: int, low: int, high: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for shard, asked in _shards(batches):
        rows = []
        for own, label, vector, wanted in asked:
            wanted = [w for w in wanted if low * w["score"] <= high * w["score"]]
            found = within(shard, vector, label, [window(w["score"], low, high) for w in wanted], k)
            rows += [(own, w["other"], other, w["score"], score) for w, some in zip(wanted, found) for other, score in some]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ((),) * 5)],
            ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])


def _usable(vector: Column) -> Column:
    return F.forall(vector, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < F.lit(float("inf"))), F.lit(False)))


def hard_negatives(rows: DataFrame, asks: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows for which ``asks``, a condition on the column ``id``, holds. A score is
    the inner product of components times 256, rounded down. An anchor's positives are its best
    ``positives`` other rows of its label; for each, the best ``negatives`` rows of other labels
    whose score is ``low`` to ``high`` per cent of the positive's are returned, ranked from 1.
    Ties go to the smaller id. A positive whose window is empty, as for a negative score, has none.

    Rows whose id, label or vector is null, or that hold a component that is null or not finite
    (or not finite times 256), take no part; vectors of different length are not compared. Of
    rows that repeat an id the one with the least label, then the least vector counts. Scores
    beyond 64 bits are held at the ends of that range. Other columns, whatever their names, are not read.
    """
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).where(_usable(F.col("vector")))
    anchors = rows.where(asks).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("v")).select("id", "v.label", "v.vector")
    sizes = rows.agg(F.count("*").alias("n"), F.count(F.when(asks, 1)).alias("q")).first()
    shards, blocks = max(1, -(-sizes["n"] // SHARD)), max(1, -(-sizes["q"] // BLOCK))
    shard, block = (F.pmod(F.xxhash64("id"), F.lit(n)) for n in (shards, blocks))
    none = F.array().cast("array<struct<other:bigint,score:bigint>>")
    indexed = rows.select("id", "label", "vector", none.alias("wanted"), F.lit(False).alias("asks"), shard.alias("shard"),
                          F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def met(asked: DataFrame) -> DataFrame:
        asked = asked.select("id", "label", "vector", "wanted", F.lit(True).alias("asks"),
                             F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block.alias("block"))
        both = indexed.union(asked).withColumn("key", F.xxhash64(F.size("vector"), F.col("shard").cast("long"), F.col("block").cast("long")))
        return both.select("key", "id", "label", "vector", "wanted", "asks").repartition("key").sortWithinPartitions("key")

    found = met(anchors.withColumn("wanted", none)).mapInArrow(partial(_positives, positives), "id long, other long, score long")
    order = Window.partitionBy("id").orderBy(F.desc("score"), "other")
    first = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives)
    wanted = first.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("other", "score"))).alias("wanted"))
    found = met(anchors.join(wanted, "id")).mapInArrow(
        partial(_negatives, negatives, low, high), "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
    WITH e AS (
        SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
        FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
    p AS (
        SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS rank,
        other AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY rank <= 3"""


@query("op13_hard_negatives", ORACLE)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five positives of every fiftieth vector; every seventh vector is of the next label."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", label.alias("label"), "embedding"), F.col("id") % 50 == 0)
