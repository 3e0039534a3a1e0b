import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.llm import ann


def brute(rows, k=5):
    out = {}
    for q, a in rows:
        if q % 50:
            continue
        scored = []
        for v, b in rows:
            if v != q and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                scored.append((-(x * y).sum() / (math.sqrt((x * x).sum()) * math.sqrt((y * y).sum())), v))
        out[q] = [(v, -s) for s, v in sorted(scored)[:k]]
    return out


def test_recall_on_the_table(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows)
    got = {}
    for r in ann.op9_neighbours(spark, sf).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    known = {q: dict(brute([r for r in rows if r[0] == q or r[0] in {v for v, _ in got[q]}], 5)[q]) for q in list(want)[:5]}
    assert all(abs(s - known[q][v]) < 1e-12 for q in known for v, s in got[q])


def test_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 150)
    monkeypatch.setattr(ann, "BLOCK", 4)
    draw = np.random.default_rng(1)
    rows = [(k, draw.standard_normal(16).tolist()) for k in range(700)]
    want = brute(rows)
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["query_id"], r["vec_id"]) for r in ann.nearest(vectors, F.col("id") % 50 == 0).collect()]
    assert len(got) == len(set(got)) == 5 * len(want)
    assert len(set(got) & {(q, v) for q in want for v, _ in want[q]}) >= 0.9 * len(got)


def test_few_rows_ties_and_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (2, [3.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [None, 1.0]),
        (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, []), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (50, [-1.0, 0.0]), (100, [0.0, 0.0]),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS key", "2 AS id", "3 AS rank")
    got = [tuple(r) for r in ann.nearest(vectors, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 0.0), (0, 4, 50, -1.0), (50, 1, 3, 0.0), (50, 2, 0, -1.0), (50, 3, 1, -1.0), (50, 4, 2, -1.0)]
    assert ann.nearest(vectors.where("false"), F.col("id") % 50 == 0).collect() == []


@pytest.mark.parametrize(("dim", "spread"), [(64, None), (256, None), (64, 0.3), (256, 0.3)])
def test_recall_and_share_of_verified_vectors(dim, spread):
    """On vectors without any structure, the hardest ones, and on such that lie round a hundred centres."""
    draw = np.random.default_rng(dim)
    vectors = draw.standard_normal((4_000, dim))
    if spread:
        vectors = draw.standard_normal((100, dim))[draw.integers(0, 100, 4_000)] + spread * vectors
    shard = ann.Shard(np.arange(4_000), vectors)
    queries = np.arange(0, 4_000, 100)
    got = shard.nearest(queries, vectors[queries], 5)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    cosine = unit[queries] @ unit.T
    cosine[np.arange(len(queries)), queries] = -2
    want = {(int(q), int(v)) for q, row in zip(queries, np.argsort(-cosine, axis=1)[:, :5]) for v in row}
    assert len(got) == len(want) and len(want & {(q, v) for q, v, _ in got}) >= 0.9 * len(want)
    share = shard.verified / (len(queries) * 4_000)
    assert share < (0.05 if spread else 0.25 if dim == 64 else 0.75), share


def test_numbers_at_the_ends_of_the_range(spark):
    rows = [(0, [1e-200, 2e-200]), (1, [1e200, 2e200]), (2, [3e-308, -1e-308]), (3, [5e-324, 5e-324]), (4, [1e308, 1e308]), (5, [1.0, 2.0]), (50, [-1e300, 1e-300])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in ann.nearest(vectors, F.col("id") % 50 == 0).collect()}
    assert set(got) == {(0, v) for v in (1, 2, 3, 4, 5)} | {(50, v) for v in (0, 1, 3, 4, 5, 2)} - {(50, 2)}
    assert got[0, 1] == got[0, 5] and abs(got[0, 1] - 1) < 1e-15 and abs(got[0, 3] - got[0, 4]) < 1e-15 and abs(got[50, 4] + 0.5**0.5) < 1e-12
