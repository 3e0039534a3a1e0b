import itertools
import math
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from pageloom.llm import langid

PIECES = sorted(["▁", "▁a", "a", "b", "ab", "▁ab", "c", "bc", "abc"])


def segmentations(text):
    for cuts in itertools.product((False, True), repeat=len(text) - 1):
        at = [0, *(k + 1 for k, c in enumerate(cuts) if c), len(text)]
        yield [text[i:j] for i, j in zip(at, at[1:])]


def brute(word, chance):
    total = np.zeros(chance.shape[1])
    expected = np.zeros_like(chance)
    for pieces in segmentations(langid.BEGIN + word):
        index = [PIECES.index(p) if p in PIECES else len(PIECES) if len(p) == 1 else None for p in pieces]
        if None in index:
            continue
        p = np.prod(chance[index], axis=0)
        total += p
        for i in index:
            expected[i] += p
    return total, expected / total


def test_sums_over_all_segmentations():
    chance = np.random.default_rng(0).random((len(PIECES) + 1, 2))
    words = ["abc", "a", "zab", "cabcab", "bbabcz", "abcabcab", "q"]
    pieces = langid.Pieces(PIECES)
    assert np.allclose(langid.log_chances(pieces, chance, words), np.log([brute(w, chance)[0] for w in words]))
    counts = langid.expected(pieces, chance, words, np.ones((len(words), 2)))
    assert np.allclose(counts, sum(brute(w, chance)[1] for w in words))


def test_runs_of_any_length(monkeypatch):
    """Sums that no float holds, by exact fractions."""
    draw = np.random.default_rng(1)
    chance = draw.random((len(PIECES) + 1, 2)) * 1e-12
    pieces = langid.Pieces(PIECES)
    words = ["".join(draw.choice(list("abcz"), n)) for n in (30, 90, 255, 256, 257, 700)]
    want = []
    for word in words:
        text, sums = langid.BEGIN + word, [[Fraction(1)] * 2]
        for j in range(1, len(text) + 1):
            total = [Fraction(0)] * 2
            for i in range(max(0, j - 3), j):
                p = text[i:j]
                at = PIECES.index(p) if p in PIECES else len(PIECES) if len(p) == 1 else None
                if at is not None:
                    total = [t + s * Fraction(c) for t, s, c in zip(total, sums[i], chance[at].tolist())]
            sums.append(total)
        want.append([math.log(t.numerator) - math.log(t.denominator) for t in sums[-1]])
    assert np.allclose(langid.log_chances(pieces, chance, words), want, rtol=1e-9)
    monkeypatch.setattr(langid, "TOGETHER", 10)
    assert np.allclose(langid.log_chances(pieces, chance, words), want, rtol=1e-9)


def test_letters_and_their_marks(spark, sf):
    assert langid.words_of("½ ² 10 Ⅻ ① _ 3x") == ["x"]
    assert langid.words_of("हिन्दी ภาษาไทย Ünï e\u0301t") == ["हिन्दी", "ภาษาไทย", "ünï", "e\u0301t"]
    assert langid.words_of("\u0301a1b" + "x" * 500) == ["a", "b" + "x" * 500]
    model = langid.fit(spark.read.parquet(f"{sf}/documents.parquet"), langid.piece_vocabulary(langid.vocabulary_path()))
    texts = [(1, "½ ² 10"), (2, "ภาษาไทย" * 2_000), (3, "x" * 3_000)]
    rows = {r["doc_id"]: r for r in langid.predict(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    assert (rows[1]["lang_pred"], rows[1]["score"]) == ("und", 0.0)
    assert all(rows[k]["lang_pred"] in model.langs and 0 < rows[k]["score"] <= 1 for k in (2, 3))


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = langid.op5_language(spark, sf).join(docs, "doc_id").where("held_out").collect()
    assert rows and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(spark, odd_docs, empty_docs):
    model = langid.fit(odd_docs, langid.piece_vocabulary(langid.vocabulary_path()))
    assert model.langs == ["de", "en"]
    rows = langid.predict(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    assert {(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] in (2, 3, 4)} == {("und", 0.0)}
    none = langid.fit(empty_docs, PIECES)
    assert none.langs == [] and langid.predict(empty_docs, none).collect() == []
    assert {r["lang_pred"] for r in langid.predict(odd_docs, none).collect()} == {"und"}


def test_only_the_text_is_looked_at(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(docs, langid.piece_vocabulary(langid.vocabulary_path()))
    plain = langid.predict(docs, model).orderBy("doc_id").collect()
    changed = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y"))
    assert langid.predict(changed, model).orderBy("doc_id").collect() == plain
