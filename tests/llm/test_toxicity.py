import random

import pytest
from pyspark.sql import functions as F

from pageloom.llm import toxicity


def test_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = toxicity.op8_toxicity(spark, sf).join(labels, "doc_id").where("held_out").collect()
    bad = [r for r in rows if r["toxic"] == 1]
    fine = [r for r in rows if r["toxic"] == 0]
    assert sum(r["predicted"] for r in bad) >= 0.6 * len(bad)
    assert sum(r["predicted"] for r in fine) <= 0.05 * len(fine)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_features():
    lexicon = toxicity.Lexicon(toxicity.SEED, {"blarg": 0.95, "meh": 0.5})
    names = dict(zip(toxicity.FEATURES, toxicity.features_of("You are an IDIOT!! blargen, mehly 1d10t w0rthless", lexicon)))
    assert names["lexicon_kinds"] == 2 and names["leaning_hits"] == 1 and names["second_near"] > 0 and names["exclamations"] > 0 and names["disguised_hits"] >= 1
    assert set(toxicity.features_of("", lexicon)) == {0.0} and len(toxicity.features_of("a", lexicon)) == len(toxicity.FEATURES)


@pytest.fixture(scope="module")
def model(spark):
    draw = random.Random(4)
    texts = [["".join(draw.choice("abcdefg") for _ in range(draw.randint(1, 8))) for _ in range(draw.randint(0, 60))] for _ in range(600)]
    for words in texts[::4]:
        words += ["idiot", "you", "moron"]
        draw.shuffle(words)
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(texts)], "doc_id long, text string")
    labels = docs.select("doc_id", F.col("text").contains("idiot").cast("int").alias("toxic"))
    return toxicity.fit_tables(docs, labels)


def test_filter_keeps_columns_and_clean_rows(spark, odd_docs, empty_docs, model):
    kept = toxicity.without_toxic(odd_docs, model)
    assert kept.columns == odd_docs.columns
    assert kept.count() == odd_docs.count()
    bad = spark.createDataFrame([(1, "you stupid idiot you moron"), (2, "a quiet text about item 7")], "doc_id long, text string")
    assert [r["doc_id"] for r in toxicity.without_toxic(bad, model).collect()] == [2]
    assert toxicity.without_toxic(empty_docs, model).collect() == []


def test_without_labels_or_with_one_only(spark, odd_docs, empty_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    lone = toxicity.fit_tables(odd_docs, none)
    assert {r["score"] for r in toxicity.score(odd_docs.select("doc_id", "text"), lone).collect()} == {0.0}
    one = spark.createDataFrame([(k, 1) for k in range(1, 9)], "doc_id long, toxic int")
    assert toxicity.fit_tables(odd_docs, one).trees is None
    assert toxicity.fit_tables(empty_docs, one).trees is None


def test_scores_with_columns_of_any_name(spark, odd_docs, model):
    docs = odd_docs.selectExpr("*", "1 AS features", "2 AS margin", "3 AS predicted", "4 AS c0", "5 AS f_lean", "6 AS probability", "7 AS rawPrediction")
    scored = toxicity.score(docs, model)
    assert scored.columns == [c for c in docs.columns if c not in ("text", "score", "predicted")] + ["score", "predicted"]
    rows = scored.collect()
    assert len(rows) == docs.count() and all((r["features"], r["margin"], r["c0"], r["f_lean"], r["probability"]) == (1, 2, 4, 5, 6) for r in rows)
    plain = sorted(r["score"] for r in toxicity.score(docs.select("doc_id", "text"), model).collect())
    assert sorted(r["score"] for r in rows) == plain
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == docs.count()
