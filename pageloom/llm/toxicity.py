"""Toxicity of texts: gradient-boosted trees over dense features, calibrated by isotonic regression.

The features are rates that need no vocabulary of the corpus: densities of a lexicon and of
its disguised spellings, how near second-person words stand to it, capitals, punctuation and
obfuscation. The lexicon is a fixed seed and the beginnings of words that a bounded sample of
labelled rows shows mostly in toxic texts, each with the share of toxic ones. Trees and calibration come from Spark's library.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.registry import query, table
from pageloom.llm.words import slices
from pageloom.session import written

#: Labelled rows that the model is fitted on, at most about, chosen by a hash of the id.
SAMPLE_ROWS = 20_000
#: Beginnings of words that may be learned beside the seed, how many toxic texts must hold each, and their lengths.
LEARNED, LEAST_TEXTS, STEMS = 300, 5, (3, 4, 5, 6, 7)
#: The share of toxic texts among those with a stem from which on it leans, or is sure.
LEANS, SURE = 0.35, 0.9
#: Toxic texts that the calibration fold must hold to be used alone.
LEAST_CALIBRATION = 30
#: Trees, their depth, and the share of each that is added.
TREES, DEPTH, STEP = 20, 3, 0.3

#: Insults that any sample would teach, second-person words, and letters that signs stand for.
SEED = frozenset("idiot moron stupid loser pathetic disgusting worthless trash scum clown dumb imbecile fool retard freak".split())
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer tú ti usted ustedes vosotros tus".split())
DISGUISE = str.maketrans("01345789@$!|", "oieastbgasil")

FEATURES = (
    "log_words", "leaning_hits", "leaning_density", "leaning_kinds", "lean", "lexicon_hits", "lexicon_density", "disguised_hits", "second_density", "second_near", "lexicon_kinds",
    "capitals", "marks", "exclamations", "digits", "obfuscated", "stretched", "longest_gap",
)

_WORDS = re.compile(r"[^\W_]+").findall
_ODD_WORDS = re.compile(r"[^\W\d_]+[0-9@$!|][^\W_@$!|]*[0-9@$!|\w]*").findall

_KIND = np.zeros(256, dtype=np.int8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[[*range(48, 58), *map(ord, "@$*!|")]] = 2


class Lexicon:
    """Whole words, which are sure, and stems: beginnings of words, each with its share of toxic texts."""

    def __init__(self, words: frozenset[str], stems: dict[str, float] | None = None):
        self.words, self.stems = words, stems or {}
        self.begin = frozenset(s[: STEMS[0]] for s in [*words, *self.stems])

    def share(self, word: str) -> float:
        if word[: STEMS[0]] not in self.begin:
            return 0.0
        return 1.0 if word in self.words else max(self.stems.get(word[:k], 0.0) for k in STEMS)


def features_of(text: str, lexicon: Lexicon) -> list[float]:
    """The features of one text, in the order of ``FEATURES``; all 0 for one without words."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    words = _WORDS(text.lower())
    if not words:
        return [0.0] * len(FEATURES)
    begin, size = lexicon.begin, STEMS[0]
    shares = [(k, x) for k, w in enumerate(words) if w[:size] in begin and (x := lexicon.share(w))]
    hits = [k for k, x in shares if x >= SURE]
    leaning = [k for k, x in shares if x < SURE]
    count = len(words)
    bytes_ = np.bincount(data, minlength=256)
    letters = max(1, int(bytes_[65:91].sum() + bytes_[97:123].sum() + bytes_[192:].sum()))
    kind = _KIND[data]
    inside = int(((kind[1:-1] == 2) & (kind[:-2] == 1) & (kind[2:] == 1)).sum())
    same = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & (kind[2:] == 1)
    disguised = 0
    if inside:
        disguised = sum(lexicon.share(w.translate(DISGUISE).lower()) >= SURE for w in _ODD_WORDS(text))
    second = [k for k, w in enumerate(words) if w in SECOND_PERSON] if hits else []
    near = 0.0
    if hits and second:
        at = np.searchsorted(second, hits)
        s = np.array(second)
        apart = np.minimum(np.abs(s[np.minimum(at, len(s) - 1)] - hits), np.abs(s[np.maximum(at - 1, 0)] - hits))
        near = 1.0 / (1.0 + float(apart.min()))
    marks = int(bytes_[33:48].sum() + bytes_[58:65].sum() + bytes_[91:97].sum() + bytes_[123:127].sum())
    return [
        float(np.log1p(count)), float(len(leaning)), len(leaning) / count, float(len({words[k] for k in leaning})),
        sum(x for _, x in shares) / count, float(np.log1p(len(hits))), len(hits) / count, float(disguised), len(second) / count, near,
        float(len({words[k] for k in hits})), float(bytes_[65:91].sum()) / letters, marks / len(data), float(bytes_[33]) / count,
        float(bytes_[48:58].sum()) / len(data), inside / count, float(same.sum()) / letters,
        float(np.log1p(np.diff(hits).max())) if len(hits) > 1 else 0.0,
    ]


def _measure(lexicon: Broadcast, dropped: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = lexicon.value
    for batch in batches:
        for part in slices(batch, "text"):
            texts = pc.fill_null(part.column("text"), "").to_pylist()
            grid = np.array([features_of(t, words) for t in texts], dtype=np.float64).reshape(-1, len(FEATURES))
            keep = [k for k, name in enumerate(part.schema.names) if name != dropped]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(k) for k in keep), *(pa.array(grid[:, k]) for k in range(len(FEATURES)))],
                [*(part.schema.names[k] for k in keep), *(f"f_{f}" for f in FEATURES)])


def measured(rows: DataFrame, lexicon: Lexicon, keep_text: bool = False) -> DataFrame:
    """``rows`` with a column ``f_…`` for each feature, instead of ``text`` or beside it."""
    words = rows.sparkSession.sparkContext.broadcast(lexicon)
    dropped = "" if keep_text else "text"
    kept = [f for f in rows.schema.fields if f.name != dropped]
    schema = T.StructType([*kept, *(T.StructField(f"f_{f}", T.DoubleType()) for f in FEATURES)])
    return rows.mapInArrow(partial(_measure, words, dropped), schema)


def _stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each beginning of a word, the texts that hold it and the toxic ones among them."""
    for batch in batches:
        for part in slices(batch, "text"):
            texts, bad = Counter(), Counter()
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                words = set(_WORDS(text.lower()))
                found = {w[:k] for k in STEMS for w in words if len(w) >= k}
                texts.update(found)
                if toxic:
                    bad.update(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(texts), pa.string()), pa.array(list(texts.values()), pa.int64()), pa.array([bad[s] for s in texts], pa.int64())],
                ["stem", "n", "bad"])


def learned_lexicon(sample: DataFrame) -> Lexicon:
    """The seed and the stems that mark toxic texts of the sample, at most ``LEARNED`` of them.

    Of stems that begin one another, the longest one stays that stands in nearly all the
    texts of the shorter, and then longer ones only if they are sure where it is not.
    """
    totals = sample.agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).first()
    if not totals["bad"]:
        return Lexicon(SEED)
    share = totals["bad"] / totals["n"]
    counts = sample.select("text", "toxic").mapInArrow(_stems, "stem string, n long, bad long").groupBy("stem").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    spread = F.sqrt(F.col("n") * share * (1 - share) + 0.5)
    marked = counts.where((F.col("bad") >= LEAST_TEXTS) & (F.col("bad") >= LEANS * F.col("n")) & (F.col("bad") >= 3 * share * F.col("n"))).withColumn(
        "z", (F.col("bad") - F.col("n") * share) / spread)
    best = {r["stem"]: (r["bad"], r["bad"] / r["n"]) for r in marked.where("z >= 5").orderBy(F.desc("z"), "stem").limit(LEARNED).collect()}
    kept: dict[str, float] = {}
    for stem, (bad, rate) in sorted(best.items(), key=lambda x: len(x[0])):
        known = max((kept.get(stem[:k], 0.0) for k in STEMS), default=0.0)
        longer = any(s.startswith(stem) and len(s) > len(stem) and n >= 0.95 * bad for s, (n, _) in best.items())
        if not longer and (known == 0.0 or known < SURE <= rate):
            kept[stem] = rate
    return Lexicon(SEED, kept)


class Model:
    """A lexicon, trees and a calibration. Without both labels in the sample there are no trees."""

    def __init__(self, lexicon, trees, calibration, share):
        self.lexicon, self.trees, self.calibration, self.share = lexicon, trees, calibration, share


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"f_{f}" for f in FEATURES], outputCol="features").transform(rows)


def _margin(trees, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn("margin", vector_to_array("probability")[1])


def fit(docs: DataFrame, labels: DataFrame, train: Column, calibrate: Column, sample_rows: int = SAMPLE_ROWS,
        id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from ``labels`` (id, toxic) of the documents that ``train`` and ``calibrate`` choose.

    Both are conditions on the column ``doc_id`` of labels. Labels are read for at most about
    ``sample_rows`` documents, chosen by a hash; that list has a fixed size, so it is sent to all
    tasks. Rows without a label or a text teach nothing, repeated texts teach once, and a
    document with contradicting labels counts as toxic.
    """
    spark = docs.sparkSession
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(train | calibrate)
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"), F.first(calibrate).alias("calibrate"))
    share = min(1.0, sample_rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    sample = texts.join(F.broadcast(chosen), "doc_id").withColumn("h", F.xxhash64("text")).dropDuplicates(["h"])
    sample = written(sample.select("text", "toxic", "calibrate"), "toxicity-sample")
    lexicon = learned_lexicon(sample.where(~F.col("calibrate")))
    rows = written(measured(sample, lexicon), "toxicity-features")
    stats = rows.groupBy("calibrate").agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).collect()
    n, bad = sum(r["n"] for r in stats), sum(r["bad"] for r in stats)
    usable = {r["calibrate"] for r in stats if (LEAST_CALIBRATION if r["calibrate"] else 1) <= r["bad"] < r["n"]}
    if False not in usable:
        return Model(lexicon, None, None, bad / n if n else 0.0)
    rows = _assembled(rows).select("toxic", "calibrate", "features").coalesce(4).persist()
    booster = GBTClassifier(labelCol="toxic", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7, cacheNodeIds=False)
    trees = booster.fit(rows.where(~F.col("calibrate")))
    judged = _margin(trees, rows.where("calibrate" if True in usable else "true"))
    calibration = IsotonicRegression(labelCol="toxic", featuresCol="margin", predictionCol="prediction_calibrated").fit(judged)
    rows.unpersist()
    return Model(lexicon, trees, calibration, bad / n)


def _scored(rows: DataFrame, model: Model, keep_text: bool = False) -> DataFrame:
    """``rows`` (columns c0, c1, …, and text) with ``score`` and ``predicted``."""
    kept = [c for c in rows.columns if keep_text or c != "text"]
    if model.trees is None:
        scored = rows.withColumn("score", F.lit(float(model.share)))
    else:
        scored = _margin(model.trees, _assembled(measured(rows, model.lexicon, keep_text)))
        scored = model.calibration.transform(scored).withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prediction_calibrated"))))
    return scored.select(*kept, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without ``text_col`` and with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Null and empty texts are scored like any text without words. Only the text is looked
    at. Other columns stay, whatever their names; those called ``score`` or ``predicted`` are
    replaced. Without trees every text gets the share of toxic rows.
    """
    names = [c for c in docs.columns if c not in (text_col, "score", "predicted")]
    held = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)]
    scored = _scored(docs.select(*held, F.col(f"`{text_col}`").alias("text")), model)
    return scored.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)], "score", "predicted")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model predicts 0 for, with the columns they came with."""
    names = {c: "text" if c == "text" else f"c{k}" for k, c in enumerate(docs.columns)}
    scored = _scored(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), model, keep_text=True)
    return scored.where(F.col("predicted") == 0).select(*[F.col(n).alias(c) for c, n in names.items()])


def _fold() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5


def fit_tables(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the table of labels, learned without the held-out fifth."""
    return fit(docs, labels, _fold().isin(2, 3, 4), _fold() == 1)


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_tables(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, model)
    return scored.select("doc_id", F.coalesce(_fold() == 0, F.lit(False)).alias("held_out"), "score", "predicted")
