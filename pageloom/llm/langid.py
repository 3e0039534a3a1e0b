"""Language of texts by unigram pieces, summed over all ways to cut a word into pieces.

The pieces come from a fixed public vocabulary; only their probabilities are learned, one
set per language, by expectation-maximisation over the words of a bounded sample. A word's
probability is the sum over all its segmentations (the forward algorithm), and a text's
score is the sum over its words. Words of one length are worked on together in numpy.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.registry import query, table
from pageloom.llm.words import slices

#: Documents per language that the probabilities are learned from, chosen by a hash.
SAMPLE_DOCS = 2_000
#: Rounds of expectation-maximisation, and the added count of every piece.
ROUNDS, SMOOTHING = 2, 0.05
#: Letters of the longest word that teaches something, and of the longest that is scored together with others.
LEARNED, TOGETHER = 64, 256
#: Words whose scores a task remembers; beyond that it forgets all and goes on.
MEMORY = 300_000

#: The vocabulary's mark of a word's beginning, and the language of texts without letters.
BEGIN, UNKNOWN = "▁", "und"

#: An odd multiplier for hashing substrings.
_BASE = 0x9E3779B97F4A7C15


def _class_of(kind: str) -> str:
    """The characters of a general category, as ranges of a pattern."""
    codes = np.array([c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == kind])
    cuts = np.flatnonzero(np.diff(codes) > 1)
    low, high = codes[np.append(0, cuts + 1)], codes[np.append(cuts, len(codes) - 1)]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(low.tolist(), high.tolist()))


@cache
def _letters() -> Callable[[str], list[str]]:
    """Finds the runs of letters, each with the marks behind it."""
    letters = _class_of("L")
    return re.compile(f"[{letters}][{letters}{_class_of('M')}]*+").findall


def words_of(text: str) -> list[str]:
    """The runs of letters of a text in lower case; marks belong to the letter before them."""
    return _letters()(text.lower())


class Pieces:
    """The vocabulary, and all beginnings of its pieces, for looking up substrings of many words at once."""

    def __init__(self, pieces: list[str]):
        self.count = len(pieces)
        self.longest = max(map(len, pieces), default=1)
        entries: dict[int, int] = {}
        for k, piece in enumerate(pieces):
            h = 0
            for c in piece:
                h = (h * _BASE + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
                entries.setdefault(h, -1)
            entries[h] = k
        hashes = np.array([*entries], dtype=np.uint64)
        order = np.argsort(hashes * np.uint64(_BASE))
        self.hashes, self.index = hashes[order], np.array([*entries.values()], dtype=np.int64)[order]
        # a table by the first bits of the hash narrows each search to a few places
        self.shift = np.uint64(64 - 18)
        self.begin = np.searchsorted(self._slot(self.hashes), np.arange((1 << 18) + 1)).astype(np.int32)
        self.most = int(np.diff(self.begin).max(initial=0))

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * np.uint64(_BASE)) >> self.shift).astype(np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are beginnings of pieces, and of these the piece, or -1."""
        slot = self._slot(hashes)
        at, stop = self.begin[slot], self.begin[slot + 1]
        rows, where = [], []
        live = np.arange(len(hashes))
        for k in range(self.most):
            live = live[at[live] + k < stop[live]]
            if not len(live):
                break
            hit = self.hashes[at[live] + k] == hashes[live]
            rows.append(live[hit])
            where.append(at[live[hit]] + k)
            live = live[~hit]
        rows = np.concatenate(rows) if rows else live
        return rows, self.index[np.concatenate(where)] if where else live

    def lattice(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
        """For words of like length: their places, their lengths, and all cuts (begin, end, rows, pieces).

        A single letter that is no piece counts as the piece behind the last one.
        """
        lengths = np.array([len(w) + 1 for w in words], dtype=np.int64)
        classes = (lengths + 3) // 4
        for c in np.unique(classes).tolist():
            own_class = np.flatnonzero(classes == c)
            for own in np.array_split(own_class, len(own_class) // 20_000 + 1):
                own = own[np.argsort(-lengths[own], kind="stable")]
                n = lengths[own]
                width = int(n[0])
                text = "".join([(BEGIN + words[k]).ljust(width) for k in own.tolist()])
                grid = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).reshape(len(own), width).astype(np.uint64).T.copy() + np.uint64(1)
                longer = np.searchsorted(-n, -np.arange(width + 1), "right")
                cuts = []
                for i in range(width):
                    live = np.arange(longer[i + 1])
                    h = np.zeros(len(live), dtype=np.uint64)
                    for j in range(i + 1, width + 1):
                        inside = live < longer[j]
                        live, h = live[inside], h[inside]
                        if not len(live):
                            break
                        h = h * np.uint64(_BASE) + grid[j - 1, live]
                        rows, found = self.find(h)
                        good = found >= 0
                        use, piece = live[rows[good]], found[good]
                        if j == i + 1 and len(use) < len(live):
                            rest = np.setdiff1d(live, use, assume_unique=True)
                            use, piece = np.concatenate((use, rest)), np.concatenate((piece, np.full(len(rest), self.count)))
                        if len(use):
                            cuts.append((i, j, use, piece))
                        live, h = live[rows], h[rows]
                yield own, n, cuts


#: Every so many letters, sums that have become smaller than this are scaled up.
_EVERY, _TINY = 8, 1e-60


def _forward(n: np.ndarray, cuts: list, chance: np.ndarray, longest: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all segmentations of each word's beginnings: (length + 1, words, languages), and the logarithm of each word's scale.

    With ``longest``, the letters of the longest piece, sums are scaled where they become tiny: those from the place reached on,
    beyond which no piece from before leads further than that.
    """
    alpha = np.zeros((int(n[0]) + 1, len(n), chance.shape[1]))
    alpha[0] = 1.0
    scale = np.zeros(len(n))
    at = 0
    for i, j, rows, piece in cuts:
        if longest and i >= at + _EVERY:
            at = i
            top = alpha[i].max(axis=1)
            low = np.flatnonzero((top < _TINY) & (top > 0) & (n > i))
            if len(low):
                alpha[i : i + longest + 1, low] /= top[low][:, None]
                scale[low] += np.log(top[low])
        alpha[j, rows] += alpha[i, rows] * chance[piece]
    return alpha, scale


def _alone(pieces: Pieces, chance: np.ndarray, word: str) -> np.ndarray:
    """The log probability of one very long word, letter by letter, with as many sums as the longest piece has letters."""
    codes = np.frombuffer((BEGIN + word).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
    reach = pieces.longest
    sums = np.zeros((reach + 1, chance.shape[1]))
    sums[0] = 1.0
    scale = 0.0
    for block in range(0, len(codes), 1 << 16):
        size = min(1 << 16, len(codes) - block)
        found = np.full((size, reach), -1, dtype=np.int64)
        live, h = np.arange(size), np.zeros(size, dtype=np.uint64)
        for k in range(reach):
            inside = block + live + k < len(codes)
            live, h = live[inside], h[inside]
            if not len(live):
                break
            h = h * np.uint64(_BASE) + codes[block + live + k]
            rows, piece = pieces.find(h)
            found[live[rows], k] = piece
            live, h = live[rows], h[rows]
        found[found[:, 0] < 0, 0] = pieces.count
        for own in found:
            k = np.flatnonzero(own >= 0)
            sums[k + 1] += sums[0] * chance[own[k]]
            sums[:-1] = sums[1:]
            sums[-1] = 0.0
            top = sums[0].max()
            if top < _TINY:
                sums /= top
                scale += np.log(top)
    with np.errstate(divide="ignore"):
        return np.log(sums[0]) + scale


def log_chances(pieces: Pieces, chance: np.ndarray, words: list[str]) -> np.ndarray:
    """The log probability of each word in each language."""
    out = np.zeros((len(words), chance.shape[1]))
    short = [k for k, w in enumerate(words) if len(w) <= TOGETHER]
    for own, n, cuts in pieces.lattice([words[k] for k in short]) if short else ():
        alpha, scale = _forward(n, cuts, chance, pieces.longest)
        with np.errstate(divide="ignore"):
            out[np.array(short)[own]] = np.log(alpha[n, np.arange(len(own))]) + scale[:, None]
    for k, word in enumerate(words):
        if len(word) > TOGETHER:
            out[k] = _alone(pieces, chance, word)
    return np.maximum(out, -1e300)


def expected(pieces: Pieces, chance: np.ndarray, words: list[str], weight: np.ndarray) -> np.ndarray:
    """How often each piece is expected in the words, by language; the last row is unknown letters."""
    out = np.zeros_like(chance)
    for own, n, cuts in pieces.lattice(words):
        alpha, _ = _forward(n, cuts, chance)
        beta = np.zeros_like(alpha)
        beta[n, np.arange(len(own))] = 1.0
        for i, j, rows, piece in reversed(cuts):
            beta[i, rows] += beta[j, rows] * chance[piece]
        scale = weight[own] / np.maximum(alpha[n, np.arange(len(own))], 1e-300)
        used = np.concatenate([piece for _, _, _, piece in cuts])
        share = np.concatenate([alpha[i, rows] * beta[j, rows] * chance[piece] * scale[rows] for i, j, rows, piece in cuts])
        for k in range(chance.shape[1]):
            out[:, k] += np.bincount(used, weights=share[:, k], minlength=len(out))
    return out


def _count(state: Broadcast, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Expected counts of the words of a task: one row per piece and language that has any."""
    pieces, chance = state.value
    total = np.zeros_like(chance)
    for batch in batches:
        words = batch.column("word").to_pylist()
        weight = np.zeros((len(words), size))
        weight[np.arange(len(words)), batch.column("lang").to_numpy(zero_copy_only=False)] = batch.column("n").to_numpy(zero_copy_only=False)
        total += expected(pieces, chance, words, weight)
    piece, lang = np.nonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(total[piece, lang])], ["piece", "lang", "n"])


class Model:
    """Languages, vocabulary, and each language's probability of each piece.

    Its size is that of the vocabulary times the number of languages, whatever the corpus.
    """

    def __init__(self, langs: list[str], pieces: Pieces, chance: np.ndarray):
        self.langs, self.pieces, self.chance = langs, pieces, chance


def fit(docs: DataFrame, vocabulary: list[str], sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id") -> Model:
    """Learn from the text and lang of at most about ``sample_docs`` documents of each language.

    Rows without a language, or without letters, teach nothing, nor do words of more than ``LEARNED`` letters. Counting words and summing
    up expected counts are Spark jobs; per language, only vocabulary-sized results return.
    """
    spark = docs.sparkSession
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.col(id_col).alias("key"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    pieces = Pieces(sorted({p.lower() for p in vocabulary if p}))
    chance = np.full((pieces.count + 1, len(langs)), 1.0 / (pieces.count + 1))
    if not langs:
        return Model([], pieces, chance)
    share = F.lit(0.0)
    number = F.lit(-1)
    for k, lang in enumerate(langs):
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_docs / sizes[lang]))).otherwise(share)
        number = F.when(F.col("lang") == lang, F.lit(k)).otherwise(number)
    chosen = rows.where(F.pmod(F.xxhash64("key", "text"), F.lit(1_000_000)) < share * 1_000_000)
    schema = "lang int, word string"
    words = chosen.select(number.cast("int").alias("lang"), "text").mapInArrow(_spell, schema)
    counted = words.groupBy("lang", "word").agg(F.count("*").alias("n")).persist()
    for _ in range(ROUNDS):
        state = spark.sparkContext.broadcast((pieces, chance))
        sums = counted.mapInArrow(partial(_count, state, len(langs)), "piece int, lang int, n double")
        table_ = sums.groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow()
        new = np.full_like(chance, SMOOTHING)
        new[table_.column("piece").to_numpy(), table_.column("lang").to_numpy()] += table_.column("n").to_numpy()
        chance = new / new.sum(axis=0)
    counted.unpersist()
    return Model(langs, pieces, chance)


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = [[w for w in words_of(t) if len(w) <= LEARNED] for t in part.column("text").to_pylist()]
            lang = np.repeat(part.column("lang").to_numpy(zero_copy_only=False), [len(w) for w in found])
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array([w for ws in found for w in ws], pa.string())], ["lang", "word"])


def _score(state: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    langs, pieces, chance = state.value
    place: dict[str, int] = {}
    known = np.zeros((0, len(langs)))
    for batch in batches:
        for part in slices(batch, batch.schema.names[-1], 2 << 20):
            if len(place) > MEMORY:
                place, known = {}, known[:0]
            found = [words_of(t or "") for t in part.column(part.num_columns - 1).to_pylist()]
            every = [w for words in found for w in words]
            index = np.array([place.get(w, -1) for w in every], dtype=np.int64)
            unknown = np.flatnonzero(index < 0).tolist()
            if unknown and langs:
                new = list({every[k] for k in unknown})
                place.update(zip(new, range(len(place), len(place) + len(new))))
                known = np.concatenate((known, log_chances(pieces, chance, new)))
                index[unknown] = [place[every[k]] for k in unknown]
            counts = np.array([len(words) for words in found], dtype=np.int64)
            has = (counts > 0) & bool(langs)
            best, score = [UNKNOWN] * len(found), np.zeros(len(found))
            if has.any():
                ends = np.cumsum(counts)
                total = np.add.reduceat(known[index], (ends - counts)[has], axis=0)
                top = total.argmax(axis=1)
                odds = np.exp(total - total.max(axis=1, keepdims=True))
                score[has] = 1.0 / odds.sum(axis=1)
                for k, t in zip(np.flatnonzero(has).tolist(), top.tolist()):
                    best[k] = langs[t]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(best, pa.string()), pa.array(score)], [*part.schema.names[:-1], "lang_pred", "score"])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``lang_pred`` and ``score`` (the share of the best language).

    A text that is null or has no letter gives ``und`` and 0, as does a model without
    languages. Among equal scores the first language by name wins. Nothing but the text is
    looked at; other columns, whatever their names, are left out.
    """
    state = docs.sparkSession.sparkContext.broadcast((model.langs, model.pieces, model.chance))
    pairs = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    schema = T.StructType([pairs.schema["key"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return pairs.mapInArrow(partial(_score, state), schema).withColumnRenamed("key", id_col)


def piece_vocabulary(path: str) -> list[str]:
    """The pieces of a public sentence-piece model file, without its control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return [model.id_to_piece(i) for i in kept]


def vocabulary_path() -> str:
    """The public piece vocabulary that is installed beside Python."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op5_language")
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = fit(docs.where(fold != 2), piece_vocabulary(vocabulary_path()))
    scored = predict(docs, model)
    return scored.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
