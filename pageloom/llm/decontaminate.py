"""Benchmark decontamination: every passage of every text queries a BM25 index of test items.

Items are cut into parts, the index's documents. A passage is two neighbouring chunks of a
text's words, so that a part that stands in a text lies in one of them almost whole. All passages
of a batch walk the index together, as in block-max WAND: a part's terms of least impact cannot
bring a passage to its threshold by half, so a passage must earn the rest from the others. Their
postings lie in blocks with the largest impact of each term, and sums of these bound what a
passage can score in a block. Only the blocks whose bound reaches a threshold are scored, part
by part, with all distinct terms of the passage. No passage that reaches a part's threshold is
lost on the way. What is retrieved is verified against the words of question and answer, in the
passages that retrieved it and as many words around them as the item has.

The index is sent to the executors; a benchmark beyond ``SHARD_BYTES`` is cut into shards by a
hash of its items. The texts pass one shard after the other and are written in between, so that no
task holds two shards.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.registry import query, table
from pageloom.llm.words import SIGNS, slices, windows, words_of
from pageloom.session import written

#: Words of a part, and of a chunk; a passage is two chunks.
PART, CHUNK = 40, 32
#: BM25's two constants, and the share of the score a part gives itself that a passage must reach.
K1, B, REACH = 1.2, 0.75, 0.5
#: Parts of a block of the index, and the share of its threshold that a part's weakest terms may add up to.
BLOCK, WEAK = 8, 0.5
#: Words of a shingle for verifying, and the shares of question and answer that a text must hold. A question or answer with
#: fewer words than a shingle must stand next to the other half, so many words apart at most.
SHINGLE, QUESTION, ANSWER, APART = 3, 0.6, 0.6, 3
#: Entries of the index that are worked on at a time, for as many texts as they come from.
ENTRIES = 1 << 20
#: Bytes of benchmark text in one shard of the index.
SHARD_BYTES = 8 << 20

LEAKS = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()),
    T.StructField("question", T.DoubleType()), T.StructField("answer", T.DoubleType()),
]))
_LEAKS = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64())]))


def _words(texts: pa.Array):
    return words_of(pc.utf8_lower(texts), SIGNS)


def halves(text: str) -> tuple[str, str]:
    """Question and answer: what ends with the last question mark and what follows, else two halves of the words."""
    cut = text.rfind("?") + 1
    if cut and text[cut:].strip():
        return text[:cut], text[cut:]
    words = text.split()
    return " ".join(words[: len(words) // 2]), " ".join(words[len(words) // 2 :])


def _spread(first: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of the lists ``at``, and for each which of the lists it comes from."""
    counts = first[at + 1] - first[at]
    owner = np.repeat(np.arange(len(at)), counts)
    return np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first[at], counts), owner


class Index:
    """Postings of a shard's parts by term, with the largest impact of each term over all and in each block."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [i for i, _ in items]
        both = [halves(t) for _, t in items]
        self.checks = []
        for question, answer in both:
            grams, count = [], 0
            for half in (question, answer):
                w = _words(pa.array([half])).hashes
                size = min(SHINGLE, len(w))
                count += len(w)
                grams.append((np.unique(windows(w, size)) if size else np.zeros(0, np.uint64), size))
            self.checks.append((*grams, count))
        words = _words(pa.array([t for _, t in items], pa.string()))
        part_of, terms = [], []
        self.item = []
        for k in range(len(items)):
            own = words.hashes[words.first[k] : words.first[k + 1]]
            pieces = max(1, math.ceil(len(own) / PART)) if len(own) else 0
            for piece in np.array_split(own, pieces) if pieces else []:
                terms.append(piece)
                part_of.append(np.full(len(piece), len(self.item)))
                self.item.append(k)
        self.item = np.array(self.item, dtype=np.int64)
        parts = len(self.item)
        flat, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (terms, part_of))
        self.terms, term = np.unique(flat.astype(np.uint64), return_inverse=True)
        pair, tf = np.unique(term * max(1, parts) + owner, return_counts=True)
        term, part = pair // max(1, parts), pair % max(1, parts)
        length = np.bincount(owner.astype(np.int64), minlength=parts)
        df = np.bincount(term, minlength=len(self.terms))
        idf = np.log(1.0 + (parts - df + 0.5) / (df + 0.5))
        scale = K1 * (1.0 - B + B * length / max(1.0, length.mean() if parts else 1.0))
        self.impact = idf[term] * tf * (K1 + 1.0) / (tf + scale[part])
        self.part = part
        self.reach = REACH * np.bincount(part, weights=self.impact, minlength=parts)
        # the weakest terms of each part, as far as they stay below a share of its threshold
        order = np.lexsort((self.impact, part))
        total = np.cumsum(self.impact[order])
        begin = np.searchsorted(part[order], np.arange(parts))
        so_far = total - (total[begin] - self.impact[order][begin])[part[order]] if parts else total
        weak = np.zeros(len(part), dtype=bool)
        weak[order] = so_far <= WEAK * self.reach[part[order]]
        self.blocks = parts // BLOCK + 1
        need = self.reach - np.bincount(part[weak], weights=self.impact[weak], minlength=parts)
        self.block_need = np.array([need[k * BLOCK : (k + 1) * BLOCK].min(initial=np.inf) for k in range(self.blocks)])
        strong = np.flatnonzero(~weak)
        both_ = term[strong] * self.blocks + part[strong] // BLOCK
        edge = np.flatnonzero(np.diff(both_, prepend=-1))
        self.block = both_[edge] % self.blocks
        self.block_impact = np.maximum.reduceat(self.impact[strong], edge) if len(edge) else np.zeros(0)
        self.block_first = np.searchsorted(both_[edge] // self.blocks, np.arange(len(self.terms) + 1))
        # where the postings of a term in a block begin
        self.cell, begin = np.unique(term * self.blocks + part // BLOCK, return_index=True)
        self.cell_first = np.append(begin, len(part))

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """The term of each word, or -1."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def search(self, term: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All (row, part, score, first chunk) of a passage and a part whose threshold it reaches; rows' words begin at ``first``."""
        chunks = -(-np.diff(first) // CHUNK)
        chunk_first = np.concatenate(([0], np.cumsum(chunks)))
        known = np.flatnonzero(term >= 0)
        row = np.searchsorted(first, known, "right") - 1
        # the distinct terms of each chunk
        pair = np.unique((chunk_first[row] + (known - first[row]) // CHUNK) * max(1, len(self.terms)) + term[known])
        chunk, term = pair // max(1, len(self.terms)), pair % max(1, len(self.terms))
        ends = np.searchsorted(chunk, np.arange(chunk_first[-1] + 1))
        work = np.concatenate(([0], np.cumsum(self.block_first[term + 1] - self.block_first[term])))[ends] if len(pair) else np.zeros(len(ends), np.int64)
        out = []
        low = 0
        while low < chunk_first[-1]:
            high = max(low + 1, int(np.searchsorted(work, work[low] + ENTRIES, "right")) - 1)
            passage, block = self._open(low, high, chunk, term, ends, chunks, chunk_first)
            out += self._scored(passage, block, term, ends, chunk_first)
            low = high
        at, part, score = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        row = np.searchsorted(chunk_first, at, "right") - 1
        return row, part, score, at - chunk_first[row]

    def _open(self, low: int, high: int, chunk, term, ends, chunks, chunk_first) -> tuple[np.ndarray, np.ndarray]:
        """(passage, block) whose bound reaches a threshold, of the passages that begin in the chunks from ``low`` up to ``high``."""
        own = slice(ends[low], ends[min(high + 1, len(ends) - 1)])
        entry, source = _spread(self.block_first, term[own])
        key = chunk[own][source] * self.blocks + self.block[entry]
        order = np.argsort(key, kind="stable")
        key, gain = key[order], self.block_impact[entry][order]
        edge = np.flatnonzero(np.diff(key, prepend=-1))
        if not len(edge):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        key, gain = key[edge], np.add.reduceat(gain, edge)
        # the two passages that hold a chunk: it and the next one, it and the one before
        after = np.searchsorted(key, key + self.blocks)
        after = np.where(key[np.minimum(after, len(key) - 1)] == key + self.blocks, after, len(key))
        bound = gain + np.append(gain, 0.0)[after]
        before = np.zeros(len(key))
        before[after[after < len(key)]] = gain[after < len(key)]
        at, block = key // self.blocks, key % self.blocks
        row = np.searchsorted(chunk_first, at, "right") - 1
        single = at + 1 >= chunk_first[row + 1]
        here = (bound >= self.block_need[block] - 1e-9) & (~single | (chunks[row] == 1))
        there = (gain + before >= self.block_need[block] - 1e-9) & (at > chunk_first[row])
        open_ = np.unique(np.concatenate((key[here], key[there] - self.blocks)))
        passage = open_ // self.blocks
        inside = (passage >= low) & (passage < high)
        return passage[inside], open_[inside] % self.blocks

    def _scored(self, passage: np.ndarray, block: np.ndarray, term, ends, chunk_first) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(passage, part, score) of the parts in these blocks whose threshold the passage reaches."""
        row = np.searchsorted(chunk_first, passage, "right") - 1
        begin, stop = ends[passage], ends[np.minimum(passage + 2, chunk_first[row + 1])]
        total = np.concatenate(([0], np.cumsum(stop - begin)))
        out = []
        low = 0
        while low < len(passage):
            high = max(low + 1, int(np.searchsorted(total, total[low] + ENTRIES // BLOCK, "right")) - 1)
            size = stop[low:high] - begin[low:high]
            owner = np.repeat(np.arange(low, high), size)
            word = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin[low:high], size)
            cell = term[word] * self.blocks + block[owner]
            at = np.minimum(np.searchsorted(self.cell, cell), len(self.cell) - 1)
            hit = np.flatnonzero(self.cell[at] == cell)
            once = np.unique((owner[hit] - low) * len(self.cell) + at[hit])  # a term may stand in both chunks
            entry, source = _spread(self.cell_first, once % len(self.cell))
            slot = once[source] // len(self.cell) * BLOCK + self.part[entry] % BLOCK
            score = np.bincount(slot, weights=self.impact[entry], minlength=(high - low) * BLOCK)
            which = np.arange(low, high).repeat(BLOCK)
            part = block[which] * BLOCK + np.tile(np.arange(BLOCK), high - low)
            good = part < len(self.item)
            good[good] = (score[good] >= self.reach[part[good]] - 1e-9) & (score[good] > 0)
            out.append((passage[which[good]], part[good], score[good]))
            low = high
        return out


def _regions(at: np.ndarray, length: int, words: int) -> Iterator[tuple[int, int]]:
    """Stretches of a text of ``words`` words, round passages that begin in the chunks ``at``, for an item of so many words."""
    around = math.ceil(length / CHUNK) + 1
    low = None
    for c in at.tolist():
        if low is not None and c - high > 2 * around:
            yield max(0, (low - around) * CHUNK), min(words, (high + 2 + around) * CHUNK)
            low = None
        low, high = (c if low is None else low), c
    if low is not None:
        yield max(0, (low - around) * CHUNK), min(words, (high + 2 + around) * CHUNK)


def _shares(own: np.ndarray, question: tuple[np.ndarray, int], answer: tuple[np.ndarray, int], count: int, alone: bool) -> tuple[float, float]:
    """The shares of a question's and an answer's shingles in a stretch of words."""
    places, shares = [], []
    for grams, size in (question, answer):
        held = windows(own, size) if size else np.zeros(0, np.uint64)
        places.append(np.flatnonzero(np.isin(held, grams)))
        shares.append(float(np.isin(grams, held).mean()) if len(grams) else 1.0)
    if count < 2:  # a single word tells nothing unless the text is that word
        return (shares[0], shares[1]) if alone and len(own) == count else (0.0, 0.0)
    if min(question[1], answer[1]) < SHINGLE and question[1] and answer[1]:
        gap = places[1][None, :] - (places[0][:, None] + question[1])
        near = bool(((gap >= 0) & (gap <= APART)).any())
        shares = [x if near or size == SHINGLE else 0.0 for x, (_, size) in zip(shares, (question, answer))]
    return shares[0], shares[1]


def _leaks(index: Index, texts: pa.Array) -> dict[int, dict[int, tuple]]:
    """By row and item: the best score and the verified shares."""
    words = _words(texts)
    row, part, score, at = index.search(index.lookup(words.hashes), words.first)
    out: dict[int, dict[int, tuple]] = {}
    if not len(row):
        return out
    pair = row * len(index.items) + index.item[part]
    order = np.lexsort((at, pair))
    pair, score, at = pair[order], score[order], at[order]
    edges = np.flatnonzero(np.diff(pair, prepend=-1, append=-1))
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
        r, k = divmod(int(pair[low]), len(index.items))
        question, answer, count = index.checks[k]
        begin, stop = int(words.first[r]), int(words.first[r + 1])
        best = (0.0, 0.0)
        for a, b in _regions(at[low:high], count, stop - begin):
            found = _shares(words.hashes[begin + a : begin + b], question, answer, count, b - a == stop - begin)
            best = max(best, found, key=min)
        if best[0] >= QUESTION and best[1] >= ANSWER:
            out.setdefault(r, {})[index.items[k]] = (float(score[low:high].max()), *best)
    return out


def _search(shard: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = shard.value
    for batch in batches:
        for part in slices(batch, "text"):
            found = _leaks(index, part.column("text"))
            held = part.column(part.num_columns - 1)
            if found or held.null_count:
                lists = [x or [] for x in held.to_pylist()]
                for r, items in found.items():
                    lists[r] = lists[r] + [{"item_id": i, "score": v[0], "question": v[1], "answer": v[2]} for i, v in sorted(items.items())]
                held = pa.array(lists, _LEAKS)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], held], part.schema.names)


def search(docs: DataFrame, benchmark: DataFrame, into: str = "leaks") -> DataFrame:
    """``docs`` with a column ``into``: the test items that its ``text`` holds, by item id.

    ``benchmark`` has (item_id, text). A null or empty text has no leaks; a null or wordless
    item is found nowhere, one of a single word only where it is the whole text, and a repeated one is found once. Other columns stay; one that is
    called like ``into`` is replaced. An empty benchmark leaves every list empty.
    """
    spark = docs.sparkSession
    docs = docs.drop(into).withColumn(into, F.array().cast(LEAKS))
    items = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(size / SHARD_BYTES))
    for k in range(shards if size else 0):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == k).orderBy("item_id", "text").collect()
        index = spark.sparkContext.broadcast(Index([(r["item_id"], r["text"]) for r in rows]))
        docs = written(docs, "decontaminate-shard") if k else docs
        docs = docs.mapInArrow(partial(_search, index), docs.schema)
    return docs


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without leaks, with the columns they came with."""
    return search(docs, benchmark, "_found_items").where(F.size("_found_items") == 0).select(*docs.columns)


@query("op4_decontaminate")
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a test item that it holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = search(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
