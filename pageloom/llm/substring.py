"""Removal of long spans that repeat across documents, over a De Bruijn graph of words.

Every 13 consecutive words are an edge of the graph. Consecutive edges of a document that
share their least four-word hash form one path; as that hash depends on the edge alone, equal
edges lie in paths of one name wherever they stand, and a sixth of the rows names them all.

* A name that one document alone has is dropped: nothing of it repeats.
* A name whose path reads the same everywhere does not branch: it is one compacted path, and
  the first document that has it decides for all its edges at once.
* The other names branch. Only their edges are spelled out, and joined one by one.

Names are 64-bit hashes that only bring together what may be equal. Whether it is, is told by 128
bits of SHA-256 of the words themselves, read at the source coordinates of every path and every branching
edge: of the first document that has it and of all others, in one aggregate.

The decided names are written to the shared folder, as three later steps read them; the documents'
own words at their own places give the spans and the text that is kept. Aggregates combine
before they are shuffled, and the joins that spread decisions have plain exchanges on both sides,
so that adaptive execution can split the rows of a passage that very many documents share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm.graph import apart
from pageloom.llm.registry import query, table
from pageloom.llm.words import Words, inner, mix, slices, windows, words_of
from pageloom.session import written

#: Words of a window, and of the hashes whose least one names a path.
WINDOW, NAME = 13, 4


class _Edges:
    """Windows of a column of texts: where each begins, its name, and its row."""

    def __init__(self, texts: pa.Array, window: int):
        self.words: Words = words_of(texts)
        self.window = window
        self.at, begin = inner(self.words.first, window)
        self.row = np.repeat(np.arange(len(texts)), np.diff(begin))
        names = windows(self.words.hashes, min(NAME, window))
        span = window - min(NAME, window) + 1
        least = names[: max(0, len(names) - span + 1)].copy()
        for k in range(1, span):
            np.minimum(least, names[k : k + len(least)], out=least)
        self.name = least[self.at]

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """The first window of each path, and the digests of the words of the path."""
        if not len(self.at):
            return np.zeros(0, np.int64), np.zeros((0, 2), np.int64)
        new = np.concatenate(([True], (self.name[1:] != self.name[:-1]) | (self.row[1:] != self.row[:-1])))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(self.at)) - 1
        return first, self._digests(self.at[first], self.at[last] + self.window)

    def digests(self, chosen: np.ndarray) -> np.ndarray:
        """The digests of the words of some windows."""
        return self._digests(self.at[chosen], self.at[chosen] + self.window)

    def _digests(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Two numbers of SHA-256 of the words from ``low`` up to ``high``, each word with a blank behind it."""
        data, ends = _joined(self.words)
        view = memoryview(data)
        sha = hashlib.sha256
        found = b"".join([sha(view[a:b]).digest()[:16] for a, b in zip(ends[low].tolist(), ends[high].tolist())])
        return np.frombuffer(found, dtype="<i8").reshape(-1, 2)


def _joined(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words, each with a blank behind it, and where each word begins in them."""
    sizes = words.ends - words.starts + 1
    ends = np.concatenate(([0], np.cumsum(sizes)))
    source = np.arange(ends[-1]) + np.repeat(words.starts - ends[:-1], sizes)
    data = words.data[np.minimum(source, max(0, len(words.data) - 1))] if len(source) else np.zeros(0, np.uint8)
    data[ends[1:] - 1] = 32
    return data, ends


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _name_paths(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, p1, p2, doc) of every path, once for each document."""
    for batch in batches:
        for part in slices(batch, "text"):
            edges = _Edges(part.column("text"), window)
            first, path = edges.paths()
            doc = part.column("doc").to_numpy(zero_copy_only=False).astype(np.int64)[edges.row[first]]
            name = edges.name[first]
            _, keep = np.unique(mix(name ^ mix(path[:, 0].view(np.uint64) ^ mix(doc.view(np.uint64)))), return_index=True)
            yield pa.RecordBatch.from_arrays(
                [_signed(name[keep]), pa.array(path[keep, 0]), pa.array(path[keep, 1]), pa.array(doc[keep])], ["name", "p1", "p2", "doc"])


def _listed(column: pa.Array, salt: np.ndarray) -> np.ndarray:
    """The values of a column of lists, each mixed with the salt of its row."""
    column = pa.concat_arrays([column])
    sizes = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return values ^ np.repeat(salt, sizes)


def _within(row: np.ndarray, values: np.ndarray, column: pa.Array) -> np.ndarray:
    """Whether each window's value is in the list of its row."""
    salt = mix(np.arange(1, len(column) + 1, dtype=np.uint64))
    return np.isin(values ^ salt[row], _listed(column, salt))


def _spell(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(e1, e2, doc) of every window whose name branches, once for each document."""
    for batch in batches:
        for part in slices(batch.filter(batch.column("branching").is_valid()), "text"):
            edges = _Edges(part.column("text"), window)
            chosen = np.flatnonzero(_within(edges.row, edges.name, part.column("branching")))
            doc = part.column("doc").to_numpy(zero_copy_only=False).astype(np.int64)[edges.row[chosen]]
            edge = edges.digests(chosen)
            _, keep = np.unique(mix(edge[:, 0].view(np.uint64) ^ mix(doc.view(np.uint64))), return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(edge[keep, 0]), pa.array(edge[keep, 1]), pa.array(doc[keep])], ["e1", "e2", "doc"])


def _kept_text(words: Words, keep: np.ndarray) -> pa.Array:
    """For each text its kept words, joined by one blank."""
    chosen = np.flatnonzero(keep)
    rows = len(words.first) - 1
    count = np.concatenate(([0], np.cumsum(keep)))[words.first]
    starts, sizes = words.starts[chosen], words.ends[chosen] - words.starts[chosen] + 1
    last = count[1:][count[1:] > count[:-1]] - 1
    sizes[last] -= 1  # no blank behind the last word of a text
    ends = np.concatenate(([0], np.cumsum(sizes)))
    source = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)
    data = words.data[np.minimum(source, max(0, len(words.data) - 1))] if len(source) else np.zeros(0, np.uint8)
    blanks = np.ones(len(chosen), dtype=bool)
    blanks[last] = False
    data[ends[1:][blanks] - 1] = 32
    offsets = ends[count].astype(np.int32)
    return pa.StringArray.from_buffers(rows, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes()))


def _remove(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            edges = _Edges(part.column("text"), window)
            gone = _within(edges.row, edges.name, part.column("simple"))
            spelled = np.flatnonzero(_within(edges.row, edges.name, part.column("branching")))
            if len(spelled):
                gone[spelled] |= _within(edges.row[spelled], edges.digests(spelled)[:, 0].view(np.uint64), part.column("edges"))
            words = edges.words
            cover = np.zeros(len(words.hashes) + 1, dtype=np.int64)
            cover[edges.at[gone]] += 1
            np.subtract.at(cover, edges.at[gone] + window, 1)
            removed = np.cumsum(cover[:-1]) > 0
            total = np.concatenate(([0], np.cumsum(removed)))[words.first]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), pa.array(np.diff(words.first)), pa.array(np.diff(total)), _kept_text(words, ~removed)],
                ["doc", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words``, ``n_removed`` and ``kept``.

    A word goes if it lies in ``window`` consecutive words that also start in a document
    with a smaller id; windows are those of the input. ``kept`` joins the other words by one
    blank. Null and empty texts, and texts shorter than the window, lose nothing. Rows that
    repeat an id are not compared with each other, as neither is smaller. A row without an
    id loses nothing and removes nothing. Other columns, whatever their names, are left out.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    paths = texts.where(F.col("doc").isNotNull()).mapInArrow(partial(_name_paths, window), "name long, p1 long, p2 long, doc long")
    same = (F.min("p1") == F.max("p1")) & (F.min("p2") == F.max("p2"))
    names = paths.groupBy(*apart("name")).agg(F.min("doc").alias("first"), F.max("doc").alias("last"), same.alias("same"))
    names = names.where("first < last").select("name", "first", (~F.col("same")).alias("branches"))
    met = paths.select("name", "doc").join(names, "name").where(F.col("branches") | (F.col("doc") > F.col("first")))
    decided = written(met.groupBy("doc").agg(
        F.collect_set(F.when(~F.col("branches"), F.col("name"))).alias("simple"),
        F.collect_set(F.when(F.col("branches"), F.col("name"))).alias("branching")), "substring-names")
    spelled = texts.join(decided.where(F.size("branching") > 0).select("doc", "branching"), "doc", "left")
    edges = spelled.mapInArrow(partial(_spell, window), "e1 long, e2 long, doc long")
    firsts = edges.groupBy("e1", "e2", (F.col("e1") % 16).alias("apart")).agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    firsts = firsts.where("first < last").select("e1", "e2", "first")
    later = edges.join(firsts, ["e1", "e2"]).where("doc > first").groupBy("doc").agg(F.collect_set("e1").alias("edges"))
    # what branches matters only where an edge of it goes
    known = decided.select("doc", "simple", "branching").join(later, "doc", "full").withColumn("branching", F.when(F.col("edges").isNotNull(), F.col("branching")))
    out = texts.join(known, "doc", "left").mapInArrow(partial(_remove, window), "doc long, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("doc", id_col)


@query("op7_substrings")
def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the spans that a document before it has."""
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
