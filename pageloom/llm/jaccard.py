"""N-gram Jaccard join by chosen paths.

Every text is the set of its five-word shingles, sketched by 64 min-hash values. A path through
a recursion tree is a sequence of sampled coordinates with the values found there: at each node
a hash of the path chooses two coordinates, and a set goes on along both, so that similar sets
share many paths and others soon part. Buckets with few sets are compared pair by pair on their
sketches. A large bucket is compared with a few of its own sets first; what those tie together,
and what is too far from the rest to be like any of it, is done, and the others are split on.
Independent runs repeat until the recall that is asked for; after the first run, buckets whose
sets are tied together already have nothing left to tell and are left out.

What is similar by sketch is then verified exactly: candidates fall into components, each one is
cut into blocks of bounded size, and every two blocks meet in one task that counts shared shingles
and returns the number of links and a spanning forest. Pairs are never rows. Equal sets are one
set with a count from the start, so copies cost nothing, however many there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm.graph import apart, components
from pageloom.llm.registry import query, table
from pageloom.llm.words import inner, mix, slices, windows, words_of
from pageloom.session import written

#: Words of a shingle, the similarity of a link, and the share of links to find at that very similarity.
SHINGLE, SIMILARITY, RECALL = 5, 0.8, 0.9999
#: Min-hash values of a sketch; pairs that agree on a smaller share of them are no candidates. At a
#: similarity of 0.8 this leaves out fewer than one pair in a million.
VALUES, ALIKE = 64, 0.5
#: Differing values that two similar sketches have at most, with the same small chance of error.
APART = int(VALUES * (1 - ALIKE))
#: Coordinates chosen at a node, the depth at which buckets are first counted, and the levels split at a time after it.
FANOUT, DEPTH, STEP = 2, 3, 2
#: Sets of a bucket that are compared pair by pair, and those a larger one is first compared with.
SMALL, PIVOTS = 2_000, 8
#: Sets and shingles of a block in the exact comparison.
BLOCK_SETS, BLOCK_SHINGLES = 512, 1_000_000

_FACTORS = mix(np.arange(1, VALUES + 1, dtype=np.uint64)) | np.uint64(1)


def runs_for(recall: float, similarity: float, depth: int = DEPTH) -> int:
    """Runs after which a pair of the given similarity has met with the given probability."""
    meets = 1.0
    for _ in range(depth):
        meets = 1.0 - (1.0 - similarity * meets) ** FANOUT
    return max(1, math.ceil(math.log(1.0 - recall) / math.log(max(1.0 - meets, 1e-300))))


def _shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, ordered by text and value, and where each text's begin.

    A text of fewer words than a shingle has one, all its words; a text without words has none.
    """
    words = words_of(texts)
    counts = np.diff(words.first)
    at, begin = inner(words.first, SHINGLE)
    values = windows(words.hashes, SHINGLE)[at]
    rows = np.repeat(np.arange(len(texts)), np.diff(begin))
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    whole = [int(windows(words.hashes[words.first[k] : words.first[k + 1]], int(counts[k]))[0]) for k in short.tolist()]
    values, rows = np.concatenate((values, np.array(whole, dtype=np.uint64))), np.concatenate((rows, short))
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows = values[new], rows[new]
    return values, np.searchsorted(rows, np.arange(len(texts) + 1))


def _name(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A hash of each set, whatever the order of its members; 0 for an empty one."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(values))))
    return np.where(np.diff(begin) > 0, mix(sums[begin[1:]] - sums[begin[:-1]] + np.diff(begin).astype(np.uint64)), np.uint64(0))


def _sketches(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The min-hash values of each set, which must not be empty."""
    out = np.empty((len(begin) - 1, VALUES), dtype=np.uint32)
    for k in range(VALUES):
        out[:, k] = np.minimum.reduceat((values * _FACTORS[k]) >> np.uint64(32), begin[:-1]) if len(out) else 0
    return out


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _rows_of(column: pa.Array, width: int, kind) -> np.ndarray:
    """A column of equally long binary values as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), width)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text_hash, set, size, sketch) of each row; set and sketch are null without words."""
    for batch in batches:
        for part in slices(batch, "text", 2 << 20):
            values, begin = _shingles(part.column("text"))
            size = np.diff(begin)
            full = size > 0
            sketch: list = [None] * len(size)
            for k, row in zip(np.flatnonzero(full).tolist(), _sketches(values, np.append(begin[:-1][full], len(values)))):
                sketch[k] = row.tobytes()
            names = pa.array(_name(values, begin).view(np.int64), mask=~full)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), part.column("text_hash"), names, pa.array(size.astype(np.int64)), pa.array(sketch, pa.binary())],
                ["doc", "text_hash", "set", "size", "sketch"])


def _extend(bucket: np.ndarray, sketch: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that many levels below, and for each the row of ``sketch`` it belongs to."""
    row = np.arange(len(bucket))
    for _ in range(levels):
        one = mix(bucket)
        first = (one % np.uint64(VALUES)).astype(np.int64)
        second = (first + 1 + ((one >> np.uint64(32)) % np.uint64(VALUES - 1)).astype(np.int64)) % VALUES
        children = [mix(bucket ^ mix((sketch[row, c].astype(np.uint64) << np.uint64(8)) + c.astype(np.uint64))) for c in (first, second)]
        bucket, row = np.concatenate(children), np.concatenate((row, row))
    return bucket, row


def _start(runs: range, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, set) for some runs, at the first depth."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sketch = _rows_of(batch.column("sketch"), VALUES, np.uint32)
        sets = batch.column("set").to_numpy(zero_copy_only=False)
        for run in runs:
            bucket, row = _extend(np.full(len(sets), run + 1, dtype=np.uint64), sketch, DEPTH)
            yield pa.RecordBatch.from_arrays([_signed(bucket), pa.array(sets[row])], ["bucket", "set"])


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sketch = _rows_of(batch.column("sketch"), VALUES, np.uint32)
        sets = batch.column("set").to_numpy(zero_copy_only=False)
        bucket, row = _extend(batch.column("bucket").to_numpy(zero_copy_only=False).view(np.uint64), sketch, STEP)
        yield pa.RecordBatch.from_arrays([_signed(bucket), pa.array(sets[row])], ["bucket", "set"])


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """The runs of equal keys in a sorted stream of batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for low, high in zip(cuts, cuts[1:]):
            part = batch.slice(low, high - low)
            if held and held[-1].column(key)[0].as_py() != int(keys[low]):
                yield _joined(held)
                held = []
            held.append(part)
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _forest(alike: np.ndarray) -> np.ndarray:
    """The least member of each one's component, for a symmetric matrix of ties."""
    label = np.arange(len(alike))
    tie = alike | np.eye(len(alike), dtype=bool)
    while True:
        new = np.where(tie, label[None, :], len(label)).min(axis=1)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _compare_small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ties between the sets of each small bucket, as a forest (a, b)."""
    a, b = [], []
    for group in groups(batches, "bucket"):
        sketch = _rows_of(group.column("sketch"), VALUES, np.uint32)
        sets = group.column("set").to_numpy(zero_copy_only=False)
        alike = np.zeros((len(sets), len(sets)), dtype=np.int16)
        for k in range(VALUES):
            alike += sketch[:, k, None] == sketch[None, :, k]
        root = _forest(alike >= ALIKE * VALUES)
        tied = np.flatnonzero(root != np.arange(len(sets)))
        a.append(sets[tied])
        b.append(sets[root[tied]])
        if len(a) >= 2_000:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])
            a, b = [], []
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])


def _compare_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, set, pivot, differ, tied) of every set of a large bucket: the pivots it is like, or all if it is like none."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sketch = _rows_of(batch.column("sketch"), VALUES, np.uint32)
        sets = batch.column("set").to_numpy(zero_copy_only=False)
        buckets = batch.column("bucket").to_numpy(zero_copy_only=False)
        order = np.argsort(buckets, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(buckets[order])) + 1).tolist(), len(order)]
        out = []
        for low, high in zip(cuts, cuts[1:]):
            rows = order[low:high]
            pivots = batch.column("pivots")[int(rows[0])].as_py()
            grid = np.frombuffer(b"".join(p["sketch"] for p in pivots), dtype=np.uint32).reshape(len(pivots), VALUES)
            differ = np.stack([(sketch[rows] != g).sum(axis=1) for g in grid], axis=1)
            tied = differ <= VALUES - ALIKE * VALUES
            r, p = np.nonzero(tied | ~tied.any(axis=1)[:, None])
            names = np.array([x["set"] for x in pivots], dtype=np.int64)
            out.append((buckets[rows[r]], sets[rows[r]], names[p], differ[r, p], tied[r, p]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["bucket", "set", "pivot", "differ", "tied"])


def _candidates(sketches: DataFrame, runs: range, roots: DataFrame | None) -> DataFrame:
    """Ties (a, b) between sets whose sketches are alike, from some runs.

    ``roots`` (set, root) tells what earlier runs have tied together.
    """
    rows = sketches.mapInArrow(partial(_start, runs), "bucket long, set long")
    if roots is not None:
        rows = rows.join(roots, "set", "left").select("bucket", "set", F.coalesce("root", "set").alias("root"))
    else:
        rows = rows.withColumn("root", F.col("set"))
    ties = []
    while True:
        rows = written(rows, "jaccard-paths")
        sizes = rows.groupBy(*apart("bucket")).agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).drop("apart")
        sizes = sizes.where("low < high").select("bucket", "n")
        small = rows.join(sizes.where(F.col("n") <= SMALL).select("bucket"), "bucket")
        members = small.groupBy("bucket").agg(F.array_sort(F.collect_set("set")).alias("members")).select("members").distinct()
        met = members.select(F.xxhash64("members").alias("bucket"), F.explode("members").alias("set")).join(sketches, "set")
        met = met.repartition("bucket").sortWithinPartitions("bucket")
        ties.append(written(met.mapInArrow(_compare_small, "a long, b long").distinct(), "jaccard-ties"))
        large = written(rows.join(sizes.where(F.col("n") > SMALL), "bucket"), "jaccard-large")
        if large.isEmpty():
            break
        # pivots are the sets with the least hashes among a sample of about four times as many
        order = F.xxhash64("bucket", "set")
        chosen = large.where(F.pmod(order, F.lit(1 << 30)) < F.lit(4.0 * PIVOTS * (1 << 30)) / F.col("n")).select("bucket", "set")
        first = large.groupBy("bucket").agg(F.min("set").alias("set"))
        chosen = chosen.union(first).distinct().join(sketches, "set")
        pivots = chosen.groupBy("bucket").agg(
            F.slice(F.sort_array(F.collect_list(F.struct(order.alias("h"), "set", "sketch"))), 1, PIVOTS).alias("pivots"))
        joined = large.select("bucket", "set").join(sketches, "set").join(pivots, "bucket").select("bucket", "set", "sketch", "pivots")
        near = written(joined.mapInArrow(_compare_pivots, "bucket long, set long, pivot long, differ long, tied boolean"), "jaccard-pivots")
        tied = near.where("tied")
        ties.append(tied.where("set <> pivot").select(F.col("set").alias("a"), F.col("pivot").alias("b")).distinct())
        # the tied part holds together if each pivot shares a set with the least one
        least = tied.groupBy(*apart("bucket")).agg(F.min("pivot").alias("least")).drop("apart")
        beside = tied.join(least, "bucket").groupBy("bucket", "set").agg(F.max(F.col("pivot") == F.col("least")).alias("least"), F.collect_set("pivot").alias("of"))
        reached = beside.select("bucket", "least", F.explode("of").alias("pivot")).groupBy("bucket", "pivot").agg(F.max("least").alias("least"))
        whole = reached.groupBy("bucket").agg(F.min("least").alias("whole")).where("whole").select("bucket")
        # in such a bucket a set is done if all that is not tied differs from one of its pivots by so much more than it does
        others = near.where("NOT tied").groupBy("bucket", "pivot").agg(F.min("differ").alias("nearest"))
        settled = tied.join(whole, "bucket").join(others, ["bucket", "pivot"], "left")
        settled = settled.where(F.col("nearest").isNull() | (F.col("nearest") - F.col("differ") > APART)).select("bucket", "set").distinct()
        going = large.select("bucket", "set", "root").join(settled, ["bucket", "set"], "left_anti").join(sketches, "set")
        rows = going.select("bucket", "set", "sketch").mapInArrow(_split, "bucket long, set long")
        rows = rows.join(large.select("set", "root").distinct(), "set").select("bucket", "set", "root")
    return reduce(DataFrame.union, ties)


def _tied(sets: DataFrame, runs: int) -> DataFrame:
    """(set, root) of all sets that are tied to others, over all runs."""
    sketches = sets.select("set", "sketch")
    first = components(_candidates(sketches, range(1, 2), None), "jaccard-first").select(F.col("node").alias("set"), "root")
    if runs == 1:
        return first
    first = written(first, "jaccard-roots")
    more = _candidates(sketches, range(2, runs + 1), first)
    known = first.where("set <> root").select(F.col("set").alias("a"), F.col("root").alias("b"))
    return components(more.union(known), "jaccard-candidates").select(F.col("node").alias("set"), "root")


def _sets_of_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of the sets that take part, once for every pair of blocks they belong to."""
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            values, begin = _shingles(part.column("text"))
            real = _name(values, begin).view(np.int64) == part.column("set").to_numpy(zero_copy_only=False)
            cols: dict[str, list] = {"key": [], "low": [], "high": [], "set": [], "copies": [], "block": [], "shingles": []}
            rows = part.select(["set", "root", "copies", "blocks", "block"]).to_pylist()
            for k in np.flatnonzero(real).tolist():
                r = rows[k]
                data = values[begin[k] : begin[k + 1]].tobytes()
                for other in range(r["blocks"]):
                    low, high = sorted((r["block"], other))
                    key = int(mix(np.array([(r["root"] & 0xFFFFFFFFFFFFFFFF) ^ (low << 40) ^ (high << 20)], dtype=np.uint64)).view(np.int64)[0])
                    for c, v in zip(cols, (key, low, high, r["set"], r["copies"], r["block"], data)):
                        cols[c].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[c], pa.int64()) for c in list(cols)[:-1]] + [pa.array(cols["shingles"], pa.binary())], list(cols))


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many members every two sets share, by products of 0/1 matrices over a few members at a time."""
    sizes = np.array([len(s) for s in sets])
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    often = np.bincount(column) > 1  # what one set alone has is shared with none
    column, row = (np.cumsum(often) - 1)[column[often[column]]], row[often[column]]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = 4096
    for low in range(0, int(often.sum()), width):
        at, stop = np.searchsorted(column, (low, low + width))
        grid = np.zeros((len(sets), min(width, int(often.sum()) - low)), dtype=np.float32)
        grid[row[at:stop], column[at:stop] - low] = 1.0
        out += grid @ grid.T
    return out


def _verify(similarity: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(set, links, root) of each pair of blocks: the copies it is linked with, and its tie in a forest."""
    sets_out, links_out, roots_out = [], [], []
    for group in groups(batches, "key"):
        sets = [np.frombuffer(v, dtype=np.uint64) for v in group.column("shingles").to_pylist()]
        names, copies = (group.column(c).to_numpy(zero_copy_only=False) for c in ("set", "copies"))
        if len(once := np.unique(names, return_index=True)[1]) < len(names):  # rows that repeat an id and a text
            sets, names, copies, group = [sets[k] for k in once.tolist()], names[once], copies[once], group.take(pa.array(once))
        block = group.column("block").to_numpy(zero_copy_only=False)
        shared = _shared(sets)
        size = np.array([len(s) for s in sets], dtype=np.float64)
        linked = shared >= similarity * (size[:, None] + size[None, :] - shared) - 1e-6
        np.fill_diagonal(linked, False)
        if group.column("low")[0].as_py() != group.column("high")[0].as_py():
            linked &= block[:, None] != block[None, :]
        links = linked @ copies.astype(np.int64)
        some = np.flatnonzero(links)
        if len(some):
            root = _forest(linked)
            sets_out.append(names[some])
            links_out.append(links[some])
            roots_out.append(names[root[some]])
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (sets_out, links_out, roots_out)], ["set", "links", "root"])


def _decided(texts: DataFrame, similarity: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """(doc, text_hash, set, …) of each row with an id, and (set, doc, root, class_id, n_links) of each set; ``doc`` is its least id."""
    if not 0.75 <= similarity <= 1.0:
        raise ValueError("sketches tell candidates apart for similarities from 0.75 on")
    marks = texts.where("doc IS NOT NULL").select("doc", F.xxhash64("text").alias("text_hash"), "text")
    marks = written(marks.mapInArrow(_mark, "doc long, text_hash long, set long, size long, sketch binary"), "jaccard-marks")
    sets = marks.where("set IS NOT NULL").groupBy("set").agg(
        F.min("doc").alias("doc"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("sketch").alias("sketch"))
    sets = written(sets, "jaccard-sets")
    members = _tied(sets, runs_for(recall, similarity)).join(sets.select("set", "doc", "copies", "size"), "set")
    extent = members.groupBy(*apart("root")).agg(F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).alias("blocks")).drop("apart")
    members = members.join(extent, "root").withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")))
    with_text = texts.join(members.select("doc", "set", "root", "copies", "blocks", "block").distinct(), "doc")
    spelled = with_text.select("text", "set", "root", "copies", "blocks", "block").mapInArrow(
        _sets_of_members, "key long, low long, high long, set long, copies long, block long, shingles binary")
    verified = spelled.repartition("key").sortWithinPartitions("key").mapInArrow(partial(_verify, similarity), "set long, links long, root long")
    verified = written(verified, "jaccard-verified")
    links = verified.groupBy("set").agg(F.sum("links").alias("links"))
    forest = verified.where("set <> root").select(F.col("set").alias("a"), F.col("root").alias("b"))
    classes = components(forest, "jaccard-classes").select(F.col("node").alias("set"), "root")
    owner = sets.select("set", "doc", "copies").join(classes, "set", "left").withColumn("root", F.coalesce("root", "set"))
    named = owner.join(owner.groupBy(*apart("root")).agg(F.min("doc").alias("class_id")).drop("apart"), "root").join(links, "set", "left")
    decided = named.select("set", "doc", "root", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return marks, written(decided, "jaccard-decided")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``class_id`` and ``n_links``.

    Two rows are linked if the Jaccard similarity of their shingles is ``similarity`` or
    more; a class is what links tie together, named by its least id, and ``n_links``
    counts a row's links to other rows, copies included. Texts without words (null, empty,
    blank) are linked with nothing and are classes of their own. Rows that repeat an id count
    as rows. A row without an id takes no part: no class, no links. ``recall`` is the
    chance that a link of exactly that similarity is found; others are found more often.
    Other columns, whatever their names, are left out.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    marks, decided = _decided(texts, similarity, recall)
    out = marks.select("doc", "set").join(decided.drop("doc", "root"), "set", "left").select(
        "doc", F.coalesce("class_id", "doc").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    lost = texts.where("doc IS NULL").select("doc", F.lit(None).cast("long"), F.lit(0).cast("long"))
    return out.union(lost).withColumnRenamed("doc", id_col)


def without_copies(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` (``doc_id``, ``text``, any others), of each class one: that of its least id.

    If that id stands for several texts of the class, one of them stays; its texts of other classes are
    decided on by themselves. Rows that repeat an id and a text are one. Rows without an id or without words all stay, but
    for repeated ones of an id.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    marks, decided = _decided(texts, similarity, recall)
    keepers = decided.where("doc = class_id").groupBy(*apart("root")).agg(F.min("set").alias("keeper")).drop("apart")
    gone = decided.join(keepers, "root").select("set", "class_id", "keeper")
    gone = marks.where("set IS NOT NULL").select("doc", "text_hash", "set").join(gone, "set").where("doc <> class_id OR set <> keeper")
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("held")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("text_hash"), held)
    rows = rows.join(gone.select("doc", "text_hash").distinct(), ["doc", "text_hash"], "left_anti")
    once = rows.where("doc IS NOT NULL").dropDuplicates(["doc", "text_hash"])
    return once.unionByName(rows.where("doc IS NULL")).select("held.*")


@query("op1_ngram_jaccard")
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near copies and its number of links."""
    return near_duplicates(table(spark, sf_dir, "documents"))
