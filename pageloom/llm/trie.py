"""The prefix trie of conversations, and what its subtrees hold, by the Euler-tour technique.

Every distinct sequence of first turns is a node. Texts are hashed where they are read; what is
shuffled are names. A conversation's turns are put in order by a sort of the whole table by
ranges, so that a conversation of any length is spread over tasks, and the names of its
prefixes are made in chunks: a chunk's hash starts from that of all chunks before it, which is
made in the same way one level up.

The tour of the trie has two arcs for each node, in and out. Its successor function comes from
first children and next siblings; children of one node are kept in buckets, so no node has them
all in one task. Arcs that follow one another on the path of one conversation are one element
of the list that ``listrank`` ranks. Values at the arcs' places are summed up in blocks, and a
subtree's share is the difference between the sums at its two arcs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageloom.llm.listrank import places
from pageloom.llm.registry import query, table
from pageloom.session import written

#: Turns of a conversation, and depths of a path, that one task handles together.
CHUNK = 1_024
#: Buckets of the children of a node, ids that are joined to one string, and places whose values are summed up together.
BUCKETS, IDS, BLOCK = 1_024, 4_096, 65_536
#: The name of the root, which has no turn.
ROOT = bytes(16)


def _mark(role: Column, text: Column) -> Column:
    """16 bytes of the hash of a turn."""
    whole = F.concat_ws(":", F.length(role), F.concat(role, text))
    return F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 32))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each row how many turns of its conversation come before it in this task."""
    last, before = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv, copies = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("conv", "copies"))
        total = np.concatenate([[0], np.cumsum(copies)])
        first = np.concatenate([[True], conv[1:] != conv[:-1]])
        begin = np.flatnonzero(first)
        place = total[:-1] - np.repeat(total[begin], np.diff(np.append(begin, len(conv))))
        if conv[0] == last:
            place[: begin[1] if len(begin) > 1 else len(conv)] += before
        last, before = conv[-1], int(place[-1] + copies[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())], [*batch.schema.names, "place"])


def in_order(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, start, copies, mark, bytes): runs of equal turns at their places in each conversation, from 0.

    Turns go by ``turn_col``, null first, those with the same by the hash of role and text.
    A null role or text is empty; rows without a conversation take no part.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), _mark(role, text).alias("mark"), F.octet_length(text).cast("long").alias("bytes"))
    rows = written(rows.groupBy("conv", "turn", "mark", "bytes").agg(F.count("*").alias("copies")), "trie-turns")
    order = ["conv", F.asc_nulls_first("turn"), "mark"]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.spark_partition_id().cast("long").alias("part"), "conv", "mark", "bytes", "copies")
    placed = written(sorted_rows.mapInArrow(_counted, "part long, conv long, mark binary, bytes long, copies long, place long"), "trie-places")
    # a part's rows of a conversation come behind those of the parts before it
    ahead = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part", "conv").agg(F.sum("copies").alias("n")).withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    return placed.join(parts, ["part", "conv"]).select("conv", (F.col("place") + F.col("ahead")).alias("start"), "copies", "mark", "bytes")


def sizes(runs: DataFrame) -> DataFrame:
    """(conv, total) of every conversation."""
    return runs.groupBy("conv").agg(F.sum("copies").alias("total"))


# --- names of prefixes --------------------------------------------------------------------------------------------


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of one chunk of one conversation at a time."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[-1][:2] != row[:2]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _chunk_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hash of all turns of each chunk."""
    out = []
    for rows in _pieces(batches):
        held = hashlib.sha256()
        for _, _, _, copies, mark, *_ in rows:
            held.update(mark * copies)
        out.append((rows[0][0], rows[0][1], held.digest()[:16]))
        if len(out) >= 10_000:
            yield _table(out, ["conv", "start", "mark"])
            out = []
    if out:
        yield _table(out, ["conv", "start", "mark"])


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"mark": pa.binary(), "node": pa.binary(), "parent": pa.binary(), "last": pa.bool_()}
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, columns)], names)


_PREFIX = ["conv", "depth", "node", "parent", "bytes", "last"]
_PREFIX_SQL = "conv long, depth long, node binary, parent binary, bytes long, last boolean"


def _chains(level: int, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each prefix that ends in a chunk."""
    out: list[tuple] = []
    for rows in _pieces(batches):
        conv, chunk, _, _, _, _, total, seed, full = rows[0]
        held = hashlib.sha256(bytes([level]) + seed)
        depth, last = chunk * size, seed
        for _, _, _, copies, mark, weight, *_ in rows:
            for _ in range(copies):
                depth += 1
                held.update(mark)
                node = full if full is not None and depth == (chunk + 1) * size else held.digest()[:16]
                out.append((conv, depth, node, last, weight, depth == total))
                last = node
        if len(out) >= 10_000:
            yield _table(out, _PREFIX)
            out = []
    if out:
        yield _table(out, _PREFIX)


def prefixes(runs: DataFrame, longest: int, level: int = 0) -> DataFrame:
    """(conv, depth, node, parent, bytes, last) of every prefix with a turn: ``node`` names its sequence of turns.

    ``runs`` is (conv, start, copies, mark, bytes, total), and ``longest`` the greatest ``total``.
    """
    size = CHUNK
    chunks = F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("start") + F.col("copies") - 1) / size))).alias("chunk")
    low, high = F.col("chunk") * size, F.least(F.col("start") + F.col("copies"), (F.col("chunk") + 1) * size)
    pieces = runs.select("*", chunks).select(
        "conv", "chunk", F.greatest("start", low).alias("start"), (high - F.greatest("start", low)).alias("copies"), "mark", "bytes", "total")

    def together(rows: DataFrame) -> DataFrame:
        return rows.repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "start")

    if longest > size:
        sums = together(pieces).mapInArrow(_chunk_sums, "conv long, start long, mark binary")
        sums = sums.select("conv", "start", F.lit(1).cast("long").alias("copies"), "mark", F.lit(0).cast("long").alias("bytes"), F.lit(0).cast("long").alias("total"))
        above = prefixes(sums, -(-longest // size), level + 1)
        seeds = above.select("conv", (F.col("depth") - 1).alias("chunk"), F.col("parent").alias("seed"), F.col("node").alias("full"))
        pieces = pieces.join(seeds, ["conv", "chunk"])
    else:
        pieces = pieces.select("*", F.lit(ROOT).alias("seed"), F.lit(None).cast("binary").alias("full"))
    return together(pieces).mapInArrow(partial(_chains, level, size), _PREFIX_SQL)


# --- nodes --------------------------------------------------------------------------------------------------------


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of the comma-joined ids of each node, from its strings in order; nothing but the hash is held."""
    now, held = None, hashlib.sha256()
    for batch in batches:
        rows = []
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if node == now:
                held.update(b",")
            else:
                if now is not None:
                    rows.append((now, held.hexdigest()))
                now, held = node, hashlib.sha256()
            held.update(ids.encode())
        yield _ends(rows)
    if now is not None:
        yield _ends([(now, held.hexdigest())])


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], ["node", "ends_sha256"])


def ends(last: DataFrame) -> DataFrame:
    """(node, ends_sha256) from (node, conv) of the conversations that end at a node."""
    some = last.groupBy("node", F.floor(F.col("conv") / IDS).alias("part")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    some = some.select("node", "part", F.array_join(F.transform("ids", lambda c: c.cast("string")), ",").alias("ids"))
    return some.repartition("node").sortWithinPartitions("node", "part").mapInArrow(_end_hashes, "node binary, ends_sha256 string")


def _family(nodes: DataFrame) -> DataFrame:
    """``nodes`` (node, parent, conv, ...) with the parent's conversation, the first child's, the next sibling's, and the number of children.

    Children go by their conversation: as a node's is the least of its members, a child that has the same one is the first.
    """
    bucket = F.pmod(F.xxhash64("node"), F.lit(BUCKETS)).alias("bucket")
    kids = nodes.where("parent IS NOT NULL").select("node", "parent", "conv", bucket)
    full = kids.groupBy("parent", "bucket").agg(F.min("conv").alias("first"), F.count("*").alias("n"))
    by_first = Window.partitionBy("parent").orderBy("first")
    whole = Window.partitionBy("parent")
    full = full.select("parent", "bucket", F.lead("first").over(by_first).alias("next_first"), F.min("first").over(whole).alias("child"),
                       F.sum("n").over(whole).alias("n_children"), (F.row_number().over(by_first) == 1).alias("lead"))
    parents = full.where("lead").select(F.col("parent").alias("node"), "child", "n_children")
    above = full.select("parent", "bucket", "next_first").join(
        nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv")), "parent")
    following = F.lead("conv").over(Window.partitionBy("parent", "bucket").orderBy("conv"))
    kids = kids.withColumn("following", following).join(above, ["parent", "bucket"]).select(
        "node", "parent_conv", F.coalesce("following", "next_first").alias("next"))
    return nodes.join(parents, "node", "left").join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))


def _arcs(nodes: DataFrame) -> DataFrame:
    """Both arcs of each node: (c, x), x being twice the depth and 1 for the way out; the successor; the element of the list and the place in it.

    An arc is a head unless the one before it is known to be of the same conversation and chunk of depths.
    """
    chunk = F.floor(F.col("depth") / CHUNK)
    inner_head = ~(F.col("parent_conv").eqNullSafe(F.col("conv")) & (F.col("depth") % CHUNK != 0))
    only = (F.col("n_children") == 1) & (F.col("child") == F.col("conv")) & ((F.col("depth") + 1) % CHUNK != 0)
    outer_head = ~((F.col("n_children") == 0) | F.coalesce(only, F.lit(False)))
    into = F.struct(
        F.lit(0).alias("way"), F.col("depth").alias("at"), inner_head.alias("head"),
        F.coalesce("child", "conv").alias("sc"), F.when(F.col("child").isNull(), 2 * F.col("depth") + 1).otherwise(2 * F.col("depth") + 2).alias("sx"),
        (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    out = F.struct(
        F.lit(1).alias("way"), (-F.col("depth")).alias("at"), outer_head.alias("head"),
        F.coalesce("next", "parent_conv").alias("sc"),
        F.when(F.col("next").isNotNull(), 2 * F.col("depth")).when(F.col("parent_conv").isNotNull(), 2 * F.col("depth") - 1).alias("sx"),
        F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    arcs = nodes.select("conv", "depth", chunk.alias("chunk"), F.explode(F.array(into, out)).alias("a")).select("conv", "depth", "chunk", "a.*")
    order = Window.partitionBy("conv", "chunk").orderBy("way", "at")
    arcs = arcs.withColumn("nth", F.row_number().over(order))
    head = F.max(F.when(F.col("head"), F.col("nth"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    arcs = arcs.withColumn("begin", head)
    return arcs.select("conv", "depth", "chunk", "way", "begin", (F.col("nth") - F.col("begin")).cast("long").alias("offset"), "sc", "sx", "leaves", "saved",
                       (2 * F.col("depth") + F.col("way")).alias("x"))


def subtrees(nodes: DataFrame, small: int | None = None) -> DataFrame:
    """(conv, depth, n_leaves, saved_tokens): sums over the subtree of each node.

    ``nodes`` is (conv, depth, parent_conv, child, next, n_children, n_convs, bytes), one trie.
    """
    arcs = written(_arcs(nodes), "trie-arcs")
    # an element of the list is named by its first arc, and leads where its last arc leads
    elements = arcs.groupBy("conv", "chunk", "begin").agg(
        F.min_by("x", "offset").alias("x"), F.max_by("sc", "offset").alias("sc"), F.max_by("sx", "offset").alias("sx"), F.count("*").alias("size"))
    elements = written(elements.withColumnRenamed("conv", "c"), "trie-elements")
    ranked = places(elements.select("c", "x", "sc", "sx", "size"), "trie-list", small)
    ranked = elements.select("c", "x", "chunk", "begin").join(ranked, ["c", "x"]).select(F.col("c").alias("conv"), "chunk", "begin", "place")
    placed = arcs.join(ranked, ["conv", "chunk", "begin"]).select(
        "conv", "depth", "way", "leaves", "saved", (F.col("place") + F.col("offset")).alias("place"))
    block = Window.partitionBy("block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn("block", F.floor(F.col("place") / BLOCK)).select(
        "conv", "depth", "way", "block", *[F.sum(c).over(block).alias(c) for c in ("leaves", "saved")],
        F.col("leaves").alias("own_leaves"), F.col("saved").alias("own_saved"))
    summed = written(summed, "trie-sums")
    # one row for each block: as few as the arcs divided by its size
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = summed.groupBy("block").agg(F.max("leaves").alias("l"), F.max("saved").alias("s")).select(
        "block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("l", "s")])
    whole = summed.join(blocks, "block").select(
        "conv", "depth", "way", (F.col("leaves") + F.col("l_before")).alias("leaves"), (F.col("saved") + F.col("s_before")).alias("saved"), "own_leaves", "own_saved")

    def share(name: str, own: str) -> Column:
        signed = F.when(F.col("way") == 1, F.col(name)).otherwise(F.col(own) - F.col(name))
        return F.sum(signed)

    return whole.groupBy("conv", "depth").agg(share("leaves", "own_leaves").alias("n_leaves"), share("saved", "own_saved").alias("saved_tokens"))


def trie(runs: DataFrame, totals: DataFrame, small: int | None = None) -> DataFrame:
    """One row per node of the trie of all conversations, the root (depth 0) included.

    ``runs`` is (conv, start, copies, mark, bytes, total) as made by ``in_order`` or
    ``rebuilt``, ``totals`` has (conv, total) of every conversation, those without a turn
    included. Returns, all long: conv_id, the smallest member; depth; parent_conv_id, null at
    the root; n_convs; n_children; n_leaves and saved_tokens, summed over the subtree (leaves,
    and each node's members but one times the UTF-8 bytes of its last text); and ends_sha256,
    the hash of the comma-joined ids, ascending, of the members that end there. Sequences are
    told apart by 128 bits of SHA-256. No conversation at all gives no node.
    """
    facts = totals.agg(F.min("conv").alias("first"), F.count("*").alias("n"), F.max("total").alias("longest")).first()
    found = written(prefixes(runs, facts["longest"] or 0), "trie-prefixes")
    root = F.lit(ROOT)
    last = found.where("last").select("node", "conv").union(totals.where("total = 0").select(root.alias("node"), "conv"))
    nodes = found.groupBy("node", "parent").agg(
        F.min("conv").alias("conv"), F.max("depth").alias("depth"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"))
    top = totals.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        root.alias("node"), F.lit(None).cast("binary").alias("parent"), "conv", F.lit(0).cast("long").alias("depth"), "n_convs", F.lit(0).cast("long").alias("bytes"))
    nodes = written(nodes.union(top).join(ends(last), "node", "left"), "trie-nodes")
    nodes = written(_family(nodes).select(
        "conv", "depth", "parent_conv", "child", "next", "n_children", "n_convs", "bytes", "ends_sha256"), "trie-family")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(subtrees(nodes, small), ["conv", "depth"]).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"))


def rebuilt(runs: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Runs and totals of conversations that begin as the first of their group does.

    Conversation c takes the first h turns of c - c % group, all if there are fewer, and its
    own ones after its first h; h is the CRC-32 of the decimal c, modulo ``heads``.
    """
    runs = written(runs, "trie-runs")
    known = sizes(runs)
    base = (F.col("conv") - F.col("conv") % group).alias("base")
    own = known.select("conv", "total", base, (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).alias("h"))
    own = own.join(known.select(F.col("conv").alias("base"), F.col("total").alias("there")), "base", "left")
    lead = F.least("h", F.coalesce("there", F.lit(0)))
    own = written(own.select("conv", "base", "h", lead.alias("lead"), (lead + F.greatest(F.lit(0), F.col("total") - F.col("h"))).alias("total")), "trie-heads")
    # a conversation of very many turns makes its key a hot one: its side of the join can be split, the other has one row
    end = F.col("start") + F.col("copies")
    behind = runs.join(own, "conv").where(end > F.col("h")).select(
        "conv", (F.greatest("start", "h") - F.col("h") + F.col("lead")).alias("start"), (end - F.greatest("start", "h")).alias("copies"), "mark", "bytes", "total")
    first = runs.where(F.col("start") < heads).withColumnRenamed("conv", "base")
    ahead = first.join(own, "base").where(F.col("start") < F.col("h")).select(
        "conv", "start", (F.least(end, F.col("h")) - F.col("start")).alias("copies"), "mark", "bytes", "total")
    return behind.union(ahead), own.select("conv", "total")


def prefix_trie(turns: DataFrame, small: int | None = None) -> DataFrame:
    """The trie of a table of conversations (conv_id, turn, role, text) as they are; see ``trie``."""
    runs = written(in_order(turns), "trie-runs")
    totals = written(sizes(runs), "trie-totals")
    return trie(runs.join(totals, "conv"), totals, small)


ORACLE = """
    WITH m AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    o AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) - 1 AS pos, mark, bytes
        FROM (SELECT conv_id, turn, sha256(length(role) || ':' || role || text) AS mark, strlen(text) AS bytes FROM m)),
    c AS (
        SELECT conv_id, count(*) AS n, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
            string_split(conv_id::VARCHAR, ''), lambda d: [ascii(d)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
            lambda s, b: xor(xor(s, b) >> 1, (xor(s, b) & 1) * 3988292384::BIGINT)), 4294967295::BIGINT) % 9 AS h
        FROM o GROUP BY conv_id),
    r AS (
        SELECT c.conv_id, pos, mark, bytes FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 5 AND pos < h
        UNION ALL
        SELECT c.conv_id, least(c.h, coalesce(f.n, 0)) + pos - c.h, mark, bytes
        FROM c JOIN o USING (conv_id) LEFT JOIN c AS f ON f.conv_id = c.conv_id - c.conv_id % 5 WHERE pos >= c.h),
    e AS (
        SELECT conv_id, pos + 1 AS depth, string_agg(mark, '') OVER (PARTITION BY conv_id ORDER BY pos) AS path, bytes FROM r
        UNION ALL SELECT conv_id, 0, '', 0 FROM c),
    l AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM e),
    n AS (
        SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
        FROM l GROUP BY path, depth),
    k AS (
        SELECT n.*, p.conv_id AS parent_conv_id, count(d.path) AS n_children
        FROM n LEFT JOIN n AS p ON p.path = left(n.path, 64 * (n.depth - 1)) AND n.depth > 0 AND p.depth = n.depth - 1
            LEFT JOIN n AS d ON d.depth = n.depth + 1 AND left(d.path, 64 * n.depth) = n.path
        GROUP BY ALL),
    b AS (SELECT DISTINCT up.path AS path, down.path AS below FROM e AS up JOIN e AS down ON up.conv_id = down.conv_id AND up.depth <= down.depth)
    SELECT k.conv_id, k.depth, k.parent_conv_id, k.n_convs, k.n_children, count(*) FILTER (d.n_children = 0) AS n_leaves,
        sum((d.n_convs - 1) * d.bytes)::BIGINT AS saved_tokens, k.ends_sha256
    FROM k JOIN b USING (path) JOIN k AS d ON d.path = b.below GROUP BY ALL"""


@query("op11_prefix_trie", ORACLE)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of conversations that begin like the first of their five."""
    return trie(*rebuilt(in_order(table(spark, sf_dir, "conversations"))))
