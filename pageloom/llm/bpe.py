"""Byte-pair encoding with word ends, and decoding: propose, check, and merge only where the check fails.

Greedy longest matches propose the tokens of a word. A proposal is the encoding exactly if
every token is one that merging can reach and every two neighbours are compatible: no merge
across their border takes its turn before the merges that build them. That check walks back
through the merges of both neighbours, for all pairs of a batch at once, in numpy. Words that
fail it are merged one pair after the other.

Decoding follows the tokenizer file, which names no decoder: token strings joined by blanks.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.registry import query, table
from pageloom.llm.words import slices

#: Pieces of text between white space whose encoding a task remembers; beyond that it forgets all and goes on.
MEMORY = 400_000

#: What the tokenizer library does not know yet of the character tables that Python's modules have. Letters and
#: numbers that are signs to it, and marks that it neither sorts nor joins with others; ranges of code points.
LATER_LETTERS = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a "
    "11db0-11ddb 11df1 16ea0-16eb8 16ebb-16ed3 16ff2-16ff3 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 "
    "1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e "
    "2cea2-2cead 323b0-33479 3d000-3fc3f")
LATER_NUMBERS = "11de0-11de9 1246f 12475-1247f 12550-12686 16ff4-16ff6"
LATER_MARKS = (
    "7fd 898-89f 8ca-8d3 9fe c3c d3b-d3c eba 1715 1abf-1ace 1df6-1dfa a82c 10d24-10d27 10eab-10eac 10efd-10eff 10f46-10f50 10f82-10f85 11070 1133b "
    "1145e 11839-1183a 11930 1193d-1193e 11943 119e0 11a34 11a47 11a99 11d42 11d44-11d45 11d97 11f41-11f42 16ff0-16ff1 1e08f 1e130-1e136 1e2ae "
    "1e2ec-1e2ef 1e4ec-1e4ef")
#: Capitals that the library knows and Python's tables do not, each with its distance to the small letter.
LATER_CAPITALS = {0x1C89: 1, 0xA7CB: 0x264 - 0xA7CB, 0xA7DC: 0x19B - 0xA7DC, **dict.fromkeys((0xA7CC, 0xA7CE, 0xA7D2, 0xA7D4, 0xA7DA), 1),
                  **dict.fromkeys(range(0x10D50, 0x10D66), 0x20), **dict.fromkeys(range(0x16EA0, 0x16EB9), 0x1B)}


def _ranges(text: str) -> str:
    """Ranges of code points as a pattern has them."""
    return "".join("-".join(f"\\U{int(end, 16):08x}" for end in part.split("-")) for part in text.split())


_LETTER, _NUMBER = rf"[\p{{L}}--[{_ranges(LATER_LETTERS)}]]", rf"[\p{{N}}--[{_ranges(LATER_NUMBERS)}]]"
#: The word pattern, the end-of-word mark and the byte alphabet of the tokenizer format.
PATTERN = rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|{_LETTER}+|{_NUMBER}|[^\s{_LETTER}{_NUMBER}]+"
WORD_END = "</w>"
#: The end of a word among its bytes, the rank of a pair that never merges, and the bytes up to which words are done in rows.
END, NEVER, WIDE = 256, np.iinfo(np.int64).max, 128
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on, in order."""
    letters = {b: chr(b) for b in _PRINTED}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(_PRINTED)))
    return [letters[b] for b in range(256)]


class Table:
    """A map from pairs of small integers to integers, looked up for whole arrays by hashing."""

    def __init__(self, a: np.ndarray, b: np.ndarray, values: np.ndarray):
        self.bits = max(8, int(len(a) * 4 - 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, -1, dtype=np.int64)
        code = (a.astype(np.int64) << 32) | b
        slot = self._slot(code)
        left = np.arange(len(code))
        while len(left):
            at = slot[left]
            free = self.keys[at] == -1
            self.keys[at[free]] = code[left[free]]  # of several for one place the last one stays
            won = self.keys[at] == code[left]
            self.values[at[won]] = values[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, code: np.ndarray) -> np.ndarray:
        return ((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The value of each pair, -1 where there is none."""
        code = (a.astype(np.int64) << 32) | b
        slot = self._slot(code)
        out = np.where(self.keys[slot] == code, self.values[slot], -1)
        live = np.flatnonzero((self.keys[slot] != code) & (self.keys[slot] != -1))
        while len(live):
            slot[live] = (slot[live] + 1) & ((1 << self.bits) - 1)
            key = self.keys[slot[live]]
            hit = key == code[live]
            out[live[hit]] = self.values[slot[live[hit]]]
            live = live[~hit & (key != -1)]
        return out


class Merges:
    """A tokenizer file's vocabulary and merges, as tables for proposing, checking and merging."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        self.strings = [""] * size
        for s, i in [*self.vocab.items(), *self.special.items()]:
            self.strings[i] = s
        self.rank = np.full(size, -1, dtype=np.int64)
        self.left = np.full(size, -1, dtype=np.int64)
        self.right = np.full(size, -1, dtype=np.int64)
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for k, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            i, j, made = self.vocab[a], self.vocab[b], self.vocab[a + b]
            if (i, j) not in self.pairs:
                self.pairs[i, j] = (k, made)
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = k, i, j
        one, two = np.array([*self.pairs], dtype=np.int64).reshape(-1, 2).T
        self.ranked = Table(one, two, np.array([r for r, _ in self.pairs.values()], dtype=np.int64))
        self.made = np.array([m for _, m in self.pairs.values()], dtype=np.int64)
        self.size = size
        self.longest = max(map(len, self.vocab)) if self.vocab else 1
        self._grow()
        self.reached = self._reached()

    def _grow(self) -> None:
        """The tree of all tokens over bytes, with ``END`` for the word's end, as a table of steps."""
        self.letters = _alphabet()
        byte = {c: b for b, c in enumerate(self.letters)}
        nodes: dict[tuple[int, int], int] = {}
        token = {}
        for s, i in self.vocab.items():
            ended = s.endswith(WORD_END) and s != WORD_END
            at = 0
            for symbol in [byte[c] for c in (s[: -len(WORD_END)] if ended else s)] + [END] * ended:
                at = nodes.setdefault((at, symbol), len(nodes) + 1)
            token[at] = i
        one, two = np.array([*nodes], dtype=np.int64).reshape(-1, 2).T
        self.steps = Table(one, two, np.array([*nodes.values()], dtype=np.int64))
        self.token_at = np.full(len(nodes) + 1, -1, dtype=np.int64)
        self.token_at[[*token]] = [*token.values()]
        self.inner = np.array([self.vocab.get(c, -1) for c in self.letters])
        self.final = np.array([self.vocab.get(c + WORD_END, -1) for c in self.letters])

    def _reached(self) -> np.ndarray:
        """Which tokens merging makes out of their own characters."""
        made = np.flatnonzero(self.rank >= 0)
        good = np.zeros(self.size, dtype=bool)
        good[[i for i in self.vocab.values() if self.rank[i] < 0]] = True
        fits = dict(zip(made.tolist(), self._compatible(self.left[made], self.right[made], self.rank[made]).tolist()))
        for t in made[np.argsort(self.rank[made])].tolist():
            good[t] = fits[t] and good[self.left[t]] and good[self.right[t]]
        return good

    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        rank = self.ranked.find(a, b)
        return np.where(rank < 0, NEVER, rank)

    def _compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether each pair of tokens stays apart while both are built.

        Going back in time, the later of the two merges is undone, which bares an inner
        token at the border. A merge of the bared pair comes first if its rank is less than
        that of the merge undone, or equal where the right token was taken apart, as equal
        ranks are merged from the left.
        """
        a, b = a.copy(), b.copy()
        good = self._pair_rank(a, b) >= (NEVER if before is None else before)
        live = np.flatnonzero(good)
        while len(live):
            x, y = a[live], b[live]
            undo_left = self.rank[x] > self.rank[y]
            at = np.where(undo_left, self.rank[x], self.rank[y])
            going = at >= 0
            live, x, y, undo_left, at = live[going], x[going], y[going], undo_left[going], at[going]
            if not len(live):
                break
            x = np.where(undo_left, self.right[x], x)
            y = np.where(undo_left, y, self.left[y])
            crossing = self._pair_rank(x, y)
            early = np.where(undo_left, crossing < at, crossing <= at)
            good[live[early]] = False
            a[live], b[live] = x, y
            live = live[~early]
        return good

    def proposed(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Greedy longest matches of each row of symbols, -1 behind the last token.

        A row holds a word's bytes, then ``END``. No token may leave the end mark alone.
        """
        count = len(lengths)
        out = np.full(symbols.shape, -1, dtype=np.int64)
        used = np.zeros(count, dtype=np.int64)
        row = np.arange(count)
        at, node = np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int64)
        best, best_end = np.full(count, -1, dtype=np.int64), np.zeros(count, dtype=np.int64)
        while len(row):
            inside = at <= lengths[row]
            ahead = np.full(len(row), -1, dtype=np.int64)
            ahead[inside] = self.steps.find(node[inside], symbols[row[inside], at[inside]])
            going = ahead >= 0
            node = np.where(going, ahead, 0)
            at += going
            token = self.token_at[node]
            good = going & (token >= 0) & (at != lengths[row])
            best, best_end = np.where(good, token, best), np.where(good, at, best_end)
            stop = np.flatnonzero(~going)
            rows = row[stop]
            out[rows, used[rows]] = best[stop]
            used[rows] += 1
            at[stop] = best_end[stop]
            over = np.zeros(len(row), dtype=bool)
            over[stop] = (best[stop] < 0) | (best_end[stop] > lengths[rows])
            best[stop] = -1
            keep = ~over
            row, at, node, best, best_end = row[keep], at[keep], node[keep], best[keep], best_end[keep]
        return out

    def merged_rows(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The exact merging of each row, one merge of every row at a time."""
        count, width = len(lengths), symbols.shape[1] - 1
        place = np.arange(width)
        ids = np.where(place < lengths[:, None], self.inner[symbols[:, :width] & 255], -1)
        ids[np.arange(count), lengths - 1] = self.final[symbols[np.arange(count), lengths - 1]]
        rank = np.full((count, width), NEVER, dtype=np.int64)
        both = place[None, : width - 1] < lengths[:, None] - 1
        r, c = np.nonzero(both)
        rank[r, c] = self._pair_rank(ids[r, c], ids[r, c + 1])
        row = np.arange(count)
        while len(row):
            k = np.argmin(rank[row], axis=1)
            least = rank[row, k]
            row, k, least = row[least < NEVER], k[least < NEVER], least[least < NEVER]
            if not len(row):
                break
            ids[row, k] = self.made[least]
            gone = place[None, :] > k[:, None]
            for grid, empty in ((ids, -1), (rank, NEVER)):
                old = grid[row]
                new = np.concatenate((old[:, 1:], np.full((len(row), 1), empty)), axis=1)
                grid[row] = np.where(gone, new, old)
            rank[row, k] = NEVER
            right = np.flatnonzero((k + 1 < width) & (ids[row, np.minimum(k + 1, width - 1)] >= 0))
            rank[row[right], k[right]] = self._pair_rank(ids[row[right], k[right]], ids[row[right], k[right] + 1])
            left = np.flatnonzero(k > 0)
            rank[row[left], k[left] - 1] = self._pair_rank(ids[row[left], k[left] - 1], ids[row[left], k[left]])
        return ids

    def merged(self, word: str) -> list[int]:
        """The encoding by merging the pair of least rank, the leftmost first, until none is left.

        Live pairs wait in a heap, so that a word of n characters takes n log n steps.
        """
        ids = [self.vocab[c] for c in word[:-1]] + [self.vocab[word[-1] + WORD_END]]
        n = len(ids)
        after, ahead = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = []
        for k in range(n - 1):
            if q := self.pairs.get((ids[k], ids[k + 1])):
                heap.append((q[0], k, q[1], (ids[k], ids[k + 1])))
        heapq.heapify(heap)
        while heap:
            _, k, made, p = heapq.heappop(heap)
            j = after[k]
            if ids[k] < 0 or j < 0 or (ids[k], ids[j]) != p:
                continue
            ids[k], ids[j] = made, -1
            after[k] = after[j]
            if after[j] >= 0:
                ahead[after[j]] = k
            for u, v in ((ahead[k], k), (k, after[k])):
                if u >= 0 and v >= 0 and (q := self.pairs.get((ids[u], ids[v]))):
                    heapq.heappush(heap, (q[0], u, q[1], (ids[u], ids[v])))
        return [i for i in ids if i >= 0]

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """The encoding of each word, given as its bytes; words of like length are done together."""
        out: list = [None] * len(words)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        classes = np.where(sizes > WIDE, -1, np.maximum(sizes - 1, 0) // 8)
        for k in np.flatnonzero(classes < 0).tolist():
            out[k] = self.merged("".join([self.letters[b] for b in words[k]]))
        for c in np.unique(classes[classes >= 0]).tolist():
            for chosen in np.array_split(own := np.flatnonzero(classes == c), len(own) // 20_000 + 1):
                for k, ids in zip(chosen.tolist(), self._encode([words[k] for k in chosen.tolist()], sizes[chosen])):
                    out[k] = ids
        return out

    def _encode(self, words: list[bytes], lengths: np.ndarray) -> list[list[int]]:
        width = int(lengths.max()) + 1
        symbols = np.full((len(words), width), END, dtype=np.int64)
        symbols[np.arange(width) < lengths[:, None]] = np.frombuffer(b"".join(words), dtype=np.uint8)
        tokens = self.proposed(symbols, lengths)
        counts = (tokens >= 0).sum(axis=1)
        r, c = np.nonzero(tokens >= 0)
        failing = counts == 0
        failing[r[~self.reached[tokens[r, c]]]] = True
        r, c = np.nonzero(tokens[:, 1:] >= 0)
        pairs, where = np.unique((tokens[r, c] << 32) | tokens[r, c + 1], return_inverse=True)
        good = self._compatible(pairs >> 32, pairs & 0xFFFFFFFF)[where]
        failing[r[~good]] = True
        again = np.flatnonzero(failing)
        if len(again):
            exact = self.merged_rows(symbols[again], lengths[again])
            tokens[again, : width - 1] = exact
            tokens[again, width - 1] = -1
            counts[again] = (exact >= 0).sum(axis=1)
        flat = tokens[tokens >= 0].tolist()
        ends = np.cumsum(counts).tolist()
        return [flat[low:high] for low, high in zip([0, *ends], ends)]


_MARKS = regex.compile(f"([{_ranges(LATER_MARKS)}])")
_CAPITALS = regex.compile("[" + "".join(map(chr, LATER_CAPITALS)) + "]")
_SMALL = {c: c + far for c, far in LATER_CAPITALS.items()}


def _normal(text: str) -> str:
    """Composed form, then lower case letter by letter (a sigma does not look at its neighbours)."""
    if text.isascii():
        return text.lower()
    if _MARKS.search(text):  # nothing is sorted or joined across what the library does not know
        text = "".join(unicodedata.normalize("NFC", part) if k % 2 == 0 else part for k, part in enumerate(_MARKS.split(text)))
    else:
        text = unicodedata.normalize("NFC", text)
    text = text.replace("Σ", "σ").lower()
    return text.translate(_SMALL) if _CAPITALS.search(text) else text


class Coder:
    """Encodes and decodes batches of texts, remembering the pieces between white space it has met.

    No word of the pattern holds white space, so each piece is encoded by itself.
    """

    def __init__(self, merges: Merges):
        self.merges = merges
        self.find = regex.compile(PATTERN).findall
        self.space = regex.compile(r"\s+")
        self.odd = regex.compile("[\x1c-\x1f]")
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in merges.special) + ")") if merges.special else None
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.lengths = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.int32)
        self.shown = pa.array([], pa.string())
        self._remember([*self.merges.special], [[i] for i in self.merges.special.values()])

    def _remember(self, pieces: list[str], ids: list[list[int]]) -> None:
        strings = self.merges.strings
        self.place.update(zip(pieces, range(len(self.place), len(self.place) + len(pieces))))
        self.lengths = np.concatenate((self.lengths, [len(x) for x in ids])).astype(np.int64)
        self.flat = np.concatenate((self.flat, np.array([i for x in ids for i in x], dtype=np.int32)))
        shown = pa.array([" ".join([strings[i] for i in x]) if x else None for x in ids], pa.string())
        self.shown = pa.concat_arrays([self.shown, shown])

    def _pieces(self, text: str) -> list[str]:
        if self.cut is not None and "<" in text and any(s in text for s in self.merges.special):
            return [p for part in self.cut.split(text) for p in ([part] if part in self.merges.special else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        # str.split also cuts at four control characters that the pattern takes as signs
        return self.space.split(text) if self.odd.search(text) else text.split()

    def _learn(self, pieces: list[str]) -> None:
        words = [self.find(_normal(p)) for p in pieces]
        distinct = list({w for found in words for w in found})
        ids = dict(zip(distinct, self.merges.encode([w.encode() for w in distinct])))
        self._remember(pieces, [[i for w in found for i in ids[w]] for found in words])

    def encode(self, texts: list[str]) -> tuple[pa.Array, pa.Array]:
        """Token ids and decoded text for each text."""
        if len(self.place) > MEMORY:
            self.forget()
        found = [self._pieces(t) for t in texts]
        every = [p for pieces in found for p in pieces]
        index = np.array([self.place.get(p, -1) for p in every], dtype=np.int64)
        unknown = np.flatnonzero(index < 0).tolist()
        if unknown:
            self._learn(list({every[k] for k in unknown}))
            index[unknown] = [self.place[every[k]] for k in unknown]
        begins = np.cumsum(self.lengths) - self.lengths
        counts = np.array([len(x) for x in found], dtype=np.int64)
        each = self.lengths[index]
        ends = np.cumsum(each)
        tokens = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins[index] - (ends - each), each)]
        first = np.concatenate(([0], np.cumsum(counts)))
        token_first = np.concatenate(([0], ends))[first]
        ids = pa.ListArray.from_arrays(pa.array(token_first, pa.int32()), pa.array(tokens, pa.int32()))
        shown = self.shown.take(pa.array(index))
        if shown.null_count:  # a piece of which the pattern leaves nothing
            kept = np.concatenate(([0], np.cumsum(~shown.is_null().to_numpy(zero_copy_only=False))))
            first, shown = kept[first], shown.drop_null()
        pieces = pa.ListArray.from_arrays(pa.array(first, pa.int32()), shown)
        return ids, pc.binary_join(pieces, " ")


def _encode(spec: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    coder = Coder(Merges(spec.value))
    for batch in batches:
        for part in slices(batch, batch.schema.names[-1], 2 << 20):
            ids, decoded = coder.encode(pc.fill_null(part.column(part.num_columns - 1), "").to_pylist())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids, decoded], [*part.schema.names[:-1], "ids", "decoded"])


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``ids`` (array of int) and ``decoded`` (text).

    ``tokenizer`` is the path of a tokenizer file, read where the job is built; its tables
    have a fixed size and go to the executors once. A null or empty text gives no ids and
    an empty decoded text. Repeated rows stay, an empty table gives an empty one, and
    other columns, whatever their names, are left out. Special strings in a text are
    encoded as the tokens they name.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    pairs = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    schema = T.StructType([
        pairs.schema["key"], T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType()),
    ])
    return pairs.mapInArrow(partial(_encode, spec), schema).withColumnRenamed("key", id_col)


def digest(encoded: DataFrame) -> DataFrame:
    """The number of tokens and hashes of ids and decoded text."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def tokenizer_path() -> str:
    """The public word-end tokenizer that is installed beside Python."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return digest(encode(table(spark, sf_dir, "documents"), tokenizer_path()))
