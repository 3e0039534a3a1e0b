"""Words of many texts at once, as 64-bit hashes, with numpy over the UTF-8 bytes.

A word is a run of characters other than blank, tab, line feed, vertical tab, form feed
and carriage return, unless other bytes are given. Texts are never cut: only the working arrays are bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: An odd number that parts the places within a word, and the groups of eight bytes that are hashed at a time.
_STEP = 0x9E3779B97F4A7C15
_CHUNK = 1 << 18
#: The lowest bits of a group of eight bytes, by how many of the bytes belong to the word.
_LOWEST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)

#: Bytes between words: white space, or all ASCII but letters and digits.
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
SIGNS = np.zeros(256, dtype=bool)
SIGNS[:128] = [not chr(b).isalnum() for b in range(128)]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: neighbouring inputs give unrelated outputs."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words:
    """The words of a column of texts.

    ``hashes`` holds one value per word; the words of text i are those from ``first[i]``
    up to ``first[i + 1]``. ``starts`` and ``ends`` are byte offsets into ``data``.
    """

    def __init__(self, hashes, first, starts, ends, data):
        self.hashes, self.first, self.starts, self.ends, self.data = hashes, first, starts, ends, data


def slices(batch: pa.RecordBatch, column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``size`` bytes of text each, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths.astype(np.int64)) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for low, high in zip(cuts, cuts[1:]):
        if high > low:
            yield batch.slice(low, high - low)
    pa.default_memory_pool().release_unused()  # workers live on after their task


def words_of(texts: pa.Array, between: np.ndarray = WHITE) -> Words:
    """The words of each text; a null text has none. ``between`` tells the bytes that part words."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    texts = pa.concat_arrays([texts])
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low, high = int(offsets[0]), int(offsets[-1])
    data = data[low:high]
    offsets = offsets - low
    inside = ~between[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(closes) + 1
    return Words(_hashed(data, starts, ends), np.searchsorted(starts, offsets), starts, ends, data)


def _hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes, independent of where the word stands.

    Each group of eight bytes is mixed with its place in the word before the groups are summed up:
    no regularity of the bytes, such as that of the words of two letters in which every polynomial agrees, survives that.
    """
    sizes = ends - starts
    groups = (sizes + 7) >> 3
    total = np.concatenate(([0], np.cumsum(groups)))
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eights = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))  # eight bytes from each place on
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(total, total[at] + _CHUNK, "right")) - 1)
        first = total[at:stop] - total[at]
        place = np.arange(total[stop] - total[at]) - np.repeat(first, groups[at:stop])
        left = np.repeat(sizes[at:stop], groups[at:stop]) - 8 * place
        value = eights[np.repeat(starts[at:stop], groups[at:stop]) + 8 * place] & _LOWEST[np.minimum(left, 8)]
        value += mix((place.astype(np.uint64) + np.uint64(1)) * np.uint64(_STEP))
        out[at:stop] = np.add.reduceat(mix(value), first) if len(place) else 0
        at = stop
    return mix(out + sizes.astype(np.uint64) * np.uint64(_STEP))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` consecutive values; there are ``len - size + 1``."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(count, dtype=np.uint64)
    for k in range(size):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[k : k + count]
    return mix(out)


def inner(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the windows over all words lie in one text.

    Returns their positions and, for each text, where its windows begin among them.
    """
    counts = np.maximum(np.diff(first) - size + 1, 0)
    begin = np.concatenate(([0], np.cumsum(counts)))
    position = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], counts)
    return position, begin
