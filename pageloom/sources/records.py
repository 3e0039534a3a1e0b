"""Records of quoted text files, cut at line feeds that stand outside quotes.

A value in quotes may hold line feeds and separators, and a doubled quote stands for one. Where
a record starts therefore depends on all bytes before it, yet files are read in ranges: first
every range tells, for each state it could begin in, the state it would end in; the states of
a file's ranges follow one another from there; then each range reads the records that start
in it. A quote that nothing closes is a reject of one line, and reading goes on behind that line.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.sources.warc import file_system

#: Bytes of a range, bytes that are read at a time beyond it, and text of an Arrow batch.
RANGE, PIECE, BATCH = 64 << 20, 1 << 20, 4 << 20
#: States between two bytes: at the start of a record or of a field, in a plain field, in quotes, behind a quote in quotes.
RECORD, FIELD, PLAIN, QUOTED, QUOTE = range(5)


class Grammar:
    """The patterns of one separator."""

    def __init__(self, sep: str):
        s = re.escape(sep.encode())
        self.body = re.compile(rb'[^"]*+(?:""[^"]*+)*+')
        self.plain = re.compile(rb"[^%b\n]*+" % s)
        field = rb'(?>"[^"]*+(?:""[^"]*+)*+"[^%b\n]*+|[^"%b\n][^%b\n]*+|)' % (s, s, s)
        # a quoted value must be closed by a quote that no other one follows, and a plain one ends at a separator
        closed = rb"(?=[%b\n])" % s
        self.fields = re.compile(rb"(?:%b%b%b)*+" % (field, closed, s))
        self.record = re.compile(rb"(?:%b%b%b)*+%b%b\n" % (field, closed, s, field, closed))
        self.sep = sep.encode()

    def records(self, data: bytes, at: int) -> tuple[list[int], int]:
        """The starts of records from one that starts at ``at``, the last of them perhaps not whole, and the state at the end."""
        starts = [at]
        while (found := self.record.match(data, at)) is not None:
            at = found.end()
            starts.append(at)
        return starts, self._state(data, at)

    def _state(self, data: bytes, at: int) -> int:
        """The state at the end of a record that starts at ``at`` and does not end."""
        if at == len(data):
            return RECORD
        at = self.fields.match(data, at).end()
        if at == len(data):
            return FIELD
        return self._in_quotes(data, at + 1)[1] if data[at] == 0x22 else PLAIN

    def _in_quotes(self, data: bytes, at: int) -> tuple[int, int]:
        """From inside quotes: the place behind the closing quote and PLAIN, or the end and QUOTED, or QUOTE if that is a quote."""
        at = self.body.match(data, at).end()
        if at == len(data):
            return at, QUOTED
        return (at + 1, QUOTE) if at + 1 == len(data) else (at + 1, PLAIN)

    def enter(self, data: bytes, state: int) -> tuple[int | None, int, bool]:
        """Where the first record starts for data that begins in a state (None: nowhere); else the state at the end; and whether quotes closed."""
        at, closed = 0, state not in (QUOTED, QUOTE)
        if state == QUOTE:  # a second quote stands for itself
            if data[:1] == b'"':
                at, state = 1, QUOTED
            elif data:
                state, closed = PLAIN, True
            else:
                return None, QUOTE, False
        if state == QUOTED:
            at, state = self._in_quotes(data, at)
            if state != PLAIN:
                return None, state, False
            closed = True
        if state == RECORD:
            return 0, RECORD, closed
        if state == PLAIN:
            at = self.plain.match(data, at).end()
            if at == len(data):
                return None, PLAIN, closed
            if data[at] == 0x0A:
                return at + 1, RECORD, closed
            at += 1
        found = self.record.match(data, at)
        if found is not None:
            return found.end(), RECORD, closed
        end = self._state(data, at)
        return None, FIELD if end == RECORD else end, closed

    def outcomes(self, data: bytes) -> tuple[list[int], list[bool]]:
        """For each state the data could begin in, the state at its end, and whether quotes it began in were closed."""
        known: tuple[list[int], int] | None = None
        ends, closed = [], []
        for state in range(5):
            first, end, shut = self.enter(data, state)
            if first is not None:
                if known is None:
                    known = self.records(data, first)
                place = bisect_left(known[0], first)
                same = place < len(known[0]) and known[0][place] == first
                end = known[1] if same else self.records(data, first)[1]
            ends.append(end)
            closed.append(shut)
        return ends, closed


def _read(path: str, start: int, end: int) -> bytes:
    system, inner = file_system(path)
    with system.open_input_file(inner) as file:
        file.seek(start)
        return file.read(end - start)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _outcomes(sep: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grammar = Grammar(sep)
    for row in _rows(batches):
        ends, closed = grammar.outcomes(_read(row["path"], row["start"], row["end"]))
        yield pa.RecordBatch.from_pylist([{**row, "ends": ends, "closed": closed}], schema=_OUTCOME)


_RANGE_SQL = "path string, start long, end long"
_OUTCOME = pa.schema([("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("ends", pa.list_(pa.int32())), ("closed", pa.list_(pa.bool_()))])


def _followed(ranges: pd.DataFrame) -> pd.DataFrame:
    """The state each range of one file begins in, and whether quotes that are open at its end are closed later."""
    ranges = ranges.sort_values("start")
    state, states = RECORD, []
    for ends in ranges["ends"]:
        states.append(state)
        state = int(ends[state])
    later, flags = state == QUOTE, []  # a quote at the end of the file closes
    for begun, closed in zip(reversed(states), reversed(list(ranges["closed"]))):
        flags.append(later)
        later = begun not in (QUOTED, QUOTE) or bool(closed[begun]) or later
    return pd.DataFrame({"path": ranges["path"], "start": ranges["start"], "end": ranges["end"], "state": states, "closed_later": flags[::-1]})


class _Ahead:
    """The bytes of a file from a place on, read as they are asked for."""

    def __init__(self, path: str, start: int, end: int):
        self.path, self.at = path, end
        self.data = _read(path, start, end)

    def more(self) -> bool:
        """Read on, twice as far each time; False at the end of the file."""
        new = _read(self.path, self.at, self.at + max(PIECE, len(self.data)))
        self.at += len(new)
        self.data += new
        return bool(new)


def _closes(path: str, at: int, grammar: Grammar, data: bytes) -> bool:
    """Whether quotes that are open behind ``data``, which reaches up to ``at``, are closed further on; nothing is kept."""
    state = grammar._state(data, 0)
    while True:
        new = _read(path, at, at + 16 * PIECE)
        if not new:
            return state == QUOTE
        _, state, shut = grammar.enter(new, state)
        if shut:
            return True
        at += len(new)


def records_of(path: str, start: int, end: int, state: int, closed_later: bool, sep: str) -> Iterator[tuple[int, str, bool]]:
    """(place, text, whether its quotes are closed) of the records that start in [start, end).

    If quotes are open at the end of the range and stay so to the end of the file, the ranges that
    follow have no record of their own, and what comes behind the line with the quote is read here.
    """
    grammar = Grammar(sep)
    ahead = _Ahead(path, start, end)
    at, _, _ = grammar.enter(ahead.data, state)
    if at is None:
        return
    base, limit, rest = start, end, False  # place of the data in the file, where to stop, whether past the range
    while True:
        found = grammar.record.match(ahead.data, at)
        if found is None and (rest or base + at < limit):
            open_ = grammar._state(ahead.data, at)
            stays = open_ in (QUOTED, QUOTE) and not (
                _closes(path, ahead.at, grammar, ahead.data[at:]) if rest or ahead.at > end else closed_later or _closed_at_end(open_, path, ahead.at))
            if stays:
                line = ahead.data.find(b"\n", at)
                while line < 0 and ahead.more():
                    line = ahead.data.find(b"\n", at)
                stop = len(ahead.data) if line < 0 else line
                yield base + at, _text(ahead.data[at:stop]), False
                at, rest = stop + 1, True
                if line < 0:
                    return
                continue
            if ahead.more():
                continue
            if at < len(ahead.data):  # the file does not end with a line feed
                yield base + at, _text(ahead.data[at:]), True
            return
        if found is None or (not rest and base + at >= limit):
            return
        yield base + at, _text(ahead.data[at : found.end() - 1]), True
        at = found.end()
        if at >= 4 * PIECE:  # what was read is given up
            ahead.data, base, at = ahead.data[at:], base + at, 0


def _closed_at_end(state: int, path: str, at: int) -> bool:
    """A quote at the very end of the file closes."""
    return state == QUOTE and not _read(path, at, at + 1)


def _text(data: bytes) -> str:
    return data.removesuffix(b"\r").decode("utf-8", errors="replace")


def _records(sep: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        held, size = [], 0
        for place, text, closed in records_of(row["path"], row["start"], row["end"], row["state"], row["closed_later"], sep):
            held.append((row["path"], place, text, closed))
            size += len(text) + 64
            if size >= BATCH:
                yield _batch(held)
                held, size = [], 0
        if held:
            yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["path", "place", "record", "closed"])


def read_records(spark: SparkSession, path: str, sep: str = ",", range_bytes: int | None = None) -> DataFrame:
    """(path, place, record, closed): the records of the files of a folder, file or glob, by their place in the file.

    A carriage return before the line feed that ends a record is left out. Empty lines are empty
    records. ``closed`` is false for a line with a quote that nothing closes. Damaged files apart, a task reads a range.
    """
    size = RANGE if range_bytes is None else range_bytes
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    pieces = F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / size))).alias("k")
    ranges = files.select("path", "length", pieces).select(
        "path", (F.col("k") * size).alias("start"), F.least("length", (F.col("k") + 1) * size).alias("end"))
    count = files.agg(F.sum(F.floor((F.col("length") - 1) / size) + 1).alias("n")).first()["n"] or 1
    tasks = min(count, 20_000)
    outcomes = ranges.repartition(tasks).mapInArrow(partial(_outcomes, sep), f"{_RANGE_SQL}, ends array<int>, closed array<boolean>")
    states = outcomes.groupBy("path").applyInPandas(_followed, f"{_RANGE_SQL}, state int, closed_later boolean")
    return states.repartition(tasks).mapInArrow(partial(_records, sep), "path string, place long, record string, closed boolean")
