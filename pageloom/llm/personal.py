"""Personal data: fixed forms by rule, and further forms by a character-level LSTM with a CRF.

Four kinds have a fixed form that is found by rule: the base. A bidirectional LSTM over
characters (``charnet``) is trained on windows of a bounded sample of texts, whose labels are the base spans there
and known forms, written in other ways, that are put into such windows. Every text is then cut into
windows that overlap; each is decoded by itself, and the spans of all windows of a text are
reconciled: what a window's edge cut is joined up, and of spans that overlap those stay that
have the greatest sum of log-odds. Spans that touch no base span are added to the base.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm.charnet import Net, signs_of
from pageloom.llm.registry import query, table
from pageloom.llm.words import slices

#: The base kinds, in the order in which spans are listed.
BASE = ("email", "ip", "card", "phone")
#: What the model adds is of a kind of its own, listed after the base.
KINDS = BASE + tuple(f"{k}_variant" for k in BASE)
#: Texts that the sample has about, and windows that one text gives at most.
SAMPLE_DOCS, WINDOWS_OF_TEXT = 2_000, 6
#: Windows the net is trained on, their characters, and rounds of training.
TRAINED, TRAINED_SIZE, ROUNDS = 4_000, 56, 14
#: Characters of a window and how many of them the next window sees again; windows that are run at a time.
WINDOW, OVERLAP, TOGETHER = 256, 32, 1_024
#: The log-odds over "no span" that an added span must have.
LEAST_ODDS = 4.0

Span = tuple[int, int, int]  # kind (a place in BASE), start, end

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_CALL = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0  # where the last match ended
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        host = _DOMAIN.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            free = host.end()
        at = text.find("@", max(at + 1, free))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for chain in _DOTTED.finditer(text):
        parts = chain.group().split(".")
        start = chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end
            start = end + 1


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() < 38:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _CALL.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()


def base_spans(text: str) -> list[Span]:
    """All base spans, by kind and start; each finder reads a text in linear time."""
    finders = (_emails, _ips, _cards, _phones)
    return [(k, start, end) for k, find in enumerate(finders) for start, end in find(text)]


# --- training ---------------------------------------------------------------------------------------------------


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of sampled texts: round base spans, round other digits and signs, and anywhere."""
    mark = re.compile(r"[0-9@]+")
    for batch in batches:
        out = []
        for text in batch.column(0).to_pylist():
            spans = base_spans(text)
            draw = np.random.default_rng([7, len(text), sum(map(ord, text[:: max(1, len(text) // 64)]))])
            places = [(s + e) // 2 for _, s, e in spans][: WINDOWS_OF_TEXT // 2]
            others = [m.start() for m in mark.finditer(text)]
            places += [others[k] for k in draw.permutation(len(others))[:2].tolist()]
            places += draw.integers(0, len(text) + 1, WINDOWS_OF_TEXT - len(places)).tolist()
            for place in places:
                start = max(0, min(place - int(draw.integers(10, TRAINED_SIZE - 10)), len(text) - TRAINED_SIZE))
                end = start + TRAINED_SIZE
                # a span that the window's edge cuts moves the edge
                start = min([start, *(s for _, s, e in spans if s < start < e)])
                end = max([end, *(e for _, s, e in spans if s < end < e)])
                inside = [{"kind": k, "start": s - start, "end": e - start} for k, s, e in spans if start <= s and e <= end]
                out.append({"text": text[start:end], "spans": inside})
        yield pa.RecordBatch.from_pylist(out, schema=_WINDOW)


_WINDOW = pa.schema([("text", pa.string()), ("spans", pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])))])
_WINDOW_SQL = "text string, spans array<struct<kind:int,start:int,end:int>>"

# Forms by kind: 9 stands for a digit, a for a letter, f for a hexadecimal digit, N for a number up to 255, w for a word.
_FORMS = (
    ("w.99@w.w.w", "w@w.aa", "w99 [at] w [dot] w", "w(at)w.aa", "w [at] w.aaa", "w @ w . w", "w.99 @ w.aaa", "w_w(at)w(dot)aa", "w.w[at]w[dot]w",
     "w {at} w {dot} aaa", "w99 <at> w.aa"),
    ("N.N.N.N", "N[.]N[.]N[.]N", "N . N . N . N", "N(.)N(.)N(.)N", "N dot N dot N dot N", "ffff:ff:ffff::fff:ffff", "ffff::ff:fff", "ffff:ffff:f:f:ffff:ff:ffff:ffff"),
    ("9999 9999 9999 9999", "9999-9999-9999-9999", "9999.9999.9999.9999", "9999/9999/9999/9999", "9999  9999  9999  9999", "9999 - 9999 - 9999 - 9999",
     "9999_9999_9999_9999", "9999.999999.99999"),
    ("+9 (999) 999-9999", "+99 99 99999999", "(999) 999-9999", "999-999-9999", "999.999.9999", "1-999-999-9999", "0099 99 9999999", "0999/9999999",
     "0999 999 9999", "(099) 9999 9999"),
)
# Forms that belong to no kind.
_OTHERS = (
    "9999-99-99", "99.99.9999", "99/99/9999", "99:99:99", "v9.9.9", "9.9.9-aa", "9,999,999.99", "$9,999.99", "#99999", "9.99999", "999999999999999",
    "9999999999999999", "99999999", "99 999 999", "99-99", "@w", "w@", "w at w", "w dot w", "https://w.aaa/w?w=99", "ffffffffffffffffffffffffffffffff", "w_w = \"ffffffffff\"",
    "9.9.9.9.9.9", "999.9 w", "w 9", "(9)", "9999 w 9999", "99%", "w.w", "w: w", "[w]", "9 x 9",
)


def _filled(form: str, words: list[str], draw: np.random.Generator) -> str:
    def one(m: re.Match) -> str:
        c = m.group()
        if c == "9":
            return str(draw.integers(0, 10))
        if c == "N":
            return str(draw.integers(1, 256))
        if c == "w":
            return words[draw.integers(0, len(words))]
        return "".join(draw.choice(list("0123456789abcdef" if c[0] == "f" else "abcdefghijklmnopqrstuvwxyz"), len(c)))

    return re.sub(r"9|N|\bw|(?<=[@._])w|f{1,32}(?![a-z])|\ba{2,3}(?![a-z])", one, form)


def lessons(windows: list[tuple[str, list[dict]]], count: int = TRAINED, seed: int = 3) -> list[tuple[str, list[Span]]]:
    """``count`` labelled texts: a part of the windows as they are, and windows with a form put in at a blank."""
    draw = np.random.default_rng(seed)
    words = sorted({w.lower() for text, _ in windows for w in re.findall(r"\b[A-Za-z]{2,12}\b", text)}) or ["name", "mail", "host"]
    out = []
    for n in range(count if windows else 0):
        text, spans = windows[n % len(windows)]
        held = [(s["kind"], s["start"], s["end"]) for s in spans]
        way = draw.integers(0, 10)
        if way >= 3:
            blanks = [m.end() for m in re.finditer(r"[ \n]", text) if all(not s <= m.start() < e for _, s, e in held)]
            place = blanks[draw.integers(0, len(blanks))] if blanks else len(text) if all(e < len(text) for _, _, e in held) else 0
            kind = int(draw.integers(0, len(BASE))) if way < 8 else None
            forms = _OTHERS if kind is None else _FORMS[kind]
            new = _filled(forms[draw.integers(0, len(forms))], words, draw)
            after = str(draw.choice([" ", " ", " ", ", ", ". ", "\n", ") "]))
            before = " " if place and not text[place - 1].isspace() else ""
            size = len(before) + len(new) + len(after)
            held = [(k, s, e) if e <= place else (k, s + size, e + size) for k, s, e in held]
            if kind is not None:
                held.append((kind, place + len(before), place + len(before) + len(new)))
            text = text[:place] + before + new + after + text[place:]
        out.append((text, sorted(held, key=lambda s: s[1])))
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def tensors(labelled: list[tuple[str, list[Span]]], size: int = TRAINED_SIZE + 40) -> tuple[np.ndarray, np.ndarray]:
    """Kinds of characters and labels, one row for each text; what is longer is cut where no span is."""
    signs, labels = np.zeros((len(labelled), size), dtype=np.uint8), np.zeros((len(labelled), size), dtype=np.int64)
    for n, (text, spans) in enumerate(labelled):
        first = max(0, min(len(text) - size, min([s for _, s, _ in spans], default=0)))
        codes = _codes(text)[first : first + size]
        signs[n, : len(codes)] = signs_of(codes)
        for k, s, e in spans:
            labels[n, max(0, s - first) : max(0, e - first)] = k + 1
    return signs, labels


def _trained(rounds: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [(r["text"], r["spans"]) for batch in batches for r in batch.to_pylist()]
    rows.sort(key=lambda r: (r[0], str(r[1])))
    order = np.random.default_rng(1).permutation(len(rows)).tolist()
    net = Net(len(BASE) + 1)
    signs, labels = tensors(lessons([rows[k] for k in order]))
    if len(signs):
        net.train(signs, labels, rounds)
        yield pa.RecordBatch.from_arrays([pa.array([net.to_bytes()], pa.binary())], ["net"])


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS, text_col: str = "text") -> Net | None:
    """The net, trained on windows of about ``sample_docs`` texts that a hash chooses; None if there is no text.

    Half of the sample are texts with a digit or an at sign. Labels are the base spans of each
    window and the forms put in. One task trains on the windows, which are bounded by the sample.
    """
    texts = docs.select(F.col(text_col).alias("text")).where(F.length("text") > 0)
    marked = F.col("text").rlike("[0-9@]")
    sizes = texts.agg(F.count("*").alias("n"), F.count(F.when(marked, 1)).alias("m")).first()
    place = F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(1 << 30))
    shares = [sample_docs / 2 / max(1, n) for n in (sizes["m"], sizes["n"] - sizes["m"])]
    chosen = texts.where(place < F.when(marked, F.lit(shares[0])).otherwise(F.lit(shares[1])) * float(1 << 30))
    windows = chosen.mapInArrow(_windows, _WINDOW_SQL).dropDuplicates(["text"])
    found = windows.coalesce(1).mapInArrow(partial(_trained, rounds), "net binary").first()
    return Net.from_bytes(bytes(found["net"])) if found else None


# --- finding ----------------------------------------------------------------------------------------------------


def spread(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start in it, length) of the windows that cover texts of these lengths."""
    step = WINDOW - OVERLAP
    counts = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - WINDOW) // step)), 0)
    text = np.repeat(np.arange(len(lengths)), counts)
    start = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * step
    return text, start, np.minimum(WINDOW, lengths[text] - start)


def proposals(net: Net, texts: list[str]) -> list[list[tuple[int, int, int, float, bool, bool]]]:
    """For each text, (kind, start, end, log-odds, cut at its start, cut at its end) of the spans in its windows."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    codes = _codes("".join(texts))
    signs = np.concatenate([signs_of(codes), np.zeros(1, np.uint8)])
    begin = np.cumsum(lengths) - lengths
    text, start, size = spread(lengths)
    out: list[list[tuple[int, int, int, float, bool, bool]]] = [[] for _ in texts]
    steps = net.weights["steps"].astype(np.float64)
    order = np.argsort(-size, kind="stable")
    for at in range(0, len(order), TOGETHER):
        some = order[at : at + TOGETHER]
        reach = np.arange(size[some[0]])[:, None]
        place = np.where(reach < size[some], begin[text[some]] + start[some] + reach, len(signs) - 1)
        scores = net.scores(signs[place])
        labels = net.decode(scores)
        for n in np.flatnonzero(labels.any(axis=0)).tolist():
            row = labels[: size[some[n]], n]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(row)) + 1, [len(row)]])
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                k = int(row[low])
                if not k:
                    continue
                odds = float((scores[low:high, k, n] - scores[low:high, 0, n]).sum(dtype=np.float64)) + (high - low - 1) * (steps[k, k] - steps[0, 0])
                odds += (steps[0, k] - steps[0, 0]) * (low > 0) + (steps[k, 0] - steps[0, 0]) * (high < len(row))
                w, first = int(text[some[n]]), int(start[some[n]])
                out[w].append((k - 1, first + low, first + high, odds, low == 0 and first > 0, high == len(row) and first + high < lengths[w]))
    return out


def reconcile(found: list[tuple[int, int, int, float, bool, bool]]) -> list[tuple[int, int, int, float]]:
    """Spans of one text from the proposals of all its windows; none overlap.

    Spans of one kind that overlap and of which one was cut by the edge of its window are one
    span. Of all sets of spans that do not overlap, the one with the greatest sum of log-odds is taken.
    """
    joined: list[list] = []
    for kind, start, end, odds, cut_low, cut_high in sorted(found):
        last = joined[-1] if joined else None
        if last and last[0] == kind and start <= last[2] and (cut_low or cut_high or last[4] or last[5]):
            last[2], last[3] = max(last[2], end), max(last[3], odds)
            last[5] = cut_high
        else:
            joined.append([kind, start, end, odds, cut_low, cut_high])
    best: dict[tuple[int, int, int], float] = {}
    for kind, start, end, odds, *_ in joined:
        if odds > 0:
            best[kind, start, end] = max(odds, best.get((kind, start, end), 0.0))
    spans = sorted(((*s, odds) for s, odds in best.items()), key=lambda s: (s[2], s[1], s[0]))
    ends = [s[2] for s in spans]
    total, taken = [0.0], []
    for n, (_, start, _, odds) in enumerate(spans):
        before = bisect.bisect_right(ends, start, 0, n)
        take = total[before] + odds
        taken.append((take > total[n], before))
        total.append(max(take, total[n]))
    out, n = [], len(spans)
    while n:
        chosen, before = taken[n - 1]
        if chosen:
            out.append(spans[n - 1])
        n = before if chosen else n - 1
    return out[::-1]


_TELLING = re.compile(r"[0-9@(\[{<]")
_BEFORE, _AFTER = re.compile(r"[^0-9A-Za-z(+\[]+"), re.compile(r"[^0-9A-Za-z)]+$")


def added(text: str, found: list[tuple[int, int, int, float, bool, bool]], base: list[Span], least: float = LEAST_ODDS) -> list[tuple[int, int, int, float]]:
    """The model's spans without signs around them, of enough odds, that overlap no base span and do not read like mere words."""
    out = []
    low = sorted((s, e) for _, s, e in base)
    for kind, start, end, odds in reconcile(found):
        held = text[start:end]
        lead = _BEFORE.match(held)
        start, held = (start + lead.end(), held[lead.end():]) if lead else (start, held)
        held = _AFTER.sub("", held)
        if odds >= least and len(held) >= 6 and _TELLING.search(held) and not any(s < start + len(held) and start < e for s, e in low):
            out.append((kind, start, start + len(held), odds))
    return out


def _found(state: Broadcast | None, least: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    net = Net.from_bytes(state.value) if state is not None else None
    for batch in batches:
        for part in slices(batch, batch.schema.names[-1], 1 << 20):
            texts = [t or "" for t in part.column(part.num_columns - 1).to_pylist()]
            more = proposals(net, texts) if net is not None else [[] for _ in texts]
            rows = []
            for text, found in zip(texts, more):
                base = base_spans(text)
                rows.append([{"kind": BASE[k], "order": k, "start": s, "end": e, "odds": None} for k, s, e in base] + [
                    {"kind": KINDS[k + len(BASE)], "order": k + len(BASE), "start": s, "end": e, "odds": odds}
                    for k, s, e, odds in sorted(added(text, found, base, least))])
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(rows, _SPANS)], [*part.schema.names[:-1], "found"])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("order", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("odds", pa.float64())]))
_SPANS_SQL = "array<struct<kind:string,order:int,start:bigint,end:bigint,odds:double>>"


def find(docs: DataFrame, net: Net | None, least: float = LEAST_ODDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and ``found``, all spans by kind and start, in code points with exclusive ends.

    ``odds`` is null for base spans. A null text counts as empty and has none. Without a net
    only the base is found. Other columns, whatever their names, are not read.
    """
    state = docs.sparkSession.sparkContext.broadcast(net.to_bytes()) if net is not None else None
    pairs = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    schema = f"key {pairs.schema['key'].dataType.simpleString()}, found {_SPANS_SQL}"
    return pairs.mapInArrow(partial(_found, state, least), schema).withColumnRenamed("key", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a hash of the base spans, and all spans as text."""
    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["order"] < len(BASE))
    return found.select(id_col, *[count(k) for k in BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


@query("op12_personal")
def op12_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: the base by rule, and what a net trained on a sample adds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(find(docs, fit(docs)))
