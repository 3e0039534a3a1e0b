import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
import pytest

from pageloom.llm import personal
from pageloom.llm.charnet import Net, _likelihood, signs_of

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m.group())
            doubled = sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(digits[::-1]))
            good = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else None,
                    "card": 16 <= len(digits) <= 19 and doubled % 10 == 0, "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def net(docs):
    return personal.fit(docs)


def test_base_as_by_plain_patterns():
    draw = np.random.default_rng(0)
    pieces = list("aZ09 .@+-()%_é") + ["10.0.0.255", "4111 1111 1111 1111", "+1 (555) 010-9999", "a.b@c.d-e", "@x.y", "300.1.2.3", "00000.1.2.3", "\U0001f600", "+1", "@@"]
    for _ in range(4_000):
        text = "".join(pieces[k] for k in draw.integers(0, len(pieces), draw.integers(0, 25)))
        assert [(personal.BASE[k], s, e) for k, s, e in personal.base_spans(text)] == brute(text), text


def test_base_takes_linear_time():
    size = 1_000_000
    for text in ("a" * size, "1" * size, "1." * size, "@" * size, "a@" * size, "+1" * size, "1 " * size, "+1" + " " * size):
        assert len(personal.base_spans(text)) <= size


def test_gradient():
    draw = np.random.default_rng(1)
    net = Net(3)
    net.weights = {n: v.astype(np.float64) for n, v in net.weights.items()}
    signs, labels = draw.integers(0, 12, (6, 4)), draw.integers(0, 3, (6, 4))
    _, grown = net.loss(signs, labels)
    for name, weights in net.weights.items():
        for _ in range(6):
            place = tuple(int(draw.integers(0, 12 if n == 132 else n)) for n in weights.shape)
            kept, values = weights[place], []
            for step in (1e-5, -1e-5):
                weights[place] = kept + step
                values.append(net.loss(signs, labels)[0])
            weights[place] = kept
            assert abs((values[0] - values[1]) / 2e-5 - grown[name][place]) < 1e-6, name


def test_likelihood_and_best_path_by_all_paths():
    draw = np.random.default_rng(2)
    net = Net(3)
    for _ in range(20):
        scores, steps = draw.normal(0, 2, (5, 1, 3)), draw.normal(0, 1, (3, 3))
        net.weights["steps"] = steps
        value = {p: sum(scores[t, 0, k] for t, k in enumerate(p)) + sum(steps[a, b] for a, b in zip(p, p[1:])) for p in itertools.product(range(3), repeat=5)}
        best = max(value, key=value.get)
        assert tuple(net.decode(scores.transpose(0, 2, 1))[:, 0].tolist()) == best
        whole = np.log(sum(np.exp(v) for v in value.values()))
        labels = np.array(best)[:, None]
        assert abs(_likelihood(scores, steps, labels)[0] - (whole - value[best])) < 1e-9


def test_windows_cover_every_text():
    lengths = np.array([0, 1, 127, 128, 129, 224, 225, 1000])
    text, start, size = personal.spread(lengths)
    for n, length in enumerate(lengths.tolist()):
        mine = [(s, s + z) for t, s, z in zip(text.tolist(), start.tolist(), size.tolist()) if t == n]
        assert {p for s, e in mine for p in range(s, e)} == set(range(length)) and all(e <= length for _, e in mine)
        assert all(b[0] <= a[1] - personal.OVERLAP for a, b in zip(mine, mine[1:]))


def test_reconciled_spans_have_the_greatest_sum():
    draw = np.random.default_rng(3)
    for _ in range(200):
        spans = [(int(draw.integers(0, 2)), s, s + int(draw.integers(1, 6)), round(float(draw.normal(3, 3)), 2), False, False) for s in draw.integers(0, 20, 7).tolist()]
        got = personal.reconcile(spans)
        best = max(sum(s[3] for s in some) for n in range(8) for some in itertools.combinations(spans, n)
                   if all(a[2] <= b[1] or b[2] <= a[1] for a, b in itertools.combinations(some, 2)))
        assert all(a[2] <= b[1] for a, b in zip(got, got[1:])) and abs(sum(s[3] for s in got) - best) < 1e-9


def test_spans_cut_by_a_window_are_joined():
    cut = [(1, 100, 128, 9.0, False, True), (1, 96, 140, 11.0, True, False), (0, 150, 160, 5.0, False, False)]
    assert personal.reconcile(cut) == [(1, 96, 140, 11.0), (0, 150, 160, 5.0)]
    assert personal.reconcile([(1, 5, 9, 4.0, False, False), (1, 5, 9, 6.0, False, False)]) == [(1, 5, 9, 6.0)]


def test_other_ways_of_writing_are_found(docs, net):
    """Windows of documents that the sample may hold, with words and digits it does not hold put in."""
    texts = [r["text"] for r in docs.where("length(text) > 200").orderBy("doc_id").limit(60).collect()]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    windows = [(r["text"], r["spans"]) for b in personal._windows(iter([batch])) for r in b.to_pylist()]
    hit = wanted = extra = 0
    for text, spans in personal.lessons(windows, 600, seed=99):
        base = personal.base_spans(text)
        others = [s for s in spans if not any(b[1] < s[2] and s[1] < b[2] for b in base)]
        got = personal.added(text, personal.proposals(net, [text])[0], base)
        wanted += len(others)
        hits = [g for g in got if any(g[0] == k and abs(g[1] - s) <= 2 and abs(g[2] - e) <= 2 for k, s, e in others)]
        hit += len(hits)
        extra += len(got) - len(hits)
    assert wanted > 100 and hit >= 0.6 * wanted and extra <= 0.3 * hit, (hit, wanted, extra)


def test_query(spark, sf, docs, net):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = personal.digest(personal.find(docs, net)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = brute(texts[r["doc_id"]])
        spans = [s.split(":") for s in r["spans"].split(",")] if r["spans"] else []
        assert [(k, int(s), int(e)) for k, s, e in spans if not k.endswith("_variant")] == want
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in personal.BASE] == [sum(w[0] == k for w in want) for k in personal.BASE]
        order = [(personal.KINDS.index(k), int(s)) for k, s, _ in spans]
        assert order == sorted(order)
    assert sum("variant" in r["spans"] for r in rows) <= 0.02 * len(rows)  # the table has next to nothing but the base


def test_odd_rows(spark, odd_docs, empty_docs, net):
    df = odd_docs.selectExpr("*", "'clash' AS found", "'clash' AS kind", "1 AS start")
    more = spark.createDataFrame([(90, "mail x.1@y.zz or 10.1.2.3, call +1 (555) 010-9999"), (91, "+1 (555) 010-9999")], "doc_id long, text string")
    got = personal.find(df.select("doc_id", "text").union(more), net).collect()
    assert len(got) == odd_docs.count() + 2
    found = {r["doc_id"]: r["found"] for r in got}
    assert found[2] == [] and found[3] == [] and found[4] == []
    assert [(s["kind"], s["start"], s["end"]) for s in found[90] if s["odds"] is None] == [("email", 5, 13), ("ip", 17, 25), ("phone", 32, 49)]
    assert personal.find(df, net).count() == odd_docs.count()
    assert personal.find(empty_docs, net).collect() == []
    assert personal.fit(empty_docs) is None
    bare = {r["doc_id"]: r["found"] for r in personal.find(more, None).collect()}
    assert len(bare[90]) == 3 and [s["kind"] for s in bare[91]] == ["phone"]


def test_weights_survive_bytes_and_signs_have_no_case():
    net = Net(5)
    other = Net.from_bytes(net.to_bytes())
    assert all((net.weights[n] == other.weights[n]).all() for n in net.weights)
    assert signs_of(np.array([65, 97])).tolist() == [98, 98]
