import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from pageloom.llm import decontaminate as dc


@pytest.mark.parametrize("entries", [1 << 20, 50])
def test_search_finds_what_scoring_everything_finds(spark, sf, entries, monkeypatch):
    monkeypatch.setattr(dc, "ENTRIES", entries)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    index = dc.Index(items)
    texts = pa.array([r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(120).collect()])
    words = dc._words(texts)
    term = index.lookup(words.hashes)
    rows, parts, _, _ = index.search(term, words.first)
    want = set()
    for r in range(len(texts)):
        low, high = int(words.first[r]), int(words.first[r + 1])
        for start in range(low, max(low + 1, high - dc.CHUNK), dc.CHUNK) if high > low else []:
            terms = np.unique(term[start : min(start + 2 * dc.CHUNK, high)])
            cells = np.isin(index.cell // index.blocks, terms[terms >= 0])
            entry, _ = dc._spread(index.cell_first, np.flatnonzero(cells))
            score = np.bincount(index.part[entry], weights=index.impact[entry], minlength=len(index.item))
            want |= {(r, int(p)) for p in np.flatnonzero(score >= index.reach - 1e-9)}
    assert set(zip(rows.tolist(), parts.tolist())) == want and want


def test_whole_items_are_found_and_nothing_else(spark, sf):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = {(d, i) for i, t in items for d, text in docs.items() if t in text}
    found = {(r["doc_id"], r["item_id"]) for r in dc.op4_decontaminate(spark, sf).collect()}
    assert want and found == want


def test_changed_case_and_signs_and_long_items(spark):
    item = " ".join(f"term{k}" for k in range(200)) + "? The answer is forty two of seven."
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "!!")], "item_id long, text string")
    filler = " ".join(f"other{k}" for k in range(300))
    docs = spark.createDataFrame(
        [(1, f"{filler} {item.upper().replace(' ', ' - ')} {filler}"), (2, filler), (3, " ".join(item.split()[:20])), (4, None), (5, "")], "doc_id long, text string")
    rows = dc.search(docs, bench).collect()
    assert {r["doc_id"]: [x["item_id"] for x in r["leaks"]] for r in rows} == {1: [1], 2: [], 3: [], 4: [], 5: []}


@pytest.mark.parametrize("item", [
    "Which town is the capital of France and its largest? Paris", "How many roads must one walk down before noon? 42",
    "Is the sum of two odd numbers always an even one? Answer: yes", "Why? Because the sky scatters blue light most", "zebra quokka",
    "zebra quokka numbat", "zebra quokka numbat wombat dingo",
])
def test_short_questions_and_answers(spark, item):
    bench = spark.createDataFrame([(1, item), (2, "Which planet has rings of ice around it? Saturn of course")], "item_id long, text string")
    filler = " ".join(f"other{k}" for k in range(100))
    short = item.rsplit(" ", 1)[0] if len(item.split()) < 9 else item[: item.rfind("?") + 1]
    docs = spark.createDataFrame([(1, f"{filler} {item} {filler}"), (2, filler), (3, item), (4, f"{filler} {short}")], "doc_id long, text string")
    found = {r["doc_id"]: [x["item_id"] for x in r["leaks"]] for r in dc.search(docs, bench).collect()}
    assert found[1] == found[3] == [1] and found[2] == []
    if "?" in item and len(item) - item.rfind("?") < 15:
        assert found[4] == []
    assert [r["doc_id"] for r in dc.clean(docs, bench).orderBy("doc_id").collect()][:1] == [2]


def test_halves_are_verified_where_they_were_retrieved(spark):
    bench = spark.createDataFrame(
        [(1, "zebra quokka"), (2, "Is the sum of two odd numbers always an even one? yes"), (3, "wombat"),
         (4, "Which of the four great rivers of that valley is longest? The one that flows north")], "item_id long, text string")
    filler = " ".join(f"other{k}" for k in range(20))
    far = " ".join(f"word{k}" for k in range(5_000))
    question, answer = "Which of the four great rivers of that valley is longest?", "The one that flows north"
    docs = spark.createDataFrame([
        (1, f"{filler} quokka {filler} zebra {filler}"), (2, f"Is the sum of two odd numbers always an even one? {far} yes"), (3, f"{filler} wombat {filler}"),
        (4, f"{question} {far} {answer}"), (5, f"{filler} zebra quokka"), (6, f"{far} Is the sum of two odd numbers always an even one? Well, yes {far}"),
        (7, "Wombat!"), (8, f"{far} {question} {filler} {answer} {far}"), (9, f"{answer} {filler} {far} {question}")], "doc_id long, text string")
    found = {r["doc_id"]: [x["item_id"] for x in r["leaks"]] for r in dc.search(docs, bench).collect()}
    assert found == {1: [], 2: [], 3: [], 4: [], 5: [1], 6: [2], 7: [3], 8: [4], 9: []}


def test_words_on_which_polynomials_agree(spark):
    bits = [bin(k).count("1") % 2 for k in range(1024)]
    one, two = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    item = " ".join(f"{one} x{k}" for k in range(10))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, item), (2, " ".join(f"{two} y{k}" for k in range(10)))], "doc_id long, text string")
    assert {r["doc_id"]: len(r["leaks"]) for r in dc.search(docs, bench).collect()} == {1: 1, 2: 0}


def test_a_large_benchmark_needs_little_memory():
    """Items with the frequencies of words that languages have, against many words of that kind."""
    draw = np.random.default_rng(1)
    words = np.array([f"w{k}" for k in range(20_000)])

    def text(count):
        return " ".join(words[np.minimum(draw.zipf(1.1, count) - 1, len(words) - 1)])

    index = dc.Index([(k, text(45)) for k in range(5_000)])
    texts = pa.array([text(5_000) for _ in range(4)])
    tracemalloc.start()
    dc._leaks(index, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20


@pytest.mark.parametrize("shard", [1 << 23, 500])
def test_shards_do_not_matter(spark, sf, shard, monkeypatch):
    monkeypatch.setattr(dc, "SHARD_BYTES", shard)
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").limit(12)
    found = {(r["doc_id"], x["item_id"]) for r in dc.search(docs, bench).collect() for x in r["leaks"]}
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    assert found == {(r["doc_id"], i) for r in docs.collect() for i, t in items if t in r["text"]}


def test_odd_rows(spark, odd_docs, empty_docs):
    bench = spark.createDataFrame([(9, odd_docs.where("doc_id = 1").first()["text"])], "item_id long, text string")
    left = dc.clean(odd_docs, bench)
    assert left.columns == odd_docs.columns
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in left.collect()) == [-1, 2, 3, 4, 5, 6, 8]
    assert dc.clean(empty_docs, bench).collect() == []
    assert dc.clean(odd_docs, bench.where("false")).count() == odd_docs.count()
