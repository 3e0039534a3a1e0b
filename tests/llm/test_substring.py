import random
import re

import numpy as np
import pyarrow as pa

from pageloom.llm import substring

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def brute(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    first = {}
    for (doc, _), w in zip(rows, words):
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if doc is not None:
                first[key] = min(doc, first.get(key, doc))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[k : k + window])] < doc:
                gone[k : k + window] = [True] * window
        out.append((-1 if doc is None else doc, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out)


def got(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect())


def test_random_texts_with_shared_passages(spark):
    draw = random.Random(5)
    shared = [[draw.choice("abcdefgh") * draw.randint(1, 3) for _ in range(draw.randint(10, 40))] for _ in range(6)]
    rows = []
    for doc in range(60):
        words = []
        for _ in range(draw.randint(0, 6)):
            words += draw.choice(shared)[draw.randint(0, 5) :] if draw.random() < 0.6 else [draw.choice("klmnopq") + str(draw.randint(0, 60)) for _ in range(draw.randint(1, 20))]
        rows.append((doc, draw.choice([" ", "\n", " \t "]).join(words)))
    rows += [(60, rows[3][1]), (61, " a b é ü " * 20), (62, "a b é ü " * 9), (63, "x " * 500), (64, "x " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(substring.remove_repeats(docs)) == brute(rows, substring.WINDOW)
    assert got(substring.remove_repeats(docs, 5)) == brute(rows, 5)
    assert got(substring.remove_repeats(docs, 3)) == brute(rows, 3)


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(substring.remove_repeats(docs)) == brute(rows, substring.WINDOW)


def test_odd_rows(spark, odd_docs, empty_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    assert got(substring.remove_repeats(odd_docs)) == brute(rows, substring.WINDOW)
    assert substring.remove_repeats(empty_docs).collect() == []


def thue_morse():
    """Two words of 1,024 letters on which every polynomial hash modulo a power of two agrees."""
    bits = [bin(k).count("1") % 2 for k in range(1024)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_on_which_polynomials_agree(spark):
    one, two = thue_morse()
    filler = [f"w{k}" for k in range(12)]
    rows = [(1, " ".join([*filler, one])), (2, " ".join([*filler, two])), (3, " ".join([*filler, one]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(substring.remove_repeats(docs)) == brute(rows, substring.WINDOW)
    assert {r["doc_id"]: r["n_removed"] for r in substring.remove_repeats(docs).collect()} == {1: 0, 2: 0, 3: 13}


def test_names_only_bring_together(monkeypatch):
    """If all names were equal, the digests of paths would still be those of their words."""
    texts = pa.array([" ".join(f"w{k}" for k in range(40)), " ".join(f"w{k}" for k in range(1, 41)), " ".join(f"w{k}" for k in range(40))])
    monkeypatch.setattr(substring, "windows", lambda hashes, size: np.zeros(max(0, len(hashes) - size + 1), dtype=np.uint64))
    edges = substring._Edges(texts, 13)
    first, path = edges.paths()
    assert len(first) == 3 and (path[0] == path[2]).all() and (path[0] != path[1]).any()
    digests = edges.digests(np.arange(len(edges.at)))
    assert (digests[1] == digests[28]).all() and (digests[0] == digests[56]).all() and len(np.unique(digests, axis=0)) == 29
