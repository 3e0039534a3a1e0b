import collections
import random

import pytest

from pageloom.llm import graph, jaccard


def shingles(text):
    words = (text or "").split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows, similarity=0.8):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = collections.Counter()
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and both >= similarity * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    least = {}
    for k, (doc, _) in enumerate(rows):
        least[find(k)] = min(doc, least.get(find(k), doc))
    return sorted((doc, least[find(k)], links[k]) for k, (doc, _) in enumerate(rows))


def got(df):
    return sorted(tuple(r) for r in df.collect())


def near_copies(draw, count, words, edits):
    base = [f"w{draw.randint(0, 999)}" for _ in range(words)]
    out = []
    for _ in range(count):
        copy = list(base)
        for _ in range(draw.randint(0, edits)):
            copy[draw.randrange(words)] = f"e{draw.randint(0, 10**6)}"
        out.append(" ".join(copy))
    return out


def corpus(seed, big=40):
    draw = random.Random(seed)
    texts = near_copies(draw, big, 300, 5)
    for _ in range(20):
        texts += near_copies(draw, draw.randint(1, 5), draw.randint(3, 200), 3)
    line = " ".join(f"common{k}" for k in range(60))
    texts += [line + " " + " ".join(f"u{draw.randint(0, 10**6)}" for _ in range(40)) for _ in range(30)]
    texts += ["one two", "one two", "one", "", None, texts[0], texts[0]]
    draw.shuffle(texts)
    return list(enumerate(texts))


def test_classes_and_links_as_by_hand(spark):
    rows = corpus(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jaccard.near_duplicates(docs)) == brute(rows)


def test_large_buckets_and_many_blocks(spark, monkeypatch):
    """The ways that production takes for large groups, on small ones."""
    monkeypatch.setattr(jaccard, "SMALL", 6)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 7)
    rows = corpus(2, 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jaccard.near_duplicates(docs)) == brute(rows)


def test_runs_reach_the_recall():
    assert jaccard.runs_for(0.9999, 0.8) > jaccard.runs_for(0.9, 0.8) >= 1
    assert jaccard.runs_for(0.9999, 1.0) == 1


def test_odd_rows(spark, odd_docs, empty_docs):
    rows = got(jaccard.near_duplicates(odd_docs.where("doc_id IS NOT NULL")))
    assert rows == [(1, 1, 2), (2, 2, 0), (3, 3, 0), (4, 4, 0), (5, 5, 1), (6, 5, 1), (7, 1, 2), (7, 1, 2), (8, 8, 0)]
    lost = jaccard.near_duplicates(odd_docs).where("doc_id IS NULL").collect()
    assert [(r["class_id"], r["n_links"]) for r in lost] == [(None, 0)]
    assert jaccard.near_duplicates(empty_docs).collect() == []


def test_low_similarities_are_refused(spark, empty_docs):
    with pytest.raises(ValueError):
        jaccard.near_duplicates(empty_docs, 0.5)


def test_components(spark):
    draw = random.Random(3)
    pairs = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(200)] + [(1_000 + k, 1_001 + k) for k in range(60)] + [(7, 7)]
    parent = {x: x for p in pairs for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    edges = spark.createDataFrame(pairs, "a long, b long")
    found = {r["node"]: r["root"] for r in graph.components(edges, "test").collect()}
    assert all(found.get(x, x) == find(x) for x in parent)


def test_words_on_which_polynomials_agree(spark):
    bits = [bin(k).count("1") % 2 for k in range(1024)]
    one, two = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    rows = [(1, " ".join([one] * 9)), (2, " ".join([two] * 9)), (3, " ".join([one] * 8))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(docs).collect()}
    assert got == {1: (1, 1), 2: (2, 0), 3: (1, 1)}


def test_one_of_each_class_stays(spark, odd_docs):
    base = " ".join(f"w{k}" for k in range(60))
    near = base + " more"
    alone = " ".join(f"v{k}" for k in range(60))
    rows = [(1, base), (2, near), (2, alone), (3, base), (3, None), (4, near + " again"), (4, near + " and again"), (5, ""), (5, ""), (None, base), (None, base), (1, near)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS doc", "2 AS text_hash", "3 AS set", "4 AS held")
    left = jaccard.without_copies(docs)
    assert left.columns == docs.columns
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in left.collect())
    first = [t for d, t in got if d == 1]
    assert len(first) == 1 and first[0] in (base, near)
    assert [x for x in got if x[0] != 1] == [(0, base), (0, base), (2, alone), (3, ""), (5, "")]
    assert jaccard.without_copies(odd_docs).count() == odd_docs.count() - 3
