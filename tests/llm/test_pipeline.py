import collections
import hashlib

import corpus_pipeline
from pageloom.llm import bpe


def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf)
        rows = docs.collect()
        yield name, before, rows
        docs = spark.createDataFrame(rows, docs.schema)


def test_each_stage_on_its_own_input(spark):
    sf = "/root/testdata/sf0.01"
    benchmark = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    columns = spark.read.parquet(f"{sf}/documents.parquet").columns
    for name, before, rows in stages(spark, sf):
        texts = {r["doc_id"]: r["text"] for r in before.collect()}
        kept = {r["doc_id"] for r in rows}
        assert len(rows) == len(kept) and kept <= set(texts)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert list(rows[0].asDict()) == columns
        if name == "n-gram jaccard join":
            sets = {d: frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for d, t in texts.items() if (w := t.split())}
            assert kept == brute_first(sets)
        elif name == "benchmark decontamination":
            assert kept == {d for d, t in texts.items() if not any(b in t for b in benchmark)}
        elif name == "secret scans":
            changed = [r for r in rows if r["text"] != texts[r["doc_id"]]]
            assert changed and all("[SECRET]" in r["text"] and r["n_chars"] == len(r["text"]) for r in changed) and kept == set(texts)
        elif name.startswith("bpe"):
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(bpe.tokenizer_path())
            for r in rows:
                ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
                assert r["n_tokens"] == len(ids)
                assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def brute_first(sets):
    having = collections.defaultdict(list)
    for d, s in sets.items():
        for x in s:
            having[x].append(d)
    shared = collections.Counter()
    for docs in having.values():
        for i, a in enumerate(docs):
            for b in docs[:i]:
                shared[min(a, b), max(a, b)] += 1
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in shared.items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {d for d in sets if find(d) == d}


def test_odd_rows_pass_every_stage(spark, odd_docs, empty_docs):
    sf = "/root/testdata/sf0.001"
    for start in (odd_docs, empty_docs):
        docs = start.select("doc_id", "text", "lang", "source", "n_chars")
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, docs, sf)
            docs = spark.createDataFrame(rows.collect(), rows.schema)
        assert docs.count() == (0 if start is empty_docs else 7)


def test_run_is_the_stages(spark, sf):
    rows = corpus_pipeline.run(spark, sf)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and rows.count() > 0
