import random

import pytest

from pageloom.llm import bpe


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(bpe.tokenizer_path())
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def coder():
    with open(bpe.tokenizer_path(), encoding="utf-8") as f:
        return bpe.Coder(bpe.Merges(f.read()))


def same(coder, library, texts):
    ids, decoded = coder.encode(texts)
    for text, i, d in zip(texts, ids.to_pylist(), decoded.to_pylist()):
        want = library.encode(text, add_special_tokens=False).ids
        assert i == want, text
        assert d == library.decode(want, skip_special_tokens=False), text


def test_random_letters(coder, library):
    draw = random.Random(1)
    letters = "abcdehilnorst  '.,!?ÀéßΣσςİıſK　  \u0085\x1c\x1d\x1f\x0b\t\n0１२½😀👨‍👩‍👧ﬁΑ̈́가각é<|endoftext|>"
    same(coder, library, ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(2_000)])


def test_concatenated_tokens_fail_the_check_or_pass_it_rightly(coder, library):
    draw = random.Random(2)
    vocab = [s.replace(bpe.WORD_END, "") for s in coder.merges.strings[512:40_000]]
    same(coder, library, ["".join(draw.choice(vocab) for _ in range(draw.randint(1, 4))) for _ in range(3_000)])


@pytest.mark.parametrize("text", ["", "a" * 3_000, "ab" * 500, "<|startoftext|>hello<|endoftext|> x <|ENDOFTEXT|>", "it's we'll I'M o'd", "hahahaha" * 40])
def test_edges(coder, library, text):
    same(coder, library, [text])


def test_forgetting_changes_nothing(coder, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 3)
    same(coder, library, ["one two three four five"])
    same(coder, library, ["six seven one two"])


def test_rows_match_the_library(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = bpe.encode(docs, bpe.tokenizer_path()).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["ids"] == library.encode(texts[r["doc_id"]], add_special_tokens=False).ids


def test_odd_rows(spark, odd_docs, empty_docs):
    rows = bpe.encode(odd_docs, bpe.tokenizer_path()).collect()
    assert len(rows) == odd_docs.count()
    assert [(r["ids"], r["decoded"]) for r in rows if r["doc_id"] in (2, 3, 4)] == [([], "")] * 3
    assert bpe.digest(bpe.encode(empty_docs, bpe.tokenizer_path())).collect() == []


def test_every_code_point(library):
    """Between letters, doubled, and with marks on both sides, all at once: as the library has it."""
    coder = bpe.Coder(bpe.Merges(open(bpe.tokenizer_path(), encoding="utf-8").read()))
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x34000 or c % 101 == 0 or 0xE0000 <= c < 0xE0200)]
    for low in range(0, len(points), 2_000):
        some = [chr(c) for c in points[low : low + 2_000]]
        texts = [f"a{c}b {c}{c} 1{c}2 x\u0301{c}\u0316 y\u0316{c}\u0301" for c in some]
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        got = coder.encode(texts)[0].to_pylist()
        assert got == want, [hex(ord(c)) for c, g, w in zip(some, got, want) if g != w]
    pair = "\U00011935\U00011930"
    assert coder.encode([pair])[0].to_pylist() == [library.encode(pair, add_special_tokens=False).ids]
