"""Domain names as topic words, with and without a sub-word vocabulary."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.operators.joins import skew_join


def _accents() -> tuple[str, str]:
    """Accented Latin letters and their base letters, by Unicode decomposition."""
    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in range(0xC0, 0x250)]
    changed = [(a, b) for a, b in pairs if a != b]
    return "".join(a for a, _ in changed), "".join(b for _, b in changed)


def _words(domain: Column) -> Column:
    """Lower-case words without accents: cut at blanks, punctuation and CJK characters."""
    plain = F.translate(F.lower(domain), *_accents())
    return F.regexp_extract_all(plain, F.lit(r"[^\s\p{Punct}\p{P}\p{IsHan}\p{Cc}]+"), F.lit(0))


def domain_words(domain: Column) -> Column:
    """Words of a domain made of plain letters only; needs no vocabulary."""
    return F.regexp_extract_all(F.lower(domain), F.lit(r"\b[a-z]+\b"), F.lit(0))


def word_heads(words: DataFrame, vocabulary: DataFrame, max_word: int | None = None) -> DataFrame:
    """First vocabulary piece of each distinct ``word``, by greedy longest match.

    ``vocabulary`` has one ``token`` per row; tokens after the first piece of a word
    start with ``##``. A word that cannot be covered to its end has no pieces and is
    left out. All pieces of a word that are in the vocabulary come from one
    equi-join; the greedy walk over them is an expression on the positions of the word.
    Words longer than ``max_word``, if one is given, count as unknown.
    """
    tokens = vocabulary.select("token").distinct()
    longest = F.coalesce(tokens.agg(F.max(F.length("token"))).scalar(), F.lit(0))
    distinct = words.select("word").distinct().where(F.length("word") >= 1)
    if max_word is not None:
        distinct = distinct.where(F.length("word") <= max_word)
    size = F.length("word")
    starts = distinct.withColumn("_start", F.explode(F.sequence(F.lit(0), size - 1)))
    ends = starts.withColumn(
        "_end", F.explode(F.sequence(F.col("_start") + 1, F.least(size, F.col("_start") + longest)))
    )
    piece = F.substring("word", F.col("_start") + 1, F.col("_end") - F.col("_start"))
    pieces = ends.withColumn("token", F.when(F.col("_start") == 0, piece).otherwise(F.concat(F.lit("##"), piece)))
    known = skew_join(pieces, tokens, ["token"], "left_semi")
    reach = known.groupBy("word", "_start").agg(F.max("_end").alias("_end"))
    jumps = reach.groupBy("word").agg(
        F.map_from_entries(F.collect_list(F.struct("_start", "_end"))).alias("_jumps")
    )
    # Position -1 means stuck; otherwise the walk stands where the next piece begins.
    last = F.aggregate(
        F.sequence(F.lit(0), size - 1),
        F.lit(0),
        lambda at, i: F.when(at == i, F.coalesce(F.try_element_at("_jumps", i), F.lit(-1))).otherwise(at),
    )
    head_end = F.try_element_at("_jumps", F.lit(0))
    return jumps.where(last == size).select("word", F.substring("word", F.lit(1), head_end).alias("head"))


def domain_topics(pages: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """``pages`` with ``domain_topics``: the plain-letter pieces that start a word.

    Without a vocabulary every plain word is a topic. With one, words are looked up
    once each, and each distinct domain is put together once.
    """
    if vocabulary is None:
        return pages.withColumn("domain_topics", domain_words(F.col("domain")))
    domains = pages.select("domain").distinct()
    placed = domains.select("domain", F.posexplode(_words(F.col("domain"))).alias("_pos", "word"))
    heads = word_heads(placed, vocabulary).where(F.col("head").rlike(r"\A[a-z]+\z"))
    found = skew_join(placed, heads, ["word"])
    # The length of the domain itself bounds its list.
    topics = found.groupBy("domain").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", "head"))), lambda t: t["head"]).alias("domain_topics")
    )
    joined = skew_join(pages, topics, ["domain"], "left")
    none = F.array().cast("array<string>")
    return joined.withColumn("domain_topics", F.coalesce("domain_topics", none)).select(
        *pages.columns, "domain_topics"
    )
