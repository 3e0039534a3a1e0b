"""All queries of this subpackage; importing a module enters its queries."""

from pageloom.llm import ann, bpe, decontaminate, extract, jaccard, langid, licenses, negatives, personal, secret_scan, substring, toxicity, trie  # noqa: F401
from pageloom.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
