"""Importing the operator modules fills the registry."""

from boundaryspark.llm import (  # noqa: F401
    bpe, conversation_trie, decontaminate, exact_dedup, html_text, jaccard_join, line_dedup, phrases, quality, repeats, secret_scan, urls, warc)
from boundaryspark.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
