"""A training corpus from `documents`: low quality, copies, near copies and benchmark passages go, the rest is encoded.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept.  The pipeline has no
SQL form, since the quality classifier is learned; tests hold its operators against brute force one by one, but
not yet the rows of `run()`.

Null and empty texts are one group of copies; an empty table passes through; columns beyond those of
`documents` are kept up to the last stage, which returns ids of tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boundaryspark.llm import bpe, decontaminate, exact_dedup, jaccard_join, quality
from boundaryspark.llm.common import table
from boundaryspark.runtime import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of every text, and the digest of the text that they decode to."""
    encoded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), keep_text=False)
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids",
                          F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))


STAGES = [("quality", quality_stage), ("exact_dedup", exact_dedup_stage), ("near_dedup", near_dedup_stage),
          ("decontaminate", decontaminate_stage), ("bpe", encode_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
