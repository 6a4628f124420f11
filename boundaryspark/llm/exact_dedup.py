"""Exact deduplication against a persistent digest index, DataFrame operations only.

Method: the index is a table bucketed and sorted by digest.  A batch is digested once into a written
table.  Inside a batch one aggregate per digest, combined before the shuffle, picks the row
that could stay, so a text that holds a third of all rows is no hot group.  These go to the index, at first an empty one, in a
sort-merge anti-join, and what is new is appended as further sorted buckets.  Which rows stay is read back from the
index; the join of rows with these decisions is one that adaptive execution splits.

Texts are equal when equal after all white space of [\\x20\\x09-\\x0D] is deleted; a null text counts as
empty.  The row of most code points stays, then the smallest id, then the first of rows alike; a null id
comes after all others.  A text that the index already holds is dropped whatever its length.  Other
columns are kept; results replace columns of the same names.  An empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boundaryspark.llm.common import table
from boundaryspark.llm.registry import query
from boundaryspark.runtime import materialize

BUCKETS = 64


def digest_of(text: str):
    return F.sha2(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "[\\x20\\x09-\\x0D]+", ""), 256)


class DigestIndex:
    """A table (text_sha256, keep_id, batch, keep_row) in the warehouse, bucketed and sorted by digest.

    `batch` and `keep_row` tell which row of which batch brought the digest.
    """

    SCHEMA = "text_sha256 string, keep_id long, batch string, keep_row long"

    def __init__(self, spark: SparkSession, name: str, buckets: int = BUCKETS) -> None:
        self.spark, self.name, self.buckets = spark, name, buckets

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        if not self.exists():
            self.append(self.spark.range(0).selectExpr(*[f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in self.SCHEMA.split(", ")]))
        return self.spark.table(self.name)

    def unseen(self, digests: DataFrame) -> DataFrame:
        """Rows whose digest the index lacks."""
        return digests.hint("merge").join(self.read().select("text_sha256").hint("merge"), "text_sha256", "left_anti")

    def append(self, new: DataFrame) -> None:
        columns = [f"cast({c.split()[0]} as {c.split()[1]}) as {c.split()[0]}" for c in self.SCHEMA.split(", ")]
        (new.selectExpr(*columns).repartition(self.buckets, "text_sha256").write.mode("append")
         .bucketBy(self.buckets, "text_sha256").sortBy("text_sha256").saveAsTable(self.name))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _add_batch(rows: DataFrame, index: DigestIndex) -> tuple[DataFrame, str]:
    """Groups of a written batch (doc_id, text_sha256, _length, _row); digests that the index lacks are appended to it."""
    order = F.struct(-F.col("_length"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))
    groups = rows.groupBy("text_sha256").agg(F.min_by(F.struct("doc_id", "_row", "_length"), order).alias("_best"), F.count(F.lit(1)).alias("group_size"))
    groups = materialize(groups.select("text_sha256", "group_size", F.col("_best.doc_id").alias("keep_id"), F.col("_best._row").alias("keep_row"),
                                       F.col("_best._length").alias("_length")), "groups")
    batch = uuid.uuid4().hex
    index.append(index.unseen(groups).withColumn("batch", F.lit(batch)))
    return groups, batch


def _digests(df: DataFrame, doc_id: str, text: str) -> list:
    return [F.col(doc_id).alias("doc_id"), digest_of(text).alias("text_sha256"), F.length(F.coalesce(F.col(text), F.lit(""))).alias("_length")]


def decide(df: DataFrame, index: DigestIndex, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `df`: id, digest, the id that stays, the group's size and whether this row stays.

    The digests that the index lacks are appended to it, and what stays is read back from it.
    """
    rows = materialize(df.select(*_digests(df, doc_id, text)).withColumn("_row", F.monotonically_increasing_id()), "digests")
    groups, batch = _add_batch(rows, index)
    held = groups.select("text_sha256", "group_size").hint("merge").join(index.read().hint("merge"), "text_sha256")
    held = materialize(held.select("text_sha256", "group_size", "keep_id", F.when(F.col("batch") == batch, F.col("keep_row")).alias("keep_row")), "held")
    out = rows.hint("merge").join(held, "text_sha256")
    return out.select("doc_id", "keep_id", "group_size", F.coalesce(F.col("_row") == F.col("keep_row"), F.lit(False)).alias("kept"), "text_sha256")


def _fresh_index(spark: SparkSession) -> DigestIndex:
    return DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}")


def keep_first(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `df` that stay, with all their columns, judged within `df` alone.  Texts are moved once, in the last join."""
    rows = materialize(df.select(*_digests(df, doc_id, text)).withColumn("_row", F.monotonically_increasing_id()), "digests")
    index = _fresh_index(df.sparkSession)
    try:
        groups, batch = _add_batch(rows, index)
        brought = index.read().where(F.col("batch") == batch).select("text_sha256")
        kept = groups.hint("merge").join(brought.hint("merge"), "text_sha256", "left_semi")
        kept = materialize(kept.select(F.col("keep_id").alias("_id"), F.col("text_sha256").alias("_kept"), F.col("_length").alias("_size")), "kept")
    finally:
        index.drop()
    same = (F.col("doc_id").eqNullSafe(F.col("_id"))) & (F.col("text_sha256") == F.col("_kept")) & (F.col("_length") == F.col("_size"))
    alike = rows.groupBy("text_sha256", "doc_id", "_length").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = not alike.join(kept, same, "left_semi").isEmpty()
    found = df.withColumns({"_digest": digest_of(text), "_n": F.length(F.coalesce(F.col(text), F.lit("")))})
    found = found.join(kept.hint("merge"), found[doc_id].eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_kept")) & (F.col("_n") == F.col("_size")), "left_semi")
    # of rows alike in id and text one stays
    return (found.dropDuplicates([doc_id, "_digest"]) if repeated else found).drop("_digest", "_n")


OP7_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256,
    length(coalesce(text, '')) AS n FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
"""


@query("op7_exact_dedup", OP7_SQL)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _fresh_index(spark)
    try:
        return decide(table(spark, sf_dir, "documents").select("doc_id", "text"), index)
    finally:
        index.drop()
