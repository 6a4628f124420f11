"""Metadata documents of published layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boundaryspark.schema import LAYER_METADATA


def read_layer_metadata(spark: SparkSession, root: str, products: list[str], pattern: str = "*metaData.json") -> tuple[DataFrame, DataFrame]:
    """Metadata of folders with exactly one document, and the folders that have several.

    The product is the one whose name is in the path; documents outside any product are ignored.
    """
    docs = spark.read.schema(LAYER_METADATA).option("recursiveFileLookup", "true").option(
        "pathGlobFilter", pattern).option("multiLine", "true").json(root)
    placed = docs.select("*", F.col("_metadata.file_path").alias("path")).withColumn("folder", F.regexp_replace("path", "/[^/]*$", "")) \
        .withColumn("product", F.coalesce(*[F.when(F.col("path").contains(p), F.lit(p)) for p in products])) \
        .filter(F.col("product").isNotNull())
    counts = placed.groupBy("folder").agg(F.count(F.lit(1)).alias("documents"))
    single = placed.join(counts.filter("documents = 1").select("folder"), "folder", "left_semi")
    return single, counts.filter("documents > 1")
