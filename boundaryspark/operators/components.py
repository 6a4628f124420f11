"""Connected components of links between numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boundaryspark.runtime import materialize


def connected_components(edges: DataFrame, low: str = "a", high: str = "b") -> DataFrame:
    """(node, component): the least node that links reach, for every node of an edge.

    Alternating large-star and small-star steps.  Each step is one shuffle on node keys with map-side
    minima; a node of very many links is only a group of an aggregate and one side of an equi-join
    that adaptive execution can split.  Every round is written to the shared folder, which cuts lineage.
    """
    edges = edges.select(F.least(low, high).alias("u"), F.greatest(low, high).alias("v")).where("u < v").distinct()
    edges = materialize(edges, "cc")
    total = None
    while True:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("x"), F.col("m"))
        small = small.where("x <> m").select(F.col("m").alias("u"), F.col("x").alias("v"))
        small = small.unionAll(least.select(F.col("m").alias("u"), F.col("u").alias("v"))).distinct()
        edges = materialize(small, "cc")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == total:
            break
        total = tuple(state)
    roots = edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionAll(roots)
