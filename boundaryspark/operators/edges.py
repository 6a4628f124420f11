"""Vertices and edges of features as rows: the working form of all joins on geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACE = ["poly", "ring", "seq"]


def explode_vertices(features: DataFrame, ids: list[str]) -> DataFrame:
    """ids, poly, ring, seq, x, y."""
    polygons = features.select(*ids, F.posexplode("geom").alias("poly", "_polygon"))
    rings = polygons.select(*ids, "poly", F.posexplode("_polygon").alias("ring", "_ring"))
    return rings.select(*ids, "poly", "ring", F.posexplode("_ring").alias("seq", "_v")).select(
        *ids, *PLACE, F.col("_v.x").alias("x"), F.col("_v.y").alias("y"))


def explode_edges(features: DataFrame, ids: list[str]) -> DataFrame:
    """ids, poly, ring, seq, x1, y1, x2, y2; made inside each row, without a shuffle."""
    polygons = features.select(*ids, F.posexplode("geom").alias("poly", "_polygon"))
    rings = polygons.select(*ids, "poly", F.posexplode("_polygon").alias("ring", "_ring"))
    n = F.greatest(F.size("_ring") - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice("_ring", F.lit(1), n).alias("a"), F.slice("_ring", F.lit(2), n).alias("b"))
    return rings.select(*ids, "poly", "ring", F.posexplode(pairs).alias("seq", "_e")).select(
        *ids, *PLACE, F.col("_e.a.x").alias("x1"), F.col("_e.a.y").alias("y1"),
        F.col("_e.b.x").alias("x2"), F.col("_e.b.y").alias("y2"))


def assemble(vertices: DataFrame, ids: list[str]) -> DataFrame:
    """Vertex rows back to nested geometry; a group is one ring, polygon or feature, never a layer."""
    def ordered(key: str, value: str):
        return F.transform(F.array_sort(F.collect_list(F.struct(F.col(key), F.col(value)))),
                           lambda s: s[value])

    points = vertices.withColumn("_v", F.struct("x", "y"))
    rings = points.groupBy(*ids, "poly", "ring").agg(ordered("seq", "_v").alias("_ring"))
    polygons = rings.groupBy(*ids, "poly").agg(ordered("ring", "_ring").alias("_polygon"))
    return polygons.groupBy(*ids).agg(ordered("poly", "_polygon").alias("geom"))
