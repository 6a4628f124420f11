"""Vertices that lie within a tolerance of each other become one, wherever a grid line runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boundaryspark.functions import geometry as G
from boundaryspark.operators.components import connected_components
from boundaryspark.operators.edges import assemble, explode_vertices
from boundaryspark.runtime import broadcast_if_small, dealt_by_key, materialize

#: Half of the neighbours of a cell whose side is tolerance / sqrt(2): those that can hold a point within the tolerance, each pair once.
_AHEAD = [(i, j) for i in range(-2, 3) for j in range(3) if (j > 0 or i > 0) and abs(i) + j < 4]
FEATURES_PER_TASK = 20_000


def near_vertices(vertices: DataFrame, layer: list[str], tolerance: float = G.TOLERANCE) -> DataFrame:
    """layer, x, y, to_x, to_y of the vertices that move.

    Vertices are linked if their distance is at most the tolerance, and chains of links are one cluster, which goes to its most used
    vertex, then the least.  Cells are so small that all vertices of one belong together, so no pairs are formed inside a cell and
    cells are the nodes whose components are looked for.  A vertex is sent to those cells only that begin within the tolerance.
    """
    side = tolerance / 2 ** 0.5
    at = lambda c: F.floor(F.col(c) / F.lit(side)).cast("long")
    used = vertices.groupBy(*layer, "x", "y").agg(F.count(F.lit(1)).alias("n"))
    used = materialize(used.select(*layer, "x", "y", "n", at("x").alias("i"), at("y").alias("j")), "snap-vertices")
    cell = [*layer, "i", "j"]
    node = lambda i, j: F.xxhash64(*layer, i, j)
    steps = F.array(*[F.struct(F.lit(i).alias("di"), F.lit(j).alias("dj")) for i, j in _AHEAD])
    # from a vertex to the near side of a cell, in sides; coordinates are rounded when divided
    gap = lambda c, own, step: F.when(F.col(step) > 0, F.col(step) - (F.col(c) / F.lit(side) - F.col(own))).when(
        F.col(step) < 0, F.col(c) / F.lit(side) - F.col(own) - F.col(step) - 1).otherwise(0.0)
    gap_x, gap_y = gap("x", "i0", "di"), gap("y", "j0", "dj")
    slack = F.lit(1e-6) + (F.abs("x") + F.abs("y")) / F.lit(side) * F.lit(1e-14)
    begun = used.select(*layer, "x", "y", F.col("i").alias("i0"), F.col("j").alias("j0"), F.inline(steps)).filter(gap_x * gap_x + gap_y * gap_y <= F.lit(2.0) + slack)
    ahead = begun.select(
        *layer, F.col("x").alias("x0"), F.col("y").alias("y0"), "i0", "j0", (F.col("i0") + F.col("di")).alias("i"), (F.col("j0") + F.col("dj")).alias("j"))
    dx, dy = F.col("x") - F.col("x0"), F.col("y") - F.col("y0")
    links = ahead.join(used, cell).filter(dx * dx + dy * dy <= tolerance * tolerance).select(
        node(F.col("i0"), F.col("j0")).alias("a"), node(F.col("i"), F.col("j")).alias("b")).distinct()
    clusters = connected_components(links).withColumnRenamed("node", "_node")
    grouped = used.withColumn("_node", node(F.col("i"), F.col("j"))).join(clusters, "_node", "left").withColumn(
        "_cluster", F.coalesce("component", "_node"))
    grouped = materialize(grouped.select(*layer, "x", "y", "n", "_cluster"), "snap-clusters")
    best = grouped.groupBy(*layer, "_cluster").agg(F.min_by(F.struct("x", "y"), F.struct(-F.col("n"), F.col("x"), F.col("y"))).alias("_to"), F.count(F.lit(1)).alias("_n"))
    moved = grouped.join(best.filter("_n > 1"), [*layer, "_cluster"])
    return moved.filter((F.col("x") != F.col("_to.x")) | (F.col("y") != F.col("_to.y"))).select(
        *layer, "x", "y", F.col("_to.x").alias("to_x"), F.col("_to.y").alias("to_y"))


def snap_near(features: DataFrame, ids: list[str], layer: list[str], tolerance: float = G.TOLERANCE) -> DataFrame:
    """Features whose near vertices are joined within each layer, cleaned; shared borders stay shared, since equal vertices move alike.

    Features none of whose vertices move are not taken apart.
    """
    key = list(dict.fromkeys([*layer, *ids]))
    # written in many files, as later reads are cut by file
    features = materialize(dealt_by_key(features, key, FEATURES_PER_TASK), "snap-features")
    vertices = materialize(explode_vertices(features, key), "snap-points")
    moves = materialize(near_vertices(vertices, layer, tolerance), "snap-moves")
    placed = vertices.join(broadcast_if_small(moves), [*layer, "x", "y"], "left")
    changed = materialize(placed.filter(F.col("to_x").isNotNull()).select(*key).distinct(), "snap-changed")
    pick = lambda to, own: F.coalesce(F.col(to), F.col(own)).alias(own)
    rows = placed.join(changed, key, "left_semi").select(*key, "poly", "ring", "seq", pick("to_x", "x"), pick("to_y", "y"))
    rebuilt = assemble(rows, key).withColumnRenamed("geom", "_moved")
    others = [c for c in features.columns if c != "geom" and c not in key]
    columns: list[str | Column] = [*key, *others, G.clean_rings(F.coalesce("_moved", "geom")).alias("geom")]
    return features.join(rebuilt, key, "left").select(*columns)
