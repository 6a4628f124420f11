"""Boolean operations on polygons: split edges where they meet, keep sides by rule, build rings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from boundaryspark.functions import geometry as G
from boundaryspark.operators import spatial as P
from boundaryspark.operators import topology as T
from boundaryspark.operators.edges import assemble, explode_edges
from boundaryspark.runtime import materialize

GRID_BITS = 40  # the grid of an overlay is the largest coordinate divided by 2^40, far above rounding: less than 0.01 mm on the earth


def overlay_grid(*sides: DataFrame) -> float:
    """Side of the grid that all vertices of an overlay are put on, a power of two, so that the products with it are exact.

    Vertices of both sides that differ by rounding alone would make lines cross where they lie on each other, and rings that do not close.
    """
    far = [e.agg(F.max(F.greatest(*[F.abs(c) for c in T.COORDS]))).first()[0] or 1.0 for e in sides]
    return 2.0 ** (math.ceil(math.log2(max(far))) - GRID_BITS)


def _on_grid(value: Column, grid: float) -> Column:
    return F.rint(value / F.lit(grid)) * F.lit(grid)


def _near_cells(edges: DataFrame, own: str, cells: DataFrame, other: str, cell: float, pairs: DataFrame) -> DataFrame:
    """own, other, no: the edges of each pair that pass through a cell of the other feature."""
    laid = T._laid(edges, cell, "_", [own]).select(own, F.col("_no").alias("no"), "col", "row")
    return laid.join(cells, ["col", "row"]).join(pairs, [own, other], "left_semi").select(own, other, "no").distinct()


def _runs(parts: DataFrame, key: list[str]) -> DataFrame:
    """Number the parts of a ring by runs: between two places where the other outline is met, all parts lie on one side of it."""
    ring = W.partitionBy(*key, "no.poly", "no.ring").orderBy("no.seq", "part")
    before, follows = F.lag("no.seq").over(ring), F.lag("ends").over(ring)
    new = F.col("begins") | F.coalesce(follows, F.lit(True)) | (F.col("no.seq") - before > 1)
    marked = parts.withColumn("_new", new.cast("long"))
    return marked.withColumn("run", F.sum("_new").over(ring)).drop("_new")


def overlay_edges(left_edges: DataFrame, right_edges: DataFrame, pairs: DataFrame, left: str, right: str,
                  how: str, grid: float | None = None) -> DataFrame:
    """Outline edges of intersection, union or difference for each (left, right) pair.

    A pair takes the edges of a feature only in the cells of the other one; all others are outside.  One point tells for all parts
    between two meeting points whether they lie inside.  Vertices and meeting points lie on a grid (`overlay_grid`).
    """
    if how not in ("intersection", "union", "difference"):
        raise ValueError(how)
    key = [left, right]
    grid = grid or overlay_grid(left_edges, right_edges)
    put = lambda edges, own: T.numbered_edges(edges).select(own, "no", *[_on_grid(F.col(c), grid).alias(c) for c in T.COORDS]).filter(
        (F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))
    le, re = materialize(put(left_edges, left), "overlay-left"), materialize(put(right_edges, right), "overlay-right")
    pairs = materialize(pairs.select(*key).distinct(), "overlay-pairs")
    cell = min(P.choose_cell(le, [left]), P.choose_cell(re, [right]), key=P.area_of)
    l_caps, r_caps = (materialize(P.edge_caps(e, [i], cell), "overlay-caps") for e, i in ((le, left), (re, right)))
    l_cells, r_cells = (caps.select(i, "col", "row").distinct() for caps, i in ((l_caps, left), (r_caps, right)))
    near = T.near_pairs(le, re, T.edge_cell(le), [left], [right]).join(pairs, key, "left_semi")
    placed = F.transform("points", lambda p: G.xy(_on_grid(p["x"], grid), _on_grid(p["y"], grid))).alias("points")
    met = materialize(T.meeting_points(near).select(*key, "a_no", "b_no", placed).distinct(), "overlay-points")

    def parts(edges: DataFrame, own: str, other: str, cells: DataFrame, number: str) -> tuple[DataFrame, DataFrame]:
        """Parts of the edges that are near the other feature, and the edges that aren't."""
        close = materialize(_near_cells(edges, own, cells, other, cell, pairs).unionByName(
            met.select(*key, F.col(number).alias("no"))).distinct(), "overlay-near")
        mine = edges.join(close, [own, "no"])
        cut = T.split_edges(mine, met.select(*key, F.col(number).alias("no"), "points"), key, places=True)
        return T.with_canonical(_runs(cut, key)), close
    (a, a_close), (b, b_close) = parts(le, left, right, r_cells, "a_no"), parts(re, right, left, l_cells, "b_no")
    # the parts of both sides meet once: how often does the right side pass an edge ahead and back, and does the left one?
    at = W.partitionBy(*key, *T.EDGE)
    passed = lambda test: F.coalesce(F.max(test).over(at), F.lit(False))
    met_by = {"_ahead": passed((F.col("_side") == 1) & (F.col("dir") > 0)), "_back": passed((F.col("_side") == 1) & (F.col("dir") < 0)), "_left": passed(F.col("_side") == 0)}
    both = a.withColumn("_side", F.lit(0)).unionByName(b.withColumn("_side", F.lit(1))).withColumns(met_by)
    both = materialize(both.select(*key, "no", "run", *T.COORDS, "dir", "_side", *met_by), "overlay-parts")
    mine = both.filter("_side = 0")
    same, opposite = mine.filter("if(dir > 0, _ahead, _back)"), mine.filter("if(dir > 0, _back, _ahead)")
    a_only, b_only = mine.filter("not _ahead and not _back"), both.filter("_side = 1 and not _left")

    def inside(edges: DataFrame, caps: DataFrame, covering: str, kind: str) -> DataFrame:
        run = [*key, "poly", "ring", "run"]
        named = edges.select(*key, F.col("no.poly").alias("poly"), F.col("no.ring").alias("ring"), "run", *T.COORDS)
        # the middle of the longest part of a run is farthest from its ends
        size = G.planar_length(*[F.col(c) for c in T.COORDS])
        points = named.groupBy(*run).agg(F.max_by(F.struct(*T.COORDS), F.struct(size, *T.COORDS)).alias("_e")).select(*run, "_e.*")
        points = materialize(T.middles(points).select(*run, "x", "y"), "overlay-runs")
        covered = P.cover_by_caps(points, caps, run, [covering], cell, shared=[covering]).select(*run)
        return named.join(covered, run, kind)

    far = lambda edges, own, close: edges.join(pairs, own).join(close, [*key, "no"], "left_anti")
    flip = lambda df: df.select(*key, F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    if how == "intersection":
        found = [inside(a_only, r_caps, right, "left_semi"), inside(b_only, l_caps, left, "left_semi"), same]
    elif how == "union":
        found = [inside(a_only, r_caps, right, "left_anti"), inside(b_only, l_caps, left, "left_anti"), same, far(le, left, a_close), far(re, right, b_close)]
    else:
        found = [inside(a_only, r_caps, right, "left_anti"), flip(inside(b_only, l_caps, left, "left_semi")), opposite, far(le, left, a_close)]
    out = found[0].select(*key, *T.COORDS)
    for more in found[1:]:
        out = out.unionByName(more.select(*key, *T.COORDS))
    return out


def overlay(left: DataFrame, right: DataFrame, left_id: str, right_id: str, how: str = "intersection",
            pairs: DataFrame | None = None) -> DataFrame:
    """left_id, right_id, geom of the boolean operation for each pair; by default pairs whose envelopes touch."""
    from boundaryspark.operators.layers import with_bounds
    if pairs is None:
        boxes = with_bounds(left)
        size = tuple(s or 1.0 for s in boxes.agg(F.avg(F.col("xmax") - F.col("xmin")), F.avg(F.col("ymax") - F.col("ymin"))).first())
        pairs = P.bbox_join(boxes, with_bounds(right), [left_id], [right_id], size)
    key = [left_id, right_id]
    left_edges, right_edges = explode_edges(left, [left_id]), explode_edges(right, [right_id])
    grid = overlay_grid(left_edges, right_edges)
    out = assemble(T.stitch_rings(overlay_edges(left_edges, right_edges, pairs, left_id, right_id, how, grid), key), key)
    # parts thinner than the grid can tell are rounding
    thick = F.filter("geom", lambda p: F.abs(G.ring_area(p[0])) > G.ring_length(p[0]) * F.lit(4 * grid))
    return out.withColumn("geom", thick).filter(F.size("geom") > 0)


def clip(features: DataFrame, mask: DataFrame, ids: str, mask_id: str, pairs: DataFrame | None = None) -> DataFrame:
    """Features cut to a mask; `pairs` names the mask of each feature where it is known."""
    return overlay(features, mask, ids, mask_id, "intersection", pairs)


def repair(features: DataFrame, ids: list[str]) -> DataFrame:
    """Rebuild features by the even-odd rule after cutting their edges at their own crossings.

    Bow-ties become two parts, as with a zero-width buffer by the even-odd rule; a buffer that
    follows the winding rule can differ on overlapping parts.
    """
    edges = materialize(T.numbered_edges(explode_edges(features, ids)).select(*ids, "no", *T.COORDS), "repair-edges")
    noded = materialize(T.with_canonical(T.node_edges(edges, ids)), "repair-noded")
    odd = noded.groupBy(*ids, *T.EDGE).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") % 2 == 1).select(
        *ids, F.col("ax").alias("x1"), F.col("ay").alias("y1"), F.col("bx").alias("x2"), F.col("by").alias("y2"))
    odd = materialize(odd, "repair-odd")
    points = T.middles(odd, 1e-6)
    at = [*ids, *T.COORDS]
    cover = P.point_cover(points, edges, at, ids, shared=ids).filter(F.abs(F.col("cover")) % 2 == 1).drop("cover")
    inner_left = odd.join(cover, at, "left_semi")
    inner_right = odd.join(cover, at, "left_anti").select(
        *ids, F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    return assemble(T.stitch_rings(inner_left.select(*at).unionByName(inner_right), ids), ids)


def repair_report(features: DataFrame, repaired: DataFrame, ids: list[str]) -> DataFrame:
    """Area of each feature before and after the repair, in km2."""
    area = lambda df, name: df.select(*ids, (G.planar_area(G.project_equal_area("geom")) / 1e6).alias(name))
    return area(features, "old_area_km2").join(area(repaired, "new_area_km2"), ids, "left")
