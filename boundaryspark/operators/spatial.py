"""Spatial joins on a grid: envelopes, points in polygons, overlap areas.

A polygon is cut into *caps*: straight pieces over an x-range inside one grid cell, each with a
height above the cell floor at both ends and a weight, such that summing the weights of the caps
above a point tells how often the polygon covers it.  Cells wholly inside a polygon are one flat
cap.  Everything after the cut is an equality join on the cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from boundaryspark.functions import geometry as G
from boundaryspark.operators.cells import Cell, meet_in_cells, sides
from boundaryspark.runtime import materialize

#: Edges of a cell of features with very many.
EDGES_PER_CELL = 8


def choose_cell(edges: DataFrame, ids: list[str], times: Column | int = 1) -> tuple[float, float]:
    """Width and height of a cell, in the proportions of an average edge; one aggregate row comes to the driver.

    All features together cover about as many cells as there are features, or as many as their edges fill, and no cell is narrower or lower than
    an average edge.  So the pieces of all edges, and the cells inside features, are in proportion to the edges, also for long thin features.
    """
    row = edges.agg(
        F.abs(F.sum((F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) * times)).alias("area2"),
        F.approx_count_distinct(F.struct(*ids)).alias("n"), F.count(F.lit(1)).alias("edges"),
        F.avg(F.abs(F.col("x2") - F.col("x1"))).alias("w"), F.avg(F.abs(F.col("y2") - F.col("y1"))).alias("h"),
        F.max(F.greatest(F.abs("x1"), F.abs("y1"))).alias("far")).first()
    if not row["n"]:
        return 1.0, 1.0
    least = row["far"] * 1e-9 or 1.0
    width, height = max(row["w"], least), max(row["h"], least)
    wanted = row["area2"] / 2 / max(row["n"], row["edges"] / EDGES_PER_CELL)
    larger = max((wanted / (width * height)) ** 0.5, 1.0)
    return width * larger, height * larger


def area_of(cell: Cell) -> float:
    return sides(cell)[0] * sides(cell)[1]


def _floor(value: Column, cell: float) -> Column:
    return F.floor(value / F.lit(cell))


def edge_caps(edges: DataFrame, ids: list[str], cell: Cell, times: Column | int = 1) -> DataFrame:
    """ids, col, row, xl, xr, hl, hr, w for closed rings with shells counter-clockwise; an edge counts `times`."""
    wide, high = sides(cell)
    times = (times if isinstance(times, Column) else F.lit(times)).cast("int")
    size, tall = F.lit(wide), F.lit(high)
    leftward = F.col("x1") > F.col("x2")
    slanted = edges.filter(F.col("x1") != F.col("x2")).select(
        *ids, F.least("x1", "x2").alias("xl"), F.greatest("x1", "x2").alias("xr"),
        F.when(leftward, F.col("y2")).otherwise(F.col("y1")).alias("yl"),
        F.when(leftward, F.col("y1")).otherwise(F.col("y2")).alias("yr"),
        F.when(leftward, times).otherwise(-times).alias("w"))
    columns = slanted.withColumn("col", F.explode(F.sequence(_floor(F.col("xl"), wide), _floor(F.col("xr"), wide))))
    at = lambda x: F.col("yl") + (x - F.col("xl")) * (F.col("yr") - F.col("yl")) / (F.col("xr") - F.col("xl"))
    left, right = F.col("col") * size, (F.col("col") + 1) * size
    pieces = columns.select(
        *ids, "col", "w",
        F.greatest(F.col("xl"), left).alias("xa"), F.least(F.col("xr"), right).alias("xb"),
        F.when(F.col("xl") >= left, F.col("yl")).otherwise(at(left)).alias("ya"),
        F.when(F.col("xr") <= right, F.col("yr")).otherwise(at(right)).alias("yb")) \
        .filter(F.col("xa") < F.col("xb")) \
        .withColumn("ra", _floor(F.col("ya"), high)).withColumn("rb", _floor(F.col("yb"), high))

    # pieces by row, and the change of cover above a row where a piece leaves it through its top
    rows = pieces.withColumn("row", F.explode(F.sequence(F.least("ra", "rb"), F.greatest("ra", "rb"))))
    rising = F.col("rb") >= F.col("ra")
    floor_y, top_y = F.col("row") * tall, (F.col("row") + 1) * tall
    cross = lambda y: F.greatest(F.col("xa"), F.least(F.col("xb"), F.col("xa") + (y - F.col("ya")) * (
        F.col("xb") - F.col("xa")) / (F.col("yb") - F.col("ya"))))
    first, last = F.col("row") == F.col("ra"), F.col("row") == F.col("rb")
    entry_y = F.when(first, F.col("ya")).when(rising, floor_y).otherwise(top_y)
    exit_y = F.when(last, F.col("yb")).when(rising, top_y).otherwise(floor_y)
    entry_x = F.when(first, F.col("xa")).otherwise(cross(entry_y))
    exit_x = F.when(last, F.col("xb")).otherwise(cross(exit_y))
    top_x = F.when(F.col("row") < F.greatest("ra", "rb"), cross(top_y))

    def cap(xl, xr, hl, hr, w):
        return F.struct(xl.alias("xl"), xr.alias("xr"), hl.cast("double").alias("hl"), hr.cast("double").alias("hr"),
                        w.cast("int").alias("w"))

    change = F.when(rising, F.col("w")).otherwise(-F.col("w"))
    both = F.array(
        cap(entry_x, exit_x, entry_y - floor_y, exit_y - floor_y, F.col("w")),
        F.when(top_x.isNotNull(), cap(top_x, (F.col("col") + 1) * size, tall, tall, change)))
    pieced = rows.select(*ids, "col", "row", F.inline(F.array_compact(both))).filter(F.col("xl") < F.col("xr"))

    # upright edges change the cover of the rows they pass, from their x to the end of the cell
    upright = edges.filter((F.col("x1") == F.col("x2")) & (F.col("y1") != F.col("y2"))).select(
        *ids, _floor(F.col("x1"), wide).alias("col"), F.col("x1").alias("xl"),
        F.when(F.col("y2") > F.col("y1"), -times).otherwise(times).alias("w"),
        _floor(F.least("y1", "y2"), high).alias("lo"), _floor(F.greatest("y1", "y2"), high).alias("hi"))
    steps = upright.filter((F.col("lo") < F.col("hi")) & (F.col("xl") > F.col("col") * size)).select(
        *ids, "col", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("row"), "xl",
        ((F.col("col") + 1) * size).alias("xr"), tall.alias("hl"), tall.alias("hr"), "w").filter(F.col("xl") < F.col("xr"))

    # cover of whole cells: running sum, from the top, of the pieces that begin at the column's left side
    starts = pieces.filter(F.col("xa") == F.col("col") * size).groupBy(*ids, "col", F.col("ra").alias("row")).agg(
        F.sum("w").alias("w")).filter(F.col("w") != 0)
    down = W.partitionBy(*ids, "col").orderBy(F.desc("row"))
    cover = starts.select(*ids, "col", "row", F.lead("row").over(down).alias("below"),
                          F.sum("w").over(down.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("w"))
    whole = cover.filter((F.col("w") != 0) & F.col("below").isNotNull()).select(
        *ids, "col", F.explode(F.sequence("below", F.col("row") - 1)).alias("row"),
        (F.col("col") * size).alias("xl"), ((F.col("col") + 1) * size).alias("xr"), tall.alias("hl"), tall.alias("hr"),
        F.col("w").cast("int").alias("w"))
    return pieced.unionByName(steps).unionByName(whole)


def _min_integral(a, b, fa, fb, ga, gb) -> Column:
    """Integral over [a, b] of the lower of two straight lines given by their end values."""
    da, db = fa - ga, fb - gb
    t = da / (da - db)
    meet = fa + t * (fb - fa)
    low_a, low_b = F.least(fa, ga), F.least(fb, gb)
    return (b - a) / 2 * F.when(da * db >= 0, low_a + low_b).otherwise(
        (low_a + meet) * t + (meet + low_b) * (1 - t))


def cap_areas(caps: DataFrame, ids: list[str]) -> DataFrame:
    """Planar area per feature from its caps."""
    return caps.groupBy(*ids).agg(F.sum(
        F.col("w") * (F.col("hl") + F.col("hr")) / 2 * (F.col("xr") - F.col("xl"))).alias("area"))


def intersection_areas(left_caps: DataFrame, right_caps: DataFrame, left: str, right: str, cell: Cell) -> DataFrame:
    """left, right, isec: planar area of each overlapping pair, summed over grid cells."""
    named = lambda caps, key, p: caps.select(key, "col", "row", *[F.col(c).alias(f"{p}_{c}") for c in ("xl", "xr", "hl", "hr", "w")])
    met = meet_in_cells(named(left_caps, left, "l"), named(right_caps, right, "r"), cell, ["col", "row"], [("col", ("l_xl", "l_xr"), ("r_xl", "r_xr"))])
    pairs = met.withColumn("a", F.greatest("l_xl", "r_xl")).withColumn("b", F.least("l_xr", "r_xr")).filter(F.col("a") < F.col("b"))
    height = lambda s, x: F.col(f"{s}_hl") + (x - F.col(f"{s}_xl")) * (F.col(f"{s}_hr") - F.col(f"{s}_hl")) / (
        F.col(f"{s}_xr") - F.col(f"{s}_xl"))
    area = _min_integral(F.col("a"), F.col("b"), height("l", F.col("a")), height("l", F.col("b")),
                         height("r", F.col("a")), height("r", F.col("b")))
    return pairs.groupBy(left, right).agg(F.sum(F.col("l_w") * F.col("r_w") * area).alias("isec"))


def edge_areas(edges: DataFrame, ids: list[str]) -> DataFrame:
    """Planar area per feature from its directed edges."""
    return edges.groupBy(*ids).agg((F.sum(
        (F.col("x1") - F.col("x2")) * (F.col("y1") + F.col("y2"))) / 2).alias("area"))


def equal_area_edges(edges: DataFrame) -> DataFrame:
    """Edges on the equal-area projection, in kilometres."""
    return edges.withColumns({
        **{c: G.equal_area_x(F.col(c)) / 1000 for c in ("x1", "x2")},
        **{c: G.equal_area_y(F.col(c)) / 1000 for c in ("y1", "y2")}})


def overlap_join(left_edges: DataFrame, right_edges: DataFrame, left: str, right: str,
                 cell: Cell | None = None, least_share: float = 1e-9) -> DataFrame:
    """Pairs that share area, with equality = I/U, within = I/A1, contains = I/A2.

    Edges are in degrees; areas are in square kilometres on the equal-area projection.  The caps
    of each side are written once, since counting, joining and the areas all read them.  Overlaps of up to
    `least_share` of the smaller unit are rounding.
    """
    le, re = equal_area_edges(left_edges), equal_area_edges(right_edges)
    cell = cell or choose_cell(le, [left])
    lc = materialize(edge_caps(le, [left], cell), "left-caps")
    rc = materialize(edge_caps(re, [right], cell), "right-caps")
    shared = intersection_areas(lc, rc, left, right, cell).filter(F.col("isec") > 0)
    with_areas = shared.join(cap_areas(lc, [left]).withColumnRenamed("area", "a1"), left) \
        .join(cap_areas(rc, [right]).withColumnRenamed("area", "a2"), right)
    isec = F.col("isec")
    with_areas = with_areas.filter(isec > least_share * F.least("a1", "a2"))
    return with_areas.select(left, right, "isec", "a1", "a2",
                             (isec / (F.col("a1") + F.col("a2") - isec)).alias("equality"),
                             (isec / F.col("a1")).alias("within"), (isec / F.col("a2")).alias("contains"))


def point_in_boundary(points: DataFrame, edges: DataFrame, point_ids: list[str], ids: list[str],
                      cell: Cell | None = None) -> DataFrame:
    """point_ids, ids for every polygon that covers a point (columns x, y)."""
    return point_cover(points, edges, point_ids, ids, cell).drop("cover")


def point_cover(points: DataFrame, edges: DataFrame, point_ids: list[str], ids: list[str],
                cell: Cell | None = None, shared: list[str] | None = None, times: Column | int = 1) -> DataFrame:
    """As `point_in_boundary`, with the winding number; `shared` columns must be equal on both sides, and an edge counts `times`."""
    cell = cell or choose_cell(edges, ids, times)
    return cover_by_caps(points, materialize(edge_caps(edges, ids, cell, times), "cover-caps"), point_ids, ids, cell, shared)


def cover_by_caps(points: DataFrame, caps: DataFrame, point_ids: list[str], ids: list[str], cell: Cell, shared: list[str] | None = None) -> DataFrame:
    """`point_cover` of the polygons with these caps, a written table."""
    wide, high = sides(cell)
    placed = points.select(*point_ids, "x", "y", _floor(F.col("x"), wide).alias("col"), _floor(F.col("y"), high).alias("row"))
    on = [*(shared or []), "col", "row"]
    slope = (F.col("hr") - F.col("hl")) / (F.col("xr") - F.col("xl"))
    above = F.col("hl") + (F.col("x") - F.col("xl")) * slope > F.col("y") - F.col("row") * F.lit(high)
    # ids that both sides have, but need not share, are told apart
    caps = caps.select(*[F.col(c).alias(f"_cap_{c}") if c in point_ids and c not in on else F.col(c) for c in caps.columns])
    hits = meet_in_cells(placed, caps, cell, on, [("col", ("x", "x"), ("xl", "xr"))]).filter(
        (F.col("xl") <= F.col("x")) & (F.col("x") < F.col("xr")) & above)
    out = [*point_ids, *[i for i in ids if i not in point_ids]]
    return hits.groupBy(*out).agg(F.sum("w").alias("cover")).filter(F.col("cover") != 0)


def bbox_join(left: DataFrame, right: DataFrame, left_ids: list[str], right_ids: list[str], cell: Cell) -> DataFrame:
    """Pairs of ids whose envelopes (xmin, ymin, xmax, ymax) touch.

    Both sides are laid into grid cells; a pair is emitted only in the cell that holds the lower
    left corner of the common envelope, so no distinct is needed afterwards.
    """
    wide, high = sides(cell)

    def laid(df: DataFrame, ids: list[str], prefix: str) -> DataFrame:
        box = df.select(*ids, *[F.col(c).alias(f"{prefix}{c}") for c in ("xmin", "ymin", "xmax", "ymax")])
        span = lambda lo, hi, side: F.sequence(_floor(F.col(f"{prefix}{lo}"), side), _floor(F.col(f"{prefix}{hi}"), side))
        return box.withColumn("col", F.explode(span("xmin", "xmax", wide))).withColumn("row", F.explode(span("ymin", "ymax", high)))

    axis = lambda name, c: (name, (f"l_{c}min", f"l_{c}max"), (f"r_{c}min", f"r_{c}max"))
    pairs = meet_in_cells(laid(left, left_ids, "l_"), laid(right, right_ids, "r_"), cell, ["col", "row"], [axis("col", "x"), axis("row", "y")])
    touch = ((F.col("l_xmin") <= F.col("r_xmax")) & (F.col("r_xmin") <= F.col("l_xmax"))
             & (F.col("l_ymin") <= F.col("r_ymax")) & (F.col("r_ymin") <= F.col("l_ymax")))
    corner = (F.col("col") == _floor(F.greatest("l_xmin", "r_xmin"), wide)) & (F.col("row") == _floor(F.greatest("l_ymin", "r_ymin"), high))
    return pairs.filter(touch & corner).select(*left_ids, *right_ids)
