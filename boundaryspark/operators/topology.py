"""Shared borders, validity, dissolve, ring building and gap filling on edge rows.

Edges are directed with the interior on their left.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from boundaryspark.functions import geometry as G
from boundaryspark.operators import spatial as P
from boundaryspark.operators.cells import Cell, meet_in_cells, sides
from boundaryspark.operators.edges import assemble, explode_edges
from boundaryspark.runtime import materialize

COORDS = ["x1", "y1", "x2", "y2"]
EDGE = ["ax", "ay", "bx", "by"]
NEAR = 1e-12  # share of an edge below which a crossing is taken to lie on its end
ROUNDING = 2e-15  # share of a coordinate below which an end is taken to lie on another edge: a few units in the last place
POINTS = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
KERNEL_EDGES = 200_000  # larger groups are ordered by joins instead of one task
EDGES_AT_ONCE = 100_000  # smaller groups are ordered together


def with_canonical(edges: DataFrame) -> DataFrame:
    """Adds the undirected edge (ax, ay, bx, by) and the direction `dir` relative to it."""
    forward = (F.col("x1") < F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") < F.col("y2")))
    pick = lambda a, b: F.when(forward, F.col(a)).otherwise(F.col(b))
    return edges.withColumns({"ax": pick("x1", "x2"), "ay": pick("y1", "y2"), "bx": pick("x2", "x1"),
                              "by": pick("y2", "y1"), "dir": F.when(forward, 1).otherwise(-1)})


def shared_borders(edges: DataFrame, unit: str, layer: list[str]) -> DataFrame:
    """Neighbouring units (left_unit < right_unit) and the length of their common border in km.

    An edge with exactly two owners is a border; no pairs are formed.  Edges with more owners mean
    overlapping units and are listed by `overlapping_edges`.
    """
    owners = with_canonical(edges).groupBy(*layer, *EDGE).agg(
        F.count(F.lit(1)).alias("_n"), F.min(unit).alias("left_unit"), F.max(unit).alias("right_unit"))
    pairs = owners.filter((F.col("_n") == 2) & (F.col("left_unit") != F.col("right_unit")))
    length = G.great_circle(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")) / 1000
    return pairs.groupBy(*layer, "left_unit", "right_unit").agg(
        F.count(F.lit(1)).alias("edges"), F.sum(length).alias("border_km"))


def overlapping_edges(edges: DataFrame, layer: list[str]) -> DataFrame:
    return with_canonical(edges).groupBy(*layer, *EDGE).agg(F.count(F.lit(1)).alias("owners")).filter("owners > 2")


def net_edges(edges: DataFrame, key: list[str], times: Column | int = 1) -> DataFrame:
    """Edges of a key after opposite ones cancel out, and how often each is left over (`times`); an edge counts `times`."""
    net = with_canonical(edges).groupBy(*key, *EDGE).agg(F.sum(F.col("dir") * times).alias("_net")).filter(F.col("_net") != 0)
    ahead = F.col("_net") > 0
    pick = lambda a, b: F.when(ahead, F.col(a)).otherwise(F.col(b))
    return net.select(*key, pick("ax", "bx").alias("x1"), pick("ay", "by").alias("y1"),
                      pick("bx", "ax").alias("x2"), pick("by", "ay").alias("y2"), F.abs("_net").alias("times"))


def dissolve_edges(edges: DataFrame, key: list[str]) -> DataFrame:
    """Outline of all polygons of a key that share their vertices and do not overlap."""
    return net_edges(edges, key).drop("times")


def union_edges(edges: DataFrame, key: list[str]) -> DataFrame:
    """Outline of the union of all polygons of a key, also where vertices do not match or polygons overlap.

    What is left after cancelling is cut where it meets, cancelled again, and kept where the winding number
    is above zero on the left and zero on the right.  Cancelling changes no winding number.
    """
    return union_rings(edges, key).select(*key, *COORDS)


def union_rings(edges: DataFrame, key: list[str], kernel_edges: int = KERNEL_EDGES) -> DataFrame:
    """The outline of `union_edges` as rings, like `order_rings`.

    If nothing is cut, what is left after cancelling stays as it is; and if no two edges begin in one vertex, rings are apart
    from each other, so one point tells of a whole ring whether it is a part of the outline.
    """
    net = materialize(net_edges(edges, key).withColumn("no", F.struct(*COORDS)), "union-net")
    splits = materialize(inner_splits(net, key), "union-splits")
    noded = net.drop("no")
    if not splits.isEmpty():
        noded = materialize(net_edges(split_edges(net, splits, key, carried=["times"]), key, F.col("times")), "union-noded")
    busiest = noded.groupBy(*key, "x1", "y1").agg(F.sum("times").alias("n")).agg(F.max("n")).first()[0] or 0
    if busiest > 1:
        return order_rings(_by_winding(noded, key), key, kernel_edges)
    rings = materialize(order_rings(noded.select(*key, *COORDS), key, kernel_edges), "union-rings")
    ring = [*key, "ring_id"]
    points = middles(rings.filter("seq = 0").select(*ring, *COORDS), 1e-6)
    kept = P.point_cover(points, rings, ring, key, shared=key).filter("cover = 1").select(*ring)
    return rings.join(kept, ring, "left_semi")


def _by_winding(noded: DataFrame, key: list[str]) -> DataFrame:
    """Edges with cover on their left and none on their right."""
    at = [*key, *COORDS]
    cover = P.point_cover(middles(noded.select(*at), 1e-6), noded, at, key, shared=key, times=F.col("times"))
    return noded.join(cover, at).filter((F.col("cover") > 0) & (F.col("cover") <= F.col("times"))).select(*at)


def outline_measures(outline: DataFrame, key: list[str]) -> DataFrame:
    """Area (km2, equal-area) and perimeter (km, equidistant) of outlines, before any ring is built."""
    q = lambda c, f: f(F.col(c)) / 1000
    area = (q("x1", G.equal_area_x) - q("x2", G.equal_area_x)) * (q("y1", G.equal_area_y) + q("y2", G.equal_area_y)) / 2
    length = G.planar_length(*[q(c, G.equidistant_x) for c in COORDS])
    return outline.groupBy(*key).agg(F.sum(area).alias("area_km2"), F.sum(length).alias("perimeter_km"))


# --- rings from edges ----------------------------------------------------------------------------


def _next_edges(edges: DataFrame, key: list[str]) -> DataFrame:
    """key, eid, nxt, x, y: the edge that goes on from each edge's end, the sharpest left turn at a crossing."""
    outgoing = edges.select(*key, F.col("x1").alias("x2"), F.col("y1").alias("y2"), F.col("eid").alias("_o"),
                            (F.col("x2") - F.col("x1")).alias("_dx"), (F.col("y2") - F.col("y1")).alias("_dy"))
    met = edges.join(outgoing, [*key, "x2", "y2"])
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    turn = F.atan2(dx * F.col("_dy") - dy * F.col("_dx"), dx * F.col("_dx") + dy * F.col("_dy"))
    return met.groupBy(*key, "eid").agg(F.max_by("_o", F.struct(turn, F.col("_o"))).alias("nxt"), F.first("x1").alias("x"), F.first("y1").alias("y"))


def _order_small(links: pd.DataFrame) -> pd.DataFrame:
    """Ring label (least edge id) and position of each edge by pointer jumping inside whole groups; edge ids are unique over all groups."""
    eid = links["eid"].to_numpy()
    order = np.argsort(eid)
    links = links.iloc[order]
    eid = eid[order]
    nxt = np.searchsorted(eid, links["nxt"].to_numpy())
    rounds = max(1, int(np.ceil(np.log2(len(eid) + 1))))
    label, jump = np.arange(len(eid)), nxt.copy()
    for _ in range(rounds):
        label = np.minimum(label, label[jump])
        jump = jump[jump]
    last = nxt == label                      # the edge before the labelled one ends its ring
    left = np.where(last, 0, 1)
    jump = np.where(last, np.arange(len(eid)), nxt)
    for _ in range(rounds):
        left = left + left[jump]
        jump = jump[jump]
    size = np.bincount(label, minlength=len(eid))[label]
    return links.assign(ring_id=eid[label], seq=size - 1 - left)


def _order_groups(links: DataFrame, key: list[str], total: int) -> DataFrame:
    """`_order_small` of many groups at once: a task takes them in order of the key and works on about `EDGES_AT_ONCE` edges in a call."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in links.schema.fields) + ", ring_id long, seq long"

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size < EDGES_AT_ONCE:
                continue
            rows = pd.concat(held, ignore_index=True)
            group = rows.groupby(key, dropna=False, sort=False).ngroup().to_numpy()
            whole = group != group[-1]  # the last group may go on in the next batch
            if whole.any():
                yield _order_small(rows[whole])
            held, size = [rows[~whole]], int((~whole).sum())
        if size:
            yield _order_small(pd.concat(held, ignore_index=True))
    # by an expression and a number of its own, so that neither a join nor adaptive execution deals the groups anew
    dealt = links.repartition(max(1, -(-total // EDGES_AT_ONCE)), F.xxhash64(*key)).sortWithinPartitions(*key)
    return dealt.mapInPandas(run, schema)


def _local_chains(rows: pd.DataFrame, key: list[str]) -> pd.DataFrame:
    """Contract the chains of links that one task holds.

    Gives the place of every node in its chain (`kind` 0: head and offset), and each chain as one link from its head to the head of the
    next (`kind` 1), with its length, its least edge id and where that is.  A ring that lies here whole becomes a link to itself.
    """
    group = rows.groupby(key, dropna=False, sort=False).ngroup().to_numpy()
    eid, nxt, weight, least, least_at = (rows[c].to_numpy() for c in ("eid", "nxt", "weight", "least", "least_at"))
    names = np.unique(eid)
    code = group * len(names) + np.searchsorted(names, eid)
    order = np.argsort(code)
    place = np.minimum(np.searchsorted(names, nxt), len(names) - 1)
    wanted = group * len(names) + place
    at = np.minimum(np.searchsorted(code[order], wanted), len(code) - 1)
    follower = np.where((names[place] == nxt) & (code[order][at] == wanted), order[at], -1)
    here, all_rows = np.flatnonzero(follower >= 0), np.arange(len(eid))
    before = np.full(len(eid), -1)
    before[follower[here]] = here
    rounds = max(1, int(np.ceil(np.log2(len(eid) + 1))))

    def heads() -> tuple[np.ndarray, np.ndarray]:
        jump, offset = np.where(before >= 0, before, all_rows), np.where(before >= 0, weight[before], 0)
        for _ in range(rounds):
            offset = offset + offset[jump]
            jump = jump[jump]
        return jump, offset
    head, offset = heads()
    circling = before[head] >= 0
    if circling.any():
        # rings without a head begin at their first row
        first, jump = all_rows.copy(), np.where(follower >= 0, follower, all_rows)
        for _ in range(rounds):
            first = np.minimum(first, first[jump])
            jump = jump[jump]
        before[circling & (first == all_rows)] = -1
        head, offset = heads()
    last = (follower < 0) | (before[np.maximum(follower, 0)] < 0)
    onward = np.empty(len(eid), nxt.dtype)
    onward[head[last]] = nxt[last]
    chains = np.flatnonzero(before < 0)
    total = np.zeros(len(eid), np.int64)
    np.add.at(total, head, weight)
    by_least = np.lexsort((least, head))
    firsts = by_least[np.append(True, head[by_least][1:] != head[by_least][:-1])]
    lowest, lowest_at = np.empty(len(eid), least.dtype), np.empty(len(eid), np.int64)
    lowest[head[firsts]], lowest_at[head[firsts]] = least[firsts], offset[firsts] + least_at[firsts]
    members = rows.assign(kind=0, head=eid[head], offset=offset)
    links = rows.iloc[chains].assign(kind=1, head=eid[chains], offset=0, nxt=onward[chains], weight=total[chains], least=lowest[chains],
                                     least_at=lowest_at[chains])
    return pd.concat([members, links], ignore_index=True)


def _order_large(links: DataFrame, key: list[str], kernel_edges: int) -> DataFrame:
    """Ring and place of each edge of groups too large for one task, by contraction.

    Links are dealt by place, so that most followers are in the same task, and each task contracts its chains.  The heads that are left are dealt
    anew, in fewer and so larger areas, until one task holds them.  Places then come back through the levels: every edge is written once
    on the way down, and read once on the way up.
    """
    kernel_edges = max(kernel_edges, 1)
    state = links.withColumns({"weight": F.lit(1).cast("long"), "least": F.col("eid"), "least_at": F.lit(0).cast("long")})
    plain = [f for f in state.schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain) + ", kind int, head long, offset long"
    levels: list[DataFrame] = []
    rings: DataFrame | None = None

    def run(batches):
        held = [b for b in batches if len(b)]
        if held:
            out = _local_chains(pd.concat(held, ignore_index=True), key)
            yield out.astype({"kind": "int32", "head": "int64", "offset": "int64"})
    while True:
        state = materialize(state, "ring-links")
        left, low, high = state.agg(F.count(F.lit(1)), F.min("x"), F.max("x")).first()
        if not left:
            break
        parts = -(-left // kernel_edges)
        columns = max(1, int(parts ** 0.5))
        stripe = F.least(F.floor((F.col("x") - F.lit(low)) / F.lit((high - low) or 1.0) * columns), F.lit(columns - 1))
        # a single task holds what is left, once it is few enough
        dealt = state.coalesce(1) if parts == 1 else state.withColumn("_s", stripe).repartitionByRange(parts, *key, "_s", "y", "eid").drop("_s")
        level = materialize(dealt.mapInPandas(run, schema), "ring-level")
        levels.append(level.filter("kind = 0").select(*key, "eid", "head", "offset"))
        chains = level.filter("kind = 1")
        whole = chains.filter("nxt = eid").select(*key, F.col("eid").alias("head"), F.lit(0).cast("long").alias("base"), "weight", "least", "least_at", F.lit(len(levels)).alias("_level"))
        rings = whole if rings is None else rings.unionByName(whole)
        state = chains.filter("nxt <> eid").select(*[f.name for f in plain])
        if state.count() > 0.75 * left and parts > 1:
            # neighbours lie far apart: larger areas, down to one task for each key
            kernel_edges *= 4
    places: DataFrame | None = None
    for n in range(len(levels), 0, -1):
        known = rings.filter(F.col("_level") == n).drop("_level")
        if places is not None:
            known = known.unionByName(places.withColumnRenamed("eid", "head").select(*known.columns))
        places = levels[n - 1].join(known, [*key, "head"]).select(
            *key, "eid", (F.col("base") + F.col("offset")).alias("base"), "weight", "least", "least_at")
    return places.select(*key, "eid", F.col("least").alias("ring_id"), F.pmod(F.col("base") - F.col("least_at"), F.col("weight")).alias("seq"))


def order_rings(edges: DataFrame, key: list[str], kernel_edges: int = KERNEL_EDGES) -> DataFrame:
    """key, eid, coordinates, ring_id and seq: each edge's ring and its place in it."""
    stored = materialize(edges.select(*key, *COORDS).withColumn("eid", F.monotonically_increasing_id()), "outline")
    links = materialize(_next_edges(stored, key), "links")  # with the place of each edge's begin
    sizes = materialize(links.groupBy(*key).agg(F.count(F.lit(1)).alias("_edges"), F.count_distinct("nxt").alias("_next")), "sizes")
    most, twice, total = (x or 0 for x in sizes.agg(F.max("_edges"), F.max(F.col("_edges") - F.col("_next")), F.sum("_edges")).first())
    if twice or total != stored.count():
        raise ValueError(f"edges do not close into rings: {total} edges go on, {twice} successors at most are shared in a key")
    small = links.join(sizes.filter(F.col("_edges") <= kernel_edges), key, "left_semi")
    ordered = _order_groups(small, key, total)
    if most > kernel_edges:
        large = links.join(sizes.filter(F.col("_edges") > kernel_edges), key, "left_semi")
        ordered = ordered.select(*key, "eid", "ring_id", "seq").unionByName(_order_large(large, key, kernel_edges))
    return stored.join(ordered.select(*key, "eid", "ring_id", "seq"), [*key, "eid"])


def stitch_rings(edges: DataFrame, key: list[str], kernel_edges: int = KERNEL_EDGES) -> DataFrame:
    """Vertex rows (key, poly, ring, seq, x, y) of polygons: shells with the holes inside them."""
    return place_rings(order_rings(edges, key, kernel_edges), key)


def place_rings(rings: DataFrame, key: list[str]) -> DataFrame:
    """`stitch_rings` of edges that are in rings already."""
    rings = materialize(rings, "rings")
    ox, oy = F.min("x1"), F.min("y1")
    origin = rings.groupBy(*key, "ring_id").agg(ox.alias("_ox"), oy.alias("_oy"))
    cross = G.edge_cross(*[F.col(c) for c in COORDS], F.col("_ox"), F.col("_oy"))
    areas = materialize(rings.join(origin, [*key, "ring_id"]).groupBy(*key, "ring_id").agg(
        (F.sum(cross) / 2).alias("area"), F.count(F.lit(1)).alias("edges"),
        F.min(F.when(F.col("seq") == 0, (F.col("x1") + F.col("x2")) / 2)).alias("x"),
        F.min(F.when(F.col("seq") == 0, (F.col("y1") + F.col("y2")) / 2)).alias("y")), "ring-areas")
    shells = areas.filter(F.col("area") > 0)
    holes = areas.filter(F.col("area") < 0)
    placed = shells.select(*key, F.col("ring_id").alias("poly_id"), "ring_id", F.lit(0).alias("_hole"))
    if not holes.isEmpty():
        holed = shells.join(holes.select(*key).distinct(), key, "left_semi")
        shell_edges = rings.join(holed.select(*key, "ring_id"), [*key, "ring_id"], "left_semi") \
            .withColumnRenamed("ring_id", "poly_id")
        points = holes.select(*key, F.col("ring_id").alias("hole_id"), "x", "y")
        inside = P.point_cover(points, shell_edges, [*key, "hole_id"], [*key, "poly_id"], shared=key)
        sized = inside.join(shells.select(*key, F.col("ring_id").alias("poly_id"), "area"), [*key, "poly_id"])
        owner = sized.groupBy(*key, "hole_id").agg(F.min_by("poly_id", F.struct("area", "poly_id")).alias("poly_id"))
        placed = placed.unionByName(owner.select(*key, "poly_id", F.col("hole_id").alias("ring_id"), F.lit(1).alias("_hole")))
    numbers = placed.select(*key, "ring_id", F.col("poly_id").alias("poly"),
                            F.when(F.col("_hole") == 0, F.lit(-1).cast("long")).otherwise(F.col("ring_id")).alias("ring"))
    rows = rings.join(numbers, [*key, "ring_id"])
    closing = areas.select(*key, "ring_id", "edges")
    ends = rows.filter(F.col("seq") == 0).join(closing, [*key, "ring_id"]).select(
        *key, "poly", "ring", F.col("edges").alias("seq"), F.col("x1").alias("x"), F.col("y1").alias("y"))
    return rows.select(*key, "poly", "ring", "seq", F.col("x1").alias("x"), F.col("y1").alias("y")).unionByName(ends)


def dissolve(features: DataFrame, key: list[str]) -> DataFrame:
    """One multipart feature per key: the union of its features.  A null key is a key like others."""
    group = F.to_json(F.struct(*key), {"ignoreNullFields": "false"})
    named = features.withColumn("_group", group)
    rings = union_rings(explode_edges(named, ["_group"]), ["_group"])
    out = assemble(place_rings(rings, ["_group"]), ["_group"])
    return out.join(features.select(*key).distinct().withColumn("_group", group), "_group").select(*key, "geom")


def fill_gaps(features: DataFrame, ids: list[str], layer: list[str], max_area_km2: float) -> DataFrame:
    """Holes of the dissolved layer below the area limit go to the unit with the longest border on them."""
    key = [*layer, *ids]
    plain = explode_edges(features, key).withColumn("no", F.struct(F.struct(*ids).alias("unit"), "poly", "ring", "seq"))
    plain = materialize(plain.select(*key, "no", *COORDS), "gap-plain")
    edges = materialize(node_edges(plain, layer, ids), "gap-edges")
    rings = materialize(union_rings(edges, layer), "gap-rings")
    measured = outline_measures(rings, [*layer, "ring_id"])
    gaps = measured.filter((F.col("area_km2") < 0) & (F.col("area_km2") > -max_area_km2)).select(*layer, "ring_id")
    gap_edges = rings.join(gaps, [*layer, "ring_id"], "left_semi")
    touching = gap_edges.join(edges, [*layer, *COORDS])
    length = G.great_circle(*[F.col(c) for c in COORDS])
    longest = touching.groupBy(*layer, "ring_id", *ids).agg(F.sum(length).alias("_len")) \
        .groupBy(*layer, "ring_id").agg(F.max_by(F.struct(*ids), F.struct("_len", *ids)).alias("_u")).select(*layer, "ring_id", "_u.*")
    # an outline keeps the dissolved area on its left, so the gap itself is bounded by the reverse edges
    added = gap_edges.join(longest, [*layer, "ring_id"]).select(
        *key, F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    added = materialize(added, "gap-added")
    grown = added.select(*key).distinct()
    changed = edges.join(grown, key, "left_semi").unionByName(added)
    rebuilt = assemble(stitch_rings(dissolve_edges(changed, key), key), key)
    return features.join(grown, key, "left_anti").select(*key, "geom").unionByName(rebuilt.select(*key, "geom"))


# --- crossings, validity, repair -----------------------------------------------------------------


def edge_cell(edges: DataFrame) -> tuple[float, float]:
    """Width and height of a cell near the extents of an average edge, so that edges lie in few cells and cells hold few edges."""
    row = edges.agg(F.avg(F.abs(F.col("x2") - F.col("x1"))).alias("w"), F.avg(F.abs(F.col("y2") - F.col("y1"))).alias("h"),
                    F.max(F.greatest(F.abs("x1"), F.abs("y1"))).alias("m")).first()
    least = (row["m"] or 1.0) / 1e8
    return max(row["w"] or 1.0, least), max(row["h"] or 1.0, least)


def _laid(edges: DataFrame, cell: Cell, prefix: str, keep: list[str]) -> DataFrame:
    """Edges by grid cell: along the longer axis cell by cell, across it only the rows they pass."""
    wide, high = sides(cell)
    f = lambda v, side: F.floor(v / F.lit(side))
    lo, hi = F.least("x1", "x2"), F.greatest("x1", "x2")
    cols = edges.withColumn("col", F.explode(F.sequence(f(lo, wide), f(hi, wide))))
    at = lambda x: F.when(F.col("x1") == F.col("x2"), F.col("y1")).otherwise(
        F.col("y1") + (x - F.col("x1")) * (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1")))
    left, right = F.greatest(lo, F.col("col") * F.lit(wide)), F.least(hi, (F.col("col") + 1) * F.lit(wide))
    upright = F.col("x1") == F.col("x2")
    ya = F.when(upright, F.col("y1")).otherwise(at(left))
    yb = F.when(upright, F.col("y2")).otherwise(at(right))
    spread = cols.withColumn("_ya", F.least(ya, yb)).withColumn("_yb", F.greatest(ya, yb))
    pad = F.lit(high * 1e-9)
    rows = spread.withColumn("row", F.explode(F.sequence(f(F.col("_ya") - pad, high), f(F.col("_yb") + pad, high))))
    return rows.select(*keep, "col", "row", F.col("no").alias(f"{prefix}no"), *[F.col(c).alias(f"{prefix}{c}") for c in COORDS])


def near_pairs(a_edges: DataFrame, b_edges: DataFrame, cell: Cell, a_ids: list[str], b_ids: list[str],
               shared: list[str] | None = None) -> DataFrame:
    """Pairs of edges (a_no, a_x1, ..., b_no, b_x1, ...) whose envelopes touch, once for every grid cell that both pass through.

    Callers keep those that meet and make them distinct then, when few are left.
    """
    on = [*(shared or []), "col", "row"]
    bounds = lambda p: {f"{p}{k}": f(f"{p}{c}1", f"{p}{c}2") for k, f, c in (
        ("xl", F.least, "x"), ("xr", F.greatest, "x"), ("yl", F.least, "y"), ("yr", F.greatest, "y"))}
    helper = [f"{p}{k}" for p in ("a_", "b_") for k in ("xl", "xr", "yl", "yr")]
    axis = lambda name, c: (name, (f"a_{c}l", f"a_{c}r"), (f"b_{c}l", f"b_{c}r"))
    met = meet_in_cells(_laid(a_edges, cell, "a_", a_ids).withColumns(bounds("a_")), _laid(b_edges, cell, "b_", b_ids).withColumns(bounds("b_")),
                        cell, on, [axis("col", "x"), axis("row", "y")])
    met = met.filter((F.col("a_xl") <= F.col("b_xr")) & (F.col("b_xl") <= F.col("a_xr")) & (F.col("a_yl") <= F.col("b_yr")) & (F.col("b_yl") <= F.col("a_yr")))
    if shared:
        met = met.filter(F.col("a_no") < F.col("b_no"))
    return met.drop("col", "row", *helper)


def _cross(ox, oy, ax, ay, bx, by) -> Column:
    return (ax - ox) * (by - oy) - (ay - oy) * (bx - ox)


def proper_crossing() -> Column:
    """Do edges a and b cross strictly inside both?"""
    c = {n: F.col(n) for p in ("a_", "b_") for n in [p + x for x in COORDS]}
    d1 = _cross(c["a_x1"], c["a_y1"], c["a_x2"], c["a_y2"], c["b_x1"], c["b_y1"])
    d2 = _cross(c["a_x1"], c["a_y1"], c["a_x2"], c["a_y2"], c["b_x2"], c["b_y2"])
    d3 = _cross(c["b_x1"], c["b_y1"], c["b_x2"], c["b_y2"], c["a_x1"], c["a_y1"])
    d4 = _cross(c["b_x1"], c["b_y1"], c["b_x2"], c["b_y2"], c["a_x2"], c["a_y2"])
    return (d1 * d2 < 0) & (d3 * d4 < 0)


def numbered_edges(edges: DataFrame) -> DataFrame:
    return edges.withColumn("no", F.struct("poly", "ring", "seq"))


def self_crossings(edges: DataFrame, ids: list[str], cell: Cell | None = None) -> DataFrame:
    """ids, a_no, b_no, x, y of edges of one feature that cross each other."""
    e = numbered_edges(edges)
    cell = cell or edge_cell(edges)
    x, y = crossing_point()
    return near_pairs(e, e, cell, ids, ids, shared=ids).filter(proper_crossing()).select(
        *ids, "a_no", "b_no", x.alias("x"), y.alias("y")).distinct()


def crossing_point() -> tuple[Column, Column]:
    rx, ry = F.col("a_x2") - F.col("a_x1"), F.col("a_y2") - F.col("a_y1")
    sx, sy = F.col("b_x2") - F.col("b_x1"), F.col("b_y2") - F.col("b_y1")
    den = rx * sy - ry * sx
    t = ((F.col("b_x1") - F.col("a_x1")) * sy - (F.col("b_y1") - F.col("a_y1")) * sx) / F.nullif(den, F.lit(0.0))
    return F.col("a_x1") + t * rx, F.col("a_y1") + t * ry


def validity_report(features: DataFrame, ids: list[str], cell: Cell | None = None) -> DataFrame:
    """Per feature: valid, the reasons and the place of the first crossing."""
    rings = lambda test: F.exists("geom", lambda p: F.exists(p, test))
    shape = features.select(
        *ids, rings(lambda r: (F.element_at(r, 1)["x"] != F.element_at(r, -1)["x"]) | (F.element_at(r, 1)["y"] != F.element_at(r, -1)["y"])).alias("open_ring"),
        rings(lambda r: F.size(r) < 4).alias("few_points"),
        F.exists("geom", lambda p: G.ring_area(F.element_at(p, 1)) == 0).alias("zero_area"))
    edges = materialize(explode_edges(features, ids), "validity-edges")
    crossings = materialize(self_crossings(edges, ids, cell), "validity-crossings").groupBy(*ids).agg(
        F.count(F.lit(1)).alias("crossings"), F.min_by(F.struct("x", "y"), F.struct("a_no", "b_no")).alias("_at"))
    repeated = with_canonical(edges).groupBy(*ids, *EDGE).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1") \
        .select(*ids).distinct().withColumn("_repeated", F.lit(True))
    out = shape.join(crossings, ids, "left").join(repeated, ids, "left").join(misplaced_holes(edges, ids), ids, "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    reasons = F.concat_ws("; ", F.when(F.col("open_ring"), "open ring"), F.when(F.col("few_points"), "too few points"),
                          F.when(F.col("zero_area"), "zero area"), F.when(F.col("crossings") > 0, "self-crossing"),
                          F.when(flag("_repeated"), "repeated edge"), F.when(flag("_misplaced"), "hole outside shell"))
    return out.select(*ids, (reasons == "").alias("valid"), reasons.alias("reason"),
                      F.coalesce("crossings", F.lit(0).cast("long")).alias("crossings"),
                      F.col("_at.x").alias("at_x"), F.col("_at.y").alias("at_y"))


def misplaced_holes(edges: DataFrame, ids: list[str]) -> DataFrame:
    """Features with a hole whose middle of the first edge is not inside its own shell."""
    middle = edges.filter((F.col("ring") > 0) & (F.col("seq") == 0)).select(
        *ids, "poly", F.col("ring").alias("hole"), ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"))
    own = [*ids, "poly"]
    shells = edges.filter(F.col("ring") == 0).join(middle.select(*own).distinct(), own, "left_semi")
    covered = materialize(P.point_cover(middle, shells, [*own, "hole"], own, shared=own), "validity-holes")
    return middle.join(covered, [*own, "hole"], "left_anti").select(*ids).distinct().withColumn("_misplaced", F.lit(True))


# --- noding ------------------------------------------------------------------------------------------


def _meetings(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where edges a and b (rows x1, y1, x2, y2) meet: up to four points a pair and their number; ends of the edges are kept exactly."""
    a1, a2, b1, b2 = a[:, :2], a[:, 2:], b[:, :2], b[:, 2:]
    (rx, ry), (sx, sy), (qx, qy) = (a2 - a1).T, (b2 - b1).T, (b1 - a1).T
    with np.errstate(divide="ignore", invalid="ignore"):
        den = rx * sy - ry * sx
        scale = np.sqrt((rx * rx + ry * ry) * (sx * sx + sy * sy))
        parallel = np.abs(den) <= scale * NEAR
        safe = np.where(parallel, np.nan, den)
        t, u = (qx * sy - qy * sx) / safe, (qx * ry - qy * rx) / safe
        # coordinates are rounded, which is a large share of a short edge, or of one that crosses at a small angle: so the distance counts too
        apart = np.maximum(np.abs(a).max(axis=1), np.abs(b).max(axis=1)) * ROUNDING
        to_b, to_a = np.abs(den) / np.sqrt(sx * sx + sy * sy), np.abs(den) / np.sqrt(rx * rx + ry * ry)
        on = lambda share, length: (np.abs(share) <= NEAR) | (np.abs(share) * length <= apart)
        on_a1, on_a2, on_b1, on_b2 = on(t, to_b), on(t - 1, to_b), on(u, to_a), on(u - 1, to_a)
        meets = ((t >= 0) | on_a1) & ((t <= 1) | on_a2) & ((u >= 0) | on_b1) & ((u <= 1) | on_b2)
        on_line = parallel & (np.abs(qx * ry - qy * rx) <= NEAR * scale)
        points = np.stack([a1, a2, b1, b2], axis=1)
        crossing = np.stack([a1[:, 0] + t * rx, a1[:, 1] + t * ry], axis=1)
    for hit, end in ((on_b2, b2), (on_b1, b1), (on_a2, a2), (on_a1, a1)):
        crossing = np.where(hit[:, None], end, crossing)
    points[:, 0] = np.where(on_line[:, None], a1, crossing)
    return points, np.where(on_line, 4, np.where(meets, 1, 0))


def _coords(batch: pa.RecordBatch, side: str) -> np.ndarray:
    return np.stack([batch.column(f"{side}_{c}").to_numpy(zero_copy_only=False) for c in COORDS], axis=1)


def meeting_points(pairs: DataFrame) -> DataFrame:
    """Adds `points`: where edges a and b meet; ends of the edges are kept exactly."""
    schema = T.StructType([*pairs.schema.fields, T.StructField("points", POINTS)])

    def run(batches):
        for batch in batches:
            points, n = _meetings(_coords(batch, "a"), _coords(batch, "b"))
            rows = np.flatnonzero(n)
            flat = points[rows][np.arange(4) < n[rows, None]]
            xy = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["x", "y"])
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n[rows])), pa.int32()), xy)
            kept = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*kept.columns, lists], [*batch.schema.names, "points"])
    return pairs.mapInArrow(run, schema)


def split_edges(edges: DataFrame, splits: DataFrame, ids: list[str], places: bool = False, carried: list[str] | None = None) -> DataFrame:
    """Edges (ids, no, coordinates) cut at the `points` of `splits` that lie strictly inside them; parts keep the `carried` columns.

    With `places` each part keeps `no`, its number `part` on the edge, and `begins` and `ends`: is this end one of the points?
    The points of an edge are rows in order, so that an edge met by very many others is neither held in one row nor compared point by point.
    """
    on, more = [*ids, "no"], carried or []
    met = splits.select(*on, F.explode("points").alias("_p"))
    joined = edges.select(*on, *more, *COORDS).withColumn("_row", F.monotonically_increasing_id()).join(met, on, "left")
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    x, y = F.col("_p.x"), F.col("_p.y")
    along = ((x - F.col("x1")) * dx + (y - F.col("y1")) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    is_begin, is_end = (x == F.col("x1")) & (y == F.col("y1")), (x == F.col("x2")) & (y == F.col("y2"))
    inner = ~is_begin & ~is_end & (along > 0) & (along < 1)
    placed = joined.withColumn("_at", F.when(inner, F.struct(along.alias("t"), x.alias("x"), y.alias("y"))))
    edge = W.partitionBy(*on, "_row")
    order = edge.orderBy(F.asc_nulls_last("_at"))
    ranked = placed.withColumns({"_next": F.lead("_at").over(order), "_first_row": F.row_number().over(order) == 1, "_rank": F.dense_rank().over(order)})
    if places:
        any_row = lambda test: F.coalesce(F.max(test).over(edge), F.lit(False))
        ranked = ranked.withColumns({"_first": any_row(is_begin), "_last": any_row(is_end)})
    # the first row of an edge also gives the part before its point; rows of points that cut nothing give none
    part = lambda number, x, y, to, is_last: F.struct(number.alias("part"), x.alias("x1"), y.alias("y1"), F.coalesce(to["x"], F.col("x2")).alias("x2"),
                                                      F.coalesce(to["y"], F.col("y2")).alias("y2"), is_last.alias("is_last"))
    before = part(F.lit(0), F.col("x1"), F.col("y1"), F.col("_at"), F.col("_at").isNull())
    after = part(F.col("_rank"), F.col("_at.x"), F.col("_at.y"), F.col("_next"), F.col("_next").isNull())
    parts = F.when(F.col("_at").isNull(), F.array(before)).when(F.col("_first_row"), F.array(before, after)).otherwise(F.array(after))
    ends = ["_first", "_last"] if places else []
    cut = ranked.filter(F.col("_first_row") | F.col("_at").isNotNull()).select(*on, *more, *ends, F.explode(parts).alias("_s"))
    cut = cut.select(*on, *more, *ends, "_s.*").filter((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))
    if not places:
        return cut.select(*ids, *more, *COORDS)
    return cut.select(*on, *more, "part", ((F.col("part") > 0) | F.col("_first")).alias("begins"), (~F.col("is_last") | F.col("_last")).alias("ends"), *COORDS)


def middles(edges: DataFrame, offset: float = 0.0) -> DataFrame:
    """Middle of each edge, moved to its left by a share of its length."""
    return edges.withColumn("x", (F.col("x1") + F.col("x2")) / 2 - (F.col("y2") - F.col("y1")) * offset) \
        .withColumn("y", (F.col("y1") + F.col("y2")) / 2 + (F.col("x2") - F.col("x1")) * offset)


def may_cut() -> Column:
    """False for edges a and b that are the same, or meet in a common end only: at no acute angle, or at one far above rounding."""
    c = {n: F.col(n) for p in ("a_", "b_") for n in [p + x for x in COORDS]}
    same = lambda i, j: (c[f"a_x{i}"] == c[f"b_x{j}"]) & (c[f"a_y{i}"] == c[f"b_y{j}"])
    far = F.greatest(*[F.abs(v) for v in c.values()])
    harmless = (same(1, 1) & same(2, 2)) | (same(1, 2) & same(2, 1))
    for i, j in ((1, 1), (1, 2), (2, 1), (2, 2)):
        # both edges as they leave the common end
        ux, uy, wx, wy = (c[f"{p}_{x}{3 - n}"] - c[f"{p}_{x}{n}"] for p, n in (("a", i), ("b", j)) for x in "xy")
        uu, ww, cross = ux * ux + uy * uy, wx * wx + wy * wy, ux * wy - uy * wx
        wide = (cross * cross > uu * ww * 1e-18) & (cross * cross > far * far * 1e-24 * F.greatest(uu, ww))
        harmless = harmless | (same(i, j) & ((ux * wx + uy * wy <= 0) | wide))
    return ~F.coalesce(harmless, F.lit(False))


def inner_splits(edges: DataFrame, layer: list[str]) -> DataFrame:
    """layer, no, points: where edges of a layer meet others strictly inside."""
    # most pairs of a layer are neighbours with a common end, which needs no further look
    pairs = near_pairs(edges, edges, edge_cell(edges), layer, layer, shared=layer).filter(may_cut())
    at = {f.name: f for f in pairs.schema.fields}
    schema = T.StructType([*[at[c] for c in layer], T.StructField("no", at["a_no"].dataType), T.StructField("points", POINTS)])

    def run(batches):
        for batch in batches:
            sides = {s: _coords(batch, s) for s in ("a", "b")}
            points, n = _meetings(sides["a"], sides["b"])
            there = np.arange(4) < n[:, None]
            for side, e in sides.items():
                begin, step = e[:, None, :2], (e[:, 2:] - e[:, :2])[:, None]
                with np.errstate(divide="ignore", invalid="ignore"):
                    along = ((points - begin) * step).sum(axis=2) / (step * step).sum(axis=2)
                end = (points == begin).all(axis=2) | (points == e[:, None, 2:]).all(axis=2)
                row, place = np.nonzero(there & ~end & (along > 0) & (along < 1))
                x, y = points[row, place].T
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1), pa.int32()), pa.StructArray.from_arrays([pa.array(x), pa.array(y)], ["x", "y"]))
                kept = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*[kept.column(c) for c in layer], kept.column(f"{side}_no"), lists], [*layer, "no", "points"])
    return pairs.mapInArrow(run, schema).distinct()


def node_edges(edges: DataFrame, layer: list[str], ids: list[str] | None = None) -> DataFrame:
    """Edges (layer, ids, coordinates) cut where edges of a layer meet; with `ids`, `no` holds them as `unit`."""
    ids = ids or []
    splits = inner_splits(edges, layer).withColumns({i: F.col(f"no.unit.{i}") for i in ids})
    return split_edges(edges, splits, [*layer, *ids])
