"""Line simplification that keeps shared borders shared.

Rings are cut into arcs at vertices where other than two edges meet.  A border shared by two
units is the same arc in both, read in a fixed direction, so both copies lose the same vertices.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from boundaryspark.functions import geometry as G
from boundaryspark.operators import topology as T
from boundaryspark.operators.edges import assemble, explode_edges
from boundaryspark.runtime import materialize, numbered, running_sums, spread_join

METRES_PER_DEGREE = np.pi * G.SEMI_MAJOR / 180
ANGLE_WEIGHT = 0.7
KERNEL_VERTICES = 100_000  # longer arcs are first divided by joins, with the same result
RING_AT_ONCE = 65_536  # a layer without longer rings has each ring in one place, without joins


def arcs(features: DataFrame, ids: list[str], layer: list[str]) -> DataFrame:
    """Edges of rings turned to start at a node: ids, poly, ring, seq, arc, coordinates."""
    return _arcs(features, ids, layer)[0]


def _arcs(features: DataFrame, ids: list[str], layer: list[str]) -> tuple[DataFrame, bool]:
    """`arcs`, and whether all rings are short, of up to `RING_AT_ONCE` edges."""
    key = [*layer, *ids]
    ring = [*key, "poly", "ring"]
    edges = materialize(explode_edges(features, key), "arc-edges")
    ends = T.with_canonical(edges).select(*layer, *T.EDGE).distinct().select(
        *layer, F.inline(F.array(F.struct(F.col("ax").alias("x1"), F.col("ay").alias("y1")),
                                 F.struct(F.col("bx").alias("x1"), F.col("by").alias("y1")))))
    nodes = ends.groupBy(*layer, "x1", "y1").agg(F.count(F.lit(1)).alias("_deg")).filter("_deg <> 2") \
        .select(*layer, "x1", "y1").withColumn("node", F.lit(1))
    flagged = edges.join(nodes, [*layer, "x1", "y1"], "left").withColumn("node", F.coalesce("node", F.lit(0)))
    flagged = materialize(flagged, "arc-nodes")
    # first vertex: the first node, or the least vertex of a ring without nodes
    if (flagged.agg(F.max("seq")).first()[0] or 0) < RING_AT_ONCE:
        whole = W.partitionBy(*ring)
        first = F.coalesce(F.min(F.when(F.col("node") == 1, F.col("seq"))).over(whole), F.min_by("seq", F.struct("x1", "y1")).over(whole))
        turned = flagged.withColumns({"_n": F.count(F.lit(1)).over(whole), "_start": first}).withColumn("seq", F.pmod(F.col("seq") - F.col("_start"), F.col("_n")))
        upto = whole.orderBy("seq").rowsBetween(W.unboundedPreceding, W.currentRow)
        return turned.withColumn("arc", F.sum("node").over(upto)).select(*ring, "seq", "arc", *T.COORDS), True
    start = flagged.groupBy(*ring).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.when(F.col("node") == 1, F.col("seq"))).alias("_node"),
        F.min_by("seq", F.struct("x1", "y1")).alias("_least")).select(*ring, "_n", F.coalesce("_node", "_least").alias("_start"))
    turned = flagged.join(start, ring).withColumn("seq", F.pmod(F.col("seq") - F.col("_start"), F.col("_n")))
    return running_sums(turned, ring, "seq", {"arc": F.col("node")}).select(*ring, "seq", "arc", *T.COORDS), False


def _canonical(x: np.ndarray, y: np.ndarray) -> bool:
    """Is the arc read in its fixed direction?"""
    first, last = (x[0], y[0]), (x[-1], y[-1])
    if first == last and len(x) > 2:
        first, last = (x[1], y[1]), (x[-2], y[-2])
    return first <= last


def with_scale(edges: DataFrame, arc_key: list[str], short: bool = False) -> DataFrame:
    """Adds `scale`, the metres per degree of longitude at the mean latitude of the whole arc; `short` arcs are met without a join.

    It is fixed before an arc is divided, so parts measure like the arc does.
    """
    low, high = F.min(F.least("y1", "y2")), F.max(F.greatest("y1", "y2"))
    scale = lambda low, high: F.cos(F.radians((low + high) / 2)) * float(METRES_PER_DEGREE)
    if short:
        whole = W.partitionBy(*arc_key)
        return edges.withColumn("scale", scale(low.over(whole), high.over(whole)))
    return edges.join(edges.groupBy(*arc_key).agg(scale(low, high).alias("scale")), arc_key)


def _distances(px, py, ax, ay, bx, by):
    dx, dy = bx - ax, by - ay
    squared = dx * dx + dy * dy
    if squared == 0:
        return np.hypot(px - ax, py - ay)
    t = np.clip(((px - ax) * dx + (py - ay) * dy) / squared, 0, 1)
    return np.hypot(px - ax - t * dx, py - ay - t * dy)


def douglas_peucker(x: np.ndarray, y: np.ndarray, tolerance: float) -> np.ndarray:
    """Mask of kept vertices; both ends stay."""
    keep = np.zeros(len(x), dtype=bool)
    keep[[0, -1]] = True
    stack = [(0, len(x) - 1)]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        d = _distances(x[a + 1:b], y[a + 1:b], x[a], y[a], x[b], y[b])
        far = int(np.argmax(d))
        if d[far] > tolerance:
            split = a + 1 + far
            keep[split] = True
            stack += [(a, split), (split, b)]
    return keep


def drop_least(x: np.ndarray, y: np.ndarray, floors: np.ndarray, most: float = np.inf, weighting: float = ANGLE_WEIGHT):
    """Drop inner vertices by their triangles, the least first, up to the area `most`; both ends stay.

    Gives the value at which each vertex dropped out (infinite for the others), the floors of those left, and for either end the list of its
    neighbours with the value from which on each was one.  A vertex drops out at its own area or, if that has shrunk since, at the value
    of the neighbour that went last, its floor; this is the running maximum of the whole line's order.
    """
    n = len(x)
    value, floors = np.full(n, np.inf), floors.copy()
    before, after = np.arange(-1, n - 1), np.arange(1, n + 1)

    def triangle(i: int) -> float:
        ax, ay, bx, by = x[before[i]] - x[i], y[before[i]] - y[i], x[after[i]] - x[i], y[after[i]] - y[i]
        sides = np.hypot(ax, ay) * np.hypot(bx, by)
        return abs(ax * by - ay * bx) / 2 * (1 - weighting * (ax * bx + ay * by) / sides) if sides else 0.0

    current = {i: triangle(i) for i in range(1, n - 1)}
    heap = [(a, i) for i, a in current.items()]
    heapq.heapify(heap)
    beside = ([(0.0, 1)], [(0.0, n - 2)]) if n > 1 else ([], [])
    while heap and heap[0][0] <= most:
        a, i = heapq.heappop(heap)
        if current.get(i) != a:
            continue
        value[i] = max(a, floors[i])
        del current[i]
        p, q = before[i], after[i]
        after[p], before[q] = q, p
        floors[p], floors[q] = value[i], value[i]
        if p == 0:
            beside[0].append((value[i], q))
        if q == n - 1:
            beside[1].append((value[i], p))
        for j in (p, q):
            if j in current:
                current[j] = triangle(j)
                heapq.heappush(heap, (current[j], j))
    return value, floors, beside


def effective_areas(x: np.ndarray, y: np.ndarray, weighting: float = ANGLE_WEIGHT) -> np.ndarray:
    """Triangle area, less for sharp angles, at which each vertex drops out; ends never do.

    The area is multiplied by 1 - `weighting` * cosine of the angle at the vertex, so spikes go before bends.
    """
    return drop_least(x, y, np.zeros(len(x)), weighting=weighting)[0]


def _triangles(x: np.ndarray, y: np.ndarray, weighting: float = ANGLE_WEIGHT) -> np.ndarray:
    """Weighted triangle of every inner vertex."""
    ax, ay, bx, by = x[:-2] - x[1:-1], y[:-2] - y[1:-1], x[2:] - x[1:-1], y[2:] - y[1:-1]
    sides = np.hypot(ax, ay) * np.hypot(bx, by)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(sides > 0, np.abs(ax * by - ay * bx) / 2 * (1 - weighting * (ax * bx + ay * by) / sides), 0.0)


def _cuts_of_block(rows: pd.DataFrame) -> pd.DataFrame:
    """The vertex of a block farthest from the line between its ends, and the median triangle of the block."""
    rows = rows.sort_values("pos")
    x, y = rows["x"].to_numpy(), rows["y"].to_numpy()
    far = 1 + int(np.argmax(_distances(x[1:-1], y[1:-1], x[0], y[0], x[-1], y[-1])))
    return rows.iloc[[far]].assign(mid=float(np.median(np.maximum(_triangles(x, y), rows["floor"].to_numpy()[1:-1]))))


def _rank_long(vertices: DataFrame, key: list[str], limit: int) -> DataFrame:
    """Values of the vertices (key, pos, x, y) of lines too long for a task, as `effective_areas` of the whole line gives them.

    Rounds: each block of a line names a prominent vertex as a cut, and the parts between cuts drop their vertices up to the median triangle
    of the line, each in a task.  The parts are independent as long as no cut would have dropped out itself, which is checked from the
    neighbours that both sides report; where one would have, the line's round is void and tried up to a smaller triangle.  Lines short enough, or
    of which nothing more can be dropped so (all triangles equal), end in one task.
    """
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vertices.schema.fields if f.name in key)
    state = vertices.withColumns({"floor": F.lit(0.0), "shrink": F.lit(1.0)})
    done: DataFrame | None = None
    block = max(4, limit // 2)
    ends = f"{names}, kind int, part long, pos long, x double, y double, floor double, shrink double, value double, side int, t double"

    def finish(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        value, _, _ = drop_least(rows["x"].to_numpy(), rows["y"].to_numpy(), rows["floor"].to_numpy())
        return rows[[*key, "pos"]].assign(value=value)

    def drop(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos").reset_index(drop=True)
        x, y = rows["x"].to_numpy(), rows["y"].to_numpy()
        value, floors, beside = drop_least(x, y, rows["floor"].to_numpy(), float(rows["most"].iloc[0]))
        own = rows[[*key, "part", "pos", "x", "y", "shrink"]].assign(floor=floors, value=value, kind=0, side=0, t=0.0)
        told = []
        for side, at in ((0, 0), (1, len(rows) - 1)):
            for t, j in beside[side]:
                told.append(rows.iloc[[at]][[*key, "part", "pos", "shrink"]].assign(x=x[j], y=y[j], floor=floors[at], value=0.0, kind=1, side=side, t=t))
        out = pd.concat([own, *told], ignore_index=True)
        return out[[*key, "kind", "part", "pos", "x", "y", "floor", "shrink", "value", "side", "t"]]

    def holds(rows: pd.DataFrame) -> pd.DataFrame:
        """Does a cut outlast the round?  Its neighbours after it (side 0) and before it (side 1) come with their times."""
        me = rows[rows["kind"] == 2].iloc[0]
        steps = sorted(rows[rows["kind"] == 1][["t", "side", "x", "y"]].itertuples(index=False), key=lambda r: r.t)
        near, good = {}, True
        for k, r in enumerate(steps):
            near[r.side] = (r.x, r.y)
            later = steps[k + 1].t if k + 1 < len(steps) else float(me["most"])
            if len(near) == 2 and (k + 1 == len(steps) or later > r.t):
                area = _triangles(np.array([near[1][0], me["x"], near[0][0]]), np.array([near[1][1], me["y"], near[0][1]]))[0]
                good &= bool(area > later)
        return pd.DataFrame([{**{c: me[c] for c in key}, "good": good}])
    while True:
        state = materialize(state, "long-lines")
        sizes = materialize(state.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min("pos").alias("_low"), F.max("pos").alias("_high")), "long-sizes")
        short = sizes.filter((F.col("_n") <= limit) | F.col("_n").isNull()).select(*key)
        stuck = state.filter("shrink < 1e-6").select(*key).distinct()
        last = materialize(short.unionByName(stuck).distinct(), "long-last")
        ended = materialize(state.join(last, key, "left_semi").groupBy(*key).applyInPandas(finish, f"{names}, pos long, value double"), "long-values")
        done = ended if done is None else done.unionByName(ended)
        state = state.join(last, key, "left_anti")
        if state.isEmpty():
            return done
        # blocks of about `block` vertices: consecutive cells of places with their counts
        wide = sizes.select(*key, "_low", ((F.col("_high") - F.col("_low") + 1) / F.col("_n") * (block / 8)).alias("_cell"))
        placed = state.join(wide, key).withColumn("_c", F.floor((F.col("pos") - F.col("_low")) / F.col("_cell")).cast("long")).drop("_low", "_cell")
        cells = placed.groupBy(*key, "_c").agg(F.count(F.lit(1)).alias("_k"))
        upto = F.sum("_k").over(W.partitionBy(*key).orderBy("_c"))
        blocks = cells.select(*key, "_c", F.floor((upto - 1) / block).cast("long").alias("block"))
        placed = materialize(placed.join(blocks, [*key, "_c"]).drop("_c"), "long-blocks")
        large = placed.groupBy(*key, "block").agg(F.count(F.lit(1)).alias("_k")).filter("_k > 2").select(*key, "block")
        cut_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields) + ", mid double"
        cuts = materialize(placed.join(large, [*key, "block"], "left_semi").groupBy(*key, "block").applyInPandas(_cuts_of_block, cut_schema), "long-cuts")
        most = cuts.groupBy(*key).agg((F.percentile_approx("mid", 0.5) * F.min("shrink")).alias("most"))
        cut_of = cuts.select(*key, "block", F.col("pos").alias("_cut"))
        # the last cut before a vertex names its part; a cut also ends the part before
        order = W.partitionBy(*key).orderBy("block")
        bounds = cut_of.withColumn("_before", F.coalesce(F.lag("_cut").over(order), F.lit(-1).cast("long")))
        spans = placed.select(*key, "block").distinct().join(bounds, [*key, "block"], "left").withColumn(
            "_before", F.coalesce("_before", F.last("_cut", True).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(-1).cast("long")))
        tagged = placed.join(spans, [*key, "block"]).withColumn("part", F.when(F.col("pos") >= F.col("_cut"), F.col("_cut")).otherwise(F.col("_before")))
        both = F.when(F.col("pos") == F.col("_cut"), F.array("part", "_before")).otherwise(F.array("part"))
        parts = tagged.withColumn("part", F.explode(both)).join(most, key).drop("_cut", "_before", "block")
        dropped = materialize(parts.groupBy(*key, "part").applyInPandas(drop, ends), "long-drops")
        inner = cuts.select(*key, "pos", "x", "y").join(most, key).withColumns({"kind": F.lit(2), "side": F.lit(0), "t": F.lit(0.0)})
        seen = dropped.filter("kind = 1").withColumn("most", F.lit(0.0)).select(*key, "pos", "x", "y", "most", "kind", "side", "t").join(
            cuts.select(*key, "pos"), [*key, "pos"], "left_semi")
        verdict = inner.unionByName(seen).groupBy(*key, "pos").applyInPandas(holds, f"{names}, good boolean")
        good = materialize(verdict.groupBy(*key).agg(F.bool_and("good").alias("good")), "long-verdicts")
        judged = dropped.filter("kind = 0").join(good, key)
        out = judged.filter("good and value <> double('infinity')").select(*key, "pos", "value")
        done = done.unionByName(materialize(out, "long-values"))
        # a cut is in two parts: it takes the larger floor
        kept = judged.filter("good and value = double('infinity')").groupBy(*key, "pos").agg(
            F.first("x").alias("x"), F.first("y").alias("y"), F.max("floor").alias("floor"), F.min("shrink").alias("shrink"))
        again = state.join(good.filter("not good"), key, "left_semi").withColumn("shrink", F.col("shrink") / 4)
        fewer = out.select(*key).distinct().withColumn("_any", F.lit(True))
        kept = kept.join(fewer, key, "left").withColumn("shrink", F.when(F.col("_any"), F.lit(1.0)).otherwise(F.col("shrink") * 0.0)).drop("_any")
        state = kept.select(*state.columns).unionByName(again.select(*state.columns))


def _measure_arcs(edges: DataFrame, arc_key: list[str], measure) -> DataFrame:
    """Vertices (the last one of each arc left out) with the value `measure` gives them.

    Arcs are hashed to partitions and sorted there; a task reads them batch by batch and holds one
    unfinished arc at most.
    """
    def values(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        x1, y1, x2, y2, scale = (pdf[c].to_numpy() for c in [*T.COORDS, "scale"])
        out = np.full(len(pdf), np.inf)
        stops = np.append(starts[1:], len(pdf))
        for a, b in zip(starts[stops - starts > 1], stops[stops - starts > 1]):
            x, y = np.append(x1[a:b], x2[b - 1]), np.append(y1[a:b], y2[b - 1])
            step = 1 if _canonical(x, y) else -1
            out[a:b] = measure(x[::step] * scale[a], y[::step] * METRES_PER_DEGREE)[::step][:-1]
        return pdf.assign(value=out).drop(columns=["x2", "y2"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            pdf = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            changed = (pdf[arc_key] != pdf[arc_key].shift()).any(axis=1).to_numpy()
            starts = np.flatnonzero(changed)
            if len(starts) > 1:
                yield values(pdf.iloc[:starts[-1]], starts[:-1])
            rest = pdf.iloc[starts[-1]:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield values(rest, np.array([0]))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in edges.schema.fields
                       if f.name not in ("x2", "y2")) + ", value double"
    return edges.repartition(*arc_key).sortWithinPartitions(*arc_key, "seq").mapInPandas(run, schema)


def _divide_long(arc_edges: DataFrame, key: list[str], tolerance: float, limit: int) -> DataFrame:
    """Douglas-Peucker rounds by aggregate for arcs above the limit: split at the farthest vertex.

    Adds `part`; parts are short enough for the kernel and are what its recursion would reach.
    Parts whose vertices are all near enough keep their ends only.
    """
    state = arc_edges.withColumn("part", F.lit(0).cast("long"))
    while True:
        sizes = state.groupBy(*key, "part").agg(
            F.count(F.lit(1)).alias("_n"), F.min_by(F.struct("x1", "y1"), "seq").alias("_a"),
            F.max_by(F.struct("x2", "y2"), "seq").alias("_b"), F.min("seq").alias("_first"))
        long = materialize(sizes.filter(F.col("_n") > limit), "long-arcs")
        if long.isEmpty():
            return state
        cos, m = F.col("scale"), float(METRES_PER_DEGREE)
        px, py = F.col("x1") * cos, F.col("y1") * m
        ax, ay = F.col("_a.x1") * cos, F.col("_a.y1") * m
        bx, by = F.col("_b.x2") * cos, F.col("_b.y2") * m
        dx, dy = bx - ax, by - ay
        t = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)))), F.lit(0.0))
        d = G.planar_length(px, py, ax + t * dx, ay + t * dy)
        inner = spread_join(state, long, [*key, "part"]).filter(F.col("seq") > F.col("_first"))
        far = inner.groupBy(*key, "part").agg(F.max_by(F.struct("seq", d.alias("d")), F.struct(d, "x1", "y1")).alias("_far"))
        cut = materialize(far.select(*key, "part", F.col("_far.seq").alias("_cut"), (F.col("_far.d") > tolerance).alias("_split")), "arc-cuts")
        joined = spread_join(state, cut, [*key, "part"], "left")
        part = F.when(F.coalesce("_split", F.lit(False)) & (F.col("seq") >= F.col("_cut")), F.col("_cut")).otherwise(F.col("part"))
        flat = spread_join(joined.withColumn("part", part), long.select(*key, "part", "_a", "_b", "_first"), [*key, "part"], "left")
        drop = F.coalesce(~F.col("_split"), F.lit(False))
        # a flat part becomes the single edge between its ends
        kept = flat.filter(~drop | (F.col("seq") == F.col("_first"))).withColumn(
            "x2", F.when(drop, F.col("_b.x2")).otherwise(F.col("x2"))).withColumn(
            "y2", F.when(drop, F.col("_b.y2")).otherwise(F.col("y2")))
        state = materialize(kept.select(*arc_edges.columns, "part"), "arc-parts")


def _close_rings(kept: DataFrame, original: DataFrame, key: list[str]) -> DataFrame:
    """Closed rings with at least three corners; the largest ring of a feature is kept whatever happens."""
    ring = [*key, "poly", "ring"]
    sizes = kept.groupBy(*ring).agg(F.count(F.lit(1)).alias("_n"))
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    areas = original.groupBy(*ring).agg(F.abs(F.sum(cross)).alias("_area"))
    # one row a ring tells what becomes of it; a polygon is gone once its shell is
    size = F.struct(F.col("_area").alias("a"), (-F.col("poly")).alias("p"), (-F.col("ring")).alias("r"))
    told = areas.join(sizes, ring, "left").select(*ring, size.alias("_size"), (F.coalesce("_n", F.lit(0)) >= 3).alias("_whole"))
    told = told.withColumn("_there", F.col("_whole") | (F.col("_size") == F.max("_size").over(W.partitionBy(*key))))
    shell = F.max(F.col("_there") & (F.col("ring") == 0)).over(W.partitionBy(*key, "poly"))
    told = materialize(told.withColumn("_shell", shell).filter("_there and _shell").select(*ring, "_whole"), "ring-verdicts")
    rows = kept.select(*ring, "seq", F.col("x1").alias("x"), F.col("y1").alias("y")).join(told.filter("_whole").select(*ring), ring, "left_semi")
    collapsed = told.filter("not _whole").select(*ring)
    if not collapsed.isEmpty():
        rows = rows.unionByName(original.join(collapsed, ring, "left_semi").select(*ring, "seq", F.col("x1").alias("x"), F.col("y1").alias("y")))
    rows = materialize(rows, "ring-rows")
    ends = rows.groupBy(*ring).agg(F.min_by(F.struct("x", "y"), "seq").alias("_v"), F.max("seq").alias("_s")).select(
        *ring, (F.col("_s") + 1).alias("seq"), "_v.*")
    return rows.unionByName(ends)


def simplify(features: DataFrame, ids: list[str], layer: list[str], metres: float = 100.0,
             kernel_vertices: int = KERNEL_VERTICES) -> DataFrame:
    """Douglas-Peucker with a tolerance in metres."""
    key = [*layer, *ids]
    arc_key = [*key, "poly", "ring", "arc"]
    turned, short = _arcs(features, ids, layer)
    edges = materialize(with_scale(turned, arc_key, short), "arcs")
    parts = _divide_long(edges, arc_key, metres, kernel_vertices)
    measured = _measure_arcs(parts, [*arc_key, "part"], lambda x, y: douglas_peucker(x, y, metres).astype(float))
    kept = materialize(measured.filter(F.col("value") > 0), "kept")
    return assemble(_close_rings(kept, edges, key), key)


def _largest(vertices: DataFrame, layer: list[str], fraction: float) -> DataFrame:
    """layer, x1, y1 of the share of vertices with the largest values in each layer, exactly; ties go by a hash of the vertex."""
    values = vertices.groupBy(*layer, "value").agg(F.count(F.lit(1)).alias("_n"))
    placed = running_sums(numbered(values, "value", "_no", layer), layer, "_no", {"_upto": F.col("_n")})
    goals = vertices.groupBy(*layer).agg((F.count(F.lit(1)) - F.round(F.count(F.lit(1)) * fraction)).cast("long").alias("_drop"))
    cuts = placed.join(goals, layer).filter((F.col("_upto") > F.col("_drop")) & (F.col("_upto") - F.col("_n") <= F.col("_drop")))
    cuts = materialize(cuts.select(*layer, F.col("value").alias("_cut"), (F.col("_upto") - F.col("_drop")).alias("_quota")), "cuts")
    ranked = spread_join(vertices, cuts, layer)
    ties = ranked.filter("value = _cut").select(*layer, "x1", "y1", "_quota", F.xxhash64("x1", "y1").alias("_hash"))
    held = numbered(ties, "_hash", "_rank", layer).filter("_rank <= _quota")
    return ranked.filter("value > _cut").select(*layer, "x1", "y1").unionByName(held.select(*layer, "x1", "y1"))


def _measure_long(edges: DataFrame, arc_key: list[str], limit: int) -> DataFrame:
    """Rows of `_measure_arcs` for arcs above the limit, in the arc's fixed direction."""
    first, last = F.min("seq"), F.max("seq")
    spans = edges.groupBy(*arc_key).agg(first.alias("_first"), last.alias("_last"))
    at = edges.join(spans, arc_key)
    corner = lambda test, x, y: F.max(F.when(test, F.struct(F.col(x).alias("x"), F.col(y).alias("y"))))
    is_first, is_last = F.col("seq") == F.col("_first"), F.col("seq") == F.col("_last")
    turns = at.groupBy(*arc_key, "_first", "_last").agg(
        corner(is_first, "x1", "y1").alias("_a"), corner(is_last, "x2", "y2").alias("_b"), corner(is_first, "x2", "y2").alias("_a2"), corner(is_last, "x1", "y1").alias("_b2"))
    closed = (F.col("_a") == F.col("_b")) & (F.col("_last") > F.col("_first"))
    ahead = F.when(closed, F.col("_a2") <= F.col("_b2")).otherwise(F.col("_a") <= F.col("_b"))
    turns = turns.withColumn("_ahead", ahead).drop("_a", "_b", "_a2", "_b2")
    placed = edges.join(turns, arc_key)
    place = lambda seq: F.when(F.col("_ahead"), seq - F.col("_first")).otherwise(F.col("_last") + 1 - seq).cast("long")
    points = placed.select(*arc_key, place(F.col("seq")).alias("pos"), (F.col("x1") * F.col("scale")).alias("x"), (F.col("y1") * float(METRES_PER_DEGREE)).alias("y"))
    tails = placed.filter(F.col("seq") == F.col("_last")).select(*arc_key, place(F.col("seq") + 1).alias("pos"), (F.col("x2") * F.col("scale")).alias("x"),
                                                                 (F.col("y2") * float(METRES_PER_DEGREE)).alias("y"))
    values = _rank_long(points.unionByName(tails), arc_key, limit)
    out = placed.withColumn("pos", place(F.col("seq"))).join(values, [*arc_key, "pos"])
    return out.drop("pos", "_first", "_last", "_ahead", "x2", "y2")


def simplify_fraction(features: DataFrame, ids: list[str], layer: list[str], fraction: float = 0.10,
                      kernel_vertices: int = KERNEL_VERTICES) -> DataFrame:
    """Keep the given share of the removable vertices of each layer, those with the largest weighted triangles.

    A vertex that several units share is one vertex.  Arcs above `kernel_vertices` are measured in parts, with the same values.
    """
    key = [*layer, *ids]
    arc_key = [*key, "poly", "ring", "arc"]
    turned, short = _arcs(features, ids, layer)
    edges = materialize(with_scale(turned, arc_key, short), "arcs")
    long = materialize(edges.groupBy(*arc_key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > kernel_vertices).select(*arc_key), "long-arcs")
    if long.isEmpty():
        measured = _measure_arcs(edges, arc_key, effective_areas)
    else:
        short = _measure_arcs(edges.join(long, arc_key, "left_anti"), arc_key, effective_areas)
        measured = short.unionByName(_measure_long(edges.join(long, arc_key, "left_semi"), arc_key, kernel_vertices).select(*short.columns))
    measured = materialize(measured, "areas")
    fixed = F.col("value") == float("inf")
    vertices = materialize(measured.filter(~fixed).groupBy(*layer, "x1", "y1").agg(F.max("value").alias("value")), "vertices")
    chosen = materialize(_largest(vertices, layer, fraction), "chosen")
    kept = measured.filter(fixed).unionByName(measured.filter(~fixed).join(chosen, [*layer, "x1", "y1"], "left_semi"))
    closed = materialize(_close_rings(materialize(kept, "kept"), edges, key), "closed")
    return assemble(closed, key)
