import math

import pytest
from conftest import AWAY, BOW, CORNER, DONUT, ELL, HALF_ON, NESTED, RIGHT, SHIFTED, SQUARE, frame, ring
from pyspark.sql import functions as F

from boundaryspark.functions import geometry as G
from boundaryspark.operators import cells
from boundaryspark.operators import edges as E
from boundaryspark.operators import overlay as O
from boundaryspark.operators import simplify as S
from boundaryspark.operators import spatial as P
from boundaryspark.operators import topology as T


def as_dict(df, value):
    keys = [c for c in df.columns if c != value]
    return {tuple(r[k] for k in keys): r[value] for r in df.collect()}


def test_measures(spark):
    df = frame(spark, [("square", SQUARE), ("ell", ELL), ("donut", DONUT)])
    rows = {r["id"]: r for r in df.select("id", G.planar_area("geom").alias("a"), G.planar_perimeter("geom").alias("p"),
                                          G.shell_vertices("geom").alias("n"), G.all_vertices("geom").alias("m")).collect()}
    assert (rows["square"]["a"], rows["square"]["p"]) == (1.0, 4.0)
    assert (rows["ell"]["a"], rows["ell"]["p"]) == (3.0, 8.0)
    assert (rows["donut"]["a"], rows["donut"]["p"]) == (8.0, 16.0)
    assert (rows["donut"]["n"], rows["donut"]["m"]) == (5, 10)


def test_world_area_on_equal_area_projection(spark):
    world = [[ring((-180, -90), (180, -90), (180, 90), (-180, 90), (-180, -90))]]
    area = frame(spark, [("w", world)]).select(G.planar_area(G.project_equal_area("geom")) / 1e6).first()[0]
    assert area == pytest.approx(510065621.7, abs=1)


def test_clean_rings(spark):
    spoiled = [[ring((0, 0), (0, 1), (0, 1), (1, 1), (1, 0))], [ring((5, 5), (6, 5), (5, 5))]]
    cleaned = frame(spark, [("a", spoiled)]).select(G.clean_rings("geom").alias("g")).first()["g"]
    assert len(cleaned) == 1
    shell = [(v["x"], v["y"]) for v in cleaned[0][0]]
    assert shell[0] == shell[-1] and len(shell) == 5
    assert sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(shell, shell[1:])) == 2.0


def test_bounds_tolerance(spark):
    from boundaryspark.operators.layers import filter_by_bounds
    edge = lambda x: [[ring((0, 0), (x, 0), (x, 1), (0, 0))]]
    kept = filter_by_bounds(frame(spark, [("in", edge(180.000001)), ("out", edge(180.1))])).collect()
    assert [r["id"] for r in kept] == ["in"]


def test_assemble_is_inverse_of_explode(spark):
    df = frame(spark, [("donut", DONUT), ("two", SQUARE + AWAY)])
    back = E.assemble(E.explode_vertices(df, ["id"]), ["id"])
    assert as_dict(back, "geom") == as_dict(df, "geom")


PAIRS = {"same": (SQUARE, SQUARE, 1.0), "shifted": (SQUARE, SHIFTED, 0.25), "nested": (SQUARE, NESTED, 0.25), "away": (SQUARE, AWAY, 0.0),
         "edge": (SQUARE, RIGHT, 0.0), "corner": (SQUARE, CORNER, 0.0), "half": (SQUARE, HALF_ON, 0.5), "ring": (ELL, DONUT, 3.0), "hole": (DONUT, NESTED, 0.25)}


@pytest.mark.parametrize("cell", [0.3, 0.5, 7.0])
def test_intersection_areas(spark, cell):
    left = frame(spark, [(n, a) for n, (a, _, _) in PAIRS.items()], "l string")
    right = frame(spark, [(n, b) for n, (_, b, _) in PAIRS.items()], "r string")
    caps = lambda df, i: P.edge_caps(E.explode_edges(df, [i]), [i], cell)
    out = P.intersection_areas(caps(left, "l"), caps(right, "r"), "l", "r", cell)
    got = {r["l"]: r["isec"] for r in out.filter("l = r").collect()}
    for name, (_, _, want) in PAIRS.items():
        assert got.get(name, 0.0) == pytest.approx(want, abs=1e-9), name
    areas = {r["l"]: r["area"] for r in P.cap_areas(caps(left, "l"), ["l"]).collect()}
    assert areas["ring"] == pytest.approx(3.0) and areas["hole"] == pytest.approx(8.0)


def test_crowded_cells_give_the_same(spark, monkeypatch):
    left, right = frame(spark, [("a", ELL)], "l string"), frame(spark, [("b", SHIFTED), ("c", DONUT)], "r string")
    caps = lambda df, i: P.edge_caps(E.explode_edges(df, [i]), [i], 5.0)
    run = lambda: {r["r"]: round(r["isec"], 9) for r in P.intersection_areas(caps(left, "l"), caps(right, "r"), "l", "r", 5.0).collect()}
    whole = run()
    monkeypatch.setattr(cells, "PAIRS_PER_CELL", 2)
    assert run() == whole == {"b": 0.75, "c": 3.0}


def test_point_in_boundary(spark):
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 1.5), (3, 2.5, 2.5), (4, 5.0, 5.0)], "p int, x double, y double")
    edges = E.explode_edges(frame(spark, [("donut", DONUT), ("ell", ELL)]), ["id"])
    got = {(r["p"], r["id"]) for r in P.point_in_boundary(points, edges, ["p"], ["id"], 0.7).collect()}
    assert got == {(1, "donut"), (1, "ell"), (3, "donut")}


def test_dissolve_and_borders(spark):
    df = frame(spark, [("k", 1, SQUARE), ("k", 2, RIGHT), ("d", 3, DONUT)], "k string, u int")
    out = as_dict(T.dissolve(df.drop("u"), ["k"]).select("k", G.planar_area("geom").alias("a")), "a")
    assert out == {("k",): 2.0, ("d",): 8.0}
    borders = T.shared_borders(E.explode_edges(df, ["k", "u"]), "u", ["k"]).collect()
    assert [(r["left_unit"], r["right_unit"], r["edges"]) for r in borders] == [(1, 2, 1)]


def test_dissolve_is_the_union(spark):
    box = lambda a, b, *more: [[ring((a, a), (b, a), *more, (b, b), (a, b), (a, a))]]
    # right of the first box, which has one more vertex on the common border
    beside = [[ring((1, 0), (2, 0), (2, 1), (1, 1), (1, 0))]]
    rows = [("tee", box(0, 1, (1, 0.5))), ("tee", beside), ("overlap", box(0, 2)), ("overlap", box(1, 3)), (None, box(0, 1)),
            ("inside", box(0, 3)), ("inside", box(1, 2)), ("twice", box(0, 1)), ("twice", box(0, 1)), ("plug", DONUT), ("plug", box(1, 2))]
    out = as_dict(T.dissolve(frame(spark, rows, "k string"), ["k"]).select("k", F.round(G.planar_area("geom"), 9).alias("a")), "a")
    assert out == {("tee",): 2.0, ("overlap",): 7.0, (None,): 1.0, ("inside",): 9.0, ("twice",): 1.0, ("plug",): 9.0}


def test_open_chains_are_refused(spark):
    edges = spark.createDataFrame([("k", 0.0, 0.0, 1.0, 0.0), ("k", 1.0, 0.0, 1.0, 1.0)], "k string, x1 double, y1 double, x2 double, y2 double")
    with pytest.raises(ValueError, match="rings"):
        T.order_rings(edges, ["k"])


def test_large_groups_order_like_small_ones(spark):
    edges = T.dissolve_edges(E.explode_edges(frame(spark, [("d", DONUT), ("two", SQUARE + AWAY), ("ell", ELL)]), ["id"]), ["id"])
    shape = lambda limit: as_dict(E.assemble(T.stitch_rings(edges, ["id"], limit), ["id"]).select(
        "id", G.planar_area("geom").alias("a"), G.all_vertices("geom").alias("n"), F.size("geom").alias("parts")).select("id", F.struct("a", "n", "parts").alias("v")), "v")
    assert shape(0) == shape(1000)
    assert tuple(shape(0)[("d",)]) == (8.0, 10, 1)


def test_validity_reasons(spark):
    outside = [[SQUARE[0][0], ring((5, 5), (5, 6), (6, 6), (6, 5), (5, 5))]]
    rows = [("ok", SQUARE), ("donut", DONUT), ("bow", BOW), ("open", [[ring((0, 0), (1, 0), (1, 1), (0, 1))]]), ("short", [[ring((0, 0), (1, 0), (0, 0))]]), ("hole", outside)]
    got = as_dict(T.validity_report(frame(spark, rows), ["id"]).select("id", "reason"), "reason")
    assert got[("ok",)] == "" and got[("donut",)] == ""
    assert "self-crossing" in got[("bow",)] and "open ring" in got[("open",)]
    assert "too few points" in got[("short",)] and "hole outside shell" in got[("hole",)]


@pytest.mark.parametrize("how", ["intersection", "union", "difference"])
def test_overlay_areas(spark, how):
    left = frame(spark, [(n, a) for n, (a, _, _) in PAIRS.items()], "l string")
    right = frame(spark, [(n, b) for n, (_, b, _) in PAIRS.items()], "r string")
    pairs = spark.createDataFrame([(n, n) for n in PAIRS], "l string, r string")
    got = {r["l"]: r["a"] for r in O.overlay(left, right, "l", "r", how, pairs).select("l", G.planar_area("geom").alias("a")).collect()}
    area = {"same": (1, 1), "ring": (3, 8), "hole": (8, 0.25), "nested": (1, 0.25)}
    for name, (_, _, both) in PAIRS.items():
        a, b = area.get(name, (1, 1))
        want = {"intersection": both, "union": a + b - both, "difference": a - both}[how]
        assert got.get(name, 0.0) == pytest.approx(want, abs=1e-9), name


def test_repair_bow_tie(spark):
    out = O.repair(frame(spark, [("bow", BOW), ("ok", DONUT)]), ["id"])
    got = {r["id"]: (round(r["a"], 9), r["parts"]) for r in out.select("id", G.planar_area("geom").alias("a"), F.size("geom").alias("parts")).collect()}
    assert got == {"bow": (2.0, 2), "ok": (8.0, 1)}


def test_fill_gaps(spark):
    small = lambda g: [[[(x / 100, y / 100) for x, y in r] for r in p] for p in g]
    df = frame(spark, [("l", "donut", small(DONUT)), ("l", "far", small(AWAY))], "layer string, id string")
    area = lambda limit: as_dict(T.fill_gaps(df, ["id"], ["layer"], limit).select("id", F.round(G.planar_area("geom") * 1e4, 6).alias("a")), "a")
    assert area(1000.0) == {("donut",): 9.0, ("far",): 1.0}
    assert area(0.001) == {("donut",): 8.0, ("far",): 1.0}


def wavy(n=60):
    return [(1 + 0.00001 * math.sin(9 * i), i / n) for i in range(n + 1)]


def test_simplify_keeps_shared_borders(spark):
    border = wavy()
    left = [[[(0.0, 0.0), *border, (0.0, 1.0), (0.0, 0.0)]]]
    right = [[[(2.0, 0.0), (2.0, 1.0), *border[::-1], (2.0, 0.0)]]]
    df = frame(spark, [("l", "a", left), ("l", "b", right)], "layer string, id string")
    for out in (S.simplify(df, ["id"], ["layer"], 100.0), S.simplify(df, ["id"], ["layer"], 100.0, kernel_vertices=8),
                S.simplify_fraction(df, ["id"], ["layer"], 0.2)):
        got = {r["id"]: [(v["x"], v["y"]) for v in r["geom"][0][0]] for r in out.collect()}
        on_border = lambda pts: {p for p in pts if 0.5 < p[0] < 1.5}
        assert on_border(got["a"]) == on_border(got["b"])
        assert len(got["a"]) < len(border) and got["a"][0] == got["a"][-1]


def test_long_arcs_simplify_like_short_ones(spark):
    coast = [(math.cos(t) * (1 + 0.01 * math.sin(31 * t)), math.sin(t)) for t in [2 * math.pi * i / 200 for i in range(200)]]
    df = frame(spark, [("l", "a", [[coast + coast[:1]]])], "layer string, id string")
    one, many = (S.simplify(df, ["id"], ["layer"], 300.0, kernel_vertices=k).first()["geom"] for k in (10_000, 40))
    assert 10 < len(many[0][0]) < 201
    assert one == many


def test_fraction_is_exact_in_each_layer(spark):
    def ring(size, n):
        pts = [(size * math.cos(t), size * math.sin(t)) for t in [2 * math.pi * i / n for i in range(n)]]
        return [[pts + pts[:1]]]
    straight = [(i / 50, 0.0) for i in range(51)] + [(1.0, 1.0), (0.0, 1.0)]
    rows = [("coarse", "a", ring(5, 400)), ("fine", "a", ring(0.01, 200)), ("ties", "a", [[straight + straight[:1]]])]
    got = {r["layer"]: len(r["geom"][0][0]) for r in S.simplify_fraction(
        frame(spark, rows, "layer string, id string"), ["id"], ["layer"], 0.1).collect()}
    # the share of all vertices but the first, the first, and the closing one
    assert got == {"coarse": 40 + 2, "fine": 20 + 2, "ties": 5 + 2}


def test_composite_names_what_it_cannot_place(spark):
    from boundaryspark.plans.composite import composite_layers
    world = frame(spark, [("Nowhere", SQUARE)], "country_na string").withColumn("fid", F.lit(1))
    layers = frame(spark, [("NOW", "ADM1", "u", "n", SQUARE)], "iso string, adm string, shapeID string, shapeName string")
    names = spark.createDataFrame([("Somewhere", "SOM")], "name string, code string")
    with pytest.raises(ValueError, match="Nowhere"):
        composite_layers(world, layers, names)


def test_tiny_shapes_survive(spark):
    df = frame(spark, [("l", "dot", [[ring((0, 0), (1e-7, 0), (1e-7, 1e-7), (0, 0))]])], "layer string, id string")
    assert S.simplify(df, ["id"], ["layer"], 100.0).count() == 1


def test_crowded_cells_everywhere(spark, monkeypatch):
    """Envelopes, points, crossings and overlays do not change when every cell counts as crowded."""
    from boundaryspark.operators.layers import with_bounds
    shapes = [("s", SQUARE), ("e", ELL), ("d", DONUT), ("b", BOW), ("h", SHIFTED)]
    left, right = frame(spark, shapes, "l string"), frame(spark, shapes, "r string")
    points = spark.createDataFrame([(i, (i % 37) / 11 + 0.013, (i % 29) / 9 + 0.017) for i in range(200)], "p int, x double, y double")
    edges = E.explode_edges(frame(spark, shapes), ["id"])

    def run():
        boxes = {tuple(r) for r in P.bbox_join(with_bounds(left), with_bounds(right), ["l"], ["r"], 5.0).collect()}
        inside = {tuple(r) for r in P.point_in_boundary(points, edges, ["p"], ["id"], 5.0).collect()}
        crossing = {(r["id"], round(r["x"], 9)) for r in T.self_crossings(edges, ["id"], 5.0).collect()}
        return boxes, inside, crossing

    want = run()
    assert len(want[0]) == 25 and want[2] == {("b", 1.0)}
    monkeypatch.setattr(cells, "PAIRS_PER_CELL", 2)
    assert run() == want


def test_repair_query_sees_holes_and_composite_sees_national_layers(spark):
    from boundaryspark.plans.inputs import features
    from boundaryspark.plans.topology_queries import _composite_inputs, repair_bow_ties
    small = "/root/testdata/sf0.001"
    units = {r["uid"]: r["n"] for r in features(spark, small, "ADM2").select("uid", F.size(F.element_at("geom", 1)).alias("n")).collect()}
    rows = {r["uid"]: r for r in repair_bow_ties(spark, small).collect()}
    assert set(rows) == set(units) and 2 in units.values()
    for uid, n in units.items():
        if n == 2 and uid % 17 != 5:
            assert rows[uid]["new_area_km2"] == pytest.approx(rows[uid]["old_area_km2"], rel=1e-6)
    levels = {r["adm"] for r in _composite_inputs(spark, small)[1].select("adm").distinct().collect()}
    assert levels == {"ADM0", "ADM1", "ADM2"}


def test_bow_tie_with_a_hole_keeps_the_hole(spark):
    # two triangles of area 1 each; the hole of 0.04 lies in the left one
    tie = [[ring((0, 0), (2, 2), (2, 0), (0, 2), (0, 0)), ring((0.2, 0.9), (0.2, 1.1), (0.4, 1.1), (0.4, 0.9), (0.2, 0.9))]]
    out = O.repair(frame(spark, [("tie", tie)]), ["id"])
    assert out.select(G.planar_area("geom")).first()[0] == pytest.approx(1.96)


def test_composite_falls_back_to_the_national_layer(spark):
    from boundaryspark.plans.composite import composite_layers
    world = frame(spark, [(1, "Aland", SQUARE), (2, "Bland", RIGHT)], "fid long, country_na string")
    layers = frame(spark, [("A", "ADM0", "A0", "Aland", SQUARE), ("B", "ADM0", "B0", "Bland", RIGHT), ("B", "ADM1", "B1", "b", RIGHT)],
                   "iso string, adm string, shapeID string, shapeName string")
    names = spark.createDataFrame([("Aland", "A"), ("Bland", "B")], "name string, code string")
    out = composite_layers(world, layers, names, keep_share=1.0)
    found = sorted((r["level"], r["shapeGroup"], r["shapeType"], round(r["a"], 6)) for r in out.withColumn("a", G.planar_area("geom")).collect())
    assert found == [("ADM0", "A", "ADM0", 1.0), ("ADM0", "B", "ADM0", 1.0), ("ADM1", "A", "ADM0", 1.0), ("ADM1", "B", "ADM1", 1.0),
                     ("ADM2", "A", "ADM0", 1.0), ("ADM2", "B", "ADM1", 1.0)]


def test_wide_boxes_in_one_cell_meet_once(spark):
    import random
    rng = random.Random(3)
    wide = [(i, rng.uniform(0, 2), rng.uniform(0, 2), rng.uniform(7, 9), rng.uniform(7, 9)) for i in range(1000)]
    small = [(i, x, y, x + 0.05, y + 0.05) for i, x, y in ((i, rng.uniform(0, 9), rng.uniform(0, 9)) for i in range(1000))]
    sides = "xmin double, ymin double, xmax double, ymax double"
    a, b = spark.createDataFrame(wide, f"l int, {sides}"), spark.createDataFrame(wide, f"r int, {sides}")
    assert P.bbox_join(a, b, ["l"], ["r"], 10.0).count() == 1_000_000
    # before any test of extents: every pair in one block
    laid = lambda df, p: df.select(F.col(df.columns[0]), *[F.col(c).alias(p + c) for c in ("xmin", "ymin", "xmax", "ymax")], F.lit(0).alias("col"), F.lit(0).alias("row"))
    axes = [("col", ("l_xmin", "l_xmax"), ("r_xmin", "r_xmax")), ("row", ("l_ymin", "l_ymax"), ("r_ymin", "r_ymax"))]
    assert cells.meet_in_cells(laid(a, "l_"), laid(b, "r_"), 10.0, ["col", "row"], axes).count() == 1_000_000
    s, t = spark.createDataFrame(small, f"l int, {sides}"), spark.createDataFrame(small, f"r int, {sides}")
    got = {tuple(r) for r in P.bbox_join(s, t, ["l"], ["r"], 10.0).collect()}
    assert got == {(i[0], j[0]) for i in small for j in small if i[1] <= j[3] and j[1] <= i[3] and i[2] <= j[4] and j[2] <= i[4]}
    candidates = cells.meet_in_cells(laid(s, "l_"), laid(t, "r_"), 10.0, ["col", "row"], axes).count()
    assert candidates < 1_000_000 / 2


def test_overlay_copies_only_edges_near_the_other(spark, monkeypatch):
    n = 3000
    circle = [(50 * math.cos(2 * math.pi * i / n), 50 * math.sin(2 * math.pi * i / n)) for i in range(n)]
    mask = frame(spark, [("m", [[ring(*circle, circle[0])]])], "r string")
    box = lambda x, y: [[ring((x, y), (x + 4, y), (x + 4, y + 4), (x, y + 4), (x, y))]]
    units = [(f"{x},{y}", box(x, y)) for x in range(-60, 60, 5) for y in (-48, -2, 33)]
    left = frame(spark, units, "l string")
    sizes = []
    whole = O.materialize

    def counted(df, name):
        out = whole(df, name)
        if name == "overlay-parts":
            sizes.append(out.count())
        return out
    monkeypatch.setattr(O, "materialize", counted)
    got = {r["l"]: r["a"] for r in O.clip(left, mask, "l", "r").select("l", G.planar_area("geom").alias("a")).collect()}
    # four edges for each unit, crossings, and the mask's edges in the cells of units: not 3,000 for each unit
    assert sizes[1] < 3 * n

    def inside(x, y):
        return x * x + y * y < 50 * 50
    for name, shape in units:
        (x, y) = shape[0][0][0]
        corners = [inside(a, b) for a in (x, x + 4) for b in (y, y + 4)]
        if all(corners):
            assert got[name] == pytest.approx(16.0)
        elif name in got:
            steps = 200
            share = sum(inside(x + 4 * (i + 0.5) / steps, y + 4 * (j + 0.5) / steps) for i in range(steps) for j in range(steps)) / steps ** 2
            assert got[name] == pytest.approx(16 * share, abs=0.1)
    assert sum(1 for name, shape in units if all(inside(a, b) for a in (shape[0][0][0][0], shape[0][0][0][0] + 4) for b in (shape[0][0][0][1], shape[0][0][0][1] + 4))) > 20


@pytest.mark.parametrize("shift", [0.0, 0.37, 0.5, 0.99])
def test_near_vertices_as_by_hand(spark, shift):
    import random
    from boundaryspark.operators import snapping as N
    rng = random.Random(11)
    points = [(round(rng.uniform(0, 12), 2) + shift, round(rng.uniform(0, 12), 2) + shift) for _ in range(60)]
    points += [(x + 1.0, y) for x, y in points[:10]] + [(x + 0.7, y + 0.7) for x, y in points[10:20]] + points[:5]
    # a crowd within one tolerance
    points += [(20 + shift + k / 5000, 20 + shift) for k in range(300)]
    df = spark.createDataFrame([("l", x, y) for x, y in points] + [("m", points[0][0] + 0.1, points[0][1])], "layer string, x double, y double")
    got = {(r["x"], r["y"]): (r["to_x"], r["to_y"]) for r in N.near_vertices(df, ["layer"], 1.0).collect()}
    uses = {}
    for p in points:
        uses[p] = uses.get(p, 0) + 1
    parent = {p: p for p in uses}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p
    for a in uses:
        for b in uses:
            if (a[0] - b[0]) * (a[0] - b[0]) + (a[1] - b[1]) * (a[1] - b[1]) <= 1.0:
                parent[find(a)] = find(b)
    groups = {}
    for p in uses:
        groups.setdefault(find(p), []).append(p)
    want = {p: min(g, key=lambda q: (-uses[q], q)) for g in groups.values() for p in g}
    assert got == {p: to for p, to in want.items() if p != to}


def test_snapped_borders_stay_shared(spark):
    from boundaryspark.operators import snapping as N
    off = 4e-6
    right = [[ring((1 + off, off), (2, 0), (2, 1), (1 - off, 1 + off), (1 + off, off))]]
    df = frame(spark, [("k", 1, SQUARE), ("k", 2, right), ("k", 3, AWAY)], "layer string, u int")
    borders = lambda d: T.shared_borders(E.explode_edges(d, ["layer", "u"]), "u", ["layer"]).count()
    out = N.snap_near(df, ["u"], ["layer"], 2e-5)
    assert borders(df) == 0 and borders(out) == 1 and out.count() == 3


def test_composite_plans_each_part_by_itself(spark, monkeypatch):
    from boundaryspark.plans import composite as P
    plans, materialize = {}, P.materialize

    def recorded(df, name):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        plans[name] = sum(plan.count(step) for step in ("Join", "Aggregate", "Window", "Generate"))
        return materialize(df, name)
    monkeypatch.setattr(P, "materialize", recorded)
    world = frame(spark, [(1, "Aland", SQUARE), (2, "Bland", AWAY), (3, "Cland (disp)", SQUARE)], "fid int, country_na string")
    layers = frame(spark, [("AAA", "ADM1", "u1", "one", SQUARE)], "iso string, adm string, shapeID string, shapeName string")
    names = spark.createDataFrame([("Aland", "AAA"), ("Bland", "BBB")], "name string, code string")
    out = P.composite_layers(world, layers, names, keep_share=1.0)
    assert sorted((r["level"], r["shapeID"]) for r in out.collect()) == sorted(
        [("ADM0", "AAA"), ("ADM0", "BBB"), ("ADM1", "u1"), ("ADM2", "u1"), *[(f"ADM{n}", "DIS001") for n in range(3)]])
    # no plan holds the national layers and the numbering of disputed areas at once
    assert max(plans.values()) <= 40, plans


def test_snapping_writes_its_features_in_parts(spark, monkeypatch):
    from boundaryspark.operators import snapping as N
    files, materialize = {}, N.materialize

    def recorded(df, name):
        out = materialize(df, name)
        files[name] = len(out.inputFiles())
        return out
    monkeypatch.setattr(N, "materialize", recorded)
    monkeypatch.setattr(N, "FEATURES_PER_TASK", 2, raising=False)
    moved = lambda u: [[[(x + 3 * u + 4e-6 * (u % 2), y) for x, y in SQUARE[0][0]]]]
    df = frame(spark, [("k", u, moved(u)) for u in range(12)], "layer string, u int").coalesce(1)
    out = {r["u"]: r["geom"] for r in N.snap_near(df, ["u"], ["layer"], 2e-5).collect()}
    assert sorted(out) == list(range(12)) and all(len(g[0][0]) == 5 for g in out.values())
    assert files["snap-points"] > 1


@pytest.mark.parametrize("kernel", [7, 60, 1000])
def test_rings_by_contraction_as_in_one_task(spark, monkeypatch, kernel):
    coast = lambda cx, cy, r, n: [(cx + r * (1 + 0.2 * math.sin(17 * t)) * math.cos(t), cy + r * (1 + 0.2 * math.sin(17 * t)) * math.sin(t))
                                  for t in [2 * math.pi * i / n for i in range(n)]]
    closed = lambda pts: pts + pts[:1]
    island = [[closed(coast(0, 0, 5, 300)), closed(coast(0, 0, 2, 90)[::-1])], [closed(coast(20, 3, 4, 111))]]
    # two squares that touch in a corner
    tie = [[ring((40, 0), (42, 0), (42, 2), (40, 2), (40, 0))], [ring((42, 2), (44, 2), (44, 4), (42, 4), (42, 2))]]
    small = [[closed(coast(3, 3, 1, 5))]]
    edges = E.explode_edges(frame(spark, [("a", island), ("b", tie), ("c", small)], "k string"), ["k"]).select("k", *T.COORDS)
    noded = T.node_edges(edges.withColumn("no", F.struct(*T.COORDS)), ["k"])
    rows = lambda limit: {(r["k"], r["x1"], r["y1"], r["x2"], r["y2"]): (r["ring_id"], r["seq"]) for r in T.order_rings(noded, ["k"], limit).collect()}

    def rings(found):
        """Rings as sets of edges in order from their first, whatever the edge ids are."""
        out = {}
        for edge, (number, seq) in found.items():
            out.setdefault((edge[0], number), {})[seq] = edge
        assert all(sorted(r) == list(range(len(r))) for r in out.values())
        turn = lambda r: (lambda at: tuple(r[at:] + r[:at]))(r.index(min(r)))
        return sorted(turn([r[i] for i in range(len(r))]) for r in out.values())
    written = []
    whole = T.materialize

    def counted(df, name):
        out = whole(df, name)
        if name in ("ring-level", "ring-links"):
            written.append((name, out.count()))
        return out
    want = rings(rows(200_000))
    monkeypatch.setattr(T, "materialize", counted)
    got = rings(rows(kernel))
    assert got == want and len(want) == 6
    if kernel == 60:  # edges of the key above the limit: 501
        assert sum(n for _, n in written) <= 4 * 501


def test_values_of_long_lines_as_of_whole_ones(spark):
    import random
    import numpy as np
    rng = random.Random(2)

    def walk(n):
        x, y, out = 0.0, 0.0, []
        for _ in range(n):
            x, y = x + rng.uniform(0, 2), y + rng.uniform(-3, 3)
            out.append((x, y))
        return out
    ring_of = [(1000 * math.cos(t) * (1 + 0.05 * math.sin(9 * t) + 0.01 * math.sin(80 * t)), 1000 * math.sin(t)) for t in [2 * math.pi * i / 700 for i in range(701)]]
    lines = {"walk": walk(1500), "other": walk(400), "coast": ring_of, "even": [(math.cos(i / 50), math.sin(i / 50)) for i in range(150)], "straight": [(float(i), 0.0) for i in range(130)]}
    df = spark.createDataFrame([(k, i, *p) for k, line in lines.items() for i, p in enumerate(line)], "line string, pos long, x double, y double")
    got = {(r["line"], r["pos"]): r["value"] for r in S._rank_long(df, ["line"], 100).collect()}
    assert len(got) == sum(map(len, lines.values()))
    for k, line in lines.items():
        want = S.effective_areas(*np.array(line).T)
        assert [got[k, i] for i in range(len(line))] == want.tolist(), k


def test_fraction_of_long_arcs_as_of_short_ones(spark):
    coast = [(5 * math.cos(t) * (1 + 0.02 * math.sin(31 * t)), 5 * math.sin(t) + 0.01 * math.cos(77 * t)) for t in [2 * math.pi * i / 300 for i in range(300)]]
    border = wavy(200)
    left = [[[(0.0, 0.0), *border, (0.0, 1.0), (0.0, 0.0)]]]
    right = [[[(2.0, 0.0), (2.0, 1.0), *border[::-1], (2.0, 0.0)]]]
    df = frame(spark, [("a", "c", [[coast + coast[:1]]]), ("b", "l", left), ("b", "r", right)], "layer string, id string")
    one, many = ({r["id"]: r["geom"] for r in S.simplify_fraction(df, ["id"], ["layer"], 0.2, kernel_vertices=k).collect()} for k in (100_000, 50))
    assert one == many and len(one["c"][0][0]) < 100


def test_only_points_inside_an_edge_cut_it(spark):
    # edges on a line that share an end, ends that only touch, a T, a cross and a part of another edge
    lines = [(0, 0, 2, 0), (2, 0, 5, 0), (5, 0, 5, 3), (1, 0, 1, 4), (0, 2, 3, 2), (3, 2, 0.5, 2)]
    edges = spark.createDataFrame([("l", n, *map(float, e)) for n, e in enumerate(lines)], "layer string, no long, x1 double, y1 double, x2 double, y2 double")
    found = {(r["no"], p["x"], p["y"]) for r in T.inner_splits(edges, ["layer"]).collect() for p in r["points"]}
    assert found == {(0, 1.0, 0.0), (3, 1.0, 2.0), (4, 1.0, 2.0), (4, 0.5, 2.0), (5, 1.0, 2.0)}
    chain = edges.filter("no < 3")
    assert T.inner_splits(chain, ["layer"]).isEmpty()


def test_points_of_an_edge_are_rows(spark):
    # one long edge met by many, once with doubled rows; a part keeps the carried columns
    many = 300
    edges = spark.createDataFrame([("l", 1, 0.0, 0.0, 8.0, 0.0, 2), ("l", 2, 8.0, 0.0, 8.0, 1.0, 3), ("l", 2, 8.0, 0.0, 8.0, 1.0, 3), ("l", 3, 5.0, 5.0, 6.0, 5.0, 1)],
                                  "layer string, no long, x1 double, y1 double, x2 double, y2 double, times long")
    cuts = [("l", 1, [(8.0 * i / many, 0.0)]) for i in range(many + 1)] + [("l", 1, [(4.0, 0.0), (9.0, 0.0)]), ("l", 2, [(8.0, 0.5), (8.0, 0.0)])]
    splits = spark.createDataFrame(cuts, "layer string, no long, points array<struct<x:double,y:double>>")
    out = T.split_edges(edges, splits, ["layer"], carried=["times"])
    at = sorted(8.0 * i / many for i in range(many + 1))
    want = [(a, 0.0, b, 0.0, 2) for a, b in zip(at, at[1:])] + 2 * [(8.0, 0.0, 8.0, 0.5, 3), (8.0, 0.5, 8.0, 1.0, 3)] + [(5.0, 5.0, 6.0, 5.0, 1)]
    assert sorted((r["x1"], r["y1"], r["x2"], r["y2"], r["times"]) for r in out.collect()) == sorted(want)
    placed = {(r["no"], r["part"], r["begins"], r["ends"]) for r in T.split_edges(edges.filter("no > 1").distinct(), splits, ["layer"], places=True).collect()}
    assert placed == {(2, 0, True, True), (2, 1, True, False), (3, 0, False, False)}
    # no row holds all points of an edge, which were compared one by one
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "array_distinct" not in plan


def test_edges_count_as_often_as_they_lie_there(spark):
    edges = E.explode_edges(frame(spark, [("a", SQUARE), ("b", SQUARE), ("c", CORNER)]), ["id"]).withColumn("layer", F.lit("l"))
    twice = T.net_edges(edges, ["layer"])
    once = T.net_edges(twice, ["layer"], F.col("times"))
    rows = lambda df: sorted((r["x1"], r["y1"], r["x2"], r["y2"], r["times"]) for r in df.collect())
    assert rows(once) == rows(twice) and {r[-1] for r in rows(twice)} == {1, 2}
    points = spark.createDataFrame([(0, 0.5, 0.5), (1, 1.5, 1.5), (2, 3.0, 3.0)], "p int, x double, y double").withColumn("layer", F.lit("l"))
    cover = P.point_cover(points, twice, ["layer", "p"], ["layer"], shared=["layer"], times=F.col("times"))
    assert as_dict(cover.select("p", "cover"), "cover") == {(0,): 2, (1,): 1}


def test_pairs_left_out_cut_nothing(spark, monkeypatch):
    import random
    rng = random.Random(4)
    spot = lambda: (rng.choice([0.0, 1.0, 2.0, 3.0, 2.0 + 1e-13, 1e-9]), rng.choice([0.0, 1.0, 2.0, 1.0 + 1e-15, 1e-7]))
    lines = {(*a, *b) for a, b in ((spot(), spot()) for _ in range(160)) if a != b}
    edges = spark.createDataFrame([("l", n, *e) for n, e in enumerate(sorted(lines))], "layer string, no long, x1 double, y1 double, x2 double, y2 double")
    found = lambda: {(r["no"], p["x"], p["y"]) for r in T.inner_splits(edges, ["layer"]).collect() for p in r["points"]}
    got = found()
    # units beside each other: shared sides, corners and borders in a line
    strips = [(str(i), [[ring((i, 0), (i + 1, 0), (i + 1, 9), (i, 9), (i, 0))]]) for i in range(12)]
    side = T.numbered_edges(E.explode_edges(frame(spark, strips), ["id"])).withColumns({"no": F.struct("id", "no"), "layer": F.lit("l")})
    pairs = T.near_pairs(side, side, T.edge_cell(side), ["layer"], ["layer"], shared=["layer"])
    assert pairs.count() > 0 and pairs.filter(T.may_cut()).isEmpty()
    monkeypatch.setattr(T, "may_cut", lambda: F.lit(True))
    assert got == found() and len(got) > 100


def test_rings_in_one_place_as_by_joins(spark, monkeypatch):
    border = wavy(60)
    coast = [(5 * math.cos(t) * (1 + 0.02 * math.sin(31 * t)), 5 * math.sin(t)) for t in [2 * math.pi * i / 80 for i in range(80)]]
    left = [[[(0.0, 0.0), *border, (0.0, 1.0), (0.0, 0.0)]]]
    right = [[[(2.0, 0.0), (2.0, 1.0), *border[::-1], (2.0, 0.0)]]]
    speck = [[ring((7, 7), (7.001, 7), (7.001, 7.001), (7, 7))], [ring((8, 8), (8.001, 8), (8.001, 8.002), (8, 8))]]
    df = frame(spark, [("a", "c", [[coast + coast[:1]]]), ("b", "l", left), ("b", "r", right), ("a", "s", speck)], "layer string, id string")
    found = lambda: {r["id"]: r["geom"] for r in S.simplify_fraction(df, ["id"], ["layer"], 0.2).collect()}
    short = found()
    plan = S.arcs(df, ["id"], ["layer"])._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(S, "RING_AT_ONCE", 1)
    assert short == found() and set(short) == {"c", "l", "r", "s"} and len(short["s"]) >= 1
    assert "Join" not in plan
