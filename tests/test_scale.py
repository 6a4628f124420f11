"""Work that has to stay in proportion to the input: thin features, many small groups, many small packages, long texts of one file."""

import io
import zipfile

import pandas as pd
from conftest import frame, ring
from pyspark.sql import functions as F

from boundaryspark.functions import geometry as G
from boundaryspark.operators import edges as E
from boundaryspark.operators import overlay as O
from boundaryspark.operators import spatial as P
from boundaryspark.operators import topology as T
from boundaryspark.runtime import dealt_by_key
from boundaryspark.sources import packages as K


def strips(n, width=0.01, height=20.0):
    return [(str(i), [[ring((i * width, 0), ((i + 1) * width, 0), ((i + 1) * width, height), (i * width, height), (i * width, 0))]]) for i in range(n)]


def test_caps_of_thin_features_are_in_proportion(spark):
    edges = E.explode_edges(frame(spark, strips(400)), ["id"])
    assert P.edge_caps(edges, ["id"], P.choose_cell(edges, ["id"])).count() < 5 * edges.count()


def test_cells_of_two_sides_find_the_same_points(spark):
    edges = E.explode_edges(frame(spark, strips(40)), ["id"])
    points = spark.range(200).select("id", (F.col("id") * 0.002 + 0.0005).alias("x"), (F.col("id") % 19 + 0.5).alias("y")).withColumnRenamed("id", "p")
    found = lambda cell: {tuple(r) for r in P.point_in_boundary(points, edges, ["p"], ["id"], cell).collect()}
    assert found((0.013, 7.0)) == found(3.0) == {(p, str(int((p * 0.002 + 0.0005) / 0.01))) for p in range(200)}


def test_many_small_groups_are_ordered_together(spark, monkeypatch):
    edges = T.dissolve_edges(E.explode_edges(frame(spark, strips(30)), ["id"]), ["id"])
    rows = lambda: {(r["id"], tuple(r["seqs"])) for r in T.order_rings(edges, ["id"]).groupBy("id", "ring_id").agg(F.array_sort(F.collect_list("seq")).alias("seqs")).collect()}
    expected = {(str(i), (0, 1, 2, 3)) for i in range(30)}
    assert rows() == expected
    monkeypatch.setattr(T, "EDGES_AT_ONCE", 7)
    assert rows() == expected


def test_members_of_many_small_packages_are_handed_on_together():
    class Packages:
        def select(self, *_):
            return self

        def mapInPandas(self, run, _):
            return run

    def packed(n):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as archive:
            for name in ("meta.txt", f"{n}.geojson"):
                archive.writestr(name, name)
        return buffer.getvalue()
    batch = pd.DataFrame({"package_id": [str(n) for n in range(50)], "content": [packed(n) if n != 7 else b"no zip" for n in range(50)]})
    frames = list(K.package_members(Packages())([batch, batch]))
    assert len(frames) == 1 and len(frames[0]) == 2 * (49 * 2 + 1)
    assert set(frames[0][frames[0]["package_id"] == "7"]["member"]) == {K.UNREADABLE}


def test_texts_of_one_file_are_dealt_by_key(spark):
    df = spark.range(1000).coalesce(1).select(F.col("id").alias("k"), F.array(F.lit(1), F.lit(2)).alias("lines"))
    dealt = dealt_by_key(df, ["k"], 100)
    assert dealt.rdd.getNumPartitions() == 10 and dealt.agg(F.sum("k")).first()[0] == 499500
    assert dealt_by_key(df, ["k"], 1000).rdd.getNumPartitions() == 1
    counted = dealt.select("k", F.explode("lines").alias("n")).groupBy("k").agg(F.sum("n").alias("n"))
    assert counted._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_many_parts_are_dealt_from_splits_of_one_size(spark):
    df = spark.range(500, numPartitions=1).select((F.col("id") % 250).alias("k"), "id")
    dealt = dealt_by_key(df, ["k"], 2)
    assert dealt.rdd.getNumPartitions() == 250
    parts = dealt.select("k", "id", F.spark_partition_id().alias("p")).collect()
    assert sorted(r["id"] for r in parts) == list(range(500)) and len({(r["k"], r["p"]) for r in parts}) == 250
    # a task that deals to 250 parts sorts its split, so one that streams comes before it
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RebalancePartitions") == 1 and plan.count("RepartitionByExpression") == 1


def test_repair_of_thin_bow_ties_with_holes_on_their_edges(spark):
    def unit(i, width=20 / 36000):
        x0, x1 = -50 + i * width, -50 + i * width + width
        at = lambda fx, fy: (x0 * (1 - fx) + x1 * fx, -50.0 * (1 - fy) - 30.0 * fy)
        shell = [at(0, 0), at(1, 1), at(1, 0), at(0, 1), at(0, 0)]
        return str(i), [[shell, [at(0.4, 0.2), at(0.4, 0.4), at(0.6, 0.4), at(0.6, 0.2), at(0.4, 0.2)]]]
    repaired = O.repair(frame(spark, [unit(i) for i in range(0, 3000, 10)]), ["id"]).select((G.planar_area("geom") / (20 * 20 / 36000)).alias("share"))
    low, high, n = repaired.agg(F.min("share"), F.max("share"), F.count("share")).first()
    assert n == 300 and abs(low - 0.54) < 1e-6 and abs(high - 0.54) < 1e-6


def test_steps_of_a_ring_are_worked_out_once(spark):
    # a list named again inside the loop over a ring would be built anew for each vertex
    ragged = [[ring((0, 0), (0, 0), (0, 2), (2, 2), (2, 2), (2, 0))]]
    cleaned = frame(spark, [("a", ragged)]).select(G.clean_rings("geom").alias("geom"))
    assert cleaned._jdf.queryExecution().analyzed().toString().count("zip_with(") == 2
    assert [(v["x"], v["y"]) for v in cleaned.first()[0][0][0]] == [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]


def test_overlay_of_lines_apart_by_rounding(spark):
    # 3.7 is 444 of these widths, so that lines of both sides lie on each other but for rounding
    wide = 20.0 / 2400
    box = lambda i, dx, dy: [[ring(*[(-50 + (i + a) * wide + dx, b + dy) for a, b in ((0, 0), (1, 0), (1, 20), (0, 20), (0, 0))])]]
    left = frame(spark, [(str(i), box(i, 0.0, 0.0)) for i in range(440, 520)]).withColumnRenamed("id", "l")
    right = frame(spark, [(str(i), box(i, 3.7, 0.11)) for i in range(0, 60)]).withColumnRenamed("id", "r")
    areas = {}
    for how in ("intersection", "difference", "union"):
        out = O.overlay(left, right, "l", "r", how).select("l", "r", F.round(G.planar_area("geom"), 5).alias("a"))
        areas[how] = {(int(r["l"]), int(r["r"])): r["a"] for r in out.collect()}
    assert areas["intersection"] == {(i + 444, i): round(wide * 19.89, 5) for i in range(60)}
    assert all(areas["difference"][(i + 444, i)] == round(wide * 0.11, 5) for i in range(60))
    assert all(areas["union"][(i + 444, i)] == round(wide * 20.11, 5) for i in range(60))
