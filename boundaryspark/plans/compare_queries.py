"""Queries that compare two sources: envelopes, overlaps, matches, points in polygons."""

from __future__ import annotations

from pyspark.sql import functions as F

from boundaryspark.functions import geometry as G
from boundaryspark.operators import compare as M
from boundaryspark.operators import edges as E
from boundaryspark.operators import layers as L
from boundaryspark.operators import spatial as P
from boundaryspark.plans.inputs import features, table, with_inputs
from boundaryspark.plans.layer_queries import FEATURE_SQL
from boundaryspark.plans.registry import query

DX, DY = 3.7, 0.11


def left_features(spark, sf_dir):
    return features(spark, sf_dir, "ADM1").withColumn("left_id", F.col("uid"))


def right_features(spark, sf_dir):
    moved = features(spark, sf_dir, "ADM1").withColumn("geom", G.map_points("geom", lambda v: G.xy(v["x"] + DX, v["y"] + DY)))
    return moved.withColumn("right_id", F.col("uid"))


def overlaps(spark, sf_dir):
    return P.overlap_join(E.explode_edges(left_features(spark, sf_dir), ["left_id"]),
                          E.explode_edges(right_features(spark, sf_dir), ["right_id"]), "left_id", "right_id")


# Overlap area in plain SQL: every pair of edges, signed, over the whole common x-range.
_PROJ = FEATURE_SQL["p"].split("SELECT *,")[1].split("FROM")[0]
_TERM = """(least(l.xr, r.xr) - greatest(l.xl, r.xl)) / 2 * CASE WHEN (fa - ga) * (fb - gb) >= 0 THEN least(fa, ga) + least(fb, gb)
 ELSE (least(fa, ga) + fa + t * (fb - fa)) * t + (fa + t * (fb - fa) + least(fb, gb)) * (1 - t) END"""


def _edges_cte(name, dx, dy):
    return {
        f"{name}_p": f"SELECT *, ax / 1000 AS px, ay / 1000 + 20000 AS py FROM (SELECT uid, poly, ring, seq, {_PROJ} FROM (SELECT uid, poly, ring, seq, x + {dx}e0 AS x, y + {dy}e0 AS y FROM fx_vertex WHERE adm = 'ADM1'))",
        f"{name}_e": f"SELECT * FROM (SELECT uid, px AS x1, py AS y1, lead(px) OVER w AS x2, lead(py) OVER w AS y2 FROM {name}_p WINDOW w AS (PARTITION BY uid, poly, ring ORDER BY seq)) WHERE x2 IS NOT NULL",
        f"{name}_a": f"SELECT uid, sum((x1 - x2) * (y1 + y2)) / 2 AS area, min(x1) AS bx0, max(x1) AS bx1, min(y1) AS by0, max(y1) AS by1 FROM {name}_e GROUP BY 1",
        f"{name}_s": f"SELECT uid, least(x1, x2) AS xl, greatest(x1, x2) AS xr, CASE WHEN x1 < x2 THEN y1 ELSE y2 END AS yl, CASE WHEN x1 < x2 THEN y2 ELSE y1 END AS yr, CASE WHEN x1 > x2 THEN 1 ELSE -1 END AS w FROM {name}_e WHERE x1 <> x2",
    }


OVERLAP_SQL = {
    **_edges_cte("l", 0, 0), **_edges_cte("r", DX, DY),
    "cand": "SELECT l.uid AS left_id, r.uid AS right_id, l.area AS a1, r.area AS a2 FROM l_a l JOIN r_a r ON l.bx0 <= r.bx1 AND r.bx0 <= l.bx1 AND l.by0 <= r.by1 AND r.by0 <= l.by1",
    "pairs": """SELECT left_id, right_id, a1, a2, l.w * r.w AS w, l.xl AS lxl, l.xr AS lxr, r.xl AS rxl, r.xr AS rxr,
 l.yl + (greatest(l.xl, r.xl) - l.xl) * (l.yr - l.yl) / (l.xr - l.xl) AS fa, l.yl + (least(l.xr, r.xr) - l.xl) * (l.yr - l.yl) / (l.xr - l.xl) AS fb,
 r.yl + (greatest(l.xl, r.xl) - r.xl) * (r.yr - r.yl) / (r.xr - r.xl) AS ga, r.yl + (least(l.xr, r.xr) - r.xl) * (r.yr - r.yl) / (r.xr - r.xl) AS gb
 FROM cand JOIN l_s l ON l.uid = left_id JOIN r_s r ON r.uid = right_id AND l.xl < r.xr AND r.xl < l.xr""",
    "ov": f"""SELECT left_id, right_id, a1, a2, isec, isec / (a1 + a2 - isec) AS equality, isec / a1 AS within, isec / a2 AS contains FROM (
 SELECT left_id, right_id, a1, a2, sum(w * {_TERM.replace('l.x', 'lx').replace('r.x', 'rx')}) AS isec FROM (SELECT *, CASE WHEN (fa - ga) * (fb - gb) < 0 THEN (fa - ga) / ((fa - ga) - (fb - gb)) END AS t FROM pairs) GROUP BY ALL) WHERE isec > 1e-6""",
    "best_l": "SELECT left_id, arg_max(right_id, (round(equality, 9), -right_id)) AS right_id FROM ov WHERE equality >= 0.01 GROUP BY 1",
    "best_r": "SELECT right_id, arg_max(left_id, (round(equality, 9), -left_id)) AS left_id FROM ov WHERE equality >= 0.01 GROUP BY 1",
    "best": "SELECT u.uid AS left_id, o.right_id, o.equality, o.within, o.contains FROM l_a u LEFT JOIN (SELECT ov.* FROM ov JOIN best_l USING (left_id, right_id) JOIN best_r USING (left_id, right_id)) o ON u.uid = o.left_id",
}


def overlap_sql(body):
    return with_inputs("fx_vertex", body, OVERLAP_SQL)


_R = "round({0}, 6) AS {0}"
_RATIOS = ", ".join(_R.format(c) for c in ("equality", "within", "contains"))


def _ratios():
    return [F.round(c, 6).alias(c) for c in ("equality", "within", "contains")]


@query("overlap_join", overlap_sql(f"SELECT left_id, right_id, round(isec, 2) AS isec, round(a1, 2) AS a1, round(a2, 2) AS a2, {_RATIOS} FROM ov"))
def overlap_join(spark, sf_dir):
    return overlaps(spark, sf_dir).select("left_id", "right_id", *[F.round(c, 2).alias(c) for c in ("isec", "a1", "a2")], *_ratios())


@query("bbox_join", with_inputs("fx_unit", f"""SELECT l.uid AS left_id, r.uid AS right_id FROM fx_unit l JOIN fx_unit r ON l.adm = 'ADM1' AND r.adm = 'ADM2'
 AND l.x0 <= r.x1 + {DX}e0 AND r.x0 + {DX}e0 <= l.x1 AND l.y0 <= r.y1 + {DY}e0 AND r.y0 + {DY}e0 <= l.y1"""))
def bbox_join(spark, sf_dir):
    right = features(spark, sf_dir, "ADM2").withColumn("right_id", F.col("uid"))
    moved = L.with_bounds(right).select("right_id", (F.col("xmin") + DX).alias("xmin"), (F.col("xmax") + DX).alias("xmax"),
                                        (F.col("ymin") + DY).alias("ymin"), (F.col("ymax") + DY).alias("ymax"))
    return P.bbox_join(L.with_bounds(left_features(spark, sf_dir)), moved, ["left_id"], ["right_id"], 5.0)


@query("point_in_boundary", with_inputs("fx_edge", """
SELECT event_id, adm, uid FROM (SELECT event_id, (event_id * 7919 % 100003) / 1000.0e0 - 50 AS px, (event_id * 104729 % 100019) / 1000.0e0 - 50 AS py FROM events) p
JOIN fx_edge e ON (y1 > py) <> (y2 > py) AND px < x1 + (py - y1) * (x2 - x1) / (y2 - y1) GROUP BY ALL HAVING count(*) % 2 = 1"""))
def point_in_boundary(spark, sf_dir):
    points = table(spark, sf_dir, "events").select(
        "event_id", ((F.col("event_id") * 7919 % 100003) / 1000.0 - 50).alias("x"), ((F.col("event_id") * 104729 % 100019) / 1000.0 - 50).alias("y"))
    edges = E.explode_edges(features(spark, sf_dir), ["adm", "uid"])
    # rings as given: holes of the fixture run clockwise, shells counter-clockwise
    return P.point_in_boundary(points, edges, ["event_id"], ["adm", "uid"])


def _best(spark, sf_dir):
    return M.best_matches(overlaps(spark, sf_dir), left_features(spark, sf_dir), "left_id", "right_id")


@query("best_matches", overlap_sql(f"SELECT left_id, right_id, {_RATIOS} FROM best"))
def best_matches(spark, sf_dir):
    return _best(spark, sf_dir).select("left_id", "right_id", *_ratios())


@query("rank_relations", overlap_sql("""SELECT left_id, right_id, round(within, 6) AS within, row_number() OVER (PARTITION BY left_id ORDER BY round(within, 9) DESC, right_id) AS rank FROM ov WHERE within >= 0.05"""))
def rank_relations(spark, sf_dir):
    return M.rank_relations(overlaps(spark, sf_dir), "within", 0.05).select("left_id", "right_id", F.round("within", 6).alias("within"), "rank")


@query("significant_relations", overlap_sql(f"""SELECT left_id, right_id, {_RATIOS}, row_number() OVER (PARTITION BY left_id ORDER BY round(ov.equality, 9) DESC, right_id) AS rank
FROM ov WHERE within >= 0.01 OR contains >= 0.01"""))
def significant_relations(spark, sf_dir):
    return M.significant_relations(overlaps(spark, sf_dir)).select("left_id", "right_id", *_ratios(), "rank")


@query("total_agreement", overlap_sql("""SELECT round(m, 0) AS match_area, round(i, 0) AS isec_area, round(a + b - i, 0) AS union_area, round(least(100, 100 * m / (a + b - i)), 6) AS percent
FROM (SELECT (SELECT sum(area * within) FROM best JOIN l_a ON uid = left_id) AS m, (SELECT sum(isec) FROM ov) AS i, (SELECT sum(area) FROM l_a) AS a, (SELECT sum(area) FROM r_a) AS b)"""))
def total_agreement(spark, sf_dir):
    left = P.edge_areas(P.equal_area_edges(E.explode_edges(left_features(spark, sf_dir), ["left_id"])), ["left_id"])
    right = P.edge_areas(P.equal_area_edges(E.explode_edges(right_features(spark, sf_dir), ["right_id"])), ["right_id"])
    pairs = overlaps(spark, sf_dir)
    best = M.best_matches(pairs, left_features(spark, sf_dir), "left_id", "right_id")
    out = M.total_agreement(pairs, best, left, right, "left_id")
    return out.select(*[F.round(c, 0).alias(c) for c in ("match_area", "isec_area", "union_area")], F.round("percent", 6).alias("percent"))


@query("unmatched_units", overlap_sql("SELECT uid AS right_id FROM r_a WHERE uid NOT IN (SELECT right_id FROM best WHERE right_id IS NOT NULL)"))
def unmatched_units(spark, sf_dir):
    return M.unmatched_units(right_features(spark, sf_dir).select("right_id"), _best(spark, sf_dir), "right_id")


@query("matched_units", overlap_sql("SELECT left_id FROM best WHERE right_id IS NOT NULL"))
def matched_units(spark, sf_dir):
    return M.matched_units(left_features(spark, sf_dir).select("left_id"), _best(spark, sf_dir), "left_id", "right_id")
