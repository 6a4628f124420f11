"""Queries on shared borders, validity, outlines, boolean operations and simplification."""

from __future__ import annotations

from pyspark.sql import functions as F

from boundaryspark.functions import geometry as G
from boundaryspark.operators import edges as E
from boundaryspark.operators import overlay as O
from boundaryspark.operators import simplify as S
from boundaryspark.operators import snapping as N
from boundaryspark.operators import topology as T
from boundaryspark.plans.compare_queries import DX, DY, OVERLAP_SQL, left_features, right_features
from boundaryspark.plans.inputs import features, with_inputs
from boundaryspark.plans.layer_queries import FEATURE_SQL, feature_sql
from boundaryspark.plans.registry import query

OUTLINE_SQL = {
    "canon": """SELECT iso, adm, uid, CASE WHEN f THEN x1 ELSE x2 END AS ax, CASE WHEN f THEN y1 ELSE y2 END AS ay, CASE WHEN f THEN x2 ELSE x1 END AS bx, CASE WHEN f THEN y2 ELSE y1 END AS by_,
 CASE WHEN f THEN 1 ELSE -1 END AS dir FROM (SELECT *, x1 < x2 OR (x1 = x2 AND y1 < y2) AS f FROM fx_edge)""",
    "net": "SELECT iso, adm, ax, ay, bx, by_, sum(dir) AS d FROM canon GROUP BY ALL HAVING sum(dir) <> 0",
}
_AY = f"""({(1 - G.ECC2)!r} * (sin(radians({{0}})) / (1 - {G.ECC2!r} * sin(radians({{0}})) ** 2) - ln((1 - {G.ECC!r} * sin(radians({{0}}))) / (1 + {G.ECC!r} * sin(radians({{0}})))) / {2 * G.ECC!r}) * {(G.SEMI_MAJOR / (2 * G.K0) / 1000)!r})"""
_AX = f"(radians({{0}}) * {(G.SEMI_MAJOR * G.K0 / 1000)!r})"
_AREA = f"sum(sign(d) * ({_AX.format('ax')} - {_AX.format('bx')}) * ({_AY.format('ay')} + {_AY.format('by_')}) / 2)"
_LEN = f"sum(sqrt(radians(ax - bx) ** 2 + radians(ay - by_) ** 2)) * {(G.SEMI_MAJOR / 1000)!r}"


def _edges(spark, sf_dir, *levels):
    return E.explode_edges(features(spark, sf_dir, *levels), ["iso", "adm", "uid"])


@query("dissolve_measures", with_inputs("fx_edge", f"SELECT iso, adm, round({_AREA}, 2) AS area_km2, round({_LEN}, 2) AS perimeter_km FROM net GROUP BY ALL", OUTLINE_SQL))
def dissolve_measures(spark, sf_dir):
    outline = T.dissolve_edges(_edges(spark, sf_dir), ["iso", "adm"])
    out = T.outline_measures(outline, ["iso", "adm"])
    return out.select("iso", "adm", F.round("area_km2", 2).alias("area_km2"), F.round("perimeter_km", 2).alias("perimeter_km"))


@query("dissolve", with_inputs("fx_edge", f"SELECT iso, adm, round({_AREA}, 2) AS area_km2, round({_LEN}, 2) AS perimeter_km, cast(count(*) AS bigint) AS edges FROM net GROUP BY ALL", OUTLINE_SQL))
def dissolve(spark, sf_dir):
    out = T.dissolve(features(spark, sf_dir), ["iso", "adm"])
    return out.select("iso", "adm", F.round(G.planar_area(G.project_equal_area("geom")) / 1e6, 2).alias("area_km2"),
                      F.round(G.planar_perimeter(G.project_equidistant("geom")) / 1000, 2).alias("perimeter_km"),
                      (G.all_vertices("geom") - F.aggregate(F.transform("geom", lambda p: F.size(p).cast("long")), F.lit(0).cast("long"), lambda a, n: a + n)).alias("edges"))


@query("dissolve_levels", with_inputs("fx_unit", f"""SELECT iso, 1 AS parts, round(({_AX.format('x1')} - {_AX.format('x0')}) * ({_AY.format('y1')} - {_AY.format('y0')}), 2) AS area_km2 FROM fx_unit WHERE adm = 'ADM0'"""))
def dissolve_levels(spark, sf_dir):
    # all levels of a country lie on each other: borders that end in the middle of others, overlaps, notches and holes
    out = T.dissolve(features(spark, sf_dir), ["iso"])
    return out.select("iso", F.size("geom").alias("parts"), F.round(G.planar_area(G.project_equal_area("geom")) / 1e6, 2).alias("area_km2"))


_GC = f"{2 * G.SPHERE_RADIUS / 1000!r} * asin(sqrt(sin(radians(by_ - ay) / 2) ** 2 + sin(radians(bx - ax) / 2) ** 2 * cos(radians(ay)) * cos(radians(by_))))"


@query("shared_borders", with_inputs("fx_edge", f"""SELECT adm, a AS left_unit, b AS right_unit, count(*) AS edges, round(sum({_GC}), 4) AS border_km
FROM (SELECT adm, ax, ay, bx, by_, min(uid) AS a, max(uid) AS b FROM canon GROUP BY ALL HAVING count(*) = 2 AND min(uid) <> max(uid)) GROUP BY ALL""", OUTLINE_SQL))
def shared_borders(spark, sf_dir):
    return T.shared_borders(_edges(spark, sf_dir), "uid", ["adm"]).withColumn("border_km", F.round("border_km", 4))


@query("overlapping_edges", with_inputs("fx_edge", """SELECT iso, round(ax, 6) AS ax, round(ay, 6) AS ay, round(bx, 6) AS bx, round(by_, 6) AS "by", count(*) AS owners FROM canon GROUP BY iso, canon.ax, canon.ay, canon.bx, canon.by_ HAVING count(*) > 2""", OUTLINE_SQL))
def overlapping_edges(spark, sf_dir):
    # all levels in one layer: strips of different levels lie on each other
    out = T.overlapping_edges(_edges(spark, sf_dir), ["iso"])
    return out.select("iso", *[F.round(c, 6).alias(c) for c in T.EDGE], "owners")


def bow_ties(spark, sf_dir, *levels):
    """Units with the second and third corner swapped where the unit number says so."""
    base = features(spark, sf_dir, *levels)
    swapped = F.transform("geom", lambda p: F.transform(p, lambda r, i: F.when(
        i == 0, F.concat(F.slice(r, 1, 1), F.slice(r, 3, 1), F.slice(r, 2, 1), F.slice(r, F.lit(4), F.size(r) - 3))).otherwise(r)))
    return base.withColumn("geom", F.when((F.col("adm") == "ADM2") & (F.col("uid") % 17 == 5), swapped).otherwise(F.col("geom")))


_BOW = {
    "bow_v": "SELECT adm, uid, ring, CASE WHEN adm = 'ADM2' AND uid % 17 = 5 AND ring = 0 AND seq IN (1, 2) THEN 3 - seq ELSE seq END AS seq, x, y FROM fx_vertex",
    "bow_e": "SELECT * FROM (SELECT adm, uid, ring, seq, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM bow_v WINDOW w AS (PARTITION BY adm, uid, ring ORDER BY seq)) WHERE x2 IS NOT NULL",
    "bow_c": """SELECT a.adm, a.uid, count(*) AS n FROM bow_e a JOIN bow_e b ON a.adm = b.adm AND a.uid = b.uid AND (a.ring, a.seq) < (b.ring, b.seq)
 WHERE ((a.x2 - a.x1) * (b.y1 - a.y1) - (a.y2 - a.y1) * (b.x1 - a.x1)) * ((a.x2 - a.x1) * (b.y2 - a.y1) - (a.y2 - a.y1) * (b.x2 - a.x1)) < 0
 AND ((b.x2 - b.x1) * (a.y1 - b.y1) - (b.y2 - b.y1) * (a.x1 - b.x1)) * ((b.x2 - b.x1) * (a.y2 - b.y1) - (b.y2 - b.y1) * (a.x2 - b.x1)) < 0 GROUP BY ALL""",
    "bow_area": "SELECT adm, uid, sum(CASE WHEN ring = 0 THEN x1 * y2 - x2 * y1 ELSE 0 END) AS s FROM bow_e GROUP BY ALL",
    # does the middle of the hole's first edge lie inside the shell?
    "bow_hole": """SELECT h.adm, h.uid, count(*) FILTER ((s.y1 > h.y) <> (s.y2 > h.y) AND h.x < s.x1 + (h.y - s.y1) * (s.x2 - s.x1) / (s.y2 - s.y1)) % 2 = 0 AS outside
 FROM (SELECT adm, uid, (x1 + x2) / 2 AS x, (y1 + y2) / 2 AS y FROM bow_e WHERE ring = 1 AND seq = 0) h JOIN bow_e s ON s.adm = h.adm AND s.uid = h.uid AND s.ring = 0 GROUP BY ALL""",
}


@query("validity_report", with_inputs("fx_vertex fx_unit", """SELECT u.adm, u.uid, c.n IS NULL AND NOT coalesce(h.outside, false) AND abs(a.s) > 1e-9 AS valid,
 concat_ws('; ', CASE WHEN abs(a.s) <= 1e-9 THEN 'zero area' END, CASE WHEN c.n > 0 THEN 'self-crossing' END, CASE WHEN h.outside THEN 'hole outside shell' END) AS reason, coalesce(c.n, 0) AS crossings
FROM fx_unit u JOIN bow_area a USING (adm, uid) LEFT JOIN bow_c c ON c.adm = u.adm AND c.uid = u.uid LEFT JOIN bow_hole h ON h.adm = u.adm AND h.uid = u.uid""", _BOW))
def validity_report(spark, sf_dir):
    return T.validity_report(bow_ties(spark, sf_dir), ["adm", "uid"]).select("adm", "uid", "valid", "reason", "crossings")


_FLAT = "u.adm = 'ADM2' AND u.uid % 29 = 7"


@query("layer_geometry_verdict", with_inputs("fx_vertex fx_unit", f"""SELECT iso, adm, far AS bounds_ok, flat = 0 AS valid_ok, proj AS projection_ok, bad AS invalid_features, first_invalid,
 concat_ws(' | ', CASE WHEN NOT far THEN 'at least one geometry extends past the bounds of the earth' END, CASE WHEN flat > 0 THEN 'at least one geometry is invalid and cannot be repaired' END,
  CASE WHEN NOT proj THEN 'the projection must be EPSG 4326' END) AS message, far AND flat = 0 AND proj AS passed
FROM (SELECT iso, u.adm, bool_and(NOT (u.adm = 'ADM1' AND u.uid % 40 = 3)) AS far, count(*) FILTER ({_FLAT}) AS flat, any_value(cast(substr(iso, 2, 2) AS int) % 4 <> 0) AS proj,
 count(*) FILTER (c.n > 0 OR {_FLAT} OR h.outside) AS bad, min(CASE WHEN c.n > 0 OR {_FLAT} OR h.outside THEN u.uid END) AS first_invalid
 FROM fx_unit u LEFT JOIN bow_c c ON c.adm = u.adm AND c.uid = u.uid LEFT JOIN bow_hole h ON h.adm = u.adm AND h.uid = u.uid GROUP BY ALL)""", _BOW))
def layer_geometry_verdict(spark, sf_dir):
    from boundaryspark.plans.jobs import geometry_checks
    from boundaryspark.sources.packages import check_projection
    # bow-ties can be repaired, units without area can't; some lie past the bounds, some layers have another projection
    flat = (F.col("adm") == "ADM2") & (F.col("uid") % 29 == 7)
    out = (F.col("adm") == "ADM1") & (F.col("uid") % 40 == 3)
    units = bow_ties(spark, sf_dir).withColumns({"_w": F.when(flat, 0.0).otherwise(1.0), "_d": F.when(out, 400.0).otherwise(0.0)}).withColumn(
        "geom", G.map_points("geom", lambda v: G.xy(v["x"] + F.col("_d"), v["y"] * F.col("_w"))))
    units = units.withColumn("package_id", F.concat_ws("/", "iso", "adm"))
    text = F.when(F.substring("iso", 2, 2).cast("int") % 4 == 0, 'PROJCS["UTM 33N",GEOGCS["WGS 84"]]').otherwise('GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984"]]')
    members = units.select("package_id", F.lit("units.prj").alias("member"), F.encode(text, "UTF-8").alias("content")).distinct()
    checked = geometry_checks(units.select("package_id", F.col("uid").alias("feature_no"), "geom"), check_projection(members))
    part = F.split("package_id", "/")
    return checked.select(part[0].alias("iso"), part[1].alias("adm"), *[c for c in checked.columns if c != "package_id"])


@query("repair", feature_sql("SELECT adm, uid, round(km2, 2) AS km2 FROM feat"))
def repair(spark, sf_dir):
    # a ring read twice over with its corners in order is repaired to itself
    out = O.repair(features(spark, sf_dir), ["adm", "uid"])
    return out.select("adm", "uid", F.round(G.planar_area(G.project_equal_area("geom")) / 1e6, 2).alias("km2"))


# two triangles of a bow-tie are half of the box; a hole lies outside them, so the even-odd rule fills it
_X, _Y = (lambda c: _AX.format(c)), (lambda c: _AY.format(c))
_BOX = f"({_X('x1')} - {_X('x0')}) * ({_Y('y1')} - {_Y('y0')})"
# the hole's upper corners lie on the crossing edges and become vertices of both triangles, which are no longer straight when projected
_QUAD = "abs({x0} * ({b} - {d} + {c} - {a}) + {xc} * ({d} - {b}) + {xd} * ({a} - {c}))".format(
    x0=_X("x0"), xc=_X("(x0 * 0.6e0 + x1 * 0.4e0)"), xd=_X("((x0 + x1) / 2)"), a=_Y("y1"), b=_Y("y0"), c=_Y("(y0 * 0.6e0 + y1 * 0.4e0)"), d=_Y("((y0 + y1) / 2)"))
_HOLE = f"CASE WHEN uid % 10 = 0 THEN ({_X('(x0 * 0.4e0 + x1 * 0.6e0)')} - {_X('(x0 * 0.6e0 + x1 * 0.4e0)')}) * ({_Y('(y0 * 0.6e0 + y1 * 0.4e0)')} - {_Y('(y0 * 0.8e0 + y1 * 0.2e0)')}) ELSE 0 END"


@query("repair_bow_ties", with_inputs("fx_unit", f"""SELECT adm, uid, round(abs(CASE WHEN uid % 17 = 5 THEN {_HOLE} ELSE {_BOX} - {_HOLE} END), 2) AS old_area_km2,
 round(CASE WHEN uid % 17 = 5 AND uid % 10 = 0 THEN {_QUAD} + {_HOLE} WHEN uid % 17 = 5 THEN {_BOX} / 2 ELSE {_BOX} - {_HOLE} END, 2) AS new_area_km2 FROM fx_unit WHERE adm = 'ADM2'"""))
def repair_bow_ties(spark, sf_dir):
    units = bow_ties(spark, sf_dir, "ADM2")
    out = O.repair_report(units, O.repair(units, ["adm", "uid"]), ["adm", "uid"])
    return out.select("adm", "uid", F.abs(F.round("old_area_km2", 2)).alias("old_area_km2"), F.round("new_area_km2", 2).alias("new_area_km2"))


_DEGREES = {k: (v.replace("ax / 1000 AS px, ay / 1000 + 20000 AS py", "lon AS px, lat + 200 AS py") if k in ("l_p", "r_p") else v)
            for k, v in OVERLAP_SQL.items()}


@query("overlay_intersection", with_inputs("fx_vertex", "SELECT left_id, right_id, round(isec, 5) AS area FROM ov", _DEGREES))
def overlay_intersection(spark, sf_dir):
    out = O.overlay(left_features(spark, sf_dir), right_features(spark, sf_dir), "left_id", "right_id", "intersection")
    return out.select("left_id", "right_id", F.round(G.planar_area("geom"), 5).alias("area"))


@query("overlay_union", with_inputs("fx_vertex", "SELECT left_id, right_id, round(a1 + a2 - coalesce(isec, 0), 5) AS area FROM cand LEFT JOIN (SELECT left_id, right_id, isec FROM ov) USING (left_id, right_id)", _DEGREES))
def overlay_union(spark, sf_dir):
    out = O.overlay(left_features(spark, sf_dir), right_features(spark, sf_dir), "left_id", "right_id", "union")
    return out.select("left_id", "right_id", F.round(G.planar_area("geom"), 5).alias("area"))


@query("overlay_difference", with_inputs("fx_vertex", "SELECT left_id, right_id, round(a1 - coalesce(isec, 0), 5) AS area FROM cand LEFT JOIN (SELECT left_id, right_id, isec FROM ov) USING (left_id, right_id) WHERE a1 - coalesce(isec, 0) > 1e-9", _DEGREES))
def overlay_difference(spark, sf_dir):
    out = O.overlay(left_features(spark, sf_dir), right_features(spark, sf_dir), "left_id", "right_id", "difference")
    return out.select("left_id", "right_id", F.round(G.planar_area("geom"), 5).alias("area"))


# units cut by masks that lie across them: the area between the mask's floor and roof below each edge
_CLIP_SQL = {
    "mask": f"SELECT iso, x0 + {DX}e0 AS mx0, x1 + {DX}e0 AS mx1, y0 + {DY}e0 AS my0, y1 + {DY}e0 AS my1 FROM fx_unit WHERE adm = 'ADM0'",
    "cut": """SELECT uid, iso, greatest(least(x1, x2), mx0) AS xa, least(greatest(x1, x2), mx1) AS xb, my0, my1, x1, y1, x2, y2, CASE WHEN x1 > x2 THEN 1 ELSE -1 END AS w
 FROM (SELECT * FROM fx_edge WHERE adm = 'ADM1' AND x1 <> x2) e JOIN mask USING (iso)""",
    "side": "SELECT *, y1 + (xa - x1) * (y2 - y1) / (x2 - x1) AS fa, y1 + (xb - x1) * (y2 - y1) / (x2 - x1) AS fb FROM cut WHERE xa < xb",
    "low": """SELECT uid, iso, w * s * (xb - xa) * CASE WHEN greatest(fa, fb) <= c THEN (fa + fb) / 2 WHEN least(fa, fb) >= c THEN c
 ELSE ((least(fa, fb) + c) / 2) * (c - least(fa, fb)) / abs(fb - fa) + c * (greatest(fa, fb) - c) / abs(fb - fa) END AS area
 FROM (SELECT *, my1 AS c, 1 AS s FROM side UNION ALL SELECT *, my0, -1 FROM side)""",
}


@query("clip", with_inputs("fx_edge fx_unit", "SELECT uid, iso AS mask, round(sum(area), 6) AS area FROM low GROUP BY ALL HAVING sum(area) > 1e-9", _CLIP_SQL))
def clip(spark, sf_dir):
    units = features(spark, sf_dir, "ADM1")
    pairs = units.select("uid", F.col("iso").alias("mask"))
    masks = features(spark, sf_dir, "ADM0").select(F.col("iso").alias("mask"), G.map_points("geom", lambda v: G.xy(v["x"] + DX, v["y"] + DY)).alias("geom"))
    out = O.clip(units.select("uid", "geom"), masks, "uid", "mask", pairs)
    return out.select("uid", "mask", F.round(G.planar_area("geom"), 6).alias("area"))


_OFF = "0.000001e0"
_MOVED = {
    # every second unit lies a little off, so borders that were shared no longer are
    "off": f"SELECT adm, uid, ring, seq, round(x, 6) AS ox, round(y, 6) AS oy, x + CASE WHEN uid % 2 = 1 THEN {_OFF} ELSE 0 END AS x, y - CASE WHEN uid % 2 = 1 THEN {_OFF} ELSE 0 END AS y FROM fx_vertex",
    "uses": "SELECT adm, ox, oy, x, y, count(*) AS n FROM off GROUP BY ALL",
    "best": "SELECT adm, ox, oy, arg_min((x, y), (-n, x, y)) AS t FROM uses GROUP BY ALL",
}


@query("snap_near", with_inputs("fx_vertex", """SELECT adm, uid, ring, cast(seq AS int) AS seq, round(t[1], 8) AS x, round(t[2], 8) AS y FROM off JOIN best USING (adm, ox, oy)""", _MOVED))
def snap_near(spark, sf_dir):
    off = F.when(F.col("uid") % 2 == 1, float(_OFF)).otherwise(0.0)
    moved = features(spark, sf_dir).withColumn("_off", off).withColumn("geom", G.map_points("geom", lambda v: G.xy(v["x"] + F.col("_off"), v["y"] - F.col("_off"))))
    out = N.snap_near(moved.select("adm", "uid", "geom"), ["uid"], ["adm"])
    return E.explode_vertices(out, ["adm", "uid"]).select("adm", "uid", "ring", "seq", F.round("x", 8).alias("x"), F.round("y", 8).alias("y"))


@query("fill_gaps", with_inputs("fx_vertex", """SELECT adm, uid, round(sum(CASE WHEN ring = 0 THEN area WHEN area / 1e6 < 10000 THEN 0 ELSE -area END) / 1e6, 2) AS km2
FROM rings WHERE adm = 'ADM2' GROUP BY ALL""", {k: FEATURE_SQL[k] for k in ("p", "pe", "rings")}))
def fill_gaps(spark, sf_dir):
    out = T.fill_gaps(features(spark, sf_dir, "ADM2"), ["uid"], ["adm"], 10000.0)
    return out.select("adm", "uid", F.round(G.planar_area(G.project_equal_area("geom")) / 1e6, 2).alias("km2"))


# every edge gets a vertex in its middle, which has to go again; the corners lie farther off than the tolerance
@query("simplify", feature_sql("SELECT adm, uid, cast(all_n AS bigint) AS vertices FROM feat"))
def simplify(spark, sf_dir):
    middle = lambda a, b: G.xy((a["x"] + b["x"]) / 2, (a["y"] + b["y"]) / 2)
    dense = lambda r: F.concat(F.flatten(F.transform(G.ring_steps(r), lambda s: F.array(s["a"], middle(s["a"], s["b"])))), F.slice(r, 1, 1))
    units = features(spark, sf_dir).withColumn("geom", F.transform("geom", lambda p: F.transform(p, dense)))
    out = S.simplify(units, ["uid"], ["adm"], 100.0)
    return out.select("adm", "uid", G.all_vertices("geom").alias("vertices"))


@query("simplify_fraction")
def simplify_fraction(spark, sf_dir):
    out = S.simplify_fraction(features(spark, sf_dir), ["uid"], ["adm"], 0.10)
    return out.select("adm", "uid", G.all_vertices("geom").alias("vertices"))


@query("arcs", with_inputs("fx_edge", "SELECT adm, uid, ring, count(*) AS edges FROM fx_edge GROUP BY ALL"))
def arcs(spark, sf_dir):
    return S.arcs(features(spark, sf_dir), ["uid"], ["adm"]).groupBy("adm", "uid", "ring").agg(F.count(F.lit(1)).alias("edges"))




def _composite_inputs(spark, sf_dir):
    units = features(spark, sf_dir)
    name = F.when(F.col("uid") == 24, F.concat("unit_name", F.lit(" (disp)"))).when(F.col("uid") == 3, "Burma").otherwise(F.col("unit_name"))
    world = units.filter(F.col("adm") == "ADM0").select(F.col("uid").alias("fid"), name.alias("country_na"), "geom")
    layers = units.select(
        "iso", "adm", F.concat("adm", F.col("uid").cast("string")).alias("shapeID"), F.col("unit_name").alias("shapeName"), "geom")
    names = units.filter(F.col("adm") == "ADM0").select(F.col("unit_name").alias("name"), F.col("iso").alias("code"))
    return world, layers, names


@query("composite_layers")
def composite_layers(spark, sf_dir):
    from boundaryspark.plans.composite import composite_layers as build
    out = build(*_composite_inputs(spark, sf_dir), aliases={"Burma": "N03"})
    return out.groupBy("level", "shapeType", "shapeGroup").agg(
        F.count(F.lit(1)).alias("units"), F.round(F.sum(G.planar_area(G.project_equal_area("geom")) / 1e6), 0).alias("km2"))
