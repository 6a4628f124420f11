"""Queries on unit polygons: counts, statistics, standardising, geometry helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from boundaryspark.functions import geometry as G
from boundaryspark.operators import catalog as C
from boundaryspark.operators import edges as E
from boundaryspark.operators import identity as I
from boundaryspark.operators import layers as L
from boundaryspark.plans.inputs import derived, features, table, with_inputs
from boundaryspark.plans.registry import query

LAYER = ["iso", "adm"]

# Per-feature figures in plain SQL: area and length by edges, so each projection is written once.
_A, _E2 = G.SEMI_MAJOR, G.ECC2
_PROJECT = f"""
 x AS lon, y AS lat, radians(x) * {_A!r} AS qx, radians(y) * {_A!r} AS qy, radians(x) * {(_A * G.K0)!r} AS ax,
 {(1 - _E2)!r} * (sin(radians(y)) / (1 - {_E2!r} * sin(radians(y)) ** 2)
  - ln((1 - {G.ECC!r} * sin(radians(y))) / (1 + {G.ECC!r} * sin(radians(y)))) / {2 * G.ECC!r}) * {(_A / (2 * G.K0))!r} AS ay"""
FEATURE_SQL = {
    "p": f"SELECT *, {_PROJECT} FROM fx_vertex",
    "pe": """SELECT *, lead(qx) OVER w AS qx2, lead(qy) OVER w AS qy2, lead(ax) OVER w AS ax2, lead(ay) OVER w AS ay2,
 lead(lon) OVER w AS lon2, lead(lat) OVER w AS lat2 FROM p WINDOW w AS (PARTITION BY adm, uid, poly, ring ORDER BY seq)""",
    "rings": f"""SELECT adm, iso, uid, ring, count(*) AS nv, sum(sqrt((qx2 - qx) ** 2 + (qy2 - qy) ** 2)) AS len,
 abs(sum(ax * ay2 - ax2 * ay)) / 2 AS area, sum({2 * G.SPHERE_RADIUS!r} * atan2(sqrt(h), sqrt(1 - h))) AS slen,
 abs(sum(radians(lon2 - lon) * (2 + sin(radians(lat)) + sin(radians(lat2))) * {(G.SPHERE_RADIUS ** 2 / 2)!r})) AS sarea
 FROM (SELECT *, sin(radians(lat2 - lat) / 2) ** 2 + sin(radians(lon2 - lon) / 2) ** 2 * cos(radians(lat)) * cos(radians(lat2)) AS h FROM pe) GROUP BY ALL""",
    "feat": """SELECT adm, iso, uid, sum(CASE WHEN ring = 0 THEN nv ELSE 0 END) AS shell_n, sum(nv) AS all_n, sum(len) / 1000 AS km,
 sum(CASE WHEN ring = 0 THEN area ELSE -area END) / 1e6 AS km2, sum(slen) / 1000 AS skm,
 sum(CASE WHEN ring = 0 THEN sarea ELSE -sarea END) / 1e6 AS skm2 FROM rings GROUP BY ALL""",
}


def feature_sql(body: str, also: str = "") -> str:
    return with_inputs(("fx_vertex " + also).strip(), body, FEATURE_SQL)


@query("layer_catalogue", feature_sql("""
SELECT f.iso, f.adm, c.name, c.continent, c.income, count(*) AS unit_count, round_even(avg(shell_n), 0) AS mean_vertices,
 cast(min(shell_n) AS bigint) AS min_vertices, cast(max(shell_n) AS bigint) AS max_vertices, round(avg(km), 3) AS mean_perimeter_km,
 round(avg(km2), 3) AS mean_area_km2, round(min(km2), 3) AS min_area_km2, round(max(km2), 3) AS max_area_km2
FROM feat f JOIN fx_country c ON f.iso = c.iso GROUP BY ALL"""))
def layer_catalogue(spark, sf_dir):
    stats = L.layer_statistics(features(spark, sf_dir), LAYER)
    joined = C.enrich_with_country(stats, derived(spark, sf_dir, "fx_country"), "iso")
    r = [F.round(c, 3).alias(c) for c in ("mean_perimeter_km", "mean_area_km2", "min_area_km2", "max_area_km2")]
    return joined.select("iso", "adm", "name", "continent", "income", "unit_count", "mean_vertices",
                         "min_vertices", "max_vertices", *r)


@query("unit_count", with_inputs("fx_unit", "SELECT iso, adm, count(*) AS unit_count FROM fx_unit GROUP BY ALL"))
def unit_count(spark, sf_dir):
    return L.unit_count(features(spark, sf_dir), LAYER)


@query("vertex_stats", feature_sql("""SELECT iso, adm, round_even(avg(shell_n), 0) AS mean_vertices,
 cast(min(shell_n) AS bigint) AS min_vertices, cast(max(shell_n) AS bigint) AS max_vertices FROM feat GROUP BY ALL"""))
def vertex_stats(spark, sf_dir):
    return L.vertex_stats(features(spark, sf_dir), LAYER)


@query("perimeter_stats", feature_sql("""SELECT iso, adm, round(avg(km), 3) AS mean_perimeter_km,
 round(min(km), 3) AS min_perimeter_km, round(max(km), 3) AS max_perimeter_km FROM feat GROUP BY ALL"""))
def perimeter_stats(spark, sf_dir):
    out = L.perimeter_stats(features(spark, sf_dir), LAYER)
    return out.select("iso", "adm", *[F.round(c, 3).alias(c) for c in out.columns[2:]])


@query("area_stats", feature_sql("""SELECT iso, adm, round(avg(km2), 3) AS mean_area_km2,
 round(min(km2), 3) AS min_area_km2, round(max(km2), 3) AS max_area_km2 FROM feat GROUP BY ALL"""))
def area_stats(spark, sf_dir):
    out = L.area_stats(features(spark, sf_dir), LAYER)
    return out.select("iso", "adm", *[F.round(c, 3).alias(c) for c in out.columns[2:]])


@query("source_stats", feature_sql("""SELECT iso, adm, count(*) AS unit_count, round(sum(skm2), 2) AS area_km2,
 round(sum(skm), 2) AS length_km, cast(sum(all_n) AS bigint) AS vertices, round(sum(skm) / sum(all_n) * 1000, 2) AS metres_per_vertex,
 round(sum(all_n) / sum(skm), 6) AS vertices_per_km FROM feat GROUP BY ALL"""))
def source_stats(spark, sf_dir):
    out = L.source_stats(features(spark, sf_dir), LAYER)
    return out.select("iso", "adm", "unit_count", F.round("area_km2", 2).alias("area_km2"),
                      F.round("length_km", 2).alias("length_km"), "vertices",
                      F.round("metres_per_vertex", 2).alias("metres_per_vertex"),
                      F.round("vertices_per_km", 6).alias("vertices_per_km"))


def _attributes(spark, sf_dir):
    """Features with a free attribute map, as read from a submission."""
    base = features(spark, sf_dir)
    uid = F.col("uid")
    return base.withColumn("props", F.map_filter(F.create_map(
        F.lit("shapeName"), F.col("unit_name"), F.lit("OBJECTID"), uid.cast("string"),
        F.lit("LEVEL_1"), (uid % 7).cast("string"),
        F.lit("iso"), F.when(F.col("adm") != "ADM1", F.concat("iso", F.lit("-"), uid.cast("string"))),
        F.lit("NAME"), F.when(F.col("adm") == "ADM0", F.col("unit_name"))), lambda k, v: v.isNotNull()))


@query("column_uniqueness", with_inputs("fx_unit", """
, a AS (SELECT iso, adm, 'shapeName' AS attribute, unit_name AS v FROM fx_unit UNION ALL SELECT iso, adm, 'OBJECTID', cast(uid AS string) FROM fx_unit
 UNION ALL SELECT iso, adm, 'LEVEL_1', cast(uid % 7 AS string) FROM fx_unit UNION ALL SELECT iso, adm, 'iso', concat(iso, '-', uid) FROM fx_unit WHERE adm <> 'ADM1'
 UNION ALL SELECT iso, adm, 'NAME', unit_name FROM fx_unit WHERE adm = 'ADM0')
SELECT a.iso, a.adm, attribute, count(DISTINCT v) AS distinct_values, round(count(DISTINCT v) / max(n), 9) AS uniqueness
FROM a JOIN (SELECT iso, adm, count(*) AS n FROM fx_unit GROUP BY ALL) t USING (iso, adm) GROUP BY ALL"""))
def column_uniqueness(spark, sf_dir):
    out = L.column_uniqueness(_attributes(spark, sf_dir), LAYER)
    return out.withColumn("uniqueness", F.round("uniqueness", 9))


@query("rank_name_columns", with_inputs("fx_unit", """
SELECT iso, adm, CASE WHEN adm = 'ADM0' THEN 'NAME' ELSE 'shapeName' END AS name_column FROM fx_unit GROUP BY ALL"""))
def rank_name_columns(spark, sf_dir):
    return L.rank_name_columns(L.column_uniqueness(_attributes(spark, sf_dir), LAYER), LAYER)


@query("detect_column", with_inputs("fx_unit", """
SELECT iso, adm, CASE WHEN adm = 'ADM0' THEN NULL ELSE 'shapeName' END AS name_column,
 CASE WHEN adm = 'ADM1' THEN NULL ELSE 'iso' END AS code_column FROM fx_unit GROUP BY ALL"""))
def detect_column(spark, sf_dir):
    data = _attributes(spark, sf_dir)
    names = L.detect_column(data, LAYER, L.NAME_CANDIDATES).withColumnRenamed("column", "name_column")
    codes = L.detect_column(data, LAYER, L.ISO_CANDIDATES).withColumnRenamed("column", "code_column")
    return names.join(codes, LAYER)


def _layer_meta(data):
    return data.select(*LAYER).distinct().withColumn("fingerprint", F.concat("iso", "adm"))


GEOM_TEXT_SQL = {
    "ring_text": """SELECT adm, iso, uid, poly, ring, '(' || string_agg(printf('%.9f %.9f', x, y), ',' ORDER BY seq) || ')' AS t FROM fx_vertex GROUP BY ALL""",
    "poly_text": """SELECT adm, iso, uid, poly, '(' || string_agg(t, ',' ORDER BY ring) || ')' AS t FROM ring_text GROUP BY ALL""",
    "geom_text": """SELECT adm, iso, uid, 'MULTIPOLYGON(' || string_agg(t, ',' ORDER BY poly) || ')' AS t FROM poly_text GROUP BY ALL""",
}


def mod_sql(text: str, modulus: int) -> str:
    """SHA-256 of a text modulo a power of ten, with 128-bit steps."""
    chunks = ", ".join(f"cast('0x' || substr(sha256({text}), {i}, 4) AS hugeint)" for i in range(1, 65, 4))
    return f"cast(list_reduce([cast(0 AS hugeint), {chunks}], lambda a, b: (a * 65536 + b) % {modulus}) AS bigint)"


@query("standardize_features", with_inputs("fx_vertex", f"""
SELECT g.iso, g.adm, g.iso || g.adm || 'B' || {mod_sql('t', 10 ** 14)} AS "shapeID", u.unit_name AS "shapeName",
 CASE WHEN g.adm = 'ADM1' THEN '' ELSE concat(u.iso, '-', u.uid) END AS "shapeISO", u.iso AS "shapeGroup", u.adm AS "shapeType"
FROM geom_text g JOIN fx_unit u ON g.adm = u.adm AND g.uid = u.uid WHERE u.adm <> 'ADM0'""", GEOM_TEXT_SQL))
def standardize_features(spark, sf_dir):
    data = _attributes(spark, sf_dir)
    meta = _layer_meta(data)
    return L.standardize_features(data.withColumnsRenamed({"iso": "l_iso", "adm": "l_adm"}), ["l_iso", "l_adm"],
                                  meta.withColumn("l_iso", F.col("iso")).withColumn("l_adm", F.col("adm"))) \
        .drop("geom").withColumnsRenamed({"l_iso": "iso", "l_adm": "adm"})


@query("shape_id", with_inputs("fx_vertex", f"""
SELECT adm, uid, t AS geometry_text, 'p' || uid || 'B' || {mod_sql('t', 10 ** 14)} AS id14, 'p' || uid || 'B' || {mod_sql('t', 10 ** 8)} AS id8 FROM geom_text""",
                                 GEOM_TEXT_SQL))
def shape_id(spark, sf_dir):
    prefix = F.concat(F.lit("p"), F.col("uid").cast("string"))
    return features(spark, sf_dir).select(
        "adm", "uid", G.geometry_text("geom").alias("geometry_text"), I.shape_id(prefix, "geom").alias("id14"),
        I.shape_id(prefix, "geom", 10 ** 8).alias("id8"))


@query("value_fill_stats", """
SELECT l_returnflag AS layer, CASE WHEN max(CASE WHEN v IS NULL THEN 1 ELSE 0 END) = 1 THEN 0 ELSE count(v) END AS filled,
 arg_min_null(v, pos) AS example FROM (SELECT l_returnflag, l_orderkey * 10 + l_linenumber AS pos, CASE WHEN l_returnflag <> 'A' OR l_tax > 0.02 THEN l_linestatus END AS v FROM lineitem) GROUP BY 1""")
def value_fill_stats(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("layer"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
        F.when((F.col("l_returnflag") != "A") | (F.col("l_tax") > 0.02), F.col("l_linestatus")).alias("v"))
    return L.value_fill_stats(lines, ["layer"], "v", "pos")


@query("latest_timestamp", """SELECT o_custkey AS key, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS latest FROM orders GROUP BY 1""")
def latest_timestamp(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "key")
    out = L.latest_timestamp(orders, ["key"], "o_orderdate")
    return out.withColumn("latest", F.date_format("latest", "yyyy-MM-dd HH:mm:ss"))


@query("sequence_features", """
SELECT adm, pos, row_number() OVER (PARTITION BY adm ORDER BY pos) AS feature_no FROM (SELECT l_returnflag AS adm, l_orderkey * 10 + l_linenumber AS pos, max(l_discount) AS d FROM lineitem GROUP BY ALL) WHERE d > 0""")
def sequence_features(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_returnflag").alias("adm"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos")).agg(
        F.max("l_discount").alias("d"))
    data = lines.withColumn("geom", F.when(F.col("d") > 0, F.array(F.col("d"))))
    return L.sequence_features(data, "pos", ["adm"]).select("adm", "pos", F.col("feature_no").cast("long").alias("feature_no"))


@query("explode_vertices", with_inputs("fx_vertex", "SELECT adm, uid, poly, ring, seq, round(x, 9) AS x, round(y, 9) AS y FROM fx_vertex"))
def explode_vertices(spark, sf_dir):
    out = E.explode_vertices(features(spark, sf_dir), ["adm", "uid"])
    return out.withColumn("x", F.round("x", 9)).withColumn("y", F.round("y", 9))


@query("explode_edges", with_inputs("fx_edge", """SELECT adm, uid, poly, ring, seq, round(x1, 9) AS x1, round(y1, 9) AS y1, round(x2, 9) AS x2,
 round(y2, 9) AS y2 FROM fx_edge"""))
def explode_edges(spark, sf_dir):
    out = E.explode_edges(features(spark, sf_dir), ["adm", "uid"])
    return out.select("adm", "uid", "poly", "ring", "seq", *[F.round(c, 9).alias(c) for c in ("x1", "y1", "x2", "y2")])


@query("assemble_features", feature_sql("SELECT adm, uid, cast(all_n AS bigint) AS vertices, round(km2, 3) AS km2 FROM feat"))
def assemble_features(spark, sf_dir):
    out = E.assemble(E.explode_vertices(features(spark, sf_dir), ["adm", "uid"]), ["adm", "uid"])
    return out.select("adm", "uid", G.all_vertices("geom").alias("vertices"),
                      F.round(G.planar_area(G.project_equal_area("geom")) / 1e6, 3).alias("km2"))


@query("bounds", with_inputs("fx_vertex", """SELECT adm, uid, round(min(x), 9) AS xmin, round(min(y), 9) AS ymin, round(max(x), 9) AS xmax,
 round(max(y), 9) AS ymax FROM fx_vertex GROUP BY ALL"""))
def bounds(spark, sf_dir):
    out = L.with_bounds(features(spark, sf_dir))
    return out.select("adm", "uid", *[F.round(c, 9).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


@query("layer_extent", with_inputs("fx_vertex", """SELECT iso, adm, round(min(x), 9) AS xmin, round(min(y), 9) AS ymin, round(max(x), 9) AS xmax,
 round(max(y), 9) AS ymax FROM fx_vertex GROUP BY ALL"""))
def layer_extent(spark, sf_dir):
    out = L.layer_extent(features(spark, sf_dir), LAYER)
    return out.select("iso", "adm", *[F.round(c, 9).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


@query("filter_by_bounds", with_inputs("fx_vertex", """
SELECT adm, uid FROM (SELECT adm, uid, x * 4.5 AS x, y * 2 AS y FROM fx_vertex) GROUP BY ALL
HAVING min(x) >= -180 - 1e-5 AND max(x) <= 180 + 1e-5 AND min(y) >= -90 - 1e-5 AND max(y) <= 90 + 1e-5"""))
def filter_by_bounds(spark, sf_dir):
    stretched = features(spark, sf_dir).withColumn("geom", G.map_points("geom", lambda v: G.xy(v["x"] * 4.5, v["y"] * 2)))
    return L.filter_by_bounds(stretched).select("adm", "uid")


@query("project_points", with_inputs("fx_vertex", """
SELECT adm, uid, round(sum(qx) / 1e6, 6) AS qx, round(sum(qy) / 1e6, 6) AS qy, round(sum(ax) / 1e6, 6) AS ax, round(sum(ay) / 1e6, 6) AS ay FROM p GROUP BY ALL""",
                                       {"p": FEATURE_SQL["p"]}))
def project_points(spark, sf_dir):
    def total(geom, axis):
        points = F.flatten(F.flatten(geom))
        return F.round(F.aggregate(F.transform(points, lambda v: v[axis]), F.lit(0.0), lambda a, v: a + v) / 1e6, 6)
    q, a = G.project_equidistant("geom"), G.project_equal_area("geom")
    return features(spark, sf_dir).select("adm", "uid", total(q, "x").alias("qx"), total(q, "y").alias("qy"),
                                          total(a, "x").alias("ax"), total(a, "y").alias("ay"))


@query("ring_measures", with_inputs("fx_edge", f"""
SELECT adm, uid, ring, round(sum(x1 * y2 - x2 * y1) / 2, 6) AS area, round(sum(sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2)), 6) AS length,
 round(abs(sum(radians(x2 - x1) * (2 + sin(radians(y1)) + sin(radians(y2))) * {(G.SPHERE_RADIUS ** 2 / 2)!r})) / 1e6, 3) AS sphere_km2,
 round(sum({2 * G.SPHERE_RADIUS!r} * atan2(sqrt(h), sqrt(1 - h))) / 1000, 3) AS sphere_km
FROM (SELECT *, sin(radians(y2 - y1) / 2) ** 2 + sin(radians(x2 - x1) / 2) ** 2 * cos(radians(y1)) * cos(radians(y2)) AS h FROM fx_edge) GROUP BY ALL"""))
def ring_measures(spark, sf_dir):
    rings = features(spark, sf_dir).select("adm", "uid", F.posexplode(F.element_at("geom", 1)).alias("ring", "r"))
    return rings.select("adm", "uid", "ring", F.round(G.ring_area("r"), 6).alias("area"),
                        F.round(G.ring_length("r"), 6).alias("length"),
                        F.round(G.ring_area_spherical("r") / 1e6, 3).alias("sphere_km2"),
                        F.round(G.ring_length_spherical("r") / 1000, 3).alias("sphere_km"))


@query("clean_rings", with_inputs("fx_edge", """
SELECT adm, uid, ring, count(*) + 1 AS vertices, round(sum(x1 * y2 - x2 * y1) / 2, 6) AS area FROM fx_edge GROUP BY ALL"""))
def clean_rings(spark, sf_dir):
    # spoil the rings first: turn them round, repeat vertices and leave them open
    spoiled = F.transform("geom", lambda p: F.transform(p, lambda r: F.flatten(F.transform(
        F.slice(F.reverse(r), F.lit(1), F.size(r) - 1), lambda v: F.array(v, v)))))
    cleaned = features(spark, sf_dir).select("adm", "uid", G.clean_rings(spoiled).alias("geom"))
    rings = cleaned.select("adm", "uid", F.posexplode(F.element_at("geom", 1)).alias("ring", "r"))
    return rings.select("adm", "uid", "ring", F.size("r").cast("long").alias("vertices"),
                        F.round(G.ring_area("r"), 6).alias("area"))


@query("snap_vertices", with_inputs("fx_vertex", """
SELECT adm, uid, ring, seq, round(round(x / 0.00001) * 0.00001, 7) AS x, round(round(y / 0.00001) * 0.00001, 7) AS y FROM fx_vertex"""))
def snap_vertices(spark, sf_dir):
    snapped = features(spark, sf_dir).withColumn("geom", G.snap_vertices("geom"))
    out = E.explode_vertices(snapped, ["adm", "uid"])
    return out.select("adm", "uid", "ring", "seq", F.round("x", 7).alias("x"), F.round("y", 7).alias("y"))


@query("as_multipolygon", with_inputs("fx_vertex", "SELECT adm, uid, 1 AS polygons, cast(count(DISTINCT ring) AS int) AS rings FROM fx_vertex GROUP BY ALL"))
def as_multipolygon(spark, sf_dir):
    polygons = features(spark, sf_dir).select("adm", "uid", F.element_at("geom", 1).alias("polygon"))
    wrapped = polygons.select("adm", "uid", G.as_multipolygon("polygon").alias("geom"))
    return wrapped.select("adm", "uid", F.size("geom").alias("polygons"), F.size(F.element_at("geom", 1)).alias("rings"))


@query("drop_source_fields", with_inputs("fx_unit", "SELECT adm, uid, 'shapeName' || CASE adm WHEN 'ADM0' THEN ',NAME,iso' WHEN 'ADM1' THEN '' ELSE ',iso' END AS kept FROM fx_unit"))
def drop_source_fields(spark, sf_dir):
    kept = L.drop_source_fields(_attributes(spark, sf_dir), props="props")
    order = F.when(F.col("adm") == "ADM0", F.array(F.lit("shapeName"), F.lit("NAME"), F.lit("iso"))).otherwise(
        F.array(F.lit("shapeName"), F.lit("iso")))
    return kept.select("adm", "uid", F.array_join(F.array_intersect(order, F.map_keys("props")), ",").alias("kept"))
