"""Queries on the catalogue: lookups, identity, change detection, publication, listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from boundaryspark.functions import scalars as S
from boundaryspark.operators import catalog as C
from boundaryspark.operators import identity as I
from boundaryspark.plans.inputs import derived, table, with_inputs
from boundaryspark.plans.layer_queries import mod_sql
from boundaryspark.plans.registry import query

KEYS = ["iso", "adm"]
BASE, PREFIX = "https://boundaries.example.org/data", "layer"


@query("enrich_with_country", with_inputs("fx_catalog fx_area", """
SELECT boundary_id, c.iso, adm, name, continent, region, subregion, income FROM fx_catalog c JOIN fx_area a ON c.iso = a.iso"""))
def enrich_with_country(spark, sf_dir):
    meta = derived(spark, sf_dir, "fx_catalog").select("boundary_id", "iso", "adm")
    return C.enrich_with_country(meta, derived(spark, sf_dir, "fx_area"), "iso")


@query("enrich_with_unknown", with_inputs("fx_catalog fx_known_area", """
SELECT boundary_id, c.iso, name, a.iso IS NOT NULL AS country_known FROM fx_catalog c LEFT JOIN fx_known_area a ON c.iso = a.iso"""))
def enrich_with_unknown(spark, sf_dir):
    meta = derived(spark, sf_dir, "fx_catalog").select("boundary_id", "iso")
    return C.enrich_with_country(meta, derived(spark, sf_dir, "fx_known_area").select("iso", "name"), "iso", keep_unknown=True)


@query("unknown_codes", with_inputs("fx_catalog fx_known_area", "SELECT boundary_id, iso FROM fx_catalog WHERE iso NOT IN (SELECT iso FROM fx_known_area)"))
def unknown_codes(spark, sf_dir):
    return C.unknown_codes(derived(spark, sf_dir, "fx_catalog").select("boundary_id", "iso"),
                           derived(spark, sf_dir, "fx_known_area"), "iso", "iso")


_RENAMED = "CASE " + " ".join(f"WHEN contains(country_na, '{p}') THEN '{n}'" for p, n in C.NAME_PATTERNS) + " ELSE country_na END"
_ALIASES = "(VALUES " + ", ".join("('{}', '{}')".format(n.replace("'", "''"), c) for n, c in C.COUNTRY_ALIASES.items()) + ") AS a(name, code)"


@query("rename_by_pattern", with_inputs("fx_world", f"SELECT fid, country_na, {_RENAMED} AS new_name FROM fx_world"))
def rename_by_pattern(spark, sf_dir):
    return derived(spark, sf_dir, "fx_world").withColumn("new_name", C.rename_by_pattern("country_na"))


@query("resolve_country_code", with_inputs("fx_world fx_name_list", f"""
SELECT fid, n.new_name, coalesce(u.code, a.code) AS iso_code FROM (SELECT fid, {_RENAMED} AS new_name FROM fx_world) n
LEFT JOIN (SELECT name, max(code) AS code FROM fx_name_list GROUP BY 1 HAVING count(*) = 1) u ON n.new_name = u.name LEFT JOIN {_ALIASES} ON n.new_name = a.name"""))
def resolve_country_code(spark, sf_dir):
    world = derived(spark, sf_dir, "fx_world").select("fid", C.rename_by_pattern("country_na").alias("new_name"))
    return C.resolve_country_code(world, "new_name", derived(spark, sf_dir, "fx_name_list"))


@query("unresolved_names", with_inputs("fx_world fx_name_list", f"""
SELECT fid, n.new_name AS country_na FROM (SELECT fid, {_RENAMED} AS new_name FROM fx_world WHERE NOT contains(country_na, 'disp')) n
LEFT JOIN (SELECT name, max(code) AS code FROM fx_name_list GROUP BY 1 HAVING count(*) = 1) u ON n.new_name = u.name LEFT JOIN {_ALIASES} ON n.new_name = a.name
WHERE coalesce(u.code, a.code) IS NULL"""))
def unresolved_names(spark, sf_dir):
    from boundaryspark.plans.composite import unresolved_names as unresolved
    return unresolved(derived(spark, sf_dir, "fx_world"), derived(spark, sf_dir, "fx_name_list"))


@query("split_disputed", with_inputs("fx_world", """
SELECT fid, CASE WHEN contains(country_na, 'disp') THEN replace(country_na, ' (disp)', '') ELSE country_na END AS country_na, contains(country_na, 'disp') AS disputed FROM fx_world"""))
def split_disputed(spark, sf_dir):
    plain, marked = C.split_disputed(derived(spark, sf_dir, "fx_world"), "country_na")
    return plain.withColumn("disputed", F.lit(False)).unionByName(marked.withColumn("disputed", F.lit(True)))


@query("dedupe_country_names", with_inputs("fx_world", f"""
SELECT new_name, initial, min(fid) AS fid FROM (SELECT fid, {_RENAMED} AS new_name, substr(country_na, 1, 1) AS initial FROM fx_world) GROUP BY ALL"""))
def dedupe_country_names(spark, sf_dir):
    world = derived(spark, sf_dir, "fx_world").select(
        C.rename_by_pattern("country_na").alias("new_name"), F.substring("country_na", 1, 1).alias("initial"), "fid")
    return C.dedupe_country_names(world, "new_name", "initial", "fid")


@query("level_fallback", with_inputs("fx_catalog", """
SELECT iso, adm, CASE adm WHEN 'ADM0' THEN a0 WHEN 'ADM1' THEN coalesce(a1, a0) ELSE coalesce(a2, a1, a0) END AS layer
FROM (SELECT iso, max(CASE WHEN adm = 'ADM0' THEN boundary_id END) AS a0, max(CASE WHEN adm = 'ADM1' THEN boundary_id END) AS a1, max(CASE WHEN adm = 'ADM2' THEN boundary_id END) AS a2
 FROM fx_catalog GROUP BY 1), (VALUES ('ADM0'), ('ADM1'), ('ADM2')) AS l(adm)"""))
def level_fallback(spark, sf_dir):
    layers = derived(spark, sf_dir, "fx_catalog").select("iso", "adm", F.col("boundary_id").alias("layer"))
    return C.level_fallback(layers, "layer")


@query("coverage_gaps", with_inputs("fx_catalog fx_area", """
SELECT a.iso, l.adm, p.product FROM fx_area a, (VALUES ('ADM0'), ('ADM1'), ('ADM2')) AS l(adm), (VALUES ('Public Domain'), ('Open Data Commons Open Database License 1.0')) AS p(product)
WHERE NOT EXISTS (SELECT 1 FROM fx_catalog c WHERE c.iso = a.iso AND c.adm = l.adm AND c.boundary_license = p.product)
 AND NOT EXISTS (SELECT 1 FROM fx_area e WHERE e.iso = a.iso AND e.income = 'Undefined' AND l.adm = 'ADM2')"""))
def coverage_gaps(spark, sf_dir):
    areas = derived(spark, sf_dir, "fx_area")
    catalog = derived(spark, sf_dir, "fx_catalog").withColumn("product", F.col("boundary_license"))
    exempt = areas.filter(F.col("income") == "Undefined").select("iso", F.lit("ADM2").alias("adm"))
    return C.coverage_gaps(catalog, areas, ["Public Domain", "Open Data Commons Open Database License 1.0"],
                           ["ADM0", "ADM1", "ADM2"], exempt)


@query("catalog_lookup", with_inputs("fx_source", "SELECT iso, adm, source, min(pos) AS pos, arg_min(url, pos) AS url FROM fx_source GROUP BY ALL"))
def catalog_lookup(spark, sf_dir):
    sources = derived(spark, sf_dir, "fx_source").select("iso", "adm", "source", "pos", "url")
    return C.catalog_lookup_all(sources, "pos")


@query("catalog_search", with_inputs("fx_catalog fx_area", """
SELECT boundary_id, c.iso, adm, continent, name FROM fx_catalog c JOIN fx_area a ON c.iso = a.iso
WHERE adm = 'ADM2' AND continent = 'BUILDING' AND (contains(lower(boundary_id), 'r#0000') OR contains(lower(name), 'r#0000') OR contains(lower(c.iso), 'r#0000'))"""))
def catalog_search(spark, sf_dir):
    rows = C.enrich_with_country(derived(spark, sf_dir, "fx_catalog"), derived(spark, sf_dir, "fx_area"), "iso")
    shown = rows.select("boundary_id", "iso", "adm", "continent", "name")
    return C.catalog_search(shown, "R#0000 ", "ADM2", "BUILDING", ["boundary_id", "name", "iso"])


def published_names(df):
    """Catalogue input under the published column names."""
    return df.select(
        F.col("boundary_id").alias("boundaryID"), F.col("name").alias("boundaryName"), F.col("iso").alias("boundaryISO"),
        F.col("boundary_year").alias("boundaryYear"), F.lower("adm").alias("boundaryType"),
        F.col("boundary_canonical").alias("boundaryCanonical"), F.col("boundary_source").alias("boundarySource"),
        F.col("boundary_license").alias("boundaryLicense"), F.col("license_detail").alias("licenseDetail"),
        F.col("license_source").alias("licenseSource"), F.col("boundary_source_url").alias("boundarySourceURL"),
        F.col("source_date").alias("sourceDataUpdateDate"), F.col("build_date").alias("buildDate"),
        F.col("continent").alias("Continent"), F.col("region").alias("UNSDG-region"),
        F.col("subregion").alias("UNSDG-subregion"), F.col("income").alias("worldBankIncomeGroup"),
        F.col("units").alias("admUnitCount"), F.lit(None).cast("double").alias("meanVertices"),
        F.col("min_vertices").alias("minVertices"), F.col("max_vertices").alias("maxVertices"),
        F.lit(float("nan")).alias("meanPerimeterLengthKM"), F.col("min_area").alias("minPerimeterLengthKM"),
        F.col("max_area").alias("maxPerimeterLengthKM"), F.col("max_area").alias("meanAreaSqKM"),
        F.col("min_area").alias("minAreaSqKM"), F.col("max_area").alias("maxAreaSqKM"),
        F.col("static_link").alias("staticDownloadLink"))


def _published(spark, sf_dir):
    return published_names(C.enrich_with_country(
        derived(spark, sf_dir, "fx_catalog"), derived(spark, sf_dir, "fx_area"), "iso"))


_BARE = "regexp_replace({}, 'https?:?//', '', 'g')"
_STEM = f"'{BASE}/' || c.iso || '/' || adm || '/{PREFIX}-' || c.iso || '-' || adm"
_API = f"""
SELECT boundary_id AS "boundaryID", name AS "boundaryName", c.iso AS "boundaryISO", boundary_year AS "boundaryYearRepresented", adm AS "boundaryType",
 coalesce(nullif(boundary_canonical, ''), 'Unknown') AS "boundaryCanonical", boundary_source AS "boundarySource", boundary_license AS "boundaryLicense",
 coalesce(license_detail, '') AS "licenseDetail", {_BARE.format('license_source')} AS "licenseSource",
 {_BARE.format('boundary_source_url')} AS "boundarySourceURL", strftime(source_date, '%a %b %d %H:%M:%S %Y') AS "sourceDataUpdateDate", strftime(build_date, '%b %d, %Y') AS "buildDate",
 continent AS "Continent", region AS "UNSDG-region", subregion AS "UNSDG-subregion", income AS "worldBankIncomeGroup", cast(units AS string) AS "admUnitCount", '' AS "meanVertices",
 cast(min_vertices AS string) AS "minVertices", cast(max_vertices AS string) AS "maxVertices", '' AS "meanPerimeterLengthKM", printf('%.6f', min_area) AS "minPerimeterLengthKM",
 printf('%.6f', max_area) AS "maxPerimeterLengthKM", printf('%.6f', max_area) AS "meanAreaSqKM", printf('%.6f', min_area) AS "minAreaSqKM", printf('%.6f', max_area) AS "maxAreaSqKM",
 coalesce(nullif(static_link, ''), {_STEM} || '-all.zip') AS "staticDownloadLink", {_STEM} || '.geojson' AS "gjDownloadURL", {_STEM} || '.topojson' AS "tjDownloadURL",
 {_STEM} || '-PREVIEW.png' AS "imagePreview", {_STEM} || '_simplified.geojson' AS "simplifiedGeometryGeoJSON"
FROM fx_catalog c JOIN fx_area a ON c.iso = a.iso"""


@query("api_record", with_inputs("fx_catalog fx_area", _API))
def api_record(spark, sf_dir):
    return C.api_record(_published(spark, sf_dir), BASE, PREFIX)


@query("download_urls", with_inputs("fx_catalog", f"""SELECT boundary_id, {_STEM} || '-all.zip' AS "staticDownloadLink", {_STEM} || '.geojson' AS "gjDownloadURL", {_STEM} || '.topojson' AS "tjDownloadURL",
 {_STEM} || '-PREVIEW.png' AS "imagePreview", {_STEM} || '_simplified.geojson' AS "simplifiedGeometryGeoJSON" FROM fx_catalog c"""))
def download_urls(spark, sf_dir):
    return derived(spark, sf_dir, "fx_catalog").select(
        "boundary_id", *[v.alias(k) for k, v in S.download_urls("iso", "adm", BASE, PREFIX).items()])


@query("camel_case_columns", with_inputs("fx_catalog", """
SELECT boundary_id AS "boundaryID", boundary_source_url AS "boundarySourceURL", iso, adm, units AS "admUnits", min_area AS "minAreaSqKM", max_area AS "maxLengthKM", max_vertices AS "maxVertices"
FROM fx_catalog"""))
def camel_case_columns(spark, sf_dir):
    rows = derived(spark, sf_dir, "fx_catalog").select(
        F.col("boundary_id").alias("boundaryid"), "boundary_source_url", "iso", "adm", F.col("units").alias("adm_units"),
        F.col("min_area").alias("min_area_sqkm"), F.col("max_area").alias("max_length_km"), F.col("max_vertices").alias("maxvertices"))
    return C.camel_case_columns(rows)


_LINES = [("ISO-3166-1 (Alpha-3)", "c.iso"), ("Boundary Representative of Year", "boundary_year"), ("Boundary Type", "adm"),
          ("Boundary Source(s)", "boundary_source"), ("Canonical Boundary Type Name", "coalesce(boundary_canonical, '')"), ("License", "boundary_license"),
          ("License Notes", "license_detail"), ("License Source", "license_source"), ("Data Source", "boundary_source_url"),
          ("Source Data Updated On", "strftime(source_date, '%Y-%m-%d')"), ("File Built On", "strftime(build_date, '%Y-%m-%d')"), ("Number of Administrative Units", "units")]
_TEXT = ("list_value(CASE WHEN contains(boundary_license, 'Open Data Commons Open Database') THEN 'The source requires attribution under the Open Database licence guidelines "
         "(https://osmfoundation.org/wiki/Licence/Attribution_Guidelines).' ELSE 'Citation of the sources named in this file is recommended.' END, "
         + ", ".join(f"'{label}: ' || {c}" for label, c in _LINES) + ")")


def _metadata_rows(df):
    day = {c: F.date_format(c, "yyyy-MM-dd") for c in ("source_date", "build_date")}
    return df.select(
        "boundary_id", "iso", "adm", F.col("iso").alias("boundaryISO"), F.col("boundary_year").alias("boundaryYear"), F.col("adm").alias("boundaryType"),
        F.col("boundary_source").alias("boundarySource"), F.col("boundary_canonical").alias("boundaryCanonical"), F.col("boundary_license").alias("boundaryLicense"),
        F.col("license_detail").alias("licenseDetail"), F.col("license_source").alias("licenseSource"), F.col("boundary_source_url").alias("boundarySourceURL"),
        day["source_date"].alias("sourceDataUpdateDate"), day["build_date"].alias("buildDate"), F.col("units").alias("admUnitCount"))


@query("layer_metadata_text", with_inputs("fx_catalog", f"""
SELECT boundary_id, cast(unnest(range(13)) AS int) AS line_no, unnest({_TEXT}) AS line FROM fx_catalog c"""))
def layer_metadata_text(spark, sf_dir):
    return C.layer_metadata_text(_metadata_rows(derived(spark, sf_dir, "fx_catalog")), ["boundary_id"])


@query("catalog_rollup", with_inputs("fx_catalog", """
SELECT grain_iso, grain_adm, count(*) AS records, min(boundary_id) AS first_id, max(boundary_id) AS last_id FROM (
 SELECT 'ALL' AS grain_iso, 'ALL' AS grain_adm, boundary_id FROM fx_catalog UNION ALL SELECT 'ALL', adm, boundary_id FROM fx_catalog
 UNION ALL SELECT iso, 'ALL', boundary_id FROM fx_catalog UNION ALL SELECT iso, adm, boundary_id FROM fx_catalog) GROUP BY ALL"""))
def catalog_rollup(spark, sf_dir):
    rows = C.catalog_rollup(derived(spark, sf_dir, "fx_catalog").select("iso", "adm", "boundary_id"))
    return rows.groupBy("grain_iso", "grain_adm").agg(
        F.count(F.lit(1)).alias("records"), F.min("boundary_id").alias("first_id"), F.max("boundary_id").alias("last_id"))


@query("catalog_rollup_counts", with_inputs("fx_catalog", """
SELECT coalesce(iso, 'ALL') AS grain_iso, coalesce(adm, 'ALL') AS grain_adm, count(*) AS records FROM fx_catalog GROUP BY GROUPING SETS ((), (iso), (adm), (iso, adm))"""))
def catalog_rollup_counts(spark, sf_dir):
    return C.catalog_rollup_counts(derived(spark, sf_dir, "fx_catalog"))


@query("distinct_countries", with_inputs("fx_source", """SELECT iso, arg_min(source, pos) AS name FROM fx_source GROUP BY 1"""))
def distinct_countries(spark, sf_dir):
    sources = derived(spark, sf_dir, "fx_source").withColumn("name", F.col("source"))
    return C.distinct_countries(sources, "pos")


@query("distinct_levels", with_inputs("fx_source", "SELECT DISTINCT adm FROM fx_source WHERE iso = 'C0000001'"))
def distinct_levels(spark, sf_dir):
    return C.distinct_levels(derived(spark, sf_dir, "fx_source"), "C0000001")


@query("distinct_sources", with_inputs("fx_source", "SELECT DISTINCT source FROM fx_source WHERE iso = (SELECT min(iso) FROM fx_source) AND adm = 'ADM1'"))
def distinct_sources(spark, sf_dir):
    sources = derived(spark, sf_dir, "fx_source")
    least = sources.agg(F.min("iso").alias("iso"))
    return C.distinct_sources(sources, least.scalar(), "ADM1")


@query("group_records", with_inputs("fx_source", "SELECT source, count(*) AS records, round(avg(area), 4) AS mean FROM fx_source GROUP BY 1"))
def group_records(spark, sf_dir):
    rows = derived(spark, sf_dir, "fx_source").select("source", "pos", "area")
    lists = C.group_records(rows, "source", lists=64).groupBy("source").agg(F.sum(F.size("records")).alias("records"))
    return lists.join(C.mean_value(rows, "source", "area"), "source").withColumn("mean", F.round("mean", 4))


@query("sort_records", with_inputs("fx_catalog", "SELECT boundary_id, boundary_canonical FROM fx_catalog"))
def sort_records(spark, sf_dir):
    return C.sort_records(derived(spark, sf_dir, "fx_catalog").select("boundary_id", "boundary_canonical"), "boundary_canonical", True)


@query("page", with_inputs("fx_catalog", "SELECT boundary_id, iso, adm FROM fx_catalog ORDER BY iso, adm LIMIT 50 OFFSET 100"))
def page(spark, sf_dir):
    rows = derived(spark, sf_dir, "fx_catalog").select("boundary_id", "iso", "adm")
    return C.page(rows, 3, [F.col("iso"), F.col("adm")])


@query("merge_layers", with_inputs("fx_world fx_unit", """
SELECT fid, country_na, cast(NULL AS string) AS adm, cast(NULL AS string) AS unit_name FROM fx_world UNION ALL SELECT uid, NULL, adm, unit_name FROM fx_unit"""))
def merge_layers(spark, sf_dir):
    units = derived(spark, sf_dir, "fx_unit").select(F.col("uid").alias("fid"), "adm", "unit_name")
    return C.merge_layers(derived(spark, sf_dir, "fx_world"), units)


@query("disputed_ids", with_inputs("fx_world fx_name_list", """
SELECT fid, 'DIS' || lpad(cast(row_number() OVER (ORDER BY fid) AS string), cast(greatest(3, len(cast(row_number() OVER (ORDER BY fid) AS string))) AS int), '0') AS "shapeID",
 CASE WHEN code IS NULL THEN cast(110 + row_number() OVER (PARTITION BY code IS NULL ORDER BY fid) AS string) ELSE code END AS "shapeGroup"
FROM (SELECT fid, replace(country_na, ' (disp)', '') AS name FROM fx_world WHERE contains(country_na, 'disp')) w
LEFT JOIN (SELECT name, max(code) AS code FROM fx_name_list GROUP BY 1 HAVING count(*) = 1) u ON w.name = u.name"""))
def disputed_ids(spark, sf_dir):
    from boundaryspark.plans.composite import disputed_ids as number
    _, marked = C.split_disputed(derived(spark, sf_dir, "fx_world"), "country_na")
    coded = C.resolve_country_code(marked, "country_na", derived(spark, sf_dir, "fx_name_list"), {})
    return number(coded, "fid").select("fid", "shapeID", "shapeGroup")


# --- identity and change -------------------------------------------------------------------------


@query("boundary_id", with_inputs("fx_catalog", f"SELECT iso, adm, iso || '-' || adm || '-' || {mod_sql('boundary_id', 10 ** 8)} AS id FROM fx_catalog"))
def boundary_id(spark, sf_dir):
    return derived(spark, sf_dir, "fx_catalog").select(
        "iso", "adm", I.boundary_id("iso", "adm", I.package_fingerprint(F.col("boundary_id").cast("binary"))).alias("id"))


@query("hash_mod", f"SELECT doc_id, {mod_sql('text', 10 ** 8)} AS h8, {mod_sql('text', 10 ** 14)} AS h14 FROM documents")
def hash_mod(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.hash_mod("text", 10 ** 8).alias("h8"), S.hash_mod("text", 10 ** 14).alias("h14"))


_NORM = "lower(trim(regexp_replace(replace(replace(replace({}, chr(34), ''), chr(39), ''), ',', ''), '\\s+', ' ', 'g')))"
_FIELDS = {"admUnitCount": "cast(units AS string)", "boundaryCanonical": "boundary_canonical", "boundaryID": "boundary_id", "boundaryISO": "iso",
           "boundaryLicense": "boundary_license", "boundarySource": "boundary_source", "boundarySourceURL": "boundary_source_url", "boundaryType": "adm",
           "boundaryYear": "boundary_year", "licenseDetail": "license_detail", "licenseSource": "license_source"}
_JSON = "'{' || " + " || ',' || ".join(
    f"""'"{k}":' || coalesce('"' || replace({_NORM.format(v)}, chr(92), chr(92) || chr(92)) || '"', 'null')""" for k, v in _FIELDS.items()) + " || '}'"
_FINGERPRINT = f"sha256({_JSON})"
_SPARK_FIELDS = {"admUnitCount": "units", "boundaryCanonical": "boundary_canonical", "boundaryID": "boundary_id", "boundaryISO": "iso",
                 "boundaryLicense": "boundary_license", "boundarySource": "boundary_source", "boundarySourceURL": "boundary_source_url",
                 "boundaryType": "adm", "boundaryYear": "boundary_year", "licenseDetail": "license_detail", "licenseSource": "license_source",
                 "sourceDataUpdateDate": "source_date"}


def _print():
    return I.metadata_fingerprint({k: F.col(v) for k, v in _SPARK_FIELDS.items()})


@query("metadata_fingerprint", with_inputs("fx_catalog", f"SELECT boundary_id, {_FINGERPRINT} AS fingerprint FROM fx_catalog"))
def metadata_fingerprint(spark, sf_dir):
    return derived(spark, sf_dir, "fx_catalog").select("boundary_id", _print().alias("fingerprint"))


@query("static_links", with_inputs("fx_catalog", f"SELECT boundary_id, '{BASE}/{PREFIX}-' || iso || '-' || adm || '-all-' || {_FINGERPRINT} || '.zip' AS link FROM fx_catalog"))
def static_links(spark, sf_dir):
    return derived(spark, sf_dir, "fx_catalog").select("boundary_id", I.static_link("iso", "adm", _print(), BASE, PREFIX).alias("link"))


@query("previous_build_join", with_inputs("fx_catalog_new fx_catalog_old", """
SELECT coalesce(n.iso, o.iso) AS iso, coalesce(n.adm, o.adm) AS adm, n.units AS new_units, o.units AS old_units, n.iso IS NOT NULL AS in_new, o.iso IS NOT NULL AS in_old
FROM fx_catalog_new n FULL JOIN fx_catalog_old o ON n.iso = o.iso AND n.adm = o.adm"""))
def previous_build_join(spark, sf_dir):
    new = derived(spark, sf_dir, "fx_catalog_new").select("iso", "adm", "units")
    old = derived(spark, sf_dir, "fx_catalog_old").select("iso", "adm", "units")
    return I.previous_build_join(new, old, KEYS)


@query("detect_changes", with_inputs("fx_catalog_new fx_catalog_old", """
SELECT *, change IN ('added', 'geometry', 'metadata') AS rebuild FROM (
SELECT coalesce(n.iso, o.iso) AS iso, coalesce(n.adm, o.adm) AS adm, CASE WHEN o.iso IS NULL THEN 'added' WHEN n.iso IS NULL THEN 'removed'
 WHEN n.units <> o.units THEN 'geometry' WHEN n.license_detail <> o.license_detail OR n.boundary_license <> o.boundary_license THEN 'metadata' ELSE 'unchanged' END AS change
FROM fx_catalog_new n FULL JOIN fx_catalog_old o ON n.iso = o.iso AND n.adm = o.adm)"""))
def detect_changes(spark, sf_dir):
    def side(name):
        return derived(spark, sf_dir, name).select(
            "iso", "adm", F.sha2(F.col("units").cast("string"), 256).alias("geometry_fingerprint"),
            F.array("boundary_license", "license_detail").alias("metadata_lines"))
    return I.detect_changes(side("fx_catalog_new"), side("fx_catalog_old"), KEYS)


@query("upsert_catalog", with_inputs("fx_catalog_new fx_catalog_old", """
SELECT iso, adm, boundary_id, units FROM fx_catalog_new UNION ALL SELECT iso, adm, boundary_id, units FROM fx_catalog_old o
WHERE NOT EXISTS (SELECT 1 FROM fx_catalog_new n WHERE n.iso = o.iso AND n.adm = o.adm)"""))
def upsert_catalog(spark, sf_dir):
    cols = ["iso", "adm", "boundary_id", "units"]
    return I.upsert_catalog(derived(spark, sf_dir, "fx_catalog_old").select(cols), derived(spark, sf_dir, "fx_catalog_new").select(cols), KEYS)


# --- scalar helpers over whole tables ------------------------------------------------------------


@query("text_helpers", with_inputs("fx_catalog", f"""
SELECT boundary_id, {_BARE.format('license_source')} AS bare_url, replace(replace(replace(license_detail, ',', ''), chr(92), ''), chr(34), '') AS clean,
 {_NORM.format('license_detail')} AS norm, CASE WHEN substr(license_source, 1, 4) = 'http' THEN license_source ELSE 'http://' || license_source END AS url,
 CASE WHEN regexp_matches(boundary_source, '[",\\n]') THEN '"' || replace(boundary_source, '"', '""') || '"' ELSE boundary_source END AS csv FROM fx_catalog"""))
def text_helpers(spark, sf_dir):
    return derived(spark, sf_dir, "fx_catalog").select(
        "boundary_id", S.strip_scheme("license_source").alias("bare_url"), S.clean_free_text("license_detail").alias("clean"),
        S.normalize_text("license_detail").alias("norm"), S.ensure_scheme("license_source").alias("url"), S.csv_field("boundary_source").alias("csv"))


@query("normalize_documents", f"SELECT doc_id, {_NORM.format('text')} AS norm FROM documents")
def normalize_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.normalize_text("text").alias("norm"))


_STYLES = ["%Y-%m-%d", "%Y%m%d", "%Y/%m/%d", "%b %d, %Y", "%a %b %d %H:%M:%S %Y"]
_SPARK_STYLES = ["yyyy-MM-dd", "yyyyMMdd", "yyyy/MM/dd", "MMM dd, yyyy", "EEE MMM dd HH:mm:ss yyyy"]
_DATE_TEXT = "CASE o_orderkey % 6 " + " ".join(f"WHEN {i} THEN strftime(o_orderdate, '{s}')" for i, s in enumerate(_STYLES)) + " ELSE 'no date' END"


def _dated(spark, sf_dir):
    cases = F.lit("no date")
    for i, style in enumerate(_SPARK_STYLES):
        cases = F.when(F.col("o_orderkey") % 6 == i, F.date_format("o_orderdate", style)).otherwise(cases)
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", cases.alias("text"))


@query("parse_mixed_date", f"""SELECT o_orderkey, {_DATE_TEXT} AS text, CASE WHEN o_orderkey % 6 < 5 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS parsed FROM orders""")
def parse_mixed_date(spark, sf_dir):
    return _dated(spark, sf_dir).select("o_orderkey", "text", F.date_format(S.parse_mixed_date("text"), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("first_date_field", f"""SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 5 THEN strftime(o_orderdate, '%Y-%m-%d') END AS parsed FROM orders""")
def first_date_field(spark, sf_dir):
    names = F.array(*[F.lit(n) for n in S.SOURCE_DATE_FIELDS])
    name = F.element_at(names, (F.col("o_orderkey") % 5 + 1).cast("int"))
    whole = F.concat(F.lit('{"other": 1, "'), name, F.lit('": "'), F.col("text"), F.lit('"}'))
    broken = F.concat(F.lit('{"other: 1, "sourceDataUpdateDate" : "'), F.col("text"), F.lit('",'))
    doc = F.when(F.substring("o_orderpriority", 1, 1) == "1", broken).otherwise(whole)
    return _dated(spark, sf_dir).select("o_orderkey", F.date_format(S.first_date_field(doc), "yyyy-MM-dd").alias("parsed"))
