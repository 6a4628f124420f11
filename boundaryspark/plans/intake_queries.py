"""Queries on submitted packages and their metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from boundaryspark.functions import scalars as S
from boundaryspark.operators import intake as N
from boundaryspark.plans.inputs import derived, with_inputs
from boundaryspark.plans.registry import query
from boundaryspark.runtime import dealt_by_key

YEAR = 2026
TEXTS_PER_TASK = 20_000


def _kv(spark, sf_dir):
    # a text becomes a dozen lines, which are sorted by package in a task
    return N.parse_meta(dealt_by_key(derived(spark, sf_dir, "fx_meta_text"), N.PACKAGE, TEXTS_PER_TASK))


@query("check_package", with_inputs("fx_member", """
SELECT package_id, metas > 0 AS has_meta, shp + gj AS geometry_files, concat_ws(';', CASE WHEN metas = 0 THEN 'no meta.txt' END,
 CASE WHEN shp + gj = 0 THEN 'no geometry file' END, CASE WHEN shp + gj > 1 THEN 'several geometry files' END,
 CASE WHEN one AND shx = 0 THEN 'no .shx' END, CASE WHEN one AND dbf = 0 THEN 'no .dbf' END, CASE WHEN one AND prj = 0 THEN 'no .prj' END) AS reasons,
 metas > 0 AND shp + gj = 1 AND NOT (one AND (shx = 0 OR dbf = 0 OR prj = 0)) AS passed
FROM (SELECT *, shp = 1 AND shp + gj = 1 AS one FROM (SELECT package_id, count(*) FILTER (member = 'meta.txt') AS metas,
 count(*) FILTER (member LIKE '%.shp' AND member NOT LIKE '%MACOS%') AS shp, count(*) FILTER (member LIKE '%.geojson' AND member NOT LIKE '%MACOS%') AS gj,
 count(*) FILTER (member LIKE '%.shx') AS shx, count(*) FILTER (member LIKE '%.dbf') AS dbf, count(*) FILTER (member LIKE '%.prj') AS prj FROM fx_member GROUP BY 1))"""))
def check_package(spark, sf_dir):
    out = N.check_package(derived(spark, sf_dir, "fx_member"))
    return out.withColumn("reasons", F.concat_ws(";", "reasons"))


@query("parse_meta", with_inputs("fx_kv", "SELECT package_id, cast(line_no AS int) AS line_no, key, val FROM fx_kv"))
def parse_meta(spark, sf_dir):
    return _kv(spark, sf_dir).drop("path")


@query("parse_meta_strict", with_inputs("fx_meta_text", """
SELECT package_id, cast(line_no AS int) AS line_no, CASE WHEN p = 0 THEN 'readError' ELSE trim(substr(line, 1, p - 1)) END AS key,
 CASE WHEN p = 0 THEN 'readError' ELSE trim(substr(line, p + 1)) END AS val
FROM (SELECT package_id, line, line_no, instr(line, ':') AS p FROM (SELECT package_id, unnest(string_split(meta_text, chr(10))) AS line, unnest(range(len(string_split(meta_text, chr(10))))) AS line_no FROM fx_meta_text))"""))
def parse_meta_strict(spark, sf_dir):
    return N.parse_meta(derived(spark, sf_dir, "fx_meta_text"), mode="strict").drop("path")


@query("meta_wide", with_inputs("fx_kv", "SELECT package_id, " + ", ".join(
    f"""coalesce(arg_max(CASE WHEN key = '{k}' THEN val END, CASE WHEN key = '{k}' THEN line_no END), '{"" if c == "boundaryCanonical" else "METADATA ERROR"}') AS "{c}" """
    for k, c in N.META_COLUMNS.items()) + " FROM fx_kv GROUP BY 1"))
def meta_wide(spark, sf_dir):
    return N.meta_wide(_kv(spark, sf_dir))


_YEAR_SQL = f"""CASE WHEN contains(v, 'to') THEN CASE WHEN len(string_split(v, ' to ')) = 2 AND try_strptime(string_split(v, ' to ')[1], '%d-%m-%Y') IS NOT NULL AND try_strptime(string_split(v, ' to ')[2], '%d-%m-%Y') IS NOT NULL
   THEN v ELSE 'ERROR: unreadable year range' END
 WHEN try_cast(v AS double) IS NULL THEN 'ERROR: unreadable year' WHEN floor(try_cast(v AS double)) > 1950 AND floor(try_cast(v AS double)) <= {YEAR} THEN v
 ELSE 'ERROR: year out of range: ' || cast(floor(try_cast(v AS double)) AS bigint) END"""
_BLANK = "len(replace(val, ' ', '')) = 0"
_NULLISH = f"CASE WHEN NOT ({_BLANK}) AND lower(val) NOT IN ('na', 'nan', 'null') THEN val END"
_LICENSE_NAME = """CASE WHEN val = 'Creative Commons Attribution for Intergovernmental Organisations' THEN
 'Creative Commons Attribution 3.0 Intergovernmental Organisations (CC BY 3.0 IGO)' ELSE val END"""


def _opt(word):
    return f"(SELECT package_id, arg_max(o, line_no) AS v FROM (SELECT package_id, line_no, CASE WHEN {_BLANK} THEN '' ELSE {_NULLISH} END AS o FROM fx_kv WHERE contains(lower(key), '{word}')) WHERE o IS NOT NULL GROUP BY 1)"


FIELD_SQL = {
    "f_year": f"""SELECT package_id, arg_max({_YEAR_SQL}, line_no) AS v FROM (SELECT package_id, line_no, CASE WHEN contains(val, '.0') THEN substr(val, 1, len(val) - 2) ELSE val END AS v
 FROM fx_kv WHERE contains(key, 'Year') OR contains(key, 'year')) GROUP BY 1""",
    "f_type": """SELECT package_id, arg_max(CASE WHEN upper(replace(val, ' ', '')) IN ('ADM0', 'ADM1', 'ADM2', 'ADM3', 'ADM4', 'ADM5') THEN val ELSE 'ERROR: unknown boundary type' END, line_no) AS v
 FROM fx_kv WHERE contains(lower(key), 'boundary type') AND NOT contains(lower(key), 'name') GROUP BY 1""",
    "f_iso": """SELECT package_id, arg_max(CASE WHEN len(val) <> 3 THEN 'ERROR: code has not three letters' WHEN val IN (SELECT iso FROM fx_country) THEN val ELSE 'ERROR: code is not listed' END, line_no) AS v
 FROM fx_kv WHERE contains(lower(key), 'iso') GROUP BY 1""",
    "f_source": f"""SELECT package_id, string_agg(o, ', ' ORDER BY line_no) AS v FROM (SELECT package_id, line_no, {_NULLISH} AS o FROM fx_kv
 WHERE contains(lower(key), 'source') AND NOT contains(lower(key), 'license') AND NOT contains(lower(key), 'data')) WHERE o IS NOT NULL GROUP BY 1""",
    "f_release": """SELECT package_id, arg_max(CASE WHEN lower(val) NOT IN ('gbauthoritative', 'gbhumanitarian', 'gbopen', 'un_salb', 'un_ocha') THEN 'ERROR: unknown release type'
 WHEN NOT contains(lower(path), lower(val)) THEN 'ERROR: release type does not fit the folder' ELSE lower(val) END, line_no) AS v FROM fx_kv WHERE contains(lower(key), 'release type') GROUP BY 1""",
    "f_license": f"""SELECT package_id, arg_max(CASE WHEN lower(trim(n)) IN (SELECT lower(license) FROM fx_license) THEN n ELSE 'ERROR: unknown license: ' || n END, line_no) AS v
 FROM (SELECT package_id, line_no, {_LICENSE_NAME} AS n FROM fx_kv WHERE lower(key) = 'license') GROUP BY 1""",
    "f_licsrc": f"SELECT package_id, arg_max(coalesce({_NULLISH}, 'ERROR: no license source'), line_no) AS v FROM fx_kv WHERE contains(lower(key), 'license source') GROUP BY 1",
    "f_link": f"SELECT package_id, arg_max(coalesce({_NULLISH}, 'ERROR: no link to source data'), line_no) AS v FROM fx_kv WHERE contains(lower(key), 'link to source data') GROUP BY 1",
    "f_canonical": f"SELECT * FROM {_opt('canonical')}", "f_licnotes": f"SELECT * FROM {_opt('license notes')}",
    "f_other": f"SELECT * FROM {_opt('other notes')}",
    "f_image": "SELECT DISTINCT package_id FROM fx_member WHERE member IN ('license.png', 'license.jpg')",
    "checks": """SELECT p.package_id, coalesce(f_year.v, 'NONE') AS year, coalesce(f_type.v, 'NONE') AS "bType", coalesce(f_iso.v, 'NONE') AS iso, coalesce(f_source.v, 'NONE') AS source,
 coalesce(f_release.v, 'NONE') AS "releaseType", coalesce(f_license.v, 'NONE') AS license, coalesce(f_licsrc.v, 'NONE') AS "licenseSource", coalesce(f_link.v, 'NONE') AS "dataSource",
 coalesce(f_canonical.v, '') AS canonical, coalesce(f_licnotes.v, '') AS "licenseNotes", coalesce(f_other.v, '') AS "otherNotes",
 CASE WHEN f_licsrc.v IS NULL OR f_licsrc.v LIKE 'ERROR%' THEN 'NONE' WHEN i.package_id IS NOT NULL THEN 'Image Available' ELSE 'None Available' END AS "licenseImage"
 FROM fx_meta_text p LEFT JOIN f_year USING (package_id) LEFT JOIN f_type USING (package_id) LEFT JOIN f_iso USING (package_id) LEFT JOIN f_source USING (package_id)
 LEFT JOIN f_release USING (package_id) LEFT JOIN f_license USING (package_id) LEFT JOIN f_licsrc USING (package_id) LEFT JOIN f_link USING (package_id)
 LEFT JOIN f_canonical USING (package_id) LEFT JOIN f_licnotes USING (package_id) LEFT JOIN f_other USING (package_id) LEFT JOIN f_image i ON p.package_id = i.package_id""",
}


def checks_sql(body):
    return with_inputs("fx_kv fx_member fx_country fx_license", body, FIELD_SQL)


def _one(cte, column, missing="NONE"):
    return checks_sql(f"SELECT p.package_id, coalesce(c.v, '{missing}') AS \"{column}\" FROM fx_meta_text p LEFT JOIN {cte} c ON p.package_id = c.package_id")


def _checks(spark, sf_dir):
    return N.metadata_checks(_kv(spark, sf_dir), derived(spark, sf_dir, "fx_country"), derived(spark, sf_dir, "fx_license"),
                             derived(spark, sf_dir, "fx_member"), YEAR)


query("check_year", _one("f_year", "year"))(lambda s, d: N.check_year(_kv(s, d), YEAR))
query("check_boundary_type", _one("f_type", "bType"))(lambda s, d: N.check_boundary_type(_kv(s, d)))
query("check_iso", _one("f_iso", "iso"))(lambda s, d: N.check_iso(_kv(s, d), derived(s, d, "fx_country")))
query("check_optional_text", _one("f_canonical", "canonical", ""))(lambda s, d: N.check_optional_text(_kv(s, d), "canonical", "canonical"))
query("check_license_notes", _one("f_licnotes", "licenseNotes", ""))(lambda s, d: N.check_optional_text(_kv(s, d), "license notes", "licenseNotes"))
query("check_other_notes", _one("f_other", "otherNotes", ""))(lambda s, d: N.check_optional_text(_kv(s, d), "other notes", "otherNotes"))
query("collect_sources", _one("f_source", "source"))(lambda s, d: N.collect_sources(_kv(s, d)))
query("check_release_type", _one("f_release", "releaseType"))(lambda s, d: N.check_release_type(_kv(s, d)))
query("check_license", _one("f_license", "license"))(lambda s, d: N.check_license(_kv(s, d), derived(s, d, "fx_license")))
query("check_data_link", _one("f_link", "dataSource"))(lambda s, d: N.check_data_link(_kv(s, d)))
query("check_license_source", checks_sql('SELECT package_id, "licenseSource", "licenseImage" FROM checks'))(
    lambda s, d: N.check_license_source(_kv(s, d), derived(s, d, "fx_member")))
query("metadata_checks", checks_sql("SELECT * FROM checks"))(_checks)

_ALL = N.REQUIRED_FIELDS + N.OPTIONAL_FIELDS
_NOTES = ", ".join(f"""CASE WHEN "{f}" = 'NONE' THEN 'Missing data for {f}.' WHEN contains("{f}", 'ERROR') THEN "{f}" END""" for f in _ALL)
_BAD = " OR ".join(f"""("{f}" = 'NONE' OR contains("{f}", 'ERROR'))""" for f in _ALL)


@query("metadata_verdict", checks_sql(f"SELECT package_id, concat_ws(' | ', {_NOTES}) AS message, NOT ({_BAD}) AS all_valid FROM checks"))
def metadata_verdict(spark, sf_dir):
    return N.metadata_verdict(_checks(spark, sf_dir))


@query("check_labels", checks_sql(" UNION ALL ".join(
    f"""SELECT package_id, '{f}' AS test, '{kind}' AS kind, CASE WHEN "{f}" NOT IN ('NONE', '', 'None Available') AND NOT contains("{f}", 'ERROR') THEN 'PASSED' ELSE 'FAILED' END AS label FROM checks"""
    for f, kind in [(f, "optional" if f in N.OPTIONAL_FIELDS + ["licenseImage"] else "required") for f in _ALL])))
def check_labels(spark, sf_dir):
    return N.check_labels(_checks(spark, sf_dir))


@query("check_summary", checks_sql(f"""
SELECT "releaseType" AS product, count(*) FILTER (ok) AS successes, count(*) FILTER (NOT ok) AS failures, CASE WHEN bool_and(ok) THEN 'PASSED' ELSE 'FAILED' END AS result
FROM (SELECT "releaseType", NOT ({_BAD}) AS ok FROM checks) GROUP BY 1"""))
def check_summary(spark, sf_dir):
    checks = _checks(spark, sf_dir)
    verdict = N.metadata_verdict(checks, ["package_id", "releaseType"]).select(
        F.col("releaseType").alias("product"), F.col("all_valid").alias("passed"))
    return N.check_summary(verdict, ["product"])


@query("license_compatible", with_inputs("fx_kv fx_license", f"""
SELECT package_id, m.license, product, l.license IS NOT NULL AS license_known,
 coalesce(CASE lower(product) WHEN 'gbopen' THEN gb_open WHEN 'gbauthoritative' THEN gb_authoritative WHEN 'gbhumanitarian' THEN gb_humanitarian ELSE l.license IS NOT NULL END, false) AS license_allowed
FROM (SELECT package_id, max(CASE WHEN key = 'License' THEN {_LICENSE_NAME} END) AS license, max(CASE WHEN key = 'Release Type' THEN val END) AS product FROM fx_kv GROUP BY 1) m
LEFT JOIN fx_license l ON lower(trim(m.license)) = lower(trim(l.license))"""))
def license_compatible(spark, sf_dir):
    short, full = next(iter(N.LICENSE_ALIASES.items()))
    meta = _kv(spark, sf_dir).groupBy("package_id").agg(
        F.max(F.when(F.col("key") == "License", F.when(F.col("val") == short, full).otherwise(F.col("val")))).alias("license"),
        F.max(F.when(F.col("key") == "Release Type", F.col("val"))).alias("product"))
    return N.license_compatible(meta, derived(spark, sf_dir, "fx_license"))


@query("build_issue_digest", checks_sql(f"""
SELECT package_id, '{{"iso_ok":' || (iso NOT LIKE 'ERROR%') || ',"package_id":' || package_id || ',"year_ok":' || (year NOT LIKE 'ERROR%') || '}}' AS body
FROM checks WHERE {_BAD}"""))
def build_issue_digest(spark, sf_dir):
    checks = _checks(spark, sf_dir)
    report = N.metadata_verdict(checks, ["package_id", "iso", "year"]).select(
        "package_id", F.when(F.col("all_valid"), "PASS").otherwise("FAIL").alias("status"),
        (~F.col("iso").startswith("ERROR")).alias("iso_ok"), (~F.col("year").startswith("ERROR")).alias("year_ok"))
    return N.build_issue_digest(report, ["package_id"], ["iso_ok", "year_ok"])


@query("package_selection", with_inputs("fx_meta_text", """
SELECT package_id, file_name FROM (SELECT package_id, string_split(path, '/')[-1] AS file_name FROM fx_meta_text)
WHERE starts_with(file_name, 'N01_ADM') OR starts_with(file_name, 'N07_ADM') OR starts_with(file_name, 'N12_ADM')"""))
def package_selection(spark, sf_dir):
    packages = derived(spark, sf_dir, "fx_meta_text").select("package_id", S.file_name("path").alias("file_name"))
    return N.package_selection(packages, "N01,N07,N12", "ADM")


@query("file_stem_parts", with_inputs("fx_meta_text", """
SELECT package_id, f AS file_name, regexp_extract(f, '\\.([^.]*)$', 1) AS extension, regexp_extract(f, '^([^_]+)_', 1) AS iso, regexp_extract(f, '_([^_.]+)\\.', 1) AS adm
FROM (SELECT package_id, string_split(path, '/')[-1] AS f FROM fx_meta_text)"""))
def file_stem_parts(spark, sf_dir):
    return derived(spark, sf_dir, "fx_meta_text").select(
        "package_id", *[v.alias(k) for k, v in S.file_stem_parts("path").items()])


@query("nullish", with_inputs("fx_kv", f"SELECT package_id, cast(line_no AS int) AS line_no, {_NULLISH} AS val FROM fx_kv"))
def nullish(spark, sf_dir):
    return _kv(spark, sf_dir).select("package_id", "line_no", S.nullish("val").alias("val"))
