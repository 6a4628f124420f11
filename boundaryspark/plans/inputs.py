"""Boundary-shaped inputs derived from the given tables, the same in Spark and in plain SQL.

Every derived row comes from one row (or one group of rows) of a given table, without windows,
so the inputs grow with the tables and need no single big task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# SQL both engines accept.
COMMON = {
    "fx_country": """
SELECT concat('N', lpad(cast(n_nationkey AS string), 2, '0')) AS iso, n_name AS name, r_name AS continent,
       CASE n_nationkey % 3 WHEN 0 THEN 'High-income Countries' WHEN 1 THEN 'Low-income Countries' ELSE 'Undefined' END AS income,
       n_nationkey AS k
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "fx_unit": """
SELECT 'ADM0' AS adm, iso, cast(k AS bigint) AS uid, name AS unit_name,
       -50 + 20.0e0 * (k % 5) AS x0, -30 + 20.0e0 * (k % 5) AS x1,
       -50 + 20.0e0 * floor(k / 5.0e0) AS y0, -30 + 20.0e0 * floor(k / 5.0e0) AS y1
FROM fx_country
UNION ALL
SELECT 'ADM1', concat('N', lpad(cast(s_suppkey % 25 AS string), 2, '0')), s_suppkey, s_name,
       -50 + 20.0e0 * (s_suppkey % 5) + 20 * (floor(s_suppkey / 25.0e0) / (SELECT floor(max(s_suppkey) / 25.0e0) + 1 FROM supplier)),
       -50 + 20.0e0 * (s_suppkey % 5) + 20 * ((floor(s_suppkey / 25.0e0) + 1) / (SELECT floor(max(s_suppkey) / 25.0e0) + 1 FROM supplier)),
       -50 + 20.0e0 * floor((s_suppkey % 25) / 5.0e0), -30 + 20.0e0 * floor((s_suppkey % 25) / 5.0e0)
FROM supplier
UNION ALL
SELECT 'ADM2', concat('N', lpad(cast(c_custkey % 25 AS string), 2, '0')), c_custkey, c_name,
       -50 + 20.0e0 * (c_custkey % 5) + 20 * (floor(c_custkey / 25.0e0) / (SELECT floor(max(c_custkey) / 25.0e0) + 1 FROM customer)),
       -50 + 20.0e0 * (c_custkey % 5) + 20 * ((floor(c_custkey / 25.0e0) + 1) / (SELECT floor(max(c_custkey) / 25.0e0) + 1 FROM customer)),
       -50 + 20.0e0 * floor((c_custkey % 25) / 5.0e0), -30 + 20.0e0 * floor((c_custkey % 25) / 5.0e0)
FROM customer""",
    "fx_meta_text": """
SELECT c_custkey AS package_id,
 concat('sourceData/gbOpen/N', lpad(cast(c_custkey % 25 AS string), 2, '0'), '_ADM', cast(c_custkey % 6 AS string), '.zip') AS path,
 concat('Boundary Representative of Year: ', CASE c_custkey % 9 WHEN 0 THEN '1949' WHEN 1 THEN '01-02-2015 to 31-12-2016' WHEN 2 THEN '2013.0' WHEN 3 THEN '13-13-2015 to 31-12-2016' WHEN 4 THEN 'about 2010' ELSE '2013' END, chr(10),
 'ISO-3166-1 (Alpha-3): ', CASE WHEN c_custkey % 11 = 0 THEN 'ZZZ' WHEN c_custkey % 31 = 0 THEN 'TOOLONG' ELSE concat('N', lpad(cast(c_nationkey AS string), 2, '0')) END, chr(10),
 'Boundary Type: ', CASE WHEN c_custkey % 13 = 0 THEN 'ADM9' ELSE concat('adm ', cast(c_custkey % 6 AS string)) END, chr(10),
 'Canonical Boundary Type Name: ', CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'Qarqet' END, chr(10),
 'Source 1: ', CASE WHEN c_custkey % 23 = 0 THEN 'na' ELSE c_name END, chr(10), 'Source 2: ', CASE WHEN c_custkey % 4 = 0 THEN 'nan' ELSE 'Second source' END, chr(10),
 'Release Type: ', CASE WHEN c_custkey % 7 = 0 THEN 'gbHumanitarian' WHEN c_custkey % 29 = 0 THEN 'gbOther' ELSE 'gbOpen' END, chr(10),
 'License: ', CASE c_custkey % 5 WHEN 0 THEN 'Public Domain' WHEN 1 THEN 'No Such License' WHEN 2 THEN 'Creative Commons Attribution for Intergovernmental Organisations' ELSE 'Open Data Commons Open Database License 1.0' END, chr(10),
 'License Notes: ', CASE WHEN c_custkey % 3 = 0 THEN 'na' ELSE 'see file' END, chr(10), 'License Source: ', CASE WHEN c_custkey % 19 = 0 THEN '' ELSE concat('https://example.org/', cast(c_custkey AS string)) END, chr(10),
 'Link to Source Data: ', CASE WHEN c_custkey % 8 = 0 THEN '' ELSE 'https://example.org/data:v1:x' END, chr(10), 'Other Notes: ', CASE WHEN c_custkey % 15 = 0 THEN concat(chr(10), 'broken line') ELSE '' END) AS meta_text
FROM customer""",
    "fx_license": """
SELECT license, gb_open, gb_authoritative, gb_humanitarian
FROM (VALUES ('Public Domain', true, true, true),
             ('Open Data Commons Open Database License 1.0', true, false, true),
             ('Creative Commons Attribution 3.0 Intergovernmental Organisations (CC BY 3.0 IGO)', false, true, true)) AS l(license, gb_open, gb_authoritative, gb_humanitarian)""",
    "fx_task": """
SELECT o_orderkey AS taskid, concat('N', lpad(cast(o_custkey % 25 AS string), 2, '0')) AS iso, concat('ADM', cast(o_orderkey % 6 AS string)) AS adm, o_orderdate AS time_added,
 cast(floor(o_totalprice) AS bigint) AS filesize, CASE o_orderstatus WHEN 'F' THEN 'COMPLETE' WHEN 'O' THEN 'ready' ELSE 'ERROR' END AS status, o_orderdate + (o_orderkey % 72) * INTERVAL '1' HOUR AS status_time
FROM orders""",
    "fx_status": """
SELECT event_id, concat('U', lpad(cast(user_id AS string), 6, '0'), '_ADM', cast(event_id % 6 AS string), '_WORKER') AS status_type,
 CASE event_type WHEN 'purchase' THEN 'COMPLETE' WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'S' ELSE 'PROCESSING' END AS status, ts, event_type, user_id FROM events""",
    "fx_world": """
SELECT c_custkey AS fid,
 CASE c_custkey % 11 WHEN 0 THEN concat('LAND_', cast(c_custkey % 120 AS string), ' (disp)') WHEN 1 THEN concat(c_name, ' (UK)') WHEN 2 THEN 'Portugal [Azores]'
  WHEN 3 THEN 'Greenland (Den)' WHEN 4 THEN concat(c_name, ' (Den)') WHEN 5 THEN 'Netherlands [Caribbean]' WHEN 6 THEN 'Burma' ELSE concat('LAND_', cast(c_custkey % 120 AS string)) END AS country_na
FROM customer""",
    "fx_name_list": """
SELECT concat('LAND_', cast(s_suppkey % 90 AS string)) AS name, concat('L', lpad(cast(s_suppkey AS string), 6, '0')) AS code FROM supplier
UNION ALL SELECT 'Portugal', 'PRT' UNION ALL SELECT 'United Kingdom', 'GBR' UNION ALL SELECT 'Greenland', 'GRL' UNION ALL SELECT 'Denmark', 'DNK'""",
    "fx_area": """
SELECT concat('C', lpad(cast(c_custkey AS string), 7, '0')) AS iso, c_name AS name, c_mktsegment AS continent,
 concat('region of ', c_mktsegment) AS region, concat('subregion ', cast(c_nationkey AS string)) AS subregion,
 CASE c_nationkey % 3 WHEN 0 THEN 'High-income Countries' WHEN 1 THEN 'Low-income Countries' ELSE 'Undefined' END AS income
FROM customer""",
    # a list that lacks some countries, for the queries on unknown codes
    "fx_known_area": "SELECT concat('C', lpad(cast(c_custkey AS string), 7, '0')) AS iso, c_name AS name FROM customer WHERE c_acctbal > 0",
    "fx_build": """
SELECT concat('C', lpad(cast(o_custkey AS string), 7, '0')) AS iso, concat('ADM', cast(o_orderkey % 6 AS string)) AS adm,
 o_orderkey AS key, o_totalprice AS price, o_orderdate AS day, o_orderpriority AS priority
FROM orders""",
    "fx_catalog": """
SELECT concat(iso, '-', adm, '-', cast(max(key) AS string)) AS boundary_id, iso, adm,
 cast(1950 + max(key) % 70 AS string) AS boundary_year, concat('Office of "', iso, '"') AS boundary_source,
 CASE max(key) % 3 WHEN 0 THEN '' WHEN 1 THEN cast(NULL AS string) ELSE 'Qarqet' END AS boundary_canonical,
 CASE max(key) % 2 WHEN 0 THEN 'Public Domain' ELSE 'Open Data Commons Open Database License 1.0' END AS boundary_license,
 concat(' Note, "', max(priority), '"   ', adm, chr(92), ' https//x.org') AS license_detail,
 concat(CASE max(key) % 4 WHEN 0 THEN 'https//' WHEN 1 THEN 'https://' WHEN 2 THEN 'http//' ELSE 'http://' END, 'example.org/', iso) AS license_source,
 concat('https://example.org/', iso, '/', adm) AS boundary_source_url,
 max(day) AS source_date, max(day) AS build_date, count(*) AS units,
 min(price) AS min_area, max(price) AS max_area, min(key) AS min_vertices, max(key) AS max_vertices,
 CASE max(key) % 5 WHEN 0 THEN concat('https://static.example.org/', iso, adm, '.zip') WHEN 1 THEN '' ELSE cast(NULL AS string) END AS static_link
FROM fx_build GROUP BY iso, adm""",
    "fx_source": """
SELECT concat('C', lpad(cast(o_custkey AS string), 7, '0')) AS iso, concat('ADM', cast(o_orderkey % 6 AS string)) AS adm,
 o_orderpriority AS source, o_orderkey AS pos, o_totalprice AS area, concat('https://example.org/', cast(o_orderkey AS string)) AS url
FROM orders""",
}
COMMON["fx_catalog_new"] = COMMON["fx_catalog"].replace("FROM fx_build", "FROM fx_build WHERE day >= DATE '1996-01-01'")
COMMON["fx_catalog_old"] = COMMON["fx_catalog"].replace("FROM fx_build", "FROM fx_build WHERE day < DATE '2001-01-01'")

# Parts where the spelling of list expansion differs.
_MEMBERS = """CASE WHEN p_partkey % 7 <> 0 THEN 'meta.txt' END, CASE WHEN p_partkey % 3 = 0 THEN 'a.shp' END, CASE WHEN p_partkey % 2 = 0 THEN 'a.shx' END,
 CASE WHEN p_partkey % 3 = 0 THEN 'a.dbf' END, CASE WHEN p_partkey % 4 <> 1 THEN 'a.prj' END, CASE WHEN p_partkey % 5 = 0 OR p_partkey % 3 = 1 THEN 'b.geojson' END,
 CASE WHEN p_partkey % 2 = 1 THEN '__MACOSX/b.geojson' END, CASE WHEN p_partkey % 6 = 0 THEN 'license.png' END"""
_SPARK_ONLY = {
    "fx_member": f"SELECT package_id, member FROM (SELECT p_partkey AS package_id, explode(array({_MEMBERS})) AS member FROM part) WHERE member IS NOT NULL",
}
_TEMPLATE = """(VALUES (0,0,0.0e0,0.0e0,'all'),(0,1,1.0e0,0.0e0,'all'),(0,2,1.0e0,1.0e0,'all'),(0,3,0.5e0,0.6e0,'notch'),(0,4,0.0e0,1.0e0,'all'),(0,5,0.0e0,0.0e0,'all'),
 (1,0,0.4e0,0.2e0,'hole'),(1,1,0.4e0,0.4e0,'hole'),(1,2,0.6e0,0.4e0,'hole'),(1,3,0.6e0,0.2e0,'hole'),(1,4,0.4e0,0.2e0,'hole')) AS v(ring, seq, fx, fy, kind)"""
_SQL_ONLY = {
    "fx_member": f"SELECT package_id, member FROM (SELECT p_partkey AS package_id, unnest([{_MEMBERS}]) AS member FROM part) WHERE member IS NOT NULL",
    "fx_vertex": f"""
SELECT u.adm, u.iso, u.uid, 0 AS poly, v.ring, cast(row_number() OVER (PARTITION BY u.adm, u.uid, v.ring ORDER BY v.seq) - 1 AS int) AS seq, u.x0 * (1 - v.fx) + u.x1 * v.fx AS x, u.y0 * (1 - v.fy) + u.y1 * v.fy AS y
FROM fx_unit u CROSS JOIN {_TEMPLATE}
WHERE v.kind = 'all' OR (v.kind = 'notch' AND u.adm = 'ADM1' AND u.uid % 3 = 0) OR (v.kind = 'hole' AND u.adm = 'ADM2' AND u.uid % 10 = 0)""",
    "fx_edge": """
SELECT * FROM (SELECT adm, iso, uid, poly, ring, seq, x AS x1, y AS y1,
 lead(x) OVER (PARTITION BY adm, uid, poly, ring ORDER BY seq) AS x2, lead(y) OVER (PARTITION BY adm, uid, poly, ring ORDER BY seq) AS y2 FROM fx_vertex) e WHERE x2 IS NOT NULL""",
    "fx_kv": """
SELECT package_id, path, line_no, CASE WHEN len(parts) < 2 THEN 'readError' ELSE trim(parts[1]) END AS key,
 CASE WHEN len(parts) < 2 THEN 'readError' WHEN len(parts) > 2 THEN trim(parts[2] || parts[3]) ELSE trim(parts[2]) END AS val
FROM (SELECT package_id, path, line_no, string_split(line, ':') AS parts
 FROM (SELECT package_id, path, unnest(string_split(meta_text, chr(10))) AS line, unnest(range(len(string_split(meta_text, chr(10))))) AS line_no FROM fx_meta_text))""",
}

_NEEDS = {
    "fx_unit": ["fx_country"], "fx_vertex": ["fx_unit"], "fx_edge": ["fx_vertex"], "fx_kv": ["fx_meta_text"],
    "fx_catalog": ["fx_build"], "fx_catalog_new": ["fx_build"], "fx_catalog_old": ["fx_build"],
}


def with_inputs(names: str, body: str, extra: dict[str, str] | None = None) -> str:
    """SQL text with the named inputs (and their own inputs) as common table expressions."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    texts = {**COMMON, **_SQL_ONLY}
    ctes = [f"{n} AS ({texts[n]})" for n in ordered]
    ctes += [f"{n} AS ({sql})" for n, sql in (extra or {}).items()]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; timestamps without zone become instants of the UTC session."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*[F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.typeName() == "timestamp_ntz"
                       else F.col(f.name) for f in df.schema.fields])


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input as a DataFrame."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")

    def register(wanted: str) -> DataFrame:
        for needed in _NEEDS.get(wanted, []):
            register(needed)
        text = {**COMMON, **_SPARK_ONLY}[wanted]
        for base in ("region", "nation", "supplier", "customer", "part", "orders", "events"):
            if re.search(rf"\b{base}\b", text):
                table(spark, sf_dir, base).createOrReplaceTempView(base)
        df = spark.sql(text)
        df.createOrReplaceTempView(wanted)
        return df

    return register(name)


def _corner(fx: float, fy: float) -> Column:
    return F.struct((F.col("x0") * (1 - fx) + F.col("x1") * fx).alias("x"),
                    (F.col("y0") * (1 - fy) + F.col("y1") * fy).alias("y"))


def features(spark: SparkSession, sf_dir: str, *levels: str) -> DataFrame:
    """Unit polygons: plain strips, notched ones (ADM1) and ones with a hole (ADM2)."""
    units = derived(spark, sf_dir, "fx_unit")
    if levels:
        units = units.filter(F.col("adm").isin(*levels))
    none = F.array().cast("array<struct<x:double,y:double>>")
    notch = F.when((F.col("adm") == "ADM1") & (F.col("uid") % 3 == 0), F.array(_corner(0.5, 0.6))).otherwise(none)
    shell = F.concat(F.array(_corner(0, 0), _corner(1, 0), _corner(1, 1)), notch,
                     F.array(_corner(0, 1), _corner(0, 0)))
    hole = F.array(_corner(0.4, 0.2), _corner(0.4, 0.4), _corner(0.6, 0.4), _corner(0.6, 0.2), _corner(0.4, 0.2))
    has_hole = (F.col("adm") == "ADM2") & (F.col("uid") % 10 == 0)
    polygon = F.when(has_hole, F.array(shell, hole)).otherwise(F.array(shell))
    return units.select("adm", "iso", "uid", "unit_name", F.array(polygon).alias("geom"))
