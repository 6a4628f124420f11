"""Queries that run the build and the publish job, and the readers of lookup tables, on files made from the given tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from boundaryspark.operators import layers as L
from boundaryspark.plans.inputs import derived, features, table, with_inputs
from boundaryspark.plans.intake_queries import YEAR
from boundaryspark.plans.jobs import build_layers, publish
from boundaryspark.plans.registry import query
from boundaryspark.plans.topology_queries import _BOW, bow_ties
from boundaryspark.runtime import scratch_path
from boundaryspark.sources import geojson as J
from boundaryspark.sources import lookups as R


def _zips(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        contents = []
        for meta, layer in zip(batch["meta_text"], batch["layer"]):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                for name, text in (("meta.txt", meta), ("units.geojson", layer), ("__MACOSX/units.geojson", "junk"), ("license.png", "p")):
                    if text is not None:
                        archive.writestr(zipfile.ZipInfo(name, (2024, 1, 1, 0, 0, 0)), text)
            contents.append(buffer.getvalue())
        yield batch[["package_id", "iso", "adm"]].assign(content=contents)


_YEAR_OF = "CASE k % 6 WHEN 1 THEN '1949' ELSE '2013' END"


def _submissions(spark, sf_dir):
    """A package for each layer: some without metadata, with an early year, or in another projection; some units are bow-ties."""
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.col("uid").cast("string").alias("Name")).alias("properties"),
                                 F.from_json(J.geojson_geometry("geom"), "struct<type:string,coordinates:array<array<array<array<double>>>>>").alias("geometry")))
    units = bow_ties(spark, sf_dir).withColumn("_f", F.struct("uid", feature.alias("text")))
    k = F.substring("iso", 2, 2).cast("int")
    # a layer is one file of a package, so its units meet in one row
    layers = units.groupBy("iso", "adm").agg(F.array_join(F.array_sort(F.collect_list("_f"))["text"], ",").alias("_fs")).withColumn("k", k)
    crs = F.when(k % 5 == 4, '"crs":{"type":"name","properties":{"name":"urn:ogc:def:crs:EPSG::3857"}},').otherwise("")
    meta = F.concat_ws("\n", F.concat(F.lit("Boundary Representative of Year: "), F.expr(_YEAR_OF)), F.concat(F.lit("ISO-3166-1 (Alpha-3): "), "iso"),
                       F.concat(F.lit("Boundary Type: "), "adm"), F.lit("Canonical Boundary Type Name: "), F.lit("Source 1: Survey"), F.lit("Source 2: Office"),
                       F.lit("Release Type: gbOpen"), F.lit("License: Public Domain"), F.lit("License Notes: none"), F.lit("License Source: https://example.org/c"),
                       F.lit("Link to Source Data: https://example.org/d"), F.lit("Other Notes: "))
    rows = layers.select(F.concat(F.lit("sourceData/gbOpen/"), "iso", F.lit("_"), "adm", F.lit(".zip")).alias("package_id"), "iso", "adm",
                         F.when(k % 8 != 3, meta).alias("meta_text"), F.concat(F.lit('{"type":"FeatureCollection",'), crs, F.lit('"features":['), "_fs", F.lit("]}")).alias("layer"))
    return rows.mapInPandas(_zips, "package_id string, iso string, adm string, content binary")


@query("build_layers", with_inputs("fx_vertex fx_unit", """
SELECT u.iso, u.adm, k % 8 <> 3 AS has_meta, k % 5 <> 4 AS projection_ok, count(*) AS units, count(*) FILTER (c.n > 0 OR h.outside) AS invalid,
 k % 8 <> 3 AND k % 6 <> 1 AS meta_valid, k % 8 <> 3 AND k % 6 <> 1 AND k % 5 <> 4 AS passed, min(v.n) AS min_vertices, max(v.n) AS max_vertices
FROM (SELECT *, cast(substr(iso, 2, 2) AS int) AS k FROM fx_unit) u JOIN (SELECT adm, uid, count(*) AS n FROM fx_vertex WHERE ring = 0 GROUP BY ALL) v ON v.adm = u.adm AND v.uid = u.uid
LEFT JOIN bow_c c ON c.adm = u.adm AND c.uid = u.uid LEFT JOIN bow_hole h ON h.adm = u.adm AND h.uid = u.uid GROUP BY ALL""", _BOW))
def build(spark, sf_dir):
    rows, _ = build_layers(_submissions(spark, sf_dir), derived(spark, sf_dir, "fx_country"), derived(spark, sf_dir, "fx_license"), current_year=YEAR)
    return rows.select("iso", "adm", "has_meta", "projection_ok", F.col("unit_count").alias("units"), F.col("invalid_features").alias("invalid"),
                       (F.col("metadata_message") == "").alias("meta_valid"), "passed", "min_vertices", "max_vertices")


_COUNTRY_COLUMNS = {"iso": "boundaryISO", "name": "boundaryName", "continent": "Continent", "income": "worldBankIncomeGroup"}


def _metadata_documents(spark, sf_dir):
    """A folder with a metadata document for each layer, and a second document in every seventh one."""
    root = scratch_path(spark, "metadata")
    figures = L.layer_statistics(features(spark, sf_dir), ["iso", "adm"])
    docs = figures.select(
        F.lit("gbOpen").alias("product"), F.col("iso").alias("folder_iso"), F.col("adm").alias("folder_adm"),
        F.concat_ws("-", "iso", "adm", "unit_count").alias("boundaryID"), F.col("iso").alias("boundaryISO"), F.lit("2013").alias("boundaryYear"), F.col("adm").alias("boundaryType"),
        F.lit('Survey "A", Office').alias("boundarySource"), F.lit("").alias("boundaryCanonical"), F.lit("Public Domain").alias("boundaryLicense"), F.lit("none").alias("licenseDetail"),
        F.lit("https://example.org/c").alias("licenseSource"), F.lit("http//example.org/d").alias("boundarySourceURL"), F.lit("2020-02-01").alias("sourceDataUpdateDate"),
        F.lit("Mar 04, 2021").alias("buildDate"), F.col("unit_count").cast("string").alias("admUnitCount"), F.col("mean_vertices").cast("string").alias("meanVertices"),
        F.col("min_vertices").cast("string").alias("minVertices"), F.col("max_vertices").cast("string").alias("maxVertices"))
    docs = docs.repartition(8, F.xxhash64("folder_iso"))
    write = lambda df: df.write.mode("append").partitionBy("product", "folder_iso", "folder_adm").json(root)
    write(docs)
    write(docs.filter(F.substring("folder_iso", 2, 2).cast("int") % 7 == 2))
    return root


def _published(spark, sf_dir):
    out = scratch_path(spark, "published")
    countries = derived(spark, sf_dir, "fx_country").select(*[F.col(c).alias(n) for c, n in _COUNTRY_COLUMNS.items()])
    countries = countries.withColumns({"UNSDG-region": F.lit("r"), "UNSDG-subregion": F.lit("s")})
    records, rejected = publish(spark, _metadata_documents(spark, sf_dir), out, ["gbOpen"], countries, "https://boundaries.example.org/data", "layer", "*.json")
    return out, records, rejected


@query("publish_layers", with_inputs("fx_unit fx_country", """
SELECT CASE WHEN g.iso_dir = 'ALL' THEN 'ALL' ELSE u.iso END AS iso_dir, CASE WHEN g.adm_dir = 'ALL' THEN 'ALL' ELSE u.adm END AS adm_dir,
 u.iso || '-' || u.adm || '-' || n AS "boundaryID", c.name AS "boundaryName", c.continent AS "Continent", '2020' AS updated, 'Mar 04, 2021' AS "buildDate", 'example.org/d' AS "boundarySourceURL", cast(n AS string) AS "admUnitCount"
FROM (SELECT iso, adm, count(*) AS n FROM fx_unit GROUP BY ALL) u JOIN fx_country c ON c.iso = u.iso, (VALUES ('ALL', 'ALL'), ('ALL', 'adm'), ('iso', 'ALL'), ('iso', 'adm')) AS g(iso_dir, adm_dir)
WHERE c.k % 7 <> 2"""))
def publish_layers(spark, sf_dir):
    out, _, _ = _published(spark, sf_dir)
    lines = spark.read.option("basePath", f"{out}/api").schema("value string, iso_dir string, adm_dir string").text(f"{out}/api")
    body = F.regexp_replace("value", "^,", "")
    field = lambda name: F.get_json_object(body, f"$.{name}").alias(name)
    return lines.filter(body.startswith("{")).select(
        "iso_dir", "adm_dir", field("boundaryID"), field("boundaryName"), field("Continent"), F.right(F.get_json_object(body, "$.sourceDataUpdateDate"), F.lit(4)).alias("updated"),
        field("buildDate"), field("boundarySourceURL"), field("admUnitCount"))


@query("rejected_metadata", with_inputs("fx_unit fx_country", "SELECT DISTINCT u.iso, u.adm, 2 AS documents FROM fx_unit u JOIN fx_country c ON c.iso = u.iso WHERE c.k % 7 = 2"))
def rejected_metadata(spark, sf_dir):
    rejected = _published(spark, sf_dir)[2]
    return rejected.select(F.regexp_extract("folder", "folder_iso=([^/]+)", 1).alias("iso"), F.regexp_extract("folder", "folder_adm=([^/]+)", 1).alias("adm"), "documents")


@query("read_countries", """SELECT 'C' || c_custkey AS iso, c_name || ', "the"' AS name, CASE c_custkey % 3 WHEN 0 THEN 0 ELSE c_custkey % 3 END AS claimants, CASE WHEN c_custkey % 3 = 2 THEN 'B' || c_custkey END AS second FROM customer""")
def read_countries(spark, sf_dir):
    path = scratch_path(spark, "countries")
    code = F.col("c_custkey").cast("string")
    listed = F.when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("A"), code)).when(F.col("c_custkey") % 3 == 2, F.concat(F.lit("A"), code, F.lit("|B"), code)).otherwise("None")
    rows = table(spark, sf_dir, "customer").select(
        F.concat("c_name", F.lit(', "the"')).alias("Name"), F.lit("1").alias("LocationCode"), F.concat(F.lit("C"), code).alias("Alpha-3code"), listed.alias("Claimant(s)"),
        *[F.lit("x").alias(c) for c in ("Disputed", "UNSDG-subregion", "UNSDG-region", "Continent", "worldBankIncomeGroup")])
    rows.write.option("header", "true").csv(path)
    out = R.read_countries(spark, path)
    return out.select("iso", F.regexp_replace("Name", "\\\\", "").alias("name"), F.size("claimants").alias("claimants"), F.try_element_at("claimants", F.lit(2)).alias("second"))


@query("read_licenses", "SELECT lower(p_name) AS license, p_size % 2 = 0 AS gb_open, p_size % 3 = 0 AS gb_authoritative, p_size % 5 = 0 AS gb_humanitarian FROM part")
def read_licenses(spark, sf_dir):
    path = scratch_path(spark, "licenses")
    flag = lambda n: F.when(F.col("p_size") % n == 0, " Yes").otherwise(" No")
    rows = table(spark, sf_dir, "part").select(F.upper("p_name").alias("license_name"), F.lit(" t.pdf").alias("licenseText"), flag(2).alias("gbOpen"), flag(3).alias("gbAuthoritative"),
                                               flag(5).alias("gbHumanitarian"), *[F.lit(" No").alias(c) for c in "abcde"])
    rows.write.option("header", "true").option("ignoreLeadingWhiteSpace", "false").csv(path)
    return R.read_licenses(spark, path).select("license", "gb_open", "gb_authoritative", "gb_humanitarian")


@query("read_source_catalog", with_inputs("fx_source", "SELECT iso, adm, source, url FROM fx_source"))
def read_source_catalog(spark, sf_dir):
    path = scratch_path(spark, "sources")
    rows = derived(spark, sf_dir, "fx_source").select("iso", "adm", "source", "url")
    blank = rows.filter(F.col("iso").endswith("7")).select(*[F.lit("  ").alias(c) for c in rows.columns])
    rows.unionByName(blank).write.option("header", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    return R.read_source_catalog(spark, path)
