"""Writers: catalogue CSV, JSON index, feature collections, check reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boundaryspark.functions import scalars as S
from boundaryspark.operators.catalog import CATALOG_COLUMNS, catalog_rollup
from boundaryspark.sources.geojson import geojson_geometry


def framed_lines(rows: DataFrame, groups: list[str], order: str, body: Column, head: str | Column, foot: str) -> DataFrame:
    """Lines of one JSON document per group: head, bodies with commas between, foot.

    Only the first row of a group differs (it has no comma before it); it is found by aggregate and
    joined on group and order, so no group is gathered.  `order` is unique within its group.
    """
    first = rows.groupBy(*groups).agg(F.min(order).alias(order)).withColumn("_first", F.lit(True))
    marked = rows.withColumn("_body", body).join(first, [*groups, order], "left")
    opening = F.when(F.col("_first"), F.lit("")).otherwise(F.lit(","))
    lines = marked.select(*groups, F.lit(1).alias("_part"), F.col(order).alias("_sort"), F.concat(opening, F.col("_body")).alias("value"))
    frame = first.select(*groups, F.col(order).alias("_sort"), F.inline(F.array(
        F.struct(F.lit(0).alias("_part"), (head if isinstance(head, Column) else F.lit(head)).alias("value")),
        F.struct(F.lit(2).alias("_part"), F.lit(foot).alias("value")))))
    return lines.select(*groups, "_part", "_sort", "value").unionByName(frame.select(*groups, "_part", "_sort", "value"))


def write_documents(lines: DataFrame, groups: list[str], path: str) -> None:
    """Text parts per group; read in file name order they are the document.

    Rows are ranged over (group, part, order), so a large group is many files and no task holds it all.
    """
    keys = [*groups, "_part", "_sort"]
    lines.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*groups, "value") \
        .write.partitionBy(*groups).mode("overwrite").text(path)


def write_catalog_csv(df: DataFrame, path: str) -> None:
    """Fixed columns, every value quoted, one folder per product."""
    df.select("product", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in CATALOG_COLUMNS]) \
        .write.partitionBy("product").mode("overwrite").option("header", "true").option("quoteAll", "true") \
        .option("escape", '"').option("ignoreLeadingWhiteSpace", "false") \
        .option("ignoreTrailingWhiteSpace", "false").csv(path)


def write_api_index(records: DataFrame, path: str) -> None:
    """JSON lists at ALL/ALL, ALL/level and country/ALL, a single object at country/level.

    `records` are published records (`boundaryISO`, `boundaryType`, `boundaryID`, ...), one per
    country and level.
    """
    body = records.select(F.col("boundaryISO").alias("iso"), F.col("boundaryType").alias("adm"),
                          F.col("boundaryID").alias("id"), F.to_json(F.struct("*")).alias("body"))
    spread = catalog_rollup(body).select(F.col("grain_iso").alias("iso_dir"), F.col("grain_adm").alias("adm_dir"), "id", "body")
    single = (F.col("iso_dir") != "ALL") & (F.col("adm_dir") != "ALL")
    lists = framed_lines(spread.filter(~single), ["iso_dir", "adm_dir"], "id", F.col("body"), "[", "]")
    objects = spread.filter(single).select("iso_dir", "adm_dir", F.lit(1).alias("_part"), F.col("id").alias("_sort"),
                                           F.col("body").alias("value"))
    write_documents(lists.unionByName(objects), ["iso_dir", "adm_dir"], path)


def write_feature_collections(features: DataFrame, path: str, layer: str = "layer", order: str = "shapeID") -> None:
    """One GeoJSON FeatureCollection per layer; attribute values are written as text."""
    names = [f.name for f in features.schema.fields if f.name not in ("geom", layer)]

    def text(f):
        return S.decode_text(f.name) if f.dataType.typeName() == "binary" else F.col(f.name).cast("string")

    props = F.to_json(F.struct(*[text(f).alias(f.name) for f in features.schema.fields if f.name in names]))
    body = F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), geojson_geometry("geom"), F.lit("}"))
    head = F.concat(F.lit('{"type":"FeatureCollection","name":'), F.to_json(F.struct(F.col(layer).alias("n"))).substr(6, 1 << 30))
    head = F.concat(F.regexp_replace(head, "}$", ""), F.lit(
        ',"crs":{"type":"name","properties":{"name":"urn:ogc:def:crs:OGC:1.3:CRS84"}},"features":['))
    write_documents(framed_lines(features, [layer], order, body, head, "]}"), [layer], path)


def write_check_report(df: DataFrame, path: str) -> None:
    """One row per layer with its META_* and GEOM_* flags."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def check_report(checks: DataFrame, geometry: DataFrame, keys: list[str]) -> DataFrame:
    """Flags of the report from metadata checks and geometry verdicts."""
    ok = lambda c: (F.col(c) != "NONE") & (F.col(c) != "") & ~F.contains(F.col(c), F.lit("ERROR"))
    meta = checks.select(
        *keys, ok("year").alias("META_yearValid"), ok("iso").alias("META_isoValid"), ok("bType").alias("META_boundaryTypeValid"),
        ok("source").alias("META_sourceExists"), ok("releaseType").alias("META_releaseTypeValid"), ok("license").alias("META_licenseValid"),
        ok("licenseSource").alias("META_licenseSourceExists"), ok("dataSource").alias("META_dataSourceExists"),
        ok("canonical").alias("META_canonicalNameInMeta"), (F.col("licenseImage") == "Image Available").alias("META_licenseImageInZip"))
    required = ["META_yearValid", "META_isoValid", "META_boundaryTypeValid", "META_sourceExists", "META_releaseTypeValid",
                "META_licenseValid", "META_licenseSourceExists", "META_dataSourceExists"]
    all_meta = F.lit(True)
    for c in required:
        all_meta = all_meta & F.col(c)
    geom = geometry.select(*keys, F.col("valid_ok").alias("GEOM_Topology"), F.col("projection_ok").alias("GEOM_Projection"),
                           F.col("passed").alias("GEOM_requiredChecksPassing"))
    joined = meta.withColumn("META_requiredChecksPassing", all_meta).join(geom, keys, "left")
    passed = F.col("META_requiredChecksPassing") & F.coalesce("GEOM_requiredChecksPassing", F.lit(False))
    return joined.withColumn("status", F.when(passed, "PASS").otherwise("FAIL"))
