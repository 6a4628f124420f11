"""Standardising layers and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boundaryspark.functions import geometry as G
from boundaryspark.functions import scalars as S
from boundaryspark.runtime import numbered, spread_join

# Attribute names accepted as unit name and as unit code.
NAME_CANDIDATES = ["Name", "name", "NAME", "shapeName", "shapename", "SHAPENAME", "MAX_Name"]
ISO_CANDIDATES = ["ISO", "ISO_code", "ISO_Code", "iso", "shapeISO", "shapeiso", "shape_iso", "MAX_ISO_Co"]

# Left-over attributes removed from composites.
COMPOSITE_DROP_FIELDS = [
    "FID", "PROV_34_NA", "DIST_34_NA", "OBJECTID", "Shape_Leng", "Shape_Area", "shapeISO", "id", "COUNTRY_NA",
    "Shape_Le_1", "ADM1_NAME", "admin1Name", "Type", "ISO Code", "LEVEL", "LEVEL_1", "Shape_Length", "ISO2",
    "LEVEL2", "SHAPE_Leng", "SHAPE_Area", "DISTRICT", "admin2Name", "OBJECTID_1", "SOVEREIGNT", "Level",
    "MAX_Name", "MAX_ISO_Co", "MAX_Level", "ISO_CODE", "ISO_CODE2"]


def unit_count(features: DataFrame, layer: list[str]) -> DataFrame:
    return features.groupBy(*layer).agg(F.count(F.lit(1)).alias("unit_count"))


def vertex_stats(features: DataFrame, layer: list[str]) -> DataFrame:
    """Vertices of shells per feature: layer mean (half-even, no decimals), least and most."""
    per_feature = features.select(*layer, G.shell_vertices("geom").alias("_n"))
    return per_feature.groupBy(*layer).agg(
        S.round_half_even(F.avg("_n")).alias("mean_vertices"),
        F.min("_n").alias("min_vertices"), F.max("_n").alias("max_vertices"))


def perimeter_stats(features: DataFrame, layer: list[str]) -> DataFrame:
    """Lengths of all rings in kilometres on the equidistant projection."""
    per_feature = features.select(*layer, (G.planar_perimeter(G.project_equidistant("geom")) / 1000).alias("_v"))
    return per_feature.groupBy(*layer).agg(
        F.avg("_v").alias("mean_perimeter_km"), F.min("_v").alias("min_perimeter_km"),
        F.max("_v").alias("max_perimeter_km"))


def area_stats(features: DataFrame, layer: list[str]) -> DataFrame:
    """Areas in square kilometres on the equal-area projection."""
    per_feature = features.select(*layer, (G.planar_area(G.project_equal_area("geom")) / 1e6).alias("_v"))
    return per_feature.groupBy(*layer).agg(
        F.avg("_v").alias("mean_area_km2"), F.min("_v").alias("min_area_km2"), F.max("_v").alias("max_area_km2"))


def layer_statistics(features: DataFrame, layer: list[str]) -> DataFrame:
    """All layer figures in one pass and one shuffle of one row per feature at most."""
    per_feature = features.select(
        *layer, G.shell_vertices("geom").alias("_n"),
        (G.planar_perimeter(G.project_equidistant("geom")) / 1000).alias("_p"),
        (G.planar_area(G.project_equal_area("geom")) / 1e6).alias("_a"))
    return per_feature.groupBy(*layer).agg(
        F.count(F.lit(1)).alias("unit_count"),
        S.round_half_even(F.avg("_n")).alias("mean_vertices"),
        F.min("_n").alias("min_vertices"), F.max("_n").alias("max_vertices"),
        F.avg("_p").alias("mean_perimeter_km"), F.min("_p").alias("min_perimeter_km"),
        F.max("_p").alias("max_perimeter_km"), F.avg("_a").alias("mean_area_km2"),
        F.min("_a").alias("min_area_km2"), F.max("_a").alias("max_area_km2"))


def source_stats(features: DataFrame, layer: list[str]) -> DataFrame:
    """Totals of a source on the sphere; vertices of all rings."""
    per_feature = features.select(
        *layer, (G.spherical_area("geom") / 1e6).alias("_a"),
        (G.spherical_perimeter("geom") / 1000).alias("_l"), G.all_vertices("geom").alias("_n"))
    totals = per_feature.groupBy(*layer).agg(
        F.count(F.lit(1)).alias("unit_count"), F.sum("_a").alias("area_km2"),
        F.sum("_l").alias("length_km"), F.sum("_n").alias("vertices"))
    return totals.withColumn("metres_per_vertex", F.col("length_km") / F.col("vertices") * 1000) \
        .withColumn("vertices_per_km", F.col("vertices") / F.col("length_km"))


def value_fill_stats(features: DataFrame, layer: list[str], value: Column | str, order: str,
                     null_makes_zero: bool = True) -> DataFrame:
    """Filled values and the first one; one null makes the count 0 unless switched off."""
    v = S.col(value)
    filled = F.count(v)
    if null_makes_zero:
        filled = F.when(F.max(v.isNull()), F.lit(0).cast("long")).otherwise(filled)
    return features.groupBy(*layer).agg(filled.alias("filled"), F.min_by(v, F.col(order)).alias("example"))


def latest_timestamp(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(ts).alias("latest"))


def column_uniqueness(features: DataFrame, layer: list[str], props: str = "props",
                      approximate: bool = False) -> DataFrame:
    """Distinct values per row for every attribute; a row without the attribute counts as one null value."""
    long = features.select(*layer, F.explode(props).alias("attribute", "_value"))
    distinct = (F.approx_count_distinct("_value", 0.01) if approximate else F.count_distinct("_value"))
    per_attribute = long.groupBy(*layer, "attribute").agg(
        distinct.alias("_d"), F.count(F.lit(1)).alias("_rows"), F.max(F.col("_value").isNull()).alias("_null"))
    totals = features.groupBy(*layer).agg(F.count(F.lit(1)).alias("_total"))
    joined = spread_join(per_attribute, totals, layer)
    with_null = F.col("_d") + (F.col("_null") | (F.col("_rows") < F.col("_total"))).cast("long")
    return joined.select(*layer, "attribute", with_null.alias("distinct_values"),
                         (with_null / F.col("_total")).alias("uniqueness"))


def rank_name_columns(uniqueness: DataFrame, layer: list[str]) -> DataFrame:
    """The attribute taken as name: "name" or "adm" in it first, then the most unique, then by name."""
    lower = F.lower("attribute")
    rank = F.struct((~(lower.contains("name") | lower.contains("adm"))).alias("p"),
                    (-F.col("uniqueness")).alias("u"), F.col("attribute").alias("a"))
    return uniqueness.groupBy(*layer).agg(F.min(rank).alias("_r")).select(*layer, F.col("_r.a").alias("name_column"))


def detect_column(features: DataFrame, layer: list[str], candidates: list[str], props: str = "props") -> DataFrame:
    """Per layer the one attribute among the candidates; null where none or several fit."""
    known = F.array(*[F.lit(c) for c in candidates])
    found = features.select(*layer, F.explode_outer(F.array_intersect(F.map_keys(props), known)).alias("_c"))
    # at most one bit per candidate is kept per layer, whatever the number of features
    flags = [F.max(F.coalesce(F.col("_c") == c, F.lit(False))).alias(f"_{i}") for i, c in enumerate(candidates)]
    per_layer = found.groupBy(*layer).agg(*flags)
    hits = F.array_compact(F.array(*[F.when(F.col(f"_{i}"), F.lit(c)) for i, c in enumerate(candidates)]))
    return per_layer.select(*layer, F.when(F.size(hits) == 1, F.element_at(hits, 1)).alias("column"))


def standardize_features(features: DataFrame, layer: list[str], meta: DataFrame, props: str = "props") -> DataFrame:
    """Six fixed columns; the unit name column is mandatory, the unit code may be blank.

    `meta` holds per layer the country `iso`, the level `adm` and the package `fingerprint`.
    """
    from boundaryspark.operators.identity import shape_id
    names = detect_column(features, layer, NAME_CANDIDATES, props).withColumnRenamed("column", "_name")
    codes = detect_column(features, layer, ISO_CANDIDATES, props).withColumnRenamed("column", "_code")
    per_layer = meta.select(*layer, F.col("iso").alias("_iso"), F.col("adm").alias("_adm"),
                            F.col("fingerprint").alias("_print")).join(names, layer).join(codes, layer)
    joined = spread_join(features, per_layer.filter(F.col("_name").isNotNull()), layer)
    return joined.select(
        *layer, shape_id(F.col("_print"), F.col("geom")).alias("shapeID"),
        F.coalesce(F.try_element_at(F.col(props), F.col("_name")), F.lit("")).alias("shapeName"),
        F.coalesce(F.try_element_at(F.col(props), F.col("_code")), F.lit("")).alias("shapeISO"),
        F.col("_iso").alias("shapeGroup"), F.col("_adm").alias("shapeType"), "geom")


def drop_source_fields(df: DataFrame, names: list[str] | None = None, props: str | None = None) -> DataFrame:
    """Remove left-over attributes, as columns or inside the attribute map."""
    names = names or COMPOSITE_DROP_FIELDS
    out = df.drop(*[c for c in df.columns if c in names])
    if props:
        out = out.withColumn(props, F.map_filter(props, lambda k, v: ~k.isin(names)))
    return out


def with_bounds(features: DataFrame) -> DataFrame:
    return features.withColumns(G.bounds("geom"))


def filter_by_bounds(features: DataFrame, flag_only: bool = False) -> DataFrame:
    flagged = with_bounds(features).withColumn("in_bounds", G.within_earth("xmin", "ymin", "xmax", "ymax"))
    return flagged if flag_only else flagged.filter("in_bounds")


def layer_extent(features: DataFrame, layer: list[str]) -> DataFrame:
    return with_bounds(features).groupBy(*layer).agg(
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


def sequence_features(features: DataFrame, order: str, layer: list[str]) -> DataFrame:
    """1..n per layer over features that have a geometry."""
    return numbered(features.filter(F.col("geom").isNotNull()), order, "feature_no", layer)


def layer_geometry_verdict(checks: DataFrame, layer: list[str]) -> DataFrame:
    """Worst outcome per layer from per-feature flags in_bounds, valid, repairable, projection_ok.

    Bounds and projection must hold everywhere; an invalid feature counts only if no repair helps.
    """
    agg = checks.groupBy(*layer).agg(
        F.bool_and("in_bounds").alias("bounds_ok"),
        F.bool_and(F.col("valid") | F.col("repairable")).alias("valid_ok"),
        F.bool_and("projection_ok").alias("projection_ok"),
        F.count_if(~F.col("valid")).alias("invalid_features"),
        F.min(F.when(~F.col("valid"), F.col("feature_id"))).alias("first_invalid"))
    message = F.concat_ws(
        " | ",
        F.when(~F.col("bounds_ok"), "at least one geometry extends past the bounds of the earth"),
        F.when(~F.col("valid_ok"), "at least one geometry is invalid and cannot be repaired"),
        F.when(~F.col("projection_ok"), "the projection must be EPSG 4326"))
    return agg.withColumn("message", message).withColumn(
        "passed", F.col("bounds_ok") & F.col("valid_ok") & F.col("projection_ok"))


def first_per_key(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row per key, the least by `order`: an aggregate, so hot keys combine before the shuffle."""
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*others), order).alias("_r")).select(*keys, "_r.*")


