"""The global composite: base map, national layers, disputed areas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boundaryspark.operators import catalog as C
from boundaryspark.operators import overlay as O
from boundaryspark.operators import simplify as S
from boundaryspark.operators import topology as T
from boundaryspark.runtime import materialize, numbered, spread_join

FIRST_DISPUTED_CODE = 111  # fixed value: codes given to disputed areas without a country code


def disputed_ids(disputed: DataFrame, order: str, code: str = "iso_code") -> DataFrame:
    """shapeID DIS001, DIS002, ... in order; areas without a code get 111, 112, ..."""
    rows = numbered(disputed, order, "_no")
    uncoded = rows.withColumn("_uncoded", F.col(code).isNull())
    codes = numbered(uncoded, order, "_k", ["_uncoded"])
    width = F.greatest(F.lit(3), F.length(F.col("_no").cast("string")))
    return codes.select(
        *disputed.columns, F.concat(F.lit("DIS"), F.lpad(F.col("_no").cast("string"), width, F.lit("0"))).alias("shapeID"),
        F.coalesce(F.col(code), (F.col("_k") + (FIRST_DISPUTED_CODE - 1)).cast("string")).alias("shapeGroup"))


def unresolved_names(world: DataFrame, names: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Undisputed areas whose name gives no country code: none may be left before a build."""
    plain, _ = C.split_disputed(world, "country_na")
    renamed = plain.withColumn("country_na", C.rename_by_pattern("country_na"))
    coded = C.resolve_country_code(renamed, "country_na", names, aliases)
    return coded.filter(F.coalesce("iso_code", F.lit("")) == "").select("fid", "country_na")


def composite_layers(world: DataFrame, layers: DataFrame, names: DataFrame, aliases: dict[str, str] | None = None,
                     keep_share: float = 0.10, gap_km2: float = 10000.0) -> DataFrame:
    """The composite at the levels ADM0, ADM1 and ADM2, with disputed areas on top.

    `world`: fid, country_na, geom.  `layers`: iso, adm, shapeID, shapeName, geom of the national
    layers.  Result: level, shapeGroup, shapeType, shapeName, shapeID, geom.
    """
    unknown = [r["country_na"] for r in unresolved_names(world, names, aliases).limit(10).collect()]
    if unknown:
        raise ValueError(f"names without a country code: {unknown}")
    plain, marked = C.split_disputed(world, "country_na")
    coded = C.resolve_country_code(plain.withColumn("country_na", C.rename_by_pattern("country_na")), "country_na", names, aliases)
    base_names = C.dedupe_country_names(coded.select(F.col("iso_code").alias("iso"), F.col("country_na").alias("shapeName"), "fid"),
                                        "iso", "shapeName", "fid").groupBy("iso").agg(F.min_by("shapeName", "fid").alias("shapeName"))
    # each part is written by itself: a plan of all of them is made anew after every stage, and its copies fill the driver
    base_names = materialize(base_names, "base-names")
    base = materialize(T.dissolve(coded.select(F.col("iso_code").alias("iso"), "geom"), ["iso"]), "base")

    # each level of a country comes from the layer that exists nearest above it
    present = layers.select("iso", "adm").distinct().withColumn("source", F.col("adm"))
    wanted = C.level_fallback(present, "source").filter(F.col("source").isNotNull() & (F.col("adm") != "ADM0")).select(
        "iso", F.col("adm").alias("level"), F.col("source").alias("adm"))
    small = materialize(S.simplify_fraction(layers.select("adm", "iso", "shapeID", "geom"), ["iso", "shapeID"], ["adm"], keep_share), "small")
    pairs = small.select(F.concat_ws("/", "adm", "shapeID").alias("unit"), "iso")
    cut = materialize(O.clip(small.select(F.concat_ws("/", "adm", "shapeID").alias("unit"), "geom"), base, "unit", "iso", pairs), "clipped")
    # units of countries that the base map lacks stay as they are
    unmasked = small.join(base.select("iso"), "iso", "left_anti").select(F.concat_ws("/", "adm", "shapeID").alias("unit"), "iso", "geom")
    cut = cut.select("unit", "iso", "geom").unionByName(unmasked)
    named = layers.select(F.concat_ws("/", "adm", "shapeID").alias("unit"), "adm", "shapeID", "shapeName")
    national = materialize(spread_join(cut.join(named, "unit"), materialize(wanted, "wanted"), ["iso", "adm"]).select(
        "level", F.col("iso").alias("shapeGroup"), F.col("adm").alias("shapeType"), "shapeName", "shapeID", "geom"), "national")
    world_layer = base.join(base_names, "iso").select(
        F.lit("ADM0").alias("level"), F.col("iso").alias("shapeGroup"), F.lit("ADM0").alias("shapeType"), "shapeName",
        F.col("iso").alias("shapeID"), "geom")
    areas = materialize(disputed_ids(materialize(C.resolve_country_code(marked, "country_na", names, aliases), "marked"), "fid"), "disputed")
    disputed = areas.select(F.explode(F.array(F.lit("ADM0"), F.lit("ADM1"), F.lit("ADM2"))).alias("level"), "shapeGroup",
                            F.lit("DISP").alias("shapeType"), F.col("country_na").alias("shapeName"), "shapeID", "geom")
    merged = C.merge_layers(materialize(world_layer, "world-layer"), national, disputed)
    filled = T.fill_gaps(merged.select("level", "shapeID", "geom"), ["shapeID"], ["level"], gap_km2)
    return filled.join(merged.drop("geom"), ["level", "shapeID"])
