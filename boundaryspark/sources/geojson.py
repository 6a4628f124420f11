"""GeoJSON and TopoJSON layers as feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boundaryspark.functions import scalars as S
from boundaryspark.operators.edges import assemble
from boundaryspark.runtime import materialize, running_sums
from boundaryspark.sources.json_ranges import read_elements

FEATURES = "array<struct<type:string,properties:string,geometry:struct<type:string,coordinates:string>>>"
POINTS = "array<array<array<array<double>>>>"


def parse_collections(df: DataFrame, text: str = "value") -> DataFrame:
    """Features of GeoJSON texts: layer, feature_no, props (map) and multipolygon geometry.

    Features without polygon geometry are left out; Polygon and MultiPolygon become one type.
    """
    others = [c for c in df.columns if c != text]
    features = df.select(*others, F.posexplode(F.from_json(
        F.get_json_object(text, "$.features"), FEATURES)).alias("feature_no", "_f"))
    return _feature_columns(features, [*others, "feature_no"])


def _feature_columns(features: DataFrame, others: list[str]) -> DataFrame:
    kind = F.col("_f.geometry.type")
    coords = F.col("_f.geometry.coordinates")
    wrapped = F.when(kind == "Polygon", F.concat(F.lit("["), coords, F.lit("]"))).when(kind == "MultiPolygon", coords)
    nested = features.withColumn("_c", F.from_json(wrapped, POINTS)).filter(F.col("_c").isNotNull())
    geom = F.transform("_c", lambda p: F.transform(p, lambda r: F.transform(
        r, lambda v: F.struct(v[0].alias("x"), v[1].alias("y")))))
    return nested.select(*others, F.from_json("_f.properties", "map<string,string>").alias("props"), geom.alias("geom"))


def read_feature_collections(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per feature; `layer` is the file.

    Files of any layout are read by byte ranges, so a large file is shared out over many tasks; a feature is one row.
    """
    elements = read_elements(spark, paths, [("features", "")])
    features = elements.select("layer", F.col("element_no").cast("int").alias("feature_no"), F.from_json(
        F.col("element").cast("string"), FEATURES.removeprefix("array<").removesuffix(">")).alias("_f"))
    return _feature_columns(features, ["layer", "feature_no"])


def read_feature_lines(spark: SparkSession, path: str) -> DataFrame:
    """Features of collections written one feature per line, as the writer here does.

    Lines are read on their own, so one large collection is shared out over many tasks; partition
    folders become columns.
    """
    lines = spark.read.option("basePath", path).text(path)
    others = [c for c in lines.columns if c != "value"]
    bare = F.regexp_replace("value", "^,", "")
    features = lines.filter(bare.startswith('{"type":"Feature",')).select(
        *others, F.from_json(bare, FEATURES.removeprefix("array<").removesuffix(">")).alias("_f"))
    return _feature_columns(features, others)


def features_of_members(members: DataFrame) -> DataFrame:
    """Features of the GeoJSON member of each package."""
    layers = members.filter(F.col("member").endswith(".geojson")).select("package_id", S.decode_text("content").alias("value"))
    return parse_collections(layers)


# --- TopoJSON ------------------------------------------------------------------------------------

_TOPO_GEOMETRY = "struct<type:string,arcs:string,properties:string>"
TOPOLOGY = ("struct<transform:struct<scale:array<double>,translate:array<double>>,arcs:array<array<array<double>>>,"
            f"objects:map<string,struct<geometries:array<{_TOPO_GEOMETRY}>>>>")


def read_topologies(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per file, for small files."""
    texts = spark.read.text(paths, wholetext=True).withColumn("layer", F.col("_metadata.file_path"))
    return texts.select("layer", F.from_json("value", TOPOLOGY).alias("t"))


def read_topology_tables(spark: SparkSession, paths: str | list[str], name: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The tables of `topology_tables` for the object `name` (the first with geometries if None) of files read by byte ranges.

    Arcs are rows, so no task holds a file.  Ranges end at `]]`, as between two arcs without white space.
    """
    found = read_elements(spark, paths, [("arcs", ""), ("objects", "*", "geometries", ""), ("transform",)], "]]")
    value = F.col("element").cast("string")
    change = found.filter("pattern = 2").select("layer", F.from_json(value, "struct<scale:array<double>,translate:array<double>>").alias("transform"))
    arcs = found.filter("pattern = 0").select("layer", F.col("element_no").cast("int").alias("arc_id"), F.from_json(value, "array<array<double>>").alias("_a"))
    rows = found.filter("pattern = 1").select("layer", "name", "element_no", F.from_json(value, _TOPO_GEOMETRY).alias("_g"))
    firsts = rows.groupBy("layer").agg(F.min_by("name", "element_no").alias("_name")) if name is None else \
        rows.select("layer", F.lit(name).alias("_name")).distinct()
    wanted = rows.join(firsts, (rows["layer"] == firsts["layer"]) & rows["name"].eqNullSafe(firsts["_name"])).drop(firsts["layer"])
    begins = wanted.groupBy("layer").agg(F.min("element_no").alias("_least"))
    geometries = wanted.join(begins, "layer").select("layer", (F.col("element_no") - F.col("_least")).cast("int").alias("feature_no"), "_g")
    return _topology_parts(arcs.join(F.broadcast(change), "layer", "left"), geometries)


def topology_tables(topologies: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """arcs(layer, arc_id, seq, dx, dy, scale, translate), ring_arcs(...) and feature properties."""
    arcs = topologies.select("layer", F.col("t.transform").alias("transform"), F.posexplode("t.arcs").alias("arc_id", "_a"))
    first = F.element_at(F.map_values("t.objects"), 1)["geometries"]
    return _topology_parts(arcs, topologies.select("layer", F.posexplode(first).alias("feature_no", "_g")))


def _topology_parts(arcs: DataFrame, geometries: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    scale = F.coalesce(F.col("transform.scale"), F.array(F.lit(1.0), F.lit(1.0)))
    shift = F.coalesce(F.col("transform.translate"), F.array(F.lit(0.0), F.lit(0.0)))
    arcs = arcs.select("layer", "arc_id", "_a", scale.alias("_s"), shift.alias("_t"), F.col("transform").isNotNull().alias("quantised"))
    points = arcs.select("layer", "arc_id", "quantised", F.col("_s")[0].alias("sx"), F.col("_s")[1].alias("sy"),
                         F.col("_t")[0].alias("tx"), F.col("_t")[1].alias("ty"), F.posexplode("_a").alias("seq", "_p")) \
        .select("layer", "arc_id", "seq", F.col("_p")[0].alias("dx"), F.col("_p")[1].alias("dy"), "sx", "sy", "tx", "ty", "quantised")
    refs = F.when(F.col("_g.type") == "Polygon", F.concat(F.lit("["), F.col("_g.arcs"), F.lit("]"))) \
        .when(F.col("_g.type") == "MultiPolygon", F.col("_g.arcs"))
    polygons = geometries.select("layer", "feature_no", F.posexplode(F.from_json(refs, "array<array<array<int>>>")).alias("poly", "_p"))
    rings = polygons.select("layer", "feature_no", "poly", F.posexplode("_p").alias("ring", "_r"))
    ring_arcs = rings.select("layer", "feature_no", "poly", "ring", F.posexplode("_r").alias("pos", "_i")).select(
        "layer", "feature_no", "poly", "ring", "pos", F.when(F.col("_i") < 0, -1 - F.col("_i")).otherwise(F.col("_i")).alias("arc_id"),
        (F.col("_i") < 0).alias("reversed"))
    props = geometries.select("layer", "feature_no", F.from_json("_g.properties", "map<string,string>").alias("props"))
    return points, ring_arcs, props


def delta_decode(arcs: DataFrame, arc: list[str]) -> DataFrame:
    """Running sums of dx and dy, scaled and moved where the topology is quantised."""
    summed = running_sums(arcs, arc, "seq", {"_x": F.col("dx"), "_y": F.col("dy")})
    pick = lambda total, raw, s, t: F.when(F.col("quantised"), F.col(total) * F.col(s) + F.col(t)).otherwise(F.col(raw))
    return summed.select(*arc, "seq", pick("_x", "dx", "sx", "tx").alias("x"), pick("_y", "dy", "sy", "ty").alias("y"))


def splice_rings(points: DataFrame, ring_arcs: DataFrame, ids: list[str]) -> DataFrame:
    """Vertices of rings: arcs in order, reversed where marked, the joint point of two arcs once."""
    sizes = points.groupBy("layer", "arc_id").agg(F.count(F.lit(1)).alias("_n"))
    placed = ring_arcs.join(sizes, ["layer", "arc_id"])
    ring = ["layer", *ids, "poly", "ring"]
    # every arc but the last gives all points except its final one
    offsets = running_sums(placed, ring, "pos", {"_end": F.col("_n") - 1})
    lasts = placed.groupBy(*ring).agg(F.max("pos").alias("_last"))
    ready = offsets.join(lasts, ring)
    joined = ready.join(points, ["layer", "arc_id"])
    place = F.when(F.col("reversed"), F.col("_n") - 1 - F.col("seq")).otherwise(F.col("seq"))
    rows = joined.withColumn("_at", place).filter((F.col("_at") < F.col("_n") - 1) | (F.col("pos") == F.col("_last")))
    return rows.select(*ring, (F.col("_end") - (F.col("_n") - 1) + F.col("_at")).alias("seq"), "x", "y")


def topojson_to_features(topologies: DataFrame) -> DataFrame:
    return _topology_features(*topology_tables(topologies))


def read_topojson_features(spark: SparkSession, paths: str | list[str], name: str | None = None) -> DataFrame:
    """Features of one object of TopoJSON files, which are read by byte ranges."""
    return _topology_features(*[materialize(t, "topology") for t in read_topology_tables(spark, paths, name)])


def _topology_features(arcs: DataFrame, ring_arcs: DataFrame, props: DataFrame) -> DataFrame:
    vertices = splice_rings(delta_decode(arcs, ["layer", "arc_id"]), ring_arcs, ["feature_no"])
    return assemble(vertices, ["layer", "feature_no"]).join(props, ["layer", "feature_no"])


def geojson_geometry(geom: Column | str) -> Column:
    """MultiPolygon coordinates as JSON text."""
    return F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.transform(S.col(geom), lambda p: F.transform(
        p, lambda r: F.transform(r, lambda v: F.array(v["x"], v["y"])))).alias("coordinates")))
