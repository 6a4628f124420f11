"""The build and the publish job: the operators chained over all packages or all layers at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boundaryspark.functions import geometry as G
from boundaryspark.functions import scalars as S
from boundaryspark.operators import catalog as C
from boundaryspark.operators import identity as I
from boundaryspark.operators import layers as L
from boundaryspark.operators import overlay as O
from boundaryspark.operators import topology as T
from boundaryspark.runtime import materialize
from boundaryspark.sources import geojson as J
from boundaryspark.sources import metadata as M
from boundaryspark.sources import packages as P
from boundaryspark.sources import sinks as K
from boundaryspark.streaming import jobs as ST

#: Members that a build unpacks: metadata, layer and projection.
BUILD_MEMBERS = r"meta\.txt|(?!.*MACOS).*\.(geojson|prj)"
UNIT = ["package_id", "feature_no"]


def geometry_checks(features: DataFrame, projections: DataFrame) -> DataFrame:
    """Verdict on the geometry of each package: bounds, validity or repair, projection.

    Only invalid features are rebuilt, and one of which nothing is left can't be repaired.
    """
    report = materialize(T.validity_report(features, UNIT).select(*UNIT, "valid"), "build-validity")
    bad = features.join(report.filter(~F.col("valid")), UNIT, "left_semi")
    if bad.isEmpty():
        mended = report.limit(0).select(*UNIT)
    else:
        mended = materialize(O.repair(bad.select(*UNIT, "geom"), UNIT).filter(G.planar_area("geom") > 0).select(*UNIT), "build-mended")
    flagged = L.filter_by_bounds(features, flag_only=True).select(*UNIT, "in_bounds").join(report, UNIT).join(
        mended.withColumn("_mended", F.lit(True)), UNIT, "left").join(projections, "package_id", "left")
    checks = flagged.select("package_id", F.col("feature_no").alias("feature_id"), "in_bounds", "valid",
                            F.coalesce("_mended", F.lit(False)).alias("repairable"), F.coalesce("projection_ok", F.lit(False)).alias("projection_ok"))
    return L.layer_geometry_verdict(checks, ["package_id"])


def build_layers(packages: DataFrame, countries: DataFrame, licenses: DataFrame, previous: DataFrame | None = None,
                 current_year: int | None = None) -> tuple[DataFrame, DataFrame]:
    """One row per package (package_id, iso, adm, path, content), failing ones with their reasons, and the units of those that pass.

    Rows carry the intake verdict, the geometry verdict, the statistics and identifier of the layer and, against the `previous` rows of this job, what
    changed.  Units: package_id, feature_no, props, geom, cleaned.
    """
    packages = packages.select("package_id", "iso", "adm", "content")
    members = materialize(P.package_members(packages, BUILD_MEMBERS), "build-members")
    intake = ST.intake_of_members(packages.select("package_id"), members, countries, licenses, current_year)
    units = materialize(J.features_of_members(members).withColumn("geom", G.clean_rings("geom")), "build-units")
    geometry = geometry_checks(units.select(*UNIT, "geom"), P.check_projection(members)).select(
        "package_id", "bounds_ok", "valid_ok", "projection_ok", "invalid_features", F.col("message").alias("geometry_message"), F.col("passed").alias("geometry_passed"))
    statistics = L.layer_statistics(units, ["package_id"])
    prints = I.geometry_fingerprint(units.select("package_id", "props", "geom"), ["package_id"])
    lines = P.meta_texts(members).select("package_id", F.split("meta_text", "\\r\\n|\\n|\\r").alias("metadata_lines"))
    named = packages.select("package_id", "iso", "adm", I.boundary_id("iso", "adm", I.package_fingerprint("content")).alias("boundaryID"))
    rows = named.join(intake.withColumnsRenamed({"message": "metadata_message", "passed": "metadata_passed"}), "package_id", "left")
    for part in (geometry, statistics, prints, lines):
        rows = rows.join(part, "package_id", "left")
    rows = rows.withColumn("passed", F.col("metadata_passed") & F.coalesce("geometry_passed", F.lit(False)))
    rows = materialize(rows, "build-rows")
    if previous is not None:
        change = I.detect_changes(rows.filter("passed"), previous, ["iso", "adm"]).filter(F.col("change") != "removed")
        rows = rows.join(change, ["iso", "adm"], "left")
    return rows, units.join(rows.filter("passed").select("package_id"), "package_id", "left_semi")


def publish(spark: SparkSession, root: str, out: str, products: list[str], countries: DataFrame, base_url: str, prefix: str,
            pattern: str = "*metaData.json") -> tuple[DataFrame, DataFrame]:
    """Metadata documents below `root` as published records, written to `<out>/csv` and `<out>/api`; and the rejected folders.

    `countries` has the published country columns by `boundaryISO`.  One scan of the documents serves the CSV and all grains of the index.
    """
    documents, rejected = M.read_layer_metadata(spark, root, products, pattern)
    known = C.enrich_with_country(documents, countries, "boundaryISO")
    clean = {c: S.clean_free_text(c) for c in ("boundarySource", "licenseDetail")}
    known = known.withColumns({**clean, "sourceDataUpdateDate": S.parse_mixed_date("sourceDataUpdateDate"), "buildDate": S.parse_mixed_date("buildDate")})
    fingerprint = I.metadata_fingerprint({c: F.col(c) for c in known.columns})
    linked = known.withColumn("staticDownloadLink", I.static_link("boundaryISO", "boundaryType", fingerprint, base_url, prefix))
    records = materialize(C.api_record(linked, base_url, prefix).withColumn("product", F.lit(products[0])) if len(products) == 1 else
                          C.api_record(linked, base_url, prefix).join(linked.select("boundaryID", "product"), "boundaryID"), "records")
    K.write_catalog_csv(records, f"{out}/csv")
    K.write_api_index(records.drop("product"), f"{out}/api")
    return records, rejected
