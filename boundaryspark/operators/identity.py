"""Content-hash identifiers and change detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boundaryspark.functions import geometry as G
from boundaryspark.functions import scalars as S

# Metadata fields that enter the fingerprint.
FINGERPRINT_FIELDS = [
    "admUnitCount", "boundaryCanonical", "boundaryID", "boundaryISO", "boundaryLicense", "boundarySource",
    "boundarySourceURL", "boundaryType", "boundaryYear", "licenseDetail", "licenseSource", "meanAreaSqKM"]

PACKAGE_MODULUS = 10 ** 8
SHAPE_MODULUS = 10 ** 14
#: Only for `detect_changes(mode="legacy")`, which compares so many first lines.
LEGACY_METADATA_LINES = 19
# Labels of the metadata lines that hold dates.
DATE_LABELS = ["Source Data Updated On", "File Built On"]


def package_fingerprint(content: Column | str) -> Column:
    """SHA-256 of the package bytes modulo 10^8, as text."""
    return S.hex_mod(F.sha2(S.col(content), 256), PACKAGE_MODULUS).cast("string")


def boundary_id(iso: Column | str, adm: Column | str, fingerprint: Column | str) -> Column:
    return F.concat_ws("-", S.col(iso), S.col(adm), S.col(fingerprint))


def shape_id(prefix: Column | str, geom: Column | str, modulus: int = SHAPE_MODULUS) -> Column:
    """Prefix, the letter B and the hash of the canonical geometry text."""
    return F.concat(S.col(prefix), F.lit("B"), S.hash_mod(G.geometry_text(geom), modulus).cast("string"))


def metadata_fingerprint(fields: dict[str, Column]) -> Column:
    """SHA-256 of the listed fields, normalised, as JSON with sorted keys; dates do not enter."""
    present = {k: fields[k] for k in sorted(fields) if k in FINGERPRINT_FIELDS}
    struct = F.struct(*[S.normalize_text(v.cast("string")).alias(k) for k, v in present.items()])
    return F.sha2(F.to_json(struct, {"ignoreNullFields": "false"}).cast("binary"), 256)


def static_link(iso: Column | str, adm: Column | str, fingerprint: Column, base_url: str, prefix: str) -> Column:
    """Link that changes with the metadata, so an old link keeps naming the old file."""
    return F.concat(F.lit(base_url.rstrip("/") + f"/{prefix}-"), S.col(iso), F.lit("-"), S.col(adm),
                    F.lit("-all-"), fingerprint, F.lit(".zip"))


def previous_build_join(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join with prefixes new_ and old_ on the compared columns."""
    left = new.select(*keys, F.lit(True).alias("_in_new"), *[
        F.col(c).alias(f"new_{c}") for c in new.columns if c not in keys])
    right = old.select(*keys, F.lit(True).alias("_in_old"), *[
        F.col(c).alias(f"old_{c}") for c in old.columns if c not in keys])
    joined = left.join(right, keys, "full_outer")
    return joined.withColumn("in_new", F.coalesce("_in_new", F.lit(False))) \
        .withColumn("in_old", F.coalesce("_in_old", F.lit(False))).drop("_in_new", "_in_old")


def geometry_fingerprint(features: DataFrame, keys: list[str], geom: str = "geom") -> DataFrame:
    """`geometry_fingerprint` of each layer: all its units with every coordinate and their other columns, in any order.

    Hashes of the units are counted and summed, so a layer of any size is one row of an aggregate.
    """
    others = sorted(c for c in features.columns if c not in keys and c != geom)
    unit = F.sha2(F.to_json(F.struct(F.col(geom).alias("geom"), *others), {"ignoreNullFields": "false"}).cast("binary"), 256)
    sums = [F.sum(F.conv(F.substring("_unit", at, 15), 16, 10).cast("decimal(38,0)")) for at in (1, 16, 31, 46)]
    text = F.concat_ws("-", F.count(F.lit(1)), *sums)
    return features.withColumn("_unit", unit).groupBy(*keys).agg(F.sha2(text.cast("binary"), 256).alias("geometry_fingerprint"))


def metadata_lines_fingerprint(lines: Column | str) -> Column:
    """SHA-256 of all metadata lines in their order, without the lines that hold dates; null for missing lines."""
    def dated(line: Column) -> Column:
        starts = [F.startswith(line, F.lit(f"{label}:")) for label in DATE_LABELS]
        return F.coalesce(starts[0] | starts[1], F.lit(False))
    return F.sha2(F.to_json(F.filter(S.col(lines), lambda line: ~dated(line))).cast("binary"), 256)


def detect_changes(new: DataFrame, old: DataFrame, keys: list[str], mode: str = "fingerprint") -> DataFrame:
    """Added, removed, geometry, metadata or unchanged, by `geometry_fingerprint` and all `metadata_lines` but dates.

    `mode="legacy"` is the historic rule: `geometry_size` and the first 19 lines decide, so edits of equal size and
    later lines are not seen.  A side that lacks a value (an unreadable earlier build) counts as changed.
    """
    if mode not in ("fingerprint", "legacy"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "legacy":
        geometry, metadata = F.col("geometry_size"), F.slice("metadata_lines", 1, LEGACY_METADATA_LINES)
    else:
        geometry, metadata = F.col("geometry_fingerprint"), metadata_lines_fingerprint("metadata_lines")
    sides = [side.select(*keys, geometry.alias("geometry"), metadata.alias("metadata")) for side in (new, old)]
    pairs = previous_build_join(*sides, keys)
    kind = (F.when(~F.col("in_old"), "added").when(~F.col("in_new"), "removed")
            .when(F.col("new_geometry").isNull() | F.col("old_geometry").isNull()
                  | F.col("new_metadata").isNull() | F.col("old_metadata").isNull(), "error")
            .when(F.col("new_geometry") != F.col("old_geometry"), "geometry")
            .when(F.col("new_metadata") != F.col("old_metadata"), "metadata").otherwise("unchanged"))
    return pairs.select(*keys, kind.alias("change"),
                        (~kind.isin("unchanged", "removed")).alias("rebuild"))


def upsert_catalog(catalog: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `updates` replace rows with the same key; the latest update wins if keys repeat.

    Both sides are tagged and reduced with one aggregate, so one shuffle does the whole upsert.
    """
    columns = catalog.columns
    others = [c for c in columns if c not in keys]
    tagged = catalog.select(*columns, F.lit(0).alias("_new")).unionByName(
        updates.select(*columns, F.lit(1).alias("_new")))
    chosen = tagged.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct("_new", *others)).alias("_r"))
    return chosen.select(*keys, "_r.*").select(*columns)
