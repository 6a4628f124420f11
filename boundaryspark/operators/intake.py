"""Checks of submitted packages and their metadata as set-based jobs; failing rows stay, with reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boundaryspark.functions import scalars as S
from boundaryspark.runtime import broadcast_if_small

# Accepted levels, release types, licence short form and its full name.
LEVELS = ["ADM0", "ADM1", "ADM2", "ADM3", "ADM4", "ADM5"]
RELEASE_TYPES = ["gbauthoritative", "gbhumanitarian", "gbopen", "un_salb", "un_ocha"]
LICENSE_ALIASES = {
    "Creative Commons Attribution for Intergovernmental Organisations":
        "Creative Commons Attribution 3.0 Intergovernmental Organisations (CC BY 3.0 IGO)",
}
REQUIRED_FIELDS = ["year", "bType", "iso", "source", "releaseType", "license", "licenseSource", "dataSource",
                   "licenseImage"]
OPTIONAL_FIELDS = ["canonical", "licenseNotes", "otherNotes"]
# Keys of meta.txt and the columns they fill.
META_COLUMNS = {
    "ISO-3166-1 (Alpha-3)": "boundaryISO", "Boundary Representative of Year": "boundaryYear",
    "Boundary Type": "boundaryType", "Source 1": "boundarySource-1", "Source 2": "boundarySource-2",
    "Canonical Boundary Type Name": "boundaryCanonical", "License": "boundaryLicense",
    "License Notes": "licenseDetail", "License Source": "licenseSource",
    "Link to Source Data": "boundarySourceURL"}

PACKAGE = ["package_id"]


def package_selection(packages: DataFrame, isos: str, adm: str, name: str = "file_name") -> DataFrame:
    """Packages whose file name starts with `<ISO>_<level prefix>` for one of the listed countries."""
    wanted = F.lit(False)
    for iso in isos.split(","):
        wanted = wanted | F.col(name).startswith(f"{iso}_{adm}")
    return packages.filter(wanted)


def check_package(members: DataFrame, keys: list[str] = PACKAGE, member: str = "member") -> DataFrame:
    """Contents of each package: one geometry file, its side files, a metadata file in the root."""
    m = F.col(member)
    plain = ~m.contains("MACOS")
    counts = members.groupBy(*keys).agg(
        F.count_if(m == "meta.txt").alias("metas"), F.count_if(m.endswith(".shp") & plain).alias("shapes"),
        F.count_if(m.endswith(".geojson") & plain).alias("geojsons"), F.count_if(m.endswith(".shx")).alias("shx"),
        F.count_if(m.endswith(".dbf")).alias("dbf"), F.count_if(m.endswith(".prj")).alias("prj"))
    total = F.col("shapes") + F.col("geojsons")
    shape_only = (F.col("shapes") == 1) & (total == 1)
    reasons = F.array_compact(F.array(
        F.when(F.col("metas") == 0, F.lit("no meta.txt")),
        F.when(total == 0, F.lit("no geometry file")), F.when(total > 1, F.lit("several geometry files")),
        F.when(shape_only & (F.col("shx") == 0), F.lit("no .shx")),
        F.when(shape_only & (F.col("dbf") == 0), F.lit("no .dbf")),
        F.when(shape_only & (F.col("prj") == 0), F.lit("no .prj"))))
    return counts.select(*keys, (F.col("metas") > 0).alias("has_meta"), total.alias("geometry_files"),
                         reasons.alias("reasons"), (F.size(reasons) == 0).alias("passed"))


def parse_meta(df: DataFrame, text: str = "meta_text", mode: str = "legacy") -> DataFrame:
    """Lines of meta.txt as key and value.

    `legacy` splits on every colon and joins the second and third part, so the colon of a URL is
    lost; `strict` splits on the first colon only.  Lines without a colon give `readError`.
    """
    others = [c for c in df.columns if c != text]
    body = F.regexp_replace(F.col(text), "(\\r\\n|\\n|\\r)$", "")
    lines = df.select(*others, F.posexplode(F.split(body, "\\r\\n|\\n|\\r")).alias("line_no", "_line"))
    parts = F.split("_line", ":", 2 if mode == "strict" else -1)
    split = lines.withColumn("_p", parts)
    n = F.size("_p")
    value = F.when(n > 2, F.concat(F.col("_p")[1], F.try_element_at("_p", F.lit(3)))).otherwise(F.col("_p")[1])
    bad = n < 2
    return split.select(
        *others, "line_no",
        F.when(bad, F.lit("readError")).otherwise(F.trim(F.col("_p")[0])).alias("key"),
        F.when(bad, F.lit("readError")).otherwise(F.trim(F.when(~bad, value))).alias("val"))


def meta_wide(kv: DataFrame, keys: list[str] = PACKAGE) -> DataFrame:
    """One row per package; the last line of a key wins, a missing key is "METADATA ERROR"."""
    def pick(name: str, column: str) -> Column:
        here = F.col("key") == name
        value = F.max_by(F.when(here, F.col("val")), F.when(here, F.col("line_no")))
        return F.coalesce(value, F.lit("" if column == "boundaryCanonical" else "METADATA ERROR")).alias(column)

    return kv.groupBy(*keys).agg(*[pick(n, c) for n, c in META_COLUMNS.items()])


# --- one aggregate expression per field; all of them run in a single pass ------------------------

def _key() -> Column:
    return F.lower("key")


def _val() -> Column:
    return F.col("val")



def _last(match: Column, outcome: Column) -> Column:
    hit = match & outcome.isNotNull()
    return F.max_by(F.when(hit, outcome), F.when(hit, F.col("line_no")))


def year_outcome(current_year: int | None = None) -> Column:
    value = F.when(_val().contains(".0"), F.substring(_val(), F.lit(1), F.length(_val()) - 2)).otherwise(_val())
    ends = F.split(value, " to ")
    good_range = (F.size(ends) == 2) & F.try_to_timestamp(ends[0], F.lit("d-M-yyyy")).isNotNull() \
        & F.try_to_timestamp(F.try_element_at(ends, F.lit(2)), F.lit("d-M-yyyy")).isNotNull()
    number = F.floor(value.try_cast("double"))
    latest = F.lit(current_year) if current_year else F.year(F.current_date())
    return (F.when(value.contains("to"), F.when(good_range, value).otherwise(F.lit("ERROR: unreadable year range")))
            .when(number.isNull(), F.lit("ERROR: unreadable year"))
            .when((number > 1950) & (number <= latest), value)
            .otherwise(F.concat(F.lit("ERROR: year out of range: "), number.cast("string"))))


def _year(current_year: int | None) -> Column:
    return _last(F.col("key").contains("Year") | F.col("key").contains("year"), year_outcome(current_year))


def _boundary_type() -> Column:
    known = F.upper(F.replace(_val(), F.lit(" "), F.lit(""))).isin(LEVELS)
    return _last(_key().contains("boundary type") & ~_key().contains("name"),
                 F.when(known, _val()).otherwise(F.lit("ERROR: unknown boundary type")))


def _iso() -> Column:
    return _last(_key().contains("iso"), F.when(F.length(_val()) != 3, F.lit("ERROR: code has not three letters"))
                 .when(F.col("iso_known"), _val()).otherwise(F.lit("ERROR: code is not listed")))


def _optional(word: str) -> Column:
    return _last(_key().contains(word), F.when(S.is_blank(_val()), F.lit("")).otherwise(S.nullish(_val())))


def _sources() -> Column:
    hit = _key().contains("source") & ~_key().contains("license") & ~_key().contains("data")
    found = F.collect_list(F.when(hit & S.nullish(_val()).isNotNull(), F.struct(F.col("line_no"), _val())))
    joined = F.concat_ws(", ", F.transform(F.array_sort(found), lambda s: s["val"]))
    return F.when(F.size(found) > 0, joined)


def _release_type(release_types: list[str] | None = None) -> Column:
    value = F.lower(_val())
    listed = [t.lower() for t in release_types or RELEASE_TYPES]
    return _last(_key().contains("release type"),
                 F.when(~value.isin(listed), F.lit("ERROR: unknown release type"))
                 .when(~F.contains(F.lower("path"), value), F.lit("ERROR: release type does not fit the folder"))
                 .otherwise(value))


def _license() -> Column:
    return _last(_key() == "license", F.when(F.col("license_known"), F.col("license_name"))
                 .otherwise(F.concat(F.lit("ERROR: unknown license: "), F.col("license_name"))))


def _license_source() -> Column:
    return _last(_key().contains("license source"),
                 F.coalesce(S.nullish(_val()), F.lit("ERROR: no license source")))


def _data_link() -> Column:
    return _last(_key().contains("link to source data"),
                 F.coalesce(S.nullish(_val()), F.lit("ERROR: no link to source data")))


def _with_lookups(kv: DataFrame, isos: DataFrame | None, licenses: DataFrame | None) -> DataFrame:
    out = kv
    if isos is not None:
        known = isos.select(F.col("iso").alias("_iso")).distinct().withColumn("_listed", F.lit(True))
        out = out.join(broadcast_if_small(known), (_val() == F.col("_iso")) & _key().contains("iso"), "left") \
            .withColumn("iso_known", F.coalesce("_listed", F.lit(False))).drop("_iso", "_listed")
    if licenses is not None:
        full = _val()
        for short, name in LICENSE_ALIASES.items():
            full = F.when(_val() == short, F.lit(name)).otherwise(full)
        known = licenses.select(F.lower(F.trim("license")).alias("_license")).distinct().withColumn("_listed", F.lit(True))
        out = out.withColumn("license_name", full).join(
            broadcast_if_small(known), (F.lower(F.trim("license_name")) == F.col("_license")) & (_key() == "license"), "left") \
            .withColumn("license_known", F.coalesce("_listed", F.lit(False))).drop("_license", "_listed")
    return out


def _field(df: DataFrame, keys: list[str], name: str, outcome: Column, missing: str = "NONE") -> DataFrame:
    return df.groupBy(*keys).agg(F.coalesce(outcome, F.lit(missing)).alias(name))


def check_year(kv, current_year=None, keys=PACKAGE):
    return _field(kv, keys, "year", _year(current_year))


def check_boundary_type(kv, keys=PACKAGE):
    return _field(kv, keys, "bType", _boundary_type())


def check_iso(kv, countries, keys=PACKAGE):
    return _field(_with_lookups(kv, countries, None), keys, "iso", _iso())


def check_optional_text(kv, key: str, name: str, keys=PACKAGE):
    return _field(kv, keys, name, _optional(key), "")


def collect_sources(kv, keys=PACKAGE):
    return _field(kv, keys, "source", _sources())


def check_release_type(kv, keys=PACKAGE, release_types: list[str] | None = None):
    return _field(kv, keys, "releaseType", _release_type(release_types))


def check_license(kv, licenses, keys=PACKAGE):
    return _field(_with_lookups(kv, None, licenses), keys, "license", _license())


def check_data_link(kv, keys=PACKAGE):
    return _field(kv, keys, "dataSource", _data_link())


def license_images(members: DataFrame, keys: list[str] = PACKAGE) -> DataFrame:
    return members.filter(F.col("member").isin("license.png", "license.jpg")).select(*keys).distinct() \
        .withColumn("has_image", F.lit(True))


def _with_image(checked: DataFrame, members: DataFrame, keys: list[str]) -> DataFrame:
    found = F.when(F.coalesce("has_image", F.lit(False)), "Image Available").otherwise("None Available")
    usable = ~F.col("licenseSource").startswith("ERROR") & (F.col("licenseSource") != "NONE")
    return checked.join(license_images(members, keys), keys, "left").withColumn(
        "licenseImage", F.when(usable, found).otherwise(F.lit("NONE"))).drop("has_image")


def check_license_source(kv, members, keys=PACKAGE):
    return _with_image(_field(kv, keys, "licenseSource", _license_source()), members, keys)


def metadata_checks(kv: DataFrame, countries: DataFrame, licenses: DataFrame, members: DataFrame,
                    current_year: int | None = None, keys: list[str] = PACKAGE, release_types: list[str] | None = None) -> DataFrame:
    """All metadata fields of a package, checked in one aggregate: value, "NONE" or "ERROR: ..."."""
    def req(name, outcome):
        return F.coalesce(outcome, F.lit("NONE")).alias(name)

    def opt(name, word):
        return F.coalesce(_optional(word), F.lit("")).alias(name)

    checked = _with_lookups(kv, countries, licenses).groupBy(*keys).agg(
        req("year", _year(current_year)), req("bType", _boundary_type()), req("iso", _iso()),
        req("source", _sources()), req("releaseType", _release_type(release_types)), req("license", _license()),
        req("licenseSource", _license_source()), req("dataSource", _data_link()),
        opt("canonical", "canonical"), opt("licenseNotes", "license notes"), opt("otherNotes", "other notes"))
    return _with_image(checked, members, keys)


def metadata_verdict(checks: DataFrame, keys: list[str] = PACKAGE) -> DataFrame:
    """Missing and wrong fields joined to a message; a package is valid only without both."""
    notes = [F.when(F.col(f) == "NONE", F.lit(f"Missing data for {f}."))
             .when(F.contains(F.col(f), F.lit("ERROR")), F.col(f)) for f in REQUIRED_FIELDS + OPTIONAL_FIELDS]
    return checks.select(*keys, F.concat_ws(" | ", *notes).alias("message"),
                         (F.size(F.array_compact(F.array(*notes))) == 0).alias("all_valid"))


def check_labels(checks: DataFrame, keys: list[str] = PACKAGE) -> DataFrame:
    """PASSED or FAILED per test, required and optional."""
    def row(field: str, kind: str) -> Column:
        ok = (F.col(field) != "NONE") & (F.col(field) != "") & ~F.contains(F.col(field), F.lit("ERROR"))
        if field == "licenseImage":
            ok = F.col(field) == "Image Available"
        return F.struct(F.lit(field).alias("test"), F.lit(kind).alias("kind"),
                        F.when(ok, "PASSED").otherwise("FAILED").alias("label"))

    rows = [row(f, "required") for f in REQUIRED_FIELDS if f != "licenseImage"] + \
           [row(f, "optional") for f in [*OPTIONAL_FIELDS, "licenseImage"]]
    return checks.select(*keys, F.inline(F.array(*rows)))


def check_summary(results: DataFrame, groups: list[str]) -> DataFrame:
    """Successes and failures of `passed` rows and the overall result."""
    return results.groupBy(*groups).agg(
        F.count_if("passed").alias("successes"), F.count_if(~F.col("passed")).alias("failures"),
        F.when(F.bool_and("passed"), "PASSED").otherwise("FAILED").alias("result"))


def license_compatible(meta: DataFrame, licenses: DataFrame) -> DataFrame:
    """Is the licence allowed for the product?  `meta` has `license` and `product`."""
    known = licenses.select(F.lower(F.trim("license")).alias("_license"), "gb_open", "gb_authoritative", "gb_humanitarian")
    product = F.lower("product")
    allowed = (F.when(product == "gbopen", F.col("gb_open")).when(product == "gbauthoritative", F.col("gb_authoritative"))
               .when(product == "gbhumanitarian", F.col("gb_humanitarian")).otherwise(F.lit(True)))
    joined = meta.join(broadcast_if_small(known), F.lower(F.trim("license")) == F.col("_license"), "left")
    return joined.withColumn("license_known", F.col("_license").isNotNull()) \
        .withColumn("license_allowed", F.coalesce(F.col("_license").isNotNull() & allowed, F.lit(False))) \
        .drop("_license", "gb_open", "gb_authoritative", "gb_humanitarian")


def build_issue_digest(report: DataFrame, keys: list[str], flags: list[str]) -> DataFrame:
    """Failing layers with their flags as JSON in name order, once per key."""
    failing = report.filter(F.col("status") == "FAIL")
    body = F.to_json(F.struct(*[F.col(c) for c in sorted([*keys, *flags])]))
    return failing.groupBy(*keys).agg(F.min(body).alias("body"))
