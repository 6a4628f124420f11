"""The boundary catalogue: lookups, country codes, publication records, listing queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boundaryspark.functions import scalars as S
from boundaryspark.operators.layers import first_per_key
from boundaryspark.runtime import broadcast_if_small, spread_join

# Parts of a country name and the name they stand for, first match wins.
NAME_PATTERNS = [
    ("(US)", "United States"), ("(UK)", "United Kingdom"), ("(Aus)", "Australia"), ("Greenland (Den)", "Greenland"),
    ("(Den)", "Denmark"), ("(Fr)", "France"), ("(Ch)", "China"), ("(Nor)", "Norway"), ("(NZ)", "New Zealand"),
    ("Netherlands [Caribbean]", "Netherlands"), ("(Neth)", "Netherlands"), ("Portugal [", "Portugal"),
    ("Spain [", "Spain")]

# Country names of the base map whose code the country list does not give.
COUNTRY_ALIASES = {
    "Antigua & Barbuda": "ATG", "Bahamas, The": "BHS", "Bosnia & Herzegovina": "BIH", "Congo, Dem Rep of the": "COD",
    "Congo, Rep of the": "COG", "Cabo Verde": "CPV", "Cote d'Ivoire": "CIV", "Central African Rep": "CAF",
    "Czechia": "CZE", "Gambia, The": "GMB", "Iran": "IRN", "Korea, North": "PRK", "Korea, South": "KOR",
    "Laos": "LAO", "Macedonia": "MKD", "Marshall Is": "MHL", "Micronesia, Fed States of": "FSM", "Moldova": "MDA",
    "Sao Tome & Principe": "STP", "Solomon Is": "SLB", "St Kitts & Nevis": "KNA", "St Lucia": "LCA",
    "St Vincent & the Grenadines": "VCT", "Syria": "SYR", "Tanzania": "TZA", "Vatican City": "VAT",
    "United States": "USA", "Antarctica": "ATA", "Bolivia": "BOL", "Brunei": "BRN", "Russia": "RUS",
    "Trinidad & Tobago": "TTO", "Swaziland": "SWZ", "Venezuela": "VEN", "Vietnam": "VNM", "Burma": "MMR"}

# Published columns in order.
CATALOG_COLUMNS = [
    "boundaryID", "boundaryName", "boundaryISO", "boundaryYearRepresented", "boundaryType", "boundaryCanonical",
    "boundarySource", "boundaryLicense", "licenseDetail", "licenseSource", "boundarySourceURL",
    "sourceDataUpdateDate", "buildDate", "Continent", "UNSDG-region", "UNSDG-subregion", "worldBankIncomeGroup",
    "admUnitCount", "meanVertices", "minVertices", "maxVertices", "meanPerimeterLengthKM", "minPerimeterLengthKM",
    "maxPerimeterLengthKM", "meanAreaSqKM", "minAreaSqKM", "maxAreaSqKM", "staticDownloadLink"]

PAGE_SIZE = 50


def enrich_with_country(meta: DataFrame, countries: DataFrame, key: str, keep_unknown: bool = False) -> DataFrame:
    """Country columns for each row; unknown codes drop out or, if kept, are flagged."""
    if keep_unknown:
        flagged = meta.join(broadcast_if_small(countries.withColumn("_hit", F.lit(True))), key, "left")
        return flagged.withColumn("country_known", F.coalesce("_hit", F.lit(False))).drop("_hit")
    return meta.join(broadcast_if_small(countries), key)


def unknown_codes(df: DataFrame, codes: DataFrame, code: str, listed: str) -> DataFrame:
    """Rows whose code is null, blank or not listed."""
    known = codes.select(F.col(listed).alias(code)).distinct()
    return df.join(broadcast_if_small(known), code, "left_anti")


def rename_by_pattern(name: Column | str, patterns: list[tuple[str, str]] | None = None) -> Column:
    """The new name of the first pattern contained in the name, else the name."""
    value = S.col(name)
    hits = [F.when(value.contains(p), F.lit(new)) for p, new in (patterns or NAME_PATTERNS)]
    return F.coalesce(*hits, value)


def resolve_country_code(df: DataFrame, name: str, names: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Code of the exact name if the list holds it once, else the alias code, else null."""
    unique = names.groupBy("name").agg(F.count(F.lit(1)).alias("_n"), F.max("code").alias("_code")) \
        .filter(F.col("_n") == 1).select(F.col("name").alias(name), "_code")
    known = COUNTRY_ALIASES if aliases is None else aliases
    alias_code = F.coalesce(F.lit(None).cast("string"), *[F.when(F.col(name) == n, F.lit(c)) for n, c in known.items()])
    joined = spread_join(df, unique, [name], "left")
    return joined.withColumn("iso_code", F.coalesce("_code", alias_code)).drop("_code")


def split_disputed(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Undisputed rows, and rows whose name has "disp" in it, with the suffix removed."""
    disputed = F.col(name).rlike("(disp)")
    plain = df.filter(~disputed)
    marked = df.filter(disputed).withColumn(name, F.replace(F.col(name), F.lit(" (disp)"), F.lit("")))
    return plain, marked


def level_fallback(layers: DataFrame, value: str) -> DataFrame:
    """Per country the layers ADM0-2; an absent level takes the next coarser one."""
    level = {n: F.max(F.when(F.col("adm") == f"ADM{n}", F.col(value))).alias(f"_{n}") for n in range(3)}
    wide = layers.groupBy("iso").agg(*level.values())
    resolved = [F.struct(F.lit("ADM0").alias("adm"), F.col("_0").alias(value)),
                F.struct(F.lit("ADM1").alias("adm"), F.coalesce("_1", "_0").alias(value)),
                F.struct(F.lit("ADM2").alias("adm"), F.coalesce("_2", "_1", "_0").alias(value))]
    return wide.select("iso", F.inline(F.array(*resolved)))


def coverage_gaps(catalog: DataFrame, countries: DataFrame, products: list[str], levels: list[str],
                  exempt: DataFrame | None = None) -> DataFrame:
    """Expected country, level and product jobs without a source; exempt (iso, adm) pairs are left out."""
    expected = countries.select("iso").distinct() \
        .withColumn("adm", F.explode(F.array(*[F.lit(x) for x in levels]))) \
        .withColumn("product", F.explode(F.array(*[F.lit(p) for p in products])))
    gaps = expected.join(catalog.select("iso", "adm", "product"), ["iso", "adm", "product"], "left_anti")
    return gaps if exempt is None else gaps.join(exempt.select("iso", "adm"), ["iso", "adm"], "left_anti")


def catalog_lookup(sources: DataFrame, iso: str, level: str, source: str, order: str) -> DataFrame:
    """First row of one (country, level, source)."""
    hit = (F.col("iso") == iso) & (F.col("adm") == level) & (F.col("source") == source)
    return sources.filter(hit).orderBy(order).limit(1)


def catalog_lookup_all(sources: DataFrame, order: str) -> DataFrame:
    """First row of every (country, level, source)."""
    return first_per_key(sources, ["iso", "adm", "source"], F.col(order))


def catalog_search(df: DataFrame, q: str = "", adm: str = "", continent: str = "",
                   columns: list[str] | None = None) -> DataFrame:
    """Equality filters, then a text looked for in any shown column, whatever its case."""
    out = df
    if adm:
        out = out.filter(F.col("adm") == adm)
    if continent:
        out = out.filter(F.col("continent") == continent)
    needle = q.strip().lower()
    if needle:
        hit = F.lit(False)
        for c in columns or df.columns:
            hit = hit | F.contains(F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit(needle))
        out = out.filter(hit)
    return out


def api_record(df: DataFrame, base_url: str, prefix: str) -> DataFrame:
    """Published record: all texts, no nulls, dates and links rendered."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")

    def whole(name: str) -> Column:
        return F.coalesce(F.col(name).cast("long"), F.lit(0).cast("long")).cast("string")

    def number(name: str) -> Column:
        value = F.when(F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double")),
                       F.format_string("%.6f", F.col(name).cast("double")))
        return F.coalesce(value, F.lit(""))

    adm = F.upper("boundaryType")
    links = S.download_urls("boundaryISO", adm, base_url, prefix)
    links["staticDownloadLink"] = F.coalesce(F.nullif(F.col("staticDownloadLink"), F.lit("")), links["staticDownloadLink"])
    record = {
        "boundaryID": text("boundaryID"), "boundaryName": text("boundaryName"), "boundaryISO": text("boundaryISO"),
        "boundaryYearRepresented": text("boundaryYear"), "boundaryType": F.coalesce(adm, F.lit("")),
        "boundaryCanonical": F.coalesce(F.nullif(F.col("boundaryCanonical"), F.lit("")), F.lit("Unknown")),
        "boundarySource": text("boundarySource"), "boundaryLicense": text("boundaryLicense"),
        "licenseDetail": text("licenseDetail"),
        "licenseSource": S.strip_scheme(text("licenseSource")),
        "boundarySourceURL": S.strip_scheme(text("boundarySourceURL")),
        "sourceDataUpdateDate": F.coalesce(F.date_format("sourceDataUpdateDate", "EEE MMM dd HH:mm:ss yyyy"), F.lit("")),
        "buildDate": F.coalesce(F.date_format("buildDate", "MMM dd, yyyy"), F.lit("")),
        "Continent": text("Continent"), "UNSDG-region": text("UNSDG-region"),
        "UNSDG-subregion": text("UNSDG-subregion"), "worldBankIncomeGroup": text("worldBankIncomeGroup"),
        "admUnitCount": text("admUnitCount"), "meanVertices": number("meanVertices"),
        "minVertices": whole("minVertices"), "maxVertices": whole("maxVertices"),
        **{n: number(n) for n in ("meanPerimeterLengthKM", "minPerimeterLengthKM", "maxPerimeterLengthKM",
                                  "meanAreaSqKM", "minAreaSqKM", "maxAreaSqKM")},
        **links}
    return df.select(*[v.alias(k) for k, v in record.items()])


#: Published spelling of the catalogue's columns, however their stored names mark or run together words.
_SPELLINGS = {c.replace("-", "").lower(): c for c in CATALOG_COLUMNS}
_UNITS = {"id": "ID", "iso": "ISO", "url": "URL", "km": "KM", "sqkm": "SqKM"}


def published_name(stored: str) -> str:
    """Column of the catalogue that a stored name means; other names join their words, each but the first capitalised."""
    words = [w for w in stored.lower().split("_") if w]
    known = _SPELLINGS.get("".join(words))
    return known or "".join([*words[:1], *[_UNITS.get(w, w.capitalize()) for w in words[1:]]])


def camel_case_columns(df: DataFrame) -> DataFrame:
    """Columns under their published names."""
    return df.toDF(*[published_name(c) for c in df.columns])


def layer_metadata_text(df: DataFrame, keys: list[str], citation: str = "") -> DataFrame:
    """Labelled lines of a layer in fixed order; Open Database licences add an attribution line.

    `citation` is the publisher's own text, put before the lines.
    """
    open_database = F.contains(F.col("boundaryLicense"), F.lit("Open Data Commons Open Database"))
    note = F.when(open_database, "The source requires attribution under the Open Database licence guidelines "
                                 "(https://osmfoundation.org/wiki/Licence/Attribution_Guidelines).") \
        .otherwise("Citation of the sources named in this file is recommended.")
    # Line labels in their order.
    labels = [("ISO-3166-1 (Alpha-3)", "boundaryISO"), ("Boundary Representative of Year", "boundaryYear"),
              ("Boundary Type", "boundaryType"), ("Boundary Source(s)", "boundarySource"),
              ("Canonical Boundary Type Name", "boundaryCanonical"), ("License", "boundaryLicense"),
              ("License Notes", "licenseDetail"), ("License Source", "licenseSource"),
              ("Data Source", "boundarySourceURL"), ("Source Data Updated On", "sourceDataUpdateDate"),
              ("File Built On", "buildDate"), ("Number of Administrative Units", "admUnitCount")]
    lines = [F.lit(citation)] if citation else []
    lines += [note] + [F.concat(F.lit(f"{label}: "), F.coalesce(F.col(c).cast("string"), F.lit("")))
                       for label, c in labels if c in df.columns]
    return df.select(*keys, F.posexplode(F.array(*lines)).alias("line_no", "line"))


def catalog_rollup(catalog: DataFrame) -> DataFrame:
    """Every record under its four grains (ALL/ALL, ALL/level, country/ALL, country/level), one row each.

    The record list of a grain stays spread over rows, since ALL/ALL holds the whole catalogue.
    """
    everything = F.lit("ALL")
    grains = F.array(F.struct(everything.alias("grain_iso"), everything.alias("grain_adm")),
                     F.struct(everything.alias("grain_iso"), F.col("adm").alias("grain_adm")),
                     F.struct(F.col("iso").alias("grain_iso"), everything.alias("grain_adm")),
                     F.struct(F.col("iso").alias("grain_iso"), F.col("adm").alias("grain_adm")))
    return catalog.select(F.inline(grains), *catalog.columns)


def catalog_rollup_counts(catalog: DataFrame) -> DataFrame:
    counts = catalog.cube("iso", "adm").agg(F.count(F.lit(1)).alias("records"))
    return counts.select(F.coalesce("iso", F.lit("ALL")).alias("grain_iso"),
                         F.coalesce("adm", F.lit("ALL")).alias("grain_adm"), "records")


def distinct_countries(catalog: DataFrame, order: str) -> DataFrame:
    """Countries with the name of their first row, sorted by name."""
    return first_per_key(catalog.select("iso", "name", order), ["iso"], F.col(order)).drop(order).orderBy("name", "iso")


def distinct_levels(catalog: DataFrame, iso: str) -> DataFrame:
    return catalog.filter(F.col("iso") == iso).select("adm").distinct().orderBy("adm")


def distinct_sources(catalog: DataFrame, iso: str, adm: str) -> DataFrame:
    return catalog.filter((F.col("iso") == iso) & (F.col("adm") == adm)).select("source").distinct().orderBy("source")


def group_records(df: DataFrame, key: str, lists: int = 1) -> DataFrame:
    """Rows of every key in `lists` lists (`list_no` from 0), whatever its size: by a hash of the row, so keys of very many rows want more."""
    numbered_rows = df.withColumn("list_no", F.pmod(F.xxhash64(*df.columns), F.lit(lists)).cast("int"))
    return numbered_rows.groupBy(key, "list_no").agg(F.collect_list(F.struct(*df.columns)).alias("records"))


def mean_value(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias("mean"))


def sort_records(df: DataFrame, key: str, descending: bool = False) -> DataFrame:
    """Numbers by size before other texts, nulls last."""
    number, text = F.col(key).try_cast("double"), F.col(key).cast("string")
    null_last = F.col(key).isNull().asc()
    if descending:
        return df.orderBy(null_last, number.desc_nulls_last(), text.desc_nulls_last())
    return df.orderBy(null_last, number.asc_nulls_last(), text.asc_nulls_last())


def page(df: DataFrame, n: int, order: list[Column], size: int = PAGE_SIZE) -> DataFrame:
    """Page n of the ordered rows; n is kept between 1 and the last page."""
    last = max(1, -(-df.count() // size))
    number = min(max(n, 1), last)
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def merge_layers(*layers: DataFrame) -> DataFrame:
    """Union of layers with different fields; absent fields are null."""
    merged, *rest = layers
    for layer in rest:
        merged = merged.unionByName(layer, allowMissingColumns=True)
    return merged


def dedupe_country_names(df: DataFrame, name: str, iso: str, order: str) -> DataFrame:
    """First row per name and code."""
    return first_per_key(df, [name, iso], F.col(order))
