"""Scalar helpers as column expressions; none of them leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no value" in submitted metadata.
NULL_WORDS = ["na", "nan", "null"]

# Date patterns tried in this order.
DATE_PATTERNS = ["yyyy-M-d", "yyyyMMdd", "yyyy/M/d", "MMM d, yyyy", "MMM d HH:mm:ss yyyy"]

# Fields searched for the date of a source, in this order.
SOURCE_DATE_FIELDS = ["sourceDataUpdateDate", "sourceDate", "sourceDataDate", "lastUpdated", "date"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_scheme(url: Column | str) -> Column:
    """Remove http and https prefixes, also where the colon was lost."""
    return F.regexp_replace(col(url), "https?:?//", "")


def clean_free_text(text: Column | str) -> Column:
    return F.translate(col(text), ',\\"', "")


def normalize_text(text: Column | str) -> Column:
    bare = F.translate(col(text), "\"',", "")
    return F.lower(F.trim(F.regexp_replace(bare, "\\s+", " ")))


def ensure_scheme(url: Column | str) -> Column:
    return F.when(F.substring(col(url), 1, 4) == "http", col(url)).otherwise(F.concat(F.lit("http://"), col(url)))


def nullish(text: Column | str) -> Column:
    """Null for blank values and the null words, else the value."""
    value = col(text)
    return F.when((F.length(F.replace(value, F.lit(" "), F.lit(""))) > 0)
                  & ~F.lower(value).isin(NULL_WORDS), value)


def is_blank(text: Column | str) -> Column:
    return F.length(F.replace(col(text), F.lit(" "), F.lit(""))) == 0


def parse_mixed_date(text: Column | str) -> Column:
    """First date pattern that fits; a leading weekday name is dropped, as Spark parses none."""
    value = F.trim(F.regexp_replace(col(text), "^(Mon|Tue|Wed|Thu|Fri|Sat|Sun) +", ""))
    value = F.regexp_replace(value, " +", " ")
    return F.coalesce(*[F.try_to_timestamp(value, F.lit(p)) for p in DATE_PATTERNS])


def first_date_field(json_text: Column | str) -> Column:
    """Date of a metadata document; broken JSON is searched for the main field by pattern."""
    doc = col(json_text)
    fields = F.coalesce(*[parse_mixed_date(F.get_json_object(doc, f"$.{n}")) for n in SOURCE_DATE_FIELDS])
    by_pattern = parse_mixed_date(F.nullif(
        F.regexp_extract(doc, '"sourceDataUpdateDate"\\s*:\\s*"([^"]+)"', 1), F.lit("")))
    return F.when(F.get_json_object(doc, "$").isNotNull(), fields).otherwise(by_pattern)


def to_local(ts: Column | str, zone: str = "America/New_York") -> Column:
    """UTC instant as ISO text in another zone, with its offset."""
    local = F.from_utc_timestamp(col(ts), zone)
    minutes = F.floor((F.unix_timestamp(local) - F.unix_timestamp(col(ts))) / 60)
    sign = F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+"))
    offset = F.format_string("%02d:%02d", F.floor(F.abs(minutes) / 60), F.abs(minutes) % 60)
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), sign, offset)


def format_elapsed(seconds: Column | str) -> Column:
    s = F.floor(col(seconds)).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60)


def status_key_iso(key: Column | str) -> Column:
    parts = F.split(col(key), "_")
    return F.when(F.size(parts) >= 3, F.element_at(parts, 1))


def status_key_level(key: Column | str) -> Column:
    parts = F.split(col(key), "_")
    return F.when(F.size(parts) >= 3, F.replace(F.element_at(parts, 2), F.lit("ADM"), F.lit("")))


def hex_mod(digest: Column, modulus: int) -> Column:
    """Hexadecimal SHA-256 text as an integer modulo 10^8 or 10^14, in 64-bit steps."""
    digits = 8 if modulus <= 10 ** 8 else 4
    base = 16 ** digits
    acc = F.lit(0).cast("long")
    for start in range(1, 65, digits):
        chunk = F.conv(F.substring(digest, start, digits), 16, 10).cast("long")
        acc = (acc * F.lit(base) + chunk) % F.lit(modulus)
    return acc


def hash_mod(text: Column | str, modulus: int) -> Column:
    return hex_mod(F.sha2(col(text).cast("binary"), 256), modulus)


def round_half_even(value: Column | str) -> Column:
    return F.bround(col(value), 0)


def share_label(share: Column | str) -> Column:
    return F.concat(F.format_string("%.1f", col(share) * 100), F.lit("%"))


def share_class(share: Column | str) -> Column:
    return F.when(col(share) > 0.9, "high").when(col(share) > 0.7, "mid").otherwise("low")


def file_name(path: Column | str) -> Column:
    return F.substring_index(col(path), "/", -1)


def file_stem_parts(path: Column | str) -> dict[str, Column]:
    """File name, extension, country code and level of `<ISO>_<ADM>.<ext>`."""
    name = file_name(path)
    stem = F.regexp_replace(name, "\\.[^.]*$", "")
    return {
        "file_name": name,
        "extension": F.regexp_extract(name, "\\.([^.]*)$", 1),
        "iso": F.regexp_extract(stem, "^([^_]+)_", 1),
        "adm": F.regexp_extract(stem, "^[^_]+_([^_]+)$", 1),
    }


def decode_text(raw: Column | str) -> Column:
    """Bytes as text: UTF-8 if valid, else Latin-1, which accepts every byte."""
    return F.coalesce(F.try_validate_utf8(col(raw).cast("string")), F.decode(col(raw), "ISO-8859-1"))


def claimants(text: Column | str) -> Column:
    listed = F.filter(F.split(F.coalesce(col(text), F.lit("")), "\\|"), lambda c: F.trim(c) != "")
    return F.array_remove(listed, "None")


def csv_field(text: Column | str) -> Column:
    value = F.replace(F.coalesce(col(text), F.lit("")), F.lit('"'), F.lit('""'))
    return F.when(value.rlike('[",\\n]'), F.concat(F.lit('"'), value, F.lit('"'))).otherwise(value)


def download_urls(iso: Column | str, adm: Column | str, base_url: str, prefix: str) -> dict[str, Column]:
    """Five links of a published layer; site address and file prefix are the caller's."""
    stem = F.concat(F.lit(base_url.rstrip("/") + "/"), col(iso), F.lit("/"), col(adm), F.lit(f"/{prefix}-"),
                    col(iso), F.lit("-"), col(adm))
    return {
        "staticDownloadLink": F.concat(stem, F.lit("-all.zip")),
        "gjDownloadURL": F.concat(stem, F.lit(".geojson")),
        "tjDownloadURL": F.concat(stem, F.lit(".topojson")),
        "imagePreview": F.concat(stem, F.lit("-PREVIEW.png")),
        "simplifiedGeometryGeoJSON": F.concat(stem, F.lit("_simplified.geojson")),
    }
