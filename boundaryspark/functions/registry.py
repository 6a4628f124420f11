"""Scalar helpers as temporary SQL functions; their bodies stay visible to the optimiser."""

from __future__ import annotations

from pyspark.sql import SparkSession

from boundaryspark.functions import geometry as G

_POINTS = "array<struct<x:double,y:double>>"
_STEPS = "zip_with(slice(ring, 1, greatest(size(ring) - 1, 0)), slice(ring, 2, greatest(size(ring) - 1, 0)), (a, b) -> named_struct('a', a, 'b', b))"
_BARE_DATE = "regexp_replace(regexp_replace(trim(text), '^(Mon|Tue|Wed|Thu|Fri|Sat|Sun) +', ''), ' +', ' ')"

FUNCTIONS = {
    "strip_scheme(url STRING) RETURNS STRING": "regexp_replace(url, 'https?:?//', '')",
    "clean_free_text(text STRING) RETURNS STRING": "translate(text, concat(',', char(92), char(34)), '')",
    "normalize_text(text STRING) RETURNS STRING":
        "lower(trim(regexp_replace(translate(text, concat(char(34), char(39), ','), ''), '[ \\\\t\\\\r\\\\n\\\\f]+', ' ')))",
    "ensure_scheme(url STRING) RETURNS STRING": "if(substring(url, 1, 4) = 'http', url, concat('http://', url))",
    "parse_mixed_date(text STRING) RETURNS TIMESTAMP": "coalesce(" + ", ".join(
        f"try_to_timestamp({_BARE_DATE}, '{p}')" for p in ("yyyy-M-d", "yyyyMMdd", "yyyy/M/d", "MMM d, yyyy", "MMM d HH:mm:ss yyyy")) + ")",
    "hash_mod8(text STRING) RETURNS BIGINT": None,
    "hash_mod14(text STRING) RETURNS BIGINT": None,
    "equidistant_x(lon DOUBLE) RETURNS DOUBLE": f"radians(lon) * {G.SEMI_MAJOR!r}D",
    "equidistant_y(lat DOUBLE) RETURNS DOUBLE": f"radians(lat) * {G.SEMI_MAJOR!r}D",
    "equal_area_x(lon DOUBLE) RETURNS DOUBLE": f"radians(lon) * {G.SEMI_MAJOR * G.K0!r}D",
    "equal_area_y(lat DOUBLE) RETURNS DOUBLE":
        f"{(1 - G.ECC2) * G.SEMI_MAJOR / (2 * G.K0)!r}D * (sin(radians(lat)) / (1 - {G.ECC2!r}D * sin(radians(lat)) * sin(radians(lat))) "
        f"- ln((1 - {G.ECC!r}D * sin(radians(lat))) / (1 + {G.ECC!r}D * sin(radians(lat)))) / {2 * G.ECC!r}D)",
    f"ring_area(ring {_POINTS}) RETURNS DOUBLE":
        f"aggregate({_STEPS}, 0.0D, (acc, s) -> acc + (s.a.x - s.b.x) * (s.a.y + s.b.y) / 2)",
    f"ring_length(ring {_POINTS}) RETURNS DOUBLE":
        f"aggregate({_STEPS}, 0.0D, (acc, s) -> acc + sqrt(pow(s.b.x - s.a.x, 2) + pow(s.b.y - s.a.y, 2)))",
}


def _hash_body(digits: int, modulus: int) -> str:
    base = 16 ** digits
    count = 64 // digits
    return (f"aggregate(transform(sequence(0, {count - 1}), i -> cast(conv(substring(sha2(text, 256), i * {digits} + 1, {digits}), 16, 10) AS BIGINT)), "
            f"0L, (acc, v) -> (acc * {base}L + v) % {modulus}L)")


def register_functions(spark: SparkSession) -> list[str]:
    names = []
    for signature, body in FUNCTIONS.items():
        name = signature.split("(")[0]
        if body is None:
            body = _hash_body(8, 10 ** 8) if name == "hash_mod8" else _hash_body(4, 10 ** 14)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
        names.append(name)
    return names
