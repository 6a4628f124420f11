"""Secret scans with multipart credential linking, DataFrame operations only.

Base spans are found by pattern: `assign` (keyword, separator and a value of 12 or more characters),
`access` (access identifiers) and `hex` (runs of 16 or more).  Further parts are too weak alone: `ident`
(a named user, account or key id), `value` (a token of mixed letters and digits) and `endpoint` (an
address with a scheme).  An interval join links the parts of a text: sorted by start, each weak part
meets the nearest end before it and the nearest start after it of every role (running extremes in both orders), and it is reported only
when complementary parts lie within `scope` code points: a value with an identifier or an endpoint, an
identifier with a secret, an endpoint with both.  The join is a sort and running extremes per text, so
many parts make no pairs.

Places: the pieces that a split leaves and the matches themselves add up to every match's start; sums
run in blocks, so a text of many matches stays near linear.  For `hex` and `access` the least length may
stand in the pattern, since a run that is too short holds no other match.

Edge cases: null and empty texts have no spans; weak parts that overlap base spans are dropped; repeated
rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boundaryspark.llm.common import table
from boundaryspark.llm.registry import query
from boundaryspark.runtime import materialize

SCOPE = 200
_WORDS = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
_NAMES = "[Uu][Ss][Ee][Rr](_?[Nn][Aa][Mm][Ee])?|[Ll][Oo][Gg][Ii][Nn]|[Aa][Cc][Cc][Oo][Uu][Nn][Tt]|[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd]|[Aa][Cc][Cc][Ee][Ss][Ss]_?[Kk][Ee][Yy](_?[Ii][Dd])?"
_SEP = r"""["']?\x20*[:=]\x20*["']?"""
#: kind: (pattern, role); base kinds first, in the order of their names in span lists.
KINDS = {
    "assign": (rf"({_WORDS}){_SEP}([A-Za-z0-9+/_.=-]+)", "secret"),
    "access": (r"AKIA[A-Z0-9]{14,}", "identifier"),
    "hex": (r"[0-9a-f]{16,}", "secret"),
    "ident": (rf"({_NAMES}){_SEP}[A-Za-z0-9@._+-]{{3,}}", "identifier"),
    "value": (r"[A-Za-z0-9+/_=-]{20,}", "secret"),
    "endpoint": (r"""[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20"'<>]{4,}""", "endpoint"),
}
BASE = ("assign", "access", "hex")
NAMES = list(KINDS)
BLOCK = 64
_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _running(values: Column) -> Column:
    """Running sums of an array that is not empty."""
    def of(v: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
        sums = F.transform(blocks, lambda b: _total(F.slice(v, b * BLOCK + 1, BLOCK)))
        before = _let(sums, lambda s: F.transform(blocks, lambda b: _total(F.slice(s, F.lit(1), b))))
        return _let(before, lambda p: F.flatten(F.transform(blocks, lambda b: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(BLOCK), F.size(v) - b * BLOCK)),
            lambda k: F.element_at(p, b + 1) + _total(F.slice(v, b * BLOCK + 1, k))))))
    return _let(values, of)


def _holds(kind: str, found: Column) -> Column:
    """What the pattern of a kind leaves to be checked on a match."""
    if kind == "assign":
        return F.length(F.regexp_extract(found, KINDS[kind][0], 2)) >= 12
    if kind == "value":
        return found.rlike("[0-9]") & found.rlike("[a-z]") & found.rlike("[A-Z]")
    return F.lit(True)


def _spans(text: Column, kind: str) -> Column:
    """(start, kind, end) of every match of a kind that holds."""
    pattern = F.lit(KINDS[kind][0])

    def of(parts: Column) -> Column:
        found, sizes = parts["found"], F.transform(parts["found"], lambda m: F.length(m))
        steps = F.zip_with(F.transform(F.slice(parts["gaps"], F.lit(1), F.size(found)), lambda g: F.length(g)),
                           F.concat(F.array(F.lit(0)), F.slice(sizes, F.lit(1), F.size(found) - 1)), lambda g, m: g + m)
        spans = F.zip_with(_running(steps), found, lambda s, m: F.struct(
            s.alias("start"), F.lit(NAMES.index(kind)).alias("kind"), (s + F.length(m)).alias("end"),
            _holds(kind, m).alias("holds")))
        return F.transform(F.filter(spans, lambda s: s["holds"]), lambda s: s.dropFields("holds"))
    parts = F.struct(F.split(text, KINDS[kind][0], -1).alias("gaps"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"))
    return F.coalesce(F.when(text.rlike(KINDS[kind][0]), _let(parts, of)), F.array()).cast(_SPAN)


def find_secrets(df: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """(doc_id, base, spans) per row: arrays of (start, kind, end) with code points, kinds as numbers of NAMES."""
    content = F.col("_text")
    scanned = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")).select(
        "doc_id", F.array_sort(F.concat(*[_spans(content, k) for k in BASE])).alias("base"),
        F.concat(*[_spans(content, k) for k in NAMES if k not in BASE]).alias("weak"))
    scanned = materialize(scanned.withColumn("_row", F.monotonically_increasing_id()), "spans")
    parts = scanned.where(F.size("weak") > 0).where(F.size("weak") + F.size("base") > 1).select(
        "_row", F.inline(F.concat("base", "weak")))
    roles = [KINDS[k][1] for k in NAMES]
    parts = parts.withColumn("role", F.element_at(F.array(*map(F.lit, roles)), F.col("kind") + 1)).withColumn(
        "weak", F.col("kind") >= len(BASE))
    # frames that grow with the rows only: a frame up to the last row would be read anew for every row
    ways = Window.partitionBy("_row").orderBy("start", "kind", "end"), Window.partitionBy("_row").orderBy(*[F.desc(c) for c in ("start", "kind", "end")])
    before, after = (w.rowsBetween(Window.unboundedPreceding, -1) for w in ways)
    base_end = F.max(F.when(~F.col("weak"), F.col("end"))).over(before)
    base_start = F.min(F.when(~F.col("weak"), F.col("start"))).over(after)
    free = parts.withColumn("_covered", F.coalesce(base_end > F.col("start"), F.lit(False))
                            | F.coalesce(base_start < F.col("end"), F.lit(False))).where("not (weak and _covered)")

    def near(role: str) -> Column:
        is_role = F.col("role") == role
        last = F.max(F.when(is_role, F.col("end"))).over(before)
        following = F.min(F.when(is_role, F.col("start"))).over(after)
        return F.coalesce(F.col("start") - last <= scope, F.lit(False)) | F.coalesce(following - F.col("end") <= scope, F.lit(False))
    linked = free.withColumns({r: near(r) for r in ("identifier", "secret", "endpoint")}).where("weak").where(
        "(role = 'secret' and (identifier or endpoint)) or (role = 'identifier' and secret)"
        " or (role = 'endpoint' and identifier and secret)")
    found = linked.groupBy("_row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("_linked"))
    return scanned.join(found, "_row", "left").select("doc_id", "base", F.array_sort(F.concat(
        "base", F.coalesce("_linked", F.array().cast(_SPAN)))).alias("spans"))


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, NAMES))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def _sql() -> str:
    rows = ", ".join("({}, '{}', '{}', '{}')".format(i, k, KINDS[k][0].replace("'", "''"), KINDS[k][1]) for i, k in enumerate(NAMES))
    near = " OR ".join(["(p.role = 'secret' AND ({id} OR {ep}))", "(p.role = 'identifier' AND {se})",
                        "(p.role = 'endpoint' AND {id} AND {se})"])
    exists = ("EXISTS (SELECT 1 FROM free q WHERE q.rid = p.rid AND (q.kind <> p.kind OR q.s <> p.s) AND q.role = '{}' AND p.s - q.e <= {n} AND q.s - p.e <= {n})")
    near = near.format(**{k: exists.format(r, n=SCOPE) for k, r in (("id", "identifier"), ("se", "secret"), ("ep", "endpoint"))})
    return rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
k(kind, name, pattern, role) AS (VALUES {rows}),
m AS (SELECT rid, kind, name, role, pattern, string_split_regex(text, pattern) AS gaps, regexp_extract_all(text, pattern) AS found
  FROM t, k WHERE regexp_matches(text, pattern)),
e AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m),
f AS (SELECT rid, kind, name, role, pattern, found[i] AS hit,
    (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i-1], lambda x: length(x))), 0))::BIGINT AS s FROM e),
spans AS (SELECT rid, kind, name, role, s, s + length(hit) AS e FROM f
  WHERE (kind <> 0 OR length(regexp_extract(hit, pattern, 2)) >= 12)
    AND (kind <> 4 OR (regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]')))),
free AS (SELECT * FROM spans p WHERE kind < 3 OR NOT EXISTS (SELECT 1 FROM spans b WHERE b.rid = p.rid AND b.kind < 3 AND b.s < p.e AND p.s < b.e)),
kept AS (SELECT * FROM free p WHERE kind < 3 OR ({near}))
SELECT t.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  sha256(coalesce(string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind, e) FILTER (kind < 3), '')) AS base_sha256,
  coalesce(string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind, e), '') AS spans
FROM t LEFT JOIN kept USING (rid) GROUP BY t.rid, t.doc_id
"""


@query("op2_secret_scan", _sql())
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == NAMES.index(kind))).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
                        F.sha2(span_list(F.col("base")), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))
