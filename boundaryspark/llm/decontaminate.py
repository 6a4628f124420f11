"""Benchmark decontamination, DataFrame operations only.

Method: windows as long as a benchmark item are laid over the documents, get a SimHash of their words, and
meet the items' fingerprints through an index of `radius` + 1 bit blocks: two fingerprints that differ in
at most `radius` bits agree on a whole block, so no fingerprint within the radius is missed.  Candidates
within the radius are verified by exact similarity of their weighted shingles (the weight is how often a
shingle occurs), and a document holds an item when that is at least `similarity`.

Where windows are laid: a window of similarity s shares at least s of the item's shingles, so of any set of
more than 1 - s of them it holds one, and with it every word of that shingle.  Each item picks such a set
around few anchor words (rare in the benchmark, then long), and windows are laid only where an anchor
occurs, aligned with it; the anchor is part of the index key.  Windows are cut at the ends of a text.

Words are runs of letters and digits in lower case.  The anchors' hashes make a byte table of fixed size
that is tested inside each row, so texts are read once and nothing of them is shuffled but the windows.

Edge cases: null and empty texts and items match nothing; an item with fewer words than a shingle is one
shingle; repeated rows give one result for each (id, text, item); a null id is an id like others; empty
tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boundaryspark.llm.common import broadcast_if_counted, table
from boundaryspark.llm.registry import query
from boundaryspark.runtime import materialize

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
SLOTS = 1 << 17
#: Four counters of 15 bits in one number: ones in each, a bit of a nibble in each, and what lifts it to the top.
_MOST_PACKED = (1 << 14) - 1
_LANES = sum(1 << 15 * j for j in range(4))
_NIBBLE = sum(1 << 16 * j for j in range(4))
_LIFT = sum(((1 << 14) - (1 << j)) << 15 * j for j in range(4))


def words(text: str) -> Column:
    parts = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[^\\p{L}\\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def shingles(column: str, size: int) -> Column:
    """Shingles as strings; a shorter sequence is one shingle, none has none."""
    return F.expr(f"""transform(sequence(0, greatest(size({column}) - {size}, 0)),
        i -> array_join(slice({column}, i + 1, {size}), ' '))""")


def simhash(column: str) -> Column:
    """64-bit SimHash of an array of words, by majorities of packed counters, or of one counter a bit where they would run over."""
    spread = (f"shiftrightunsigned((((shiftrightunsigned(h, 4 * k) & 15L) * {_LANES}L) & {_NIBBLE}L) + {_LIFT}L, 14) & {_LANES}L")
    lanes = f"aggregate(hs, 0L, (a, h) -> a + ({spread}))"
    major = f"shiftrightunsigned({lanes} + ({(1 << 14) - 1}L - size(hs) div 2) * {_LANES}L, 14) & {_LANES}L"
    gather = "((x | shiftrightunsigned(x, 14) | shiftrightunsigned(x, 28) | shiftrightunsigned(x, 42)) & 15L)"
    ones = "aggregate(hs, 0L, (a, h) -> a + (shiftrightunsigned(h, k) & 1L))"
    wide = f"aggregate(transform(sequence(0, 63), k -> if({ones} > size(hs) div 2, shiftleft(1L, k), 0L)), 0L, (a, x) -> a | x)"
    return F.expr(f"""element_at(transform(array(transform({column}, w -> xxhash64(w))), hs -> if(size(hs) > {_MOST_PACKED}, {wide},
        aggregate(transform(sequence(0, 15), k -> {major}), named_struct('f', 0L, 'n', 0),
            (s, x) -> named_struct('f', s.f | shiftleft({gather}, 4 * s.n), 'n', s.n + 1)).f)), 1)""")


def blocks(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of radius + 1 blocks of 64 bits."""
    cuts = [64 * k // (radius + 1) for k in range(radius + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def block_values(fingerprint: str, radius: int) -> Column:
    return F.array(*[F.expr(f"struct({k} as block, shiftrightunsigned({fingerprint}, {a}) & {(1 << n) - 1}L as value)")
                     for k, (a, n) in enumerate(blocks(radius))])


def prepare_items(items: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(item_id, item_words, n, fp, anchor, at): a row per item and chosen anchor position."""
    split = items.select("item_id", words("text").alias("item_words")).where("size(item_words) > 0")
    counts = split.select(F.explode("item_words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("seen"))
    placed = split.select("item_id", "item_words", F.posexplode("item_words").alias("at", "word")).join(counts, "word")
    ranked = placed.groupBy("item_id", "item_words").agg(
        F.array_sort(F.collect_list(F.struct("seen", (-F.length("word")).alias("short"), "at"))).alias("ranked"))
    number = f"greatest(size(item_words) - {shingle - 1}, 1)"
    need = f"floor({1 - similarity:.6f} * {number} + 1e-9)"
    chosen = F.expr(f"""aggregate(ranked, named_struct('at', cast(array() as array<int>), 'covered', cast(array() as array<int>)),
        (s, p) -> if(size(s.covered) > {need}, s, named_struct('at', array_append(s.at, p.at),
            'covered', array_union(s.covered, sequence(least(greatest(p.at - {shingle - 1}, 0), {number} - 1), least(p.at, {number} - 1)))))).at""")
    out = ranked.withColumn("_chosen", chosen).select("item_id", "item_words", F.size("item_words").alias("n"),
                                                      F.explode("_chosen").alias("at"))
    return out.withColumns({"fp": simhash("item_words"), "anchor": F.expr("element_at(item_words, at + 1)")})


def _similarity(size: int) -> Column:
    """Shared weight over joint weight of the shingles of `window` and `item_words`."""
    pair = F.struct(shingles("window", size).alias("a"), shingles("item_words", size).alias("b"))
    common = F.transform(F.array(pair), lambda p: F.struct(F.size(p["a"]) + F.size(p["b"]), F.aggregate(
        F.array_distinct(p["b"]), F.lit(0), lambda t, s: t + F.least(
            F.size(F.filter(p["b"], lambda x: x == s)), F.size(F.filter(p["a"], lambda x: x == s))))))
    return F.element_at(F.transform(common, lambda c: c["col2"] / (c["col1"] - c["col2"])), 1)


def find_leaks(documents: DataFrame, items: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY,
               radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, item_id, similarity, first_word, n_words): the best window of each text and item."""
    prepared = materialize(prepare_items(items.select("item_id", "text"), shingle, similarity), "items")
    longest = prepared.agg(F.max("n")).first()[0] or 0
    slot = f"pmod(xxhash64(%s), {SLOTS}L)"
    slots = bytearray(SLOTS)
    for row in prepared.select(F.expr(slot % "anchor").alias("slot")).distinct().collect():
        slots[row["slot"]] = 1
    # one expression per row: were the words a column of their own, the optimiser would split texts again for every word
    found = F.expr(f"""element_at(transform(array(_words), ws -> if(size(ws) = 0, null, transform(
        filter(sequence(0, size(ws) - 1), i -> substring(_slots, cast({slot % 'ws[i]'} as int) + 1, 1) = X'01'),
        i -> named_struct('pos', i, 'anchor', ws[i], 'from', greatest(i - {longest}, 0),
            'near', slice(ws, greatest(i - {longest}, 0) + 1, {2 * longest + 1}))))), 1)""")
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
                            words(text).alias("_words"), F.lit(bytes(slots)).alias("_slots"))
    around = rows.select("doc_id", "text_hash", F.inline(found))
    anchors = broadcast_if_counted(materialize(prepared.select("anchor", "at", "n").distinct(), "anchors"))
    windows = around.join(anchors, "anchor").withColumns({
        "first_word": F.greatest(F.col("pos") - F.col("at"), F.lit(0)), "_end": F.col("pos") - F.col("at") + F.col("n")})
    windows = windows.withColumn("window", F.expr("slice(near, first_word - from + 1, _end - first_word)"))
    windows = windows.withColumn("fp", simhash("window")).select(
        "doc_id", "text_hash", "first_word", "window", "anchor", "at", "n", "fp", F.inline(block_values("fp", radius)))
    index = prepared.select("item_id", "anchor", "at", "n", F.col("item_words"), F.col("fp").alias("item_fp"),
                            F.inline(block_values("fp", radius)))
    index = broadcast_if_counted(materialize(index, "blocks"))
    near = windows.join(index, ["anchor", "at", "n", "block", "value"]).where(
        F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    first = " and ".join(f"(block <= {k} or (shiftrightunsigned(fp ^ item_fp, {a}) & {(1 << b) - 1}L) <> 0)"
                         for k, (a, b) in enumerate(blocks(radius)))
    near = near.where(first).select("doc_id", "text_hash", "item_id", "first_word", F.size("window").alias("n_words"),
                                    _similarity(shingle).alias("similarity"))
    scored = near.where(F.col("similarity") >= similarity)
    best = F.min_by(F.struct("first_word", "n_words", "similarity"), F.struct(-F.col("similarity"), "first_word"))
    return scored.groupBy("doc_id", "text_hash", "item_id").agg(best.alias("_best")).select(
        "doc_id", "text_hash", "item_id", "_best.similarity", "_best.first_word", "_best.n_words")


def remove_leaks(documents: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of `documents` that hold no benchmark item, with all their columns."""
    leaks = find_leaks(documents, items, **options).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    leaks = broadcast_if_counted(materialize(leaks, "leaks"))
    rows = documents.withColumn("_text_hash", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    return rows.join(leaks, rows["doc_id"].eqNullSafe(leaks["_id"]) & (rows["_text_hash"] == leaks["_hash"]),
                     "left_anti").drop("_text_hash")


@query("op3_decontaminate")
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "first_word", "n_words")
