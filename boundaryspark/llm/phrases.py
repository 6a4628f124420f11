"""Phrase collocation mining over a weighted de Bruijn graph of words, each language on its own.

Method: nodes are phrases of three words, edges phrases of four, which join the nodes that overlap in two words.  Edges
are aggregated with their number of occurrences, and the last one to three words of a piece go along as shorter
rows.  The count of a node is the flow out of it and the ends of pieces in it, that of two words the flow of
the nodes that begin with them and the ends.  A node that all occurrences enter by one edge and leave by one edge is unary:
chains of such edges are compacted into paths by pointer doubling, and a path gives its four-word phrases from one row; its inner nodes
lie in an edge of the same count and so are no candidates.  There are no unary cycles, since every occurrence has a first word.

A phrase is frequent only if its parts are.  Passes before count words, pairs of frequent words and threes of frequent pairs; texts are then
cut at pairs and threes that aren't frequent, which changes the count of no frequent phrase.  These counts are held by 32 bits of a hash, so they are
never too low, and bit tables of fixed size tell which are frequent; a false hit costs a row, never a result.  All counts are aggregates
that combine before the shuffle, so a very common phrase is a row of each task.  Words are 64-bit hashes of language and word; a last pass
spells the words of the rows returned.

Edge cases: a null language is `und`, a null or empty text has no words; a text is whole at any length; a repeated row counts
again; scores that tie go by count and phrase; an empty table, or one without frequent phrases, gives an empty result.
Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boundaryspark.llm.common import broadcast_if_counted, hash_table, table, table_of
from boundaryspark.llm.registry import query
from boundaryspark.llm.repeats import mix
from boundaryspark.runtime import materialize

LEAST, TOP, COVER_PERCENT, SCALE = 30, 2000, 80, 2_000_000
#: Bytes of texts that are taken apart at once.
CHUNK = 2 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 0 part of a word, 1 between words, 2 between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_SYMBOLS = np.random.default_rng(13).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(texts: list[bytes], languages: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of some texts: key, number of the piece, text, first byte and end in the joined lower-cased bytes, and these bytes."""
    data = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    kind = _KIND[data]
    word = kind == 0
    bounds = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = bounds[::2], bounds[1::2]
    lengths = ends - starts
    if not len(starts):
        return np.zeros(0, np.uint64), starts, starts, starts, ends, data
    at = np.flatnonzero(word)
    power = np.cumprod(np.full(int(lengths.max()), _STEP, np.uint64), dtype=np.uint64)
    values = _SYMBOLS[data[at]] * power[at - np.repeat(starts, lengths)]
    sums = np.add.reduceat(values, np.cumsum(lengths) - lengths)
    begins = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
    row = np.searchsorted(begins, starts, side="right") - 1
    seeds = np.array([xxhash.xxh3_64_intdigest(x) for x in languages], np.uint64)
    return mix(mix(sums) ^ seeds[row]), np.cumsum(kind == 2)[starts], row, starts, ends, data


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[str]]]:
    for batch in batches:
        texts, languages, size = [], [], 0
        for text, language in zip(batch.column(0), batch.column(1), strict=True):
            texts.append(text.as_py())
            languages.append(language.as_py())
            size += len(texts[-1])
            if size >= CHUNK:
                yield texts, languages
                texts, languages, size = [], [], 0
        if texts:
            yield texts, languages


def _follows(keys: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every two words that follow one another, and whether they are of one piece."""
    return mix(keys[:-1] * _STEP + keys[1:]), pieces[1:] == pieces[:-1]


def _threes(pair: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return mix(pair[:-1] * _STEP ^ pair[1:]), linked[:-1] & linked[1:]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _inputs(documents: DataFrame, text: str, lang: str) -> DataFrame:
    return documents.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"), F.coalesce(F.col(lang), F.lit("und")).alias("lang"))


def count_words(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(word_key, language, n) of all words, and (language, lang, n) of all languages; `language` is the hash of its name."""
    def count(batches):
        for raw, languages in _chunks(batches):
            keys, _, row, *_ = words_of(raw, languages)
            seeds = np.array([xxhash.xxh3_64_intdigest(x) for x in languages], np.uint64)
            unique, first, n = np.unique(keys, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(unique), _signed(seeds[row[first]]), pa.array(n.astype(np.int64)),
                                              pa.nulls(len(n), pa.string())], names=names)
            _, first, n = np.unique(seeds[row], return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(n), pa.int64()), _signed(seeds[row[first]]), pa.array(n.astype(np.int64)),
                                              pa.array([languages[r] for r in row[first].tolist()], pa.string())], names=names)
    names = ["word_key", "language", "n", "lang"]
    counted = texts.mapInArrow(count, "word_key long, language long, n long, lang string").groupBy(*[n for n in names if n != "n"]).agg(F.sum("n").alias("n"))
    counted = materialize(counted, "words")
    return counted.where("word_key is not null").drop("lang"), counted.where("word_key is null").drop("word_key")


def _count_hashes(texts: DataFrame, least: int, hashes) -> DataFrame:
    """(hash, n) of the 32-bit hashes that occur at least `least` times; `hashes` makes them of keys and pieces."""
    def count(batches):
        for raw, languages in _chunks(batches):
            keys, pieces, *_ = words_of(raw, languages)
            unique, n = np.unique(hashes(keys, pieces) >> np.uint64(32), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(unique.astype(np.uint32).view(np.int32)), pa.array(n.astype(np.int32))], names=["hash", "n"])
    return texts.mapInArrow(count, "hash int, n int").groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class _Known:
    """Are words, pairs or threes frequent?  Bit tables are unpacked once in a task."""

    def __init__(self, *packed: bytes) -> None:
        self.packed, self.tables = packed, []

    def __getitem__(self, k: int):
        self.tables = self.tables or [table_of(p) for p in self.packed]
        return self.tables[k]

    def linked(self, keys: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pair, joined = _follows(keys, pieces)
        return pair, joined & self[0](pair >> np.uint64(32))


def _hash_bits(hashes: DataFrame) -> bytes:
    return hash_table(hashes, F.col("hash").cast("long"))


def frequent_pairs(texts: DataFrame, words: bytes, least: int) -> bytes:
    """Bit table of the pairs of frequent words that occur often enough."""
    often = _Known(words)

    def pairs(keys, pieces):
        known, (pair, joined) = often[0](keys), _follows(keys, pieces)
        return pair[joined & known[:-1] & known[1:]]
    return _hash_bits(_count_hashes(texts, least, pairs))


def frequent_threes(texts: DataFrame, pairs: bytes, least: int) -> bytes:
    often = _Known(pairs)

    def threes(keys, pieces):
        three, linked = _threes(*often.linked(keys, pieces))
        return three[linked]
    return _hash_bits(_count_hashes(texts, least, threes))


def count_edges(texts: DataFrame, pairs: bytes, threes: bytes) -> DataFrame:
    """(w1, w2, w3, w4, n): the longest phrase of two to four words that starts at a word and whose pairs and threes are
    frequent; w3 and w4 are null where it ends before."""
    often = _Known(pairs, threes)

    def count(batches):
        for raw, languages in _chunks(batches):
            keys, pieces, *_ = words_of(raw, languages)
            pair, linked = often.linked(keys, pieces)
            three, both = _threes(pair, linked)
            both = np.append(both & often[1](three >> np.uint64(32)), [False] * 4)
            two = np.flatnonzero(linked)
            third = both[two]
            fourth = third & both[two + 1]
            padded = np.append(keys, np.zeros(4, np.uint64))
            columns = [padded[two], padded[two + 1], np.where(third, padded[two + 2], np.uint64(0)), np.where(fourth, padded[two + 3], np.uint64(0))]
            row = third.astype(np.uint64) + fourth
            for c in columns:
                row = mix(row * _STEP + c)
            _, first, n = np.unique(row, return_index=True, return_counts=True)
            third, fourth = third[first], fourth[first]
            yield pa.RecordBatch.from_arrays([_signed(columns[0][first]), _signed(columns[1][first]),
                                              pa.array(columns[2][first].view(np.int64), mask=~third), pa.array(columns[3][first].view(np.int64), mask=~fourth),
                                              pa.array(n.astype(np.int64))], names=["w1", "w2", "w3", "w4", "n"])
    sent = texts.mapInArrow(count, "w1 long, w2 long, w3 long, w4 long, n long")
    return sent.groupBy("w1", "w2", "w3", "w4").agg(F.sum("n").alias("n"))


def spell(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(word_key, word) of the keys in `wanted`, a written table."""
    often = _Known(hash_table(wanted, F.col("word_key")))

    def found(batches):
        for raw, languages in _chunks(batches):
            keys, _, _, starts, ends, data = words_of(raw, languages)
            unique, first = np.unique(keys, return_index=True)
            keep = often[0](unique)
            whole, first = data.tobytes(), first[keep]
            words = [whole[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([_signed(unique[keep]), pa.array(words, pa.binary()).cast(pa.string())], names=["word_key", "word"])
    return texts.mapInArrow(found, "word_key long, word string").distinct().join(wanted.select("word_key").distinct(), "word_key", "left_semi")


def phrase_key(*words: str):
    return F.xxhash64(F.lit(len(words)), *words)


def compact_paths(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(words, n): maximal chains of edges through unary nodes, as lists of word keys.  An edge between other nodes is a path of four words."""
    edges = materialize(edges.select(phrase_key("w1", "w2", "w3", "w4").alias("edge"), phrase_key("w1", "w2", "w3").alias("source"),
                                     phrase_key("w2", "w3", "w4").alias("target"), "w1", "w2", "w3", "w4", "n"), "edges")
    nodes = nodes.select(phrase_key("w1", "w2", "w3").alias("node"), F.col("n").alias("flow"))
    enter = edges.select(F.col("edge").alias("before"), F.col("target").alias("node"), F.col("n").alias("flow"))
    leave = edges.select("edge", F.col("source").alias("node"), F.col("n").alias("flow"))
    links = nodes.join(enter, ["node", "flow"]).join(leave, ["node", "flow"]).select("edge", "before")
    state = materialize(edges.select("edge").join(links, "edge", "left").select(
        "edge", F.coalesce("before", "edge").alias("head"), F.col("before").isNotNull().cast("long").alias("place")), "paths")
    while True:
        ahead = state.where("place > 0").select(F.col("edge").alias("head"), F.col("head").alias("_head"), F.col("place").alias("_place"))
        if ahead.join(state.where("place > 0").select("head"), "head", "left_semi").isEmpty():
            break
        state = materialize(state.join(ahead, "head", "left").select(
            "edge", F.coalesce("_head", "head").alias("head"), (F.col("place") + F.coalesce("_place", F.lit(0))).alias("place")), "paths")
    rows = edges.join(state, "edge")
    chains = rows.groupBy("head").agg(F.array_sort(F.collect_list(F.struct("place", "w4"))).alias("rest"), F.first("n").alias("n"),
                                      F.min_by(F.array("w1", "w2", "w3"), "place").alias("begin"))
    return chains.select(F.concat("begin", F.col("rest.w4")).alias("words"), "n")


def _windows(paths: DataFrame, size: int, inner: bool = False) -> DataFrame:
    """All runs of `size` words of each path; inner ones neither begin nor end it."""
    first, last = (1, F.size("words") - size - 1) if inner else (0, F.size("words") - size)
    paths = paths.where(last >= first)
    at = paths.select("n", "words", F.explode(F.sequence(F.lit(first), last)).alias("_at"))
    return at.select(*[F.element_at("words", F.col("_at") + k + 1).alias(f"w{k + 1}") for k in range(size)], "n")


def _cover(longer: DataFrame, size: int) -> DataFrame:
    """Largest count of the phrases of `size` + 1 words that hold a phrase of `size` words, by its words."""
    names = [f"w{k + 1}" for k in range(size)]
    ends = longer.select(*names, "n").unionAll(longer.select(*[F.col(f"w{k + 2}").alias(f"w{k + 1}") for k in range(size)], "n"))
    return ends.groupBy(*names).agg(F.max("n").alias("cover"))


def phrase_graph(texts: DataFrame, least: int = LEAST) -> dict[str, DataFrame]:
    """Written tables of the frequent part of the graph of (raw, lang): words, pairs (w1, w2), nodes (w1-w3) and paths (words), each with
    its count n, and languages with the number of all their words."""
    words, languages = count_words(texts)
    words = words.where(F.col("n") >= least)
    pairs = frequent_pairs(texts, hash_table(words, F.col("word_key")), least)
    rows = materialize(count_edges(texts, pairs, frequent_threes(texts, pairs, least)), "edges")
    flow = rows.where("w3 is not null").groupBy("w1", "w2", "w3").agg(F.sum("n").alias("n"))
    flow = materialize(flow, "nodes")
    two = flow.select("w1", "w2", "n").unionAll(rows.where("w3 is null").select("w1", "w2", "n"))
    two = materialize(two.groupBy("w1", "w2").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "pairs")
    nodes = flow.where(F.col("n") >= least)
    paths = materialize(compact_paths(rows.where(F.col("w4").isNotNull() & (F.col("n") >= least)), nodes), "paths")
    return {"words": words, "pairs": two, "nodes": nodes, "paths": paths, "languages": languages}


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP, cover_percent: int = COVER_PERCENT, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of two to four words of each language."""
    texts = _inputs(documents, text, lang)
    graph = phrase_graph(texts, least)
    words, pairs, nodes, paths = (graph[k] for k in ("words", "pairs", "nodes", "paths"))
    fours = _windows(paths, 4)
    covered = F.coalesce(100 * F.col("cover").cast("decimal(30,0)") >= cover_percent * F.col("n").cast("decimal(30,0)"), F.lit(False))
    inner = _windows(paths, 3, inner=True)
    threes = nodes.join(inner, ["w1", "w2", "w3"], "left_anti").join(_cover(fours, 3), ["w1", "w2", "w3"], "left").where(~covered)
    twos = pairs.join(_cover(nodes, 2), ["w1", "w2"], "left").where(~covered)
    counts = materialize(words.select(phrase_key("word_key").alias("part"), "n", "language").unionByName(
        pairs.select(phrase_key("w1", "w2").alias("part"), "n"), allowMissingColumns=True).unionByName(
        nodes.select(phrase_key("w1", "w2", "w3").alias("part"), "n"), allowMissingColumns=True), "parts")

    def cuts(rows: DataFrame, size: int) -> DataFrame:
        names = [f"w{k + 1}" for k in range(size)]
        ways = F.array(*[F.struct(F.lit(k).alias("k"), phrase_key(*names[:k]).alias("left"), phrase_key(*names[k:]).alias("right")) for k in range(1, size)])
        return rows.select(F.array(*names).alias("words"), F.col("n").alias("a"), F.explode(ways).alias("cut")).select("words", "a", "cut.*")
    every = cuts(fours, 4).unionAll(cuts(threes, 3)).unionAll(cuts(twos, 2))
    parts = broadcast_if_counted(counts)
    every = every.join(parts.select(F.col("part").alias("left"), F.col("n").alias("l"), "language"), "left")
    every = every.join(parts.select(F.col("part").alias("right"), F.col("n").alias("r")), "right")
    every = every.withColumn("score", F.expr(f"cast(a as decimal(20,0)) * {SCALE} div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    best = every.groupBy("words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_best"), F.max("language").alias("language"))
    best = best.select("language", "words", "a", "_best.l", "_best.r", "_best.score")
    # ties stay until the phrases themselves are there to part them
    order = [F.col("score").desc(), F.col("a").desc()]
    best = best.withColumn("_rank", F.rank().over(Window.partitionBy("language").orderBy(*order))).where(F.col("_rank") <= top).drop("_rank")
    best = materialize(best.withColumn("_id", F.xxhash64("words")), "best")
    places = materialize(best.select("_id", F.posexplode("words").alias("_at", "word_key")), "best")
    spelled = places.join(spell(texts, places), "word_key")
    spelled = spelled.groupBy("_id").agg(F.concat_ws(" ", F.array_sort(F.collect_list(F.struct("_at", "word")))["word"]).alias("phrase"))
    out = best.join(spelled, "_id").join(broadcast_if_counted(graph["languages"]), "language")
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long"))
    return out.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP13_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
i AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (SELECT lang, ws[i:i + k - 1] AS ws, k FROM i, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, ws, k, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
s AS (SELECT a.lang, a.ws[j:j + m - 1] AS ws, max(a.f) AS f FROM f a, (SELECT unnest([1, 2, 3]) AS j), (SELECT unnest([2, 3]) AS m)
  WHERE a.k > m AND j + m - 1 <= a.k GROUP BY ALL),
c AS (SELECT f.* FROM f LEFT JOIN s ON f.lang = s.lang AND f.ws = s.ws
  WHERE f.k >= 2 AND NOT coalesce(100 * s.f::HUGEINT >= 80 * f.f::HUGEINT, FALSE)),
u AS (SELECT c.lang, c.ws, c.f AS a, x.f AS l, y.f AS r, (c.f::HUGEINT * 2000000 // (x.f + y.f)::HUGEINT)::BIGINT AS score, h
  FROM c, (SELECT unnest([1, 2, 3]) AS h), f x, f y
  WHERE h < c.k AND x.lang = c.lang AND y.lang = c.lang AND x.ws = c.ws[1:h] AND y.ws = c.ws[h + 1:c.k]),
b AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, h) = 1),
o AS (SELECT *, array_to_string(ws, ' ') AS phrase FROM b)
SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM o JOIN t ON o.lang = t.lang
QUALIFY rank <= 2000
"""


@query("op13_collocations", OP13_SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))
