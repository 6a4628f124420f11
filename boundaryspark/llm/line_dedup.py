"""Line deduplication: a line that many documents hold stays in one of them.

Method: a sharded minimal perfect hash over distinct line hashes.  One aggregate, combined before the shuffle,
counts the documents of every line hash; lines of too few documents can't be dropped, so the index holds
the others.  Each shard (about `SHARD_KEYS` hashes) is built by a task: levels of bits, at each of which the hashes
that fall alone into a place are settled; the rank of a hash's bit is its slot, and arrays by slot hold its
64-bit fingerprint, its count and the largest id.  Documents probe the arrays: a hash that is in no level or whose
fingerprint differs is no repeated line.

Up to `resident` hashes the arrays go to every task (about 21 bytes a hash) and texts are read once and not moved.  Beyond, probes
go to the shards, which are copied as often as their counted probes need, so that a line in a third of all
documents is shared out; a bit table of fixed size keeps back most probes that would find nothing.  Both ways give the same rows.

A line's key has white space [\\x20\\x09-\\x0D] stripped at both ends and A-Z lowered.  Keys are compared by 128-bit hashes.
Edge cases: a null or empty text is one empty line; a document is a row, so a repeated row is a further
document; a null id is smaller than all others, and rows that share the largest id all keep their lines; very
long texts and lines are whole; an empty table gives an empty result.  Other columns are kept; results replace
columns of the same names.
"""

from __future__ import annotations

import struct
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boundaryspark.llm.common import append_columns, broadcast_if_counted, hash_table, table, table_of
from boundaryspark.llm.registry import query
from boundaryspark.runtime import materialize

LEAST_DOCS, LEAST_CHARS = 3, 20
#: Hashes of a shard; slots of the bit levels for each hash.
SHARD_KEYS, ROOM = 1 << 16, 1.5
#: Hashes up to which every task holds the whole index (22 MB).
RESIDENT_KEYS = 1 << 20
#: Probes that one copy of a shard answers.
PROBES = 1 << 20
NO_ID = -(1 << 63)
_SPACE = b" \t\n\x0b\x0c\r"


def line_hashes(raw: bytes, least_chars: int = LEAST_CHARS) -> tuple[list[bytes], list[int], list[bytes]]:
    """Lines of a text, the places of those with long enough keys, and the 128-bit hashes of these keys."""
    lines = raw.split(b"\n")
    places, digests = [], []
    for place, line in enumerate(lines):
        if len(line) < least_chars:
            continue
        key = line.strip(_SPACE).lower()
        if len(key) >= least_chars and (key.isascii() or len(key.decode()) >= least_chars):
            places.append(place)
            digests.append(xxhash.xxh3_128_digest(key))
    return lines, places, digests


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def _level_place(hashes: np.ndarray, prints: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    x = hashes + prints * np.uint64(2 * level + 1)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
    return ((x ^ (x >> np.uint64(28))) % np.asarray(size, np.uint64)).astype(np.int64)


def build_shard(hashes: np.ndarray, prints: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Sizes of the levels, their bits, and the order that brings arrays of these hashes to their slots."""
    sizes, bits, order, left = [], [], [], np.arange(len(hashes))
    while len(left):
        size = -(-int(len(left) * ROOM + 1) // 64) * 64
        place = _level_place(hashes[left], prints[left], len(sizes), size)
        alone = np.bincount(place, minlength=size)[place] == 1
        level = np.zeros(size, bool)
        level[place[alone]] = True
        order.append(left[alone][np.argsort(place[alone])])
        sizes.append(size)
        bits.append(level)
        left = left[~alone]
    if not bits:
        return [], np.zeros(0, np.uint8), left
    return sizes, np.packbits(np.concatenate(bits), bitorder="little"), np.concatenate(order)


class LineIndex:
    """Arrays of some shards, probed for many hashes at once."""

    def __init__(self, shards: list[dict], n_shards: int) -> None:
        depth = max([len(s["sizes"]) for s in shards], default=0)
        self.n_shards = n_shards
        self.sizes, self.first = np.zeros((n_shards, depth), np.int64), np.zeros((n_shards, depth), np.int64)
        at = 0
        for s in shards:
            sizes = np.array(s["sizes"], np.int64)
            self.sizes[s["shard"], :len(sizes)] = sizes
            self.first[s["shard"], :len(sizes)] = at + np.cumsum(sizes) - sizes
            at += int(sizes.sum())

        def joined(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(b"".join(bytes(s[name]) for s in shards), kind)
        self.words = joined("bits", np.uint64)
        self.before = np.cumsum(np.bitwise_count(self.words), dtype=np.int64) - np.bitwise_count(self.words)
        self.prints, self.counts, self.keepers = joined("prints", np.uint64), joined("counts", np.uint32), joined("keepers", np.int64)

    def slots(self, hashes: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Slot of each hash in the arrays, or -1."""
        out = np.full(len(hashes), -1)
        shard, left = ((hashes >> np.uint64(1)) % np.uint64(self.n_shards)).astype(np.int64), np.arange(len(hashes))
        for level in range(self.sizes.shape[1]):
            left = left[self.sizes[shard[left], level] > 0]
            place = self.first[shard[left], level] + _level_place(hashes[left], prints[left], level, self.sizes[shard[left], level])
            word, bit = self.words[place >> 6], (place & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) > 0
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = (self.before[place >> 6] + below)[hit]
            left = left[~hit]
        found = out >= 0
        out[found] = np.where(self.prints[out[found]] == prints[found], out[found], -1)
        return out


def _texts(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))


def _hash_rows(texts: DataFrame, least_chars: int, wanted: bytes | None = None) -> DataFrame:
    """(hash, print, id): each distinct line hash of each row, of those that `wanted` may hold."""
    def send(batches):
        known = table_of(wanted) if wanted is not None else None
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                found = [dict.fromkeys(line_hashes(raw, least_chars)[2]) for raw in part.column(1).to_pylist()]
                columns = [*_halves([d for digests in found for d in digests]), np.repeat(part.column(0).to_numpy(), [len(x) for x in found])]
                if known is not None:
                    keep = known(columns[0])
                    columns = [c[keep] for c in columns]
                yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names=["hash", "print", "id"])
    return texts.mapInArrow(send, "hash long, print long, id long")


def _build(table_of_shard: pa.Table) -> pa.Table:
    h, p = (table_of_shard.column(n).to_numpy().view(np.uint64) for n in ("hash", "print"))
    sizes, bits, order = build_shard(h, p)
    counts = np.minimum(table_of_shard.column("n").to_numpy(), (1 << 32) - 1)
    row = {"shard": table_of_shard.column("shard")[0].as_py(), "sizes": sizes, "bits": bits.tobytes(), "prints": p[order].tobytes(),
           "counts": counts[order].astype(np.uint32).tobytes(), "keepers": table_of_shard.column("keeper").to_numpy()[order].tobytes(),
           "probes": int(table_of_shard.column("n").to_numpy().sum())}
    return pa.table({k: pa.array([v], _SHARD_KINDS[k]) for k, v in row.items()})


_SHARD_KINDS = {"shard": pa.int32(), "sizes": pa.list_(pa.int32()), "bits": pa.binary(), "prints": pa.binary(), "counts": pa.binary(),
                "keepers": pa.binary(), "probes": pa.int64()}
_SHARD_DDL = "shard int, sizes array<int>, bits binary, prints binary, counts binary, keepers binary, probes long"


def line_counts(documents: DataFrame, least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(hash, print, n, keeper) of the lines found in at least `least_docs` documents."""
    sent = _hash_rows(_texts(documents, doc_id, text), least_chars)
    counted = sent.groupBy("hash", "print").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keeper"))
    return counted.where(F.col("n") >= least_docs)


def _shard(n_shards: int) -> Column:
    return (F.shiftrightunsigned("hash", 1) % n_shards).cast("int")


def build_index(counts: DataFrame, n_shards: int) -> DataFrame:
    """One row of arrays for each shard that has hashes."""
    return counts.withColumn("shard", _shard(n_shards)).groupBy("shard").applyInArrow(_build, _SHARD_DDL)


def _without(lines: list[bytes], dropped: np.ndarray, places: list[int]) -> tuple[bytes, int]:
    gone = {place for place, d in zip(places, dropped.tolist(), strict=True) if d}
    return b"\n".join([line for k, line in enumerate(lines) if k not in gone]) if gone else b"\n".join(lines), len(gone)


_FIELDS = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_text", T.StringType())]


def _columns(found: list[tuple[int, int, bytes]]) -> list[pa.Array]:
    return [pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()),
            pa.array([x[2] for x in found], pa.binary()).cast(pa.string())]


def drop_repeated_lines(documents: DataFrame, least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS, resident: int = RESIDENT_KEYS,
                        shard_keys: int = SHARD_KEYS, probes: int = PROBES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows with n_lines (before dropping), n_dropped and kept_text."""
    counts = materialize(line_counts(documents, least_docs, least_chars, doc_id, text), "lines")
    n_keys = counts.count()
    n_shards = -(-n_keys // shard_keys) or 1
    shards = materialize(build_index(counts, n_shards), "line_index")
    if n_keys > resident:
        return _by_shards(documents, counts, shards, n_shards, least_chars, probes, doc_id, text)
    rows = [r.asDict() for r in shards.collect()]
    held: list[LineIndex] = []

    def probe(batch: pa.RecordBatch) -> list[pa.Array]:
        if not held:
            held.append(LineIndex(rows, n_shards))
        index = held[0]
        parsed = [line_hashes(raw, least_chars) for raw in batch.column("_line_raw").to_pylist()]
        ids = np.repeat(batch.column("_line_id").to_numpy(), [len(x[1]) for x in parsed])
        slots = index.slots(*_halves([d for x in parsed for d in x[2]]))
        dropped = slots >= 0
        dropped[dropped] = (index.counts[slots[dropped]] >= least_docs) & (index.keepers[slots[dropped]] != ids[dropped])
        ends = np.cumsum([len(x[1]) for x in parsed])
        out = []
        for (lines, places, _), end in zip(parsed, ends, strict=True):
            kept, gone = _without(lines, dropped[end - len(places):end], places)
            out.append((len(lines), gone, kept))
        return _columns(out)
    return append_columns(_with_raw(documents, doc_id, text), _FIELDS, probe, drop=("_line_id", "_line_raw"))


def _with_raw(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.withColumns({"_line_id": F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)), "_line_raw": F.coalesce(F.col(text), F.lit("")).cast("binary")})


def _by_shards(documents: DataFrame, counts: DataFrame, shards: DataFrame, n_shards: int, least_chars: int, probes: int, doc_id: str, text: str) -> DataFrame:
    """The same rows where the index is too large for a task: probes go to copies of the shards, answers back to the texts."""
    sent = _hash_rows(_texts(documents, doc_id, text), least_chars, hash_table(counts, F.col("hash")))
    sent = sent.withColumn("shard", _shard(n_shards))
    copies = materialize(shards.select("shard", F.ceil(F.col("probes") / probes).cast("int").alias("copies")), "copies")
    sent = sent.join(broadcast_if_counted(copies), "shard").withColumn("copy", F.pmod(F.xxhash64("id", "hash"), F.col("copies")).cast("int"))
    arrays = shards.withColumn("copy", F.explode(F.sequence(F.lit(0), F.ceil(F.col("probes") / probes).cast("int") - 1)))
    # the arrays of a copy come before its probes
    both = arrays.withColumn("kind", F.lit(0)).unionByName(sent.select("shard", "copy", "hash", "print", "id", F.lit(1).alias("kind")), allowMissingColumns=True)
    both = both.select("shard", "copy", "kind", "sizes", "bits", "prints", "counts", "keepers", "hash", "print", "id")

    def answer(batches):
        index = None
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(kind)) + 1).tolist(), len(kind)]
            for a, b in pairwise(cuts if len(kind) else []):
                part = batch.slice(a, b - a)
                if kind[a] == 0:  # copies without probes may follow one another: the last one counts
                    index = LineIndex([part.slice(part.num_rows - 1).select(["shard", "sizes", "bits", "prints", "counts", "keepers"]).to_pylist()[0]], n_shards)
                    continue
                h, p = (part.column(n).to_numpy().view(np.uint64) for n in ("hash", "print"))
                slots, ids = index.slots(h, p), part.column("id").to_numpy()
                drop = slots >= 0
                drop[drop] = index.keepers[slots[drop]] != ids[drop]
                keep = pa.array(drop)
                yield pa.RecordBatch.from_arrays([part.column("id").filter(keep), part.column("hash").filter(keep), part.column("print").filter(keep)],
                                                 names=["id", "hash", "print"])
    told = both.repartition("shard", "copy").sortWithinPartitions("shard", "copy", "kind").mapInArrow(answer, "id long, hash long, print long")
    told = told.distinct().groupBy("id").agg(F.collect_list(F.struct("hash", "print")).alias("_gone")).withColumnRenamed("id", "_told")
    rows = _with_raw(documents, doc_id, text)
    rows = rows.join(told, rows["_line_id"] == told["_told"], "left").drop("_told")

    def rebuild(batch: pa.RecordBatch) -> list[pa.Array]:
        out = []
        for raw, gone in zip(batch.column("_line_raw").to_pylist(), batch.column("_gone").to_pylist(), strict=True):
            lines, places, digests = line_hashes(raw, least_chars)
            away = {struct.pack("<qq", x["hash"], x["print"]) for x in gone or ()}
            dropped = np.array([d in away for d in digests], bool)
            kept, n = _without(lines, dropped, places)
            out.append((len(lines), n, kept))
        return _columns(out)
    return append_columns(rows, _FIELDS, rebuild, drop=("_line_id", "_line_raw", "_gone"))


OP11_SQL = r"""
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a, row_number() OVER () AS r FROM documents),
l AS (SELECT r, doc_id, unnest(a) AS line, unnest(range(len(a))) AS i FROM t),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT r) >= 3),
j AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.keeper AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY r
"""


@query("op11_line_dedup", OP11_SQL)
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
