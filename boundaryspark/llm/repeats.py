"""Repeated byte strings: every byte covered by a string of `length` bytes that also starts elsewhere.

Method: bucket-pointer refinement over sampled suffixes.  With q = length / 4, suffixes get an initial
bucket by their first q bytes.  Of all q-grams of a window of `length` bytes, the one of least hash is its
anchor (content-defined, so equal windows have equal anchors at equal offsets), and a task of Spark holds
whole buckets of one anchor.  There every window whose anchor this is is a suffix, and its bucket is
refined by the bucket pointers q and then 2q bytes later: each level is the pair of two pointers of the
level before, used again for all offsets, and the last level is sorted; a refined bucket of two or more
suffixes is a repeat.  Suffixes are refined only as far as the `length` bytes asked for.

Passes: (1) texts give their anchors with a hash of the bytes of the anchor's windows; anchors whose bytes
all agree with those of another place repeat whole and are settled by counting; (2) texts send the bytes of
the anchors that have places of equal and of other bytes to their bucket; equal bytes in a task meet before
the shuffle, so a passage in a third of all rows sends a row per task; (3) removed ranges come back to
their text.  Which anchors and texts a pass needs is told by bit tables of fixed size; a false
hit costs a row, never a result.  Anchors of more than `hot` occurrences do not meet in one task: each of
their windows becomes a row of its own, counted by an aggregate.  Copies of a whole text are removed whole.

Edge cases: null and empty texts, and texts below `length`, lose nothing; very long texts are worked on in
segments; repeats inside one text count, overlapping ones too; repeated rows are copies and so removed when
long enough.  Other columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boundaryspark.llm.common import hash_table, table, table_of
from boundaryspark.llm.registry import query
from boundaryspark.runtime import materialize

LENGTH = 400
SEGMENT = 1 << 20
HOT = 50_000
CHUNK = 4096
_PLACE = np.uint64((1 << 22) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_SYMBOLS = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    size = 1 << max(12, int(n - 1).bit_length())
    if size not in _POWERS:
        inverse = pow(_BASE, -1, 1 << 64)
        one = np.full(size, _BASE, np.uint64), np.full(size, inverse, np.uint64)
        one[0][0] = one[1][0] = 1
        _POWERS[size] = tuple(np.cumprod(x, dtype=np.uint64) for x in one)
    return _POWERS[size]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def gram_hashes(data: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q bytes at every place along the last axis."""
    n = data.shape[-1]
    power, inverse = _powers(n)
    sums = np.zeros((*data.shape[:-1], n + 1), np.uint64)
    np.cumsum(_SYMBOLS[data] * power[:n], axis=-1, out=sums[..., 1:])
    return mix((sums[..., q:] - sums[..., :-q]) * inverse[:n - q + 1])


def _anchors(grams: np.ndarray, windows: np.ndarray | None, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors (places of the leftmost least of `width` grams) of the given windows (all if None), and the first and
    last start of the windows that have them."""
    n = len(grams)
    keys = (grams & ~_PLACE) | (np.arange(n, dtype=np.uint64) & _PLACE)
    blocks = -(-n // width) * width
    padded = np.full(blocks, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    padded = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n - width + 1], ahead[width - 1:n])
    starts = np.arange(n - width + 1)
    if windows is not None:
        least, starts = least[windows], starts[windows]
    places = starts + ((least & _PLACE).astype(np.int64) - starts) % (1 << 22)
    first = np.flatnonzero(np.diff(places, prepend=-1))
    last = np.append(first[1:], len(places)) - 1
    return places[first], starts[first], starts[last]


def segment_anchors(data: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor hashes, places, first and last start of their windows, starts of windows that repeat in the segment)
    for each segment of a text."""
    q = length // 4
    for first in range(0, max(0, len(data) - length + 1), SEGMENT):
        part = data[first:first + SEGMENT + length - 1]
        grams = gram_hashes(part, q)
        width = length - q + 1
        places, low, high = _anchors(grams, None, width)
        repeated = np.zeros(0, np.int64)
        if len(np.unique(grams[places])) < len(places):
            whole = window_buckets(grams, q, length)
            _, firsts, group, counts = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
            repeated = np.flatnonzero(counts[group] > 1)
            places, low, high = _anchors(grams, np.sort(firsts), width)
        yield grams[places], places + first, low + first, high + first, repeated + first


def window_buckets(grams: np.ndarray, q: int, length: int) -> np.ndarray:
    """Refined bucket of every window: the pointers of one level, now and later, are those of the next."""
    reach = q
    while reach < length:
        step = min(reach, length - reach)
        n = grams.shape[-1] - step
        grams = mix(grams[..., :n] * np.uint64(0xD6E8FEB86659FD93) + grams[..., step:step + n])
        reach += step
    return grams


def _runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Ranges covered by windows at sorted starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length) + 1
    return [(int(s[0]), int(s[-1]) + length) for s in np.split(starts, cut)]


def merged_ranges(ranges: list[tuple[int, int]]) -> list[list[int]]:
    """The union of ranges as ranges apart from each other."""
    merged: list[list[int]] = []
    for start, end in sorted(ranges):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return merged


def _batch(columns: list[list], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _texts(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    content = F.coalesce(F.col(text), F.lit(""))
    return documents.select(F.col(doc_id).alias("doc_id"), F.unhex(F.sha2(content, 256)).alias("key"), content.alias("_text")).withColumn(
        "tid", F.xxhash64("key"))


def _counted(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """Anchors of more than one place with the number of places of equal bytes (`same`); `hash` is null if all places have equal ones.

    Only aggregates, which combine before the shuffle, see all anchors; a bit table then lets the few through that occur again.
    """
    per = anchors.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), (F.min("bytes_hashes") == F.max("bytes_hashes")).alias("alike")).where("n > 1")
    per = materialize(per, "anchor-counts")
    wanted = hash_table(per, F.col("hash"))

    def again(batches):
        known = table_of(wanted)
        for batch in batches:
            yield batch.filter(pa.array(known(batch.column("hash").to_numpy())))
    kept = anchors.mapInArrow(again, anchors.schema)
    kept = materialize(kept.hint("merge").join(per.hint("merge"), "hash"), "anchors")
    mixed = kept.where("not alike")
    same = materialize(mixed.groupBy("hash", "bytes_hashes").agg(F.count(F.lit(1)).alias("same")), "anchor-bytes")
    least = same.groupBy("hash").agg(F.min("same").alias("least"))
    parted = mixed.join(same.join(least, "hash"), ["hash", "bytes_hashes"])
    # places that all have company of equal bytes are settled; the others of an anchor go to their bucket
    every = kept.where("alike").withColumns({"same": F.col("n"), "least": F.col("n")}).select(*parted.columns).unionAll(parted)
    return materialize(every.select("tid", F.when(F.col("least") == 1, F.col("hash")).alias("hash"), "n", "same", "low", "windows"), "anchors")


def find_repeats(documents: DataFrame, length: int = LENGTH, hot: int = HOT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, ranges, n_removed, kept_sha256, text) per row: what is removed, and the hash and the text of what is left.

    `text` replaces bytes that a cut leaves without the rest of their character.
    """
    q = length // 4
    texts = _texts(documents, doc_id, text)

    def first_pass(batches):
        seen: set[bytes] = set()
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                rows = [[] for _ in range(7)]
                for number, key, content in zip(*(whole.column(i).slice(start, 2000) for i in range(3)), strict=True):
                    key, data = key.as_py(), content.as_py().encode("utf-8", "replace")
                    parts = [np.zeros(0, np.int64)] * 4
                    if key not in seen and len(data) >= length:
                        found = list(segment_anchors(np.frombuffer(data, np.uint8), length))
                        parts = [np.concatenate([x[k] for x in found]) for k in (0, 2, 3)]
                        parts[0] = parts[0].view(np.int64)
                        parts.append(np.array([xxhash.xxh3_64_intdigest(data[a:b + length]) - (1 << 63)
                                               for a, b in zip(parts[1].tolist(), parts[2].tolist(), strict=True)], np.int64))
                    seen.add(key)
                    for column, value in zip(rows, (number.as_py(), key, len(data), *parts), strict=True):
                        column.append(value)
                yield _batch(rows, [pa.int64(), pa.binary(), pa.int64(), *[pa.list_(pa.int64())] * 4], first_names)
    first_names = ["doc_id", "key", "n_bytes", "hashes", "lows", "highs", "bytes_hashes"]
    rows = materialize(texts.mapInArrow(first_pass, "doc_id long, key binary, n_bytes long, hashes array<long>, lows array<long>, "
                                                    "highs array<long>, bytes_hashes array<long>"), "texts")
    classes = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.max("n_bytes").alias("n")), "classes")
    # a task sends the anchors of a text once; copies in other tasks count too, and are removed whole anyway
    anchors = rows.select(F.xxhash64("key").alias("tid"), F.inline(F.arrays_zip("hashes", "lows", "highs", "bytes_hashes"))).select(
        "tid", F.col("hashes").alias("hash"), F.col("lows").cast("int").alias("low"),
        (F.col("highs") - F.col("lows")).cast("int").alias("windows"), "bytes_hashes")
    anchors = _counted(rows, anchors)
    settled = anchors.where("same > 1").select("tid", F.col("low").cast("long").alias("start"),
                                               (F.col("low") + F.col("windows") + length).cast("long").alias("end"))
    open_anchors = anchors.where("hash is not null")
    wanted = hash_table(open_anchors, F.col("hash"))
    very_hot = np.array([r[0] for r in open_anchors.where(F.col("n") > hot).select("hash").distinct().collect()], np.int64).view(np.uint64)

    def second_pass(batches):
        seen: set[int] = set()
        known = table_of(wanted)
        met: dict[tuple[int, bytes], tuple | None] = {}
        for batch in batches:
            out = [[] for _ in range(7)]

            def add(kind, place, key, start, end=None, before=None, near=None, out=out):
                for column, value in zip(out, (kind, place, key, start, end, before, near), strict=True):
                    column.append(value)
            for _, _, content, key in zip(*(batch.column(i) for i in range(4)), strict=True):
                key = key.as_py()
                raw = content.as_py().encode("utf-8", "replace")
                if key in seen or len(raw) < length:
                    continue
                seen.add(key)
                data, covered = np.frombuffer(raw, np.uint8), []
                for hashes, places, lows, highs, repeated in segment_anchors(data, length):
                    covered += _runs(repeated, length)
                    keep = known(hashes.view(np.int64))
                    for h, place, low, high in zip(hashes[keep], places[keep].tolist(), lows[keep].tolist(),
                                                   (highs[keep] + length).tolist(), strict=True):
                        if len(very_hot) and h in very_hot:
                            for s, w in enumerate(window_buckets(gram_hashes(data[low:high], q), q, length).view(np.int64).tolist()):
                                add(2, w, key, low + s, low + s + length)
                            continue
                        around = raw[low:high]
                        same = (int(h), hashlib.blake2b(around, digest_size=16).digest())
                        if same in met:  # equal surroundings of another place: all their windows repeat
                            if met[same] is not None:
                                add(1, met[same][0], *met[same])
                                met[same] = None
                            covered.append((low, high))
                        else:
                            if len(met) >= 100_000:
                                met.clear()
                            met[same] = (key, low, high)
                            add(0, int(h.view(np.int64)), key, low, high, place - low, around)
                for a, b in merged_ranges(covered):
                    add(1, key, key, a, b)
                if len(out[0]) >= 4000:
                    yield _batch(out, kinds, names)
                    for column in out:
                        column.clear()
            if out[0]:
                yield _batch(out, kinds, names)
    names = ["kind", "hash", "key", "start", "end", "before", "near"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    schema = "kind int, hash long, key long, start long, end long, before int, near binary"
    sent = texts.mapInArrow(second_pass, schema).repartition("hash").sortWithinPartitions("hash", "key", "start")

    def refine(batches):
        held: list[tuple] = []
        for batch in batches:
            kind = batch.column(0).to_numpy()
            if (kind > 0).any():  # ranges and single windows go on as they are
                yield batch.filter(pa.array(kind > 0)).select([0, 1, 2, 3, 4])
                batch = batch.filter(pa.array(kind == 0))
            held += zip(*(batch.column(i).to_pylist() for i in (1, 2, 3, 5, 6)), strict=True)
            if len(held) >= CHUNK:
                last = held[-1][0]
                cut = len(held)
                while cut and held[cut - 1][0] == last:
                    cut -= 1
                if cut:
                    yield refined(held[:cut])
                    held = held[cut:]
        if held:
            yield refined(held)

    def refined(held: list[tuple]) -> pa.RecordBatch:
        """Ranges of the windows that share their refined bucket with a window of the same anchor."""
        unique = [r for k, r in enumerate(held) if k == 0 or r[:3] != held[k - 1][:3]]
        hashes = np.array([r[0] for r in unique], np.int64)
        alone = np.ones(len(unique), bool)
        alone[1:] &= hashes[1:] != hashes[:-1]
        alone[:-1] &= hashes[:-1] != hashes[1:]
        unique = [r for r, a in zip(unique, alone, strict=True) if not a]
        reach, ids = length - q, []
        for first in range(0, len(unique), 1024):
            part = unique[first:first + 1024]
            bytes_of = np.zeros((len(part), q + 2 * reach), np.uint8)
            for i, (_, _, _, _, near) in enumerate(part):
                bytes_of[i, :len(near)] = np.frombuffer(near, np.uint8)
            found = window_buckets(gram_hashes(bytes_of, q), q, length)
            ids += [found[i, :len(r[4]) - length + 1] for i, r in enumerate(part)]
        out = [[], [], []]
        if ids:
            counts = np.array([len(x) for x in ids])
            flat = np.concatenate(ids)
            order = np.argsort(flat)
            equal = np.zeros(len(flat) + 1, bool)
            equal[1:-1] = flat[order][1:] == flat[order][:-1]
            again = np.empty(len(flat), bool)
            again[order] = equal[1:] | equal[:-1]
            ends = np.cumsum(counts)
            for i in np.flatnonzero(np.logical_or.reduceat(again, ends - counts)):
                _, key, start, _, _ = unique[i]
                for a, b in _runs(np.flatnonzero(again[ends[i] - counts[i]:ends[i]]) + start, length):
                    out[0].append(key)
                    out[1].append(a)
                    out[2].append(b)
        n = len(out[0])
        return _batch([[1] * n, [None] * n, *out], [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()],
                      ["kind", "hash", "key", "start", "end"])
    told = materialize(sent.mapInArrow(refine, "kind int, hash long, key long, start long, end long"), "ranges")
    tid = F.col("key").alias("tid")
    ranges = told.where("kind = 1").select(tid, "start", "end").unionAll(settled)
    if len(very_hot):
        windows = told.where("kind = 2").select("hash", tid, "start", "end").distinct()
        often = windows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        ranges = ranges.unionAll(windows.join(often, "hash").select("tid", "start", "end"))
    alone = classes.where("copies = 1").select(F.xxhash64("key").alias("tid"))
    by_text = ranges.groupBy("tid").agg(F.collect_list(F.struct("start", "end")).alias("ranges")).join(alone, "tid")
    whole = classes.where((F.col("copies") > 1) & (F.col("n") >= length)).select(F.xxhash64("key").alias("tid"), F.array(
        F.struct(F.lit(0).cast("long").alias("start"), F.col("n").alias("end"))).alias("ranges"))
    by_text = materialize(by_text.unionByName(whole), "ranges")
    touched = hash_table(by_text, F.col("tid"))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    out_names = ["doc_id", "n_bytes", "ranges", "n_removed", "kept_sha256", "text"]
    out_kinds = [pa.int64(), pa.int64(), pa.list_(span), pa.int64(), pa.string(), pa.string()]
    out_schema = "doc_id long, n_bytes long, ranges array<struct<start:long,end:long>>, n_removed long, kept_sha256 string, text string"

    def select(wanted: bool):
        def run(batches):
            known = None
            for batch in batches:
                known = known or table_of(touched)
                yield batch.filter(pa.array(known(batch.column("tid").to_numpy()) == wanted))
        return run
    # texts that nothing touches are not moved; a false hit of the table finds no ranges
    untouched = texts.mapInArrow(select(False), texts.schema).select(
        "doc_id", F.octet_length("_text").cast("long").alias("n_bytes"), F.array().cast("array<struct<start:long,end:long>>").alias("ranges"),
        F.lit(0).cast("long").alias("n_removed"), F.lower(F.hex("key")).alias("kept_sha256"), F.col("_text").alias("text"))

    def cut(batches):
        for batch in batches:
            out = [[] for _ in out_names]
            for number, content, spans in zip(*(batch.column(c) for c in ("doc_id", "_text", "ranges")), strict=True):
                raw = content.as_py().encode("utf-8", "replace")
                merged = merged_ranges([(x["start"], x["end"]) for x in spans.as_py() or ()])
                edges = [0, *[x for span in merged for x in span], len(raw)]
                left = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                for column, value in zip(out, (number.as_py(), len(raw), [{"start": a, "end": b} for a, b in merged], len(raw) - len(left),
                                               hashlib.sha256(left).hexdigest(), left.decode("utf-8", "replace")), strict=True):
                    column.append(value)
            yield _batch(out, out_kinds, out_names)
    cut_texts = texts.mapInArrow(select(True), texts.schema).hint("merge").join(by_text.hint("merge"), "tid", "left").select("doc_id", "_text", "ranges")
    return untouched.unionByName(cut_texts.mapInArrow(cut, out_schema))


@query("op9_repeats")
def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("ranges").cast("long").alias("n_spans"), "kept_sha256", "text")
