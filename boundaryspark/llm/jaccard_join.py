"""N-gram Jaccard self-join of texts: exact links and their connected components.

Method: size-banded tiles with hashed bitmap signatures.  A tile holds the texts that share one rare
shingle: of a set of n, two sets that reach the threshold share a shingle among their
n - ceil(t * n) + 1 first ones in any common order, here rarest first by counts over all texts in a table of
fixed size (the order steers cost, never results).  In a tile, texts stand by set size, and each meets only
the band of sizes that the threshold leaves.  Bitmaps of hashed shingles bound the overlap from above: a bit is
the parity of the shingles hashed to it, so each bit in which two bitmaps differ has a member of the symmetric
difference of its own, and common shingles hide none.  What passes the bound is verified by intersecting the
sorted shingle arrays.

Only links between texts not yet known to be connected are looked for, which the components cannot
lose: first, texts of like size that share a least shingle hash meet in tiles with their arrays, where all
pairs are decided and a spanning forest of verified links is left; then only tiles with texts of several
components are worked on, and of them only pairs across components that met in no tile of the first kind.
A group of thousands of near copies so costs links along a tree instead of all pairs.  A first tile of more
than `TILE` texts is dealt into runs by hashes of key and text, each a group of its own in the shuffle; then one text
of every component of a run meets those of the other runs of its key in tiles of the same kind, and what pairs of
different runs are left go to the second kind.  A task holds the arrays of one run, which ends at `TILE` texts or
`RUN_BYTES`.  A second tile of more than `tile` texts is divided into blocks and pairs of blocks.  Both are exact.

Sets that are equal are one node, so copies are not expanded.  Shingles and sets are held as 64-bit hashes.

Edge cases: words split at [\\x20\\x09-\\x0D] after A-Z is lower-cased; fewer words than a shingle make one
shingle, no words (null or empty texts too) an empty set that links with nothing; an id that repeats counts
once per text; a null id takes part, and a component of null ids only has a null id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boundaryspark.llm.common import broadcast_if_counted, connected_components, hash_table, table, table_of
from boundaryspark.llm.registry import query
from boundaryspark.runtime import materialize

COUNT_BITS = 17
KEYS = 2
TILE = 2048
RUN_BYTES = 64 * 1024 * 1024
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_KEY_SALTS = np.array([0x0, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)


class WordHashes(dict):
    """Hash of each word; starts anew when full, so a task's memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str, size: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    words = text.encode("utf-8", "replace").lower().split()
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if len(hashes) == 0:
        return hashes
    width = min(size, len(hashes))
    out = hashes[:len(hashes) - width + 1].copy()
    for k in range(1, width):
        out = _mix(out * _MULTIPLIER + hashes[k:len(hashes) - width + 1 + k])
    return np.unique(_mix(out + np.uint64(width)))


def bitmap_of(members: np.ndarray, per_member: int = 1) -> np.ndarray:
    """Signature of at least `per_member` bits for each member, a power of two from 64 up, as 64-bit words.

    A bit is the parity of the members hashed to it, so that members which two sets share cancel out.
    """
    bits = max(64, per_member << int(len(members) - 1).bit_length())
    place = (members >> np.uint64(20)) & np.uint64(bits - 1)
    out = (np.bincount(place.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(out, bitorder="little").view(np.uint64)


def node_of(members: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(members.tobytes()) - (1 << 63)


class Components:
    """Union-find over the rows of a tile."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


class Band:
    """Texts of a tile by set size with their bitmaps, and which of them may reach the threshold with one of them."""

    def __init__(self, sizes: np.ndarray, bitmaps: list[np.ndarray], percent: int) -> None:
        self.sizes, self.percent = sizes, percent
        self.words = np.array([len(b) for b in bitmaps])
        self.rows: dict[int, np.ndarray] = {}
        widest = {}
        for width in np.unique(self.words):
            # rows of this width and, folded, of twice the width; sizes of a band span no more
            block = np.zeros((len(bitmaps), width), np.uint64)
            for i in np.flatnonzero((self.words == width) | (self.words == 2 * width)):
                b = bitmaps[i]
                block[i] = b if len(b) == width else b[:width] ^ b[width:]
            widest[int(width)] = block
        self.rows = widest

    def partners(self, i: int) -> np.ndarray:
        """Places after i whose size and bitmap leave the threshold within reach."""
        n = int(self.sizes[i])
        high = int(np.searchsorted(self.sizes, n * 100 // self.percent, side="right"))
        if high <= i + 1:
            return np.zeros(0, np.int64)
        block = self.rows[int(self.words[i])]
        apart = np.bitwise_count(block[i + 1:high] ^ block[i]).sum(axis=1, dtype=np.int64)
        total = self.sizes[i + 1:high] + n
        return i + 1 + np.flatnonzero((100 + self.percent) * apart <= (100 - self.percent) * total)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common > 0 and 100 * common >= percent * (len(a) + len(b) - common)


def _groups(batches, columns: int, target: int = 1024):
    """Rows of a sorted stream in pieces that end where the first column changes."""
    held: list[tuple] = []
    for batch in batches:
        held += zip(*(batch.column(i).to_pylist() for i in range(columns)), strict=True)
        if len(held) >= target:
            cut = len(held)
            while cut and held[cut - 1][0] == held[-1][0]:
                cut -= 1
            if cut:
                yield held[:cut]
                held = held[cut:]
    if held:
        yield held


def _tiles(rows: list[tuple]):
    start = 0
    for k in range(1, len(rows) + 1):
        if k == len(rows) or rows[k][0] != rows[start][0]:
            if k - start > 1:
                yield rows[start:k]
            start = k


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _first_hashes(members: np.ndarray) -> list[int]:
    """Keys of the first tiles: the least member under each of a few fixed orders, with the band of sizes."""
    size = np.log(len(members)) / np.log(1.5)
    least = np.array([_mix(members ^ salt).min() for salt in _KEY_SALTS[:KEYS]], np.uint64)
    # like sizes at the edge of one band share another
    bands = np.array([int(size + k / KEYS) * KEYS + k for k in range(KEYS)], np.uint64)
    return _mix(_mix(least) + bands * _MULTIPLIER).view(np.int64).tolist()


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """First pass: (doc_id, text_hash, node, n, keys, bitmap) of every text and, once per task, counts of hashed shingles."""
    def run(batches):
        known, counts = WordHashes(), np.zeros(1 << COUNT_BITS, np.int64)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int32(), pa.binary()]
        names = ["doc_id", "text_hash", "node", "n", "keys", "bitmap", "slice", "counts"]
        for batch in batches:
            out = [[] for _ in range(6)]
            for number, content, text_hash in zip(*(batch.column(i) for i in range(3)), strict=True):
                members = shingle_set(content.as_py() or "", size, known)
                counts += np.bincount((members >> np.uint64(64 - COUNT_BITS)).astype(np.int64), minlength=len(counts))
                row = (node_of(members), len(members), _first_hashes(members), bitmap_of(members).tobytes()) \
                    if len(members) else (None, 0, [], None)
                row = (number.as_py(), text_hash.as_py(), *row)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            empty = [None] * len(out[0])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([*out, empty, empty], kinds, strict=True)], names=names)
        if counts.any():
            parts = np.split(counts, 16)
            rows = [*[[None] * 16] * 6, list(range(16)), [p.tobytes() for p in parts]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=names)
    return texts.mapInArrow(run, "doc_id long, text_hash long, node long, n long, keys array<long>, bitmap binary, slice int, counts binary")


def _shingle_counts(sets: DataFrame) -> np.ndarray:
    """Occurrences by hashed shingle, a table of 2^COUNT_BITS numbers."""
    def add(key, frame):
        import pandas as pd
        total = sum(np.frombuffer(x, np.int64) for x in frame["counts"])
        return pd.DataFrame({"slice": [key[0]], "counts": [total.tobytes()]})
    parts = sets.where("slice is not null").select("slice", "counts").groupBy("slice").applyInPandas(add, "slice int, counts binary")
    total = np.zeros((16, (1 << COUNT_BITS) // 16), np.int64)
    for row in parts.collect():
        total[row["slice"]] = np.frombuffer(row["counts"], np.int64)
    return np.minimum(total.ravel(), np.iinfo(np.int32).max).astype(np.int32)


def _run_links(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the texts of a run, given as (n, node, members) by size."""
    members = [np.frombuffer(r[2], np.uint64) for r in rows]
    band = Band(np.array([r[0] for r in rows]), [bitmap_of(m, 16) for m in members], percent)
    parts, links = Components(len(rows)), []
    for i in range(len(rows)):
        for j in band.partners(i).tolist():
            if parts.find(i) != parts.find(j) and linked(members[i], members[j], percent):
                parts.join(i, j)
                links.append((rows[i][1], rows[j][1]))
    return links


class Runs:
    """Runs of the texts that share a key and part, from rows in the order of key, part, n and node: the arrays of one run are held."""

    def __init__(self, percent: int, first: int) -> None:
        self.percent, self.first = percent, first
        self.at, self.number, self.held, self.bytes = None, 0, [], 0

    def add(self, at: tuple[int, int], n: int, node: int, members: bytes) -> list[tuple[int, int, int, int]]:
        """Takes a row; gives (kind, key, a, b) of the run that ends before it."""
        if at == self.at and self.held and self.held[-1][1] == node:
            return []
        out = []
        if at != self.at or len(self.held) >= self.first or self.bytes >= RUN_BYTES:
            out = self.end()
            self.number = self.number + 1 if at == self.at else 0
            self.at, self.held, self.bytes = at, [], 0
        self.held.append((n, node, members))
        self.bytes += len(members)
        return out

    def end(self) -> list[tuple[int, int, int, int]]:
        if len(self.held) < 2:
            return []
        run = xxhash.xxh3_64_intdigest(repr((self.at, self.number))) - (1 << 63)
        return [*((1, 0, a, b) for a, b in _run_links(self.held, self.percent)), *((2, self.at[0], r[1], run) for r in self.held)]


def _rows_of(found: list[tuple[int, int, int, int]]) -> list[np.ndarray]:
    kind, *others = np.array(found, np.int64).reshape(-1, 4).T
    return [kind.astype(np.int32), *others]


def _split_keys(nodes: DataFrame, shared: DataFrame, first: int) -> DataFrame | None:
    """(key, parts) of the keys that more than `first` sets hold, a written table; None if there are none."""
    hot = materialize(shared.where(F.col("held") > first).select("key"), "hot")
    if hot.isEmpty():
        return None
    held = nodes.select("node", F.explode("keys").alias("key")).join(broadcast_if_counted(hot), "key").groupBy("key").agg(
        F.count_distinct("node").alias("held"))
    parts = materialize(held.where(F.col("held") > first).select("key", F.ceil(F.col("held") / first).cast("int").alias("parts")), "split")
    return None if parts.isEmpty() else parts


def _meet_again(reps: DataFrame, percent: int, first: int) -> DataFrame:
    """Links and runs, as of the second pass, of (key, n, node, members) of one text for every component of a run."""
    def run(batches):
        runs = Runs(percent, first)
        names = ["kind", "key", "a", "b"]
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                key, n, node, members = (x.as_py() for x in row)
                found = runs.add((key, -1), n, node, members)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in _rows_of(found)], names=names)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in _rows_of(runs.end())], names=names)
    return reps.repartition("key").sortWithinPartitions("key", "n", "node").mapInArrow(run, "kind int, key long, a long, b long")


def _candidates(tiles: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in a tile that met in no first tile, as sizes and bitmaps let through."""
    def run(batches):
        for rows in _groups(batches, 6):
            out = set()
            for tile in _tiles(rows):
                labels, met = np.array([r[3] for r in tile]), [set(r[5] or ()) for r in tile]
                band = Band(np.array([r[1] for r in tile]), [np.frombuffer(r[4], np.uint64) for r in tile], percent)
                for i in range(len(tile)):
                    partners = band.partners(i)
                    for j in partners[labels[partners] != labels[i]].tolist():
                        if met[i].isdisjoint(met[j]):
                            out.add((min(tile[i][2], tile[j][2]), max(tile[i][2], tile[j][2])))
            if out:
                yield _pairs(sorted(out))
    return tiles.repartition("tile").sortWithinPartitions("tile", "n", "node").mapInArrow(run, "a long, b long")


def _members(texts: DataFrame, wanted: bytes, size: int) -> DataFrame:
    """(node, members) of the texts whose hashes the table holds, once per task."""
    def run(batches):
        known, in_table, seen = WordHashes(), table_of(wanted), set()
        for whole in batches:
            batch = whole.filter(pa.array(in_table(whole.column(2).to_numpy())))
            out = [[], []]
            for content in batch.column(1):
                members = shingle_set(content.as_py() or "", size, known)
                node = node_of(members)
                if len(members) and node not in seen:
                    seen.add(node)
                    out[0].append(node)
                    out[1].append(members.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary())], names=["node", "members"])
    return texts.mapInArrow(run, "node long, members binary")


def _second_pass(texts: DataFrame, counts: np.ndarray, wanted: bytes, split: DataFrame | None, size: int, percent: int,
                 first_tile: int) -> DataFrame:
    """What the texts that share a key give: kind 0 (key a token, a node, b its size) for each text of a token that
    several sets have among their first shingles; kind 1 (a, b) links of the first tiles; kind 2 (key a tile, a node,
    b the run of a first tile in which it met others)."""
    rarity, names = counts.tobytes(), ["key", "n", "node", "members"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]

    def send(batches):
        known, in_table, seen, order = WordHashes(), table_of(wanted), set(), np.frombuffer(rarity, np.int32)
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                tokens, nodes, numbers, tiles = [], [], [], [[], [], [], []]
                for content in whole.column(1).slice(start, 2000):
                    members = shingle_set(content.as_py() or "", size, known)
                    n, node = len(members), node_of(members)
                    if n == 0 or node in seen:
                        continue
                    seen.add(node)
                    prefix = n - -(-percent * n // 100) + 1
                    seldom = order[(members >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
                    first = np.lexsort((members, seldom))[:prefix]
                    tokens.append(members[first].view(np.int64))
                    nodes.append(np.full(len(first), node))
                    numbers.append(np.full(len(first), n, np.int32))
                    keys = np.array(_first_hashes(members))
                    for key in keys[in_table(keys)].tolist():
                        for column, value in zip(tiles, (key, n, node, members.tobytes()), strict=True):
                            column.append(value)
                if tokens:
                    columns = [np.concatenate(x) for x in (tokens, numbers, nodes)]
                    yield pa.RecordBatch.from_arrays([*[pa.array(c, k) for c, k in zip(columns, kinds, strict=False)],
                                                      pa.nulls(len(columns[0]), pa.binary())], names=names)
                if tiles[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(tiles, kinds, strict=True)], names=names)

    def meet(batches):
        runs, last, last_shared = Runs(percent, first_tile), None, False
        for batch in batches:
            keys, numbers, nodes, parts = (batch.column(i).to_numpy() for i in range(4))
            plain = ~batch.column(4).is_valid().to_numpy(zero_copy_only=False)
            found = []
            for i in np.flatnonzero(~plain).tolist():
                found += runs.add((int(keys[i]), int(parts[i])), int(numbers[i]), int(nodes[i]), batch.column(4)[i].as_py())
            out = [_rows_of(found)]
            if plain.any():
                token = [y[plain].astype(np.int64) for y in (keys, nodes, numbers)]
                if last is not None:
                    token = [np.append(x, y) for x, y in zip(last, token, strict=True)]
                new = np.ones(len(token[0]), bool)  # sorted, so copies of a set sent by several tasks are neighbours
                new[1:] = (token[0][1:] != token[0][:-1]) | (token[1][1:] != token[1][:-1])
                token = [x[new] for x in token]
                same = token[0][1:] == token[0][:-1]
                shared = np.append(last_shared, same) | np.append(same, False)
                # whether the last row has a neighbour is known when the next batch comes
                last, last_shared = tuple(x[-1:] for x in token), bool(shared[-1])
                keep = np.flatnonzero(shared[:-1])
                out.append([np.zeros(len(keep), np.int32), *(x[keep] for x in token)])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[k] for o in out])) for k in range(4)], names=["kind", "key", "a", "b"])
        out = [_rows_of(runs.end())]
        if last_shared:
            out.append([np.zeros(1, np.int32), *last])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[k] for o in out])) for k in range(4)], names=["kind", "key", "a", "b"])
    sent = texts.mapInArrow(send, "key long, n int, node long, members binary")
    if split is None:
        sent = sent.withColumn("part", F.lit(0))
    else:
        dealt = F.pmod(F.xxhash64("key", "node"), F.coalesce("parts", F.lit(1))).cast("int")
        sent = sent.join(broadcast_if_counted(split), "key", "left").withColumn("part", F.when(F.col("members").isNotNull(), dealt).otherwise(0))
    sent = sent.select("key", "n", "node", "part", "members")
    return sent.repartition("key", "part").sortWithinPartitions("key", "part", F.col("members").isNull(), "n", "node").mapInArrow(
        meet, "kind int, key long, a long, b long")


def join_texts(documents: DataFrame, shingle: int = 4, percent: int = 85, tile: int = TILE,
               doc_id: str = "doc_id", text: str = "text", first_tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, node, n, component) per row, the component being named by a node, and the links (a, b) of nodes
    that connect them.  Equal sets have one node."""
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"),
                             F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_hash"))
    written = materialize(_sets(texts, shingle), "sets")
    rows = written.where("slice is null")
    nodes = rows.where("node is not null")
    counts = _shingle_counts(written)
    keys = nodes.select("node", F.explode("keys").alias("key")).groupBy("key").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("held"))
    shared = materialize(keys.where("low <> high").select("key", "held"), "keys")
    split = _split_keys(nodes, shared, first_tile)
    passed = materialize(_second_pass(texts, counts, hash_table(shared, F.col("key")), split, shingle, percent, first_tile), "met")
    once = nodes.groupBy("node").agg(F.first("bitmap").alias("bitmap"))
    forest = passed.where("kind = 1").select("a", "b")
    labels = materialize(connected_components(forest), "labels")
    linking = passed.where("kind > 0")
    if split is not None:
        # one text of every linked component of a run meets those of the other runs of its key
        runs = passed.where("kind = 2").join(broadcast_if_counted(split.select("key")), "key")
        reps = materialize(runs.join(labels, runs["a"] == labels["node"]).groupBy("key", "b", "component").agg(F.min("a").alias("node"))
                           .select("key", "node").distinct(), "reps")
        hashes = rows.join(reps.select("node").distinct(), "node").select("text_hash")
        arrays = _members(texts, hash_table(hashes, F.col("text_hash")), shingle).groupBy("node").agg(F.first("members").alias("members"))
        reps = reps.join(arrays, "node").select("key", F.expr("cast(octet_length(members) / 8 as int)").alias("n"), "node", "members")
        linking = linking.unionAll(materialize(_meet_again(reps, percent, first_tile), "again"))
        forest = linking.where("kind = 1").select("a", "b")
        labels = materialize(connected_components(forest), "labels")
    met = linking.where("kind = 2").groupBy(F.col("a").alias("node")).agg(F.collect_set("b").alias("met"))
    prefixes = passed.where("kind = 0").select(F.col("key").alias("token"), F.col("a").alias("node"), F.col("b").alias("n"))
    prefixes = prefixes.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    mixed = prefixes.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                          F.count(F.lit(1)).alias("held")).where("low <> high").drop("low", "high")
    tiles = prefixes.join(mixed, "token")
    tiles = tiles.withColumn("parts", F.ceil(F.col("held") / tile).cast("int")).withColumn(
        "part", F.pmod(F.hash("node"), F.col("parts")))
    # a divided tile: every text goes to the pairs of its block with each block
    tiles = tiles.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        F.xxhash64("token", F.least("part", "other"), F.greatest("part", "other")).alias("tile"), "n", "node", "label")
    tiles = tiles.join(once.join(met, "node", "left"), "node").select("tile", "n", "node", "label", "bitmap", "met")
    pairs = materialize(_candidates(tiles, percent).distinct(), "pairs")
    links = forest
    if pairs.limit(1).count():
        ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
        hashes = rows.join(ends, "node").select("text_hash")
        held = materialize(_members(texts, hash_table(hashes, F.col("text_hash")), shingle).groupBy("node").agg(
            F.first("members").alias("members")), "members")
        both = pairs.join(held.withColumnsRenamed({"node": "a", "members": "_a"}), "a").join(
            held.withColumnsRenamed({"node": "b", "members": "_b"}), "b").select("a", "b", "_a", "_b")

        def verify(batches):
            for batch in batches:
                keep = [linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent)
                        for x, y in zip(batch.column(2), batch.column(3), strict=True)]
                yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
        links = materialize(forest.unionAll(both.mapInArrow(verify, "a long, b long")), "links")
    components = materialize(connected_components(links), "components")
    out = rows.select("doc_id", "text_hash", "node", "n").hint("merge").join(components, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    return materialize(out.select("doc_id", "text_hash", "node", "n", "component"), "joined"), links


def keep_one(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `documents` without the further members of each component: the text of the largest set stays,
    then of the smallest id.  Rows with empty sets all stay, and so do rows alike in id and text."""
    joined, _ = join_texts(documents, shingle, percent)
    order = F.struct(-F.col("n"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))
    best = joined.where("component is not null").groupBy("component").agg(
        F.min_by(F.struct("doc_id", "text_hash"), order).alias("best"), F.count(F.lit(1)).alias("members")).where("members > 1")
    dropped = joined.hint("merge").join(best, "component").where(
        ~(F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))))
    dropped = broadcast_if_counted(materialize(dropped.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_gone")).distinct(), "dropped"))
    rows = documents.withColumn("_hash", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    return rows.join(dropped, rows["doc_id"].eqNullSafe(dropped["_id"]) & (rows["_hash"] == dropped["_gone"]), "left_anti").drop("_hash")


@query("op5_jaccard_join")
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined, _ = join_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    least = joined.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    return joined.hint("merge").join(least, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))
