"""Prefix trie of conversations: each distinct beginning is a node with its members, children, leaves and saved bytes.

Method: padded matrices of turn ids.  Conversations are cut into bands of `BAND` turns; a band's rows hang under a root, the
beginning that they share, whose key is the hash of all turns before.  Rows are dealt by range of (root, turns, conversation) into
shards of about `SHARD` rows.  A task holds one shard as a matrix padded to its longest row, orders it by numpy's lexsort, and ORs the
masks of changed columns from left to right: a set place begins a node of that depth, and `reduceat` over these places aggregates
every depth.  Nodes on the first or the last row's path may go on in the next shard: they leave as partial rows that one
aggregate recombines, and what their parts need from one another (children, sums) flows along these paths only.

Sums over subtrees: a node adds (n_convs - 1) times the bytes of its last text, a childless node one leaf.  For conversations of more
than one band, the totals of a deeper root come first and are carried by its least member to the bands above.

Definitions: turns are ordered by turn (null first), ties by role, then by the MD5 digest of the text.  Null role or text is empty.  conv_id % 5
keeps the sign of conv_id.  Rows of a null conv_id belong to no conversation.  Repeated rows are further turns.  Texts
are compared by MD5 digests, turns and beginnings by 64-bit hashes of these.  An empty table gives an empty result, without a
root.  Very long texts only count by bytes; very long conversations are many bands.  Other columns do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boundaryspark.llm.common import broadcast_if_counted, table
from boundaryspark.llm.registry import query
from boundaryspark.llm.repeats import mix
from boundaryspark.runtime import materialize

#: Turns of a band; rows of a shard; conversations rebuilt together, and the turns that a head has at most.
BAND, SHARD = 64, 20_000
FAMILY, HEAD = 5, 8
_PAD = np.iinfo(np.int64).min
_STEP = np.uint64(0x9E3779B97F4A7C15)


def turn_ids(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, id, size): every turn in order, as a hash and the bytes of its text."""
    text, role = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("role"), F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        "conv_id", "turn", role.alias("role"), F.unhex(F.md5(text.cast("binary"))).alias("digest"), F.octet_length(text).cast("long").alias("size"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    # the least long pads matrices, so no turn has it
    return turns.select("conv_id", F.row_number().over(order).alias("place"),
                        F.greatest(F.xxhash64("role", "digest"), F.lit(_PAD + 1)).alias("id"), "size")


def rebuild(turns: DataFrame) -> DataFrame:
    """(conv_id, place, id, size) after the first h turns are those of the first conversation of the family."""
    turns = materialize(turns.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)), "turns")
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = turns.where(F.col("place") <= HEAD).where(F.col("conv_id") % FAMILY == 0).groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("place", "id", "size"))).alias("head"))
    each = turns.groupBy("conv_id").agg(F.first("h").alias("h")).withColumn("base", base)
    each = each.join(heads, "base", "left").select("conv_id", "h", F.slice(F.coalesce("head", F.array()), 1, F.col("h").cast("int")).alias("head"))
    each = materialize(each, "heads")
    own = turns.where(F.col("place") > F.col("h")).join(each.select("conv_id", F.size("head").alias("n")), "conv_id")
    begun = each.select("conv_id", F.inline("head")).select("conv_id", "place", "id", "size")
    return begun.unionAll(own.select("conv_id", (F.col("place") - F.col("h") + F.col("n")).cast("int").alias("place"), "id", "size")).unionAll(
        each.select("conv_id", F.lit(0), F.lit(None).cast("long"), F.lit(0).cast("long")))


def bands(rebuilt: DataFrame, band: int = BAND) -> DataFrame:
    """(conv_id, band, root, ids, sizes): the turns of each band under the hash of all turns before; a conversation that ends with a
    full band has an empty one after it, whose root is its last node."""
    number = F.when(F.col("place") == 0, F.lit(0)).otherwise(F.floor((F.col("place") - 1) / band)).cast("int")
    turns = F.filter(F.array_sort(F.collect_list(F.struct("place", "id", "size"))), lambda t: t["place"] > 0)
    rows = rebuilt.withColumn("band", number).groupBy("conv_id", "band").agg(turns.alias("t")).select(
        "conv_id", "band", F.col("t.id").alias("ids"), F.col("t.size").alias("sizes"))
    last = rows.groupBy("conv_id").agg(F.max(F.struct("band", F.size("ids").alias("n"))).alias("last")).where(F.col("last.n") == band)
    none = F.array().cast("array<long>")
    return rows.unionAll(last.select("conv_id", F.col("last.band") + 1, none, none))


def _fold(ids: np.ndarray, root: int) -> np.ndarray:
    """Keys of the beginnings of one row of turns."""
    return _keys(ids.reshape(1, -1), np.array([root], np.int64))[0]


def _keys(ids: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """Key of the beginning of every length, one more column than turns."""
    keys = np.empty((len(ids), ids.shape[1] + 1), np.uint64)
    keys[:, 0] = roots.view(np.uint64)
    for k in range(ids.shape[1]):
        keys[:, k + 1] = mix(keys[:, k] * _STEP + ids[:, k].view(np.uint64))
    return keys


def with_roots(rows: DataFrame) -> DataFrame:
    """Add the key of each band's root: rows of a conversation of one band have the root of all; others fold their bands in order."""
    def fold(batches):
        conv, root = None, 0
        for batch in batches:
            roots = []
            for c, ids in zip(batch.column("conv_id").to_pylist(), batch.column("ids"), strict=True):
                if c != conv:
                    conv, root = c, 0
                roots.append(root)
                root = int(_fold(np.array(ids.as_py(), np.int64), root)[-1].view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots, pa.int64())], names=[*batch.schema.names, "root"])
    long = rows.where("band > 0").select("conv_id").distinct()
    single = rows.join(long, "conv_id", "left_anti").withColumn("root", F.lit(0).cast("long"))
    # by an expression, so that this shuffle stays whatever adaptive execution makes of the join before it
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folded = rows.join(long, "conv_id", "left_semi").repartition(count, F.xxhash64("conv_id")).sortWithinPartitions("conv_id", "band").mapInArrow(
        fold, "conv_id long, band int, ids array<long>, sizes array<long>, root long")
    return single.unionByName(folded)


_NODE = ("key long, parent_key long, depth long, band_root boolean, beyond boolean, open boolean, low long, n long, parent_low long, children long, "
         "leaves long, saved long, size long, ends string, ends_sha256 string, above array<long>")
_KINDS = {"key": pa.int64(), "parent_key": pa.int64(), "depth": pa.int64(), "band_root": pa.bool_(), "beyond": pa.bool_(), "open": pa.bool_(),
          "low": pa.int64(), "n": pa.int64(), "parent_low": pa.int64(), "children": pa.int64(), "leaves": pa.int64(), "saved": pa.int64(),
          "size": pa.int64(), "ends": pa.string(), "ends_sha256": pa.string(), "above": pa.list_(pa.int64())}


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


_EMPTY_SHA = _sha("")


def shard_nodes(shard: pa.Table, band: int) -> pa.Table:
    """Nodes of the rows of one shard: whole ones, and open ones (on the path of the first or last row), whose figures are
    parts that cover the whole nodes below them in this shard only."""
    conv, number, root = (shard.column(c).to_numpy() for c in ("conv_id", "band", "root"))
    more_leaves, more_saved = (shard.column(c).to_numpy() for c in ("more_leaves", "more_saved"))
    lists = shard.column("ids").combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    width = int(lengths.max(initial=0))
    filled = np.arange(width) < lengths[:, None]
    ids, sizes = np.full((len(conv), width), _PAD), np.zeros((len(conv), width), np.int64)
    ids[filled] = lists.flatten().to_numpy()
    sizes[filled] = shard.column("sizes").combine_chunks().flatten().to_numpy()
    order = np.lexsort((conv, *ids.T[::-1], root))
    conv, number, root, lengths, ids, sizes, filled = (x[order] for x in (conv, number, root, lengths, ids, sizes, filled))
    more_leaves, more_saved = more_leaves[order], more_saved[order]
    keys = _keys(ids, root).view(np.int64)
    rows = len(conv)
    # a change in a column is a change in all columns after it
    changed = np.ones((rows, width + 1), bool)
    changed[1:, 0] = root[1:] != root[:-1]
    changed[1:, 1:] = ids[1:] != ids[:-1]
    np.logical_or.accumulate(changed, axis=1, out=changed)
    texts = np.array([str(c) for c in conv.tolist()], object)
    out: dict[str, list] = {name: [] for name in _KINDS}
    below = None  # of the depth after: first rows, their nodes' sums
    for d in range(width, -1, -1):
        there = lengths >= d
        if not there.any():
            continue
        starts = np.flatnonzero(changed[:, d] & there)
        # rows of a node are next to one another and shorter rows come first, so a node ends where the next row changes
        where = np.flatnonzero(changed[:, d])
        ends_at = np.append(where[1:], rows)[np.searchsorted(where, starts)]
        count = ends_at - starts
        low = np.minimum.reduceat(conv, where)[np.searchsorted(where, starts)]
        extra_leaves, extra_saved = ((np.add.reduceat(x, where)[np.searchsorted(where, starts)]) for x in (more_leaves, more_saved))
        opened = (starts == 0) | (ends_at == rows)
        children, leaves, saved = np.zeros(len(starts), np.int64), extra_leaves.copy(), extra_saved.copy()
        size = sizes[starts, d - 1] if d else np.zeros(len(starts), np.int64)
        if below is not None:
            holder = np.searchsorted(starts, below["starts"], side="right") - 1
            np.add.at(children, holder[~below["open"]], 1)
            # what rows carry from deeper bands is in this depth's sums already
            np.add.at(leaves, holder, below["leaves"] - below["extra_leaves"])
            np.add.at(saved, holder, below["saved"] - below["extra_saved"])
        leaves += ~opened & (children == 0) & (d < band)
        saved += np.where(opened, 0, (count - 1) * size)
        below = {"starts": starts, "open": opened, "leaves": leaves, "saved": saved, "extra_leaves": extra_leaves, "extra_saved": extra_saved}
        finished = np.flatnonzero(lengths == d)
        at = np.searchsorted(finished, starts), np.searchsorted(finished, ends_at)
        ended = [",".join(texts[finished[a:b]]) for a, b in zip(*(x.tolist() for x in at), strict=True)]
        m = len(starts)
        parent_low: list[int | None] = [None] * m
        if d:
            up = np.flatnonzero(changed[:, d - 1])
            parent = np.searchsorted(up, starts, side="right") - 1
            unknown = (up[parent] == 0) | (np.append(up[1:], rows)[parent] == rows)
            parent_low = [None if u else v for v, u in zip(np.minimum.reduceat(conv, up)[parent].tolist(), unknown.tolist(), strict=True)]
        out["key"] += keys[starts, d].tolist()
        out["parent_key"] += keys[starts, d - 1].tolist() if d else [None] * m
        out["depth"] += (number[starts].astype(np.int64) * band + d).tolist()
        out["band_root"] += [d == 0] * m
        out["beyond"] += [d == band] * m
        out["open"] += opened.tolist()
        out["low"] += low.tolist()
        out["n"] += count.tolist()
        out["parent_low"] += parent_low
        out["children"] += children.tolist()
        out["leaves"] += leaves.tolist()
        out["saved"] += saved.tolist()
        out["size"] += size.tolist()
        out["ends"] += [e if o else None for e, o in zip(ended, opened.tolist(), strict=True)]
        out["ends_sha256"] += [None if o else _sha(e) if e else _EMPTY_SHA for e, o in zip(ended, opened.tolist(), strict=True)]
        out["above"] += [keys[s, :d].tolist() if o else None for s, o in zip(starts.tolist(), opened.tolist(), strict=True)]
    return pa.table({name: pa.array(out[name], kind) for name, kind in _KINDS.items()})


def _hash_ends(batches):
    """SHA-256 of the pieces of each key, which arrive in order."""
    key, digest, first = None, None, True
    for batch in batches:
        found = []
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    found.append((key, digest.hexdigest()))
                key, digest, first = k, hashlib.sha256(), True
            digest.update(piece.encode() if first else b"," + piece.encode())
            first = False
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int64()), pa.array([h for _, h in found])], names=["key", "sha"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([digest.hexdigest()])], names=["key", "sha"])


def trie_of_bands(rows: DataFrame, band: int, shard: int) -> DataFrame:
    """Node rows of written band rows: key, parent_key, depth, band_root, beyond, size, low, n, parent_low, children, leaves, saved, ends_sha256.
    Rows `beyond` are the last nodes of full bands, which the next band gives as its roots; the bytes of their text count here."""
    n = rows.count()

    def nodes(batches):
        held = list(batches)
        if held:
            whole = pa.Table.from_batches(held)
            if whole.num_rows:
                yield from shard_nodes(whole, band).to_batches()
    made = materialize(rows.repartitionByRange(max(1, -(-n // shard)), "root", "ids", "conv_id").mapInArrow(nodes, _NODE), "trie_parts")
    parts = made.where("open")
    pieces = parts.where("ends <> '' and not beyond").select("key", "ends", F.substring_index("ends", ",", 1).cast("long").alias("first"))
    ends = pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hash_ends, "key long, sha string")
    # the last node of a full band and the root of the next have one key
    merged = parts.groupBy("key", "beyond").agg(*[F.first(c).alias(c) for c in ("parent_key", "depth", "band_root", "size", "above")], F.min("low").alias("low"),
                                      *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")])
    merged = materialize(merged, "trie_open")
    open_children = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("open_children"))
    merged = merged.join(open_children, "key", "left").withColumn("children", F.col("children") + F.coalesce("open_children", F.lit(0)))
    # open nodes below give to all above them what no shard could know: their own bytes, and that they are childless
    takers = F.when(F.col("beyond"), F.col("above")).otherwise(F.concat("above", F.array("key")))
    given = merged.select(F.explode(takers).alias("key"), F.when((F.col("children") == 0) & ~F.col("beyond"), 1).otherwise(0).alias("leaf"),
                          ((F.col("n") - 1) * F.col("size")).alias("bytes"))
    given = given.groupBy("key").agg(F.sum("leaf").alias("leaf"), F.sum("bytes").alias("bytes"))
    lows = merged.where("not beyond").select(F.col("key").alias("parent_key"), F.col("low").alias("up"))
    whole = merged.join(given, "key", "left").join(ends, "key", "left").join(lows, "parent_key", "left").select(
        "key", "parent_key", "depth", "band_root", "beyond", "size", "low", "n", F.col("up").alias("parent_low"), "children",
        (F.col("leaves") + F.coalesce("leaf", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("bytes", F.lit(0))).alias("saved"),
        F.coalesce("sha", F.lit(_EMPTY_SHA)).alias("ends_sha256"))
    under_open = F.col("parent_low").isNull() & F.col("parent_key").isNotNull()
    closed = made.where("not open").select(*whole.columns)
    joined = closed.where(under_open).drop("parent_low").join(broadcast_if_counted(materialize(lows, "trie_lows")), "parent_key")
    return whole.unionAll(closed.where(~under_open)).unionAll(joined.withColumnRenamed("up", "parent_low").select(*whole.columns))


def conversation_trie(conversations: DataFrame, band: int = BAND, shard: int = SHARD) -> DataFrame:
    """One row per node of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256."""
    rows = materialize(with_roots(materialize(bands(rebuild(turn_ids(conversations)), band), "bands")), "band_rows")
    none = F.lit(0).cast("long")
    last = rows.agg(F.max("band")).first()[0] or 0
    if last:
        # totals of deeper roots, by their least member, for all bands above
        deep = trie_of_bands(rows.where("band > 0").withColumns({"more_leaves": none, "more_saved": none}), band, shard)
        deep = deep.where("band_root and (leaves > 0 or saved > 0)").select(
            F.col("low").alias("conv_id"), (F.col("depth") / band).cast("int").alias("_band"), "leaves", "saved")
        lifted = deep.select("conv_id", F.explode(F.sequence(F.lit(0), F.col("_band") - 1)).alias("band"), "leaves", "saved").groupBy("conv_id", "band").agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        rows = rows.join(materialize(lifted, "lifted"), ["conv_id", "band"], "left").withColumns({
            "more_leaves": F.coalesce("more_leaves", none), "more_saved": F.coalesce("more_saved", none)})
    else:
        rows = rows.withColumns({"more_leaves": none, "more_saved": none})
    nodes = trie_of_bands(rows, band, shard)
    if last:
        nodes = materialize(nodes, "trie_nodes")
        links = nodes.where("beyond").select("key", F.col("parent_low").alias("up"), F.col("size").alias("last"))
        nodes = nodes.where("not beyond").join(links, "key", "left").withColumns({
            "parent_low": F.coalesce("parent_low", "up"), "saved": F.col("saved") + (F.col("n") - 1) * F.coalesce("last", none)})
    return nodes.where("not beyond").select(F.col("low").alias("conv_id"), "depth", F.col("parent_low").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                                            F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256")


OP12_SQL = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT conv_id, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda a, b: list_reduce([xor(a, b)] || range(8)::BIGINT[],
      lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
a AS (SELECT h.conv_id, 0 AS own, t.i, t.role, t.text FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % 5 AND t.i <= h.h
  UNION ALL SELECT h.conv_id, 1, t.i, t.role, t.text FROM h JOIN t ON t.conv_id = h.conv_id AND t.i > h.h),
c AS (SELECT h.conv_id, coalesce(list({'r': a.role, 't': a.text} ORDER BY a.own, a.i) FILTER (a.role IS NOT NULL), []) AS s
  FROM h LEFT JOIN a ON h.conv_id = a.conv_id GROUP BY h.conv_id),
e AS (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM c),
n AS (SELECT s[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(s) = d), '') AS ends FROM e GROUP BY s[1:d], d),
k AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children, CASE WHEN n.d > 0 THEN strlen(n.p[n.d].t) ELSE 0 END AS size
  FROM n LEFT JOIN k ON n.d = k.d AND n.p = k.p),
u AS (SELECT a.p, a.d, sum((b.n_convs - 1) * b.size)::BIGINT AS saved, count(*) FILTER (b.n_children = 0) AS leaves
  FROM m a JOIN m b ON b.d >= a.d AND b.p[1:a.d] = a.p GROUP BY ALL)
SELECT m.conv_id, m.d AS depth, o.conv_id AS parent_conv_id, m.n_convs, m.n_children, u.leaves AS n_leaves, u.saved AS saved_tokens,
  sha256(m.ends) AS ends_sha256
FROM m JOIN u ON m.d = u.d AND m.p = u.p LEFT JOIN m o ON o.d = m.d - 1 AND o.p = m.p[1:m.d - 1]
"""


@query("op12_conversation_trie", OP12_SQL)
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
