"""Large JSON documents read by byte ranges: the elements of named arrays as rows, whatever their layout.

Spark's text reader cuts a file into ranges at a separator that JSON only has after a value (`}` or `]]`), so a range
begins in a string or between tokens, but never behind a backslash.  What lies before a range is not known to its task.  A first
pass therefore sums up each range for both beginnings, in a string and not: the brackets that it closes beyond its own,
and those that it leaves open with the names of their members.  These sums are composed in file order (a few rows per
range), which gives every range the path that it begins in.  The second pass finds elements by that path; an element that
ends in a later range leaves as pieces, which one aggregate joins.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boundaryspark.runtime import materialize

#: Bytes that a task takes apart at once.
BLOCK = 4 << 20
_BRACKET = np.zeros(256, np.int8)
_BRACKET[[*b"[{"]] = 1
_BRACKET[[*b"]}"]] = -1
_SPACE = b" \t\r\n"

#: An open bracket: whether it is an object, and the name under which an object holds it ("" in arrays, None if unknown).
Open = tuple[bool, str | None]


def structure(data: np.ndarray, in_string: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of the quotes that begin or end strings, of the brackets outside strings, and whether the bytes end in a string."""
    quotes = np.flatnonzero(data == 0x22)
    slash = data == 0x5C
    if len(quotes) and slash.any():
        plain = np.maximum.accumulate(np.where(slash, -1, np.arange(len(data))))
        run = quotes - 1 - np.where(quotes > 0, plain[quotes - 1], -1)
        quotes = quotes[run % 2 == 0]
    brackets = np.flatnonzero(_BRACKET[data])
    brackets = brackets[(np.searchsorted(quotes, brackets) + in_string) % 2 == 0]
    return quotes, brackets, bool((len(quotes) + in_string) % 2)


def name_before(raw: bytes, quotes: np.ndarray, place: int) -> str | None:
    """Name of the member whose value begins at `place`; "" for an element of an array, None if the name began before these bytes."""
    at = place - 1
    while at >= 0 and raw[at] in _SPACE:
        at -= 1
    if at < 0 or raw[at] != 0x3A:
        return "" if at >= 0 else None
    last = int(np.searchsorted(quotes, at)) - 1
    if last < 1:
        return None
    try:
        return json.loads(raw[quotes[last - 1]:quotes[last] + 1].decode("utf-8", "replace"))
    except ValueError:
        return None


def sum_up(raw: bytes, in_string: bool) -> tuple[int, list[Open], bool]:
    """Brackets closed beyond those opened, the ones left open, and whether the bytes end in a string."""
    data = np.frombuffer(raw, np.uint8)
    quotes, brackets, ends = structure(data, in_string)
    step = _BRACKET[data[brackets]]
    depth = np.cumsum(step, dtype=np.int64)
    # a bracket stays open if the depth never falls below its own again
    later = np.minimum.accumulate(depth[::-1])[::-1]
    left = [(raw[p] == 0x7B, name_before(raw, quotes, p)) for p in brackets[(step > 0) & (depth <= later)].tolist()]
    return -min(0, int(depth.min(initial=0))), left, ends


class Elements:
    """Finds elements in the blocks of one range that begins under the path `stack`."""

    def __init__(self, patterns: list[tuple[str, ...]], stack: list[Open], in_string: bool) -> None:
        self.patterns, self.stack, self.depth, self.in_string = patterns, list(stack), len(stack), in_string
        self.limits: dict[str | None, int] = {}
        for p in patterns:
            self.limits[p[0]] = max(self.limits.get(p[0], 0), len(p) + 1)
        # depth of the element that these bytes are in, which may have begun in an earlier range
        self.inside = next((d for d in range(2, len(stack) + 1) if self.matched(d) is not None), None)
        self.begun: tuple[int, str | None] | None = None
        self.piece: list[bytes] = []

    def matched(self, depth: int) -> int | None:
        """Number of the pattern that the first `depth` open brackets fulfil."""
        for k, p in enumerate(self.patterns):
            if len(p) + 1 == depth and all(w in ("*", n) for w, (_, n) in zip(p, self.stack[1:depth], strict=True)):
                return k
        return None

    def feed(self, raw: bytes) -> Iterator[tuple[str, int | None, str | None, bytes]]:
        """(kind, pattern, member name, bytes) of whole elements, and of the end of one that began in an earlier range."""
        data = np.frombuffer(raw, np.uint8)
        quotes, brackets, self.in_string = structure(data, self.in_string)
        step = _BRACKET[data[brackets]]
        depth = np.cumsum(step, dtype=np.int64) + self.depth
        reach = depth + (step < 0)  # depth that a bracket opens or closes
        closers: dict[int, np.ndarray] = {}
        within: dict[int, np.ndarray] = {}

        def following(known: dict[int, np.ndarray], level: int, rule, at: int) -> int:
            if level not in known:
                known[level] = np.flatnonzero(rule())
            k = int(np.searchsorted(known[level], at))
            return int(known[level][k]) if k < len(known[level]) else len(brackets)
        start, at = 0, 0
        while at < len(brackets):
            if self.inside is not None:
                level = self.inside
                at = following(closers, level, lambda level=level: (step < 0) & (reach == level), at)
                if at == len(brackets):
                    break
                end = int(brackets[at]) + 1
                self.piece.append(raw[start:end])
                yield ("whole", *self.begun, b"".join(self.piece)) if self.begun else ("end", None, None, b"".join(self.piece))
                del self.stack[level - 1:]
                self.inside, self.begun, self.piece, at = None, None, [], at + 1
                continue
            # brackets farther from the top than any pattern under this member matter to none
            limit = self.limits.get(self.stack[1][1], 2) if len(self.stack) > 1 else 2
            at = following(within, limit, lambda limit=limit: reach <= limit, at)
            if at == len(brackets):
                break
            place, level = int(brackets[at]), max(int(reach[at]), 1)
            del self.stack[level - 1:]
            if step[at] > 0:
                held = bool(self.stack) and self.stack[-1][0]
                self.stack.append((raw[place] == 0x7B, name_before(raw, quotes, place) if held else ""))
                kind = self.matched(level)
                if kind is not None:
                    stars = [n for w, (_, n) in zip(self.patterns[kind], self.stack[1:], strict=True) if w == "*"]
                    self.inside, self.begun, start = level, (kind, stars[0] if stars else None), place
            at += 1
        if self.inside is not None:
            self.piece.append(raw[start:])
        self.depth = int(depth[-1]) if len(brackets) else self.depth

    def rest(self) -> Iterator[tuple[str, int | None, str | None, bytes]]:
        """The piece of an element that goes on in the next range."""
        if self.inside is not None:
            yield ("begin", *self.begun, b"".join(self.piece)) if self.begun else ("middle", None, None, b"".join(self.piece))


def _ranges(batches: Iterator[pa.RecordBatch], separator: bytes) -> Iterator[tuple[str, int, bytes | None]]:
    """(file, first byte, block) of the ranges of a task, and a None after the last block of each."""
    now, held, size = None, [], 0
    for batch in batches:
        for raw, file, start in zip(*(batch.column(c).to_pylist() for c in ("raw", "layer", "start")), strict=True):
            if now != (file, start):
                if now is not None:
                    yield (*now, separator.join([*held, b""]))
                    yield (*now, None)
                now, held, size = (file, start), [], 0
            held.append(raw)
            size += len(raw)
            if size >= BLOCK:
                yield (*now, separator.join(held) + separator)
                held, size = [], 0
    if now is not None:
        yield (*now, separator.join([*held, b""]))
        yield (*now, None)


#: Ranges that a call reads at most: 25 TB at 128 MB each; their paths, under 200 bytes each, go to every task.
MOST_RANGES = 200_000
_SUMS = "layer string, start long, sums string"
_PIECES = "layer string, start long, kind string, pattern int, name string, no long, element binary"


def read_elements(spark: SparkSession, paths: str | list[str], patterns: list[tuple[str, ...]], separator: str = "}") -> DataFrame:
    """(layer, pattern, name, element_no, element): the containers that fulfil a pattern, numbered in each file from 0.

    A pattern names the members from the top down: ("features", "") are the elements of the array `features`, "*" is any name
    (told as `name`), ("transform",) is the value itself.  Elements of arrays that are no arrays or objects are left out.  A
    range without a known beginning, which a changed file or setting between the passes would give, is an error.
    """
    mark = separator.encode()

    def texts() -> DataFrame:
        return spark.read.option("lineSep", separator).text(paths).select(
            F.col("value").cast("binary").alias("raw"), F.col("_metadata.file_path").alias("layer"), F.col("_metadata.file_block_start").alias("start"))

    def first_pass(batches):
        now, ways = None, []

        def done() -> pa.RecordBatch:
            text = json.dumps([[w[0], w[1], w[2]] for w in ways])
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, text)], names=["layer", "start", "sums"])
        for file, start, raw in _ranges(batches, mark):
            if raw is None:
                yield done()
                continue
            if now != (file, start):
                now, ways = (file, start), [(0, [], False), (0, [], True)]
            ways = [_joined(w, sum_up(raw, w[2])) for w in ways]
    sums = materialize(texts().mapInArrow(first_pass, _SUMS), "json-sums")
    if sums.limit(MOST_RANGES + 1).count() > MOST_RANGES:
        raise ValueError(f"more than {MOST_RANGES} ranges: read fewer files at a time")

    def compose(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("start")
        state, out = (0, [], False), []
        for text in rows.column("sums").to_pylist():
            out.append(json.dumps([state[1], state[2]]))
            closed, left, ends = json.loads(text)[int(state[2])]
            state = _joined(state, (closed, left, ends))
        return pa.table({"layer": rows.column("layer"), "start": rows.column("start"), "sums": pa.array(out, pa.string())})
    began = {(r["layer"], r["start"]): r["sums"] for r in sums.groupBy("layer").applyInArrow(compose, _SUMS).collect()}

    def second_pass(batches):
        now, finder, numbers, rows = None, None, [], []

        def batch() -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.binary()]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(columns, names=["layer", "start", "kind", "pattern", "name", "no", "element"])
        for file, start, raw in _ranges(batches, mark):
            if now != (file, start):
                now = (file, start)
                if now not in began:
                    raise ValueError(f"range {now} was not there in the first pass")
                stack, in_string = json.loads(began[now])
                finder, numbers = Elements(patterns, [tuple(x) for x in stack], in_string), [0] * len(patterns)
            for kind, pattern, name, element in (finder.rest() if raw is None else finder.feed(raw)):
                no = None
                if pattern is not None:
                    no = numbers[pattern]
                    numbers[pattern] += 1
                rows.append((file, start, kind, pattern, name, no, element))
            if rows and (raw is None or sum(len(r[6]) for r in rows) >= BLOCK):
                yield batch()
                rows = []
    pieces = materialize(texts().mapInArrow(second_pass, _PIECES), "json-elements")
    counts = pieces.where("pattern is not null").groupBy("layer", "start", "pattern").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("layer", "pattern").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(counts.select("layer", "start", "pattern", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")))
    # pieces of one element: its beginning, the ranges that it fills, its end
    parts = pieces.where("kind <> 'whole'").select("layer", "start", "kind", F.when(F.col("kind") == "begin", F.col("start")).alias("_first"))
    order = Window.partitionBy("layer").orderBy("start", F.col("kind") == "begin")
    owner = parts.withColumn("_owner", F.last("_first", True).over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_first")
    joined = pieces.join(F.broadcast(owner), ["layer", "start", "kind"]).groupBy("layer", F.col("_owner").alias("start")).agg(
        F.array_sort(F.collect_list(F.struct("start", "element"))).alias("_p"), *[F.max(c).alias(c) for c in ("pattern", "name", "no")])
    mended = joined.select("layer", "start", "pattern", "name", "no", F.aggregate(
        "_p", F.lit(b""), lambda a, x: F.concat(a, x["element"])).alias("element"))
    every = pieces.where("kind = 'whole'").select(*mended.columns).unionAll(mended).join(offsets, ["layer", "start", "pattern"])
    return every.select("layer", "pattern", "name", (F.col("no") + F.col("_before")).alias("element_no"), "element")


def _joined(a: tuple[int, list[Open], bool], b: tuple[int, list[Open], bool]) -> tuple[int, list[Open], bool]:
    """Sum of two neighbouring ranges."""
    left = a[1][:max(0, len(a[1]) - b[0])] + [tuple(x) for x in b[1]]
    return a[0] + max(0, b[0] - len(a[1])), left, b[2]
