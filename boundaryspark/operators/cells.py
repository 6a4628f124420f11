"""Pairs of rows that meet in grid cells, whatever is crowded.

Cells with few pairs are one join key.  A crowded cell becomes a quadtree (over one axis: a binary tree): a row belongs to the deepest
level whose parts are at least as wide as the row, so it lies in at most two parts along an axis.  A pair meets at the lesser level of the
two, in the one part that holds the lower corner of what they have in common.  Wide rows thus stay whole instead of being
repeated in every part, and narrow ones never meet those of other parts.  What is still crowded (many wide rows) is cut into blocks of
left times right rows, each pair in one block, so that no task has more than about `PAIRS_PER_CELL` pairs of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boundaryspark.runtime import broadcast_if_small, materialize

PAIRS_PER_CELL = 250_000
MAX_DEPTH = 20

#: Name of the column with the cell's number on an axis, then the columns with the lower and upper end of a left and a right row.
Axis = tuple[str, tuple[str, str], tuple[str, str]]
#: Side of a cell, or its width and its height.
Cell = float | tuple[float, float]


def sides(cell: Cell) -> tuple[float, float]:
    """Width and height of a cell."""
    return cell if isinstance(cell, tuple) else (cell, cell)


def _side(axis: str, cell: Cell) -> Column:
    return F.lit(sides(cell)[axis == "row"])


def _part(x: Column, axis: str, level: Column, cell: Cell) -> Column:
    """Number of the part of a cell that x falls into, of 2^level parts; what lies outside counts to the ends."""
    parts = F.pow(F.lit(2.0), level)
    side = _side(axis, cell)
    place = F.floor((x - F.col(axis) * side) / side * parts)
    return F.least(F.greatest(place, F.lit(0)), parts.cast("long") - 1)


def _placed(df: DataFrame, ends: list[tuple[str, str, str]], cell: Cell) -> DataFrame:
    """Rows in the parts that they touch, at their own level (`_native`) and at all coarser ones."""
    widest = F.lit(0.0)
    for axis, low, high in ends:
        side = _side(axis, cell)
        begin = F.col(axis) * side
        inside = F.least(F.col(high), begin + side) - F.greatest(F.col(low), begin)
        widest = F.greatest(widest, inside / side)
    # an empty extent fits the deepest level
    fitting = F.when(widest > 0, F.floor(-F.log2(widest))).otherwise(F.lit(MAX_DEPTH))
    own = F.least(F.greatest(fitting, F.lit(0)), F.col("_depth")).cast("int")
    df = df.withColumn("_own", own).withColumn("_level", F.explode(F.sequence(F.lit(0), F.col("_own"))))
    for axis, low, high in ends:
        at = lambda c, axis=axis: _part(F.col(c), axis, F.col("_level"), cell)
        df = df.withColumn(f"_p_{axis}", F.explode(F.sequence(at(low), at(high))))
    return df.withColumn("_native", F.col("_level") == F.col("_own")).drop("_own", "_depth")


def _blocks(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Join on the key; keys of too many pairs are cut into blocks, of which every pair is in one."""
    count = lambda df, n: df.groupBy(*key).agg(F.count(F.lit(1)).alias(n))
    side = max(1, int(PAIRS_PER_CELL ** 0.5))
    many = count(left, "_nl").join(count(right, "_nr"), key).filter(F.col("_nl") * F.col("_nr") > PAIRS_PER_CELL).select(
        *key, F.ceil(F.col("_nl") / side).cast("int").alias("_rows"), F.ceil(F.col("_nr") / side).cast("int").alias("_columns"))
    many = materialize(many, "blocks")
    left, right = left.drop("_native"), right.drop("_native")
    if many.isEmpty():
        return left.join(right, key)
    many = broadcast_if_small(many)
    whole = [F.coalesce(F.col(c), F.lit(1)) for c in ("_rows", "_columns")]

    def dealt(df: DataFrame, own: str, other: str, n_own: Column, n_other: Column) -> DataFrame:
        plain = [c for c in df.columns if c not in key]
        out = df.join(many, key, "left").withColumn(own, F.pmod(F.xxhash64(*plain), n_own).cast("int"))
        return out.withColumn(other, F.explode(F.sequence(F.lit(0), n_other - 1))).drop("_rows", "_columns")
    a, b = dealt(left, "_i", "_j", *whole), dealt(right, "_j", "_i", *whole[::-1])
    return a.join(b, [*key, "_i", "_j"]).drop("_i", "_j")


def meet_in_cells(left: DataFrame, right: DataFrame, cell: Cell, on: list[str], axes: list[Axis]) -> DataFrame:
    """Pairs of rows equal in `on` whose extents may touch, each once for a cell.

    Beside `on`, which includes the axes' cell numbers, column names of the sides differ.  In a crowded cell a pair appears in the
    part with the lower corner of its common extent; whether the extents touch is the caller's to test.
    """
    count = lambda df, n: df.groupBy(*on).agg(F.count(F.lit(1)).alias(n))
    pairs = F.col("_nl") * F.col("_nr") / F.lit(PAIRS_PER_CELL)
    crowded = materialize(count(left, "_nl").join(count(right, "_nr"), on).filter(pairs > 1).select(*on, F.least(
        F.ceil(F.log2(pairs) / 2), F.lit(MAX_DEPTH)).cast("int").alias("_depth")), "crowded")
    # the stored size of one side tells little of its size in memory, so it is never sent whole to every task
    if crowded.isEmpty():
        return left.hint("merge").join(right, on)
    crowded = broadcast_if_small(crowded)
    place = lambda df, ends: materialize(_placed(df.join(crowded, on), ends, cell), "crowded-rows")
    a, b = place(left, [(x, *l) for x, l, _ in axes]), place(right, [(x, *r) for x, _, r in axes])
    key = [*on, "_level", *[f"_p_{x}" for x, _, _ in axes]]
    met = _blocks(a.filter("_native"), b, key).unionByName(_blocks(a.filter("not _native"), b.filter("_native"), key))
    for axis, (low, _), (r_low, _) in axes:
        met = met.filter(F.col(f"_p_{axis}") == _part(F.greatest(F.col(low), F.col(r_low)), axis, F.col("_level"), cell))
    met = met.drop("_level", *[f"_p_{x}" for x, _, _ in axes])
    return left.join(crowded, on, "left_anti").hint("merge").join(right, on).unionByName(met)
