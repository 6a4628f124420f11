"""Session-level helpers: checkpoints, size-checked broadcasts, numbering without one big task."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024
SEQUENCE_BUCKETS = 256
STREAMED_PARTS = 200  # to more parts (spark.shuffle.sort.bypassMergeThreshold) a task sorts all rows of its split before it writes them


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints; a temporary one only for local sessions that name none."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="boundaryspark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back, where several consumers need one costly input."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt_by_key(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Rows by key in parts of about `rows` rows, however few files they come from; what fits one part stays as it is.

    A job that turns each row into many then holds a bounded part in a task, and aggregates by the keys without another shuffle.
    Where a task would sort its split to deal it, the splits are first made of one size, by an exchange that holds no rows.
    """
    parts = -(-df.count() // rows)
    if parts > STREAMED_PARTS:
        df = df.hint("rebalance", STREAMED_PARTS, *keys)
    return df.repartition(parts, *keys) if parts > 1 else df


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate of the optimised plan."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast hint only when the estimated size is under the limit; otherwise Spark decides."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def spread_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner",
                salts: int = 16) -> DataFrame:
    """Join a side with hot keys to a side with few rows per key.

    The few-rows side is repeated under every salt, so one hot key is worked on by
    `salts` tasks.  Exact for inner, left, left_semi and left_anti joins.  The salt is a hash of the
    row, so a task run again after a lost executor sends its rows to the same place.
    """
    if estimated_bytes(small) <= BROADCAST_LIMIT_BYTES:
        return big.join(F.broadcast(small), keys, how)
    plain = [F.col(f"`{f.name}`") for f in big.schema.fields if isinstance(f.dataType, T.AtomicType)]
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*plain), F.lit(salts)).cast("int"))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def numbered(df: DataFrame, order: str, name: str, group: list[str] | None = None,
             buckets: int = SEQUENCE_BUCKETS) -> DataFrame:
    """Consecutive numbers 1..n by a unique numeric column, per group or over everything.

    Rows fall into buckets cut at the quantiles of the order column.  Only bucket counts are
    summed up in order; each bucket is numbered on its own, so no group meets in one task.
    """
    group = group or []
    shares = [i / buckets for i in range(1, buckets)]
    cuts = df.agg(F.expr(
        f"percentile_approx(`{order}`, array({','.join(f'{s}d' for s in shares)}), 10000)").alias("cuts"))
    # every 16th cut tells which 16 to look through
    tops = F.filter("cuts", lambda c, i: i % 16 == 15)
    upto = lambda found: F.size(F.filter(found, lambda c: c <= F.col(order)))
    bucketed = df.withColumn("_c", cuts.select(F.struct("cuts", tops.alias("tops"))).scalar()) \
        .withColumn("_top", 16 * upto("_c.tops")) \
        .withColumn("_bucket", F.coalesce(F.col("_top") + upto(F.slice("_c.cuts", F.col("_top") + 1, F.lit(16))), F.lit(0))).drop("_c", "_top")
    counts = bucketed.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*(group or [F.lit(0)])).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = W.partitionBy(*group, "_bucket").orderBy(order)
    joined = spread_join(bucketed, offsets, [*group, "_bucket"])
    return joined.withColumn(name, F.row_number().over(within) + F.col("_before")).drop("_bucket", "_before")


def running_sums(df: DataFrame, group: list[str], order: str, sums: dict[str, Column],
                 chunk: int = 65536) -> DataFrame:
    """Running totals along a dense integer order column, chunk by chunk.

    Totals of earlier chunks are added to the running total inside a chunk, so a very long
    group is spread over many tasks.
    """
    work = df.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk)))
    for name, value in sums.items():
        work = work.withColumn(f"_v_{name}", value)
    totals = work.groupBy(*group, "_chunk").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    before = W.partitionBy(*group).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(*group, "_chunk", *[
        F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in sums])
    within = W.partitionBy(*group, "_chunk").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = work.join(offsets, [*group, "_chunk"])
    for name in sums:
        out = out.withColumn(name, F.sum(f"_v_{name}").over(within) + F.col(f"_b_{name}"))
    return out.drop("_chunk", *[f"_v_{n}" for n in sums], *[f"_b_{n}" for n in sums])
