"""Monitoring and intake as Structured Streaming jobs.

Windows and spells in append mode come out once, when the watermark is past their end, and their state is dropped
then; in complete mode the whole result is kept and given after every batch.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from boundaryspark.operators import intake as N
from boundaryspark.runtime import materialize, scratch_path
from boundaryspark.sources import packages as P
from boundaryspark.sources.versions import BUCKETS, VersionedTable


def stream_latest_status(stream: DataFrame, key: str = "status_type", ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """Last write wins per key; for update or complete mode.  State is one row per key."""
    return stream.groupBy(key).agg(F.max_by("status", F.struct(ts, tie)).alias("status"), F.max(ts).alias(ts))


def stream_task_outcomes(stream: DataFrame, ts: str = "status_time", length: str = "24 hours", step: str = "1 hour",
                         lateness: str = "24 hours") -> DataFrame:
    """Completed and failed tasks in sliding windows; a window equal to its step gives the tumbling form."""
    window = F.window(ts, length) if length == step else F.window(ts, length, step)
    return stream.withWatermark(ts, lateness).groupBy(window.alias("w")).agg(
        F.count_if(F.col("status") == "COMPLETE").alias("successful"), F.count_if(F.col("status") == "ERROR").alias("failed")) \
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "successful", "failed")


def stream_quiet_periods(stream: DataFrame, key: str, gap: str, ts: str = "ts", lateness: str = "1 hour") -> DataFrame:
    """Spells of activity per component; a spell ends once the component is silent for the gap."""
    return stream.withWatermark(ts, lateness).groupBy(key, F.session_window(ts, gap).alias("s")).agg(
        F.count(F.lit(1)).alias("events"), F.max(ts).alias("last_seen")) \
        .select(key, F.col("s.start").alias("active_from"), "last_seen", F.col("s.end").alias("quiet_from"), "events")


def intake_batch(packages: DataFrame, countries: DataFrame, licenses: DataFrame, current_year: int | None = None) -> DataFrame:
    """Package contents and metadata verdict of one batch of packages."""
    # names come from the directories of the zips; the metadata file alone is unpacked, once for all checks
    members = materialize(P.package_members(packages, P.META_FILE), "intake-members")
    return intake_of_members(packages.select("package_id"), members, countries, licenses, current_year)


def intake_of_members(packages: DataFrame, members: DataFrame, countries: DataFrame, licenses: DataFrame, current_year: int | None = None) -> DataFrame:
    """The same for packages whose members are read, of which the metadata files have their bytes."""
    contents = N.check_package(members)
    kv = N.parse_meta(P.meta_texts(members))
    checks = N.metadata_checks(kv, countries, licenses, members.select("package_id", "member"), current_year)
    verdict = N.metadata_verdict(checks)
    # a package without usable members still gives a row
    joined = packages.join(contents, "package_id", "left").join(verdict, "package_id", "left")
    reasons = F.coalesce(F.concat_ws("; ", "reasons"), F.lit(""))
    return joined.select("package_id", F.coalesce("has_meta", F.lit(False)).alias("has_meta"),
                         F.coalesce("geometry_files", F.lit(0).cast("long")).alias("geometry_files"),
                         F.when(F.col("has_meta").isNull(), "no meta.txt; no geometry file").otherwise(reasons).alias("reasons"),
                         F.coalesce("message", F.lit("no metadata")).alias("message"),
                         F.coalesce(F.col("passed") & F.col("all_valid"), F.lit(False)).alias("passed"))


def stream_intake(stream: DataFrame, countries: DataFrame, licenses: DataFrame, path: str, checkpoint: str,
                 current_year: int | None = None) -> StreamingQuery:
    """Append the verdicts of each micro-batch; a batch retried after a failure replaces its own folder."""
    def handle(batch: DataFrame, number: int) -> None:
        intake_batch(batch, countries, licenses, current_year).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_new_tasks(stream: DataFrame, keys: list[str], ts: str = "time_added", window: str = "72 hours") -> DataFrame:
    """First ready task per key; later ones within the watermark are dropped."""
    return stream.withWatermark(ts, window).dropDuplicatesWithinWatermark(keys)


def stream_ready_tasks(stream: DataFrame, keys: list[str], ts: str = "time_added", number: str = "taskid", hold: str = "72 hours",
                       lateness: str = "1 hour") -> DataFrame:
    """Submitted tasks (status `ready`) of keys that have no ready task: neither completed (`COMPLETE`, `ERROR`) nor older than `hold`.

    The state is one time per key with a ready task.  A task that ends drops it, and so does a timer once the watermark is past `hold`, with
    no row of that key, so keys that are never heard of again leave nothing behind.  Rows of a key in a micro-batch are put in order of
    time and number, so they have to fit a task.
    """
    spark = stream.sparkSession
    hold_ms = int(spark.range(1).select(F.expr(f"unix_millis(timestamp_millis(0) + interval {hold})")).first()[0])
    fields = [f for f in stream.schema.fields if f.name in (*keys, ts, number)]

    def run(key, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values(["_ms", number])
        ready = state.get[0] if state.exists else None
        taken = []
        for ms, status in zip(rows["_ms"], rows["status"], strict=True):
            open_now = ready is not None and ms < ready + hold_ms
            taken.append(status == "ready" and not open_now)
            if taken[-1]:
                ready = int(ms)
            elif status in ("COMPLETE", "ERROR"):
                ready = None
        if ready is not None and ready + hold_ms > state.getCurrentWatermarkMs():
            state.update((ready,))
            state.setTimeoutTimestamp(ready + hold_ms)
        elif state.exists:
            state.remove()
        yield rows.loc[taken, [f.name for f in fields]]
    timed = stream.withColumn("_ms", F.unix_millis(ts)).withWatermark(ts, lateness)
    return timed.groupBy(*keys).applyInPandasWithState(run, T.StructType(fields), "ready long", "append", GroupStateTimeout.EventTimeTimeout)


def upsert_batches(stream: DataFrame, target: str, keys: list[str], order: str, checkpoint: str,
                   prepare: Callable[[DataFrame], DataFrame] = lambda df: df, buckets: int = BUCKETS) -> StreamingQuery:
    """Keep the newest row per key in a `VersionedTable`, a version per micro-batch, of which only touched buckets are written."""
    def handle(batch: DataFrame, number: int) -> None:
        VersionedTable(batch.sparkSession, target, keys, order, buckets).upsert(prepare(batch), number)

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_table(stream: DataFrame, mode: str, name: str) -> DataFrame:
    """Drain what is available and read the result: a file sink for append, else the final version.

    Complete and update results are written whole per micro-batch, never kept in driver memory.
    """
    spark = stream.sparkSession
    out, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    last: list[int] = []
    if mode == "append":
        query = stream.writeStream.outputMode("append").format("parquet").option("path", out).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)

    def handle(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/version={number}")
        last.append(number)

    query = stream.writeStream.outputMode(mode).foreachBatch(handle).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/version={max(last)}")


def parquet_stream(spark: SparkSession, path: str) -> DataFrame:
    """A parquet file or folder as a stream; timestamps without zone become instants."""
    folder, _, file = path.rpartition("/")
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", file).parquet(folder)
    return stream.select(*[F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.typeName() == "timestamp_ntz" else F.col(f.name)
                           for f in schema.fields])

