"""Monitoring queries over task and status tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boundaryspark.functions import scalars as S
from boundaryspark.operators.layers import first_per_key

# Components of the pipeline, their status and heartbeat types, levels of the grid.
COMPONENTS = [("GIT", "GIT_PULL", "GIT_HEARTBEAT"), ("QUEUE", "QUEUE_STATUS", "QUEUE_HEARTBEAT"),
              ("WORKER", "WORKER_STATUS", "WORKER_OP_HEARTBEAT")]
GRID_LEVELS = ["ADM0", "ADM1", "ADM2", "ADM3", "ADM4", "ADM5"]
QUIET_HOURS = {"git": 12, "metadata": 48, "queue": 72, "worker": 3}


def task_outcomes(tasks: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Completed and failed tasks of the last hours."""
    recent = tasks.filter(F.col("status_time") >= now - F.expr(f"INTERVAL '{hours}' HOUR"))
    return recent.agg(F.count_if(F.col("status") == "COMPLETE").alias("successful"),
                      F.count_if(F.col("status") == "ERROR").alias("failed"))


def queue_summary(tasks: DataFrame, now: Column) -> DataFrame:
    """Ready tasks, tasks touched in 24 hours and the oldest ready task, in one pass."""
    ready = F.col("status") == "ready"
    return tasks.agg(F.count_if(ready).alias("ready_tasks"),
                     F.count_if(F.col("status_time") >= now - F.expr("INTERVAL '24' HOUR")).alias("processed_24h"),
                     F.min(F.when(ready, F.col("time_added"))).alias("oldest_ready"))


def build_progress(statuses: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """S counts as done and skipped, a code with E as done and failed; percent of the jobs not skipped."""
    code = F.col("status")
    skipped, failed = code == "S", code.contains("E")
    counts = statuses.groupBy(*(groups or [])).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(skipped).alias("skipped"),
        F.count_if(~skipped & failed).alias("errors"), F.count_if(skipped | failed | (code == "D")).alias("done"))
    left = F.col("total") - F.col("skipped")
    return counts.withColumn("percent_done", F.when(left > 0, (F.col("done") - F.col("skipped")) / left * 100))


def latest_status(events: DataFrame, key: str = "status_type", ts: str = "ts", tie: str | None = None) -> DataFrame:
    """Newest row per key by aggregate, so the many rows of one key combine before the shuffle."""
    order = F.struct(F.col(ts), F.col(tie)) if tie else F.col(ts)
    others = [c for c in events.columns if c != key]
    return events.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("_r")).select(key, "_r.*")


def attach_heartbeat(events: DataFrame, components: list[tuple[str, str, str]] | None = None, tie: str | None = None) -> DataFrame:
    """Latest status and latest heartbeat per component; a component without status gives no row."""
    parts = components or COMPONENTS
    kind = F.col("status_type")
    component, beat = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for name, status_type, heartbeat_type in parts:
        component = F.when(kind.isin(status_type, heartbeat_type), F.lit(name)).otherwise(component)
        beat = F.when(kind == heartbeat_type, F.lit(True)).when(kind == status_type, F.lit(False)).otherwise(beat)
    order = F.struct(F.col("ts"), F.col(tie)) if tie else F.col("ts")
    row = F.struct("status", "ts")

    def newest(is_beat: bool) -> Column:
        hit = F.col("_beat") == is_beat
        return F.max_by(F.when(hit, row), F.when(hit, order))

    rows = events.withColumn("component", component).withColumn("_beat", beat).filter(F.col("component").isNotNull())
    wide = rows.groupBy("component").agg(newest(False).alias("_s"), newest(True).alias("_h"))
    return wide.filter(F.col("_s").isNotNull()).select(
        "component", F.col("_s.status").alias("status_message"), F.col("_s.ts").alias("status_time"),
        F.col("_h.status").alias("heartbeat_message"), F.col("_h.ts").alias("heartbeat_time"))


def component_status(reports: list[DataFrame]) -> DataFrame:
    """Reports of several components as one sorted table."""
    merged, *rest = reports
    for report in rest:
        merged = merged.unionByName(report)
    return merged.orderBy("component")


def worker_grid(events: DataFrame, zone: str = "America/New_York", tie: str | None = None) -> DataFrame:
    """Latest status of each `ISO_ADMn_WORKER`, times in local form."""
    workers = events.filter(F.col("status_type").endswith("_WORKER") & (F.size(F.split("status_type", "_")) >= 3))
    newest = latest_status(workers, tie=tie)
    return newest.select(S.status_key_iso("status_type").alias("iso"), S.status_key_level("status_type").alias("adm"),
                         "status", S.to_local("ts", zone).alias("time"))


def status_grid(statuses: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row per key, one column per level with its newest code; "|" where there is none."""
    hit = {level: F.col("adm") == level for level in GRID_LEVELS}
    cells = [F.coalesce(F.max_by(F.when(h, F.col("status")), F.when(h, order)), F.lit("|")).alias(level)
             for level, h in hit.items()]
    return statuses.groupBy(*keys).agg(*cells)


def new_ready_tasks(files: DataFrame, tasks: DataFrame, order: str) -> DataFrame:
    """One new task per (iso, adm) of the files, unless a ready task exists."""
    waiting = tasks.filter(F.col("status") == "ready").select("iso", "adm").distinct()
    return first_per_key(files, ["iso", "adm"], F.col(order)).join(waiting, ["iso", "adm"], "left_anti")


def next_ready_task(tasks: DataFrame, k: int = 1, tie: str = "taskid") -> DataFrame:
    """The k oldest ready tasks."""
    return tasks.filter(F.col("status") == "ready").orderBy("time_added", tie).limit(k)


def build_freshness(commits: DataFrame, keys: list[str]) -> DataFrame:
    """Compare the newest source, build and script dates (column `kind`) of each layer."""
    newest = commits.groupBy(*keys).agg(*[
        F.max(F.when(F.col("kind") == k, F.col("committed"))).alias(f"{k}_date") for k in ("source", "build", "script")])
    verdict = (F.when(F.col("source_date").isNull(), "no source").when(F.col("build_date").isNull(), "no build")
               .when(F.col("build_date") <= F.col("source_date"), "source is newer")
               .when(F.col("build_date") <= F.col("script_date"), "script is newer").otherwise("up to date"))
    return newest.withColumn("verdict", verdict)


def task_runtime(events: DataFrame, keys: list[str]) -> DataFrame:
    """Time from the first to the last event of a task as HH:MM:SS."""
    span = events.groupBy(*keys).agg(F.min("ts").alias("started"), F.max("ts").alias("finished"))
    seconds = F.unix_timestamp("finished") - F.unix_timestamp("started")
    return span.withColumn("seconds", seconds).withColumn("runtime", S.format_elapsed("seconds"))


def quiet_periods(events: DataFrame, key: str, now: Column, gap_hours: float) -> DataFrame:
    """Batch twin of the streaming sessions: has a component been silent for longer than the gap?"""
    newest = events.groupBy(key).agg(F.max("ts").alias("last_seen"))
    silent = (F.unix_timestamp(now) - F.unix_timestamp("last_seen")) / 3600
    return newest.withColumn("silent_hours", silent).withColumn("quiet", silent > gap_hours)


def shuffled_jobs(jobs: DataFrame, seed: int, partitions: int) -> DataFrame:
    """Jobs dealt out to partitions by a seeded hash, so large ones do not meet and a rerun agrees."""
    return jobs.withColumn("_r", F.xxhash64(F.lit(seed), *jobs.columns)).repartition(partitions, "_r").drop("_r")
