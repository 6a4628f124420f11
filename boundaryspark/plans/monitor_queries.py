"""Queries on tasks and status events."""

from __future__ import annotations

from pyspark.sql import functions as F

from boundaryspark.functions import scalars as S
from boundaryspark.operators import monitor as M
from boundaryspark.plans.inputs import derived, table, with_inputs
from boundaryspark.plans.registry import query

STAMP = "yyyy-MM-dd HH:mm:ss"
NOW = "TIMESTAMP '2000-01-01 12:00:00'"


def _now():
    return F.lit("2000-01-01 12:00:00").cast("timestamp")


@query("task_outcomes", with_inputs("fx_task", f"""SELECT count(*) FILTER (status = 'COMPLETE') AS successful, count(*) FILTER (status = 'ERROR') AS failed
FROM fx_task WHERE status_time >= {NOW} - INTERVAL 24 HOUR"""))
def task_outcomes(spark, sf_dir):
    return M.task_outcomes(derived(spark, sf_dir, "fx_task"), _now())


@query("queue_summary", with_inputs("fx_task", f"""SELECT count(*) FILTER (status = 'ready') AS ready_tasks, count(*) FILTER (status_time >= {NOW} - INTERVAL 24 HOUR) AS processed_24h,
 strftime(min(time_added) FILTER (status = 'ready'), '%Y-%m-%d %H:%M:%S') AS oldest_ready FROM fx_task"""))
def queue_summary(spark, sf_dir):
    out = M.queue_summary(derived(spark, sf_dir, "fx_task"), _now())
    return out.withColumn("oldest_ready", F.date_format("oldest_ready", STAMP))


@query("build_progress", with_inputs("fx_status", """SELECT user_id, count(*) AS total, count(*) FILTER (code = 'S') AS skipped, count(*) FILTER (code = 'E') AS errors, count(*) FILTER (code <> 'P') AS done,
 round(CASE WHEN count(*) FILTER (code <> 'S') > 0 THEN count(*) FILTER (code IN ('D', 'E')) * 100.0e0 / count(*) FILTER (code <> 'S') END, 6) AS percent_done
FROM (SELECT user_id, CASE event_type WHEN 'purchase' THEN 'D' WHEN 'error' THEN 'E' WHEN 'signup' THEN 'S' ELSE 'P' END AS code FROM fx_status) GROUP BY 1"""))
def build_progress(spark, sf_dir):
    kind = F.col("event_type")
    code = F.when(kind == "purchase", "D").when(kind == "error", "E").when(kind == "signup", "S").otherwise("P")
    out = M.build_progress(derived(spark, sf_dir, "fx_status").withColumn("status", code), ["user_id"])
    return out.withColumn("percent_done", F.round("percent_done", 6))


@query("latest_status", with_inputs("fx_status", """SELECT status_type, arg_max(status, (ts, event_id)) AS status, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ts FROM fx_status GROUP BY 1"""))
def latest_status(spark, sf_dir):
    out = M.latest_status(derived(spark, sf_dir, "fx_status"), tie="event_id")
    return out.select("status_type", "status", F.date_format("ts", STAMP).alias("ts"))


_PARTS = [("PURCHASE", "purchase", "view"), ("SIGNUP", "signup", "click"), ("ERROR", "error", "none")]


@query("attach_heartbeat", " UNION ALL ".join(
    f"""SELECT '{n}' AS component, s.props AS status_message, strftime(s.ts, '%Y-%m-%d %H:%M:%S') AS status_time, h.props AS heartbeat_message, strftime(h.ts, '%Y-%m-%d %H:%M:%S') AS heartbeat_time
 FROM (SELECT * FROM events WHERE event_type = '{a}' ORDER BY ts DESC, event_id DESC LIMIT 1) s LEFT JOIN (SELECT * FROM events WHERE event_type = '{b}' ORDER BY ts DESC, event_id DESC LIMIT 1) h ON true"""
    for n, a, b in _PARTS))
def attach_heartbeat(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("status_type"), F.col("props").alias("status"), "ts", "event_id")
    out = M.attach_heartbeat(events, _PARTS, tie="event_id")
    return out.withColumn("status_time", F.date_format("status_time", STAMP)).withColumn("heartbeat_time", F.date_format("heartbeat_time", STAMP))


@query("component_status", """SELECT event_type AS component, arg_max(props, (ts, event_id)) AS status, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ts FROM events GROUP BY 1""")
def component_status(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("component"), F.col("props").alias("status"), "ts", "event_id")
    reports = [M.latest_status(events, "component", tie="event_id").drop("event_id")]
    return M.component_status(reports).withColumn("ts", F.date_format("ts", STAMP))


@query("worker_grid", with_inputs("fx_status", """SELECT string_split(status_type, '_')[1] AS iso, replace(string_split(status_type, '_')[2], 'ADM', '') AS adm, status,
 strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S') || '-05:00' AS time FROM (SELECT status_type, arg_max(status, (ts, event_id)) AS status, max(ts) AS ts FROM fx_status GROUP BY 1)"""))
def worker_grid(spark, sf_dir):
    return M.worker_grid(derived(spark, sf_dir, "fx_status"), tie="event_id")


_GRID = ", ".join(f"""coalesce(arg_max(CASE WHEN adm = 'ADM{i}' THEN status END, CASE WHEN adm = 'ADM{i}' THEN (ts, event_id) END), '|') AS "ADM{i}" """ for i in range(6))


@query("status_grid", with_inputs("fx_status", f"""SELECT iso, {_GRID} FROM (SELECT *, string_split(status_type, '_')[1] AS iso, string_split(status_type, '_')[2] AS adm FROM fx_status) GROUP BY 1"""))
def status_grid(spark, sf_dir):
    parts = F.split("status_type", "_")
    rows = derived(spark, sf_dir, "fx_status").withColumn("iso", parts[0]).withColumn("adm", parts[1])
    return M.status_grid(rows, ["iso"], F.struct("ts", "event_id"))


@query("new_ready_tasks", """SELECT iso, adm, min(pos) AS pos FROM (SELECT o_custkey AS iso, o_orderkey % 6 AS adm, o_orderkey AS pos, o_orderstatus FROM orders) f
WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_custkey = f.iso AND t.o_orderkey % 6 = f.adm AND t.o_orderstatus = 'O') GROUP BY ALL""")
def new_ready_tasks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("iso"), (F.col("o_orderkey") % 6).alias("adm"), F.col("o_orderkey").alias("pos"),
        F.when(F.col("o_orderstatus") == "O", "ready").otherwise("COMPLETE").alias("status"))
    return M.new_ready_tasks(orders.select("iso", "adm", "pos"), orders, "pos")


@query("next_ready_task", with_inputs("fx_task", "SELECT taskid, iso, adm, filesize FROM fx_task WHERE status = 'ready' ORDER BY time_added, taskid LIMIT 5"))
def next_ready_task(spark, sf_dir):
    return M.next_ready_task(derived(spark, sf_dir, "fx_task"), 5).select("taskid", "iso", "adm", "filesize")


@query("build_freshness", """SELECT o_custkey AS layer, CASE WHEN s IS NULL THEN 'no source' WHEN b IS NULL THEN 'no build' WHEN b <= s THEN 'source is newer' WHEN b <= c THEN 'script is newer' ELSE 'up to date' END AS verdict
FROM (SELECT o_custkey, max(o_orderdate) FILTER (o_orderstatus = 'F') AS s, max(o_orderdate) FILTER (o_orderstatus = 'O') AS b, max(o_orderdate) FILTER (o_orderstatus = 'P') AS c FROM orders GROUP BY 1)""")
def build_freshness(spark, sf_dir):
    status = F.col("o_orderstatus")
    commits = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("layer"), F.col("o_orderdate").alias("committed"),
        F.when(status == "F", "source").when(status == "O", "build").otherwise("script").alias("kind"))
    return M.build_freshness(commits, ["layer"]).select("layer", "verdict")


@query("task_runtime", """SELECT user_id, s AS seconds, printf('%02d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) AS runtime
FROM (SELECT user_id, cast(epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts))) AS bigint) AS s FROM events GROUP BY 1)""")
def task_runtime(spark, sf_dir):
    return M.task_runtime(table(spark, sf_dir, "events"), ["user_id"]).select("user_id", "seconds", "runtime")


@query("to_local", "SELECT event_id, strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S') || '-05:00' AS local FROM events")
def to_local(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", S.to_local("ts").alias("local"))


@query("split_status_key", with_inputs("fx_status", """SELECT event_id, string_split(status_type, '_')[1] AS iso, replace(string_split(status_type, '_')[2], 'ADM', '') AS adm FROM fx_status"""))
def split_status_key(spark, sf_dir):
    return derived(spark, sf_dir, "fx_status").select(
        "event_id", S.status_key_iso("status_type").alias("iso"), S.status_key_level("status_type").alias("adm"))


@query("format_elapsed", """SELECT l_orderkey, l_linenumber, printf('%02d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) AS t FROM (SELECT l_orderkey, l_linenumber, cast(floor(l_extendedprice) AS bigint) AS s FROM lineitem)""")
def format_elapsed(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.format_elapsed("l_extendedprice").alias("t"))


@query("quiet_periods", """SELECT user_id, epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(date_trunc('second', max(ts))) > 3 * 3600 AS quiet FROM events GROUP BY 1""")
def quiet_periods(spark, sf_dir):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    return M.quiet_periods(table(spark, sf_dir, "events"), "user_id", now, 3).select("user_id", "quiet")


@query("shuffled_jobs", with_inputs("fx_task", "SELECT taskid, iso, adm FROM fx_task"))
def shuffled_jobs(spark, sf_dir):
    return M.shuffled_jobs(derived(spark, sf_dir, "fx_task").select("taskid", "iso", "adm"), 7, 8)


@query("claimants", """SELECT p_partkey, array_to_string(list_filter(string_split(t, '|'), lambda c: trim(c) <> '' AND c <> 'None'), ',') AS claimants
FROM (SELECT p_partkey, CASE WHEN p_size < 10 THEN 'None' WHEN p_size < 20 THEN '' ELSE p_brand || '|' || p_type || '|None' END AS t FROM part)""")
def claimants(spark, sf_dir):
    text = F.when(F.col("p_size") < 10, "None").when(F.col("p_size") < 20, "").otherwise(F.concat_ws("|", "p_brand", "p_type", F.lit("None")))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(S.claimants(text), ",").alias("claimants"))


@query("share_labels", """SELECT l_orderkey, l_linenumber, printf('%.1f%%', l_discount * 10 * 100) AS label, CASE WHEN l_discount * 10 > 0.9 THEN 'high' WHEN l_discount * 10 > 0.7 THEN 'mid' ELSE 'low' END AS class FROM lineitem""")
def share_labels(spark, sf_dir):
    share = F.col("l_discount") * 10
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.share_label(share).alias("label"), S.share_class(share).alias("class"))


@query("round_half_even", "SELECT l_orderkey, l_linenumber, round_even(l_quantity / 2, 0) AS half FROM lineitem")
def round_half_even(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.round_half_even(F.col("l_quantity") / 2).alias("half"))
