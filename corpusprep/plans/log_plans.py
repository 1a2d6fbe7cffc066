"""Log analytics (A7-A9, S8, J8) over events read as a request log and orders read as tasks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.operators import joins, shape
from corpusprep.sources.files import parse_event_lines
from corpusprep.sources.tables import table

QUERIES = {}
SQL = {}


def register(name, sql=None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


def requests_frame(spark, sf_dir):
    """events as requests: method = event type, elapsed = value, bytes sent = props.k, bytes
    received = size of the props text, start = seconds since the epoch (wall clock as UTC)."""
    ev = table(spark, sf_dir, "events")
    from corpusprep.streaming.streams import ntz_to_instant
    start = F.unix_micros(ntz_to_instant("ts")) / 1e6  # wall clock read as UTC, whatever the session zone
    return ev.select("event_id", "user_id", F.col("event_type").alias("method"), F.col("value").alias("elapsed"),
                     F.get_json_object("props", "$.k").cast("long").alias("send_bytes"),
                     F.length("props").cast("long").alias("recv_bytes"), start.alias("start"))


@register("request_stats_by_method", """
SELECT event_type AS method, count(*) AS requests, sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS bytes_sent,
       sum(CAST(length(props) AS BIGINT)) AS bytes_received, round(sum(value), 6) AS total_elapsed, round(avg(value), 6) AS mean_elapsed,
       CASE WHEN sum(length(props)) < 1024 THEN format('{:.2f} B', sum(length(props))::DOUBLE)
            WHEN sum(length(props)) < 1048576 THEN format('{:.2f} KB', sum(length(props)) / 1024.0)
            ELSE format('{:.2f} MB', sum(length(props)) / 1048576.0) END AS received_human
FROM events GROUP BY event_type""")
def request_stats_by_method(spark, sf_dir):
    """A7 + A8: request count, bytes, total and mean elapsed per method; bytes in B / KB / MB."""
    st = shape.request_stats(requests_frame(spark, sf_dir), by=["method"])
    return st.withColumn("received_human", shape.format_bytes("bytes_received"))


@register("concurrency_by_user", """
SELECT user_id, count(*) AS tasks, round(sum(value), 6) AS sum_elapsed,
       round(max(epoch(ts) + value) - min(epoch(ts)), 6) AS wall_time, round(avg(value), 6) AS mean_elapsed,
       round(round(sum(value), 6) / round(max(epoch(ts) + value) - min(epoch(ts)), 6), 4) AS speedup
FROM events GROUP BY user_id""")
def concurrency_by_user(spark, sf_dir):
    """Summed elapsed over wall time per user (how much the requests overlapped)."""
    return shape.concurrency_report(requests_frame(spark, sf_dir), "start", "elapsed", by=["user_id"])


LOG_SCHEMA = T.StructType([
    T.StructField("event", T.StringType()), T.StructField("ts", T.DoubleType()),
    T.StructField("task", T.StructType([T.StructField("id", T.LongType())])),
    T.StructField("worktree", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("error", T.StringType()),
])


@register("event_log_parse", """
SELECT CASE WHEN value > 95 THEN 'parse_error' ELSE event_type END AS event, count(*) AS rows,
       count(*) FILTER (WHERE value > 95) AS raw_lines FROM events GROUP BY 1""")
def event_log_parse(spark, sf_dir):
    """Events written as JSON lines (lines of values above 95 cut in half, as a crash would leave
    them) and read back without failing: broken lines become parse_error rows with their raw text."""
    ev = table(spark, sf_dir, "events")
    line = F.to_json(F.struct(F.col("event_type").alias("event"), F.col("value").alias("ts"),
                              F.struct(F.col("user_id").alias("id")).alias("task"),
                              F.struct(F.col("event_id").cast("string").alias("name")).alias("worktree")))
    text = F.when(F.col("value") > 95, F.substring(line, 1, F.floor(F.length(line) / 2).cast("int"))).otherwise(line)
    parsed = parse_event_lines(ev.select(text.alias("text")), LOG_SCHEMA)
    return parsed.groupBy("event").agg(F.count(F.lit(1)).alias("rows"), F.count("raw").alias("raw_lines"))


@register("ready_tasks", """
WITH t AS (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'in_progress' END AS status,
                  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'agent-' || CAST(o_custkey AS VARCHAR) END AS owner,
                  lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS blocker FROM orders)
SELECT t.id FROM t LEFT JOIN t b ON t.blocker = b.id
WHERE t.status = 'pending' AND coalesce(t.owner, '') = '' AND (t.blocker IS NULL OR b.status = 'completed')""")
def ready_tasks(spark, sf_dir):
    """Orders as tasks (F = completed, O = pending, else in progress; urgent and high ones
    owned), each blocked by the customer's previous order; the pending unowned tasks whose blocker
    is finished are ready."""
    from corpusprep.operators.ranking import neighbor_values
    o = neighbor_values(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", ["o_orderkey"], -1, "prev_")
    tasks = o.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("in_progress").alias("status"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.concat(F.lit("agent-"), F.col("o_custkey").cast("string"))).alias("owner"),
        F.array_compact(F.array("prev_o_orderkey")).alias("blockedBy"))
    return joins.ready_rows(tasks).select("id")
