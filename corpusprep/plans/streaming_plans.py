"""Streaming queries (X1-X5): each drives a file stream over a whole table with an
``availableNow`` trigger into the shared checkpoint area and returns the written result."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.plans.log_plans import SQL as LOG_SQL
from corpusprep.plans.quality_plans import RULES_SQL, customer_rules
from corpusprep.sources.tables import table
from corpusprep.streaming import streams as st

QUERIES = {}
SQL = {}


def register(name, sql=None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


def _stream(spark, sf_dir, name):
    schema = table(spark, sf_dir, name).schema
    # A table is one file or a folder of files; a pattern that only its name fits lets the source read either.
    return spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/{name}.parque[t]")


@register("stream_keyword_docs", """
SELECT doc_id, lang FROM documents WHERE contains(text, 'the') OR contains(text, 'und') OR contains(text, 'que')""")
def stream_keyword_docs(spark, sf_dir):
    """Keyword filter over the documents read as a file stream."""
    out = st.checkpoint_path(spark, "x1-out")
    sdf = st.stream_keyword_filter(_stream(spark, sf_dir, "documents"), "text", ["the", "und", "que"])
    kept = sdf.select("doc_id", "lang")
    st.run_to_parquet(kept, out, st.checkpoint_path(spark, "x1"))
    return spark.read.schema(kept.schema).parquet(out)


@register("stream_keep_ratio_docs", """
SELECT count(*) FILTER (WHERE contains(text, 'the') OR contains(text, 'und') OR contains(text, 'que')) AS kept, count(*) AS total,
       round(100.0 * count(*) FILTER (WHERE contains(text, 'the') OR contains(text, 'und') OR contains(text, 'que')) / count(*), 2) AS kept_pct
FROM documents""")
def stream_keep_ratio_docs(spark, sf_dir):
    """Running keep ratio (complete mode), final state."""
    from corpusprep.operators.shape import any_keyword
    out = st.checkpoint_path(spark, "x2-out")
    sdf = st.stream_keep_ratio(_stream(spark, sf_dir, "documents"), any_keyword("text", ["the", "und", "que"]))
    st.run_foreach_batch(sdf, out, st.checkpoint_path(spark, "x2"), mode="complete")
    return spark.read.parquet(out)


@register("stream_request_windows", """
SELECT CAST(epoch(wb) AS BIGINT) AS window_start, event_type, count(*) AS requests,
       sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS bytes_sent, sum(CAST(length(props) AS BIGINT)) AS bytes_received,
       round(sum(value), 6) AS total_elapsed
FROM (SELECT time_bucket(INTERVAL 1 day, ts) AS wb, * FROM events)
GROUP BY wb, event_type""")
def stream_request_windows(spark, sf_dir):
    """Events as a request log (value = elapsed seconds, k = bytes sent, JSON size = bytes
    received), one-day tumbling windows per event type, one hour of lateness; the windows still open at
    the end of the input are added from the rows after the last closed one."""
    def shaped(df):
        return df.select(
            "ts", "event_type", F.col("value").alias("elapsed"),
            F.get_json_object("props", "$.k").cast("long").alias("send_bytes"), F.length("props").cast("long").alias("recv_bytes")) \
            .withColumn("ts", st.ntz_to_instant("ts"))

    sdf = st.stream_request_stats(shaped(_stream(spark, sf_dir, "events")), "ts", "1 day", "1 hour", by=["event_type"])
    out = st.checkpoint_path(spark, "x4-out")
    st.run_to_parquet(sdf, out, st.checkpoint_path(spark, "x4"))
    closed = spark.read.schema(sdf.schema).parquet(out)
    res = closed.unionByName(st.open_windows(shaped(table(spark, sf_dir, "events")), closed, "ts", "1 day", by=["event_type"]))
    return res.select(F.unix_timestamp("window_start").alias("window_start"), "event_type", "requests",
                      "bytes_sent", "bytes_received", F.round("total_elapsed", 6).alias("total_elapsed"))


@register("stream_validated_customers", f"""
SELECT accepted, count(*) AS rows FROM (SELECT len({RULES_SQL}) = 0 AS accepted FROM customer) GROUP BY accepted""")
def stream_validated_customers(spark, sf_dir):
    """Customers validated continuously, split into accepted and quarantined folders."""
    good, bad = st.checkpoint_path(spark, "x5-good"), st.checkpoint_path(spark, "x5-bad")
    q = st.stream_validate(_stream(spark, sf_dir, "customer"), customer_rules(), good, bad, st.checkpoint_path(spark, "x5"))
    q.awaitTermination()
    g = spark.read.schema(table(spark, sf_dir, "customer").schema).parquet(good) if _exists(spark, good) else None
    parts = []
    if g is not None:
        parts.append(g.agg(F.count(F.lit(1)).alias("rows")).withColumn("accepted", F.lit(True)))
    if _exists(spark, bad):
        parts.append(spark.read.parquet(bad).agg(F.count(F.lit(1)).alias("rows")).withColumn("accepted", F.lit(False)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.col("rows") > 0).select("accepted", "rows")


def _exists(spark, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


@register("stream_event_log_lines", LOG_SQL["event_log_parse"])
def stream_event_log_lines(spark, sf_dir):
    """Events appended as JSON-lines files (values above 95 cut in half, as a crash would leave
    them), ingested as a file stream with a checkpoint: every line delivered once, broken lines
    as parse_error rows."""
    from corpusprep.plans.log_plans import LOG_SCHEMA
    ev = table(spark, sf_dir, "events")
    line = F.to_json(F.struct(F.col("event_type").alias("event"), F.col("value").alias("ts"),
                              F.struct(F.col("user_id").alias("id")).alias("task"),
                              F.struct(F.col("event_id").cast("string").alias("name")).alias("worktree")))
    text = F.when(F.col("value") > 95, F.substring(line, 1, F.floor(F.length(line) / 2).cast("int"))).otherwise(line)
    folder = st.checkpoint_path(spark, "x3-log")
    ev.select(text.alias("value")).write.mode("overwrite").text(folder)
    out = st.checkpoint_path(spark, "x3-out")
    st.run_to_parquet(st.stream_event_log(spark, folder, LOG_SCHEMA), out, st.checkpoint_path(spark, "x3"))
    res = spark.read.parquet(out)
    return res.groupBy("event").agg(F.count(F.lit(1)).alias("rows"), F.count("raw").alias("raw_lines"))
