"""Structured Streaming operators.

Sources are file streams with explicit schemas; every sink keeps its progress in a checkpoint
folder under the session's shared checkpoint directory, so each record is delivered once and a
restarted query resumes where it stopped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.operators.quality import errors
from corpusprep.operators.shape import any_keyword
from corpusprep.session import ensure_checkpoint_dir
from corpusprep.sources.files import parse_event_lines


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A fresh checkpoint folder for one streaming query, inside the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/streams/{name}-{uuid.uuid4().hex}"


def ntz_to_instant(c) -> Column:
    """A wall-clock TIMESTAMP_NTZ read as UTC, as an absolute TIMESTAMP (independent of the
    session time zone), which event-time watermarks require."""
    c = F.col(c) if isinstance(c, str) else c
    days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    secs = F.hour(c) * 3600 + F.minute(c) * 60
    micros = days * 86400000000 + secs.cast("long") * 1000000 + (F.date_part(F.lit("SECOND"), c) * 1000000).cast("long")
    return F.timestamp_micros(micros)


def stream_keyword_filter(sdf: DataFrame, c: str, keywords: list[str]) -> DataFrame:
    """The any-keyword predicate of P8 on an unbounded source (append mode)."""
    return sdf.where(any_keyword(c, keywords))


def stream_keep_ratio(sdf: DataFrame, pred: Column) -> DataFrame:
    """Running kept / total / percent (update or complete mode)."""
    return sdf.agg(F.count_if(pred).alias("kept"), F.count(F.lit(1)).alias("total")) \
        .withColumn("kept_pct", F.round(F.lit(100.0) * F.col("kept") / F.col("total"), 2))


def stream_event_log(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Append-only JSON-lines folder as a stream; broken lines become parse_error rows."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_event_lines(reader.load(path).withColumnRenamed("value", "text"), schema)


def stream_request_stats(sdf: DataFrame, ts: str, window: str = "1 day", lateness: str = "1 hour",
                         by: list[str] | None = None, elapsed: str = "elapsed", sent: str = "send_bytes",
                         recv: str = "recv_bytes") -> DataFrame:
    """Request statistics per tumbling event-time window; rows later than the watermark are
    dropped, a window is emitted once the watermark passes its end (append mode)."""
    marked = sdf.withWatermark(ts, lateness) if sdf.isStreaming else sdf
    w = marked.groupBy(F.window(ts, window).alias("w"), *(by or []))
    return w.agg(F.count(F.lit(1)).alias("requests"), F.sum(sent).alias("bytes_sent"), F.sum(recv).alias("bytes_received"),
                 F.sum(elapsed).alias("total_elapsed")) \
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *(by or []),
                "requests", "bytes_sent", "bytes_received", "total_elapsed")


def validated_batch(rules: list[tuple[str, Column]], good_path: str, bad_path: str):
    """The sink of X5: (batch, epoch) -> both parts written under the epoch's own folder."""
    def split(batch: DataFrame, epoch: int):
        checked = batch.withColumn("errors", errors(rules)).persist()
        checked.where(F.size("errors") == 0).drop("errors").write.mode("overwrite").parquet(f"{good_path}/epoch={epoch}")
        checked.where(F.size("errors") > 0).write.mode("overwrite").parquet(f"{bad_path}/epoch={epoch}")
        checked.unpersist()
    return split


def open_windows(rows: DataFrame, emitted: DataFrame, ts: str, window: str, **columns) -> DataFrame:
    """X4 at the end of the input: statistics of the windows the watermark has not closed, from the rows at or
    after the last emitted window's end."""
    last = emitted.agg(F.max("window_end")).scalar()
    tail = rows.where(F.coalesce(F.col(ts) >= last, F.lit(True)))
    return stream_request_stats(tail, ts, window, **columns)


def stream_validate(sdf: DataFrame, rules: list[tuple[str, Column]], good_path: str, bad_path: str,
                    checkpoint: str, trigger: dict | None = None):
    """Continuous validation; every micro-batch is split once into accepted rows and
    quarantined rows (with their errors), written to two folders.  Each batch overwrites its own
    ``epoch=<id>`` subfolder, so a batch replayed after a failure is still delivered once.  Returns
    the running query."""
    w = sdf.writeStream.foreachBatch(validated_batch(rules, good_path, bad_path)).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def run_to_parquet(sdf: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Drive a stream over everything available now into a parquet folder and wait for it."""
    q = sdf.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint) \
        .outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()


def run_foreach_batch(sdf: DataFrame, path: str, checkpoint: str, mode: str = "complete") -> None:
    """Drive an aggregating stream (update / complete mode) over everything available now; the
    last state is written with overwrite on every micro-batch."""
    def write(batch: DataFrame, epoch: int):
        batch.write.mode("overwrite").parquet(path)

    q = sdf.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
