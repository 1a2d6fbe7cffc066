"""Delimited records whose quoted fields span lines, read by as many tasks as the file has ranges.

Spark cuts a text file into byte ranges and hands each task the lines that begin in its range.  Whether a line
begins a record depends on all text before it, but only by one bit: is a quoted field open.  A line maps that
bit to the bit after it, and these maps compose.  So a first pass reduces each range to four numbers (the bit
after it and the records that begin in it, for either bit before it), a window over one row a range gives the bit
each range really begins with, and a second pass cuts the records.  Only a record that crosses a range travels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'
# Bytes of the table of ranges that may be broadcast, and what one of its rows takes at most.
MAX_BROADCAST_BYTES = 64 << 20
RANGE_ROW_BYTES = 1024

SUMMARY = "path string, block long, lines long, open_0 boolean, open_1 boolean, starts_0 long, starts_1 long"
PIECES = "path string, record long, block long, whole boolean, value string"


def ends_open(line: str, sep: str, is_open: bool) -> bool:
    """Is a quoted field open after the line, if one was (``is_open``) before it?  A field is quoted if it begins
    with the quote; a doubled quote inside is text; what follows a closing quote is text up to the separator."""
    at = 0
    if not is_open:
        if line.startswith(QUOTE):
            at = 1
        else:
            at = line.find(sep + QUOTE) + 2
            if at == 1:
                return False
    while True:
        end = line.find(QUOTE, at)
        while end >= 0 and line.startswith(QUOTE, end + 1):
            end = line.find(QUOTE, end + 2)
        if end < 0:
            return True
        at = line.find(sep + QUOTE, end + 1) + 2
        if at == 1:
            return False


def line_maps(quoted: pd.Series, sep: str) -> tuple[np.ndarray, np.ndarray]:
    """(bit after the line if closed before, if open before); null stands for a line without quotes."""
    after_0, after_1 = np.zeros(len(quoted), bool), np.ones(len(quoted), bool)
    for i in np.flatnonzero(quoted.notna().to_numpy()):
        line = quoted.iat[i]
        after_0[i], after_1[i] = ends_open(line, sep, False), ends_open(line, sep, True)
    return after_0, after_1


def bits_before(after_0: np.ndarray, after_1: np.ndarray, bit: bool) -> tuple[np.ndarray, bool]:
    """The bit before every line and the bit after the last, from the bit before the first.  A map either sets the
    bit, keeps it or turns it: the bit is what was set last, turned as often as lines since then turn it."""
    n = len(after_0)
    sets, turns = after_0 == after_1, after_0 & ~after_1
    turned = np.concatenate([[0], np.cumsum(turns)])
    last = np.maximum.accumulate(np.concatenate([[0], np.where(sets, np.arange(1, n + 1), 0)]))
    base = np.concatenate([[bit], after_0])[last]
    bits = base ^ ((turned - turned[last]) & 1).astype(bool)
    return bits[:-1], bool(bits[-1])


def runs(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The stretches of a batch that belong to one range; a task reads its ranges one after the other."""
    path, block = batch["path"], batch["block"]
    cuts = np.flatnonzero(((path != path.shift()) | (block != block.shift())).to_numpy())
    for a, b in zip(cuts, [*cuts[1:], len(batch)]):
        yield batch.iloc[a:b]


def _summaries(sep: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            for part in runs(batch):
                key = (part["path"].iat[0], int(part["block"].iat[0]))
                if held is None or held[:2] != key:
                    if held is not None:
                        yield pd.DataFrame([held], columns=NAMES)
                    held = (*key, 0, False, True, 0, 0)
                maps, blank = line_maps(part["quoted"], sep), part["blank"].to_numpy(bool)
                ends, starts = [], []
                for bit in held[3:5]:
                    before, end = bits_before(*maps, bit)
                    ends.append(end)
                    starts.append(int((~before & ~blank).sum()))
                held = (*key, held[2] + len(part), *ends, held[5] + starts[0], held[6] + starts[1])
        if held is not None:
            yield pd.DataFrame([held], columns=NAMES)
    return run


NAMES = [c.split()[0] for c in SUMMARY.split(", ")]


def _cut(sep: str):
    def flush(key, record, block, head, is_open, parts):
        return (key, record, block, not head and not is_open, "\n".join(parts))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = bit = record = head = seen = expected = None
        parts: list[str] = []

        def close(out, is_open):
            if key is None:
                return
            if seen != expected:
                raise RuntimeError("byte ranges changed between the two passes; set spark.sql.files.minPartitionNum")
            if parts:
                out.append(flush(key[0], record, key[1], head, is_open, parts))

        for batch in batches:
            out: list[tuple] = []
            for part in runs(batch):
                here = (part["path"].iat[0], int(part["block"].iat[0]))
                if here != key:
                    close(out, bit)
                    key, bit, seen, expected = here, bool(part["is_open"].iat[0]), 0, int(part["lines"].iat[0])
                    record, head, parts = int(part["first"].iat[0]) - 1, True, []
                seen += len(part)
                before, bit = bits_before(*line_maps(part["quoted"], sep), bit)
                values, blank = part["value"].tolist(), part["blank"].tolist()
                for i, inside in enumerate(before.tolist()):
                    if inside:
                        parts.append(values[i])
                        continue
                    if parts:
                        out.append(flush(key[0], record, key[1], head, False, parts))
                        parts = []
                    if not blank[i]:
                        record, head, parts = record + 1, False, [values[i]]
            if out:
                yield pd.DataFrame(out, columns=["path", "record", "block", "whole", "value"])
        out = []
        close(out, bit)
        if out:
            yield pd.DataFrame(out, columns=["path", "record", "block", "whole", "value"])
    return run


def read_records(spark: SparkSession, path: str | list[str], sep: str = ",", max_broadcast: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(path, record, value): the records of delimited files, numbered from 0 in each file.  Line breaks inside a
    quoted field are kept; a carriage return that ends a record is dropped; empty lines between records are no
    records; a quote never closed runs to the end of its file.  Empty files give nothing.  Compressed files are one
    range each."""
    raw = spark.read.option("lineSep", "\n").text(path)
    value = F.col("value")
    lines = raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), value,
                       F.when(value.contains(QUOTE), value).alias("quoted"), value.isin("", "\r").alias("blank"))
    ranges = lines.select("path", "block", "quoted", "blank").mapInPandas(_summaries(sep), SUMMARY)
    ranges = _beginnings(ranges)
    known = with_ranges(raw, lines, ranges, max_broadcast)
    known = known.select("path", "block", "is_open", "first", "lines", "quoted", "blank", "value")
    pieces = known.mapInPandas(_cut(sep), PIECES)
    # Pieces of a record lie in different ranges of a file, so the range orders them.
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "value"))), lambda p: p["value"]), "\n")
    crossing = pieces.where(~F.col("whole")).groupBy("path", "record").agg(joined.alias("value"))
    records = pieces.where("whole").select("path", "record", "value").unionByName(crossing)
    return records.withColumn("value", F.regexp_replace("value", "\r$", ""))


def with_ranges(raw: DataFrame, lines: DataFrame, ranges: DataFrame, max_broadcast: int) -> DataFrame:
    """Every line of the scan with the columns of its range, the lines of a range in order in one task.  The table
    of ranges is broadcast if its size allows; else lines travel to their range and are sorted there."""
    # A file's last range may be smaller than a task's share, all others fill one.
    rows = raw.rdd.getNumPartitions() + len(raw.inputFiles())
    if rows * RANGE_ROW_BYTES <= max_broadcast:
        return lines.join(F.broadcast(ranges), ["path", "block"])
    ordered = lines.withColumn("at", F.monotonically_increasing_id())
    return ordered.join(ranges.hint("merge"), ["path", "block"]).repartition("path", "block").sortWithinPartitions("path", "block", "at")


def _beginnings(ranges: DataFrame) -> DataFrame:
    """Every range with the bit it begins with and the number of its first record.  The bit before a range is what
    the last range that sets it left, turned once by every range since then that turns it."""
    by_file = Window.partitionBy("path").orderBy("block")
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    sets = F.col("open_0") == F.col("open_1")
    turns = (F.col("open_0") & ~F.col("open_1")).cast("long")
    turned = F.coalesce(F.sum(turns).over(by_file), F.lit(0))
    out = ranges.withColumn("turned", turned)
    last = F.max(F.when(sets, F.struct("block", "open_0", "turned"))).over(earlier)
    out = out.withColumn("last", last).withColumn("turned_before", F.coalesce(F.lag("turned").over(by_file), F.lit(0)))
    since = F.col("turned_before") - F.coalesce(F.col("last.turned"), F.lit(0))
    is_open = (F.coalesce(F.col("last.open_0"), F.lit(False)).cast("long") + since) % 2 == 1
    out = out.withColumn("is_open", is_open)
    starts = F.when(F.col("is_open"), F.col("starts_1")).otherwise(F.col("starts_0"))
    return out.select("path", "block", "lines", "is_open", F.coalesce(F.sum(starts).over(earlier), F.lit(0)).alias("first"))
