"""Rows of one large JSON document, read by as many tasks as the file has byte ranges.

The rows are the elements of the array under one top-level key.  Spark reads the file as text between commas.  What
a comma means depends on the text before it by two values: is a string open, and how many brackets are.  A first
pass reduces each range to what it does to them, once for either state of the string; a window over one row a range
gives the values it really begins with and where the array begins and ends; a second pass cuts the elements.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.sources.records import MAX_BROADCAST_BYTES, runs, with_ranges

STEP = np.zeros(256, np.int8)
STEP[list(b"{[")], STEP[list(b"}]")] = 1, -1
QUOTE, COMMA, BACKSLASH = b'",\\'

# Depths are relative to the range's first byte.  ``key_*``: the last of the outermost keys that carry the array's
# name; ``commas_*``: the depths at which commas outside strings occur.
KEY = "struct<depth: long, after: long, low: long>"
FIELDS = {"path": "string", "block": "long", "pieces": "long", "turns": "long", "delta_0": "long", "delta_1": "long", "low_0": "long",
          "low_1": "long", "key_0": KEY, "key_1": KEY, "commas_0": "array<long>", "commas_1": "array<long>"}
SUMMARY = ", ".join(f"{name} {kind}" for name, kind in FIELDS.items())
PIECES = "path string, block long, element long, whole boolean, value string"


def as_bytes(values: list[str]) -> bytes:
    """The bytes of a stretch of pieces; every piece but a file's last ends at a comma."""
    return (",".join(values) + ",").encode("utf-8", "surrogatepass")


def inside_string(data: np.ndarray) -> np.ndarray:
    """1 from an opening quote to the byte before its closing quote, if no string is open before the first byte."""
    quotes = data == QUOTE
    if (data == BACKSLASH).any():
        at = np.arange(len(data))
        other = np.maximum.accumulate(np.where(data != BACKSLASH, at, -1))
        hits = np.flatnonzero(quotes)
        hits = hits[hits > 0]
        quotes[hits[(hits - 1 - other[hits - 1]) % 2 == 1]] = False
    return (np.cumsum(quotes) & 1).astype(np.int8)


def _summaries(name: str):
    wanted = re.compile(re.escape(json.dumps(name, ensure_ascii=False).encode()) + rb"\s*:\s*\[")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None

        def row():
            key, pieces, offset, turns, sides = held
            found = [None if s["key"] is None else dict(zip(("depth", "after", "low"), s["key"])) for s in sides]
            return pd.DataFrame([(*key, pieces, turns, *[s["depth"] for s in sides], *[s["low"] for s in sides], *found,
                                  *[sorted(s["commas"]) for s in sides])], columns=list(FIELDS))

        for batch in batches:
            for part in runs(batch):
                key = (part["path"].iat[0], int(part["block"].iat[0]))
                if held is None or held[0] != key:
                    if held is not None:
                        yield row()
                    held = [key, 0, 0, 0, [{"depth": 0, "low": 0, "key": None, "commas": set()} for _ in (0, 1)]]
                text = as_bytes(part["value"].tolist())
                data = np.frombuffer(text, np.uint8)
                inside = inside_string(data) ^ held[3]
                found = [(m.start(), m.end()) for m in wanted.finditer(text)]
                for bit, side in enumerate(held[4]):
                    outside = inside == bit
                    depth = side["depth"] + np.cumsum(np.where(outside, STEP[data], 0), dtype=np.int64)
                    low = int(depth.min())
                    if side["key"] is not None:
                        side["key"] = (*side["key"][:2], min(side["key"][2], low))
                    for a, b in found:
                        # An opening quote is the first byte of its string.
                        if not outside[a] and (side["key"] is None or depth[a] <= side["key"][0]):
                            side["key"] = (int(depth[a]), held[2] + b, int(depth[b - 1:].min()))
                    side["low"], side["depth"] = min(side["low"], low), int(depth[-1])
                    side["commas"].update(np.unique(depth[outside & (data == COMMA)]).tolist())
                held[1], held[2], held[3] = held[1] + len(part), held[2] + len(data), int(inside[-1])
        if held is not None:
            yield row()
    return run


def _beginnings(ranges: DataFrame) -> DataFrame:
    """The ranges that hold part of the array: open string and depth at their first byte, ``start`` (where the array
    begins in this range, 0 if it began before) and ``head`` (the range in which the element that is open began)."""
    by_file = Window.partitionBy("path").orderBy("block")
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    out = ranges.withColumn("is_open", F.coalesce(F.sum("turns").over(earlier), F.lit(0)) % 2)
    for c in ("delta", "low", "key", "commas"):
        out = out.withColumn(c, F.when(F.col("is_open") == 1, F.col(f"{c}_1")).otherwise(F.col(f"{c}_0")))
    out = out.withColumn("depth", F.coalesce(F.sum("delta").over(earlier), F.lit(0)))
    here = F.when(F.col("depth") + F.col("key.depth") == 1,
                  F.struct("block", F.col("key.after").alias("after"), (F.col("depth") + F.col("key.low")).alias("low")))
    out = out.withColumn("begin", F.max(here).over(Window.partitionBy("path")))
    later = F.col("block") > F.col("begin.block")
    lowest = F.min(F.when(later, F.col("depth") + F.col("low"))).over(earlier)
    over = later & ((F.col("begin.low") < 2) | (F.coalesce(lowest, F.lit(2)) < 2))
    starts = (F.col("block") == F.col("begin.block")) | (later & F.array_contains("commas", 2 - F.col("depth")))
    out = out.withColumn("head", F.max(F.when(starts, F.col("block"))).over(earlier)).withColumn("over", over)
    start = F.when(later, F.lit(0)).otherwise(F.col("begin.after")).alias("start")
    kept = out.where((F.col("block") >= F.col("begin.block")) & ~F.col("over"))
    return kept.select("path", "block", "pieces", "is_open", "depth", start, F.when(later, F.col("head")).alias("head"))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key = None
    bit = depth = offset = start = seen = expected = element = 0
    whole = done = False
    parts: list[bytes] = []

    def emit(out, is_whole):
        text = b"".join(parts).decode("utf-8", "surrogatepass")
        if text:
            out.append((*key, element, is_whole, text))

    def close(out):
        if key is None:
            return
        if seen != expected:
            raise RuntimeError("byte ranges changed between the two passes; set spark.sql.files.minPartitionNum")
        if not done:
            emit(out, False)

    for batch in batches:
        out: list[tuple] = []
        for part in runs(batch):
            here = (part["path"].iat[0], int(part["block"].iat[0]))
            if here != key:
                close(out)
                first = part.iloc[0]
                key, seen, expected, offset, done, parts = here, 0, int(first["pieces"]), 0, False, []
                bit, depth, start = int(first["is_open"]), int(first["depth"]), int(first["start"])
                whole = pd.isna(first["head"])
                element = here[1] if whole else int(first["head"])
            seen += len(part)
            if done:
                continue
            text = as_bytes(part["value"].tolist())
            data = np.frombuffer(text, np.uint8)
            inside = inside_string(data) ^ bit
            depths = depth + np.cumsum(np.where(inside == 0, STEP[data], 0), dtype=np.int64)
            at = max(0, start - offset)
            bit, depth, offset = int(inside[-1]), int(depths[-1]), offset + len(data)
            if at >= len(data):
                continue
            ends = np.flatnonzero(depths[at:] < 2)
            stop = at + int(ends[0]) if len(ends) else len(data)
            for comma in np.flatnonzero((data[at:stop] == COMMA) & (inside[at:stop] == 0) & (depths[at:stop] == 2)) + at:
                parts.append(text[at:comma])
                emit(out, whole)
                at, whole, element, parts = comma + 1, True, key[1], []
            parts.append(text[at:stop])
            if len(ends):
                emit(out, whole)
                done, parts = True, []
        if out:
            yield pd.DataFrame(out, columns=["path", "block", "element", "whole", "value"])
    out = []
    close(out)
    if out:
        yield pd.DataFrame(out, columns=["path", "block", "element", "whole", "value"])


def read_elements(spark: SparkSession, path: str | list[str], name: str, max_broadcast: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(path, value): the elements of the array under the key ``name`` of the object that each file holds, as JSON
    text.  No key, another type than an array or an empty array or file give nothing; of a repeated key the last
    counts.  A document that breaks off gives what it holds.  A compressed file is one range."""
    if "," in name:
        raise ValueError("the key may not hold a comma")
    raw = spark.read.option("lineSep", ",").text(path)
    pieces = raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
    ranges = _beginnings(pieces.mapInPandas(_summaries(name), SUMMARY))
    known = with_ranges(raw, pieces, ranges, max_broadcast).select("path", "block", "pieces", "is_open", "depth", "start", "head", "value")
    cut = known.mapInPandas(_cut, PIECES)
    # Pieces of an element lie in different ranges of a file, so the range orders them.
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "value"))), lambda p: p["value"]), "")
    crossing = cut.where(~F.col("whole")).groupBy("path", "element").agg(joined.alias("value")).select("path", "value")
    return cut.where("whole").select("path", "value").unionByName(crossing).where(F.trim(F.translate("value", "\n\r\t", "   ")) != "")


def read_rows(spark: SparkSession, path: str | list[str], name: str, schema: T.StructType) -> DataFrame:
    """The elements as rows; a null element is a row of nulls."""
    return read_elements(spark, path, name).select(F.from_json("value", schema).alias("row")).select("row.*")
