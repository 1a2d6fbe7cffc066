"""Helpers shared by the operators of this subpackage: row keys, size-derived blocks, tables written
to the cluster's shared folder, and small numpy routines used inside tasks."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusprep.session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Text bytes that one co-grouped block of documents should hold.
BLOCK_BYTES = 8 << 20
#: Id ranges for work in id order.
ORDERED_BLOCKS = 4096

# Internal columns carry this prefix, so that no column of the caller's can clash with them.
BLOCK, KEY_ID, KEY_HASH = "__cp_block", "__cp_id", "__cp_hash"


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table as a plain scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read again: it cuts lineage,
    outlives any executor, and gives the reader exact sizes."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_row_key(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Two long columns that name a row by its id and text.  Rows that repeat both share a key, and
    every operator here gives such rows the same result, so joining on the key loses nothing."""
    return df.withColumns({
        KEY_ID: F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))),
        KEY_HASH: F.xxhash64(F.col(text_col)),
    })


def block_count(df: DataFrame, text_col: str, block_bytes: int = BLOCK_BYTES) -> int:
    """Blocks of about ``block_bytes`` of text; one narrow aggregate over the text column."""
    total = df.agg(F.sum(F.octet_length(F.col(text_col)).cast("long") + 64).alias("n")).collect()[0]["n"] or 0
    return max(1, -(-int(total) // block_bytes))


def block_of(n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(KEY_ID), F.col(KEY_HASH)), F.lit(n_blocks)).cast("int")


def ordered_blocks(df: DataFrame, text_col: str, block_bytes: int = 2 * BLOCK_BYTES) -> DataFrame:
    """``df`` (with a row key) and the number of the id range each row falls into.  Ranges are meant to
    be sorted and streamed, not held, and there are at least as many as shuffle partitions; their cuts are
    approximate quantiles, ``ORDERED_BLOCKS`` numbers at most.  Equal ids share a range."""
    n = max(block_count(df, text_col, block_bytes), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n = min(ORDERED_BLOCKS, n)
    cuts: list[int] = []
    if n > 1:
        share = [i / n for i in range(1, n)]
        got = df.agg(F.percentile_approx(KEY_ID, share, 20 * n).alias("q")).collect()[0]["q"]
        cuts = sorted(set(got or []))
    return df.withColumn(BLOCK, _bisect(F.col(KEY_ID), cuts).cast("int"))


def _bisect(value: Column, cuts: list[int], base: int = 0) -> Column:
    """The number of cuts at or below the value, as comparisons nested to the logarithm of their number."""
    if not cuts:
        return F.lit(base)
    mid = len(cuts) // 2
    return F.when(value < F.lit(cuts[mid]), _bisect(value, cuts[:mid], base)).otherwise(
        _bisect(value, cuts[mid + 1:], base + mid + 1))


def running_starts(df: DataFrame, order: str, value: str, out: str, width: int = 1000) -> DataFrame:
    """(order, out): the sum of ``value`` over all smaller ``order`` numbers (distinct integers).  Groups
    of ``width`` numbers are summed first, so the one window over everything holds a row per group."""
    d = df.select(F.col(order), F.col(value).alias("__v"), F.floor(F.col(order) / width).alias("__g"))
    before = Window.orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)
    groups = d.groupBy("__g").agg(F.sum("__v").alias("__s")).select("__g", F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__b"))
    inside = Window.partitionBy("__g").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return d.withColumn("__w", F.coalesce(F.sum("__v").over(inside), F.lit(0))).join(groups, "__g") \
        .select(order, (F.col("__w") + F.col("__b")).alias(out))


def byte_texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def str_texts(column: pa.ChunkedArray | pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def slices(batches, rows: int = 500):
    """The batches cut into runs of ``rows`` rows, so that a task holds the Python objects of one run only."""
    for b in batches:
        for a in range(0, b.num_rows, rows):
            yield b.slice(a, rows)


def release_memory() -> None:
    """Gives freed memory back to the system; Python workers outlive their task and wait for the next one."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``f`` on each slice of an Arrow batch of ``df``."""
    def run(batches):
        for b in slices(batches):
            out = f(b)
            if out is not None and out.num_rows:
                yield out
        release_memory()
    return df.mapInArrow(run, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits (public-domain constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(s, s + n)`` for each start and length."""
    lengths = np.asarray(lengths, dtype=np.int64)
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, dtype=np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, dtype=np.int64) - first, lengths)


def components(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest node reachable from each of ``n`` nodes over the links (a, b), by hooking each label
    to the smaller one across a link and halving the paths."""
    label = np.arange(n, dtype=np.int64) if label is None else label
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return label
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        np.minimum.at(label, high, low)
        while True:
            nxt = label[label]
            if np.array_equal(nxt, label):
                break
            label = nxt
