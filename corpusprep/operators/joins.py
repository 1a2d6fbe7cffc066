"""Joins, set operations and explode.

Join strategy is left to Catalyst + AQE (broadcast when the runtime size allows it, sort-merge
with skew splitting otherwise).  No operator here builds all pairs of a group: the bounded
pairing of J5 is an equi-join on the end position after expanding each start over the
allowed span, and J7 is a block scoring in ``retrieval``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_list(df: DataFrame, other: DataFrame, key: str, c: str, element_type: str = "string") -> DataFrame:
    """Left lookup of a list column; no match -> empty list."""
    return df.join(other.select(key, c), key, "left") \
        .withColumn(c, F.coalesce(F.col(c), F.array().cast(f"array<{element_type}>")))


def replicate_source(chunks: DataFrame, src: DataFrame, key: str) -> DataFrame:
    """Copy every source column onto each chunk (equi-join on the lineage key)."""
    dup = [c for c in src.columns if c in chunks.columns and c != key]
    return chunks.join(src.drop(*dup), key, "inner")


def pair_with_reference(pred: DataFrame, ref: DataFrame, key: str) -> DataFrame:
    """Predictions joined to references by example id."""
    return pred.join(ref, key, "inner")


def features_of(examples: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """Example -> its features (1:N), with the feature count per example."""
    counts = features.groupBy(key).agg(F.count(F.lit(1)).alias("n_features"))
    return examples.join(features, key, "inner").join(counts, key, "inner")


def bounded_pairs(starts: DataFrame, ends: DataFrame, by: list[str], max_len: int,
                  start_col: str = "start_index", end_col: str = "end_index") -> DataFrame:
    """(start, end) pairs of one group with start <= end and end - start + 1 <= max_len.

    Each start is expanded over its max_len possible ends and equi-joined on the end index,
    so the work is O(rows * max_len), never a product of the two sides."""
    expanded = starts.withColumn("_span", F.explode(F.sequence(F.lit(0), F.lit(max_len - 1)))) \
        .withColumn(end_col, F.col(start_col) + F.col("_span")).drop("_span")
    return expanded.join(ends, [*by, end_col], "inner")


def attach_tool_name(parts: DataFrame, conv: str = "conv_id", kind: str = "type", use_id: str = "tool_use_id",
                     name: str = "tool_name") -> DataFrame:
    """Each tool result gets the tool name of the matching call in its conversation, else 'unknown'."""
    calls = parts.where(F.col(kind) == "tool_use").select(conv, use_id, F.col(name).alias("_called"))
    calls = calls.groupBy(conv, use_id).agg(F.first("_called", ignorenulls=True).alias("_called"))
    out = parts.join(calls, [conv, use_id], "left")
    return out.withColumn(name, F.when(F.col(kind) == "tool_result", F.coalesce(F.col("_called"), F.lit("unknown")))
                          .otherwise(F.col(name))).drop("_called")


def ready_rows(df: DataFrame, id_col: str = "id", blocked_by: str = "blockedBy", status: str = "status",
               owner: str = "owner") -> DataFrame:
    """Pending, unowned rows none of whose blockers is unfinished (semi/anti join, no loops)."""
    unfinished = df.where(F.col(status) != "completed").select(F.col(id_col).alias("_blocker"))
    edges = df.select(F.col(id_col), F.explode_outer(F.col(blocked_by)).alias("_blocker")).where(F.col("_blocker").isNotNull())
    blocked = edges.join(unfinished, "_blocker", "left_semi").select(id_col).distinct()
    candidates = df.where((F.col(status) == "pending") & (F.coalesce(F.col(owner), F.lit("")) == ""))
    return candidates.join(blocked, id_col, "left_anti")


def vocab_diff(old: DataFrame, new: DataFrame, token: str = "token") -> DataFrame:
    """Counts of tokens kept, dropped (in old only) and added (in new only)."""
    o = old.select(F.col(token), F.lit(True).alias("_in_old")).distinct()
    n = new.select(F.col(token), F.lit(True).alias("_in_new")).distinct()
    j = o.join(n, token, "full")
    return j.agg(
        F.count_if(F.col("_in_old") & F.col("_in_new")).alias("kept"),
        F.count_if(F.col("_in_old") & F.col("_in_new").isNull()).alias("replaced"),
        F.count_if(F.col("_in_old").isNull() & F.col("_in_new")).alias("added"),
    )


def union_splits(**dfs: DataFrame) -> DataFrame:
    """Union of frames with the same columns, each tagged with its split name."""
    return reduce(lambda a, b: a.unionByName(b), [d.withColumn("split", F.lit(s)) for s, d in dfs.items()])


def explode_list(df: DataFrame, c: str, pos_col: str | None = None) -> DataFrame:
    """One row per list element; an empty or null list keeps one row with null."""
    if pos_col:
        return df.select(*[x for x in df.columns if x != c], F.posexplode_outer(c).alias(pos_col, c))
    return df.withColumn(c, F.explode_outer(c))


def latest_per_key(df: DataFrame, key: str | list[str], ts: str, tie: str | None = None) -> DataFrame:
    """Last write wins per key; one hash aggregation (partial per partition, so a hot key
    costs one state per task, never a sorted group)."""
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(ts), F.col(tie)) if tie else F.col(ts)
    return df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in others]), order).alias("_last")) \
        .select(*keys, "_last.*")
