"""Sort, limit, sample, split and batch.

Rows have no position in Spark, so every positional operator takes an explicit order and
breaks ties by key.  ``global_rank`` (L6) is the distributed replacement of a row index:
range partitioning (balanced by sampling, so a hot value cannot pile up in one task when
the key is part of the order), a reliable checkpoint that fixes partition contents, one
count per partition, running offsets over that tiny table, and the in-partition position.
No window without ``partitionBy`` ever touches the data itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.session import cut_lineage


def _cols(cs) -> list[Column]:
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def seeded_key(key, seed: int) -> Column:
    """md5 of ``seed:key`` as hex; the same order in Spark SQL and in DuckDB."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _cols(key)[0].cast("string")))


def seeded_uniform(*parts) -> Column:
    """Uniform [0,1) number from the first 8 hex digits of md5 over the joined parts."""
    h = F.md5(F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def below(digits: Column, share: float) -> Column:
    """Whether the number in [0, 1) that eight hex digits stand for is below ``share`` (0 to 1): equal digits long, they
    compare as strings, without being converted."""
    cut = math.ceil(share * (1 << 32))
    return digits < F.lit(f"{cut:08x}") if cut < 1 << 32 else F.lit(True)


def sort_take(df: DataFrame, by, n: int, ascending: bool = False) -> DataFrame:
    """L1: sort by a (derived) column and take the first n (a TopK, no full sort)."""
    order = [c.asc() if ascending else c.desc() for c in _cols(by)]
    return df.orderBy(*order).limit(n)


def select_range(df: DataFrame, order_by, n: int) -> DataFrame:
    """L2: first n rows of a defined order."""
    return df.orderBy(*_cols(order_by)).limit(n)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """L3: repeatable shuffle sample of n rows."""
    return df.orderBy(seeded_key(key, seed), F.col(key)).limit(n)


def global_rank(df: DataFrame, order_by, rank_col: str = "rank", partitions: int | None = None,
                with_total: bool = False):
    """1-based dense position of every row in ``order_by`` (which must be unique; add the key).

    Returns the ranked frame, and the row total as well when ``with_total``.
    """
    order = _cols(order_by)
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(n, *order).sortWithinPartitions(*order))
    tagged = ranged.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # Tiny frame: one row per partition, so the un-partitioned window is harmless.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"), "_n")
    offsets = cut_lineage(offsets)
    ranked = tagged.join(F.broadcast(offsets.select("_pid", "_off")), "_pid") \
        .withColumn(rank_col, F.col("_off") + (F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)) + 1) \
        .drop("_pid", "_mid", "_off")
    if with_total:
        total = offsets.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
        return ranked, int(total)
    return ranked


#: Hex digits added to the prefix at each step of the search for a cut: a histogram has at most 16^4 rows.
CUT_DIGITS = 4
HASH_DIGITS = 32


def cut_points(hashes: DataFrame, cuts: list[int], col: str = "_h") -> list[tuple[str, int, int]]:
    """For each cut the (prefix, taken, held) of the hash order: rows whose hash has a smaller prefix lie before the
    cut, and so do ``taken`` of the ``held`` rows with this prefix.

    A step counts the rows by prefix and goes on, with a longer prefix, only inside the prefixes that hold a cut, until
    each cut falls between two prefixes or the whole hash is used up (rows of equal keys)."""
    found: list[tuple[str, int, int] | None] = [None if c > 0 else ("", 0, 1) for c in cuts]
    inside = {i: ("", c) for i, c in enumerate(cuts) if c > 0}
    width = 0
    while inside:
        width += CUT_DIGITS
        starts = sorted({p for p, _ in inside.values()})
        rows = hashes if starts == [""] else hashes.where(F.substring(col, 1, width - CUT_DIGITS).isin(starts))
        counts = sorted((r[0], r[1]) for r in rows.groupBy(F.substring(col, 1, width).alias("p")).count().collect())
        for i, (prefix, need) in list(inside.items()):
            del inside[i]
            found[i] = ("", 1, 1)  # the cut lies behind the last row
            for p, held in counts:
                if not p.startswith(prefix):
                    continue
                if need <= held:
                    found[i] = (p, need, held)
                    if need < held and width < HASH_DIGITS:
                        inside[i] = (p, need)
                    break
                need -= held
    return found


def seeded_cut_labels(df: DataFrame, key: str, seed: int, cuts: list[int], labels: list[str],
                      split_col: str = "split", rest: str | None = None) -> DataFrame:
    """Label rows by their position in the seeded md5 order: rows before ``cuts[0]`` get
    ``labels[0]``, before ``cuts[1]`` ``labels[1]`` ... and the rest ``rest`` (dropped if None).

    The table is only scanned, never shuffled: the cuts are found from histograms of hash prefixes and each row
    compares its hash with them.  Only where a cut falls inside the rows of one repeated key are those rows ranked
    (``global_rank``), in the order Spark reads them.  Rows without a key come first, as rows of one key."""
    base = df.withColumn("_h", F.coalesce(seeded_key(key, seed), F.lit("0" * HASH_DIGITS)))
    points = cut_points(base.select("_h"), cuts)
    tied = {p: held for p, taken, held in points if 0 < taken < held}

    def slotted(rows: DataFrame, place: Column | None = None) -> DataFrame:
        slot = F.lit(len(cuts))
        for i in reversed(range(len(cuts))):
            prefix, taken, held = points[i]
            mine = F.substring("_h", 1, len(prefix))
            before = mine <= prefix if taken == held else mine < prefix
            if place is not None and prefix in tied and taken < held:
                before = before | ((F.col("_h") == prefix) & (place <= taken))
            slot = F.when(before, F.lit(i)).otherwise(slot)
        return rows.withColumn("_slot", slot)

    if tied:
        ranked = global_rank(base.where(F.col("_h").isin(*tied)).withColumn("_m", F.monotonically_increasing_id()),
                             ["_h", "_m"], "_r")
        skipped = F.lit(0)
        for p in tied:
            skipped = F.when(F.col("_h") == p, F.lit(sum(n for q, n in tied.items() if q < p))).otherwise(skipped)
        out = slotted(base.where(~F.col("_h").isin(*tied))) \
            .unionByName(slotted(ranked, F.col("_r") - skipped).drop("_m", "_r"))
    else:
        out = slotted(base)
    names = F.array(*[F.lit(x) for x in labels + ([rest] if rest is not None else [])])
    if rest is None:
        out = out.where(F.col("_slot") < len(cuts))
    return out.withColumn(split_col, F.element_at(names, F.col("_slot") + 1)).drop("_slot", "_h")


def split_fraction(df: DataFrame, key: str, fraction: float, seed: int = 42,
                   names: tuple[str, str] = ("train", "test"), split_col: str = "split") -> DataFrame:
    """L4: exact sizes floor(n*f) and the rest, chosen by the seeded md5 order."""
    n = df.count()
    return seeded_cut_labels(df, key, seed, [int(n * fraction)], [names[0]], split_col, rest=names[1])


def split_counts(df: DataFrame, key: str, train: int, test: int, seed: int = 42,
                 names: tuple[str, str] = ("train", "test"), split_col: str = "split") -> DataFrame:
    """Exact train and test counts; the remainder is dropped."""
    return seeded_cut_labels(df, key, seed, [train, train + test], list(names), split_col, rest=None)


def relabel_splits(df: DataFrame, mapping: dict[str, str], held_out: DataFrame | None = None,
                   held_out_name: str = "test", split_col: str = "split") -> DataFrame:
    """Rename split labels and attach a held-out split."""
    relabel = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), F.col(split_col)),
                         F.col(split_col))
    out = df.withColumn(split_col, relabel)
    if held_out is not None:
        out = out.unionByName(held_out.withColumn(split_col, F.lit(held_out_name)), allowMissingColumns=True)
    return out


def assign_batches(df: DataFrame, order_by, size: int, batch_col: str = "batch_id") -> DataFrame:
    """batch_id = floor((rank-1)/size); the batch count is ceil(n/size)."""
    ranked = global_rank(df, order_by, "_r")
    return ranked.withColumn(batch_col, F.floor((F.col("_r") - 1) / size).cast("long")).withColumnRenamed("_r", "position")


def clamp_recent(n) -> int:
    """L9 limit rule: missing or zero -> 20, then clamped to 1..200."""
    return max(1, min(int(n or 20), 200))


def recent(df: DataFrame, ts, n: int | None = 20, key: str | None = None) -> DataFrame:
    """The last n rows by time (newest last in the order of the log)."""
    order = _cols(ts) + ([F.col(key)] if key else [])
    return df.orderBy(*[c.desc() for c in order]).limit(clamp_recent(n))


def top1_per_group(df: DataFrame, by, score: str, key: str) -> DataFrame:
    """The best-scoring row per group (ties -> smallest numeric key); one hash aggregation with
    map-side partial results, so a hot group costs one small state, not a sorted window."""
    by_cols = [by] if isinstance(by, str) else list(by)
    others = [c for c in df.columns if c not in by_cols]
    best = F.max_by(F.struct(*[F.col(c) for c in others]),
                    F.struct(F.col(score), -F.col(key)))
    return df.groupBy(*by_cols).agg(best.alias("_b")).select(*by_cols, "_b.*")


def score_cut(df: DataFrame, score: str, threshold: float) -> DataFrame:
    """Keep rows scoring strictly above the threshold."""
    return df.where(F.col(score) > threshold)


def columnar_slice(df: DataFrame, order_by, n: int, cols: list[str] | None = None) -> DataFrame:
    """The first n rows as one row of lists (one list per column)."""
    cols = cols or df.columns
    order = _cols(order_by)
    head = df.orderBy(*order).limit(n).withColumn("_o", F.struct(*order))
    packed = head.agg(F.sort_array(F.collect_list(F.struct(F.col("_o"), *[F.col(c) for c in cols]))).alias("_rows"))
    return packed.select(*[F.col("_rows").getField(c).alias(c) for c in cols])


def running_total(df: DataFrame, group: str | list[str], order: str, value, out: str, width: int = 4096) -> DataFrame:
    """Inclusive running sum of ``value`` per group in ``order`` (numeric, unique inside a group),
    safe for a hot group.  Rows are cut into order ranges of ``width``; one aggregation gives every
    (group, range) its total, a window over those few range rows gives its offset, and the running
    sum inside a range is a window over at most ``width`` rows.  A group holding a third of the
    data is therefore spread over ranges instead of being sorted in one task."""
    groups = [group] if isinstance(group, str) else list(group)
    v = F.col(value) if isinstance(value, str) else value
    t = df.withColumn("_rb", F.floor(F.col(order) / width)).withColumn("_rv", v)
    totals = t.groupBy(*groups, "_rb").agg(F.sum("_rv").alias("_rt"))
    before = Window.partitionBy(*groups).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*groups, "_rb", F.coalesce(F.sum("_rt").over(before), F.lit(0)).alias("_ro"))
    inside = Window.partitionBy(*groups, "_rb").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return t.join(offsets, [*groups, "_rb"]).withColumn(out, F.col("_ro") + F.sum("_rv").over(inside)) \
        .drop("_rb", "_rv", "_ro")


def neighbor_values(df: DataFrame, group: str | list[str], order: str, cols: list[str], offset: int = -1,
                    prefix: str = "prev_") -> DataFrame:
    """Values of the row ``offset`` places away inside its group (lag: -1, lead: +1), safe for a
    hot group: the dense position comes from ``running_total`` and the neighbour is found by an
    equi-join on (group, position), which spreads a huge group over many tasks instead of sorting
    it in one window partition."""
    groups = [group] if isinstance(group, str) else list(group)
    pos = running_total(df, groups, order, F.lit(1), "_npos")
    other = pos.select(*groups, (F.col("_npos") - offset).alias("_npos"), *[F.col(c).alias(prefix + c) for c in cols])
    return pos.join(other, [*groups, "_npos"], "left").drop("_npos")
