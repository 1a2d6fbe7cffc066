"""Projection, filter, derive (P1-P20) and aggregation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.text import word_count


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- P: projection, filter, derive -------------------------------------------------------------

def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P1"""
    return df.withColumnsRenamed(mapping)


def keep_only(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep exactly these columns; a missing keep column is an error, not a silent drop."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"keep_only: columns not in frame: {missing}")
    return df.select(*cols)


def remove_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """P3"""
    return df.drop(*cols)


def derive(df: DataFrame, **exprs: Column) -> DataFrame:
    """Add or overwrite columns."""
    return df.withColumns(exprs)


def add_column_by_key(df: DataFrame, other: DataFrame, key: str | list[str], how: str = "left") -> DataFrame:
    """P5: attach columns of ``other`` by key (the reference adds them by position)."""
    return df.join(other, key, how)


def lower_not_null(df: DataFrame, c: str) -> DataFrame:
    """Drop null rows first, then lower-case."""
    return df.where(F.col(c).isNotNull()).withColumn(c, F.lower(F.col(c)))


def min_words(df: DataFrame, c: str, n: int) -> DataFrame:
    """Keep rows with strictly more than n words."""
    return df.where(word_count(c) > n)


def any_keyword(c, keywords: list[str]) -> Column:
    """Case-sensitive substring match of any keyword."""
    return reduce(lambda a, b: a | b, [_c(c).contains(k) for k in keywords])


def keep_ratio(df: DataFrame, pred: Column, by: list[str] | None = None) -> DataFrame:
    """Kept, total and kept/total in percent with 2 decimals, in one pass."""
    agg = [
        F.count_if(pred).alias("kept"),
        F.count(F.lit(1)).alias("total"),
        F.round(F.lit(100.0) * F.count_if(pred) / F.count(F.lit(1)), 2).alias("kept_pct"),
    ]
    return df.groupBy(*(by or [])).agg(*agg)


def flag_present(c) -> Column:
    """P10"""
    return _c(c).isNotNull()


def has_items(null_c, list_c) -> Column:
    """Flag column null and list not empty."""
    return _c(null_c).isNull() & (F.size(_c(list_c)) > 0)


def size_not(c, n: int) -> Column:
    """P12"""
    return F.size(_c(c)) != n


def count_not(c, n: int) -> Column:
    """P12 on a count made by the aggregate itself, so that no list of a group is collected."""
    return _c(c) != n


def join_text(cols, sep: str = " \n ") -> Column:
    """Null-safe concatenation, null -> empty string."""
    return F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])


def labelled_text(mapping: dict[str, str | Column]) -> Column:
    """P14: 'Label: value' lines joined by newlines."""
    return F.concat_ws("\n", *[F.concat(F.lit(f"{label}: "), F.coalesce(_c(c).cast("string"), F.lit("")))
                               for label, c in mapping.items()])


def labelled_metadata(mapping: dict[str, str | Column]) -> Column:
    """P14 metadata map."""
    return F.create_map(*[x for k, c in mapping.items() for x in (F.lit(k), _c(c).cast("string"))])


def pick_pair(df: DataFrame, c: str, src: str, tgt: str) -> DataFrame:
    """Two struct fields into two columns."""
    return df.withColumn(src, F.col(f"{c}.{src}")).withColumn(tgt, F.col(f"{c}.{tgt}"))


def task_prefix(c, prefix: str = "summarize: ") -> Column:
    """P16"""
    return F.concat(F.lit(prefix), _c(c))


def min_target_words(df: DataFrame, c: str, n: int) -> DataFrame:
    """Drop pairs whose target has n words or fewer."""
    return min_words(df, c, n)


def id_to_label(c, names: list[str]) -> Column:
    """Class index -> name (literal array; name lists are small by nature)."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), _c(c) + 1)


def label_to_id(c, names: list[str]) -> Column:
    """Name -> class index, null when unknown."""
    pos = F.array_position(F.array(*[F.lit(n) for n in names]), _c(c))
    return F.when(pos > 0, (pos - 1).cast("int"))


def page_route(dynamic, login) -> Column:
    """Login -> dynamic, dynamic -> dynamic, else static."""
    return F.when(_c(login) | _c(dynamic), F.lit("dynamic")).otherwise(F.lit("static"))


def route(df: DataFrame, flag) -> tuple[DataFrame, DataFrame]:
    """P20: rows with the flag true, and the rest (null counts as false)."""
    f = F.coalesce(_c(flag), F.lit(False))
    return df.where(f), df.where(~f)


# --- A: aggregation ----------------------------------------------------------------------------

def key_unique(df: DataFrame, key: str, by: str | list[str] = "split") -> DataFrame:
    """A1: rows and distinct keys per group, with the uniqueness verdict."""
    by = [by] if isinstance(by, str) else by
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("distinct_keys")) \
        .withColumn("unique", F.col("rows") == F.col("distinct_keys"))


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    """A2"""
    return df.select(c).distinct()


def value_counts(df: DataFrame, c: str, value_name: str | None = None, count_name: str = "frequency") -> DataFrame:
    """A3: counts per value, nulls excluded, most frequent first (ties by value)."""
    out = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias(count_name))
    if value_name:
        out = out.withColumnRenamed(c, value_name)
        c = value_name
    return out.orderBy(F.col(count_name).desc(), F.col(c))


def rows_per_split(df: DataFrame, split_col: str = "split") -> DataFrame:
    """A4"""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("rows"))


def expansion_ratio(src: DataFrame, out: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """A5: source rows, produced rows and produced per source row (per group when ``by``).
    Both sides go through one union and one aggregation, so no join (and no cross join) is needed."""
    by = by or []
    key_type = out.schema[key].dataType
    a = src.select(*by, F.lit(1).alias("_s"), F.lit(0).alias("_o"), F.lit(None).cast(key_type).alias("_k"))
    b = out.select(*by, F.lit(0).alias("_s"), F.lit(1).alias("_o"), F.col(key).alias("_k"))
    agg = a.unionByName(b).groupBy(*by).agg(
        F.sum("_s").cast("long").alias("source_rows"), F.sum("_o").cast("long").alias("output_rows"),
        F.count_distinct("_k").alias("sources_used"))
    return agg.withColumn("ratio", F.round(F.col("output_rows") / F.col("source_rows"), 4))


def length_stats(df: DataFrame, length, by: list[str] | None = None, approx_median: bool = False) -> DataFrame:
    """Min, max and mean of a length expression (``F.size`` of ids, ``word_count``...).
    The median is a bounded-memory sketch (``percentile_approx``); an exact median would hold
    every value of a group in one task."""
    size = _c(length)
    aggs = [
        F.min(size).cast("long").alias("min_len"),
        F.max(size).cast("long").alias("max_len"),
        F.round(F.avg(size), 4).alias("mean_len"),
        F.count(F.lit(1)).alias("rows"),
    ]
    if approx_median:
        aggs.append(F.percentile_approx(size, 0.5, 10000).alias("median_len_approx"))
    return df.groupBy(*(by or [])).agg(*aggs)


def length_percentiles(df: DataFrame, length, shares: dict[str, float], by: list[str] | None = None,
                       accuracy: int = 10000) -> DataFrame:
    """The lengths at the given shares of each group's rows, one column per entry of ``shares``.

    Every task keeps one quantile sketch a group, the sketches are merged, and no task holds a group's values.  A
    returned value is a length of the group whose rank is off by about rows / ``accuracy``, and by one or two ranks
    even in small groups once sketches are merged.  Null lengths are not counted; a group without any other gives
    nulls."""
    names = list(shares)
    sketch = F.percentile_approx(_c(length), [float(shares[n]) for n in names], accuracy)
    out = df.groupBy(*(by or [])).agg(F.count(_c(length)).alias("rows"), sketch.alias("_q"))
    return out.select(*(by or []), "rows", *[F.element_at("_q", i + 1).cast("long").alias(n) for i, n in enumerate(names)])


def request_stats(df: DataFrame, by: list[str] | None = None, sent: str = "send_bytes", recv: str = "recv_bytes",
                  elapsed: str = "elapsed") -> DataFrame:
    """Request count, bytes sent/received, total and mean elapsed."""
    return df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum(sent).alias("bytes_sent"),
        F.sum(recv).alias("bytes_received"),
        F.round(F.sum(elapsed), 6).alias("total_elapsed"),
        F.round(F.avg(elapsed), 6).alias("mean_elapsed"),
    )


def format_bytes(c) -> Column:
    """B below 1024, KB below 1024*1024, else MB; two decimals."""
    b = _c(c).cast("double")
    return (F.when(b < 1024, F.format_string("%.2f B", b))
            .when(b < 1024 * 1024, F.format_string("%.2f KB", b / 1024))
            .otherwise(F.format_string("%.2f MB", b / (1024 * 1024))))


def concurrency_report(df: DataFrame, start: str, elapsed: str, by: list[str] | None = None) -> DataFrame:
    """Summed elapsed over wall time (max end - min start), and mean elapsed; seconds."""
    st = F.col(start)  # epoch seconds
    return df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("tasks"),
        F.round(F.sum(elapsed), 6).alias("sum_elapsed"),
        F.round(F.max(st + F.col(elapsed)) - F.min(st), 6).alias("wall_time"),
        F.round(F.avg(elapsed), 6).alias("mean_elapsed"),
    ).withColumn("speedup", F.round(F.col("sum_elapsed") / F.col("wall_time"), 4))


def metric_delta(before: DataFrame, after: DataFrame, key: str = "metric", value: str = "value") -> DataFrame:
    """Absolute and relative change per metric."""
    b = before.select(key, F.col(value).alias("before"))
    a = after.select(key, F.col(value).alias("after"))
    return b.join(a, key, "full").withColumn("delta", F.round(F.col("after") - F.col("before"), 6)) \
        .withColumn("relative", F.round((F.col("after") - F.col("before")) / F.col("before"), 6))
