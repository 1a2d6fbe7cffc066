"""Training-sequence construction (Q1-Q21) on id arrays.

Everything per row is a native higher-order array expression.  Positional operators that span
rows (packing Q11/Q12, batch padding Q14) use ``ranking.global_rank`` for positions and windows
partitioned by a bounded group (a pack group of 1000 rows, a batch), never a global window.
Packing emits one slice per (row, chunk) it overlaps instead of one row per token.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions.batches import items_at, list_array, list_sizes, parts
from corpusprep.functions.hashes import numbered_draws
from corpusprep.operators.ranking import below, global_rank
from corpusprep.operators.vocab import SPECIAL_IDS

# Ids of the special tokens and the label that losses ignore.
PAD_ID = SPECIAL_IDS["[PAD]"]
CLS_ID = SPECIAL_IDS["[CLS]"]
SEP_ID = SPECIAL_IDS["[SEP]"]
MASK_ID = SPECIAL_IDS["[MASK]"]
IGNORE = -100


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _int_array(*vals) -> Column:
    return F.array(*[F.lit(v).cast("int") for v in vals])


def single_template(ids, max_length: int | None = None, cls: int = CLS_ID, sep: int = SEP_ID) -> Column:
    """Q1 (+Q3): [CLS] a [SEP], content cut so the whole fits max_length; struct of
    input_ids, token_type_ids (all 0) and attention_mask (all 1)."""
    body = _c(ids) if max_length is None else F.slice(_c(ids), 1, max_length - 2)
    input_ids = F.concat(_int_array(cls), body, _int_array(sep))
    n = F.size(input_ids)
    return F.struct(input_ids.alias("input_ids"), F.array_repeat(F.lit(0), n).alias("token_type_ids"),
                    F.array_repeat(F.lit(1), n).alias("attention_mask"))


def pair_template(a, b, cls: int = CLS_ID, sep: int = SEP_ID) -> Column:
    """Q2 (+Q8): [CLS] a [SEP] b [SEP]; type ids 0 for the first part with its specials, 1 after;
    sequence ids null for specials, 0 / 1 for the parts."""
    ids = F.concat(_int_array(cls), _c(a), _int_array(sep), _c(b), _int_array(sep))
    types = F.concat(F.array_repeat(F.lit(0), F.size(_c(a)) + 2), F.array_repeat(F.lit(1), F.size(_c(b)) + 1))
    null_int = F.lit(None).cast("int")
    seq_ids = F.concat(F.array(null_int), F.array_repeat(F.lit(0), F.size(_c(a))), F.array(null_int),
                       F.array_repeat(F.lit(1), F.size(_c(b))), F.array(null_int))
    return F.struct(ids.alias("input_ids"), types.alias("token_type_ids"),
                    F.array_repeat(F.lit(1), F.size(ids)).alias("attention_mask"), seq_ids.alias("sequence_ids"))


def truncate_ids(c, n: int) -> Column:
    """Q3"""
    return F.slice(_c(c), 1, n)


def overflow_chunks(df: DataFrame, key: str, c: str, n: int, specials: bool = True) -> DataFrame:
    """Q4: consecutive windows of the id array, each holding n ids with its specials (n-2 content);
    the source key is kept on every chunk (overflow-to-sample mapping)."""
    width = n - 2 if specials else n
    starts = F.sequence(F.lit(0), F.greatest(F.size(c) - 1, F.lit(0)), F.lit(width))
    ex = df.where(F.size(c) > 0).select("*", F.posexplode(starts).alias("chunk_id", "_s"))
    body = F.slice(c, F.col("_s") + 1, width)
    ids = F.concat(_int_array(CLS_ID), body, _int_array(SEP_ID)) if specials else body
    return ex.withColumn("input_ids", ids).drop("_s")


def sliding_windows(df: DataFrame, key: str, first: str, second: str, n: int, stride: int) -> DataFrame:
    """Q5: windows over the second part; each holds the whole first part, overlaps the previous
    window by ``stride`` ids and stops at the first window that reaches the end."""
    payload = F.lit(n - 3) - F.size(first)
    step = payload - F.lit(stride)
    total = F.size(second)
    last = F.when(total <= payload, F.lit(0)).otherwise(F.ceil((total - payload) / step) * step)
    ex = df.select("*", F.posexplode(F.sequence(F.lit(0), last.cast("int"), step.cast("int"))).alias("window_id", "_s"))
    part = F.slice(second, F.col("_s") + 1, payload.cast("int"))
    tpl = pair_template(F.col(first), part)
    return ex.withColumn("_t", tpl).select("*", "_t.*").withColumn("context_start", F.col("_s")).drop("_t", "_s")


def _spans(offsets: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of all tokens; the span of a null one holds nothing."""
    sizes, flat = list_sizes(offsets), offsets.flatten()
    start, end = (pc.fill_null(pc.struct_field(flat, i), v).to_numpy(zero_copy_only=False) for i, v in ((0, np.iinfo(np.int32).max), (1, -1)))
    return np.repeat(np.arange(len(sizes)), sizes), start, end


def char_to_token(offsets, pos):
    """Q9: index of the token whose [start, end) holds the character, null when none.  Like the others of Q9 it takes
    columns, or Arrow arrays inside a task."""
    if isinstance(offsets, pa.Array):
        row, start, end = _spans(offsets)
        known = pos.is_valid().to_numpy(zero_copy_only=False)[row]
        at = pc.fill_null(pos, -1).to_numpy(zero_copy_only=False)[row]
        hit = np.flatnonzero(known & (start <= at) & (end > at))
        rows, first = np.unique(row[hit], return_index=True)
        sizes = list_sizes(offsets)
        out, found = np.zeros(len(sizes), dtype=np.int32), np.zeros(len(sizes), dtype=bool)
        out[rows], found[rows] = hit[first] - (np.cumsum(sizes) - sizes)[rows], True
        return pa.array(out, mask=~found)
    i = F.array_position(F.transform(_c(offsets), lambda o: (o["start"] <= pos) & (o["end"] > pos)), True)
    return F.when(i > 0, (i - 1).cast("int"))


def token_to_chars(offsets, i):
    """Q9"""
    if isinstance(offsets, pa.Array):
        return items_at(offsets, i)
    return F.element_at(_c(offsets), F.lit(i) + 1 if isinstance(i, int) else i + 1)


def char_to_word(offsets, word_ids, pos):
    """Q9"""
    t = char_to_token(offsets, pos)
    if isinstance(offsets, pa.Array):
        return items_at(word_ids, t)
    return F.element_at(_c(word_ids), t + 1)


def word_to_chars(offsets, word_ids, w):
    """Q9: (start, end) span of all tokens of a word."""
    if isinstance(offsets, pa.Array):
        row, start, end = _spans(offsets)
        hit = np.flatnonzero(pc.fill_null(pc.equal(word_ids.flatten(), w.take(pa.array(row))), False).to_numpy(zero_copy_only=False))
        first, last = np.full(len(offsets), np.iinfo(np.int32).max), np.full(len(offsets), -1)
        np.minimum.at(first, row[hit], start[hit])
        np.maximum.at(last, row[hit], end[hit])
        return pa.StructArray.from_arrays([pa.array(x.astype(np.int32), mask=last < 0) for x in (first, last)], names=["start", "end"])
    z = F.filter(F.arrays_zip(_c(offsets).alias("o"), _c(word_ids).alias("w")), lambda x: x["w"] == w)
    return F.struct(F.array_min(F.transform(z, lambda x: x["o"]["start"])).alias("start"),
                    F.array_max(F.transform(z, lambda x: x["o"]["end"])).alias("end"))


def full_chunks(df: DataFrame, key: str, c: str, n: int) -> DataFrame:
    """Q10: windows of exactly n ids, no specials; the short tail is dropped."""
    return overflow_chunks(df, key, c, n, specials=False).where(F.size("input_ids") == n)


def pack(df: DataFrame, order_by, c: str, n: int, group: int = 1000) -> DataFrame:
    """Q11: rows in ``order_by`` order form groups of ``group`` rows; inside a group the id arrays
    are concatenated and cut into n-id blocks, the remainder of each group dropped; labels = ids."""
    ranked = global_rank(df.select(*([order_by] if isinstance(order_by, str) else order_by), c), order_by, "_r")
    ranked = ranked.withColumn("pack_group", F.floor((F.col("_r") - 1) / group).cast("long")) \
        .withColumn("_len", F.size(c))
    w = Window.partitionBy("pack_group").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("_off", F.coalesce(F.sum("_len").over(w), F.lit(0)))
    wt = Window.partitionBy("pack_group")
    ranked = ranked.withColumn("_full", F.floor(F.sum("_len").over(wt) / n))
    # Chunks this row overlaps: from off div n to (off+len-1) div n, only the full ones.
    first = F.floor(F.col("_off") / n)
    last = F.least(F.floor((F.col("_off") + F.col("_len") - 1) / n), F.col("_full") - 1)
    rows = ranked.where((F.col("_len") > 0) & (first <= last)) \
        .select("pack_group", "_r", "_off", c, F.explode(F.sequence(first, last)).alias("chunk"))
    lo = F.greatest(F.col("chunk") * n - F.col("_off"), F.lit(0))
    hi = F.least((F.col("chunk") + 1) * n - F.col("_off"), F.size(c))
    pieces = rows.select("pack_group", "chunk", "_r", F.slice(c, (lo + 1).cast("int"), (hi - lo).cast("int")).alias("_p"))
    packed = pieces.groupBy("pack_group", "chunk").agg(F.sort_array(F.collect_list(F.struct("_r", "_p"))).alias("_ps"))
    ids = F.flatten(F.transform("_ps", lambda s: s["_p"]))
    return packed.select("pack_group", "chunk", ids.alias("input_ids"), ids.alias("labels"))


def pack_with_eos(df: DataFrame, order_by, c: str, n: int, eos: int, group: int = 1000) -> DataFrame:
    """Q12: an end-of-sequence id appended to every row before packing."""
    return pack(df.withColumn(c, F.concat(F.col(c), _int_array(eos))), order_by, c, n, group)


def pad_to(c, n, pad: int = PAD_ID) -> Column:
    """Q13: right padding to length n (longer arrays unchanged)."""
    return F.concat(_c(c), F.array_repeat(F.lit(pad), F.greatest(F.lit(0) + n - F.size(_c(c)), F.lit(0))))


def attention_mask(c, n) -> Column:
    return F.concat(F.array_repeat(F.lit(1), F.size(_c(c))), F.array_repeat(F.lit(0), F.greatest(F.lit(0) + n - F.size(_c(c)), F.lit(0))))


def pad_batch(df: DataFrame, batch: str, cols: dict[str, int]) -> DataFrame:
    """Q14: pad each listed column to the longest row of its batch (window per batch, bounded)."""
    first = next(iter(cols))
    w = Window.partitionBy(batch)
    out = df.withColumn("_maxlen", F.max(F.size(first)).over(w))
    out = out.withColumn("attention_mask", attention_mask(first, F.col("_maxlen")))
    for c, pad in cols.items():
        out = out.withColumn(c, pad_to(c, F.col("_maxlen"), pad))
    return out.drop("_maxlen")


def pad_labels(c, n) -> Column:
    """Q15"""
    return pad_to(c, n, IGNORE)


def mask_tokens(ids, key, seed: int, p: float = 0.15, vocab_size: int = 30522, first_random: int = 1000,
                specials=tuple(SPECIAL_IDS.values())) -> Column:
    """Q16: each non-special id is picked with probability p (seeded md5 draw per key and position);
    of those 80% -> [MASK], 10% -> a random id in [first_random, vocab_size), 10% unchanged.
    Returns struct(input_ids, labels) with labels -100 where not picked."""
    spec = F.array(*[F.lit(s) for s in specials])

    def draw(h, at):
        return F.conv(F.substring(h, at, 8), 16, 10).cast("double") / F.lit(4294967296.0)

    # one md5 per token; three runs of its digits are the three draws, converted only where a number is made of them
    hashed = F.transform(_c(ids), lambda x, i: F.struct(
        x.alias("x"), F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"), i.cast("string"))).alias("h")))
    drawn = F.transform(hashed, lambda e: F.struct(
        e["x"].alias("x"), e["h"].alias("h"), (below(F.substring(e["h"], 1, 8), p) & ~F.array_contains(spec, e["x"])).alias("pick")))
    both = F.transform(drawn, lambda e: F.struct(
        F.when(~e["pick"], e["x"]).when(below(F.substring(e["h"], 9, 8), 0.8), F.lit(MASK_ID))
        .when(below(F.substring(e["h"], 9, 8), 0.9), (F.floor(draw(e["h"], 17) * (vocab_size - first_random)) + first_random).cast("int"))
        .otherwise(e["x"]).alias("input_ids"),
        F.when(e["pick"], e["x"]).otherwise(F.lit(IGNORE)).alias("labels")))
    return F.struct(both["input_ids"].alias("input_ids"), both["labels"].alias("labels"))


def word_runs(word_ids) -> Column:
    """Run number per token: a run ends when the word id changes; null ids get null and do not
    end a run (equal ids around a special count as one word).  One fold per row."""
    return _runs(_c(word_ids))


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _runs(word_ids: pa.Array) -> pa.Array:
    rows = pa.RecordBatch.from_arrays([word_ids], names=["ids"])
    done = [_numbered(part.column(0)) for part in parts(rows, list_sizes(word_ids))]
    return pa.concat_arrays(done) if done else pa.array([], pa.list_(pa.int32()))


def _numbered(word_ids: pa.ListArray) -> pa.ListArray:
    sizes = list_sizes(word_ids)
    flat = word_ids.flatten()
    known = flat.is_valid().to_numpy(zero_copy_only=False)
    ids, row = flat.drop_null().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes)[known]
    new_row = np.ones(len(ids), dtype=bool)
    new_row[1:] = row[1:] != row[:-1]
    changed = new_row.copy()
    changed[1:] |= ids[1:] != ids[:-1]
    run = np.cumsum(changed)
    first = run[new_row]  # of every row that has ids
    out = np.zeros(len(known), dtype=np.int32)
    out[known] = run - np.repeat(first, np.diff(np.append(np.flatnonzero(new_row), len(ids))))
    return list_array(np.concatenate([[0], np.cumsum(sizes)]), pa.array(out, pa.int32(), mask=~known))


@F.arrow_udf(T.StructType([T.StructField("input_ids", T.ArrayType(T.IntegerType())), T.StructField("labels", T.ArrayType(T.IntegerType()))]))
def _masked(ids: pa.Array, word_ids: pa.Array, prefixes: pa.Array, cuts: pa.Array) -> pa.Array:
    rows = pa.RecordBatch.from_arrays([ids, word_ids, prefixes, cuts], names=["ids", "word_ids", "prefixes", "cuts"])
    done = [_masked_words(*part.columns) for part in parts(rows, np.maximum(list_sizes(ids), list_sizes(word_ids)))]
    return pa.concat_arrays(done) if done else _masked_words(ids, word_ids, prefixes, cuts)


def _filled(lists: pa.ListArray, sizes: np.ndarray) -> pa.ListArray:
    """The lists with nulls at their ends, so that they have the given sizes."""
    if np.array_equal(list_sizes(lists), sizes):
        return lists
    return pa.array([[*(x or ()), *[None] * (n - len(x or ()))] for x, n in zip(lists.to_pylist(), sizes.tolist())], lists.type)


def _masked_words(ids: pa.ListArray, word_ids: pa.ListArray, prefixes: pa.Array, cuts: pa.Array) -> pa.StructArray:
    """Masked ids and labels of all rows at once: one draw for every word."""
    sizes = np.maximum(list_sizes(ids), list_sizes(word_ids))
    runs = _filled(_numbered(word_ids), sizes).flatten()
    known = runs.is_valid().to_numpy(zero_copy_only=False)
    run, row = pc.fill_null(runs, -1).to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)
    n_runs = np.zeros(len(sizes), dtype=np.int64)
    np.maximum.at(n_runs, row, run + 1)
    drawn = numbered_draws(prefixes, n_runs) < (cuts[0].as_py() if len(cuts) else 0)
    picked = np.zeros(len(run), dtype=bool)
    picked[known] = drawn[(np.cumsum(n_runs) - n_runs)[row[known]] + run[known]]
    x, picked = _filled(ids, sizes).flatten(), pa.array(picked)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    made = [pc.if_else(picked, pa.scalar(MASK_ID, pa.int32()), x), pc.if_else(picked, x, pa.scalar(IGNORE, pa.int32()))]
    return pa.StructArray.from_arrays([list_array(ends, m, ids.is_null()) for m in made], names=["input_ids", "labels"])


def mask_words(ids, word_ids, key, seed: int, p: float = 0.2):
    """Q17: every word (run of equal word ids) is masked with probability p; all its ids become
    [MASK]; labels keep the original id there only.  One draw by the md5 of seed, key and word (``seeded_uniform``).
    Columns, or Arrow arrays inside a task, where ``key`` is the prefix of the hashed text."""
    if isinstance(ids, pa.Array):
        return _masked_words(ids, word_ids, key, pa.array([math.ceil(p * (1 << 32))] * len(ids)))
    prefix = F.concat(F.concat_ws(":", F.lit(str(seed)), F.lit("w"), key.cast("string")), F.lit(":"))
    return _masked(_c(ids).cast("array<int>"), _c(word_ids).cast("array<int>"), prefix, F.lit(math.ceil(p * (1 << 32))).cast("long"))


def freeze_masks(df: DataFrame, key: str, ids: str, seed: int, path: str, p: float = 0.15) -> DataFrame:
    """Q18: mask once with a fixed seed, write, read back with the masked columns renamed to the
    model's input names."""
    m = df.withColumn("_m", mask_tokens(ids, F.col(key), seed, p)) \
        .select("*", F.col("_m.input_ids").alias("masked_input_ids"), F.col("_m.labels").alias("masked_labels")).drop("_m")
    m.drop(ids).write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.parquet(path)
    return back.withColumnsRenamed({"masked_input_ids": "input_ids", "masked_labels": "labels"})


def next_token_labels(c) -> Column:
    """Q19: inputs ids[:-1], labels ids[1:]."""
    n = F.size(_c(c))
    return F.struct(F.slice(_c(c), 1, F.greatest(n - 1, F.lit(0))).alias("input_ids"),
                    F.slice(_c(c), 2, F.greatest(n - 1, F.lit(0))).alias("labels"))


def decoder_inputs(labels, start: int, pad: int = PAD_ID) -> Column:
    """Q20: labels shifted right with the start id first; -100 becomes the pad id."""
    shifted = F.concat(_int_array(start), F.slice(_c(labels), 1, F.greatest(F.size(_c(labels)) - 1, F.lit(0))))
    return F.transform(shifted, lambda x: F.when(x == IGNORE, F.lit(pad)).otherwise(x))


def encode_parallel(df: DataFrame, key: str, src: str, tgt: str, encode, n: int = 128) -> DataFrame:
    """Q21: source -> input_ids, target -> labels, both cut at n; ``encode(df, col)`` returns
    (key, input_ids) for a text column."""
    s = encode(df.select(key, src), src).select(key, F.slice("input_ids", 1, n).alias("input_ids"))
    t = encode(df.select(key, tgt), tgt).select(key, F.slice("input_ids", 1, n).alias("labels"))
    return s.join(t, key)
