"""Label alignment (N1-N7) on token arrays: alignment and rendering in numpy and Arrow over the tokens of a
batch, answer spans as native higher-order functions per row; entity grouping over rows uses windows partitioned by the sequence key (bounded by its length)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions.batches import code_points, joined_ranges, list_array, list_sizes, parts
from corpusprep.functions.hashes import numbered_draws
from corpusprep.operators.sequences import IGNORE
from corpusprep.operators.vocab import CONTINUATION, UNK


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _aligned(labels: pa.ListArray, word_ids: pa.ListArray, first_only: bool) -> pa.ListArray:
    """Labels of the tokens of all rows at once.  A word without a label is an error, as for ``element_at``."""
    sizes, held = list_sizes(word_ids), list_sizes(labels)
    flat = word_ids.flatten()
    row = np.repeat(np.arange(len(sizes)), sizes)
    known = flat.is_valid().to_numpy(zero_copy_only=False)
    word = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    changed = np.ones(len(word), dtype=bool)
    changed[1:] = (row[1:] != row[:-1]) | (known[1:] != known[:-1]) | (word[1:] != word[:-1])
    all_labels = labels.flatten()
    wanted = known & labels.is_valid().to_numpy(zero_copy_only=False)[row]
    if first_only:
        wanted &= changed
    at = np.flatnonzero(wanted)
    place = np.where(word[at] >= 0, word[at], held[row[at]] + word[at] + 1)
    outside = (word[at] == -1) | (place < 0) | (place >= held[row[at]])
    if outside.any():
        i = int(np.argmax(outside))
        raise IndexError(f"word {word[at][i]} has no label: there are {held[row[at]][i]}")
    place += (np.cumsum(held) - held)[row[at]]
    out = np.full(len(word), IGNORE, dtype=np.int64)
    missing = known & (changed if first_only else True)  # tokens whose label is not known: a null label, or no list
    values = pc.fill_null(all_labels, 0).to_numpy(zero_copy_only=False).astype(np.int64)[place]
    if not first_only:
        values = values + (~changed[at] & (values % 2 == 1))
    out[at] = values
    missing[at] = all_labels.is_null().to_numpy(zero_copy_only=False)[place]
    return list_array(np.concatenate([[0], np.cumsum(sizes)]), pa.array(out, pa.int32(), mask=missing), word_ids.is_null())


def _in_parts(run, sized: int, *columns: pa.Array) -> pa.Array:
    """``run`` over parts of the columns; the lists of one of them give a part's size."""
    rows = pa.RecordBatch.from_arrays(list(columns), names=[str(i) for i in range(len(columns))])
    done = [run(*part.columns) for part in parts(rows, list_sizes(columns[sized]))]
    return pa.concat_arrays(done) if done else run(*columns)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _continued(labels: pa.Array, word_ids: pa.Array) -> pa.Array:
    return _in_parts(lambda x, w: _aligned(x, w, False), 1, labels, word_ids)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _firsts(labels: pa.Array, word_ids: pa.Array) -> pa.Array:
    return _in_parts(lambda x, w: _aligned(x, w, True), 1, labels, word_ids)


def align_continue(labels, word_ids) -> Column:
    """Specials -> -100; the first piece of a word keeps its label; later pieces turn B- (odd)
    into I- (odd + 1).  Columns, or Arrow arrays inside a task."""
    if isinstance(word_ids, pa.Array):
        return _aligned(labels, word_ids, False)
    return _continued(_c(labels), _c(word_ids))


def align_first(labels, word_ids) -> Column:
    """Only the first piece of every word carries the label, the rest -100.  Columns, or Arrow arrays inside a task."""
    if isinstance(word_ids, pa.Array):
        return _aligned(labels, word_ids, True)
    return _firsts(_c(labels), _c(word_ids))


def with_special_word_ids(word_ids) -> Column:
    """Word ids of a single-sequence template: null for [CLS] and [SEP].  A column, or an Arrow array inside a task."""
    if isinstance(word_ids, pa.Array):
        sizes = list_sizes(word_ids)
        ends = np.cumsum(sizes + 2)
        at = np.full(int(ends[-1]) if len(ends) else 0, -1, dtype=np.int64)
        at[joined_ranges(ends - sizes - 1, sizes)] = np.arange(int(sizes.sum()))
        return list_array(np.concatenate([[0], ends]), word_ids.flatten().take(pa.array(at, mask=at < 0)), word_ids.is_null())
    null_int = F.lit(None).cast("int")
    return F.concat(F.array(null_int), _c(word_ids), F.array(null_int))


def answer_token_span(offsets, sequence_ids, start_char, end_char) -> Column:
    """(0, 0) unless the answer lies wholly inside the window's context; else the last context
    token starting at or before the answer start and the first context token ending at or after
    the answer end.  A window without context tokens gives (0, 0)."""
    idx = F.sequence(F.lit(0), F.size(_c(offsets)) - 1)
    ctx = F.filter(idx, lambda i: F.element_at(_c(sequence_ids), i + 1) == 1)
    cs, ce = F.array_min(ctx), F.array_max(ctx)
    o = lambda i, f: F.element_at(_c(offsets), i + 1)[f]
    inside = cs.isNotNull() & (o(cs, "start") <= start_char) & (o(ce, "end") >= end_char)
    start = F.array_max(F.filter(ctx, lambda i: o(i, "start") <= start_char))
    end = F.array_min(F.filter(ctx, lambda i: o(i, "end") >= end_char))
    return F.struct(F.when(inside, start).otherwise(F.lit(0)).alias("start_position"),
                    F.when(inside, end).otherwise(F.lit(0)).alias("end_position"))


def validation_offsets(offsets, sequence_ids) -> Column:
    """Offsets of tokens outside the context set to null."""
    return F.zip_with(_c(offsets), _c(sequence_ids), lambda o, s: F.when(s == 1, o))


def _two_lines(words: pa.ListArray, names: pa.ListArray) -> pa.StringArray:
    sizes = list_sizes(words)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    known = pc.and_(words.is_valid(), names.is_valid())
    if not np.array_equal(sizes, list_sizes(names)):  # the shorter list of a row is filled up with nulls
        longer = lambda xs, ys: None if xs is None or ys is None else xs + [None] * (len(ys) - len(xs))
        pairs = list(zip(words.to_pylist(), names.to_pylist()))
        return _two_lines(pa.array([longer(x, y) for x, y in pairs], pa.list_(pa.string())), pa.array([longer(y, x) for x, y in pairs], pa.list_(pa.string())))
    flat = words.flatten(), names.flatten()
    # the width of the wider of the two; a null takes no part, and is not printed
    long = [pc.utf8_length(x) for x in flat]
    width = pc.add(pc.max_element_wise(*long), 1)
    spaces = pa.array([" " * n for n in range((pc.max(width).as_py() or 0) + 1)], pa.string())
    lines = []
    for x, n in zip(flat, long):
        padded = pc.binary_join_element_wise(x, spaces.take(pc.subtract(width, n)), "")
        lines.append(pc.binary_join(list_array(ends, pc.fill_null(padded, "")), ""))
    return pc.if_else(known, pc.binary_join_element_wise(*lines, "\n"), None)


@F.arrow_udf(T.StringType())
def _side_by_side(words: pa.Array, names: pa.Array) -> pa.Array:
    return _in_parts(_two_lines, 0, words, names)


def side_by_side(words, label_names) -> Column:
    """Two lines, every word and its label padded to the longer of the two plus one space.
    Columns, or Arrow arrays inside a task."""
    if isinstance(words, pa.Array):
        return _two_lines(words, label_names)
    return _side_by_side(_c(words), _c(label_names))


def label_names(labels: pa.ListArray, names: list[str]) -> pa.ListArray:
    """Names of lists of labels, '-' for null and for ignored positions."""
    flat = labels.flatten()
    found = pc.fill_null(pa.array(names, pa.string()).take(pc.if_else(pc.less(flat, 0), None, flat)), "-")
    return list_array(np.concatenate([[0], np.cumsum(list_sizes(labels))]), found, labels.is_null())


def offsets_hold_pieces(texts: pa.Array, tokens: pa.ListArray, offsets: pa.ListArray) -> pa.Array:
    """Whether every piece's character span holds the piece itself (continuation marker removed; [UNK] holds anything)."""
    sizes = list_sizes(tokens)
    row = np.repeat(np.arange(len(sizes)), sizes)
    flat, spans = tokens.flatten(), offsets.flatten()
    points, row_at = code_points(texts)
    marked = pc.starts_with(flat, CONTINUATION)
    pieces = pc.if_else(marked, pc.utf8_slice_codeunits(flat, len(CONTINUATION)), flat)
    chars, at = code_points(pieces)
    n = np.diff(at)
    size = np.diff(row_at)[row]
    start, end = (np.minimum(spans.field(i).to_numpy(zero_copy_only=False), size) for i in (0, 1))
    unknown = pc.equal(flat, UNK).to_numpy(zero_copy_only=False)
    same = end - start == n
    looked = np.flatnonzero(same & ~unknown)
    here = points[joined_ranges((start + row_at[row])[looked], n[looked])]
    differs = here != chars[joined_ranges(at[:-1][looked], n[looked])]
    same[np.repeat(looked, n[looked])[differs]] = False
    wrong = np.bincount(row[~(same | unknown)], minlength=len(sizes)) > 0
    # a piece in no text is neither held nor not held
    missing = texts.is_null().to_numpy(zero_copy_only=False) & (np.bincount(row[~unknown], minlength=len(sizes)) > 0)
    return pc.if_else(tokens.is_valid(), pa.array(~wrong, mask=missing), None)


def drawn_tags(ignored: pa.Array, kinds: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """A tag for every word of a row (``counts``, at least one), by md5 as ``ranking.seeded_uniform``: none (0) with p = 0.7
    by the prefix ``ignored``, else one of eight by the prefix ``kinds``."""
    n = np.maximum(counts, 1)
    plain = numbered_draws(ignored, n) / 4294967296.0 < 0.7
    tags = np.zeros(len(plain), dtype=np.int32)
    tags[~plain] = (numbered_draws(kinds, n, ~plain) >> 29) + 1  # eight kinds: the draw's first three bits
    return list_array(np.concatenate([[0], np.cumsum(n)]), pa.array(tags, pa.int32()))


def tag_type(tag: Column) -> Column:
    return F.when(tag.startswith("B-") | tag.startswith("I-"), F.substr(tag, F.lit(3)))


def span_array(tags) -> Column:
    """Entity spans of one tag array (conlleval chunking), computed inside the row: an entity
    starts at B-X, or at I-X after O or after another type, and ends where the next tag does not
    continue it.  Starts and ends come out in the same order, so zipping them pairs each entity.
    Each tag is zipped with its neighbours (shifted copies), so one linear pass decides both
    flags.  Returns array<struct<type, start, end>> with inclusive positions."""
    marks = F.transform(_c(tags), lambda x: F.struct(tag_type(x).alias("ty"), x.startswith("B-").alias("b")))

    def flagged(m: Column) -> Column:
        n = F.size(m)
        none = F.array(F.lit(None).cast("struct<ty:string,b:boolean>"))
        prev = F.concat(none, F.slice(m, 1, F.greatest(n - 1, F.lit(0))))
        nxt = F.concat(F.slice(m, 2, F.greatest(n - 1, F.lit(0))), none)
        pos = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))
        z = F.arrays_zip(m.alias("c"), F.slice(prev, 1, n).alias("p"), F.slice(nxt, 1, n).alias("x"), F.slice(pos, 1, n).alias("i"))
        held = F.filter(z, lambda e: e["c"]["ty"].isNotNull())
        return F.transform(held, lambda e: F.struct(
            e["i"].alias("i"), e["c"]["ty"].alias("ty"),
            (e["c"]["b"] | e["p"]["ty"].isNull() | (e["p"]["ty"] != e["c"]["ty"])).alias("st"),
            (~F.coalesce(~e["x"]["b"] & (e["x"]["ty"] == e["c"]["ty"]), F.lit(False))).alias("en")))

    def paired(flags: Column) -> Column:
        starts = F.filter(flags, lambda f: f["st"])
        ends = F.transform(F.filter(flags, lambda f: f["en"]), lambda f: f["i"])
        return F.zip_with(starts, ends, lambda s_, e_: F.struct(s_["ty"].alias("type"), s_["i"].alias("start"), e_.alias("end")))

    return _named(_named(marks, flagged), paired)


def _named(value: Column, use) -> Column:
    """``use`` of the value, which is computed once: a lambda's variable stands for it."""
    return F.get(F.transform(F.array(value), use), 0)


def entity_spans(df: DataFrame, key: str, tags: str) -> DataFrame:
    """Spans of a tag sequence, one row per entity: (key, type, start, end)."""
    return df.select(key, F.explode(span_array(tags)).alias("s")).select(key, "s.type", "s.start", "s.end")


def group_entities(df: DataFrame, key: str, tokens: str = "tokens", tags: str = "tags", scores: str = "scores",
                   offsets: str | None = None, text: str | None = None) -> DataFrame:
    """Adjacent tokens of one entity merged: type, mean score, token span, word text (tokens
    joined, '##' pieces glued) and character span when offsets are given."""
    spans = entity_spans(df, key, tags)
    j = spans.join(df.select(key, tokens, scores, *([offsets] if offsets else [])), key)
    piece = F.slice(tokens, F.col("start") + 1, F.col("end") - F.col("start") + 1)
    sc = F.slice(scores, F.col("start") + 1, F.col("end") - F.col("start") + 1)
    out = j.select(key, F.col("type").alias("entity_group"), "start", "end",
                   F.regexp_replace(F.array_join(piece, " "), " ##", "").alias("word"),
                   (F.aggregate(sc, F.lit(0.0), lambda a, x: a + x) / F.size(sc)).alias("score"),
                   *([F.element_at(offsets, F.col("start") + 1)["start"].alias("char_start"),
                      F.element_at(offsets, F.col("end") + 1)["end"].alias("char_end")] if offsets else []))
    return out
