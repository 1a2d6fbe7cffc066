"""Evaluation metrics over prediction / reference tables.

Metrics are sums of per-row counts, so Spark's partial (map-side) and final aggregation replaces
the reference's gather-to-one-process step; batch-wise accumulation (E2) gives the same numbers.
"""

from __future__ import annotations

import functools
import string

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions.batches import list_sizes, parts
from corpusprep.functions.text import pretokenize, words
from corpusprep.operators.labels import entity_spans
from corpusprep.operators.sequences import IGNORE, PAD_ID


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _counts(pred: Column, ref: Column):
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if(pred == ref).alias("correct"),
        F.count_if((pred == 1) & (ref == 1)).alias("tp"),
        F.count_if((pred == 1) & (ref == 0)).alias("fp"),
        F.count_if((pred == 0) & (ref == 1)).alias("fn"),
    ]


def _finish(df: DataFrame) -> DataFrame:
    return df.withColumn("accuracy", F.round(F.col("correct") / F.col("n"), 6)) \
        .withColumn("f1", F.round(F.when((2 * F.col("tp") + F.col("fp") + F.col("fn")) > 0,
                                         2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).otherwise(0.0), 6))


def accuracy_f1(df: DataFrame, pred, ref, by: list[str] | None = None) -> DataFrame:
    """Accuracy and binary F1 (positive class 1)."""
    return _finish(df.groupBy(*(by or [])).agg(*_counts(_c(pred), _c(ref))))


def accumulate(df: DataFrame, pred, ref, batch: str, by: list[str] | None = None) -> DataFrame:
    """Counts per batch first, then summed: the same result as the whole-table metric."""
    per_batch = df.groupBy(*(by or []), batch).agg(*_counts(_c(pred), _c(ref)))
    total = per_batch.groupBy(*(by or [])).agg(*[F.sum(c).alias(c) for c in ("n", "correct", "tp", "fp", "fn")])
    return _finish(total)


def drop_ignored(pred, ref, names: list[str] | None = None) -> Column:
    """Keep positions whose reference is not -100; ids -> names when ``names``.
    Returns struct(pred, ref) of equal-length arrays."""
    z = F.filter(F.arrays_zip(_c(pred).alias("p"), _c(ref).alias("r")), lambda e: e["r"] != IGNORE)
    p = F.transform(z, lambda e: e["p"])
    r = F.transform(z, lambda e: e["r"])
    if names:
        arr = F.array(*[F.lit(n) for n in names])
        p = F.transform(p, lambda x: F.element_at(arr, x + 1))
        r = F.transform(r, lambda x: F.element_at(arr, x + 1))
    return F.struct(p.alias("pred"), r.alias("ref"))


def materialized(df: DataFrame, **columns: Column) -> DataFrame:
    """The given columns, each computed once a row: the optimizer does not pull expressions through a generator, so
    a lambda that refers to one of them does not compute it anew for every element."""
    return df.select(F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_m")).select("_m.*")


def entity_scores(df: DataFrame, key: str, pred: str, ref: str) -> DataFrame:
    """Entity-level precision / recall / F1 (span and type must match), per type and overall
    (type 'overall', which also carries the token accuracy).  ``pred``/``ref`` are tag-name arrays.

    Both tag arrays stand in one row, so spans are matched inside it (as text keys, which ``array_intersect`` hashes);
    only one row per document and type leaves the task, into one rollup that gives the per-type rows and the
    overall row."""
    from corpusprep.operators.labels import span_array
    marker, sep = "\u0000tokens", "\u0001"
    zero = ("p", "r", "tp", "same", "total")

    def record(kind: Column, **given) -> Column:
        return F.struct(kind.alias("type"), *[given.get(z, F.lit(0)).cast("long").alias(z) for z in zero])

    def held(array: str, kind: Column) -> Column:
        return F.size(F.filter(array, lambda x: x == kind))

    same = F.size(F.filter(F.arrays_zip(F.col(pred).alias("p"), F.col(ref).alias("r")), lambda e: e["p"] == e["r"]))
    keys = {c: F.transform(span_array(t), lambda s_: F.concat_ws(sep, s_["type"], s_["start"], s_["end"])) for c, t in (("_p", pred), ("_r", ref))}
    spans = materialized(df, **keys, _same=same, _total=F.size(ref))
    kinds = {c: F.transform(k, lambda x: F.substring_index(x, sep, 1)) for c, k in (("_p", F.col("_p")), ("_r", F.col("_r")), ("_tp", F.array_intersect("_p", "_r")))}
    spans = materialized(spans, **kinds, _same=F.col("_same"), _total=F.col("_total"))
    rows = spans.select(F.explode(F.concat(
        F.transform(F.array_distinct(F.concat("_p", "_r")), lambda k: record(k, p=held("_p", k), r=held("_r", k), tp=held("_tp", k))),
        F.array(record(F.lit(marker), same=F.col("_same"), total=F.col("_total"))))).alias("s")).select("s.*")
    counts = rows.rollup("type").agg(
        F.sum("p").alias("n_pred"), F.sum("r").alias("n_ref"), F.sum("tp").alias("tp"),
        F.sum("same").alias("same"), F.sum("total").alias("total"), F.grouping("type").alias("_all"))
    counts = counts.where((F.col("_all") == 1) | (F.col("type") != marker))
    out = counts.select(F.when(F.col("_all") == 1, F.lit("overall")).otherwise(F.col("type")).alias("type"),
                        F.col("n_pred").cast("long").alias("n_pred"), F.col("n_ref").cast("long").alias("n_ref"),
                        F.col("tp").cast("long").alias("tp"),
                        F.when(F.col("_all") == 1, F.round(F.col("same") / F.col("total"), 6)).alias("accuracy"))
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0)
    rec = F.when(F.col("n_ref") > 0, F.col("tp") / F.col("n_ref")).otherwise(0.0)
    return out.withColumn("precision", F.round(prec, 6)).withColumn("recall", F.round(rec, 6)) \
        .withColumn("f1", F.round(F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0), 6))


def best_answers(features: DataFrame, examples: DataFrame, n_best: int = 20, max_len: int = 30,
                 example: str = "example_id", feature: str = "feature_id", context: str = "context") -> DataFrame:
    """E5: per window the n_best start and end positions by logit; valid pairs (both offsets in the
    context, start <= end, length <= max_len) scored by the logit sum; best over all windows of the
    example; the answer is the context slice, empty when no pair is valid."""
    def top(col):
        ranked = F.sort_array(F.transform(F.col(col), lambda x, i: F.struct((-x).alias("o"), i.alias("i"), x.alias("logit"))))
        return F.filter(F.slice(ranked, 1, n_best), lambda e: F.get("offset_mapping", e["i"]).isNotNull())

    # candidates and their pairs stay inside the feature's row: at most n_best of each side
    cand = materialized(features, **{example: F.col(example)}, offset_mapping=F.col("offset_mapping"), _s=top("start_logits"), _e=top("end_logits"))
    pairs = F.flatten(F.transform("_s", lambda s_: F.transform(
        F.filter("_e", lambda e_: (e_["i"] >= s_["i"]) & (e_["i"] < s_["i"] + max_len)),
        lambda e_: F.struct((s_["logit"] + e_["logit"]).alias("score"),
                            (-F.get("offset_mapping", s_["i"])["start"]).alias("ns"), (-F.get("offset_mapping", e_["i"])["end"]).alias("ne")))))
    best = cand.select(example, F.array_max(pairs).alias("m")).groupBy(example).agg(F.max("m").alias("m")).where("m is not null") \
        .select(example, F.struct((-F.col("m.ns")).alias("s"), (-F.col("m.ne")).alias("e"), F.col("m.score").alias("score")).alias("b"))
    j = examples.select(example, context).join(best, example, "left")
    answer = F.when(F.col("b").isNull(), F.lit("")).otherwise(
        F.substring(context, F.col("b.s") + 1, F.col("b.e") - F.col("b.s")))
    return j.select(example, answer.alias("prediction_text"), F.col("b.score").alias("score"))


# The punctuation set and article words of the SQuAD normaliser.
PUNCTUATION = string.punctuation
ARTICLES = ("a", "an", "the")


def squad_normalize(c) -> Column:
    """Lower case, punctuation removed, article tokens removed, whitespace collapsed.  Articles are
    dropped as whole whitespace tokens (the same as a word-boundary rule on ASCII text, and
    well-defined on accented text where regex word boundaries differ between engines)."""
    s = F.translate(F.lower(_c(c)), PUNCTUATION, "")
    kept = F.filter(words(s), lambda x: ~x.isin(*ARTICLES))
    return F.array_join(kept, " ")


@F.arrow_udf(T.LongType())
def overlap(a: pa.Array, b: pa.Array) -> pa.Array:
    """Size of the multiset intersection of two arrays of the row."""
    rows = pa.RecordBatch.from_arrays([a, b], names=["a", "b"])
    done = [_overlaps(part.column(0), part.column(1)) for part in parts(rows, list_sizes(a) + list_sizes(b))]
    return pa.array(np.concatenate(done) if done else [], pa.int64())


def _overlaps(a: pa.ListArray, b: pa.ListArray) -> np.ndarray:
    """Items are numbered; each (row, item) is counted on both sides at once."""
    flat = [a.flatten(), b.flatten()]
    coded = pa.concat_arrays(flat).dictionary_encode()
    n = len(coded.dictionary) + 1
    codes = coded.indices.fill_null(n - 1).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.concatenate([np.repeat(np.arange(len(x)), list_sizes(x)) for x in (a, b)])
    cut = len(flat[0])
    places = row * n + codes
    left, n_left = np.unique(places[:cut], return_counts=True)
    right, n_right = np.unique(places[cut:], return_counts=True)
    both, i, j = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    shared = np.minimum(n_left[i], n_right[j])
    return np.bincount(both // n, weights=shared, minlength=len(a)).astype(np.int64)


def squad_scores(pred: DataFrame, ref: DataFrame, key: str = "id", prediction: str = "prediction_text",
                 answers: str = "answers") -> DataFrame:
    """Exact match and token F1 (x100), each the best over the references, averaged over examples.
    ``ref.answers`` is an array of strings."""
    p = pred.select(key, squad_normalize(prediction).alias("p"))
    r = ref.select(key, F.posexplode(answers).alias("ref_id", "a")).select(key, "ref_id", squad_normalize("a").alias("r"))
    pr = p.join(r, key)
    per = pr.select(key, (F.col("p") == F.col("r")).cast("double").alias("em"), words("p").alias("pt"), words("r").alias("rt")) \
        .select(key, "em", F.size("pt").alias("np"), F.size("rt").alias("nr"), overlap("pt", "rt").alias("same"))
    prec = F.col("same") / F.col("np")
    rec = F.col("same") / F.col("nr")
    f1 = F.when((F.col("np") == 0) | (F.col("nr") == 0), (F.col("np") == F.col("nr")).cast("double")) \
        .when(F.col("same") == 0, F.lit(0.0)).otherwise(2 * prec * rec / (prec + rec))
    best = per.withColumn("f1", f1).groupBy(key).agg(F.max("em").alias("em"), F.max("f1").alias("f1"))
    return best.agg(F.round(100 * F.avg("em"), 4).alias("exact_match"), F.round(100 * F.avg("f1"), 4).alias("f1"))


#: Tokens whose n-grams are counted at a time; a larger row alone.
BLEU_TOKENS = 1 << 18


def corpus_bleu(df: DataFrame, key: str, pred: str, refs: str, tokenize=pretokenize, max_n: int = 4) -> DataFrame:
    """Corpus BLEU with clipped n-gram precisions 1..4, brevity penalty against the closest
    reference length (ties: shorter) and exponential smoothing of zero counts; x100.

    The n-grams of a row are counted and clipped inside the row; a task adds up its rows, and only sums leave it."""
    toks = df.select(tokenize(_c(pred)).alias("h"), F.transform(_c(refs), lambda r: tokenize(r)).alias("rs"))

    def run(batches):
        total = np.zeros(2 * max_n + 2, dtype=np.int64)
        for batch in batches:
            batch = batch.filter(pc.and_(batch.column(0).is_valid(), batch.column(1).is_valid()))
            h, rs = batch.columns
            ends = np.concatenate([[0], np.cumsum(list_sizes(rs))])
            read = np.concatenate([[0], np.cumsum(list_sizes(rs.flatten()))])[ends]
            for part in parts(batch, list_sizes(h) + np.diff(read), BLEU_TOKENS):
                total += _bleu_sums(part.column(0), part.column(1), max_n)
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in total.tolist()], names=names)

    names = [f"{kind}{n}" for n in range(1, max_n + 1) for kind in ("m", "t")] + ["c", "r"]
    sums = toks.mapInArrow(run, ", ".join(f"{n} long" for n in names)).agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in names])
    logs, k = F.lit(0.0), F.lit(1.0)
    for n in range(1, max_n + 1):
        m, t = F.col(f"m{n}"), F.col(f"t{n}")
        k = F.when((m == 0) & (t > 0), k * 2).otherwise(k)
        logs = logs + F.when(m == 0, -F.log(k * F.greatest(t, F.lit(1)))).otherwise(F.log(m / F.greatest(t, F.lit(1))))
    empty = functools.reduce(lambda x, y: x | y, [F.col(f"t{n}") == 0 for n in range(1, max_n + 1)]) | (F.col("c") == 0)
    brevity = F.when(F.col("c") >= F.col("r"), F.lit(1.0)).otherwise(F.exp(1 - F.col("r") / F.greatest(F.col("c"), F.lit(1))))
    bleu = F.when(empty, F.lit(0.0)).otherwise(100 * brevity * F.exp(logs / max_n))
    shares = [F.round(F.when(F.col(f"t{n}") > 0, 100.0 * F.col(f"m{n}") / F.greatest(F.col(f"t{n}"), F.lit(1))).otherwise(0.0), 4).alias(f"p{n}")
              for n in range(1, max_n + 1)]
    return sums.select(F.round(bleu, 4).alias("bleu"), *shares, F.col("c").alias("sys_len"), F.col("r").alias("ref_len"))


def _bleu_sums(h: pa.ListArray, rs: pa.ListArray, max_n: int) -> np.ndarray:
    """Clipped matches and n-grams of each order, then tokens and closest reference lengths, summed over the rows.

    Tokens are numbered inside their row, an n-gram is the number its tokens spell, and one sort counts the n-grams of all
    rows; numbers that could outgrow 64 bits are replaced by their ranks."""
    total = np.zeros(2 * max_n + 2, dtype=np.int64)
    rows, refs = len(h), rs.flatten()
    if not rows:
        return total
    held, own, theirs = list_sizes(rs), list_sizes(h).astype(np.int64), list_sizes(refs).astype(np.int64)
    ref_row, first = np.repeat(np.arange(rows), held), np.concatenate([[0], np.cumsum(held)])[:-1]
    total[-2] = own.sum()
    if len(refs):
        closest = np.minimum.reduceat(np.abs(theirs - own[ref_row]) << 32 | theirs, first[held > 0])
        total[-1] = (closest & 0xFFFFFFFF).sum()
    # the hypotheses, then the references: row and number (0: hypothesis) of each token's text
    sizes = np.concatenate([own, theirs])
    row = np.repeat(np.concatenate([np.arange(rows), ref_row]), sizes)
    text = np.repeat(np.concatenate([np.zeros(rows, dtype=np.int64), 1 + np.arange(len(refs)) - first[ref_row]]), sizes)
    end = np.repeat(np.cumsum(sizes), sizes)
    texts = int(held.max()) + 1
    if not len(row):
        return total
    coded = pa.concat_arrays([h.flatten(), refs.flatten()]).dictionary_encode(null_encoding="encode")
    seen, code = np.unique(row * len(coded.dictionary) + coded.indices.to_numpy(), return_inverse=True)
    code = code - np.searchsorted(seen, np.arange(rows) * len(coded.dictionary))[row]
    width = space = int(code.max()) + 1
    at, gram = np.arange(len(code)), code
    for n in range(1, max_n + 1):
        if n > 1:
            whole = end[at] - at >= n
            at, gram = at[whole], gram[whole]
            if space * width * rows * texts >= 1 << 63:
                seen, gram = np.unique(gram, return_inverse=True)
                space = len(seen)
            gram, space = gram * width + code[at + n - 1], space * width
        if not len(at):
            break
        key, count = np.unique((row[at] * space + gram) * texts + text[at], return_counts=True)
        mine, group = key % texts == 0, key // texts
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        most = np.maximum.reduceat(np.where(mine, 0, count), starts)
        total[2 * n - 2] = np.minimum(np.maximum.reduceat(np.where(mine, count, 0), starts), most).sum()
        total[2 * n - 1] = count[mine].sum()
    return total


def rouge_tokens(c) -> Column:
    """ROUGE tokenizer: lower case, every run of characters outside [a-z0-9] is a separator."""
    return F.filter(F.split(F.regexp_replace(F.lower(_c(c)), "[^a-z0-9]+", " "), " "), lambda x: x != "")


def lcs_length(x, y) -> int:
    """Length of the longest common subsequence, a row of the table at a time as the bits of one integer."""
    places: dict = {}
    for i, t in enumerate(x):
        places[t] = places.get(t, 0) | 1 << i
    every = (1 << len(x)) - 1
    row = every
    for t in y:
        hit = row & places.get(t, 0)
        row = ((row + hit) | (row - hit)) & every
    return len(x) - row.bit_count()


@F.pandas_udf(T.LongType())
def _lcs(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([lcs_length(x, y) for x, y in zip(a, b)], dtype="int64")


def _bigrams(toks: str) -> Column:
    n = F.size(toks)
    pairs = F.zip_with(F.slice(toks, 1, F.greatest(n - 1, F.lit(0))), F.slice(toks, 2, F.greatest(n - 1, F.lit(0))),
                       lambda x, y: F.concat(x, F.lit("\u0001"), y))
    return F.when(n > 1, pairs).otherwise(F.array().cast("array<string>"))


def rouge(df: DataFrame, key: str, pred: str, ref: str) -> DataFrame:
    """ROUGE-1, ROUGE-2 (n-gram overlap) and ROUGE-L (longest common subsequence) F-measures,
    mean over pairs; recall and precision kept too.  All counts are made inside the row."""
    toks = df.select(key, rouge_tokens(pred).alias("h"), rouge_tokens(ref).alias("r"))
    out = toks.select(key, F.size("h").alias("nh"), F.size("r").alias("nr"), overlap("h", "r").alias("o1"),
                      overlap(_bigrams("h"), _bigrams("r")).alias("o2"), _lcs("h", "r").alias("lcs"))

    def fm(o, hn, rn):
        p = F.when(hn > 0, o / hn).otherwise(0.0)
        r = F.when(rn > 0, o / rn).otherwise(0.0)
        return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0), r
    f1, r1 = fm(F.col("o1"), F.col("nh"), F.col("nr"))
    f2, r2 = fm(F.col("o2"), F.greatest(F.col("nh") - 1, F.lit(0)), F.greatest(F.col("nr") - 1, F.lit(0)))
    fl, rl = fm(F.col("lcs"), F.col("nh"), F.col("nr"))
    return out.agg(F.round(F.avg(f1), 6).alias("rouge1"), F.round(F.avg(f2), 6).alias("rouge2"),
                   F.round(F.avg(fl), 6).alias("rougeL"), F.round(F.avg(r1), 6).alias("rouge1_recall"),
                   F.round(F.avg(r2), 6).alias("rouge2_recall"), F.round(F.avg(rl), 6).alias("rougeL_recall"))


def perplexity(df: DataFrame, loss: str, by: list[str] | None = None) -> DataFrame:
    """exp(mean loss); an overflowing exponent gives infinity."""
    m = F.avg(loss)
    return df.groupBy(*(by or [])).agg(m.alias("mean_loss")).withColumn(
        "perplexity", F.when(F.col("mean_loss") > 709.0, F.lit(float("inf"))).otherwise(F.exp("mean_loss")))


def weighted_loss(df: DataFrame, losses: str, ids: str, key_ids: list[int], alpha: float = 1.0,
                  by: list[str] | None = None) -> DataFrame:
    """Per row mean token loss x alpha * (1 + number of key tokens in the row), mean over rows."""
    mean = F.aggregate(losses, F.lit(0.0), lambda a, x: a + x) / F.size(losses)
    keys = F.array(*[F.lit(k) for k in key_ids])
    count = F.size(F.filter(ids, lambda x: F.array_contains(keys, x)))
    return df.groupBy(*(by or [])).agg(F.avg(mean * F.lit(alpha) * (1 + count)).alias("weighted_loss"))


def top_candidates(df: DataFrame, key: str, logits: str, k: int = 5) -> DataFrame:
    """Softmax over a stored logits array, the k most probable ids with their probability."""
    m = F.array_max(logits)
    probs = F.transform(logits, lambda x: F.exp(x - m))
    total = F.aggregate(probs, F.lit(0.0), lambda a, x: a + x)
    ranked = F.array_sort(F.transform(probs, lambda p, i: F.struct((-(p / total)).alias("o"), i.alias("i"))))
    return df.select(key, F.posexplode(F.slice(ranked, 1, k)).alias("r", "e")) \
        .select(key, F.col("e.i").alias("token_id"), (-F.col("e.o")).alias("prob"), (F.col("r") + 1).alias("rank"))


def clean_labels(labels, pad: int = PAD_ID) -> Column:
    """-100 in label arrays replaced by the pad id before decoding."""
    return F.transform(_c(labels), lambda x: F.when(x == IGNORE, F.lit(pad)).otherwise(x))
