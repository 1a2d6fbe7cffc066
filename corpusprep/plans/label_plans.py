"""Label alignment and extractive-QA preparation (N1-N7, Q5-Q9, Q17, B7, U7) over documents.

Tags, answers and logits are chosen by md5 of (seed, document, position), so every run and
every engine sees the same inputs.  These queries have no SQL oracle (subword encoding and
HTML-free char offsets are Python in the task); tests check their invariants.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions.batches import joined_ranges, last_items, list_array, list_sizes
from corpusprep.functions.text import words
from corpusprep.operators import labels as lb
from corpusprep.operators import sequences as sq
from corpusprep.operators import vocab as vb
from corpusprep.operators.ranking import seeded_uniform
from corpusprep.plans.eval_plans import NER_TAGS, TAGS_SQL, _tags_frame
from corpusprep.plans.sequence_plans import ENC_SQL, encoded_docs_frame
from corpusprep.session import cut_lineage
from corpusprep.sources.tables import table

QUERIES = {}
SQL = {}


def register(name, sql=None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


OFFSET_T = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


@F.arrow_udf(OFFSET_T)
def word_offsets(texts: pa.Array) -> pa.Array:
    """[start, end) code-point span of every whitespace word, kept as plain integers."""
    starts, ends, bounds = array("i"), array("i"), [0]
    for t in texts:
        for m in re.finditer(r"\S+", t.as_py() or ""):
            starts.append(m.start())
            ends.append(m.end())
        bounds.append(len(starts))
    ints = [pa.array(np.frombuffer(a, dtype=np.int32) if len(a) else [], pa.int32()) for a in (starts, ends)]
    return list_array(bounds, pa.StructArray.from_arrays(ints, names=["start", "end"]))


def wordpiece_vocab(spark, sf_dir, size: int = 2000):
    """A WordPiece vocabulary from the corpus: specials, the most frequent words, and every character
    as a word-initial and a '##' continuation piece (so every word can be segmented)."""
    docs = table(spark, sf_dir, "documents").select("text")
    freqs = cut_lineage(vb.word_frequencies(docs, "text"))  # read twice below
    top = vb.word_vocab(freqs, size).select("token")
    chars = freqs.select(F.explode(F.filter(F.split("word", ""), lambda x: x != "")).alias("c")).distinct()
    pieces = chars.select(F.col("c").alias("token")).unionByName(chars.select(F.concat(F.lit("##"), "c").alias("token")))
    allv = top.unionByName(pieces).distinct()
    from corpusprep.operators.ranking import global_rank
    return global_rank(allv, "token", "_r").select("token", (F.col("_r") + 200).cast("int").alias("id"))


def _paired(docs, key: str, text: str):
    """The rows of a table with every text of the same key, ``other``, as a join of the table with itself by the key gives
    them.  Only repeated keys (one job looks) are joined; a row whose key does not repeat is ``alone``, and its own text
    the other."""
    docs = docs.where(F.col(key).isNotNull())
    repeated = docs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(key)
    alone = lambda df: df.select(key, text, F.lit(None).cast("string").alias("other"), F.lit(True).alias("alone"))
    if repeated.isEmpty():
        return alone(docs)
    many = docs.join(repeated, key, "left_semi")
    pairs = many.join(many.select(key, F.col(text).alias("other")), key).select(key, text, "other", F.lit(False).alias("alone"))
    return alone(docs.join(repeated, key, "left_anti")).unionByName(pairs)


@register("ner_aligned_docs")
def ner_aligned_docs(spark, sf_dir):
    """N3 (B7 + Q7 + N1), N2 and N6: every document WordPiece-encoded, tag per word by md5, labels
    aligned to tokens both ways; per document token count, ignored positions and a side-by-side
    rendering digest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    v = wordpiece_vocab(spark, sf_dir)
    prefix = lambda seed: F.concat(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")), F.lit(":"))
    n_words = F.when(~F.col("alone"), F.size(F.regexp_extract_all("other", F.lit(r"(?U)(\w+|[^\w\s])"), 1)))
    pairs = _paired(docs, "doc_id", "text").select("*", n_words.alias("n_words"), prefix("3").alias("p3"), prefix("4").alias("p4"))

    def aligned(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        tokens, text = c["tokens"], pc.if_else(c["alone"], c["text"], c["other"])
        # a row alone has as many words as its encoding counts
        counts = np.where(c["alone"].to_numpy(zero_copy_only=False), last_items(c["word_ids"]) + 1, pc.fill_null(c["n_words"], 0).to_numpy(zero_copy_only=False))
        tags, wids = lb.drawn_tags(c["p3"], c["p4"], counts), lb.with_special_word_ids(c["word_ids"])
        labels_cont, labels_first = lb.align_continue(tags, wids), lb.align_first(tags, wids)
        inner = _without_ends(labels_cont)
        side = lb.side_by_side(tokens, lb.label_names(inner, NER_TAGS))
        # Q6 / Q9: every piece's character span holds the piece itself (continuation marker removed)
        ok = lb.offsets_hold_pieces(text, tokens, c["offsets"])
        return pa.RecordBatch.from_arrays(
            [c["doc_id"], pc.list_value_length(tokens), pc.list_value_length(labels_cont), ok, _ignored(labels_first), _ignored(labels_cont), side],
            names=["doc_id", "n_tokens", "n_labels", "offsets_ok", "ignored_first", "ignored_cont", "side"])

    out = vb.encode_wordpiece(pairs, "text", "doc_id", v, keep=("text", "other", "alone", "n_words", "p3", "p4"), then=aligned,
                              then_t=f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens int, n_labels int, offsets_ok boolean, "
                                     "ignored_first int, ignored_cont int, side string")
    return out.select("doc_id", "n_tokens", "n_labels", "offsets_ok", "ignored_first", "ignored_cont", F.md5("side").alias("side_md5"))


def _without_ends(labels: pa.ListArray) -> pa.ListArray:
    """The labels of a template's tokens without those of [CLS] and [SEP]."""
    sizes = list_sizes(labels)
    first = np.cumsum(sizes) - sizes
    return list_array(np.concatenate([[0], np.cumsum(sizes - 2)]), labels.flatten().take(pa.array(joined_ranges(first + 1, sizes - 2))))


def _ignored(labels: pa.ListArray) -> pa.Array:
    """How many labels of every row are ignored."""
    sizes = list_sizes(labels)
    hit = pc.equal(labels.flatten(), sq.IGNORE).fill_null(False).to_numpy(zero_copy_only=False)
    return pa.array(np.bincount(np.repeat(np.arange(len(sizes)), sizes)[hit], minlength=len(sizes)).astype(np.int32), pa.int32())


def _qa_frame(spark, sf_dir):
    """Question = first 8 words, context = the whole document, answer = 3 words at an md5 position."""
    enc = encoded_docs_frame(spark, sf_dir)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    df = enc.join(docs, "doc_id").where(F.size("ids") >= 4)
    k = F.floor(seeded_uniform(F.lit(11), F.col("doc_id")) * (F.size("ids") - 3)).cast("int")
    df = df.withColumn("offsets", word_offsets("text")).withColumn("_k", k)
    return df.select("doc_id", "text", F.slice("ids", 1, 8).alias("question_ids"), F.col("ids").alias("context_ids"), "offsets",
                     F.element_at("offsets", F.col("_k") + 1)["start"].alias("answer_start"),
                     F.element_at("offsets", F.col("_k") + 3)["end"].alias("answer_end"))


def _windows(spark, sf_dir, n=64, stride=16):
    qa = _qa_frame(spark, sf_dir)
    w = sq.sliding_windows(qa, "doc_id", "question_ids", "context_ids", n, stride)
    payload = F.lit(n - 3) - F.size("question_ids")
    ctx_off = F.slice("offsets", F.col("context_start") + 1, payload.cast("int"))
    null_off = F.lit(None).cast(OFFSET_T.elementType)
    off = F.concat(F.array_repeat(null_off, F.size("question_ids") + 2), ctx_off, F.array(null_off))
    return w.withColumn("offset_mapping", lb.validation_offsets(off, "sequence_ids"))


@register("qa_windows_docs", f"""WITH {ENC_SQL},
qa AS (SELECT doc_id, ids, len(ids[1:8]) AS nq, len(ids) AS nt,
              CAST(floor((('0x' || substr(md5('11:' || CAST(doc_id AS VARCHAR)), 1, 8))::UBIGINT / 4294967296.0) * (len(ids) - 3)) AS BIGINT) AS k
       FROM e WHERE len(ids) >= 4),
p AS (SELECT *, 61 - nq AS payload, 61 - nq - 16 AS step FROM qa),
w AS (SELECT *, unnest(range(0, CASE WHEN nt <= payload THEN 1 ELSE 1 + CAST(ceil((nt - payload) / step) AS BIGINT) END)) AS window_id FROM p),
s AS (SELECT *, window_id * step AS cs, len(ids[window_id * step + 1:window_id * step + payload]) AS L FROM w)
SELECT doc_id, CAST(window_id AS INTEGER) AS window_id, CAST(nq + 3 + L AS INTEGER) AS n_ids,
       CAST(CASE WHEN k >= cs AND k + 2 <= cs + L - 1 THEN k - cs + nq + 2 ELSE 0 END AS INTEGER) AS start_position,
       CAST(CASE WHEN k >= cs AND k + 2 <= cs + L - 1 THEN k + 2 - cs + nq + 2 ELSE 0 END AS INTEGER) AS end_position,
       CAST(CASE WHEN k >= cs AND k <= cs + L - 1 THEN k - cs + nq + 2 END AS INTEGER) AS answer_token
FROM s""")
def qa_windows_docs(spark, sf_dir):
    """Q5 + Q6 + Q8 + N4 + N5: windows of 64 ids (stride 16) with the question repeated, context
    offsets, and the answer's token span ((0, 0) when outside the window)."""
    w = _windows(spark, sf_dir)
    span = lb.answer_token_span("offset_mapping", "sequence_ids", F.col("answer_start"), F.col("answer_end"))
    out = w.withColumn("span", span)
    return out.select("doc_id", "window_id", F.size("input_ids").alias("n_ids"), "span.start_position", "span.end_position",
                      sq.char_to_token("offset_mapping", F.col("answer_start")).alias("answer_token"))


def qa_logits_frame(spark, sf_dir):
    """Windows as features with md5-made start/end logits per position, and the examples."""
    w = _windows(spark, sf_dir)
    logit = lambda kind: F.transform("input_ids", lambda x, i: seeded_uniform(F.lit(kind), F.col("doc_id"), F.col("window_id"), i) * 10)
    feats = w.select(F.col("doc_id").alias("example_id"), F.col("window_id").alias("feature_id"), "offset_mapping",
                     logit("s").alias("start_logits"), logit("e").alias("end_logits"))
    examples = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("example_id"), F.col("text").alias("context"))
    return feats, examples


@register("whole_word_masked_docs")
def whole_word_masked_docs(spark, sf_dir):
    """Q17 (+Q7): WordPiece ids with word ids; whole words masked with p = 0.2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    v = wordpiece_vocab(spark, sf_dir)
    pieces = vb.encode_wordpiece(docs, "text", "doc_id", v, then=lambda batch: batch.select(["doc_id", "tokens", "word_ids"]),  # spans stay in the task
                                 then_t=f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, tokens array<string>, word_ids array<int>")
    enc = vb.to_ids(pieces, v, "tokens", "ids").select("doc_id", "word_ids", "ids")
    m = enc.withColumn("m", sq.mask_words("ids", "word_ids", F.col("doc_id"), seed=5, p=0.2))
    return m.select("doc_id", F.size("ids").alias("n_ids"),
                    F.size(F.filter("m.labels", lambda x: x != -100)).alias("n_masked"),
                    F.md5(F.array_join("m.input_ids", ",")).alias("ids_md5"))


def _entity_groups_sql() -> str:
    uni = "(('0x' || substr(md5('9:' || CAST(sp.doc_id AS VARCHAR) || ':' || CAST(i AS VARCHAR)), 1, 8))::UBIGINT / 4294967296.0)"
    return f"""WITH {TAGS_SQL},
d AS (SELECT tg.doc_id, list_transform(tg.pred, lambda x: nm[x + 1]) AS tags, w.w AS ws,
             string_split_regex(doc.text, '\\S+') AS seps
      FROM tg JOIN w ON tg.doc_id = w.doc_id JOIN documents doc ON doc.doc_id = tg.doc_id, names),
tk AS (SELECT doc_id, unnest(tags) AS tag, generate_subscripts(tags, 1) - 1 AS pos FROM d),
ty AS (SELECT *, CASE WHEN starts_with(tag, 'B-') OR starts_with(tag, 'I-') THEN substr(tag, 3) END AS typ FROM tk),
pv AS (SELECT *, lag(typ) OVER (PARTITION BY doc_id ORDER BY pos) AS ptyp FROM ty),
en AS (SELECT *, sum(CASE WHEN typ IS NOT NULL AND (starts_with(tag, 'B-') OR ptyp IS NULL OR ptyp <> typ) THEN 1 ELSE 0 END)
                 OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ent FROM pv),
sp AS (SELECT doc_id, typ, min(pos) AS st, max(pos) AS en FROM en WHERE typ IS NOT NULL GROUP BY doc_id, typ, ent),
x AS (SELECT sp.doc_id, sp.typ,
             (SELECT avg({uni}) FROM range(sp.st, sp.en + 1) r(i)) AS score,
             coalesce(list_sum(list_transform(d.ws[sp.st + 1:sp.en + 1], lambda t: length(t))), 0)
             + coalesce(list_sum(list_transform(d.seps[sp.st + 2:sp.en + 1], lambda g: length(g))), 0) AS chars
      FROM sp JOIN d ON sp.doc_id = d.doc_id)
SELECT typ AS entity_group, count(*) AS entities, round(avg(score), 6) AS mean_score, CAST(sum(chars) AS BIGINT) AS chars
FROM x GROUP BY typ"""


@register("entity_groups_docs", _entity_groups_sql())
def entity_groups_docs(spark, sf_dir):
    """Predicted tags (md5) over the words of every document grouped into entities with mean
    score and character span; counted per type."""
    tg = _tags_frame(spark, sf_dir)
    names = F.array(*[F.lit(n) for n in NER_TAGS])
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    df = tg.join(docs, "doc_id").select(
        "doc_id", words("text").alias("tokens"), F.transform("pred", lambda x: F.element_at(names, x + 1)).alias("tags"),
        F.transform("pred", lambda x, i: seeded_uniform(F.lit(9), F.col("doc_id"), i)).alias("scores"),
        word_offsets("text").alias("offsets"))
    ents = lb.group_entities(df, "doc_id", offsets="offsets")
    return ents.groupBy("entity_group").agg(F.count(F.lit(1)).alias("entities"), F.round(F.avg("score"), 6).alias("mean_score"),
                                            F.sum(F.col("char_end") - F.col("char_start")).alias("chars"))


@register("qa_windows_udtf", f"""WITH {ENC_SQL},
w AS (SELECT doc_id, len(ids) AS n, unnest(range(0, CASE WHEN len(ids) <= 53 THEN 1 ELSE 1 + CAST(ceil((len(ids) - 53) / 37) AS BIGINT) END)) AS window_id
      FROM e WHERE len(ids) > 0)
SELECT doc_id, CAST(window_id AS INTEGER) AS window_id, CAST(window_id * 37 AS INTEGER) AS start,
       CAST(least(53, n - window_id * 37) AS INTEGER) AS n_ids FROM w""")
def qa_windows_udtf(spark, sf_dir):
    """The window generation of Q5 as a Python table function called from SQL."""
    from corpusprep.operators.tablefuncs import register_qa_windows
    register_qa_windows(spark)
    enc = encoded_docs_frame(spark, sf_dir).where(F.size("ids") > 0)
    enc.createOrReplaceTempView("_encoded_docs")
    return spark.sql("""
        SELECT e.doc_id, w.window_id, w.start, size(w.ids) AS n_ids
        FROM _encoded_docs e, LATERAL qa_windows(e.ids, 53, 37) w""")
