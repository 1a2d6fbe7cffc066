"""Vocabulary ids and training sequences (B1, B9, Q1-Q20) over the documents table.

Ids come from a word-level vocabulary learned from the corpus itself (the 5000 most frequent
whitespace words, ids from 1000; [UNK] = 100), so DuckDB can recompute every array.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from corpusprep.functions.text import words
from corpusprep.operators import sequences as sq
from corpusprep.operators import vocab as vb
from corpusprep.plans.corpus import WORDS_SQL
from corpusprep.sources.tables import table

QUERIES = {}
SQL = {}

VOCAB_SIZE = 5000


def register(name, sql=None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


def encoded_docs_frame(spark, sf_dir):
    """(doc_id, lang, ids) with the corpus word vocabulary."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    freqs = vb.word_frequencies(docs, "text", pretok=words)
    vocab = vb.word_vocab(freqs, VOCAB_SIZE)
    enc = vb.to_ids(docs.select("doc_id", "lang", words("text").alias("tokens")), vocab, "tokens", "ids")
    return enc.drop("tokens")


ENC_SQL = f"""
f AS (SELECT w AS word, count(*) AS cnt FROM (SELECT unnest({WORDS_SQL.format(c='text')}) AS w FROM documents) GROUP BY w),
v AS (SELECT word AS token, CAST(row_number() OVER (ORDER BY cnt DESC, word) - 1 + 1000 AS INTEGER) AS id FROM f
      QUALIFY row_number() OVER (ORDER BY cnt DESC, word) <= {VOCAB_SIZE}
      UNION ALL SELECT * FROM (VALUES ('[PAD]', 0), ('[UNK]', 100), ('[CLS]', 101), ('[SEP]', 102), ('[MASK]', 103)) s(token, id)),
t AS (SELECT doc_id, unnest({WORDS_SQL.format(c='text')}) AS tok, generate_subscripts({WORDS_SQL.format(c='text')}, 1) AS pos FROM documents),
e0 AS (SELECT t.doc_id, list(CAST(coalesce(v.id, 100) AS INTEGER) ORDER BY t.pos) AS ids FROM t LEFT JOIN v ON t.tok = v.token GROUP BY t.doc_id),
e AS (SELECT d.doc_id, d.lang, coalesce(e0.ids, CAST([] AS INTEGER[])) AS ids FROM documents d LEFT JOIN e0 ON d.doc_id = e0.doc_id)"""

IDS_MD5 = "md5(array_to_string({c}, ','))"


def _md5(c):
    return F.md5(F.array_join(c, ","))


@register("encoded_docs", f"""WITH {ENC_SQL},
tp AS (SELECT doc_id, [101] || ids[1:126] || [102] AS input_ids, ids FROM e)
SELECT doc_id, CAST(len(input_ids) AS INTEGER) AS n_ids,
       CAST(len(list_filter(ids, lambda x: x = 100)) AS INTEGER) AS n_unk,
       {IDS_MD5.format(c='input_ids')} AS ids_md5,
       CAST(list_sum(list_transform(input_ids, lambda x: 0)) AS BIGINT) AS type_sum,
       CAST(list_sum(list_transform(input_ids, lambda x: 1)) AS BIGINT) AS mask_sum
FROM tp""")
def encoded_docs(spark, sf_dir):
    """B1 + B9 + Q1 + Q3: corpus word vocabulary, ids, single template cut at 128."""
    enc = encoded_docs_frame(spark, sf_dir)
    t = enc.withColumn("t", sq.single_template("ids", 128))
    return t.select("doc_id", F.size("t.input_ids").alias("n_ids"),
                    F.size(F.filter("ids", lambda x: x == 100)).alias("n_unk"),
                    _md5(F.col("t.input_ids")).alias("ids_md5"),
                    F.aggregate("t.token_type_ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("type_sum"),
                    F.aggregate("t.attention_mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("mask_sum"))


@register("overflow_chunks_docs", f"""WITH {ENC_SQL},
s AS (SELECT doc_id, ids, unnest(range(0, len(ids), 126)) AS st FROM e WHERE len(ids) > 0)
SELECT doc_id, CAST(st / 126 AS INTEGER) AS chunk_id, CAST(len(ids[st + 1:st + 126]) + 2 AS INTEGER) AS n_ids,
       {IDS_MD5.format(c="[101] || ids[st + 1:st + 126] || [102]")} AS ids_md5 FROM s""")
def overflow_chunks_docs(spark, sf_dir):
    """Q4: windows of 128 ids with specials ([128, 45]-style tail), source key kept; A5 follows."""
    ch = sq.overflow_chunks(encoded_docs_frame(spark, sf_dir), "doc_id", "ids", 128)
    return ch.select("doc_id", "chunk_id", F.size("input_ids").alias("n_ids"), _md5(F.col("input_ids")).alias("ids_md5"))


@register("full_chunks_docs", f"""WITH {ENC_SQL},
s AS (SELECT doc_id, ids, unnest(range(0, len(ids), 64)) AS st FROM e WHERE len(ids) > 0)
SELECT doc_id, CAST(st / 64 AS INTEGER) AS chunk_id, {IDS_MD5.format(c='ids[st + 1:st + 64]')} AS ids_md5
FROM s WHERE len(ids[st + 1:st + 64]) = 64""")
def full_chunks_docs(spark, sf_dir):
    """Q10: 64-id blocks without specials, short tails dropped."""
    ch = sq.full_chunks(encoded_docs_frame(spark, sf_dir), "doc_id", "ids", 64)
    return ch.select("doc_id", "chunk_id", _md5(F.col("input_ids")).alias("ids_md5"))


@register("packed_docs", f"""WITH {ENC_SQL},
r AS (SELECT doc_id, ids || [102] AS ids, row_number() OVER (ORDER BY doc_id) AS rn FROM e),
g AS (SELECT *, CAST(floor((rn - 1) / 100) AS BIGINT) AS pack_group FROM r),
o AS (SELECT *, coalesce(sum(len(ids)) OVER (PARTITION BY pack_group ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off,
             sum(len(ids)) OVER (PARTITION BY pack_group) AS tot FROM g),
tk AS (SELECT pack_group, tot, off + generate_subscripts(ids, 1) - 1 AS p, unnest(ids) AS id FROM o),
c AS (SELECT pack_group, CAST(floor(p / 128) AS BIGINT) AS chunk, list(id ORDER BY p) AS input_ids FROM tk
      WHERE p < floor(tot / 128) * 128 GROUP BY pack_group, chunk)
SELECT pack_group, chunk, {IDS_MD5.format(c='input_ids')} AS ids_md5, CAST(len(input_ids) AS INTEGER) AS n_ids FROM c""")
def packed_docs(spark, sf_dir):
    """Q11 + Q12: documents in id order, separator appended, packed in groups of 100 rows into
    128-id blocks, each group's remainder dropped."""
    enc = encoded_docs_frame(spark, sf_dir).select("doc_id", "ids")
    p = sq.pack_with_eos(enc, "doc_id", "ids", 128, eos=sq.SEP_ID, group=100)
    return p.select("pack_group", "chunk", _md5(F.col("input_ids")).alias("ids_md5"), F.size("input_ids").alias("n_ids"))


@register("padded_batches", f"""WITH {ENC_SQL},
b AS (SELECT doc_id, ids, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 8) AS BIGINT) AS batch_id FROM e),
m AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS ml FROM b)
SELECT doc_id, batch_id, CAST(ml AS INTEGER) AS padded_len,
       {IDS_MD5.format(c='ids || list_transform(range(ml - len(ids)), lambda x: 0)')} AS ids_md5,
       {IDS_MD5.format(c='ids || list_transform(range(ml - len(ids)), lambda x: -100)')} AS labels_md5,
       CAST(len(ids) AS INTEGER) AS mask_ones
FROM m""")
def padded_batches(spark, sf_dir):
    """Q13 + Q14 + Q15: batches of 8 (L8), padded to the longest row of the batch;
    labels padded with -100; attention mask marks real ids."""
    from corpusprep.operators.ranking import assign_batches
    enc = encoded_docs_frame(spark, sf_dir).select("doc_id", "ids")
    b = assign_batches(enc, "doc_id", 8).withColumn("labels", F.col("ids"))
    w = Window.partitionBy("batch_id")
    b = b.withColumn("_ml", F.max(F.size("ids")).over(w)).withColumn("labels", sq.pad_labels("labels", F.col("_ml")))
    p = sq.pad_batch(b, "batch_id", {"ids": sq.PAD_ID})
    return p.select("doc_id", "batch_id", F.size("ids").alias("padded_len"), _md5(F.col("ids")).alias("ids_md5"),
                    _md5(F.col("labels")).alias("labels_md5"),
                    F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_ones"))


def _u(kind: str) -> str:
    at = {"p": 1, "v": 9, "r": 17}[kind]
    return (f"(('0x' || substr(md5(concat_ws(':', '42', CAST(doc_id AS VARCHAR), CAST(i - 1 AS VARCHAR))), {at}, 8))"
            f"::UBIGINT / 4294967296.0)")


PICK = f"(NOT list_contains([0, 100, 101, 102, 103], x) AND {_u('p')} < 0.15)"


@register("masked_docs", f"""WITH {ENC_SQL},
tp AS (SELECT doc_id, [101] || ids || [102] AS ids FROM e),
m AS (SELECT doc_id,
        list_transform(ids, lambda x, i: CASE WHEN NOT {PICK} THEN x WHEN {_u('v')} < 0.8 THEN 103
             WHEN {_u('v')} < 0.9 THEN CAST(floor({_u('r')} * 29522) + 1000 AS INTEGER) ELSE x END) AS input_ids,
        list_transform(ids, lambda x, i: CASE WHEN {PICK} THEN x ELSE -100 END) AS labels FROM tp)
SELECT doc_id, {IDS_MD5.format(c='input_ids')} AS ids_md5, {IDS_MD5.format(c='labels')} AS labels_md5,
       CAST(len(list_filter(labels, lambda x: x <> -100)) AS INTEGER) AS n_masked FROM m""")
def masked_docs(spark, sf_dir):
    """Q16: seeded 15% token masking (80/10/10) over all templated ids of every document."""
    enc = encoded_docs_frame(spark, sf_dir)
    t = enc.withColumn("ids", sq.single_template("ids")["input_ids"])
    m = t.withColumn("m", sq.mask_tokens("ids", F.col("doc_id"), seed=42, p=0.15))
    return m.select("doc_id", _md5(F.col("m.input_ids")).alias("ids_md5"), _md5(F.col("m.labels")).alias("labels_md5"),
                    F.size(F.filter("m.labels", lambda x: x != -100)).alias("n_masked"))


@register("next_token_docs", f"""WITH {ENC_SQL},
tp AS (SELECT doc_id, ids FROM e)
SELECT doc_id, {IDS_MD5.format(c='ids[1:len(ids) - 1]')} AS inputs_md5, {IDS_MD5.format(c='ids[2:len(ids)]')} AS labels_md5,
       {IDS_MD5.format(c='[0] || ids[1:len(ids) - 1]')} AS decoder_md5 FROM tp""")
def next_token_docs(spark, sf_dir):
    """Q19 + Q20: next-token inputs/labels and right-shifted decoder inputs (start id 0)."""
    enc = encoded_docs_frame(spark, sf_dir).select("doc_id", "ids")
    nt = enc.withColumn("nt", sq.next_token_labels("ids"))
    return nt.select("doc_id", _md5(F.col("nt.input_ids")).alias("inputs_md5"), _md5(F.col("nt.labels")).alias("labels_md5"),
                     _md5(sq.decoder_inputs("ids", 0)).alias("decoder_md5"))


@register("pair_template_docs", f"""WITH {ENC_SQL},
pr AS (SELECT doc_id, ids AS a, lead(ids) OVER (PARTITION BY lang ORDER BY doc_id) AS b FROM e)
SELECT doc_id, CAST(len(a) + len(b) + 3 AS INTEGER) AS n_ids, CAST(len(b) + 1 AS BIGINT) AS type_ones,
       {IDS_MD5.format(c='[101] || a || [102] || b || [102]')} AS ids_md5 FROM pr WHERE b IS NOT NULL""")
def pair_template_docs(spark, sf_dir):
    """Q2 + Q8: each document paired with the next one of its language, all ids of both."""
    from corpusprep.operators.ranking import neighbor_values
    enc = encoded_docs_frame(spark, sf_dir).select("doc_id", "lang", F.col("ids").alias("a"))
    pr = neighbor_values(enc, "lang", "doc_id", ["a"], 1, "next_").withColumnRenamed("next_a", "b").where(F.col("b").isNotNull())
    t = pr.withColumn("t", sq.pair_template("a", "b"))
    return t.select("doc_id", F.size("t.input_ids").alias("n_ids"),
                    F.aggregate("t.token_type_ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("type_ones"),
                    _md5(F.col("t.input_ids")).alias("ids_md5"))


@register("chunk_expansion", f"""WITH {ENC_SQL},
s AS (SELECT doc_id, unnest(range(0, len(ids), 126)) AS st FROM e WHERE len(ids) > 0)
SELECT (SELECT count(*) FROM documents) AS source_rows, count(*) AS output_rows, count(DISTINCT doc_id) AS sources_used,
       round(count(*) / (SELECT count(*) FROM documents), 4) AS ratio FROM s""")
def chunk_expansion(spark, sf_dir):
    """A5 + J2: chunks produced per source document for 128-id overflow windows."""
    from corpusprep.operators import shape
    enc = encoded_docs_frame(spark, sf_dir)
    ch = sq.overflow_chunks(enc, "doc_id", "ids", 128)
    return shape.expansion_ratio(table(spark, sf_dir, "documents"), ch.select("doc_id", "chunk_id"), "doc_id")


@register("summarization_pairs", f"""
WITH p AS (SELECT doc_id, lang, text AS source, lead(split_part(text, chr(10), 1)) OVER (PARTITION BY lang ORDER BY doc_id) AS target
           FROM documents)
SELECT doc_id, md5('summarize: ' || source) AS input_md5, target,
       CAST(len({WORDS_SQL.format(c='target')}) AS INTEGER) AS target_words
FROM p WHERE target IS NOT NULL AND len({WORDS_SQL.format(c='target')}) > 5""")
def summarization_pairs(spark, sf_dir):
    """P15 + P16 + P17: (document, first line of the next document of its language) as a
    translation-style struct, fields picked into columns, task prefix added, short targets dropped."""
    from corpusprep.operators import shape
    from corpusprep.functions.text import word_count
    from corpusprep.operators.ranking import neighbor_values
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text", F.split("text", "\n").getItem(0).alias("line"))
    nb = neighbor_values(docs, "lang", "doc_id", ["line"], 1, "next_")
    pairs = nb.select("doc_id", F.struct(F.col("text").alias("source"), F.col("next_line").alias("target")).alias("translation"))
    pairs = shape.pick_pair(pairs, "translation", "source", "target").where(F.col("target").isNotNull())
    pairs = shape.min_target_words(pairs, "target", 5)
    return pairs.select("doc_id", F.md5(shape.task_prefix("source")).alias("input_md5"), "target",
                        word_count("target").alias("target_words"))


@register("parallel_pairs_encoded", f"""WITH {ENC_SQL},
p AS (SELECT doc_id, ids AS src, lead(ids) OVER (PARTITION BY lang ORDER BY doc_id) AS tgt FROM e)
SELECT doc_id, {IDS_MD5.format(c='src[1:128]')} AS input_md5, {IDS_MD5.format(c='tgt[1:128]')} AS labels_md5,
       CAST(len(tgt[1:128]) AS INTEGER) AS n_labels FROM p WHERE tgt IS NOT NULL""")
def parallel_pairs_encoded(spark, sf_dir):
    """Q21: source -> input_ids and target -> labels (the next document of the same language),
    both encoded with the corpus vocabulary and cut at 128."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    freqs = vb.word_frequencies(docs, "text", pretok=words)
    vocab = vb.word_vocab(freqs, VOCAB_SIZE)
    from corpusprep.operators.ranking import neighbor_values
    pairs = neighbor_values(docs, "lang", "doc_id", ["text"], 1, "next_") \
        .select("doc_id", F.col("text").alias("src"), F.col("next_text").alias("tgt")).where(F.col("tgt").isNotNull())

    def encode(df, col):
        return vb.to_ids(df.select("doc_id", words(col).alias("tokens")), vocab, "tokens", "input_ids")

    out = sq.encode_parallel(pairs, "doc_id", "src", "tgt", encode, 128)
    return out.select("doc_id", _md5(F.col("input_ids")).alias("input_md5"), _md5(F.col("labels")).alias("labels_md5"),
                      F.size("labels").alias("n_labels"))


@register("frozen_masks_docs", SQL["masked_docs"])
def frozen_masks_docs(spark, sf_dir):
    """Q18: masking done once with a fixed seed, written to the shared checkpoint area, read back
    with the masked columns renamed to the model's names (same values as the live masking)."""
    from corpusprep.streaming.streams import checkpoint_path
    enc = encoded_docs_frame(spark, sf_dir)
    t = enc.select("doc_id", sq.single_template("ids")["input_ids"].alias("ids"))
    back = sq.freeze_masks(t, "doc_id", "ids", 42, checkpoint_path(spark, "frozen-masks"))
    return back.select("doc_id", _md5(F.col("input_ids")).alias("ids_md5"), _md5(F.col("labels")).alias("labels_md5"),
                       F.size(F.filter("labels", lambda x: x != -100)).alias("n_masked"))


@register("qa_windows_per_doc", f"""WITH {ENC_SQL}
SELECT doc_id, CAST(CASE WHEN len(ids) <= 64 - 3 - len(ids[1:8]) THEN 1
            ELSE 1 + ceil((len(ids) - (64 - 3 - len(ids[1:8]))) / (64 - 3 - len(ids[1:8]) - 16)) END AS BIGINT) AS n_features
FROM e WHERE len(ids) >= 4""")
def qa_windows_per_doc(spark, sf_dir):
    """J4 + J3 + Q5: windows (features) of 64 ids, stride 16, grouped back to their document."""
    from corpusprep.operators import joins
    from corpusprep.plans.label_plans import _windows
    w = _windows(spark, sf_dir).select("doc_id", "window_id")
    examples = encoded_docs_frame(spark, sf_dir).where(F.size("ids") >= 4).select("doc_id")
    per = joins.features_of(examples, w, "doc_id").select("doc_id", "n_features").distinct()
    return joins.pair_with_reference(per, examples, "doc_id")
