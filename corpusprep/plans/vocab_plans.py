"""Vocabulary queries (B1-B12, E12) over the documents and benchmark tables."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from corpusprep.functions.batches import last_items
from corpusprep.functions.text import pretokenize, words
from corpusprep.operators import metrics as mt
from corpusprep.operators import sequences as sq
from corpusprep.operators import vocab as vb
from corpusprep.plans.sequence_plans import ENC_SQL, VOCAB_SIZE, encoded_docs_frame
from corpusprep.sources.tables import table

QUERIES = {}
SQL = {}

# Merges and units learned by the registered queries; the operators take any number.
MERGES, PIECE_MERGES, UNITS = 200, 2000, 4000


def register(name, sql=None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


PRETOK_SQL = "regexp_extract_all(text, '[\\p{L}\\p{N}_\\p{M}]+|[^\\p{L}\\p{N}_\\p{M}\\s]')"


@register("word_frequency_table", f"""
SELECT word, count(*) AS count FROM (SELECT unnest({PRETOK_SQL}) AS word FROM documents) GROUP BY word""")
def word_frequency_table(spark, sf_dir):
    """B1: distinct pre-tokens of the whole corpus with their counts."""
    return vb.word_frequencies(table(spark, sf_dir, "documents"), "text")


@register("byte_unit_stats", """
WITH t AS (SELECT lang, CAST(sum(strlen(hex(encode(text))) / 2) AS BIGINT) AS byte_units FROM documents GROUP BY lang),
u AS (SELECT lang, count(DISTINCT u) AS distinct_units FROM (
        SELECT lang, unnest(regexp_extract_all(hex(encode(text)), '(..)', 1)) AS u FROM documents) GROUP BY lang)
SELECT t.lang, byte_units, distinct_units FROM t JOIN u ON t.lang = u.lang""")
def byte_unit_stats(spark, sf_dir):
    """UTF-8 byte units (hex pairs) per language: total and distinct (at most 256)."""
    d = table(spark, sf_dir, "documents").select("lang", F.octet_length("text").cast("long").alias("n"), F.array_distinct(vb.byte_units("text")).alias("us"))
    totals = d.groupBy("lang").agg(F.sum("n").alias("byte_units"))
    distinct = d.select("lang", F.explode("us").alias("u")).groupBy("lang").agg(F.count_distinct("u").alias("distinct_units"))
    return totals.join(distinct, "lang")


def _freqs(spark, sf_dir):
    return vb.word_frequencies(table(spark, sf_dir, "documents"), "text")


def _tokens_only(docs) -> dict:
    """For an encoder whose word indices and spans the query does not return: they stay in the task."""
    return {"then": lambda batch: batch.select(["doc_id", "tokens"]), "then_t": f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, tokens array<string>"}


@register("bpe_learned_merges")
def bpe_learned_merges(spark, sf_dir):
    """B2: the first MERGES BPE merges learned from the whole corpus's word frequencies."""
    merges, _ = vb.learn_bpe(_freqs(spark, sf_dir), MERGES)
    return merges


@register("bpe_encoded_docs")
def bpe_encoded_docs(spark, sf_dir):
    """B2 + B6 + B11: MERGES merges learned, every document encoded; tokens per document under the
    character alphabet and under the merges."""
    freqs = _freqs(spark, sf_dir)
    merges, _ = vb.learn_bpe(freqs, MERGES)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    enc = vb.encode_bpe(docs, "text", "doc_id", merges, **_tokens_only(docs))
    base = docs.select("doc_id", F.aggregate(F.transform(pretokenize("text"), lambda w: F.length(w)), F.lit(0),
                                             lambda a, x: a + x).alias("tokens_chars"))
    return enc.select("doc_id", F.size("tokens").alias("tokens_bpe")).join(base, "doc_id")


@register("byte_bpe_encoded_docs")
def byte_bpe_encoded_docs(spark, sf_dir):
    """B5 + B2 + B6: byte-level BPE (256 base units, no unknown), MERGES merges, every document."""
    merges, _ = vb.learn_bpe(_freqs(spark, sf_dir), MERGES, byte_level=True)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    enc = vb.encode_bpe(docs, "text", "doc_id", merges, byte_level=True, **_tokens_only(docs))
    return enc.select("doc_id", F.size("tokens").alias("tokens"), F.size(F.filter("tokens", lambda t: F.length(t) > 2)).alias("merged"))


@register("byte_offsets_docs", r"""
WITH p AS (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}_\p{M}]+|[^\p{L}\p{N}_\p{M}\s]|\s+') AS pieces FROM documents),
i AS (SELECT doc_id, pieces, list_filter(range(1, len(pieces) + 1), lambda n: NOT regexp_matches(pieces[n], '^\s')) AS spots FROM p),
w AS (SELECT doc_id, pieces, len(spots) AS n_words, len(spots) // 2 AS word, spots[len(spots) // 2 + 1] AS piece FROM i),
s AS (SELECT *, CAST(coalesce(list_sum(list_transform(pieces[1:piece - 1], lambda x: length(x))), 0) AS INT) AS word_start FROM w)
SELECT doc_id, CAST(n_words AS INT) AS n_words, CAST(word AS INT) AS word, word_start, CAST(word_start + length(pieces[piece]) AS INT) AS word_end,
       CAST(word AS INT) AS word_of_start, CAST(word AS INT) AS word_of_last, word_start AS token_start FROM s WHERE n_words > 0""")
def byte_offsets_docs(spark, sf_dir):
    """Q6 + Q7 + Q9 on byte-level pieces: the character span of every document's middle word, put together from its
    pieces, the words that its first and last character lie in, and where the token of the first begins."""
    merges, _ = vb.learn_bpe(_freqs(spark, sf_dir), MERGES, byte_level=True)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def spans(batch: pa.RecordBatch) -> pa.RecordBatch:
        batch = batch.filter(pc.greater(pc.list_value_length(batch.column("tokens")), 0))
        offsets, word_ids = batch.column("offsets"), batch.column("word_ids")
        n_words = last_items(word_ids) + 1
        n_words, word = pa.array(n_words, pa.int32()), pa.array(n_words // 2, pa.int32())
        span = sq.word_to_chars(offsets, word_ids, word)
        first, end = span.field(0), span.field(1)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), n_words, word, first, end, sq.char_to_word(offsets, word_ids, first),
             sq.char_to_word(offsets, word_ids, pc.subtract(end, 1)), sq.token_to_chars(offsets, sq.char_to_token(offsets, first)).field(0)],
            names=["doc_id", "n_words", "word", "word_start", "word_end", "word_of_start", "word_of_last", "token_start"])

    return vb.encode_bpe(docs, "text", "doc_id", merges, byte_level=True, then=spans,
                         then_t=f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words int, word int, word_start int, word_end int, "
                                "word_of_start int, word_of_last int, token_start int")


@register("wordpiece_learned_docs")
def wordpiece_learned_docs(spark, sf_dir):
    """B3 + B7: WordPiece learned to alphabet + PIECE_MERGES merges, every document encoded."""
    freqs = _freqs(spark, sf_dir)
    v = vb.learn_wordpiece(freqs, 1 << 30, max_merges=PIECE_MERGES)
    enc = vb.encode_wordpiece(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "doc_id", v)
    return enc.select("doc_id", F.size("tokens").alias("tokens"), F.size(F.filter("tokens", lambda t: t == "[UNK]")).alias("unknown"))


@register("unigram_pruned_docs")
def unigram_pruned_docs(spark, sf_dir):
    """B4 + B8: unigram units seeded with four times as many repeated substrings, re-estimated and pruned by
    quarters to UNITS units; every document segmented by Viterbi."""
    units = vb.prune_unigram(_freqs(spark, sf_dir), UNITS, share=0.25)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    enc = vb.encode_unigram(docs, "text", "doc_id", units, **_tokens_only(docs))
    return enc.select("doc_id", F.size("tokens").alias("tokens"))


@register("decoded_docs", f"""WITH {ENC_SQL},
known AS (SELECT token FROM v WHERE id >= 1000),
dec AS (SELECT t.doc_id, string_agg(t.tok, ' ' ORDER BY t.pos) AS txt FROM t JOIN known ON t.tok = known.token GROUP BY t.doc_id)
SELECT d.doc_id, md5(coalesce(dec.txt, '')) AS text_md5 FROM documents d LEFT JOIN dec ON d.doc_id = dec.doc_id""")
def decoded_docs(spark, sf_dir):
    """B9 + B10 + E12: ids with -100 label positions replaced by the pad id, decoded back to text
    with special tokens skipped (unknown words disappear, the rest round-trips)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    freqs = vb.word_frequencies(docs, "text", pretok=words)
    v = vb.word_vocab(freqs, VOCAB_SIZE)
    enc = vb.to_ids(docs.select("doc_id", words("text").alias("tokens")), v, "tokens", "ids")
    labels = enc.withColumn("labels", F.transform("ids", lambda x: F.when(x == 100, F.lit(-100)).otherwise(x)))
    cleaned = labels.withColumn("labels", mt.clean_labels("labels"))
    dec = vb.decode(cleaned.select("doc_id", "labels"), v, "labels", skip_special=True)
    return dec.select("doc_id", F.md5("text").alias("text_md5"))


@register("single_token_keywords")
def single_token_keywords(spark, sf_dir):
    """Distinct benchmark words encoded with the corpus WordPiece vocabulary; which of them
    are a single token."""
    from corpusprep.plans.label_plans import wordpiece_vocab
    kw = table(spark, sf_dir, "benchmark").select(F.explode(words("text")).alias("word")).distinct()
    enc = vb.encode_wordpiece(kw, "word", "word", wordpiece_vocab(spark, sf_dir))
    out = vb.single_token_ids(enc, "word")
    return out.groupBy("single").agg(F.count(F.lit(1)).alias("keywords"))


@register("vocab_report_docs")
def vocab_report_docs(spark, sf_dir):
    """Tokens per document under the word vocabulary and under the WordPiece vocabulary."""
    from corpusprep.plans.label_plans import wordpiece_vocab
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    old = encoded_docs_frame(spark, sf_dir).select("doc_id", F.col("ids").alias("tokens"))
    new = vb.encode_wordpiece(docs, "text", "doc_id", wordpiece_vocab(spark, sf_dir))
    return vb.vocab_report(old, new, "doc_id")
