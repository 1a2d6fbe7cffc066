"""Dataset shaping, aggregation, joins and ranking over the corpus tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.functions.text import word_count, words
from corpusprep.operators import joins, ranking, shape
from corpusprep.sources.tables import table

QUERIES = {}
SQL = {}

# DuckDB spelling of the word split used by every oracle.
WORDS_SQL = "list_filter(string_split_regex({c}, '\\s+'), lambda x: x <> '')"
NWORDS_SQL = "CAST(len(" + WORDS_SQL + ") AS BIGINT)"


def register(name, sql=None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


@register("doc_words_by_lang", f"""
SELECT lang, count(*) AS docs, CAST(sum(w) AS BIGINT) AS words, round(avg(w), 4) AS mean_words
FROM (SELECT lang, {NWORDS_SQL.format(c='text')} AS w FROM documents)
WHERE w > 30 GROUP BY lang""")
def doc_words_by_lang(spark, sf_dir):
    """Flagship (T1, P7, A3): documents with more than 30 words, frequency and size per language."""
    docs = table(spark, sf_dir, "documents").select("lang", word_count("text").alias("w"))
    kept = docs.where(F.col("w") > 30)
    return kept.groupBy("lang").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("w").cast("long").alias("words"),
        F.round(F.avg("w"), 4).alias("mean_words")).orderBy(F.col("docs").desc(), "lang")


@register("reviews_shaped", f"""
SELECT d.doc_id AS patient_id, lower(d.source) AS condition, d.lang AS drug_name, l.quality AS rating,
       {NWORDS_SQL.format(c='d.text')} AS review_length
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.source IS NOT NULL AND {NWORDS_SQL.format(c='d.text')} > 30""")
def reviews_shaped(spark, sf_dir):
    """Review-table shaping (P1, P5, P6, P4, P7): labels attached by key, renamed, null-filtered then
    lower-cased, length derived, short reviews dropped."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    df = shape.add_column_by_key(docs, labels, "doc_id")
    df = shape.rename(df, {"doc_id": "patient_id", "source": "condition", "lang": "drug_name", "quality": "rating"})
    df = shape.lower_not_null(df, "condition")
    df = shape.derive(df, review_length=word_count("text").cast("long"))
    df = shape.min_words(df, "text", 30)
    return shape.remove_columns(df, ["text"])


@register("condition_value_counts", """
SELECT source AS condition, count(*) AS frequency FROM documents WHERE source IS NOT NULL GROUP BY source""")
def condition_value_counts(spark, sf_dir):
    """A3: value counts with renamed columns, nulls excluded, most frequent first."""
    docs = table(spark, sf_dir, "documents")
    return shape.value_counts(docs, "source", value_name="condition", count_name="frequency")


@register("distinct_sources", "SELECT DISTINCT source FROM documents")
def distinct_sources(spark, sf_dir):
    """A2"""
    return shape.distinct_values(table(spark, sf_dir, "documents"), "source")


SPLIT_SQL = """
(SELECT *, CASE WHEN rn <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM (
   SELECT *, row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn,
          count(*) OVER () AS n FROM documents))"""


@register("split_fraction_docs", f"""SELECT doc_id, split FROM {SPLIT_SQL}""")
def split_fraction_docs(spark, sf_dir):
    """Exact 80/20 split by seeded md5 order."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return ranking.split_fraction(docs, "doc_id", 0.8, seed=42)


@register("split_key_audit", f"""
SELECT split, count(*) AS rows, count(DISTINCT doc_id) AS distinct_keys, count(*) = count(DISTINCT doc_id) AS "unique"
FROM {SPLIT_SQL} GROUP BY split""")
def split_key_audit(spark, sf_dir):
    """A1 + A4 over the L4 split."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return shape.key_unique(ranking.split_fraction(docs, "doc_id", 0.8, seed=42), "doc_id", "split")


@register("split_counts_docs", """
SELECT doc_id, CASE WHEN rn <= 600 THEN 'train' ELSE 'test' END AS split FROM (
  SELECT doc_id, row_number() OVER (ORDER BY md5('7:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn FROM documents)
WHERE rn <= 800""")
def split_counts_docs(spark, sf_dir):
    """Exact train/test counts (600/200), remainder dropped."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return ranking.split_counts(docs, "doc_id", 600, 200, seed=7)


@register("relabelled_splits", f"""
SELECT doc_id, CASE split WHEN 'test' THEN 'validation' ELSE split END AS split FROM {SPLIT_SQL}
UNION ALL SELECT doc_id, 'test' AS split FROM labels""")
def relabelled_splits(spark, sf_dir):
    """Test renamed to validation, the labelled documents attached as the held-out test split."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    split = ranking.split_fraction(docs, "doc_id", 0.8, seed=42)
    held = table(spark, sf_dir, "labels").select("doc_id")
    return ranking.relabel_splits(split, {"test": "validation"}, held_out=held, held_out_name="test")


@register("seeded_sample_docs", """
SELECT doc_id, lang FROM documents ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 50""")
def seeded_sample_docs(spark, sf_dir):
    """L3: repeatable sample of 50 (sampling is the feature)."""
    return ranking.seeded_sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 50, 42)


@register("longest_docs", f"""
SELECT doc_id, {NWORDS_SQL.format(c='text')} AS review_length FROM documents
ORDER BY review_length DESC, doc_id LIMIT 10""")
def longest_docs(spark, sf_dir):
    """L1: sort by a derived column, take the first 10 (top-k report)."""
    df = table(spark, sf_dir, "documents").select("doc_id", word_count("text").cast("long").alias("review_length"))
    return df.orderBy(F.col("review_length").desc(), "doc_id").limit(10)


@register("first_docs_range", "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 25")
def first_docs_range(spark, sf_dir):
    """L2: positional range on a defined order."""
    return ranking.select_range(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id", 25)


@register("doc_global_rank", """
SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rank FROM documents""")
def doc_global_rank(spark, sf_dir):
    """Distributed global rank by (n_chars desc, doc_id)."""
    df = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return ranking.global_rank(df, [F.col("n_chars").desc(), F.col("doc_id")], "rank").select("doc_id", "rank")


@register("doc_batches", """
SELECT batch_id, count(*) AS rows, min(doc_id) AS first_doc, max(doc_id) AS last_doc FROM (
  SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 8) AS BIGINT) AS batch_id FROM documents)
GROUP BY batch_id""")
def doc_batches(spark, sf_dir):
    """Batches of 8 in key order; ceil(n/8) batches."""
    df = ranking.assign_batches(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 8)
    return df.groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("first_doc"),
                                      F.max("doc_id").alias("last_doc"))


@register("recent_events", """
SELECT event_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 20""")
def recent_events(spark, sf_dir):
    """Last 20 log rows (limit 0 -> 20, clamped to 200)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return ranking.recent(ev, "ts", 0, key="event_id").select("event_id", "event_type", "value")


@register("longest_doc_per_source", f"""
SELECT source, arg_max(doc_id, (n_chars, -doc_id)) AS doc_id, max(n_chars) AS n_chars FROM documents GROUP BY source""")
def longest_doc_per_source(spark, sf_dir):
    """Top-1 per group (longest document per source, ties -> smallest id)."""
    df = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return ranking.top1_per_group(df, "source", "n_chars", "doc_id").select("source", "doc_id", "n_chars")


@register("long_doc_cut", "SELECT doc_id, n_chars FROM documents WHERE n_chars > 4000")
def long_doc_cut(spark, sf_dir):
    """Threshold cut on a score."""
    return ranking.score_cut(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", 4000)


@register("columnar_head", """
SELECT array_to_string(list(doc_id ORDER BY doc_id), ',') AS doc_ids, array_to_string(list(lang ORDER BY doc_id), ',') AS langs
FROM (SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 5)""")
def columnar_head(spark, sf_dir):
    """First 5 rows as one row of lists (rendered as text for comparison)."""
    s = ranking.columnar_slice(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 5)
    return s.select(F.array_join(F.col("doc_id").cast("array<string>"), ",").alias("doc_ids"),
                    F.array_join("lang", ",").alias("langs"))


@register("keyword_keep_ratio", """
SELECT lang, count(*) FILTER (WHERE contains(text, 'the') OR contains(text, 'und') OR contains(text, 'que')) AS kept,
       count(*) AS total,
       round(100.0 * count(*) FILTER (WHERE contains(text, 'the') OR contains(text, 'und') OR contains(text, 'que')) / count(*), 2) AS kept_pct
FROM documents GROUP BY lang""")
def keyword_keep_ratio(spark, sf_dir):
    """P8 + P9: any-keyword filter and its keep ratio, per language."""
    docs = table(spark, sf_dir, "documents")
    return shape.keep_ratio(docs, shape.any_keyword("text", ["the", "und", "que"]), by=["lang"])


def conversation_issues_frame(spark, sf_dir):
    """Issue-style shaping on conversations (P10, P2, J2, T1/P7): first turn = title, second = body,
    later turns = comments; conversations with a system turn play pull requests.  One row per kept
    comment (more than 15 words).  Comments are never gathered into a list per conversation: the
    per-conversation fields (a hash aggregate with map-side partials) are joined onto the comment
    rows, so a huge conversation is spread over many tasks."""
    conv = table(spark, sf_dir, "conversations")
    issues = conv.groupBy("conv_id").agg(
        F.max(F.when(F.col("turn") == 0, F.col("text"))).alias("title"),
        F.max(F.when(F.col("turn") == 1, F.col("text"))).alias("body"),
        F.max(F.when(F.col("role") == "system", F.col("conv_id"))).alias("pull_request"),
        F.count_if(F.col("turn") >= 2).alias("n_comments"))
    issues = issues.where(~shape.flag_present("pull_request") & (F.col("n_comments") > 0))
    issues = shape.keep_only(issues, ["conv_id", "title", "body"])
    comments = conv.where(F.col("turn") >= 2).select("conv_id", "turn", F.col("text").alias("comment"))
    ex = joins.replicate_source(comments, issues, "conv_id")
    ex = ex.withColumn("comment_length", word_count("comment").cast("long"))
    return ex.where(F.col("comment_length") > 15)


@register("conversation_issues", f"""
WITH conv AS (
  SELECT conv_id,
         max(CASE WHEN turn = 0 THEN text END) AS title,
         max(CASE WHEN turn = 1 THEN text END) AS body,
         list(text ORDER BY turn) FILTER (WHERE turn >= 2) AS comments,
         max(CASE WHEN role = 'system' THEN conv_id END) AS pull_request
  FROM conversations GROUP BY conv_id),
issues AS (
  SELECT conv_id, title, body, coalesce(comments, []) AS comments FROM conv
  WHERE pull_request IS NULL AND len(coalesce(comments, [])) > 0),
exploded AS (SELECT conv_id, title, body, unnest(comments) AS comment FROM issues)
SELECT conv_id, {NWORDS_SQL.format(c='comment')} AS comment_length,
       md5(coalesce(title, '') || ' \n ' || coalesce(body, '') || ' \n ' || coalesce(comment, '')) AS text_md5
FROM exploded WHERE {NWORDS_SQL.format(c='comment')} > 15""")
def conversation_issues(spark, sf_dir):
    """P13 on the issue rows: title, body and comment joined null-safely (247 -> 851 -> 616 style)."""
    ex = conversation_issues_frame(spark, sf_dir)
    return ex.select("conv_id", "comment_length",
                     F.md5(shape.join_text(["title", "body", "comment"])).alias("text_md5"))


@register("guest_documents", """
SELECT c.c_custkey AS guest_id,
       'Name: ' || c.c_name || '\n' || 'Relation: ' || coalesce(n.n_name, '') || '\n' || 'Description: ' || c.c_mktsegment
         || '\n' || 'Email: ' || lower(replace(c.c_name, '#', '.')) || '@example.com' AS page_content,
       c.c_name AS name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def guest_documents(spark, sf_dir):
    """Labelled document text per guest (customer joined to nation) plus its name metadata."""
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    df = cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
    email = F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@example.com"))
    text = shape.labelled_text({"Name": "c_name", "Relation": "n_name", "Description": "c_mktsegment", "Email": email})
    meta = shape.labelled_metadata({"name": "c_name"})
    return df.select(F.col("c_custkey").alias("guest_id"), text.alias("page_content"), meta["name"].alias("name"))


@register("latest_event_per_user", """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type,
       arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY user_id""")
def latest_event_per_user(spark, sf_dir):
    """Last write wins per user."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return joins.latest_per_key(ev, "user_id", "ts", tie="event_id").select("user_id", "event_id", "event_type", "value")


@register("split_vocab_diff", f"""
WITH s AS {SPLIT_SQL},
w AS (SELECT DISTINCT split, unnest({WORDS_SQL.format(c='text')}) AS token FROM s),
o AS (SELECT DISTINCT token FROM w WHERE split = 'train'), n AS (SELECT DISTINCT token FROM w WHERE split = 'test')
SELECT count(*) FILTER (WHERE o.token IS NOT NULL AND n.token IS NOT NULL) AS kept,
       count(*) FILTER (WHERE n.token IS NULL) AS replaced, count(*) FILTER (WHERE o.token IS NULL) AS added
FROM o FULL OUTER JOIN n ON o.token = n.token""")
def split_vocab_diff(spark, sf_dir):
    """Word vocabulary of the train split against the test split: kept, replaced, added."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    split = ranking.split_fraction(docs, "doc_id", 0.8, seed=42)
    toks = split.select("split", F.explode(words("text")).alias("token"))
    return joins.vocab_diff(toks.where(F.col("split") == "train"), toks.where(F.col("split") == "test"))


@register("union_of_sources", """
SELECT doc_id, 'train' AS split FROM documents WHERE lang = 'en'
UNION ALL SELECT doc_id, 'extra' AS split FROM documents WHERE lang <> 'en'""")
def union_of_sources(spark, sf_dir):
    """Union of two frames with the same columns, tagged by split."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return joins.union_splits(train=docs.where(F.col("lang") == "en").select("doc_id"),
                              extra=docs.where(F.col("lang") != "en").select("doc_id"))


@register("word_length_stats", f"""
SELECT lang, min(w) AS min_len, max(w) AS max_len, round(avg(w), 4) AS mean_len, count(*) AS rows
FROM (SELECT lang, {NWORDS_SQL.format(c='text')} AS w FROM documents) GROUP BY lang""")
def word_length_stats(spark, sf_dir):
    """Length distribution per language."""
    docs = table(spark, sf_dir, "documents")
    return shape.length_stats(docs, word_count("text"), by=["lang"])


@register("word_length_percentiles")
def word_length_percentiles(spark, sf_dir):
    """Percentiles of the text lengths per language, from merged sketches.  No oracle: exact values differ by a
    rank here and there (on sf0.1 the 95th percentile of one language is 1324, exactly 1330)."""
    docs = table(spark, sf_dir, "documents")
    return shape.length_percentiles(docs, word_count("text"), {"p50": 0.5, "p95": 0.95, "p99": 0.99}, by=["lang"])


@register("labelled_expansion", """
SELECT d.lang, count(DISTINCT d.doc_id) AS source_rows, count(l.doc_id) AS output_rows,
       count(DISTINCT l.doc_id) AS sources_used, round(count(l.doc_id) / count(DISTINCT d.doc_id), 4) AS ratio
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang""")
def labelled_expansion(spark, sf_dir):
    """A5: rows produced per source row, per language (labels over documents)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    lab = table(spark, sf_dir, "labels").select("doc_id").join(docs, "doc_id")
    out = shape.expansion_ratio(docs, lab, "doc_id", by=["lang"])
    return out.select("lang", "source_rows", F.coalesce("output_rows", F.lit(0)).alias("output_rows"),
                      F.coalesce("sources_used", F.lit(0)).alias("sources_used"),
                      F.coalesce("ratio", F.lit(0.0)).alias("ratio"))


@register("conversation_answer_audit", """
SELECT conv_id, max(CASE WHEN role = 'system' THEN 1 ELSE 0 END) = 1 AS is_pull_request,
       CAST(count(*) FILTER (WHERE role = 'assistant') AS INTEGER) AS answers,
       count(*) FILTER (WHERE role = 'assistant') <> 1 AS not_single_answer,
       ['question', 'answer', 'instruction'][CASE min(role) WHEN 'assistant' THEN 1 WHEN 'system' THEN 2 ELSE 0 END + 1] AS least_role_name,
       CASE min(role) WHEN 'assistant' THEN 1 WHEN 'system' THEN 2 WHEN 'user' THEN 0 END AS least_role_id
FROM conversations GROUP BY conv_id""")
def conversation_answer_audit(spark, sf_dir):
    """P10 + P12 + P18: pull-request flag from a nullable field, conversations whose answer list
    does not hold exactly one answer, and a class id <-> name mapping both ways."""
    conv = table(spark, sf_dir, "conversations")
    names = ["question", "answer", "instruction"]
    role_names = F.create_map(F.lit("user"), F.lit("question"), F.lit("assistant"), F.lit("answer"),
                              F.lit("system"), F.lit("instruction"))
    g = conv.groupBy("conv_id").agg(
        F.max(F.when(F.col("role") == "system", F.col("conv_id"))).alias("pull_request"),
        F.count_if(F.col("role") == "assistant").cast("int").alias("answers"),
        F.min("role").alias("least_role"))
    least_id = shape.label_to_id(F.element_at(role_names, F.col("least_role")), names)
    return g.select("conv_id", shape.flag_present("pull_request").alias("is_pull_request"),
                    "answers", shape.count_not("answers", 1).alias("not_single_answer"),
                    shape.id_to_label(least_id, names).alias("least_role_name"), least_id.alias("least_role_id"))


@register("doc_label_lists", """
WITH l AS (SELECT doc_id, [quality, toxic] AS labels, CASE WHEN toxic = 1 THEN doc_id END AS toxic_flag FROM labels),
d AS (SELECT d.doc_id, coalesce(l.labels, CAST([] AS INTEGER[])) AS labels, l.toxic_flag FROM documents d LEFT JOIN l ON d.doc_id = l.doc_id),
k AS (SELECT * FROM d WHERE toxic_flag IS NULL AND len(labels) > 0)
SELECT doc_id, CAST(generate_subscripts(labels, 1) - 1 AS INTEGER) AS position, unnest(labels) AS label FROM k""")
def doc_label_lists(spark, sf_dir):
    """J1 + P11 + J11 on naturally bounded lists: each document looks up its label list (quality,
    toxic; empty when unlabelled), keeps the non-toxic labelled ones, one row per list element."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.array("quality", "toxic").alias("labels"), F.when(F.col("toxic") == 1, F.col("doc_id")).alias("toxic_flag"))
    docs = table(spark, sf_dir, "documents").select("doc_id")
    df = joins.lookup_list(docs, labels.select("doc_id", "labels"), "doc_id", "labels", "int") \
        .join(labels.select("doc_id", "toxic_flag"), "doc_id", "left")
    kept = df.where(shape.has_items("toxic_flag", "labels"))
    return joins.explode_list(kept.select("doc_id", "labels"), "labels", pos_col="position") \
        .select("doc_id", F.col("position").cast("int").alias("position"), F.col("labels").alias("label"))
