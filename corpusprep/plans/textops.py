"""Text scalars (T1-T19) over documents, pages, events and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions import text as tx
from corpusprep.plans.corpus import WORDS_SQL
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


@register("doc_text_scalars", f"""
SELECT doc_id,
       CAST(floor(length(text) / 4) AS BIGINT) AS est_tokens,
       round(CAST(0.3 AS DOUBLE) * (length(text) - length(regexp_replace(text, '[^\\x{{4E00}}-\\x{{9FFF}}]', '', 'g')))
             + CAST(0.6 AS DOUBLE) * length(regexp_replace(text, '[^\\x{{4E00}}-\\x{{9FFF}}]', '', 'g')), 4) AS est_tokens_script,
       md5(trim(text, ' \t\n\r\x0b\x0c')) AS stripped_md5,
       array_to_string(({WORDS_SQL.format(c='text')})[1:8], ' ') AS head_words,
       substr(text, 1, 40) AS head_chars,
       md5(CASE WHEN position('</think>' IN text) > 0 THEN split_part(text, '</think>', -1) ELSE text END) AS answer_md5
FROM documents""")
def doc_text_scalars(spark, sf_dir):
    """T6, T7, T8, T14, T16 on every document."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id",
        tx.estimate_tokens("text").alias("est_tokens"),
        F.round(tx.estimate_tokens_by_script("text"), 4).alias("est_tokens_script"),
        F.md5(tx.strip("text")).alias("stripped_md5"),
        tx.truncate_words("text", 8).alias("head_words"),
        tx.truncate_chars("text", 40).alias("head_chars"),
        F.md5(tx.after_marker("text")).alias("answer_md5"),
    )


@register("pretoken_counts", """
SELECT lang, CAST(sum(len(regexp_extract_all(text, '[\\p{L}\\p{N}_\\p{M}]+|[^\\p{L}\\p{N}_\\p{M}\\s]'))) AS BIGINT) AS pretokens,
       count(*) AS docs
FROM documents GROUP BY lang""")
def pretoken_counts(spark, sf_dir):
    """T4: pre-tokens (word runs and single punctuation marks) per language."""
    d = table(spark, sf_dir, "documents")
    return d.groupBy("lang").agg(F.sum(F.size(tx.pretokenize("text"))).cast("long").alias("pretokens"),
                                 F.count(F.lit(1)).alias("docs"))


@register("byte_level_pieces")
def byte_level_pieces(spark, sf_dir):
    """T5: byte-level pre-tokenisation keeping spaces (leading space -> U+0120, newline -> U+010A)."""
    d = table(spark, sf_dir, "documents")
    pieces = d.select("lang", F.explode(tx.pretokenize_spaces("text")).alias("piece"))
    return pieces.groupBy("lang").agg(F.count(F.lit(1)).alias("pieces"),
                                      F.count_if(F.col("piece").startswith("Ġ")).alias("space_led"),
                                      F.count_if(F.col("piece").contains("Ċ")).alias("with_newline"))


@register("normalized_docs", """
SELECT doc_id, md5(lower(strip_accents(text))) AS normalized_md5 FROM documents""")
def normalized_docs(spark, sf_dir):
    """NFD, accents stripped, lower-cased."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(tx.normalize("text")).alias("normalized_md5"))


@register("page_names", """
SELECT page_id,
       CASE WHEN regexp_matches(url, '^https?://') THEN url ELSE 'https://' || url END AS full_url,
       coalesce(nullif(substr(replace(trim(regexp_replace(
           CASE WHEN trim(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') <> ''
                THEN replace(trim(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), '/', '_')
                ELSE replace(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)', 1), '.', '_') END,
           '[<>:"/\\\\|?*\\n\\r\\t]', '_', 'g'), ' \t\n\r\x0b\x0c'), '', ''), 1, 100), ''), 'untitled') AS file_name,
       coalesce(nullif(substr(replace(trim(regexp_replace(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1),
           '[<>:"/\\\\|?*\\n\\r\\t]', '', 'g'), ' \t\n\r\x0b\x0c'), ' ', '_'), 1, 100), ''), 'page_' || CAST(page_id AS VARCHAR)) AS title_name
FROM pages""")
def page_names(spark, sf_dir):
    """URL completion, file name from the URL, safe name from the raw title."""
    p = table(spark, sf_dir, "pages")
    raw_title = F.regexp_extract("html", r"(?s)<title[^>]*>(.*?)</title>", 1)
    return p.select(
        "page_id",
        tx.complete_url("url").alias("full_url"),
        tx.name_from_url("url").alias("file_name"),
        tx.safe_name(raw_title, F.concat(F.lit("page_"), F.col("page_id").cast("string"))).alias("title_name"),
    )


@register("url_query_pairs", """
WITH q AS (SELECT page_id, regexp_extract(url, '\\?([^#]*)', 1) AS query FROM pages),
p AS (SELECT page_id, trim(unnest(string_split(query, '&'))) AS piece FROM q WHERE query <> '')
SELECT page_id, trim(split_part(piece, '=', 1)) AS key, trim(substr(piece, position('=' IN piece) + 1)) AS value
FROM p WHERE contains(piece, '=')""")
def url_query_pairs(spark, sf_dir):
    """key=value string to rows (cookie rule: pieces without '=' skipped, first '=' splits)."""
    p = table(spark, sf_dir, "pages")
    query = F.regexp_extract("url", r"\?([^#]*)", 1)
    pairs = p.select("page_id", F.explode(tx.kv_pairs(F.nullif(query, F.lit("")), "&", "=")).alias("kv"))
    return pairs.select("page_id", "kv.key", "kv.value")


PROPS_SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("category", T.StringType())])


@register("event_props_json", """
SELECT event_id,
       coalesce(TRY_CAST(json_extract(props, '$.k') AS BIGINT), -1) AS k,
       coalesce(json_extract_string(props, '$.category'), 'general') AS category,
       coalesce(TRY_CAST(json_extract(regexp_extract('Result: ' || props || ' done', '\\{[^{}]*\\}'), '$.k') AS BIGINT), -1) AS k_embedded
FROM events""")
def event_props_json(spark, sf_dir):
    """JSON field extraction with defaults, directly and from JSON embedded in free text."""
    ev = table(spark, sf_dir, "events")
    defaults = {"k": -1, "category": "general"}
    direct = tx.first_json("props", PROPS_SCHEMA, defaults)
    embedded = tx.first_json(F.concat(F.lit("Result: "), F.col("props"), F.lit(" done")), PROPS_SCHEMA, defaults)
    return ev.select("event_id", direct["k"].alias("k"), direct["category"].alias("category"),
                     embedded["k"].alias("k_embedded"))


@register("embedding_argmax", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax,
       round(CAST(embedding[1] AS DOUBLE), 6) AS first_value, CAST(len(embedding[2:5]) AS INTEGER) AS slice_len
FROM embeddings""")
def embedding_argmax(spark, sf_dir):
    """Slice, first element and first-maximum index of a vector column."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", tx.argmax("embedding").alias("argmax"),
                    F.round(tx.first_vector("embedding").cast("double"), 6).alias("first_value"),
                    F.size(tx.concat_slices("embedding", 2, 4)).alias("slice_len"))


@register("page_titles_unescaped")
def page_titles_unescaped(spark, sf_dir):
    """HTML character references decoded (raw <title> text of every page)."""
    p = table(spark, sf_dir, "pages")
    raw = F.regexp_extract("html", r"(?s)<title[^>]*>(.*?)</title>", 1)
    return p.select("page_id", raw.alias("raw_title"), tx.html_unescape(raw).alias("title"))
