"""Retrieval queries (V1-V12) over embeddings, documents, benchmark and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.functions.text import word_count
from corpusprep.operators import retrieval as rv
from corpusprep.plans.corpus import NWORDS_SQL, WORDS_SQL, conversation_issues_frame
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


CENTROIDS_SQL = """
c AS (SELECT label, list(v ORDER BY pos) AS q FROM (
        SELECT label, pos, avg(CAST(x AS DOUBLE)) AS v FROM (
          SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
        GROUP BY label, pos) GROUP BY label)"""


def _knn_sql(score_expr: str, order: str) -> str:
    return f"""
WITH {CENTROIDS_SQL},
s AS (SELECT c.label, e.vec_id, {score_expr} AS score FROM c, embeddings e),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score {order}, vec_id) AS rank FROM s)
SELECT label, vec_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5"""


DOT = "list_dot_product(CAST(e.embedding AS DOUBLE[]), c.q)"
L2 = "list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) - 2 * list_dot_product(CAST(e.embedding AS DOUBLE[]), c.q) + list_dot_product(c.q, c.q)"
COS = "list_dot_product(CAST(e.embedding AS DOUBLE[]), c.q) / (sqrt(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[]))) * sqrt(list_dot_product(c.q, c.q)))"


def _knn(spark, sf_dir, metric):
    emb = table(spark, sf_dir, "embeddings")
    q = rv.centroids(emb, "label", "embedding", "query_vec")
    top = rv.top_k_vectors(q, emb, 5, metric, q_id="label", q_vec="query_vec", d_id="vec_id", d_vec="embedding")
    return top.select("label", "vec_id", F.round("score", 6).alias("score"), "rank")


@register("knn_dot_label_centroids", _knn_sql(DOT, "DESC"))
def knn_dot_label_centroids(spark, sf_dir):
    """V1 (J7 as block scoring): five highest dot products per label centroid."""
    return _knn(spark, sf_dir, "dot")


@register("knn_l2_label_centroids", _knn_sql(L2, "ASC"))
def knn_l2_label_centroids(spark, sf_dir):
    """V2: five nearest by squared L2 distance per label centroid."""
    return _knn(spark, sf_dir, "l2")


@register("knn_cosine_label_centroids", _knn_sql(COS, "DESC"))
def knn_cosine_label_centroids(spark, sf_dir):
    """V3: five highest cosine similarities per label centroid."""
    return _knn(spark, sf_dir, "cosine")


def bm25_sql(queries_sql: str, docs_sql: str, k: int, p: str = "", k1: float = 1.5, b: float = 0.75,
             eps: float = 0.25) -> str:
    """DuckDB twin of ``retrieval.bm25``: CTEs (names prefixed by ``p``) ending in
    ``{p}top(query_id, doc_id, score, rank)``."""
    return f"""
{p}q AS ({queries_sql}), {p}d AS ({docs_sql}),
{p}post AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({WORDS_SQL.format(c='text')}) AS term FROM {p}d) GROUP BY doc_id, term),
{p}lens AS (SELECT doc_id, len({WORDS_SQL.format(c='text')}) AS dl FROM {p}d),
{p}st AS (SELECT CAST(count(*) AS DOUBLE) AS nd, avg(dl) AS avgdl FROM {p}lens),
{p}dfq AS (SELECT term, CAST(count(*) AS DOUBLE) AS n FROM {p}post GROUP BY term),
{p}raw AS (SELECT term, ln(nd - n + 0.5) - ln(n + 0.5) AS idf_raw FROM {p}dfq, {p}st),
{p}mi AS (SELECT avg(idf_raw) AS mean_idf FROM {p}raw),
{p}idf AS (SELECT term, CASE WHEN idf_raw < 0 THEN {eps} * mean_idf ELSE idf_raw END AS idf FROM {p}raw, {p}mi),
{p}qt AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest({WORDS_SQL.format(c='query')}) AS term FROM {p}q) GROUP BY query_id, term),
{p}sc AS (SELECT qt.query_id, post.doc_id,
              round(sum(qtf * idf * tf * {k1 + 1} / (tf + {k1} * ({1 - b} + {b} * dl / avgdl))), 9) AS score
       FROM {p}qt qt JOIN {p}post post ON qt.term = post.term JOIN {p}idf idf ON qt.term = idf.term
            JOIN {p}lens lens ON post.doc_id = lens.doc_id, {p}st
       GROUP BY qt.query_id, post.doc_id),
{p}top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM {p}sc)
        WHERE rank <= {k})"""


@register("bm25_benchmark_docs", "WITH " + bm25_sql("SELECT item_id AS query_id, text AS query FROM benchmark",
                                                    "SELECT doc_id, text FROM documents", 3) + """
SELECT query_id AS item_id, doc_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM top""")
def bm25_benchmark_docs(spark, sf_dir):
    """V5: every benchmark item as a query, top-3 documents by BM25."""
    q = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    top = rv.bm25(q, d, k=3)
    return top.select(F.col("query_id").alias("item_id"), "doc_id", F.round("score", 6).alias("score"), "rank")


@register("bm25_no_match_report", "WITH " + bm25_sql(
    "SELECT item_id AS query_id, translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS query FROM benchmark",
                                                     "SELECT doc_id, text FROM documents", 3) + """
SELECT b.item_id, count(top.doc_id) AS hits,
       CASE WHEN count(top.doc_id) = 0 THEN 'No matching information found.' END AS message
FROM benchmark b LEFT JOIN top ON b.item_id = top.query_id GROUP BY b.item_id""")
def bm25_no_match_report(spark, sf_dir):
    """V5 message path: benchmark items with ASCII letters upper-cased (case-sensitive BM25 rarely
    matches them; ``translate`` maps the same characters in every engine, unlike full Unicode upper)."""
    q = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"),
        F.translate("text", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("query"))
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    top = rv.bm25(q, d, k=3, with_message=True)
    return top.groupBy(F.col("query_id").alias("item_id")).agg(F.count("doc_id").alias("hits"),
                                                                F.max("message").alias("message"))


WORD_CHUNKS_SQL = """
WITH w AS (SELECT doc_id, {words} AS ws FROM documents),
s AS (SELECT doc_id, ws, unnest(range(0, len(ws), {n})) AS st FROM w WHERE len(ws) > 0)
SELECT doc_id, CAST(st / {n} AS INTEGER) AS chunk_id, CAST(len(ws[st + 1:st + {n}]) AS INTEGER) AS n_words,
       md5(array_to_string(ws[st + 1:st + {n}], ' ')) AS chunk_md5 FROM s"""


@register("word_chunks_128", WORD_CHUNKS_SQL.format(words=WORDS_SQL.format(c="text"), n=128))
def word_chunks_128(spark, sf_dir):
    """V6: fixed 128-word chunks of every document (last one short)."""
    ch = rv.fixed_chunks(table(spark, sf_dir, "documents"), "doc_id", "text", 128)
    return ch.select("doc_id", "chunk_id", "n_words", F.md5("chunk").alias("chunk_md5"))


@register("paragraph_chunks_docs", """
WITH p AS (SELECT doc_id, unnest(string_split_regex(text, '\\n\\s*\\n')) AS chunk,
                  generate_subscripts(string_split_regex(text, '\\n\\s*\\n'), 1) - 1 AS para_id FROM documents)
SELECT doc_id, CAST(para_id AS INTEGER) AS para_id, md5(trim(chunk)) AS chunk_md5 FROM p WHERE trim(chunk) <> ''""")
def paragraph_chunks_docs(spark, sf_dir):
    """V7: blank-line paragraphs of every document."""
    ch = rv.paragraph_chunks(table(spark, sf_dir, "documents"), "doc_id", "text")
    return ch.select("doc_id", "para_id", F.md5("chunk").alias("chunk_md5"))


@register("overlap_chunks_64_16", f"""
WITH w AS (SELECT doc_id, {WORDS_SQL.format(c='text')} AS ws FROM documents),
s AS (SELECT doc_id, ws, unnest(range(0, CASE WHEN len(ws) <= 64 THEN 0 ELSE CAST(ceil((len(ws) - 64) / 48) AS BIGINT) * 48 END + 1, 48)) AS st
      FROM w WHERE len(ws) > 0)
SELECT doc_id, CAST(st / 48 AS INTEGER) AS chunk_id, CAST(len(ws[st + 1:st + 64]) AS INTEGER) AS n_words,
       md5(array_to_string(ws[st + 1:st + 64], ' ')) AS chunk_md5 FROM s""")
def overlap_chunks_64_16(spark, sf_dir):
    """V8: 64-word windows overlapping by 16 words."""
    ch = rv.overlap_chunks(table(spark, sf_dir, "documents"), "doc_id", "text", 64, 16)
    return ch.select("doc_id", "chunk_id", "n_words", F.md5("chunk").alias("chunk_md5"))


@register("benchmark_context", "WITH " + bm25_sql("SELECT item_id AS query_id, text AS query FROM benchmark",
                                                  "SELECT doc_id, text FROM documents", 3) + f""",
pieces AS (SELECT top.query_id, top.rank, array_to_string(({WORDS_SQL.format(c='d.text')})[1:30], ' ') AS piece
           FROM top JOIN documents d ON top.doc_id = d.doc_id)
SELECT query_id AS item_id, md5(string_agg(piece, '\n\n' ORDER BY rank)) AS context_md5, CAST(count(*) AS INTEGER) AS pieces
FROM pieces GROUP BY query_id""")
def benchmark_context(spark, sf_dir):
    """Top-3 BM25 documents per benchmark item, each cut to 30 words, joined in rank order."""
    q = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    ctx = rv.build_context(rv.bm25(q, d, k=3), d, "query_id", "doc_id", "text", 30)
    return ctx.select(F.col("query_id").alias("item_id"), F.md5("context").alias("context_md5"), "pieces")


HIER_TITLES = "SELECT doc_id, split_part(text, chr(10), 1) AS text FROM documents"
HIER_CHUNKS = f"""SELECT struct_pack(doc_id := doc_id, chunk_id := CAST(st / 64 AS BIGINT)) AS doc_id, array_to_string(ws[st + 1:st + 64], ' ') AS text
  FROM (SELECT doc_id, ws, unnest(range(0, len(ws), 64)) AS st FROM
        (SELECT doc_id, {WORDS_SQL.format(c='text')} AS ws FROM documents) WHERE len(ws) > 0)"""


@register("hierarchical_search", "WITH " + bm25_sql("SELECT item_id AS query_id, text AS query FROM benchmark", HIER_TITLES, 3, "t_")
          + ", " + bm25_sql("SELECT item_id AS query_id, text AS query FROM benchmark", HIER_CHUNKS, 1 << 40, "c_") + """
SELECT t.query_id AS item_id, t.doc_id.doc_id AS doc_id, t.doc_id.chunk_id AS chunk_id, round(t.score, 6) AS score,
       CAST(row_number() OVER (PARTITION BY t.query_id ORDER BY t.score DESC, t.doc_id) AS INTEGER) AS rank
FROM c_sc t JOIN t_top h ON t.query_id = h.query_id AND t.doc_id.doc_id = h.doc_id
QUALIFY row_number() OVER (PARTITION BY t.query_id ORDER BY t.score DESC, t.doc_id) <= 2""")
def hierarchical_search(spark, sf_dir):
    """BM25 over document titles (first line) picks 3 documents per query; then BM25 over the
    64-word chunks of the whole corpus, restricted to those documents (semi join), keeps 2 chunks."""
    q = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    docs = table(spark, sf_dir, "documents")
    titles = docs.select("doc_id", F.split("text", "\n").getItem(0).alias("text"))
    picked = rv.bm25(q, titles, k=3).select("query_id", F.col("doc_id").alias("parent"))
    chunks = rv.fixed_chunks(docs, "doc_id", "text", 64).select(
        F.struct("doc_id", F.col("chunk_id").cast("long").alias("chunk_id")).alias("doc_id"), F.col("doc_id").alias("parent"),
        F.col("chunk").alias("text"))
    top = rv.hierarchical(q, picked, chunks, k=2)
    return top.select(F.col("query_id").alias("item_id"), "doc_id.doc_id", "doc_id.chunk_id",
                      F.round("score", 6).alias("score"), "rank")


@register("issue_comment_search", "WITH " + bm25_sql(
    "SELECT item_id AS query_id, text AS query FROM benchmark",
    """SELECT struct_pack(conv_id := conv_id, turn := turn) AS doc_id, text FROM conversations
       WHERE turn >= 2 AND conv_id NOT IN (SELECT conv_id FROM conversations WHERE role = 'system')
       AND """ + NWORDS_SQL.format(c="text") + " > 15", 5) + """
SELECT query_id AS item_id, doc_id.conv_id AS conv_id, doc_id.turn AS turn, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM top""")
def issue_comment_search(spark, sf_dir):
    """Issue shaping (compound filter, comment rows, length filter) then top-5 lexical search
    of the kept comments for every benchmark item."""
    comments = conversation_issues_frame(spark, sf_dir).select(
        F.struct("conv_id", "turn").alias("doc_id"), F.col("comment").alias("text"))
    q = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    top = rv.bm25(q, comments, k=5)
    return top.select(F.col("query_id").alias("item_id"), "doc_id.conv_id", "doc_id.turn",
                      F.round("score", 6).alias("score"), "rank")


@register("approx_knn_lsh")
def approx_knn_lsh(spark, sf_dir):
    """V4: bucketed random-projection index over all embeddings, queried with every label centroid."""
    emb = table(spark, sf_dir, "embeddings")
    model, hashed = rv.build_lsh(emb, "embedding", bucket_length=0.5, tables=4)
    q = rv.centroids(emb, "label", "embedding", "query_vec")
    top = rv.top_k_approx(q, model, hashed, 5, q_id="label", q_vec="query_vec")
    return top.select("label", "vec_id", F.round("score", 6).alias("score"), "rank")


@register("two_stage_vectors")
def two_stage_vectors(spark, sf_dir):
    """V9: approximate coarse 50 per centroid, exact dot re-score, keep 5."""
    emb = table(spark, sf_dir, "embeddings")
    q = rv.centroids(emb, "label", "embedding", "query_vec")
    top = rv.two_stage(q, emb, coarse=50, k=5, q_id="label")
    return top.select("label", "vec_id", F.round("score", 6).alias("score"), "rank")


# Share of the inverted lists read for each query.
PROBED = 0.75


@register("vector_index_search")
def vector_index_search(spark, sf_dir):
    """V4 + S11: inverted lists around trained centroids, saved once and searched twice: every label centroid
    against all embeddings, then the rows whose id is divisible by 50 (shown with their label as null)."""
    from corpusprep.streaming.streams import checkpoint_path
    emb = table(spark, sf_dir, "embeddings")
    path = checkpoint_path(spark, "vector-index")
    rv.save_vector_index(emb, path)
    labels = rv.centroids(emb, "label", "embedding", "query_vec").select(F.col("label").cast("long").alias("query_id"), "query_vec")
    rows = emb.where(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    found = [rv.search_vector_index(q, path, 5, PROBED).select(F.lit(kind).alias("kind"), "query_id", "vec_id", F.round("score", 6).alias("score"), "rank")
             for kind, q in (("label", labels), ("row", rows))]
    return found[0].unionByName(found[1])


@register("bm25_indexed_search", SQL["bm25_benchmark_docs"])
def bm25_indexed_search(spark, sf_dir):
    """V5 with the index built once and persisted (postings bucketed by term hash) in the shared
    checkpoint area, then searched: only the query terms' buckets are read."""
    from corpusprep.streaming.streams import checkpoint_path
    path = checkpoint_path(spark, "bm25-index")
    rv.save_bm25_index(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    q = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    top = rv.bm25_from_index(q, path, k=3)
    return top.select(F.col("query_id").alias("item_id"), "doc_id", F.round("score", 6).alias("score"), "rank")
