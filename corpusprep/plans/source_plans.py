"""Source and sink queries (S1-S7, S9-S11): each writes a whole table to the shared checkpoint folder in one
format and returns what is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.operators import web
from corpusprep.sources import files
from corpusprep.sources.tables import table
from corpusprep.streaming.streams import checkpoint_path

QUERIES = {}
SQL = {}


def register(name, sql=None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


SPLIT_SQL = "CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END"


def _split_docs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return docs.withColumn("split", F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train"))


@register("delimited_splits", f"SELECT doc_id, lang, {SPLIT_SQL} AS split, md5(text) AS text_md5 FROM documents")
def delimited_splits(spark, sf_dir):
    """Documents written as one tab-separated folder per split (quoted line breaks) and read back."""
    docs, paths = _split_docs(spark, sf_dir), {}
    for s in ("train", "test"):
        paths[s] = checkpoint_path(spark, f"s1-{s}")
        files.write_delimited(docs.where(F.col("split") == s).drop("split"), paths[s])
    back = files.read_delimited(spark, paths, schema="doc_id long, lang string, text string", multi_line=True)
    return back.select("doc_id", "lang", "split", F.md5("text").alias("text_md5"))


@register("text_lines", """
SELECT line_md5, count(*) AS lines FROM (SELECT md5(unnest(string_split(text, chr(10)))) AS line_md5 FROM documents) GROUP BY line_md5""")
def text_lines(spark, sf_dir):
    """Documents written as plain text and read as one row per line."""
    path = checkpoint_path(spark, "s2-text")
    table(spark, sf_dir, "documents").select(F.col("text").alias("value")).write.text(path)
    return files.read_text(spark, path).groupBy(F.md5("text").alias("line_md5")).agg(F.count(F.lit(1)).alias("lines"))


@register("jsonl_splits", f"SELECT doc_id, {SPLIT_SQL} AS split, md5(text) AS text_md5 FROM documents")
def jsonl_splits(spark, sf_dir):
    """S6 + S3: documents exported as JSON lines, one folder per split, and read per split."""
    path = checkpoint_path(spark, "s6-jsonl")
    files.export_jsonl(_split_docs(spark, sf_dir), path)
    back = files.read_jsonl(spark, {s: f"{path}/split={s}" for s in ("train", "test")}, "doc_id long, lang string, text string")
    return back.select("doc_id", "split", F.md5("text").alias("text_md5"))


# Rows that one JSON document should hold.
DOCUMENT_ROWS = 10_000


def json_documents(df, group, key, columns, rows=None):
    """(group, bucket, value): the rows of a group dealt by their hash into as many documents of about ``rows`` rows
    as the group's count asks for.  Rows that repeat a key and all columns share a document."""
    counts = df.groupBy(F.col(group).alias("__group")).agg(F.ceil(F.count(F.lit(1)) / (rows or DOCUMENT_ROWS)).alias("__buckets"))
    dealt = df.join(F.broadcast(counts), F.col(group).eqNullSafe(F.col("__group")))  # one row per group
    bucket = F.pmod(F.xxhash64(key, *columns), F.col("__buckets")).alias("bucket")
    return dealt.groupBy(group, bucket).agg(
        F.to_json(F.struct(F.lit(1).alias("version"), F.collect_list(F.struct(*columns)).alias("data"))).alias("value"))


def write_json_documents(df, group, key, columns, path, rows=None):
    """One file per document, read as a whole; every task writes the documents of few buckets."""
    json_documents(df, group, key, columns, rows).write.partitionBy(group, "bucket").text(path)


@register("json_field_customers", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_field_customers(spark, sf_dir):
    """Customers as JSON documents of bounded size, as many per nation as its rows need, with the rows under
    one key; read back as rows."""
    path = checkpoint_path(spark, "s4-json")
    write_json_documents(table(spark, sf_dir, "customer"), "c_nationkey", "c_custkey", ["c_custkey", "c_name", "c_acctbal"], path)
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()), T.StructField("c_acctbal", T.DoubleType())])
    return files.read_json_field(spark, path, "data", schema)


@register("columnar_splits", f"""
SELECT split, count(*) AS docs, CAST(sum(length(text)) AS BIGINT) AS chars FROM (SELECT *, {SPLIT_SQL} AS split FROM documents) GROUP BY split""")
def columnar_splits(spark, sf_dir):
    """Documents saved with one folder per split and reloaded."""
    path = checkpoint_path(spark, "s5-splits")
    files.save_splits(_split_docs(spark, sf_dir), path)
    return files.load_splits(spark, path).groupBy("split").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.length("text")).cast("long").alias("chars"))


@register("record_lines", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def record_lines(spark, sf_dir):
    """Orders written as one JSON record per line and read with an explicit schema."""
    path = checkpoint_path(spark, "s7-records")
    files.write_records(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), path)
    return files.read_jsonl(spark, path, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double")


@register("page_files", "SELECT md5('<!-- Source: ' || url || ' -->' || chr(10) || html) AS html_md5, count(*) AS pages FROM pages GROUP BY 1")
def page_files(spark, sf_dir):
    """Pages rendered and exported, the stored HTML files read back."""
    path = checkpoint_path(spark, "s9-pages")
    files.export_pages(web.render_text(web.parse_pages(table(spark, sf_dir, "pages"))), path)
    stored = spark.read.schema("file_name string, html_file string, text_file string").parquet(path)
    return stored.groupBy(F.md5("html_file").alias("html_md5")).agg(F.count_if(F.length("text_file") > 0).alias("pages"))


@register("transcript_archive", "SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations")
def transcript_archive(spark, sf_dir):
    """Conversations archived as JSON lines in order and read back."""
    path = checkpoint_path(spark, "s10-archive")
    files.archive_transcripts(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), path)
    back = files.read_jsonl(spark, path, "conv_id long, turn long, role string, text string")
    return back.select("conv_id", "turn", "role", F.md5("text").alias("text_md5"))


@register("saved_embeddings", """
SELECT vec_id, label, len(embedding) AS dims, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS total FROM embeddings""")
def saved_embeddings(spark, sf_dir):
    """Embeddings saved apart from any index and loaded again."""
    path = checkpoint_path(spark, "s11-embeddings")
    files.save_embeddings(table(spark, sf_dir, "embeddings"), path)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return files.load_embeddings(spark, path).select("vec_id", "label", F.size("embedding").cast("long").alias("dims"), F.round(total, 6).alias("total"))
