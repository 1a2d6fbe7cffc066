import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.plans import source_plans
from corpusprep.sources import files
from corpusprep.streaming import streams as st

LOG_SCHEMA = T.StructType([T.StructField("event", T.StringType()), T.StructField("ts", T.DoubleType()),
                           T.StructField("error", T.StringType())])


def write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_event_log_never_fails(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "log")
    write(d, "a.jsonl", '{"event": "start", "ts": 1.5}\n{"event": "end", "ts": 2.0, "error": "x"}\n{"event": broken\n')
    out = files.read_event_log(spark, d, LOG_SCHEMA).orderBy("ts").collect()
    assert [r["event"] for r in out] == ["parse_error", "start", "end"]
    assert out[0]["raw"] == '{"event": broken'


def test_splits_round_trip(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a", "train"), (2, "b", "test"), (3, "c", "train")], "id long, t string, split string")
    p = os.path.join(tmpdir_path, "splits")
    files.save_splits(df, p)
    back = files.load_splits(spark, p)
    assert sorted((r["id"], r["split"]) for r in back.collect()) == [(1, "train"), (2, "test"), (3, "train")]
    files.export_jsonl(df, os.path.join(tmpdir_path, "jsonl"))
    j = files.read_jsonl(spark, os.path.join(tmpdir_path, "jsonl"), "id long, t string")
    assert j.count() == 3


def test_delimited_and_json_field(spark, tmpdir_path):
    write(os.path.join(tmpdir_path, "tsv"), "train.tsv", 'id\ttext\n1\t"multi\nline"\n2\tplain\n')
    df = files.read_delimited(spark, {"train": os.path.join(tmpdir_path, "tsv")}, "\t", "id long, text string", multi_line=True)
    assert sorted((r["id"], r["text"]) for r in df.collect()) == [(1, "multi\nline"), (2, "plain")]
    write(os.path.join(tmpdir_path, "js"), "d.json", '{"version": 1, "data": [{"a": 1}, {"a": 2}]}')
    rows = files.read_json_field(spark, os.path.join(tmpdir_path, "js"), "data", T.StructType([T.StructField("a", T.LongType())]))
    assert sorted(r["a"] for r in rows.collect()) == [1, 2]


def test_archive_and_embeddings(spark, tmpdir_path):
    conv = spark.createDataFrame([(1, 1, "user", "b"), (1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    files.archive_transcripts(conv, os.path.join(tmpdir_path, "arch"))
    lines = [r[0] for r in spark.read.text(os.path.join(tmpdir_path, "arch")).collect() if r[0]]
    assert len(lines) == 2 and '"text":"a"' in lines[0]
    emb = spark.createDataFrame([(1, [0.1, 0.2])], "vec_id long, embedding array<float>")
    files.save_embeddings(emb, os.path.join(tmpdir_path, "emb"))
    assert files.load_embeddings(spark, os.path.join(tmpdir_path, "emb")).count() == 1


def test_stream_event_log_matches_batch(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "slog")
    write(d, "1.jsonl", '{"event": "a", "ts": 1.0}\nnot json\n')
    write(d, "2.jsonl", '{"event": "b", "ts": 2.0}\n')
    sdf = st.stream_event_log(spark, d, LOG_SCHEMA, max_files=1)
    out = os.path.join(tmpdir_path, "out")
    st.run_to_parquet(sdf, out, os.path.join(tmpdir_path, "ckpt"))
    got = sorted(r["event"] for r in spark.read.parquet(out).collect())
    batch = sorted(r["event"] for r in files.read_event_log(spark, d, LOG_SCHEMA).collect())
    assert got == batch == ["a", "b", "parse_error"]
    # a restart with the same checkpoint delivers nothing twice
    st.run_to_parquet(st.stream_event_log(spark, d, LOG_SCHEMA), out, os.path.join(tmpdir_path, "ckpt"))
    assert spark.read.parquet(out).count() == 3


def test_stream_keyword_and_validation(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    spark.createDataFrame([(1, "import numpy"), (2, "hello"), (3, "import pandas")], "id long, content string") \
        .write.parquet(src)
    sdf = spark.readStream.schema("id long, content string").parquet(src)
    out = os.path.join(tmpdir_path, "kw")
    st.run_to_parquet(st.stream_keyword_filter(sdf, "content", ["pandas", "numpy"]), out, os.path.join(tmpdir_path, "c1"))
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 3]
    good, bad = os.path.join(tmpdir_path, "good"), os.path.join(tmpdir_path, "bad")
    q = st.stream_validate(sdf, [("no import", F.col("content").startswith("import"))], good, bad, os.path.join(tmpdir_path, "c2"))
    q.awaitTermination()
    assert spark.read.parquet(good).count() == 2 and spark.read.parquet(bad).first()["errors"] == ["no import"]


def test_export_pages_and_records(spark, tmpdir_path):
    from corpusprep.operators import web
    html = "<html><head><title>T</title></head><body><h1>H</h1><p>P</p><a href='/x'>X</a></body></html>"
    df = web.parse_pages(spark.createDataFrame([(1, "https://e.org", html)], "page_id long, url string, html string"))
    files.export_pages(web.render_text(df), os.path.join(tmpdir_path, "pages"))
    r = spark.read.parquet(os.path.join(tmpdir_path, "pages")).first()
    assert r["file_name"] == "T" and r["html_file"].startswith("<!-- Source: https://e.org -->\n")
    assert "[h1] H" in r["text_file"] and "X -> /x" in r["text_file"]
    files.write_records(spark.createDataFrame([(1, "a")], "id long, t string"), os.path.join(tmpdir_path, "rec"))
    assert spark.read.json(os.path.join(tmpdir_path, "rec")).count() == 1


def test_replayed_batch_is_delivered_once(spark, tmpdir_path):
    from corpusprep.streaming import streams as st
    good, bad = tmpdir_path + "/good", tmpdir_path + "/bad"
    sink = st.validated_batch([("x", F.col("v") > 0)], good, bad)
    batch = spark.createDataFrame([(1,), (-1,), (2,)], "v int")
    sink(batch, 0)
    sink(batch, 0)
    sink(batch, 1)
    assert spark.read.parquet(good).count() + spark.read.parquet(bad).count() == 6


def test_package_runs_from_another_folder(tmpdir_path):
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from corpusprep.session import ship_package
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
ship_package(spark)
sys.path.remove({repo!r})
from corpusprep.operators import web
print("pages", web.parse_pages(spark.createDataFrame([(1, "<p>x</p>")], "page_id int, html string")).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmpdir_path, env=env, capture_output=True, text=True, timeout=300)
    assert "pages 1" in got.stdout, got.stderr[-2000:]


def test_json_documents_hold_a_bounded_share_of_a_group(spark, tmpdir_path):
    import json
    rows = [(i, f"c{i}", 0.5 * i, 7 if i % 10 else 3) for i in range(2000)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "c_custkey long, c_name string, c_acctbal double, c_nationkey int")
    columns = ["c_custkey", "c_name", "c_acctbal"]
    sizes = [len(json.loads(r["value"])["data"]) for r in source_plans.json_documents(df, "c_nationkey", "c_custkey", columns, rows=100).collect()]
    assert sum(sizes) == 2001 and max(sizes) <= 200
    path = os.path.join(tmpdir_path, "documents")
    source_plans.write_json_documents(df, "c_nationkey", "c_custkey", columns, path, rows=100)
    back = files.read_json_field(spark, path, "data", df.select(*columns).schema)
    assert sorted(map(repr, (tuple(r) for r in back.collect()))) == sorted(repr(r[:3]) for r in rows)
