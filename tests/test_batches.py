import os
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusprep.functions.batches import parts
from corpusprep.operators import sequences as sq
from corpusprep.operators import vocab as vb
from corpusprep.operators import web
from corpusprep.plans import label_plans, streaming_plans


def test_parts_are_bounded_and_whole():
    sizes = np.array([3, 0, 9, 2, 2, 2, 0, 50, 1])
    batch = pa.RecordBatch.from_arrays([pa.array(range(9))], names=["i"])
    got = [p.column(0).to_pylist() for p in parts(batch, sizes, 6, 3)]
    assert [i for p in got for i in p] == list(range(9))
    assert all(len(p) <= 3 and (sum(sizes[i] for i in p) <= 6 or len(p) == 1) for p in got)
    assert list(parts(batch.slice(0, 0), sizes[:0])) == []


def test_encoding_holds_a_part_of_its_rows(spark):
    """One batch of 3 million pieces; the task grew by some 300 bytes for each."""
    def held():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")

    def cut(word, model):  # characters; a probe word gives the memory of its task
        return [str(held())] if word.startswith("probe") else list(word)

    long = "".join(chr(97 + i % 26) for i in range(1000))
    df = spark.range(0, 3002, 1, 1).select("id", F.when(F.col("id") == 0, "probea").when(F.col("id") == 3001, "probeb").otherwise(long).alias("t"))
    enc = vb._encode_partitions(df, "id", "t", {}, cut)
    n, ends = enc.select(F.sum(F.size("tokens")), F.collect_list(F.when(F.size("tokens") == 1, F.struct("id", "tokens")))).first()
    first, last = (int(r["tokens"][0]) for r in sorted(ends))
    assert n == 3_000_002 and last - first < 300 << 20


def test_encoding_of_odd_texts(spark):
    v = spark.createDataFrame([("a", 0), ("##b", 1), ("é", 2)], "token string, id int")
    df = spark.createDataFrame([(1, "ab  é zz ab"), (2, None), (3, ""), (None, "a")], "k long, t string")
    rows = {r["k"]: r for r in vb.encode_wordpiece(df, "t", "k", v).collect()}
    assert rows[1]["tokens"] == ["a", "##b", "é", "[UNK]", "a", "##b"] and rows[1]["word_ids"] == [0, 0, 1, 2, 3, 3]
    assert [tuple(o) for o in rows[1]["offsets"]] == [(0, 1), (1, 2), (4, 5), (6, 8), (9, 10), (10, 11)]
    assert rows[2]["tokens"] == rows[3]["tokens"] == [] and rows[2]["offsets"] == [] and rows[None]["tokens"] == ["a"]


def test_word_offsets_are_plain_integers(spark):
    """spans of a batch's words took some 250 bytes each as dicts."""
    texts = pa.array(["a bc é", None, ""] + ["ab cd " * 500] * 1000)
    tracemalloc.start()
    try:
        got = label_plans.word_offsets.func(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got.slice(0, 3).to_pylist() == [[{"start": 0, "end": 1}, {"start": 2, "end": 4}, {"start": 5, "end": 6}], [], []]
    assert len(got.flatten()) == 1_000_003 and peak < 60 << 20
    df = spark.createDataFrame([("x yz",), (None,)], "t string")
    assert [[tuple(o) for o in r[0]] for r in df.select(label_plans.word_offsets("t")).collect()] == [[(0, 1), (2, 4)], []]


def test_word_runs_of_odd_rows(spark):
    df = spark.createDataFrame([([5, 5, None, 5, 6],), ([5],), (None,), ([],), ([None, 7, 8, 8],)], "w array<int>").coalesce(1)
    assert [r[0] for r in df.select(sq.word_runs("w")).collect()] == [[0, 0, None, 0, 1], [0], [], [], [None, 0, 1, 1]]


def test_lookup_goes_through_a_batch_in_parts(spark, monkeypatch):
    """F23, F25, F28"""
    seen = []
    monkeypatch.setattr(vb, "LOOKED_UP", 3)
    monkeypatch.setattr(vb, "parts", lambda *a: seen.append(a[2]) or parts(*a), raising=True)
    v = spark.createDataFrame([("a", 7), ("b", 8)], "token string, id int")
    df = spark.createDataFrame([(1, ["a", "b"]), (2, None), (3, ["z", "a", "b", "a"]), (4, [])], "k long, tokens array<string>").coalesce(1)
    assert {r["k"]: r["ids"] for r in vb.to_ids(df, v, "tokens", "ids").collect()} == {1: [7, 8], 2: None, 3: [100, 7, 8, 7], 4: []}


def test_pages_are_parsed_in_parts(spark):
    """The parts of a batch's pages as Python objects."""
    df = spark.range(0, 6000, 1, 1).select(F.col("id").alias("page_id"), F.concat(
        F.lit("<title>"), F.col("id").cast("string"), F.lit("</title>"), F.expr("repeat('<p>x</p><a href=\"u\">y</a>', 100)")).alias("html"))
    got = web.parse_pages(df.unionByName(spark.createDataFrame([(-1, None)], "page_id long, html string"))) \
        .select("page_id", "parsed.title", F.size("parsed.links").alias("n"), F.col("parsed").isNull().alias("none")).collect()
    assert len(got) == 6001 and all(r["none"] if r["page_id"] < 0 else r["title"] == str(r["page_id"]) and r["n"] == 100 for r in got)


def test_streams_read_a_table_that_is_a_folder(spark, tmpdir_path):
    """a table of several files lies in a folder of the table's name."""
    rows = [(1, "en", "the cat"), (2, "en", "dog"), (3, "de", "hund und"), (4, "de", None)]
    for kind in ("folder", "file"):
        at = f"{tmpdir_path}/{kind}"
        df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
        if kind == "folder":
            df.repartition(3).write.parquet(f"{at}/documents.parquet")
            df.limit(0).write.parquet(f"{at}/documents.parquet.old")
        else:
            os.makedirs(at)
            df.toPandas().to_parquet(f"{at}/documents.parquet")
        assert sorted(r["doc_id"] for r in streaming_plans.stream_keyword_docs(spark, at).collect()) == [1, 3]
        r = streaming_plans.stream_keep_ratio_docs(spark, at).first()
        assert (r["kept"], r["total"], r["kept_pct"]) == (2, 4, 50.0)
