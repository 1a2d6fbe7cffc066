import hashlib

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusprep.operators import ranking
from corpusprep.sources.tables import table
from tests.conftest import SF0001


def test_global_rank_matches_row_number(spark):
    docs = table(spark, SF0001, "documents").select("doc_id", "n_chars")
    ranked = ranking.global_rank(docs, [F.col("n_chars").desc(), F.col("doc_id")], "rank", partitions=5)
    ref = docs.withColumn("rn", F.row_number().over(Window.orderBy(F.col("n_chars").desc(), "doc_id")))
    got = {r["doc_id"]: r["rank"] for r in ranked.collect()}
    exp = {r["doc_id"]: r["rn"] for r in ref.collect()}
    assert got == exp


def test_split_fraction_exact_and_disjoint(spark):
    docs = table(spark, SF0001, "documents").select("doc_id")
    n = docs.count()
    s = ranking.split_fraction(docs, "doc_id", 0.8, seed=42)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts["train"] == int(n * 0.8) and counts["test"] == n - int(n * 0.8)
    assert s.select("doc_id").distinct().count() == n
    # repeatable for the same seed, different for another seed
    again = ranking.split_fraction(docs, "doc_id", 0.8, seed=42)
    assert sorted(r[0] for r in s.where("split = 'test'").select("doc_id").collect()) == \
        sorted(r[0] for r in again.where("split = 'test'").select("doc_id").collect())


def test_fraction_rule():
    # 138514 rows at 0.8 -> 110811 / 27703 (floor of n * f for train)
    n = 138514
    assert int(n * 0.8) == 110811 and n - int(n * 0.8) == 27703


def test_split_counts(spark):
    docs = table(spark, SF0001, "documents").select("doc_id")
    s = ranking.split_counts(docs, "doc_id", 100, 20, seed=3)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": 100, "test": 20}


def test_batches(spark):
    df = spark.range(3668).withColumnRenamed("id", "k")
    b = ranking.assign_batches(df, "k", 8)
    assert b.select("batch_id").distinct().count() == 459
    assert b.groupBy("batch_id").count().where("count > 8").count() == 0


def test_recent_clamp():
    assert ranking.clamp_recent(0) == 20
    assert ranking.clamp_recent(500) == 200
    assert ranking.clamp_recent(None) == 20
    assert ranking.clamp_recent(5) == 5


def test_top1_and_sample(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 7), ("a", 3, 7), ("b", 4, 1)], "g string, k long, s long")
    top = {r["g"]: r["k"] for r in ranking.top1_per_group(df, "g", "s", "k").collect()}
    assert top == {"a": 2, "b": 4}
    s1 = [r[0] for r in ranking.seeded_sample(df, "k", 2, 9).collect()]
    s2 = [r[0] for r in ranking.seeded_sample(df, "k", 2, 9).collect()]
    assert s1 == s2 and len(s1) == 2


def test_columnar_slice(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    r = ranking.columnar_slice(df, "k", 2).first()
    assert r["k"] == [1, 2] and r["v"] == ["a", "b"]


def _expected_split(spark, n, seed, cut):
    df = spark.range(n).withColumnRenamed("id", "k")
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy(ranking.seeded_key("k", seed), F.col("k"))))
    return {r["k"] for r in ref.where(F.col("rn") <= cut).collect()}


def test_band_split_exact_on_larger_input(spark, monkeypatch):
    n, seed = 60000, 11
    df = spark.range(n).withColumnRenamed("id", "k")
    monkeypatch.setattr(ranking, "CUT_DIGITS", 1)  # several steps to each cut
    s = ranking.split_fraction(df, "k", 0.7, seed=seed)
    got = {r["k"] for r in s.where("split = 'train'").select("k").collect()}
    assert got == _expected_split(spark, n, seed, int(n * 0.7))
    assert s.count() == n


def test_band_split_fallback(spark, monkeypatch):
    n, seed = 3000, 5
    df = spark.range(n).withColumnRenamed("id", "k")
    monkeypatch.setattr(ranking, "CUT_DIGITS", 2)
    s = ranking.split_counts(df, "k", 1000, 500, seed=seed)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": 1000, "test": 500}
    got = {r["k"] for r in s.where("split = 'train'").select("k").collect()}
    assert got == _expected_split(spark, n, seed, 1000)


def test_split_counts_larger_than_table(spark):
    df = spark.range(50).withColumnRenamed("id", "k")
    s = ranking.split_counts(df, "k", 40, 30, seed=1)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": 40, "test": 10}


def test_running_total_matches_window(spark):
    rows = [(g, t, (t * 7 + g) % 5) for g in range(3) for t in range(0, 3000, 3)]
    df = spark.createDataFrame(rows, "g long, t long, v long")
    got = {(r["g"], r["t"]): r["c"] for r in ranking.running_total(df, "g", "t", "v", "c", width=64).collect()}
    w = Window.partitionBy("g").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    exp = {(r["g"], r["t"]): r["c"] for r in df.withColumn("c", F.sum("v").over(w)).collect()}
    assert got == exp


def test_neighbor_values(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 5, "y"), ("a", 9, "z"), ("b", 2, "q")], "g string, t long, v string")
    prev = {(r["g"], r["t"]): r["prev_v"] for r in ranking.neighbor_values(df, "g", "t", ["v"]).collect()}
    assert prev == {("a", 1): None, ("a", 5): "x", ("a", 9): "y", ("b", 2): None}
    nxt = {(r["g"], r["t"]): r["next_v"] for r in ranking.neighbor_values(df, "g", "t", ["v"], 1, "next_").collect()}
    assert nxt == {("a", 1): "y", ("a", 5): "z", ("a", 9): None, ("b", 2): None}


@pytest.mark.parametrize("digits", [1, 4])
def test_cuts_in_repeated_keys_keep_every_row(spark, monkeypatch, digits):
    monkeypatch.setattr(ranking, "CUT_DIGITS", digits)
    keys = [7] * 300 + [None] * 40 + list(range(60)) + [3] * 100
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, n int").repartition(5)
    for cut in (0, 1, 57, 250, 499, 500, 900):
        out = ranking.seeded_cut_labels(df, "k", 42, [cut, cut + 30], ["a", "b"], rest="c").collect()
        sizes = {x: sum(r["split"] == x for r in out) for x in "abc"}
        first = min(cut, 500)
        assert sorted(r["n"] for r in out) == list(range(500))
        assert (sizes["a"], sizes["b"]) == (first, min(cut + 30, 500) - first)
        order = {k: hashlib.md5(f"42:{k}".encode()).hexdigest() if k is not None else "0" * 32 for k in set(keys)}
        ends = [max((order[r["k"]] for r in out if r["split"] == x), default="") for x in "ab"]
        assert all(order[r["k"]] >= ends[0] for r in out if r["split"] != "a")
        assert all(order[r["k"]] >= ends[1] for r in out if r["split"] == "c")


def test_cuts_of_an_empty_table(spark):
    out = ranking.split_fraction(spark.createDataFrame([], "k long"), "k", 0.5)
    assert out.columns == ["k", "split"] and out.count() == 0
