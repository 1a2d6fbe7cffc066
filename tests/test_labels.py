from pyspark.sql import functions as F

from corpusprep.operators import labels as lb


def test_align_rules(spark):
    df = spark.createDataFrame([([3, 0, 7], [None, 0, 1, 1, 2, 2, None])], "l array<int>, w array<int>")
    r = df.select(lb.align_continue("l", "w").alias("c"), lb.align_first("l", "w").alias("f")).first()
    assert r["c"] == [-100, 3, 0, 0, 7, 8, -100]
    assert r["f"] == [-100, 3, 0, -100, 7, -100, -100]


def test_answer_span(spark):
    offs = [None, None, (0, 3), (4, 8), (9, 12), None]
    seq = [None, 0, 1, 1, 1, None]
    df = spark.createDataFrame([(offs, seq)], "o array<struct<start:int,end:int>>, s array<int>")
    inside = df.select(lb.answer_token_span("o", "s", F.lit(4), F.lit(12)).alias("p")).first()["p"]
    assert (inside["start_position"], inside["end_position"]) == (3, 4)
    outside = df.select(lb.answer_token_span("o", "s", F.lit(20), F.lit(25)).alias("p")).first()["p"]
    assert (outside["start_position"], outside["end_position"]) == (0, 0)


def test_side_by_side(spark):
    df = spark.createDataFrame([(["EU", "rejects"], ["B-ORG", "O"])], "w array<string>, l array<string>")
    r = df.select(lb.side_by_side("w", "l").alias("s")).first()["s"]
    assert r == "EU    rejects \nB-ORG O       "


def test_spans_and_groups(spark):
    tags = ["B-PER", "I-PER", "O", "I-LOC", "B-LOC", "I-ORG", "O"]
    df = spark.createDataFrame([(1, ["a", "b", "c", "d", "e", "f", "g"], tags, [0.5, 1.0, 0.2, 0.4, 0.6, 0.3, 0.1])],
                               "k long, tokens array<string>, tags array<string>, scores array<double>")
    spans = sorted((r["type"], r["start"], r["end"]) for r in lb.entity_spans(df, "k", "tags").collect())
    assert spans == [("LOC", 3, 3), ("LOC", 4, 4), ("ORG", 5, 5), ("PER", 0, 1)]
    g = {r["entity_group"] + str(r["start"]): r for r in lb.group_entities(df, "k").collect()}
    assert g["PER0"]["word"] == "a b" and abs(g["PER0"]["score"] - 0.75) < 1e-9
