import math

from pyspark.sql import functions as F

from corpusprep.operators import metrics as mt


def test_accuracy_f1_and_batches(spark):
    df = spark.createDataFrame([(1, 1, 0), (0, 1, 0), (1, 1, 1), (0, 0, 1)], "p int, r int, b int")
    r = mt.accuracy_f1(df, "p", "r").first()
    assert r["accuracy"] == 0.75 and abs(r["f1"] - 0.8) < 1e-9
    r2 = mt.accumulate(df, "p", "r", "b").first()
    assert (r2["accuracy"], r2["f1"]) == (r["accuracy"], r["f1"])


def test_entity_scores(spark):
    names = ["O", "B-PER", "I-PER", "B-ORG", "I-ORG", "B-LOC", "I-LOC", "B-MISC", "I-MISC"]
    ref = [3, 0, 7, 0, 0, 0, 7, 0, 0]
    pred = [3, 0, 0, 0, 0, 0, 7, 0, 0]
    df = spark.createDataFrame([(1, pred, ref)], "k long, p array<int>, r array<int>")
    kept = df.withColumn("z", mt.drop_ignored("p", "r", names)).select("k", "z.pred", "z.ref")
    out = {r["type"]: r for r in mt.entity_scores(kept, "k", "pred", "ref").collect()}
    o = out["overall"]
    assert o["precision"] == 1.0 and abs(o["recall"] - 2 / 3) < 1e-6 and abs(o["f1"] - 0.8) < 1e-6
    assert abs(o["accuracy"] - 8 / 9) < 1e-6


def test_drop_ignored(spark):
    df = spark.createDataFrame([([1, 2, 3], [-100, 2, -100])], "p array<int>, r array<int>")
    r = df.select(mt.drop_ignored("p", "r").alias("z")).first()["z"]
    assert r["pred"] == [2] and r["ref"] == [2]


def test_perplexity_and_weighted_loss(spark):
    df = spark.createDataFrame([(math.log(4),), (math.log(4),)], "loss double")
    assert abs(mt.perplexity(df, "loss").first()["perplexity"] - 4.0) < 1e-9
    df2 = spark.createDataFrame([([1.0, 1.0], [5, 6]), ([2.0, 2.0], [7, 9])], "l array<double>, ids array<int>")
    assert abs(mt.weighted_loss(df2, "l", "ids", [7], alpha=1.0).first()["weighted_loss"] - 2.5) < 1e-9
    big = spark.createDataFrame([(1000.0,)], "loss double")
    assert mt.perplexity(big, "loss").first()["perplexity"] == float("inf")


def test_squad(spark):
    pred = spark.createDataFrame([(1, "The Cat sat."), (2, "a dog")], "id long, prediction_text string")
    ref = spark.createDataFrame([(1, ["cat sat", "x"]), (2, ["big dog"])], "id long, answers array<string>")
    r = mt.squad_scores(pred, ref).first()
    assert r["exact_match"] == 50.0
    assert abs(r["f1"] - 100 * (1.0 + 2 / 3) / 2) < 1e-3


def test_bleu_clipping(spark):
    df = spark.createDataFrame([(1, "This This This This", ["This is a test", "Another one"])],
                               "k long, h string, refs array<string>")
    r = mt.corpus_bleu(df, "k", "h", "refs").first()
    assert abs(r["p1"] - 25.0) < 1e-9
    same = spark.createDataFrame([(1, "a b c d e", ["a b c d e"])], "k long, h string, refs array<string>")
    assert abs(mt.corpus_bleu(same, "k", "h", "refs").first()["bleu"] - 100.0) < 1e-6


def test_rouge(spark):
    df = spark.createDataFrame([(1, "the cat sat", "the cat sat down")], "k long, p string, r string")
    r = mt.rouge(df, "k", "p", "r").first()
    assert abs(r["rouge1_recall"] - 0.75) < 1e-6 and abs(r["rougeL"] - 2 * 1 * 0.75 / 1.75) < 1e-6


def test_top_candidates(spark):
    df = spark.createDataFrame([(1, [0.0, 2.0, 1.0])], "k long, logits array<double>")
    r = mt.top_candidates(df, "k", "logits", 2).orderBy("rank").collect()
    assert [x["token_id"] for x in r] == [1, 2]
    assert abs(sum(math.exp(v) for v in [0, 2, 1]) * r[0]["prob"] - math.exp(2)) < 1e-9


def test_best_answer(spark):
    offs = [None, (0, 5), (6, 11), (12, 17), None]
    feats = spark.createDataFrame([(1, 0, offs, [0.0, 1.0, 5.0, 0.0, 9.0], [0.0, 0.0, 1.0, 4.0, 9.0])],
                                  "example_id long, feature_id long, offset_mapping array<struct<start:int,end:int>>, "
                                  "start_logits array<double>, end_logits array<double>")
    ex = spark.createDataFrame([(1, "hello world again"), (2, "none")], "example_id long, context string")
    out = {r["example_id"]: r["prediction_text"] for r in mt.best_answers(feats, ex, n_best=20, max_len=30).collect()}
    assert out == {1: "world again", 2: ""}


def test_clean_labels(spark):
    df = spark.createDataFrame([([5, -100],)], "l array<int>")
    assert df.select(mt.clean_labels("l").alias("c")).first()["c"] == [5, 0]


def test_lcs_against_the_table():
    import random
    rng = random.Random(1)
    for _ in range(50):
        x = [rng.choice("abc") for _ in range(rng.randint(0, 30))]
        y = [rng.choice("abcd") for _ in range(rng.randint(0, 30))]
        row = [0] * (len(y) + 1)
        for a in x:
            new = [0]
            for j, b in enumerate(y):
                new.append(row[j] + 1 if a == b else max(row[j + 1], new[j]))
            row = new
        assert mt.lcs_length(x, y) == row[-1]
