from pyspark.sql import functions as F

from corpusprep.operators import sequences as sq


def test_pair_template(spark):
    df = spark.createDataFrame([(list(range(1, 7)), list(range(11, 17)))], "a array<int>, b array<int>")
    r = df.select(sq.pair_template("a", "b").alias("t")).first()["t"]
    assert len(r["input_ids"]) == 15
    assert r["token_type_ids"] == [0] * 8 + [1] * 7
    assert r["sequence_ids"][0] is None and r["sequence_ids"][1] == 0 and r["sequence_ids"][-2] == 1


def test_overflow_128_45(spark):
    df = spark.createDataFrame([(1, list(range(1000, 1169)))], "k long, ids array<int>")
    ch = sq.overflow_chunks(df, "k", "ids", 128).orderBy("chunk_id").collect()
    assert [len(r["input_ids"]) for r in ch] == [128, 45]
    assert all(r["input_ids"][0] == sq.CLS_ID and r["input_ids"][-1] == sq.SEP_ID for r in ch)
    assert sum(len(r["input_ids"]) - 2 for r in ch) == 169


def test_full_chunks_drop_tail(spark):
    df = spark.createDataFrame([(1, list(range(10)))], "k long, ids array<int>")
    ch = sq.full_chunks(df, "k", "ids", 4).collect()
    assert sorted(r["input_ids"] for r in ch) == [[0, 1, 2, 3], [4, 5, 6, 7]]


def test_sliding_windows_overlap(spark):
    df = spark.createDataFrame([(1, [7, 8], list(range(100, 130)))], "k long, q array<int>, c array<int>")
    w = sq.sliding_windows(df, "k", "q", "c", n=15, stride=4).orderBy("window_id").collect()
    payload = 15 - 3 - 2
    ctx = [r["input_ids"][4:-1] for r in w]
    for a, b in zip(ctx, ctx[1:]):
        assert a[-4:] == b[:4]  # overlap of exactly `stride`
    assert ctx[-1][-1] == 129 and all(len(c) <= payload for c in ctx)
    assert all(r["input_ids"][:4] == [sq.CLS_ID, 7, 8, sq.SEP_ID] for r in w)


def test_pack(spark):
    rows = [(i, list(range(i * 10, i * 10 + 7))) for i in range(10)]
    df = spark.createDataFrame(rows, "k long, ids array<int>")
    p = sq.pack(df, "k", "ids", 8, group=5).collect()
    flat = {}
    for r in p:
        assert len(r["input_ids"]) == 8 and r["labels"] == r["input_ids"]
        flat.setdefault(r["pack_group"], []).append((r["chunk"], r["input_ids"]))
    g0 = [x for _, ids in sorted(flat[0]) for x in ids]
    assert g0 == [x for i in range(5) for x in range(i * 10, i * 10 + 7)][:32]


def test_padding(spark):
    df = spark.createDataFrame([(1, 0, [5, 6, 7]), (2, 0, [5]), (3, 1, [9, 9])], "k long, b long, ids array<int>")
    out = {r["k"]: r for r in sq.pad_batch(df, "b", {"ids": 0}).collect()}
    assert out[2]["ids"] == [5, 0, 0] and out[2]["attention_mask"] == [1, 0, 0]
    assert out[3]["ids"] == [9, 9]
    r = df.select(sq.pad_labels("ids", 4).alias("l")).where(F.col("k") == 2).first()
    assert r["l"] == [5, -100, -100, -100]


def test_masking_invariants(spark):
    ids = [sq.CLS_ID] + list(range(2000, 2200)) + [sq.SEP_ID]
    df = spark.createDataFrame([(k, ids) for k in range(20)], "k long, ids array<int>")
    m = df.select("ids", sq.mask_tokens("ids", F.col("k"), seed=1).alias("m")).collect()
    picked = total = 0
    for r in m:
        for orig, new, lab in zip(r["ids"], r["m"]["input_ids"], r["m"]["labels"]):
            total += 1
            if lab == -100:
                assert new == orig
            else:
                picked += 1
                assert lab == orig and orig not in (sq.CLS_ID, sq.SEP_ID)
    assert 0.10 < picked / total < 0.20


def test_whole_word_masking(spark):
    df = spark.createDataFrame([(1, [1, 2, 3, 4, 5, 6], [None, 0, 0, 1, 2, None])], "k long, ids array<int>, w array<int>")
    runs = df.select(sq.word_runs("w").alias("r")).first()["r"]
    assert runs == [None, 0, 0, 1, 2, None]
    m = df.select(sq.mask_words("ids", "w", F.col("k"), seed=3, p=1.0).alias("m")).first()["m"]
    assert m["input_ids"] == [1, sq.MASK_ID, sq.MASK_ID, sq.MASK_ID, sq.MASK_ID, 6]
    assert m["labels"] == [-100, 2, 3, 4, 5, -100]


def test_next_token_and_decoder(spark):
    df = spark.createDataFrame([([1, 2, 3, -100],)], "ids array<int>")
    r = df.select(sq.next_token_labels("ids").alias("n"), sq.decoder_inputs("ids", 9).alias("d")).first()
    assert r["n"]["input_ids"] == [1, 2, 3] and r["n"]["labels"] == [2, 3, -100]
    assert r["d"] == [9, 1, 2, 3]


def test_char_token_lookup(spark):
    df = spark.createDataFrame([([(0, 3), (4, 6), (6, 9)], [0, 1, 1])],
                               "o array<struct<start:int,end:int>>, w array<int>")
    r = df.select(sq.char_to_token("o", F.lit(5)).alias("t"), sq.char_to_word("o", "w", F.lit(7)).alias("cw"),
                  sq.word_to_chars("o", "w", F.lit(1)).alias("wc")).first()
    assert r["t"] == 1 and r["cw"] == 1 and (r["wc"]["start"], r["wc"]["end"]) == (4, 9)


def test_word_runs_skip_nulls(spark):
    from corpusprep.operators import sequences as sq
    df = spark.createDataFrame([([None, 0, 0, None, 0, 1, 1, 0, None],), ([],), ([None],)], "w array<int>")
    assert [r[0] for r in df.select(sq.word_runs("w")).collect()] == [[None, 0, 0, None, 0, 1, 1, 2, None], [], [None]]


def test_masking_reaches_every_id(spark):
    from pyspark.sql import functions as F

    from corpusprep.operators import sequences as sq
    df = spark.createDataFrame([(1, list(range(1000, 3000)))], "k long, ids array<int>")
    m = df.select("ids", sq.mask_tokens("ids", F.col("k"), 42).alias("m")).first()
    assert len(m["m"]["input_ids"]) == len(m["m"]["labels"]) == 2000
    picked = [i for i, x in enumerate(m["m"]["labels"]) if x != -100]
    assert 200 < len(picked) < 400 and max(picked) > 1900 and all(m["m"]["labels"][i] == m["ids"][i] for i in picked)
