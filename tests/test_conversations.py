from corpusprep.operators import conversations as cv


def test_compaction_fixture(spark):
    rows = []
    for i in range(5):
        rows.append((1, 2 * i, "tool_use", f"u{i}", "bash", "run"))
        rows.append((1, 2 * i + 1, "tool_result", f"u{i}", None, "x" * 200))
    df = spark.createDataFrame(rows, "conv_id long, pos long, type string, tool_use_id string, tool_name string, content string")
    out = {r["pos"]: r for r in cv.compact_tool_results(df).collect()}
    assert out[1]["content"] == "[Previous: used bash]" and out[3]["content"] == "[Previous: used bash]"
    assert out[5]["content"] == "x" * 200 and out[9]["content"] == "x" * 200


def test_preserved_and_unknown(spark):
    rows = [(1, 0, "tool_use", "a", "read_file", "r"), (1, 1, "tool_result", "a", None, "y" * 300),
            (1, 2, "tool_result", "zz", None, "y" * 300)] + \
           [(1, 3 + i, "tool_result", f"k{i}", None, "short") for i in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, pos long, type string, tool_use_id string, tool_name string, content string")
    out = {r["pos"]: r for r in cv.compact_tool_results(df).collect()}
    assert out[1]["content"] == "y" * 300  # read_file preserved
    assert out[2]["content"] == "[Previous: used unknown]"


def test_turns_and_render(spark):
    df = spark.createDataFrame([(1, 0, "system", "S1"), (1, 1, "user", "hi"), (1, 2, "assistant", "a</think>b"),
                                (1, 3, "assistant", "c"), (1, 4, "system", "S2"), (1, 5, "user", "q")],
                               "conv_id long, turn long, role string, text string")
    t = {r["turn"]: (r["turn_no"], r["sub_turn"]) for r in cv.number_turns(df).collect()}
    assert t[2] == (1, 1) and t[3] == (1, 2) and t[5] == (2, None)
    r = cv.render_chat(df).first()["rendered"]
    assert r == cv.BOS + "S1\n\nS2" + cv.USER_MARK + "hi" + cv.ASSISTANT_MARK + "b" + cv.EOS + cv.ASSISTANT_MARK + "c" + cv.EOS + cv.USER_MARK + "q"


def test_budget_and_summary(spark):
    df = spark.createDataFrame([(1, 0, "user", "x" * 40), (2, 0, "user", "y" * 8)], "conv_id long, turn long, role string, text string")
    b = {r["conv_id"]: r for r in cv.token_budget(df, limit=5).collect()}
    assert b[1]["tokens"] == 10 and b[1]["over_limit"] and not b[2]["over_limit"]
    s = spark.createDataFrame([(1, "")], "conv_id long, summary string")
    out = {r["conv_id"]: r["text"] for r in cv.replace_with_summary(df, s, limit=5).collect()}
    assert out[1].endswith(cv.NO_SUMMARY) and out[2] == "y" * 8


def test_transcript_tail_cut(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"message number {t} " * (t + 1)) for t in range(12)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    from pyspark.sql import functions as F
    full = df.groupBy("conv_id").agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))),
                                                           lambda m: F.struct(m["role"].alias("role"), m["text"].alias("content")))).alias("j")) \
        .first()["j"]
    for n in (10, 257, 1000, len(full) - 1, len(full), len(full) + 50):
        r = cv.transcript_tail(df, n=n).first()
        assert r["tail"] == full[-n:] and r["full_chars"] == len(full)
