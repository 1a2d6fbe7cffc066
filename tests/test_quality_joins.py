from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.operators import joins, quality as qa, shape


def test_validate_and_route(spark):
    df = spark.createDataFrame([("alice", "a@x.org", "secret1", "secret1", 30), ("b", "bad", "x", "y", -1)],
                               "username string, email string, password string, confirm string, age int")
    rules = [("username too short", qa.text_rule("username", min_length=3)),
             ("email invalid", qa.text_rule("email", pattern=r"[^@]+@[^@]+\.[a-z]+")),
             ("passwords differ", qa.equal("password", "confirm")),
             ("age out of range", qa.bounds("age", ge=0, le=150))]
    good, bad = qa.validate(df, rules)
    assert [r["username"] for r in good.collect()] == ["alice"]
    assert bad.first()["errors"] == ["username too short", "email invalid", "passwords differ", "age out of range"]
    a, b = shape.route(df.withColumn("f", F.col("age") > 0), "f")
    assert a.count() == 1 and b.count() == 1


def test_coerce_defaults_unknown(spark):
    df = spark.createDataFrame([("12", " x ", '{"a": 1, "z": 2}'), ("1.5x", None, '{"a": 2}')], "n string, s string, j string")
    c = qa.coerce(df, {"n": "int"}).collect()
    assert c[0]["n"] == 12 and c[1]["n"] is None and c[1]["coerce_errors"] == ["n: not a valid int"]
    d = qa.apply_defaults(df, {"name": {"alias": "s", "default": "anon", "strip": True}}).collect()
    assert [r["name"] for r in d] == ["x", "anon"]
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    f = qa.apply_unknown_policy(df, "j", schema, "forbid").collect()
    assert f[0]["unknown_errors"] == ["z: extra fields not permitted"] and f[1]["unknown_errors"] == []
    al = qa.apply_unknown_policy(df, "j", schema, "allow").collect()
    assert al[0]["extra"] == {"z": "2"}


def test_mask_json_time(spark):
    df = spark.createDataFrame([(1, "pw"), (2, None)], "id long, secret string")
    j = qa.to_json_view(df.withColumn("secret", qa.mask_secret("secret")), exclude=[]).collect()
    assert j[0]["json"] == '{"id":1,"secret":"**********"}' and j[1]["json"] == '{"id":2}'
    t = spark.createDataFrame([("2024-01-02 03:04:05",), ("nope",)], "s string")
    r = t.select(qa.format_time(qa.parse_time("s")).alias("f")).collect()
    assert r[0]["f"] == "2024-01-02 03:04:05" and r[1]["f"] is None


def test_ready_rows_fixture(spark):
    df = spark.createDataFrame([(1, "completed", None, []), (2, "pending", None, [1]), (3, "pending", None, [2]),
                                (4, "pending", "bob", [])], "id long, status string, owner string, blockedBy array<long>")
    assert [r["id"] for r in joins.ready_rows(df).collect()] == [2]


def test_bounded_pairs(spark):
    s = spark.createDataFrame([(1, 0), (1, 5)], "g long, start_index int")
    e = spark.createDataFrame([(1, 0), (1, 3), (1, 9), (1, 40)], "g long, end_index int")
    pairs = sorted((r["start_index"], r["end_index"]) for r in joins.bounded_pairs(s, e, ["g"], 5).collect())
    assert pairs == [(0, 0), (0, 3), (5, 9)]


def test_vocab_diff_lookup_latest(spark):
    old = spark.createDataFrame([("a",), ("b",), ("c",)], "token string")
    new = spark.createDataFrame([("b",), ("c",), ("d",), ("e",)], "token string")
    r = joins.vocab_diff(old, new).first()
    assert (r["kept"], r["replaced"], r["added"]) == (2, 1, 2)
    df = spark.createDataFrame([(1,), (2,)], "k long")
    other = spark.createDataFrame([(1, ["x"])], "k long, c array<string>")
    got = {r["k"]: r["c"] for r in joins.lookup_list(df, other, "k", "c").collect()}
    assert got == {1: ["x"], 2: []}
    log = spark.createDataFrame([(1, 1.0, "a"), (1, 2.0, "b"), (2, 1.0, "c")], "k long, ts double, v string")
    assert {r["k"]: r["v"] for r in joins.latest_per_key(log, "k", "ts").collect()} == {1: "b", 2: "c"}
    ex = joins.explode_list(spark.createDataFrame([(1, []), (2, ["p", "q"])], "k long, c array<string>"), "c")
    assert sorted((r["k"], r["c"]) for r in ex.collect()) == [(1, None), (2, "p"), (2, "q")]


def test_shape_helpers(spark):
    df = spark.createDataFrame([("a b c", None, "x"), (None, "t", "y")], "a string, b string, c string")
    with __import__("pytest").raises(ValueError):
        shape.keep_only(df, ["a", "missing"])
    r = df.select(shape.join_text(["a", "b"]).alias("j"), shape.any_keyword("c", ["y", "q"]).alias("k")).collect()
    assert r[0]["j"] == "a b c \n " and r[1]["k"]
    assert shape.lower_not_null(df, "a").count() == 1
    assert df.select(shape.id_to_label(F.lit(1), ["O", "B"]).alias("l"), shape.label_to_id(F.lit("B"), ["O", "B"]).alias("i")).first() \
        .asDict() == {"l": "B", "i": 1}
    assert df.select(shape.format_bytes(F.lit(2048)).alias("f")).first()["f"] == "2.00 KB"


def test_length_percentiles_stay_within_the_stated_rank_error(spark):
    from corpusprep.operators.shape import length_percentiles
    n, accuracy = 40000, 100
    df = spark.range(n).selectExpr("id % 2 AS g", "(id * 7919) % 40000 AS v") \
        .unionByName(spark.createDataFrame([(5, None), (5, None)], "g long, v long"))
    got = {r["g"]: r for r in length_percentiles(df, "v", {"p50": 0.5, "p95": 0.95, "p99": 0.99}, ["g"], accuracy).collect()}
    values = {g: sorted((i * 7919) % 40000 for i in range(g, n, 2)) for g in (0, 1)}
    for g, v in values.items():
        assert got[g]["rows"] == len(v)
        for name, share in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
            assert abs(v.index(got[g][name]) + 1 - share * len(v)) <= len(v) / accuracy + 1
    assert got[5]["rows"] == 0 and got[5]["p50"] is None
