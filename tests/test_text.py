from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions import text as tx


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


def test_word_count_and_truncate(spark):
    assert one(spark, tx.word_count, "  a b\tc\n d  ") == 4
    assert one(spark, tx.word_count, "") == 0
    assert one(spark, lambda c: tx.truncate_words(c, 2), "a  b c") == "a b"


def test_estimates(spark):
    assert one(spark, tx.estimate_tokens, "0123456789") == 2
    assert abs(one(spark, tx.estimate_tokens_by_script, "ab中文") - (0.6 + 1.2)) < 1e-9


def test_safe_names(spark):
    assert one(spark, lambda c: tx.safe_name(c, "x"), "a<b>: c/d") == "ab_cd"
    assert one(spark, tx.safe_name_replace, "a<b>: c/d") == "a_b__ c_d"
    assert one(spark, lambda c: tx.safe_name(c, "page_1"), " <> ") == "page_1"
    assert one(spark, tx.safe_name_replace, "") == "untitled"


def test_urls(spark):
    assert one(spark, tx.complete_url, "example.com/a") == "https://example.com/a"
    assert one(spark, tx.complete_url, "http://x.y") == "http://x.y"
    assert one(spark, tx.name_from_url, "https://a.b.com/x/y/") == "x_y"
    assert one(spark, tx.name_from_url, "https://a.b.com/") == "a_b_com"


def test_cookie_pairs(spark):
    r = one(spark, tx.kv_pairs, "a=1; b=x=y; z")
    assert [(x["key"], x["value"]) for x in r] == [("a", "1"), ("b", "x=y")]


def test_after_marker_and_strip(spark):
    assert one(spark, tx.after_marker, "think</think>answer") == "answer"
    assert one(spark, tx.after_marker, "no marker") == "no marker"
    assert one(spark, tx.strip, "\n x \t") == "x"


def test_first_json(spark):
    schema = T.StructType([T.StructField("is_spam", T.BooleanType()), T.StructField("category", T.StringType())])
    defaults = {"is_spam": False, "category": "general"}
    r = one(spark, lambda c: tx.first_json(c, schema, defaults), 'Sure: {"is_spam": true} ok')
    assert r["is_spam"] is True and r["category"] == "general"
    r = one(spark, lambda c: tx.first_json(c, schema, defaults), "nothing here")
    assert r["is_spam"] is False and r["category"] == "general"
    r = one(spark, lambda c: tx.first_json(c, schema, defaults), '{"is_spam": false, "category": "work"}')
    assert r["is_spam"] is False and r["category"] == "work"


def test_pretokenize_and_unicode(spark):
    assert one(spark, tx.pretokenize, "Héllo, world!") == ["Héllo", ",", "world", "!"]
    assert one(spark, tx.pretokenize_spaces, "Hi there\nyou") == ["Hi", "Ġthere", "Ċ", "you"]
    assert one(spark, tx.normalize, "Héllò") == "hello"
    assert one(spark, tx.html_unescape, "a &amp; b &#169;") == "a & b ©"


def test_arrays(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, 2.0],)], "v array<double>")
    r = df.select(tx.argmax("v").alias("a"), tx.first_vector("v").alias("f"), tx.concat_slices("v", 2, 2).alias("s")).first()
    assert r["a"] == 1 and r["f"] == 1.0 and r["s"] == [3.0, 3.0]
