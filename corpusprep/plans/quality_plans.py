"""Record-quality queries (D1-D11, P20) over customer, orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.operators import quality as qa
from corpusprep.operators import shape
from corpusprep.sources.tables import table

QUERIES = {}
SQL = {}

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def register(name, sql=None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


def customer_rules():
    return [
        ("c_acctbal out of range", qa.bounds("c_acctbal", ge=-999.99, le=9999.99, finite=True)),
        ("c_acctbal not a multiple of 0.01", qa.bounds(F.round(F.col("c_acctbal") * 100, 6), multiple_of=1)),
        ("c_name malformed", qa.text_rule("c_name", min_length=18, max_length=25, pattern=r"Customer#[0-9]{9}")),
        ("c_nationkey out of range", qa.bounds("c_nationkey", ge=0, lt=25)),
        ("c_mktsegment unknown", qa.one_of("c_mktsegment", SEGMENTS)),
        ("c_name does not match c_custkey", qa.equal(F.substring("c_name", 10, 9).try_cast("long"), F.col("c_custkey"))),
        ("c_acctbal negative", qa.bounds("c_acctbal", gt=0)),
    ]


RULES_SQL = """
list_filter([
  CASE WHEN NOT coalesce(c_acctbal >= -999.99 AND c_acctbal <= 9999.99 AND NOT isnan(c_acctbal) AND abs(c_acctbal) <> 'inf'::DOUBLE, false) THEN 'c_acctbal out of range' END,
  CASE WHEN NOT coalesce(abs(round(c_acctbal * 100, 6) % 1) < 1e-9, false) THEN 'c_acctbal not a multiple of 0.01' END,
  CASE WHEN NOT coalesce(length(c_name) >= 18 AND length(c_name) <= 25 AND regexp_full_match(c_name, 'Customer#[0-9]{9}'), false) THEN 'c_name malformed' END,
  CASE WHEN NOT coalesce(c_nationkey >= 0 AND c_nationkey < 25, false) THEN 'c_nationkey out of range' END,
  CASE WHEN NOT coalesce(c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'), false) THEN 'c_mktsegment unknown' END,
  CASE WHEN NOT coalesce(TRY_CAST(substr(c_name, 10, 9) AS BIGINT) = c_custkey, false) THEN 'c_name does not match c_custkey' END,
  CASE WHEN NOT coalesce(c_acctbal > 0, false) THEN 'c_acctbal negative' END
], lambda x: x IS NOT NULL)"""


@register("customer_validation", f"""
SELECT c_custkey, array_to_string({RULES_SQL}, '; ') AS errors, len({RULES_SQL}) = 0 AS accepted FROM customer""")
def customer_validation(spark, sf_dir):
    """Rule checks on every customer, error list and verdict."""
    c = table(spark, sf_dir, "customer")
    good, bad = qa.validate(c, customer_rules())
    g = good.select("c_custkey", F.lit("").alias("errors"), F.lit(True).alias("accepted"))
    b = bad.select("c_custkey", F.array_join("errors", "; ").alias("errors"), F.lit(False).alias("accepted"))
    return g.unionByName(b)


@register("quarantine_routes", f"""
SELECT len({RULES_SQL}) = 0 AS accepted, c_mktsegment, count(*) AS rows FROM customer GROUP BY ALL""")
def quarantine_routes(spark, sf_dir):
    """P20: the two routes of the validation flag counted per segment."""
    c = table(spark, sf_dir, "customer").withColumn("accepted", F.size(qa.errors(customer_rules())) == 0)
    good, bad = shape.route(c, "accepted")
    agg = lambda d, v: d.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("rows")).withColumn("accepted", F.lit(v))
    return agg(good, True).unionByName(agg(bad, False)).select("accepted", "c_mktsegment", "rows")


@register("event_props_coercion", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CASE WHEN json_extract_string(props, '$.k') IS NOT NULL AND TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL
            THEN 1 ELSE 0 END AS coerce_errors,
       coalesce(trim(event_type), 'unknown') AS kind,
       array_to_string(list_filter(json_keys(props), lambda x: x NOT IN ('user')), ',') AS unknown_keys
FROM events""")
def event_props_coercion(spark, sf_dir):
    """A JSON field coerced to int with failures listed, an alias with a default and
    strip, and the keys a schema with only 'user' does not know."""
    ev = table(spark, sf_dir, "events")
    ev = ev.withColumn("k", F.get_json_object("props", "$.k"))
    ev = qa.coerce(ev, {"k": "int"})
    ev = qa.apply_defaults(ev, {"kind": {"alias": "event_type", "default": "unknown", "strip": True}})
    return ev.select("event_id", "k", F.size("coerce_errors").alias("coerce_errors"), "kind",
                     F.array_join(qa.unknown_fields("props", ["user"]), ",").alias("unknown_keys"))


@register("order_time_formats", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_time,
       epoch(try_strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S')) = epoch(o_orderdate) AS round_trip,
       try_strptime(o_orderpriority, '%Y-%m-%d %H:%M:%S') IS NULL AS priority_not_time
FROM orders""")
def order_time_formats(spark, sf_dir):
    """Format with a fixed pattern, parse back, and a non-time text that does not parse."""
    o = table(spark, sf_dir, "orders")
    txt = qa.format_time("o_orderdate")
    back = qa.parse_time(txt)
    return o.select("o_orderkey", txt.alias("order_time"),
                    (F.unix_micros(back.cast("timestamp")) == F.unix_micros(F.col("o_orderdate").cast("timestamp"))).alias("round_trip"),
                    qa.parse_time("o_orderpriority").isNull().alias("priority_not_time"))


@register("masked_customer_json", """
SELECT md5(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_acctbal': CASE WHEN c_acctbal IS NOT NULL THEN '**********' END})) AS json_md5,
       c_custkey FROM customer""")
def masked_customer_json(spark, sf_dir):
    """D9 + D10: balance masked as a secret, JSON export with an include list."""
    c = table(spark, sf_dir, "customer").withColumn("c_acctbal", qa.mask_secret("c_acctbal"))
    j = qa.to_json_view(c, include=["c_custkey", "c_name", "c_acctbal"], keep=["c_custkey"])
    return j.select("c_custkey", F.md5("json").alias("json_md5"))


@register("unknown_field_policy", """
SELECT event_id, CAST(len(list_filter(json_keys(props), lambda k: k NOT IN ('user'))) AS INTEGER) AS errors,
       CAST(len(list_filter(json_keys(props), lambda k: k NOT IN ('user'))) AS INTEGER) AS extra_keys FROM events""")
def unknown_field_policy(spark, sf_dir):
    """D7 policies on the events' JSON properties: forbid lists errors, allow keeps the extras."""
    schema = T.StructType([T.StructField("user", T.StringType())])
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    forbid = qa.apply_unknown_policy(ev, "props", schema, "forbid").drop("user")
    both = qa.apply_unknown_policy(forbid, "props", schema, "allow")
    return both.select("event_id", F.size("unknown_errors").alias("errors"), F.size("extra").alias("extra_keys"))
