"""Quoted records that span lines, read in many byte ranges."""

import os
import random

import numpy as np
import pytest

from corpusprep.sources import files, records
from tests.conftest import SF001


@pytest.fixture()
def small_ranges(spark):
    """Byte ranges of 2000 bytes, so that a small file has many."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def slow_open(line, sep, is_open):
    fresh, i = not is_open, 0
    while i < len(line):
        c = line[i]
        if is_open:
            if c == '"':
                if line[i + 1:i + 2] == '"':
                    i += 1
                else:
                    is_open = False
        elif c == sep:
            fresh = True
            i += 1
            continue
        elif c == '"' and fresh:
            is_open = True
        fresh = False
        i += 1
    return is_open


def test_state_of_a_line_and_of_many():
    rng = random.Random(3)
    for _ in range(3000):
        text = ["".join(rng.choice('"",ab') for _ in range(rng.randrange(9))) for _ in range(rng.randrange(1, 6))]
        a0 = np.array([records.ends_open(t, ",", False) for t in text])
        a1 = np.array([records.ends_open(t, ",", True) for t in text])
        assert a0.tolist() == [slow_open(t, ",", False) for t in text]
        assert a1.tolist() == [slow_open(t, ",", True) for t in text]
        for bit in (False, True):
            before, end = records.bits_before(a0, a1, bit)
            for t, b in zip(text, before.tolist()):
                assert b == bit
                bit = slow_open(t, ",", bit)
            assert end == bit


def field(rng):
    kind = rng.randrange(6)
    if kind == 0:
        return ""
    if kind == 1:
        return 'five" disk'
    body = "".join(rng.choice(["a", "é", "\n", "\n\n", '""', "\t", ",", " ", "\r\n"]) for _ in range(rng.choice([3, 40, 900])))
    return f'"{body}"' if kind > 2 else "plain text"


def write_file(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
        f.write(text)


def both(spark, folder, schema, header=True, **kw):
    got = files._parse_records(records.read_records(spark, folder, "\t", **kw), schema, "\t", header)
    want = spark.read.options(header=header, multiLine=True, **files._delimited_options("\t")).schema(schema).csv(folder)
    return [sorted(map(repr, (tuple(r) for r in df.collect()))) for df in (got, want)]


@pytest.mark.parametrize("max_broadcast", [records.MAX_BROADCAST_BYTES, 0])
def test_large_file_in_many_ranges_equals_the_whole_file_reader(spark, tmpdir_path, small_ranges, max_broadcast):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.StringType()), T.StructField("y", T.StringType())])
    rng = random.Random(9)
    folder = os.path.join(tmpdir_path, "tsv")
    for name in ("a.tsv", "b.tsv"):
        rows = [f"{i}\t{field(rng)}\t{field(rng)}" for i in range(150)]
        write_file(folder, name, "\n".join(['id\t"x\ny"\tz', *rows[:70], "", *rows[70:]]) + "\n")
    assert spark.read.text(folder).rdd.getNumPartitions() > 20
    got, want = both(spark, folder, schema, max_broadcast=max_broadcast)
    assert len(want) == 300 and got == want
    again = files.read_delimited(spark, {"all": folder}, multi_line=True, schema=schema)
    assert again.count() == 300 and again.columns == ["id", "x", "y", "split"]


def test_record_longer_than_a_range_and_one_never_closed(spark, tmpdir_path, small_ranges):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.StringType())])
    folder = os.path.join(tmpdir_path, "long")
    long_text = "\n".join(f"line {i}" for i in range(3000))
    write_file(folder, "a.tsv", f'id\tx\n1\ta\n2\t"{long_text}"\n3\tc\n4\t"open\nto the end\n')
    got = {r["id"]: r["x"] for r in files.read_delimited(spark, {"s": folder}, schema=schema, multi_line=True).collect()}
    assert set(got) == {1, 2, 3, 4} and got[2] == long_text and got[4].rstrip("\n") in ('open\nto the end', '"open\nto the end')
    assert both(spark, folder, schema)[0][:3] == both(spark, folder, schema)[1][:3]


def test_empty_files_names_from_the_header_and_documents(spark, tmpdir_path, small_ranges):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType())])
    folder = os.path.join(tmpdir_path, "empty")
    write_file(folder, "a.tsv", "")
    assert files.read_delimited(spark, {"s": folder}, schema=schema, multi_line=True).count() == 0
    write_file(os.path.join(tmpdir_path, "crlf"), "a.tsv", 'id\t"odd `name"\r\n\r\n1\t"a\r\nb"\r\n2\tc\r\n')
    rows = files.read_delimited(spark, {"s": os.path.join(tmpdir_path, "crlf")}, multi_line=True)
    assert rows.columns == ["id", "odd `name", "split"]
    assert sorted(tuple(r)[:2] for r in rows.collect()) == [("1", "a\r\nb"), ("2", "c")]


def test_whole_table_through_small_ranges(spark, tmpdir_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang", "text")
    path = os.path.join(tmpdir_path, "docs")
    files.write_delimited(docs.coalesce(1), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        back = files.read_delimited(spark, {"s": path}, schema="doc_id long, lang string, text string", multi_line=True).drop("split")
        assert spark.read.text(path).rdd.getNumPartitions() > 8
        assert back.exceptAll(docs).count() == 0 and back.count() == docs.count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
