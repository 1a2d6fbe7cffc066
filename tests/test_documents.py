"""Rows of one JSON document, read in many byte ranges."""

import gzip
import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from corpusprep.sources import documents, files, records
from tests.test_records import small_ranges, write_file  # noqa: F401

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("data", T.ArrayType(T.LongType())), T.StructField("sub", T.StructType([T.StructField("data", T.StringType())]))])


def element(rng, i):
    text = "".join(rng.choice(["a", "é", '"', "\\", ",", "]", "}", "[", "{", "\n", '"data":[', " ", "😀"]) for _ in range(rng.choice([0, 5, 60, 2500])))
    return {"id": i, "text": text, "data": [1, 2, i][: rng.randrange(4)], "sub": rng.choice([None, {"data": "x, [y]"}])}


def test_strings_and_escapes():
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice('"\\\\a,') for _ in range(rng.randrange(1, 12)))
        state, skip, want = 0, False, []
        for c in text:
            if skip:
                skip = False
            elif c == "\\":
                skip = True
            elif c == '"':
                state ^= 1
            want.append(state)
        assert documents.inside_string(np.frombuffer(text.encode(), np.uint8)).tolist() == want


@pytest.mark.parametrize("max_broadcast", [records.MAX_BROADCAST_BYTES, 0])
def test_one_document_in_many_ranges(spark, tmpdir_path, small_ranges, max_broadcast):  # noqa: F811
    rng = random.Random(5)
    folder = os.path.join(tmpdir_path, "json")
    want = []
    for name, indent in (("a.json", None), ("b.json", 1)):
        rows = [element(rng, i) for i in range(120)]
        want += [json.dumps(r, sort_keys=True) for r in rows]
        doc = {"version": [1, 2], "meta": {"data": [{"id": -1}]}, "note": '"data": [', "data": rows, "other": [[{"id": -2}], 3, 4], "end": {"data": [5, 6]}}
        write_file(folder, name, json.dumps(doc, indent=indent, ensure_ascii=rng.random() < 0.5))
    assert spark.read.option("lineSep", ",").text(folder).rdd.getNumPartitions() > 20
    got = documents.read_elements(spark, folder, "data", max_broadcast)
    assert sorted(json.dumps(json.loads(r["value"]), sort_keys=True) for r in got.collect()) == sorted(want)


def test_rows_equal_the_whole_document_reader(spark, tmpdir_path, small_ranges):  # noqa: F811
    from pyspark.sql import functions as F
    rng = random.Random(6)
    folder = os.path.join(tmpdir_path, "json")
    write_file(folder, "a.json", json.dumps({"data": [element(rng, i) for i in range(100)] + [None, {}]}, indent=2))
    got = files.read_json_field(spark, folder, "data", SCHEMA)
    wrapped = T.StructType([T.StructField("data", T.ArrayType(SCHEMA))])
    want = spark.read.schema(wrapped).option("multiLine", True).json(folder).select(F.explode("data").alias("row")).select("row.*")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_long_elements_empty_ones_and_gzip(spark, tmpdir_path, small_ranges):  # noqa: F811
    folder = os.path.join(tmpdir_path, "json")
    long_text = ", ".join(str(i) for i in range(4000))
    write_file(folder, "a.json", json.dumps({"x": 1, "data": [{"id": 1}, {"id": 2, "text": long_text}, {"id": 3}]}))
    write_file(folder, "b.json", '{"data": [ \n ], "x": [1,2]}')
    write_file(folder, "c.json", '{"data": null, "x": {"data": [1]}}')
    write_file(folder, "d.json", "")
    write_file(folder, "e.json", '{"data": [{"id": 9}], "data": [{"id": 10},{"id": 11}]}')
    write_file(folder, "f.json", '{"data": [{"id": 20}, {"id": 21}, {"id": 2')
    with gzip.open(os.path.join(folder, "g.json.gz"), "wt") as f:
        json.dump({"a": "b", "data": [{"id": 30}, {"id": 31}]}, f)
    rows = files.read_json_field(spark, folder, "data", SCHEMA).collect()
    assert sorted(r["id"] for r in rows if r["id"] is not None) == [1, 2, 3, 10, 11, 20, 21, 30, 31]
    assert [r["text"] for r in rows if r["id"] == 2] == [long_text]
    with pytest.raises(ValueError):
        documents.read_elements(spark, folder, "a,b")
