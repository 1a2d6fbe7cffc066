import random
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from corpusprep.operators import labels as lb
from corpusprep.operators import metrics as mt
from corpusprep.operators import sequences as sq
from corpusprep.operators.ranking import below


def test_overlap_counts_arrow_batches(spark):
    """F31"""
    r = random.Random(3)
    words = ["a", "b", "é", None, "c"]
    rows = [([r.choice(words) for _ in range(r.randrange(8))], [r.choice(words) for _ in range(r.randrange(8))]) for _ in range(60)]
    rows += [(None, ["a"]), (["a"], None), ([], [])]
    want = [sum((Counter(x) & Counter(y)).values()) for x, y in rows]
    a, b = (pa.array([row[i] for row in rows], pa.list_(pa.string())) for i in (0, 1))
    assert mt.overlap.func(a, b).to_pylist() == want
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    assert [x[0] for x in df.coalesce(1).select(mt.overlap("a", "b")).collect()] == want


def test_hash_digits_compare_as_numbers(spark):
    """F29, F30"""
    digits = [f"{v:08x}" for v in (0, 1, 0x19999999, 0x1999999A, 0xB3333332, 0xB3333333, 0xB3333334, 0xFFFFFFFF)]
    df = spark.createDataFrame([(d,) for d in digits], "d string")
    for share in (0.0, 0.1, 0.15, 0.2, 0.7, 0.8, 1.0):
        got = [r[0] for r in df.coalesce(1).select(below(F.col("d"), share)).collect()]
        assert got == [int(d, 16) / 4294967296.0 < share for d in digits]
    plan = spark.createDataFrame([(1, [5])], "k long, ids array<int>").select(sq.mask_tokens("ids", F.col("k"), 1).alias("m"))
    text = plan.select("m.labels")._jdf.queryExecution().optimizedPlan().toString()
    assert "conv(substring(namedlambdavariable() AS h, 1" not in text and text.count("conv(") <= 1


def test_spans_of_odd_tags(spark):
    """the types of tags are found once, spans as before."""
    r = random.Random(5)
    names = ["O", "B-X", "I-X", "B-Y", "I-Y", None]
    rows = [[r.choice(names) for _ in range(r.randrange(9))] for _ in range(80)] + [[], None]
    got = [x[0] for x in spark.createDataFrame([(t,) for t in rows], "t array<string>").coalesce(1).select(lb.span_array("t")).collect()]
    for tags, spans in zip(rows, got):
        if tags is None:
            assert spans is None
            continue
        want, open_ = [], None
        for i, t in enumerate([*tags, "O"]):
            kind = t[2:] if t and t[:2] in ("B-", "I-") else None
            if open_ and (kind != open_[0] or t[:2] == "B-"):
                want.append((open_[0], open_[1], i - 1))
                open_ = None
            if kind and not open_:
                open_ = (kind, i)
        assert [tuple(s) for s in spans] == want
    plan = spark.createDataFrame([(["O"],)], "t array<string>").select(lb.span_array("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StartsWith(") <= 3


def _bleu_by_counters(rows, max_n=4):
    total = [0] * (2 * max_n + 2)
    for h, rs in rows:
        total[-2] += len(h)
        total[-1] += min((abs(len(r) - len(h)), len(r)) for r in rs)[1] if rs else 0
        for n in range(1, max_n + 1):
            grams = lambda t: Counter(zip(*(t[k:] for k in range(n))))  # noqa: B023, E731
            most = Counter()
            for r in rs:
                most |= grams(r)
            total[2 * n - 2] += sum((grams(h) & most).values())
            total[2 * n - 1] += max(0, len(h) - n + 1)
    return total


def test_bleu_counts_ngrams_of_many_rows_at_once():
    import time

    import numpy as np
    import pyarrow as pa

    from corpusprep.operators.metrics import _bleu_sums
    rng = np.random.default_rng(3)
    text = lambda n, v: [f"w{x}" for x in rng.integers(0, v, n)]
    rows = [(text(n, 9), [text(m, 9) for m in ms]) for n, ms in [(0, [3]), (4, []), (12, [30, 30, 2]), (1, [0]), (25, [25]), (3, [9, 1])]]
    rows.append((text(40_000, 1 << 30), [text(40_000, 1 << 30)]))  # four numbers of its tokens need over 64 bits
    rows[-1][1][0][100:300] = rows[-1][0][7:207]
    arrays = lambda some: (pa.array([h for h, _ in some], pa.list_(pa.string())), pa.array([r for _, r in some], pa.list_(pa.list_(pa.string()))))
    assert _bleu_sums(*arrays(rows), 4).tolist() == _bleu_by_counters(rows)
    assert _bleu_sums(*arrays(rows[:-1]), 2).tolist() == _bleu_by_counters(rows[:-1], 2)
    many = [(text(500, 3000), [text(500, 3000), text(500, 3000)]) for _ in range(300)]
    h, rs = arrays(many)
    start = time.perf_counter()
    got = _bleu_sums(h, rs, 4).tolist()
    quick = time.perf_counter() - start
    start = time.perf_counter()
    assert got == _bleu_by_counters(many)
    assert quick < (time.perf_counter() - start) / 2
