import random
import time

import numpy as np
import pyarrow as pa
import pytest

from corpusprep.functions import tries
from corpusprep.operators import vocab as vb


def pair_counts(words):
    out = {}
    for symbols, n in words:
        for p in zip(symbols, symbols[1:]):
            out[p] = out.get(p, 0) + n
    return out


def merge(symbols, joined):
    out = []
    for x in symbols:
        if out and (out[-1], x) in joined:
            out[-1:] = [joined[out[-1], x], None]  # a merged symbol takes no part in another merge
        else:
            out.append(x)
    return [x for x in out if x is not None]


def symbols_of(block):
    words, out = [[]], []
    for i in block.data.tolist():
        words[-1].append(block.names[i - 1]) if i else words.append([])
    for w, n in zip(words, block.counts.tolist()):
        out.append((w, n))
    return out


@pytest.mark.parametrize("table", [vb.PAIR_TABLE, 4])
@pytest.mark.parametrize("byte_level", [False, True])
def test_blocks_of_words(monkeypatch, table, byte_level):
    """pairs, neighbours and merges of a block of words, against plain loops."""
    monkeypatch.setattr(vb, "PAIR_TABLE", table)
    r = random.Random(1)
    words = sorted({"".join(r.choice("aabcé日😀") for _ in range(r.randrange(1, 9))) for _ in range(500)}) + ["aaaaa", "a" * 8, ""]
    counts = np.array([r.randrange(1, 60) for _ in words])
    unit = (lambda w: [f"{b:02X}" for b in w.encode()]) if byte_level else list
    held = [(unit(w), n) for w, n in zip(words, counts.tolist())]
    block = vb._Block.of_words(pa.array(words), counts, byte_level)
    assert symbols_of(block) == held
    for _ in range(12):
        left, right, freq = block.pairs()
        want = pair_counts(held)
        assert {(block.names[a - 1], block.names[b - 1]): n for a, b, n in zip(left.tolist(), right.tolist(), freq.tolist())} == want
        ranked = vb.apart(sorted(((*p, n) for p, n in want.items()), key=lambda x: (-x[2], x[:2])))[:6]
        pairs = [(a, b) for a, b, _ in ranked]
        beside = {}
        for symbols, n in held:
            for i, p in enumerate(zip(symbols, symbols[1:])):
                if p in pairs:
                    for side, k in ((0, i - 1), (1, i + 2)):
                        if 0 <= k < len(symbols):
                            key = (pairs.index(p), side, symbols[k])
                            beside[key] = beside.get(key, 0) + n
        assert {x[:3]: x[3] for x in block.neighbours(pairs)} == beside
        joined = {(a, b): a + b for a, b in pairs}
        held = [(m, n) for m, n in ((merge(s, joined), n) for s, n in held) if len(m) > 1]
        row = block.merged(joined).batch()
        block = vb._Block.of_row({k: row.column(i)[0].as_py() for i, k in enumerate(("symbols", "data", "counts"))})
        assert symbols_of(block) == held
        got = {(p["left"], p["right"]): p["freq"] for p in row.column(3)[0].as_py()}
        assert got == pair_counts(held)


def test_blocks_take_a_fraction_of_the_time():
    """a round went over the symbols of every word one by one."""
    r = random.Random(2)
    words = sorted({"".join(r.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(60_000)})
    counts = np.ones(len(words), dtype=np.int64)
    block = vb._Block.of_words(pa.array(words), counts, False)
    held = [(list(w), 1) for w in words]
    start = time.perf_counter()
    block.merged({("a", "b"): "ab"}).pairs()
    quick = time.perf_counter() - start
    start = time.perf_counter()
    pair_counts([(merge(s, {("a", "b"): "ab"}), n) for s, n in held])
    assert quick < (time.perf_counter() - start) / 4


def test_a_token_made_in_two_ways(spark):
    """"abc" is made of ab + c and of a + bc; its pairs count both from then on."""
    from test_vocab import one_at_a_time
    counts = {"abcd": 50, "xabcd": 9, "ab": 300, "bc": 310, "cab": 40, "abc": 45, "abcabc": 30, "dabcd": 20, "bcd": 70, "aabcc": 11, "": 4}
    f = spark.createDataFrame(list(counts.items()), "word string, count long")
    for merges in (3, 9, 40):
        got = [(r["left"], r["right"], r["freq"]) for r in vb.learn_bpe(f, merges)[0].orderBy("rank").collect()]
        assert got == one_at_a_time(counts, merges)


def some_units(seed, letters, n):
    r = random.Random(seed)
    units = {c: r.uniform(4, 12) for c in letters}
    for _ in range(n):
        units.setdefault("".join(r.choice(letters) for _ in range(r.randrange(2, 6))), r.uniform(3, 12))
    return units


@pytest.mark.parametrize("table", [tries.TABLE, 4])
def test_lattices_of_many_words(monkeypatch, table):
    """best paths, expected counts and removal losses of words of all lengths, against one word at a time."""
    monkeypatch.setattr(tries, "TABLE", table)
    monkeypatch.setattr(tries.BestPaths, "HELD", 1 << 11)
    r = random.Random(3)
    units = some_units(4, "abcdé日😀", 200)
    longest = vb._longest(units)
    words = sorted({"".join(r.choice("abcdé日😀?") for _ in range(r.randrange(1, 12))) for _ in range(900)}) + ["a" * 30, "", "abab" * 150]
    counts = np.array([r.randrange(1, 50) for _ in words])
    paths = tries.BestPaths(units, vb.UNK, vb._expected_counts)
    seg = paths(pa.array(words))
    names = seg.names.to_pylist()
    got = [([names[i] for i in seg.name[a:b]], seg.begin[a:b].tolist(), seg.end[a:b].tolist()) for a, b in zip(seg.first, seg.first[1:])]
    best = [vb._viterbi(w, units, longest) for w in words]
    pieces = [p or ([vb.UNK] if w else []) for w, (p, _) in zip(words, best)]
    assert got == [(p, *vb._piece_offsets(w, p)) for w, p in zip(words, pieces)]
    expected, losses = dict.fromkeys(units, 0.0), dict.fromkeys(units, 0.0)
    for w, n, (p, cost) in zip(words, counts.tolist(), best):
        for u, x in vb._expected_counts(w, units, longest).items():
            expected[u] += n * x
        for u in {u for u in p or () if len(u) > 1}:
            losses[u] += n * (vb._viterbi(w, units, longest, banned=u)[1] - cost)
    assert np.allclose(paths.expected(pa.array(words), counts), list(expected.values()), rtol=1e-9, atol=1e-9)
    assert np.allclose(paths.removal_losses(pa.array(words), counts), list(losses.values()), rtol=1e-9, atol=1e-9)
    assert paths.expected(pa.array([], pa.string()), np.array([], dtype=int)).tolist() == [0.0] * len(units)


def test_lattices_take_a_fraction_of_the_time():
    """every word was segmented by loops of its own."""
    r = random.Random(5)
    letters = "abcdefghijklmnop"
    units = some_units(6, letters, 3000)
    longest = vb._longest(units)
    words = sorted({"".join(r.choice(letters) for _ in range(r.randrange(5, 12))) for _ in range(20_000)})
    paths, array, counts = tries.BestPaths(units, vb.UNK), pa.array(words), np.ones(len(words), dtype=np.int64)
    for many, one in ((paths.expected, lambda w: vb._expected_counts(w, units, longest)), (lambda a, _: paths(a), lambda w: vb._viterbi(w, units, longest))):
        start = time.perf_counter()
        many(array, counts)
        quick = time.perf_counter() - start
        start = time.perf_counter()
        for w in words[::4]:
            one(w)
        assert quick < time.perf_counter() - start
