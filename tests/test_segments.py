import hashlib
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusprep.functions import tries
from corpusprep.functions.hashes import numbered_draws
from corpusprep.operators import labels as lb
from corpusprep.operators import sequences as sq
from corpusprep.operators import vocab as vb
from corpusprep.operators.ranking import seeded_uniform
from corpusprep.plans import label_plans


def shown(seg):
    names = seg.names.to_pylist()
    return [([names[i] for i in seg.name[a:b]], seg.begin[a:b].tolist(), seg.end[a:b].tolist()) for a, b in zip(seg.first, seg.first[1:])]


def one_by_one(words, segment, spans):
    pieces = [segment(w) for w in words]
    return [(p, *spans(w, p)) for w, p in zip(words, pieces)]


def some_words(seed, letters, n=2000):
    r = random.Random(seed)
    return list({"".join(r.choice(letters) for _ in range(r.randrange(1, 12))) for _ in range(n)}) + ["a" * 40, "ab" * 20, ""]


@pytest.mark.parametrize("table", [tries.TABLE, 4])
def test_longest_matches_of_many_words(monkeypatch, table):
    """F1, F2"""
    monkeypatch.setattr(tries, "TABLE", table)
    words = some_words(1, "abcdé日😀")
    every = set("abcdé日😀")
    for vocab in ({"a", "ab", "##a", "##ab", "##ba", "abc", "##é", "é", "日", "c", "##b"}, {"a", "##a"}, set(), every | {"##" + c for c in every} | {"##aaab", "dcb"}):
        longest = vb._longest(vocab)
        assert shown(vb._wordpiece_match(vocab)(pa.array(words))) == one_by_one(words, lambda w: vb._wordpiece_segment(w, vocab, longest), vb._piece_offsets)
    assert shown(vb._wordpiece_match({"a"})(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("table", [tries.TABLE, 4])
@pytest.mark.parametrize("byte_level", [False, True])
def test_merges_of_many_words(monkeypatch, table, byte_level):
    """F3, F5, F6"""
    monkeypatch.setattr(tries, "TABLE", table)
    r = random.Random(2)
    words = some_words(3, "abcdé日😀")
    pool = [f"{b:02X}" for b in "abc日".encode()] if byte_level else list("abcé日")
    ranks = {(pool[0], pool[0]): 0}
    for _ in range(60):
        a, b = r.choice(pool), r.choice(pool)
        if (a, b) not in ranks:
            ranks[a, b] = len(ranks)
            pool.append(a + b)
    want = one_by_one(words, lambda w: vb._bpe_segment(w, ranks, byte_level), vb._byte_offsets if byte_level else vb._piece_offsets)
    assert shown(tries.Merges(ranks, byte_level)(pa.array(words))) == want
    assert shown(tries.Merges({}, False)(pa.array(["ab", ""]))) == [(["a", "b"], [0, 1], [1, 2]), ([], [], [])]


def test_words_are_segmented_together():
    """many words take a fraction of the time that they take one by one."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = some_words(4, letters, 60_000)
    vocab = {*letters, *("##" + c for c in letters), *random.Random(5).sample(words, 2000)}
    longest = vb._longest(vocab)
    match = vb._wordpiece_match(vocab)
    start = time.perf_counter()
    match(pa.array(words))
    quick = time.perf_counter() - start
    start = time.perf_counter()
    one_by_one(words, lambda w: vb._wordpiece_segment(w, vocab, longest), vb._piece_offsets)
    assert quick < (time.perf_counter() - start) / 3


def test_draws_are_md5_digits():
    """F1, F2"""
    prefixes = ["3:17:", "", "é" * 30 + ":", "x" * 50, "x" * 54, "x" * 200, "none:"]
    counts = [1203, 11, 105, 101, 3, 2, 0]
    want = [int(hashlib.md5(f"{p}{i}".encode()).hexdigest()[:8], 16) for p, n in zip(prefixes, counts) for i in range(n)]
    assert numbered_draws(pa.array(prefixes), np.array(counts)).tolist() == want
    wanted = np.arange(len(want)) % 3 == 1
    assert numbered_draws(pa.array(prefixes), np.array(counts), wanted).tolist() == want[1::3]


def test_word_starts_where_words_are_not_the_text(spark):
    lower = lambda c: F.split(F.lower(c), " ")
    df = spark.createDataFrame([(1, "b  A b"), (2, "x y")], "k long, t string")
    rows = {r["k"]: r for r in vb._encode_partitions(df, "k", "t", {}, lambda w, m: [w], pretok=lower).collect()}
    assert [tuple(o) for o in rows[1]["offsets"]] == [(0, 1), (1, 1), (1, 2), (5, 6)]
    texts, words = pa.array(["a b　c", None, "ab"]), pa.array(["a", "b", "c", "ab"])
    assert vb._word_starts(texts, words, np.array([3, 0, 1])).tolist() == [0, 2, 4, 0]
    assert vb._word_starts(texts, pa.array(["a", "b", "c", "b"]), np.array([3, 0, 1])).tolist() == [0, 2, 4, 1]


def slow_align(labels, word_ids, first_only):
    out = []
    for i, w in enumerate(word_ids):
        new = i == 0 or word_ids[i - 1] != w
        if w is None or first_only and not new:
            out.append(-100)
        else:
            lab = None if labels is None else labels[w]
            out.append(lab if lab is None or new or first_only or lab % 2 == 0 else lab + 1)
    return out


def test_labels_of_many_rows(spark):
    """F1"""
    r = random.Random(6)
    rows = []
    for k in range(60):
        labels = [r.choice([0, 1, 2, 7, None]) for _ in range(r.randrange(1, 6))]
        rows.append((k, labels, sorted(r.randrange(len(labels)) for _ in range(r.randrange(8))) + [None]))
    rows += [(60, None, [0, None, 0]), (61, [1], None), (62, [], [])]
    df = spark.createDataFrame(rows, "k int, l array<int>, w array<int>").coalesce(2)
    for k, c, f in df.select("k", lb.align_continue("l", "w"), lb.align_first("l", "w")).collect():
        _, labels, ids = rows[k]
        assert (c, f) == ((None, None) if ids is None else (slow_align(labels, ids, False), slow_align(labels, ids, True)))
    with pytest.raises(Exception, match="has no label"):
        spark.createDataFrame([([1], [0, 1])], "l array<int>, w array<int>").select(lb.align_first("l", "w")).collect()


def test_two_lines_of_odd_rows(spark):
    rows = [(["a", None, "日本"], ["B-X", "O", None]), (["a", "b"], ["O"]), (None, ["O"]), ([], [])]
    df = spark.createDataFrame(rows, "w array<string>, l array<string>").coalesce(1)
    assert [x[0] for x in df.select(lb.side_by_side("w", "l")).collect()] == ["a   日本 \nB-X O ", "a b \nO ", None, "\n"]
    named = pa.array([[0, 2, None, -100], None, []], pa.list_(pa.int32()))
    assert lb.label_names(named, ["p", "q", "r"]).to_pylist() == [["p", "r", "-", "-"], None, []]
    ids = pa.array([[0, 0, 3], [], None, [1]], pa.list_(pa.int32()))
    assert lb.with_special_word_ids(ids).to_pylist() == [[None, 0, 0, 3, None], [None, None], None, [None, 1, None]]
    assert lb.with_special_word_ids(ids.slice(4)).to_pylist() == []


def test_offsets_hold_pieces():
    rows = [("né 日x", ["n", "##é", "日", "[UNK]"], [(0, 1), (1, 2), (3, 4), (0, 9)], True), ("ab", ["a", "##c"], [(0, 1), (1, 2)], False),
            ("ab", ["ab"], [(0, 1)], False), ("ab", ["b", "##"], [(1, 9), (2, 2)], True), (None, ["[UNK]"], [(0, 1)], True),
            (None, ["a"], [(0, 1)], None), (None, [], [], True), ("a", None, None, None)]
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    held = pa.array([o and [dict(zip(("start", "end"), x)) for x in o] for _, _, o, _ in rows], spans)
    texts, tokens = pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.string()))
    assert lb.offsets_hold_pieces(texts, tokens, held).to_pylist() == [r[3] for r in rows]


def test_tags_and_masks_draw_as_seeded_uniform(spark):
    """F1, F2"""
    r = random.Random(7)
    rows = [(k if k % 9 else None, [r.randrange(50) for _ in range(n)], sorted(r.choice([0, 1, 2, 3]) for _ in range(n)))
            for k, n in ((k, r.randrange(12)) for k in range(50))] + [(7, None, [1]), (7, [1], None), (8, [5, 6], [None, 0])]
    df = spark.createDataFrame(rows, "k long, ids array<int>, w array<int>").coalesce(2)
    n = F.when(F.col("k") != 5, F.size("w"))
    tags = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
                       lambda i: F.when(seeded_uniform(F.lit(3), F.col("k"), i) < 0.7, F.lit(0)).otherwise((F.floor(seeded_uniform(F.lit(4), F.col("k"), i) * 8) + 1).cast("int")))
    z = F.arrays_zip(F.col("ids").alias("x"), sq.word_runs("w").alias("r"))
    picked = lambda e: e["r"].isNotNull() & (seeded_uniform(F.lit(5), F.lit("w"), F.col("k"), e["r"]) < 0.2)
    masks = F.struct(F.transform(z, lambda e: F.when(picked(e), F.lit(103)).otherwise(e["x"])), F.transform(z, lambda e: F.when(picked(e), e["x"]).otherwise(F.lit(-100))))
    keys = [F.concat(F.concat_ws(":", F.lit(x), F.col("k").cast("string")), F.lit(":")) for x in ("3", "4", "5:w")]
    got = df.select(sq.mask_words("ids", "w", F.col("k"), seed=5, p=0.2), masks, tags, F.coalesce(n, F.lit(0)), "ids", "w", *keys).collect()
    lists = lambda i: pa.array([g[i] for g in got], pa.list_(pa.int32()))
    p3, p4, p5 = (pa.array([g[i] for g in got]) for i in (6, 7, 8))
    assert lb.drawn_tags(p3, p4, np.array([g[3] for g in got])).to_pylist() == [g[2] for g in got]
    assert [tuple(g[0]) for g in got] == [tuple(g[1]) for g in got]
    assert [tuple(m.values()) for m in sq.mask_words(lists(4), lists(5), p5, 5, 0.2).to_pylist()] == [tuple(g[1]) for g in got]


def test_pretokens_of_many_texts(spark):
    """Pieces and their places as the engine's regular expression finds them."""
    from corpusprep.functions.text import character_classes, pretokenize, pretokens
    r = random.Random(9)
    odd = "a1_é日😀ß  \t\n\u00a0\u3000\u200b\u0301\u180e\u001c\x00\u2028.,-#\u200d٣"
    texts = ["", None, " ", "a", "ab", "\n", "a b", "ab"] + ["".join(r.choice(odd) for _ in range(r.randrange(40))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    want = [x["w"] or [] for x in df.select("k", pretokenize("t").alias("w")).orderBy("k").collect()]
    pieces, sizes, starts = pretokens(pa.array(texts, pa.string()), character_classes())
    assert pieces.to_pylist() == [w for ws in want for w in ws] and sizes.tolist() == [len(w) for w in want]
    lists = np.repeat(np.arange(len(texts)), sizes).tolist()
    assert all(texts[i][s:s + len(w)] == w for i, s, w in zip(lists, starts.tolist(), pieces.to_pylist()))
    assert [len(x) for x in pretokens(pa.array(texts, pa.string()).slice(4, 3), character_classes())] == [3, 3, 3]
    freqs = {x["word"]: x["count"] for x in vb.word_frequencies(df, "t").collect()}
    assert freqs == Counter(w for ws in want for w in ws)


def test_documents_of_repeated_ids_meet_each_other(spark):
    """rows of ids that do not repeat are not joined."""
    one = spark.createDataFrame([(1, "a"), (2, None), (None, "n")], "doc_id long, text string")
    pairs = label_plans._paired(one, "doc_id", "text")
    assert sorted(map(tuple, pairs.collect())) == [(1, "a", None, True), (2, None, None, True)]
    assert "Join" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    rows = [(1, "a"), (2, "b"), (2, "c"), (2, None), (None, "n"), (None, "n"), (3, None)]
    two = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"], r["text"] if r["alone"] else r["other"]) for r in label_plans._paired(two, "doc_id", "text").collect()), key=str)
    assert got == sorted(((k, x, y) for k, x in rows for j, y in rows if k is not None and k == j), key=str)


def test_positions_of_many_rows(spark):
    """the columns' answers, for all rows of a batch at once."""
    r = random.Random(11)
    rows = []
    for _ in range(80):
        cuts = sorted(r.sample(range(20), r.randrange(1, 8)))
        spans = [None if r.random() < 0.1 else p for p in zip(cuts, cuts[1:])]
        rows.append((spans, sorted(r.randrange(4) for _ in spans), r.choice([0, 1, 2, 3, None]), r.choice([0, 3, 7, 19, None])))
    rows += [(None, None, 0, 0), ([], [], 0, 0)]
    df = spark.createDataFrame(rows, "o array<struct<start:int,end:int>>, w array<int>, n int, p int").coalesce(1)
    token = sq.char_to_token("o", F.col("p"))
    want = df.select(sq.word_to_chars("o", "w", F.col("n")), token, sq.char_to_word("o", "w", F.col("p")), sq.token_to_chars("o", token)).collect()
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    o = pa.array([x[0] and [s and dict(zip(("start", "end"), s)) for s in x[0]] for x in rows], pa.list_(span))
    w, n, p = pa.array([x[1] for x in rows], pa.list_(pa.int32())), pa.array([x[2] for x in rows], pa.int32()), pa.array([x[3] for x in rows], pa.int32())
    got = [sq.word_to_chars(o, w, n), sq.char_to_token(o, p), sq.char_to_word(o, w, p), sq.token_to_chars(o, sq.char_to_token(o, p))]
    plain = lambda x: None if x is None or isinstance(x, dict) and x["start"] is None else tuple(x.values()) if isinstance(x, dict) else x
    same = lambda x: None if x is None or isinstance(x, tuple) and x[0] is None else tuple(x) if isinstance(x, tuple) else x
    for i, column in enumerate(got):
        assert [plain(x) for x in column.to_pylist()] == [same(x[i]) for x in want]
