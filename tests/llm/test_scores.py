"""Quality classifier, language-model scores, decontamination, chat formatting and the pipeline."""

import hashlib
import math
import random
import re
import weakref
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusprep.llm import chat, decontam, lm, plans, quality
from tests.llm.test_dups import slow_components, slow_fingerprint, slow_lines

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, score string, n_words string, items string, block string"


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z", "b") for i, t in rows], SCHEMA)


# --- quality -----------------------------------------------------------------------------------------


def test_quality_separates_and_ignores_held_out_labels(spark):
    rng = random.Random(1)
    good = [" ".join(rng.choice(["the", "of", "river", "stone"]) for _ in range(40)) for _ in range(60)]
    bad = [" ".join(rng.choice(["BUY", "NOW!!", "cheap", "$$$"]) for _ in range(40)) for _ in range(60)]
    rows = list(enumerate(good + bad)) + [(500, None), (501, ""), (None, good[0]), (3, good[3]), (502, "the " * 50000)]
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120)] + [(7, 0, 0), (9999, 1, 0), (None, 1, 0), (8, None, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = rows_of(spark, rows)
    usable = plans.crc_of("doc_id") % 5 != 0
    weights = quality.train(docs, labels, usable=usable)
    out = quality.score(docs, weights)
    assert out.columns == [*[c for c in docs.columns if c != "score"], "score", "predicted"]
    got = [(r.doc_id, r.score, r.predicted) for r in out.collect()]
    assert len(got) == len(rows) and all(0 <= s <= 1 and p == int(s >= 0.3) for _, s, p in got)
    by = {i: s for i, s, _ in got}
    assert min(by[i] for i in range(60)) > 0.5 > max(by[i] for i in range(60, 120)) and by[502] > 0.5
    flipped = labels.withColumn("quality", F.when(plans.crc_of("doc_id") % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.train(docs, flipped, usable=usable) == weights
    untaught = quality.score(docs, quality.train(docs, labels.where("false")))
    assert {r.score for r in untaught.collect()} == {0.5}
    assert quality.score(rows_of(spark, []), weights).count() == 0


def test_quality_held_out_accuracy(spark):
    out = plans.op4_quality(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    held = [(r.quality, r.score) for r in out.where("held_out").collect()]
    right = sum((s >= 0.3) == (q == 1) for q, s in held) / len(held)
    lost = sum(s < 0.3 for q, s in held if q == 1) / sum(q for q, _ in held)
    assert len(held) > 500 and right > 0.95 and lost < 0.01


# --- language model ----------------------------------------------------------------------------------


def slow_base(rows, held):
    def tokens(t):
        return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), "\n"]
    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return [(i, held(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n,
             round(math.fsum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t in rows]


def held_out(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2


def test_lm_scores(spark):
    rng = random.Random(2)
    words = ["river", "Stone", "bridge", "ÉTÉ", "été", "the", "of"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, "\n \t"), (None, "river"), (5, rows[5][1]), (5, rows[5][1]), (103, "stone " * 30000), (104, "q" * 3000)]
    docs = rows_of(spark, rows)
    got = lm.score_documents(docs, plans.crc_of("doc_id") % 7 == 2, block_bytes=4000).collect()
    have = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(map(repr, have)) == sorted(map(repr, slow_base(rows, held_out)))
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[103].bits_per_byte < 0.3
    assert lm.score_documents(docs.where("false"), F.lit(False)).count() == 0
    blank = lm.score_documents(docs, F.lit(True)).collect()  # nothing to learn from: one bit costs one bit
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in blank)
    assert max(abs(r.bits_per_byte - 8) for r in blank if r.doc_id == 103) < 0.5


def test_lm_learns_only_from_its_documents_and_beats_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = plans.crc_of("doc_id") % 7 == 2
    a = {r.doc_id: r for r in lm.score_documents(docs, held).collect()}
    out = [r for r in a.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    other = docs.withColumn("text", F.when(held & (F.col("doc_id") % 2 == 0), F.lit("other words here")).otherwise(F.col("text")))
    b = {r.doc_id: r for r in lm.score_documents(other, held).collect()}
    same = [i for i, r in a.items() if not (r.held_out and i % 2 == 0)]
    assert max(abs(a[i].score - b[i].score) / (1 + abs(a[i].score)) for i in same) < 1e-6


def test_lm_shards_answer_in_pieces(spark, monkeypatch):
    rng = random.Random(5)
    pairs = sorted({bytes([rng.randint(0, 2)]) + "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 9))).encode() for _ in range(400)})
    rows = spark.createDataFrame([(zlib.crc32(p[1:]) % 3, bytearray(p), i, i) for i, p in enumerate(pairs)], "block int, pair binary, n long, known long")
    found = []
    for keys in (1 << 18, 50):
        monkeypatch.setattr(lm, "ANSWER_KEYS", keys)
        found.append({r["block"]: lm.unpacked_sums(r["sums"], r["size"]).tolist() for r in lm.counted_blocks(rows, 2).collect()})
    assert found[0] == found[1] and len(found[0]) == 3


def test_lm_holds_one_block_at_a_time():
    words = [b"\0ab", b"\1abc", b"\0b"]
    block = lm.Counted(*lm._tokens_of(words))
    sums = lm.prefix_sums(block.keys, block.own(np.array([1, 2, 3])))
    row = {"pairs": words, "n": [1, 2, 3], "known": [1, 2, 3], "size": len(block.keys), "sums": lm.packed_sums(sums)}
    found = lm._blocks_of(pa.Table.from_pylist([row, row]))
    for _, _, _, b in found:
        assert b.sums.tolist() == sums.tolist()
        assert sum(x.nbytes for part in b.evidence(False) for x in part) <= 8 * 6 * len(block.keys)
        gone = weakref.ref(b)
        del b, _
        assert gone() is None


def test_lm_counts_are_exact_and_grow_with_the_words(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_KEYS", 1 << 12)
    rng = random.Random(4)
    pairs = sorted({bytes([rng.randint(0, 2)]) + "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 9))).encode() for _ in range(900)})
    counts = [0 if i % 5 == 0 else 2 ** 40 + i if i % 7 == 0 else i for i in range(len(pairs))]
    rows = spark.createDataFrame([(zlib.crc32(p[1:]) % 3, bytearray(p), n, n) for p, n in zip(pairs, counts)], "block int, pair binary, n long, known long")
    blocks = {r["block"]: r for r in lm.counted_blocks(rows, 5).collect()}
    assert sorted(bytes(p) for r in blocks.values() for p in r["pairs"]) == pairs
    whole = lm.Counted(*lm._tokens_of(pairs))
    want = dict(zip(whole.keys.tolist(), lm.prefix_sums(whole.keys, whole.own(np.array(counts))).T.tolist()))
    for r in blocks.values():
        got = lm.Counted(*lm._tokens_of([bytes(p) for p in r["pairs"]]), lm.unpacked_sums(r["sums"], r["size"]))
        assert [want[k] for k in got.keys.tolist()] == got.sums.T.tolist()
    # by hand: what follows the whole token's first bytes, whatever the class
    after = Counter()
    for p, n in zip(pairs, counts):
        for i, byte in enumerate(p[1:] + b" "):
            for k in range(9):
                after[p[1:][:i], k, byte >> (8 - k)] += n
    at, c = 0, 6
    for p in pairs:
        for i, byte in enumerate(p[1:] + b" "):
            assert want[int(whole.keys[whole.at[c, at]])] == [after[p[1:][:i], k, byte >> (8 - k)] for k in range(9)]
            at += 1


def test_bit_costs_are_a_distribution():
    words = [b"ab", b"abc", b"b", b"xyz", b"cd", lm.END_TOKEN]
    classes, counts = np.array([0, 1, 0, 2, 0, 1]), np.array([5, 3, 2, 1, 1, 4])
    table = np.zeros(2 * lm.SLOTS, dtype=np.float32)
    lm.count_bits(words, classes, counts, table)
    mixer = lm.Mixer(table.astype("<u2").view("<u4"))
    for _ in range(20):
        mixer.learn(words, classes, counts)
    # all words of one byte, each followed by its space, and the end mark: shares of one whole
    every = [bytes([b]) for b in range(256) if b not in (0x20, 0x0A)] + [lm.END_TOKEN]
    assert sum(2.0 ** -mixer.bits_of(every, np.zeros(len(every), dtype=int))) <= 1.0
    cost = mixer.bits_of([b"ab", b"zz"], np.zeros(2, dtype=int))
    assert cost[0] < cost[1]


def test_classes_follow_the_text():
    groups = {b"the": 1, b"of": 1, b"der": 2, b"und": 2}
    got = lm.classed_tokens(b"x The der UND of y und z", groups)
    assert [t[0] for t in got] == [0, 0, 1, 1, 2, 1, 1, 2, 2] and [t[1:] for t in got] == lm.plain_tokens(b"x The der UND of y und z")
    assert lm.classed_tokens(b"", groups) == [b"\0\n"] and lm.classed_tokens(b"a", {}) == [b"\0a", b"\0\n"]


# --- decontamination ---------------------------------------------------------------------------------


def slow_contamination(rows, items, width, share):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = [(i, tuple(w[k:k + width])) for i, t in items for w in [words(t)] if w for k in range(max(1, len(w) - width + 1))]
    out = []
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for i, p in windows:
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k:k + len(p)]) == p:
                    hit.update(range(k, k + len(p)))
                    found.add(i)
        out.append((d, len(w), len(hit), sorted(str(i) for i in found if i is not None), bool(hit) and share * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("bound", [decontam.BROADCAST_BYTES, 0])
def test_decontamination(spark, monkeypatch, bound):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", bound)
    rng = random.Random(3)
    vocab = ["the", "of", "a", "été", "x1", "日本", "stone", "river"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 5, 9])))) for i in range(12)]
    items += [(50, None), (51, "!!!"), (52, ""), (None, "river river river"), (3, items[3][1]), (53, "the the the the the")]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 4, 30, 80])))) for i in range(30)]
    rows += [(i + 100, "Lead-in, " + t.upper().replace(" ", ", ") + "! tail") for i, t in items if t and i is not None]
    rows += [(900, None), (901, "..."), (None, items[1][1]), (4, rows[4][1]), (4, rows[4][1]), (902, "the " * 5000), (903, "zebra " * 50 + items[2][1])]
    docs, bench = rows_of(spark, rows), spark.createDataFrame([(i, t, "q") for i, t in items], "item_id long, text string, phrase string")
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in decontam.contamination(docs, bench, width=5).collect()]
    want = slow_contamination(rows, items, 5, 20)
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    left = decontam.drop_contaminated(docs, bench, width=5)
    assert left.columns == docs.columns
    assert sorted(map(repr, (r.doc_id for r in left.collect()))) == sorted(repr(i) for i, _, _, _, bad in want if not bad)
    none = decontam.contamination(docs, bench.where("false"), width=5).collect()
    assert len(none) == len(rows) and not any(r.n_hit for r in none)
    assert decontam.contamination(docs.where("false"), bench, width=5).count() == 0


def test_proximity(spark):
    docs = rows_of(spark, [(1, "a x x b x x x x x a"), (2, "b a"), (3, "a"), (4, None)])
    dw = decontam.keyed_words(docs, "doc_id", "text")
    index = decontam.positional_index(dw, spark.createDataFrame([("a",), ("b",)], "term string"), 2)
    near = decontam.proximity_matches(index, spark.createDataFrame([("a", "b")], "a string, b string"), 3)
    ids = {(r[decontam.KEY_ID], r.pos_a, r.pos_b) for r in near.collect()}
    assert ids == {(1, 0, 3), (2, 1, 0)}


def test_decontamination_runs_no_python(spark):
    plan = plans.op7_decontamination(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- chat --------------------------------------------------------------------------------------------


def tree_rows(spark, rows):
    return spark.createDataFrame(rows, "tree long, msg long, parent long, role string, text string, score double")


def test_reply_trees(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 1.0), (1, 3, 1, "assistant", "good", 5.0),
            (1, 4, 3, "user", "more", 0.0), (1, 5, 4, "assistant", "end", None), (1, 6, 2, "user", "z", 9.0),
            (2, 1, 99, "user", None, 1.0), (2, 1, 99, "user", None, 1.0), (None, 7, None, None, "x\\<|im_end|>", 1.0), (3, 1, 1 - 1, "a\\n\nb", "", 0.0)]
    rows += [(4, i, i - 1 if i else None, "user" if i % 2 else "assistant", f"t{i}", 0.0) for i in range(70)]
    messages = tree_rows(spark, rows)
    paths = {}
    for r in chat.reply_paths(messages.withColumn("tree", F.coalesce("tree", F.lit(chat.NO_TREE)))).collect():
        paths.setdefault((r.tree, r.leaf), []).append((r.up, r.msg))
    assert [m for _, m in sorted(paths[1, 5])] == [5, 4, 3, 1] and [m for _, m in sorted(paths[1, 6])] == [6, 2, 1]
    assert [m for _, m in sorted(paths[4, 69])] == list(range(69, -1, -1)) and len(paths) == 6
    out = {(r.tree, r.branch): r for r in chat.format_trees(messages, branches=2).select(
        "tree", "branch", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss")).alias("lossy")).collect()}
    assert [(t.role, t.text) for t in out[1, 1].turns] == [("user", "q"), ("assistant", "bad"), ("user", "z")]
    assert [(t.role, t.text) for t in out[1, 2].turns] == [("user", "q"), ("assistant", "good"), ("user", "more"), ("assistant", "end")]
    assert out[1, 2].lossy == "goodend" and (1, 3) not in out
    assert [(t.role, t.text) for t in out[2, 1].turns] == [("user", "")]
    assert [(t.role, t.text) for t in out[None, 1].turns] == [("", "x\\<|im_end|>")]
    assert [(t.role, t.text) for t in out[3, 1].turns] == [("a\\n\nb", "")]
    assert out[4, 1].lossy == "".join(f"t{i}" for i in range(0, 70, 2))
    with pytest.raises(ValueError):
        chat.reply_paths(tree_rows(spark, [(1, 1, 2, "u", "x", 0.0), (1, 2, 1, "u", "y", 0.0), (1, 3, 1, "u", "y", 0.0)]))


def test_chat_round_trip(spark):
    rng = random.Random(5)
    pieces = ["<|", "|>", "\\", "\\\\", "<\\|", "im_end", "<|im_end|>\n", "<|im_start|>", "\n", "é", "n", "|", "<", "$1"]
    rows = [(c, t, rng.choice(["user", "assistant", "a\\nb", "x\ny", "\\"]), "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))))
            for c in range(40) for t in range(rng.randint(1, 6))]
    rows += [(100, 0, "assistant", None), (101, 0, None, "x"), (None, 1, "user", "n"), (102, 0, "assistant", "long " * 40000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.tree: r for r in chat.format_trees(chat.thread_messages(df)).select(
        "tree", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("lossy")).collect()}
    for c in {r[0] for r in rows}:
        own = [(r or "", t or "") for cc, _, r, t in sorted((x for x in rows if x[0] == c), key=lambda x: x[1])]
        assert [(t.role, t.text) for t in got[c].turns] == own
        assert got[c].lossy == "".join(t for r, t in own if r == "assistant")
    assert chat.format_trees(chat.thread_messages(df.where("false"))).count() == 0


# --- pipeline ----------------------------------------------------------------------------------------


def test_pipeline_stages_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, current = docs.columns, docs
    tables = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, folder).cache()
        assert current.columns == columns and current.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        tables.append({r.doc_id: r for r in current.collect()})
    kept, lined, near, clean = tables
    given = {r.doc_id: r for r in docs.collect()}
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    bad, good = {i for i, q in marks.items() if q == 0}, {i for i, q in marks.items() if q == 1}
    assert set(kept) <= set(given)
    assert len(bad & set(kept)) <= 0.5 * len(bad) and len(good - set(kept)) <= 0.02 * len(good)
    want = {i: (d, h) for i, _, d, h in slow_lines([(i, r.text) for i, r in kept.items()], 10, 1)}
    assert set(lined) == set(kept)
    for i, r in lined.items():
        assert hashlib.sha256(r.text.encode()).hexdigest() == want[i][1] and r.n_chars == len(r.text)
    ids, fps = list(lined), [slow_fingerprint(lined[i].text) for i in lined]
    assert set(near) == set(slow_components(ids, fps, 2).values())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    flagged = {i for i, _, _, _, c in slow_contamination([(i, r.text) for i, r in near.items()], items, 13, 20) if c}
    assert set(clean) == set(near) - flagged
    out = corpus_pipeline.STAGES[-1][1](spark, current, folder).collect()
    assert {r.doc_id for r in out} == set(clean) and all(len(r.ids) == r.n_tokens for r in out)


def test_pipeline_edge_cases(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, __x string, fp string"
    rows = [(1, None, "en", "s", None, "a", "b"), (2, "", None, None, 0, "a", "b"), (None, "one text here", "en", "s", 13, "a", "b"),
            (3, "one text here", "en", "s", 13, "a", "b"), (3, "one text here", "en", "s", 13, "a", "b"), (4, "word " * 20000, "en", "s", 100000, "a", "b")]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        got = docs.collect()
        assert len([r for r in got if r.doc_id == 3]) == (1 if data else 0) and not any(r.doc_id is None for r in got)
