import math
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from corpusprep.operators import vocab as vb


def freqs(spark):
    # the classic BPE teaching corpus: word counts
    rows = [("hug", 10), ("pug", 5), ("pun", 12), ("bun", 4), ("hugs", 5)]
    return spark.createDataFrame(rows, "word string, count long")


def test_bpe_learn_and_encode(spark):
    merges, alphabet = vb.learn_bpe(freqs(spark), 3)
    m = [(r["left"], r["right"], r["freq"]) for r in merges.orderBy("rank").collect()]
    assert m[0] == ("u", "g", 20) and m[1] == ("u", "n", 16) and m[2] == ("h", "ug", 15)
    assert sorted(r[0] for r in alphabet.collect()) == ["b", "g", "h", "n", "p", "s", "u"]
    docs = spark.createDataFrame([(1, "hugs bun")], "k long, t string")
    enc = vb.encode_bpe(docs, "t", "k", merges).first()
    assert enc["tokens"] == ["hug", "s", "b", "un"] and enc["word_ids"] == [0, 0, 1, 1]


def test_byte_level(spark):
    merges, alphabet = vb.learn_bpe(freqs(spark), 1, byte_level=True)
    assert merges.first()["left"] == "75" and merges.first()["right"] == "67"  # 'u' 'g' as UTF-8 hex
    df = spark.createDataFrame([("é",)], "s string")
    assert df.select(vb.byte_units("s").alias("b")).first()["b"] == ["C3", "A9"]


def test_wordpiece(spark):
    v = vb.learn_wordpiece(freqs(spark), 1 << 20, max_merges=2)
    toks = [r["token"] for r in v.orderBy("id").collect()]
    assert toks[:5] == [vb.PAD, vb.UNK, vb.CLS, vb.SEP, vb.MASK] and "##u" in toks
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate(["[UNK]", "hug", "##s", "b", "##u", "##n"])], "token string, id int")
    docs = spark.createDataFrame([(1, "hugs bun xyz")], "k long, t string")
    enc = vb.encode_wordpiece(docs, "t", "k", vocab).first()
    assert enc["tokens"] == ["hug", "##s", "b", "##u", "##n", "[UNK]"]
    ids = vb.to_ids(enc_df := vb.encode_wordpiece(docs, "t", "k", vocab), vocab, "tokens", "ids").first()["ids"]
    assert ids == [1, 2, 3, 4, 5, 0]
    dec = vb.decode(vb.to_ids(enc_df, vocab, "tokens", "ids"), vocab, "ids").first()["text"]
    assert dec == "hugs bun"


def test_unigram(spark):
    units = vb.prune_unigram(freqs(spark), 12, seed_size=10)
    n = units.count()
    assert n <= 12 and units.where(F.length("unit") == 1).count() == 7
    enc = vb.encode_unigram(spark.createDataFrame([(1, "hugs")], "k long, t string"), "t", "k", units).first()
    assert "".join(enc["tokens"]) == "hugs"


def test_word_vocab_and_frequencies(spark):
    docs = spark.createDataFrame([(1, "a b, a.")], "k long, t string")
    f = {r["word"]: r["count"] for r in vb.word_frequencies(docs, "t").collect()}
    assert f == {"a": 2, "b": 1, ",": 1, ".": 1}
    v = {r["token"]: r["id"] for r in vb.word_vocab(vb.word_frequencies(docs, "t"), 2).collect()}
    assert v["a"] == 1000 and v[","] == 1001 and v["[UNK]"] == 100 and "b" not in v


def test_single_token(spark):
    enc = spark.createDataFrame([("x", ["x"]), ("yy", ["y", "##y"])], "word string, tokens array<string>")
    out = {r["word"]: r["single"] for r in vb.single_token_ids(enc).collect()}
    assert out == {"x": True, "yy": False}


def test_offsets(spark):
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate(["[UNK]", "hug", "##s", "b", "##u", "##n"])], "token string, id int")
    docs = spark.createDataFrame([(1, "hugs,  bun xyz")], "k long, t string")
    r = vb.encode_wordpiece(docs, "t", "k", vocab).first()
    spans = [(o["start"], o["end"]) for o in r["offsets"]]
    assert r["tokens"] == ["hug", "##s", "[UNK]", "b", "##u", "##n", "[UNK]"]
    assert spans == [(0, 3), (3, 4), (4, 5), (7, 8), (8, 9), (9, 10), (11, 14)]


def one_at_a_time(counts, merges):
    """BPE learning by one merge per step over a plain dictionary."""
    words = [(list(w), c) for w, c in counts.items()]
    out = []
    for _ in range(merges):
        pairs = {}
        for sym, c in words:
            for p in zip(sym, sym[1:]):
                pairs[p] = pairs.get(p, 0) + c
        if not pairs:
            break
        (a, b), f = min(pairs.items(), key=lambda x: (-x[1], x[0]))
        out.append((a, b, f))
        for sym, _ in words:
            i = 0
            while i < len(sym) - 1:
                if sym[i] == a and sym[i + 1] == b:
                    sym[i:i + 2] = [a + b]
                i += 1
    return out


def test_batched_bpe_equals_one_merge_at_a_time(spark):
    import random
    rng = random.Random(1)
    syllables = ["an", "the", "re", "ou", "tion", "ll", "aa", "st", "é", "ü"]
    counts = {}
    for _ in range(400):
        w = "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
        counts[w] = counts.get(w, 0) + rng.randint(1, 50)
    counts["aaaaaaa"], counts["ababab"] = 37, 41
    f = spark.createDataFrame(list(counts.items()), "word string, count long")
    got = [(r["left"], r["right"], r["freq"]) for r in vb.learn_bpe(f, 80)[0].orderBy("rank").collect()]
    assert got == one_at_a_time(counts, 80)


def test_long_units_and_words(spark):
    unit = "abcdefghijklmnopqrstuvwxyzabcd"
    assert vb._viterbi(unit, {unit: 1.0, **{c: 5.0 for c in unit}}, 30)[0] == [unit]
    assert vb._wordpiece_segment("x" * 150, {"x", "##x"}, 3) == ["x"] + ["##x"] * 149


def slow_wordpiece(freqs, merges):
    words = {w: [c if i == 0 else "##" + c for i, c in enumerate(w)] for w in freqs}
    out = []
    for _ in range(merges):
        units, pairs = Counter(), Counter()
        for w, n in freqs.items():
            for s in words[w]:
                units[s] += n
            for p in zip(words[w], words[w][1:]):
                pairs[p] += n
        if not pairs:
            break
        a, b = min(pairs, key=lambda p: (-pairs[p] / (units[p[0]] * units[p[1]]), p))
        token = a + b[2:]
        out.append(token)
        for w, s in words.items():
            k, new = 0, []
            while k < len(s):
                if k + 1 < len(s) and (s[k], s[k + 1]) == (a, b):
                    new.append(token)
                    k += 2
                else:
                    new.append(s[k])
                    k += 1
            words[w] = new
    return out


def random_freqs(seed, words, letters, longest=9):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randrange(1, longest))): rng.choice([1, 1, 1, 2, 3, 7, 40]) for _ in range(words)}


def test_wordpiece_rounds_equal_one_merge_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(vb, "WP_PAIRS", 24)
    monkeypatch.setattr(vb, "WP_WORDS", 40)
    for seed, letters, merges in ((1, "abcdefg", 60), (2, "ab", 25), (3, "abcdefghijklmnopqrstuvwxyz", 60)):
        table = random_freqs(seed, 120, letters)
        v = vb.learn_wordpiece(spark.createDataFrame(list(table.items()), "word string, count long"), 1 << 20, specials=(), max_merges=merges)
        alphabet = {c if i == 0 else "##" + c for w in table for i, c in enumerate(w)}
        want = sorted(alphabet) + slow_wordpiece(table, merges)
        assert [r["token"] for r in v.orderBy("id").collect()] == list(dict.fromkeys(want))


def slow_seed(freqs, size):
    count, follow = Counter(), defaultdict(set)
    for w, n in freqs.items():
        for i in range(len(w)):
            for j in range(i + 1, len(w) + 1):
                count[w[i:j]] += n
                follow[w[i:j]].add(w[j:j + 1])
    multi = [u for u in count if len(u) > 1 and count[u] > 1 and (len(follow[u]) > 1 or "" in follow[u])]
    multi.sort(key=lambda u: (-count[u] * len(u), u))
    return {u: float(count[u]) for u in [u for u in count if len(u) == 1] + multi[:size]}


def segmentations(word, units):
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        if word[:k] in units:
            for rest in segmentations(word[k:], units):
                yield [word[:k], *rest]


def slow_unigram(freqs, size, seed_size, share=0.1):
    units = slow_seed(freqs, seed_size)

    def probabilities():
        total = sum(units.values())
        return {u: f / total for u, f in units.items()}

    def cost(s, p):
        return -sum(math.log(p[u]) for u in s)
    while True:
        p, expected = probabilities(), Counter()
        for w, n in freqs.items():
            every = list(segmentations(w, p))
            weight = [math.exp(-cost(s, p)) for s in every]
            for s, x in zip(every, weight):
                for u in s:
                    expected[u] += n * x / sum(weight)
        units = {u: max(expected[u], 1e-3) for u in units}
        if len(units) <= size:
            return units
        p, loss = probabilities(), Counter()
        for w, n in freqs.items():
            every = list(segmentations(w, p))
            best = min(every, key=lambda s: cost(s, p))
            for u in {u for u in best if len(u) > 1}:
                loss[u] += n * (min(cost(s, p) for s in every if u not in s) - cost(best, p))
        multi = sorted((u for u in units if len(u) > 1), key=lambda u: (round(loss[u], 6), u))
        for u in multi[:min(max(1, int(len(units) * share)), len(units) - size)]:
            del units[u]


def test_unigram_seed_is_the_repeated_substrings(spark):
    for seed, letters in ((5, "ab"), (6, "abcé"), (7, "abcdefgh")):
        table = random_freqs(seed, 80, letters) | {"abab": 3, "aaaaaa": 2, "é🙂é🙂": 4}
        for size in (10, 10**6):
            got = {r["unit"]: r["freq"] for r in vb.unigram_seed(spark.createDataFrame(list(table.items()), "word string, count long"), size).collect()}
            assert got == slow_seed(table, size)


def test_unigram_equals_a_slow_loop(spark):
    table = random_freqs(8, 60, "abcd", 7)
    got = {r["unit"]: r["freq"] for r in vb.prune_unigram(spark.createDataFrame(list(table.items()), "word string, count long"), 20, words_per_task=10).collect()}
    want = slow_unigram(table, 20, 80)
    assert set(got) == set(want) and all(abs(got[u] - want[u]) < 1e-6 * max(1, want[u]) for u in want)


def test_byte_level_offsets_cover_their_bytes_and_no_more(spark):
    from corpusprep.operators import sequences as sq
    rng = random.Random(8)
    texts = ["", None, "  ", "naïve café", "日本語 😀😀!", "a😀b é"] + \
        [" ".join("".join(rng.choice("abéß日😀") for _ in range(rng.randrange(1, 9))) for _ in range(6)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    for merges in (0, 3, 40):
        learned, _ = vb.learn_bpe(vb.word_frequencies(docs, "t"), max(merges, 1), byte_level=True)
        enc = vb.encode_bpe(docs, "t", "k", learned.where(F.col("rank") < merges) if merges == 0 else learned, byte_level=True)
        for r in enc.collect():
            text = texts[r["k"]] or ""
            assert len(r["tokens"]) == len(r["offsets"]) == len(r["word_ids"])
            assert bytes.fromhex("".join(r["tokens"])).decode() == "".join(text.split())
            at = {}
            for piece, o, w in zip(r["tokens"], r["offsets"], r["word_ids"]):
                first = at.setdefault(w, [o["start"], 0])
                word = text[first[0]:].encode()
                raw, begin = bytes.fromhex(piece), first[1]
                assert word[begin:begin + len(raw)] == raw
                first[1] += len(raw)
                # Bytes of the word up to either end of the span hold the piece, one character less does not.
                before = len(text[first[0]:o["start"]].encode())
                assert before <= begin < before + len(text[o["start"]].encode())
                after = len(text[first[0]:o["end"]].encode())
                assert after - len(text[o["end"] - 1].encode()) < begin + len(raw) <= after
    row = enc.where("k = 4").select(sq.word_to_chars("offsets", "word_ids", F.lit(0)).alias("w0"),
                                    sq.char_to_word("offsets", "word_ids", F.lit(5)).alias("c5"),
                                    sq.char_to_word("offsets", "word_ids", F.lit(3)).alias("gap")).first()
    assert tuple(row["w0"]) == (0, 3) and row["c5"] == 2 and row["gap"] is None
