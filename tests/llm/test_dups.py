"""SimHash components and line dedup against brute force, with the edge cases each operator defines."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import xxhash

from corpusprep.llm.lines import LineCounts, MinimalPerfectHash, drop_frequent_lines
from corpusprep.llm.simhash import fingerprint_of, hamming_links, simhash_components

SCHEMA = "doc_id long, text string, source string, fp string, n_lines string"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "s", "x", "y") for i, t in texts], SCHEMA)


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, fps, distance):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    u = sorted(set(fps))
    for i, a in enumerate(u):
        for b in u[i + 1:]:
            if bin(a ^ b).count("1") <= distance:
                root[find(a)] = find(b)
    small = defaultdict(list)
    for i, f in zip(ids, fps):
        small[find(f)].append(i)
    return {(i, f): min((x for x in small[find(f)] if x is not None), default=None) for i, f in zip(ids, fps)}


def test_fingerprint_long_and_odd_texts():
    rng = random.Random(1)
    words = ["Aé", "b", "ccc", "ÉX", "d\x1fe"]
    for n in (0, 1, 2, 3, 4, 700, 3000):
        text = "".join(rng.choice(words) + rng.choice([" ", "\n", "\t\x0b ", "\r"]) for _ in range(n))
        assert fingerprint_of(text.encode()) == slow_fingerprint(text)


def test_links_find_every_pair_through_split_nodes(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    codes = set(base)
    for b in base[:20]:
        for _ in range(40):
            codes.add(b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(1, 4))))
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    fps = spark.createDataFrame([(c,) for c in signed], "fp long")
    want = slow_components(codes, codes, 2)
    for limit in (4096, 5):  # the small limit sends nodes down all levels
        links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in hamming_links(fps, 2, limit).collect()]
        assert all(bin(a ^ b).count("1") <= 64 for a, b in links)
        root = {c: c for c in codes}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in links:
            root[find(a)] = find(b)
        got = defaultdict(set)
        for c in codes:
            got[find(c)].add(c)
        slow = defaultdict(set)
        for (i, _), m in want.items():
            slow[m].add(i)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, slow.values()))


def test_simhash_components(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    texts = []
    for g in range(12):
        words = [rng.choice(vocab) for _ in range(300)]
        for _ in range(5):
            w = list(words)
            w[rng.randrange(300)] = "edit"
            texts.append(" ".join(w))
    texts += [texts[0]] * 3 + [None, "", "  \n", "one", "ONE", "x " * 20000]
    rows = list(enumerate(texts)) + [(None, "only null ids"), (None, texts[0]), (0, texts[0]), (0, texts[0])]
    got = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash_components(docs_of(spark, rows)).collect()]
    fps = [slow_fingerprint(t) for _, t in rows]
    want = slow_components([i for i, _ in rows], fps, 2)
    assert sorted(map(repr, got)) == sorted(repr((i, f, want[i, f])) for (i, _), f in zip(rows, fps))
    assert simhash_components(docs_of(spark, [])).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 20000).astype(np.uint64))
    index = MinimalPerfectHash(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
    counts = LineCounts(np.concatenate([keys, keys[:100]]), np.ones(len(keys) + 100))
    assert counts.count(keys[:100]).tolist() == [2] * 100 and set(counts.count(keys[100:]).tolist()) == {1}
    assert counts.count(keys[:50] ^ np.uint64(1 << 40)).max() == 0
    assert MinimalPerfectHash(keys[:0]).slots(keys[:3]).tolist() == [-1] * 3


def slow_lines(rows, min_docs, min_chars):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip("\x20\t\n\r\x0b\x0c"))
    seen = defaultdict(int)
    for _, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            seen[k] += 1
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < max(1, min_chars) or seen[key(x)] < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_drop_frequent_lines(spark):
    rng = random.Random(5)
    pool = ["Common Line", " common line\t", "ÉCLAIR", "éclair", "", "   ", "é", "x", "tie"] + [f"line {i}" for i in range(30)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12)))) for i in range(60)]
    rows += [(900, None), (901, ""), (902, "\n\n"), (None, "Common Line"), (5, rows[5][1]), (5, rows[5][1]),
             (903, "\n".join(["long"] * 30000))]
    df = docs_of(spark, rows)
    for min_docs, min_chars, block in ((10, 1, 8 << 20), (3, 2, 300), (1, 1, 1000)):
        got = drop_frequent_lines(df, min_docs=min_docs, min_chars=min_chars, block_bytes=block)
        assert got.columns == ["doc_id", "text", "source", "fp", "n_lines", "n_dropped"]
        have = [(r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in got.collect()]
        assert sorted(map(repr, have)) == sorted(map(repr, slow_lines(rows, min_docs, min_chars)))
        assert got.where("doc_id = 900 and text is null").count() == 1
    assert drop_frequent_lines(docs_of(spark, [])).count() == 0


# --- repeated byte strings ---------------------------------------------------------------------------


def slow_cut(texts, span):
    seen = defaultdict(int)
    data = [(t or "").encode() for t in texts]
    for t in data:
        for i in range(len(t) - span + 1):
            seen[t[i:i + span]] += 1
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - span + 1):
            if seen[t[i:i + span]] > 1:
                gone[i:i + span] = b"\1" * span
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def planted_texts():
    rng = random.Random(7)

    def fresh(n):
        return "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    passage, other = fresh(90), fresh(40)
    texts = [fresh(rng.randint(0, 200)) for _ in range(20)]
    texts += [fresh(30) + passage + fresh(30) for _ in range(6)] + [fresh(10) + passage[20:70] + other for _ in range(4)]
    texts += [texts[0]] * 3 + [other + fresh(15) + other, "a" * 300, "ab" * 80, None, "", "x", passage[:39], passage[:40]]
    for _ in range(25):  # many variants of one passage, so that its anchors fill several shards
        at = rng.randrange(80)
        texts.append(passage[:at] + rng.choice("XYZ") + passage[at + 1:] + fresh(5))
    return texts


def test_cut_repeats(spark):
    from corpusprep.llm.suffix import cut_repeats
    texts = planted_texts()
    rows = list(enumerate(texts)) + [(None, "null id " * 9), (3, texts[3]), (3, texts[3])]
    for span, gram, shard in ((40, 10, 1 << 20), (40, 10, 200), (24, 24, 1 << 20), (300, 5, 1 << 20)):
        got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
               for r in cut_repeats(docs_of(spark, rows), span=span, gram=gram, block_bytes=2000, shard_bytes=shard).collect()]
        want = [(i, *w) for (i, _), w in zip(rows, slow_cut([t for _, t in rows], span))]
        assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert cut_repeats(docs_of(spark, [])).count() == 0


def test_suffix_array_and_prefixes():
    from corpusprep.llm.suffix import Shard, eight_bytes, neighbour_prefixes, suffix_array
    rng = np.random.default_rng(4)
    for data in (rng.integers(97, 99, 500).astype(np.uint8), np.frombuffer(b"a" * 200, np.uint8), np.frombuffer(b"abc" * 60, np.uint8)):
        raw = data.tobytes()
        order = suffix_array(data, 64).tolist()
        assert sorted(order) == list(range(len(raw)))
        heads = [raw[i:i + 64] for i in order if i + 64 <= len(raw)]
        assert heads == sorted(heads)
        shard = Shard([raw], 64)
        before = np.full(len(shard.starts), -1)
        before[shard.sorted[1:]] = shard.sorted[:-1]
        lcp = neighbour_prefixes(shard.eight, shard.starts, before, 64, stride=8)
        for i, b, n in zip(shard.starts.tolist(), before.tolist(), lcp.tolist()):
            if b >= 0:
                a, c = raw[i:i + 64], raw[b:b + 64]
                assert n == next((k for k in range(64) if a[k] != c[k]), 64)
    assert eight_bytes(np.zeros(0, np.uint8)).tolist() == []


def test_shards_merge_by_search():
    from corpusprep.llm.suffix import Shard
    rng = random.Random(8)
    a = ["".join(rng.choice("ab") for _ in range(30)).encode() for _ in range(20)]
    b = ["".join(rng.choice("ab") for _ in range(30)).encode() for _ in range(20)]
    left, right = Shard(a, 9), Shard(b, 9)
    left.mark_across(right)
    there = {t[i:i + 9] for t in b for i in range(22)}
    want = [t[i:i + 9] in there for t in a for i in range(22)]
    assert left.marked.tolist() == want


def test_marks_inside_a_shard_of_overlapping_slices():
    """Slices of one text, with many starts that agree in more bytes than are sorted, against all substrings."""
    from corpusprep.llm.suffix import Shard
    rng = random.Random(12)
    for _ in range(240):
        span = rng.choice([5, 9, 16, 40])
        base = bytes(rng.choice(b"ab") if rng.random() < 0.5 else rng.choice(b"abcdefgh") for _ in range(rng.randrange(60, 400)))
        texts = []
        for _ in range(rng.randrange(2, 9)):
            at = rng.randrange(len(base) - span)
            t = bytearray(base[at:at + rng.randrange(span, 300)])
            if rng.random() < 0.5 and len(t) > span:
                t[rng.randrange(len(t))] = ord("z")
            if len(t) >= span:
                texts.append(bytes(t))
        places = defaultdict(list)
        for i, t in enumerate(texts):
            for k in range(len(t) - span + 1):
                places[t[k:k + span]].append((i, k))
        want = sorted(p for v in places.values() if len(v) > 1 for p in v)
        shard = Shard(texts, span)
        shard.mark_inside()
        text, first, sizes = shard.runs()
        assert sorted((i, k) for i, f, n in zip(text.tolist(), first.tolist(), sizes.tolist()) for k in range(f, f + n)) == want


def test_repeats_with_heavy_keys(spark):
    """One passage in most texts, alone and beside others, so that its anchors are heavy."""
    from corpusprep.llm.suffix import cut_repeats
    rng = random.Random(13)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(90))
    texts = [passage if i % 3 else f"{i} " + passage[:rng.randrange(20, 90)] + "".join(rng.choice("xyz") for _ in range(30)) for i in range(120)]
    got = {r["doc_id"]: (r["n_removed"], bytes(r["kept"]).decode()) for r in cut_repeats(docs_of(spark, list(enumerate(texts))), span=16).collect()}
    seen = defaultdict(int)
    for t in texts:
        for k in range(len(t) - 15):
            seen[t[k:k + 16]] += 1
    for i, t in enumerate(texts):
        gone = {p for k in range(len(t) - 15) if seen[t[k:k + 16]] > 1 for p in range(k, k + 16)}
        assert got[i] == (len(gone), "".join(c for p, c in enumerate(t) if p not in gone))
