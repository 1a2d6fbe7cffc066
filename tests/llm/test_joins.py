"""Token alignment, Jaccard join and whitening against brute force, with the edge cases each operator defines."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from corpusprep.llm import align, partenum, whiten
from corpusprep.llm.plans import BYTE_VOCABULARY, PIECE_VOCABULARY, QUERIES
from tests.conftest import SF0001

SCHEMA = "doc_id long, text string, chunk string, class string, a string, n string, sig string, pair string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "c", "l", "a", "n", "s", "p") for i, t in rows], SCHEMA)


# --- alignment -----------------------------------------------------------------------------------


def test_merge_path_finds_all_shared_ends():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n, m, top = rng.integers(0, 40), rng.integers(0, 40), rng.integers(40, 90)
        a, b = np.sort(rng.choice(top, n, replace=False)), np.sort(rng.choice(top, m, replace=False))
        i, j = align.diagonals(a, b, 7)
        assert i[0] == j[0] == 0 and i[-1] == n and j[-1] == m and (np.diff(i + j)[:-1] == 7).all()
        for piece in (1, 2, 7, 1000):
            cut_a, cut_b = align.shared_ends(a, b, piece)
            assert (a[cut_a] == np.intersect1d(a, b)).all() and (b[cut_b] == np.intersect1d(a, b)).all()


def library_a():
    out = Tokenizer.from_file(BYTE_VOCABULARY)
    out.encode_special_tokens = True
    return out


def slow_alignment(rows):
    library = library_a()
    tok = align.two_tokenizers(BYTE_VOCABULARY, PIECE_VOCABULARY)
    docs = []
    for i, t in rows:
        whole = (" " + (t or "")).encode()
        a = library.encode(" " + t, add_special_tokens=False).ids if t else []
        b = tok.b.encode(t) if t else []
        if b"".join(tok.bytes_a[x] for x in a) != whole or b"".join(tok.bytes_b[x] for x in b) != whole:
            a, b = [], []
        groups, at_a, at_b, x, y = [([], [])], 0, 0, 0, 0
        while x < len(a) or y < len(b):
            if at_a <= at_b:
                groups[-1][0].append(a[x])
                at_a, x = at_a + len(tok.bytes_a[a[x]]), x + 1
            else:
                groups[-1][1].append(b[y])
                at_b, y = at_b + len(tok.bytes_b[b[y]]), y + 1
            if at_a == at_b:
                groups.append(([], []))
        docs.append((i, len(a), len(b), groups[:-1]))
    held = Counter(p for d in docs for p in {(x, y) for g in d[3] for x in g[0] for y in g[1]})
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for i, n_a, n_b, groups in docs:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((i, n_a, n_b, len(groups), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
                    text, hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


def aligned(spark, rows, piece=align.PIECE):
    return [tuple(r) for r in align.align_documents(docs_of(spark, rows), BYTE_VOCABULARY, PIECE_VOCABULARY, piece=piece).collect()]


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


ODD_TEXTS = ["", None, " ", "  ", " a", "a ", "a  b", "a \n b", "\n", "\t\tx  y\n\n\nz", "naïve façade — “quotes” 北京 🙂🙂 é", "a▁b", "x ▁ y",
             "<s> </s> <unk> <0x41>", "<|endoftext|> a<|endoftext|>", "\x00 \x1c a\x85b \xa0 c", "don't  stop　now   z", "1234567 89,00", "a" * 300, "ab " * 500,
             "    " * 50 + "end", "﻿ bom", "the  the the"]


def test_alignment_equals_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(3, "repeated row"), (3, "repeated row"), (None, "no id"), (None, None)]
    texts = [r["text"] for r in spark.read.parquet(SF0001 + "/documents.parquet").select("text").limit(60).collect()]
    rows += [(100 + i, t) for i, t in enumerate(texts)]
    assert key(aligned(spark, rows)) == key(slow_alignment(rows))
    assert key(aligned(spark, rows[:30], piece=5)) == key(slow_alignment(rows[:30]))


def test_alignment_of_wide_groups_counts_distinct_ids(monkeypatch, spark):
    tok = align.two_tokenizers(BYTE_VOCABULARY, PIECE_VOCABULARY)
    text = "straße çedille Œuvre 한국어 " * 3
    ids = tok.encode([text])
    whole = align.Aligned(tok, *ids).linked_pairs()
    monkeypatch.setattr(align, "WIDE_LINKS", 1)
    assert all((x == y).all() for x, y in zip(whole, align.Aligned(tok, *ids).linked_pairs()))


def test_alignment_of_an_empty_table(spark):
    assert aligned(spark, []) == []


def test_alignment_cache_is_emptied(monkeypatch):
    tok = align.TwoTokenizers(BYTE_VOCABULARY, PIECE_VOCABULARY)
    first = [x.tolist() for x in tok.encode(["one two", "three"])]
    monkeypatch.setattr(align, "CACHE_ENTRIES", 0)
    assert [x.tolist() for x in tok.encode(["one two", "three"])] == first
    tok.a, tok.ranked = library_a(), None  # a file that is no plain byte-level BPE goes through the library
    tok.clear()
    assert [x.tolist() for x in tok.encode(["one two", "three"])] == first


# --- Jaccard join --------------------------------------------------------------------------------


def slow_set(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def slow_join(rows, percent=85):
    sets = [slow_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    by_size = sorted(range(len(rows)), key=lambda i: len(sets[i]))
    for at, i in enumerate(by_size):
        for j in by_size[at + 1:]:
            if 100 * len(sets[i]) < percent * len(sets[j]):
                break
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    small = defaultdict(list)
    for i, (name, _) in enumerate(rows):
        small[find(i)].append(name)
    return [(name, len(sets[i]), min((x for x in small[find(i)] if x is not None), default=None)) for i, (name, _) in enumerate(rows)]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        k = rng.randrange(3)
        at = rng.randrange(len(words))
        if k == 0:
            words[at] = f"x{rng.randrange(10**6)}"
        elif k == 1:
            words.insert(at, f"y{rng.randrange(10**6)}")
        elif len(words) > 1:
            del words[at]
    return words


def near_texts(rng, groups=40):
    rows = []
    for g in range(groups):
        n = rng.choice([1, 2, 4, 6, 8, 10, 14, 20, 40, 80, 200, 500])
        base = [f"w{rng.randrange(3000)}" for _ in range(n)]
        for _ in range(rng.randrange(1, 7)):
            rows.append(" ".join(edited(rng, base, rng.randrange(0, max(2, n // 22)))))
    return rows


def test_sets_linked_by_the_threshold_share_a_signature():
    rng = random.Random(3)
    tried = 0
    for _ in range(2500):
        n = rng.choice([*range(5, 30), 60, 150, 400])
        base = [rng.getrandbits(64) for _ in range(n)]
        drop, add = rng.randrange(0, n // 5 + 2), rng.randrange(0, n // 5 + 2)
        other = base[drop:] + [rng.getrandbits(64) for _ in range(add)]
        x, y = set(base), set(other)
        if x == y or 100 * len(x & y) < 85 * len(x | y):
            continue
        tried += 1
        a, b = (partenum.signatures(np.array(sorted(s), dtype=np.uint64)) for s in (x, y))
        assert len(np.intersect1d(a, b))
    assert tried > 300


def test_sparse_sets_go_to_further_divisions(monkeypatch):
    monkeypatch.setattr(partenum, "PARTS", 3)
    rng = np.random.default_rng(5)
    more = 0
    for _ in range(400):
        x = np.unique(rng.integers(0, 1 << 63, 13).astype(np.uint64))
        plain = sum(partenum.partitions(int(k))[0] * 3 for k in (2, 1))
        more += len(partenum.signatures(x)) > plain
    assert more


def joined(spark, rows, **kw):
    return [tuple(r) for r in partenum.jaccard_components(docs_of(spark, rows), **kw).collect()]


def test_jaccard_components_equal_brute_force(spark):
    rng = random.Random(4)
    texts = near_texts(rng)
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(1000, ""), (1001, None), (1002, " \n "), (1003, "ONE two"), (1004, "one TWO"), (1005, "one"), (None, texts[0]), (None, ""),
                                     (2000, texts[3]), (2000, texts[3])]
    assert key(joined(spark, rows)) == key(slow_join(rows))
    assert key(joined(spark, rows, percent=60)) == key(slow_join(rows, 60))


def test_jaccard_chains_need_pairs_inside_a_signature(spark):
    """Texts that slide along one sequence: only neighbours link, and many share signatures."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 6:i * 6 + 100])) for i in range(50)] + [(100 + i, " ".join(words[i * 25:i * 25 + 100])) for i in range(12)]
    assert key(joined(spark, rows)) == key(slow_join(rows))


def test_across_pairs_in_blocks_equal_all_pairs(spark):
    rng = random.Random(6)
    rows = [(s, c, rng.randrange(3), 0, 10, *[0] * 8) for s in range(3) for c in range(40)]
    size = Counter(r[0] for r in rows)
    df = spark.createDataFrame([(s, c, la, size[s], n, *m) for s, c, la, _, n, *m in rows],
                               "sig long, class long, label long, size long, n long, " + ", ".join(f"m{i} long" for i in range(8)))
    want = {(a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1] and a[2] != b[2]}
    for block in (7, 1000):
        assert {tuple(r) for r in partenum.across_pairs(df, 85, block).collect()} == want


def test_jaccard_long_repeated_and_empty(spark):
    long_ = " ".join(f"w{i}" for i in range(60000))
    rows = [(1, long_), (2, long_ + " tail"), (3, "a " * 50000), (4, "a a a a"), (5, long_.replace("w5", "v5"))] + [(9, "same four words here and more")] * 300
    got = joined(spark, rows)
    assert key(got) == key(slow_join(rows))
    assert joined(spark, []) == []


# --- whitening -----------------------------------------------------------------------------------


def slow_whitening(rows, count):
    good = [(i, v) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in good], dtype=np.int64)
    n, s = len(x), x.sum(axis=0)
    centred = (n * x - s) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1][:count], v[:, ::-1][:, :count]
    keep = e > 1e-10 * e[0]
    deviation = [int(sum(int(n * a - b) ** 2 for a, b in zip(row, s))) for row in x]
    return [i for i, _ in good], n, deviation, (centred @ v / np.sqrt(e))[:, keep], e[keep] / np.trace(centred.T @ centred / n)


def check_whitening(got, rows, count):
    names, n, deviation, want, explained = slow_whitening(rows, count)
    place = {i: k for k, i in enumerate(names)}
    assert len(got) == want.size and {r["n"] for r in got} == {n}
    w = np.full(want.shape, np.nan)
    for r in got:
        assert r["deviation"] == deviation[place[r["vec_id"]]]
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-6)
        assert r["identity_error"] < 1e-6
        w[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
    sign = np.sign((w * want).sum(axis=0))
    assert np.abs(w * sign - want).max() < 1e-6


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, b"x", "k") for i, v in rows], "vec_id long, embedding array<float>, n int, cells binary, ids string")


def test_whitening_equals_the_eigenvectors(spark):
    rng = np.random.default_rng(7)
    mixing = rng.normal(size=(12, 12)) * np.linspace(3, 0.3, 12)
    rows = [(i, (rng.normal(size=12) @ mixing).tolist()) for i in range(700)] + [(900, None), (901, [None] * 12), (902, [float("nan")] * 12),
                                                                                  (903, [float("inf")] + [0.0] * 11), (904, [1e30] * 12), (905, [1.0]), (906, [])]
    fit = [r for r in rows if r[0] < 900]
    for count in (5, 32):
        check_whitening(whiten.whiten(vectors_of(spark, rows), count=count).collect(), fit, count)


def test_bidiagonalisation_with_repeated_and_zero_variances():
    rng = np.random.default_rng(8)
    x = np.zeros((64, 9))
    x[:, :6] = np.kron(np.eye(2), np.ones((32, 1)))[:, [0, 1] * 3] * rng.permutation([1, 1, 2, 2, 3, 3])
    for data in (x - x.mean(axis=0), np.vstack([np.eye(6), -np.eye(6)]), rng.normal(size=(4, 7)), np.zeros((3, 4))):
        v, b = whiten.bidiagonalise(lambda y: data.T @ (data @ y), data.shape[1])
        assert np.allclose(v.T @ v, np.eye(data.shape[1]), atol=1e-12)
        assert np.allclose(np.linalg.svd(b)[1][:min(data.shape)], np.linalg.svd(data)[1], atol=1e-9)
        assert np.allclose(v @ b.T @ b @ v.T, data.T @ data, atol=1e-9)


def test_whitening_of_small_and_constant_tables(spark):
    assert whiten.whiten(vectors_of(spark, [])).collect() == []
    assert whiten.whiten(vectors_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    got = whiten.whiten(vectors_of(spark, [(1, [1.0, 2.0]), (2, [2.0, 2.0]), (2, [2.0, 2.0]), (None, [3.0, 2.0])])).collect()
    assert len(got) == 4 and {r["component"] for r in got} == {1} and sum(r["whitened"] ** 2 for r in got) == pytest.approx(4)
    big = whiten.whiten(vectors_of(spark, [(1, [1e12, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 3.0])])).collect()
    assert {r["deviation"] for r in big} >= {None} or len(big)


def test_whitening_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(SF0001 + "/embeddings.parquet").select("vec_id", "embedding").collect()]
    check_whitening(QUERIES["op13_whitening"](spark, SF0001).collect(), rows, 32)


def test_ranked_vocabulary_equals_the_library():
    tok, rng = align.two_tokenizers(BYTE_VOCABULARY, PIECE_VOCABULARY), random.Random(9)
    assert tok.ranked is not None
    letters = "etaoin shrdlu'ES 019.,-_\n\té🙂京"
    texts = [" " + "".join(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(5000)]
    assert [tok.ranked.encode_ordinary(t) for t in texts] == [e.ids for e in library_a().encode_batch_fast(texts, add_special_tokens=False)]


def test_large_signatures_are_compared_in_turns(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(110)]
    rows = []
    for i in range(250):
        words = list(base)
        for _ in range(rng.choice([1, 2, 2, 3])):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 10 ** 6)}"
        rows.append((i, " ".join(words)))
    asked, plain = [], partenum.across_pairs

    def seen(*args):
        asked.append(plain(*args).count())
        return plain(*args)

    monkeypatch.setattr(partenum, "across_pairs", seen)
    monkeypatch.setattr(partenum, "TURNS", 0)
    whole = sorted(joined(spark, rows))
    monkeypatch.undo()
    monkeypatch.setattr(partenum, "across_pairs", seen)
    assert sorted(joined(spark, rows)) == whole
    assert asked[1] < asked[0]
