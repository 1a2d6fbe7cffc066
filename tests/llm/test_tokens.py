"""Tokens, shards of ids and MinHash fingerprints against the library or brute force."""

import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusprep.llm.minhash import edited_text, fingerprints_of, likeness, neighbour_fingerprints, pack, unpack
from corpusprep.llm.tokenfile import MIN_COUNT, Grammar, compress, frequent_pairs, read_documents, write_ids
from corpusprep.llm.wordbpe import decode_documents, encode_documents, merge_encoder, vocabulary

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, ids string, n_tokens string, start string"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def odd_texts():
    rng = random.Random(1)
    texts = ["Hello the WORLD!!  it's we'll 'LL x'd 12 345", "<|endoftext|>a<|startoftext|> <|endoftext", "a\x1cb\x1d c\x85d\xa0e  f",
             "é é ́x ÀÉ ŸÿIıİi̇", "ΣΑΣ ΟΔΟΣ ς", "日本語 中文字 ｱｲｳ １２", "👍🏽 emoji 🇩🇪", "Ᲊ Ɤ \U00010d50x ՘a ࢏", "",
             "   \n\t ", "aaaa" * 300, "abab" * 200 + "b", "ß" * 50, "x" * 3000, "​﻿ z", "don't can't I'VE", "<|", "ﬁ ﬃ ǆ Ǆ"]
    pool = "abcdefghijklmnopqrstuvwxyzABC'ést.,!<|>0123 \n\t́ßΣ中"
    texts += ["".join(rng.choice(pool) for _ in range(rng.randint(1, 120))) for _ in range(300)]
    words = ["the", "ing", "tion", "er", "an", "re", "on"]
    texts += [" ".join("".join(rng.choice(words) for _ in range(rng.randint(1, 12))) for _ in range(40)) for _ in range(50)]
    return texts


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA)


def test_bpe_equals_library(spark, library):
    rows = list(enumerate([*odd_texts(), None])) + [(None, "null id"), (1, "twice"), (1, "twice")]
    encoded = encode_documents(rows_of(spark, rows), PATH)
    want = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows]
    assert sorted(map(repr, [(r.doc_id, r.ids) for r in encoded.collect()])) == sorted(map(repr, want))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.text) for r in decode_documents(encoded, PATH).collect()]
    want = [(i, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), library.decode(x, skip_special_tokens=False)) for i, x in want]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert encode_documents(rows_of(spark, []), PATH).count() == 0


def test_every_code_point(library):
    encoder = merge_encoder(PATH)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}1 {c}" for c in points[i:i + 2000]) for i in range(0, len(points), 2000)]
    for t in texts[:12] + texts[20:40:4]:
        ids, _ = encoder.encode([t])
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids


def test_cache_is_emptied(library):
    from corpusprep.llm.wordbpe import CachedEncoder
    small = CachedEncoder(merge_encoder(PATH).splitter, vocabulary(PATH).encode_words, entries=10)
    texts = [f"word{i} thing{i} <|endoftext|>" for i in range(60)]
    for t in texts:
        assert small.encode([t, t])[0].tolist() == 2 * library.encode(t, add_special_tokens=False).ids


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(2)
    phrase = rng.integers(0, 49408, 40)
    for ids in (np.concatenate([phrase] * 50 + [rng.integers(0, 49408, 500)]), np.full(1000, 7), np.array([1]), np.array([5, 5, 5]),
                np.tile([1, 2], 500), rng.integers(0, 20, 5000)):
        sizes = np.array([len(ids) // 3, 0, len(ids) - len(ids) // 3])
        g = compress(ids.astype(np.int32), sizes, 49408, min_count=3)
        back = Grammar.load(g.dump())
        assert back.expand(back.symbols).tolist() == ids.tolist()
        assert len(back.symbols) <= len(ids) and back.sizes.tolist() == sizes.tolist()
        for _ in range(50):
            a, b = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
            assert back.read(a, b).tolist() == ids[a:b].tolist()
        assert back.document(2).tolist() == ids[len(ids) // 3:].tolist()
    assert len(compress(np.full(1000, 7, dtype=np.int32), np.array([1000]), 49408).symbols) < 100
    with pytest.raises(ValueError):
        Grammar.load(struct.pack("<5I", 1, 2, 3, 4, 5))


def test_token_files(spark, library, monkeypatch):
    from corpusprep.llm import tokenfile
    rng = random.Random(3)
    rows = [(i, t) for i, t in enumerate([*odd_texts(), None, ""])]
    rng.shuffle(rows)
    import corpusprep.llm.common as common
    monkeypatch.setattr(common, "block_count", lambda *a: 5)
    files = write_ids(rows_of(spark, rows), PATH, 1, shard_ids=500)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in read_documents(files).collect()}
    at, want = 0, {}
    for i, t in sorted(rows):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want[i] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert got == want and len(got) == len(rows)
    assert files.groupBy("block").count().count() > 1
    assert read_documents(write_ids(rows_of(spark, []), PATH, 1)).count() == 0
    # repeated and null ids keep every row and leave no gap
    files = write_ids(rows_of(spark, [(2, "a b"), (2, "a b"), (None, "c"), (1, None)]), PATH, 1)
    got = sorted((r.start, r.n_tokens, r.doc_id) for r in read_documents(files).collect())
    assert [(s, d) for s, _, d in got] == [(0, None), (got[0][1], 1), (got[0][1] + 1, 2), (got[0][1] + 4, 2)]
    assert tokenfile.SHARD_IDS > 500


def jaccard(a, b):
    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def test_minhash_estimates(spark):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(rng.choice([1, 3, 6, 40, 400, 3000]))) for _ in range(60)]
    texts += [None, "", "  ", "One two", "one TWO", texts[5], texts[5]]
    rows = list(enumerate(texts))
    import corpusprep.llm.common as common
    got = {r.doc_id: r for r in neighbour_fingerprints(rows_of(spark, rows)).collect()}
    assert len(got) == len(rows)
    errors = []
    for i, t in rows:
        t, following = t or "", texts[(i + 1) % len(texts)] or ""
        edited = t[:len(t) - len(t) // 2] + following[:len(t) // 2]
        assert edited == edited_text(t, following)
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        wrong = [abs(r.near_edited - jaccard(t, edited)), abs(r.near_next - jaccard(t, following))]
        errors += wrong
        assert max(wrong) < (0.15 if len(t.split()) >= 40 else 0.6)
        assert (r.fingerprint == r.edited_fingerprint) == (t == edited or r.near_edited == 1)
    assert np.mean(errors) < 0.03
    assert got[60].near_next == 1.0 and got[63].near_next == 1.0 and got[65].near_next == 1.0
    assert common.ORDERED_BLOCKS >= 1
    bins = fingerprints_of([b"a b c d e f g"])
    assert (unpack(pack(bins)[0]) == bins[0]).all() and likeness(bins, bins).tolist() == [1.0]
    assert neighbour_fingerprints(rows_of(spark, [])).count() == 0
    alone = neighbour_fingerprints(rows_of(spark, [(1, "a b c d e f")])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_minhash_over_many_ranges(spark, monkeypatch):
    import corpusprep.llm.common as common
    monkeypatch.setattr(common, "block_count", lambda *a: 7)
    rows = [(i * 3 - 40, f"text {i} " + "word " * i) for i in range(50)] + [(None, "first"), (2, "same"), (2, "same")]
    got = neighbour_fingerprints(rows_of(spark, rows), step=4).collect()
    key = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(map(repr, (r.doc_id for r in got))) == sorted(map(repr, (i for i, _ in rows)))
    texts = {i: t for i, t in rows}
    order = [i for i, _ in key if i not in (2,)]
    have = {r.doc_id: r.edited_sha256 for r in got}
    for a, b in zip(order, order[1:] + order[:1]):
        if 2 in range((a or -99) + 1, (b or -99)):
            continue
        assert have[a] == hashlib.sha256(edited_text(texts[a], texts[b]).encode()).hexdigest()


def test_grammar_folds_until_no_pair_is_frequent():
    rng = np.random.default_rng(6)
    ids = np.tile(rng.integers(0, 5000, 1500), 600)
    grammar = compress(ids, np.full(600, 1500), 5000)
    assert np.array_equal(grammar.expand(grammar.symbols), ids)
    assert not len(frequent_pairs(grammar.symbols, MIN_COUNT, 1)) and grammar.lengths.max() > 1500
    assert np.array_equal(Grammar.load(grammar.dump()).document(599), ids[-1500:])


def test_small_memory_of_chunks_gives_the_library_ids(library):
    from corpusprep.llm.tokenfile import LibraryEncoder
    from corpusprep.llm.wordbpe import WordSplitter
    odd = ["", " ", "\n a  b\n\n", "Ünïcode été.", "x\x1cy\x1f z", "<|endoftext|> <| it's", "ﬁ İ ẞ 漢字 ét\xa0q", "a1b2,c", "..."]
    texts = [f"{odd[i % len(odd)]} the wörd{i} of w{i % 7} The, the {i}" for i in range(400)] + odd
    encoder = LibraryEncoder(WordSplitter(PATH), entries=50)
    got = []
    for flat, sizes in encoder.steps(texts, 300):
        got += [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(encoder.chunk) < 150


def test_all_ids_of_a_shard_equal_its_expansion():
    rng = np.random.default_rng(5)
    block = rng.integers(0, 300, 700)
    for ids in (np.tile(block, 40), np.zeros(5000, dtype=np.int64), rng.integers(0, 20, 9000), np.zeros(0, dtype=np.int64)):
        grammar = Grammar.load(compress(ids, np.array([len(ids)]), 300).dump())
        assert np.array_equal(grammar.ids(), ids) and np.array_equal(grammar.expand(grammar.symbols), ids)


def test_library_encoder_takes_many_words_in_a_call():
    from corpusprep.llm import tokenfile
    from corpusprep.llm.wordbpe import WordSplitter

    splitter = WordSplitter(PATH)
    encoder = tokenfile.LibraryEncoder(splitter)
    rng = random.Random(9)
    words = sorted({"".join(rng.choice(splitter.symbols) for _ in range(rng.randint(1, 12))) for _ in range(400)} | set(splitter.symbols))
    mixed = [("special", 7), *words[:100], ("special", 8), ("special", 9), *words[100:], ("special", 7)]
    each = [[w[1]] if isinstance(w, tuple) else [t.id for t in splitter.library.model.tokenize(w)] for w in mixed]
    encoder.encode_each = None  # the call for each word is not needed
    flat, sizes = encoder.encode_words(mixed)
    assert sizes.tolist() == list(map(len, each)) and flat.tolist() == [i for ids in each for i in ids]
    assert [x.tolist() for x in tokenfile.LibraryEncoder(splitter).encode_words([])] == [[], []]
    assert [x.tolist() for x in tokenfile.LibraryEncoder(splitter).encode_words([("special", 5)])] == [[5], [1]]
