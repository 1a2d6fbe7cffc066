"""Token-id files: shards of ids compressed by a Re-Pair grammar, with random access.

Documents are dealt into id ranges, sorted inside each, encoded and appended to shards of about
``SHARD_IDS`` ids (a document is never split).  A shard repeatedly replaces its most frequent pairs of
neighbouring symbols by new nonterminals.  A round counts all pairs exactly and takes, in the order of
their counts, pairs that cannot overlap each other, so taking them together equals taking them one
after the other.  It stops when no pair is frequent enough or symbols would need more than 16 bits.

The shard format (all integers little-endian):

    magic "RPG1", then counts as u32: terminals, rules, symbols, documents
    rules      u16 left, u16 right        one pair per rule; rule r is the symbol terminals + r
    lengths    u32                        how many ids each rule expands to
    symbols    u16                        the compressed sequence
    sizes      u32                        ids of each document

Any stretch of ids is found by binary search in the running sum of the symbols' lengths and only the
symbols that cover it are expanded.

Files are Parquet rows (block, shard, n_ids, doc_ids, payload) in the shared folder, so a lost task is
written again by another executor under Spark's commit protocol.

Defined results: a null or empty text holds only the end id; null document ids come first in the order;
rows that repeat an id follow each other in an order fixed by their text; an empty table writes no
shard; only the id and text columns are read.
"""

from __future__ import annotations

import functools
import struct
import zlib
from itertools import chain, groupby, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from corpusprep.llm.common import (BLOCK, KEY_HASH, KEY_ID, ordered_blocks, ranges, running_starts, saved, str_texts,
                                   with_row_key)
from corpusprep.llm.wordbpe import _PLAIN, CachedEncoder, WordSplitter

MAGIC = b"RPG1"
SHARD_IDS = 1 << 20
MIN_COUNT = 16
PAIRS_PER_ROUND = 4096
STEP_ROWS, STEP_CHARS = 2000, 4 << 20  # texts encoded at a time
CONTROLS = "\x1c\x1d\x1e\x1f"  # whitespace for str.split alone
WORDS_PER_CALL = 50_000  # words that the library encodes in one call
KNOWN_CHUNKS = 240_000  # chunks a worker remembers; beyond that the often used half stays


class Grammar:
    """Rules (left, right), the compressed symbols and the size of each document."""

    def __init__(self, terminals: int, rules: np.ndarray, symbols: np.ndarray, sizes: np.ndarray):
        self.terminals, self.rules, self.symbols, self.sizes = terminals, rules, symbols, sizes
        lengths = [1] * terminals
        for a, b in rules.tolist():
            lengths.append(lengths[a] + lengths[b])
        self.lengths = np.array(lengths, dtype=np.int64)
        self._ends = None

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        out = symbols.astype(np.int64)
        while True:
            rule = out >= self.terminals
            if not rule.any():
                return out.astype(np.uint32)
            places = np.arange(len(out)) + np.cumsum(rule) - rule
            wide = np.empty(len(out) + int(rule.sum()), dtype=np.int64)
            pair = self.rules[out[rule] - self.terminals]
            wide[places[~rule]] = out[~rule]
            wide[places[rule]], wide[places[rule] + 1] = pair[:, 0], pair[:, 1]
            out = wide

    def ids(self) -> np.ndarray:
        """All ids of the shard: the rules are expanded once, level by level (a level's rules refer to lower ones),
        and copied to their places."""
        n = len(self.rules)
        starts = np.concatenate(([0], np.cumsum(self.lengths)))
        flat = np.zeros(int(starts[-1]), dtype=np.uint32)
        flat[:self.terminals] = np.arange(self.terminals)
        level = [0] * (self.terminals + n)
        for r, (a, b) in enumerate(self.rules.tolist(), self.terminals):
            level[r] = 1 + max(level[a], level[b])
        level = np.array(level[self.terminals:], dtype=np.int64)
        for k in range(1, int(level.max(initial=0)) + 1):
            rule = np.flatnonzero(level == k)
            parts = self.rules[rule].ravel()
            target = ranges(starts[self.terminals + rule], self.lengths[self.terminals + rule])
            flat[target] = flat[ranges(starts[parts], self.lengths[parts])]
        return flat[ranges(starts[self.symbols], self.lengths[self.symbols])]

    def read(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the shard; only the symbols that cover them are expanded."""
        if self._ends is None:
            self._ends = np.cumsum(self.lengths[self.symbols])
        if start >= end:
            return np.zeros(0, dtype=np.uint32)
        a = int(np.searchsorted(self._ends, start, side="right"))
        b = int(np.searchsorted(self._ends, end, side="left")) + 1
        skip = start - (int(self._ends[a - 1]) if a else 0)
        return self.expand(self.symbols[a:b])[skip:skip + end - start]

    def document(self, n: int) -> np.ndarray:
        before = int(self.sizes[:n].sum())
        return self.read(before, before + int(self.sizes[n]))

    def dump(self) -> bytes:
        head = MAGIC + struct.pack("<4I", self.terminals, len(self.rules), len(self.symbols), len(self.sizes))
        return b"".join([head, self.rules.astype("<u2").tobytes(), self.lengths[self.terminals:].astype("<u4").tobytes(),
                         self.symbols.astype("<u2").tobytes(), self.sizes.astype("<u4").tobytes()])

    @classmethod
    def load(cls, data: bytes) -> Grammar:
        if data[:4] != MAGIC:
            raise ValueError("not a shard of token ids")
        terminals, n_rules, n_symbols, n_docs = struct.unpack_from("<4I", data, 4)
        at = 20
        rules = np.frombuffer(data, "<u2", 2 * n_rules, at).reshape(-1, 2).astype(np.int64)
        at += 4 * n_rules
        lengths = np.frombuffer(data, "<u4", n_rules, at)
        at += 4 * n_rules
        symbols = np.frombuffer(data, "<u2", n_symbols, at)
        out = cls.__new__(cls)
        out.terminals, out.rules, out.symbols = terminals, rules, symbols
        out.sizes = np.frombuffer(data, "<u4", n_docs, at + 2 * n_symbols).astype(np.int64)
        out.lengths = np.concatenate([np.ones(terminals, dtype=np.int64), lengths.astype(np.int64)])
        out._ends = None
        return out


def often_pairs(symbols: np.ndarray, min_count: int, watch: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(keys in rising order, counts) of the pairs found at least ``min_count`` times; a key is left << 16 | right.
    ``watch`` flags symbols as left (1) or right (2) of a pair to count, or as a symbol all of whose pairs count (4)."""
    keys = symbols[:-1].astype(np.uint32) << np.uint32(16) | symbols[1:]
    if watch is not None:
        flag = watch[symbols]
        keys = keys[((flag[:-1] & 1) & (flag[1:] >> 1) | (flag[:-1] | flag[1:]) & 4) != 0]
    if not len(keys):
        return keys, np.zeros(0, dtype=np.int64)
    keys = np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    count = np.diff(np.append(first, len(keys)))
    often = count >= min_count
    return keys[first[often]], count[often]


def apart(keys: np.ndarray, count: np.ndarray, room: int) -> np.ndarray:
    """Pairs (left, right) in falling order of their counts, such that no symbol ends one and begins
    another: none of their places can overlap."""
    order = np.lexsort((keys, -count))[:4 * PAIRS_PER_ROUND]
    lefts, rights, out = set(), set(), []
    for key in keys[order].tolist():
        a, b = key >> 16, key & 0xFFFF
        if a in rights or b in lefts or (a == b and (a in lefts or a in rights)):
            continue
        lefts.add(a)
        rights.add(b)
        out.append((a, b))
        if len(out) == min(PAIRS_PER_ROUND, room):
            break
    return np.array(out, dtype=np.int64).reshape(-1, 2)


def frequent_pairs(symbols: np.ndarray, min_count: int, room: int) -> np.ndarray:
    """The pairs one round replaces."""
    return apart(*often_pairs(symbols, min_count), room)


def compress(ids: np.ndarray, sizes: np.ndarray, terminals: int, min_count: int = MIN_COUNT) -> Grammar:
    """The grammar of one shard; ``terminals`` is one above the largest id and at most 65536.

    Counts of old pairs only fall, so after the first round only pairs that were frequent and pairs with a new symbol
    are counted."""
    symbols = ids.astype(np.uint16)
    rules = np.zeros((0, 2), dtype=np.int64)
    watch = None
    while True:  # every round but the last shortens the symbols
        room = 65536 - terminals - len(rules)
        if len(symbols) < 2 or room <= 0:
            break
        keys, count = often_pairs(symbols, min_count, watch)
        pairs = apart(keys, count, room)
        if not len(pairs):
            break
        watch = np.zeros(65536, dtype=np.uint8)
        watch[keys >> 16] |= 1
        watch[keys & 0xFFFF] |= 2
        watch[terminals + len(rules):] |= 4
        side = np.zeros(65536, dtype=np.uint8)
        side[pairs[:, 0]] |= 1
        side[pairs[:, 1]] |= 2
        at_side = side[symbols]
        maybe = np.flatnonzero(at_side[:-1] & (at_side[1:] >> 1))
        key = symbols[maybe].astype(np.int64) << 16 | symbols[maybe + 1]
        chosen = pairs[:, 0] << 16 | pairs[:, 1]
        order = np.argsort(chosen)
        at = np.minimum(np.searchsorted(chosen[order], key), len(order) - 1)
        hit = chosen[order][at] == key
        places, rule = maybe[hit], order[at[hit]]
        start = np.append(True, np.diff(places) != 1)  # only (a, a) can overlap itself
        run = np.arange(len(places)) - np.maximum.accumulate(np.where(start, np.arange(len(places)), 0))
        places, rule = places[run % 2 == 0], rule[run % 2 == 0]
        symbols[places] = terminals + len(rules) + rule
        keep = np.ones(len(symbols), dtype=bool)
        keep[places + 1] = False
        symbols = symbols[keep]
        rules = np.concatenate([rules, pairs])
    return Grammar(terminals, rules, symbols, sizes)


class _Letters(dict):
    """The symbols of a letter's bytes."""

    def __init__(self, symbols: list[str]):
        super().__init__()
        self.symbols = symbols

    def __missing__(self, letter: str) -> str:
        self[letter] = out = "".join(map(self.symbols.__getitem__, letter.encode()))
        return out


class LibraryEncoder(CachedEncoder):
    """Texts to ids; the tokenizers library's model encodes the new words, many in a call: the vocabulary marks the
    token that ends a word.  A full memory of chunks keeps those used again since the last time, so a stream of words
    that occur once does not push out the frequent ones."""

    def __init__(self, splitter: WordSplitter, entries: int = KNOWN_CHUNKS):
        super().__init__(splitter, self.encode_words, entries)
        self.letters = _Letters(splitter.symbols)
        self.model = Tokenizer(splitter.library.model)
        self.model.pre_tokenizer = WhitespaceSplit()  # no byte's symbol is white space
        end, vocab = splitter.spec["model"]["end_of_word_suffix"], splitter.spec["model"]["vocab"]
        self.ends_word = np.zeros(1 + max(vocab.values()), dtype=bool)
        if end:
            self.ends_word[[i for t, i in vocab.items() if t.endswith(end)]] = True

    def clear(self) -> None:
        super().clear()
        self.uses = np.zeros(0, dtype=np.int64)

    def mapped(self, chunk: str) -> list[str]:
        """The words of a chunk, their bytes as the vocabulary's symbols."""
        if _PLAIN.fullmatch(chunk):
            low = chunk.lower()
            if low.isalpha():
                return [low if low.isascii() else "".join(map(self.letters.__getitem__, low))]
            if low[:-1].isalpha() and low[-1] in ".,;:!?":
                return ["".join(map(self.letters.__getitem__, low[:-1])), low[-1]]
        symbol = self.splitter.symbols.__getitem__
        return ["".join(map(symbol, w)) for w in self.splitter.words(chunk)] if chunk else []

    def encode_words(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        special = [i for i, w in enumerate(words) if isinstance(w, tuple)]
        plain = [w for w in words if not isinstance(w, tuple)] if special else words
        parts = [self.encode_many(plain[a:a + WORDS_PER_CALL]) for a in range(0, len(plain), WORDS_PER_CALL)] or [self.encode_each([])]
        flat, sizes = (np.concatenate(x) for x in zip(*parts))
        if special:
            before = np.array(special) - np.arange(len(special))  # plain words before each
            ends = np.concatenate(([0], np.cumsum(sizes)))
            flat, sizes = np.insert(flat, ends[before], [words[i][1] for i in special]), np.insert(sizes, before, 1)
        return flat, sizes

    def encode_many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, ids of each word), by one call."""
        flat = np.array(self.model.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype=np.int32)
        sizes = np.diff(np.flatnonzero(self.ends_word[flat]), prepend=-1)
        return (flat, sizes) if len(sizes) == len(words) and int(sizes.sum()) == len(flat) else self.encode_each(words)

    def encode_each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same, word by word."""
        found = [[t.id for t in self.splitter.library.model.tokenize(w)] for w in words]
        return np.array(list(chain.from_iterable(found)), dtype=np.int32), np.array(list(map(len, found)), dtype=np.int64)

    def _learn(self, chunks: list) -> None:
        known, number = len(self.word), self.word.__getitem__
        words: list[int] = []
        last = [0]
        for c in chunks:
            if isinstance(c, tuple):
                words.append(number(c))
            elif c.isascii() and c.isalpha():  # most of them
                words.append(number(c.lower()))
            else:
                words.extend(map(number, self.mapped(c)))
            last.append(len(words))
        if len(self.word) > known:
            self.word_ids.add(*self.encode_words(list(islice(self.word, known, None))))
        flat, sizes = self.word_ids.get(np.array(words, dtype=np.int64))
        ends = np.concatenate(([0], np.cumsum(sizes)))
        self.chunk_ids.add(flat, np.diff(ends[last]))

    def _forget(self) -> None:
        """Keeps the chunks used more than once since the last time, the most used ones up to half the memory."""
        order = np.argsort(-self.uses, kind="stable")[:self.entries // 2]
        kept = np.sort(order[self.uses[order] > 1])
        wanted = np.zeros(len(self.uses), dtype=bool)
        wanted[kept] = True
        names = [c for c, w in zip(self.chunk, wanted.tolist()) if w]
        held = self.chunk_ids.get(kept)
        self.clear()
        for c in names:
            self.chunk[c]
        self.chunk_ids.add(*held)
        self.uses = np.zeros(len(names), dtype=np.int64)

    def _numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the chunks of all texts in a row, chunks of each text).  Arrow splits the texts and finds the
        distinct chunks; texts with special tokens or control characters are split by the general rule."""
        numbers, counts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for odd, run in groupby(texts, lambda t: "<|" in t or any(c in t for c in CONTROLS)):
            if odd:
                found = [self.splitter.chunks(t) for t in run]
                counts.append(np.fromiter(map(len, found), dtype=np.int64, count=len(found)))
                numbers.append(np.fromiter(map(self.chunk.__getitem__, chain.from_iterable(found)), dtype=np.int64))
                continue
            found = pc.utf8_split_whitespace(pa.array(list(run), pa.string()))
            coded = found.flatten().dictionary_encode()
            seen = np.fromiter(map(self.chunk.__getitem__, coded.dictionary.to_numpy(False).tolist()), dtype=np.int64)
            counts.append(np.diff(found.offsets.to_numpy()).astype(np.int64))
            numbers.append(seen[coded.indices.to_numpy()])
        return np.concatenate(numbers), np.concatenate(counts)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids of each text)."""
        if max(len(self.chunk), len(self.word)) > self.entries:
            self._forget()
        known = len(self.chunk)
        numbers, counts = self._numbers(texts)
        if len(self.chunk) > known:
            self._learn(list(islice(self.chunk, known, None)))
        uses = np.bincount(numbers, minlength=len(self.chunk))
        uses[:len(self.uses)] += self.uses
        self.uses = uses
        flat, sizes = self.chunk_ids.get(numbers)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return flat, np.diff(ends[np.concatenate(([0], np.cumsum(counts)))])


@functools.lru_cache(maxsize=2)
def library_encoder(path: str) -> tuple[int, LibraryEncoder]:
    """(ids of the vocabulary, encoder), once per Python worker."""
    splitter = WordSplitter(path)
    return splitter.library.get_vocab_size(), LibraryEncoder(splitter)


FILE_SCHEMA = "block int, shard int, n_ids long, doc_ids array<long>, payload binary"


def write_ids(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
              shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encodes every text, appends ``end_id`` and writes the shards in ascending id order; returns them
    as read back from the shared folder."""
    def run(batches):
        terminals, encoder = library_encoder(path)
        block, shard, ids, sizes, names, held = None, 0, [], [], [], 0

        def flush():
            grammar = compress(np.concatenate(ids), np.array(sizes, dtype=np.int64), terminals)
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([shard], pa.int32()), pa.array([held], pa.int64()),
                 pa.array([names], pa.list_(pa.int64())), pa.array([grammar.dump()], pa.binary())],
                names=["block", "shard", "n_ids", "doc_ids", "payload"])

        for batch in (whole.slice(a, STEP_ROWS) for whole in batches for a in range(0, whole.num_rows, STEP_ROWS)):
            texts, blocks = str_texts(batch.column("text")), batch.column("block").to_pylist()
            doc_ids, at = batch.column("doc_id").to_pylist(), 0
            for flat, counts in encoder.steps(texts, STEP_CHARS):
                ends = np.concatenate(([0], np.cumsum(counts))).tolist()
                for k in range(len(counts)):
                    if sizes and (blocks[at] != block or held >= shard_ids):
                        yield flush()
                        shard, ids, sizes, names, held = (shard + 1 if blocks[at] == block else 0), [], [], [], 0
                    elif blocks[at] != block:
                        shard = 0
                    block = blocks[at]
                    ids.append(np.append(flat[ends[k]:ends[k + 1]], np.int32(end_id)))
                    sizes.append(len(ids[-1]))
                    names.append(doc_ids[at])
                    held += sizes[-1]
                    at += 1
        if sizes:
            yield flush()

    keyed = with_row_key(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")
    dealt = ordered_blocks(keyed, "text").repartition(BLOCK).sortWithinPartitions(BLOCK, KEY_ID, KEY_HASH)
    rows = dealt.select("doc_id", "text", F.col(BLOCK).alias("block"))
    return saved(rows.mapInArrow(run, FILE_SCHEMA), "token-ids")


def read_documents(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the shards: ``start`` counts the ids of
    all documents before it."""
    def run(batches):
        for batch in batches:
            for block, shard, names, payload in zip(*(batch.column(c).to_pylist() for c in ("block", "shard", "doc_ids", "payload"))):
                grammar = Grammar.load(payload)
                ids = grammar.ids().astype("<u4", copy=False)
                ends = np.concatenate(([0], np.cumsum(grammar.sizes)))
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * n, pa.int32()), pa.array([shard] * n, pa.int32()), pa.array(names, pa.int64()),
                     pa.array(ends[:-1].astype(np.int64)), pa.array(grammar.sizes.astype(np.int64)), pa.array(crc, pa.int64())],
                    names=["block", "shard", "doc_id", "inner", "n_tokens", "ids_crc32"])

    held = files.select("block", "shard", "n_ids")
    before = Window.partitionBy("block").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("block", "shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("in_block")) \
        .join(running_starts(held.groupBy("block").agg(F.sum("n_ids").alias("n")), "block", "n", "block_start"), "block")
    rows = files.select("block", "shard", "doc_ids", "payload").mapInArrow(
        run, "block int, shard int, doc_id long, inner long, n_tokens long, ids_crc32 long")
    return rows.join(starts, ["block", "shard"]).select(
        "doc_id", (F.col("block_start") + F.col("in_block") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
