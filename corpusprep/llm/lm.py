"""Language-model scores: online logistic context mixing over the words of a text.

The scored text is the sequence of tokens: words with A-Z lower-cased, each followed by one space, and an
end mark.  Every token is coded byte by byte and bit by bit.  A bit is predicted from eight contexts (the
text's class, the last one to four bytes, the whole prefix of the token, and two of them together with the
class), each with exact counts of the zeros and ones that followed it and the bits of the byte so far.  The
log-odds are added with weights; the weight set is gated by the bit's place, by how many of the long
contexts were ever seen and by how often the longest was.  The weights are learned online, batch after batch,
by the gradient of the coding cost, where a token predicts itself from the counts without its own occurrence.
A second table, also adapted online, refines the mixed probability given the bits so far.  The sum of the
bits' costs is the text's code length.

The class adapts to the text while it is read: the most frequent words of the corpus are put into groups that
occur in the same documents (in mixed corpora: languages), and a token's class is the group that most of the
frequent words before it in the text belong to.

All other contexts lie inside a token, so a token costs the same wherever it stands in texts of a class.  The
corpus is therefore reduced to distinct (class, word) pairs and their counts (all documents that may be
learned from count), and each distinct pair is scored once.  Scored pairs go back to the documents in blocks of
bounded size; no word list is sent to the driver.

The counts grow with the corpus.  Pairs are dealt into blocks; a block sends each of its distinct (context,
byte) keys, 64 bits of context and byte, once to the key's shard.  A shard adds up the counts of all blocks and
answers each block with the sums of its keys: nothing is shared between contexts, capped or held in one place.

The base score is the add-one unigram model over the same tokens.

Of fixed size are the mixing weights, the refining table and the classes (``FREQUENT`` words in ``GROUPS``
groups).  The hashed table of ``count_bits`` and ``Mixer(table)`` is a form for small data in one process.

Defined results: a null or empty text has only the end token; repeated rows count and are scored each; a
null id counts as the empty string where ids decide what is held out; with nothing to learn from every bit
costs one bit; an empty table gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import (BLOCK, BLOCK_BYTES, KEY_HASH, KEY_ID, block_count, block_of, byte_texts, mix64,
                                   release_memory, saved, with_row_key)

END_TOKEN = b"\n"
#: log2 of the slots of each context's table: class; one byte; two with class; two, three, four; prefix; prefix with class.
TABLE_BITS = (12, 16, 20, 20, 21, 21, 21, 21)
DELTA = 0.05
STEP = 0.1
BATCH_WORDS = 2048
#: Bytes of the pairs of one block, and keys (before repeats in a block are dropped) of one shard.
PAIR_BYTES = 1 << 17
SHARD_KEYS = 1 << 22
#: Keys of a shard that are summed at a time.
ANSWER_KEYS = 1 << 18
#: Pairs that one training task should have.
TRAIN_PAIRS = 400_000
FREQUENT = 256
GROUPS = 8
GATES = 8 * 5 * 4
BUCKETS = 33
SPREAD = 12.0
_OFFSETS = np.concatenate(([0], np.cumsum([1 << b for b in TABLE_BITS])))
SLOTS = int(_OFFSETS[-1])
_INPUTS = len(TABLE_BITS) + 1


class Contexts:
    """Bytes of a list of tokens with the context hashes of each, and the table slots of each bit."""

    def __init__(self, words: list[bytes], classes: np.ndarray):
        coded = [w if w == END_TOKEN else w + b" " for w in words]
        self.sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        self.bytes = np.frombuffer(b"".join(coded), dtype=np.uint8).astype(np.uint64)
        first = np.cumsum(self.sizes) - self.sizes
        place = np.arange(len(self.bytes)) - np.repeat(first, self.sizes)
        self.token = np.repeat(np.arange(len(coded)), self.sizes)
        kind = np.asarray(classes).astype(np.uint64)[self.token]
        last = np.zeros(len(self.bytes), dtype=np.uint64)
        lasts = []
        for k in range(1, 5):
            back = np.full(len(self.bytes), 0x20, dtype=np.uint64)
            back[place >= k] = self.bytes[np.flatnonzero(place >= k) - k]
            last = last | back << np.uint64(8 * (k - 1))
            lasts.append(last)
        power = np.cumprod(np.full(int(self.sizes.max(initial=1)) + 1, 0x9E3779B97F4A7C15, dtype=np.uint64))
        total = np.cumsum((self.bytes + np.uint64(1)) * power[place])
        before = np.concatenate((np.zeros(1, dtype=np.uint64), total[:-1]))
        prefix = mix64((before - np.repeat(before[first], self.sizes)) + place.astype(np.uint64))
        of_class = (kind + np.uint64(1)) * np.uint64(0xA24BAED4963EE407)
        self.hashes = [kind, lasts[0], mix64(lasts[1] + of_class), *(mix64(lasts[k] + np.uint64(k << 40)) for k in (1, 2, 3)),
                       prefix, mix64(prefix + of_class)]

    def bits(self):
        """For each of the eight bits: (place, bit, bits so far, slots of the contexts)."""
        for k in range(8):
            node = (np.uint64(1) << np.uint64(k)) | self.bytes >> np.uint64(8 - k)
            bit = (self.bytes >> np.uint64(7 - k) & np.uint64(1)).astype(np.int64)
            slots = []
            for c, h in enumerate(self.hashes):
                if c < 2:
                    at = h << np.uint64(8) | node
                else:
                    at = (h + node * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xFF51AFD7ED558CCD) >> np.uint64(64 - TABLE_BITS[c])
                slots.append(at.astype(np.int64) + _OFFSETS[c])
            yield k, bit, node.astype(np.int64), slots


def count_bits(words: list[bytes], classes: np.ndarray, counts: np.ndarray, table: np.ndarray) -> None:
    """Adds the tokens' bits to the table of (zeros, ones) per slot, flat."""
    ctx = Contexts(words, classes)
    weight = counts.astype(table.dtype)[ctx.token]
    for _, bit, _, slots in ctx.bits():
        for at in slots:
            np.add.at(table, 2 * at + bit, weight)


class Mixer:
    """Counts (uint32 per slot: zeros in its low half, ones in its high half), gated weights and the refining table."""

    def __init__(self, table: np.ndarray, weights: np.ndarray | None = None, refine: np.ndarray | None = None):
        self.table = table
        self.weights = np.full((GATES, _INPUTS), 0.2) if weights is None else weights
        self.squares = np.full((GATES, _INPUTS), 1e-4)
        centre = 1 / (1 + np.exp(-np.linspace(-SPREAD, SPREAD, BUCKETS)))
        prior = np.stack([1 - centre, centre], axis=-1) * 4.0
        self.refine = np.broadcast_to(prior, (256, BUCKETS, 2)).copy() if refine is None else refine

    def inputs(self, k: int, bit: np.ndarray, slots: list[np.ndarray], own: bool):
        """(log-odds of the contexts and a bias, gate); with ``own`` one occurrence is left out of the counts."""
        x = np.empty((_INPUTS, len(bit)), dtype=np.float32)
        x[-1] = 0.3
        seen = np.zeros(len(bit), dtype=np.int64)
        for c, at in enumerate(slots):
            both = self.table[at]  # zeros and ones in one number: one look-up per context
            n0, n1 = (both & np.uint32(0xFFFF)).astype(np.float32), (both >> np.uint32(16)).astype(np.float32)
            if own:
                n1 -= bit
                n0 -= 1 - bit
                np.maximum(n0, 0, out=n0)
                np.maximum(n1, 0, out=n1)
            n0 += np.float32(DELTA)
            n1 += np.float32(DELTA)
            total = n0 + n1
            np.divide(n1, n0, out=n1)
            np.log(n1, out=x[c])
            if c >= len(slots) - 4:
                seen += total > 2.5 * DELTA
        bucket = (total > 0.5 + 2 * DELTA).astype(np.int64) + (total > 2.5 + 2 * DELTA) + (total > 15.5 + 2 * DELTA)
        return x, (k * 5 + seen) * 4 + bucket

    def mixed(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        w = self.weights.astype(np.float32)
        total = np.zeros(x.shape[1], dtype=np.float32)
        for j, row in enumerate(x):
            total += w[:, j][gate] * row
        return np.clip(total, -SPREAD, SPREAD)

    def refined(self, logit: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(probability of a one, buckets below, share of the bucket above, mixed probability)."""
        at = (logit + SPREAD) * ((BUCKETS - 1) / (2 * SPREAD))
        low = np.minimum(at.astype(np.int64), BUCKETS - 2)
        share = at - low
        p = (self.refine[..., 1] / self.refine.sum(axis=-1)).astype(np.float32).reshape(-1)
        mixed = 1 / (1 + np.exp(-logit))
        cell = node * BUCKETS + low
        return 0.5 * mixed + 0.5 * (p[cell] * (1 - share) + p[cell + 1] * share), low, share, mixed

    def looked_up(self, ctx: Contexts, own: bool):
        for k, bit, node, slots in ctx.bits():
            yield bit, node, *self.inputs(k, bit, slots, own)

    def learn(self, words: list[bytes], classes: np.ndarray, counts: np.ndarray) -> None:
        """One online step over a batch of tokens, each weighing as much as its count."""
        ctx = Contexts(words, classes)
        self.adapt(self.looked_up(ctx, True), counts.astype(np.float64)[ctx.token])

    def adapt(self, steps, weight: np.ndarray) -> None:
        """One online step over the eight bits (bit, bits so far, inputs, gate) of weighted bytes."""
        for bit, node, x, gate in steps:
            logit = self.mixed(x, gate)
            _, low, share, mixed = self.refined(logit, node)
            error = weight * (bit - mixed)
            total = np.bincount(gate, weights=weight, minlength=GATES)
            gradient = np.stack([np.bincount(gate, weights=error * row, minlength=GATES) for row in x], axis=1)
            used = total > 0
            gradient = gradient[used] / total[used, None]
            self.squares[used] += gradient ** 2
            self.weights[used] += STEP * gradient / np.sqrt(self.squares[used])
            for side, part in ((low, 1 - share), (low + 1, share)):
                cell = (node * BUCKETS + side) * 2 + bit
                self.refine += np.bincount(cell, weights=weight * part, minlength=self.refine.size).reshape(self.refine.shape)

    def bits_of(self, words: list[bytes], classes: np.ndarray) -> np.ndarray:
        """Code length of each token in bits."""
        if not words:
            return np.zeros(0)
        ctx = Contexts(words, classes)
        return np.bincount(ctx.token, weights=self.costs(self.looked_up(ctx, False)), minlength=len(words))

    def costs(self, steps) -> np.ndarray:
        """Code length of each byte in bits."""
        cost = 0.0
        for bit, node, x, gate in steps:
            p = self.refined(self.mixed(x, gate), node)[0]
            cost = cost - np.log2(np.clip(np.where(bit == 1, p, 1 - p), 1e-7, 1.0))
        return cost


class Counted:
    """The contexts of a block's tokens with their exact counts.

    A key is 56 bits of a context's hash and the byte that follows; keys are sorted, so the bytes of a context
    that share their first bits lie side by side.  ``sums[k]`` holds, for each key, how often its context was
    followed by a byte with the same first k bits."""

    def __init__(self, words: list[bytes], classes: np.ndarray, sums: np.ndarray | None = None):
        self.ctx = ctx = Contexts(words, classes)
        self.ends = np.cumsum(ctx.sizes)
        salts = np.arange(1, len(ctx.hashes) + 1, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
        raw = np.concatenate([mix64(h + salt) & ~np.uint64(0xFF) | ctx.bytes for h, salt in zip(ctx.hashes, salts)])
        self.keys, at = np.unique(raw, return_inverse=True)
        self.at = at.reshape(len(ctx.hashes), -1)
        self.sums = sums

    def own(self, counts: np.ndarray) -> np.ndarray:
        """How often each key occurs in these tokens."""
        weight = np.tile(counts.astype(np.float64)[self.ctx.token], len(self.at))
        return np.bincount(self.at.reshape(-1), weights=weight, minlength=len(self.keys)).astype(np.int64)

    def evidence(self, own: bool):
        """For each bit and key: (log-odds of the bit that comes, whether the context was seen, how often by steps);
        with ``own`` one occurrence is left out."""
        out = []
        for k in range(8):
            hit, miss = self.sums[k + 1], self.sums[k] - self.sums[k + 1]
            if own:
                hit = np.maximum(hit - 1, 0)
            seen = hit + miss
            odds = np.log((hit + DELTA) / (miss + DELTA)).astype(np.float32)
            out.append((odds, seen > 0, (seen > 0).astype(np.int8) + (seen > 2) + (seen > 15)))
        return out

    def steps(self, evidence, first: int, last: int):
        """(bit, bits so far, inputs, gate) of the bytes of tokens ``first`` to ``last``."""
        part = self.part(first, last)
        byte, at = self.ctx.bytes[part].astype(np.int64), self.at[:, part]
        for k, (odds, seen, often) in enumerate(evidence):
            bit = byte >> (7 - k) & 1
            x = np.empty((_INPUTS, len(byte)), dtype=np.float32)
            x[-1] = 0.3
            x[:-1] = odds[at] * (2 * bit - 1).astype(np.float32)
            gate = (k * 5 + seen[at[-4:]].sum(axis=0)) * 4 + often[at[-1]]
            yield bit, 1 << k | byte >> (8 - k), x, gate

    def part(self, first: int, last: int) -> slice:
        return slice(int(self.ends[first - 1]) if first else 0, int(self.ends[last - 1]))


def counted(docs: DataFrame, text_col: str, usable: Column, tokens) -> DataFrame:
    """(token, n): how often ``tokens(text)`` gives each token over the usable documents."""
    def run(batches):
        for b in batches:
            n: Counter = Counter()
            for t in byte_texts(b.column(0)):
                n.update(tokens(t))
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], names=["token", "n"])

    d = docs.where(usable).select(F.col(text_col).alias("text"))
    return d.mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def plain_tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END_TOKEN]


def classed_tokens(text: bytes, groups: dict[bytes, int]) -> list[bytes]:
    """The tokens, each with its class as a first byte: the group most often met before it in the text (0
    before the first frequent word; ties go to the smaller group)."""
    words = plain_tokens(text)
    met = np.fromiter((groups.get(w, 0) for w in words), dtype=np.int64, count=len(words))
    at = np.flatnonzero(met)
    if not len(at):
        return [b"\0" + w for w in words]
    votes = np.zeros((len(at), GROUPS + 1), dtype=np.int32)
    votes[np.arange(len(at)), met[at]] = 1
    leader = np.cumsum(votes, axis=0).argmax(axis=1)
    kind = np.repeat(np.append(0, leader), np.diff(np.concatenate(([0], at + 1, [len(words)])))).tolist()
    return [_KINDS[k] + w for k, w in zip(kind, words)]


_KINDS = [bytes([k]) for k in range(GROUPS + 1)]


def word_groups(docs: DataFrame, text_col: str, usable: Column, vocabulary: DataFrame) -> dict[bytes, int]:
    """Groups 1 to ``GROUPS`` of the most frequent words, by the documents they share: at most ``FREQUENT`` words
    and the square of that in co-occurrence counts reach the driver."""
    top = vocabulary.where(F.col("token") != F.lit(END_TOKEN)).orderBy(F.desc("n"), "token").limit(FREQUENT).collect()
    words = [bytes(r["token"]) for r in top]
    if not words:
        return {}
    number = {w: i for i, w in enumerate(words)}
    size = len(words)

    def together(batches):
        total = np.zeros((size, size))
        for b in batches:
            rows, cols = [], []
            for i, t in enumerate(byte_texts(b.column(0))):
                found = {number[w] for w in t.lower().split() if w in number}
                rows += [i] * len(found)
                cols += found
            here = np.zeros((b.num_rows, size), dtype=np.float32)
            here[rows, cols] = 1
            total += here.T @ here
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(total.reshape(-1)[cell].astype(np.int64))], names=["cell", "n"])

    pairs = np.zeros(size * size)
    for r in docs.where(usable).select(F.col(text_col).alias("text")).mapInArrow(together, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        pairs[r["cell"]] = r["n"]
    pairs = pairs.reshape(size, size)
    alone = np.sqrt(np.maximum(np.diag(pairs), 1))
    row = pairs / alone[:, None] / alone[None, :]
    row /= np.maximum(np.linalg.norm(row, axis=1, keepdims=True), 1e-12)
    centre = row[:1]
    while len(centre) < min(GROUPS, size):  # the word least like the centres so far
        centre = np.concatenate([centre, row[[int((row @ centre.T).max(axis=1).argmin())]]])
    for _ in range(20):
        near = (row @ centre.T).argmax(axis=1)
        centre = np.stack([row[near == k].sum(axis=0) if (near == k).any() else centre[k] for k in range(len(centre))])
        centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)
    return {w: int(k) + 1 for w, k in zip(words, near)}


def packed(x: np.ndarray) -> bytes:
    """64-bit numbers, compressed by byte planes; those of small numbers are nearly empty."""
    planes = np.ascontiguousarray(x.reshape(-1).view(np.uint8).reshape(-1, 8).T)
    return pa.compress(pa.py_buffer(planes), codec="zstd", asbytes=True)


def unpacked(x: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(x, decompressed_size=size * 8, codec="zstd"), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(np.int64)


def packed_sums(sums: np.ndarray) -> bytes:
    """Of each row only what it has over the next: mostly nothing."""
    return packed(np.concatenate((sums[:-1] - sums[1:], sums[-1:])))


def unpacked_sums(x: bytes, size: int) -> np.ndarray:
    sums = unpacked(x, 9 * size).reshape(9, -1)
    for k in range(7, -1, -1):
        sums[k] += sums[k + 1]
    return sums


def _tokens_of(pairs: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    return [t[1:] for t in pairs], np.array([t[0] for t in pairs], dtype=np.int64)


def prefix_sums(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For sorted distinct keys: the counts of all keys that share context and first k bits of the byte, k from 0 to 8."""
    out = np.empty((9, len(keys)), dtype=np.int64)
    for k in range(9):
        group = keys >> np.uint64(8 - k)
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        out[k] = np.repeat(np.add.reduceat(counts, first), np.diff(np.append(first, len(keys))))
    return out


def counted_blocks(pairs: DataFrame, n_shards: int) -> DataFrame:
    """One row per block of (block, pair, n, known): its pairs in an order of their own with the counts of
    their contexts over all blocks: (block, pairs, n, known, size, sums)."""
    def in_order(table: pa.Table) -> tuple[list[bytes], list[int], list[int]]:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("pair", "n", "known"))), key=lambda r: (zlib.crc32(r[0]), r[0]))
        return [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]

    def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        coded, n, _ = in_order(table)
        block = Counted(*_tokens_of(coded))
        count = block.own(np.array(n))
        shard = ((block.keys >> np.uint64(32)) * np.uint64(n_shards) >> np.uint64(32)).astype(np.int64)  # rises with the key
        names, first = np.unique(shard, return_index=True)
        cuts = np.append(first, len(shard)).tolist()
        parts = list(zip(cuts[:-1], cuts[1:]))
        out = pa.table({
            "shard": pa.array(names.astype(np.int32)), "block": pa.array(np.full(len(names), key[0].as_py(), dtype=np.int32)),
            "size": pa.array([b - a for a, b in parts], pa.int32()),
            "keys": pa.array([packed(np.diff(block.keys[a:b], prepend=np.uint64(0))) for a, b in parts], pa.binary()),
            "counts": pa.array([packed(count[a:b]) for a, b in parts], pa.binary())})
        release_memory()
        return out

    def answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        sizes = table.column("size").to_pylist()
        asked = [np.cumsum(unpacked(x, n).view(np.uint64)) for x, n in zip(table.column("keys").to_pylist(), sizes)]
        count = [unpacked(x, n) for x, n in zip(table.column("counts").to_pylist(), sizes)]
        low, high = min(int(a[0]) for a in asked), max(int(a[-1]) for a in asked)
        pieces = -(-sum(sizes) // ANSWER_KEYS)
        cuts = np.array([low + (high - low) * i // pieces & ~0xFF for i in range(1, pieces)], dtype=np.uint64)  # between contexts
        bounds = [[0, *np.searchsorted(a, cuts).tolist(), len(a)] for a in asked]
        parts: list[list[bytes]] = [[] for _ in sizes]
        for p in range(pieces):
            part = [slice(*b[p:p + 2]) for b in bounds]
            keys, n = (np.concatenate([x[s] for x, s in zip(rows, part)]) for rows in (asked, count))
            if not len(keys):
                continue
            order = np.argsort(keys, kind="stable")
            first = np.flatnonzero(np.append(True, keys[order[1:]] != keys[order[:-1]]))
            sums = prefix_sums(keys[order[first]], np.add.reduceat(n[order], first))
            at = np.empty(len(keys), dtype=np.int64)
            at[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
            end = 0
            for own, s in zip(parts, part):
                begin, end = end, end + s.stop - s.start
                if end > begin:
                    own.append(packed_sums(sums[:, at[begin:end]]))
        out = pa.table({
            "shard": table.column("shard"), "block": table.column("block"),
            "sizes": pa.array([[m for m in np.diff(b).tolist() if m] for b in bounds], pa.list_(pa.int32())),
            "sums": pa.array(parts, pa.list_(pa.binary()))})
        release_memory()
        return out

    def join(rows: pa.Table, answers: pa.Table) -> pa.Table:
        coded, n, known = in_order(rows)
        parts = sorted(zip(*(answers.column(c).to_pylist() for c in ("shard", "sizes", "sums"))))
        sums = np.concatenate([unpacked_sums(x, m) for _, sizes, blobs in parts for m, x in zip(sizes, blobs)], axis=1)
        out = pa.table({
            "block": rows.column("block")[:1], "pairs": pa.array([coded], pa.list_(pa.binary())), "n": pa.array([n], pa.list_(pa.int64())),
            "known": pa.array([known], pa.list_(pa.int64())), "size": pa.array([sums.shape[1]], pa.int32()),
            "sums": pa.array([packed_sums(sums)], pa.binary())})
        release_memory()
        return out

    answers = pairs.groupBy("block").applyInArrow(ask, "shard int, block int, size int, keys binary, counts binary") \
        .groupBy("shard").applyInArrow(answer, "shard int, block int, sizes array<int>, sums array<binary>")
    return pairs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        join, "block int, pairs array<binary>, n array<bigint>, known array<bigint>, size int, sums binary")


def _blocks_of(table):
    """(pairs, counts, word counts, counted contexts) of each row."""
    for i in range(table.num_rows):
        pairs, n, known, size = (table.column(c)[i].as_py() for c in ("pairs", "n", "known", "size"))
        # no name here keeps the block, so that it is gone before the next one is made
        yield pairs, np.array(n), known, Counted(*_tokens_of(pairs), unpacked_sums(table.column("sums")[i].as_py(), size))


def train_mixer(blocks: DataFrame, n_tasks: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, refining table): each task learns online from its blocks; weights are averaged by the
    tokens seen and the refining counts added up."""
    def learn(table: pa.Table) -> pa.Table:
        mixer, tokens = Mixer(np.zeros(1, dtype=np.uint32)), 0
        prior = mixer.refine.copy()
        for _, counts, _, block in _blocks_of(table.sort_by("block")):
            evidence = block.evidence(True)
            for a in range(0, len(counts), BATCH_WORDS):
                b = min(a + BATCH_WORDS, len(counts))
                mixer.adapt(block.steps(evidence, a, b), counts.astype(np.float64)[block.ctx.token[block.part(a, b)]])
            tokens += int(counts.sum())
            del block, evidence
        release_memory()
        return pa.table({"task": table.column("task")[:1], "tokens": pa.array([float(tokens)]),
                         "weights": pa.array([mixer.weights.tobytes()], pa.binary()), "refine": pa.array([(mixer.refine - prior).tobytes()], pa.binary())})

    weights, tokens, mixer = np.zeros((GATES, _INPUTS)), 0.0, Mixer(np.zeros(1, dtype=np.uint32))
    dealt = blocks.withColumn("task", F.pmod("block", F.lit(n_tasks)))
    learned = saved(dealt.groupBy("task").applyInArrow(learn, "task int, tokens double, weights binary, refine binary"), "lm-weights")
    for row in learned.orderBy("task").toLocalIterator():
        weights += row["tokens"] * np.frombuffer(row["weights"]).reshape(GATES, _INPUTS)
        mixer.refine += np.frombuffer(row["refine"]).reshape(mixer.refine.shape)
        tokens += row["tokens"]
    return (weights / tokens if tokens else mixer.weights), mixer.refine


SCORE_SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
                "score double, bits_per_byte double")


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Scores every text with the model learned from the documents that are not held out."""
    spark = docs.sparkSession
    usable = ~held_out
    vocabulary = saved(counted(docs, text_col, usable, plain_tokens), "lm-vocabulary")
    size = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).collect()[0]
    n_train, v_train = int(size["n"]), int(size["v"])
    groups = word_groups(docs, text_col, usable, vocabulary)

    n_blocks = block_count(docs, text_col, block_bytes)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), held_out.alias("held_out"),
                       F.coalesce(usable, F.lit(False)).alias("usable"))
    dealt = with_row_key(rows, "doc_id", "text").withColumn(BLOCK, block_of(n_blocks)).drop(KEY_ID, KEY_HASH)

    def distinct_tokens(key: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
        n: Counter = Counter()
        for t, use in zip(byte_texts(block.column("text")), block.column("usable").to_pylist()):
            found = classed_tokens(t, groups)
            n.update(found if use else dict.fromkeys(found, 0))
        out = pa.table({"pair": pa.array(list(n), pa.binary()), BLOCK: pa.array(np.full(len(n), key[0].as_py(), dtype=np.int32)),
                        "n": pa.array(list(n.values()), pa.int64())})
        del n
        release_memory()
        return out

    found = saved(dealt.groupBy(BLOCK).applyInArrow(distinct_tokens, f"pair binary, {BLOCK} int, n long"), "lm-found")
    pairs = saved(found.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("token", F.expr("substring(pair, 2)"))
                  .join(vocabulary.withColumnRenamed("n", "known"), "token", "left")
                  .select("pair", "token", "n", F.coalesce("known", F.lit(0).cast("long")).alias("known")), "lm-pairs")
    learned = F.col("n") > 0
    room = F.octet_length("pair").cast("long") + 1
    facts = pairs.agg(F.coalesce(F.sum(F.when(learned, room)), F.lit(0)).alias("a"), F.coalesce(F.sum(F.when(~learned, room)), F.lit(0)).alias("b"),
                      F.count_if(learned).alias("n")).collect()[0]
    n_learn, n_other = (max(1, -(-int(facts[c]) // PAIR_BYTES)) for c in ("a", "b"))
    # pairs that are only scored lie in blocks of their own, so that they change nothing in the order of learning
    word = F.xxhash64("token")
    numbered = pairs.select(F.when(learned, F.pmod(word, F.lit(n_learn))).otherwise(F.pmod(word, F.lit(n_other)) + n_learn).cast("int").alias("block"),
                            "pair", "n", "known")
    n_shards = max(1, -(-(int(facts["a"]) + int(facts["b"])) * len(TABLE_BITS) // SHARD_KEYS))
    blocks = saved(counted_blocks(numbered, n_shards), "lm-blocks")
    weights, refine = train_mixer(blocks.where(F.col("block") < n_learn), max(1, -(-int(facts["n"]) // TRAIN_PAIRS)))

    def cost(batches):
        mixer = Mixer(np.zeros(1, dtype=np.uint32), weights, refine)
        for b in batches:
            for coded, _, known, block in _blocks_of(b):
                evidence, bits = block.evidence(False), []
                for a in range(0, len(coded), BATCH_WORDS):
                    e = min(a + BATCH_WORDS, len(coded))
                    token = block.ctx.token[block.part(a, e)] - a
                    bits.append(np.bincount(token, weights=mixer.costs(block.steps(evidence, a, e)), minlength=e - a))
                del block, evidence
                yield pa.RecordBatch.from_arrays([pa.array(coded, pa.binary()), pa.array(known, pa.int64()), pa.array(np.concatenate(bits))],
                                                 names=["pair", "known", "bits"])
        release_memory()

    costs = blocks.select("pairs", "n", "known", "size", "sums").mapInArrow(cost, "pair binary, known long, bits double")
    scored = found.select("pair", BLOCK).join(costs, "pair").select(BLOCK, "pair", F.col("known").alias("n"), "bits")

    def add(block: pa.Table, facts: pa.Table) -> pa.Table:
        number = {w: i for i, w in enumerate(facts.column("pair").to_pylist())}
        n, bits = facts.column("n").to_numpy(), facts.column("bits").to_numpy()
        base = np.log10((n + 1) / (n_train + v_train + 1))
        tokens, known_, bases, scores, per_byte = [], [], [], [], []
        for t in byte_texts(block.column("text")):
            at = np.array(list(map(number.__getitem__, classed_tokens(t, groups))), dtype=np.int64)
            total = float(bits[at].sum())
            tokens.append(len(at))
            known_.append(int((n[at] > 0).sum()))
            bases.append(math.fsum(base[at].tolist()))
            scores.append(-total * math.log10(2))
            per_byte.append(total / (len(t) + 1))
        return pa.table({
            "doc_id": block.column("doc_id"), "held_out": block.column("held_out"),
            "n_tokens": pa.array(tokens, pa.int64()), "n_known": pa.array(known_, pa.int64()),
            "train_tokens": pa.array([n_train] * len(tokens), pa.int64()), "base_score": pa.array(bases, pa.float64()),
            "score": pa.array(scores, pa.float64()), "bits_per_byte": pa.array(per_byte, pa.float64())})

    return dealt.groupBy(BLOCK).cogroup(scored.groupBy(BLOCK)).applyInArrow(add, SCORE_SCHEMA)
