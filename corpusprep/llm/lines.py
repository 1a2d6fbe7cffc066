"""Line dedup: lines whose key occurs in many documents are dropped from all of them.

Documents are dealt into blocks of bounded size.  Each block sends, per shard, the hashes of its
distinct lines and the number of its documents that hold each: a line that every document repeats
is one number per block, so no line is hot.  A shard (a part of the hash space; their number follows
the input) builds a minimal perfect hash over its distinct line hashes, which addresses an array of
fingerprints and an array of document counts, probes those arrays with each block's hashes and sends
back the frequent ones.  Blocks then cut their lines; no line text ever leaves its document.

A line is identified by the 64-bit XXH3 hash of its key.

Defined results: a null or empty text is one empty line, which has an empty key and always stays; a
document may lose all its lines and is then empty; repeated rows count as separate documents; an
empty table gives no rows.  All columns are kept; ``text`` is replaced and ``n_lines`` and
``n_dropped`` are added (columns of these names are replaced).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.llm.common import BLOCK, BLOCK_BYTES, block_count, block_of, byte_texts, mix64, release_memory, with_row_key

GAMMA = 1.6


class MinimalPerfectHash:
    """Distinct 64-bit keys to 0 .. n - 1.  Each level is a bit array with a set bit wherever exactly
    one key lands; keys that collide go on to the next level.  The slot of a key is the number of set
    bits before its own."""

    def __init__(self, keys: np.ndarray):
        self.levels = []
        base, seed = 0, 1
        while len(keys):
            size = max(64, -(-int(GAMMA * len(keys)) // 64) * 64)
            at = self._at(keys, seed, size)
            alone = np.bincount(at, minlength=size) == 1
            words = np.packbits(alone, bitorder="little").view(np.uint64)
            ones = np.bitwise_count(words).astype(np.int64)
            self.levels.append((seed, size, words, base + np.cumsum(ones) - ones))
            base += int(ones.sum())
            keys, seed = keys[~alone[at]], seed + 1
        self.size = base

    @staticmethod
    def _at(keys: np.ndarray, seed: int, size: int) -> np.ndarray:
        return (mix64(keys + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for a key that falls through every level."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for seed, size, words, before in self.levels:
            if not len(left):
                break
            at = self._at(keys[left], seed, size)
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[left[hit]] = before[at[hit] >> 6] + below[hit]
            left = left[~hit]
        return out


class LineCounts:
    """Fingerprint and count arrays addressed by a minimal perfect hash over distinct line hashes."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        distinct, at = np.unique(hashes, return_inverse=True)
        total = np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.int64)
        self.index = MinimalPerfectHash(distinct)
        slot = self.index.slots(distinct)
        self.prints = np.empty(len(distinct), dtype=np.uint32)
        self.counts = np.empty(len(distinct), dtype=np.uint32)
        self.prints[slot] = self._print(distinct)
        self.counts[slot] = np.minimum(total, 0xFFFFFFFF)

    @staticmethod
    def _print(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(32)).astype(np.uint32)

    def count(self, hashes: np.ndarray) -> np.ndarray:
        """Documents that hold each line; 0 where the fingerprint differs."""
        slot = self.index.slots(hashes)
        known = slot >= 0
        out = np.zeros(len(hashes), dtype=np.int64)
        here = slot[known]
        out[known] = np.where(self.prints[here] == self._print(hashes[known]), self.counts[here], 0)
        return out


def line_key(line: bytes) -> bytes:
    return line.strip(b" \t\n\r\x0b\x0c").lower()


def line_hashes(text: bytes, min_chars: int) -> list[int | None]:
    """Per line the hash of its key, None where the key has fewer than ``min_chars`` code points."""
    out: list[int | None] = []
    for line in text.split(b"\n"):
        key = line_key(line)
        if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
            out.append(None)
        else:
            out.append(xxhash.xxh3_64_intdigest(key))
    return out


def drop_frequent_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
                        min_chars: int = 1, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the lines whose key, of ``min_chars`` code points or more, occurs in at least
    ``min_docs`` documents; with ``n_lines`` (before) and ``n_dropped``."""
    min_chars = max(1, min_chars)
    n_blocks = block_count(docs, text_col, block_bytes)
    n_shards = -(-n_blocks // 4)
    keyed = with_row_key(docs.drop("n_lines", "n_dropped"), id_col, text_col)
    dealt = keyed.withColumn(BLOCK, block_of(n_blocks))
    names = dealt.columns
    text_at, block_at = names.index(text_col), names.index(BLOCK)

    def sent(key: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
        per_doc = []
        for t in byte_texts(block.column(text_at)):
            found = {h for h in line_hashes(t, min_chars) if h is not None}
            per_doc.append(np.fromiter(found, dtype=np.uint64, count=len(found)))
        hashes, counts = np.unique(np.concatenate(per_doc), return_counts=True)
        shard = (mix64(hashes) % np.uint64(n_shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        hashes, counts = hashes[order], counts[order].astype(np.uint32)
        shards, first = np.unique(shard[order], return_index=True)
        ends = np.append(first[1:], len(hashes))
        return pa.table({
            "shard": pa.array(shards.astype(np.int32)),
            "block": pa.array(np.full(len(shards), key[0].as_py(), dtype=np.int32)),
            "hashes": pa.array([hashes[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
            "counts": pa.array([counts[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
        })

    def probed(shard: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x, dtype=np.uint64) for x in shard.column("hashes").to_pylist()]
        counts = [np.frombuffer(x, dtype=np.uint32) for x in shard.column("counts").to_pylist()]
        index = LineCounts(np.concatenate(hashes), np.concatenate(counts))
        frequent = [h[index.count(h) >= min_docs] for h in hashes]
        keep = [i for i, h in enumerate(frequent) if len(h)]
        return pa.table({
            BLOCK: shard.column("block").take(pa.array(keep, pa.int64())).cast(pa.int32()),
            "frequent": pa.array([frequent[i].tobytes() for i in keep], pa.binary()),
        })

    def cut(block: pa.Table, frequent: pa.Table) -> pa.Table:
        drop = set()
        for x in frequent.column("frequent").to_pylist():
            drop.update(np.frombuffer(x, dtype=np.uint64).tolist())
        texts, lines, dropped = [], [], []
        given = block.column(text_at)
        for t, is_null in zip(byte_texts(given), given.is_null().to_pylist()):
            found = line_hashes(t, min_chars)
            gone = sum(h in drop for h in found) if drop else 0
            lines.append(len(found))
            dropped.append(gone)
            if gone:
                t = b"\n".join(line for line, h in zip(t.split(b"\n"), found) if h not in drop)
            texts.append(None if is_null else t.decode("utf-8", "replace"))
        out = block.set_column(text_at, text_col, pa.array(texts, pa.string()))
        out = out.select([i for i in range(len(names)) if i not in inner])
        release_memory()
        return out.append_column("n_lines", pa.array(lines, pa.int64())).append_column("n_dropped", pa.array(dropped, pa.int64()))

    inner = {i for i, n in enumerate(names) if n.startswith("__cp_")}
    schema = T.StructType([f for f in dealt.schema if not f.name.startswith("__cp_")]
                          + [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    packed = dealt.groupBy(BLOCK).applyInArrow(sent, "shard int, block int, hashes binary, counts binary")
    frequent = packed.groupBy("shard").applyInArrow(probed, f"{BLOCK} int, frequent binary")
    return dealt.groupBy(BLOCK).cogroup(frequent.groupBy(BLOCK)).applyInArrow(cut, schema)

