"""Document fingerprints by one-permutation MinHash.

Every shingle of ``SHINGLE`` words is hashed once.  The high bits of the hash pick one of ``BINS`` bins
and each bin keeps its smallest hash.  An empty bin takes the value of a bin drawn by a hash of (bin,
attempt), the same draws for all documents, until it hits one that was filled (optimal
densification).  The fingerprint stores the low ``BITS`` bits of each bin's value, hashed with its number,
packed.  Two fingerprints
agree by chance in a share of 2^-BITS of the bins, which the likeness takes out again.

Pairs with the next document.  ``neighbour_fingerprints`` deals documents into id ranges, sorts each
range and streams over it; the first row of each range is copied to the range before it, so every row
sees its successor without a window over the table.

Defined results: a null or empty text is one empty shingle, so two of them are alike; fewer words than
a shingle give the whole sequence; a single document follows itself; rows with a null id come first,
rows that repeat an id in an order fixed by their text; an empty table gives no rows; only the id and
text columns are read.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import BLOCK, KEY_HASH, KEY_ID, mix64, ordered_blocks, str_texts, with_row_key

SHINGLE = 5
BIN_BITS = 9
BINS = 1 << BIN_BITS
BITS = 4
#: Word hashes kept by a task before its cache is emptied.
CACHE_WORDS = 400_000
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_FACTORS = mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _WordHash()


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """One hash for every run of ``size`` words, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return mix64(np.zeros(1, dtype=np.uint64))
    h = np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))
    if len(h) < size:
        return mix64(np.array([np.bitwise_xor.reduce(mix64(h * _FACTORS[:len(h)]))], dtype=np.uint64))
    n = len(h) - size + 1
    total = h[:n] * _FACTORS[0]
    for k in range(1, size):
        total += h[k:k + n] * _FACTORS[k]
    return mix64(total)


def bin_minima(hashes: np.ndarray) -> np.ndarray:
    """Smallest hash of each bin, ``_EMPTY`` where there is none."""
    h = np.sort(hashes)
    at = (h >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    out = np.full(BINS, _EMPTY)
    out[at[first]] = h[first]
    return out


def densify(minima: np.ndarray) -> np.ndarray:
    """Fills the empty bins of each row (a document) by the draws that all rows share."""
    filled = minima != _EMPTY
    out = minima.copy()
    lone = filled.sum(axis=1) == 1  # every draw ends in the one bin
    if lone.any():
        out[lone] = np.take_along_axis(minima[lone], filled[lone].argmax(axis=1)[:, None], axis=1)
    row, col = np.nonzero(~filled & ~lone[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        draw = mix64(np.arange(BINS, dtype=np.uint64) + np.uint64(attempt << 20)) & np.uint64(BINS - 1)
        to = draw.astype(np.int64)[col]
        hit = filled[row, to]
        out[row[hit], col[hit]] = minima[row[hit], to[hit]]
        row, col = row[~hit], col[~hit]
    return out


def low_bits(minima: np.ndarray) -> np.ndarray:
    """The stored bits of each bin.  The bin's number goes into the hash, so that bins which share a value
    agree with another document's by chance independently of each other."""
    return (mix64(minima ^ mix64(np.arange(1, BINS + 1, dtype=np.uint64))) & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def fingerprints_of(texts: list[bytes]) -> np.ndarray:
    """One row of ``BINS`` low-bit values per text."""
    out = [np.zeros((0, BINS), dtype=np.uint8)]
    for a in range(0, len(texts), 512):
        out.append(low_bits(densify(np.stack([bin_minima(shingle_hashes(t)) for t in texts[a:a + 512]]))))
    return np.concatenate(out)


def pack(values: np.ndarray) -> list[str]:
    """Two bins to a byte, as base64."""
    packed = (values[:, ::2] << 4 | values[:, 1::2]).astype(np.uint8)
    return [base64.b64encode(row.tobytes()).decode() for row in packed]


def unpack(fingerprint: str) -> np.ndarray:
    packed = np.frombuffer(base64.b64decode(fingerprint), dtype=np.uint8)
    return np.stack([packed >> 4, packed & 15], axis=1).reshape(-1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard likeness of rows of bins, without the agreement that chance gives."""
    chance = 1 / (1 << BITS)
    return np.clip(((a == b).mean(axis=-1) - chance) / (1 - chance), 0.0, 1.0)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) for every row."""
    def run(batches):
        for b in batches:
            prints = pack(fingerprints_of([t.encode() for t in str_texts(b.column(1))]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, "doc_id long, fingerprint string")


def followed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, block, lead) in partitions sorted so that each row's successor in id order comes
    next; ``lead`` rows are copies that only close the block before theirs."""
    keyed = with_row_key(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")
    dealt = ordered_blocks(keyed, "text")
    # one row per range: ORDERED_BLOCKS rows at most
    first = sorted((r["b"], r["k"]) for r in dealt.groupBy(F.col(BLOCK).alias("b")).agg(F.min(F.struct(KEY_ID, KEY_HASH)).alias("k")).collect())
    leads = [(k[KEY_ID], k[KEY_HASH], first[i - 1][0]) for i, (_, k) in enumerate(first)]
    first = dealt.sparkSession.createDataFrame(leads, f"{KEY_ID} long, {KEY_HASH} long, __cp_lead int")
    both = dealt.join(F.broadcast(first), [KEY_ID, KEY_HASH], "left")
    places = F.when(F.col("__cp_lead").isNull(), F.array(F.struct(F.col(BLOCK).alias("b"), F.lit(False).alias("lead")))) \
        .otherwise(F.array(F.struct(F.col(BLOCK).alias("b"), F.lit(False).alias("lead")),
                           F.struct(F.col("__cp_lead").alias("b"), F.lit(True).alias("lead"))))
    placed = both.withColumn("__cp_place", F.explode(places)).select(
        "doc_id", "text", KEY_ID, KEY_HASH, F.col("__cp_place.b").alias("block"), F.col("__cp_place.lead").alias("lead"))
    return placed.repartition("block").sortWithinPartitions("block", "lead", KEY_ID, KEY_HASH) \
        .select("doc_id", "text", "block", "lead")


def edited_text(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as much of the start of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


PAIR_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
               "near_edited double, near_next double")


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", step: int = 256) -> DataFrame:
    """For every row: its fingerprint, that of its edited text (see ``edited_text``) and the likeness of its
    fingerprint to the edited text's and to the next row's."""
    def run(batches):
        held = None  # the last row seen: (block, id, text, bins)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                texts = str_texts(part.column("text"))
                bins = fingerprints_of([t.encode() for t in texts])
                rows = list(zip(part.column("block").to_pylist(), part.column("lead").to_pylist(),
                                part.column("doc_id").to_pylist(), texts, bins))
                pairs = []
                for block, lead, doc_id, text, own in rows:
                    if held is not None and held[0] == block:
                        pairs.append((held, text, own))
                    held = None if lead else (block, doc_id, text, own)
                if not pairs:
                    continue
                edited = [edited_text(h[2], t).encode() for h, t, _ in pairs]
                own, changed = np.stack([h[3] for h, _, _ in pairs]), fingerprints_of(edited)
                yield pa.RecordBatch.from_arrays([
                    pa.array([h[1] for h, _, _ in pairs], pa.int64()),
                    pa.array([len(h[2]) for h, _, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
                    pa.array(pack(own), pa.string()),
                    pa.array(pack(changed), pa.string()),
                    pa.array(likeness(own, changed), pa.float64()),
                    pa.array(likeness(own, np.stack([n for _, _, n in pairs])), pa.float64()),
                ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return followed(docs, id_col, text_col).mapInArrow(run, PAIR_SCHEMA)
