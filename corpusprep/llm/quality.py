"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Features of a text are its words and pairs of neighbouring words, as they stand and as shapes (runs of
capitals, small letters, digits, each other character once), hashed to ``DIMENSIONS`` slots.  A slot's
value is log(1 + count), the whole scaled to unit length, so long texts weigh as much as short ones.

Training reads at most ``TRAIN_ROWS`` labelled rows (those of the smallest id hashes; the bound is a
parameter).  Their features are made where the texts lie; one task runs the updates in hash order over
the sparse rows.  The model is one weight per slot, at most 4 MB whatever the data, and scoring is a
sparse dot product in the scan, without any shuffle.

Defined results: a null or empty text has only the bias and gets its score; rows that repeat are scored
each; several labels for a document count as the larger one; labels that are null or of unknown
documents are ignored; without any label every score is 0.5; an empty table gives no rows.  All columns
of the documents are kept, and ``score`` and ``predicted`` are added (columns of these names are
replaced).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.llm.common import byte_texts, mix64, release_memory, slices

DIMENSIONS = 1 << 20
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.01, 0.05, 3
#: Words kept by a task before its cache is emptied.
CACHE_WORDS = 100_000

_CLASSES = bytes(
    ord("X") if 0x41 <= b <= 0x5A else ord("x") if 0x61 <= b <= 0x7A or b >= 0x80 else ord("9") if 0x30 <= b <= 0x39 else b
    for b in range(256))


def shape(word: bytes) -> bytes:
    """Character classes with each run written once."""
    mapped = word.translate(_CLASSES)
    return bytes(b for i, b in enumerate(mapped) if not i or b != mapped[i - 1])


class _WordHash(dict):
    """Hashes of a word and of its shape, as one integer of 128 bits' two halves."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = h = (xxhash.xxh3_64_intdigest(word, 1), xxhash.xxh3_64_intdigest(shape(word), 2))
        return h


_WORDS = _WordHash()


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(distinct slots, values) of a text; slot 0 is the bias."""
    words = text.split()
    if not words:
        return np.zeros(1, dtype=np.int32), np.ones(1, dtype=np.float32)
    h = np.array(list(map(_WORDS.__getitem__, words)), dtype=np.uint64)
    pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + mix64(h[1:])
    slots = 1 + (mix64(np.concatenate([h, pairs]).reshape(-1)) % np.uint64(DIMENSIONS - 1)).astype(np.int64)
    slots.sort()
    first = np.flatnonzero(np.append(True, slots[1:] != slots[:-1]))
    value = np.log1p(np.diff(np.append(first, len(slots))))
    value /= np.sqrt((value ** 2).sum())
    return np.append(0, slots[first]).astype(np.int32), np.append(1.0, value).astype(np.float32)


class Ftrl:
    """Follow-the-regularised-leader with per-slot learning rates and L1 and L2 penalties."""

    def __init__(self):
        self.z, self.n = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)

    def weights(self, slots=slice(None)) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def update(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(slots)
        error = 1 / (1 + np.exp(-float(w @ values))) - label
        g = error * values
        n = self.n[slots]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA
        self.z[slots] += g - sigma * w
        self.n[slots] = n + g * g


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          usable: Column | None = None, rows: int = TRAIN_ROWS) -> bytes:
    """The weights (float32 per slot) learned from the labelled documents; ``usable`` restricts the
    labels that may be learned from."""
    picked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if usable is not None:
        picked = picked.where(usable)
    picked = picked.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label")) \
        .withColumn("turn", F.xxhash64("id")).orderBy("turn", "id").limit(rows)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def featured(batches):
        for b in slices(batches):
            rows_ = [features(t) for t in byte_texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("turn"), b.column("id"), b.column("label"), pa.array([s for s, _ in rows_], pa.list_(pa.int32())),
                 pa.array([v for _, v in rows_], pa.list_(pa.float32()))], names=["turn", "id", "label", "slots", "vals"])
        _WORDS.clear()
        release_memory()

    # at most ``rows`` ids and labels: 16 bytes each
    sample = texts.join(F.broadcast(picked), "id").select("turn", "id", "label", "text") \
        .mapInArrow(featured, "turn long, id long, label int, slots array<int>, vals array<float>") \
        .repartition(1).sortWithinPartitions("turn", "id", "slots")

    def learn(batches):
        held = []
        for b in batches:
            slots, vals = b.column("slots"), b.column("vals")
            for y, s, v in zip(b.column("label").to_pylist(), slots, vals):
                held.append((s.values.to_numpy(), v.values.to_numpy().astype(np.float64), y))
        model = Ftrl()
        for _ in range(EPOCHS):
            for s, v, y in held:
                model.update(s, v, y)
        weights = model.weights().astype("<f4").tobytes()
        del held, model
        release_memory()
        yield pa.RecordBatch.from_arrays([pa.array([weights], pa.binary())], names=["w"])

    got = sample.mapInArrow(learn, "w binary").collect()
    return bytes(got[0]["w"]) if got else np.zeros(DIMENSIONS, dtype="<f4").tobytes()


def score(docs: DataFrame, weights: bytes, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on)."""
    kept = docs.drop("score", "predicted")
    text_at = kept.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 4 bytes per slot

    def run(batches):
        w = np.frombuffer(shared.value, dtype="<f4")
        for b in slices(batches):
            out = np.empty(b.num_rows)
            for i, t in enumerate(byte_texts(b.column(text_at))):
                slots, values = features(t)
                out[i] = 1 / (1 + np.exp(-float(w[slots] @ values)))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(out, pa.float64()), pa.array((out >= threshold).astype(np.int32))],
                names=[*b.schema.names, "score", "predicted"])
        _WORDS.clear()
        release_memory()

    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return kept.mapInArrow(run, schema)
