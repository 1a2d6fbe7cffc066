"""Suffix-array dedup: every byte covered by a string of ``span`` bytes that occurs elsewhere too.

1. Anchors.  Each start position of a string belongs to the smallest hashed ``gram`` inside the string
   (the leftmost of equals), its anchor.  Equal strings have equal anchors at equal offsets, so only starts
   with the same anchor hash can match.  A document becomes runs of neighbouring starts with one anchor.
2. Anchors that occur once match nothing.  If all runs of an anchor have the same bytes (copies), all their
   starts match.  Only anchors with different runs are compared byte by byte.
3. The distinct runs of such anchors are gathered into shards of bounded size.  A shard sorts its suffixes by
   Larsson-Sadakane refinement (prefix doubling on group numbers, only groups still unsorted are sorted again),
   takes the common prefixes of neighbours by Kasai's rule, and marks starts that share ``span`` bytes with a
   neighbour.  An anchor with more bytes than a shard is dealt over several; each pair of its shards is merged
   by binary search of one's strings in the other's sorted starts.
4. Marked starts go back to their documents, in blocks of bounded size, which cut the covered bytes.

Runs are compared by the 64-bit hash of their bytes beside the 64-bit anchor hash; bytes travel only for
anchors of step 3, picked in a second scan by a Bloom filter sized by their number (which may let others through;
an exact join follows).  Runs of a key that holds a large share of all rows are not shuffled by it.

Defined results: a null or empty text has no bytes; texts shorter than ``span`` never match; repeated rows
are separate places, so all of a long repeated text goes; an empty table gives no rows.  Only the id and
text columns are read.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import (BLOCK, BLOCK_BYTES, KEY_HASH, KEY_ID, block_count, block_of, byte_texts, mix64, ranges,
                                   saved, with_row_key)

SPAN = 400
#: Text bytes of one suffix-array shard.
SHARD_BYTES = 1 << 20
#: Texts are scanned for anchors in pieces of so many starts.
PIECE = 1 << 22
#: The filter has 16 bits for each mixed anchor, and 2^20 (128 kB) to 2^28 (32 MB) in all.
FILTER_BITS = (20, 28)
#: A key of more than one in so many rows is heavy; there are fewer than so many of them.
HEAVY_SHARE = 1000
_PLACE = np.uint64((1 << 24) - 1)


# --- anchors -------------------------------------------------------------------------------------


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    ones = np.ones(n, dtype=np.uint64)
    up, down = ones.copy(), ones.copy()
    up[1:], down[1:] = base, inverse
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


_UP, _DOWN = _powers(1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes at each position."""
    global _UP, _DOWN
    if len(_UP) < len(data) + 1:
        _UP, _DOWN = _powers(max(len(data) + 1, 1 << 17))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[:len(data)], out=total[1:])
    n = len(data) - gram + 1
    return mix64((total[gram:] - total[:n]) * _DOWN[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values in a row, from prefix and suffix minima of blocks."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def runs_of(text: bytes, span: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, number of starts, anchor hash) of each run."""
    firsts, sizes, anchors = [], [], []
    for at in range(0, len(text) - span + 1, PIECE):
        data = np.frombuffer(text, dtype=np.uint8, count=min(PIECE + span - 1, len(text) - at), offset=at)
        h = gram_hashes(data, gram)
        least = sliding_min((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), span - gram + 1) & _PLACE
        first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        firsts.append(first + at)
        sizes.append(np.diff(np.append(first, len(least))))
        anchors.append(h[least[first].astype(np.int64)])
    if not firsts:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none.astype(np.uint64)
    return np.concatenate(firsts), np.concatenate(sizes), np.concatenate(anchors)


# --- suffix arrays -------------------------------------------------------------------------------


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one big-endian number; zeros follow the end."""
    padded = np.zeros(len(data) + 8, dtype=np.uint64)
    padded[:len(data)] = data
    out = np.zeros(len(data), dtype=np.uint64)
    for k in range(8):
        out = out << np.uint64(8) | padded[k:k + len(data)]
    return out


def suffix_array(data: np.ndarray, depth: int, eight: np.ndarray | None = None) -> np.ndarray:
    """Positions in the order of their next ``depth`` bytes or more."""
    n = len(data)
    eight = eight_bytes(data) if eight is None else eight
    order = np.argsort(eight, kind="stable")
    key = eight[order]
    head = np.append(True, key[1:] != key[:-1])
    # a position near the end is no longer than its bytes: its zeros are no bytes of the text
    group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n + 1, dtype=np.int64)
    rank[order], rank[n] = group + 1, 0
    h = 8
    single = head & np.append(head[1:], True)
    active = np.flatnonzero(~single)
    while h < depth and len(active):
        at = order[active]
        key = rank[at] * np.int64(n + 2) + rank[np.minimum(at + h, n)]
        by = np.argsort(key, kind="stable")
        order[active], key = at[by], key[by]
        head = np.append(True, key[1:] != key[:-1])
        first = np.maximum.accumulate(np.where(head, np.arange(len(active)), 0))
        rank[order[active]] = active[first] + 1
        single = head & np.append(head[1:], True)
        active = active[~single]
        h *= 2
    return order


def _common(eight: np.ndarray, other: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix, ``depth`` at most, of the strings at ``a`` and ``b``, ``known`` bytes of
    which are known to agree."""
    length = known.copy()
    active = np.flatnonzero(length < depth)
    while len(active):
        at = length[active]
        differ = eight[a[active] + at] ^ other[b[active] + at]
        same = differ == 0
        more = np.full(len(active), 8, dtype=np.int64)  # equal leading bytes
        for k in range(1, 9):
            more -= differ >> np.uint64(64 - 8 * k) != 0
        length[active] = np.minimum(at + more, depth)
        active = active[same & (length[active] < depth)]
    return length


def neighbour_prefixes(eight: np.ndarray, starts: np.ndarray, before: np.ndarray, depth: int, stride: int = 32) -> np.ndarray:
    """Common prefix of each start (in text order) with its predecessor in suffix order (-1: none).

    Kasai's rule: moving on by one byte, the common prefix shrinks by one at most, if the predecessor moves on
    too.  Starts that agree in more bytes than were sorted stand in any order, so the next start often has another
    predecessor; it is then compared from its first byte, as every ``stride``-th start is.  The others follow
    in ``stride`` rounds, each over all strides at once."""
    n = len(starts)
    out = np.zeros(n, dtype=np.int64)
    for r in range(stride):
        at = np.arange(r, n, stride)
        known = np.zeros(len(at), dtype=np.int64)
        if r:
            prev = at - 1
            follows = (starts[at] == starts[prev] + 1) & (before[prev] >= 0) & (before[at] == before[prev] + 1)
            known = np.where(follows, np.maximum(out[prev] - 1, 0), 0)
        has = before[at] >= 0
        at, known = at[has], known[has]
        out[at] = _common(eight, eight, starts[at], before[at], known, depth)
    return out


class Shard:
    """Sorted starts of a list of strings; a start has ``span`` bytes left in its string."""

    def __init__(self, texts: list[bytes], span: int):
        self.span = span
        self.sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.first = np.cumsum(self.sizes) - self.sizes
        counts = self.sizes - span + 1
        self.starts = ranges(self.first, counts)
        self.text = np.repeat(np.arange(len(texts)), counts)
        self.eight = np.concatenate([eight_bytes(data), np.zeros(span + 8, dtype=np.uint64)])
        order = suffix_array(data, span, self.eight[:len(data)])
        number = np.full(len(data), -1, dtype=np.int64)
        number[self.starts] = np.arange(len(self.starts))
        self.sorted = order[number[order] >= 0]
        self.number = number
        self.marked = np.zeros(len(self.starts), dtype=bool)

    def mark_inside(self) -> None:
        """Marks starts that share ``span`` bytes with another start of the shard."""
        if len(self.sorted) < 2:
            return
        before = np.full(len(self.starts), -1, dtype=np.int64)
        before[self.number[self.sorted[1:]]] = self.sorted[:-1]
        whole = neighbour_prefixes(self.eight, self.starts, before, self.span) >= self.span
        self.marked |= whole
        self.marked[self.number[before[whole]]] = True

    def mark_across(self, other: Shard) -> None:
        """Marks starts of either shard whose string occurs in the other, by binary search in its order."""
        low = np.zeros(len(self.starts), dtype=np.int64)
        high = np.full(len(self.starts), len(other.sorted), dtype=np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) // 2
            below = self._compare(other, self.starts[open_], other.sorted[mid]) > 0  # the other string is smaller
            low[open_[below]] = mid[below] + 1
            high[open_[~below]] = mid[~below]
        found = np.flatnonzero(low < len(other.sorted))
        found = found[self._compare(other, self.starts[found], other.sorted[low[found]]) == 0]
        self.marked[found] = True
        other.marked[other.number[other.sorted[low[found]]]] = True

    def _compare(self, other: Shard, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        common = _common(self.eight, other.eight, a, b, np.zeros(len(a), dtype=np.int64), self.span)
        out = np.zeros(len(a), dtype=np.int64)
        apart = common < self.span
        x, y = self.eight[a[apart] + common[apart]] >> np.uint64(56), other.eight[b[apart] + common[apart]] >> np.uint64(56)
        out[apart] = np.where(x < y, -1, 1)
        return out

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(string, first marked start in it, marked starts in a row)."""
        at = np.flatnonzero(self.marked)
        if not len(at):
            return at, at, at
        fresh = np.append(True, (np.diff(at) != 1) | (np.diff(self.text[at]) != 0))
        first = at[fresh]
        sizes = np.diff(np.append(np.flatnonzero(fresh), len(at)))
        return self.text[first], self.starts[first] - self.first[self.text[first]], sizes


# --- over the cluster ----------------------------------------------------------------------------


RUN_SCHEMA = f"{KEY_ID} long, {KEY_HASH} long, {BLOCK} int, first long, size long, anchor long, bytes_hash long"


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(x).astype(np.uint64).view(np.int64))


def document_runs(keyed: DataFrame, span: int, gram: int) -> DataFrame:
    """One row per run of starts with one anchor."""
    def run(batches):
        for b in batches:
            ids, hashes, blocks = (b.column(i).to_numpy() for i in range(3))
            for a in range(0, b.num_rows, 1000):
                rows, firsts, sizes, anchors, digests = [], [], [], [], []
                for i, t in enumerate(byte_texts(b.column(3).slice(a, 1000)), a):
                    if len(t) < span:
                        continue
                    f, n, h = runs_of(t, span, gram)
                    rows.append(np.full(len(f), i))
                    firsts.append(f)
                    sizes.append(n)
                    anchors.append(h)
                    digests += [xxhash.xxh3_64_intdigest(t[x:y]) for x, y in zip(f.tolist(), (f + n + span - 1).tolist())]
                if rows:
                    at = np.concatenate(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at]), pa.array(hashes[at]), pa.array(blocks[at].astype(np.int32)), pa.array(np.concatenate(firsts)),
                         pa.array(np.concatenate(sizes)), _signed(np.concatenate(anchors)), _signed(np.array(digests, dtype=np.uint64))],
                        names=[KEY_ID, KEY_HASH, BLOCK, "first", "size", "anchor", "bytes_hash"])

    return keyed.select(KEY_ID, KEY_HASH, BLOCK, "text").mapInArrow(run, RUN_SCHEMA)


def filter_bits(n: int) -> int:
    return min(max((16 * n).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])


def filter_of(anchors: DataFrame, bits: int) -> np.ndarray:
    """A bit array of 2^bits bits with the bit of every anchor set; its words are put together on the
    executors."""
    place = F.col("anchor").bitwiseAND(F.lit((1 << bits) - 1))
    words = anchors.select(F.shiftright(place, 6).alias("w"), F.expr("shiftleft(1L, cast(anchor & 63 as int))").alias("b")) \
        .groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    for row in words.toLocalIterator():
        out[row["w"]] = np.uint64(row["b"] % (1 << 64))
    return out


def run_texts(keyed: DataFrame, shared, span: int, gram: int, bits: int) -> DataFrame:
    """(anchor, bytes_hash, body): the bytes of runs whose anchor passes the filter, each once per batch."""
    def run(batches):
        wanted = shared.value
        for b in batches:
            seen: set = set()
            rows: list = []
            held = 0
            for t in byte_texts(b.column(0)):
                if len(t) < span:
                    continue
                f, n, h = runs_of(t, span, gram)
                place = h & np.uint64((1 << bits) - 1)
                hit = np.flatnonzero(wanted[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1))
                for k in hit.tolist():
                    body = t[int(f[k]):int(f[k] + n[k]) + span - 1]
                    name = (int(h[k]), xxhash.xxh3_64_intdigest(body))
                    if name not in seen:
                        seen.add(name)
                        rows.append((*name, body))
                        held += len(body)
                if held > 8 << 20:
                    yield _texts(rows)
                    rows, held = [], 0
            if rows:
                yield _texts(rows)

    return keyed.select("text").mapInArrow(run, "anchor long, bytes_hash long, body binary")


def _texts(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_signed(np.array([r[0] for r in rows], dtype=np.uint64)), _signed(np.array([r[1] for r in rows], dtype=np.uint64)),
                                       pa.array([r[2] for r in rows], pa.binary())], names=["anchor", "bytes_hash", "body"])


MARK_SCHEMA = "anchor long, bytes_hash long, offset long, size long"


def marked_starts(texts: DataFrame, span: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(anchor, bytes_hash, offset, size): starts of each distinct run whose string occurs at another start
    of a run with the same anchor."""
    sizes = texts.groupBy("anchor").agg(F.sum(F.octet_length("body")).alias("held"))
    parts = F.ceil(F.col("held") / shard_bytes).cast("int")
    dealt = texts.join(sizes, "anchor").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("bytes_hash"), F.col("parts")).cast("int"))
    units = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda q: F.struct(F.least("part", q).alias("i"), F.greatest("part", q).alias("j")))
    placed = dealt.withColumn("u", F.explode(units)).select("anchor", "bytes_hash", "body", "parts", "part", F.col("u.i").alias("i"), F.col("u.j").alias("j"))
    placed = placed.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j")

    def run(batches):
        unit, split, rows, held = None, False, [], 0  # rows: (anchor, bytes_hash, body, on the j side)

        def flush():
            left, right = [r for r in rows if not r[3]], [r for r in rows if r[3]]
            shards = [Shard([r[2] for r in side], span) for side in (left, right) if side]
            if len(shards) == 2:
                shards[0].mark_across(shards[1])
            else:
                shards[0].mark_inside()
            for side, shard in zip((s for s in (left, right) if s), shards):
                text, offset, size = shard.runs()
                if len(text):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([side[k][0] for k in text.tolist()], pa.int64()), pa.array([side[k][1] for k in text.tolist()], pa.int64()),
                         pa.array(offset), pa.array(size)], names=["anchor", "bytes_hash", "offset", "size"])

        for b in batches:
            for anchor, digest, body, n, part, i, j in zip(*(b.column(c).to_pylist() for c in ("anchor", "bytes_hash", "body", "parts", "part", "i", "j"))):
                # whole small anchors share a shard; a part of a large one has its own
                now = (anchor, i, j)
                if rows and now != unit and (n > 1 or split or held >= shard_bytes):
                    yield from flush()
                    rows, held = [], 0
                unit, split = now, n > 1
                rows.append((anchor, digest, body, i != j and part == j))
                held += len(body)
        if rows:
            yield from flush()

    return placed.mapInArrow(run, MARK_SCHEMA)


def heavy_keys(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that hold more than one in ``HEAVY_SHARE`` of all rows, from the number ``n`` of rows of each key."""
    total = counts.agg(F.sum("n").alias("t")).collect()[0]["t"] or 0
    return saved(counts.where(F.col("n") * HEAVY_SHARE > total).select(*keys), "heavy-keys")


def heavy_join(left: DataFrame, right: DataFrame, keys: list[str], heavy: DataFrame, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``.  Rows of heavy keys (fewer than ``HEAVY_SHARE``, so their part of ``right`` is small)
    stay where they are and meet a broadcast; all others are shuffled."""
    hot = F.broadcast(heavy)
    few = left.join(hot, keys, "left_semi").join(F.broadcast(right.join(hot, keys, "left_semi")), keys, how)
    return few.unionByName(left.join(hot, keys, "left_anti").join(right.join(hot, keys, "left_anti"), keys, how))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, gram: int | None = None,
                block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) for every row: its bytes without those covered by a
    string of ``span`` bytes that starts at another place too, judged on the input."""
    gram = gram or max(1, span // 4)
    n_blocks = block_count(docs, text_col, block_bytes)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keyed = with_row_key(rows, "doc_id", "text").withColumn(BLOCK, block_of(n_blocks))
    runs = saved(document_runs(keyed, span, gram), "runs")
    anchors = saved(runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("bytes_hash").alias("low"), F.max("bytes_hash").alias("high"))
                    .where("n > 1").select("anchor", "n", (F.col("low") == F.col("high")).alias("alike")), "anchors")
    met = heavy_join(runs, anchors.drop("n"), ["anchor"], heavy_keys(anchors, ["anchor"]))
    copies = met.where("alike")
    mixed = saved(met.where("not alike").drop("alike"), "mixed-runs")
    named = ["anchor", "bytes_hash"]
    distinct = saved(mixed.groupBy(*named).agg(F.count(F.lit(1)).alias("n")), "distinct-runs")
    heavy = heavy_keys(distinct, named)
    bits = filter_bits(anchors.where("not alike").count())
    shared = docs.sparkSession.sparkContext.broadcast(filter_of(mixed.select("anchor"), bits))  # 32 MB at most
    texts = run_texts(keyed, shared, span, gram, bits).join(distinct.select(*named), named, "left_semi") \
        .groupBy(*named).agg(F.first("body").alias("body"))
    marks = saved(marked_starts(saved(texts, "run-texts"), span, shard_bytes), "marked-starts")
    twice = distinct.where("n > 1").select(*named)
    repeated = heavy_join(mixed, twice, named, heavy, "left_semi")
    partly = heavy_join(mixed.select(KEY_ID, KEY_HASH, BLOCK, "first", *named), marks, named, heavy) \
        .select(KEY_ID, KEY_HASH, BLOCK, (F.col("first") + F.col("offset")).alias("first"), "size")
    spans = copies.select(KEY_ID, KEY_HASH, BLOCK, "first", "size") \
        .unionByName(repeated.select(KEY_ID, KEY_HASH, BLOCK, "first", "size")).unionByName(partly)

    def cut(block: pa.Table, found: pa.Table) -> pa.Table:
        by_row = defaultdict(list)
        for a, b, f, n in zip(*(found.column(c).to_pylist() for c in (KEY_ID, KEY_HASH, "first", "size"))):
            by_row[a, b].append((f, f + n + span - 1))
        out = []
        for a, b, t in zip(block.column(KEY_ID).to_pylist(), block.column(KEY_HASH).to_pylist(), byte_texts(block.column("text"))):
            kept, at, removed, n_spans = [], 0, 0, 0
            for f, e in _merged(by_row.get((a, b), ())):
                kept.append(t[at:f])
                at, removed, n_spans = e, removed + e - f, n_spans + 1
            kept.append(t[at:])
            out.append((len(t), removed, n_spans, b"".join(kept)))
        return pa.table({"doc_id": block.column("doc_id"), "n_bytes": pa.array([o[0] for o in out], pa.int64()),
                         "n_removed": pa.array([o[1] for o in out], pa.int64()), "n_spans": pa.array([o[2] for o in out], pa.int64()),
                         "kept": pa.array([o[3] for o in out], pa.binary())})

    return keyed.groupBy(BLOCK).cogroup(spans.groupBy(BLOCK)).applyInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def _merged(spans) -> list[tuple[int, int]]:
    """Maximal runs of touching intervals."""
    out: list[tuple[int, int]] = []
    for f, e in sorted(spans):
        if out and f <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((f, e))
    return out
