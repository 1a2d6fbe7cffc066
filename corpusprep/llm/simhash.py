"""SimHash near-duplicates: one 64-bit fingerprint per text and the components of fingerprints that
differ in few bits.

Search.  Two fingerprints within ``d`` bits agree on at least one of ``d + 1`` bit blocks.  Each
block's mask with a fingerprint's bits under it is an upper node, shared by all fingerprints with
that masked pattern; nodes are spread over the cluster by a hash shuffle.  A node with too many
fingerprints is replaced by its children, whose masks add one of ``d + 1`` parts of the bits still
open, so no pair is lost; after four levels so few bits are open that a node is small whatever
the data.  Inside a node the fingerprints are sorted by Gray rank (neighbours share long bit
patterns), runs of them are factored into a tree whose nodes hold the bits common to all below, and
the search descends it adding up differences and dropping every subtree above the bound.

Only distinct fingerprints are searched, so a group of equal texts costs one entry, and each node
reports a spanning forest of its links instead of all pairs.  Components come from rounds of
large-star and small-star minimum propagation over those links.

Defined results: a null or empty text has no words and the fingerprint zero, linked like any other;
a repeated row gets a result row each; a null ``doc_id`` stays null and is ignored when the smallest
id of a component is taken (null if all of them are null); an empty table gives no rows.  Only the
id and text columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import KEY_HASH, KEY_ID, byte_texts, components, map_batches, ranges, saved, with_row_key

SEED = 42
NODE_LIMIT = 4096
FAN = 8
LEVELS = 4
_LANES = np.uint64(0x0101010101010101)


def fingerprint_of(text: bytes, shingle: int = 3) -> int:
    """The majority bit of the XXH64 of each word shingle, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    m = len(words) - shingle + 1
    if m <= 1:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter([digest(line[s:e], SEED) for s, e in zip(starts[:m].tolist(), ends[shingle - 1:].tolist())],
                    dtype=np.uint64, count=m)
    cuts = np.arange(0, m, 255)
    counts = np.zeros(64, dtype=np.int64)
    for bit in range(8):  # eight byte lanes are summed at once, 255 rows at most before they could overflow
        lanes = np.add.reduceat((h >> np.uint64(bit)) & _LANES, cuts)
        counts[bit::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > m, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp long) for every row."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.fromiter((fingerprint_of(t, shingle) for t in byte_texts(batch.column(1))),
                         dtype=np.uint64, count=batch.num_rows)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(d, run, "doc_id long, fp long")


# --- search inside nodes -------------------------------------------------------------------------


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray order."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class GrayForest:
    """One tree per list of codes; level 0 holds the codes in Gray order, each level above the bits
    that all codes of ``FAN`` nodes below have in common."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray):
        owner = np.repeat(np.arange(len(sizes)), sizes)
        self.order = np.lexsort((gray_rank(codes), owner))
        self.codes = codes[self.order]
        self.owner = owner
        low = high = self.codes
        counts = sizes.astype(np.int64)
        self.levels = []  # from the leaves up: mask, bits, first child, number of children, last leaf
        last = np.arange(len(codes))
        n = len(codes)
        self.levels.append((np.full(n, ~np.uint64(0)), self.codes, None, None, last))
        while counts.max(initial=0) > 1:
            above = -(-counts // FAN)
            first = np.repeat(np.cumsum(counts) - counts, above) + FAN * ranges(np.zeros(len(counts)), above)
            low, high = np.bitwise_and.reduceat(low, first), np.bitwise_or.reduceat(high, first)
            below = np.diff(np.append(first, n))
            mask = ~(low ^ high)
            last = last[first + below - 1]
            self.levels.append((mask, low & mask, first, below, last))
            counts, n = above, len(first)

    def links(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, later leaf of the same list) within ``distance`` bits; positions in Gray order."""
        top = self.levels[-1]
        q, node = queries, self.owner[queries]
        code = self.codes[q]
        diff = np.bitwise_count((code ^ top[1][node]) & top[0][node]).astype(np.int64)
        if len(self.levels) == 1:
            return q[:0], q[:0]
        for level in range(len(self.levels) - 1, 0, -1):
            mask, _, first, below, _ = self.levels[level]
            down_mask, down_bits, _, _, down_last = self.levels[level - 1]
            reps = below[node]
            child = ranges(first[node], reps)
            q, diff, up_mask = np.repeat(q, reps), np.repeat(diff, reps), np.repeat(mask[node], reps)
            keep = down_last[child] > q  # a subtree that ends before the query was searched from there
            q, diff, up_mask, child = q[keep], diff[keep], up_mask[keep], child[keep]
            diff = diff + np.bitwise_count((self.codes[q] ^ down_bits[child]) & down_mask[child] & ~up_mask)
            keep = diff <= distance
            q, diff, node = q[keep], diff[keep], child[keep]
        return q, node


def forest_links(codes: np.ndarray, sizes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (code, smallest-position code) of the links inside each list."""
    forest = GrayForest(codes, sizes)
    work = np.cumsum(np.repeat(sizes, sizes).astype(np.int64))
    label = np.arange(len(codes), dtype=np.int64)
    at = 0
    while at < len(codes):  # blocks of queries with a bounded number of pairs
        end = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + (1 << 21), side="right")))
        a, b = forest.links(np.arange(at, min(end, len(codes))), distance)
        label = components(len(codes), a, b, label)
        at = end
    node = np.nonzero(label != np.arange(len(codes)))[0]
    return forest.codes[node], forest.codes[label[node]]


# --- nodes over the cluster ----------------------------------------------------------------------


def block_masks(bits: list[int], parts: int) -> list[int]:
    """``bits`` cut into ``parts`` runs, each as a mask."""
    cut = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << b for b in bits[x:y]) for x, y in zip(cut, cut[1:])]


def mask_tree(distance: int, levels: int = LEVELS) -> list[int]:
    """Masks of the node tree: node 0 fixes nothing; the children of node i are i * p + 1 .. i * p + p."""
    p, tree = distance + 1, [0]
    for i in range(sum(p ** k for k in range(levels))):
        open_bits = [b for b in range(64) if not tree[i] >> b & 1]
        tree += [tree[i] | m for m in block_masks(open_bits, p)]
    return tree


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def hamming_links(fps: DataFrame, distance: int = 2, node_limit: int = NODE_LIMIT) -> DataFrame:
    """(a, b): links that connect every two fingerprints of the column ``fp`` (distinct values) within
    ``distance`` bits, directly or over others."""
    p = distance + 1
    tree = mask_tree(distance)
    masks = F.array(*[F.lit(_signed(m)) for m in tree])

    def children(df: DataFrame, parent) -> DataFrame:
        node = df.select("fp", F.explode(F.transform(F.sequence(F.lit(1), F.lit(p)),
                                                     lambda k: (parent * p + k).cast("int"))).alias("node"))
        return node.withColumn("pattern", F.col("fp").bitwiseAND(F.element_at(masks, F.col("node") + 1)))

    rows = children(fps, F.lit(0))
    done = []
    for level in range(LEVELS):
        # after the last level a node has at most 2^(open bits) codes, and needs no further split
        hot = saved(rows.groupBy("node", "pattern").count().where(F.col("count") > node_limit).select("node", "pattern"), "hot-nodes") \
            if level < LEVELS - 1 else None
        if hot is None or not hot.take(1):
            done.append(rows)
            break
        done.append(rows.join(hot, ["node", "pattern"], "left_anti"))
        rows = children(rows.join(hot, ["node", "pattern"], "left_semi"), F.col("node"))
    every = done[0]
    for d in done[1:]:
        every = every.unionByName(d)
    lists = every.groupBy("node", "pattern").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(0)
        sizes = np.diff(column.offsets.to_numpy())
        codes = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        a, b = forest_links(codes, sizes, distance)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return map_batches(lists, run, "a long, b long").distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over the links (a, b), for every node with a link.

    Large-star hooks each larger neighbour of a node to its smallest neighbour, small-star each
    smaller one; a round halves the height of the trees.  Only links travel, aggregates of them are
    combined before the shuffle, and each round is written to the shared folder."""
    edges = saved(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "links")

    def state(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).collect()[0])

    now = state(edges)
    while now[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b")))
        edges = saved(small.where("a > b").distinct(), "links")
        before, now = now, state(edges)
        if now == before:
            break
    return edges.groupBy("a").agg(F.min("b").alias("label")).select(F.col("a").alias("node"), "label")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       distance: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) for every row: texts whose fingerprints differ in ``distance`` bits
    or fewer are linked, and ``component_id`` is the smallest id reachable."""
    fps = saved(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    links = hamming_links(fps.select("fp").distinct(), distance)
    label = connected(links).withColumnRenamed("node", "fp")
    rooted = fps.join(label, "fp", "left").select("doc_id", "fp", F.coalesce("label", "fp").alias("root"))
    # written first, so that the join below is free to split a root that holds many rows
    smallest = saved(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "components")
    return rooted.join(smallest, "root").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (nulls last), and of rows that share
    it the one with the smallest text hash.  All columns are kept; texts are not shuffled for rows that go,
    only keys and fingerprints are."""
    keyed = with_row_key(docs, id_col, text_col)
    rows = keyed.select(KEY_ID, KEY_HASH, F.col(id_col).isNull().alias("unnamed"), F.col(text_col).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.fromiter((fingerprint_of(t, shingle) for t in byte_texts(batch.column(3))), dtype=np.uint64, count=batch.num_rows)
        return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fp.view(np.int64))], names=[KEY_ID, KEY_HASH, "unnamed", "fp"])

    fps = saved(map_batches(rows, run, f"{KEY_ID} long, {KEY_HASH} long, unnamed boolean, fp long"), "fingerprints")
    label = connected(hamming_links(fps.select("fp").distinct(), distance)).withColumnRenamed("node", "fp")
    rooted = fps.join(label, "fp", "left").withColumn("root", F.coalesce("label", "fp"))
    best = rooted.groupBy("root").agg(F.min(F.struct("unnamed", KEY_ID, KEY_HASH)).alias("k"))
    chosen = saved(best.select(f"k.{KEY_ID}", f"k.{KEY_HASH}"), "kept-keys")
    # rows that repeat both id and text share a key; one of each key is taken
    return keyed.join(chosen, [KEY_ID, KEY_HASH], "left_semi").dropDuplicates([KEY_ID, KEY_HASH]).drop(KEY_ID, KEY_HASH)
