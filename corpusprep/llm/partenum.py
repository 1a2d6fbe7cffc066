"""Jaccard join of word n-gram sets by PartEnum signatures.

A document's set holds the 64-bit hashes of its distinct shingles.  Sets are linked when
``100 * intersection >= percent * union``.

1. Sizes are cut into bands, the upper end of a band at most 100/percent times its lower one, so linked sets lie in one
   band or in neighbouring ones.  A set takes part in the instance of its band and in that of the band before; in
   instance i linked sets differ in at most k_i entries, by the largest size of band i.
2. An instance deals the domain into n1 = k/2 + 1 (+ slack) partitions and each partition into three parts.  At most k
   differences leave some partition with one difference or none, so two of its three parts agree; a
   signature is a hash of the entries in such a pair of parts.  Every pair of parts of every partition is enumerated, so
   linked sets share a signature.
3. A pair of parts without entries says nothing, and is left out.  ``slack`` more partitions than needed leave
   slack + 1 good ones, so a set with at most ``slack`` partitions that have an empty pair is found by the others.  Only
   two sets that both have more could be missed; such sets enumerate a second, independent division, and so on;
   at the last of ``DIVISIONS`` the empty pairs are signatures too.  No link is lost.
4. Equal sets form one class before all this.  A class is first compared with the smallest class it shares a
   signature with, then, by components, only with classes of other components: the smallest of each other signature,
   while signatures hold large groups one more member of each in turn, and at last all that share one.  A pair is checked by the difference of two 512-bit parity maps (a lower bound of the
   real difference) beside the sizes, and only then by its sets.

Defined results: a null text or one without words has the empty set, which links with nothing; a text of fewer words than
a shingle has its whole sequence as one shingle; rows that repeat an id or a text are rows of their own; the component
of rows with null ids only is null; an empty table gives no rows.  Shingles are identified by 64-bit hashes.
Only the id and text columns are read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import byte_texts, map_batches, mix64, release_memory, saved
from corpusprep.llm.simhash import connected

WIDTH, PERCENT = 4, 85
PARTS, MAP_BITS = 3, 512
DIVISIONS = 8
#: One more partition than needed for every so many.
SLACK_EVERY = 16
#: Classes that share one signature are compared in blocks of this size.
BLOCK_CLASSES = 1000
#: While open signatures hold more possible pairs for each of their classes than this, one member of each is compared with
#: the others, in at most so many turns; what they leave is compared in full.
PAIRS_PER_CLASS, TURNS = 4, 3
_GOLD = 0x9E3779B97F4A7C15
_M64 = (1 << 64) - 1


# --- sets ----------------------------------------------------------------------------------------


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _WordHash()


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(_WORDS) > 200_000:
        _WORDS.clear()
    h = np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))
    take = min(width, len(words))
    total = np.full(len(words) - take + 1, take, dtype=np.uint64)
    for k in range(take):
        total = mix64(total * np.uint64(_GOLD) + h[k:len(h) - take + 1 + k])
    return np.unique(total)


def parity_map(entries: np.ndarray) -> np.ndarray:
    """512 bits: each the parity of the entries that fall on it.  Two sets differ in at least as many entries as their
    maps do in bits."""
    bit = (mix64(entries ^ np.uint64(0x5BD1E995)) % np.uint64(MAP_BITS)).astype(np.int64)
    odd = np.bincount(bit, minlength=MAP_BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


# --- signatures ----------------------------------------------------------------------------------


@functools.lru_cache(maxsize=16)
def bands(percent: int, upto: int) -> tuple[np.ndarray, np.ndarray]:
    """(first size of each band, largest difference k of its instance), up to the band of size ``upto``."""
    low, diff = [1], []
    while True:
        high = low[-1] * 100 // percent
        diff.append(high * (100 - percent) // percent)
        if high >= upto:
            return np.array(low), np.array(diff)
        low.append(high + 1)


def partitions(k: int) -> tuple[int, int]:
    """(partitions, slack) for at most ``k`` differences."""
    need = k // 2 + 1
    return need + need // SLACK_EVERY, need // SLACK_EVERY


def signatures(entries: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The signatures of a set (sorted distinct hashes); linked sets that are not equal share one."""
    n = len(entries)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    first, diff = bands(percent, 1 << int(n).bit_length())
    band = int(np.searchsorted(first, n, side="right")) - 1
    out = []
    for instance in (band, band - 1):
        if instance < 0 or diff[instance] == 0:
            continue
        n1, slack = partitions(int(diff[instance]))
        for division in range(DIVISIONS):
            seed = (instance * DIVISIONS + division + 1) * _GOLD & _M64
            h = mix64(entries ^ np.uint64(seed))
            cell = (h % np.uint64(n1 * PARTS)).astype(np.int64)
            held = np.bincount(cell, minlength=n1 * PARTS).reshape(n1, PARTS)
            sums = np.zeros(n1 * PARTS, dtype=np.uint64)
            np.add.at(sums, cell, mix64(h))
            sums = sums.reshape(n1, PARTS)
            pair = sums.sum(axis=1, dtype=np.uint64)[:, None] - sums  # without the part named by the column
            empty = held.sum(axis=1)[:, None] == held
            place = np.arange(n1 * PARTS, dtype=np.uint64).reshape(n1, PARTS)
            sig = mix64(pair ^ mix64(place + np.uint64(seed)))
            sparse = int(empty.any(axis=1).sum()) > slack
            last = division == DIVISIONS - 1
            out.append(sig.ravel() if last else sig[~empty])
            if not sparse:
                break
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


# --- over the cluster ----------------------------------------------------------------------------

MAPS = [f"m{i}" for i in range(MAP_BITS // 64)]
_MAP_SCHEMA = ", ".join(f"{m} long" for m in MAPS)


def _class_of(entries: np.ndarray) -> int | None:
    return int.from_bytes(xxhash.xxh3_64_digest(entries.tobytes()), "little", signed=True) if len(entries) else None


def shingle_sets(rows: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_hash, n, class, m0 .. m7) for rows (doc_id, text_hash, text): size, a hash of the set (null for the
    empty one) and its parity map.  The entries themselves are not kept."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingle_set(t, width) for t in byte_texts(batch.column(2))]
        maps = np.array([parity_map(s) for s in found])
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(s) for s in found], pa.int64()), pa.array(map(_class_of, found), pa.int64()),
                                           *(pa.array(maps[:, i]) for i in range(len(MAPS)))], names=["doc_id", "text_hash", "n", "class", *MAPS])

    return map_batches(rows, run, f"doc_id long, text_hash long, n long, class long, {_MAP_SCHEMA}")


def set_signatures(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """(sig, class) for every signature of every set; a task gives those of one class once, as far as it remembers."""
    def run(batches):
        seen: set = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                names, sigs = [], []
                for t in byte_texts(batch.column(0).slice(at, 500)):
                    entries = shingle_set(t, width)
                    name = _class_of(entries)
                    if name is None or name in seen:
                        continue
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(name)
                    names.append(name)
                    sigs.append(signatures(entries, percent))
                if names:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.repeat(np.array(names), [len(s) for s in sigs]))],
                                                     names=["sig", "class"])
        release_memory()

    return rows.select("text").mapInArrow(run, "sig long, class long")


def set_entries(rows: DataFrame, width: int) -> DataFrame:
    """(class, entries) of rows (text)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingle_set(t, width) for t in byte_texts(batch.column(0))]
        return pa.RecordBatch.from_arrays([pa.array(map(_class_of, found), pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], names=["class", "entries"])

    return map_batches(rows.select("text"), run, "class long, entries binary")


def possible(percent: int, left: str, right: str):
    """Whether sizes and parity maps allow the two classes to be linked."""
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    apart = functools.reduce(lambda x, y: x + y, [F.bit_count(F.col(f"{left}.{c}").bitwiseXOR(F.col(f"{right}.{c}"))) for c in MAPS])
    # with a difference of d the union is (n + m + d) / 2 and the intersection (n + m - d) / 2
    return 100 * (n + m - apart) >= percent * (n + m + apart)


def linked(pairs: DataFrame, entries: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by their entries."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = np.zeros(batch.num_rows, dtype=bool)
        for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
            x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            at = np.minimum(np.searchsorted(x, y), len(x) - 1)
            both = int((x[at] == y).sum())
            good[i] = 100 * both >= percent * (len(x) + len(y) - both)
        kept = batch.filter(pa.array(good))
        return pa.RecordBatch.from_arrays(kept.columns[:2], names=["a", "b"])

    with_a = pairs.join(entries.withColumnsRenamed({"class": "a", "entries": "x"}), "a")
    both = with_a.join(entries.withColumnsRenamed({"class": "b", "entries": "y"}), "b").select("a", "b", "x", "y")
    return map_batches(both, run, "a long, b long")


def similar_classes(rows: DataFrame, sets: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(node, label): the smallest class reachable over links, for every class with a link.  ``rows`` are (doc_id,
    text_hash, text), ``sets`` what ``shingle_sets`` makes of them, in a written table."""
    classes = saved(sets.where("class is not null").groupBy("class").agg(F.min("text_hash").alias("text_hash"), *(F.min(c).alias(c) for c in ("n", *MAPS))), "set-classes")
    maps = classes.drop("text_hash")
    same = Window.partitionBy("sig")
    met = set_signatures(rows, width, percent).withColumns({"low": F.min("class").over(same), "high": F.max("class").over(same)})
    shared = saved(met.where("low < high").select("sig", "class", "low").distinct(), "shared-signatures")

    def near(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that sizes and parity maps allow."""
        return pairs.join(maps.alias("x"), F.col("a") == F.col("x.class")).join(maps.alias("y"), F.col("b") == F.col("y.class")) \
            .where(possible(percent, "x", "y")).select("a", "b")

    def entries_of(pairs: DataFrame) -> DataFrame:
        """(class, entries) of all classes in the pairs, from one text of each."""
        asked = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
        texts = classes.join(asked, "class", "left_semi").select("text_hash")
        found = set_entries(rows.join(texts, "text_hash", "left_semi").dropDuplicates(["text_hash"]), width)
        return saved(found.join(asked, "class", "left_semi").dropDuplicates(["class"]), "set-entries")

    def labels(links: DataFrame) -> DataFrame:
        return saved(connected(links), "labels")

    def relabelled(some: DataFrame, label: DataFrame, column: str, out: str) -> DataFrame:
        return some.join(label.select(F.col("node").alias(column), F.col("label").alias(out)), column, "left") \
            .withColumn(out, F.coalesce(out, column))

    others = shared.where("class <> low")
    stars = saved(near(others.select(F.col("low").alias("a"), F.col("class").alias("b")).distinct()), "pairs")
    entries = entries_of(stars)
    # each class with the smallest it shares a signature with
    links = saved(linked(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), entries, percent), "set-links")
    label = labels(links)
    # each class with the smallest of its other signatures, where components still differ
    open_ = relabelled(relabelled(stars, label, "a", "la"), label, "b", "lb").where("la <> lb").select("a", "b")
    links = links.unionByName(saved(linked(open_, entries, percent), "set-links"))
    label = labels(links)
    # all others that share a signature across components

    def still_open(members: DataFrame) -> DataFrame:
        """(sig, class, label, size) of the signatures (sig, class) whose classes have more than one label."""
        members = relabelled(members.select("sig", "class"), label, "class", "label")
        counts = members.groupBy("sig").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("l"), F.max("label").alias("h")).where("l < h")
        return saved(members.join(counts.select("sig", "size"), "sig"), "open-signatures")

    rest = still_open(others)
    for turn in range(TURNS):
        n, reach = rest.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).collect()[0]
        if reach - n <= 2 * PAIRS_PER_CLASS * n:
            break
        # the same class leads in most of its signatures; compared with all others of a signature, it leaves it
        chosen = rest.groupBy("sig").agg(F.min(F.struct(F.xxhash64("class", F.lit(turn)), "class", "label")).alias("p"))
        met = rest.join(chosen.select("sig", F.col("p.class").alias("a"), F.col("p.label").alias("la")), "sig")
        tried = saved(near(met.where("label <> la").select("a", F.col("class").alias("b")).distinct()), "pairs")
        found = saved(linked(tried, entries_of(tried), percent), "set-links")
        merged = bool(found.take(1))
        if merged:
            links = links.unionByName(found)
            label = labels(links)
        rest = still_open(met.where("class <> a"))
        if not merged:
            break
    pairs = saved(across_pairs(rest.join(maps, "class"), percent), "pairs")
    if pairs.take(1):
        links = links.unionByName(saved(linked(pairs, entries_of(pairs), percent), "set-links"))
        label = labels(links)
    return label


def across_pairs(rows: DataFrame, percent: int, block: int = BLOCK_CLASSES) -> DataFrame:
    """Distinct pairs (a, b) of classes with a common signature and different labels that sizes and maps allow.  A
    signature with more than ``block`` classes is dealt into blocks, and pairs of blocks are joined."""
    parts = F.ceil(F.col("size") / block).cast("int")
    part = F.pmod(F.xxhash64("class"), parts).cast("int")
    other = F.transform(F.sequence(F.lit(0), parts - 1), lambda q: F.struct(F.least(part, q).alias("i"), F.greatest(part, q).alias("j")))
    dealt = rows.withColumn("part", part).withColumn("u", F.explode(other)).select("*", F.col("u.i").alias("i"), F.col("u.j").alias("j")).drop("u")
    x, y = dealt.where("part = i").alias("x"), dealt.where("part = j").alias("y")
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("sig", "i", "j")]
    inside = (F.col("x.i") < F.col("x.j")) | (F.col("x.class") < F.col("y.class"))
    met = x.join(y, functools.reduce(lambda p, q: p & q, same) & inside & (F.col("x.label") != F.col("y.label")) & possible(percent, "x", "y"))
    return met.select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                       percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row: ``component_id`` is the smallest id reachable over
    links between sets of ``width``-word shingles."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    sets = saved(shingle_sets(rows, width), "shingle-sets")
    label = similar_classes(rows, sets, width, percent).withColumnRenamed("node", "class")
    rooted = sets.select("doc_id", "n", "class").join(label, "class", "left").withColumn("root", F.coalesce("label", "class"))
    smallest = saved(rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("smallest")), "set-components")
    return rooted.join(smallest, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"))
