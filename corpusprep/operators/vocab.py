"""Vocabulary learning and corpus encoding (B1-B12) as Spark jobs.

Learning works on the distinct-word frequency table (B1), never on the raw corpus: a BPE round
is one weighted pair count (blocks of words count theirs in numpy, groupBy sums them) that yields
all the merges sure to come next, applied to the blocks together.  Lineage is cut
with a reliable checkpoint every round.  Unigram
pruning runs Viterbi on many words together in ``mapInArrow`` and sums the loss per unit with ``groupBy``.

Encoding is partition-local: the learned model (bounded by the vocabulary size, checked before
it is broadcast) is applied by ``mapInArrow`` to the distinct words of a part, so no token is
shuffled and a hot word cannot skew a task.
"""

from __future__ import annotations

import heapq
import math
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions.batches import code_points, joined_ranges, list_array, list_sizes, parts, text_sizes
from corpusprep.functions.text import character_classes, pretokenize, pretokens
from corpusprep.functions.tries import BestPaths, LongestMatch, Merges, Segments
from corpusprep.session import cut_lineage

# Special tokens and their ids (BERT-style), continuation prefix, limits.
PAD, UNK, CLS, SEP, MASK = "[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"
SPECIAL_IDS = {PAD: 0, UNK: 100, CLS: 101, SEP: 102, MASK: 103}
CONTINUATION = "##"
MAX_MODEL_ENTRIES = 1_000_000
CACHED_PIECES = 500_000  # pieces of the words that an encoding task remembers
ENCODED, COUNTED = 1 << 21, 1 << 22  # bytes of text that are encoded, and whose words are counted, at a time


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- B1, B5 ---------------------------------------------------------------------------------------

def word_frequencies(df: DataFrame, c, pretok=pretokenize) -> DataFrame:
    """B1: distinct pre-tokens with counts (map-side partial counts, so hot words are cheap).  Those of ``pretokenize`` are
    made and counted for parts of a batch."""
    if pretok is pretokenize:
        bc = df.sparkSession.sparkContext.broadcast(character_classes())

        def run(batches):
            import pyarrow as pa
            for batch in batches:
                for part in parts(batch, text_sizes(batch.column(0)), COUNTED, batch.num_rows):
                    found = pretokens(part.column(0), bc.value)[0].value_counts()
                    yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["word", "count"])

        counted = df.select(_c(c).cast("string").alias("text")).mapInArrow(run, "word string, count long")
        return counted.groupBy("word").agg(F.sum("count").alias("count"))
    return df.select(F.explode(pretok(_c(c))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def byte_units(c) -> Column:
    """The UTF-8 bytes of a string as two-digit hex units (base alphabet of 256, no unknown)."""
    return F.regexp_extract_all(F.hex(F.encode(_c(c), "UTF-8")), F.lit("(..)"), 1)


def word_vocab(freqs: DataFrame, size: int, first_id: int = 1000) -> DataFrame:
    """Word-level vocabulary: the ``size`` most frequent words (ties by word) get ids from
    ``first_id`` on; special tokens keep their fixed ids.  The id window runs over the TopK result
    only, so it is bounded by ``size``."""
    from pyspark.sql import Window
    top = freqs.orderBy(F.col("count").desc(), F.col("word")).limit(size)
    rank = F.row_number().over(Window.orderBy(F.col("count").desc(), F.col("word")))
    words = top.select(F.col("word").alias("token"), (rank - 1 + first_id).cast("int").alias("id"))
    spark = freqs.sparkSession
    specials = spark.createDataFrame(list(SPECIAL_IDS.items()), "token string, id int")
    return specials.unionByName(words)


# --- BPE learning (B2) ----------------------------------------------------------------------------

#: Words whose symbols are held together, and entries of a table of all pairs of a block's symbols (more are sorted).
BLOCK_WORDS, PAIR_TABLE = 1 << 17, 1 << 22
BLOCK_T = "symbols array<string>, data binary, counts binary, pairs array<struct<left:string,right:string,freq:bigint>>"


class _Block:
    """Words as numbers of their symbols: ``data`` has those of one word after the other, each closed by 0, ``names`` those
    numbered from 1 on, ``counts`` how often each word occurs."""

    def __init__(self, names: list[str], data: np.ndarray, counts: np.ndarray):
        self.names, self.data, self.counts = names, data, counts

    @classmethod
    def of_words(cls, words, counts: np.ndarray, byte_level: bool) -> _Block:
        points, at = code_points(words)
        if byte_level:
            points = np.frombuffer(points.tobytes().decode("utf-32-le").encode(), dtype=np.uint8)
            at = np.concatenate([[0], np.cumsum(text_sizes(words), dtype=np.int64)])
        base = np.flatnonzero(np.bincount(points))
        number = np.zeros(int(base[-1]) + 1 if len(base) else 1, dtype=np.int32)
        number[base] = np.arange(1, len(base) + 1)
        data = np.zeros(len(points) + len(words), dtype=np.int32)
        data[np.arange(len(points)) + np.repeat(np.arange(len(words)), np.diff(at))] = number[points]
        return cls([f"{x:02X}" if byte_level else chr(x) for x in base.tolist()], data, counts)

    def weights(self) -> np.ndarray:
        """The count of its word for every place."""
        ends = np.flatnonzero(self.data == 0)
        return np.repeat(self.counts, np.diff(ends, prepend=-1))

    def _summed(self, codes: np.ndarray, weights: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes that occur (below ``most``) and the sums of their weights."""
        if most <= PAIR_TABLE:
            seen = np.zeros(most, dtype=bool)
            seen[codes] = True
            found = np.flatnonzero(seen)
            return found, np.bincount(codes, weights, most)[found].astype(np.int64)
        found, at = np.unique(codes, return_inverse=True)
        return found, np.bincount(at, weights, len(found)).astype(np.int64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(left, right, freq) of all pairs of neighbours."""
        k = len(self.names) + 1
        at = np.flatnonzero((self.data[:-1] > 0) & (self.data[1:] > 0))
        codes, freq = self._summed(self.data[at].astype(np.int64) * k + self.data[at + 1], self.weights()[at], k * k)
        return codes // k, codes % k, freq

    def _places(self, pairs: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs, and which pair it is at each.  No symbol ends one pair and begins another."""
        k = len(self.names) + 1
        number = {s: i + 1 for i, s in enumerate(self.names)}
        here = [(number[a], number[b], i) for i, (a, b) in enumerate(pairs) if a in number and b in number]
        lefts, rights = (np.zeros(k, dtype=np.int64) for _ in range(2))
        for j, x in enumerate(sorted({p[0] for p in here})):
            lefts[x] = j + 1
        for j, x in enumerate(sorted({p[1] for p in here})):
            rights[x] = j + 1
        which = np.full((lefts.max() + 1, rights.max() + 1), -1, dtype=np.int64)
        for a, b, i in here:
            which[lefts[a], rights[b]] = i
        first = lefts[self.data[:-1]]
        at = np.flatnonzero(first)
        found = which[first[at], rights[self.data[at + 1]]]
        return at[found >= 0], found[found >= 0]

    def neighbours(self, pairs: list[tuple[str, str]]) -> list[tuple]:
        """(pair, side, symbol, count): how often each symbol is next to places of the pairs, before (0) or after (1)."""
        at, which = self._places(pairs)
        weights, k, out = self.weights(), len(self.names) + 1, []
        for side, beside in enumerate((np.where(at > 0, self.data[at - 1], 0), self.data[np.minimum(at + 2, len(self.data) - 1)])):
            some = beside > 0
            codes, sums = self._summed(which[some] * k + beside[some], weights[at[some]], len(pairs) * k)
            out += [(c // k, side, self.names[c % k - 1], n) for c, n in zip(codes.tolist(), sums.tolist())]
        return out

    def merged(self, joined: dict[tuple[str, str], str]) -> _Block:
        """The words after merging every place of the pairs, left to right; words of one symbol are left out, they have no
        more pairs."""
        names, number = list(self.names), {s: i + 1 for i, s in enumerate(self.names)}
        for token in joined.values():
            if token not in number:
                names.append(token)
                number[token] = len(names)
        at, which = self._places(list(joined))
        # places of a pair of equal symbols may overlap: every second one of a run is taken
        same = np.diff(at, prepend=-2) == 1
        run = np.arange(len(at)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(at))))
        at, which = at[run % 2 == 0], which[run % 2 == 0]
        data, stays = self.data.copy(), np.ones(len(self.data), dtype=bool)
        data[at] = np.array([number[t] for t in joined.values()], dtype=np.int32)[which]
        stays[at + 1] = False
        data = data[stays]
        sizes = np.diff(np.flatnonzero(data == 0), prepend=-1)
        return _Block(names, data[np.repeat(sizes > 2, sizes)], self.counts[sizes > 2])

    def batch(self):
        """The block as a row of ``BLOCK_T``, with its pairs and the symbols that have places."""
        import pyarrow as pa
        used = np.flatnonzero(np.bincount(self.data, minlength=len(self.names) + 1)[1:])
        number = np.zeros(len(self.names) + 1, dtype=np.int32)
        number[used + 1] = np.arange(1, len(used) + 1)
        block = _Block([self.names[i] for i in used.tolist()], number[self.data], self.counts)
        left, right, freq = block.pairs()
        names = pa.array(block.names, pa.string())
        pairs = pa.StructArray.from_arrays([names.take(pa.array(left - 1)), names.take(pa.array(right - 1)), pa.array(freq, pa.int64())], names=["left", "right", "freq"])
        data = block.data.astype(np.uint16 if len(block.names) < 1 << 16 else np.uint32)
        return pa.RecordBatch.from_arrays([list_array([0, len(names)], names), pa.array([data.tobytes()], pa.binary()), pa.array([self.counts.tobytes()], pa.binary()),
                                           list_array([0, len(freq)], pairs)], names=["symbols", "data", "counts", "pairs"])

    @classmethod
    def of_row(cls, row: dict) -> _Block:
        data = np.frombuffer(row["data"], dtype=np.uint16 if len(row["symbols"]) < 1 << 16 else np.uint32)
        return cls(row["symbols"], data.astype(np.int32), np.frombuffer(row["counts"], dtype=np.int64))


def _blocks_in(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Block.of_row({k: batch.column(batch.schema.get_field_index(k))[i].as_py() for k in ("symbols", "data", "counts")})


def _word_blocks(freqs: DataFrame, byte_level: bool) -> DataFrame:
    """The distinct words in blocks of about ``BLOCK_WORDS``."""
    def run(batches):
        import pyarrow as pa
        held: list = []

        def block():
            t = pa.Table.from_batches(held).combine_chunks()
            return _Block.of_words(t.column(0).chunk(0), t.column(1).chunk(0).to_numpy(zero_copy_only=False), byte_level).batch()

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_WORDS:
                yield block()
                held = []
        if sum(b.num_rows for b in held):
            yield block()

    words = freqs.where(F.col("word").isNotNull()).select("word", F.coalesce("count", F.lit(0)).cast("long").alias("count"))
    return words.mapInArrow(run, BLOCK_T)


def _merge_pairs(blocks: DataFrame, joined: dict[tuple[str, str], str]) -> DataFrame:
    """Blocks after merging every place of the given pairs, left to right.  No symbol ends one pair and begins
    another, so the places of different pairs cannot overlap."""
    return blocks.select("symbols", "data", "counts").mapInArrow(lambda batches: (b.merged(joined).batch() for b in _blocks_in(batches)), BLOCK_T)


def _pair_counts(blocks: DataFrame) -> DataFrame:
    return blocks.select(F.explode("pairs").alias("p")).groupBy("p.left", "p.right").agg(F.sum("p.freq").alias("freq"))


def _join_pair(a: str, b: str, continuation: str = "") -> str:
    return a + (b[len(continuation):] if continuation and b.startswith(continuation) else b)


def apart(candidates: list[tuple]) -> list[tuple]:
    """The leading candidates (left, right, ...) up to the first one that could overlap an earlier one."""
    lefts, rights, out = set(), set(), []
    for c in candidates:
        a, b = c[0], c[1]
        if a in rights or b in lefts or (a == b and out):
            break
        out.append(c)
        if a == b:
            break
        lefts.add(a)
        rights.add(b)
    return out


def _new_pair_bounds(blocks: DataFrame, pairs: list[tuple[str, str]]) -> dict[tuple[str, str], int]:
    """For each pair the largest count that a pair with its merged symbol would have: from the symbols next
    to its places, before and after."""
    def run(batches):
        import pyarrow as pa
        for block in _blocks_in(batches):
            found = block.neighbours(pairs)
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.string(), pa.int64()))],
                                             names=["pair", "side", "s", "c"])

    sides = blocks.select("symbols", "data", "counts").mapInArrow(run, "pair int, side int, s string, c long")
    got = sides.groupBy("pair", "side", "s").agg(F.sum("c").alias("c")).groupBy("pair").agg(F.max("c").alias("c")).collect()
    return {pairs[r["pair"]]: int(r["c"]) for r in got}


def _batch(blocks: DataFrame, room: int, width: int, known: set) -> list[tuple[str, str, int]]:
    """The next merges, as many as are sure to come next one after the other; ``known`` are the tokens made before.

    Pairs that cannot overlap keep their counts while the others are merged.  A merge can only bring up pairs
    with its new symbol, none more frequent than the pair's neighbours allow; as long as the next candidate is
    more frequent than all of those, it is the next merge.  A token that was made before in another way has places
    elsewhere, so that merge ends a batch."""
    top = _pair_counts(blocks).orderBy(F.col("freq").desc(), "left", "right").limit(width).collect()
    ranked = apart([(r["left"], r["right"], int(r["freq"])) for r in top])[:room]
    if len(ranked) < 2:
        return ranked
    bounds = _new_pair_bounds(blocks, [(a, b) for a, b, _ in ranked])
    out, above, made = [], -1, set(known)
    for a, b, f in ranked:
        if out and (f <= above or a + b in made):
            break
        out.append((a, b, f))
        if a + b in made:
            break
        made.add(a + b)
        above = max(above, bounds.get((a, b), 0))
    return out


def learn_bpe(freqs: DataFrame, merges: int, byte_level: bool = False, width: int = 256) -> tuple[DataFrame, DataFrame]:
    """B2: start from characters (or bytes), merge the most frequent adjacent pair (ties: left,
    right) ``merges`` times.  Returns (merges: rank, left, right, freq) and the base alphabet.

    A round takes all leading merges that cannot change each other's rank (at most ``width``), so the result equals
    merging one pair at a time.  The distinct words are held in blocks of symbol numbers that numpy merges and counts; a
    block brings its pair counts with it, and only those are shuffled."""
    spark = freqs.sparkSession
    blocks = cut_lineage(_word_blocks(freqs, byte_level))
    alphabet = blocks.select(F.explode("symbols").alias("token")).distinct()
    learned: list[tuple] = []
    while len(learned) < merges:
        batch = _batch(blocks, merges - len(learned), width, {a + b for _, a, b, _ in learned})
        if not batch:
            break
        learned += [(len(learned) + i, a, b, f) for i, (a, b, f) in enumerate(batch)]
        if len(learned) < merges:
            blocks = cut_lineage(_merge_pairs(blocks, {(a, b): a + b for a, b, _ in batch}))
    merges_df = spark.createDataFrame(learned, "rank int, left string, right string, freq long")
    return merges_df, alphabet


def bpe_vocab(merges: DataFrame, alphabet: DataFrame) -> DataFrame:
    """Vocabulary of a BPE model: alphabet then merged tokens in merge order."""
    base = alphabet.select("token", F.lit(-1).alias("rank"))
    merged = merges.select(F.concat("left", "right").alias("token"), "rank")
    return base.unionByName(merged).groupBy("token").agg(F.min("rank").alias("rank"))


# --- WordPiece learning (B3) ----------------------------------------------------------------------

def _wp_initial(freqs: DataFrame) -> DataFrame:
    chars = F.filter(F.split("word", ""), lambda x: x != "")
    sym = F.transform(chars, lambda ch, i: F.when(i == 0, ch).otherwise(F.concat(F.lit(CONTINUATION), ch)))
    return freqs.select("word", "count", sym.alias("symbols"))


#: Best pairs, and words that hold them, that one round of WordPiece merges works with.
WP_PAIRS, WP_WORDS = 1024, 50_000


class _PairIndex:
    """Counts of units and pairs as merges are taken one after the other, between two looks at all words.

    Held are the best pairs with every word they occur in, and the counts of all pairs that touch a symbol of
    theirs.  A merge changes counts in words that hold its pair only, so the index stays exact; a pair with a new
    symbol lies in held words too.  ``next`` gives the best pair of all, as long as its words are held and no pair
    outside the index (none is better than the last of the best) could precede it."""

    def __init__(self, best: list, touching: list, held: list):
        self.units: dict = {}
        self.count: dict = {}
        for r in touching:
            self.count[r["left"], r["right"]] = int(r["freq"])
            self.units[r["left"]], self.units[r["right"]] = int(r["lf"]), int(r["rf"])
        self.symbols = [list(r["symbols"]) for r in held]
        self.weight = [int(r["count"]) for r in held]
        self.covered = {p: set() for p in best}
        for i, s in enumerate(self.symbols):
            for p in zip(s, s[1:]):
                if p in self.covered:
                    self.covered[p].add(i)
        self.changed: set = set()
        self.floor = self._rank(best[-1])
        self.heap = [self._rank(p) for p in self.count]
        heapq.heapify(self.heap)
        self.with_symbol: dict = {}
        for p in self.count:
            for x in p:
                self.with_symbol.setdefault(x, set()).add(p)

    def _rank(self, p: tuple[str, str]) -> tuple[float, str, str]:
        return (-self.count[p] / (float(self.units[p[0]]) * self.units[p[1]]), *p)

    def next(self) -> tuple[str, str] | None:
        while self.heap:
            top = self.heap[0]
            pair = top[1:]
            if not self.count.get(pair) or top != self._rank(pair):
                heapq.heappop(self.heap)  # of an earlier state; the present one is entered too
                continue
            return pair if pair in self.covered and top <= self.floor else None
        return None

    def take(self, a: str, b: str, token: str) -> None:
        """Merges every place of the pair, left to right in each word."""
        delta: dict = {}
        for i in self.covered[a, b]:
            old, new, k = self.symbols[i], [], 0
            while k < len(old):
                two = k + 1 < len(old) and old[k] == a and old[k + 1] == b
                new.append(token if two else old[k])
                k += 1 + two
            if len(new) == len(old):
                continue
            w = self.weight[i]
            for seq, sign in ((old, -w), (new, w)):
                for p in zip(seq, seq[1:]):
                    delta[p] = delta.get(p, 0) + sign
            merged = len(old) - len(new)
            for x, n in ((a, -merged), (b, -merged), (token, merged)):
                self.units[x] = self.units.get(x, 0) + n * w
            for p in zip(new, new[1:]):
                if token in p:
                    self.covered.setdefault(p, set()).add(i)
                elif p in self.covered:
                    self.covered[p].add(i)
            self.symbols[i] = new
            self.changed.add(i)
        for p, n in delta.items():
            if n:
                self.count[p] = self.count.get(p, 0) + n
                for x in p:
                    self.with_symbol.setdefault(x, set()).add(p)
        for p in set().union(*(self.with_symbol.get(x, ()) for x in (a, b, token))):
            if self.count.get(p):
                heapq.heappush(self.heap, self._rank(p))


def _wordpiece_round(words: DataFrame) -> tuple[_PairIndex | None, list]:
    """The pair index over the words' present symbols, and the words held by it."""
    units = words.select("count", F.explode("symbols").alias("u")).groupBy("u").agg(F.sum("count").alias("uf"))
    places = words.select("count", F.explode(F.arrays_zip(_lefts("symbols").alias("a"), _rights("symbols").alias("b"))).alias("p"))
    pairs = places.groupBy(F.col("p.a").alias("left"), F.col("p.b").alias("right")).agg(F.sum("count").alias("freq"), F.count(F.lit(1)).alias("places"))
    scored = cut_lineage(pairs.join(units.select(F.col("u").alias("left"), F.col("uf").alias("lf")), "left")
                         .join(units.select(F.col("u").alias("right"), F.col("uf").alias("rf")), "right"))
    score = F.col("freq") / (F.col("lf").cast("double") * F.col("rf"))
    best, held_places = [], 0
    for r in scored.orderBy(score.desc(), "left", "right").limit(WP_PAIRS).collect():
        held_places += int(r["places"])
        if best and held_places > WP_WORDS:
            break
        best.append((r["left"], r["right"]))
    if not best:
        return None, []
    spark = words.sparkSession
    named = F.broadcast(spark.createDataFrame([(x,) for x in sorted({x for p in best for x in p})], "s string"))  # twice WP_PAIRS at most
    near = scored.join(named.withColumnRenamed("s", "left"), "left", "left_semi") \
        .unionByName(scored.join(named.withColumnRenamed("s", "right"), "right", "left_semi")).distinct()
    touching = bounded_collect(near, "pairs beside candidates")
    sep = chr(0)
    inside = F.zip_with(_lefts("symbols"), _rights("symbols"), lambda x, y: F.concat(x, F.lit(sep), y))
    wanted = F.broadcast(spark.createDataFrame([(a + sep + b,) for a, b in best], "pair string"))
    rows = words.select("word", F.explode(F.array_distinct(inside)).alias("pair")).join(wanted, "pair", "left_semi").select("word").distinct()
    held = bounded_collect(words.join(rows, "word", "left_semi"), "words of candidates")
    return _PairIndex(best, touching, held), held


def _lefts(c: str) -> Column:
    return F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0)))


def _rights(c: str) -> Column:
    return F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0)))


def learn_wordpiece(freqs: DataFrame, vocab_size: int, specials: tuple[str, ...] = (PAD, UNK, CLS, SEP, MASK),
                    max_merges: int | None = None):
    """Merge the pair with the best score freq(ab) / (freq(a) * freq(b)) (ties: left, right)
    until the vocabulary (specials + alphabet + merges) reaches ``vocab_size`` or ``max_merges``
    merges are done; returns (token, id).

    A round looks at all words once, for the best pairs, everything that touches their symbols and the words that
    hold them (bounded by ``WP_PAIRS`` and ``WP_WORDS``; a pair in more words comes alone).  Merges are taken from
    that index as long as the next one is certain, so the order equals merging one pair at a time; words
    that hold a merged pair are replaced."""
    spark = freqs.sparkSession
    words = cut_lineage(_wp_initial(freqs))
    alpha_df = words.select(F.explode("symbols").alias("t")).distinct()
    alphabet = sorted(r[0] for r in bounded_collect(alpha_df, "alphabet"))
    vocab, known = list(specials) + alphabet, set(alphabet)
    taken = 0
    while len(vocab) < vocab_size and (max_merges is None or taken < max_merges):
        index, held = _wordpiece_round(words)
        if index is None:
            break
        made: list = []
        while len(vocab) < vocab_size and (max_merges is None or taken < max_merges):
            pair = index.next()
            if pair is None:
                break
            token = _join_pair(*pair, CONTINUATION)
            if made and token in known:  # the symbol has places in words that are not held
                break
            index.take(*pair, token)
            made.append(token)
            vocab.append(token)
            taken += 1
            if token in known:
                break
        if not made:
            raise RuntimeError("no certain merge")  # the best pair of a round is always certain
        known.update(made)
        new = spark.createDataFrame([(held[i]["word"], index.symbols[i]) for i in sorted(index.changed)], "word string, merged array<string>")
        words = cut_lineage(words.join(F.broadcast(new), "word", "left").select("word", "count", F.coalesce("merged", "symbols").alias("symbols")))
    seen, out = set(), []
    for t in vocab:
        if t not in seen:
            seen.add(t)
            out.append((t, len(out)))
    return spark.createDataFrame(out, "token string, id int")


# --- Unigram (B4, B8) -----------------------------------------------------------------------------

def _longest(model: dict) -> int:
    return max(map(len, model), default=0)


def _viterbi(word: str, model: dict, longest: int, banned: str | None = None):
    """Best segmentation by summed -log p (lower is better); None when impossible.  ``longest`` is the
    length of the model's longest unit."""
    n = len(word)
    best = [(0.0, -1)] + [(math.inf, -1)] * n
    for end in range(1, n + 1):
        for start in range(max(0, end - longest), end):
            piece = word[start:end]
            if piece == banned:
                continue
            s = model.get(piece)
            if s is None or best[start][0] == math.inf:
                continue
            cand = best[start][0] + s
            if cand < best[end][0]:
                best[end] = (cand, start)
    if best[n][0] == math.inf:
        return None, math.inf
    pieces, end = [], n
    while end > 0:
        start = best[end][1]
        pieces.append(word[start:end])
        end = start
    return pieces[::-1], best[n][0]


def _check_size(n: int, what: str):
    if n > MAX_MODEL_ENTRIES:
        raise ValueError(f"{what} has {n} entries, over the broadcast bound {MAX_MODEL_ENTRIES}")


def bounded_collect(df: DataFrame, what: str):
    """Collect a model table in one job, never more than the bound plus one row (the check)."""
    rows = df.limit(MAX_MODEL_ENTRIES + 1).collect()
    _check_size(len(rows), what)
    return rows


def _repeated_prefixes(frames):
    """(unit, freq) of the nodes of the suffix tree of sorted suffixes, from their common prefixes: a stack holds
    the open nodes, so memory is bounded by the longest suffix."""
    open_: list = []  # [length, freq, text]
    last = ""

    def close(length: int, out: list) -> int:
        below = 0
        while open_ and open_[-1][0] > length:
            n, freq, text = open_.pop()
            below += freq
            out.append((text, below))
            if open_ and open_[-1][0] >= length:
                open_[-1][1] += below
                below = 0
        return below

    def frame(out: list) -> pd.DataFrame:
        return pd.DataFrame([r for r in out if r[1] > 1], columns=["unit", "freq"])

    for pdf in frames:
        out: list = []
        for suffix, freq in zip(pdf["suffix"], pdf["freq"]):
            shared = 0
            for x, y in zip(last, suffix):
                if x != y:
                    break
                shared += 1
            below = close(max(shared, 1), out)
            if shared > 1 and below:
                open_.append([shared, below, suffix[:shared]])
            open_.append([len(suffix), int(freq), suffix])
            last = suffix
        yield frame(out)
    out = []
    close(1, out)
    yield frame(out)


def unigram_seed(freqs: DataFrame, size: int, max_len: int | None = None) -> DataFrame:
    """Initial unigram units: every character plus the ``size`` substrings of length >= 2 with the largest
    freq * length (freq = sum of word counts over occurrences; ties: unit), of those found twice or more that no
    single character always follows.  ``max_len`` bounds their length.

    Suffixes of the distinct words are dealt by their first two characters, which all occurrences of a substring share,
    and sorted; one pass over the common prefixes of neighbours gives the nodes of their suffix tree."""
    n = F.length("word")
    rest = F.expr("substring(word, s)") if max_len is None else F.expr(f"substring(word, s, {int(max_len)})")
    starts = freqs.where(n > 1).select("word", "count", F.explode(F.sequence(F.lit(1), n - 1)).alias("s"))
    suffixes = starts.select(rest.alias("suffix"), "count").groupBy("suffix").agg(F.sum("count").alias("freq"))
    dealt = suffixes.repartition(F.substring("suffix", 1, 2)).sortWithinPartitions("suffix")
    multi = dealt.mapInPandas(_repeated_prefixes, "unit string, freq long") \
        .orderBy((F.col("freq") * F.length("unit")).desc(), "unit").limit(size)
    singles = freqs.select(F.explode(F.filter(F.split("word", ""), lambda x: x != "")).alias("unit"), "count") \
        .groupBy("unit").agg(F.sum("count").alias("freq"))
    return _scored(singles.unionByName(multi).select("unit", F.col("freq").cast("double").alias("freq")))


def _scored(units: DataFrame) -> DataFrame:
    """(unit, freq, score): units with -log of their share of all counts."""
    units = cut_lineage(units.select("unit", "freq"))
    total = units.agg(F.sum("freq")).first()[0] or 1.0
    return units.withColumn("score", -F.log(F.col("freq") / F.lit(float(total))))


#: Expected counts below this are raised to it, so that no unit of the model becomes impossible.
LEAST_COUNT = 1e-3


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def _expected_counts(word: str, model: dict, longest: int) -> dict:
    """How often each unit is expected in the word, over all its segmentations (forward-backward, in logs)."""
    n = len(word)
    arcs = [[(start, word[start:end]) for start in range(max(0, end - longest), end) if word[start:end] in model] for end in range(n + 1)]
    ahead = [0.0] + [-math.inf] * n
    for end in range(1, n + 1):
        found = [ahead[start] - model[piece] for start, piece in arcs[end] if ahead[start] > -math.inf]
        if found:
            ahead[end] = _log_sum(found)
    if ahead[n] == -math.inf:
        return {}
    back: list = [[] for _ in range(n)] + [[0.0]]
    out: dict = {}
    for end in range(n, 0, -1):
        if not back[end] or ahead[end] == -math.inf:
            continue
        behind = _log_sum(back[end])
        for start, piece in arcs[end]:
            if ahead[start] > -math.inf:
                here = behind - model[piece]
                back[start].append(here)
                out[piece] = out.get(piece, 0.0) + math.exp(ahead[start] + here - ahead[n])
    return out


#: Distinct words whose figures a task takes together.
LATTICE_WORDS = 1 << 17


def _per_unit(words: DataFrame, units: DataFrame, figures, out: str) -> DataFrame:
    """(unit, out): ``figures`` of all distinct words and their counts (a method of ``BestPaths``), summed; units without
    any are left out."""
    bc = words.sparkSession.sparkContext.broadcast({r["unit"]: float(r["score"]) for r in bounded_collect(units.select("unit", "score"), "unigram model")})

    def run(batches):
        import pyarrow as pa
        paths = BestPaths(bc.value, UNK, _expected_counts)
        total = np.zeros(len(paths.units))
        held: list = []

        def taken() -> np.ndarray:
            t = pa.Table.from_batches(held).combine_chunks()
            return figures(paths, t.column(0).chunk(0), t.column(1).chunk(0).to_numpy(zero_copy_only=False))

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= LATTICE_WORDS:
                total += taken()
                held = []
        if sum(b.num_rows for b in held):
            total += taken()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([paths.names.take(pa.array(some)), pa.array(total[some])], names=["unit", out])

    return words.select("word", "count").mapInArrow(run, f"unit string, {out} double").groupBy("unit").agg(F.sum(out).alias(out))


def _reestimated(words: DataFrame, units: DataFrame) -> DataFrame:
    """One step of expectation and maximisation: counts expected under the present scores become the new ones."""
    counted = units.select("unit").join(_per_unit(words, units, BestPaths.expected, "freq"), "unit", "left")
    return _scored(counted.select("unit", F.greatest(F.coalesce("freq", F.lit(0.0)), F.lit(LEAST_COUNT)).alias("freq")))


def prune_unigram(freqs: DataFrame, size: int, seed_size: int | None = None, share: float = 0.1, em_steps: int = 1,
                  words_per_task: int = 100_000) -> DataFrame:
    """From a seed of four times the size, re-estimate the units by ``em_steps`` steps, drop the ``share`` of the
    multi-character units whose removal raises the corpus loss least, and repeat until ``size`` units remain, which
    are re-estimated once more; returns (unit, freq, score)."""
    words = cut_lineage(freqs.where(F.col("word").isNotNull()).select("word", F.col("count").cast("long").alias("count")))
    units = unigram_seed(words, seed_size or size * 4)
    words = words.repartition(max(1, -(-words.count() // words_per_task)))
    n_units = units.count()
    while True:
        for _ in range(em_steps):
            units = _reestimated(words, units)
        if n_units <= size:
            return units
        loss = _per_unit(words, units, BestPaths.removal_losses, "loss")
        scored = cut_lineage(units.where(F.length("unit") > 1).join(loss, "unit", "left").select("unit", F.round(F.coalesce("loss", F.lit(0.0)), 6).alias("loss")))
        drop_n = min(max(1, int(n_units * share)), n_units - size, scored.count())
        if drop_n <= 0:
            return units
        units = _scored(units.join(scored.orderBy("loss", "unit").limit(drop_n), "unit", "left_anti"))
        n_units -= drop_n


# --- encoders (B6, B7, B8) ------------------------------------------------------------------------

def _bpe_segment(word: str, ranks: dict, byte_level: bool) -> list[str]:
    sym = [f"{b:02X}" for b in word.encode("utf-8")] if byte_level else list(word)
    while len(sym) > 1:
        best, idx = None, -1
        for i in range(len(sym) - 1):
            r = ranks.get((sym[i], sym[i + 1]))
            if r is not None and (best is None or r < best):
                best, idx = r, i
        if best is None:
            break
        a, b = sym[idx], sym[idx + 1]
        out, i = [], 0
        while i < len(sym):
            if i + 1 < len(sym) and sym[i] == a and sym[i + 1] == b:
                out.append(a + b)
                i += 2
            else:
                out.append(sym[i])
                i += 1
        sym = out
    return sym


def _wordpiece_segment(word: str, vocab: set, longest: int) -> list[str]:
    """Longest match from the left; ``longest`` is the length of the vocabulary's longest token."""
    pieces, start = [], 0
    while start < len(word):
        end, found = min(len(word), start + longest), None
        while start < end:
            piece = word[start:end] if start == 0 else CONTINUATION + word[start:end]
            if piece in vocab:
                found = piece
                break
            end -= 1
        if found is None:
            return [UNK]
        pieces.append(found)
        start = end
    return pieces


def _piece_offsets(word: str, pieces: list[str]) -> tuple[list[int], list[int]]:
    """Starts and ends of the character spans of a word's pieces, counted from the word's start: continuation markers
    do not count, an unknown word maps to the whole word."""
    starts, ends, pos = [], [], 0
    for p in pieces:
        if p == UNK:
            starts.append(0)
            ends.append(len(word))
            continue
        n = len(p[len(CONTINUATION):]) if p.startswith(CONTINUATION) else len(p)
        starts.append(pos)
        ends.append(pos + n)
        pos += n
    return starts, ends


def _byte_offsets(word: str, pieces: list[str]) -> tuple[list[int], list[int]]:
    """Starts and ends of the spans of the characters that a byte-level piece holds bytes of; pieces that share a
    character all carry it."""
    # The character that each byte lies in.
    holds = range(len(word)) if word.isascii() else [i for i, c in enumerate(word) for _ in c.encode("utf-8")]
    starts, ends, pos = [], [], 0
    for p in pieces:
        n = len(p) // 2
        starts.append(holds[pos])
        ends.append(holds[pos + n - 1] + 1)
        pos += n
    return starts, ends


OFFSETS_T = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


# White space between pre-tokens (Unicode's White_Space property); the last entry stands for all characters above.
_SPACE = np.zeros(0x3002, dtype=bool)
_SPACE[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = True


def _word_starts(texts, words, sizes: np.ndarray) -> np.ndarray:
    """Where every pre-token begins in its text, located one after the other; ``words`` are those of all texts, ``sizes``
    how many each text has.

    Where the words are what is left of the texts without white space, as the pre-tokeniser's are, they are found all
    at once; else one after the other."""
    points, row_at = code_points(texts)
    parts_, word_at = code_points(words)
    row = np.repeat(np.arange(len(sizes)), sizes)
    solid = np.flatnonzero(~_SPACE[np.minimum(points, 0x3001)])
    lengths = np.diff(word_at)
    if len(solid) == len(parts_) and lengths.all() and np.array_equal(points[solid], parts_):
        starts, last = solid[word_at[:-1]], solid[word_at[1:] - 1]
        if np.array_equal(last - starts, lengths - 1) and (starts >= row_at[row]).all() and (last < row_at[row + 1]).all():
            return starts - row_at[row]
    out, every = [], iter(words.to_pylist())
    for text, n in zip(texts.to_pylist(), sizes.tolist()):
        cursor = 0
        for _ in range(n):
            w = next(every)
            start = text.find(w, cursor)
            start = cursor if start < 0 else start
            out.append(start)
            cursor = start + len(w)
    return np.array(out, dtype=np.int64)


class _OneByOne:
    """Segments words one by one, each once: their pieces and spans are kept as plain integers, and forgotten when they are
    over ``CACHED_PIECES``."""

    def __init__(self, segment, spans):
        self.segment, self.spans = segment, spans
        self._forget()

    def _forget(self) -> None:
        self.known: dict = {}
        self.names: dict = {}
        self.first, self.name, self.begin, self.end = array("q", [0]), array("i"), array("i"), array("i")

    def __call__(self, words) -> Segments:
        import pyarrow as pa
        if len(self.name) > CACHED_PIECES:
            self._forget()
        known, names = self.known, self.names
        words = words.to_pylist()
        for w in words:
            if w in known:
                continue
            seg = self.segment(w)
            begin, end = self.spans(w, seg)
            known[w] = len(self.first) - 1
            self.name.extend([names.setdefault(p, len(names)) for p in seg])
            self.begin.extend(begin)
            self.end.extend(end)
            self.first.append(len(self.name))
        first, name, begin, end = (np.array(x) for x in (self.first, self.name, self.begin, self.end))
        found = np.array([known[w] for w in words], dtype=np.int64)
        n = first[found + 1] - first[found]
        at = joined_ranges(first[found], n)
        return Segments(np.concatenate([[0], np.cumsum(n)]), name[at], begin[at], end[at], pa.array(list(names), pa.string()))


def _encode_partitions(df: DataFrame, key: str, c, model, segment=None, pretok=pretokenize, spans=_piece_offsets, keep: tuple[str, ...] = (),
                       segmenter=None, then=None, then_t: str | None = None) -> DataFrame:
    """Pre-tokenise in Spark, segment the distinct words of a part of a batch, keep token, word index and (Q6) the
    character span of every piece, found by locating each pre-token in the text in order.  A null text has no pieces; the
    columns ``keep`` stay.  ``then`` may make rows of ``then_t`` of an encoded part, so that pieces need not leave the
    task.  ``pretokenize`` is done in the task, for all texts of a part.  ``segmenter`` makes of the model a function of an array of words (``functions.tries``), without
    one ``segment`` takes one word (per-task cache).

    A batch is encoded in parts (``functions.batches``); tokens, word indices and spans of all its words are gathered from
    those of the distinct ones, so a task's memory depends neither on its rows nor on how finely words are cut."""
    spark = df.sparkSession
    own = pretok is pretokenize
    bc = spark.sparkContext.broadcast((model, character_classes() if own else None))
    pieces_t = T.ArrayType(T.StringType())
    schema = T.StructType([
        T.StructField(key, df.schema[key].dataType),
        *(df.schema[k] for k in keep),
        T.StructField("tokens", pieces_t),
        T.StructField("word_ids", T.ArrayType(T.IntegerType())),
        T.StructField("offsets", OFFSETS_T),
    ])
    src = df.select(key, *keep, *([] if own else [pretok(_c(c)).alias("_words")]), _c(c).cast("string").alias("_text"))
    n_kept = 1 + len(keep)

    def run(batches):
        import pyarrow as pa
        m, classes = bc.value
        segmented = segmenter(m) if segmenter else _OneByOne(lambda w: segment(w, m), spans)

        def encoded(part):
            texts = part.column(part.num_columns - 1)
            if own:
                words, sizes, word_starts = pretokens(texts, classes)
            else:
                lists = part.column(n_kept)
                sizes, words = list_sizes(lists), lists.flatten()
                word_starts = _word_starts(texts, words, sizes)
            distinct = words.dictionary_encode()
            first, name, begin, end, names = segmented(distinct.dictionary)
            found = distinct.indices.to_numpy(zero_copy_only=False)
            n = first[found + 1] - first[found]
            at = joined_ranges(first[found], n)
            starts = np.repeat(word_starts, n)
            bounds = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(sizes)])]
            wids = np.repeat(joined_ranges(np.zeros(len(sizes), dtype=np.int64), sizes), n)
            ints = lambda a: pa.array(a.astype(np.int32), pa.int32())
            offs = pa.StructArray.from_arrays([ints(starts + begin[at]), ints(starts + end[at])], names=["start", "end"])
            return pa.RecordBatch.from_arrays(
                [*part.columns[:n_kept], list_array(bounds, names.take(pa.array(name[at]))), list_array(bounds, ints(wids)), list_array(bounds, offs)],
                names=[key, *keep, "tokens", "word_ids", "offsets"])

        for batch in batches:
            for part in parts(batch, text_sizes(batch.column(batch.num_columns - 1)), ENCODED):
                yield then(encoded(part)) if then else encoded(part)

    return src.mapInArrow(run, then_t if then else schema)


def encode_bpe(df: DataFrame, c, key: str, merges: DataFrame, byte_level: bool = False, then=None, then_t: str | None = None) -> DataFrame:
    """Replay the merge list (lowest rank first) on every word; (key, tokens, word_ids, offsets), or the rows of
    ``then_t`` that ``then`` makes of the encoded batches."""
    ranks = {(r["left"], r["right"]): int(r["rank"]) for r in bounded_collect(merges, "merge list")}
    return _encode_partitions(df, key, c, ranks, segmenter=lambda m: Merges(m, byte_level), then=then, then_t=then_t)


def _wordpiece_match(tokens: set) -> LongestMatch:
    words, rest = sorted(tokens), sorted(t for t in tokens if t.startswith(CONTINUATION))
    return LongestMatch(words, [t[len(CONTINUATION):] for t in rest], words + rest, UNK)


def encode_wordpiece(df: DataFrame, c, key: str, vocab: DataFrame, keep: tuple[str, ...] = (), then=None, then_t: str | None = None) -> DataFrame:
    """Longest match from the left, '##' for continuation pieces, whole word [UNK] on failure; the columns
    ``keep`` stay, or ``then`` makes rows of ``then_t`` of the encoded batches."""
    tokens = {r["token"] for r in bounded_collect(vocab.select("token"), "vocabulary")}
    return _encode_partitions(df, key, c, tokens, segmenter=_wordpiece_match, keep=keep, then=then, then_t=then_t)


def encode_unigram(df: DataFrame, c, key: str, units: DataFrame, then=None, then_t: str | None = None) -> DataFrame:
    """Viterbi best path (largest product of unit probabilities); unknown word -> [UNK].  ``then`` as for the others."""
    model = {r["unit"]: float(r["score"]) for r in bounded_collect(units.select("unit", "score"), "unigram model")}
    return _encode_partitions(df, key, c, model, segmenter=lambda m: BestPaths(m, UNK), then=then, then_t=then_t)


# --- ids, decoding, reports (B9-B12) --------------------------------------------------------------

#: Tokens that are looked up at a time (or as many as the vocabulary has entries).
LOOKED_UP = 1 << 18


def to_ids(df: DataFrame, vocab: DataFrame, tokens: str = "tokens", out: str = "input_ids", unk_id: int = 100) -> DataFrame:
    """Token array -> id array, partition-local and vectorised: the vocabulary (size-checked)
    is broadcast as two Arrow arrays and every part of a batch is looked up with one hash lookup in C++."""
    import pyarrow as pa
    import pyarrow.compute as pc
    rows = bounded_collect(vocab.select("token", "id"), "vocabulary")
    bc = df.sparkSession.sparkContext.broadcast(([r[0] for r in rows], [int(r[1]) for r in rows]))
    schema = T.StructType(list(df.schema.fields) + [T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(batches):
        keys = pa.array(bc.value[0], pa.string())
        ids = pa.array(bc.value[1], pa.int32())
        for batch in batches:
            at = batch.schema.get_field_index(tokens)
            for rb in parts(batch, list_sizes(batch.column(at)), max(LOOKED_UP, len(keys)), batch.num_rows):
                col = rb.column(at)
                pos = pc.index_in(pc.list_flatten(col), value_set=keys)
                mapped = pc.fill_null(pc.take(ids, pos), pa.scalar(unk_id, pa.int32()))
                starts = np.concatenate([[0], np.cumsum(list_sizes(col))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(list(rb.columns) + [list_array(starts, mapped, col.is_null())], names=list(rb.schema.names) + [out])

    return df.mapInArrow(run, schema)


def to_tokens(df: DataFrame, vocab: DataFrame, ids: str = "input_ids", out: str = "tokens") -> DataFrame:
    """B9 reverse: id array -> token array (unknown id -> [UNK])."""
    inverse = vocab.select(F.col("id"), F.col("token"))
    mapping = {int(r["id"]): r["token"] for r in bounded_collect(inverse, "vocabulary")}
    bc = df.sparkSession.sparkContext.broadcast(mapping)
    schema = T.StructType(list(df.schema.fields) + [T.StructField(out, T.ArrayType(T.StringType()))])

    def run(it):
        m = bc.value
        for pdf in it:
            pdf[out] = [None if xs is None else [m.get(int(x), UNK) for x in xs] for xs in pdf[ids]]
            yield pdf

    return df.mapInPandas(run, schema)


def decode(df: DataFrame, vocab: DataFrame, ids: str = "input_ids", skip_special: bool = True,
           out: str = "text") -> DataFrame:
    """Ids -> text; tokens joined by spaces, ' ##' continuations glued, specials skippable."""
    toks = to_tokens(df, vocab, ids, "_toks")
    arr = F.col("_toks")
    if skip_special:
        arr = F.filter(arr, lambda t: ~t.isin(*SPECIAL_IDS.keys()))
    text = F.regexp_replace(F.array_join(arr, " "), " " + CONTINUATION, "")
    return toks.withColumn(out, text).drop("_toks")


def vocab_report(encoded_old: DataFrame, encoded_new: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """Tokens per text under two vocabularies, side by side, with totals via the caller's agg."""
    a = encoded_old.select(key, F.size(tokens).alias("tokens_old"))
    b = encoded_new.select(key, F.size(tokens).alias("tokens_new"))
    return a.join(b, key, "full")


def single_token_ids(encoded: DataFrame, key: str = "word", tokens: str = "tokens") -> DataFrame:
    """Keywords that encode to exactly one token (``single``) and the others."""
    return encoded.withColumn("single", F.size(tokens) == 1) \
        .withColumn("token", F.when(F.col("single"), F.element_at(tokens, 1)))
