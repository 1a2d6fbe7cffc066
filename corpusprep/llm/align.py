"""Cross-tokenizer alignment: groups of tokens of two tokenizers that cover the same bytes of a text.

Tokenizer A is a byte-level BPE file of the tokenizers library, B a sentencepiece model; both see a space and
the text.  The byte offsets where tokens of both end cut the text into groups; every A token of a group is
linked with every B token of it.

1. Encoding.  A single space between two characters that are no white space is a boundary for both vocabularies
   (A's pre-tokenizer starts a word there, and no piece of B holds a space behind another character), so a task
   encodes each distinct stretch between such spaces once, in a cache of bounded size.  Ids are written to the
   shared folder, in chunks of bounded text.
2. Merge path.  The ends of all tokens of a run of texts are two ascending arrays.  Diagonals ``piece`` steps
   apart, each placed by binary search, divide their merge into independent pieces of equal work, whatever the
   lengths of texts and groups.  A piece emits the ends both arrays share inside it; a tie that a diagonal
   separates is found when neighbouring pieces are stitched, and groups run on over the seams.
3. Counts.  A chunk sends each distinct id pair once, with the number of its documents; sums, and the highest
   sum of each A id, come back to the chunks that hold the pair by a join.

Defined results: null and empty texts, and texts that either tokenizer does not give back byte for byte (U+2581
reads as a space in B), have no tokens, zero counts and an empty groups text; rows that repeat are documents of
their own; a null id stays null; an empty table gives no rows.  Only the id and text columns are read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import ranges, release_memory, saved, str_texts
from corpusprep.llm.wordbpe import byte_symbols

#: Steps of one merge-path piece.
PIECE = 1 << 14
#: Characters and documents of one chunk.
CHUNK_CHARS, CHUNK_ROWS = 6 << 20, 5000
#: Characters aligned at a time.
STEP_CHARS = 1 << 19
#: Distinct stretches, and characters of them, that a task keeps.
CACHE_ENTRIES, CACHE_CHARS = 150_000, 4 << 20
#: Groups with more links than this count their distinct ids first.
WIDE_LINKS = 4096

_SINGLE = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r"\s\s")


# --- merge path ----------------------------------------------------------------------------------


def diagonals(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """How many entries of ``a`` and of ``b`` the merge has taken at every ``piece``-th step; of equal
    entries that of ``a`` is taken first."""
    d = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(d - len(b), 0), np.minimum(d, len(a))
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low, d - low
        mid = (low[open_] + high[open_]) // 2
        taken = a[mid] <= b[d[open_] - 1 - mid]
        low[open_[taken]] = mid[taken] + 1
        high[open_[~taken]] = mid[~taken]


def shared_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """For each entry of two ascending arrays, whether the other array has it too; every piece of the merge
    path is worked on by itself."""
    cut_a, cut_b = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
    if not len(a) or not len(b):
        return cut_a, cut_b
    at_a, at_b = diagonals(a, b, piece)
    for i, k, j, m in zip(at_a[:-1].tolist(), at_a[1:].tolist(), at_b[:-1].tolist(), at_b[1:].tolist()):
        if i < k and j < m:
            place = np.searchsorted(b[j:m], a[i:k])
            hit = np.flatnonzero(b[j + np.minimum(place, m - j - 1)] == a[i:k])
            cut_a[i + hit], cut_b[j + place[hit]] = True, True
    i, j = at_a[1:-1], at_b[1:-1]  # seams: the tie's A entry ends one piece, its B entry begins the next
    seam = (i > 0) & (j < len(b))
    seam[seam] = a[i[seam] - 1] == b[j[seam]]
    cut_a[i[seam] - 1], cut_b[j[seam]] = True, True
    return cut_a, cut_b


# --- tokenizers ----------------------------------------------------------------------------------


class _Numbers(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class _Ids:
    """Id lists of numbered stretches in one flat array."""

    def __init__(self):
        self.ids, self.ends = np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)

    def add(self, lists: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in lists for i in x), dtype=np.int64, count=int(sizes.sum()))])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])

    def get(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = self.ends[numbers]
        sizes = self.ends[numbers + 1] - first
        return self.ids[ranges(first, sizes)], sizes


# Fixed value: the word pattern of byte-level BPE files.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _ranked(file: dict, token_bytes: list[bytes], added: dict):
    """The vocabulary as byte ranks, several times faster on short stretches; None unless the file is plain
    byte-level BPE whose merges make ids in ascending order, so that rank order is merge order."""
    model, vocabulary = file["model"], file["model"]["vocab"]
    plain = file.get("normalizer") is None and file.get("pre_tokenizer") == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if not plain or any(x >= y for x, y in zip(made, made[1:])) or len(made) + 256 != len(token_bytes) - len(added):
        return None
    import tiktoken

    return tiktoken.Encoding("byte_level", pat_str=_WORD_PATTERN, special_tokens={},
                             mergeable_ranks={b: i for i, b in enumerate(token_bytes) if i not in added})


class TwoTokenizers:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path_a)
        library.encode_special_tokens = True
        library.no_truncation()
        library.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {c: i for i, c in enumerate(byte_symbols())}
        with open(path_a, encoding="utf-8") as f:
            file_a = json.load(f)
        added = {t["id"]: t["content"] for t in file_a.get("added_tokens", ())}
        self.bytes_a = [b""] * library.get_vocab_size()
        for token, i in library.get_vocab().items():
            self.bytes_a[i] = added[i].encode() if i in added else bytes(byte_of[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.ranked = _ranked(file_a, self.bytes_a, added)
        self.a = library if self.ranked is None else None
        self.size_a = np.fromiter(map(len, self.bytes_a), dtype=np.int64, count=len(self.bytes_a))
        self.size_b = np.fromiter(map(len, self.bytes_b), dtype=np.int64, count=len(self.bytes_b))
        self.types = tuple("<u2" if len(t) <= 1 << 16 else "<u4" for t in (self.bytes_a, self.bytes_b))
        self.clear()

    def clear(self) -> None:
        self.known, self.held = _Numbers(), 0
        self.ids_a, self.ids_b, self.exact = _Ids(), _Ids(), np.zeros(0, dtype=bool)

    def stretches(self, text: str) -> list[str]:
        if not _ODD.search(text) and not text[0].isspace() and not text[-1].isspace():
            return text.split(" ")
        return _SINGLE.split(text)

    def _learn(self, new: list[str]) -> None:
        if self.ranked is not None:
            a = list(map(self.ranked.encode_ordinary, [" " + s for s in new]))
        else:
            a = [e.ids for e in self.a.encode_batch_fast([" " + s for s in new], add_special_tokens=False)]
        b = self.b.encode(new, num_threads=1)
        known = len(self.exact)
        self.ids_a.add(a)
        self.ids_b.add(b)
        whole = [b" " + s.encode() for s in new]
        sizes = np.cumsum(np.fromiter(map(len, whole), dtype=np.int64, count=len(new)))
        at = np.arange(known, len(self.ids_a.ends) - 1)
        exact = np.ones(len(new), dtype=bool)
        for store, table, size in ((self.ids_a, self.bytes_a, self.size_a), (self.ids_b, self.bytes_b, self.size_b)):
            ids, counts = store.get(at)
            ends = np.concatenate([[0], np.cumsum(size[ids])])[np.cumsum(counts)]
            if not ((ends == sizes).all() and b"".join(map(table.__getitem__, ids.tolist())) == b"".join(whole)):
                stops = np.cumsum(counts).tolist()
                exact &= [b"".join(map(table.__getitem__, ids[x:y].tolist())) == w for x, y, w in zip([0, *stops[:-1]], stops, whole)]
        self.exact = np.concatenate([self.exact, exact])
        self.held += int(sizes[-1])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(A ids of all texts, B ids, A ids of each text, B ids of each text); texts that either does not
        give back have none."""
        if len(self.known) > CACHE_ENTRIES or self.held > CACHE_CHARS:
            self.clear()
        before, numbers = len(self.known), []
        counts = np.zeros(len(texts), dtype=np.int64)
        for i, t in enumerate(texts):
            if t:
                numbers += map(self.known.__getitem__, self.stretches(t))
            counts[i] = len(numbers)
        if len(self.known) > before:
            self._learn(list(itertools.islice(self.known, before, None)))
        number = np.array(numbers, dtype=np.int64)
        counts = np.diff(counts, prepend=0)
        text = np.repeat(np.arange(len(texts)), counts)
        good = np.bincount(text[~self.exact[number]], minlength=len(texts)) == 0
        kept = good[text]
        number, text = number[kept], text[kept]
        a, size_a = self.ids_a.get(number)
        b, size_b = self.ids_b.get(number)
        n = len(texts)
        return a, b, np.bincount(text, size_a, n).astype(np.int64), np.bincount(text, size_b, n).astype(np.int64)


@functools.lru_cache(maxsize=2)
def two_tokenizers(path_a: str, path_b: str) -> TwoTokenizers:
    return TwoTokenizers(path_a, path_b)


@functools.lru_cache(maxsize=2)
def _labels(size_a: int, size_b: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, length) of the label of each code: an A id before a comma or a bar, a B id before a comma or a semicolon."""
    labels = [f"{i}{end}".encode() for size, ends in ((size_a, ",|"), (size_b, ",;")) for end in ends for i in range(size)]
    width = max(map(len, labels))
    table = np.frombuffer(b"".join(x.ljust(width) for x in labels), dtype=np.uint8).reshape(-1, width)
    return table, np.fromiter(map(len, labels), dtype=np.int64, count=len(labels))


class Aligned:
    """Groups and links of a run of texts, from their ids and how many each text has."""

    def __init__(self, tok: TwoTokenizers, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, piece: int = PIECE):
        self.a, self.b, self.n_a, self.n_b = a, b, n_a, n_b
        self.width, self.pairs = len(tok.bytes_b), len(tok.bytes_a) * len(tok.bytes_b)
        cut_a, cut_b = shared_ends(np.cumsum(tok.size_a[a]), np.cumsum(tok.size_b[b]), piece)
        self.last_a, self.last_b = np.flatnonzero(cut_a), np.flatnonzero(cut_b)  # last token of each group
        self.group_a, self.group_b = np.diff(self.last_a, prepend=-1), np.diff(self.last_b, prepend=-1)
        # groups of each text: its last token always ends a group
        self.group_ends = np.concatenate([[0], np.cumsum(cut_a)])[np.cumsum(n_a)]
        self.n_groups = np.diff(self.group_ends, prepend=0)
        links = np.concatenate([[0], np.cumsum(self.group_a * self.group_b)])[self.group_ends]
        self.n_links = np.diff(links, prepend=0)
        self.group_text = np.repeat(np.arange(len(n_a)), self.n_groups)

    def linked_pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, links): each distinct id pair of each text, as A id times the size of B's vocabulary plus B id."""
        width = self.width
        first_a, first_b = self.last_a - self.group_a + 1, self.last_b - self.group_b + 1
        links = self.group_a * self.group_b
        g = np.flatnonzero(links <= WIDE_LINKS)
        group = np.repeat(g, links[g])
        step = ranges(np.zeros(len(g), dtype=np.int64), links[g])
        pair = [self.a[first_a[group] + step // self.group_b[group]] * width + self.b[first_b[group] + step % self.group_b[group]]]
        text, weight = [self.group_text[group]], [np.ones(len(group), dtype=np.int64)]
        for k in np.flatnonzero(links > WIDE_LINKS).tolist():
            x, m = np.unique(self.a[first_a[k]:self.last_a[k] + 1], return_counts=True)
            y, n = np.unique(self.b[first_b[k]:self.last_b[k] + 1], return_counts=True)
            pair.append((x[:, None] * width + y).ravel())
            weight.append((m[:, None] * n).ravel())
            text.append(np.full(len(pair[-1]), self.group_text[k]))
        pair, text, weight = np.concatenate(pair), np.concatenate(text), np.concatenate(weight)
        if not len(pair):
            return text, pair, weight
        order = np.argsort(text * self.pairs + pair, kind="stable")
        pair, text, weight = pair[order], text[order], weight[order]
        fresh = np.flatnonzero(np.append(True, (np.diff(pair) != 0) | (np.diff(text) != 0)))
        return text[fresh], pair[fresh], np.add.reduceat(weight, fresh)

    def texts(self, tok: TwoTokenizers) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` for each text."""
        va, vb = len(tok.bytes_a), len(tok.bytes_b)
        table, size = _labels(va, vb)
        code_a, code_b = self.a.copy(), self.b + 2 * va
        code_a[self.last_a] += va
        code_b[self.last_b] += vb
        # A tokens of a group stand behind all B tokens of the groups before it
        before_b = np.repeat(np.cumsum(self.group_b) - self.group_b, self.group_a)
        before_a = np.repeat(np.cumsum(self.group_a), self.group_b)
        code = np.empty(len(code_a) + len(code_b), dtype=np.int64)
        code[np.arange(len(code_a)) + before_b] = code_a
        code[np.arange(len(code_b)) + before_a] = code_b
        sizes = size[code]
        line = table[code][np.arange(table.shape[1]) < sizes[:, None]].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(self.n_a + self.n_b)].tolist()
        return [line[x:max(x, y - 1)] for x, y in zip([0, *ends[:-1]], ends)]  # without the last semicolon


# --- over the cluster ----------------------------------------------------------------------------


IDS_SCHEMA = "chunk long, doc_ids array<long>, n_a binary, n_b binary, a binary, b binary"


def _steps(chars: list[int], limit: int, rows: int):
    """Row ranges that hold about ``limit`` characters and ``rows`` rows at most; always one row at least."""
    at = 0
    while at < len(chars):
        end, total = at, 0
        while end < len(chars) and end - at < rows and (end == at or total + chars[end] <= limit):
            total += chars[end]
            end += 1
        yield at, end
        at = end


def encode_both(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(chunk, doc_ids, n_a, n_b, a, b): a row for a run of texts, with the ids of both tokenizers as compressed
    little-endian unsigned integers and how many each text has, written to the shared folder.  Chunk numbers are
    drawn at random and kept by the written table."""
    def run(batches):
        tok = two_tokenizers(path_a, path_b)
        chunk, rows, chars = _draw(), 0, 0
        for batch in batches:
            sizes = batch.column(2).to_pylist()
            for x, y in _steps(sizes, STEP_CHARS, 1000):
                part = batch.slice(x, y - x)
                total = sum(sizes[x:y])
                if rows and (rows + y - x > CHUNK_ROWS or chars + total > CHUNK_CHARS):
                    chunk, rows, chars = _draw(), 0, 0
                rows, chars = rows + y - x, chars + total
                a, b, n_a, n_b = tok.encode(str_texts(part.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk]), pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                     *(pa.array([_packed(v, kind)], pa.binary()) for v, kind in zip((n_a, n_b, a, b), ("<u4", "<u4", *tok.types)))],
                    names=["chunk", "doc_ids", "n_a", "n_b", "a", "b"])
            release_memory()

    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n_chars"))
    return saved(rows.mapInArrow(run, IDS_SCHEMA), "two-encodings")


def _draw() -> int:
    return int.from_bytes(os.urandom(8), "little") >> 1


def _packed(values: np.ndarray, kind: str) -> bytes:
    raw = values.astype(kind).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    raw = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return np.frombuffer(raw, dtype=kind).astype(np.int64)


def _alignments(rows, tok: TwoTokenizers, piece: int):
    """The alignment of each row of ``encode_both``."""
    for k in range(rows.num_rows):
        n_a, n_b, a, b = (_unpacked(rows.column(c)[k].as_py(), kind) for c, kind in zip(("n_a", "n_b", "a", "b"), ("<u4", "<u4", *tok.types)))
        yield Aligned(tok, a, b, n_a, n_b, piece)


PAIRS_SCHEMA = "chunk long, pair long, n long"


def chunk_pairs(encoded: DataFrame, path_a: str, path_b: str, piece: int = PIECE) -> DataFrame:
    """(chunk, pair, n): the documents of a chunk that hold an id pair linked, summed over its rows in a batch."""
    def run(batches):
        tok = two_tokenizers(path_a, path_b)
        for batch in batches:
            chunk = batch.column("chunk").to_numpy()
            cuts = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])).tolist() + [len(chunk)]
            for x, y in zip(cuts[:-1], cuts[1:]):
                found = [al.linked_pairs()[1] for al in _alignments(batch.slice(x, y - x), tok, piece)]
                pair, n = np.unique(np.concatenate(found), return_counts=True)
                if len(pair):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), chunk[x])), pa.array(pair), pa.array(n.astype(np.int64))],
                                                     names=["chunk", "pair", "n"])
                release_memory()

    return saved(encoded.select("chunk", "n_a", "n_b", "a", "b").mapInArrow(run, PAIRS_SCHEMA), "chunk-pairs")


OUT_SCHEMA = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string, "
              "groups_sha256 string")


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                    piece: int = PIECE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups, groups_sha256) for every row.  ``groups`` lists the
    ids of each group as ``a1,a2|b1;a3|b2,b3``; ``n_best`` counts the links whose pair is held by as many
    documents as any pair of their A id, ``count_sum`` adds up the documents of every link's pair."""
    width = len(two_tokenizers(path_a, path_b).bytes_b)
    encoded = encode_both(docs, path_a, path_b, id_col, text_col)
    pairs = chunk_pairs(encoded, path_a, path_b, piece)
    counts = saved(pairs.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("a_id", F.floor(F.col("pair") / width)), "pair-counts")
    best = counts.groupBy("a_id").agg(F.max("count").alias("most"))
    judged = counts.join(best, "a_id").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    # a chunk read in two batches holds a pair twice, with the same count
    known = pairs.select("chunk", "pair").join(judged, "pair").select("chunk", "pair", "count", "best")

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        tok = two_tokenizers(path_a, path_b)
        pair = found.column("pair").to_numpy()
        order = np.argsort(pair)
        pair, count = pair[order], found.column("count").to_numpy()[order]
        is_best = found.column("best").to_numpy(zero_copy_only=False)[order]
        out = []
        for ids, al in zip(rows.column("doc_ids"), _alignments(rows, tok, piece)):
            n = len(ids)
            text, key, links = al.linked_pairs()
            at = np.searchsorted(pair, key)
            sums, bests = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
            np.add.at(sums, text, links * count[at])
            np.add.at(bests, text, links * is_best[at])
            groups = al.texts(tok)
            digest = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
            out.append(pa.RecordBatch.from_arrays(
                [ids.values, *(pa.array(v.astype(np.int64)) for v in (al.n_a, al.n_b, al.n_groups, al.n_links, bests, sums)),
                 pa.array(groups, pa.binary()).cast(pa.string()), pa.array(digest, pa.string())],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "groups_sha256"]))
        release_memory()
        return pa.Table.from_batches(out)

    return encoded.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(run, OUT_SCHEMA)
