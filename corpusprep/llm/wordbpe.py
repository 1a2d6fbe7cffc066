"""BPE encoding and decoding with a public word-level vocabulary file.

A text is cut at white space into chunks and each chunk into words, as the file's normalizer and
pre-tokenizer prescribe.  Words are independent of each other, so a task encodes each distinct word
once (in a cache of bounded size) and puts documents together from the cached ids.

Merging.  The symbols of all new words lie in one flat array.  A round forms the key of every
neighbouring pair, finds its rank by binary search over the sorted keys of the merge table, takes the
lowest rank of each word, and merges all places of that pair at once, left to right.  That equals
merging one place at a time unless a merge can enable another of lower rank; for those merges only the
leftmost place is taken.

Defined results: a null text encodes as an empty one; an empty text has no ids and decodes to the empty
string; the file's special tokens are recognised inside texts; only the id and text columns are read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import ranges, release_memory, slices, str_texts

#: Chunks and words kept by a task before its cache is emptied.
CACHE_ENTRIES = 100_000
#: Characters encoded at a time.
STEP_CHARS = 1 << 20
#: Documents taken from a batch at a time.
STEP_ROWS = 500
_BIG = np.int64(1) << 62

# Latin text (U+0021 to U+024F without spaces) whose classes and case are the same in every Unicode version.
_PLAIN = re.compile(f"[!-~{chr(0xA1)}-{chr(0x24F)}]+")
# White space of the vocabulary file.  str.split() also cuts at U+001C to U+001F, which are no white space there.
_SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_CHUNK = regex.compile("[^" + "".join(map(chr, _SPACES)) + "]+")
_CONTROL = re.compile(r"[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordSplitter:
    """Texts to chunks and chunks to words (UTF-8 bytes), for one vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        split = next(p for p in self.spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(split["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self.special_at = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.library = Tokenizer.from_file(path)
        self.symbols = byte_symbols()
        self.byte_of = {c: b for b, c in enumerate(self.symbols)}

    def chunks(self, text: str) -> list:
        """Chunks of one text; a special token is the pair ("special", id)."""
        if "<|" in text and self.special_at.search(text):
            out: list = []
            for part in self.special_at.split(text):
                out.extend([("special", self.special[part])] if part in self.special else self.chunks(part))
            return out
        return _CHUNK.findall(text) if _CONTROL.search(text) else text.split()

    def words(self, chunk: str) -> list[bytes]:
        if _PLAIN.fullmatch(chunk):
            low = chunk.lower()
            if low.isalpha():
                return [low.encode()]
            if low[:-1].isalpha() and low[-1] in ".,;:!?":
                return [low[:-1].encode(), low[-1].encode()]
            return [w.encode() for w in self.word.findall(unicodedata.normalize("NFC", low))]
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))
        return [bytes(map(self.byte_of.__getitem__, p)) for p, _ in pieces]


class WordBpe:
    """The merge table of a vocabulary file as arrays."""

    def __init__(self, spec: dict):
        vocab = spec["model"]["vocab"]
        self.end = spec["model"]["end_of_word_suffix"] or ""
        self.tokens = [""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for t, i in vocab.items():
            self.tokens[i] = t
        for t in spec["added_tokens"]:
            self.tokens[t["id"]] = t["content"]
        self.width = np.int64(len(self.tokens))
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.product = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = left * self.width + right
        self.rank = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank]
        first_use = np.full(len(self.tokens), len(pairs), dtype=np.int64)
        ranks = np.arange(len(pairs))
        np.minimum.at(first_use, left, ranks)
        np.minimum.at(first_use, right, ranks)
        self.one_by_one = first_use[self.product] < ranks
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int64)
        self.last = np.array([vocab[s + self.end] for s in symbols], dtype=np.int64)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, ids of each word)."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        sym = self.inner[raw]
        ends = np.cumsum(sizes) - 1
        sym[ends[sizes > 0]] = self.last[raw[ends[sizes > 0]]]
        word = np.repeat(np.arange(len(words)), sizes)
        done_sym, done_word = [], []
        while len(sym):
            rank = np.full(len(sym), _BIG)
            pair = sym[:-1] * self.width + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            hit = (self.keys[at] == pair) & (word[:-1] == word[1:])
            rank[:-1][hit] = self.rank[at[hit]]
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            count = np.diff(np.append(first, len(sym)))
            best = np.minimum.reduceat(rank, first)
            settled = np.repeat(best == _BIG, count)
            if settled.any():
                done_sym.append(sym[settled])
                done_word.append(word[settled])
                sym, word, rank = sym[~settled], word[~settled], rank[~settled]
                count, best = count[best != _BIG], best[best != _BIG]
                if not len(sym):
                    break
            places = np.flatnonzero(rank == np.repeat(best, count))
            # places in a row share a symbol: every second one of such a run is merged
            start = np.append(True, np.diff(places) != 1)
            run = np.arange(len(places)) - np.maximum.accumulate(np.where(start, np.arange(len(places)), 0))
            take = run % 2 == 0
            lone = self.one_by_one[rank[places]]
            if lone.any():
                leftmost = np.append(True, word[places][1:] != word[places][:-1])
                take &= ~lone | leftmost
            places = places[take]
            sym[places] = self.product[rank[places]]
            keep = np.ones(len(sym), dtype=bool)
            keep[places + 1] = False
            sym, word = sym[keep], word[keep]
        if not done_sym:
            return np.zeros(0, dtype=np.int32), np.zeros(len(words), dtype=np.int64)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        return sym[np.argsort(word, kind="stable")].astype(np.int32), np.bincount(word, minlength=len(words))

    def decode(self, ids: list[int]) -> str:
        """The tokens with spaces between: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


class _Numbers(dict):
    """Numbers its keys in the order of their first look-up."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class _Store:
    """Id lists by number, in one flat array."""

    def __init__(self):
        self.flat, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        base = len(self.flat)
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        self.starts = np.concatenate([self.starts, base + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])

    def get(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[numbers]
        return self.flat[ranges(self.starts[numbers], sizes)], sizes


class CachedEncoder:
    """Texts to ids over caches of chunks and words; ``encode_words`` sees each new word once."""

    def __init__(self, splitter: WordSplitter, encode_words: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
                 entries: int = CACHE_ENTRIES):
        self.splitter, self.encode_words, self.entries = splitter, encode_words, entries
        self.clear()

    def clear(self) -> None:
        self.chunk, self.word = _Numbers(), _Numbers()
        self.chunk_ids, self.word_ids = _Store(), _Store()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids of each text)."""
        if len(self.chunk) > self.entries or len(self.word) > self.entries:
            self.clear()
        known = len(self.chunk)
        numbers: list[int] = []
        counts = np.zeros(len(texts), dtype=np.int64)
        for i, t in enumerate(texts):
            before = len(numbers)
            numbers.extend(map(self.chunk.__getitem__, self.splitter.chunks(t)))
            counts[i] = len(numbers) - before
        if len(self.chunk) > known:
            self._learn(list(self.chunk)[known:] if known else list(self.chunk))
        flat, sizes = self.chunk_ids.get(np.array(numbers, dtype=np.int64))
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return flat, np.diff(ends[np.concatenate(([0], np.cumsum(counts)))])

    def _learn(self, chunks: list) -> None:
        known = len(self.word)
        words: list[int] = []
        per_chunk = np.zeros(len(chunks), dtype=np.int64)
        for i, c in enumerate(chunks):
            if isinstance(c, tuple):
                words.append(self.word[c])
                per_chunk[i] = 1
            else:
                found = self.splitter.words(c)
                words.extend(map(self.word.__getitem__, found))
                per_chunk[i] = len(found)
        if len(self.word) > known:
            new = list(self.word)[known:]
            plain = [w for w in new if not isinstance(w, tuple)]
            flat, sizes = self.encode_words(plain)
            if len(plain) < len(new):
                ends, at, parts, counts = np.concatenate(([0], np.cumsum(sizes))), 0, [], []
                for w in new:
                    if isinstance(w, tuple):
                        parts.append(np.array([w[1]], dtype=np.int32))
                    else:
                        parts.append(flat[ends[at]:ends[at + 1]])
                        at += 1
                    counts.append(len(parts[-1]))
                flat, sizes = np.concatenate(parts), np.array(counts, dtype=np.int64)
            self.word_ids.add(flat, sizes)
        flat, sizes = self.word_ids.get(np.array(words, dtype=np.int64))
        ends = np.concatenate(([0], np.cumsum(sizes)))
        self.chunk_ids.add(flat, np.diff(ends[np.concatenate(([0], np.cumsum(per_chunk)))]))

    def steps(self, texts: list[str], chars: int = STEP_CHARS):
        """``encode`` for runs of texts of about ``chars`` characters."""
        at = 0
        while at < len(texts):
            end, total = at, 0
            while end < len(texts) and (end == at or total + len(texts[end]) <= chars):
                total += len(texts[end])
                end += 1
            yield self.encode(texts[at:end])
            at = end


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    """The vocabulary of ``path``, once per Python worker."""
    with open(path, encoding="utf-8") as f:
        return WordBpe(json.load(f))


@functools.lru_cache(maxsize=2)
def merge_encoder(path: str) -> CachedEncoder:
    """The encoder of ``path``, once per Python worker."""
    return CachedEncoder(WordSplitter(path), vocabulary(path).encode_words)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) for every row."""
    def run(batches):
        encoder = merge_encoder(path)
        for batch in batches:
            for a in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(a, STEP_ROWS)
                at = 0
                for flat, sizes in encoder.steps(str_texts(part.column(1))):
                    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
                    lists = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))
                    yield pa.RecordBatch.from_arrays([part.column(0).slice(at, len(sizes)), lists], names=["doc_id", "ids"])
                    at += len(sizes)

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, text): the decoded text and the digest of the ids as little-endian
    unsigned 32-bit integers.  Null ids count as none."""
    def run(batches):
        bpe = vocabulary(path)
        for batch in batches:
            for a in range(0, batch.num_rows, STEP_ROWS):
                doc_ids, sizes, digests, texts = batch.column(0).slice(a, STEP_ROWS), [], [], []
                for found in batch.column(1).slice(a, STEP_ROWS):
                    ids = found.values.to_numpy().astype("<u4")
                    sizes.append(len(ids))
                    digests.append(hashlib.sha256(ids.tobytes()).hexdigest())
                    texts.append(bpe.decode(ids.tolist()))
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "text"])

    d = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    return d.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, text string")


def encode_checked(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) for every row: its ids and digests of the ids and of
    the text they decode to.  One pass, so that a task needs one Python worker."""
    def run(batches):
        encoder, bpe = merge_encoder(path), vocabulary(path)
        for part in slices(batches, STEP_ROWS):
            at = 0
            for flat, sizes in encoder.steps(str_texts(part.column(1))):
                ends = np.concatenate(([0], np.cumsum(sizes)))
                ids, decoded = [], []
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                    own = flat[a:b]
                    ids.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                    decoded.append(hashlib.sha256(bpe.decode(own.tolist()).encode()).hexdigest())
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(at, len(sizes)), pa.array(sizes.astype(np.int64)), lists, pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                    names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])
                at += len(sizes)
        release_memory()

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string")
