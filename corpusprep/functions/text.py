"""Text, string, JSON and array scalars (T1-T19).  Every function returns a Column.

All of them are Catalyst expressions except ``html_unescape`` and ``normalize``, which
need the Python standard library and run as Arrow-batched pandas UDFs.
"""

from __future__ import annotations

import functools
import html
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions.batches import code_points

# Character classes and markers the reference uses.
WORD_OR_PUNCT = r"(?U)(\w+|[^\w\s])"  # whitespace + punctuation pre-tokeniser
# Byte-level pre-tokeniser: contractions, optional-space letter/number/other runs, spaces.
BYTE_LEVEL_PATTERN = r"(?U)('s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+)"
SPACE_MARK = "Ġ"  # leading space in byte-level pieces
NEWLINE_MARK = "Ċ"  # newline in byte-level pieces
THINK_END = "</think>"
LATIN_WEIGHT = 0.3
HAN_WEIGHT = 0.6
HAN_RANGE = r"[\x{4E00}-\x{9FFF}]"
UNSAFE_NAME_CHARS = r'[<>:"/\\|?*\n\r\t]'
STRIP_CHARS = " \t\n\r\x0b\x0c"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c) -> Column:
    """Whitespace split with empty pieces removed (Python ``str.split()``)."""
    return F.filter(F.split(_c(c), r"\s+"), lambda x: x != "")


def word_count(c) -> Column:
    """Number of whitespace-separated words (one code-generated pass, no array)."""
    return F.regexp_count(_c(c), F.lit(r"\S+"))


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else html.unescape(v))


def html_unescape(c) -> Column:
    """Decode HTML named and numeric character references."""
    return _unescape(_c(c))


def _normalizer(form: str, accents: bool, lower: bool):
    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        def one(v):
            if v is None:
                return None
            out = unicodedata.normalize(form, v)
            if accents:
                out = "".join(ch for ch in unicodedata.normalize("NFD", out) if unicodedata.category(ch) != "Mn")
            return out.lower() if lower else out
        return s.map(one)
    return run


def normalize(c, nf: str | None = "NFD", strip_accents: bool = True, lower: bool = True) -> Column:
    """Unicode normal form, accent strip and lower-casing, each switchable."""
    if nf is None and not strip_accents:
        return F.lower(_c(c)) if lower else _c(c)
    return _normalizer(nf or "NFC", strip_accents, lower)(_c(c))


def pretokenize(c) -> Column:
    """T4: split on whitespace and punctuation; every punctuation character is its own piece."""
    return F.regexp_extract_all(_c(c), F.lit(WORD_OR_PUNCT), 1)


@functools.lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """Of every code point what ``pretokenize`` takes it for, by the same classes of the engine that evaluates it: 1 a word
    character, 2 white space, 0 a piece of its own."""
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    every = points.astype("<u4").tobytes().decode("utf-32-le")
    spark = SparkSession.active()
    row = spark.range(1).select(F.regexp_replace(F.lit(every), r"(?U)\w", "w").alias("w"), F.regexp_replace(F.lit(every), r"(?U)\s", " ").alias("s")).first()
    out = np.zeros(0x110000, dtype=np.uint8)
    for value, name, mark in ((1, "w", "w"), (2, "s", " ")):
        out[points[np.frombuffer(row[name].encode("utf-32-le"), dtype="<u4") == ord(mark)]] = value
    return out


def pretokens(texts: pa.Array, classes: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """What ``pretokenize`` makes of an Arrow array of texts: the pieces of all of them, how many each text has, and the
    character of its text that each piece begins at."""
    points, at = code_points(texts)
    kind = classes[points]
    word = kind == 1
    before, after = np.zeros(len(points), dtype=bool), np.zeros(len(points), dtype=bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    inner = at[(at > 0) & (at < len(points))]
    before[inner], after[inner - 1] = False, False
    own = kind == 0
    starts, ends = np.flatnonzero(own | (word & ~before)), np.flatnonzero(own | (word & ~after)) + 1
    bytes_ = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    solid = kind != 2
    data = points[solid].tobytes().decode("utf-32-le").encode()
    held = np.concatenate([[0], np.cumsum(np.where(solid, bytes_, 0))])
    offsets = np.append(held[starts], held[-1]).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
    sizes = np.diff(np.searchsorted(starts, at))
    return pieces, sizes, starts - np.repeat(at[:-1], sizes)


def pretokenize_spaces(c) -> Column:
    """T5: byte-level pre-tokenisation that keeps spaces: leading space -> U+0120, newline -> U+010A."""
    pieces = F.regexp_extract_all(_c(c), F.lit(BYTE_LEVEL_PATTERN), 1)
    return F.transform(pieces, lambda p: F.translate(p, " \n", SPACE_MARK + NEWLINE_MARK))


def estimate_tokens(c) -> Column:
    """About four characters per token."""
    return F.floor(F.length(_c(c)) / 4).cast("long")


def estimate_tokens_by_script(c) -> Column:
    """0.3 per non-Han character, 0.6 per Han character."""
    han = F.regexp_count(_c(c), F.lit(HAN_RANGE))
    other = F.length(_c(c)) - han
    return other * F.lit(LATIN_WEIGHT) + han * F.lit(HAN_WEIGHT)


def strip(c, chars: str = STRIP_CHARS) -> Column:
    """Remove leading and trailing whitespace."""
    return F.btrim(_c(c), F.lit(chars))


def safe_name(c, fallback: Column | str) -> Column:
    """Drop characters illegal in file names, strip, spaces -> '_', cut to 100, else fallback."""
    cleaned = F.btrim(F.regexp_replace(_c(c), UNSAFE_NAME_CHARS, ""), F.lit(STRIP_CHARS))
    cleaned = F.substring(F.replace(cleaned, F.lit(" "), F.lit("_")), 1, 100)
    fb = F.lit(fallback) if isinstance(fallback, str) else fallback
    return F.when(F.coalesce(cleaned, F.lit("")) == "", fb).otherwise(cleaned)


def safe_name_replace(c) -> Column:
    """Illegal characters become '_', ends stripped, cut to 100, 'untitled' when nothing is left."""
    cleaned = F.btrim(F.regexp_replace(_c(c), UNSAFE_NAME_CHARS, "_"), F.lit(STRIP_CHARS))
    cleaned = F.substring(cleaned, 1, 100)
    return F.when(F.coalesce(cleaned, F.lit("")) == "", F.lit("untitled")).otherwise(cleaned)


def complete_url(c) -> Column:
    """Prefix https:// when the URL has no http(s) scheme."""
    return F.when(_c(c).rlike("^https?://"), _c(c)).otherwise(F.concat(F.lit("https://"), _c(c)))


def name_from_url(c) -> Column:
    """URL path without outer slashes, inner slashes -> '_'; else the host with dots -> '_';
    made safe by T10."""
    path = F.coalesce(F.try_parse_url(_c(c), F.lit("PATH")), F.lit(""))
    path = F.replace(F.btrim(path, F.lit("/")), F.lit("/"), F.lit("_"))
    host = F.coalesce(F.try_parse_url(_c(c), F.lit("HOST")), F.lit(""))
    name = F.when(path != "", path).otherwise(F.replace(host, F.lit("."), F.lit("_")))
    return safe_name_replace(F.when(name != "", name).otherwise(F.lit("page")))


def kv_pairs(c, pair_sep: str = ";", kv_sep: str = "=") -> Column:
    """T13: 'a=1; b=x=y; z' -> array of (key, value) structs; pieces without a separator are skipped,
    only the first separator splits, key and value are trimmed."""
    pieces = F.transform(F.split(_c(c), pair_sep), lambda p: F.trim(p))
    with_sep = F.filter(pieces, lambda p: p.contains(kv_sep))
    return F.transform(
        with_sep,
        lambda p: F.struct(
            F.trim(F.substring_index(p, kv_sep, 1)).alias("key"),
            F.trim(F.substr(p, F.instr(p, kv_sep) + len(kv_sep))).alias("value"),
        ),
    )


def after_marker(c, marker: str = THINK_END) -> Column:
    """Text after the last marker, or the whole text when the marker is absent."""
    return F.substring_index(_c(c), marker, -1)


def first_json(c, schema: T.StructType, defaults: dict) -> Column:
    """Parse the text as JSON; else the first ``{...}`` without nested braces; missing
    fields take their defaults."""
    direct = F.from_json(_c(c), schema)
    embedded = F.from_json(F.nullif(F.regexp_extract(_c(c), r"(\{[^{}]*\})", 1), F.lit("")), schema)
    parsed_ok = direct.isNotNull() & F.trim(_c(c)).startswith("{")
    parsed = F.when(parsed_ok, direct).otherwise(embedded)
    return F.struct(*[F.coalesce(parsed[f.name], F.lit(defaults.get(f.name)).cast(f.dataType)).alias(f.name) for f in schema.fields])


def truncate_words(c, n: int) -> Column:
    """First n whitespace words joined by one space."""
    return F.array_join(F.slice(words(c), 1, n), " ")


def truncate_chars(c, n: int) -> Column:
    """First n characters."""
    return F.substring(_c(c), 1, n)


def concat_slices(arr, start, length) -> Column:
    """Slice of an array (1-based start)."""
    return F.slice(_c(arr), start, length)


def first_vector(c) -> Column:
    """First vector of a token-vector sequence (CLS pooling)."""
    return F.element_at(_c(c), 1)


def argmax(c) -> Column:
    """0-based index of the first maximum."""
    return (F.array_position(_c(c), F.array_max(_c(c))) - 1).cast("int")
