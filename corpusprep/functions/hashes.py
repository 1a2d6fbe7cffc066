"""MD5 draws of many numbered keys at a time.

``seeded_uniform`` of (seed, key, position) takes the first eight hex digits of the md5 of the joined parts.  For every
position of an array that is one digest each; here the digests of a whole batch are computed together in numpy, with the
steps of RFC 1321 taken once for thousands of messages.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa

# Messages that are digested together: their 64-byte blocks fit a processor's cache.
TOGETHER = 1 << 14
# Longest message that fits one block.
ONE_BLOCK = 55

_SINES = [int(abs(math.sin(i + 1)) * (1 << 32)) for i in range(64)]
_TURNS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _first_words(blocks: np.ndarray) -> np.ndarray:
    """First 32 bits of the digests of one-block messages, ``blocks`` (messages x 64 bytes, padded), as the number that
    their hex digits stand for."""
    x = np.ascontiguousarray(blocks.view("<u4").T)
    used = x.any(axis=1)
    a, b, c, d = (np.full(x.shape[1], v, dtype=np.uint32) for v in _START)
    for i in range(64):
        turn = i // 16
        if turn == 0:
            f, k = d ^ (b & (c ^ d)), i
        elif turn == 1:
            f, k = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif turn == 2:
            f, k = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, k = c ^ (b | ~d), 7 * i % 16
        f += a
        f += np.uint32(_SINES[i])
        if used[k]:
            f += x[k]
        s = _TURNS[turn][i % 4]
        a, d, c, b = d, c, b, b + ((f << np.uint32(s)) | (f >> np.uint32(32 - s)))
    return (a + np.uint32(_START[0])).byteswap()


def numbered_draws(prefixes: pa.Array, counts: np.ndarray, wanted: np.ndarray | None = None) -> np.ndarray:
    """For every row the draws of ``prefix + "0"``, ``prefix + "1"`` and so on, ``counts`` of them, as numbers below
    2 ** 32: the first eight hex digits of the md5 of each.  ``wanted`` marks those to be drawn, if not all."""
    raw = [p.encode() for p in prefixes.to_pylist()]
    counts = np.asarray(counts, dtype=np.int64)
    longest = len(str(max(int(counts.max(initial=0)) - 1, 0)))
    heads = np.zeros((len(raw), 64), dtype=np.uint8)
    sizes = np.array([len(p) for p in raw], dtype=np.int64)
    short = sizes + longest <= ONE_BLOCK
    for i, p in enumerate(raw):
        if short[i]:
            heads[i, :len(p)] = np.frombuffer(p, dtype=np.uint8)
    rows = np.repeat(np.arange(len(raw)), counts)
    numbers = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    if wanted is not None:
        rows, numbers = rows[wanted], numbers[wanted]
    out = np.empty(len(rows), dtype=np.uint32)
    for lo in range(0, len(rows), TOGETHER):
        row, number = rows[lo:lo + TOGETHER], numbers[lo:lo + TOGETHER].astype(np.int32)
        blocks = heads[row]
        digits = np.ones(len(row), dtype=np.int32)
        for k in range(1, longest):
            digits += number >= 10 ** k
        each = np.flatnonzero(short[row])
        last = sizes[row] + digits - 1
        for k in range(longest):  # the k-th digit from the right
            some = each[digits[each] > k] if k else each
            blocks[some, last[some] - k] = 48 + number[some] % 10
            number = number // 10
        blocks[each, last[each] + 1] = 0x80
        blocks.view("<u4")[each, 14] = 8 * (last[each] + 1)
        out[lo:lo + TOGETHER] = _first_words(blocks)
        for i in np.flatnonzero(~short[row]).tolist():
            out[lo + i] = int(hashlib.md5(raw[row[i]] + str(numbers[lo + i]).encode()).hexdigest()[:8], 16)
    return out
