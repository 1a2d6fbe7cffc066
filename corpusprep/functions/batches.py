"""Parts of Arrow batches.

Spark hands a task batches of up to 10,000 rows, and Python objects made of them take many times their bytes.  Work
that makes Python objects goes through a batch in parts, so what a task holds does not grow with its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Rows, and characters or items, that are made Python objects at a time; a larger row is a part of its own.
PART_ROWS, PART_SIZE = 1024, 1 << 20


def text_sizes(texts: pa.Array) -> np.ndarray:
    """Bytes of every text, 0 for null."""
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)


def list_sizes(lists: pa.Array) -> np.ndarray:
    """Items of every list, 0 for null."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def parts(batch: pa.RecordBatch, sizes: np.ndarray, size: int = PART_SIZE, rows: int = PART_ROWS) -> Iterator[pa.RecordBatch]:
    """The batch in consecutive slices of at most ``rows`` rows and ``size`` in all, a larger row alone."""
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and (held + n > size or i - start >= rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def list_array(ends: list[int] | np.ndarray, values: pa.Array, mask: pa.Array | None = None) -> pa.ListArray:
    """Lists of the values; ``ends`` has 0 and then the end of every list."""
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=mask)


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts as numbers, and where each text begins in them (then their end); null has none."""
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1]
    raw = data[int(ends[0]):int(ends[-1])].to_pybytes() if data is not None else b""
    points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    return points, np.concatenate([[0], np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)])


def joined_ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1 and so on, ``sizes[0]`` of them, then those of first[1]."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(first - (ends - sizes), sizes)


def last_items(lists: pa.ListArray) -> np.ndarray:
    """The last number of every list, -1 of a list without items."""
    sizes, flat = list_sizes(lists), lists.flatten().to_numpy(zero_copy_only=False)
    out = np.full(len(sizes), -1, dtype=np.int64)
    out[sizes > 0] = flat[(np.cumsum(sizes) - 1)[sizes > 0]]
    return out


def items_at(lists: pa.ListArray, at: pa.Array) -> pa.Array:
    """Of every list the item at a place counted from 0, null for a null place or list."""
    sizes = list_sizes(lists)
    known = pc.and_(at.is_valid(), lists.is_valid()).to_numpy(zero_copy_only=False)
    place = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    if ((place < 0) | (place >= sizes))[known].any():
        raise IndexError("a place outside of its list")
    return lists.flatten().take(pa.array(np.cumsum(sizes) - sizes + place, mask=~known))
