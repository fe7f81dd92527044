"""Arrow/numpy helpers for word-level work inside ``mapInArrow`` tasks.

A task sees record batches; ``slices`` cuts a batch so that one slice holds a
bounded number of text bytes, and everything below works on flat numpy arrays
of one slice (words of all its documents one after another, plus offsets), so
memory per task does not depend on the table.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xFF51AFD7ED558CCD)
_M2 = np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)
_FIRST_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)  # masks of the first k of eight bytes


def give_back() -> None:
    """Return this Python worker's freed memory to the system: Spark keeps
    idle workers, and what they hold is missing from the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def released(*clear: Callable[[], None]):
    """Decorator of a function over a task's batches: at the task's end the
    caches go that ``clear`` empties, and freed memory is given back."""

    def decorate(run):
        @functools.wraps(run)
        def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            try:
                yield from run(batches)
            finally:
                for f in clear:
                    f()
                give_back()

        return wrapped

    return decorate


def slices(batch: pa.RecordBatch, column: str = "text", max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of ``batch`` of at most ``max_bytes`` text bytes
    (or one row, when a single text is longer)."""
    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    end = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        base = end[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(end, base + max_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def flat_words(texts: pa.Array, lower: bool) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text, flattened, and the offsets
    of each text's words.  A null text has no words; ``lower`` maps A-Z only."""
    texts = _compact(texts)
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    return _drop_empty(words, offsets)


def flat_alnum_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of every text after
    mapping A-Z to a-z: runs of ASCII digits, a-z and non-ASCII characters."""
    texts = pc.ascii_lower(_compact(texts))
    spaced = pc.replace_substring_regex(texts, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    lists = pc.split_pattern(spaced, " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return _drop_empty(lists.flatten(), offsets - offsets[0])


def _compact(texts: pa.Array) -> pa.Array:
    """Nulls as empty texts, copied to a buffer of their own: the string
    kernels misread slices whose first offset is not zero."""
    return pc.fill_null(texts.take(pa.array(np.arange(len(texts)))), "")


def _drop_empty(words: pa.Array, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    keep = pc.not_equal(pc.binary_length(words), 0)
    kept = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])
    return words.filter(keep), kept[offsets]


def encode(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes of the words and the distinct words they refer to."""
    d = words.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False), d.dictionary


def hash_words(words: pa.Array, seed: int = 0) -> np.ndarray:
    """One 64-bit hash for each word, eight bytes of all words at a time."""
    words = words.cast(pa.large_string())
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    _, where, data = words.buffers()
    at = np.frombuffer(where, np.int64)[words.offset : words.offset + n + 1]
    start, left = at[:-1] - at[0], np.diff(at)
    raw = np.concatenate([np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8), np.zeros(8, np.uint8)])
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))  # the eight bytes from every place
    acc = mix(left.astype(np.uint64) * _ODD + np.uint64(seed * 2 + 1))
    acc = mix(acc * _ODD + (eight[start] & _FIRST_BYTES[np.minimum(left, 8)]))
    todo = np.flatnonzero(left > 8)
    while len(todo):
        start[todo] += 8
        left[todo] -= 8
        more = eight[start[todo]] & _FIRST_BYTES[np.minimum(left[todo], 8)]
        acc[todo] = mix(acc[todo] * _ODD + more)
        todo = todo[left[todo] > 8]
    return acc


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x = x ^ (x >> _S33)
    x = x * _M2
    return x ^ (x >> _S33)


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of ``h[i : i + width]`` for every i (windows may cross documents;
    the caller masks those)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for j in range(width):
        acc = acc * _ODD + h[j : j + n]
    return mix(acc)


def owners(offsets: np.ndarray) -> np.ndarray:
    """For each flat position the index of its document."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def as_long(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as signed longs."""
    return x.view(np.int64)


def code_points(distinct: pa.Array, left: str, right: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of every word between the two marks, flat, and offsets."""
    words = distinct.to_pylist()
    if not words:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    flat = np.frombuffer((left + (right + left).join(words) + right).encode("utf-32-le"), np.uint32)
    size = pc.utf8_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64) + 2
    return flat, np.concatenate([[0], np.cumsum(size)])


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive offsets (empty stretches: 0)."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]
