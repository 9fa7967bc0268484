"""Word and shingle hashing on whole Arrow text columns (numpy, no per-word Python).

A word is a maximal run of bytes outside the six ASCII white-space characters; A-Z
may be folded first. Null texts have no words. Memory is bounded by the batch plus
one block of about ``BLOCK`` bytes (a longer single word widens its block).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
SHINGLE = 5

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: all of ASCII but its letters: words are then runs of letters and non-ASCII characters
NOT_LETTERS = np.zeros(256, dtype=bool)
NOT_LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_PLACES = 4096


def _weights(seed: int, n: int) -> np.ndarray:
    """n odd 64-bit multipliers from a fixed seed (equal on every executor)."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_PLACE = _weights(11, _PLACES)
_STEP = _weights(12, 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows (null: empty)."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    values = column.buffers()[2]
    if values is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(values, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def _block_end(data: np.ndarray, offsets: np.ndarray, start: int, space: np.ndarray) -> int:
    """The end of a block of about BLOCK bytes that cuts no word."""
    total = len(data)
    end = min(start + BLOCK, total)
    while end < total:
        row = offsets[np.searchsorted(offsets, end, side="right") - 1]
        spaces = np.flatnonzero(space[data[start:end]])
        cut = max(int(row), start + int(spaces[-1]) + 1 if len(spaces) else 0)
        if cut > start:
            return cut
        end = min(start + 2 * (end - start), total)
    return end


def hash_words(data: np.ndarray, offsets: np.ndarray, fold: bool = True,
               space: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and the n + 1 word bounds of the rows.

    ``space`` tells which bytes part words (default: white space).
    """
    hashes, starts_all = [], []
    start, total = 0, len(data)
    while start < total:
        end = _block_end(data, offsets, start, space)
        block = data[start:end]
        if fold:
            block = _FOLD[block]
        word = ~space[block]
        first = word.copy()
        first[1:] &= ~word[:-1]
        rows = offsets[np.searchsorted(offsets, start):np.searchsorted(offsets, end)] - start
        first[rows] |= word[rows]
        starts = np.flatnonzero(first)
        if len(starts):
            at = np.flatnonzero(word)
            begin = np.searchsorted(at, starts)
            lengths = np.diff(np.append(begin, len(at)))
            place = np.arange(len(at)) - np.repeat(begin, lengths)
            value = (block[at].astype(np.uint64) + np.uint64(1)) * _PLACE[place & (_PLACES - 1)]
            if lengths.max() > _PLACES:
                value = mix(value + (place // _PLACES).astype(np.uint64))
            h = np.add.reduceat(value, begin) + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            hashes.append(mix(h))
            starts_all.append(starts + start)
        start = end
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts_all), offsets)


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words (a shorter, non-empty list is one run)."""
    if len(words) == 0:
        return np.empty(0, np.uint64)
    n = min(size, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        out += words[j:len(words) - n + 1 + j] * _STEP[j]
    return mix(out + np.uint64(n))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def byte_slices(batch: pa.RecordBatch, name: str, size: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes in the named text column (a longer row is alone)."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(column(batch, name)), 0))
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > size:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)
