"""Words, shingles and windows of text batches as numpy arrays.

Words are maximal runs of bytes other than space and \\t\\n\\v\\f\\r. A null text has no words. Hashes are computed
for a whole batch at once, so no Python code runs per word: every byte has a random value at every place of a word, and a
word's hash mixes the sum of its bytes' values. (A polynomial modulo 2**64 would give some long repetitive words one hash.)
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; arrays over them take some fifty times as much. A longer text is taken alone.
CHUNK_BYTES = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Places of a word with byte values of their own; further places take them again, each block by a factor of its own.
PLACES = 64


@lru_cache(maxsize=4)
def _byte_values(seed: int) -> np.ndarray:
    """A value for every byte at every place, by 256 * place + byte."""
    return mix(mix(np.arange(1, 256 * PLACES + 1, dtype=np.uint64) * np.uint64(_ODD[seed % 2])) + np.uint64(seed))


@lru_cache(maxsize=3)
def _powers(seed: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    both = []
    for base in (_ODD[seed], pow(_ODD[seed], -1, 1 << 64)):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        both.append(np.cumprod(steps, dtype=np.uint64))
    return both[0], both[1]


def _power_tables(seed: int, need: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(seed, 1 << max(20, int(need).bit_length()))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of values[start:end] for each span; equal sequences have equal hashes wherever they stand."""
    powers, inverse = _power_tables(seed, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], out=sums[1:])
    length = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + length * np.uint64(_ODD[1 - seed]))


@dataclass
class Words:
    """Words of a batch: byte spans in `data`, and for text i the words first[i] to first[i + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self, seed: int = 0) -> np.ndarray:
        """Hash of every word. Words go from long to short, so that those with a byte at a place are the first ones."""
        values, size = _byte_values(seed), self.ends - self.starts
        order = np.argsort(-np.minimum(size, PLACES).astype(np.int16), kind="stable")
        at, length = self.starts[order], size[order]
        total = length.astype(np.uint64) * np.uint64(_ODD[1 - seed % 2])
        longer = np.cumsum(np.bincount(np.minimum(size, PLACES), minlength=PLACES + 1)[::-1])[::-1]
        for place in range(PLACES):
            count = int(longer[place + 1])
            if not count:
                break
            total[:count] += values[256 * place : 256 * place + 256][self.data[at[:count] + place]]
        long = np.flatnonzero(length[: int(longer[PLACES])] > PLACES)
        while len(long):  # blocks of words, so that many long ones need no table of their own length
            stop = max(1, int(np.searchsorted(np.cumsum(length[long]), CHUNK_BYTES, side="right")))
            mine, long = long[:stop], long[stop:]
            rest = length[mine] - PLACES
            first = np.cumsum(rest) - rest
            place = np.arange(int(rest.sum())) - np.repeat(first, rest) + PLACES
            parts = values[((place % PLACES) << 8) | self.data[np.repeat(at[mine], rest) + place]]
            parts *= mix((place // PLACES).astype(np.uint64) * np.uint64(_ODD[1])) | np.uint64(1)
            total[mine] += np.add.reduceat(parts, first)
        found = np.empty(len(size), np.uint64)
        found[order] = mix(total)
        return found

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    data, offsets = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = ~_SPACE[data]
    begins = solid[1:-1] & ~solid[:-2]
    stops = solid[1:-1] & ~solid[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] |= solid[edges + 1]
    stops[edges - 1] |= solid[edges]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of `size` consecutive words at every position that has as many (texts are not told apart here)."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total += words[k : k + len(total)] * np.uint64(pow(_ODD[0], k + 1, 1 << 64))
    return mix(total)


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each text; a text with fewer words is one shingle, without words it has none."""
    hashes = words.hashes()
    grams = gram_hashes(hashes, size)
    sets = []
    for begin, end in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if end - begin >= size:
            sets.append(np.unique(grams[begin : end - size + 1]))
        elif end > begin:
            short = gram_hashes(hashes[begin:end], end - begin) + np.uint64(end - begin)
            sets.append(mix(short * np.uint64(_ODD[1])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def give_back() -> None:
    """Free memory goes back to the system: a worker lives through many stages and should not keep the peak of each."""
    pa.default_memory_pool().release_unused()
    if (trim := _malloc_trim()) is not None:
        trim(0)


@lru_cache(maxsize=1)
def _malloc_trim():
    return getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that one piece holds at most `limit` bytes of text, or one longer text."""
    give_back()  # what the worker's last task has left
    for batch in batches:
        at = batch.schema.get_field_index(column)
        sizes = np.diff(text_bytes(batch.column(at))[1])
        ends = np.cumsum(sizes)
        row = 0
        while row < batch.num_rows:
            before = ends[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(row, stop - row)
            row = stop
    give_back()
