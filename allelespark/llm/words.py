"""Words, lines and their hashes over Arrow string columns, without a Python object per word.

A column of texts is one byte buffer with offsets.  Words are found on that buffer with NumPy: a byte is a
separator or not, a word starts after a separator or at the start of a text.  UTF-8 keeps bytes below 0x80 for
ASCII alone, so every ASCII separator class can be tested byte by byte.

A word's (or a line's) hash is a digest of 128 bits, in two halves; equal words of a piece are found byte
by byte, by Arrow's dictionary encoding, and digested once.  Whole sequences of words are digests of their words'
digests.  Runs of a bounded number of words are polynomials over the digests' halves modulo 2**64, taken from prefix
sums, one for each half; polynomials never stand for sequences whose length a text decides, for which pairs of
sequences with one value can be made (two that swap two symbols in Thue-Morse order).  Null texts count as empty.
"""

from __future__ import annotations

import ctypes
import functools
import hashlib
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

# workers live on between stages: the system's allocator gives freed memory back
pa.set_memory_pool(pa.system_memory_pool())


def trim() -> None:
    """Give the memory that the allocator holds but nobody uses back to the system."""
    if release := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone has it
        release(0)


def tidy(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """task, a function for mapInArrow, that gives the memory it has freed back at its end.

    A worker waits for its next task, often of another stage, with all that the allocator still holds of this one.
    """

    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        trim()

    return run


LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: [\x20\x09-\x0D]
SPACES = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
#: [\x00-\x2F\x3A-\x60\x7B-\x7F], for text in lower case
NOT_ALNUM = np.array([b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F for b in range(256)])
NEWLINE = np.array([b == 10 for b in range(256)])

_BASE = np.uint64(0x9E3779B97F4A7C15 & ~7 | 5)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def powers(n: int, base: int = int(_BASE)) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64; kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 12), base, np.uint64)
        step[0] = 1
        have = _powers[base] = np.cumprod(step, dtype=np.uint64)
    return have[:n]


def ranged(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The polynomial hash of values[start:end] for each pair, whatever its place; for runs of bounded length."""
    inverse = pow(int(_BASE), -1, 1 << 64)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values)), out=sums[1:])
    return mix((sums[end] - sums[start]) * powers(len(values) + 1, inverse)[start])


def _digest(x: bytes) -> bytes:
    # 16 bytes or fewer are mixed as a whole by XXH3, which is several times as fast for them
    return xxhash.xxh3_128_digest(x) if len(x) <= 16 else hashlib.blake2b(x, digest_size=16).digest()


def digests(values: Iterable[bytes]) -> np.ndarray:
    """(values, 2): digests of 128 bits, in halves: XXH3 of up to 16 bytes, BLAKE2b of more."""
    return np.frombuffer(b"".join(map(_digest, values)), np.uint64).reshape(-1, 2)


class Words(NamedTuple):
    data: np.ndarray  # the bytes, in lower case if asked for
    offsets: np.ndarray  # text i is data[offsets[i]:offsets[i + 1]]
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # the words of text i are first[i]:first[i + 1]

    def column(self) -> pa.LargeBinaryArray:
        """The words as an Arrow column."""
        n = len(self.start)
        offsets = np.zeros(n + 1, np.int64)
        np.cumsum(self.end - self.start, out=offsets[1:])
        step = np.zeros(len(self.data) + 1, np.int8)
        step[self.start] += 1
        step[self.end] -= 1
        inside = np.cumsum(step[:-1], dtype=np.int8).view(bool)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(self.data[inside])])

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """The halves of each word's digest."""
        coded = self.column().dictionary_encode()
        halves = digests(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        return np.ascontiguousarray(halves[:, 0]), np.ascontiguousarray(halves[:, 1])

    def whole(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """(texts, 2): the halves of a digest of each text's sequence of words; one, two: hashes()."""
        both = np.stack([one, two], 1)
        return digests(both[a:b].tobytes() for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True))

    def bytes_of(self, text: int) -> bytes:
        return self.data[self.offsets[text] : self.offsets[text + 1]].tobytes()


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    texts = texts.fill_null("").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(texts: pa.Array, separators: np.ndarray = SPACES, lower: bool = False) -> Words:
    data, offsets = buffer(texts)
    if lower:
        data = np.frombuffer(data.tobytes().translate(LOWER), np.uint8)
    inside = ~separators[data]
    before = np.zeros(len(data) + 1, bool)  # whether a word goes on from the byte before
    before[1:] = inside
    before[offsets] = False  # a text's end ends a word
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[offsets] = False
    start = np.flatnonzero(inside & ~before[:-1])
    end = np.flatnonzero(inside & ~after[1:]) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def ngrams(hashes: np.ndarray, n: int, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of all runs of n words inside a text."""
    if len(hashes) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ok = np.ones(len(hashes) + 1, bool)
    for k in range(1, n):  # a run must not start among the last n - 1 words of a text
        ok[np.maximum(first[1:] - k, first[:-1])[first[1:] > first[:-1]]] = False
    start = np.flatnonzero(ok[: len(hashes) - n + 1])
    return start, ranged(hashes, start, start + n)


def parts(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about `size` bytes of text; a longer text is a piece of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = buffer(batch.column(batch.schema.get_field_index(column)))
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1)
            yield batch.slice(low, high - low)
            low = high


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
