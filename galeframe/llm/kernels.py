"""numpy kernels over the bytes of an Arrow batch: words, 64-bit word hashes and word n-gram hashes.

Every kernel works on whole texts. A batch is cut into runs of rows of about `CHUNK_BYTES`, so memory is bounded by
the larger of that and the longest single text. Texts are UTF-8 and separators are ASCII, so bytes split like code
points. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240117))
#: A random odd value for each byte, and the odd base of the polynomial hash with its inverse modulo 2**64.
BYTE_VALUES = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(_rng.integers(1 << 60, 1 << 61)) * 8 + 5
INVERSE = pow(BASE, -1, 1 << 64)
#: Odd multipliers of the words of an n-gram.
PLACE = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def byte_set(*spans: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, true outside the given closed spans of bytes."""
    keep = np.ones(256, dtype=bool)
    for a, b in spans:
        keep[a : b + 1] = False
    return keep


#: `[^\x20\x09-\x0D]+`
NOT_SPACE = byte_set((0x20, 0x20), (0x09, 0x0D))
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, after A-Z became a-z
ALNUM = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, base: int, n: int) -> np.ndarray:
    table = _powers.get(kind)
    if table is None or len(table) < n:
        size = max(n, CHUNK_BYTES + (1 << 16))
        table = np.full(size, np.uint64(base), dtype=np.uint64)
        table[0] = 1
        table = np.multiply.accumulate(table)
        if size <= 8 * CHUNK_BYTES:
            _powers[kind] = table
    return table[:n]


class Chunk(NamedTuple):
    """Consecutive rows `[first, last)` of a batch: their bytes, and where each row's bytes begin (one more than rows)."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


def chunks(texts: pa.Array, most: int = CHUNK_BYTES, rows: int = 1 << 30) -> Iterator[Chunk]:
    """Runs of rows of about `most` bytes and at most `rows` rows; a longer text comes alone and whole. Nulls have no bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, dtype=np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        to = min(to, at + rows)
        yield Chunk(at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


class Words(NamedTuple):
    """Starts and ends of all words in a chunk, and the index of each row's first word (one more than rows)."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray


def words(chunk: Chunk, keep: np.ndarray, lower: bool = False) -> Words:
    data = LOWER[chunk.data] if lower else chunk.data
    inside = keep[data]
    n = len(inside)
    if n == 0:
        empty = np.empty(0, dtype=np.int64)
        return Words(empty, empty, np.zeros(len(chunk.bounds), dtype=np.int64))
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    edges = chunk.bounds[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    begin[edges] = inside[edges]
    stop[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begin)
    return Words(starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, chunk.bounds))


def word_hashes(chunk: Chunk, w: Words, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes (A-Z as a-z if `lower`): a polynomial modulo 2**64, then `mix`."""
    n = len(chunk.data)
    values = (BYTE_VALUES[LOWER] if lower else BYTE_VALUES)[chunk.data]
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * _power("up", BASE, n), out=sums[1:])
    return mix((sums[w.ends] - sums[w.starts]) * _power("down", INVERSE, n)[w.starts])


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n words from each position on; the last n - 1 positions have none. Rows are not told apart."""
    if len(hashes) < n:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
    for j in range(n):
        out += hashes[j : j + len(out)] * PLACE[j]
    return mix(out)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
