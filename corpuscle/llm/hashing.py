"""Vectorised word hashing over Arrow string batches.

A batch's UTF-8 buffer is hashed in a handful of numpy passes: every byte gets a
random 64-bit value times a power of an odd base, one wrapping cumulative sum gives
all substring sums, and multiplying by the inverse power makes the hash of a word
independent of its place.  No Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at once; a longer document is cut at a word boundary and carried on.
CHUNK = 1 << 20

_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, CHUNK), base, dtype=np.uint64)
        out[0] = 1
        _powers[base] = have = np.multiply.accumulate(out)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3, elementwise."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def combine(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of several hash columns; the order of the columns counts."""
    out = columns[0]
    for i, c in enumerate(columns[1:], 1):
        out = mix(out * np.uint64(_BASE) + c + np.uint64(i))
    return out


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets into them; a null has length 0."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def _hash_runs(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of raw[start:end]; the runs ascend and don't overlap."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        low = start[i]
        j = max(i + 1, int(np.searchsorted(end, low + CHUNK, "right")))
        n = int(end[j - 1] - low)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[raw[low : low + n]] * _power(_BASE, n), out=sums[1:])
        s, e = start[i:j] - low, end[i:j] - low
        out[i:j] = (sums[e] - sums[s]) * _power(_INVERSE, n + 1)[s]
        i = j
    return mix(out)


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and n + 1 offsets: where each text's words begin.

    A word is a longest run of letters, digits and bytes outside ASCII, lower-cased.
    A null or blank text has none.
    """
    raw, at = buffers(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    inside = _WORD[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = at[1:-1]
    cut = cut[(cut > 0) & (cut < len(raw))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return _hash_runs(raw, start, end), np.searchsorted(start, at).astype(np.int64)


def slices(batch: pa.RecordBatch, column: str | int, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about `most` bytes of text, so that memory is bounded; a longer text is a part."""
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64))
    i = 0
    while i < batch.num_rows:
        done = size[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(size, done + most, "right")))
        yield batch.slice(i, j - i)
        i = j
