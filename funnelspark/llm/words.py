"""Words and word shingles of whole texts as 64-bit hashes, computed with numpy inside tasks.

A word is a maximal run of bytes other than space and \\t \\n \\v \\f \\r in UTF-8, so no word is
ever cut inside a character. Hashing works on many words at once, eight bytes of each at a time; a very
long word's hash is a sum of `table[byte] * base ** position`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

U64 = np.uint64
SLICE_BYTES = 1 << 19

_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_STEP = U64(0x9FB21C651E98DF25)
#: The first bytes of a little-endian number.
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
#: Words of more bytes are hashed one by one.
LONG_WORD = 256
_PLACES = _random.integers(1, 1 << 63, 8, dtype=np.uint64) | U64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: ASCII punctuation and digits end words too where words are features.
PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalpha())
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the word (the splitmix64 finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 4096)
        have = np.full(size, U64(base))
        have[0] = U64(1)
        have = np.multiply.accumulate(have)
        if size <= 2 * SLICE_BYTES:  # a longer one, for one very long text, is not kept
            _powers[base] = have
    return have


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """The texts of a string column as UTF-8, null as empty, a few at a time."""
    data = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    for i in range(0, len(data), 256):
        for text in data.slice(i, 256).to_pylist():
            yield text or b""


def parts(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that only a few texts are Python objects at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1024) -> Iterator[None]:
    """Fewer rows to an Arrow batch for the jobs run inside: texts and sets are wide."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def order_within(words: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order by group, then word; `group` is ascending already."""
    if len(group) and int(group[-1]) < 1 << 20:
        key = (group.astype(np.uint64) << U64(44)) | (words >> U64(20))
        order = np.argsort(key)
        key, w = key[order], words[order]
        if not ((key[1:] == key[:-1]) & (w[1:] < w[:-1])).any():
            return order
    return np.lexsort((words, group))


def slices(texts: Iterable[bytes], most: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of at most `most` bytes (a longer text alone), with the index of the first."""
    first, run, total = 0, [], 0
    for i, text in enumerate(texts):
        if run and total + len(text) > most:
            yield first, run
            first, run, total = i, [], 0
        run.append(text)
        total += len(text) + 1
    if run:
        yield first, run


def _hashed(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each run of bytes, from 8 bytes of all runs at a time. `data` ends with 8 other bytes at least."""
    eights = data.view(np.uint64)
    hashes = sizes.astype(np.uint64) * _STEP
    at, left, some = starts, sizes, slice(None)
    for _ in range(LONG_WORD // 8):
        cell, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        value = (eights[cell] >> shift) | ((eights[cell + 1] << U64(1)) << (U64(63) - shift))
        hashes[some] = mix((hashes[some] ^ (value & _MASKS[np.minimum(left, 8)])) * _STEP)
        more = np.flatnonzero(left > 8)
        if not len(more):
            break
        some = more if isinstance(some, slice) else some[more]
        at, left = at[more] + 8, left[more] - 8
    for i in np.flatnonzero(sizes > LONG_WORD):
        run = data[starts[i] : starts[i] + sizes[i]]
        hashes[i] = mix((_BYTE[run] * _power(_BASE, len(run))[: len(run)]).sum(dtype=np.uint64, keepdims=True) + U64(len(run)))[0]
    return hashes


def hash_words(
    texts: list[bytes], lower: bool = False, also_between: bytes = b"", first: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of every text, in order, and the index of its text. With `first`, a hash of no more
    than that many bytes of each word."""
    space = _SPACE
    if also_between:
        space = space.copy()
        space[list(also_between)] = True
    joined = b"\n".join(texts)
    size = len(joined)
    padded = np.frombuffer(joined + bytes(16 - size % 8), dtype=np.uint8)
    if lower:
        padded = _LOWER[padded]
    data = padded[:size]
    apart = np.ones(size + 2, dtype=bool)
    apart[1:-1] = space[data]
    edges = np.flatnonzero(apart[1:] != apart[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    if first is not None:
        ends = np.minimum(ends, starts + first)
    hashes = _hashed(padded, starts, ends - starts)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    text_of = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, np.cumsum(lengths)), prepend=0))
    return hashes, text_of


def hash_shingles(words: np.ndarray, text_of: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words inside one text; a text of fewer words gives one for all of them."""
    n = len(words)
    if not n:
        return words, text_of
    parts, owners = [], []
    if n >= k:
        total = np.zeros(n - k + 1, dtype=np.uint64)
        for j in range(k):
            total += words[j : n - k + 1 + j] * _PLACES[j]
        inside = text_of[: n - k + 1] == text_of[k - 1 :]
        parts.append(mix(total[inside]))
        owners.append(text_of[: n - k + 1][inside])
    first = np.flatnonzero(np.diff(text_of, prepend=-1))
    counts = np.diff(np.append(first, n))
    for i, m in zip(first[counts < k], counts[counts < k]):
        whole = (words[i : i + m] * _PLACES[:m]).sum(dtype=np.uint64, keepdims=True)
        parts.append(mix(whole + np.array([m], dtype=np.uint64) * U64(0xD6E8FEB86659FD93)))
        owners.append(text_of[i : i + 1])
    hashes, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return hashes[order], owner[order]


def sets_of(texts: Iterable[bytes], k: int = 5, lower: bool = True) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in the order given; texts may come from an iterator."""
    for _, run in slices(texts):
        hashes, owner = hash_shingles(*hash_words(run, lower), k)
        bounds = np.searchsorted(owner, np.arange(len(run) + 1))
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield np.unique(hashes[a:b])


def set_key(tokens: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit keys of a set, as signed numbers."""
    a = mix(tokens + U64(0x632BE59BD9B4E019)).sum(dtype=np.uint64) + U64(len(tokens))
    b = mix(tokens ^ U64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64)
    return tuple(int(x) for x in mix(np.array([a, b])).view(np.int64))
