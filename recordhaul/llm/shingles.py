"""Words and word shingles of whole texts as 64-bit hashes, for a batch of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: UTF-8 bytes that are hashed at once.
BATCH_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS = np.ones(0, np.uint64)
_BACKS = np.ones(0, np.uint64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _BACKS
    if len(_POWERS) < n:
        size = max(n, BATCH_BYTES)
        _POWERS = np.cumprod(np.full(size, _BASE), dtype=np.uint64)
        _BACKS = np.cumprod(np.full(size, _BACK), dtype=np.uint64)
    return _POWERS[:n], _BACKS[:n]


def word_places(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last byte and hash of all words of texts that lie one behind the other."""
    white = _WHITE[data]
    starts_word = ~white
    starts_word[1:] &= white[:-1]
    ends_word = ~white
    ends_word[:-1] &= white[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    starts_word[inner] = ~white[inner]
    ends_word[inner - 1] = ~white[inner - 1]
    first, last = np.flatnonzero(starts_word), np.flatnonzero(ends_word)
    powers, backs = _powers(len(data))
    sums = np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * powers, dtype=np.uint64)
    before = np.where(first > 0, sums[np.maximum(first, 1) - 1], np.uint64(0))
    hashes = mix((sums[last] - before) * backs[first] + (last - first + 1).astype(np.uint64))
    return first, last, hashes


def byte_groups(texts: pa.Array, size: int = BATCH_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Parts of a column of about ``size`` bytes: the first text, all bytes, and where each text begins."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin = 0
    while begin < len(texts):
        total = np.cumsum(sizes[begin:])
        count = max(1, int(np.searchsorted(total, size, "right")))
        part = b"".join(x for x in texts.slice(begin, count).cast(pa.large_binary()).to_pylist() if x)
        yield begin, np.frombuffer(part, np.uint8), np.concatenate([[0], total[:count]]).astype(np.int64)
        begin += count


def word_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text: 64-bit hashes of its words, with A-Z read as a-z.

    A word is a run of bytes other than ASCII white space. A null text has no words.
    """
    begin = 0
    texts = texts.cast(pa.large_binary())
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    while begin < len(texts):
        total = np.cumsum(sizes[begin:])
        count = max(1, int(np.searchsorted(total, BATCH_BYTES, "right")))
        part = [x for x in texts.slice(begin, count).to_pylist() if x]
        bounds = np.concatenate([[0], total[:count]]).astype(np.int64)
        if not part:
            yield from [np.empty(0, np.uint64)] * count
        else:
            first, _, hashes = word_places(np.frombuffer(b"".join(part), np.uint8), bounds)
            at = np.searchsorted(first, bounds)
            yield from (hashes[a:b] for a, b in zip(at, at[1:], strict=False))
        begin += count


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """The sorted distinct shingles of ``size`` words; fewer words are one shingle, none are none."""
    if not len(words):
        return np.empty(0, np.uint64)
    width = min(size, len(words))
    out = np.full(len(words) - width + 1, np.uint64(width))
    for n in range(width):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + words[n : n + len(out)])
    return np.unique(out)
