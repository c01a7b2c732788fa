"""Hashes of word shingles of many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: A-Z become a-z; blank, tab, line feed, vertical tab, form feed and carriage return part words.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
PARTS = np.zeros(256, bool)
PARTS[[32, *range(9, 14)]] = True
#: Each byte's own random value, from a fixed seed.
BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(value: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    value = value ^ (value >> np.uint64(30))
    value = value * MIX1
    value = value ^ (value >> np.uint64(27))
    value = value * MIX2
    return value ^ (value >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word in order, and how many words each text has (lower-cased, A-Z only)."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    ends = offsets - offsets[0]
    n = len(raw)
    inside = ~PARTS[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    # A text begins a word even where the one before ended without a blank.
    begins = ends[:-1][ends[:-1] < ends[1:]]
    first[begins] = inside[begins]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    stops = ends[1:][ends[:-1] < ends[1:]] - 1
    last[stops] = inside[stops]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    power = np.cumprod(np.full(n + 1, BASE, np.uint64))
    inverse = np.cumprod(np.full(n + 1, INVERSE, np.uint64))
    upto = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE[FOLD[raw]] * power[:n], out=upto[1:])
    hashes = mix((upto[stop] - upto[start]) * inverse[start] + (stop - start).astype(np.uint64))
    counts = np.searchsorted(start, ends[1:]) - np.searchsorted(start, ends[:-1])
    return hashes, counts


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingle hashes in rising order in one array, and how many each has.

    A text with fewer words than a shingle has the whole sequence as one; without words, none.
    """
    hashes, counts = word_hashes(texts)
    n = len(counts)
    many = np.where(counts >= words, counts - words + 1, (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(n), many)
    begin = np.cumsum(counts) - counts
    at = begin[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    size = np.minimum(counts, words)[owner]
    value = np.full(len(owner), 0, np.uint64)
    for i in range(words):
        more = size > i
        value[more] = mix(value[more] * BASE + hashes[at[more] + i] + np.uint64(i + 1))
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[fresh], np.bincount(owner[fresh], minlength=n)
