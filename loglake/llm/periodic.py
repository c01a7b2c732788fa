"""Runs of words that repeat with a period, found by block convolution.

The words of a batch of texts stand in one array of numbers, a number of its own between texts. At
each dyadic scale the array is cut into blocks of B words. A run with a period q of B to 2B - 1 that
holds three periods holds a whole block and its copy q words on. The sums of squared differences of
a block and every stretch of its following window come from one convolution, exact in integers
modulo a prime; where the sum is zero the block comes again. Each such distance is a seed, extended
to both sides as far as words at that distance are equal.

A block that holds a word which does not come again within the window has no copy there, so it needs
no convolution. Sums that are zero only modulo the prime fall away when the seed is extended.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from loglake.llm.common import text_or_empty
from loglake.llm.ragged import slices, starts_of, texts_of

#: A prime with a root of unity of order 2^27, and a generator of its multiplicative group.
PRIME, GENERATOR = 15 * (1 << 27) + 1, 31
#: Numbers transformed at a time.
ROOM = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    have, step = 1, np.uint64(base)
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more] * step % PRIME
        step = step * step % np.uint64(PRIME)
        have += more
    return out


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = a + b
    return np.minimum(total, total - np.uint64(PRIME))


def _subtract(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _add(a, np.uint64(PRIME) - b)


def transform(rows: np.ndarray) -> np.ndarray:
    """The number-theoretic transform of each row, in bit-reversed order."""
    count, size = rows.shape
    half = size // 2
    while half:
        parts = rows.reshape(count, -1, 2, half)
        low, high = parts[:, :, 0], parts[:, :, 1]
        roots = _powers(pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME), half)
        rows = np.stack([_add(low, high), _subtract(low, high) * roots % PRIME], 2).reshape(count, size)
        half //= 2
    return rows


def transform_back(rows: np.ndarray) -> np.ndarray:
    """Rows from their transforms in bit-reversed order."""
    count, size = rows.shape
    half = 1
    while half < size:
        parts = rows.reshape(count, -1, 2, half)
        roots = _powers(pow(pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME), -1, PRIME), half)
        low, high = parts[:, :, 0], parts[:, :, 1] * roots % PRIME
        rows = np.stack([_add(low, high), _subtract(low, high)], 2).reshape(count, size)
        half *= 2
    return rows * np.uint64(pow(size, -1, PRIME)) % PRIME


def mismatches(words: np.ndarray, squares: np.ndarray, begins: np.ndarray, block: int, low: int, high: int) -> np.ndarray:
    """Sums modulo ``PRIME`` of squared differences of each block and the stretches ``low`` to ``high - 1`` words on.

    ``squares`` are the running sums of the words' squares, zero first.
    """
    reach = high - low + block - 1
    size = 1 << (reach - 1).bit_length()
    here = np.zeros((len(begins), size), np.uint64)
    here[:, :block] = words[begins[:, None] + np.arange(block - 1, -1, -1)]
    there = np.zeros((len(begins), size), np.uint64)
    there[:, :reach] = words[begins[:, None] + np.arange(low, low + reach)]
    products = transform_back(transform(here) * transform(there) % PRIME)[:, block - 1:reach]
    of = lambda at: _subtract(squares[at + block], squares[at])
    own, others = of(begins)[:, None], of(begins[:, None] + np.arange(low, high))
    return _subtract(_add(own, others), _add(products, products))


def scales(longest: int, shortest: int, repeats: int) -> Iterator[tuple[int, int, int]]:
    """Block lengths, and the periods from ``low`` to below ``high`` that each finds in ``longest`` words.

    A whole block begins within the first B words of a run, so block and copy end within 2B - 1 + q of
    them: three periods for q of B and more, and for smaller ones less than 3B, which the first block keeps
    within ``shortest``.
    """
    block = 1
    while 6 * block - 1 <= shortest:
        block *= 2
    low, high = 1, 2 * block
    while low * repeats <= longest:
        yield block, low, high
        block, low, high = 2 * block if low > 1 else high, high, 2 * high


def seeds(words: np.ndarray, longest: int, shortest: int, repeats: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and distances of blocks that come again; ``longest`` is the number of words of the longest text."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    gaps = np.full(n, n, np.int64)
    again = words[order[1:]] == words[order[:-1]]
    gaps[order[:-1][again]] = (order[1:] - order[:-1])[again]
    values = words.astype(np.uint64)
    squares = np.concatenate([[0], np.cumsum(values * values % PRIME)]).astype(np.uint64) % PRIME
    begins, distances = [], []
    size, widest = 1, gaps
    for block, low, high in scales(longest, shortest, repeats):
        while size < block:
            widest = np.maximum(widest[:len(widest) // 2 * 2:2], widest[1::2])
            size *= 2
        at = np.flatnonzero(widest < high) * block
        # Beyond the end stand words that occur nowhere else.
        room = int(at[-1]) + block + high - n if len(at) else 0
        if room > 0:
            values = np.concatenate([values, np.arange(room, dtype=np.uint64) + values.max() + 1])
            squares = np.concatenate([squares, (squares[-1] + np.cumsum(values[-room:] ** 2 % PRIME)) % PRIME])
            n += room
        step = max(1, ROOM // (4 * block))
        for i in range(0, len(at), step):
            part = at[i:i + step]
            row, d = np.nonzero(mismatches(values, squares, part, block, low, high) == 0)
            begins.append(part[row])
            distances.append(d + low)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *begins]), np.concatenate([none, *distances])


def names(words: np.ndarray, longest: int) -> list[np.ndarray]:
    """For each power of two up to ``longest``: a number for each stretch of so many words, equal for equal ones."""
    out, size = [words], 1
    while 2 * size <= longest:
        last = out[-1]
        pairs = last[:-size] * (int(last.max()) + 1) + last[size:]
        out.append(np.unique(pairs, return_inverse=True)[1].astype(np.int64))
        size *= 2
    return out


def extend(levels: list[np.ndarray], begins: np.ndarray, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words from a seed on, and how many before it, equal those at the seed's distance."""
    n, forth, back = len(levels[0]), begins.copy(), begins.copy()
    for k in range(len(levels) - 1, -1, -1):
        level, size = levels[k], 1 << k
        inside = forth + distances + size <= n
        at = np.where(inside, forth, 0)
        forth += size * (inside & (level[at] == level[np.where(inside, forth + distances, 0)]) & inside)
        inside = back >= size
        at = np.where(inside, back - size, 0)
        back -= size * (inside & (level[at] == level[np.minimum(at + distances, len(level) - 1)]))
    return forth - begins, begins - back


def runs(words: np.ndarray, counts: np.ndarray, shortest: int = 24, repeats: int = 3) -> np.ndarray:
    """Rows ``text, start, length, period`` of all runs in texts of ``counts`` words each, in order of text, start and period."""
    nothing = np.zeros((0, 4), np.int64)
    if not len(words):
        return nothing
    # A word of its own closes each text, so that nothing reaches from one into the next.
    ends = np.cumsum(counts)
    apart = np.insert(words, ends, words.max() + 1 + np.arange(len(counts)))
    bounds = np.concatenate([[0], ends + np.arange(1, len(counts) + 1)])
    begins, distances = seeds(apart, int(counts.max()), shortest, repeats)
    if not len(begins):
        return nothing
    # Only the texts that have seeds are extended in.
    owner = np.searchsorted(bounds, begins, side="right") - 1
    held = np.unique(owner)
    sizes = (bounds[1:] - bounds[:-1])[held]
    shift = np.zeros(len(counts), np.int64)
    shift[held] = starts_of(sizes) - bounds[held]
    inside = np.zeros(len(counts), bool)
    inside[held] = True
    kept = apart[np.repeat(inside, bounds[1:] - bounds[:-1])]
    begins = begins + shift[owner]
    kept = np.unique(kept, return_inverse=True)[1].astype(np.int64)
    levels = names(kept, int(sizes.max()))
    found = np.zeros((0, 3), np.int64)
    for i in range(0, len(begins), ROOM):
        at, d = begins[i:i + ROOM], distances[i:i + ROOM]
        forth, back = extend(levels, at, d)
        start, end = at - back, at + d + forth
        good = (end - start >= shortest) & (end - start >= repeats * d)
        rows = np.unique(np.stack([start[good], end[good], d[good]], 1), axis=0)
        found = np.unique(np.concatenate([found, rows]), axis=0)
    # The same stretch at several distances: the smallest is its period.
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(1)
    start, end, period = found[first].T
    place = starts_of(sizes)
    text = np.searchsorted(place, start, side="right") - 1
    out = np.stack([held[text], start - place[text], end - start, period], 1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def in_lists(offsets: np.ndarray, flat: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), flat)


def split_words(texts: pa.Array) -> pa.ListArray:
    """The words of each text: what stands between ASCII white space."""
    split = pc.ascii_split_whitespace(texts)
    flat, counts = split.flatten(), np.diff(split.offsets.to_numpy()).astype(np.int64)
    full = pc.greater(pc.binary_length(flat), 0)
    owner = np.repeat(np.arange(len(counts)), counts)[full.to_numpy(zero_copy_only=False)]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(counts)))])
    return in_lists(offsets, flat.filter(full))


def find_runs(documents: DataFrame, shortest: int = 24, repeats: int = 3) -> DataFrame:
    """``doc_id, n_words, runs array<struct<start,length,period>>, collapsed`` of each whole text.

    A run is a stretch of words that has a smallest period (words so far apart are equal), spans
    ``shortest`` words and ``repeats`` periods at least, and cannot be extended with that period; runs
    are sorted by start, then period. All runs are found, whatever their length or period.
    ``collapsed`` are the words that lie in no run after its first period, joined by single spaces.

    A null text counts as empty and has no words, no runs and an empty ``collapsed``. A text is whole
    in one task, whatever its length: about 200 bytes of memory a word. Repeated rows stay; other
    columns are ignored; an empty table gives no rows.
    """
    if shortest < 2 or repeats < 3:
        raise ValueError("a run has 2 words and 3 periods at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            split = split_words(texts_of(batch.column("text")))
            flat = split.flatten()
            counts = np.diff(split.offsets.to_numpy()).astype(np.int64)
            words = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
            found = runs(words, counts, shortest, repeats)
            first = starts_of(counts)
            # One more where copies begin, one less where they end.
            depth = np.zeros(len(words) + 1, np.int64)
            np.add.at(depth, first[found[:, 0]] + found[:, 1] + found[:, 3], 1)
            np.add.at(depth, first[found[:, 0]] + found[:, 1] + found[:, 2], -1)
            kept = np.cumsum(depth[:-1]) == 0
            left = np.concatenate([[0], np.cumsum(kept)])
            offsets = left[np.append(first, len(words))]
            collapsed = pc.binary_join(in_lists(offsets, flat.filter(pa.array(kept))), pa.scalar(" ", flat.type))
            each = np.concatenate([[0], np.cumsum(np.bincount(found[:, 0], minlength=len(counts)))]).astype(np.int32)
            spans = pa.StructArray.from_arrays([pa.array(found[:, i]) for i in (1, 2, 3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.ListArray.from_arrays(pa.array(each), spans), collapsed.cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
