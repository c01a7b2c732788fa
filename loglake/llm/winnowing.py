"""Document fingerprints by winnowing.

A rolling polynomial hash gives every k-gram of code points a value. Of each window of w
consecutive k-grams the smallest value is kept, of equal values the rightmost, with its position:
any passage of ``k + w - 1`` code points that two texts share gives both the same fingerprint there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.llm.common import text_or_empty
from loglake.llm.ragged import release, slices, starts_of

K, WINDOW = 16, 32
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
MIX = np.uint64(0xD6E8FEB86659FD93)
LOW = np.uint64(0xFFFFFFFF)
HALF = np.uint64(32)
FIRST_KEY = -(1 << 63)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), lengths


def gram_hashes(flat: np.ndarray, starts: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """32-bit hashes of ``flat[start : start + length]`` for each start."""
    n = len(flat)
    power = np.cumprod(np.full(n + 1, BASE, np.uint64))
    inverse = np.cumprod(np.full(n + 1, INVERSE, np.uint64))
    value = (flat.astype(np.uint64) + np.uint64(1)) * MIX
    value ^= value >> HALF
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * power[:n])])
    mixed = (upto[starts + length] - upto[starts]) * inverse[starts]
    mixed ^= mixed >> HALF
    mixed *= MIX
    return mixed >> HALF


def winnow(texts: list[str], k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and positions of all texts' fingerprints in text order, and how many each text has.

    A text shorter than ``k`` is one gram; one with fewer grams than a window is one window. An
    empty text has none.
    """
    flat, lengths = code_points(texts)
    grams = np.where(lengths >= k, lengths - k + 1, np.minimum(lengths, 1))
    begins = starts_of(grams)
    owner = np.repeat(np.arange(len(texts)), grams)
    position = np.arange(len(owner)) - np.repeat(begins, grams)
    hashes = gram_hashes(flat, starts_of(lengths)[owner] + position, np.minimum(lengths, k)[owner])
    # The smallest of these is the smallest hash, and of equal hashes the one furthest right.
    key = hashes << HALF | (LOW - position.astype(np.uint64))
    low, done = key, 1
    while done < window and len(low):
        step = min(done, window - done)
        low = np.minimum(low[:-step], low[step:]) if step < len(low) else low[:0]
        done += step
    full = np.flatnonzero(np.repeat(grams, grams) - position >= window)
    small = np.flatnonzero((grams > 0) & (grams < window))
    chosen, chosen_by = low[full], owner[full]
    if len(small):
        bounds = np.stack([begins[small], begins[small] + grams[small]], 1).ravel()
        lowest = np.minimum.reduceat(np.append(key, np.uint64(0)), bounds)[::2]
        chosen, chosen_by = np.concatenate([chosen, lowest]), np.concatenate([chosen_by, small])
        order = np.argsort(chosen_by, kind="stable")
        chosen, chosen_by = chosen[order], chosen_by[order]
    if len(chosen):
        fresh = np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (chosen_by[1:] != chosen_by[:-1])])
        chosen, chosen_by = chosen[fresh], chosen_by[fresh]
    return ((chosen >> HALF).astype(np.uint32), (LOW - (chosen & LOW)).astype(np.int64),
            np.bincount(chosen_by, minlength=len(texts)))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Jaccard similarity of the hash sets of text i of ``a`` and text i of ``b``; two empty sets are alike.

    Each side holds the hashes of all its texts in one array, and how many each text has.
    """
    n = len(a[1])
    sets = [np.unique(np.repeat(np.arange(n, dtype=np.uint64), counts) << HALF | hashes.astype(np.uint64))
            for hashes, counts in (a, b)]
    both = np.bincount((np.intersect1d(*sets, assume_unique=True) >> HALF).astype(np.int64), minlength=n)
    either = sum(np.bincount((s >> HALF).astype(np.int64), minlength=n) for s in sets) - both
    return np.where(either > 0, both / np.maximum(either, 1), 1.0)


def fingerprints(documents: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """``doc_id, hashes array<bigint>, positions array<bigint>`` of each whole text, in text order.

    A null text counts as empty; an empty text has empty arrays. Repeated rows stay; other columns
    are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 20):
            hashes, positions, counts = winnow(part.column("text").to_pylist(), k, window)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(hashes.astype(np.int64))),
                pa.ListArray.from_arrays(offsets, pa.array(positions))], ["doc_id", "hashes", "positions"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        run, f"doc_id {kind}, hashes array<bigint>, positions array<bigint>")


def with_next(documents: DataFrame, bucket_bytes: int = 8 << 20) -> DataFrame:
    """Rows dealt into ranges of ``key`` (the id, null first): ``bucket, role, key, doc_id, text``.

    Role 0 are a range's own rows. The first row of the following range comes along as role 1, and
    the very first row to the last range as role 2, so each range knows what follows each of its
    rows. The bounds are ids that occur, one for about every ``bucket_bytes`` of text.
    """
    docs = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_KEY)).alias("key"), "doc_id", text_or_empty().alias("text"))
    size, least = docs.agg(F.sum(F.octet_length("text").cast("long") + 8), F.min("key")).first()
    buckets = max(1, -(-(size or 0) // bucket_bytes))
    bounds: list[int] = []
    if buckets > 1:
        shares = [i / buckets for i in range(1, buckets)]
        bounds = sorted(set(docs.agg(F.percentile_approx("key", shares, 20 * buckets)).first()[0]))
    # Two steps, so that a row looks at twice the root of the number of bounds.
    side = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i:i + side] for i in range(0, len(bounds), side)]
    count = lambda values: F.size(F.filter(values, lambda b: b <= F.col("key")))
    place = lambda bucket, role: F.struct(bucket.cast("int").alias("bucket"), F.lit(role).alias("role"))
    if bounds:
        heads = F.array(*[F.lit(g[0]) for g in groups])
        within = F.array(*[F.array(*map(F.lit, g)) for g in groups])
        docs = docs.withColumn("group", count(heads)).withColumn(
            "bucket", F.when(F.col("group") == 0, 0).otherwise(
                (F.col("group") - 1) * side + count(F.element_at(within, F.greatest(F.col("group"), F.lit(1))))))
        bound = F.element_at(F.flatten(within), F.greatest(F.col("bucket"), F.lit(1)))
        ahead = F.when((F.col("bucket") > 0) & (F.col("key") == bound), place(F.col("bucket") - 1, 1))
    else:
        docs = docs.withColumn("bucket", F.lit(0))
        ahead = F.lit(None).cast("struct<bucket:int,role:int>")
    around = F.when(F.col("key") == F.lit(least), place(F.lit(len(bounds)), 2))
    goes = F.array(place(F.col("bucket"), 0), ahead, around)
    return docs.withColumn("to", F.explode(F.filter(goes, lambda g: g.isNotNull()))).select(
        "to.bucket", "to.role", "key", "doc_id", "text")


def compare_edited(documents: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Each text against its edit and its successor.

    The edit replaces the last half (rounded down) by as many first code points of the next
    document, or all it has. The next document is that of the next greater id; equal ids follow
    each other by text, a null id comes first, and the first document follows the last.

    ``doc_id, n_chars, edited_sha256, hashes, positions, edited_hashes, edited_positions`` (binary,
    four bytes each, in text order; a position is the code point where its gram begins),
    ``near_edited, near_next`` (Jaccard similarity of the hash sets). Null texts count as empty;
    repeated rows stay; a very long text is whole in one task; other columns are ignored; an empty
    table gives no rows.
    """

    def run(bucket: pa.Table) -> pa.Table:
        release()
        bucket = bucket.sort_by([(c, "ascending") for c in ("role", "key", "text")])
        texts = bucket.column("text").to_pylist()
        own = bucket.column("role").to_pylist().count(0)
        columns: dict[str, list] = {c: [] for c in NAMES}
        at = 0
        while at < own:
            end, size = at, 0
            while end < own and (end == at or size < 1 << 20):
                size += len(texts[end])
                end += 1
            here = texts[at:end + 1]
            edited = [t[:len(t) - len(t) // 2] + after[:len(t) // 2] for t, after in zip(here, here[1:])]
            hashes, places, counts = winnow(here, k, window)
            new_hashes, new_places, new_counts = winnow(edited, k, window)
            n, upto = len(edited), counts[:-1].sum()
            columns["doc_id"] += bucket.column("doc_id").slice(at, n).to_pylist()
            columns["n_chars"] += map(len, here[:-1])
            columns["edited_sha256"] += [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in edited]
            for name, values, many in (
                    ("hashes", hashes, counts[:-1]), ("positions", places, counts[:-1]),
                    ("edited_hashes", new_hashes, new_counts), ("edited_positions", new_places, new_counts)):
                raw, ends = values.astype(">u4").tobytes(), np.concatenate([[0], np.cumsum(many)]) * 4
                columns[name] += [raw[a:b] for a, b in zip(ends, ends[1:])]
            columns["near_edited"] += likeness((hashes[:upto], counts[:-1]), (new_hashes, new_counts)).tolist()
            columns["near_next"] += likeness((hashes[:upto], counts[:-1]), (hashes[counts[0]:], counts[1:])).tolist()
            at = end
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(columns.items(), (bucket.schema.field("doc_id").type, *TYPES))})

    kind = documents.schema["doc_id"].dataType.simpleString()
    return with_next(documents).groupBy("bucket").applyInArrow(
        run, f"doc_id {kind}, n_chars bigint, edited_sha256 string, hashes binary, positions binary, "
             "edited_hashes binary, edited_positions binary, near_edited double, near_next double")


NAMES = ("doc_id", "n_chars", "edited_sha256", "hashes", "positions", "edited_hashes", "edited_positions", "near_edited", "near_next")
TYPES = (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64())


def spelled(numbers: Column) -> Column:
    """Hashes or positions as text: eight hexadecimal digits each."""
    return F.lower(F.hex(numbers))
