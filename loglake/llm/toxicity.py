"""Toxicity by a character n-gram linear classifier with naive Bayes feature scaling.

Each hashed n-gram's value is scaled by its log-count ratio between toxic and clean training texts;
a logistic regression on the scaled values, weighted to the classes' true shares, gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.llm.common import stored, text_or_empty
from loglake.llm.ragged import release, slices

SIZES = (3, 4, 5)
BITS = 20
PAD = " " * max(SIZES)
STEP = np.uint32(0x01000193)
SPREAD = np.uint32(0x9E3779B1)


def ngrams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each size the bucket of every n-gram, and the text in which each position stands.

    Letters are lower-cased, digits count as one, white space as a blank; blanks stand around each
    text, so no n-gram mixes two.
    """
    padded = [PAD + t.lower() for t in texts]
    flat = np.frombuffer("".join([*padded, PAD]).encode("utf-32-le", "surrogatepass"), np.uint32)
    flat = np.where(flat <= 32, np.uint32(32), np.where((flat >= 48) & (flat <= 57), np.uint32(48), flat))
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in padded])
    out, value = [], flat
    for n in range(2, max(SIZES) + 1):
        value = value[:-1] * STEP + flat[n - 1:]
        if n in SIZES:
            out.append(((value * SPREAD + np.uint32(n)) * SPREAD >> np.uint32(32 - BITS))[:len(owner)])
    return out, owner


def counted(buckets: list[np.ndarray], owner: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, bucket and value (1 + log of the count) of each distinct n-gram of each text."""
    keys = []
    for values in buckets:
        by = owner[:len(values)]
        if wanted is not None:
            kept = np.flatnonzero(wanted[values])
            values, by = values[kept], by[kept]
        keys.append(by.astype(np.int64) << BITS | values)
    key = np.sort(np.concatenate(keys))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    return key[first] >> BITS, key[first] & ((1 << BITS) - 1), 1 + np.log(count)


@dataclass
class Model:
    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        """The probability of each text to be toxic."""
        table = np.zeros(1 << BITS)
        table[self.buckets] = self.weights
        text, bucket, value = counted(*ngrams(texts), table != 0)
        return 1 / (1 + np.exp(-self.bias - np.bincount(text, table[bucket] * value, minlength=len(texts))))


#: Training texts as pieces of bounded size: text (numbered through), bucket and value of each n-gram.
Pieces = list[tuple[np.ndarray, np.ndarray, np.ndarray]]


#: N-grams of fewer texts, or with a smaller log-count ratio, are left out.
LEAST_TEXTS, STRENGTH = 4, 1.0


def telling(with_it: list[np.ndarray], texts: list[int], least_texts: int = LEAST_TEXTS, strength: float = STRENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Which buckets are learned from, and each one's ratio; ``with_it`` and ``texts`` are counts of toxic and clean texts."""
    rate = [(c + 0.5) / (n + 1) for c, n in zip(with_it, texts)]
    ratio = np.log(rate[0] / rate[1])
    return (with_it[0] + with_it[1] >= least_texts) & (np.abs(ratio) >= strength), ratio


def fit(pieces: Pieces, toxic: np.ndarray, weight: np.ndarray,
        least_texts: int = LEAST_TEXTS, strength: float = STRENGTH, penalty: float = 1e-3, rounds: int = 300) -> Model:
    """Fit on the n-grams of the training texts; ``toxic`` and ``weight`` by text. Uses the pieces up.

    N-grams of fewer than ``least_texts`` texts are left out, and so are those whose ratio is within
    ``strength`` of none. With one class only, the score is the same for all texts.
    """
    share = float(np.clip((weight * toxic).sum() / max(weight.sum(), 1e-9), 1e-4, 1 - 1e-4)) if len(toxic) else 0.5
    bias = float(np.log(share / (1 - share)))
    none = Model(np.zeros(0, np.int64), np.zeros(0), bias)
    if not len(toxic) or toxic.min() == toxic.max():
        return none
    with_it = [np.zeros(1 << BITS), np.zeros(1 << BITS)]
    for doc, bucket, _ in pieces:
        for seen, y in zip(with_it, (1, 0)):
            seen += np.bincount(bucket[toxic[doc] == y], minlength=1 << BITS)
    used, ratio = telling(with_it, [(toxic == y).sum() for y in (1, 0)], least_texts, strength)
    names = np.flatnonzero(used)
    if not len(names):
        return none
    kept = []
    while pieces:
        doc, bucket, value = pieces.pop()
        chosen = used[bucket]
        kept.append((doc[chosen], bucket[chosen], value[chosen]))
    doc, bucket, value = (np.concatenate(column) for column in zip(*kept))
    del kept
    column = (np.cumsum(used) - 1)[bucket]
    value = value.astype(np.float64) * ratio[bucket]
    n, m = len(toxic), len(names)
    w, weight = np.zeros(m), weight / weight.sum()
    # Accelerated gradient steps, their length by the largest curvature the data can have.
    norm = np.bincount(doc, value * value, minlength=n)
    rate_, y, b, v, vb, t = 1 / (0.25 * (np.quantile(norm, 0.99) * 0.2 + 1) + penalty), toxic.astype(float), bias, np.zeros(m), bias, 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-vb - np.bincount(doc, value * v[column], minlength=n)))
        off = weight * (p - y)
        new_w = v - rate_ * (np.bincount(column, value * off[doc], minlength=m) + penalty * v)
        new_b = vb - rate_ * off.sum()
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return Model(names, w * ratio[names], float(b))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def examples(documents: DataFrame, known: DataFrame, per_class: int, longest: int) -> DataFrame:
    """``toxic, text``: one text for each of at most ``per_class`` ids of each class of ``known`` (``doc_id, toxic``)."""
    fitting = documents.select("doc_id", text_or_empty().alias("text")).filter(F.length("text") <= longest)
    usable = known.join(fitting.select("doc_id"), "doc_id", "left_semi")
    picked = None
    for y in (0, 1):
        part = usable.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    # At most twice per_class ids, so they can go to every task, and one text of each comes back.
    return fitting.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(
        F.first("toxic").alias("toxic"), F.min("text").alias("text")).select("toxic", "text")


def _used(grams: DataFrame) -> np.ndarray:
    """The buckets that a fit on these texts (``toxic, bucket``) uses, found where the texts lie."""
    sizes = {row["toxic"]: row["count"] for row in grams.groupBy("toxic").count().collect()}
    each = grams.select("toxic", F.explode("bucket").alias("bucket")).groupBy("bucket").agg(
        F.sum("toxic").cast("int").alias("with_toxic"), F.count(F.lit(1)).cast("int").alias("texts"))
    rows = each.filter(F.col("texts") >= LEAST_TEXTS).toArrow()
    bucket, toxic, texts = (rows.column(c).to_numpy() for c in ("bucket", "with_toxic", "texts"))
    used = np.zeros(1 << BITS, bool)
    used[bucket] = telling([toxic, texts - toxic], [sizes.get(y, 0) for y in (1, 0)])[0]
    return used


def train(documents: DataFrame, labels: DataFrame, per_class: int = 1000, longest: int = 20_000) -> Model:
    """Learn from the labelled rows that are not held out.

    The sample is bounded: of each class the ``per_class`` ids of smallest hash among those that have
    a text of at most ``longest`` code points, and of an id with several such texts the smallest one.
    Classes keep the weight they have among all labelled rows. An id with several labels is toxic if
    any says so; null ids and labels are left out.
    """
    known = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    total = {row["toxic"]: row["count"] for row in known.groupBy("toxic").count().collect()}
    texts = examples(documents, known, per_class, longest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 19):
            doc, bucket, value = counted(*ngrams(part.column("text").to_pylist()))
            offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=part.num_rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                part.column("toxic").cast(pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(bucket.astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array(value.astype(np.float32)))], ["toxic", "bucket", "value"])

    kinds = "toxic int, bucket array<int>, value array<float>"
    grams = stored(texts.mapInArrow(run, kinds), "training-ngrams")
    used = _used(grams)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("bucket")
            bucket, value = lists.flatten().to_numpy(), batch.column("value").flatten().to_numpy()
            kept = used[bucket]
            doc = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))[kept]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=batch.num_rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("toxic"), pa.ListArray.from_arrays(offsets, pa.array(bucket[kept])),
                pa.ListArray.from_arrays(offsets, pa.array(value[kept]))], ["toxic", "bucket", "value"])

    # Only n-grams that the fit uses come to the driver, with the rows of all texts.
    sample = grams.mapInArrow(keep, kinds).toArrow()
    toxic = sample.column("toxic").to_numpy().astype(np.int64)
    pieces, done, batch, lists = [], 0, None, None
    for batch in sample.to_batches(max_chunksize=200):
        lists = batch.column("bucket")
        counts = np.diff(lists.offsets.to_numpy())
        pieces.append((np.repeat(np.arange(done, done + batch.num_rows), counts).astype(np.int32),
                       lists.flatten().to_numpy(), batch.column("value").flatten().to_numpy()))
        done += batch.num_rows
    have = np.bincount(toxic, minlength=2)
    weight = np.array([total.get(y, 0) / max(have[y], 1) for y in (0, 1)])[toxic]
    del sample, batch, lists
    model = fit(pieces, toxic, weight)
    release()
    return model


def score(documents: DataFrame, model: Model, also: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns ``also`` names, and ``score`` of each whole text, 0 to 1.

    A null text counts as empty; an empty text has the score of no evidence. Repeated rows stay;
    other columns are ignored; an empty table gives no rows.
    """
    kept = ["doc_id", *also]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "scored_text", 1 << 19):
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in kept), pa.array(model.scores(part.column("scored_text").to_pylist()))], [*kept, "score"])

    kinds = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in kept)
    return documents.select(*kept, text_or_empty().alias("scored_text")).mapInArrow(run, f"{kinds}, score double")
