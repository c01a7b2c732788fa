"""A stored inverted index over texts, and ranked search in it.

Postings lie in blocks: one row holds the documents of a shard that hold a term, with how often and
among how many tokens, and above them the largest count and the smallest length of the block. Rows
are bucketed by term and sorted by it, so a search reads the row groups of its own terms and no text.

A term's blocks are as many as the shards of a segment, and a shard's documents are bounded, so a term
that a third of all documents hold is many rows and never one group.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglake.functions.text import tokens
from loglake.operators.search import B, K1, TOP_HITS, term_filter
from loglake.session import new_path
from loglake.sinks import versions

#: Documents and words of a shard, and buckets of terms.
SHARD_DOCS, SHARD_WORDS, BUCKETS = 4096, 1 << 21, 16
PARTITIONS, SORT = ("bucket",), ("term", "segment", "shard")
SEGMENTS = T.StructType([T.StructField(n, k) for n, k in (
    ("part", T.IntegerType()), ("segment", T.StringType()), ("docs", T.LongType()), ("tokens", T.LongType()))])
#: The segment that postings have once they were merged.
MERGED = ""


def _slices(words: pa.ListArray, docs: int) -> Iterator[tuple[int, int]]:
    """Cuts of a batch into shards: at most ``docs`` documents, and about ``SHARD_WORDS`` words unless one has more."""
    share = np.maximum(np.diff(words.offsets.to_numpy()), -(-SHARD_WORDS // docs))
    number = (np.cumsum(share) - share) // SHARD_WORDS
    ends = [*(np.flatnonzero(np.diff(number)) + 1).tolist(), len(words)]
    return zip([0, *ends[:-1]], ends)


def _shard_blocks(part: pa.RecordBatch, carried: Sequence[str]) -> list[pa.Array]:
    """``term, n, max_tf, min_len, postings`` of a shard's documents (``id, words`` and ``carried``)."""
    part = part.take(pc.sort_indices(part, sort_keys=[("id", "ascending")], null_placement="at_start"))
    words, docs = part.column("words"), part.num_rows
    size = np.diff(words.offsets.to_numpy()).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    key = coded.indices.to_numpy().astype(np.int64) * docs + np.repeat(np.arange(docs), size)
    key, tf = np.unique(key, return_counts=True)
    term, doc = np.divmod(key, docs)
    starts = np.flatnonzero(np.diff(term, prepend=-1))
    ends = np.append(starts[1:], len(term))
    rows = {"id": part.column("id").take(pa.array(doc)), "tf": pa.array(tf, pa.int64()), "len": pa.array(size[doc])}
    rows |= {name: part.column(name).take(pa.array(doc)) for name in carried}
    postings = pa.ListArray.from_arrays(
        pa.array(np.append(0, ends).astype(np.int32)), pa.StructArray.from_arrays(list(rows.values()), list(rows)))
    if not len(starts):
        return []
    return [coded.dictionary.take(pa.array(term[starts])), pa.array(ends - starts), pa.array(np.maximum.reduceat(tf, starts)),
            pa.array(np.minimum.reduceat(size[doc], starts)), postings]


class TextIndex:
    """The index below ``path`` of the texts of documents told apart by ``key``.

    An id names a content: a document whose id is in the index already is not added again, so copies
    that repeated loads leave do not count. ``carried`` are small columns by which searches filter.
    """

    def __init__(self, spark: SparkSession, path: str, key: T.DataType = T.StringType(), carried: Sequence[T.StructField] = ()):
        self.spark, self.path, self.carried = spark, path, [f.name for f in carried]
        posting = T.StructType([
            T.StructField("id", key), T.StructField("tf", T.LongType()), T.StructField("len", T.LongType()), *carried])
        self.schema = T.StructType([T.StructField(n, k) for n, k in (
            ("bucket", T.IntegerType()), ("term", T.StringType()), ("segment", T.StringType()), ("shard", T.LongType()),
            ("n", T.LongType()), ("max_tf", T.LongType()), ("min_len", T.LongType()), ("postings", T.ArrayType(posting)))])
        self.ids_schema = T.StructType([
            T.StructField("part", T.IntegerType()), T.StructField("segment", T.StringType()), T.StructField("id", key)])

    # --- what is stored

    @property
    def _tables(self) -> tuple[str, str, str]:
        return f"{self.path}/postings", f"{self.path}/ids", f"{self.path}/segments"

    def _segments(self) -> DataFrame:
        return versions.read(self.spark, self._tables[2], SEGMENTS, ("part",))

    def _ended(self, rows: DataFrame) -> DataFrame:
        """Rows of segments that were written to their end; a load that died leaves others."""
        return rows.where(F.col("segment") == MERGED).unionByName(
            rows.join(self._segments().select("segment").distinct(), "segment", "left_semi").select(rows.columns))

    def postings(self) -> DataFrame:
        return self._ended(versions.read(self.spark, self._tables[0], self.schema, PARTITIONS))

    def _in_segment(self, blocks: DataFrame, segment: str) -> DataFrame:
        bucket = F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).cast("int")
        return blocks.withColumns({"segment": F.lit(segment), "bucket": bucket}).select(self.schema.names)

    def _built(self, rows: DataFrame) -> DataFrame:
        """Blocks of documents (``id, words`` and the carried columns), each shard of which lies in one partition.

        A shard is a stretch of a partition, bounded in documents and words; its postings are counted
        and sorted as numbers, so that only finished blocks are shuffled.
        """
        carried, docs = list(self.carried), SHARD_DOCS

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard = TaskContext.get().partitionId() << 32
            for batch in batches:
                for begin, end in _slices(batch.column("words"), docs):
                    if columns := _shard_blocks(batch.slice(begin, end - begin), carried):
                        number = pa.array(np.full(len(columns[0]), shard))
                        yield pa.RecordBatch.from_arrays([number, *columns], ["shard", "term", "n", "max_tf", "min_len", "postings"])
                        shard += 1

        kinds = T.StructType([self.schema[c] for c in ("shard", "term", "n", "max_tf", "min_len", "postings")])
        return rows.select("id", "words", *carried).mapInArrow(build, kinds)

    def _regrouped(self, rows: DataFrame, n: int) -> DataFrame:
        """Blocks of postings ``term, id, tf, len`` and the carried columns of ``n`` documents, dealt into shards by id."""
        members = F.struct("id", "tf", "len", *self.carried)
        shard = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // SHARD_DOCS))))
        return rows.withColumn("shard", shard).groupBy("term", "shard").agg(
            F.count(F.lit(1)).alias("n"), F.max("tf").alias("max_tf"), F.min("len").alias("min_len"),
            F.sort_array(F.collect_list(members)).alias("postings"))

    # --- writing

    def add(self, docs: DataFrame, key: str = "_id", column: str = "logtext") -> int:
        """Add the documents that are not in the index yet, as one segment; returns how many.

        Copies of a document count once. A null text has no tokens, but counts as a document. The
        segment exists for readers when all of it is written.
        """
        postings_path, ids_path, segments_path = self._tables
        segment = uuid.uuid4().hex
        known = self._ended(versions.read(self.spark, ids_path, self.ids_schema, ("part",))).select("id")
        rows = docs.select(F.col(key).alias("id"), *self.carried, F.col(column).alias("text"))
        rows = rows.join(known, "id", "left_anti").groupBy("id").agg(
            F.first(F.struct(*self.carried, "text")).alias("d")).select("id", "d.*")
        words = F.inline(F.array(F.struct(tokens(F.coalesce(F.col("text"), F.lit(""))).alias("words"))))
        rows = rows.select("id", *self.carried, words).withColumn("len", F.size("words").cast("long"))
        held = new_path(self.spark, "new-texts")
        rows.write.parquet(held)
        rows = self.spark.read.schema(rows.schema).parquet(held)
        n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("len"), F.lit(0))).first()
        if not n:
            return 0
        versions.append(self._in_segment(self._built(rows), segment), postings_path, PARTITIONS, SORT)
        versions.append(rows.select(F.lit(0).alias("part"), F.lit(segment).alias("segment"), "id"), ids_path, ("part",), ("id",))
        one = self.spark.range(1, numPartitions=1).select(
            F.lit(0).alias("part"), F.lit(segment).alias("segment"), F.lit(n).cast("long").alias("docs"), F.lit(total).cast("long").alias("tokens"))
        versions.append(one, segments_path, ("part",), (), rebalance=False)
        return n

    def merge(self) -> None:
        """Join the blocks that the segments have of each term; what searches find stays the same."""
        postings_path = self._tables[0]
        n = self.size()[0]

        def join(rows: DataFrame) -> DataFrame:
            ended = self._ended(rows)
            flat = ended.select("term", F.inline("postings"))
            others = rows.join(self._segments().select("segment").distinct(), "segment", "left_anti").where(F.col("segment") != MERGED)
            return self._in_segment(self._regrouped(flat, n), MERGED).unionByName(others.select(self.schema.names))

        keys = versions.live_partitions(self.spark, postings_path, PARTITIONS)
        if keys:
            versions.replace(self.spark, postings_path, self.schema, PARTITIONS, SORT, keys, join)

    # --- searching

    def size(self) -> tuple[int, int]:
        """How many documents, and how many tokens they have."""
        return tuple(self._segments().agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first())

    def _terms(self, text: str) -> list[str]:
        """Distinct tokens of a query, split by the same expression as the texts."""
        return self.spark.range(1).select(F.array_distinct(tokens(F.lit(text)))).first()[0]

    def of_terms(self, terms: Sequence[str]) -> DataFrame:
        """The blocks of some terms; buckets and sorted terms keep all others unread."""
        rows = self.postings().where(F.col("term").isin(list(terms)))
        buckets = self.spark.range(1).select(F.array(*[
            F.pmod(F.xxhash64(F.lit(t)), F.lit(BUCKETS)).cast("int") for t in terms]).alias("b")).first()[0] if terms else []
        return rows.where(F.col("bucket").isin(buckets))

    def matches(self, contains: str, not_contains: str | None = None) -> DataFrame:
        """``id`` and carried columns of the documents that hold any token of ``contains``, and not that term."""
        found = self.of_terms(self._terms(contains)).select(F.inline("postings")).select("id", *self.carried).distinct()
        if not_contains:
            found = found.join(self.of_terms([not_contains]).select(F.inline("postings")).select("id"), "id", "left_anti")
        return found

    def top(self, text: str, k: int = TOP_HITS, **filters: object) -> DataFrame:
        """``id, score`` of the ``k`` best hits by Okapi BM25 over all documents, as a scan of the texts ranks them.

        ``filters`` are exact values of carried columns and do not change the scores; ties go to the
        smaller id. Blocks come with bounds of what their documents can score. The best blocks of
        each term give a score that ``k`` documents reach; blocks that cannot reach it with the best
        of all other terms only add to documents other blocks have brought up.
        """
        terms = self._terms(text)
        n, total = self.size()
        empty = self.spark.createDataFrame([], T.StructType([*[f for f in self.ids_schema if f.name == "id"], T.StructField("score", T.DoubleType())]))
        if not terms or not total:
            return empty
        blocks = self.of_terms(terms)
        mean = total / n
        part = lambda tf, size: tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean))
        bound = part(F.col("max_tf").cast("double"), F.col("min_len").cast("double"))
        heads = blocks.groupBy("term").agg(F.sum("n").cast("double").alias("df"), F.max(bound).alias("best"))
        heads = {r["term"]: r for r in heads.select("term", "df", F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"), "best").collect()}
        terms = [t for t in terms if t in heads]
        if not terms:
            return empty
        pick = lambda values: reduce(
            lambda rest, t: F.when(F.col("term") == t, F.lit(values[t])).otherwise(rest), terms, F.lit(0.0))
        best = {t: heads[t]["idf"] * heads[t]["best"] for t in terms}
        others = {t: sum(best.values()) - best[t] for t in terms}
        blocks = blocks.withColumn("idf", pick({t: heads[t]["idf"] for t in terms})).withColumn("bound", F.col("idf") * bound)

        def scored(some: DataFrame) -> DataFrame:
            rows = some.select("term", "idf", F.inline("postings"))
            for name, value in filters.items():
                rows = rows.where(term_filter(name, value))
            return rows.select("id", "term", (F.col("idf") * part(F.col("tf").cast("double"), F.col("len").cast("double"))).alias("part"))

        def summed(rows: DataFrame) -> DataFrame:
            """Added up in the order of the query's terms, whatever order the rows come in."""
            score = reduce(lambda a, b: a + b, [F.coalesce(F.max(F.when(F.col("term") == t, F.col("part"))), F.lit(0.0)) for t in terms])
            return rows.groupBy("id").agg(score.alias("score"))

        seeds = blocks.orderBy(F.col("bound").desc(), "term", "segment", "shard").limit(max(8, 2 * len(terms)))
        reached = summed(scored(seeds)).orderBy(F.col("score").desc()).limit(k).agg(F.min("score"), F.count(F.lit(1))).first()
        # A hair below, as bounds and scores are rounded differently.
        least = reached[0] * (1 - 1e-9) if reached[1] == k else 0.0
        able = F.col("bound") + pick(others) >= least
        wanted = scored(blocks.where(able)).select("id").distinct()
        whole = summed(scored(blocks).join(wanted, "id", "left_semi")) if least > 0 else summed(scored(blocks))
        return whole.orderBy(F.col("score").desc(), "id").limit(k)
