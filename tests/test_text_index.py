"""The stored index against scans of the texts."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglake.operators import search
from loglake.session import new_path
from loglake.sinks import text_index, versions
from loglake.sinks.text_index import TextIndex
from samples import plan_of

KIND = T.StructField("kind", T.StringType())
QUERIES = [("W3, w3 rare!", 30, {"kind": "a"}), ("w1 w2 w3 w4 w5 w6", 5, {})]


def texts(spark, low, high):
    """Words with falling frequency, some empty and null texts, a rare word."""
    i = F.col("id")
    words = F.transform(F.sequence(F.lit(1), (i % 9 + 1).cast("int")), lambda k: F.concat(
        F.lit("w"), F.floor(F.sqrt(F.pmod(F.xxhash64(i, k), F.lit(400)).cast("double"))).cast("string")))
    text = F.when(i % 50 == 0, F.lit(None)).when(i % 51 == 0, "").when(i % 97 == 0, F.concat(F.array_join(words, " "), F.lit(" rare, Rare"))).otherwise(
        F.array_join(words, " "))
    return spark.range(low, high).select(
        F.format_string("d%06d", i).alias("_id"), F.when(i % 3 == 0, "a").otherwise("b").alias("kind"), text.alias("logtext"))


def scan(docs, query, k, **filters):
    rows = search.search_topk(docs.na.fill("", ["logtext"]), query, k, **filters).select("_id", "score").collect()
    return [(r["_id"], r["score"]) for r in rows]


@pytest.fixture(params=[text_index.SHARD_DOCS, 100])
def index(request, spark, monkeypatch):
    monkeypatch.setattr(text_index, "SHARD_DOCS", request.param)
    return TextIndex(spark, new_path(spark, "index"), carried=[KIND])


def test_the_index_ranks_like_a_scan(spark, index):
    """Segments, repeated documents and merged blocks change nothing."""
    docs = texts(spark, 0, 3000)
    assert index.add(docs.where("_id < 'd001000'")) == 1000
    assert index.add(docs.where("_id < 'd001500'").union(docs.where("_id < 'd000100'"))) == 500
    assert index.add(docs) == 1500 and index.add(docs) == 0

    want = {q: scan(docs, q, k, **f) for q, k, f in QUERIES}

    def check():
        for query, k, filters in QUERIES:
            got = index.top(query, k, **filters).collect()
            assert [r["id"] for r in got] == [i for i, _ in want[query]]
            assert [r["score"] for r in got] == pytest.approx([s for _, s in want[query]], rel=1e-12)
        assert index.top("none").collect() == [] == index.top("").collect()

    check()
    index.merge()
    assert index.postings().select("segment").distinct().collect()[0][0] == text_index.MERGED
    check()
    assert index.size()[0] == 3000


def test_matches_like_a_filter(spark, index):
    docs = texts(spark, 0, 1000)
    index.add(docs)
    want = search.bool_query(docs, contains="w1 rare", not_contains="w7")
    assert sorted(r["id"] for r in index.matches("w1 rare", "w7").collect()) == sorted(r["_id"] for r in want.collect())
    assert index.matches("none").count() == 0 == index.matches("").count()


def test_a_search_reads_its_own_terms_only(spark, index):
    index.add(texts(spark, 0, 1000))
    plan = plan_of(index.of_terms(["rare"]))
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan
    assert "EqualTo(term,rare)" in plan or "In(term, [rare])" in plan
    heads = plan_of(index.of_terms(["rare"]).select("term", "n"))
    assert "postings:array" in plan and "postings:array" not in heads


def test_no_block_outgrows_its_shard(spark, monkeypatch):
    """A word that every document holds is many rows."""
    monkeypatch.setattr(text_index, "SHARD_DOCS", 100)
    index = TextIndex(spark, new_path(spark, "index"), key=T.LongType())
    index.add(spark.range(5000).select(F.col("id").alias("_id"), F.lit("all of them").alias("logtext")))
    largest, blocks = index.of_terms(["all"]).agg(F.max("n"), F.count("*")).first()
    assert largest < 160 and blocks == 50
    assert [r["id"] for r in index.top("all", 3).collect()] == [0, 1, 2]


def test_weak_blocks_are_left_out(spark, monkeypatch):
    """The bounds tell that most blocks of a frequent word cannot reach the best hits."""
    monkeypatch.setattr(text_index, "SHARD_DOCS", 50)
    index = TextIndex(spark, new_path(spark, "index"), key=T.LongType())
    docs = spark.range(2000).select(F.col("id").alias("_id"), F.when(F.col("id") < 5, "x x x x x").otherwise(
        F.concat(F.lit("x "), F.repeat(F.lit("y "), 20))).alias("logtext"))
    index.add(docs)
    assert [r["id"] for r in index.top("x", 5).collect()] == [0, 1, 2, 3, 4]
    assert [r["_id"] for r in search.search_topk(docs, "x", 5).collect()] == [0, 1, 2, 3, 4]


def test_a_segment_that_died_is_not_seen(spark, index, monkeypatch):
    docs = texts(spark, 0, 600)
    index.add(docs.where("_id < 'd000300'"))
    append, calls = versions.append, []

    def die(*args, **options):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return append(*args, **options)

    monkeypatch.setattr(text_index.versions, "append", die)
    with pytest.raises(RuntimeError):
        index.add(docs)
    monkeypatch.undo()
    assert index.size()[0] == 300
    index.merge()
    assert index.add(docs) == 300
    assert [r["id"] for r in index.top("w1 w7", 9).collect()] == [i for i, _ in scan(docs, "w1 w7", 9)]


def test_an_empty_index(spark, index):
    assert index.top("w1").collect() == [] and index.size() == (0, 0)
    assert index.add(texts(spark, 0, 0)) == 0
    index.merge()


def test_words_are_counted_without_a_shuffle(spark, index):
    """Only finished blocks move: words are counted, and postings collected, where the documents lie."""
    rows = texts(spark, 0, 3000).select(F.col("_id").alias("id"), "kind", F.split(F.coalesce("logtext", F.lit("")), " ").alias("words"))
    built = index._built(rows.withColumn("words", F.array_remove("words", "")))
    assert "Exchange" not in plan_of(built)
    blocks = built.collect()
    limit = text_index.SHARD_DOCS
    assert len({(b["term"], b["shard"]) for b in blocks}) == len(blocks) and max(b["n"] for b in blocks) <= limit
    for b in blocks:
        ids = [p["id"] for p in b["postings"]]
        assert b["n"] == len(ids) and ids == sorted(ids)
        assert b["max_tf"] == max(p["tf"] for p in b["postings"]) and b["min_len"] == min(p["len"] for p in b["postings"])


def test_shards_are_bounded_in_documents_and_words(monkeypatch):
    monkeypatch.setattr(text_index, "SHARD_WORDS", 1000)
    words = pa.array([["x"] * n for n in [1] * 250 + [400, 400, 400, 5000, 0, 0]])
    cuts = list(text_index._slices(words, 100))
    assert [b for b, _ in cuts[1:]] == [e for _, e in cuts[:-1]] and cuts[0][0] == 0 and cuts[-1][1] == 256
    assert max(e - b for b, e in cuts) == 100
    assert all(sum(len(words[i]) for i in range(b, e - 1)) <= 1000 for b, e in cuts)
