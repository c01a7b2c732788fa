"""From raw documents to packed training sequences, stage by stage.

Each stage reads all that the one before kept. Between stages the documents are written as Parquet
to the cluster's shared folder, so a lost executor costs no more than a stage's running tasks.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.llm import ngram_join, packing, secret_scan, toxicity
from loglake.llm.bloom import with_possible
from loglake.llm.common import stored, table, text_or_empty

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Rows cannot be told by SQL: the first stage is a trained model, the last a greedy search.
ORACLE_SQL = None


def _marked(docs: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents that ``rows`` (``doc_id, text_hash``) may name, and those it surely does not.

    Only the former need to move to meet ``rows``.
    """
    key = F.xxhash64("doc_id", "text_hash")
    keyed = docs.select(*COLUMNS).withColumn("text_hash", F.xxhash64(text_or_empty())).withColumn("key", key)
    tested = with_possible(keyed, rows.select(key.alias("key")).distinct(), "key")
    return tested.filter("possible").select(*COLUMNS, "text_hash"), tested.filter("not possible").select(*COLUMNS)


def _same_row() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("row_id")) & (F.col("text_hash") == F.col("row_hash"))


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.3; the model learns from the labelled ones among them."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, COLUMNS[1:]).filter(F.col("score") < 0.3).select(*COLUMNS)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more).

    Of a group the smallest id stays; of rows that are equal in id and text, one.
    """
    grouped = stored(ngram_join.ngram_components(docs, words=5, num=80, den=100), "grouped")
    out = stored(ngram_join.superfluous(grouped), "superfluous")
    again = grouped.groupBy("doc_id", "text_hash").count().filter("count > 1").select("doc_id", "text_hash")
    marked, clear = _marked(docs, stored(out.unionByName(again), "marked"))
    rows = out.select(F.col("doc_id").alias("row_id"), F.col("text_hash").alias("row_hash"))
    stay = marked.join(rows, _same_row(), "left_anti").dropDuplicates(["doc_id", "text_hash"])
    return clear.unionByName(stay.select(*COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with each secret replaced by a mark; widely copied examples stay."""
    live = lambda s: s["live"]
    found = secret_scan.scan_secrets(docs)
    found = found.select("doc_id", "text_hash", F.filter("spans", live).alias("spans")).filter(F.size("spans") > 0)
    found = stored(found.dropDuplicates(["doc_id", "text_hash"]), "live")
    marked, clear = _marked(docs, found)
    rows = found.select(F.col("doc_id").alias("row_id"), F.col("text_hash").alias("row_hash"), "spans")
    redacted = secret_scan.redact(F.col("text"), F.coalesce(
        F.col("spans"), F.array().cast("array<struct<start:bigint,kind:int,end:bigint,live:boolean>>")))
    mended = marked.join(rows, _same_row(), "left").withColumn("mended", redacted).withColumn(
        "n_chars", F.when(F.col("spans").isNotNull(), F.length("mended").cast("long")).otherwise(F.col("n_chars")))
    return clear.unionByName(mended.select("doc_id", F.col("mended").alias("text"), "lang", "source", "n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens, filled by lexical neighbours."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", remove_toxic),
    ("near_copies", remove_near_copies),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
