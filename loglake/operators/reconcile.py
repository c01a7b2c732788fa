"""Which windows of a log are not stored as the source has them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.operators.documents import doc_id
from loglake.operators.records import time_literal


def window_number(df: DataFrame, low: datetime, step_s: int, column: str = "timestamp") -> Column:
    """How many whole windows of ``step_s`` seconds lie between ``low`` and a row."""
    micros = F.unix_micros(F.col(column).cast("timestamp")) - F.unix_micros(time_literal(df, low, column).cast("timestamp"))
    return F.floor(micros / F.lit(step_s * 1_000_000)).cast("long")


def window_digests(ids: DataFrame, side: str) -> DataFrame:
    """``window, <side>_rows, <side>_digest`` of rows ``window, _id``.

    Copies count once, and the order of rows is of no matter. Each task adds up its own rows first.
    """
    each = ids.groupBy("window", "_id").agg(F.lit(1).alias("one"))
    return each.groupBy("window").agg(
        F.count(F.lit(1)).alias(f"{side}_rows"), F.sum(F.xxhash64("_id").cast("decimal(20,0)")).alias(f"{side}_digest"))


def record_ids(records: DataFrame, low: datetime, step_s: int) -> DataFrame:
    """``window, _id`` of log records as their documents will have it."""
    return records.na.fill("").select(window_number(records, low, step_s).alias("window"), doc_id().alias("_id"))


def stored_ids(docs: DataFrame, low: datetime, step_s: int) -> DataFrame:
    """``window, _id`` of stored documents; no other column is read."""
    return docs.select(window_number(docs, low, step_s, "@timestamp").alias("window"), "_id")


def differing_windows(source: DataFrame, stored: DataFrame) -> DataFrame:
    """``window, source_rows, stored_rows`` where the two hold different documents."""
    joined = window_digests(source, "source").join(window_digests(stored, "stored"), "window", "full")
    return joined.where(~F.col("source_digest").eqNullSafe(F.col("stored_digest"))).select(
        "window", F.coalesce("source_rows", F.lit(0)).alias("source_rows"), F.coalesce("stored_rows", F.lit(0)).alias("stored_rows"))
