"""Which archive files are already in the document table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST_ROW = ("timestamp", "loghost", "logtext")


def last_row_per_file(records: DataFrame, untimed: bool = False) -> DataFrame:
    """Last record of each file: the latest time, on a tie the greatest host and text.

    Rows have no position in Spark. Where a file is not in time order this can differ from its
    physically last line, but is the same for every run. ``untimed`` also gives the files with rows
    but without any readable time, with nulls for a last record.
    """
    timed = F.col("timestamp").isNotNull()
    last = F.max(F.when(timed, F.struct(*LAST_ROW))).alias("last")
    return (records if untimed else records.where(timed)).groupBy("file_path").agg(last).select(
        "file_path", *[F.col(f"last.{c}").alias(c) for c in LAST_ROW]
    )


def already_loaded(last_rows: DataFrame, docs: DataFrame, indexes: Column | None = None) -> DataFrame:
    """Files whose last record is among the documents.

    ``indexes``, an array expression over ``last_rows``, names the indexes the document may be
    in; Spark then skips the partitions of all others. The documents are the large side, so they
    are first filtered by the keys (a semi join Spark broadcasts when the keys measure small);
    only matches are shuffled.
    """
    key = list(LAST_ROW)
    wanted = last_rows
    if indexes is not None:
        key.append("_index")
        wanted = last_rows.withColumn("_index", F.explode(indexes))
    stored = docs.select(F.col("@timestamp").alias("timestamp"), "loghost", "logtext", "_index")
    found = stored.select(*key).join(wanted.select(*key).distinct(), key, "left_semi").distinct()
    loaded = wanted.join(found, key, "left_semi").select(last_rows.columns)
    return loaded if indexes is None else loaded.distinct()


def files_to_load(
    last_rows: DataFrame, docs: DataFrame, indexes: Column | None = None, reinsert: bool = False,
) -> DataFrame:
    """Files whose last record is not among the documents; all of them to reinsert.

    A file without any readable time is among them if ``last_rows`` has it (``untimed``). A file
    without rows, as writers leave for an empty partition, has nothing to load and is not.
    """
    if reinsert:
        return last_rows
    loaded = already_loaded(last_rows, docs, indexes).select("file_path")
    return last_rows.join(loaded, "file_path", "left_anti")
