"""Loads of CSV archive files into the time series, the documents, or both."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.functions.times import index_name, path_suffix
from loglake.operators.documents import to_docs
from loglake.operators.files import already_loaded, last_row_per_file
from loglake.plans.load import (
    BOTH, POINTS_ONLY, Counts, LoadSpec, collector_of, load_both, log_time, monthly_docs, split_untimed,
)
from loglake.schema import NUMERIC_TYPE
from loglake.session import new_path
from loglake.sinks import ledger
from loglake.sinks.lake import Lake, first_times, read_docs, write_rejects, write_run_log
from loglake.sinks.versions import literal_path
from loglake.sources.archives import MALFORMED, fingerprints, normalise_csv, read_ops_csv


NOTHING = {"rows_in": 0, "points_out": 0, "docs_out": 0, "rejected": 0}


def csv_records(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """Archive files as log records (without an id), with ``file_path``."""
    return normalise_csv(read_ops_csv(spark, paths, **options))


def csv_indexes(index: str, frequency: str, whole_word: bool = True) -> Column:
    """The indexes a record's document may be in, by the date in its file's path."""
    suffix = path_suffix(F.col("file_path"), F.col("timestamp"), frequency, whole_word)
    return F.array(index_name(index, suffix), index_name(NUMERIC_TYPE, suffix))


def load_csv_points(
    spark: SparkSession, paths: str | Sequence[str], lake: Lake, now: datetime,
    spec: LoadSpec = LoadSpec(), **options,
) -> Counts:
    """Every file into the time series, whether it is loaded already or not."""
    return _load_files(spark, paths, lake, now, replace(spec, targets=POINTS_ONLY), None, reinsert=True, **options)


def load_csv_docs(
    spark: SparkSession, paths: str | Sequence[str], lake: Lake, now: datetime, **options
) -> Counts:
    """The files not yet loaded into the documents."""
    return _load_new(spark, paths, lake, now, ("docs",), whole_word=True, **options)


def load_csv_both(
    spark: SparkSession, paths: str | Sequence[str], lake: Lake, now: datetime, **options
) -> Counts:
    """The files not yet loaded into both stores."""
    return _load_new(spark, paths, lake, now, BOTH, whole_word=False, **options)


def _load_new(
    spark: SparkSession, paths: str | Sequence[str], lake: Lake, now: datetime,
    targets: tuple[str, ...], whole_word: bool, index: str = "logs", frequency: str = "MONTHLY",
    reinsert: bool = False, spec: LoadSpec = LoadSpec(), suffix: str | None = None, **options,
) -> Counts:
    """``suffix`` names the indexes' ending; without it, it comes from the date in each file's path.

    ``spec``'s own document builder, if it has one, is used as it is. Further ``options`` are those
    of ``read_ops_csv`` and the ``lease`` of the load's claims.
    """
    ending = F.lit(suffix) if suffix is not None else path_suffix(
        F.col("file_path"), F.col("timestamp"), frequency, whole_word)
    if spec.doc_builder is monthly_docs:
        spec = replace(spec, doc_builder=lambda records: to_docs(records, index=index, suffix=ending))
    indexes = F.array(index_name(index, ending), index_name(NUMERIC_TYPE, ending))
    return _load_files(spark, paths, lake, now, replace(spec, targets=targets), indexes, reinsert, **options)


def _kept(df: DataFrame, label: str) -> DataFrame:
    """Written once to the shared folder, so that what a load decided on cannot change under it."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _load_files(
    spark: SparkSession, paths: str | Sequence[str], lake: Lake, now: datetime, spec: LoadSpec,
    indexes: Column | None, reinsert: bool, lease: timedelta = ledger.LEASE, **options,
) -> Counts:
    """Claim the files that are to be loaded, load them, and enter them in the ledger.

    A file that is in the ledger as it is now is not opened. One that was changed is parsed, and
    loaded if its rows differ from those stored. A load that fails gives its claims back; one that
    dies leaves them until ``lease`` is over.
    """
    load_id = uuid.uuid4().hex
    run = {"collector": collector_of("archives", spec), "host": spec.host, "timestamp": log_time(now)}
    listing = {k: options.pop(k) for k in ("name_pattern", "recursive") if k in options}
    files = fingerprints(spark, paths, **listing)
    entries = ledger.read_ledger(spark, lake.ledger)
    states = files.withColumn("status", F.lit("new"))
    if not reinsert:
        found = ledger.file_states(files, entries, spec.targets, now, lease).select("file_path", "status")
        states = files.join(found, "file_path").where(F.col("status").isin("new", "changed"))
    states = _kept(states, "archive-files")
    wanted = states.count()
    if not wanted:
        write_run_log(spark, lake.run_log, {**run, "level": "INFO", "ok": True, "message": "no file to load", **NOTHING})
        return NOTHING.copy()
    fresh = not reinsert and entries.isEmpty()
    held = _kept(ledger.claim(states, lake.ledger, spec.targets, load_id, now, lease), "claimed-files")
    try:
        chosen = [literal_path(row["path"]) for row in held.select("path").collect()]  # the files a reader lists anyway
        if not chosen:
            write_run_log(spark, lake.run_log, {**run, "level": "INFO", "ok": True, "message": "all files are claimed", **NOTHING})
            return NOTHING.copy()
        rows = _kept(csv_records(spark, chosen, malformed=True, **options), "archive-rows")
        read = _kept(_with_digests(held, rows), "digests")
        if not reinsert:
            stored = ledger.unchanged_rows(read, entries, spec.targets)
            if fresh:  # a lake from before its ledger: the documents tell what is loaded
                stored = stored.unionByName(in_documents(rows, lake, indexes)).distinct()
            rows = rows.join(stored, "file_path", "left_anti").select(rows.columns)
        counts = _load(rows, lake, now, spec)
        ledger.enter(read, lake.ledger, spec.targets, ledger.LOADED, load_id, now)
    except Exception as error:
        ledger.enter(held, lake.ledger, spec.targets, ledger.RELEASED, load_id, now)
        write_run_log(spark, lake.run_log, {
            **run, "level": "ERROR", "ok": False, "message": f"load of {wanted} files failed: {type(error).__name__}"})
        raise
    write_run_log(spark, lake.run_log, {
        **run, "level": "INFO", "ok": True, "message": f"loaded {len(chosen)} of {wanted} files", **counts})
    return counts


def _with_digests(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Files with the digest and number of their rows, and how many were rejected; also files without rows."""
    told = rows.groupBy("file_path").agg(
        ledger.row_digest([c for c in rows.columns if c != "file_path"]).alias("digest"),
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col(MALFORMED).isNotNull() | F.col("timestamp").isNull()).alias("rejected"))
    return files.join(told, "file_path", "left").na.fill({"digest": "0:0:0", "rows_in": 0, "rejected": 0})


def _load(rows: DataFrame, lake: Lake, now: datetime, spec: LoadSpec) -> Counts:
    """Good rows into the stores, all others into the rejects: rows in = stored + rejected."""
    whole = rows.where(F.col(MALFORMED).isNull()).drop(MALFORMED)
    broken = rows.where(F.col(MALFORMED).isNotNull()).select(
        F.lit("malformed").alias("reason"), F.col(MALFORMED).alias("record"), "file_path")
    timed, untimed = split_untimed(whole)
    rejected = write_rejects(broken.unionByName(untimed), lake.rejects, now)
    counts = load_both(timed, lake, now, spec)
    return {**counts, "rejected": rejected}


def in_documents(rows: DataFrame, lake: Lake, indexes: Column) -> DataFrame:
    """``file_path`` of the files whose last record is among the documents.

    A file none of whose times can be read has no last record, so it is not among them. The last
    records, one per file, are written to the shared folder; their indexes and times bound what is
    read of the documents. Which files are loaded stays a table, whatever their number.
    """
    spark = rows.sparkSession
    last = _kept(last_row_per_file(rows), "last-rows")
    names = [row[0] for row in last.select(F.explode(indexes)).distinct().toLocalIterator()]
    low, high = first_times(
        last.agg(F.min("timestamp").alias("low"), F.max("timestamp").alias("high")), "low", "high")
    docs = read_docs(
        spark, lake.docs, names, low=low, high=high, latest=False,
        columns=("_index", "@timestamp", "loghost", "logtext"))
    return already_loaded(last, docs, indexes).select("file_path")
