"""Loads of log records: one batch, a period, backwards through history.

Progress is recorded after the writes. A load that dies in between is repeated, and the keys of
datapoints and documents absorb the repetition.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.operators.accounting import resume
from loglake.operators.documents import to_docs
from loglake.operators.points import Filter, Transform, ordered_shape, to_points
from loglake.operators.reconcile import differing_windows, record_ids, stored_ids, window_number
from loglake.operators.records import finite, in_period, time_literal
from loglake.session import new_path
from loglake.sinks.lake import (
    Lake, first_times, moment, read_docs, read_progress, write_docs, write_points, write_progress, write_rejects,
    write_run_log,
)

BOTH = ("points", "docs")
POINTS_ONLY = ("points",)

Counts = dict[str, int | None]


def monthly_docs(records: DataFrame) -> DataFrame:
    """Documents in monthly indexes, so that no index grows with the whole history."""
    return to_docs(records, frequency="MONTHLY")


@dataclass(frozen=True)
class LoadSpec:
    """What a load does with its records. Every step can be replaced by the caller.

    ``data_filter`` and ``data_parser`` choose and shape datapoints, ``doc_builder`` makes the
    documents, ``points_writer`` and ``docs_writer`` store them and return how many.
    """

    targets: tuple[str, ...] = BOTH
    data_filter: Filter = finite
    data_parser: Transform = ordered_shape
    doc_builder: Transform = monthly_docs
    points_writer: Callable[[DataFrame, str, datetime], int] = write_points
    docs_writer: Callable[[DataFrame, str, datetime], int] = write_docs
    host: str = ""


def points_only(spec: LoadSpec | None) -> LoadSpec:
    return replace(spec or LoadSpec(), targets=POINTS_ONLY)


def log_time(now: datetime) -> str:
    """A run's time as the run log holds it."""
    return now.strftime("%Y-%m-%dT%H:%M:%S.") + f"{now.microsecond // 1000:03d}Z"


def collector_of(name: str, spec: LoadSpec) -> str:
    """Loads into one store keep a progress of their own, so they never hide work left for both."""
    return name if spec.targets == BOTH else "-".join((*spec.targets, name))


def without_nulls(records: DataFrame) -> DataFrame:
    """Empty text instead of null, as stored keys and partitions need."""
    return records.na.fill("")


def split_untimed(records: DataFrame, reason: str = "no time") -> tuple[DataFrame, DataFrame]:
    """Records with a time, and the others as rejects: ``reason, record, file_path``."""
    path = F.col("file_path") if "file_path" in records.columns else F.lit(None).cast("string")
    rejects = records.where(F.col("timestamp").isNull()).select(
        F.lit(reason).alias("reason"), F.to_json(F.struct(*records.columns)).alias("record"), path.alias("file_path"))
    return records.where(F.col("timestamp").isNotNull()), rejects


def load_both(
    records: DataFrame, lake: Lake, load_time: datetime, spec: LoadSpec = LoadSpec(),
    persist: bool = False,
) -> Counts:
    """Write the datapoints and documents of one set of records; returns rows in and out.

    ``persist`` keeps the records between the two writes. It suits bounded batches and sources
    that are slow to read twice; a columnar table is cheaper to scan again, since each write
    reads only the columns it needs. Every record makes a document, so ``rows_in`` is known only
    when documents are written. Null text is stored as empty.
    """
    records = without_nulls(records)
    if persist:
        records = records.persist(StorageLevel.MEMORY_AND_DISK)
    counts = {"rows_in": None, "points_out": 0, "docs_out": 0}
    try:
        if "points" in spec.targets:
            points = to_points(records, spec.data_filter, spec.data_parser)
            counts["points_out"] = spec.points_writer(points, lake.points, load_time)
        if "docs" in spec.targets:
            docs = records.transform(spec.doc_builder)
            counts["rows_in"] = counts["docs_out"] = spec.docs_writer(docs, lake.docs, load_time)
        return counts
    finally:
        if persist:
            records.unpersist()


def load_window(
    records: DataFrame, lake: Lake, collector: str, past: datetime, present: datetime,
    piglet: datetime, now: datetime, spec: LoadSpec = LoadSpec(), persist: bool = False,
    rejects: DataFrame | None = None,
) -> Counts:
    """Load the records of one window, then record progress and the run.

    ``rejects`` (``reason, record, file_path``) go to the lake's rejects and are counted.

    A load that fails leaves a run record that says so, records no progress, and raises.
    """
    spark = records.sparkSession
    run = {
        "collector": collector, "host": spec.host, "past": past, "present": present,
        "timestamp": log_time(now),
    }
    try:
        rejected = 0 if rejects is None else write_rejects(rejects, lake.rejects, now)
        counts = load_both(records, lake, now, spec, persist)
    except Exception as error:
        write_run_log(spark, lake.run_log, {
            **run, "level": "ERROR", "ok": False,
            "message": f"period {past} - {present} failed: {type(error).__name__}",
        })
        raise
    write_progress(spark, lake.progress, collector, past, present, piglet, now)
    write_run_log(spark, lake.run_log, {
        **run, "level": "INFO", "ok": True, "message": f"inserted period {past} - {present}", **counts,
        "rejected": rejected,
    })
    return counts if rejects is None else {**counts, "rejected": rejected}


def load_period(
    records: DataFrame, low: datetime, high: datetime, lake: Lake, now: datetime,
    collector: str | None = None, spec: LoadSpec = LoadSpec(), persist: bool = False,
    include_low: bool = True,
) -> Counts:
    """Load everything between two times, both inclusive; reversed bounds are put in order.

    ``include_low=False`` continues where a load up to ``low`` has ended.
    """
    low, high = min(low, high), max(low, high)
    window = in_period(records, low, high, include_low=include_low)
    return load_window(window, lake, collector or collector_of("period", spec), low, high, high, now, spec, persist)


def load_points_period(
    records: DataFrame, low: datetime, high: datetime, lake: Lake, now: datetime,
    spec: LoadSpec | None = None, **options
) -> Counts:
    """``load_period`` into the time series only."""
    return load_period(records, low, high, lake, now, spec=points_only(spec), **options)


def load_backwards(
    records: DataFrame, stop: datetime, lake: Lake, now: datetime, start: datetime | None = None,
    step: timedelta | None = timedelta(days=30), collector: str | None = None,
    spec: LoadSpec = LoadSpec(), persist: bool = False,
) -> list[Counts]:
    """Load ``[stop, start)`` newest first.

    Starts from the earliest progress, else ``now``, unless ``start`` is given. Each ``step`` is
    one distributed job with its own progress row, so a broken run goes on where it stopped;
    without a step everything is one job. Each target has a progress of its own.
    """
    collector = collector or collector_of("backwards", spec)
    if start is None:
        progress = read_progress(records.sparkSession, lake.progress)
        (start,) = first_times(resume(progress, now, "backwards", collector), "start")
    done = []
    while start > stop:
        past = stop if step is None else max(stop, start - step)
        window = in_period(records, past, start, include_high=False)
        done.append(load_window(window, lake, collector, past, start, past, now, spec, persist))
        start = past
    return done


def load_points_backwards(
    records: DataFrame, stop: datetime, lake: Lake, now: datetime, spec: LoadSpec | None = None, **options
) -> list[Counts]:
    """``load_backwards`` into the time series only."""
    return load_backwards(records, stop, lake, now, spec=points_only(spec), **options)


def load_increment(
    records: DataFrame, lake: Lake, now: datetime, delay_s: int = 100, collector: str | None = None,
    spec: LoadSpec = LoadSpec(), persist: bool = False, catch_up_s: int | None = None,
) -> Counts | None:
    """Load what arrived since the last progress, up to ``delay_s`` behind ``now``.

    ``catch_up_s`` bounds the window when progress is far behind. The window excludes its lower
    end, which the window before has loaded. Returns None, and records nothing, if no time has
    passed or no row arrived: the next call then looks at a wider window. ``persist`` makes both
    stores see the same rows of a source that changes.
    """
    collector = collector or collector_of("present", spec)
    progress = read_progress(records.sparkSession, lake.progress)
    (past,) = first_times(resume(progress, now, "present", collector), "start")
    present = now - timedelta(seconds=delay_s)
    if catch_up_s is not None and present - past > timedelta(seconds=catch_up_s):
        ahead = records.where(F.col("timestamp") > time_literal(records, past))
        (first,) = first_times(ahead.agg(F.min("timestamp").alias("first")), "first")
        if first is not None:
            present = min(present, max(past, first) + timedelta(seconds=catch_up_s))
    if present <= past:
        return None
    window = in_period(records, past, present, include_low=False)
    if window.isEmpty():
        return None
    return load_window(window, lake, collector, past, present, present, now, spec, persist)


def load_late(
    records: DataFrame, lake: Lake, low: datetime, high: datetime, now: datetime, step_s: int = 100,
    spec: LoadSpec = LoadSpec(), collector: str | None = None,
) -> Counts:
    """Load the windows of ``[low, high)`` whose records are not the stored documents.

    Rows that reached the source after their window was loaded are found by digests of each window
    on both sides; windows that agree are not loaded again. What the lake has and the source has not
    stays. The progress of other collectors is left as it is. Records must have the default ids.
    """
    spark = records.sparkSession
    period = in_period(records, low, high, include_high=False)
    docs = read_docs(spark, lake.docs, low=low, high=high, latest=False, columns=("_id", "@timestamp"))
    path = new_path(spark, "late-windows")
    differing_windows(
        record_ids(period, low, step_s), stored_ids(docs.where(F.col("@timestamp") < moment(high)), low, step_s)).write.parquet(path)
    windows = spark.read.parquet(path)
    n, first, last = windows.agg(F.count(F.lit(1)), F.min("window"), F.max("window")).first()
    run = {"collector": collector or collector_of("late", spec), "host": spec.host, "past": low, "present": high,
           "timestamp": log_time(now), "level": "INFO", "ok": True}
    counts = {"rows_in": 0, "points_out": 0, "docs_out": 0}
    if n:
        begin, end = low + timedelta(seconds=first * step_s), min(high, low + timedelta(seconds=(last + 1) * step_s))
        rows = in_period(records, begin, end, include_high=False)
        rows = rows.withColumn("window", window_number(rows, low, step_s)).join(windows.select("window"), "window", "left_semi")
        counts = load_both(rows.select(records.columns), lake, now, spec)
    write_run_log(spark, lake.run_log, {**run, "message": f"loaded {n} windows that differed", **counts})
    return {**counts, "windows": n}
