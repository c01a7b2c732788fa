"""The load that follows the present."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loglake.operators.documents import doc_id
from loglake.plans.load import (
    LoadSpec, collector_of, load_increment, load_window, points_only, split_untimed,
)
from loglake.sinks.lake import Lake, first_times, write_rejects

Clock = Callable[[], datetime]


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def with_event_time(stream: DataFrame, delay: str = "100 seconds") -> DataFrame:
    """Records with ``timestamp`` as an event time and a watermark ``delay`` behind it."""
    return stream.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark(
        "timestamp", delay
    )


def boundary_dedup(stream: DataFrame, delay: str = "100 seconds") -> DataFrame:
    """Each record once, though neighbouring windows of the source share their common bound.

    State is one id per record within the watermark. Rows later than the watermark are dropped
    by the engine, so use it only where the source cannot be later; the keyed tables of the lake
    need no such step.
    """
    return with_event_time(stream, delay).withColumn("_id", doc_id()).dropDuplicatesWithinWatermark(
        ["_id"]
    )


def windowed_counts(stream: DataFrame, step: str = "100 seconds", delay: str = "100 seconds") -> DataFrame:
    """Rows per tumbling window as a stream; a window is final once the watermark passed it."""
    return (
        with_event_time(stream, delay)
        .groupBy(F.window("timestamp", step).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("past"), F.col("w.end").alias("present"), "n")
    )


def load_present(
    stream: DataFrame, lake: Lake, checkpoint: str, spec: LoadSpec = LoadSpec(),
    collector: str | None = None, clock: Clock = utc_now, every: str | None = "10 seconds",
) -> StreamingQuery:
    """Start loading a stream of records; ``every=None`` loads what is there and ends.

    Offsets live in the checkpoint, so a restart goes on where it stopped. A micro-batch may be
    repeated after a failure; keyed tables make that harmless. Its size is the source's to
    bound (``maxFilesPerTrigger`` and the like), which also paces the catch-up. Records without
    a time go to the lake's rejects, however they fall into batches.
    """
    collector = collector or collector_of("present", spec)

    def load(batch: DataFrame, _: int) -> None:
        # A file that cannot be split is read by one task; its rows are shaped and written by all.
        batch = batch.repartition(batch.sparkSession.sparkContext.defaultParallelism).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            bounds = batch.agg(F.min("timestamp").alias("past"), F.max("timestamp").alias("present"))
            past, last = first_times(bounds, "past", "present")
            timed, rejects = split_untimed(batch)
            now = clock()
            if last is not None:
                load_window(timed, lake, collector, past, last, last, now, spec, rejects=rejects)
            elif not batch.isEmpty():
                write_rejects(rejects, lake.rejects, now)
        finally:
            batch.unpersist()

    rows = stream.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    writer = rows.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def load_points_present(
    stream: DataFrame, lake: Lake, checkpoint: str, spec: LoadSpec | None = None, **options
) -> StreamingQuery:
    """``load_present`` into the time series only."""
    return load_present(stream, lake, checkpoint, spec=points_only(spec), **options)


def poll_present(
    spark: SparkSession, read_records: Callable[[], DataFrame], lake: Lake, checkpoint: str,
    delay_s: int = 100, every: str = "10 seconds", spec: LoadSpec = LoadSpec(),
    collector: str | None = None, clock: Clock = utc_now, catch_up_s: int | None = None,
    persist: bool = True,
) -> StreamingQuery:
    """Follow a table that is not a stream, such as the log table behind JDBC.

    A clock stream fires the windows; the rows of each are read by the executors through
    ``read_records``, with the time bounds pushed to the table. They are kept between the two
    writes, so a row that arrives meanwhile is in both stores or, with the next window, in neither.
    """

    def load(_: DataFrame, __: int) -> None:
        load_increment(read_records(), lake, clock(), delay_s, collector, spec, persist, catch_up_s)

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        ticks.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )
