"""Progress, run log and running totals."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglake.session import new_path

FIRST_WINDOW_S = 100


def latest_progress(progress: DataFrame, collector: str | None = None) -> DataFrame:
    """The furthest time loaded towards the present."""
    return _of(progress, collector).agg(F.max("collector_piglet").alias("collector_piglet"))


def earliest_progress(progress: DataFrame, collector: str | None = None) -> DataFrame:
    """The furthest time loaded into the past."""
    return _of(progress, collector).agg(F.min("collector_piglet").alias("collector_piglet"))


def _of(progress: DataFrame, collector: str | None) -> DataFrame:
    """Progress of one collector since its last reset.

    A reset writes a row without a window; it starts the count anew from its own time.
    """
    if collector is None:
        return progress
    own = progress.where(F.col("collector") == collector)
    reset_at = own.where(F.col("past").isNull()).agg(F.max("written_at").alias("at"))
    since = F.coalesce(reset_at.scalar(), F.lit("0001-01-01").cast("timestamp"))
    return own.where(F.col("written_at") >= since)


def resume(
    progress: DataFrame, now: datetime, direction: str = "present", collector: str | None = None,
    first_window_s: int = FIRST_WINDOW_S,
) -> DataFrame:
    """Where a load goes on (column ``start``).

    Towards the present: the latest progress, else ``first_window_s`` before ``now``. Backwards:
    the earliest progress, else ``now``.
    """
    if direction == "present":
        found, default = latest_progress(progress, collector), now - timedelta(seconds=first_window_s)
    else:
        found, default = earliest_progress(progress, collector), now
    literal = F.lit(default.isoformat(sep=" ")).cast("timestamp")
    return found.select(F.coalesce("collector_piglet", literal).alias("start"))


def load_status(run_log: DataFrame) -> DataFrame:
    """Success and totals over every batch of the run log."""
    return run_log.agg(
        F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ok"),
        F.count(F.lit(1)).alias("loads"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
          for c in ("rows_in", "points_out", "docs_out")],
    )


def running_total(rows: DataFrame, order: str, value: str, alias: str) -> DataFrame:
    """Running sum over the whole of ``rows`` in the order of a unique column.

    One window over everything would be one task. Rows are cut into ranges of ``order``
    instead, written once so that the cut cannot change, summed within each range, and moved up
    by the sum of the ranges before: a table of one row per range.
    """
    spark = rows.sparkSession
    path = new_path(spark, "ranges")
    (
        rows.repartitionByRange(order)
        .withColumn("_range", F.spark_partition_id())
        .write.parquet(path)
    )
    cut = spark.read.parquet(path)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy("_range").agg(F.sum(value).alias("_sum")).select(
        "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        cut.withColumn("_inside", F.sum(value).over(inside))
        .join(starts, "_range")
        .withColumn(alias, F.col("_start") + F.col("_inside"))
        .select(*rows.columns, alias)
    )


def file_progress(files: DataFrame) -> DataFrame:
    """Per file: its size, the bytes done with it, and the total, also in MB.

    ``files`` is a listing (``list_files``), so no file is opened.
    """
    running = running_total(files, "file_path", "file_size", "done_bytes")
    total = files.agg(F.sum("file_size").alias("total")).scalar()
    return running.withColumn("total_bytes", total).withColumns({
        "done_mb": F.col("done_bytes") / 1_000_000.0,
        "total_mb": F.col("total_bytes") / 1_000_000.0,
    })
