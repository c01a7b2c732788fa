"""What names, tags and values a datapoint table holds, by day.

Summaries add up over days. A day's summary belongs to one generation of that day: it is used as long
as the day is clean and still that generation, and no logged delete touches it. All other days are
scanned, so the answers are those of a scan of everything.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglake.functions.times import DAY_MS, utc_day
from loglake.sinks import versions
from loglake.sinks.lake import POINT_PARTITIONS, read_points, stored_deletes

CATALOGUE = T.StructType([T.StructField(n, k) for n, k in (
    ("kind", T.StringType()), ("name", T.StringType()), ("value", T.StringType()), ("n", T.LongType()),
    ("generation", T.StringType()), ("day", T.DateType()))])
PARTITIONS, SORT = ("day",), ("kind", "name")
NAME, TAG = "name", "tag"


def _path(points: str) -> str:
    return f"{points}-catalogue"


def summary(points: DataFrame) -> DataFrame:
    """``kind, name, value, n, day``: datapoints of each metric, and of each value of each tag."""
    points = points.withColumn("day", utc_day(F.col("timestamp")))
    names = points.groupBy("day", "name").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(NAME).alias("kind"), "name", F.lit(None).cast("string").alias("value"), "n", "day")
    tags = points.select("day", F.explode("tags").alias("tag", "value")).groupBy("day", "tag", "value").agg(F.count(F.lit(1)).alias("n"))
    return names.unionByName(tags.select(F.lit(TAG).alias("kind"), F.col("tag").alias("name"), "value", "n", "day"))


def _touched(spark: SparkSession, points: str, days: list[str]) -> set[str]:
    """Days that a logged delete may reach."""
    deletes = stored_deletes(spark, points)
    if deletes is None:
        return set()
    ranges = deletes.select("start_ms", "end_ms").distinct().collect()  # as many as there are unfolded deletes
    begin = {day: (date.fromisoformat(day) - date(1970, 1, 1)).days * DAY_MS for day in days}
    return {day for day in days for r in ranges
            if (r["end_ms"] is None or r["end_ms"] >= begin[day]) and (r["start_ms"] is None or r["start_ms"] < begin[day] + DAY_MS)}


def _covered(spark: SparkSession, points: str) -> tuple[DataFrame, list[str], list[str]]:
    """Summaries in force, the days they are of, and the days that must be scanned."""
    at = versions.version(spark, points)
    live = versions.live_partitions(spark, points, POINT_PARTITIONS, at)
    clean = [day for day, is_clean in live.items() if is_clean]
    clean = sorted(set(clean) - _touched(spark, points, clean))
    rows = versions.read(spark, _path(points), CATALOGUE, PARTITIONS)
    wanted = [F.struct(F.lit(day).alias("d"), F.lit(at.of(day)).alias("g")) for day in clean]
    if not wanted:
        return rows.where(F.lit(False)), [], sorted(live)
    rows = rows.where(F.struct(F.col("day").cast("string").alias("d"), F.col("generation").alias("g")).isin(wanted)).where(
        F.col("day").cast("string").isin(clean))
    known = [str(r["day"]) for r in rows.select("day").distinct().toLocalIterator()]
    return rows, known, sorted(set(live) - set(known))


def refresh_catalogue(spark: SparkSession, points: str) -> list[str]:
    """Summarise the clean days that have no summary in force; returns them. Run it after compactions."""
    at = versions.version(spark, points)
    live = versions.live_partitions(spark, points, POINT_PARTITIONS, at)
    _, known, _ = _covered(spark, points)
    touched = _touched(spark, points, list(live))
    days = sorted(day for day, clean in live.items() if clean and day not in known and day not in touched)
    if days:
        others = [day for day in live if day not in days]
        rows = summary(read_points(spark, points, but_days=others))
        generation = F.element_at(F.create_map(*[F.lit(x) for day in days for x in (day, at.of(day))]), F.col("day").cast("string"))
        rows = rows.withColumn("generation", generation).where(F.col("generation").isNotNull())
        versions.replace(spark, _path(points), CATALOGUE, PARTITIONS, SORT, days, lambda _: rows)
    return days


def _whole(spark: SparkSession, points: str) -> DataFrame:
    """Summary rows of all days, of which those without a summary are scanned."""
    rows, known, scanned = _covered(spark, points)
    rows = rows.select("kind", "name", "value", "n", "day")
    return rows.unionByName(summary(read_points(spark, points, but_days=known))) if scanned else rows


def stored_metric_names(spark: SparkSession, points: str) -> DataFrame:
    """As ``metric_names`` of all datapoints of a table."""
    return _whole(spark, points).where(F.col("kind") == NAME).select("name").distinct()


def stored_tag_names(spark: SparkSession, points: str) -> DataFrame:
    """As ``tag_names``."""
    return _whole(spark, points).where(F.col("kind") == TAG).select(F.col("name").alias("tag")).distinct()


def stored_tag_values(spark: SparkSession, points: str) -> DataFrame:
    """As ``tag_values``."""
    return _whole(spark, points).where(F.col("kind") == TAG).select(F.col("value").alias("tag_value")).distinct()


def stored_sample_sizes(spark: SparkSession, points: str) -> DataFrame:
    """``name, sample_size``: how many datapoints each metric has."""
    return _whole(spark, points).where(F.col("kind") == NAME).groupBy("name").agg(F.sum("n").alias("sample_size"))
