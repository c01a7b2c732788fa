"""Datapoints: shaping, metric queries, catalogues, upsert and deletes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.functions.numbers import fix_exponent, to_number
from loglake.functions.text import clean_name, clean_text
from loglake.functions.times import epoch_ms, epoch_s
from loglake.operators.records import finite, nonzero_metric

POINT_COLUMNS = ("name", "timestamp", "value", "tags")
POINT_KEY = ("name", "timestamp", "tags")

Filter = Callable[[DataFrame], Column]
Transform = Callable[[DataFrame], DataFrame]


#: Not part of a datapoint: the record's own time, which orders what falls into one second.
ORDER = "order_us"


def point_shape(records: DataFrame) -> DataFrame:
    """Each record as name, epoch milliseconds, value and tags. Keeps every row."""
    return ordered_shape(records).drop(ORDER)


def ordered_shape(records: DataFrame) -> DataFrame:
    """``point_shape`` with the record's time in microseconds, for a store to order copies by."""
    return records.select(
        clean_name(F.col("keywname")).alias("name"),
        epoch_ms(F.col("timestamp")).alias("timestamp"),
        to_number(F.col("keywvalue")).alias("value"),
        F.create_map(
            F.lit("proc"), clean_name(F.col("procname")),
            F.lit("env"), clean_name(F.col("env")),
            F.lit("loghost"), clean_name(F.col("loghost")),
            F.lit("logtext"), clean_text(F.col("logtext")),
        ).alias("tags"),
        F.unix_micros(F.col("timestamp").cast("timestamp")).alias(ORDER),
    )


def to_points(
    records: DataFrame, data_filter: Filter = finite, data_parser: Transform = point_shape
) -> DataFrame:
    """Records that pass ``data_filter``, shaped by ``data_parser``."""
    return records.where(data_filter(records)).transform(data_parser)


def put_lines(records: DataFrame, data_filter: Filter = nonzero_metric, with_logtext: bool = True) -> DataFrame:
    """``put name seconds value tag=...`` text lines, in a column ``value``."""
    parts = [
        F.lit("put"), clean_name(F.col("keywname")), epoch_s(F.col("timestamp")).cast("string"),
        fix_exponent(F.col("keywvalue")),
        F.concat(F.lit("proc="), clean_name(F.col("procname"))),
        F.concat(F.lit("env="), clean_name(F.col("env"))),
        F.concat(F.lit("loghost="), clean_name(F.col("loghost"))),
    ]
    if with_logtext:
        parts.append(F.concat(F.lit("logtext="), clean_text(F.col("logtext"))))
    return records.where(data_filter(records)).select(F.concat_ws(" ", *parts).alias("value"))


# --- queries -------------------------------------------------------------------------------

def metric_filter(names: str | Iterable[str]) -> Column:
    return F.col("name").isin([names] if isinstance(names, str) else list(names))


def tag_filter(tags: Mapping[str, str | Iterable[str]]) -> Column:
    """Every given key has one of its given values; no keys means every datapoint."""
    tests = [
        F.coalesce(
            F.col("tags").getItem(key).isin([values] if isinstance(values, str) else list(values)),
            F.lit(False),
        )
        for key, values in tags.items()
    ]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def since_relative(value: int, unit: str, anchor: datetime | str) -> Column:
    """The last ``value`` units before ``anchor``; unit as in ``hours`` or ``days``."""
    text = anchor if isinstance(anchor, str) else anchor.isoformat(sep=" ")
    start = F.lit(text).cast("timestamp") - F.expr(f"interval {int(value)} {unit}")
    return F.col("timestamp") >= F.unix_millis(start)


def in_absolute_range(start_ms: int | None = None, end_ms: int | None = None) -> Column:
    """Between two epoch milliseconds, both inclusive and optional."""
    test = F.lit(True)
    if start_ms is not None:
        test = F.col("timestamp") >= F.lit(start_ms).cast("long")
    if end_ms is not None:
        test = test & (F.col("timestamp") <= F.lit(end_ms).cast("long"))
    return test


def metric_query(
    points: DataFrame,
    metrics: Sequence[Mapping],
    *,
    start_relative: tuple[int, str] | None = None,
    anchor: datetime | str | None = None,
    start_ms: int | None = None,
    end_ms: int | None = None,
) -> DataFrame:
    """Datapoints of any of the metrics (``{"name": .., "tags": {..}}``) in a time range."""
    wanted = reduce(
        lambda a, b: a | b,
        [metric_filter(m["name"]) & tag_filter(m.get("tags") or {}) for m in metrics],
    )
    found = points.where(wanted).where(in_absolute_range(start_ms, end_ms))
    if start_relative is not None:
        if anchor is None:
            raise ValueError("a relative start needs an anchor time")
        found = found.where(since_relative(*start_relative, anchor))
    return found


def sample_size(points: DataFrame) -> DataFrame:
    """How many datapoints a query met."""
    return points.agg(F.count(F.lit(1)).alias("sample_size"))


def metric_names(points: DataFrame) -> DataFrame:
    return points.select("name").distinct()


def tag_names(points: DataFrame) -> DataFrame:
    return points.select(F.explode(F.map_keys("tags")).alias("tag")).distinct()


def tag_values(points: DataFrame) -> DataFrame:
    return points.select(F.explode(F.map_values("tags")).alias("tag_value")).distinct()


# --- upsert and deletes --------------------------------------------------------------------

def upsert_points(points: DataFrame, load_time: str = "load_time") -> DataFrame:
    """One row per (name, timestamp, tags): that of the latest load, and of one load the last record.

    Records of one second are told apart by ``order_us`` where the points carry it; on a tie the
    highest value stays. A plain aggregation, so copies are combined before the shuffle.
    """
    order = [load_time, *([ORDER] if ORDER in points.columns else [])]
    latest = F.max(F.struct(*order, "value")).alias("latest")
    return points.groupBy(*POINT_KEY).agg(latest).select(
        "name", "timestamp", F.col("latest.value").alias("value"), "tags",
        *[F.col(f"latest.{c}").alias(c) for c in order],
    )


def delete_condition(
    names: Iterable[str], start_ms: int | None, end_ms: int | None, tags: Mapping | None
) -> Column:
    """True for the datapoints a delete removes, false (never null) for all others."""
    test = metric_filter(names) & in_absolute_range(start_ms, end_ms) & tag_filter(tags or {})
    return F.coalesce(test, F.lit(False))


def without_deleted(points: DataFrame, deletes: DataFrame, keep: str = "left_anti") -> DataFrame:
    """Stored datapoints without those that a logged delete names and that were loaded before it.

    ``deletes`` are rows ``names, start_ms, end_ms, tags, deleted_at``, null for no bound and no tags.
    With ``keep="left_semi"`` the deleted ones are what stays. The deletes are joined by name; Spark
    sends them to every task when they measure small.
    """
    d = deletes.select(F.explode("names").alias("d_name"), "start_ms", "end_ms", F.col("tags").alias("d_tags"), "deleted_at")
    tags_fit = F.forall(
        F.coalesce(F.map_entries("d_tags"), F.array().cast("array<struct<key:string,value:array<string>>>")),
        lambda tag: F.coalesce(F.array_contains(tag["value"], F.element_at(F.col("tags"), tag["key"])), F.lit(False)))
    named = (
        (F.col("name") == F.col("d_name")) & (F.col("load_time") <= F.col("deleted_at"))
        & (F.col("start_ms").isNull() | (F.col("timestamp") >= F.col("start_ms")))
        & (F.col("end_ms").isNull() | (F.col("timestamp") <= F.col("end_ms"))) & tags_fit)
    return points.join(d, named, keep)


def delete_metric(points: DataFrame, name: str) -> DataFrame:
    return points.where(~delete_condition([name], None, None, None))


def delete_metrics(points: DataFrame, names: Iterable[str] | DataFrame) -> DataFrame:
    """Without the given metrics; a long list comes as a DataFrame with a ``name`` column."""
    if isinstance(names, DataFrame):
        return points.join(names.select("name"), "name", "left_anti").select(points.columns)
    return points.where(~delete_condition(names, None, None, None))


def delete_points(
    points: DataFrame, names: Iterable[str], start_ms: int, end_ms: int | None = None,
    tags: Mapping[str, str | Iterable[str]] | None = None,
) -> DataFrame:
    """Without the datapoints of these metrics in the range that carry the tags."""
    return points.where(~delete_condition(names, start_ms, end_ms, tags))
