"""Predicates and counts over log records."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglake.functions.numbers import (
    finite_only, fix_exponent, is_nonzero_metric, is_numeric_value,
)
from loglake.functions.text import clean_name
from loglake.schema import time_literal_type


def time_literal(df: DataFrame, moment: datetime | str, column: str = "timestamp") -> Column:
    """A moment as a literal of the column's own type, so the filter is pushed to the scan."""
    text = moment if isinstance(moment, str) else moment.isoformat(sep=" ")
    return F.lit(text).cast(time_literal_type(df, column))


def in_period(
    df: DataFrame, low: datetime | str, high: datetime | str, *, column: str = "timestamp",
    include_low: bool = True, include_high: bool = True,
) -> DataFrame:
    """Rows between two times, both ends inclusive. Reversed bounds give no rows.

    Incremental loads exclude one end, so that neighbouring windows share no row.
    """
    c = F.col(column)
    lower, upper = time_literal(df, low, column), time_literal(df, high, column)
    above = c >= lower if include_low else c > lower
    below = c <= upper if include_high else c < upper
    return df.where(above & below)


def until_delay(df: DataFrame, now: datetime, delay_s: int = 100, column: str = "timestamp") -> DataFrame:
    """Rows at least ``delay_s`` seconds behind ``now``, when late rows have arrived."""
    return df.where(F.col(column) <= time_literal(df, now - timedelta(seconds=delay_s), column))


# Ready-made row predicates; any function ``DataFrame -> Column`` can take their place.
def numeric(_: DataFrame) -> Column:
    return is_numeric_value(F.col("keywvalue"))


def numeric_no_nan(_: DataFrame) -> Column:
    return is_numeric_value(F.col("keywvalue"), allow_nan=False)


def finite(_: DataFrame) -> Column:
    return finite_only(F.col("keywvalue"))


def finite_named(_: DataFrame) -> Column:
    """Finite, and the cleaned metric name is not empty."""
    return finite_only(F.col("keywvalue")) & (clean_name(F.col("keywname")) != "")


def nonzero_metric(_: DataFrame) -> Column:
    return is_nonzero_metric(clean_name(F.col("keywname")), fix_exponent(F.col("keywvalue")))


def is_string(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def match_all() -> Column:
    return F.lit(True)


def head_rows(df: DataFrame, *order: str | Column, n: int = 60) -> DataFrame:
    """The first ``n`` rows in a given order."""
    return df.orderBy(*order).limit(n)


def window_counts(df: DataFrame, step: str = "100 seconds", column: str = "timestamp") -> DataFrame:
    """Rows per tumbling window, with its bounds."""
    return df.groupBy(F.window(column, step).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("past"), F.col("w.end").alias("present"), "n"
    )


def load_counts(df: DataFrame, by: str | Column | None = None, data_filter=finite) -> DataFrame:
    """Rows read and rows that become datapoints, in total or per batch key."""
    counts = (
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(data_filter(df)).alias("points_out"),
    )
    return df.agg(*counts) if by is None else df.groupBy(by).agg(*counts)


def next_window(df: DataFrame, past: datetime | str, step_s: int = 100, column: str = "timestamp") -> DataFrame:
    """The first window after ``past`` that holds rows: ``past`` stays, ``present`` moves on by steps.

    No row if nothing lies ahead.
    """
    start = time_literal(df, past, column)
    first = df.where(F.col(column) > start).agg(F.min(column).alias("first"))
    micros = F.unix_micros(F.col("first").cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    steps = F.ceil(micros / F.lit(step_s * 1_000_000)).cast("long")
    return first.where(F.col("first").isNotNull()).select(
        start.cast("timestamp").alias("past"),
        F.timestamp_micros(
            F.unix_micros(start.cast("timestamp")) + steps * F.lit(step_s * 1_000_000)
        ).alias("present"),
    )
