"""The log table: over JDBC, from a catalogue table or from Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_FETCH_SIZE = 1000


def jdbc_options(
    url: str,
    table: str = "alog",
    query: str | None = None,
    fetchsize: int = DEFAULT_FETCH_SIZE,
    partitions: int | None = None,
    lower: datetime | None = None,
    upper: datetime | None = None,
    time_column: str = "timestamp",
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC read of the log table, split into ``partitions`` time slices between two bounds.

    A free query cannot be sliced, so it becomes the sub-select of ``dbtable`` in that case.
    The bounds only set the slices; rows outside them are still read, so filter as well.
    """
    options = {"url": url, "fetchsize": str(fetchsize), **extra}
    sliced = partitions is not None
    if sliced and (lower is None or upper is None):
        raise ValueError("partitions need both bounds: without them one task would read the whole table")
    if query is not None and not sliced:
        options["query"] = query
    else:
        options["dbtable"] = f"({query}) q" if query is not None else table
    if sliced:
        options |= {
            "partitionColumn": time_column,
            "lowerBound": lower.isoformat(sep=" "),
            "upperBound": upper.isoformat(sep=" "),
            "numPartitions": str(partitions),
        }
    return options


def equal_slices(times: DataFrame, n: int, column: str = "timestamp", accuracy: int = 100_000) -> list[str]:
    """Conditions that cut a table into up to ``n`` slices of about equally many rows, for one task each.

    The bounds are quantiles of ``times``, the time column of the table or a sample of it, so a burst
    is cut as finely as it is dense; equal-width slices would give it to one task. The first slice is
    open below and holds rows without a time, the last is open above: rows that the sample did not
    show are in exactly one slice too. Rows of one moment stay together.
    """
    if n < 1:
        raise ValueError("at least one slice")
    shares = [i / n for i in range(1, n)]
    c = F.unix_micros(F.col(column).cast("timestamp"))
    quantiles = F.percentile_approx(c, shares, accuracy) if shares else F.array()
    texts = F.transform(F.array_distinct(quantiles), lambda m: F.date_format(F.timestamp_micros(m), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    bounds = times.agg(texts.alias("bounds")).first()["bounds"] or []
    if not bounds:
        return ["1 = 1"]
    name = column
    inner = [f"{name} > timestamp '{a}' and {name} <= timestamp '{b}'" for a, b in zip(bounds, bounds[1:])]
    return [f"({name} <= timestamp '{bounds[0]}' or {name} is null)", *inner, f"{name} > timestamp '{bounds[-1]}'"]


def scan_alog(
    spark: SparkSession, *, path: str | None = None, table: str | None = None, slices: Sequence[str] | None = None, **jdbc
) -> DataFrame:
    """The log table from a Parquet path, a catalogue table, or JDBC (``jdbc_options``).

    ``slices`` (``equal_slices``) are the conditions by which JDBC tasks share the table.
    """
    if path is not None:
        return spark.read.parquet(path)
    if table is not None and "url" not in jdbc:
        return spark.read.table(table)
    if table is not None:
        jdbc["table"] = table
    if slices is not None:
        options = jdbc_options(**jdbc)
        url, source = options.pop("url"), options.pop("dbtable")
        return spark.read.jdbc(url, source, predicates=list(slices), properties=options)
    return spark.read.format("jdbc").options(**jdbc_options(**jdbc)).load()


def scan_sql(spark: SparkSession, sql: str, args: dict | None = None, **views: DataFrame) -> DataFrame:
    """Any parameterised SQL as the source of a load.

    ``args`` are named parameters (``:name``); ``views`` are DataFrames the text may refer to
    as ``{name}``.
    """
    return spark.sql(sql, args=args or {}, **views)
