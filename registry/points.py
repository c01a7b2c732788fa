"""Datapoints: shaping, queries, catalogues, upsert, deletes, payloads."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglake.operators import points as ops
from loglake.operators.records import finite_named, in_period, nonzero_metric, numeric_no_nan
from loglake.plans.load import load_both
from loglake.schema import POINT
from loglake.session import new_path
from loglake.sinks import catalogue
from loglake.sinks.exports import points_payload, write_lines
from loglake.sinks.lake import (
    Lake, compact_points, delete_stored_points, fold_deletes, read_points, write_points,
)
from registry.base import (
    ALOG, FIRST, FOLDED_POINTS, LAST, NAME, NOW, POINT_FIELDS, POINTS, TEXT_TAG, alog, query, table,
    written_once,
)

MS = {"low": 1704412800000, "high": 1705017600000}  # 2024-01-05 and 2024-01-12
ALL = "name, timestamp, value, proc, env, loghost, logtext"


def _points(spark, sf_dir):
    return ops.to_points(alog(spark, sf_dir))


@query("to_points", f"with {ALOG}, {POINTS} select {ALL} from points")
def _(spark, sf_dir):
    return _points(spark, sf_dir)


@query("to_points_named", f"with {ALOG}, {POINTS} select {ALL} from points where name <> ''")
def _(spark, sf_dir):
    return ops.to_points(alog(spark, sf_dir), finite_named)


# The caller's own filter and parser: purchases, in integer cents, tagged by user.
@query("data_filter_and_parser", f"""
    with {ALOG} select {NAME} as metric, cast(try_cast(keywvalue as double) * 100 as bigint) as cents, procid
    from alog where keywname like 'EVT purchase%' and isfinite(try_cast(keywvalue as double))""")
def _(spark, sf_dir):
    from loglake.functions.numbers import finite_only, to_number
    from loglake.functions.text import clean_name

    return ops.to_points(
        alog(spark, sf_dir),
        data_filter=lambda df: F.col("keywname").startswith("EVT purchase") & finite_only(F.col("keywvalue")),
        data_parser=lambda df: df.select(
            clean_name(F.col("keywname")).alias("metric"),
            F.round(to_number(F.col("keywvalue")) * 100).cast("long").alias("cents"), "procid"),
    )


@query("points_put_lines", f"""
    with {ALOG} select concat('put ', {NAME}, ' ', cast(cast(floor(epoch(timestamp)) as bigint) as varchar), ' ',
    keywvalue, ' proc=', procname, ' env=', env, ' loghost=', loghost, ' logtext=', {TEXT_TAG}) as value
    from alog where keywname <> '' and try_cast(keywvalue as double) <> 0""")
def _(spark, sf_dir):
    return ops.put_lines(alog(spark, sf_dir))


# The payload written as gzip text, read back and taken apart: every point, once.
@query("points_payload", f"with {ALOG}, {POINTS} select {ALL} from points")
def _(spark, sf_dir):
    def write(path):
        write_lines(points_payload(_points(spark, sf_dir), 1000), path)

    batches = spark.read.text(written_once(spark, sf_dir, "payload", write))
    parsed = batches.select(F.explode(F.from_json("value", T.ArrayType(POINT))).alias("p"))
    return parsed.select("p.*")


@query("metric_filter", f"with {ALOG}, {POINTS} select {ALL} from points where name in ('EVTclick3', 'EVTpurchase7')")
def _(spark, sf_dir):
    return _points(spark, sf_dir).where(ops.metric_filter(["EVTclick3", "EVTpurchase7"]))


@query("tag_filter", f"""
    with {ALOG}, {POINTS} select {ALL} from points where loghost in ('node1', 'node2') and env = 'hall2'""")
def _(spark, sf_dir):
    return _points(spark, sf_dir).where(
        ops.tag_filter({"loghost": ["node1", "node2"], "env": "hall2"}))


@query("since_relative", f"""
    with {ALOG}, {POINTS} select {ALL} from points
    where timestamp >= epoch_ms(timestamp '{LAST}' - interval 36 hour)""")
def _(spark, sf_dir):
    return _points(spark, sf_dir).where(ops.since_relative(36, "hours", LAST))


@query("in_absolute_range", f"""
    with {ALOG}, {POINTS} select {ALL} from points where timestamp between {MS['low']} and {MS['high']}""")
def _(spark, sf_dir):
    return _points(spark, sf_dir).where(ops.in_absolute_range(MS["low"], MS["high"]))


METRICS = [
    {"name": "EVTclick3", "tags": {"loghost": "node4"}},
    {"name": "EVTpurchase7", "tags": {}},
]
QUERY_SQL = f"""(name = 'EVTclick3' and loghost = 'node4' or name = 'EVTpurchase7')
    and timestamp between {MS['low']} and {MS['high']}"""


@query("metric_query", f"with {ALOG}, {POINTS} select {ALL} from points where {QUERY_SQL}")
def _(spark, sf_dir):
    return ops.metric_query(_points(spark, sf_dir), METRICS, start_ms=MS["low"], end_ms=MS["high"])


@query("metric_query_relative", f"""
    with {ALOG}, {POINTS} select {ALL} from points where name = 'EVTclick3'
    and timestamp >= epoch_ms(timestamp '{LAST}' - interval 2 day)""")
def _(spark, sf_dir):
    return ops.metric_query(
        _points(spark, sf_dir), [{"name": "EVTclick3"}], start_relative=(2, "days"), anchor=LAST)


@query("sample_size", f"with {ALOG}, {POINTS} select count(*) as sample_size from points where {QUERY_SQL}")
def _(spark, sf_dir):
    return ops.sample_size(
        ops.metric_query(_points(spark, sf_dir), METRICS, start_ms=MS["low"], end_ms=MS["high"]))


@query("metric_names", f"with {ALOG}, {POINTS} select distinct name from points")
def _(spark, sf_dir):
    return ops.metric_names(_points(spark, sf_dir))


@query("tag_names", "select unnest(['proc', 'env', 'loghost', 'logtext']) as tag from (select 1 from events limit 1)")
def _(spark, sf_dir):
    return ops.tag_names(_points(spark, sf_dir))


@query("tag_values", f"""
    with {ALOG}, {POINTS} select proc as tag_value from points union select env from points
    union select loghost from points union select logtext from points""")
def _(spark, sf_dir):
    return ops.tag_values(_points(spark, sf_dir))


# Every point loaded twice, the second time with the value doubled.
@query("upsert_points", f"""
    with {ALOG}, {POINTS} select name, timestamp, max(value * 2) as value, proc, env, loghost, logtext
    from points group by all""")
def _(spark, sf_dir):
    points = _points(spark, sf_dir)
    again = points.withColumn("value", F.col("value") * 2)
    first, second = F.lit("2024-02-01").cast("timestamp"), F.lit("2024-02-02").cast("timestamp")
    return ops.upsert_points(
        points.withColumn("load_time", first).unionByName(again.withColumn("load_time", second))
    ).drop("load_time")


# Records moved into whole minutes, so that many fall into one second: the last one of each stays.
CROWDED = "alog as (select * replace (date_trunc('minute', timestamp) + to_microseconds(id % 1000000) as timestamp, 'c' || cast(id % 3 as varchar) as keywname, 'x' as logtext) from alog1)"


@query("upsert_points_same_second", f"""
    with {ALOG.replace('alog as', 'alog1 as', 1)}, {CROWDED}, {FOLDED_POINTS} select {ALL} from folded""")
def _(spark, sf_dir):
    records = alog(spark, sf_dir).withColumns({
        "timestamp": F.timestamp_micros(F.unix_micros(F.date_trunc("minute", "timestamp").cast("timestamp")) + F.col("id") % 1000000),
        "keywname": F.concat(F.lit("c"), (F.col("id") % 3).cast("string")), "logtext": F.lit("x")})
    points = ops.to_points(records, data_parser=ops.ordered_shape)
    return ops.upsert_points(points.withColumn("load_time", F.lit("2024-02-01").cast("timestamp"))).drop("load_time", ops.ORDER)


# Names, tags and text that are null or empty are datapoints like any other.
@query("points_null_text", f"""
    with {ALOG.replace('alog as', 'alog1 as', 1)}, alog as (select * replace (
        case when id % 5 > 1 then keywname else '' end as keywname, case when id % 7 > 0 then env else '' end as env) from alog1),
    {FOLDED_POINTS} select {ALL} from folded""")
def _(spark, sf_dir):
    records = alog(spark, sf_dir).withColumns({
        "keywname": F.when(F.col("id") % 5 > 1, F.col("keywname")).when(F.col("id") % 5 == 1, ""),
        "env": F.when(F.col("id") % 7 > 0, F.col("env"))})
    lake = Lake(new_path(spark, "lake"))
    load_both(records, lake, NOW)
    return read_points(spark, lake.points)


# Written and read in another session zone: days are UTC days, so no row is lost to pruning.
@query("read_points_zone", f"""
    with {ALOG}, {FOLDED_POINTS} select {ALL} from folded where timestamp between {MS['low']} and {MS['high']}""")
def _(spark, sf_dir):
    points, path = _ordered(spark, sf_dir), new_path(spark, "points")
    held = new_path(spark, "points-utc")
    points.write.parquet(held)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Santiago")
    try:
        write_points(spark.read.parquet(held), path, NOW)
        found = new_path(spark, "points-found")
        read_points(spark, path, start_ms=MS["low"], end_ms=MS["high"]).write.parquet(found)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    return spark.read.parquet(found)


@query("delete_metric", f"with {ALOG}, {POINTS} select {ALL} from points where name <> 'EVTclick3'")
def _(spark, sf_dir):
    return ops.delete_metric(_points(spark, sf_dir), "EVTclick3")


# The names to go come as a table: all metrics with fewer points than the mean.
@query("delete_metrics", f"""
    with {ALOG}, {POINTS}, counts as (select name, count(*) as n from points group by name)
    select {ALL} from points where name not in
    (select name from counts where n < (select avg(n) from counts))""")
def _(spark, sf_dir):
    points = _points(spark, sf_dir)
    counts = points.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    rare = counts.where(F.col("n") < counts.agg(F.avg("n")).scalar())
    return ops.delete_metrics(points, rare)


DELETED = f"""name in ('EVTclick3', 'EVTclick4') and timestamp >= {MS['low']} and timestamp <= {MS['high']}
    and env in ('hall1', 'hall4')"""


@query("delete_points", f"with {ALOG}, {POINTS} select {ALL} from points where not ({DELETED})")
def _(spark, sf_dir):
    return ops.delete_points(
        _points(spark, sf_dir), ["EVTclick3", "EVTclick4"], MS["low"], MS["high"],
        {"env": ["hall1", "hall4"]})


# --- stored ---------------------------------------------------------------------------------

def _ordered(spark, sf_dir):
    """Points with the order of their records, as a load writes them."""
    return ops.to_points(alog(spark, sf_dir), data_parser=ops.ordered_shape)


def _stored(spark, sf_dir):
    def write(path):
        write_points(_ordered(spark, sf_dir), path, NOW)

    return written_once(spark, sf_dir, "points", write)


@query("write_points", f"with {ALOG}, {POINTS}, {FOLDED_POINTS} select {ALL} from folded")
def _(spark, sf_dir):
    return read_points(spark, _stored(spark, sf_dir))


@query("read_points", f"""
    with {ALOG}, {POINTS}, {FOLDED_POINTS} select {ALL} from folded
    where name in ('EVTclick3', 'EVTpurchase7') and timestamp between {MS['low']} and {MS['high']}""")
def _(spark, sf_dir):
    return read_points(spark, _stored(spark, sf_dir), ["EVTclick3", "EVTpurchase7"], MS["low"], MS["high"])


# Two loads of the same points, folded in place.
@query("compact_points", f"with {ALOG}, {POINTS}, {FOLDED_POINTS} select {ALL} from folded")
def _(spark, sf_dir):
    def write(path):
        write_points(_ordered(spark, sf_dir), path, NOW)
        write_points(_ordered(spark, sf_dir), path, NOW)
        compact_points(spark, path, [date(2024, 1, d) for d in range(1, 32)])

    return read_points(spark, written_once(spark, sf_dir, "compacted", write), latest=False)


# Delete from the stored table: a few metrics for a week, then all points of one day.
@query("delete_stored_points", f"""
    with {ALOG}, {POINTS}, {FOLDED_POINTS} select {ALL} from folded where not ({DELETED})
    and not (name <> '' and timestamp between 1705708800000 and 1705795199999)""")
def _(spark, sf_dir):
    def write(path):
        write_points(_ordered(spark, sf_dir), path, NOW)
        delete_stored_points(spark, path, ["EVTclick3", "EVTclick4"], MS["low"], MS["high"],
                             {"env": ["hall1", "hall4"]})
        names = [f"EVT{kind}{i}" for kind in ("click", "purchase") for i in range(10)]
        delete_stored_points(spark, path, names, 1705708800000, 1705795199999)

    return read_points(spark, written_once(spark, sf_dir, "deleted", write))


# --- catalogue ------------------------------------------------------------------------------

def _summarised(spark, sf_dir):
    """Two loads, all days but the last week compacted and summarised."""

    def write(path):
        write_points(_ordered(spark, sf_dir), path, NOW)
        write_points(_ordered(spark, sf_dir), path, NOW)
        compact_points(spark, path, [date(2024, 1, d) for d in range(1, 24)])
        catalogue.refresh_catalogue(spark, path)

    return written_once(spark, sf_dir, "summarised", write)


@query("stored_metric_names", f"with {ALOG}, {POINTS} select distinct name from points")
def _(spark, sf_dir):
    return catalogue.stored_metric_names(spark, _summarised(spark, sf_dir))


@query("stored_tag_names", "select unnest(['proc', 'env', 'loghost', 'logtext']) as tag from (select 1 from events limit 1)")
def _(spark, sf_dir):
    return catalogue.stored_tag_names(spark, _summarised(spark, sf_dir))


@query("stored_tag_values", f"""
    with {ALOG}, {POINTS} select proc as tag_value from points union select env from points
    union select loghost from points union select logtext from points""")
def _(spark, sf_dir):
    return catalogue.stored_tag_values(spark, _summarised(spark, sf_dir))


@query("stored_sample_sizes", f"with {ALOG}, {POINTS}, {FOLDED_POINTS} select name, count(*) as sample_size from folded group by name")
def _(spark, sf_dir):
    return catalogue.stored_sample_sizes(spark, _summarised(spark, sf_dir))


# Logged deletes folded into the files, and a later load of what was deleted.
@query("fold_deletes", f"""
    with {ALOG}, {POINTS}, {FOLDED_POINTS} select {ALL} from folded where not ({DELETED}) or name = 'EVTclick4'""")
def _(spark, sf_dir):
    def write(path):
        write_points(_ordered(spark, sf_dir), path, NOW)
        delete_stored_points(spark, path, ["EVTclick3", "EVTclick4"], MS["low"], MS["high"],
                             {"env": ["hall1", "hall4"]}, at=datetime(2024, 2, 2))
        write_points(_ordered(spark, sf_dir).where("name = 'EVTclick4'"), path, datetime(2024, 2, 3))
        fold_deletes(spark, path)

    return read_points(spark, written_once(spark, sf_dir, "deletes-folded", write))
