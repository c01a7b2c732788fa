"""Scans, periods, counts and progress over the log table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from loglake.operators import accounting, records
from loglake.operators.points import to_points
from loglake.sources.database import equal_slices, scan_alog, scan_sql
from registry.base import (
    ALOG, ALOG_SELECT, EPOCH_MS, FINITE, FIRST, LAST, NAME, NOW, POINTS, TIME_TEXT, alog, query,
    table, written_once,
)

ALL_COLUMNS = f"* replace ({TIME_TEXT.format('timestamp')} as timestamp)"
IN_PERIOD = f"timestamp between '{FIRST}' and '{LAST}'"


@query("window_counts_of_points", f"""
    with {ALOG}, kept as (select * from alog where {IN_PERIOD} and {FINITE})
    select strftime(make_timestamp(cast(floor(epoch(timestamp) / 100) as bigint) * 100000000), '%Y-%m-%d %H:%M:%S.%f') as past,
    strftime(make_timestamp(cast(floor(epoch(timestamp) / 100) as bigint) * 100000000 + 100000000), '%Y-%m-%d %H:%M:%S.%f') as present,
    count(*) as n from kept group by 1, 2""")
def window_counts_of_points(spark, sf_dir):
    """Datapoints per 100-second load window of a period: the flagship query."""
    points = to_points(records.in_period(alog(spark, sf_dir), FIRST, LAST))
    timed = points.select(F.timestamp_millis("timestamp").alias("timestamp"))
    return records.window_counts(timed)


@query("scan_alog", f"with {ALOG} select {ALL_COLUMNS} from alog")
def _(spark, sf_dir):
    def write(path):
        alog(spark, sf_dir).write.parquet(path)

    return scan_alog(spark, path=written_once(spark, sf_dir, "alog", write))


@query("scan_sql", f"""
    with {ALOG} select {ALL_COLUMNS} from alog
    where timestamp between '{FIRST}' and '{LAST}' and loghost = 'node2'""")
def _(spark, sf_dir):
    sql = (
        f"select * from ({ALOG_SELECT} {{events}}) where loghost = :host "
        "and timestamp between cast(:low as timestamp_ntz) and cast(:high as timestamp_ntz)"
    )
    return scan_sql(spark, sql, {"host": "node2", "low": FIRST, "high": LAST},
                    events=table(spark, sf_dir, "events"))


@query("in_period", f"with {ALOG} select {ALL_COLUMNS} from alog where {IN_PERIOD}")
def _(spark, sf_dir):
    return records.in_period(alog(spark, sf_dir), FIRST, LAST)


@query("in_period_reversed", f"with {ALOG} select id from alog where timestamp between '{LAST}' and '{FIRST}'")
def _(spark, sf_dir):
    return records.in_period(alog(spark, sf_dir), LAST, FIRST).select("id")


@query("until_delay", f"""
    with {ALOG} select id from alog where timestamp <= timestamp '{LAST}' - interval 100 second""")
def _(spark, sf_dir):
    return records.until_delay(alog(spark, sf_dir), datetime.fromisoformat(LAST)).select("id")


@query("window_counts", f"""
    with {ALOG}
    select strftime(make_timestamp(cast(floor(epoch(timestamp) / 100) as bigint) * 100000000), '%Y-%m-%d %H:%M:%S.%f') as past,
    strftime(make_timestamp(cast(floor(epoch(timestamp) / 100) as bigint) * 100000000 + 100000000), '%Y-%m-%d %H:%M:%S.%f') as present,
    count(*) as n from alog group by 1, 2""")
def _(spark, sf_dir):
    return records.window_counts(alog(spark, sf_dir))


@query("load_counts", f"""
    with {ALOG} select cast(date_trunc('day', timestamp) as date) as day, count(*) as rows_in,
    count(*) filter (where {FINITE}) as points_out from alog group by 1""")
def _(spark, sf_dir):
    return records.load_counts(alog(spark, sf_dir), F.to_date("timestamp").alias("day"))


@query("load_counts_total", f"""
    with {ALOG} select count(*) as rows_in, count(*) filter (where {FINITE}) as points_out from alog""")
def _(spark, sf_dir):
    return records.load_counts(alog(spark, sf_dir))


@query("head_rows", f"""
    with {ALOG} select id, {TIME_TEXT.format('timestamp')} as timestamp, keywvalue from alog
    order by alog.timestamp, id limit 60""")
def _(spark, sf_dir):
    return records.head_rows(alog(spark, sf_dir), "timestamp", "id").select("id", "timestamp", "keywvalue")


# Twelve hours before the first record: the gap is passed in whole windows.
@query("widen_gap", f"""
    with {ALOG}, f as (select min(timestamp) as first from alog where timestamp > '2023-12-31 12:00:00')
    select '2023-12-31 12:00:00.000000' as past, strftime(timestamp '2023-12-31 12:00:00'
      + to_seconds(cast(ceil(epoch_us(first - timestamp '2023-12-31 12:00:00') / 1e8) as bigint) * 100),
      '%Y-%m-%d %H:%M:%S.%f') as present from f where first is not null""")
def _(spark, sf_dir):
    return records.next_window(alog(spark, sf_dir), "2023-12-31 12:00:00")


# One progress row per 100-second window with rows, as a load by windows leaves them.
PROGRESS = f"""{ALOG}, progress as (select distinct 'present' as collector,
    make_timestamp(cast(floor(epoch(timestamp) / 100) as bigint) * 100000000) as past,
    make_timestamp(cast(floor(epoch(timestamp) / 100) as bigint) * 100000000 + 100000000) as present
    from alog)"""


def _progress(spark, sf_dir):
    windows = records.window_counts(alog(spark, sf_dir))
    utc = [F.col(c).cast("timestamp").alias(c) for c in ("past", "present")]
    return windows.select(
        F.lit("present").alias("collector"), *utc,
        F.col("present").cast("timestamp").alias("collector_piglet"),
        F.lit(NOW.isoformat(sep=" ")).cast("timestamp").alias("written_at"),
    )


@query("latest_progress", f"""
    with {PROGRESS} select {TIME_TEXT.format('max(present)')} as collector_piglet from progress""")
def _(spark, sf_dir):
    return accounting.latest_progress(_progress(spark, sf_dir), "present")


@query("earliest_progress", f"""
    with {PROGRESS} select {TIME_TEXT.format('min(present)')} as collector_piglet from progress""")
def _(spark, sf_dir):
    return accounting.earliest_progress(_progress(spark, sf_dir), "present")


@query("resume_present", f"""
    with {PROGRESS} select {TIME_TEXT.format("coalesce(max(present), timestamp '2024-01-31 23:58:20')")} as start
    from progress""")
def _(spark, sf_dir):
    return accounting.resume(_progress(spark, sf_dir), NOW, "present", "present")


# No collector of this name has run: the load starts from now.
@query("resume_backwards_first_run", f"""
    with {PROGRESS} select {TIME_TEXT.format("coalesce(min(present), timestamp '2024-02-01')")} as start
    from progress where collector = 'backwards'""")
def _(spark, sf_dir):
    return accounting.resume(_progress(spark, sf_dir), NOW, "backwards", "backwards")


@query("running_total", """
    select doc_id, n_chars, cast(sum(n_chars) over (order by doc_id) as bigint) as done from documents""")
def _(spark, sf_dir):
    sizes = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return accounting.running_total(sizes, "doc_id", "n_chars", "done")


# Text columns, found by type, and how many values of each are not empty.
@query("is_string", """
    select 'text' as name, count(*) filter (text <> '') as filled from documents
    union all select 'lang', count(*) filter (lang <> '') from documents
    union all select 'source', count(*) filter (source <> '') from documents""")
def _(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    names = [n for n in documents.columns if records.is_string(documents, n)]
    return documents.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), (F.col(n) != "").alias("has")) for n in names])).alias("c")).groupBy("c.name").agg(
        F.count_if("c.has").alias("filled"))


# Slices by the bounds of a sample: each row once, none with more than twice its share.
@query("equal_slices", f"with {ALOG} select count(*) as rows_in, cast(8 as bigint) as slices, true as fair from alog")
def _(spark, sf_dir):
    rows = alog(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    slices = equal_slices(rows.where("id % 3 = 0"), 8)
    number = F.array_position(F.array(*[F.coalesce(F.expr(s), F.lit(False)) for s in slices]), True)
    sizes = rows.groupBy(number.alias("slice")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.sum("n").alias("rows_in"), F.count_if(F.col("slice") > 0).alias("slices"),
                     (F.max("n") <= 2 * F.sum("n") / 8).alias("fair"))
