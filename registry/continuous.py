"""Batch loads by time and streaming loads, read back from the lake."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglake.operators import accounting, reconcile
from loglake.operators.documents import to_docs
from loglake.operators.records import finite, in_period
from loglake.plans import load
from loglake.session import new_path
from loglake.sinks import lake as tables
from loglake.schema import ALOG as ALOG_ROW, TAG_KEYS
from loglake.sources.polling import ParquetLog, poll_source
from loglake.streaming import present
from registry.base import (
    ALOG, EPOCH_MS, FINITE, FOLDED_POINTS, NOW, POINTS, TIME_TEXT, alog, alog_of, docs_sql, query, table,
    written_once,
)

MONTHLY_DOCS = docs_sql(suffix="strftime(timestamp, '%Y.%m')")
POINT_LIST = "name, timestamp, value, proc, env, loghost, logtext"
LOW, HIGH = datetime(2024, 1, 5), datetime(2024, 1, 12)
PERIOD = f"alog as (select * from alog0 where timestamp between '{LOW}' and '{HIGH}')"
ALOG0 = ALOG.replace("alog as", "alog0 as", 1)
# Every row of both stores as text, so that contents are compared and not counts.
POINT_ROW = ("name", "timestamp", "value", "proc", "env", "loghost", "logtext")
DOC_ROW = ("_index", "_id", "loghost", "envname", "procname", "procid", "module", "keywname", "keywvalue", "logtext",
           "errstack", "errstackidx", "errlocation", "errseverity")


def _sql_text(names):
    cells = [f"cast(cast({n} as decimal(18, 4)) as varchar)" if n == "value" else f"cast({n} as varchar)" for n in names]
    return f"concat_ws('|', {', '.join(cells)})"


STORES = f"""select 'points' as store, {_sql_text(POINT_ROW)} as stored_row from folded
    union all select distinct _type, {_sql_text(DOC_ROW)} from docs"""
FIRST_DAY = datetime(2024, 1, 1)


def _stores(spark, lake):
    """What each store holds: points, and documents by type."""
    tag = lambda n: F.col("tags").getItem(n) if n in TAG_KEYS else F.col(n)
    text = lambda c, n: c.cast("decimal(18,4)").cast("string") if n == "value" else c.cast("string")
    docs = tables.read_docs(spark, lake.docs).select(
        F.col("_type").alias("store"), F.concat_ws("|", *[text(F.col(n), n) for n in DOC_ROW]).alias("stored_row"))
    points = tables.read_points(spark, lake.points).select(
        F.lit("points").alias("store"), F.concat_ws("|", *[text(tag(n), n) for n in POINT_ROW]).alias("stored_row"))
    return points.unionByName(docs)


def _new_lake(spark):
    return tables.Lake(new_path(spark, "lake"))


@query("load_both", f"with {ALOG}, {POINTS}, {FOLDED_POINTS}, {MONTHLY_DOCS} {STORES}")
def _(spark, sf_dir):
    lake = _new_lake(spark)
    load.load_both(alog(spark, sf_dir), lake, NOW, persist=True)
    return _stores(spark, lake)


@query("load_period", f"with {ALOG0}, {PERIOD}, {MONTHLY_DOCS} select * from docs")
def _(spark, sf_dir):
    lake = _new_lake(spark)
    load.load_period(alog(spark, sf_dir), LOW, HIGH, lake, NOW)
    return tables.read_docs(spark, lake.docs)


@query("load_points_period", f"with {ALOG0}, {PERIOD}, {POINTS}, {FOLDED_POINTS} select {POINT_LIST} from folded")
def _(spark, sf_dir):
    lake = _new_lake(spark)
    load.load_points_period(alog(spark, sf_dir), LOW, HIGH, lake, NOW)
    return tables.read_points(spark, lake.points)


# (a, c] is (a, b] and (b, c], with the second load repeated.
@query("boundary_windows", f"with {ALOG0}, {PERIOD}, {POINTS}, {FOLDED_POINTS}, {MONTHLY_DOCS} {STORES}")
def _(spark, sf_dir):
    lake, records, middle = _new_lake(spark), alog(spark, sf_dir), datetime(2024, 1, 9)
    load.load_period(records, LOW, middle, lake, NOW)
    for _ in range(2):
        load.load_period(records, middle, HIGH, lake, NOW, include_low=False)
    return _stores(spark, lake)


# Two runs by steps of ten days: the second goes on where the first stopped.
@query("load_backwards", f"with {ALOG}, {POINTS}, {FOLDED_POINTS}, {MONTHLY_DOCS} {STORES}")
def _(spark, sf_dir):
    lake, records = _new_lake(spark), alog(spark, sf_dir)
    for stop in (datetime(2024, 1, 20), FIRST_DAY):
        load.load_backwards(records, stop, lake, NOW, step=timedelta(days=10))
    return _stores(spark, lake)


# Points first: the later load of both stores still has everything to do.
@query("points_then_docs_backwards", f"with {ALOG}, {POINTS}, {FOLDED_POINTS}, {MONTHLY_DOCS} {STORES}")
def _(spark, sf_dir):
    lake, records = _new_lake(spark), alog(spark, sf_dir)
    load.load_points_backwards(records, FIRST_DAY, lake, NOW, step=None)
    load.load_backwards(records, FIRST_DAY, lake, NOW, step=None)
    return _stores(spark, lake)


# A filter of the caller's own in a load of points only.
@query("load_points_period_custom", f"""
    with {ALOG0}, alog as (select * from alog0 where timestamp between '{LOW}' and '{HIGH}' and keywname like '%3'),
    {FOLDED_POINTS} select {POINT_LIST} from folded""")
def _(spark, sf_dir):
    lake = _new_lake(spark)
    spec = load.LoadSpec(data_filter=lambda df: finite(df) & F.col("keywname").endswith("3"))
    load.load_points_period(alog(spark, sf_dir), LOW, HIGH, lake, NOW, spec=spec)
    return tables.read_points(spark, lake.points)


# Records without a time are kept as rejects, whatever micro-batch they come in.
@query("load_present_rejects", f"""
    with {ALOG} select 'stored' as kind, count(*) as n from alog where id % 10 <> 0
    union all select 'rejected', count(*) from alog where id % 10 = 0""")
def _(spark, sf_dir):
    lake = _new_lake(spark)
    stream = _stream(spark, sf_dir).withColumn("timestamp", F.when(F.col("id") % 10 != 0, F.col("timestamp")))
    present.load_present(stream, lake, new_path(spark, "offsets"), clock=lambda: NOW, every=None).awaitTermination()
    count = lambda df, kind: df.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"))
    return count(tables.read_docs(spark, lake.docs), "stored").unionByName(
        count(tables.read_rejects(spark, lake.rejects), "rejected"))


@query("load_points_backwards", f"with {ALOG}, {POINTS}, {FOLDED_POINTS} select {POINT_LIST} from folded")
def _(spark, sf_dir):
    lake = _new_lake(spark)
    load.load_points_backwards(alog(spark, sf_dir), FIRST_DAY, lake, NOW, step=None)
    return tables.read_points(spark, lake.points)


def _logged(spark, sf_dir):
    """Run log and progress of a backwards load by steps of ten days."""

    def write(path):
        load.load_backwards(
            alog(spark, sf_dir), FIRST_DAY, tables.Lake(path), NOW, step=timedelta(days=10))

    return tables.Lake(written_once(spark, sf_dir, "logged", write))


@query("load_status", f"""
    with {ALOG} select true as ok, cast(4 as bigint) as loads, count(*) as rows_in,
    count(*) filter (where {FINITE}) as points_out, count(*) as docs_out from alog""")
def _(spark, sf_dir):
    return accounting.load_status(tables.read_run_log(spark, _logged(spark, sf_dir).run_log))


@query("read_progress", f"""
    with w as (select unnest(generate_series(0, 3)) as i), stops as (
        select timestamp '2024-02-01' - to_days(cast(i * 10 as integer)) as present,
        greatest(timestamp '2024-02-01' - to_days(cast(i * 10 + 10 as integer)), timestamp '2024-01-01') as past from w)
    select 'backwards' as collector, {TIME_TEXT.format('past')} as past, {TIME_TEXT.format('present')} as present,
    {TIME_TEXT.format('past')} as collector_piglet from stops where (select count(*) from events) > 0""")
def _(spark, sf_dir):
    return tables.read_progress(spark, _logged(spark, sf_dir).progress).drop("written_at")


# Follow the present with a late clock: three windows by catch-up, then nothing left.
@query("load_increment", f"""
    with {ALOG0}, alog as (select * from alog0 where timestamp > timestamp '2023-12-31 23:58:20'
    and timestamp <= timestamp '2024-01-31 23:58:20'),
    {POINTS}, {FOLDED_POINTS}, {MONTHLY_DOCS} {STORES}""")
def _(spark, sf_dir):
    lake, records = _new_lake(spark), alog(spark, sf_dir)
    tables.reset_progress(spark, lake.progress, "present", datetime(2023, 12, 31, 23, 58, 20), NOW)
    while load.load_increment(records, lake, NOW, catch_up_s=12 * 86_400) is not None:
        pass
    return _stores(spark, lake)


# --- streams ----------------------------------------------------------------------------------

def _stream(spark, sf_dir, files=4, files_per_batch=1):
    """The log table as a stream of files, in row groups that several tasks can share."""

    def write(path):
        table(spark, sf_dir, "events").repartitionByRange(files, "ts").write.option("parquet.block.size", 4 << 20).parquet(path)

    path = written_once(spark, sf_dir, "events-stream", write)
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option(
        "maxFilesPerTrigger", files_per_batch).parquet(path)
    return alog_of(spark, events)


@query("load_present", f"with {ALOG}, {POINTS}, {FOLDED_POINTS}, {MONTHLY_DOCS} {STORES}")
def _(spark, sf_dir):
    lake = _new_lake(spark)
    running = present.load_present(
        _stream(spark, sf_dir), lake, new_path(spark, "offsets"), clock=lambda: NOW, every=None)
    running.awaitTermination()
    return _stores(spark, lake)


@query("load_points_present", f"with {ALOG}, {POINTS}, {FOLDED_POINTS} select {POINT_LIST} from folded")
def _(spark, sf_dir):
    lake = _new_lake(spark)
    running = present.load_points_present(
        _stream(spark, sf_dir), lake, new_path(spark, "offsets"), clock=lambda: NOW, every=None)
    running.awaitTermination()
    return tables.read_points(spark, lake.points)


def _drained(stream, output_mode="append"):
    """All a stream gives, written to a table and read back."""
    spark = stream.sparkSession
    path = new_path(spark, "drained")
    writer = stream.writeStream.format("parquet").outputMode(output_mode).option(
        "checkpointLocation", new_path(spark, "offsets"))
    writer.trigger(availableNow=True).start(path).awaitTermination()
    return spark.read.parquet(path)


# The stream holds every file twice; each record comes out once.
@query("boundary_dedup_stream", f"with {ALOG} select id, {TIME_TEXT.format('timestamp')} as timestamp from alog")
def _(spark, sf_dir):
    def write(path):
        table(spark, sf_dir, "events").repartitionByRange(2, "ts").write.parquet(path)
        table(spark, sf_dir, "events").repartitionByRange(2, "ts").write.mode("append").parquet(path)

    path = written_once(spark, sf_dir, "events-twice", write)
    events = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(path)
    # Every record is in one micro-batch with its copy, so none is late.
    return _drained(present.boundary_dedup(alog_of(spark, events), "40 days").select("id", "timestamp"))


# A window is final once the watermark has passed its end; the last ones stay open. The files carry
# no order in time, so they make one micro-batch: none of them is late.
@query("windowed_counts_stream", f"""
    with {ALOG}, w as (select cast(floor(epoch(timestamp) / 100) as bigint) as w, count(*) as n from alog group by 1)
    select strftime(make_timestamp(w * 100000000), '%Y-%m-%d %H:%M:%S.%f') as past,
    strftime(make_timestamp((w + 1) * 100000000), '%Y-%m-%d %H:%M:%S.%f') as present, n from w
    where make_timestamp((w + 1) * 100000000) <=
      (select date_trunc('milliseconds', max(timestamp)) - interval 100 second from alog)""")
def _(spark, sf_dir):
    return _drained(present.windowed_counts(_stream(spark, sf_dir, files_per_batch=1000)))


# Followed up to the middle of the month, stopped, and followed to its end from the same checkpoint.
@query("poll_stream", f"with {ALOG} select id, {TIME_TEXT.format('timestamp')} as timestamp, loghost, typelog, keywvalue, logtext from alog")
def _(spark, sf_dir):
    columns = ["id", "timestamp", "loghost", "typelog", "keywvalue", "logtext"]
    log = written_once(spark, sf_dir, "polled-log", lambda path: alog(spark, sf_dir).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp")).repartitionByRange(8, "timestamp").write.parquet(path))
    schema = T.StructType([f for f in ALOG_ROW.fields if f.name in columns])
    path, offsets = new_path(spark, "polled"), new_path(spark, "offsets")
    for now in (datetime(2024, 1, 15), NOW):
        rows = poll_source(spark, ParquetLog(log), schema, delay_s=0, slice_s=3 * 86_400, clock=lambda now=now: now)
        rows.writeStream.format("parquet").option("checkpointLocation", offsets).trigger(availableNow=True).start(
            path).awaitTermination()
    return spark.read.schema(schema).parquet(path).select(*columns)


# --- late rows --------------------------------------------------------------------------------

def _without_late(spark, sf_dir):
    return alog(spark, sf_dir).where("id % 37 <> 5")


# Rows that come after their window was loaded: the windows that differ are loaded again.
@query("load_late", f"with {ALOG0}, alog as (select * from alog0 where timestamp >= '{LOW}' and timestamp < '{HIGH}'),"
       f" {POINTS}, {FOLDED_POINTS}, {MONTHLY_DOCS} {STORES}")
def _(spark, sf_dir):
    lake = _new_lake(spark)
    window = _without_late(spark, sf_dir).where((F.col("timestamp") >= F.lit(str(LOW))) & (F.col("timestamp") < F.lit(str(HIGH))))
    load.load_both(window, lake, NOW)
    counts = load.load_late(alog(spark, sf_dir), lake, LOW, HIGH, datetime(2024, 2, 2))
    if load.load_late(alog(spark, sf_dir), lake, LOW, HIGH, datetime(2024, 2, 3))["windows"] or not counts["windows"]:
        raise ValueError("late rows are left")
    return _stores(spark, lake)


@query("late_windows", f"""
    with {ALOG}, w as (select *, cast(floor((epoch_us(timestamp) - epoch_us(timestamp '{LOW}')) / 3600000000) as bigint) as w
        from alog where timestamp >= '{LOW}' and timestamp < '{HIGH}')
    select w as "window", count(*) as source_rows, count(*) filter (id % 37 <> 5) as stored_rows from w group by w
    having count(*) filter (id % 37 = 5) > 0""")
def _(spark, sf_dir):
    period = lambda df: in_period(df, LOW, HIGH, include_high=False)
    return reconcile.differing_windows(
        reconcile.record_ids(period(alog(spark, sf_dir)), LOW, 3600),
        reconcile.record_ids(period(_without_late(spark, sf_dir)), LOW, 3600))


# --- loads of the caller's own ------------------------------------------------------------------

# A builder with an index of its own and a writer that also keeps the hosts elsewhere.
@query("load_custom_docs", f"""
    with {ALOG}, {docs_sql("audit")}, hosts as (select distinct loghost from alog)
    select _index, loghost, count(*) as n from docs where _type = 'err' group by all
    union all select 'hosts', loghost, 1 from hosts""")
def _(spark, sf_dir):
    lake, hosts = _new_lake(spark), new_path(spark, "hosts")

    def writer(docs, path, load_time):
        docs.select("loghost").distinct().write.parquet(hosts)
        return tables.write_docs(docs, path, load_time)

    spec = load.LoadSpec(targets=("docs",), doc_builder=lambda rows: to_docs(rows, index="audit"), docs_writer=writer)
    load.load_both(alog(spark, sf_dir), lake, NOW, spec)
    docs = tables.read_docs(spark, lake.docs, doc_type="err").groupBy("_index", "loghost").agg(F.count(F.lit(1)).alias("n"))
    return docs.unionByName(spark.read.parquet(hosts).select(F.lit("hosts").alias("_index"), "loghost", F.lit(1).cast("long").alias("n")))


# A store that fails after the datapoints are written: no progress, a run that says so, and nothing twice after the repeat.
@query("delivery_rule", f"""
    with {ALOG0}, {PERIOD}, {POINTS}, {FOLDED_POINTS}
    select 'INFO' as level, true as ok, count(*) as rows_in, (select count(*) from folded) as stored_points, cast(1 as bigint) as progress from alog
    union all select 'ERROR', false, null, (select count(*) from folded), 0 where (select count(*) from alog) > 0""")
def _(spark, sf_dir):
    lake = _new_lake(spark)

    def fail(*_):
        raise OSError("the document store is gone")

    seen = []
    for spec, now in ((load.LoadSpec(docs_writer=fail), NOW), (load.LoadSpec(), datetime(2024, 2, 2))):
        try:
            load.load_period(alog(spark, sf_dir), LOW, HIGH, lake, now, spec=spec)
        except OSError:
            pass
        seen.append((tables.read_points(spark, lake.points).count(), tables.read_progress(spark, lake.progress).count()))
    log = tables.read_run_log(spark, lake.run_log)
    at = lambda i: F.when(F.col("ok"), seen[1][i]).otherwise(seen[0][i]).cast("long")
    return log.select("level", "ok", "rows_in", at(0).alias("stored_points"), at(1).alias("progress"))
