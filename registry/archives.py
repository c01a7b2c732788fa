"""CSV archives: the log table written as gzip latin-1 files, read back and loaded."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from loglake.operators import accounting, files
from loglake.operators.documents import to_docs
from loglake.operators.points import to_points
from loglake.operators.records import in_period
from loglake.plans import archives as plans
from loglake.schema import CSV_TO_ALOG, OPS_CSV
from loglake.session import new_path
from loglake.sinks import ledger
from loglake.sinks.exports import write_ops_csv
from loglake.sinks.lake import Lake, read_docs, read_points, read_rejects
from loglake.sources import archives as sources
from registry.base import (
    FOLDED_POINTS, NOW, POINTS, SECONDS, TIME_TEXT, alog_seconds, docs_sql, query, table, written_once,
)
from registry.continuous import STORES, _stores

CSV_FIELDS = f"""typelog, {TIME_TEXT.format('timestamp')} as tm, loghost, env, procname, procid, module,
    keywname as keyw, keywvalue as keyv, logtext, errstack, errstackidx, errlocation, errseverity"""
POINT_LIST = "name, timestamp, value, proc, env, loghost, logtext"
MONTH = "strftime(timestamp, '%Y.%m')"


def _csv_shape(records):
    to_csv = {target: source for source, target in CSV_TO_ALOG.items()}
    return records.withColumnsRenamed(to_csv).select(*OPS_CSV.names)


def _archive(spark, sf_dir):
    """One directory of files per day, named by its date."""

    def write(path):
        rows = _csv_shape(alog_seconds(spark, sf_dir)).withColumn("date", F.date_format("tm", "yyyy-MM-dd"))
        write_ops_csv(rows.hint("rebalance", "date"), path, partition_by=["date"])

    return written_once(spark, sf_dir, "archive", write)


def _files_of(spark, sf_dir, days):
    return f"{_archive(spark, sf_dir)}/date={days}/*.csv.gz"


@query("read_ops_csv", f"with {SECONDS} select {CSV_FIELDS} from alog")
def _(spark, sf_dir):
    rows = sources.read_ops_csv(spark, _files_of(spark, sf_dir, "*"))
    return rows.na.fill("").select(*OPS_CSV.names)


@query("read_ops_csv_columns", f"""
    with {SECONDS}, csv as (select {CSV_FIELDS} from alog)
    select typelog, tm, loghost, env, procname, procid, module, keyw, keyv, logtext from csv""")
def _(spark, sf_dir):
    rows = sources.read_ops_csv(spark, _files_of(spark, sf_dir, "*"), columns=sources.SLIM_COLUMNS)
    return rows.na.fill("").select(*sources.SLIM_COLUMNS)


# Several globs at once, with the file each row came from.
@query("read_ops_csv_paths", f"""
    with {SECONDS} select strftime(timestamp, '%Y-%m-%d') as day, count(*) as n from alog
    where day(timestamp) < 10 or day(timestamp) between 20 and 29 group by 1""")
def _(spark, sf_dir):
    paths = [_files_of(spark, sf_dir, days) for days in ("2024-01-0?", "2024-01-2?")]
    day = F.regexp_extract("file_path", "date=([0-9-]+)", 1)
    return sources.read_ops_csv(spark, paths, columns=("tm",)).groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n"))


@query("read_ops_csv_partitions", f"with {SECONDS} select {CSV_FIELDS} from alog")
def _(spark, sf_dir):
    rows = sources.read_ops_csv(spark, _archive(spark, sf_dir), partitions=16, recursive=True)
    return rows.na.fill("").select(*OPS_CSV.names)


# Free text of several languages with line breaks, as the text of a log record.
@query("csv_text_round_trip", r"""
    select doc_id as procid, regexp_replace(text, '[^\x00-\x{ff}]', '?', 'g') as logtext from documents""")
def _(spark, sf_dir):
    def write(path):
        texts = table(spark, sf_dir, "documents").select(
            *[F.lit(None).cast(f.dataType).alias(f.name) if f.name not in ("procid", "logtext")
              else F.col("doc_id" if f.name == "procid" else "text").alias(f.name)
              for f in OPS_CSV.fields])
        write_ops_csv(texts, path)

    path = written_once(spark, sf_dir, "csv-texts", write)
    return sources.read_ops_csv(spark, path, columns=("procid", "logtext")).select("procid", "logtext")


@query("normalise_csv", f"""
    with {SECONDS} select * exclude (id) replace ({TIME_TEXT.format('timestamp')} as timestamp) from alog""")
def _(spark, sf_dir):
    return plans.csv_records(spark, _files_of(spark, sf_dir, "*")).drop("file_path")


@query("csv_to_points", f"with {SECONDS}, {POINTS} select {POINT_LIST} from points")
def _(spark, sf_dir):
    return to_points(plans.csv_records(spark, _files_of(spark, sf_dir, "*")))


@query("csv_to_docs", f"with {SECONDS}, {docs_sql()} select * from docs")
def _(spark, sf_dir):
    return to_docs(plans.csv_records(spark, _files_of(spark, sf_dir, "*")))


# The sizes are those of the files this run has written; SQL can say how many there are and what holds.
@query("file_progress", f"""
    with {SECONDS} select strftime(timestamp, '%Y-%m-%d') as day, cast(1 as bigint) as files, true as summed
    from alog group by 1""")
def _(spark, sf_dir):
    listed = sources.list_files(spark, _files_of(spark, sf_dir, "*"))
    progress = accounting.file_progress(listed)
    before = listed.alias("b").join(progress.alias("p"), F.col("b.file_path") <= F.col("p.file_path")).groupBy(
        "p.file_path", "p.done_bytes", "p.total_bytes").agg(F.sum("b.file_size").alias("sum"))
    whole = listed.agg(F.sum("file_size")).scalar()
    day = F.regexp_extract("file_path", "date=([0-9-]+)", 1)
    holds = (F.col("sum") == F.col("done_bytes")) & (F.col("total_bytes") == whole)
    return before.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("files"), F.bool_and(holds).alias("summed"))


# Without the names of the files this run has written: one file per day.
@query("last_row_per_file", f"""
    with {SECONDS} select strftime(timestamp, '%Y-%m-%d') as day, {TIME_TEXT.format('max(timestamp)')} as timestamp,
    arg_max(loghost, (timestamp, loghost, logtext)) as loghost,
    arg_max(logtext, (timestamp, loghost, logtext)) as logtext from alog group by 1""")
def _(spark, sf_dir):
    last = files.last_row_per_file(plans.csv_records(spark, _files_of(spark, sf_dir, "*")))
    day = F.regexp_extract("file_path", "date=([0-9-]+)", 1)
    return last.select(day.alias("day"), "timestamp", "loghost", "logtext")


# --- which files are loaded -------------------------------------------------------------------

# One file per host and day; the documents hold everything up to noon of the 16th.
LOADED_UNTIL = "2024-01-16 12:00:00"
LOOKUP = f"""{SECONDS},
    last as (select concat('/archive/', loghost, '.', strftime(timestamp, '%Y-%m-%d'), '.csv.gz') as file_path,
        arg_max(struct_pack(t := timestamp, h := loghost, l := logtext), (timestamp, loghost, logtext)) as r
        from alog group by 1),
    status as (select file_path, exists(select 1 from alog a where a.timestamp <= '{LOADED_UNTIL}'
        and a.timestamp = last.r.t and a.loghost = last.r.h and a.logtext = last.r.l) as loaded from last)"""


def _last_rows(spark, sf_dir):
    path = F.concat(F.lit("/archive/"), "loghost", F.lit("."), F.date_format("timestamp", "yyyy-MM-dd"),
                    F.lit(".csv.gz"))
    return files.last_row_per_file(alog_seconds(spark, sf_dir).withColumn("file_path", path))


def _loaded_docs(spark, sf_dir):
    return to_docs(in_period(alog_seconds(spark, sf_dir), "2024-01-01", LOADED_UNTIL), frequency="MONTHLY")


@query("already_loaded", f"with {LOOKUP} select file_path from status where loaded")
def _(spark, sf_dir):
    return files.already_loaded(
        _last_rows(spark, sf_dir), _loaded_docs(spark, sf_dir), plans.csv_indexes("logs", "MONTHLY")
    ).select("file_path")


@query("files_to_load", f"with {LOOKUP} select file_path from status where not loaded")
def _(spark, sf_dir):
    return files.files_to_load(
        _last_rows(spark, sf_dir), _loaded_docs(spark, sf_dir)).select("file_path")


@query("files_to_load_reinsert", f"with {LOOKUP} select file_path from status")
def _(spark, sf_dir):
    return files.files_to_load(
        _last_rows(spark, sf_dir), _loaded_docs(spark, sf_dir), reinsert=True).select("file_path")


# --- loads ------------------------------------------------------------------------------------

@query("load_csv_points", f"with {SECONDS}, {POINTS}, {FOLDED_POINTS} select {POINT_LIST} from folded")
def _(spark, sf_dir):
    lake = Lake(new_path(spark, "lake"))
    plans.load_csv_points(spark, _files_of(spark, sf_dir, "*"), lake, NOW)
    return read_points(spark, lake.points)


# The first half of the month, then all files: the second load opens the new ones only.
@query("load_csv_docs", f"with {SECONDS}, {docs_sql(suffix=MONTH)} select * from docs")
def _(spark, sf_dir):
    lake = Lake(new_path(spark, "lake"))
    plans.load_csv_docs(spark, _files_of(spark, sf_dir, "2024-01-[01]?"), lake, NOW)
    plans.load_csv_docs(spark, _files_of(spark, sf_dir, "*"), lake, datetime(2024, 2, 2))
    return read_docs(spark, lake.docs, latest=False)


@query("load_csv_both", f"""
    with {SECONDS}, {POINTS}, {FOLDED_POINTS}, {docs_sql(suffix=MONTH)} {STORES}""")
def _(spark, sf_dir):
    lake = Lake(new_path(spark, "lake"))
    for _ in range(2):
        plans.load_csv_both(spark, _files_of(spark, sf_dir, "*"), lake, NOW, reinsert=True)
    return _stores(spark, lake)


# An ending of the caller's own, whatever the dates.
@query("load_csv_docs_suffix", f"with {SECONDS}, {docs_sql(suffix=repr('batch7'))} select * from docs")
def _(spark, sf_dir):
    lake = Lake(new_path(spark, "lake"))
    for _ in range(2):
        plans.load_csv_docs(spark, _files_of(spark, sf_dir, "*"), lake, NOW, suffix="batch7")
    return read_docs(spark, lake.docs, latest=False)


# --- rows and files that cannot be read -------------------------------------------------------

BROKEN = "id % 10 = 3"


def _broken(spark, sf_dir):
    """Archive lines of which each tenth has a time that does not parse."""

    def write(path):
        rows = alog_seconds(spark, sf_dir).withColumn("bad", F.expr(BROKEN))
        good = _csv_shape(rows.where(~F.col("bad")))
        write_ops_csv(good, f"{path}/good")
        rows.where("bad").select(F.concat(F.lit("FPAR,not a time,"), F.col("id").cast("string")).alias("value")).write.option(
            "compression", "gzip").text(f"{path}/bad")

    return [f"{written_once(spark, sf_dir, 'broken', write)}/{part}" for part in ("good", "bad")]


@query("csv_rejects", f"""
    with {SECONDS} select 'FPAR,not a time,' || cast(id as varchar) as record, 'malformed' as reason from alog where {BROKEN}
    union all select 'stored', cast(count(*) as varchar) from alog where not ({BROKEN})""")
def _(spark, sf_dir):
    lake = Lake(new_path(spark, "lake"))
    counts = plans.load_csv_docs(spark, _broken(spark, sf_dir), lake, NOW, multi_line=False)
    stored = read_docs(spark, lake.docs).agg(F.lit("stored").alias("record"), F.count(F.lit(1)).cast("string").alias("reason"))
    rejects = read_rejects(spark, lake.rejects).select("record", "reason")
    if counts["rejected"] + counts["docs_out"] != rejects.count() + read_docs(spark, lake.docs).count():
        raise ValueError(f"rows went missing: {counts}")
    return rejects.unionByName(stored)


# The files without one readable time are among those to load, those without a row are not.
@query("files_to_load_unreadable", f"""
    with {SECONDS} select 'bad' as part, count(*) > 0 as listed from alog where {BROKEN}
    union all select 'good', false where (select count(*) from alog) > 0""")
def _(spark, sf_dir):
    records = plans.csv_records(spark, _broken(spark, sf_dir), multi_line=False)
    new = files.files_to_load(files.last_row_per_file(records, untimed=True), to_docs(records))
    part = F.regexp_extract("file_path", "/(good|bad)/", 1)
    names = spark.range(2).select(F.when(F.col("id") == 0, "good").otherwise("bad").alias("part"))
    return names.join(new.select(part.alias("part"), F.lit(True).alias("listed")).distinct(), "part", "left").na.fill(False)


# The first nine days loaded, and three times a directory with unreadable lines, of which nothing is kept twice.
@query("files_ledger", f"""
    with {SECONDS} select strftime(timestamp, '%Y-%m-%d') as part, case when day(timestamp) < 10 then 'loaded' else 'new' end as status,
    count(*) filter (day(timestamp) < 10) as rows_in, cast(0 as bigint) as rejects from alog group by 1, 2
    union all select case when {BROKEN} then 'bad' else 'good' end, 'loaded', count(*), count(*) filter ({BROKEN}) from alog group by 1""")
def _(spark, sf_dir):
    lake, broken = Lake(new_path(spark, "lake")), _broken(spark, sf_dir)
    plans.load_csv_docs(spark, _files_of(spark, sf_dir, "2024-01-0?"), lake, NOW)
    for day in (2, 3, 4):
        plans.load_csv_docs(spark, broken, lake, datetime(2024, 2, day), multi_line=False)
    listed = sources.fingerprints(spark, _files_of(spark, sf_dir, "*")).unionByName(
        sources.fingerprints(spark, [f"{p}/*.gz" for p in broken]))
    entries = ledger.read_ledger(spark, lake.ledger)
    states = ledger.file_states(listed, entries, ("docs",), datetime(2024, 2, 5))
    held = ledger.loaded_files(entries).select("file_path", "rows_in")
    rejects = ledger.current_rejects(spark, lake).groupBy("file_path").agg(F.sum("copies").alias("rejects"))
    part = F.regexp_extract("file_path", "(?:date=|broken[^/]*/)([0-9-]+|good|bad)/", 1)
    return states.join(held, "file_path", "left").join(rejects, "file_path", "left").groupBy(part.alias("part"), "status").agg(
        F.coalesce(F.sum("rows_in"), F.lit(0)).alias("rows_in"), F.coalesce(F.sum("rejects"), F.lit(0)).alias("rejects"))
