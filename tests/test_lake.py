from __future__ import annotations

import os
import re
import time
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loglake.operators import accounting, files
from loglake.operators.documents import to_docs, upsert_docs
from loglake.operators.points import to_points
from loglake.plans import archives, load
from loglake.schema import CSV_TO_ALOG, OPS_CSV
from loglake.session import new_path, shared_dir
from loglake.sinks import exports, lake as tables
from loglake.sources import archives as csv
from loglake.sources.database import jdbc_options, scan_alog, scan_sql
from loglake.streaming import present
from samples import GOLDEN, alog, plan_of, record

NOW = datetime(2024, 2, 1)
START = datetime(2024, 1, 1)


def series(spark, n=300, step_s=600):
    """Records ten minutes apart, each fourth not numeric."""
    return alog(spark, [
        record(id=i, timestamp=START + timedelta(seconds=i * step_s), keywvalue="ON" if i % 4 == 0 else str(i))
        for i in range(n)])


@pytest.fixture
def lake(spark):
    return tables.Lake(new_path(spark, "lake"))


def contents(spark, lake):
    points = {(r["name"], r["timestamp"], r["value"]) for r in tables.read_points(spark, lake.points).collect()}
    docs = {r["_id"] for r in tables.read_docs(spark, lake.docs).collect()}
    return points, docs


def test_shared_dir_is_the_session_setting(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_second_load_changes_nothing(spark, lake):
    records = series(spark)
    counts = load.load_both(records, lake, NOW)
    assert counts == {"rows_in": 300, "points_out": 225, "docs_out": 300}
    once = contents(spark, lake)
    load.load_both(records, lake, NOW + timedelta(hours=1), persist=True)
    assert contents(spark, lake) == once
    assert tables.read_points(spark, lake.points, latest=False).count() == 450
    tables.compact_points(spark, lake.points, [date(2024, 1, 1)])
    tables.compact_points(spark, lake.points, [date(2024, 1, d) for d in (2, 3)])
    tables.compact_docs(spark, lake.docs, ["logs-2024.01", "opslog-2024.01", "fpar-2024.01"])
    assert tables.read_points(spark, lake.points, latest=False).count() == 225
    assert tables.read_docs(spark, lake.docs, latest=False).count() == 300
    assert contents(spark, lake) == once


def test_reads_skip_other_days_and_columns(spark, lake):
    load.load_both(series(spark), lake, NOW)
    day = 1704067200000
    plan = tables.read_points(spark, lake.points, "HALL_PRESSURE", day, day + 1000)
    text = plan_of(plan)
    assert "PartitionFilters: [isnotnull(day" in text
    slim = tables.read_docs(spark, lake.docs, "opslog-2024.01", columns=["loghost"])
    schema = plan_of(slim).split("ReadSchema")[1]
    assert "loghost" in schema and "logtext" not in schema


@settings(max_examples=2, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.integers(0, 180000), st.integers(0, 180000))
def test_a_period_is_the_sum_of_its_parts(spark, x, y):
    low, high = START, START + timedelta(seconds=180000)
    a, b = sorted((START + timedelta(seconds=x), START + timedelta(seconds=y)))
    records = series(spark)
    whole, parts = (tables.Lake(new_path(spark, "lake")) for _ in range(2))
    load.load_period(records, low, high, whole, NOW)
    load.load_period(records, a, low, parts, NOW)
    load.load_period(records, a, b, parts, NOW, include_low=False)
    load.load_period(records, b, high, parts, NOW, include_low=False)
    assert contents(spark, whole) == contents(spark, parts)


def test_backwards_resumes(spark, lake):
    records = series(spark)
    stop = START + timedelta(days=1)
    done = load.load_backwards(records, stop, lake, datetime(2024, 1, 4), step=timedelta(days=1))
    assert [d["rows_in"] for d in done] == [12, 144]
    assert load.load_backwards(records, stop, lake, NOW) == []
    rest = load.load_backwards(records, START, lake, NOW, step=None)
    assert [d["rows_in"] for d in rest] == [144]
    assert len(contents(spark, lake)[1]) == 300
    status = accounting.load_status(tables.read_run_log(spark, lake.run_log)).first()
    assert (status["ok"], status["loads"], status["rows_in"]) == (True, 3, 300)


def test_points_only_loads_write_no_documents(spark, lake):
    load.load_points_period(series(spark), NOW, START, lake, NOW)
    assert tables.read_points(spark, lake.points).count() == 225
    log = tables.read_run_log(spark, lake.run_log).first()
    assert (log["points_out"], log["docs_out"], log["rows_in"]) == (225, 0, None)


def test_increment_waits_for_rows_and_for_the_delay(spark, lake):
    records = series(spark, 10)
    assert load.load_increment(records, lake, START, 100) is None
    now = START + timedelta(minutes=30)
    first = load.load_increment(records, lake, now, 100)
    assert first is None  # progress begins 100 s before now, and so does the delay
    tables.reset_progress(spark, lake.progress, "present", START - timedelta(days=3), START)
    assert load.load_increment(records, lake, now, 100, catch_up_s=600)["rows_in"] == 2
    assert load.load_increment(records, lake, now, 100)["rows_in"] == 1
    assert load.load_increment(records, lake, now, 0)["rows_in"] == 1
    assert load.load_increment(records, lake, now, 0) is None


def test_progress_and_reset(spark, lake):
    def write(piglet, at):
        tables.write_progress(spark, lake.progress, "c", piglet, piglet, piglet, at)

    def start(direction):
        row = accounting.resume(tables.read_progress(spark, lake.progress), NOW, direction, "c").select(
            F.date_format("start", "yyyy-MM-dd HH:mm:ss")).first()
        return row[0]

    assert (start("present"), start("backwards")) == ("2024-01-31 23:58:20", "2024-02-01 00:00:00")
    for i in (3, 9, 5):
        write(datetime(2024, 1, i), datetime(2024, 1, 10))
    assert (start("present"), start("backwards")) == ("2024-01-09 00:00:00", "2024-01-03 00:00:00")
    tables.reset_progress(spark, lake.progress, "c", datetime(2024, 1, 6), datetime(2024, 1, 11))
    assert (start("present"), start("backwards")) == ("2024-01-06 00:00:00", "2024-01-06 00:00:00")


def test_delete_empties_a_day(spark, lake):
    load.load_both(series(spark), lake, NOW)
    day = 1704067200000
    tables.delete_stored_points(spark, lake.points, ["HALL_PRESSURE"], day, day + 86_399_999)
    left = tables.read_points(spark, lake.points)
    assert left.count() == 225 - 108
    assert left.agg(F.min("timestamp")).first()[0] >= day + 86_400_000
    tables.delete_stored_points(spark, lake.points, ["HALL_PRESSURE"], tags={"env": "none"})
    assert tables.read_points(spark, lake.points).count() == 225 - 108
    tables.delete_stored_points(spark, lake.points, ["HALL_PRESSURE"])
    assert tables.read_points(spark, lake.points).count() == 0
    tables.fold_deletes(spark, lake.points)
    assert tables.read_points(spark, lake.points, latest=False).count() == 0
    assert tables.stored_deletes(spark, lake.points) is None


def test_caller_supplied_steps(spark, lake):
    taken = []

    def writer(df, path, now):
        taken.append((path, df.count()))
        return taken[-1][1]

    spec = load.LoadSpec(
        data_filter=lambda df: F.col("keywvalue") == "ON",
        data_parser=lambda df: df.select("id"),
        doc_builder=lambda df: df.select("id"), points_writer=writer, docs_writer=writer)
    counts = load.load_both(series(spark), lake, NOW, spec)
    assert taken == [(lake.points, 75), (lake.docs, 300)]
    assert counts["points_out"] == 75


def test_running_total_over_many_ranges(spark):
    rows = spark.range(1000).select(F.format_string("f%05d", F.col("id") * 37 % 1000).alias("path"), F.col("id").alias("size"))
    got = accounting.running_total(rows, "path", "size", "done").orderBy("path").collect()
    done = 0
    for row in got:
        done += row["size"]
        assert row["done"] == done


# --- archives ---------------------------------------------------------------------------------

def as_csv(records):
    return records.withColumnsRenamed({v: k for k, v in CSV_TO_ALOG.items()}).select(*OPS_CSV.names)


def csv_file(spark, tmp_path, name, rows):
    """One gzip file under a given name."""
    folder = tmp_path / (name.replace("/", "_") + ".parts")
    exports.write_ops_csv(as_csv(alog(spark, rows)).coalesce(1), str(folder))
    (part,) = folder.glob("*.csv.gz")
    target = tmp_path / name
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(part.read_bytes())
    return str(target)


def test_csv_round_trip(spark, tmp_path):
    rows = [record(), record(keywvalue="ON", module=""), record(logtext='Señal "ñ", línea\n2 \\ fin'),
            record(logtext="x", timestamp=datetime(2016, 1, 5, 1, 2, 3))]
    path = csv_file(spark, tmp_path, "2016-1-5/hist.csv.gz", rows)
    back = archives.csv_records(spark, path)
    want = alog(spark, rows).drop("id")
    assert sorted(map(tuple, back.drop("file_path").select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert [r[0] for r in back.select("file_path").distinct().collect()][0].endswith("2016-1-5/hist.csv.gz")


def test_bad_csv_cells_do_not_fail_the_read(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text('FPAR,not a time,h,e,p,many,,k,1,"t",,x,,\nshort,row\n\n')
    rows = csv.normalise_csv(csv.read_ops_csv(spark, str(path))).collect()
    assert [(r["typelog"], r["timestamp"], r["procid"], r["logtext"]) for r in rows] == [
        ("FPAR", None, None, "t"), ("short", None, None, "")]


def test_only_new_files_are_loaded(spark, tmp_path, lake):
    first = csv_file(spark, tmp_path, "a[1].2016-01-05.csv.gz", [record(logtext="one"), record(logtext="two")])
    assert archives.load_csv_docs(spark, first.replace("[", "\\[").replace("]", "\\]"), lake, NOW)["docs_out"] == 2
    csv_file(spark, tmp_path, "b c.2016-2-05.csv.gz", [record(keywvalue="ON", logtext="three")])
    everything = str(tmp_path / "*.csv.gz")
    assert archives.load_csv_docs(spark, everything, lake, NOW)["docs_out"] == 1
    assert archives.load_csv_docs(spark, everything, lake, NOW)["docs_out"] == 0
    assert archives.load_csv_both(spark, everything, lake, NOW, reinsert=True) == {
        "rows_in": 3, "points_out": 2, "docs_out": 3, "rejected": 0}
    docs = tables.read_docs(spark, lake.docs).groupBy("_index").count().collect()
    assert {r["_index"]: r["count"] for r in docs} == {"opslog-2016.01": 2, "logs-2016.2": 1}


def test_one_file_can_hold_most_rows(spark):
    """A hot file, and many copies of its last row, still give one answer per file."""
    rows = alog(spark, [record(id=i) for i in range(500)]).withColumn(
        "file_path", F.when(F.col("id") < 400, "hot").otherwise(F.concat(F.lit("f"), F.col("id").cast("string"))))
    last = files.last_row_per_file(rows)
    assert last.count() == 101
    docs = to_docs(rows)
    assert files.already_loaded(last, docs).count() == 101
    assert files.files_to_load(last, docs).count() == 0
    assert files.files_to_load(last, docs.where("loghost = 'none'")).count() == 101


def test_list_files_reads_no_content(spark, tmp_path):
    csv_file(spark, tmp_path, "x.2016-01-05.csv.gz", GOLDEN)
    (row,) = csv.list_files(spark, str(tmp_path), "*.csv.gz").collect()
    assert row["file_size"] == (tmp_path / "x.2016-01-05.csv.gz").stat().st_size


# --- database ---------------------------------------------------------------------------------

def test_jdbc_options():
    plain = jdbc_options("jdbc:postgresql://h/alog", fetchsize=10, user="reader")
    assert plain == {"url": "jdbc:postgresql://h/alog", "dbtable": "alog", "fetchsize": "10", "user": "reader"}
    assert jdbc_options("u", query="select 1")["query"] == "select 1"
    sliced = jdbc_options("u", query="select 1", partitions=4, lower=START, upper=NOW)
    assert sliced["dbtable"] == "(select 1) q" and "query" not in sliced
    assert (sliced["partitionColumn"], sliced["lowerBound"], sliced["numPartitions"]) == (
        "timestamp", "2024-01-01 00:00:00", "4")


def test_slices_need_their_bounds():
    with pytest.raises(ValueError):
        jdbc_options("u", partitions=4)
    with pytest.raises(ValueError):
        jdbc_options("u", partitions=4, lower=START)


def test_no_row_is_lost_without_names_times_or_types(spark, lake, tmp_path):
    rows = [record(id=1, keywname=None), record(id=2, keywname="", logtext="other"), record(id=3, typelog=None, keywvalue="x"),
            record(id=4, typelog="", keywvalue="y"), record(id=5, env=None, logtext=None)]
    counts = load.load_both(alog(spark, rows), lake, NOW)
    assert counts["docs_out"] == 5 == tables.read_docs(spark, lake.docs).count()
    assert tables.read_docs(spark, lake.docs, doc_type="untyped").count() == 2
    assert counts["points_out"] == 3 == tables.read_points(spark, lake.points).count()
    path = tmp_path / "x.2024-01-05.csv"
    path.write_text('FPAR,2024-01-05 00:00:00,h,e,p,1,,k,1,"t",,0,,\nFPAR,not a time,h,e,p,1,,k,1,"t",,0,,\nshort,row\nFPAR,,h,e,p,1,,k,1,"t",,0,,\n')
    other = tables.Lake(new_path(spark, "lake"))
    counts = archives.load_csv_both(spark, str(path), other, NOW)
    assert (counts["docs_out"], counts["rejected"]) == (1, 3)
    assert sorted(r["reason"] for r in tables.read_rejects(spark, other.rejects).collect()) == ["malformed", "malformed", "no time"]


def test_days_and_ids_do_not_depend_on_the_session_zone(spark, lake):
    records = series(spark, 30)
    held = new_path(spark, "records")
    records.write.parquet(held)
    ids = {r["_id"] for r in to_docs(records).collect()}
    spark.conf.set("spark.sql.session.timeZone", "America/Santiago")
    try:
        records = spark.read.parquet(held)
        assert {r["_id"] for r in to_docs(records).collect()} == ids
        tables.write_points(to_points(records), lake.points, NOW)
        low = 1704067200000
        assert tables.read_points(spark, lake.points, start_ms=low, end_ms=low + 3_600_000).count() == 5
        tables.delete_stored_points(spark, lake.points, ["HALL_PRESSURE"], low, low + 3_600_000)
        assert tables.read_points(spark, lake.points, start_ms=low, end_ms=low + 3_600_000).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_the_last_record_of_a_second_stays(spark, lake):
    rows = [record(id=1, timestamp=datetime(2024, 1, 1, 0, 0, 0, 100_000), keywvalue="5"),
            record(id=2, timestamp=datetime(2024, 1, 1, 0, 0, 0, 900_000), keywvalue="3")]
    load.load_both(alog(spark, rows), lake, NOW)
    assert [r["value"] for r in tables.read_points(spark, lake.points).collect()] == [3.0]


def test_points_only_progress_hides_nothing(spark, lake):
    records = series(spark, 48)
    load.load_points_backwards(records, START, lake, NOW, step=None, spec=load.LoadSpec(host="h"))
    assert sum(d["docs_out"] for d in load.load_backwards(records, START, lake, NOW, step=None)) == 48
    spec = load.LoadSpec(data_filter=lambda df: F.col("keywvalue") == "7")
    one = tables.Lake(new_path(spark, "lake"))
    assert load.load_points_period(records, START, NOW, one, NOW, spec=spec)["points_out"] == 1


def test_an_archive_load_keeps_the_callers_builder(spark, tmp_path, lake):
    path = csv_file(spark, tmp_path, "a.2016-01-05.csv.gz", [record(logtext="one")])
    spec = load.LoadSpec(doc_builder=lambda rows: to_docs(rows, index="mine", numeric_index="mine"))
    archives.load_csv_docs(spark, path, lake, NOW, spec=spec)
    assert [r["_index"] for r in tables.read_docs(spark, lake.docs).collect()] == ["mine"]


def test_scan_alog_and_sql(spark, tmp_path):
    records = alog(spark, GOLDEN)
    path = str(tmp_path / "alog")
    records.write.parquet(path)
    assert scan_alog(spark, path=path).count() == 2
    records.createOrReplaceTempView("alog_view")
    assert scan_alog(spark, table="alog_view").count() == 2
    assert scan_sql(spark, "select * from {log} where loghost = :h", {"h": "node7"}, log=records).count() == 1


# --- streams ----------------------------------------------------------------------------------

def stream_of(spark, tmp_path, records, parts=3):
    path = str(tmp_path / "stream")
    records.repartition(parts).write.parquet(path)
    return spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_equals_batch_and_resumes(spark, tmp_path, lake):
    records = series(spark)
    stream = stream_of(spark, tmp_path, records)
    offsets = new_path(spark, "offsets")
    present.load_present(stream, lake, offsets, clock=lambda: NOW, every=None).awaitTermination()
    batch = tables.Lake(new_path(spark, "lake"))
    load.load_both(records, batch, NOW)
    assert contents(spark, lake) == contents(spark, batch)
    rows = tables.read_points(spark, lake.points, latest=False).count()
    present.load_present(stream, lake, offsets, clock=lambda: NOW, every=None).awaitTermination()
    assert tables.read_points(spark, lake.points, latest=False).count() == rows
    late = series(spark, 301).where(F.col("id") == 300)
    late.write.mode("append").parquet(str(tmp_path / "stream"))
    present.load_present(stream, lake, offsets, clock=lambda: NOW, every=None).awaitTermination()
    assert len(contents(spark, lake)[1]) == 301
    assert tables.read_progress(spark, lake.progress).count() == 4


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path, lake):
    stream = stream_of(spark, tmp_path, series(spark))
    for _ in range(2):  # a lost checkpoint replays everything
        present.load_present(
            stream, lake, new_path(spark, "offsets"), clock=lambda: NOW, every=None).awaitTermination()
    points, docs = contents(spark, lake)
    assert (len(points), len(docs)) == (225, 300)


def test_polling_a_table(spark, tmp_path, lake):
    path = str(tmp_path / "alog")
    series(spark).write.parquet(path)
    now = START + timedelta(seconds=300 * 600)
    tables.reset_progress(spark, lake.progress, "present", START - timedelta(seconds=1), START)
    query = present.poll_present(
        spark, lambda: spark.read.parquet(path), lake, new_path(spark, "offsets"),
        delay_s=0, every="1 second", clock=lambda: now)
    deadline = time.time() + 90
    while time.time() < deadline and tables.read_progress(spark, lake.progress).count() < 2:
        assert query.exception() is None
        time.sleep(0.5)
    query.stop()
    assert contents(spark, lake)[1] and len(contents(spark, lake)[1]) == 300


def test_spec_is_immutable_and_replaceable():
    spec = replace(load.LoadSpec(), host="h")
    assert (spec.host, spec.targets) == ("h", load.BOTH)


def test_control_tables_fold(spark, lake):
    for i in (3, 9, 5):
        at = datetime(2024, 1, i)
        tables.write_progress(spark, lake.progress, "a", at, at, at, at)
    tables.reset_progress(spark, lake.progress, "b", datetime(2024, 1, 6), datetime(2024, 1, 6))
    for i in (2, 7, 8):
        tables.write_progress(spark, lake.progress, "b", NOW, NOW, datetime(2024, 1, i), datetime(2024, 1, 6 + i % 2))
    tables.write_run_log(spark, lake.run_log, {"collector": "a", "ok": True})
    tables.write_run_log(spark, lake.run_log, {"collector": "a", "ok": False})

    def ends():
        progress = tables.read_progress(spark, lake.progress)
        return [
            (f(progress, c).first()[0]) for c in ("a", "b")
            for f in (accounting.latest_progress, accounting.earliest_progress)]

    before = ends()
    tables.compact_control(spark, lake)
    assert ends() == before
    assert tables.read_progress(spark, lake.progress).count() == 5
    assert tables.read_run_log(spark, lake.run_log).count() == 2
    assert accounting.load_status(tables.read_run_log(spark, lake.run_log)).first()["ok"] is False


def test_a_failed_load_is_logged_and_leaves_no_progress(spark, lake):
    def fail(*_):
        raise RuntimeError("store is gone")

    with pytest.raises(RuntimeError):
        load.load_period(series(spark), START, NOW, lake, NOW, spec=load.LoadSpec(docs_writer=fail))
    assert tables.read_progress(spark, lake.progress).count() == 0
    log = tables.read_run_log(spark, lake.run_log).first()
    assert (log["ok"], log["level"]) == (False, "ERROR")
    load.load_period(series(spark), START, NOW, lake, NOW)
    assert len(contents(spark, lake)[0]) == 225


def test_an_empty_window_is_a_load_of_nothing(spark, lake):
    records = series(spark)
    assert contents(spark, lake) == (set(), set())
    counts = load.load_period(records, datetime(2020, 1, 1), datetime(2020, 1, 2), lake, NOW)
    assert counts == {"rows_in": 0, "points_out": 0, "docs_out": 0}
    assert load.load_period(records.where("1 = 0"), START, NOW, lake, NOW)["docs_out"] == 0
    assert contents(spark, lake) == (set(), set())
    load.load_period(records, START, NOW, lake, NOW)
    assert len(contents(spark, lake)[1]) == 300


def test_a_hot_day_is_written_by_many_tasks(spark, lake, tmp_path):
    """Nine tenths of all rows fall on one day; its files stay near the advised size."""
    rows = alog(spark, [record()]).crossJoin(spark.range(200_000).withColumnRenamed("id", "n"))
    spread = rows.withColumn("keywvalue", F.col("n").cast("string")).withColumn(
        "logtext", F.sha2(F.col("n").cast("string"), 256)).withColumn(
        "timestamp", F.when(F.col("n") % 10 == 0, F.date_add("timestamp", (F.col("n") % 7).cast("int")))
        .otherwise(F.col("timestamp")).cast("timestamp"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        written = tables.write_points(to_points(spread.repartition(8)), lake.points, NOW)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert written == 200_000
    files_per_day = (
        spark.read.parquet(lake.points).withColumn("f", F.input_file_name()).groupBy("day")
        .agg(F.count_distinct("f").alias("files"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).collect())
    assert files_per_day[0]["n"] > 180_000 and files_per_day[0]["files"] > 4
    assert tables.read_points(spark, lake.points).count() == 200_000


def test_copies_are_combined_before_the_shuffle(spark):
    copies = to_docs(alog(spark, [record()]).crossJoin(spark.range(100_000).select(F.col("id").alias("copy")))).withColumn(
        "load_time", F.lit("2024-01-01").cast("timestamp"))
    folded = upsert_docs(copies)
    assert folded.count() == 1
    plan = plan_of(folded)
    assert plan.index("partial_max_by") > 0 and "Window" not in plan


def test_loads_do_not_depend_on_the_zone_of_python(spark, tmp_path, lake):
    records = series(spark)
    stop, now = START + timedelta(days=1), datetime(2024, 1, 4)
    before = os.environ.get("TZ")
    os.environ["TZ"] = "America/Santiago"
    time.tzset()
    try:
        load.load_backwards(records, stop, lake, now)
        load.load_backwards(records, START, lake, now, step=None)
        tables.reset_progress(spark, lake.progress, "present", START, START)
        assert load.load_increment(records, lake, now, 0)["rows_in"] == 299
        other = tables.Lake(new_path(spark, "lake"))
        present.load_present(stream_of(spark, tmp_path, records), other, new_path(spark, "offsets"),
                             clock=lambda: now, every=None).awaitTermination()
        path = csv_file(spark, tmp_path, "a.2016-01-05.csv.gz", [record(logtext="one")])
        assert archives.load_csv_docs(spark, path, other, NOW)["docs_out"] == 1
        assert archives.load_csv_docs(spark, path, other, NOW)["docs_out"] == 0
    finally:
        os.environ.pop("TZ") if before is None else os.environ.update(TZ=before)
        time.tzset()
    assert len(contents(spark, lake)[1]) == 300
    ends = tables.read_progress(spark, other.progress).agg(
        F.date_format(F.max("present"), "yyyy-MM-dd HH:mm:ss")).first()[0]
    assert ends == str(START + timedelta(seconds=299 * 600))


def test_copies_are_sorted_by_what_tells_them_apart(spark):
    docs = to_docs(alog(spark, [record()])).withColumn("load_time", F.current_timestamp())
    assert re.search(r"Sort\n.*\nArguments: \[_id#", plan_of(upsert_docs(docs)))


def test_type_and_index_are_worked_out_once_for_a_document(spark):
    plan = plan_of(load.monthly_docs(alog(spark, [record(), record(keywvalue="nan"), record(typelog="LOG")])))
    assert plan.count("inf(inity)?|nan)") == 1 and plan.count("date_format(") == 1
