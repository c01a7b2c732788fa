"""Late rows, summaries of stored datapoints, and slices of equal size."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loglake.operators import points as ops
from loglake.plans import load
from loglake.session import new_path
from loglake.sinks import catalogue, lake as tables
from loglake.sources.database import equal_slices, scan_alog
from samples import alog, plan_of, record

NOW, START = datetime(2024, 2, 1), datetime(2024, 1, 1)
DAY_MS, FIRST_MS = 86_400_000, 1704067200000


def series(spark, n=120, step_s=1800):
    return alog(spark, [
        record(id=i, timestamp=START + timedelta(seconds=i * step_s), keywname=f"M{i % 5}", loghost=f"node{i % 3}",
               keywvalue="ON" if i % 4 == 0 else str(i)) for i in range(n)])


@pytest.fixture
def lake(spark):
    return tables.Lake(new_path(spark, "lake"))


# Late rows

def test_late_rows_are_found_and_only_their_windows_loaded(spark, lake):
    records = series(spark)
    high = START + timedelta(days=3)
    load.load_period(records.where("id % 40 <> 7"), START, high, lake, NOW)
    got = load.load_late(records, lake, START, high, NOW + timedelta(days=1), step_s=7200)
    assert got == {"rows_in": 12, "points_out": 9, "docs_out": 12, "windows": 3}
    assert tables.read_docs(spark, lake.docs).count() == 120 and tables.read_points(spark, lake.points).count() == 90
    again = load.load_late(records, lake, START, high, NOW + timedelta(days=2), step_s=7200)
    assert again == {"rows_in": 0, "points_out": 0, "docs_out": 0, "windows": 0}
    assert [r["collector"] for r in tables.read_progress(spark, lake.progress).collect()] == ["period"]
    assert tables.read_run_log(spark, lake.run_log).where("collector = 'late'").count() == 2


def test_copies_are_no_difference(spark, lake):
    records = series(spark, 30)
    for _ in range(2):
        load.load_both(records, lake, NOW)
    assert load.load_late(records.union(records), lake, START, START + timedelta(days=1), NOW)["windows"] == 0


def test_the_ends_of_the_period(spark, lake):
    """The upper bound is no part of the period, on either side."""
    records = series(spark, 10)
    load.load_both(records, lake, NOW)
    high = START + timedelta(seconds=5 * 1800)
    assert load.load_late(records.where(F.col("timestamp") < F.lit(str(high)).cast("timestamp")), lake, START, high, NOW)["windows"] == 0
    assert load.load_late(records.where("false"), lake, START, high, NOW)["windows"] == 5
    empty = tables.Lake(new_path(spark, "lake"))
    assert load.load_late(records, empty, START, high, NOW)["rows_in"] == 5


# Catalogue

def answers(spark, path):
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    return [rows(f(spark, path)) for f in (
        catalogue.stored_metric_names, catalogue.stored_tag_names, catalogue.stored_tag_values, catalogue.stored_sample_sizes)]


def scans(spark, path):
    points = tables.read_points(spark, path)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    return [rows(f(points)) for f in (ops.metric_names, ops.tag_names, ops.tag_values)] + [
        rows(points.groupBy("name").count())]


def test_the_catalogue_agrees_with_scans(spark, lake):
    days = [date(2024, 1, d) for d in (1, 2, 3)]
    load.load_both(series(spark), lake, NOW)
    load.load_both(series(spark), lake, NOW + timedelta(hours=1))
    assert answers(spark, lake.points) == scans(spark, lake.points)
    assert catalogue.refresh_catalogue(spark, lake.points) == []
    tables.compact_points(spark, lake.points, days)
    assert catalogue.refresh_catalogue(spark, lake.points) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert catalogue.refresh_catalogue(spark, lake.points) == []
    want = scans(spark, lake.points)
    assert answers(spark, lake.points) == want
    plan = plan_of(catalogue.stored_metric_names(spark, lake.points))
    assert "timestamp" not in plan and "points-catalogue" in plan
    # A load makes one day dirty, a delete touches another: both are scanned until folded.
    load.load_both(series(spark, 40).withColumn("keywname", F.lit("NEW")), lake, NOW + timedelta(hours=2))
    tables.delete_stored_points(spark, lake.points, ["M1", "M2"], FIRST_MS + 2 * DAY_MS)
    want = scans(spark, lake.points)
    assert answers(spark, lake.points) == want and ("NEW",) in want[0]
    tables.fold_deletes(spark, lake.points)
    assert answers(spark, lake.points) == want
    assert catalogue.refresh_catalogue(spark, lake.points) == ["2024-01-03"]
    assert answers(spark, lake.points) == want
    # A metric that is deleted everywhere is gone from the answers.
    tables.delete_stored_points(spark, lake.points, ["NEW"])
    assert ("NEW",) not in answers(spark, lake.points)[0]


def test_the_catalogue_of_nothing(spark, lake):
    assert answers(spark, lake.points) == [[], [], [], []]
    assert catalogue.refresh_catalogue(spark, lake.points) == []


# Slices

def burst(spark):
    """Nine tenths of all rows within one minute, a few far off, and some without a time."""
    t = F.when(F.col("id") % 10 > 0, F.lit(1704067200).cast("long") * 1_000_000 + F.col("id") * 6000).otherwise(
        F.lit(1700000000).cast("long") * 1_000_000 + F.col("id") * 1_000_000_000)
    return spark.range(10_000).select("id", F.when(F.col("id") % 1000 != 1, F.timestamp_micros(t)).alias("timestamp"))


@pytest.mark.parametrize("n", [1, 2, 7, 16])
def test_each_row_is_in_one_slice_of_fair_size(spark, n):
    rows = burst(spark)
    slices = equal_slices(rows, n)
    sizes = [rows.where(s).count() for s in slices]
    assert len(slices) == n and sum(sizes) == 10_000
    assert max(sizes) <= 2 * 10_000 / n
    found = rows.select("id", *[F.expr(f"coalesce({s}, false)").cast("int").alias(f"s{i}") for i, s in enumerate(slices)])
    assert found.select(sum(F.col(f"s{i}") for i in range(n)).alias("k")).distinct().collect()[0]["k"] == 1


def test_slices_of_a_sample_cover_the_rest(spark):
    rows = burst(spark)
    slices = equal_slices(rows.where("id % 50 = 3"), 8)
    assert sum(rows.where(s).count() for s in slices) == 10_000


def test_slices_of_odd_tables(spark):
    rows = burst(spark)
    assert equal_slices(rows.where("false"), 5) == ["1 = 1"]
    assert equal_slices(rows.withColumn("timestamp", F.lit(None).cast("timestamp")), 5) == ["1 = 1"]
    one = rows.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    assert [one.where(s).count() for s in equal_slices(one, 5)] == [10_000, 0]
    with pytest.raises(ValueError):
        equal_slices(rows, 0)


def test_slices_are_tasks_of_a_jdbc_read(spark, monkeypatch):
    taken = {}

    def jdbc(self, url, table, predicates=None, properties=None, **_):
        taken.update(url=url, table=table, predicates=predicates, properties=properties)
        return spark.range(1)

    monkeypatch.setattr(type(spark.read), "jdbc", jdbc)
    scan_alog(spark, url="jdbc:x", table="log", slices=["a", "b"], fetchsize=5, user="u")
    assert taken == {"url": "jdbc:x", "table": "log", "predicates": ["a", "b"], "properties": {"fetchsize": "5", "user": "u"}}
