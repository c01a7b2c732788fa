"""A log table followed as a stream."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from pathlib import Path

import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from loglake.plans import load
from loglake.schema import ALOG
from loglake.session import new_path
from loglake.sinks import lake as tables
from loglake.sources.polling import DatabaseLog, ParquetLog, poll_source
from loglake.streaming import present
from samples import alog, record

START = datetime(2024, 1, 1)
NOW = datetime(2024, 2, 1)


def series(spark, low, high, step_s=600):
    return alog(spark, [
        record(id=i, timestamp=START + timedelta(seconds=i * step_s), keywvalue=str(i)) for i in range(low, high)])


def at(minutes):
    """A clock that stands ``minutes`` after the start."""
    moment = START + timedelta(minutes=minutes)
    return lambda: moment


@pytest.fixture
def log(spark):
    path = new_path(spark, "log")
    series(spark, 0, 100).repartition(3).write.parquet(path)
    return path


def drain(spark, log, folder, clock, **options):
    """Run until nothing is left; returns all ids so far."""
    stream = poll_source(spark, ParquetLog(log.removeprefix("file:")), ALOG, clock=clock, delay_s=0, **options)
    stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/offsets").trigger(availableNow=True).start(
        f"{folder}/rows").awaitTermination()
    rows = spark.read.schema(ALOG).parquet(f"{folder}/rows")
    return sorted(r["id"] for r in rows.collect())


def test_each_row_comes_once_over_restarts(spark, log):
    folder = new_path(spark, "polled")
    assert drain(spark, log, folder, at(300), slice_s=1000) == list(range(31))
    assert drain(spark, log, folder, at(300), slice_s=1000) == list(range(31))
    series(spark, 100, 120).write.mode("append").parquet(log)
    assert drain(spark, log, folder, at(100_000)) == list(range(120))
    assert drain(spark, log, folder, at(200_000)) == list(range(120))


def test_values_come_as_they_are(spark, log):
    folder = new_path(spark, "polled")
    drain(spark, log, folder, at(100_000), start=START + timedelta(minutes=100))
    rows = spark.read.parquet(f"{folder}/rows")
    want = series(spark, 10, 100)
    assert rows.exceptAll(want).count() == 0 == want.exceptAll(rows.select(want.columns)).count()


def test_a_batch_that_dies_is_replayed_with_its_bounds(spark, log):
    """The first run dies after it stored half of the batch; the lake holds each row once in the end."""
    lake, folder = tables.Lake(new_path(spark, "lake")), new_path(spark, "offsets")
    seen = []

    def die(batch, number):
        seen.append((number, sorted(r["id"] for r in batch.select("id").collect())))
        load.load_both(batch.where("id < 20"), lake, NOW)
        raise RuntimeError("lost")

    def stream(clock):
        return poll_source(spark, ParquetLog(log.removeprefix("file:")), ALOG, clock=clock, delay_s=0, slice_s=5000)

    running = stream(at(300)).writeStream.foreachBatch(die).option("checkpointLocation", folder).trigger(availableNow=True).start()
    with pytest.raises(Exception):
        running.awaitTermination()
    # More rows are there by now, and the clock is later: the replayed batch is the same one.
    series(spark, 100, 110).write.mode("append").parquet(log)
    again = []

    def keep(batch, number):
        again.append((number, sorted(r["id"] for r in batch.select("id").collect())))
        load.load_both(batch, lake, NOW + timedelta(hours=1))

    for _ in range(2):  # a run to the end that begins with a replay ends with it
        stream(at(100_000)).writeStream.foreachBatch(keep).option("checkpointLocation", folder).trigger(
            availableNow=True).start().awaitTermination()
    assert again[0] == seen[0] == (0, list(range(31)))
    assert [i for _, ids in again for i in ids] == list(range(110))
    assert tables.read_docs(spark, lake.docs).count() == 110 == tables.read_points(spark, lake.points).count()
    offsets = [json.loads(p.read_text().splitlines()[-1])["until"] for p in sorted(Path(folder.removeprefix("file:")).glob("offsets/[0-9]*"))]
    assert offsets == sorted(offsets) and len(offsets) == 2


def test_slices_of_time_are_tasks(spark, log):
    folder = new_path(spark, "polled")
    drain(spark, log, folder, at(100_000), slice_s=6000)
    files = [p for p in Path(f"{folder}/rows".removeprefix("file:")).glob("*.parquet")]
    assert len(files) == 10


def test_polled_rows_load_like_a_batch(spark, log):
    lake, whole = (tables.Lake(new_path(spark, "lake")) for _ in range(2))
    stream = poll_source(spark, ParquetLog(log.removeprefix("file:")), ALOG, clock=at(100_000), delay_s=0)
    present.load_present(stream, lake, new_path(spark, "offsets"), clock=lambda: NOW, every=None).awaitTermination()
    load.load_both(series(spark, 0, 100), whole, NOW)
    ids = lambda one: sorted(r["_id"] for r in tables.read_docs(spark, one.docs).collect())
    assert ids(lake) == ids(whole)


def test_an_empty_log(spark):
    path, folder = new_path(spark, "log"), new_path(spark, "polled")
    series(spark, 0, 1).where("false").write.parquet(path)
    assert drain(spark, path, folder, at(10)) == []
    series(spark, 1, 5).write.mode("append").parquet(path)
    assert drain(spark, path, folder, at(10_000)) == [2, 3, 4]  # the first run began at its clock


class FakeCursor:
    """What the source asks of a driver, answered from the files of a log."""

    def __init__(self, path):
        self.path, self.left = path, []

    def execute(self, text, values):
        rows = [r for r in ds.dataset(self.path).to_table().to_pylist()]
        rows = [{**r, "timestamp": r["timestamp"].replace(tzinfo=None)} for r in rows]
        if values:
            rows = [r for r in rows if values[0] < r["timestamp"] <= values[1]]
        if " max(" in text or " min(" in text:
            ends = [r["timestamp"] for r in rows]
            self.left = [((max if " max(" in text else min)(ends) if ends else None,)]
        else:
            names = text.removeprefix("select ").split(" from ")[0].split(", ")
            self.left = [tuple(r[n] for n in names) for r in rows]

    def fetchmany(self, n):
        out, self.left = self.left[:n], self.left[n:]
        return out


class FakeConnection:
    def __init__(self, path):
        self.path = path

    def cursor(self):
        return FakeCursor(self.path)

    def close(self):
        pass


def test_a_table_behind_a_driver(spark, log):
    path = log.removeprefix("file:")
    source = DatabaseLog(lambda: FakeConnection(path), fetch=7)
    begin = START - timedelta(seconds=1)
    assert source.first_time() == START
    assert source.last_time(begin, START + timedelta(minutes=25)) == START + timedelta(minutes=20)
    assert source.last_time(START + timedelta(days=9), NOW) is None
    got = [r for b in source.read(begin, NOW, ["id", "timestamp"]) for r in b.column(0).to_pylist()]
    assert sorted(got) == list(range(100))


def test_rows_without_a_time_are_not_seen(spark):
    path, folder = new_path(spark, "log"), new_path(spark, "polled")
    rows = series(spark, 0, 10)
    rows.withColumn("timestamp", F.when(F.col("id") % 2 == 0, F.col("timestamp"))).write.parquet(path)
    assert drain(spark, path, folder, at(10_000)) == [0, 2, 4, 6, 8]
