"""Replaced partitions, logged deletes and reads without a fold."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loglake.operators.points import delete_points, to_points
from loglake.plans import load
from loglake.session import new_path
from loglake.sinks import lake as tables, versions
from samples import alog, plan_of, record

NOW = datetime(2024, 2, 1)
LATER = datetime(2024, 2, 2)
START = datetime(2024, 1, 1)
DAYS = [date(2024, 1, d) for d in (1, 2, 3)]
DAY_MS = 86_400_000
FIRST_MS = 1704067200000


def series(spark, n=60, step_s=3600, names=("A", "B")):
    return alog(spark, [
        record(id=i, timestamp=START + timedelta(seconds=i * step_s), keywname=names[i % len(names)],
               keywvalue="ON" if i % 4 == 0 else str(i), loghost=f"node{i % 3}")
        for i in range(n)])


@pytest.fixture
def lake(spark):
    return tables.Lake(new_path(spark, "lake"))


def points_of(spark, lake, **options):
    return sorted((r["name"], r["timestamp"], r["value"]) for r in tables.read_points(spark, lake.points, **options).collect())


def docs_of(spark, lake):
    return sorted(r["_id"] for r in tables.read_docs(spark, lake.docs).collect())


def everything(spark, lake):
    return points_of(spark, lake), docs_of(spark, lake)


STEPS = ("_write", "publish_text", "_publish")


@pytest.mark.parametrize("action", ["compact_points", "fold_deletes", "compact_docs"])
def test_a_rewrite_that_dies_at_any_step(spark, lake, monkeypatch, action):
    """Readers see all rows after each death, and the next rewrite ends as if nothing had been."""
    load.load_both(series(spark, 30), lake, NOW)
    load.load_both(series(spark, 30), lake, LATER)
    tables.delete_stored_points(spark, lake.points, ["A"], FIRST_MS, FIRST_MS + DAY_MS - 1)
    before = everything(spark, lake)

    def rewrite():
        if action == "compact_points":
            tables.compact_points(spark, lake.points, DAYS[:2])
        elif action == "fold_deletes":
            tables.fold_deletes(spark, lake.points)
        else:
            tables.compact_docs(spark, lake.docs, ["logs-2024.01", "opslog-2024.01"])

    deaths = 0
    for step in STEPS:
        for done_first in (False, True):  # before the step, and after it
            real = getattr(versions, step)

            def die(*args, **options):
                if done_first:
                    real(*args, **options)
                raise RuntimeError("lost")

            monkeypatch.setattr(versions, step, die)
            try:
                rewrite()  # once published, the deletes find nothing more to remove
            except RuntimeError:
                deaths += 1
            monkeypatch.setattr(versions, step, real)
            assert everything(spark, lake) == before
    assert deaths >= 4
    rewrite()
    assert everything(spark, lake) == before


def test_a_half_written_generation_is_not_seen(spark, lake, monkeypatch):
    load.load_both(series(spark), lake, NOW)
    before = everything(spark, lake)
    write = versions._write

    def half(rows, *args):
        write(rows.limit(3), *args)
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "_write", half)
    with pytest.raises(RuntimeError):
        tables.compact_points(spark, lake.points, DAYS)
    monkeypatch.undo()
    assert everything(spark, lake) == before
    assert versions.remove_superseded(spark, lake.points, ("day",)) > 0
    assert everything(spark, lake) == before


def test_a_pinned_reader_sees_its_version(spark, lake):
    load.load_both(series(spark), lake, NOW)
    load.load_both(series(spark), lake, LATER)
    old = versions.version(spark, lake.points)
    tables.compact_points(spark, lake.points, DAYS)
    pinned = versions.read(spark, lake.points, tables.STORED_POINT, ("day",), old)
    assert pinned.count() == 90 and tables.read_points(spark, lake.points, latest=False).count() == 45
    assert versions.version(spark, lake.points).number == 1
    assert versions.version(spark, lake.points, 0) == old
    assert versions.remove_superseded(spark, lake.points, ("day",)) == 3
    assert tables.read_points(spark, lake.points, latest=False).count() == 45


def test_rows_added_during_a_rewrite_stay(spark, lake):
    load.load_both(series(spark), lake, NOW)
    more = to_points(series(spark, 30, 1800, names=("C",)))

    def fold(rows):
        tables.write_points(more, lake.points, LATER)
        return rows

    versions.replace(spark, lake.points, tables.STORED_POINT, ("day",), ("name",), ["2024-01-01"], fold)
    assert {p[0] for p in points_of(spark, lake)} == {"A", "B", "C"}
    assert len(points_of(spark, lake)) == 45 + more.count()


def test_a_load_that_ends_after_a_rewrite_stays(spark, lake, monkeypatch):
    """The load's files land in the generation it saw; it finds that replaced and writes again."""
    load.load_both(series(spark), lake, NOW)
    write, once = versions._write, []

    def slow(rows, *args):
        n = write(rows, *args)
        if not once:
            once.append(1)
            tables.compact_points(spark, lake.points, DAYS)
        return n

    points = to_points(series(spark, 30, 1800, names=("C",)))
    monkeypatch.setattr(versions, "_write", slow)
    tables.write_points(points, lake.points, LATER)
    monkeypatch.undo()
    versions.remove_superseded(spark, lake.points, ("day",))
    assert len(points_of(spark, lake)) == 45 + points.count()


def test_two_rewrites_of_one_partition(spark, lake):
    load.load_both(series(spark), lake, NOW)

    def fold(rows):
        tables.compact_points(spark, lake.points, DAYS[:1])
        return rows

    with pytest.raises(versions.Conflict):
        versions.replace(spark, lake.points, tables.STORED_POINT, ("day",), ("name",), ["2024-01-01"], fold)
    assert len(points_of(spark, lake)) == 45


def test_two_rewrites_of_different_partitions(spark, lake):
    load.load_both(series(spark), lake, NOW)

    def fold(rows):
        tables.compact_points(spark, lake.points, DAYS[:1])
        return rows

    done = versions.replace(spark, lake.points, tables.STORED_POINT, ("day",), ("name",), ["2024-01-02"], fold)
    assert done.number == 2 and set(done.generations) == {"2024-01-01", "2024-01-02"}
    assert len(points_of(spark, lake)) == 45


def test_publishing_does_not_overwrite(spark):
    path = f"{new_path(spark, 'published')}/v1.json"
    assert versions.publish_text(spark, path, "first")
    assert not versions.publish_text(spark, path, "second")
    assert versions.read_text(spark, path) == "first"


# Reads of clean partitions

def test_clean_days_are_read_without_a_shuffle(spark, lake):
    load.load_both(series(spark), lake, NOW)
    load.load_both(series(spark), lake, LATER)
    before = points_of(spark, lake)
    assert "Exchange" in plan_of(tables.read_points(spark, lake.points))
    tables.compact_points(spark, lake.points, DAYS[:2])
    assert points_of(spark, lake) == before
    first = dict(start_ms=FIRST_MS, end_ms=FIRST_MS + 2 * DAY_MS - 1)
    assert "Exchange" not in plan_of(tables.read_points(spark, lake.points, **first))
    assert points_of(spark, lake, **first) == [p for p in before if p[1] < FIRST_MS + 2 * DAY_MS]
    assert "Exchange" in plan_of(tables.read_points(spark, lake.points))
    # A load makes a day dirty again; the others stay clean.
    load.load_both(series(spark, 10), lake, datetime(2024, 2, 3))
    assert points_of(spark, lake) == before
    assert versions.live_partitions(spark, lake.points, ("day",)) == {"2024-01-01": False, "2024-01-02": True, "2024-01-03": False}


def test_clean_documents_are_read_without_a_shuffle(spark, lake):
    for now in (NOW, LATER):
        load.load_both(series(spark), lake, now)
    before = docs_of(spark, lake)
    tables.compact_docs(spark, lake.docs, "opslog-2024.01")
    assert docs_of(spark, lake) == before
    assert "Exchange" not in plan_of(tables.read_docs(spark, lake.docs, "opslog-2024.01"))
    assert "Exchange" in plan_of(tables.read_docs(spark, lake.docs, "logs-2024.01"))
    tables.compact_docs(spark, lake.docs, ["logs-2024.01", "none"])
    assert "Exchange" not in plan_of(tables.read_docs(spark, lake.docs, columns=["loghost"]))
    assert docs_of(spark, lake) == before


# Deletes

CASES = [
    (["A"], None, None, None), (["A", "B"], FIRST_MS, FIRST_MS + DAY_MS, None), (["B"], FIRST_MS + DAY_MS, None, {"loghost": "node1"}),
    (["A"], None, None, {"loghost": ["node1", "node2"], "proc": "recorder"}), (["A"], None, None, {"none": "x"}), ([], None, None, None),
]


@pytest.mark.parametrize("case", CASES)
def test_logged_deletes_agree_with_the_filter(spark, lake, case):
    names, start, end, tags = case
    load.load_both(series(spark), lake, NOW)
    want = sorted((r["name"], r["timestamp"], r["value"])
                  for r in delete_points(tables.read_points(spark, lake.points), names, start, end, tags).collect())
    files = spark.read.parquet(lake.points).inputFiles()
    tables.delete_stored_points(spark, lake.points, names, start, end, tags)
    assert sorted(spark.read.parquet(lake.points).inputFiles()) == sorted(files)
    assert len(versions.list_paths(spark, f"{lake.points}-deletes/*.parquet")) == 1
    assert points_of(spark, lake) == want
    tables.fold_deletes(spark, lake.points)
    assert points_of(spark, lake) == want and tables.stored_deletes(spark, lake.points) is None
    assert tables.read_points(spark, lake.points, latest=False).count() == len(want)


def test_loads_after_a_delete_stay(spark, lake):
    load.load_both(series(spark), lake, NOW)
    tables.delete_stored_points(spark, lake.points, ["A"], at=datetime(2024, 2, 1, 12))
    assert {p[0] for p in points_of(spark, lake)} == {"B"}
    load.load_both(series(spark, 10), lake, LATER)
    again = points_of(spark, lake)
    assert len([p for p in again if p[0] == "A"]) == 2
    tables.compact_points(spark, lake.points, DAYS[:1])
    assert points_of(spark, lake) == again
    tables.fold_deletes(spark, lake.points)
    assert points_of(spark, lake) == again


def test_many_deletes_are_one_join(spark, lake):
    load.load_both(series(spark, names=tuple("ABCDEFGHIJ")), lake, NOW)
    for name in "ABCDE":
        tables.delete_stored_points(spark, lake.points, [name], end_ms=FIRST_MS + DAY_MS)
    left = tables.read_points(spark, lake.points, latest=False)
    assert plan_of(left).count("BroadcastHashJoin LeftAnti") == 1
    assert {p[0] for p in points_of(spark, lake, end_ms=FIRST_MS + DAY_MS)} <= set("FGHIJ")


def test_control_tables_are_replaced_whole(spark, lake, monkeypatch):
    for i in range(3):
        tables.write_progress(spark, lake.progress, "a", NOW, NOW, START + timedelta(days=i), NOW + timedelta(days=i))
        tables.write_run_log(spark, lake.run_log, {"collector": "a", "ok": True})
    monkeypatch.setattr(versions, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        tables.compact_control(spark, lake)
    monkeypatch.undo()
    assert tables.read_progress(spark, lake.progress).count() == 3
    tables.compact_control(spark, lake)
    assert tables.read_progress(spark, lake.progress).count() == 2
    assert tables.read_run_log(spark, lake.run_log).count() == 3
    assert tables.read_progress(spark, lake.progress).agg(F.max("collector_piglet")).first()[0] == START + timedelta(days=2)
