"""Archive loads by the ledger of files."""

from __future__ import annotations

import gzip
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loglake.functions.times import path_suffix
from loglake.operators import accounting, files
from loglake.operators.documents import to_docs
from loglake.plans import archives
from loglake.plans.load import LoadSpec
from loglake.session import new_path
from loglake.sinks import lake as tables, ledger
from loglake.sources.archives import fingerprints
from loglake.streaming import present
from registry import QUERIES
from registry.base import alog_of

NOW = datetime(2024, 2, 1)
GOOD = 'FPAR,2024-01-05 00:00:{:02d},node1,hall1,recorder,1,,HEAT,{},"t {}",,0,,\n'


@pytest.fixture
def lake(spark):
    return tables.Lake(new_path(spark, "lake"))


def write(tmp_path, name, numbers=(), extra=""):
    path = tmp_path / name
    path.write_bytes(gzip.compress(("".join(GOOD.format(n, n, n) for n in numbers) + extra).encode("latin-1")))
    return str(path)


def age(path, seconds):
    """Another time of change."""
    os.utime(path, (seconds, seconds))


def states(spark, lake, paths, targets=("docs",), now=NOW):
    found = ledger.file_states(fingerprints(spark, paths), ledger.read_ledger(spark, lake.ledger), targets, now)
    return {r["file_path"].rsplit("/", 1)[1].split(".")[0]: r["status"] for r in found.collect()}


def test_a_file_of_rejects_loads_once(spark, tmp_path, lake):
    path = write(tmp_path, "bad.2024-01-05.csv.gz", extra="short,row\nshort,row\nFPAR,not a time,x\n")
    rejected = [archives.load_csv_docs(spark, path, lake, NOW + timedelta(hours=h))["rejected"] for h in range(3)]
    assert rejected == [3, 0, 0]
    assert sorted((r["record"], r["copies"]) for r in tables.read_rejects(spark, lake.rejects).collect()) == [
        ("FPAR,not a time,x", 1), ("short,row", 2)]
    runs = tables.read_run_log(spark, lake.run_log).orderBy("timestamp").collect()
    assert [(r["collector"], r["ok"], r["rejected"], r["message"]) for r in runs] == [
        ("docs-archives", True, 3, "loaded 1 of 1 files"), ("docs-archives", True, 0, "no file to load"), ("docs-archives", True, 0, "no file to load")]
    assert accounting.load_status(tables.read_run_log(spark, lake.run_log)).first()["loads"] == 3


def test_a_changed_file_loads_again_and_a_touched_one_does_not(spark, tmp_path, lake):
    path = write(tmp_path, "a.2024-01-05.csv.gz", range(3), extra="short,row\n")
    assert archives.load_csv_both(spark, path, lake, NOW)["docs_out"] == 3
    age(path, 1_000_000)
    assert states(spark, lake, path, ("docs", "points")) == {"a": "changed"}
    assert archives.load_csv_both(spark, path, lake, NOW + timedelta(days=1))["docs_out"] == 0
    assert states(spark, lake, path, ("docs", "points")) == {"a": "loaded"}
    write(tmp_path, "a.2024-01-05.csv.gz", range(5))
    age(path, 2_000_000)
    assert archives.load_csv_both(spark, path, lake, NOW + timedelta(days=2))["docs_out"] == 5
    assert tables.read_docs(spark, lake.docs).count() == 5 == tables.read_points(spark, lake.points).count()
    assert tables.read_rejects(spark, lake.rejects).count() == 1
    assert ledger.current_rejects(spark, lake).count() == 0


def test_an_empty_file_is_done_too(spark, tmp_path, lake):
    path = write(tmp_path, "empty.2024-01-05.csv.gz")
    for _ in range(2):
        assert archives.load_csv_both(spark, path, lake, NOW)["rows_in"] == 0
    assert states(spark, lake, path, ("docs", "points")) == {"empty": "loaded"}


def test_a_load_of_documents_hides_no_datapoints(spark, tmp_path, lake):
    path = write(tmp_path, "a.2024-01-05.csv.gz", range(3))
    archives.load_csv_docs(spark, path, lake, NOW)
    assert states(spark, lake, path, ("docs",)) == {"a": "loaded"}
    assert states(spark, lake, path, ("docs", "points")) == {"a": "changed"}
    assert archives.load_csv_both(spark, path, lake, NOW)["points_out"] == 3
    assert tables.read_docs(spark, lake.docs).count() == 3


@pytest.mark.parametrize("where", ["write_rejects", "load_both", "enter"])
def test_a_retried_load_leaves_each_row_once(spark, tmp_path, lake, monkeypatch, where):
    paths = [write(tmp_path, "a.2024-01-05.csv.gz", range(3), "short,row\n"), write(tmp_path, "b.2024-01-05.csv.gz", range(10, 14))]
    module = ledger if where == "enter" else archives
    real = getattr(module, where)

    def die(*args, **options):
        if where == "enter" and args[3] != ledger.LOADED:
            return real(*args, **options)
        real(*args, **options) if where != "enter" else None
        raise RuntimeError("lost")

    monkeypatch.setattr(module, where, die)
    with pytest.raises(RuntimeError):
        archives.load_csv_both(spark, paths, lake, NOW)
    monkeypatch.undo()
    assert states(spark, lake, paths, ("docs", "points")) == {"a": "new", "b": "new"}
    assert tables.read_run_log(spark, lake.run_log).where("not ok").count() == 1
    # The ledger tells that the load did not end, so the files load again.
    assert archives.load_csv_both(spark, paths, lake, NOW + timedelta(minutes=1))["docs_out"] == 7
    assert tables.read_docs(spark, lake.docs).count() == 7 == tables.read_points(spark, lake.points).count()
    assert [(r["record"], r["copies"]) for r in tables.read_rejects(spark, lake.rejects).collect()] == [("short,row", 1)]


def test_claims_keep_others_away_until_they_end(spark, tmp_path, lake):
    paths = [write(tmp_path, f"{n}.2024-01-05.csv.gz", range(i, i + 1)) for i, n in enumerate("abc")]
    files = fingerprints(spark, paths)
    mine = ledger.claim(files.where(F.col("path").contains("/a.")), lake.ledger, ("docs",), "load-1", NOW)
    assert mine.count() == 1
    both = ledger.claim(files, lake.ledger, ("docs",), "load-2", NOW + timedelta(seconds=1))
    assert sorted(r["path"].rsplit("/", 1)[1][0] for r in both.collect()) == ["b", "c"]
    assert states(spark, lake, paths) == {"a": "claimed", "b": "claimed", "c": "claimed"}
    assert archives.load_csv_docs(spark, paths, lake, NOW + timedelta(minutes=1))["docs_out"] == 0
    ledger.enter(both, lake.ledger, ("docs",), ledger.RELEASED, "load-2", NOW + timedelta(minutes=2))
    assert archives.load_csv_docs(spark, paths, lake, NOW + timedelta(minutes=3))["docs_out"] == 2
    # A claim of a load that died ends with its lease.
    assert archives.load_csv_docs(spark, paths, lake, NOW + timedelta(hours=2))["docs_out"] == 1


def test_a_load_that_loses_all_its_claims(spark, tmp_path, lake):
    """Another load claims the file between the look and the claim: nothing is loaded, and nothing stays blocked."""
    path = write(tmp_path, "a.2024-01-05.csv.gz", range(2))
    ledger.claim(fingerprints(spark, path), lake.ledger, ("docs",), "other", NOW)
    counts = archives.load_csv_docs(spark, path, lake, NOW + timedelta(minutes=1), reinsert=True)
    assert counts["docs_out"] == 0
    ledger.enter(fingerprints(spark, path), lake.ledger, ("docs",), ledger.RELEASED, "other", NOW + timedelta(minutes=2))
    assert archives.load_csv_docs(spark, path, lake, NOW + timedelta(minutes=3))["docs_out"] == 2


def test_a_lake_from_before_its_ledger(spark, tmp_path, lake):
    path = write(tmp_path, "a.2024-01-05.csv.gz", range(3))
    archives.load_csv_docs(spark, path, lake, NOW)
    old = tables.Lake(new_path(spark, "lake"))
    tables.write_docs(tables.read_docs(spark, lake.docs), old.docs, NOW)
    new = write(tmp_path, "b.2024-01-05.csv.gz", range(20, 22))
    assert archives.load_csv_docs(spark, [path, new], old, NOW)["docs_out"] == 2


def test_the_ledger_folds(spark, tmp_path, lake):
    path = write(tmp_path, "a.2024-01-05.csv.gz", range(3))
    for h in range(3):
        archives.load_csv_both(spark, path, lake, NOW + timedelta(hours=h), reinsert=True)
    ledger.claim(fingerprints(spark, path), lake.ledger, ("docs",), "open", NOW + timedelta(hours=5))
    assert ledger.read_ledger(spark, lake.ledger).count() == 13
    ledger.compact_ledger(spark, lake.ledger)
    assert sorted(r["state"] for r in ledger.read_ledger(spark, lake.ledger).collect()) == ["claimed", "loaded", "loaded"]
    later = NOW + timedelta(hours=9)
    assert states(spark, lake, path, ("docs", "points"), later) == {"a": "loaded"}


def test_digests_do_not_depend_on_the_order_of_rows(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 7).cast("string").alias("v"))
    digest = lambda df: df.agg(ledger.row_digest(["id", "v"])).first()[0]
    assert digest(rows) == digest(rows.orderBy(F.desc("id")).repartition(5))
    assert digest(rows) != digest(rows.where("id < 999"))
    assert digest(rows.union(rows)) != digest(rows)
    assert digest(rows.where("false")) == "0:0:0"


def test_a_replayed_micro_batch_rejects_once(spark, tmp_path, lake):
    from loglake.streaming import present
    from samples import alog, record

    records = alog(spark, [record(id=i, timestamp=None if i % 2 else datetime(2024, 1, 1)) for i in range(10)])
    path = str(tmp_path / "stream")
    records.write.parquet(path)
    stream = spark.readStream.schema(records.schema).parquet(path)
    for _ in range(2):
        present.load_present(stream, lake, new_path(spark, "offsets"), clock=lambda: NOW, every=None).awaitTermination()
    assert tables.read_rejects(spark, lake.rejects).count() == 5


def test_a_file_without_rows_is_not_to_load(spark, tmp_path):
    write(tmp_path, "empty.csv.gz")
    write(tmp_path, "good.csv.gz", range(3))
    write(tmp_path, "bad.csv.gz", extra="FPAR,not a time,3\n")
    records = archives.csv_records(spark, f"{tmp_path}/*.gz", multi_line=False)
    new = files.files_to_load(files.last_row_per_file(records, untimed=True), to_docs(records))
    assert [r["file_path"].rsplit("/", 1)[1] for r in new.select("file_path").collect()] == ["bad.csv.gz"]


def test_an_empty_first_partition_lists_no_good_file(spark, tmp_path):
    """The query itself, on a table whose first split holds no row, for which the writer leaves an empty file."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.limit(0).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    events.coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        got = QUERIES["files_to_load_unreadable"](spark, str(tmp_path)).collect()
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    assert sorted((r["part"], r["listed"]) for r in got) == [("bad", True), ("good", False)]


def test_the_date_in_a_path_is_searched_once_for_a_suffix(spark):
    """However many parts a suffix has; paths of every kind keep theirs."""
    ts = F.lit("2020-02-03 00:00:00").cast("timestamp")
    paths = spark.createDataFrame([("/a/date=2024-01-05/x",), ("/a/x2024:1/7.gz",), ("/none",), (None,)], "path string")
    for frequency, want in (("DAILY", ["2024.01.05", "2024.1.7", "2020.02.03", "2020.02.03"]), ("MONTHLY", ["2024.01", "2024.1", "2020.02", "2020.02"]),
                            ("YEARLY", ["2024", "2024", "2020", "2020"])):
        found = paths.select(path_suffix(F.col("path"), ts, frequency, whole_word=False).alias("s"))
        assert [r["s"] for r in found.collect()] == want
        assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract") == 1


def test_a_micro_batch_of_one_file_is_shaped_by_many_tasks(spark, lake, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.coalesce(1).write.parquet(f"{tmp_path}/log")
    stream = alog_of(spark, spark.readStream.schema(events.schema).parquet(f"{tmp_path}/log"))
    tasks = []

    def writer(docs, path, load_time):
        tasks.append(docs.rdd.getNumPartitions())
        return docs.count()

    spec = LoadSpec(targets=("docs",), docs_writer=writer)
    present.load_present(stream, lake, f"{tmp_path}/offsets", spec, clock=lambda: NOW, every=None).awaitTermination()
    assert tasks == [spark.sparkContext.defaultParallelism]
