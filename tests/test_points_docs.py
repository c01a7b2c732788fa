from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loglake.operators import documents, points
from loglake.operators.records import finite_named, in_period, is_string, next_window, nonzero_metric, numeric
from loglake.sinks.exports import points_payload
from samples import GOLDEN, alog, plan_of, record


def test_golden_points(spark):
    rows = points.to_points(alog(spark, GOLDEN)).orderBy("timestamp").collect()
    tags = {"proc": "recorder", "logtext": "Hall_gauge"}
    assert [r.asDict() for r in rows] == [
        {"name": "HALL_PRESSURE", "timestamp": 1615734566000, "value": 1.01325,
         "tags": {**tags, "env": "hall2", "loghost": "node7"}},
        {"name": "HALL_PRESSURE", "timestamp": 1615735900000, "value": 0.98692,
         "tags": {**tags, "env": "hall5", "loghost": "node8"}},
    ]


def test_point_filters(spark):
    rows = [record(keywvalue=v, keywname=n) for v, n in
            [("1", "a"), ("nan", "a"), ("inf", "a"), ("0", "a"), ("ON", "a"), ("1", ""), (None, "a")]]
    records = alog(spark, rows)
    assert points.to_points(records).count() == 3
    assert points.to_points(records, numeric).count() == 5
    assert points.to_points(records, finite_named).count() == 2
    assert points.to_points(records, nonzero_metric).count() == 3


def test_put_lines(spark):
    records = alog(spark, [record(keywvalue="1e5"), record(keywvalue="0"), record(keywname="??")])
    assert [r[0] for r in points.put_lines(records).collect()] == [
        "put HALL_PRESSURE 1615734566 1.0e5 proc=recorder env=hall2 loghost=node7 logtext=Hall_gauge"]
    (short,) = points.put_lines(records, with_logtext=False).collect()
    assert short[0].endswith("loghost=node7")


def test_payload_batches(spark):
    records = alog(spark, [record(id=i, keywvalue=str(i)) for i in range(25)])
    batches = points_payload(points.to_points(records.coalesce(1)), 10).collect()
    assert [b["n"] for b in batches] == [10, 10, 5]
    seen = [p["value"] for b in batches for p in json.loads(b["value"])]
    assert sorted(seen) == [float(i) for i in range(25)]


def test_upsert_points_takes_the_latest_load(spark):
    shaped = points.to_points(alog(spark, [record(keywvalue=v) for v in ("5", "9", "1")]))
    loads = F.when(F.col("value") == 1, "2024-01-02").otherwise("2024-01-01").cast("timestamp")
    kept = points.upsert_points(shaped.withColumn("load_time", loads)).collect()
    assert [r["value"] for r in kept] == [1.0]
    same = points.upsert_points(shaped.withColumn("load_time", F.lit("2024-01-01").cast("timestamp")))
    assert [r["value"] for r in same.collect()] == [9.0]


def test_relative_query_needs_an_anchor(spark):
    shaped = points.to_points(alog(spark, GOLDEN))
    with pytest.raises(ValueError):
        points.metric_query(shaped, [{"name": "x"}], start_relative=(1, "hours"))
    last_minute = points.metric_query(
        shaped, [{"name": "HALL_PRESSURE"}], start_relative=(1, "minutes"), anchor=datetime(2021, 3, 14, 15, 32))
    assert last_minute.count() == 1


def test_deletes_leave_points_without_the_tag(spark):
    shaped = points.to_points(alog(spark, GOLDEN))
    assert points.delete_points(shaped, ["HALL_PRESSURE"], 0, tags={"absent": "x"}).count() == 2
    assert points.delete_points(shaped, ["HALL_PRESSURE"], 1615735900000).count() == 1
    names = spark.createDataFrame([("HALL_PRESSURE",)], "name string")
    assert points.delete_metrics(shaped, names).count() == 0


def test_doc_types_and_routing(spark):
    rows = [record(typelog=t, keywvalue=v) for t, v in
            [("fpar", "1"), ("FPAR", "ON"), ("ERR", "1"), ("FPAR", "nan"), ("Log", "")]]
    docs = documents.to_docs(alog(spark, rows), index="logs").collect()
    assert [(d["_index"], d["_type"]) for d in docs] == [
        ("opslog", "opslog"), ("logs", "fpar"), ("logs", "err"), ("opslog", "opslog"), ("logs", "log")]
    assert [d["keywvalue_num"] for d in docs][:3] == [1.0, None, None]
    forced = documents.to_docs(alog(spark, rows), override_type="alarm").collect()
    assert {d["_type"] for d in forced} == {"alarm"}
    assert [d["_index"] for d in forced][:2] == ["opslog", "logs"]


def test_doc_id_ignores_the_database_id_and_nothing_else(spark):
    base = record()
    rows = [base, record(id=7), *[record(**{c: "x"}) for c in
            ("loghost", "env", "procname", "module", "keywname", "keywvalue", "logtext", "errseverity")],
            record(procid=3), record(timestamp=datetime(2021, 3, 14, 15, 9, 26, 1)),
            record(keywname="A", keywvalue="BC"), record(keywname="AB", keywvalue="C")]
    ids = [r[0] for r in alog(spark, rows).select(documents.doc_id()).collect()]
    assert ids[0] == ids[1]
    assert len(set(ids)) == len(ids) - 1


def test_upsert_docs_keeps_the_latest(spark):
    docs = documents.to_docs(alog(spark, GOLDEN * 3))
    old = docs.withColumn("load_time", F.lit("2024-01-01").cast("timestamp"))
    new = docs.withColumn("logtext", F.lit("new")).withColumn("load_time", F.lit("2024-01-02").cast("timestamp"))
    kept = documents.upsert_docs(old.unionByName(new)).collect()
    assert len(kept) == 2 and {d["logtext"] for d in kept} == {"new"}


def test_mapping_limits(spark):
    rows = [record(typelog="FEVT", logtext="x" * 21, keywvalue=""), record(logtext="x" * 256, keywvalue="4.669201"),
            record(logtext="x" * 257, loghost="h" * 21)]
    mapped = documents.apply_mapping(documents.to_docs(alog(spark, rows))).collect()
    assert mapped[0]["logtext_keyword"] is None and mapped[1]["logtext_keyword"] == "x" * 256
    assert mapped[2]["logtext_keyword"] is None and mapped[2]["loghost_keyword"] is None
    assert mapped[1]["keywvalue_keyword"] is None and mapped[0]["keywvalue_keyword"] == ""
    assert mapped[1]["keywvalue_num"] == pytest.approx(4.669201, abs=1e-6)
    assert mapped[1]["keywvalue_num"] != 4.669201


def test_sparse_json(spark):
    (row,) = documents.sparse_doc_json(alog(spark, [record(module="", keywname=None)])).collect()
    assert json.loads(row[0]) == {
        "@timestamp": "2021-03-14T15:09:26.000000", "loghost": "node7", "envname": "hall2",
        "procname": "recorder", "procid": 0, "keywvalue": "1.01325", "logtext": "Hall gauge"}


def test_hits_show_long_text_on_two_lines(spark):
    docs = documents.to_docs(alog(spark, [record(logtext="a\n" + "b" * 90)]))
    (text,) = [r[0] for r in documents.format_hits(docs).collect()]
    lines = text.split("\n")
    assert len(lines) == 4
    assert "(2021-03-14 15:09:26):\tloghost: node7" in lines[0]
    assert lines[2].endswith("logtext: a " + "b" * 78) and lines[3].endswith("b" * 12)


def test_periods(spark):
    records = alog(spark, GOLDEN)
    low, high = GOLDEN[0][1], GOLDEN[1][1]
    assert in_period(records, low, high).count() == 2
    assert in_period(records, low, high, include_low=False).count() == 1
    assert in_period(records, high, low).count() == 0
    (row,) = next_window(records, datetime(2021, 3, 14, 15, 0)).select(
        F.date_format("present", "HH:mm:ss")).collect()
    assert row[0] == "15:10:00"
    assert next_window(records, high).count() == 0
    assert is_string(records, "loghost") and not is_string(records, "id")


def test_period_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "alog")
    alog(spark, GOLDEN).write.parquet(path)
    plan = points.to_points(in_period(spark.read.parquet(path), *[g[1] for g in GOLDEN]))
    text = plan_of(plan)
    assert "GreaterThanOrEqual(timestamp" in text and "LessThanOrEqual(timestamp" in text
    assert "errstack" not in text.split("ReadSchema")[1]
