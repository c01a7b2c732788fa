from __future__ import annotations

import math
import re
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loglake.functions import numbers, text, times

QUIET = settings(
    max_examples=8, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")


def values(spark, inputs, expression, kind="string"):
    rows = column(spark, inputs, kind).select("i", expression(F.col("c")).alias("r")).orderBy("i").collect()
    return [row["r"] for row in rows]


def python_float(value):
    try:
        return float(value)
    except (TypeError, ValueError):
        return None


NUMBERS = [
    "1", "-2.5", "+3.", ".5", "1e5", "1E-3", "1_000", "1__0", "_1", "1_", "1e", "e5", ".", "", " 7 ",
    "\t8\n", "nan", "-NaN", "inf", "+Infinity", "-inf", "1d", "1.0f", "0x1p3", "1e999", "1,5", "ON",
    "1 2", "١", None, "infinit", "1.e3", "1_0.0_1e1_0", "9" * 400, "--1",
]


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def test_to_number_is_python_float(spark):
    got = values(spark, NUMBERS, numbers.to_number)
    # Digits outside ASCII are the one thing Python takes and this does not.
    want = [None if v == "١" else python_float(v) for v in NUMBERS]
    assert [(v, a) for v, a, b in zip(NUMBERS, got, want) if not same(a, b)] == []


@QUIET
@given(st.lists(st.text(alphabet="0123456789.eE+-_ infaN\t", max_size=9), min_size=20, max_size=60))
def test_to_number_on_any_text(spark, texts):
    got = values(spark, texts, numbers.to_number)
    assert [(t, g) for t, g in zip(texts, got) if not same(g, python_float(t))] == []


def test_numeric_rules(spark):
    inputs = ["1", "nan", "inf", "0", "x", None, "1e999"]
    assert values(spark, inputs, numbers.is_numeric_value) == [True, True, True, True, False, False, True]
    assert values(spark, inputs, lambda c: numbers.is_numeric_value(c, False)) == [
        True, False, True, True, False, False, True]
    assert values(spark, inputs, numbers.finite_only) == [True, False, False, True, False, False, False]
    assert values(spark, inputs, lambda c: numbers.is_nonzero_metric(F.lit("m"), c)) == [
        True, True, True, False, False, False, True]
    assert values(spark, ["1"], lambda c: numbers.is_nonzero_metric(F.lit(""), c)) == [False]


def test_fix_exponent(spark):
    assert values(spark, ["1e5", "1.5e5", "15", "true"], numbers.fix_exponent) == [
        "1.0e5", "1.5e5", "15", "tru.0e"]


def test_clean(spark):
    assert values(spark, ["a b:c/d.e_f-g", "é1"], text.clean_name) == ["abc/d.e_f-g", "1"]
    assert values(spark, ["Hall gauge (1)"], text.clean_text) == ["Hall_gauge_1"]


@QUIET
@given(st.lists(st.text(max_size=30), min_size=1, max_size=40))
def test_clean_name_is_idempotent_and_squeeze_is_split_join(spark, texts):
    once = values(spark, texts, text.clean_name)
    assert once == [re.sub(r"[^A-Za-z0-9./_-]", "", t) for t in texts]
    assert values(spark, once, text.clean_name) == once
    assert values(spark, texts, text.squeeze_spaces) == [" ".join(t.split()) for t in texts]
    assert values(spark, texts, text.split_spaces) == [t.split() or [""] for t in texts]


def test_loghost_from_path(spark):
    paths = ["/a/2019/05/kiln.2019-05-03.log", "host.log", "/x.y/plain", "/x/.hidden"]
    assert values(spark, paths, text.loghost_from_path) == ["kiln", "host", "plain", ""]


def test_tokens(spark):
    assert values(spark, ["Año-1: Über_x, x!"], text.tokens) == [["año", "1", "über_x", "x"]]


def test_times(spark):
    def stamp(expression):
        return lambda c: F.date_format(expression(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")

    assert values(spark, ["2021 3 4 5:06:07.5", "2021 03 04 05:06:07.000001", "x"], stamp(times.parse_cli_time)) == [
        "2021-03-04 05:06:07.500000", "2021-03-04 05:06:07.000001", None]
    assert values(spark, ["2021-03-04T05:06:07.089012", "2021-03-04T05:06:07"], stamp(times.parse_iso_micros)) == [
        "2021-03-04 05:06:07.089012", "2021-03-04 05:06:07.000000"]
    assert values(spark, [1615734566987], times.iso_utc_millis, "bigint") == ["2021-03-14T15:09:26.987Z"]
    whole = values(spark, ["2021-03-14 15:09:26.987"], lambda c: times.epoch_ms(c.cast("timestamp")))
    assert whole == [1615734566000]
    assert values(spark, ["2021-03-14 15:09:26.987"], lambda c: times.epoch_s(c.cast("timestamp"))) == [1615734566]


def test_index_suffix(spark):
    day = "2021-03-18 10:00:00"

    def named(frequency):
        return lambda c: times.index_name("logs", times.index_suffix(c.cast("timestamp"), frequency))

    assert [values(spark, [day], named(f))[0] for f in times.FREQUENCIES] == [
        "logs", "logs-2021.03.18", "logs-2021.03.15", "logs-2021.03", "logs-2021"]


def test_dates_in_paths(spark):
    paths = ["/d/hist.2010-04-05.csv.gz", "/d/2016-1-5/x.csv.gz", "/d/none.csv.gz", "/d/a12010-04-05"]
    loose = values(spark, paths, lambda c: F.concat_ws(".", *[times.date_from_path(c, False)[p] for p in ("year", "month", "day")]))
    assert loose == ["2010.04.05", "2016.1.5", "..", "2010.04.05"]
    strict = values(spark, paths, lambda c: times.date_from_path(c)["year"])
    assert strict == ["2010", "2016", "", ""]
    ts = F.lit(str(datetime(2020, 7, 8))).cast("timestamp")
    assert values(spark, paths, lambda c: times.path_suffix(c, ts, "MONTHLY")) == [
        "2010.04", "2016.1", "2020.07", "2020.07"]
