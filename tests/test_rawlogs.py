from __future__ import annotations

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loglake.schema import OPS_CSV
from loglake.sources import rawlogs
from registry.rawlogs import lines_of
from samples import RAW_LINES, alog, record

EXPECTED = [
    ("FPAR", "2019-05-03 08:15:20", "kiln", "K. hall2", "recorder", 0, "", "OVEN.HEAT", "841.5",
     "Heat of the oven ", "", 0, "", ""),
    ("FEVT", "2019-05-03 08:15:21", "kiln", "hall2", "recorder", 0, "", ".DOOR.OPEN", "",
     "Door was opened ", "", 0, "", ""),
    ("FLOG", "2019-05-03 08:15:22", "kiln", "hall2", "recorder", 0, "", "", "",
     " Shift change noted ", "", 0, "", ""),
    ("ERR", "2019-05-03 08:15:23", "kiln", "hall2", "gasCtl", 902, "burner", "", "",
     "Gas flow is low", "q15", 4, "valve.C:37", "W"),
    ("LOG", "2019-05-03 08:15:24", "kiln", "hall2", "gasCtl", 902, "burner", "", "",
     "valve cycle done", "", 0, "", ""),
]


def parse(spark, lines, path="/raw/kiln.2019-05-03.log", **options):
    df = spark.createDataFrame([(line, path) for line in lines], "value string, file_path string")
    parsed = rawlogs.parse_raw_logs(df, **options)
    return parsed.withColumn("tm", F.date_format("tm", "yyyy-MM-dd HH:mm:ss")).collect()


def test_each_line_type(spark):
    rows = parse(spark, RAW_LINES.splitlines())
    assert [tuple(row[name] for name in OPS_CSV.names) for row in rows] == EXPECTED
    assert {row["_malformed"] for row in rows} == {None}


def test_files_are_read_with_host_and_year_of_their_name(spark, tmp_path):
    path = tmp_path / "kiln.2019-05-03.log"
    path.write_text(RAW_LINES)
    parsed = rawlogs.parse_raw_logs(rawlogs.read_raw_logs(spark, str(path)))
    rows = parsed.withColumn("tm", F.date_format("tm", "yyyy-MM-dd HH:mm:ss")).orderBy("tm").collect()
    assert [tuple(row[name] for name in OPS_CSV.names) for row in rows] == EXPECTED


def test_words_of_a_value_are_joined(spark):
    line = "Oct  1 00:00:12 w recorder: 1 00:00:12> DOOR STATE = 'ON LINE' / text [e]"
    (row,) = parse(spark, [line])
    assert (row["keyw"], row["keyv"]) == ("DOOR.STATE", "ON.LINE")


def test_malformed_lines_keep_their_text_only(spark):
    lines = [
        "", "   ", "a b c d e", "no stamp at all in this line of text here",
        "Oct  1 00:00:12 w d: 1 00:00:12> KEY 12.5 / no equals sign",
        "Oct  1 00:00:12 w d: 1 00:00:12> KEY = 12.5 no slash",
        "Oct  1 00:00:12 w d: 1 00:00:12> KEY = / no value",
        "Oct  1 00:00:12 w d: 1 00:00:12>- KEY no slash",
        "Oct  1 00:00:12 w d: 1 00:00:12 e m p 1 loc x ERR_SHORT",
        "Xyz 99 99:99:99 w d: 1 99:99:99>/ text",
    ]
    for line, row in zip(lines, parse(spark, lines)):
        assert row["_malformed"] == line
        assert all(row[name] is None for name in OPS_CSV.names)


def test_year(spark):
    line = RAW_LINES.splitlines()[0]
    assert parse(spark, [line], "/raw/kiln.log")[0]["tm"] == "1900-05-03 08:15:20"
    assert parse(spark, [line], year=2001)[0]["tm"] == "2001-05-03 08:15:20"


def test_free_text_without_words(spark):
    (row,) = parse(spark, ["Oct  1 00:00:12 w d: 1 00:00:12>/"])
    assert (row["typelog"], row["logtext"], row["env"]) == ("FLOG", "", "kiln")
    (row,) = parse(spark, ["Oct  1 00:00:12 w d: 1 00:00:12>/ one"])
    assert row["logtext"] == " one"


def test_whitespace_table(spark, tmp_path):
    path = tmp_path / "t.log"
    path.write_bytes("a  b\tc\n\n d é \n".encode("latin-1"))
    rows = rawlogs.read_ws_table(spark, str(path), (0, 1, 2)).collect()
    assert [tuple(r) for r in rows] == [("a", "b", "c"), ("d", "é", None)]
    assert rawlogs.read_ws_table(spark, str(path)).columns == [*(str(i) for i in range(22)), "rest"]


def test_types_only(spark):
    df = spark.createDataFrame([(v, "/w.log") for v in [*RAW_LINES.splitlines(), "short"]],
                               "value string, file_path string")
    assert [r[0] for r in rawlogs.raw_types_only(df).collect()] == ["FPAR", "FEVT", "FLOG", "ERR", "LOG"]


def test_env_from_cells(spark, tmp_path):
    path = tmp_path / "t.log"
    path.write_text("a b [x]\na [b] c\na []\na\na [b [c] d]\n")
    cells = rawlogs.read_ws_table(spark, str(path))
    assert [r[0] for r in cells.select(rawlogs.env_from_cells(cells)).collect()] == ["x", "", "", "", ""]


def test_env_of_a_long_line(spark, tmp_path):
    path = tmp_path / "t.log"
    path.write_text(" ".join(f"w{i}" for i in range(30)) + " [env9]\n")
    cells = rawlogs.read_ws_table(spark, str(path))
    assert cells.select(rawlogs.env_from_cells(cells)).first()[0] == "env9"
    assert cells.first()["rest"] == [*(f"w{i}" for i in range(22, 30)), "[env9]"]


WORD = st.text(alphabet="abcXYZ019_.-", min_size=1, max_size=6)
WORDS = st.lists(WORD, min_size=1, max_size=4).map(" ".join)
RECORD = st.builds(
    dict, typelog=st.sampled_from(["FPAR", "FEVT", "FLOG", "ERR", "LOG"]), loghost=st.just("kiln1"), env=WORD,
    procname=WORD, procid=st.integers(0, 10**9), module=WORD, keywname=WORDS, keywvalue=WORD, logtext=WORDS,
    errstack=WORD, errstackidx=st.integers(0, 99), errlocation=WORD, errseverity=st.sampled_from("SW"),
    timestamp=st.integers(0, 300 * 86_400).map(lambda s: datetime(2023, 1, 1) + timedelta(seconds=s)),
)


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(RECORD, min_size=20, max_size=60))
def test_parsing_undoes_rendering(spark, changes):
    parsed = rawlogs.parse_raw_logs(lines_of(alog(spark, [record(**c) for c in changes]).coalesce(1)))
    rows = parsed.withColumn("tm", F.date_format("tm", "yyyy-MM-dd HH:mm:ss")).collect()
    for c, row in zip(changes, rows):
        kind = c["typelog"]
        coded, error = kind in ("ERR", "LOG"), kind == "ERR"
        # Raw lines join the words of a key by dots, and pad the text around its delimiters.
        key = {"FPAR": "", "FEVT": "."}.get(kind)
        pad = {"FPAR": "{} ", "FEVT": "{} ", "FLOG": " {} "}.get(kind, "{}")
        assert row.asDict() == {
            "typelog": kind, "tm": str(c["timestamp"]), "loghost": "kiln1", "env": c["env"],
            "procname": c["procname"], "procid": c["procid"] if coded else 0,
            "module": c["module"] if coded else "",
            "keyw": "" if key is None else key + c["keywname"].replace(" ", "."),
            "keyv": c["keywvalue"] if kind == "FPAR" else "", "logtext": pad.format(c["logtext"]),
            "errstack": c["errstack"] if error else "", "errstackidx": c["errstackidx"] if error else 0,
            "errlocation": c["errlocation"] if error else "", "errseverity": c["errseverity"] if error else "",
            "_malformed": None,
        }
