"""Raw log lines: the log table rendered as text, then parsed."""

from __future__ import annotations

from pyspark.sql import functions as F

from loglake.operators.documents import to_docs
from loglake.operators.points import to_points
from loglake.sinks.exports import write_lines
from loglake.sources import rawlogs as raw
from loglake.sources.archives import normalise_csv
from registry.base import (
    SECONDS, TIME_TEXT, alog_seconds, docs_sql, POINTS, query, table, written_once,
)

CODED = "typelog in ('ERR', 'LOG')"
ERR = "typelog = 'ERR'"
FIELDS = {
    "typelog": "typelog",
    "tm": TIME_TEXT.format("timestamp"),
    "loghost": "loghost",
    "env": "env",
    "procname": "procname",
    "procid": f"case when {CODED} then procid else 0 end",
    "module": f"case when {CODED} then module else '' end",
    "keyw": "case typelog when 'FPAR' then replace(keywname, ' ', '.') "
            "when 'FEVT' then '.' || replace(keywname, ' ', '.') else '' end",
    "keyv": "case when typelog = 'FPAR' then keywvalue else '' end",
    "logtext": "case typelog when 'FPAR' then logtext || ' ' when 'FEVT' then logtext || ' ' "
               "when 'FLOG' then ' ' || logtext || ' ' else logtext end",
    "errstack": f"case when {ERR} then errstack else '' end",
    "errstackidx": f"case when {ERR} then errstackidx else 0 end",
    "errlocation": f"case when {ERR} then errlocation else '' end",
    "errseverity": f"case when {ERR} then errseverity else '' end",
}
PARSED = "parsed as (select " + ", ".join(f"{sql} as {name}" for name, sql in FIELDS.items()) + " from alog)"
AS_ALOG = """records as (select strptime(tm, '%Y-%m-%d %H:%M:%S.%f') as timestamp, keyw as keywname,
    keyv as keywvalue, * exclude (tm, keyw, keyv) from parsed)"""


def lines_of(records):
    """Each record as a raw line of its type, with the file it would be in."""
    stamp = F.concat(
        F.date_format("timestamp", "MMM "), F.lpad(F.date_format("timestamp", "d"), 2, " "),
        F.date_format("timestamp", " HH:mm:ss "), "loghost", F.lit(" "), "procname", F.lit(": "),
        F.col("procid").cast("string"), F.date_format("timestamp", " HH:mm:ss"),
    )
    closing = F.concat(F.lit(" ["), F.col("env"), F.lit("]"))
    head = F.concat_ws(" ", "env", "module", "procname", F.col("procid").cast("string"))
    body = (
        F.when(F.col("typelog") == "FPAR", F.concat(
            F.lit("> "), "keywname", F.lit(" = "), "keywvalue", F.lit(" / "), "logtext", closing))
        .when(F.col("typelog") == "FEVT", F.concat(
            F.lit(">- "), "keywname", F.lit(" / "), "logtext", closing))
        .when(F.col("typelog") == "FLOG", F.concat(F.lit(">/ "), "logtext", closing))
        .when(F.col("typelog") == "ERR", F.concat_ws(
            " ", F.lit(""), head, "errlocation", F.lit("x"), "errstack",
            F.col("errstackidx").cast("string"), "errseverity", F.lit("ERR_CODE"), "logtext"))
        .otherwise(F.concat_ws(" ", F.lit(""), head, F.lit("x"), "logtext"))
    )
    path = F.concat(F.lit("/raw/"), "loghost", F.lit("."), F.date_format("timestamp", "yyyy-MM-dd"), F.lit(".log"))
    return records.select(F.concat(stamp, body).alias("value"), path.alias("file_path"))


def _lines(spark, sf_dir):
    return lines_of(alog_seconds(spark, sf_dir))


def _parsed(spark, sf_dir):
    return raw.parse_raw_logs(_lines(spark, sf_dir))


@query("parse_raw_logs", f"with {SECONDS}, {PARSED} select *, null as _malformed from parsed")
def _(spark, sf_dir):
    return _parsed(spark, sf_dir)


def _field(column: str, query_name: str) -> None:
    @query(query_name, f"with {SECONDS}, {PARSED} select {column}, count(*) as n from parsed group by 1")
    def _(spark, sf_dir):
        return _parsed(spark, sf_dir).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


for _column in FIELDS:
    _field(_column, {"typelog": "raw_type", "tm": "raw_time"}.get(_column, f"raw_{_column}"))


@query("raw_types_only", f"with {SECONDS}, {PARSED} select typelog from parsed")
def _(spark, sf_dir):
    return raw.raw_types_only(_lines(spark, sf_dir))


# The documents' texts are no log lines: all of them must come out as malformed, none fail.
@query("raw_malformed", """
    with l as (select unnest(string_split(text, chr(10))) as value from documents)
    select value as _malformed, count(*) as n from l group by 1""")
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select(
        F.explode(F.split("text", "\n")).alias("value"), F.lit("/raw/w.2024-01-01.log").alias("file_path"))
    return raw.parse_raw_logs(lines).groupBy("_malformed").agg(F.count(F.lit(1)).alias("n"))


@query("raw_to_points", f"""
    with {SECONDS}, {PARSED}, {AS_ALOG}, {POINTS.replace('from alog', 'from records')}
    select name, timestamp, value, proc, env, loghost, logtext from points""")
def _(spark, sf_dir):
    # Only parameter lines have a value.
    parsed = raw.parse_raw_logs(_lines(spark, sf_dir), kinds=("FPAR",))
    return to_points(normalise_csv(raw.well_formed(parsed)))


@query("raw_to_docs", f"with {SECONDS}, {PARSED}, {AS_ALOG}, {docs_sql(source='records')} select * from docs")
def _(spark, sf_dir):
    return to_docs(normalise_csv(raw.well_formed(_parsed(spark, sf_dir))))


def _written_lines(spark, sf_dir):
    def write(path):
        write_lines(_lines(spark, sf_dir), path, compression="none")

    return written_once(spark, sf_dir, "rawlogs", write)


RENDERED = """lines as (select concat(strftime(timestamp, '%b '), lpad(strftime(timestamp, '%-d'), 2, ' '),
    strftime(timestamp, ' %H:%M:%S '), loghost, ' ', procname, ': ', cast(procid as varchar),
    strftime(timestamp, ' %H:%M:%S'), case typelog
    when 'FPAR' then concat('> ', keywname, ' = ', keywvalue, ' / ', logtext, ' [', env, ']')
    when 'FEVT' then concat('>- ', keywname, ' / ', logtext, ' [', env, ']')
    when 'FLOG' then concat('>/ ', logtext, ' [', env, ']')
    when 'ERR' then concat(' ', env, ' ', module, ' ', procname, ' ', cast(procid as varchar), ' ', errlocation,
        ' x ', errstack, ' ', cast(errstackidx as varchar), ' ', errseverity, ' ERR_CODE ', logtext)
    else concat(' ', env, ' ', module, ' ', procname, ' ', cast(procid as varchar), ' x ', logtext) end) as value
    from alog)"""


@query("read_raw_logs", f"with {SECONDS}, {RENDERED} select value from lines")
def _(spark, sf_dir):
    return raw.read_raw_logs(spark, _written_lines(spark, sf_dir)).select("value")


CELLS = ", ".join(
    f'nullif(split_part(regexp_replace(value, \' +\', \' \', \'g\'), \' \', {i + 1}), \'\') as "{i}"'
    for i in range(22)
)


WORDS = "string_split(regexp_replace(value, ' +', ' ', 'g'), ' ')"


@query("read_ws_table", f"with {SECONDS}, {RENDERED} select {CELLS}, array_to_string({WORDS}[23:], ' ') as rest from lines")
def _(spark, sf_dir):
    return raw.read_ws_table(spark, _written_lines(spark, sf_dir)).withColumn("rest", F.array_join("rest", " "))


# Texts have far more words than a table has columns: none is lost, and the last is found.
@query("read_ws_table_long", """
    with t as (select doc_id, list_filter(string_split_regex(text, '[ \t\n\v\f\r]+'), lambda w : w <> '') as w from documents)
    select case when len(w) > 22 then len(w) - 22 else 0 end as n_rest, count(*) as n from t where len(w) > 0 group by 1""")
def _(spark, sf_dir):
    def write(path):
        line = F.regexp_replace(F.regexp_replace("text", r"[^\x21-\x7E \t\n\x0B\f\r]", "?"), r"[ \t\n\x0B\f\r]+", " ")
        table(spark, sf_dir, "documents").select(line.alias("value")).write.text(path)

    rows = raw.read_ws_table(spark, written_once(spark, sf_dir, "long-lines", write))
    return rows.groupBy(F.size("rest").cast("long").alias("n_rest")).agg(F.count(F.lit(1)).alias("n"))


@query("read_ws_table_columns", f"""
    with {SECONDS}, {RENDERED}, cells as (select {CELLS} from lines) select "6", "17" from cells""")
def _(spark, sf_dir):
    return raw.read_ws_table(spark, _written_lines(spark, sf_dir), (6, 17))


# The environment is the last word of a line in three of the five types.
@query("env_from_cells", f"""
    with {SECONDS} select case when typelog in ('FPAR', 'FEVT', 'FLOG') then env else '' end as env, count(*) as n
    from alog group by 1""")
def _(spark, sf_dir):
    cells = raw.read_ws_table(spark, _written_lines(spark, sf_dir))
    return cells.select(raw.env_from_cells(cells).alias("env")).groupBy("env").agg(F.count(F.lit(1)).alias("n"))
