"""Scalar functions over whole columns of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loglake.functions import numbers, text, times
from registry.base import ALOG, CLEAN, alog, query, table

FLOAT_SQL = (
    r"'(?i)^\s*[+-]?([0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?(e[+-]?[0-9]+(_[0-9]+)*)?"
    r"|\.[0-9]+(_[0-9]+)*(e[+-]?[0-9]+(_[0-9]+)*)?|inf(inity)?|nan)\s*$'"
)
WORDS = "words as (select doc_id, unnest(string_split_regex(text, '[ \\n]')) as word from documents)"
NUMBER_SQL = f"try_cast(replace(trim(word), '_', '') as double)"


def _words(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(F.split("text", "[ \n]")).alias("word")
    )


@query("clean_name", f"select doc_id, {CLEAN.format('text')} as cleaned from documents")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.clean_name(F.col("text")).alias("cleaned"))


@query("clean_text", f"""
    select doc_id, {CLEAN.format("replace(text, ' ', '_')")} as cleaned from documents""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query("squeeze_spaces",
       r"select doc_id, trim(regexp_replace(text, '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+', ' ', 'g'), ' ') as squeezed "
       "from documents")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.squeeze_spaces(F.col("text")).alias("squeezed"))


@query("join_tokens", """
    with t as (select doc_id, string_split_regex(lower(text), '[^\\p{L}\\p{N}_]+') as parts from documents),
    u as (select doc_id, unnest(parts) as w, generate_subscripts(parts, 1) as i from t)
    select doc_id, coalesce(string_agg(w, ' ' order by i) filter (where w <> ''), '') as joined
    from u group by doc_id""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.join_tokens(text.tokens(F.col("text"))).alias("joined"))


@query("is_numeric_value",
       f"with {WORDS} select regexp_matches(word, {FLOAT_SQL}) as is_number, count(*) as n, "
       f"count(distinct word) as words from words group by 1")
def _(spark, sf_dir):
    return _words(spark, sf_dir).groupBy(
        numbers.is_numeric_value(F.col("word")).alias("is_number")
    ).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("word").alias("words"))


@query("is_numeric_value_no_nan",
       f"with {ALOG} select id, try_cast(keywvalue as double) is not null and "
       "not isnan(try_cast(keywvalue as double)) as is_number from alog")
def _(spark, sf_dir):
    return alog(spark, sf_dir).select(
        "id", numbers.is_numeric_value(F.col("keywvalue"), allow_nan=False).alias("is_number"))


@query("finite_only",
       f"with {ALOG} select id, keywvalue from alog where isfinite(try_cast(keywvalue as double))")
def _(spark, sf_dir):
    return alog(spark, sf_dir).where(numbers.finite_only(F.col("keywvalue"))).select("id", "keywvalue")


@query("is_nonzero_metric",
       f"""with {ALOG} select id, keywname <> '' and try_cast(keywvalue as double) is not null
       and try_cast(keywvalue as double) <> 0 as is_metric from alog""")
def _(spark, sf_dir):
    from loglake.operators.records import nonzero_metric
    records = alog(spark, sf_dir)
    return records.select("id", nonzero_metric(records).alias("is_metric"))


@query("to_number",
       f"""with {WORDS} select doc_id, word, case when isfinite({NUMBER_SQL}) then {NUMBER_SQL} end as number,
       coalesce(isnan({NUMBER_SQL}), false) as is_nan
       from words where regexp_matches(word, {FLOAT_SQL})""")
def _(spark, sf_dir):
    number = numbers.to_number(F.col("word"))
    return _words(spark, sf_dir).where(number.isNotNull()).select(
        "doc_id", "word", F.when(numbers.is_finite(number), number).alias("number"),
        F.isnan(number).alias("is_nan"))


# Prices as exponent text, with and without a fraction: 17e3, 1.5e2.
@query("fix_exponent", """
    with t as (select l_orderkey, l_linenumber, case when l_linenumber % 2 = 0
        then concat(cast(cast(l_quantity as int) as varchar), 'e', cast(l_linenumber as varchar))
        else concat(cast(cast(l_discount as decimal(4, 2)) as varchar), 'e', cast(l_linenumber as varchar)) end as raw
        from lineitem)
    select l_orderkey, l_linenumber, case when raw like '%e%' and raw not like '%.%'
        then replace(raw, 'e', '.0e') else raw end as fixed from t""")
def _(spark, sf_dir):
    exponent = F.concat(F.lit("e"), F.col("l_linenumber").cast("string"))
    raw = F.when(
        F.col("l_linenumber") % 2 == 0, F.concat(F.col("l_quantity").cast("int").cast("string"), exponent)
    ).otherwise(F.concat(F.col("l_discount").cast("decimal(4,2)").cast("string"), exponent))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", numbers.fix_exponent(raw).alias("fixed"))


@query("epoch_ms", "select event_id, cast(floor(epoch(ts)) as bigint) * 1000 as ms from events")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", times.epoch_ms(F.col("ts")).alias("ms"))


@query("epoch_s", "select event_id, cast(floor(epoch(ts)) as bigint) as s from events")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", times.epoch_s(F.col("ts")).alias("s"))


# Times written the way a command line takes them: unpadded numbers, microseconds.
@query("parse_cli_time",
       "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as parsed from events")
def _(spark, sf_dir):
    typed = F.date_format("ts", "yyyy M d H:mm:ss.SSSSSS")
    return table(spark, sf_dir, "events").select(
        "event_id", times.parse_cli_time(typed).alias("parsed"))


# Every second time without its fraction.
@query("parse_iso_micros", """
    select event_id, strftime(case when event_id % 2 = 0 then ts else date_trunc('second', ts) end,
    '%Y-%m-%d %H:%M:%S.%f') as parsed from events""")
def _(spark, sf_dir):
    typed = F.when(
        F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    ).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, sf_dir, "events").select(
        "event_id", times.parse_iso_micros(typed).alias("parsed"))


@query("iso_utc_millis",
       "select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' as iso from events")
def _(spark, sf_dir):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", times.iso_utc_millis(ms).alias("iso"))


@query("index_suffix", """
    select event_id, '' as none, strftime(ts, '%Y.%m.%d') as daily,
    strftime(date_trunc('week', ts), '%Y.%m.%d') as weekly,
    strftime(ts, '%Y.%m') as monthly, strftime(ts, '%Y') as yearly from events""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", *[times.index_suffix(F.col("ts"), f).alias(f.lower()) for f in times.FREQUENCIES])


# One archive path per event: dates padded and not, and paths without one.
PATHS_SQL = """paths as (select event_id, ts, case
    when event_id % 3 = 0 then concat('/data/', strftime(ts, '%Y-%-m-%-d'), '/w', cast(user_id as varchar), '.csv.gz')
    when event_id % 3 = 1 then concat('/data/hist.', strftime(ts, '%Y:%m:%d'), '.csv.gz')
    else concat('/data/a1', strftime(ts, '%Y-%m-%d'), 'x.csv.gz') end as path from events)"""


def _paths(spark, sf_dir):
    kind = F.col("event_id") % 3
    path = (
        F.when(kind == 0, F.concat(F.lit("/data/"), F.date_format("ts", "yyyy-M-d"), F.lit("/w"),
                                   F.col("user_id").cast("string"), F.lit(".csv.gz")))
        .when(kind == 1, F.concat(F.lit("/data/hist."), F.date_format("ts", "yyyy:MM:dd"), F.lit(".csv.gz")))
        .otherwise(F.concat(F.lit("/data/a1"), F.date_format("ts", "yyyy-MM-dd"), F.lit("x.csv.gz")))
    )
    return table(spark, sf_dir, "events").select("event_id", "ts", path.alias("path"))


def _date_sql(pattern: str) -> str:
    return ", ".join(
        f"regexp_extract(path, '{pattern}', {i}) as {part}"
        for i, part in enumerate(("year", "month", "day"), 1)
    )


@query("date_from_path",
       f"with {PATHS_SQL} select event_id, {_date_sql('([0-9]{4})[-/:]([0-9]{1,2})[-/:]([0-9]{1,2})')} from paths")
def _(spark, sf_dir):
    return _paths(spark, sf_dir).select(
        "event_id", times.date_from_path(F.col("path"), whole_word=False).alias("d")
    ).select("event_id", "d.*")


@query("date_from_path_whole_word",
       f"with {PATHS_SQL} select event_id, {_date_sql(chr(92) + 'b([0-9]{4})[-/:]([0-9]{1,2})[-/:]([0-9]{1,2})' + chr(92) + 'b')} from paths")
def _(spark, sf_dir):
    return _paths(spark, sf_dir).select(
        "event_id", times.date_from_path(F.col("path")).alias("d")).select("event_id", "d.*")


@query("path_suffix", f"""
    with {PATHS_SQL} select event_id,
    case when event_id % 3 = 0 then strftime(ts, '%Y.%-m') else strftime(ts, '%Y.%m') end as suffix
    from paths""")
def _(spark, sf_dir):
    return _paths(spark, sf_dir).select(
        "event_id", times.path_suffix(F.col("path"), F.col("ts"), "MONTHLY").alias("suffix"))


@query("shift_hours", "select event_id, strftime(ts - interval 3 hour, '%Y-%m-%d %H:%M:%S.%f') as shifted from events")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", times.shift_hours(F.col("ts"), -3).alias("shifted"))


@query("loghost_from_path", """
    select page_id, split_part(regexp_extract(url, '[^/]*$'), '.', 1) as loghost from pages""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", text.loghost_from_path(F.col("url")).alias("loghost"))


@query("null_to_empty", """
    select doc_id, coalesce(cast(quality as varchar), '') as quality, coalesce(cast(toxic as varchar), '') as toxic
    from documents left join labels using (doc_id)""")
def _(spark, sf_dir):
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return labelled.select(
        "doc_id", text.null_to_empty(F.col("quality")).alias("quality"),
        text.null_to_empty(F.col("toxic")).alias("toxic"))


@query("none_to_text", "select event_id, cast(user_id as varchar) as user_text from events")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", text.none_to_text(F.col("user_id")).alias("user_text"))


@query("keyword_field", """
    select doc_id, case when length(source) <= 20 then source end as source_keyword,
    case when length(text) <= 256 then text end as text_keyword from documents""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.keyword_field(F.col("source"), 20).alias("source_keyword"),
        text.keyword_field(F.col("text"), 256).alias("text_keyword"))
