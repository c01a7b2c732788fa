"""Registration, and the given tables in the shapes of the lake."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglake.schema import TAG_KEYS
from loglake.session import configure, new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

NOW = datetime(2024, 2, 1)
FIRST, LAST = "2024-01-05 00:00:00", "2024-01-12 00:00:00"

# The log table over `events`. The same text runs on both engines.
ALOG_SELECT = """
select
  event_id as id,
  ts as timestamp,
  concat('node', cast(user_id % 4 + 1 as string)) as loghost,
  concat('hall', cast(user_id % 4 + 1 as string)) as env,
  'recorder' as procname,
  user_id as procid,
  case when event_type in ('error', 'signup') then concat('mod_', event_type) else '' end as module,
  case when event_type in ('click', 'purchase') then 'FPAR'
       when event_type = 'view' then 'FEVT'
       when event_type = 'error' then 'ERR'
       when event_id % 2 = 0 then 'FLOG' else 'LOG' end as typelog,
  case when event_type in ('click', 'purchase', 'view')
       then concat('EVT ', event_type, ':', cast(user_id % 10 as string)) else '' end as keywname,
  case when event_type in ('click', 'purchase') then
         case when event_id % 13 = 0 then 'ON'
              when event_id % 17 = 0 then 'nan'
              when event_id % 19 = 0 then '0'
              else cast(cast(value as decimal(12, 2)) as string) end
       when event_type = 'error' then '1' else '' end as keywvalue,
  concat(event_type, ' of user ', cast(user_id as string), ' ', props) as logtext,
  case when event_type = 'error' then concat('stk', cast(event_id % 5 as string)) else '' end as errstack,
  case when event_type = 'error' then event_id % 3 else 0 end as errstackidx,
  case when event_type = 'error' then concat('src.C:', cast(event_id % 100 as string)) else '' end as errlocation,
  case when event_type = 'error' then case when event_id % 2 = 0 then 'S' else 'W' end else '' end as errseverity
from """

# SQL building blocks of the oracles.
ALOG = f"alog as ({ALOG_SELECT} events)"
SECONDS = (
    "alog as (select * replace (date_trunc('second', timestamp) as timestamp) "
    f"from ({ALOG_SELECT} events))"
)
CLEAN = "regexp_replace({0}, '[^A-Za-z0-9./_-]', '', 'g')"
NAME = CLEAN.format("keywname")
TEXT_TAG = CLEAN.format("replace(logtext, ' ', '_')")
EPOCH_MS = "cast(floor(epoch(timestamp)) as bigint) * 1000"
TIME_TEXT = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
FINITE = "coalesce(isfinite(try_cast(keywvalue as double)), false)"
NUMERIC = "try_cast(keywvalue as double) is not null"
DOC_TYPE = f"case when lower(typelog) = 'fpar' and {NUMERIC} then 'opslog' else lower(typelog) end"
DOC_ID = (
    "md5(concat_ws(chr(31), " + TIME_TEXT.format("timestamp") + ", loghost, env, procname, "
    "cast(procid as varchar), module, typelog, keywname, keywvalue, logtext, errstack, "
    "cast(errstackidx as varchar), errlocation, errseverity))"
)
POINT_FIELDS = (
    f"{NAME} as name, {EPOCH_MS} as timestamp, try_cast(keywvalue as double) as value, "
    f"procname as proc, env, loghost, {TEXT_TAG} as logtext"
)
POINTS = f"points as (select {POINT_FIELDS} from alog where {FINITE})"
# Of one second the last record stays.
FOLDED_POINTS = f"""folded as (select {NAME} as name, {EPOCH_MS} as timestamp,
    arg_max(try_cast(keywvalue as double), (timestamp, try_cast(keywvalue as double))) as value,
    procname as proc, env, loghost, {TEXT_TAG} as logtext from alog where {FINITE}
    group by {NAME}, {EPOCH_MS}, procname, env, loghost, {TEXT_TAG})"""
DOC_NUM = f"case when lower(typelog) = 'fpar' and isfinite(try_cast(keywvalue as double)) then try_cast(keywvalue as double) end"


def docs_sql(index: str = "logs", suffix: str = "''", source: str = "alog") -> str:
    """Documents CTE. NaN, which hashes differently per engine, has a column of its own."""
    base = f"case when {DOC_TYPE} = 'opslog' then 'opslog' else '{index}' end"
    return f"""docs as (select
        case when {suffix} = '' then {base} else concat({base}, '-', {suffix}) end as _index,
        {DOC_TYPE} as _type, {DOC_ID} as _id, {TIME_TEXT.format('timestamp')} as "@timestamp",
        loghost, env as envname, procname, procid, module, keywname, keywvalue,
        {DOC_NUM} as keywvalue_num,
        coalesce({DOC_TYPE} = 'opslog' and isnan(try_cast(keywvalue as double)), false) as keywvalue_nan, logtext, errstack, errstackidx, errlocation, errseverity
        from {source})"""


DOCS = docs_sql()


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(function(configure(spark), sf_dir.rstrip("/")))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def plain(df: DataFrame) -> DataFrame:
    """Times as text and maps as tag columns, which every engine prints alike."""
    columns: list[Column] = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            columns.append(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name))
        elif isinstance(field.dataType, T.MapType):
            columns.extend(c.getItem(key).alias(key) for key in TAG_KEYS)
        elif field.name == "keywvalue_num":
            columns.append(F.when(~F.isnan(c), c).alias(field.name))
            columns.append(F.coalesce(F.isnan(c), F.lit(False)).alias("keywvalue_nan"))
        else:
            columns.append(c)
    return df.select(*columns)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def alog_of(spark: SparkSession, events: DataFrame) -> DataFrame:
    return spark.sql(ALOG_SELECT + "{events}", events=events)


def alog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alog_of(spark, table(spark, sf_dir, "events"))


def alog_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log table in whole seconds, all that text formats carry."""
    return alog(spark, sf_dir).withColumn("timestamp", F.date_trunc("second", "timestamp"))


_WRITTEN: dict[tuple, str] = {}


def forget_written() -> None:
    """Have the next queries write their tables again, so that a timing includes the writes."""
    _WRITTEN.clear()


def written_once(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    """Path of a table derived from the given ones, written by the first query that needs it."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _WRITTEN:
        path = new_path(spark, label)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]
