"""The lake: datapoints, documents, progress and run log as partitioned Parquet.

Loads append; a row's key decides on reading which copy counts, so a load that runs twice
changes nothing. ``compact_*`` folds the copies of the partitions it is given into one, and reads of
partitions so folded need no fold any more. Deletes are a log of predicates until they are folded in.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglake.operators.documents import DOC_KEY, upsert_docs
from loglake.functions.times import DAY_MS, utc_day
from loglake.operators.points import ORDER, POINT_COLUMNS, in_absolute_range, upsert_points, without_deleted
from loglake.schema import DELETE, DOC, POINT, PROGRESS, REJECT, RUN_LOG
from loglake.sinks import versions

LOAD_TIME = T.StructField("load_time", T.TimestampType())
STORED_POINT = T.StructType([
    *POINT.fields, T.StructField(ORDER, T.LongType()), LOAD_TIME, T.StructField("day", T.DateType()),
])
STORED_DOC = T.StructType([*DOC.fields, LOAD_TIME])
POINT_PARTITIONS, POINT_SORT = ("day",), ("name", "timestamp")
DOC_PARTITIONS, DOC_SORT = ("_index", "_type"), ("@timestamp",)


@dataclass(frozen=True)
class Lake:
    """Locations of the tables below one root on shared storage."""

    root: str

    @property
    def points(self) -> str:
        return f"{self.root}/points"

    @property
    def docs(self) -> str:
        return f"{self.root}/docs"

    @property
    def progress(self) -> str:
        return f"{self.root}/progress"

    @property
    def run_log(self) -> str:
        return f"{self.root}/run_log"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"


def _text(value: datetime | str | None) -> str | None:
    """A time as text, which Spark reads in the session zone whatever zone Python is in."""
    return value.isoformat(sep=" ") if isinstance(value, datetime) else value


def first_times(df: DataFrame, *columns: str) -> list[datetime | None]:
    """Times of a one-row result in the session zone.

    A collected timestamp would come in the zone of the Python process instead.
    """
    texts = [F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in columns]
    return [None if text is None else datetime.fromisoformat(text) for text in df.select(*texts).first()]


def moment(value: datetime | str) -> Column:
    return F.lit(_text(value)).cast("timestamp")


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that may not exist yet. The schema keeps Spark from guessing types of partitions."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


# --- datapoints ----------------------------------------------------------------------------

def _with_day(points: DataFrame) -> DataFrame:
    return points.withColumn("day", utc_day(F.col("timestamp")))


def write_points(
    points: DataFrame, path: str, load_time: datetime | str, rebalance: bool = True
) -> int:
    """Append datapoints by day (UTC). Points without ``order_us`` are ordered by their time."""
    order = F.col(ORDER) if ORDER in points.columns else F.col("timestamp") * F.lit(1000).cast("long")
    stored = _with_day(points.select(*POINT_COLUMNS, order.alias(ORDER)).withColumn("load_time", moment(load_time)))
    return versions.append(stored, path, POINT_PARTITIONS, POINT_SORT, rebalance)


def read_points(
    spark: SparkSession, path: str, names: str | Iterable[str] | None = None,
    start_ms: int | None = None, end_ms: int | None = None, latest: bool = True, but_days: Iterable[str] = (),
) -> DataFrame:
    """Datapoints of the given metrics and time range, one per key unless ``latest`` is off.

    ``but_days`` names days (ISO) that are left out, and not read.

    The day bounds sit beside the time bounds because Spark does not derive one from the other.
    Days that were compacted and not added to since hold each key once and are read without a shuffle.
    """
    at = versions.version(spark, path)
    first = None if start_ms is None else str(_day_of(start_ms))
    last = None if end_ms is None else str(_day_of(end_ms))
    but_days = set(but_days)
    inside = lambda day: day not in but_days and (first is None or day >= first) and (last is None or day <= last)
    live = {day: clean for day, clean in versions.live_partitions(spark, path, POINT_PARTITIONS, at).items() if inside(day)}
    points = versions.read(spark, path, STORED_POINT, POINT_PARTITIONS, at, _clean(live) if latest else ())
    points = points.where(in_absolute_range(start_ms, end_ms))
    if first is not None:
        points = points.where(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        points = points.where(F.col("day") <= F.lit(last).cast("date"))
    if but_days:
        points = points.where(~F.col("day").cast("string").isin(sorted(but_days)))
    if names is not None:
        points = points.where(F.col("name").isin([names] if isinstance(names, str) else list(names)))
    deletes = stored_deletes(spark, path)
    if deletes is not None:
        points = without_deleted(points, deletes)
    if latest:
        points = _folded(points, F.col("day").cast("string"), live, upsert_points, POINT_COLUMNS)
    return points.select(*POINT_COLUMNS)


def _clean(live: Mapping[str, bool]) -> list[str]:
    return [key for key, clean in live.items() if clean]


def _folded(rows: DataFrame, partition: Column, live: Mapping[str, bool], fold, columns: Sequence[str]) -> DataFrame:
    """``fold(rows)``, but for rows of the clean ones of the ``live`` partitions, which need none."""
    clean = _clean(live)
    if not clean:
        return fold(rows).select(*columns)
    if len(clean) == len(live):
        return rows.where(partition.isin(clean)).select(*columns)
    whole = rows.where(partition.isin(clean)).select(*columns)
    return whole.unionByName(fold(rows.where(~partition.isin(clean))).select(*columns))


def _day_of(ms: int) -> date:
    return date(1970, 1, 1) + timedelta(days=ms // DAY_MS)


def compact_points(spark: SparkSession, path: str, days: Iterable[date]) -> None:
    """Fold the copies of each datapoint of the given days into one, and logged deletes into them.

    Readers see the old files or the new ones, whole. Loads may go on meanwhile.
    """
    deletes = stored_deletes(spark, path)

    def fold(rows: DataFrame) -> DataFrame:
        return _with_day(upsert_points(rows if deletes is None else without_deleted(rows, deletes)))

    versions.replace(spark, path, STORED_POINT, POINT_PARTITIONS, POINT_SORT, [versions.key_of([d]) for d in days], fold)


def _delete_log(path: str) -> str:
    return f"{path}-deletes"


def stored_deletes(spark: SparkSession, path: str) -> DataFrame | None:
    """The logged deletes of a datapoint table that are not folded in yet; None if there are none."""
    files = versions.list_paths(spark, f"{_delete_log(path)}/*.parquet")
    return spark.read.schema(DELETE).parquet(*files) if files else None


def delete_stored_points(
    spark: SparkSession, path: str, names: Iterable[str], start_ms: int | None = None,
    end_ms: int | None = None, tags: Mapping | None = None, at: datetime | str | None = None,
) -> None:
    """Remove the datapoints of these metrics in the range that carry the tags.

    Writes one small file; no datapoint is read or written. It holds for all that was loaded up to
    ``at``, by default now: what a later load brings stays. Readers leave the rows out from now on,
    and ``compact_points`` and ``fold_deletes`` drop them from the files.
    """
    texts = lambda values: F.array(*[F.lit(v) for v in values]).cast("array<string>")
    wanted = {k: [v] if isinstance(v, str) else list(v) for k, v in (tags or {}).items()}
    pairs = [c for k, v in wanted.items() for c in (F.lit(k), texts(v))]
    spark.range(1, numPartitions=1).select(
        texts(names).alias("names"), F.lit(start_ms).cast("long").alias("start_ms"), F.lit(end_ms).cast("long").alias("end_ms"),
        (F.create_map(*pairs) if pairs else F.lit(None)).cast("map<string,array<string>>").alias("tags"),
        (F.current_timestamp() if at is None else moment(at)).alias("deleted_at"),
    ).write.mode("append").parquet(_delete_log(path))


def fold_deletes(spark: SparkSession, path: str) -> None:
    """Rewrite the days that hold datapoints a logged delete has removed, and empty the log.

    If it dies after the days were published, the deletes still logged find nothing more to remove.
    """
    files = versions.list_paths(spark, f"{_delete_log(path)}/*.parquet")
    if not files:
        return
    deletes = spark.read.schema(DELETE).parquet(*files)
    stored = versions.read(spark, path, STORED_POINT, POINT_PARTITIONS)
    low, high, open_low, open_high = deletes.agg(
        F.min("start_ms"), F.max("end_ms"), F.max(F.col("start_ms").isNull()), F.max(F.col("end_ms").isNull())).first()
    if not open_low:
        stored = stored.where(F.col("day") >= F.lit(_day_of(low)))
    if not open_high:
        stored = stored.where(F.col("day") <= F.lit(_day_of(high)))
    # The days are partitions the driver lists anyway; naming them makes sure no other is read.
    doomed = without_deleted(stored, deletes, keep="left_semi").select("day").distinct()
    days = [row["day"] for row in doomed.toLocalIterator()]
    if days:
        compact_points(spark, path, days)
    for file in files:
        versions.remove(spark, file)


# --- documents -----------------------------------------------------------------------------

def write_docs(
    docs: DataFrame, path: str, load_time: datetime | str, rebalance: bool = True
) -> int:
    """Append documents by index and type."""
    stored = docs.withColumn("load_time", moment(load_time)).withColumn(
        "@timestamp", F.col("@timestamp").cast("timestamp")
    )
    return versions.append(stored, path, DOC_PARTITIONS, DOC_SORT, rebalance)


def read_docs(
    spark: SparkSession, path: str, index: str | Iterable[str] | None = None,
    doc_type: str | None = None, low: datetime | str | None = None,
    high: datetime | str | None = None, latest: bool = True,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Documents of an index, type and time range, one per id unless ``latest`` is off.

    All copies of a document share its time, so filtering before the fold is exact. Name the
    ``columns`` you need: the fold carries whole rows, and the others are then not even read.
    Compacted partitions that were not added to since are read without a shuffle.
    """
    wanted = None if index is None else [index] if isinstance(index, str) else list(index)
    at = versions.version(spark, path)
    live = {}
    for key, clean in versions.live_partitions(spark, path, DOC_PARTITIONS, at).items():
        name, kind = key.split(versions.SEPARATOR)
        if (wanted is None or name in wanted) and doc_type in (None, kind):
            live[key] = clean
    docs = versions.read(spark, path, STORED_DOC, DOC_PARTITIONS, at, _clean(live) if latest else ())
    if columns is not None:
        kept = dict.fromkeys((*DOC_KEY, "@timestamp", *columns, "load_time"))
        docs = docs.select(*kept)
    if wanted is not None:
        docs = docs.where(F.col("_index").isin(wanted))
    if doc_type is not None:
        docs = docs.where(F.col("_type") == doc_type)
    if low is not None:
        docs = docs.where(F.col("@timestamp") >= moment(low))
    if high is not None:
        docs = docs.where(F.col("@timestamp") <= moment(high))
    if latest:
        docs = _folded(docs, F.concat_ws(versions.SEPARATOR, *DOC_PARTITIONS), live, upsert_docs, docs.columns)
    return docs.drop("load_time") if columns is None else docs.select(*columns)


def compact_docs(spark: SparkSession, path: str, index: str | Iterable[str]) -> None:
    """Fold the copies of each document of the given indexes into one; as ``compact_points``."""
    wanted = {index} if isinstance(index, str) else set(index)
    keys = [key for key in versions.live_partitions(spark, path, DOC_PARTITIONS) if key.split(versions.SEPARATOR)[0] in wanted]
    versions.replace(spark, path, STORED_DOC, DOC_PARTITIONS, DOC_SORT, keys, upsert_docs)


# --- rejects -------------------------------------------------------------------------------

def write_rejects(rows: DataFrame, path: str, load_time: datetime | str) -> int:
    """Append what a load could not store, as text, with the reason; returns the number of rows.

    Equal rejects of a load become one row with their number, which is what a repeated load repeats.
    """
    written = Observation()
    stored = rows.groupBy("reason", "record", "file_path").agg(F.count(F.lit(1)).alias("copies")).select(
        "reason", "record", "file_path", moment(load_time).alias("load_time"), "copies")
    stored.observe(written, F.sum("copies").alias("n")).write.mode("append").parquet(path)
    return written.get["n"] or 0


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Each reject (reason, text and file) once, as the latest load that met it counted it.

    A retried load, a replayed micro-batch and a file that is loaded again add nothing. Equal records
    without a file, from different batches, count as one record delivered twice.
    """
    latest = F.max(F.struct("load_time", "copies")).alias("latest")
    return _read(spark, path, REJECT).groupBy("reason", "record", "file_path").agg(latest).select(
        "reason", "record", "file_path", "latest.load_time", "latest.copies")


# --- control tables ------------------------------------------------------------------------

CONTROL_PARTITIONS = ("collector",)


def _append_row(spark: SparkSession, path: str, schema: T.StructType, values: Mapping) -> None:
    row = spark.range(1, numPartitions=1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    versions.append(row, path, CONTROL_PARTITIONS, (), rebalance=False)


def compact_control(spark: SparkSession, lake: Lake) -> None:
    """Fold the one-row files that a collector leaves per window into one file per collector.

    Run it now and then. Progress keeps its last reset and, since then, its ends, which is all a
    resume looks at; the run log keeps every row.
    """
    fields = F.struct(*[c for c in PROGRESS.names if c != "collector"])

    def ends(progress: DataFrame) -> DataFrame:
        resets = progress.where(F.col("past").isNull()).groupBy("collector").agg(
            F.max("written_at").alias("reset_at"))
        current = progress.join(resets, "collector", "left").where(
            F.col("reset_at").isNull() | (F.col("written_at") >= F.col("reset_at")))
        kept = current.groupBy("collector").agg(
            F.min_by(fields, "collector_piglet").alias("first"), F.max_by(fields, "collector_piglet").alias("last"),
            F.max_by(fields, F.when(F.col("past").isNull(), F.col("written_at"))).alias("reset"),
        )
        folded = kept.select("collector", F.explode(F.array_distinct(F.array("first", "last", "reset"))).alias("r"))
        return folded.where(F.col("r").isNotNull()).select("collector", "r.*")

    for path, schema, order, change in (
        (lake.progress, PROGRESS, ("collector_piglet",), ends), (lake.run_log, RUN_LOG, ("timestamp",), lambda rows: rows),
    ):
        keys = versions.live_partitions(spark, path, CONTROL_PARTITIONS)
        if keys:
            versions.replace(spark, path, schema, CONTROL_PARTITIONS, order, keys, change)


def write_progress(
    spark: SparkSession, path: str, collector: str, past: datetime | None,
    present: datetime | None, piglet: datetime, written_at: datetime,
) -> None:
    """Record a finished window. Called after both writes, so a crash repeats a window, not skips it."""
    _append_row(spark, path, PROGRESS, {
        "collector": collector, "past": _text(past), "present": _text(present),
        "collector_piglet": _text(piglet), "written_at": _text(written_at),
    })


def reset_progress(
    spark: SparkSession, path: str, collector: str, moment: datetime, written_at: datetime
) -> None:
    """Set the progress of a collector to a time, whatever was recorded before."""
    write_progress(spark, path, collector, None, None, moment, written_at)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return versions.read(spark, path, PROGRESS, CONTROL_PARTITIONS)


def write_run_log(spark: SparkSession, path: str, record: Mapping) -> None:
    """Append one run record; missing text is empty, not null."""
    empty = {f.name: "" for f in RUN_LOG.fields if isinstance(f.dataType, T.StringType)}
    times = {name: _text(record.get(name)) for name in ("past", "present")}
    _append_row(spark, path, RUN_LOG, {**empty, **record, **times})


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return versions.read(spark, path, RUN_LOG, CONTROL_PARTITIONS)
