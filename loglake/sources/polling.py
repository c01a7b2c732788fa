"""A log table that is no stream, followed as one: a streaming source whose offsets are times.

A micro-batch is the rows after one time up to another. Both are in the checkpoint before anything is
read, so a batch that is repeated after a failure, or after a restart, reads the same rows of a log
that is only added to. The rows are read by the executors, a slice of time in each task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

Clock = Callable[[], datetime]
EPOCH = datetime(1970, 1, 1)
TICK = timedelta(microseconds=1)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _naive(value: datetime | None) -> datetime | None:
    """A time in UTC without its zone."""
    return value if value is None or value.tzinfo is None else value.astimezone(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class ParquetLog:
    """A directory of Parquet files to which files are added; ``path`` is one Arrow can open on every machine.

    Rows outside a window are skipped by the files' statistics and never leave the reader.
    """

    path: str
    column: str = "timestamp"

    def _rows(self, after: datetime | None, until: datetime | None, columns: Sequence[str]):
        files = ds.dataset(self.path, format="parquet")
        kind, wanted = files.schema.field(self.column).type, ds.field(self.column).is_valid()
        if after is not None:
            wanted &= ds.field(self.column) > pa.scalar(after, kind)
        if until is not None:
            wanted &= ds.field(self.column) <= pa.scalar(until, kind)
        return files.scanner(columns=list(columns), filter=wanted)

    def _end(self, after: datetime | None, until: datetime | None, sign: int) -> datetime | None:
        found = None
        for batch in self._rows(after, until, [self.column]).to_batches():
            value = _naive(pc.min_max(batch.column(0))["min" if sign < 0 else "max"].as_py())
            if value is not None and (found is None or (value > found) == (sign > 0)):
                found = value
        return found

    def first_time(self) -> datetime | None:
        return self._end(None, None, -1)

    def last_time(self, after: datetime, until: datetime) -> datetime | None:
        """The last time a row has in ``(after, until]``."""
        return self._end(after, until, 1)

    def read(self, after: datetime, until: datetime, columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
        """The rows in ``(after, until]``."""
        yield from self._rows(after, until, columns).to_batches()


@dataclass(frozen=True)
class DatabaseLog:
    """A table behind a DB-API driver that every machine has; ``connect`` opens a connection.

    ``mark`` is the driver's parameter mark. Only the rows of a window are asked for.
    """

    connect: Callable
    table: str = "alog"
    column: str = "timestamp"
    mark: str = "%s"
    fetch: int = 10_000

    def _query(self, text: str, values: Sequence) -> Iterator[list]:
        connection = self.connect()
        try:
            cursor = connection.cursor()
            cursor.execute(text, tuple(values))
            while rows := cursor.fetchmany(self.fetch):
                yield rows
        finally:
            connection.close()

    def _one(self, text: str, values: Sequence = ()) -> datetime | None:
        for rows in self._query(text, values):
            return _naive(rows[0][0])
        return None

    def _window(self) -> str:
        return f"{self.column} > {self.mark} and {self.column} <= {self.mark}"

    def first_time(self) -> datetime | None:
        return self._one(f"select min({self.column}) from {self.table}")

    def last_time(self, after: datetime, until: datetime) -> datetime | None:
        return self._one(f"select max({self.column}) from {self.table} where {self._window()}", (after, until))

    def read(self, after: datetime, until: datetime, columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
        text = f"select {', '.join(columns)} from {self.table} where {self._window()}"
        for rows in self._query(text, (after, until)):
            yield pa.RecordBatch.from_arrays([pa.array(list(values)) for values in zip(*rows)], names=list(columns))


class Window(InputPartition):
    """The rows of one task: after ``low`` up to ``high``, in microseconds."""

    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


def _micros(value: datetime) -> int:
    return (value - EPOCH) // TICK


def _time(micros: int) -> datetime:
    return EPOCH + TICK * micros


class PolledReader(DataSourceStreamReader):
    """Offsets ``{"until": microseconds}``; rows up to an offset have been read, those after it have not."""

    def __init__(self, log, schema: T.StructType, start: datetime | None, delay: timedelta, slice_: timedelta, clock: Clock):
        self.log, self.schema, self.start = log, schema, start
        self.delay, self.slice, self.clock = delay, slice_, clock
        self.seen: int | None = None

    def _begin(self) -> int:
        start = self.start if self.start is not None else self.log.first_time()
        return _micros(self.clock() - self.delay if start is None else start - TICK)

    def initialOffset(self) -> dict:
        return {"until": self._begin()}

    def latestOffset(self) -> dict:
        """The last time a row has, ``delay`` behind the clock; without newer rows it stays, and no batch runs."""
        if self.seen is None:
            self.seen = self._begin()
        last = self.log.last_time(_time(self.seen), self.clock() - self.delay)
        if last is not None:
            self.seen = _micros(last)
        return {"until": self.seen}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        low, high, step = start["until"], end["until"], max(1, self.slice // TICK)
        self.seen = max(high, self.seen or high)
        return [Window(at, min(at + step, high)) for at in range(low, high, step)]

    def commit(self, end: dict) -> None:
        self.seen = max(end["until"], self.seen or end["until"])

    def read(self, partition: Window) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(self.schema)
        for batch in self.log.read(_time(partition.low), _time(partition.high), self.schema.names):
            columns = [batch.column(name) for name in self.schema.names]
            yield pa.RecordBatch.from_arrays([
                c.cast(pa.timestamp("us")).cast(f.type) if pa.types.is_timestamp(f.type) and c.type != f.type else c.cast(f.type)
                for c, f in zip(columns, target)], schema=target)


def poll_source(
    spark: SparkSession, log: ParquetLog | DatabaseLog, schema: T.StructType, name: str = "polled_log",
    start: datetime | None = None, delay_s: float = 100, slice_s: float = 3600, clock: Clock = utc_now,
) -> DataFrame:
    """The rows of ``log`` as a stream, from ``start`` on (inclusive), else from its first row.

    Rows are read once their time is ``delay_s`` behind the clock, by tasks of ``slice_s`` seconds of
    time each, so a long gap is many tasks and not a large one. A row that arrives later than that,
    with a time that was read already, is not seen; nor is one without a time. Times are UTC. ``name``
    is registered as a format of the session; ``log`` and ``clock`` are sent to other processes.
    """
    settings = (log, schema, start, timedelta(seconds=delay_s), timedelta(seconds=slice_s), clock)

    class Polled(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            return schema

        def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
            return PolledReader(*settings)

    spark.dataSource.register(Polled)
    return spark.readStream.format(name).load()
