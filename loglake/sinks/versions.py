"""Partitioned tables of which whole partitions are replaced, for all readers at one moment.

Files lie in ``<partition>/gen=<g>``. A load appends to the generation ``<g>n`` of a partition, where
``<g>`` is its current one; a rewrite puts the new contents into a generation no one has used and then
publishes a version, a small file that names the current generation of every rewritten partition.
Publishing is one rename, which fails if that version exists already. A reader takes the last version
when its query is planned and sees the generations that version names, old or new, never a mixture.
What a rewrite that died has written is in no version, so nothing needs repair.

A partition with a rewritten generation and nothing appended since is *clean*: it holds each key once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GENERATION = "gen"
FIRST, APPENDED = "0", "n"
VERSIONS = "_versions"
#: Between the values of a partition's columns.
SEPARATOR = "\x1f"


class Conflict(RuntimeError):
    """Another rewrite has replaced a partition that is being replaced."""


# --- files of the shared storage -----------------------------------------------------------

def _path(spark: SparkSession, text: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, sorted."""
    path, system = _path(spark, pattern)
    return sorted(status.getPath().toString() for status in (system.globStatus(path) or []))


def literal_path(path: str) -> str:
    """A pattern that only this path matches."""
    return "".join(f"\\{c}" if c in "[]{}*?\\" else c for c in path)


def read_text(spark: SparkSession, path: str) -> str:
    target, system = _path(spark, path)
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that appears whole or not at all; false if it is there already."""
    target, system = _path(spark, path)
    hidden, _ = _path(spark, f"{target.getParent().toString()}/.{uuid.uuid4().hex}")
    stream = system.create(hidden, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(
            context.makeQualified(hidden), context.makeQualified(target),
            spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as error:
        system.delete(hidden, False)
        if system.exists(target):
            return False
        raise error
    return True


def remove(spark: SparkSession, path: str) -> None:
    target, system = _path(spark, path)
    system.delete(target, True)


# --- versions ------------------------------------------------------------------------------

@dataclass(frozen=True)
class Version:
    """The current generation of every partition that was ever rewritten."""

    number: int = 0
    generations: dict[str, str] = field(default_factory=dict)

    def of(self, key: str) -> str:
        return self.generations.get(key, FIRST)


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """The last published version, or the one of a given number."""
    if number == 0:
        return Version()
    if number is None:
        names = list_paths(spark, f"{path}/{VERSIONS}/v*.json")
        if not names:
            return Version()
        number = int(names[-1].rsplit("/v", 1)[1].removesuffix(".json"))
    return Version(number, json.loads(read_text(spark, f"{path}/{VERSIONS}/v{number:010d}.json")))


def _publish(spark: SparkSession, path: str, base: Version, changes: dict[str, str]) -> Version:
    """The version after ``base`` in which ``changes`` are current.

    Others may have published in between; what they changed is kept, unless it is the same partition.
    """
    while True:
        last = version(spark, path)
        if any(last.of(key) != base.of(key) for key in changes):
            raise Conflict(f"{path}: a partition was replaced by another rewrite")
        following = Version(last.number + 1, {**last.generations, **changes})
        if publish_text(spark, f"{path}/{VERSIONS}/v{following.number:010d}.json", json.dumps(following.generations, sort_keys=True)):
            return following


def key_of(values: Iterable) -> str:
    return SEPARATOR.join(str(v) for v in values)


def _key(partitions: Sequence[str]) -> Column:
    return F.concat_ws(SEPARATOR, *[F.col(f"`{c}`").cast("string") for c in partitions])


def _current(at: Version, partitions: Sequence[str]) -> Column:
    """The current generation of a row's partition."""
    if not at.generations:
        return F.lit(FIRST)
    known = F.create_map(*[F.lit(x) for pair in sorted(at.generations.items()) for x in pair])
    return F.coalesce(F.element_at(known, _key(partitions)), F.lit(FIRST))


# --- tables --------------------------------------------------------------------------------

def _write(rows: DataFrame, path: str, partitions: Sequence[str], order: Sequence[str], rebalance: bool) -> int:
    """Append by partition and generation; returns the number of rows.

    The rebalance lets Spark size the files by measured bytes: it splits a large partition value over
    several tasks and packs small ones together. Sorting by the usual filter columns makes the
    row-group statistics selective; the sort begins with all partition columns, none of them null, as
    the writer would else sort every row again by those. Rows are counted in the last stage, where a
    repeated task counts once.
    """
    texts = [c for c in partitions if isinstance(rows.schema[c].dataType, T.StringType)]
    rows = rows.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in texts})
    if rebalance:
        rows = rows.hint("rebalance", *partitions)
    written = Observation()
    (
        rows.observe(written, F.count(F.lit(1)).alias("n"))
        .sortWithinPartitions(*partitions, GENERATION, *order)
        .write.mode("append").partitionBy(*partitions, GENERATION).parquet(path)
    )
    return written.get["n"]


def append(
    rows: DataFrame, path: str, partitions: Sequence[str], order: Sequence[str], rebalance: bool = True
) -> int:
    """Append rows to the current generations; returns how many.

    If one of them was replaced meanwhile, the rows are appended once more, to the new ones: the
    tables' keys fold what is there twice.
    """
    spark = rows.sparkSession
    while True:
        at = version(spark, path)
        n = _write(rows.withColumn(GENERATION, F.concat(_current(at, partitions), F.lit(APPENDED))), path, partitions, order, rebalance)
        if version(spark, path) == at:
            return n


def read(
    spark: SparkSession, path: str, schema: T.StructType, partitions: Sequence[str],
    at: Version | None = None, clean: Iterable[str] = (),
) -> DataFrame:
    """The rows of the last version, or of one given, appended ones included.

    Of partitions that the caller found ``clean`` no appended rows are read, though a load may have
    added some since. A table that does not exist yet is empty. The schema keeps Spark from guessing
    types of partitions; the generation is a partition, so others are not even opened.
    """
    at = at or version(spark, path)
    whole = T.StructType([*schema.fields, T.StructField(GENERATION, T.StringType())])
    try:
        rows = spark.read.schema(whole).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise
    current, clean = _current(at, partitions), list(clean)
    appended = F.col(GENERATION) == F.concat(current, F.lit(APPENDED))
    if clean:
        appended &= ~_key(partitions).isin(clean)
    return rows.where((F.col(GENERATION) == current) | appended).select(schema.names)


def _directories(spark: SparkSession, path: str, partitions: Sequence[str]) -> dict[str, dict[str, str]]:
    """The generations of each partition, and where they lie."""
    found: dict[str, dict[str, str]] = {}
    for directory in list_paths(spark, f"{path}/" + "/".join(f"{c}=*" for c in [*partitions, GENERATION])):
        *values, generation = [unquote(part.split("=", 1)[1]) for part in directory.split("/")[-len(partitions) - 1:]]
        found.setdefault(key_of(values), {})[generation] = directory
    return found


def live_partitions(spark: SparkSession, path: str, partitions: Sequence[str], at: Version | None = None) -> dict[str, bool]:
    """The partitions that hold files of a version, by default the last, and whether each is clean."""
    at, out = at or version(spark, path), {}
    for key, generations in _directories(spark, path, partitions).items():
        appended = at.of(key) + APPENDED in generations
        if appended or at.of(key) in generations:
            out[key] = not appended
    return out


def _appended_files(spark: SparkSession, path: str, partitions: Sequence[str], at: Version, keys: Iterable[str]) -> list[str]:
    wanted, out = set(keys), []
    for key, generations in _directories(spark, path, partitions).items():
        if key in wanted and (directory := generations.get(at.of(key) + APPENDED)):
            out += list_paths(spark, f"{literal_path(directory)}/*.parquet")
    return out


def replace(
    spark: SparkSession, path: str, schema: T.StructType, partitions: Sequence[str], order: Sequence[str],
    keys: Iterable[str], change: Callable[[DataFrame], DataFrame],
) -> Version:
    """Replace the partitions named by ``keys`` (``key_of``) by ``change(rows)`` of their rows.

    ``change`` must leave rows in their partitions, each key once. Raises ``Conflict``, and changes
    nothing, if another rewrite got into one of the partitions meanwhile. Files that a load added
    meanwhile are appended to the new generations; a load that ends later sees to that itself.
    """
    keys = sorted(set(keys))
    at = version(spark, path)
    before = _appended_files(spark, path, partitions, at, keys)
    rows = read(spark, path, schema, partitions, at).where(_key(partitions).isin(keys))
    generation = uuid.uuid4().hex
    _write(change(rows).select(schema.names).withColumn(GENERATION, F.lit(generation)), path, partitions, order, True)
    done = _publish(spark, path, at, dict.fromkeys(keys, generation))
    late = sorted(set(_appended_files(spark, path, partitions, at, keys)) - set(before))
    if late:
        rows = spark.read.schema(schema).option("basePath", path).parquet(*map(literal_path, late))
        append(rows, path, partitions, order)
    return done


def remove_superseded(spark: SparkSession, path: str, partitions: Sequence[str]) -> int:
    """Delete generations that the last version does not use; returns how many.

    Run it when no rewrite is under way and no query planned on an earlier version is running.
    """
    at, removed = version(spark, path), 0
    for key, generations in _directories(spark, path, partitions).items():
        for generation, directory in generations.items():
            if generation.removesuffix(APPENDED) != at.of(key):
                remove(spark, directory)
                removed += 1
    return removed
