"""Operational CSV archives: gzip, latin-1, no header."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglake.schema import CSV_TO_ALOG, OPS_CSV

# Encoding, time format, and the leading columns the slim reader keeps.
ENCODING = "ISO-8859-1"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
SLIM_COLUMNS = tuple(OPS_CSV.names[:10])
MALFORMED = "_malformed"


def read_ops_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    schema: T.StructType = OPS_CSV,
    partitions: int | None = None,
    multi_line: bool = True,
    recursive: bool = False,
    name_pattern: str | None = None,
    malformed: bool = False,
) -> DataFrame:
    """CSV files, globs or directories as one DataFrame with a ``file_path`` column.

    A gzip file is always one task, so ``partitions`` spreads the rows before heavy work.
    ``multi_line`` lets quoted log text hold line breaks; turn it off for uncompressed files
    without any, which Spark can then split. ``malformed`` adds ``_malformed``: the text of a row
    with cells missing or unreadable, null for all others.
    """
    options = {
        "encoding": ENCODING,
        "timestampFormat": TIME_FORMAT,
        "quote": '"',
        "escape": '"',
        "multiLine": str(multi_line).lower(),
        "recursiveFileLookup": str(recursive).lower(),
    }
    if name_pattern is not None:
        options["pathGlobFilter"] = name_pattern
    kept = list(columns or schema.names)
    if malformed:
        # A row is judged by all its cells, so none may be left out of the parse.
        options |= {"columnNameOfCorruptRecord": MALFORMED, "columnPruning": "false"}
        schema = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
        kept.append(MALFORMED)
    rows = spark.read.schema(schema).options(**options).csv(
        paths if isinstance(paths, str) else list(paths)
    )
    rows = rows.select(*kept, F.col("_metadata.file_path").alias("file_path"))
    return rows if partitions is None else rows.repartition(partitions)


def normalise_csv(rows: DataFrame) -> DataFrame:
    """CSV names to database names; empty text instead of null, but for ``_malformed``."""
    named = rows.withColumnsRenamed(CSV_TO_ALOG)
    return named.na.fill("", [c for c in named.columns if c != MALFORMED])


def list_files(
    spark: SparkSession, paths: str | Sequence[str], name_pattern: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Path and size of every file. The contents are never opened: only listed columns are used."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if name_pattern is not None:
        reader = reader.option("pathGlobFilter", name_pattern)
    return reader.load(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("length").alias("file_size")
    )


def fingerprints(
    spark: SparkSession, paths: str | Sequence[str], name_pattern: str | None = None, recursive: bool = False,
) -> DataFrame:
    """``file_path, path, file_size, modified`` of every file, without opening any.

    ``file_path`` is spelled as rows of the file carry it, ``path`` as a reader takes it.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if name_pattern is not None:
        reader = reader.option("pathGlobFilter", name_pattern)
    return reader.load(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("file_path"), "path", F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified"))
