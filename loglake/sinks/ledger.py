"""Which archive files are loaded: a table of what loads say about files.

A load *claims* the files it is about to read, and when all their rows are stored it enters them as
*loaded*, with size, time of change, a digest of their rows and their number. A file that is in the
ledger with the same size and time is done, whatever its rows were; one whose size or time differ
is read, and loaded again if its rows differ. Entries are kept by target, so a load into one store
never hides work left for the other.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.schema import LEDGER
from loglake.sinks import versions
from loglake.sinks.lake import Lake, moment, read_rejects

PARTITIONS, SORT = ("target",), ("file_path",)
CLAIMED, LOADED, RELEASED = "claimed", "loaded", "released"
#: A claim older than this is taken to be of a load that died.
LEASE = timedelta(hours=1)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All entries."""
    return versions.read(spark, path, LEDGER, PARTITIONS)


def loaded_files(entries: DataFrame) -> DataFrame:
    """The last ``loaded`` entry of each file and target: what is stored of it."""
    last = F.max(F.struct("written_at", "load_id", "file_size", "modified", "digest", "rows_in", "rejected")).alias("last")
    return entries.where(F.col("state") == LOADED).groupBy("target", "file_path").agg(last).select(
        "target", "file_path", "last.file_size", "last.modified", "last.digest", "last.written_at", "last.rows_in",
        "last.rejected")


def open_claims(entries: DataFrame, now: datetime, lease: timedelta = LEASE) -> DataFrame:
    """The claim that holds each file and target: the first of those neither ended nor too old."""
    ends = F.max(F.when(F.col("state") != CLAIMED, F.col("written_at")))
    each = entries.groupBy("target", "file_path", "load_id").agg(
        F.min(F.when(F.col("state") == CLAIMED, F.col("written_at"))).alias("claimed_at"), ends.alias("ended_at"))
    held = each.where(
        F.col("claimed_at").isNotNull() & F.col("ended_at").isNull() & (F.col("claimed_at") > moment(now - lease)))
    return held.groupBy("target", "file_path").agg(F.min(F.struct("claimed_at", "load_id")).alias("first")).select(
        "target", "file_path", F.col("first.load_id").alias("held_by"))


def _targets(files: DataFrame, targets: Iterable[str]) -> DataFrame:
    return files.withColumn("target", F.explode(F.array(*[F.lit(t) for t in targets])))


def file_states(
    files: DataFrame, entries: DataFrame, targets: Iterable[str], now: datetime, lease: timedelta = LEASE,
) -> DataFrame:
    """``files`` (``file_path, file_size, modified``) with their ``status`` over all targets.

    ``loaded``: every target has the file as it is now. ``claimed``: a load that has not ended holds it.
    ``changed``: some target has the file, but with another size or time. ``new``: all else.
    """
    done = loaded_files(entries).select(
        "target", "file_path", F.col("file_size").alias("old_size"), F.col("modified").alias("old_modified"))
    rows = _targets(files, targets).join(done, ["target", "file_path"], "left").join(
        open_claims(entries, now, lease), ["target", "file_path"], "left")
    same = (F.col("old_size") == F.col("file_size")) & (F.col("old_modified") == F.col("modified"))
    status = (
        F.when(F.bool_and(F.coalesce(same, F.lit(False))), LOADED)
        .when(F.bool_or(F.col("held_by").isNotNull()), CLAIMED)
        .when(F.bool_or(F.col("old_size").isNotNull()), "changed").otherwise("new"))
    return rows.groupBy("file_path", "file_size", "modified").agg(status.alias("status"))


def row_digest(columns: Iterable[str]) -> Column:
    """An aggregate over rows that does not depend on their order."""
    each = F.xxhash64(*columns)
    total = F.coalesce(F.sum(each.cast("decimal(20,0)")), F.lit(0)).cast("string")
    return F.concat_ws(":", F.count(F.lit(1)).cast("string"), total, F.coalesce(F.bit_xor(each), F.lit(0)).cast("string"))


def unchanged_rows(digests: DataFrame, entries: DataFrame, targets: Iterable[str]) -> DataFrame:
    """Of the files with digests (``file_path, digest``), those whose rows every target has already."""
    targets = list(targets)
    done = loaded_files(entries).where(F.col("target").isin(targets)).select("target", "file_path", "digest")
    return digests.join(done, ["file_path", "digest"]).groupBy("file_path").agg(
        F.count_distinct("target").alias("n")).where(F.col("n") == len(targets)).select("file_path")


def enter(
    files: DataFrame, path: str, targets: Iterable[str], state: str, load_id: str, now: datetime
) -> None:
    """Append an entry for each file and target; ``files`` may carry ``digest, rows_in, rejected``."""
    kinds = {f.name: f.dataType for f in LEDGER.fields}
    given = {"state": F.lit(state), "load_id": F.lit(load_id), "written_at": moment(now)}
    rows = _targets(files, targets)
    rows = rows.select(*[
        (given.get(n) if n in given else F.col(n) if n in rows.columns else F.lit(None)).cast(kinds[n]).alias(n)
        for n in LEDGER.names])
    versions.append(rows, path, PARTITIONS, SORT)


def claim(
    files: DataFrame, path: str, targets: Iterable[str], load_id: str, now: datetime, lease: timedelta = LEASE
) -> DataFrame:
    """Claim files for a load; returns those it holds. Of several claims the first holds, others are given back.

    Two loads whose clocks differ can both hold a file; the keys of what they store absorb that.
    """
    spark, targets = files.sparkSession, list(targets)
    enter(files, path, targets, CLAIMED, load_id, now)
    held = open_claims(read_ledger(spark, path), now, lease).where(F.col("held_by") != load_id)
    held = held.join(files.select("file_path"), "file_path", "left_semi")
    others = [row[0] for row in held.where(F.col("target").isin(targets)).select("file_path").distinct().collect()]
    if not others:
        return files
    lost = F.col("file_path").isin(others)  # some of the files that the caller listed
    enter(files.where(lost), path, targets, RELEASED, load_id, now)
    return files.where(~lost)


def compact_ledger(spark: SparkSession, path: str) -> None:
    """Keep the last ``loaded`` entry of each file and target, and the entries of loads under way."""

    def fold(entries: DataFrame) -> DataFrame:
        ended = entries.where(F.col("state") != CLAIMED).select("target", "file_path", "load_id").distinct()
        last = loaded_files(entries).select("target", "file_path", F.col("written_at").alias("last_at"))
        kept = entries.where(F.col("state") == LOADED).join(last, ["target", "file_path"]).where(
            F.col("written_at") == F.col("last_at")).select(LEDGER.names).dropDuplicates(["target", "file_path"])
        under_way = entries.where(F.col("state") == CLAIMED).join(ended, ["target", "file_path", "load_id"], "left_anti")
        return kept.unionByName(under_way.select(LEDGER.names))

    keys = versions.live_partitions(spark, path, PARTITIONS)
    if keys:
        versions.replace(spark, path, LEDGER, PARTITIONS, SORT, keys, fold)


def current_rejects(spark: SparkSession, lake: Lake) -> DataFrame:
    """The rejects, without those of a file that was loaded anew since and no longer has them."""
    last = loaded_files(read_ledger(spark, lake.ledger)).groupBy("file_path").agg(F.max("written_at").alias("loaded_at"))
    rejects = read_rejects(spark, lake.rejects)
    return rejects.join(last, "file_path", "left").where(
        F.col("loaded_at").isNull() | (F.col("load_time") >= F.col("loaded_at"))).select(rejects.columns)
