"""Exchange files: datapoint payloads, put lines, JSON documents, CSV archives."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.schema import OPS_CSV
from loglake.sources.archives import ENCODING, TIME_FORMAT

DEFAULT_BATCH = 10_000


def points_payload(points: DataFrame, batch_size: int = DEFAULT_BATCH) -> DataFrame:
    """JSON arrays of at most ``batch_size`` datapoints (columns ``n``, ``value``).

    Rows are serialised in Spark and joined within their own partition, so nothing is shuffled
    and a task never holds more than a batch.
    """

    def payload(held: list[str]) -> pd.DataFrame:
        return pd.DataFrame({"n": [len(held)], "value": ["[" + ",".join(held) + "]"]})

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[str] = []
        for frame in frames:
            held += frame["value"].tolist()
            whole = len(held) // batch_size * batch_size
            for start in range(0, whole, batch_size):
                yield payload(held[start:start + batch_size])
            held = held[whole:]
        if held:
            yield payload(held)

    texts = points.select(F.to_json(F.struct("name", "timestamp", "value", "tags")).alias("value"))
    return texts.mapInPandas(join, "n bigint, value string")


def write_lines(lines: DataFrame, path: str, compression: str = "gzip", mode: str = "error") -> None:
    """The column ``value`` as text lines: payloads, put lines or JSON documents."""
    lines.select("value").write.mode(mode).option("compression", compression).text(path)


def write_ops_csv(
    records: DataFrame, path: str, mode: str = "error", partition_by: Sequence[str] = ()
) -> None:
    """CSV-shaped records as gzip archive parts, latin-1, without a header.

    Characters outside latin-1 are written as ``?``. ``partition_by`` names further columns whose
    values become directories, such as the date of an archive.
    """
    writer = records.select(*OPS_CSV.names, *partition_by).write.mode(mode).options(
        encoding=ENCODING, timestampFormat=TIME_FORMAT, compression="gzip",
        quote='"', escape='"', emptyValue="",
    )
    writer.partitionBy(*partition_by).csv(path)
