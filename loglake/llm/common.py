"""Tables, stored intermediate results and small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.session import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read from there.

    Cuts the lineage: a lost executor costs the tasks it ran, not the whole history, and later
    steps all see the same rows.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
