"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Column with the position of a row in its source, written by the landing step.
ORDINAL = "_ingest_order"


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key that comes first in `order`.

    Spark puts the limit of one row per key before the shuffle as well, so a key with very many rows reaches its
    task already reduced to one row per input partition.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__position", position).where(F.col("__position") == 1).drop("__position")


def arrival(df: DataFrame, descending: bool = False) -> list[Column]:
    """Order of arrival: the ingest ordinal, or all columns where a table has none."""
    names = [ORDINAL] if ORDINAL in df.columns else df.columns
    return [F.col(c).desc() if descending else F.col(c).asc() for c in names]


def first_arrived(df: DataFrame, keys: list[str]) -> DataFrame:
    return keep_first(df, keys, arrival(df))


def last_arrived(df: DataFrame, keys: list[str]) -> DataFrame:
    return keep_first(df, keys, arrival(df, descending=True))


def best_labelled(df: DataFrame, key: str, preferred: list[str]) -> DataFrame:
    """One row per key: rows with the earlier `preferred` columns filled win, then the first arrived."""
    return keep_first(df, [key], [*(F.col(c).isNull() for c in preferred), *arrival(df)])
