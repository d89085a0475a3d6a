"""JDBC targets, written for PostgreSQL. Its driver must be on the session's class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.append import new_keys_only
from ..schemas import GOLD_KEYS
from .shared import materialise

INSERT_BATCH = 5000
CONNECTIONS = 8


def _read(spark: SparkSession, url: str, relation: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=relation, **options).load()


def _catalogue_entry(table: str) -> str:
    schema, _, name = table.rpartition(".")
    return (
        "(select table_name from information_schema.tables"
        f" where table_schema = '{schema or 'public'}' and table_name = '{name}') found"
    )


def table_exists(spark: SparkSession, url: str, table: str, **options: str) -> bool:
    return not _read(spark, url, _catalogue_entry(table), **options).isEmpty()


def read_keys(spark: SparkSession, url: str, table: str, keys: list[str], connections: int = CONNECTIONS,
              **options: str) -> DataFrame:
    """Distinct key values of a target; only the key columns leave the database.

    A table with a numeric key is read in ranges of it, over several connections.
    """
    relation = f"(select {', '.join(keys)} from {table}) held"
    found = _read(spark, url, relation, **options)
    if isinstance(found.schema[keys[0]].dataType, T.IntegralType):
        bounds = f"(select min({keys[0]}) as low, max({keys[0]}) as high from {table}) bounds"
        low, high = _read(spark, url, bounds, **options).first()
        if low is not None:
            found = _read(spark, url, relation, partitionColumn=keys[0], lowerBound=low, upperBound=high,
                          numPartitions=connections, **options)
    return found.distinct()


def insert_options(url: str, table: str, connections: int = CONNECTIONS, **options: str) -> dict:
    return dict(url=url, dbtable=table, batchsize=INSERT_BATCH, numPartitions=connections) | options


def _insert(df: DataFrame, mode: str, options: dict) -> None:
    # The number of connections also limits the tasks that compute the rows, so they are computed and written before.
    materialise(df).write.format("jdbc").mode(mode).options(**options).save()


def replace_table(df: DataFrame, url: str, table: str, connections: int = CONNECTIONS, **options: str) -> None:
    """Empty the target, keeping its definition, and insert in batches over at most `connections` connections."""
    _insert(df, "overwrite", insert_options(url, table, connections, truncate="true", **options))


def append_new(df: DataFrame, url: str, table: str, keys: list[str], connections: int = CONNECTIONS,
               **options: str) -> None:
    """Insert only rows whose key the target does not hold."""
    if table_exists(df.sparkSession, url, table, **options):
        df = new_keys_only(df, read_keys(df.sparkSession, url, table, keys, connections, **options), keys)
    _insert(df, "append", insert_options(url, table, connections, **options))


def load_star(tables: dict[str, DataFrame], url: str, mode: str = "replace", schema: str = "public",
              connections: int = CONNECTIONS, **options: str) -> None:
    """Load all star tables, dimensions before the facts that refer to them."""
    if mode not in ("replace", "append"):
        raise ValueError("Supported write modes: replace, append")
    for name, keys in GOLD_KEYS.items():
        target = f"{schema}.{name}"
        if mode == "replace":
            replace_table(tables[name], url, target, connections, **options)
        else:
            append_new(tables[name], url, target, keys, connections, **options)
