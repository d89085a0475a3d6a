"""Column names of incoming tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tidy_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Expected columns {', '.join(required)}; missing {', '.join(missing)}")
    return df


def with_optional(df: DataFrame, column: str, *substitutes: str) -> DataFrame:
    """Make sure `column` exists: from the first substitute there is, else null."""
    if column in df.columns:
        return df
    source = next((F.col(c) for c in substitutes if c in df.columns), F.lit(None).cast("string"))
    return df.withColumn(column, source)
