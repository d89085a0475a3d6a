"""Date spines, islands of contiguous days, and filling of gaps."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_range(spark, start: date, end: date, name: str = "data") -> DataFrame:
    """All days from `start` to `end`, both included; none if they are reversed."""
    bounds = spark.range(1).select(F.lit(start).alias("a"), F.lit(end).alias("b")).where("a <= b")
    return bounds.select(F.explode(F.sequence("a", "b")).alias(name))


def days_of_months(months: DataFrame, month: str, start: date | None = None, end: date | None = None,
                   name: str = "data") -> DataFrame:
    """All days of the given distinct months (first days), clipped to the bounds."""
    first = F.greatest(F.col(month), F.lit(start).cast("date"))
    last = F.least(F.last_day(month), F.lit(end).cast("date"))
    clipped = months.where(F.col(month).isNotNull()).select(first.alias("a"), last.alias("b")).where("a <= b")
    return clipped.select(F.explode(F.sequence("a", "b")).alias(name))


def contiguous_ranges(days: DataFrame, day: str) -> DataFrame:
    """Ranges of consecutive days. Distinct days are at most a calendar's worth, so one task may order them."""
    distinct = days.select(day).where(F.col(day).isNotNull()).distinct()
    island = F.date_sub(F.col(day), F.row_number().over(Window.orderBy(day)))
    return (
        distinct.withColumn("__island", island).groupBy("__island")
        .agg(F.min(day).alias("inicio"), F.max(day).alias("fim")).drop("__island")
    )


def fill_forward(df: DataFrame, by: str, order: str, columns: list[str]) -> DataFrame:
    """Fill nulls of each column with its last value before, per group."""
    so_far = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in columns})
