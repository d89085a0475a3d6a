"""Positions in a global order, without sorting everything in one task.

Rows are range-partitioned by the ordering, each partition is numbered on its own, and the sizes of the partitions
before it are added. The partitioned rows are written once in between, because range boundaries are sampled and must
not change between numbering and adding. The number of partitions is left to the planner, which joins neighbouring
ranges of small tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialise
from .lookups import lookup_join

# `monotonically_increasing_id` keeps the partition above this bit and the row number below it.
_PARTITION_SHIFT = 33


def dense_key(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """Add `name`: 1..n in the given order. The order should be total, or ties get an arbitrary order."""
    placed = materialise(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("__place", F.monotonically_increasing_id())
    ).withColumn("__block", F.shiftright("__place", _PARTITION_SHIFT))
    # One row per partition, so one task and a broadcast are enough.
    sizes = placed.groupBy("__block").agg(F.count(F.lit(1)).alias("__rows"))
    before = F.sum("__rows").over(Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__block", F.coalesce(before, F.lit(0)).alias("__before"))
    within = F.col("__place") - F.shiftleft("__block", _PARTITION_SHIFT)
    return (
        placed.join(F.broadcast(offsets), "__block")
        .withColumn(name, F.col("__before") + within + 1)
        .select(name, *df.columns)
    )


def continued_key(df: DataFrame, name: str, order: list[str], on: list[str], existing: DataFrame | None) -> DataFrame:
    """As `dense_key`, but rows whose natural key `on` is in `existing` keep its number, and new rows are numbered on
    after the highest one."""
    if existing is None:
        return dense_key(df, name, order)
    known = existing.select(*on, name)
    highest = F.coalesce(existing.agg(F.max(name)).scalar(), F.lit(0))
    new = dense_key(lookup_join(df, known.select(*on), on, "left_anti", null_safe=True), name, order)
    held = lookup_join(df, known, on, "inner", null_safe=True).select(name, *df.columns)
    return held.unionByName(new.withColumn(name, F.col(name) + highest))


def value_positions(df: DataFrame, value: str, by: list[str] = []) -> DataFrame:
    """For each distinct non-null value (per group): `eq` rows hold it, `less` rows are below it, `total` in all.

    Ranks and exact quantiles follow from these counts. Groups in `by` may be large but must be few.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("eq"))
    placed = materialise(
        counts.repartitionByRange(*by, value).withColumn("__block", F.spark_partition_id())
    )
    # At most one row per partition and group.
    block = Window.partitionBy(*by).orderBy("__block")
    rows = F.sum("__rows")
    sizes = (
        placed.groupBy(*by, "__block").agg(F.sum("eq").alias("__rows"))
        .withColumn("__before", F.coalesce(rows.over(block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("total", rows.over(Window.partitionBy(*by)))
        .drop("__rows")
    )
    inside = Window.partitionBy(*by, "__block").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("__inside", F.coalesce(F.sum("eq").over(inside), F.lit(0)))
        .join(F.broadcast(sizes), [*by, "__block"])
        .select(*by, value, (F.col("__before") + F.col("__inside")).alias("less"), "eq", "total")
    )


def average_rank() -> Column:
    """Rank of a value by `value_positions`, equal values sharing the mean of their ranks."""
    return F.col("less") + (F.col("eq") + 1) / 2


def quantile(value: str, share: Column | float) -> Column:
    """Aggregate over `value_positions`: the linearly interpolated quantile."""
    exact = (F.col("total") - 1) * share
    low, high = F.floor(exact), F.ceil(exact)

    def at(place: Column) -> Column:
        here = (F.col("less") <= place) & (place < F.col("less") + F.col("eq"))
        return F.max(F.when(here, F.col(value)))

    return at(low) + (at(high) - at(low)) * F.max(exact - low)
