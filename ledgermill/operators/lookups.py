"""Joins of a large table to a lookup table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialise

# A key is hot if it holds more than one part in this many of all rows.
HOT_PARTS = 10_000


def lookup_join(facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", *,
                null_safe: bool = False, split_hot: bool = False) -> DataFrame:
    """Join `facts` to `lookup`; for `left` and `inner` joins the lookup must be unique in `on`.

    The planner decides how: it knows the size of written tables, and learns that of computed ones while the query
    runs, so a lookup is broadcast only below the session's threshold, and partitions that turn out too large are split
    by the adaptive join. `split_hot` instead splits hot keys by their counts (`salted_join`), which helps where rows
    are too few bytes, or their work too great, for the adaptive join to notice.
    """
    join = salted_join if split_hot else _equi_join
    return join(facts, lookup, on, how, null_safe=null_safe)


def salted_join(facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", *,
                null_safe: bool = False, parts: int = HOT_PARTS) -> DataFrame:
    """Shuffled join in which no key sends more than about one part in `parts` of all rows to one task.

    Keys above that share are split in proportion to their size, and their lookup rows repeated once per split. At
    most `parts` keys can be above the share, and their splits add up to at most twice `parts`: both the broadcast
    list of hot keys and the repeated rows are bounded whatever the data. Rows are spread by a hash of their values,
    so a recomputed task sends each row where it went before; copies of a row stay apart if the rows carry an ordinal.
    `facts` are written once; the pass that finds the hot keys reads their key columns only.
    """
    facts = materialise(facts)
    splits, salt = "__splits", "__salt"
    counts = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows"))
    share = F.ceil(F.col("__rows") * parts / counts.agg(F.sum("__rows")).scalar())
    hot = materialise(counts.select(*on, share.cast("int").alias(splits)).where(F.col(splits) > 1))
    if hot.isEmpty():
        return _equi_join(facts, lookup, on, how, null_safe)

    spread = F.pmod(F.xxhash64(*facts.columns), F.coalesce(F.col(splits), F.lit(1)))
    salted_facts = (
        _equi_join(facts, F.broadcast(hot), on, "left", null_safe=True)
        .withColumn(salt, spread.cast("int")).drop(splits)
    )
    copies = F.sequence(F.lit(0), F.coalesce(F.col(splits), F.lit(1)) - 1)
    salted_lookup = (
        _equi_join(lookup, F.broadcast(hot), on, "left", null_safe=True)
        .withColumn(salt, F.explode(copies)).drop(splits)
    )
    return _equi_join(salted_facts, salted_lookup, on, how, null_safe, extra=[salt]).drop(salt)


def _equi_join(left: DataFrame, right: DataFrame, on: list[str], how: str, null_safe: bool = False,
               extra: list[str] = []) -> DataFrame:
    if not null_safe:
        return left.join(right, [*on, *extra], how)
    names = {c: f"__right_{c}" for c in [*on, *extra]}
    renamed = right.withColumnsRenamed(names)

    def same(c: str) -> Column:
        return F.col(c).eqNullSafe(F.col(names[c])) if c in on else F.col(c) == F.col(names[c])

    joined = left.join(renamed, reduce(Column.__and__, [same(c) for c in names]), how)
    return joined.drop(*names.values())
