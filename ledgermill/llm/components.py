"""Connected components of links between integer ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialise


def connected_components(links: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """`id`, `component`: for each linked id the smallest id that links reach from it.

    Alternates two steps that hang every id under smaller ones of its neighbourhood until each hangs under its
    component's smallest id; the number of rounds grows with the logarithm of the longest chain. Every round is
    written to the shared folder. Neighbourhoods are only ever reduced to their minimum, so a hub with very many
    links is not gathered anywhere. Links with a null end and links of an id to itself are ignored; repeated links
    count once; no links give no rows.
    """
    tree = links.select(
        F.greatest(first, second).cast("bigint").alias("child"), F.least(first, second).cast("bigint").alias("parent"),
    ).where(F.col(first).isNotNull() & F.col(second).isNotNull() & (F.col("child") != F.col("parent"))).distinct()
    tree, before = materialise(tree), None
    while True:
        tree = materialise(_under_smaller(_around(tree)))
        state = tree.agg(F.count(F.lit(1)), F.sum(F.xxhash64("child", "parent").cast("decimal(38,0)"))).first()
        if state == before:
            return tree.select(F.col("child").alias("id"), F.col("parent").alias("component")).union(
                tree.select("parent", "parent").distinct())
        before = state


def _around(tree: DataFrame) -> DataFrame:
    """Hang each id's larger neighbours under its smallest neighbour."""
    both = tree.select(F.col("child").alias("id"), F.col("parent").alias("near")).union(
        tree.select("parent", "child"))
    least = both.groupBy("id").agg(F.min("near").alias("least"))
    least = least.select("id", F.least("id", "least").alias("least"))
    return both.where("near > id").join(least, "id").select(
        F.col("near").alias("child"), F.col("least").alias("parent")).distinct()


def _under_smaller(tree: DataFrame) -> DataFrame:
    """Hang each id and its smaller neighbours under the smallest of them."""
    least = tree.groupBy("child").agg(F.min("parent").alias("least"))
    others = tree.join(least, "child").where("parent != least").select(
        F.col("parent").alias("child"), F.col("least").alias("parent"))
    return others.union(least.select("child", "least")).distinct()
