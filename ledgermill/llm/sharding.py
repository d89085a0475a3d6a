"""Placement of rows on shards through a lookup table that shards fill by turns."""

from __future__ import annotations

from hashlib import md5

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Slots of the table, a prime; a table never has more rows than this, so it can be broadcast.
SLOTS = 65_537


def lookup_table(shards: list[str], slots: int = SLOTS) -> np.ndarray:
    """Number of the shard that holds each slot.

    Every shard prefers the slots in an order of its own: it starts at an offset and goes on by a step, both hashed
    from its name, which visits all slots because their number is prime. Shards take turns; each claims the first
    slot of its order that is free. Slots of any two shards differ by one at most, and when a shard leaves, few slots
    of the others change hands. Names must be distinct, and there must be fewer than slots.
    """
    if len(set(shards)) != len(shards) or not 0 < len(shards) <= slots:
        raise ValueError("shards must be distinct, at least one, and no more than slots")
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    places, steps = [], []
    for name in shards:
        digest = md5(name.encode()).digest()
        places.append(int.from_bytes(digest[:8], "big") % slots)
        steps.append(int.from_bytes(digest[8:], "big") % (slots - 1) + 1)
    holder = [-1] * slots
    left = slots
    while True:
        for shard, step in enumerate(steps):
            place = places[shard]
            while holder[place] >= 0:
                place = (place + step) % slots
            holder[place] = shard
            places[shard] = (place + step) % slots
            left -= 1
            if not left:
                return np.array(holder)


def slot(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key, the same in any engine: 15 hex digits of the md5 of its text. Null counts as the empty text."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(slots))


def assign_shards(rows: DataFrame, shards: list[str], key_col: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """`rows` with `slot` and `shard`, the name of the shard the key's slot belongs to.

    The table has `slots` rows, whatever the data, and is broadcast; rows are not shuffled. Rows with equal keys
    share a shard; null keys are placed as an empty key. Columns of `rows` named `slot` or `shard` are replaced.
    """
    holder = lookup_table(shards, slots)
    table = rows.sparkSession.createDataFrame(
        [(i, shards[k]) for i, k in enumerate(holder.tolist())], "slot bigint, shard string")
    others = [c for c in rows.columns if c.lower() not in ("slot", "shard")]
    keyed = rows.select(*[F.col(f"`{c}`") for c in others], slot(F.col(key_col), slots).alias("slot"))
    return keyed.join(F.broadcast(table), "slot").select(*[F.col(f"`{c}`") for c in others], "slot", "shard")


def write_shards(rows: DataFrame, path: str, shards: list[str], key_col: str = "doc_id", slots: int = SLOTS) -> None:
    """Write each shard to a folder of its own. A large shard is written by several tasks."""
    placed = assign_shards(rows, shards, key_col, slots)
    placed.hint("rebalance", "shard").drop("slot").write.partitionBy("shard").mode("overwrite").parquet(path)
