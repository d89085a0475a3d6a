"""Best-fit packing of documents into bins of fixed size, apart from others of their source and of their copies."""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialise

# Words a bin holds, and documents that are packed together, on average.
CAPACITY, GROUP_ROWS = 2048, 8192

_PLACED = "doc_id bigint, source string, cluster bigint, piece int, words bigint, first_word bigint, bin bigint, place bigint"


def word_count(text: Column) -> Column:
    """Words between blanks; null has none."""
    tidy = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\t\\n\\x0B\\f\\r]+", " "))
    return F.when(tidy == "", F.lit(0)).otherwise(F.length(tidy) - F.length(F.replace(tidy, F.lit(" "), F.lit(""))) + 1).cast("bigint")


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and place in it of each item, in the order given.

    Bins are kept in the order of the room left. Each has a bitmap of its sources and of its clusters. An item goes to
    the bin with the least room that is enough, and on to the next ones while bitmaps collide; if none is left it
    opens a bin. Items without words need no room and conflict with nothing: they go to the fullest bin. Negative sources and
    clusters conflict with nothing.
    """
    order: list[tuple[int, int]] = []
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    bins, places = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        one = 1 << source if source >= 0 and size else 0
        other = 1 << cluster if cluster >= 0 and size else 0
        at = bisect_left(order, (size, -1))
        while at < len(order) and (source_bits[order[at][1]] & one or cluster_bits[order[at][1]] & other):
            at += 1
        if at < len(order):
            room, chosen = order.pop(at)
        else:
            room, chosen = capacity, len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        bins.append(chosen)
        places.append(capacity - room)
        source_bits[chosen] |= one
        cluster_bits[chosen] |= other
        insort(order, (room - size, chosen))
    return bins, places


def _pack(key: tuple, rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    rows = rows.assign(rest=rows["words"] % capacity, whole=rows["words"] // capacity)
    rows = rows.sort_values(["rest", "doc_id", "cluster", "source"], ascending=[False, True, True, True], kind="stable")
    short = rows[(rows["rest"] > 0) | (rows["words"] == 0)]
    sources, _ = pd.factorize(short["source"])
    clusters, _ = pd.factorize(short["cluster"])
    copies = pd.Series(clusters).map(pd.Series(clusters).value_counts()).to_numpy()
    shared, _ = pd.factorize(pd.Series(clusters).where(copies > 1))
    bins, places = best_fit(short["rest"].tolist(), sources.tolist(), shared.tolist(), capacity)
    packed = short.assign(piece=short["whole"], first_word=short["whole"] * capacity, words=short["rest"], bin=bins, place=places)
    full = rows.loc[rows.index.repeat(rows["whole"])]
    piece = full.groupby(level=0).cumcount()
    full = full.assign(piece=piece, first_word=piece * capacity, words=capacity, place=0,
                       bin=np.arange(len(full)) + max(bins, default=-1) + 1)
    out = pd.concat([packed, full])
    out["bin"] = out["bin"].astype("int64") + (int(key[0]) << 32)
    return out[[part.split()[0] for part in _PLACED.split(", ")]]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         cluster: Column | None = None, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Where each piece of each document lies: `doc_id`, `source`, `cluster`, `piece`, `words`, `first_word` (of the
    piece in its document), `bin` and `place` (words before it in the bin).

    No bin holds more than `capacity` words, two documents of one source, or two of one `cluster` (by default: of equal
    text). A document longer than a bin is cut into full pieces with bins of their own, and the rest is packed like
    a short document; nothing is left out. Documents are packed in groups of about `group_rows`, dealt by a hash of
    their id, source, cluster, words and number among equal rows, largest first, so bins of different groups can be filled at the same time and neither memory nor time of
    a task grows with the data. A hot source opens bins; it does not slow the others.

    Null and empty texts are pieces without words; they conflict with nothing. Null sources conflict with nothing.
    Rows that repeat an id are packed as documents of their own, and dealt like any others. Other columns are ignored.
    """
    if not 0 < capacity < 1 << 31:
        raise ValueError("capacity must be positive")
    text = F.col(text_col).cast("string")
    same = F.xxhash64(F.coalesce(text, F.lit(""))) if cluster is None else cluster.cast("bigint")
    rows = materialise(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                                   same.alias("cluster"), word_count(text).alias("words")))
    groups = max(1, -(-rows.count() // group_rows))
    # Equal rows are counted and told apart by number, in two steps so that no array is long and no task makes them all.
    equal = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    first = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / group_rows) * group_rows, F.lit(group_rows).cast("bigint")))
    lots = equal.select("*", first.alias("first")).repartition("doc_id", "source", "cluster", "words", "first")
    number = F.explode(F.sequence("first", F.least(F.col("n"), F.col("first") + group_rows) - 1))
    own = F.pmod(F.xxhash64("doc_id", "source", "cluster", "words", "number"), F.lit(groups))
    rows = lots.select(*rows.columns, number.alias("number")).withColumn("group", own.cast("bigint")).drop("number")
    return rows.groupBy("group").applyInPandas(lambda key, frame: _pack(key, frame, capacity), _PLACED)
