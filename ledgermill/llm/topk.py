"""Exact top-k search by inner product: a KD-tree for each shard of the vectors, searched leaf by leaf, best box first."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import dense_key
from ..sources.shared import materialise, spread

# Neighbours of a query, and by what a vector is made of whole numbers.
TOP, SCALE = 10, 1024
# Components of a tree's vectors and of a block of queries, and vectors of a leaf.
SHARD_VALUES, QUERY_VALUES, LEAF_ROWS = 1 << 18, 1 << 22, 64
# Rows are searched in rounds, each over this many times the rows of all rounds before, once a first one has enough.
ROUND_GROWTH, FIRST_ROUND_ROWS = 16, 1 << 16
_BUCKETS = 1 << 16

_LEAST, _MOST = -(1 << 63) + 1, (1 << 63) - 1
_FOUND = "query bigint, vec_id bigint, score bigint"


@dataclass
class Tree:
    """Vectors in the order of the leaves; for each node its box, smallest id, and children or rows."""

    vectors: np.ndarray
    ids: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least_id: np.ndarray
    children: list[tuple[int, int] | None]
    spans: list[tuple[int, int]]

    @classmethod
    def build(cls, vectors: np.ndarray, ids: np.ndarray) -> Tree:
        """Split at the median of the widest side until `LEAF_ROWS` are left; boxes are those of the rows themselves."""
        order, spans, children = np.arange(len(ids)), [(0, len(ids))], []
        low, high, least = [], [], []
        for begin, end in spans:  # grows while nodes are split
            own = vectors[order[begin:end]]
            low.append(own.min(axis=0))
            high.append(own.max(axis=0))
            least.append(ids[order[begin:end]].min())
            if end - begin <= LEAF_ROWS or not own.shape[1] or (low[-1] == high[-1]).all():
                children.append(None)
                continue
            # As doubles, since the width of a side may be beyond a long.
            side = (high[-1].astype(float) - low[-1].astype(float)).argmax()
            middle = (end - begin) // 2
            order[begin:end] = order[begin:end][np.argpartition(own[:, side], middle)]
            children.append((len(spans), len(spans) + 1))
            spans += [(begin, begin + middle), (begin + middle, end)]
        return cls(vectors[order], ids[order], np.array(low), np.array(high), np.array(least), children, spans)


def _kind(one: np.ndarray, other: np.ndarray) -> type:
    """The fastest type in which inner products are exact."""
    most = lambda x: max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    largest = most(one) * most(other) * max(1, one.shape[-1])
    return np.float64 if largest < 1 << 53 else np.int64 if largest < 1 << 62 else object


def _whole(products: np.ndarray) -> np.ndarray:
    """Inner products as longs; what is beyond a long becomes the nearest one."""
    if products.dtype == object:
        products = np.clip(products, _LEAST + 1, _MOST)
    return products.astype(np.int64)


@dataclass
class Answers:
    """The best of a block of queries of one width: scores and ids, best first, and what must at least be reached."""

    places: np.ndarray
    ids: np.ndarray
    vectors: np.ndarray
    top: int
    floor: np.ndarray
    floor_id: np.ndarray
    scores: np.ndarray = field(init=False)
    found: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.scores = np.full((len(self.ids), self.top), _LEAST)
        self.found = np.full((len(self.ids), self.top), _MOST)

    def wants(self, queries: np.ndarray, bounds: np.ndarray, least_id: np.ndarray) -> np.ndarray:
        """Whether a box that reaches up to `bounds`, of ids from `least_id` on, may hold an answer."""
        last, last_id = self.scores[queries, -1], self.found[queries, -1]
        ahead = (self.floor[queries] > last) | ((self.floor[queries] == last) & (self.floor_id[queries] < last_id))
        last, last_id = np.where(ahead, self.floor[queries], last), np.where(ahead, self.floor_id[queries], last_id)
        return (bounds > last) | ((bounds == last) & (least_id <= last_id))

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of a leaf's rows: one row for each query, one column for each id."""
        own = ids[None] == self.ids[queries][:, None]
        scores = np.where(own, _LEAST, scores)
        ids = np.where(own, _MOST, np.broadcast_to(ids, scores.shape))
        better = self.wants(queries, scores.max(axis=1), ids.min(axis=1))
        queries, scores, ids = queries[better], scores[better], ids[better]
        scores = np.concatenate([self.scores[queries], scores], axis=1)
        ids = np.concatenate([self.found[queries], ids], axis=1)
        best = np.lexsort((ids, -scores), axis=-1)[:, :self.top]
        self.scores[queries] = np.take_along_axis(scores, best, axis=1)
        self.found[queries] = np.take_along_axis(ids, best, axis=1)

    def search(self, tree: Tree) -> None:
        """Go down the boxes that may hold an answer, then through their leaves, for each query the best one first."""
        kind = _kind(tree.vectors, self.vectors)
        vectors, low, high = (x.astype(kind) for x in (tree.vectors, tree.low, tree.high))
        asked = self.vectors.astype(kind)
        up, down = np.maximum(asked, 0), np.minimum(asked, 0)
        leaves = [node for node, children in enumerate(tree.children) if children is None]
        column = {node: i for i, node in enumerate(leaves)}
        bounds = np.full((len(self.ids), len(leaves)), _LEAST)
        open_nodes = [(0, np.arange(len(self.ids)))]
        while open_nodes:
            node, queries = open_nodes.pop()
            reach = _whole(up[queries] @ high[node] + down[queries] @ low[node])
            wanted = self.wants(queries, reach, tree.least_id[node])
            queries = queries[wanted]
            if not len(queries):
                continue
            if tree.children[node] is None:
                bounds[queries, column[node]] = reach[wanted]
            else:
                open_nodes += [(child, queries) for child in tree.children[node]]
        order = np.argsort(-bounds, axis=1, kind="stable")
        queries = np.arange(len(self.ids))
        least_ids = tree.least_id[leaves]
        for turn in range(len(leaves)):
            leaf = order[queries, turn]
            reach = bounds[queries, leaf]
            queries, leaf, reach = (x[reach > _LEAST] for x in (queries, leaf, reach))
            # The next leaf may be left out for its ids alone, so only a lower bound ends a query's turns.
            wanted = self.wants(queries, reach, least_ids[leaf])
            going = self.wants(queries, reach, np.full(len(queries), _LEAST))
            by_leaf = np.argsort(leaf[wanted], kind="stable")
            some, which = queries[wanted][by_leaf], leaf[wanted][by_leaf]
            cuts = np.flatnonzero(np.diff(which)) + 1
            for group, at in zip(np.split(some, cuts), np.split(which, cuts)):
                if len(group):
                    begin, end = tree.spans[leaves[at[0]]]
                    self.add(group, _whole(asked[group] @ vectors[begin:end].T), tree.ids[begin:end])
            queries = queries[going]
            if not len(queries):
                break


def _searched(batches: Iterator[pa.RecordBatch], blocks: dict[int, tuple], top: int) -> Iterator[pa.RecordBatch]:
    """The best rows of a task for every query, tree by tree; what a tree finds bounds the search in the next."""
    answers = {width: Answers(*block[:3], top, *block[3:]) for width, block in blocks.items()}
    held: dict[int, list] = {width: [] for width in answers}

    def search(width: int) -> None:
        vectors, ids = (np.concatenate(x) for x in zip(*held[width]))
        held[width] = []
        answers[width].search(Tree.build(vectors, ids))

    for batch in batches:
        ids, lists = batch.column(0).to_numpy(), batch.column(1)
        widths, values, offsets = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(), lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        for width in np.unique(widths):
            if width not in answers:
                continue
            rows = np.flatnonzero(widths == width)
            step = max(LEAF_ROWS, SHARD_VALUES // max(1, int(width)))
            for begin in range(0, len(rows), step):
                part = rows[begin:begin + step]
                held[width].append((values[offsets[part][:, None] + np.arange(width)], ids[part]))
                if sum(len(x) for _, x in held[width]) >= step:
                    search(width)
    for width, own in answers.items():
        if held[width]:
            search(width)
        row, place = np.nonzero(own.found < _MOST)
        for begin in range(0, len(row), 1 << 16):
            r, p = row[begin:begin + (1 << 16)], place[begin:begin + (1 << 16)]
            yield pa.RecordBatch.from_arrays([
                pa.array(own.places[r]), pa.array(own.found[r, p]), pa.array(own.scores[r, p])], names=["query", "vec_id", "score"])


def whole_vector(vector: Column) -> Column:
    """Components as floor(1024 x); null if one is null, not finite, or beyond a long."""
    parts = F.transform(vector.cast("array<double>"), lambda x: x * SCALE)
    fits = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(1 << 63)))
    return F.when(fits, F.transform(parts, lambda x: F.floor(x).cast("bigint")))


def top_neighbours(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                   top: int = TOP) -> DataFrame:
    """The `top` vectors of highest inner product with each query, exactly: `query_id`, `rank` from 1, `vec_id`, `score`.

    Both tables have the id and vector columns. Components become floor(1024 x), so scores are whole numbers; equal
    scores go by the smaller id. Every vector is held against every query but for what the boxes rule out.

    Queries are numbered and taken in blocks of 2^22 components, which are sent to the executors; a table of any size is
    searched by as many passes. A task builds a KD-tree from each 2^18 components that it reads: split at the median
    of the widest side, with the tight box of the rows in each node. A query goes down the boxes whose best corner could
    beat its last place so far, then through the leaves from the best corner downwards until that is below its last
    place. Last places are carried from tree to tree, and on large tables from round to round: the first round searches
    a share of the rows, chosen by hash, and each further one sixteen times as many as before, until all are
    searched; so a task of a later round returns little besides true answers.

    Rows whose vector is null, or has null or non-finite components or such that no long can hold (a magnitude of
    2^53 or more), take no part, nor do rows without an id. Vectors of other lengths than the query are no candidates. Rows with
    the query's id are its own. Queries that repeat id and vector count once; of one id with two vectors each is
    ranked by itself. Scores beyond a long become the nearest long. Where there are fewer candidates all are returned.
    Other columns are ignored, and without rows or queries there are no rows.
    """
    spark = vectors.sparkSession
    taking_part = lambda df: df.select(
        F.col(id_col).cast("bigint").alias("vec_id"), whole_vector(F.col(vector_col)).alias("vector")).where(
        "vec_id IS NOT NULL AND vector IS NOT NULL")
    rows = materialise(taking_part(vectors))
    asked = materialise(dense_key(taking_part(queries).distinct(), "query", ["vec_id", "vector"]))
    count, widest = asked.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    step = max(1, QUERY_VALUES // max(1, widest or 1))
    # Shares of the hash buckets in which the rounds end.
    bounds, total = [_BUCKETS], rows.count()
    while total * bounds[0] // _BUCKETS // ROUND_GROWTH >= FIRST_ROUND_ROWS:
        bounds.insert(0, bounds[0] // ROUND_GROWTH)
    bucket = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(_BUCKETS))

    found = spark.createDataFrame([], _FOUND)
    for begin in range(1, (count or 0) + 1, step):
        block = asked.where(F.col("query").between(begin, begin + step - 1))
        best = spark.createDataFrame([], _FOUND)
        for low, high in zip([0, *bounds], bounds):
            part = rows if len(bounds) == 1 else rows.where((bucket >= low) & (bucket < high))
            best = _round(part, block, best, top, last=high == _BUCKETS)
        found = found.union(best)
    return _ranked(found, top).join(asked.select("query", F.col("vec_id").alias("query_id")), "query").select(
        "query_id", "rank", "vec_id", "score")


def _round(rows: DataFrame, block: DataFrame, best: DataFrame, top: int, last: bool) -> DataFrame:
    """Search some rows for a block of queries, beginning with the last places of the best so far."""
    known = best.where(F.col("rank") == top).select("query", "score", F.col("vec_id").alias("last_id")) if "rank" in best.columns else None
    asked = block if known is None else block.join(known, "query", "left")
    # Bounded by the block.
    frame = asked.select("query", "vec_id", "vector", *([] if known is None else ["score", "last_id"])).toArrow()
    lists = frame["vector"].combine_chunks()
    widths, values, offsets = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(), lists.offsets.to_numpy()
    offsets = offsets - offsets[0]
    floor = frame["score"].fill_null(_LEAST).to_numpy() if known is not None else np.full(len(widths), _LEAST)
    floor_id = frame["last_id"].fill_null(_MOST).to_numpy() if known is not None else np.full(len(widths), _MOST)
    places, ids = frame["query"].to_numpy(), frame["vec_id"].to_numpy()
    blocks = {}
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        blocks[width] = (places[own], ids[own], values[offsets[own][:, None] + np.arange(width)], floor[own], floor_id[own])
    sent = rows.sparkSession.sparkContext.broadcast(blocks)
    met = spread(rows).mapInArrow(lambda batches: _searched(batches, sent.value, top), _FOUND)
    found = materialise(met)
    found = best.select("query", "vec_id", "score").union(found)
    return found if last else materialise(_ranked(found, top))


def _ranked(found: DataFrame, top: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= top)
