"""Near-duplicate vectors by inverted lists, product codes of residuals and an exact rerank."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialise
from .components import connected_components

# Vectors the index is fitted on; every vector is indexed.
FIT_ROWS = 4096
# Vectors of one label a list should hold, and the lists of one level. Labels of more vectors than these lists hold get
# further levels.
LIST_ROWS, MOST_LISTS = 512, 256
# Rows of a list, and queries, that meet in one task.
TILE_ROWS = 1024
_PARTS, _CODES, _ROUNDS = 8, 128, 12

_KEYS = ["label", "width", "cell", "list_tile", "query_tile"]


@dataclass
class Index:
    """Centroids of the lists by levels, and for each part of a residual its code words.

    The first level's centroids divide all vectors. Those of each further level divide what the level before leaves of a
    vector, and are the same in all its lists, so the lists multiply from level to level while the fit stays small.
    """

    levels: list[np.ndarray]
    code_words: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int, most: int = MOST_LISTS) -> Index:
        if not len(sample):
            sample = np.zeros((1, sample.shape[1]))
        depth = 1
        while most ** depth < lists:
            depth += 1
        each = lists if depth == 1 else most
        levels, residuals = [], sample
        for _ in range(depth):
            levels.append(_means(residuals, each))
            residuals = residuals - levels[-1][_nearest(residuals, levels[-1])]
        parts = np.split(residuals, _PARTS, axis=1)
        return cls(levels, np.stack([_means(part, _CODES) for part in parts]))

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes, and the length of what the codes leave out."""
        cells, residuals = np.zeros(len(vectors), np.int64), vectors
        for centroids in self.levels:
            near = _nearest(residuals, centroids)
            cells, residuals = cells * len(centroids) + near, residuals - centroids[near]
        codes = np.stack([_nearest(part, words) for part, words in zip(
            np.split(residuals, _PARTS, axis=1), self.code_words)], axis=1)
        decoded = np.concatenate([words[codes[:, i]] for i, words in enumerate(self.code_words)], axis=1)
        return cells, codes.astype(np.uint8), np.linalg.norm(residuals - decoded, axis=1)

    def centre(self, cell: int) -> np.ndarray:
        total = np.zeros(self.levels[0].shape[1])
        for centroids in reversed(self.levels):
            cell, near = divmod(cell, len(centroids))
            total += centroids[near]
        return total

    def probes(self, vectors: np.ndarray, reach: float) -> list[np.ndarray]:
        """Which lists each vector must look into: those whose border with its own lies within `reach` on every level.

        Whatever lies within `reach` of a vector lies within `reach` of what a list's centroid leaves of it, too, so the
        rule of one level holds on all.
        """
        found = list(self._near(vectors, reach, 0))
        rows, cells = (np.concatenate(part) for part in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))
        return np.split(cells, np.searchsorted(rows, np.arange(1, len(vectors))))

    def _near(self, vectors: np.ndarray, reach: float, level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows, in their order, with the lists of this and the further levels."""
        centroids = self.levels[level]
        below = int(np.prod([len(c) for c in self.levels[level + 1:]], dtype=np.int64))
        between = np.sqrt(np.maximum(_squares(centroids, centroids), 0))
        for begin in range(0, len(vectors), 512):
            block = vectors[begin:begin + 512]
            squares = _squares(block, centroids)
            own = squares.argmin(1)
            with np.errstate(divide="ignore", invalid="ignore"):
                border = (squares - squares.min(1)[:, None]) / (2 * between[own])
            border[between[own] < 1e-6] = 0
            row, near = np.nonzero(border <= reach)
            if level + 1 == len(self.levels):
                yield begin + row, near.astype(np.int64)
                continue
            for inner, cells in self._near(block[row] - centroids[near], reach, level + 1):
                yield begin + row[inner], near[inner] * below + cells

    def distances(self, queries: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Distance of each query to each coded vector of a list, added up from tables."""
        total = np.zeros((len(queries), len(codes)), np.float32)
        for i, part in enumerate(np.split(queries - self.centre(cell), _PARTS, axis=1)):
            total += _squares(part, self.code_words[i]).astype(np.float32)[:, codes[:, i]]
        return np.sqrt(np.maximum(total, 0))


def _squares(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    return (rows ** 2).sum(1)[:, None] - 2 * rows @ points.T + (points ** 2).sum(1)[None]


def _nearest(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    return _squares(rows, points).argmin(1)


def _means(rows: np.ndarray, n: int) -> np.ndarray:
    """Cluster means, started from evenly spaced rows."""
    n = min(n, len(rows))
    means = rows[np.linspace(0, len(rows) - 1, n).astype(int)].copy()
    for _ in range(_ROUNDS):
        near = _nearest(rows, means)
        sizes = np.bincount(near, minlength=n)
        sums = np.zeros_like(means)
        np.add.at(sums, near, rows)
        means[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return means


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                           label_col: str = "label", threshold: float = 0.93, margin: float = 0.5,
                           fit_rows: int = FIT_ROWS) -> DataFrame:
    """Links between vectors of one label with a cosine of `threshold` or more, and their components.

    Returns for each row its id (as `vec_id`), `n_links` (other rows linked directly), `component_id` (the smallest id
    reachable by links, its own included) and `kept` (vec_id = component_id).

    Equal vectors of a label are one class that is searched once. The index is fitted on `fit_rows` unit vectors, in
    hash order; every vector is indexed. There is a list for every `LIST_ROWS` vectors of
    the largest label; beyond `MOST_LISTS` they are cut into levels. A vector is coded as its list and one code word for each eighth of its residual. Each vector is also a query: it looks into every list whose border with its own lies within `margin`
    times the link radius (1 loses no link whatever the data; a half is four standard deviations of a link in a random
    direction of 64 dimensions), adds up its distances from tables, keeps what lies within the link radius plus the
    coding error stored with each vector, which loses nothing, and confirms each by its cosine in double precision.
    Lists and queries are cut into tiles, so neither a large list nor a group of copies meets in one task, and a tile
    returns counts and a spanning set of links, never all pairs.

    Null labels or vectors, vectors without components, of zeros only, or with null or non-finite components link with
    nothing; so do vectors of different lengths. Rows without an id link with nothing, have a null component and are
    kept. Rows that repeat an id are vectors of their own and share a component. Other columns are ignored, and no
    rows give no rows.
    """
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.withColumn("usable", F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _measurable(F.col("vector")), F.lit(False)))
    rows = rows.withColumns({
        "class_id": F.when(F.col("usable"), F.xxhash64("label", "vector")),
        "check": F.when(F.col("usable"), F.xxhash64(F.lit(5), "vector", "label")),
    })
    same = ["class_id", "check"]
    classes = materialise(rows.where("usable").groupBy(*same, "label").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("members"), F.first("vector").alias("vector"))
        .withColumn("width", F.size("vector")))
    width = classes.agg(F.max("width")).first()[0] or 1
    width += -width % _PARTS
    largest = classes.groupBy("label", "width").count().agg(F.max("count")).first()[0] or 1
    sample = classes.orderBy("class_id", "check").limit(fit_rows).select("vector").toPandas()["vector"]
    index = Index.fit(_units(sample, width), -(-largest // LIST_ROWS), MOST_LISTS)
    radius = float(np.sqrt(2 - 2 * threshold)) + 1e-6

    coded = materialise(classes.select("class_id", "first", "members", "label", "width", "vector").mapInPandas(
        lambda frames: _encoded(frames, index, width, margin * radius),
        "class_id bigint, first bigint, members bigint, label string, width int, vector binary, codes binary, "
        "missing double, cell bigint, probed array<bigint>"))
    fresh = [F.col(c).alias(c) for c in ("class_id", "first", "members", "label", "width", "vector")]  # for the cogroup
    queries = coded.select(*fresh, F.col("cell").alias("home"), F.explode("probed").alias("cell"))
    place = ["label", "width", "cell"]
    tiles = lambda df, name: df.groupBy(*place).agg(
        F.ceil(F.count(F.lit(1)) / TILE_ROWS).cast("int").alias(name))
    counts = materialise(tiles(coded, "list_tiles").join(tiles(queries, "query_tiles"), place))
    own, others = F.pmod("class_id", F.col("list_tiles")), F.pmod("class_id", F.col("query_tiles"))
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    listed = coded.join(counts, place).withColumn("list_tile", own.cast("int")).withColumn(
        "query_tile", every("query_tiles")).drop("list_tiles", "query_tiles")
    asked = queries.join(counts, place).withColumn("query_tile", others.cast("int")).withColumn(
        "list_tile", every("list_tiles")).drop("list_tiles", "query_tiles")
    met = materialise(asked.groupBy(*_KEYS).cogroup(listed.groupBy(*_KEYS)).applyInPandas(
        lambda key, left, right: _linked(key, left, right, index, threshold, radius),
        "class_id bigint, first bigint, links bigint, root bigint"))

    links = met.groupBy("class_id").agg(F.sum("links").alias("links"))
    near = met.where("first != root").select(F.col("first").alias("a"), F.col("root").alias("b"))
    copies = rows.join(classes.where("members > 1").select(*same, "first"), same).select(
        F.col("first").alias("a"), F.col("vec_id").alias("b"))
    component = connected_components(near.union(copies)).withColumnRenamed("id", "vec_id")
    whole = F.coalesce("component", "vec_id")
    return (
        rows.select("vec_id", *same).join(classes.select(*same, "members"), same, "left")
        .join(links, "class_id", "left").join(component, "vec_id", "left")
        .select("vec_id", (F.coalesce(F.col("members") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).alias("n_links"),
                whole.alias("component_id"), F.coalesce(F.col("vec_id") == whole, F.lit(True)).alias("kept")))


def _measurable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _units(vectors: pd.Series, width: int) -> np.ndarray:
    """Unit vectors, filled up with zeros to `width`."""
    out = np.zeros((len(vectors), width))
    for i, vector in enumerate(vectors):
        out[i, :len(vector)] = vector
    out /= np.abs(out).max(axis=1, keepdims=True, initial=1e-300)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _encoded(frames: Iterator[pd.DataFrame], index: Index, width: int, reach: float) -> Iterator[pd.DataFrame]:
    for whole in frames:
        for begin in range(0, len(whole), 2048):
            frame = whole.iloc[begin:begin + 2048]
            units = _units(frame["vector"], width)
            cells, codes, missing = index.encode(units)
            yield frame.assign(
                vector=[u.tobytes() for u in units], codes=[c.tobytes() for c in codes], missing=missing, cell=cells,
                probed=index.probes(units, reach))


def _linked(key: tuple, queries: pd.DataFrame, listed: pd.DataFrame, index: Index, threshold: float,
            radius: float) -> pd.DataFrame:
    if not len(queries) or not len(listed):
        return pd.DataFrame({c: pd.Series([], dtype="int64") for c in ("class_id", "first", "links", "root")})
    read = lambda column, kind: np.frombuffer(b"".join(column), kind).reshape(len(column), -1)
    asked, units, codes = read(queries["vector"], float), read(listed["vector"], float), read(listed["codes"], np.uint8)
    near = index.distances(asked, int(key[2]), codes) <= radius + listed["missing"].to_numpy()[None] + 1e-4
    near &= queries["class_id"].to_numpy()[:, None] != listed["class_id"].to_numpy()[None]
    q, x = np.nonzero(near)
    hit = np.concatenate([np.einsum("ij,ij->i", asked[q[i:i + 65536]], units[x[i:i + 65536]]) >= threshold
                          for i in range(0, len(q), 65536)] or [np.zeros(0, bool)])
    q, x = q[hit], x[hit]
    links = np.bincount(q, listed["members"].to_numpy()[x], len(queries)).astype("int64")
    # A listed vector that does not look into the list of the one that asks never finds it, so the link counts here for both.
    homes, home = np.unique(queries["home"].to_numpy(), return_inverse=True)
    looks = np.zeros((len(listed), len(homes)), bool)
    for row, lists in enumerate(listed["probed"]):
        looks[row] = np.isin(homes, lists)
    unseen = ~looks[x, home[q]]
    back = np.bincount(x[unseen], queries["members"].to_numpy()[q[unseen]], len(listed)).astype("int64")
    left, right = queries["first"].to_numpy().copy(), listed["first"].to_numpy().copy()
    while len(q):
        least = np.minimum(left[q], right[x])
        if (least == left[q]).all() and (least == right[x]).all():
            break
        np.minimum.at(left, q, least)
        np.minimum.at(right, x, least)
    used = np.zeros(len(listed), bool)
    used[x] = True
    some = links > 0
    return pd.concat([
        pd.DataFrame({"class_id": queries["class_id"][some], "first": queries["first"][some], "links": links[some],
                      "root": left[some]}),
        pd.DataFrame({"class_id": listed["class_id"][used], "first": listed["first"][used], "links": back[used],
                      "root": right[used]}),
    ])
