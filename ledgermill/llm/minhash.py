"""Near-duplicate documents by fast similarity sketching, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialise
from .arrays import list_column, mix, seeds, shingle_sets
from .components import connected_components

COORDINATES = 512
BANDS = 64
_ROUND_SEEDS = seeds(2 * COORDINATES, 101)
_BIN_SHIFT = np.uint64(64 - 9)
_VALUE_BITS = np.uint64(53)
_VALUE_MASK = np.uint64((1 << 53) - 1)
_EMPTY = np.uint64((1 << 64) - 1)
_BAND_PLACES = seeds(COORDINATES, 211).reshape(BANDS, -1) | np.uint64(1)
_BAND_SALT = seeds(BANDS, 307)
# Expected number of hash values until every bin of a small set is filled, and a little more.
_ENOUGH = int(COORDINATES * np.log(COORDINATES) * 1.25)

_SKETCHED = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"

# Documents of a tile, and shingles that are counted at once.
TILE_ROWS = 512
_COLUMNS = 4096


def sketch(elements: np.ndarray) -> np.ndarray:
    """Fast similarity sketch of a non-empty set of 64-bit hashes.

    In each of the first t rounds every element is thrown into one of t bins; a bin keeps its smallest (round, hash).
    In round t + j every element goes to bin j, so each bin is filled after 2 t rounds at the latest. Rounds stop when
    all bins are filled, which takes about t log t hash values for small sets and one round for large ones. Several
    rounds are computed at once; later ones cannot replace what an earlier round put into a bin.
    """
    out = np.full(COORDINATES, _EMPTY)
    begin = 0
    while begin < COORDINATES:
        end = min(COORDINATES, begin + max(1, -(-_ENOUGH // len(elements))))
        thrown = mix(elements[None, :] ^ _ROUND_SEEDS[begin:end, None])
        rounds = np.arange(begin, end, dtype=np.uint64)[:, None] << _VALUE_BITS
        np.minimum.at(out, (thrown >> _BIN_SHIFT).astype(np.intp).ravel(), (rounds | (thrown & _VALUE_MASK)).ravel())
        if not (out == _EMPTY).any():
            return out
        begin = end
    for j in np.flatnonzero(out == _EMPTY):
        smallest = (mix(elements ^ _ROUND_SEEDS[COORDINATES + j]) & _VALUE_MASK).min()
        out[j] = np.uint64(COORDINATES + j) << _VALUE_BITS | smallest
    return out


def _sketched(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, sets in shingle_sets(batch.column(1), width):
            sizes = np.array([len(s) for s in sets], np.int64)
            sums = np.array([[s.sum(dtype=np.uint64), mix(s).sum(dtype=np.uint64)] for s in sets], np.uint64)
            sketches = np.zeros((len(sets), COORDINATES), np.uint64)
            for i, elements in enumerate(sets):
                if len(elements):
                    sketches[i] = sketch(elements)
            bands = (sketches.reshape(len(sets), BANDS, -1) * _BAND_PLACES).sum(axis=2, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(first, len(sets)), pa.array(sizes),
                pa.array(sums[:, 0].view(np.int64)), pa.array(sums[:, 1].copy().view(np.int64)),
                list_column(mix(bands + _BAND_SALT).view(np.int64)),
            ], names=["doc_id", "n_shingles", "set_a", "set_b", "bands"])


def _confirmed(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2), batch.column(3)
        if not batch.num_rows:
            continue
        step = max(1, int((1 << 20) * batch.num_rows / max(1, sum(t.nbytes for t in texts))))
        for begin in range(0, batch.num_rows, step):
            one, other = ([s for _, part in shingle_sets(t.slice(begin, step), width) for s in part] for t in texts)
            keep = []
            for left, right in zip(one, other):
                common = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(common > 0 and 100 * common >= percent * (len(left) + len(right) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).slice(begin, len(keep)).filter(pa.array(keep)) for i in (0, 1)], names=["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """Groups of documents whose sets of `width`-word shingles are alike.

    Two documents are linked if 100 * |A and B| >= `percent` * |A or B|. Returns for each row of `docs` its id (as
    `doc_id`), `n_shingles`, `component_id` (the smallest id that links reach, its own included) and `kept`
    (doc_id = component_id).

    Equal sets become one class, represented by its smallest id, so copies are never paired with each other. The
    sketches of the representatives are cut into 64 bands of 8 coordinates. In every band bucket all members are first
    held against the bucket's smallest id only; where that leaves a bucket with several components, its members are
    held against each other as well, in tiles. Every link is confirmed on the full shingle sets. A pair of similarity 0.8 shares a bucket with a probability of
    0.99999, one of 0.85 with more than 0.9999999. Use `percent` of 80 or more.

    Null and empty texts have no shingles and link with nothing. Rows without an id link with nothing, have a null
    component and are kept. Rows that repeat an id count as one document that has the links of each. Other columns
    are ignored, and no rows give no rows.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketched = materialise(docs.mapInArrow(lambda batches: _sketched(batches, width), _SKETCHED))
    usable = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ["set_a", "set_b", "n_shingles"]
    classes = materialise(usable.groupBy(*same).agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("members")))
    copies = usable.join(classes.where("members > 1"), same).where("doc_id != first").select(
        F.col("first").alias("a"), F.col("doc_id").alias("b"))

    heads = usable.join(classes.select(*same, F.col("first").alias("doc_id")), [*same, "doc_id"], "left_semi")
    buckets = heads.select("doc_id", F.explode("bands").alias("band"))
    # Sums of a bucket are small rows; only members of shared buckets are met again.
    shared = buckets.groupBy("band").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where(
        "first != last").select("band", "first")
    members = materialise(buckets.join(shared, "band").where("doc_id != first").distinct())
    # The ids grow with the corpus, so they are never broadcast; texts are shuffled once and only these go further.
    met = members.select("doc_id").union(members.select("first")).distinct()
    texts = materialise(docs.join(met.hint("merge"), "doc_id", "left_semi"))
    pairs = members.select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = materialise(_confirm(pairs, texts, width, percent))

    found = connected_components(links)
    grouped = materialise(members.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "band", "first", "doc_id", F.coalesce("component", "doc_id").alias("component")))
    mixed = grouped.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where(
        "low != high").select("band")
    left = materialise(grouped.join(mixed, "band", "left_semi").select("first", "doc_id", "component"))
    if not left.isEmpty():
        links = links.union(materialise(_among(left, texts, width, percent)))

    component = connected_components(links.union(copies)).withColumnRenamed("id", "doc_id")
    whole = F.coalesce("component", "doc_id")
    return sketched.select("doc_id", "n_shingles").join(component, "doc_id", "left").select(
        "doc_id", "n_shingles", whole.alias("component_id"),
        F.coalesce(F.col("doc_id") == whole, F.lit(True)).alias("kept"))


def _among(left: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between documents that share a bucket but not a component.

    Documents that buckets connect are cut into tiles, and every two tiles meet in one task, which counts the common
    shingles of all its pairs as a product of matrices. Pairs are never rows: a task returns one spanning link for
    each linked document.
    """
    around = connected_components(left, "first", "doc_id").select(F.col("id").alias("doc_id"), F.col("component").alias("cluster"))
    own = left.groupBy("doc_id").agg(F.min("component").alias("component"))
    sizes = around.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / TILE_ROWS).cast("int").alias("tiles"))
    placed = around.join(own, "doc_id", "left").join(sizes, "cluster").join(texts, "doc_id").select(
        "cluster", "doc_id", F.coalesce("component", "doc_id").alias("component"), "text",
        F.pmod(F.xxhash64("doc_id"), F.col("tiles")).cast("int").alias("tile"),
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    met = placed.select("cluster", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"),
                        "tile", "doc_id", "component", "text")
    return met.groupBy("cluster", "low", "high").applyInPandas(
        lambda key, frame: _spanning(key, frame, width, percent), "a bigint, b bigint")


def _spanning(key: tuple, frame: pd.DataFrame, width: int, percent: int) -> pd.DataFrame:
    sets = [s for _, part in shingle_sets(pa.array(frame["text"], pa.string()), width) for s in part]
    sides = [np.flatnonzero(frame["tile"] == t) for t in key[1:]]
    sizes = np.array([len(s) for s in sets])
    rows = [(np.repeat(np.arange(len(side)), sizes[side]), np.concatenate([np.empty(0, np.uint64), *(sets[i] for i in side)]))
            for side in sides]
    known = np.intersect1d(rows[0][1], rows[1][1])
    common = np.zeros((len(sides[0]), len(sides[1])), np.float32)
    placed = []
    for row, values in rows:
        at = np.searchsorted(known, values)
        have = at < len(known)
        have[have] = known[at[have]] == values[have]
        order = np.argsort(at[have], kind="stable")
        placed.append((row[have][order], at[have][order]))
    for begin in range(0, len(known), _COLUMNS):
        parts = []
        for (row, at), side in zip(placed, sides):
            span = slice(*np.searchsorted(at, (begin, begin + _COLUMNS)))
            part = np.zeros((len(side), min(_COLUMNS, len(known) - begin)), np.float32)
            part[row[span], at[span] - begin] = 1
            parts.append(part)
        common += parts[0] @ parts[1].T
    components = frame["component"].to_numpy()
    linked = (common > 0) & (100 * common >= percent * (sizes[sides[0]][:, None] + sizes[sides[1]][None] - common))
    linked &= components[sides[0]][:, None] != components[sides[1]][None]
    one, other = np.nonzero(linked)
    one, other = sides[0][one], sides[1][other]
    ids = frame["doc_id"].to_numpy()
    least = ids.copy()
    while len(one):
        low = np.minimum(least[one], least[other])
        if (low == least[one]).all() and (low == least[other]).all():
            break
        np.minimum.at(least, one, low)
        np.minimum.at(least, other, low)
    moved = least != ids
    return pd.DataFrame({"a": least[moved], "b": ids[moved]})


def _confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs of ids that are linked by their full sets."""
    both = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(
        lambda batches: _confirmed(batches, width, percent), "a bigint, b bigint")
