"""Toxicity of texts: a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialise
from .arrays import code_points, letter_table, seeds, text_pieces

# Labelled rows the classifier is fitted on, at most.
FIT_ROWS = 16_000
SIZES = (3, 4, 5)
_BITS = 20
_BLOCK = 1 << 14
_TASKS = 16
_PLACES = {n: (seeds(n, 400 + n) >> np.uint64(32)).astype(np.uint32) | np.uint32(1) for n in SIZES}

# An n-gram counts if at least so many fitted rows have it, its class counts differ from the expected ones by so many
# standard deviations, and its log-count ratio is at least this far from 0.
_LEAST_ROWS, _DEVIATIONS, _LEAST_RATIO = 5, 5.0, 0.4


@dataclass
class Classifier:
    """Weight of each hashed n-gram (its log-count ratio times what was learned), and the bias."""

    weights: np.ndarray
    bias: float


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters with 0 for all else, each row between two zeros, and where the rows begin."""
    points, offsets = code_points(data, offsets)
    sizes = np.diff(offsets)
    begins = offsets + 2 * np.arange(len(offsets))
    out = np.zeros(begins[-1], np.uint32)
    out[np.arange(len(points)) + np.repeat(2 * np.arange(len(sizes)) + 1, sizes)] = letter_table()[points]
    return out, begins


def _grams(letters: np.ndarray, n: int) -> np.ndarray:
    """Hash bucket of the n-gram at each place."""
    count = max(0, len(letters) - n + 1)
    total = np.zeros(count, np.uint32)
    for j in range(n):
        total += letters[j:j + count] * _PLACES[n][j]
    total ^= total >> np.uint32(15)
    total *= np.uint32(0x2C1B3C6D)
    return total >> np.uint32(32 - _BITS)


def _present(letters: np.ndarray, begins: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of each wanted n-gram that a row has, once."""
    found = []
    for n in SIZES:
        grams = _grams(letters, n)
        at = np.flatnonzero(wanted[grams])
        row = np.searchsorted(begins, at, "right") - 1
        inside = at + n <= begins[row + 1]
        found.append(row[inside] << _BITS | grams[at[inside]])
    both = np.unique(np.concatenate(found))
    return both >> _BITS, both & ((1 << _BITS) - 1)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many rows of each class have each n-gram, in blocks of buckets."""
    counts = np.zeros((2, 1 << _BITS), np.int32)
    every = np.ones(1 << _BITS, bool)
    for batch in batches:
        labels = batch.column(1).to_numpy(zero_copy_only=False).astype(int)
        for first, _, data, offsets in text_pieces(batch.column(0)):
            rows, grams = _present(*_padded(data, offsets), every)
            for label in (0, 1):
                counts[label] += np.bincount(grams[labels[first + rows] == label], minlength=1 << _BITS).astype(np.int32)
    blocks = range(0, 1 << _BITS, _BLOCK)
    yield pa.RecordBatch.from_arrays([
        pa.array([b // _BLOCK for b in blocks], pa.int32()),
        pa.array([counts[0, b:b + _BLOCK].tobytes() for b in blocks], pa.binary()),
        pa.array([counts[1, b:b + _BLOCK].tobytes() for b in blocks], pa.binary()),
    ], names=["block", "clean", "toxic"])


def _summed(blocks: pd.DataFrame) -> pd.DataFrame:
    add = lambda column: np.sum([np.frombuffer(x, np.int32) for x in column], axis=0, dtype=np.int32)
    return pd.DataFrame({"block": [int(blocks["block"].iloc[0])], "clean": [add(blocks["clean"]).tobytes()],
                         "toxic": [add(blocks["toxic"]).tobytes()]})


def _selected(batches: Iterator[pa.RecordBatch], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The wanted n-grams of each row."""
    for batch in batches:
        for first, last, data, offsets in text_pieces(batch.column(0)):
            rows, grams = _present(*_padded(data, offsets), wanted)
            ends = np.searchsorted(rows, np.arange(last - first + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(1).slice(first, last - first),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(grams.astype(np.int32))),
            ], names=["toxic", "grams"])


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", key_col: str = "doc_id",
        fit_rows: int = FIT_ROWS) -> Classifier:
    """Fit on at most `fit_rows` of the rows whose label is 0 or 1, the first in the order of their key's hash.

    Counts per n-gram and class are made on the executors and reach the driver as one table of fixed size; the rows
    reach it as lists of the selected n-grams. Rows without text count as empty. Without rows of both classes the
    classifier gives the share of the one class for every text.
    """
    rows = labelled.select(F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("int").alias("toxic"),
                           F.xxhash64(F.col(key_col).cast("string")).alias("place")).where("toxic IN (0, 1)")
    rows = materialise(rows.orderBy("place", "toxic").limit(fit_rows).repartition(_TASKS, "place").select("text", "toxic"))
    sums = rows.mapInArrow(_counted, "block int, clean binary, toxic binary").groupBy("block").applyInPandas(
        _summed, "block int, clean binary, toxic binary").toPandas().sort_values("block")
    size = dict(rows.groupBy("toxic").count().collect())
    positive, negative = size.get(1, 0), size.get(0, 0)
    weights = np.zeros(1 << _BITS, np.float32)
    total = positive + negative
    if not positive or not negative:
        share = (positive + 0.5) / (total + 1)
        return Classifier(weights, float(np.log(share / (1 - share))))
    clean, toxic = (np.frombuffer(b"".join(sums[c]), np.int32).astype(float) for c in ("clean", "toxic"))

    ratio = np.log((toxic + 1) / (positive + 2)) - np.log((clean + 1) / (negative + 2))
    seen = toxic + clean
    expected = seen * positive / total
    spread = np.sqrt(expected * (negative / total) * np.maximum(1 - seen / total, 1e-9)) + 1e-9
    wanted = (seen >= _LEAST_ROWS) & (np.abs(toxic - expected) >= _DEVIATIONS * spread) & (np.abs(ratio) >= _LEAST_RATIO)
    chosen = rows.mapInArrow(lambda batches: _selected(batches, wanted), "toxic int, grams array<int>").toPandas()

    place = np.cumsum(wanted) - 1
    sizes = chosen["grams"].map(len).to_numpy()
    columns = place[np.concatenate([*chosen["grams"], np.empty(0, int)]).astype(int)]
    learned, bias = _logistic(np.repeat(np.arange(len(chosen)), sizes), columns, ratio[wanted], chosen["toxic"].to_numpy(float))
    weights[wanted] = learned * ratio[wanted]
    return Classifier(weights, bias)


def _logistic(rows: np.ndarray, columns: np.ndarray, scale: np.ndarray, labels: np.ndarray,
              penalty: float = 1e-4, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression on presences times `scale`, by accelerated gradient steps."""
    n, features = len(labels), len(scale)
    prior = labels.mean()
    weights, bias = np.zeros(features), float(np.log(prior / (1 - prior)))
    if not len(rows):
        return weights, bias
    squares = np.bincount(rows, scale[columns] ** 2, n)
    rate = 4 / (squares.mean() + 1) / 4
    ahead, ahead_bias = weights, bias
    for step in range(steps):
        margin = np.bincount(rows, (ahead * scale)[columns], n) + ahead_bias
        gap = 1 / (1 + np.exp(-margin)) - labels
        slope = np.bincount(columns, gap[rows], features) * scale / n + penalty * ahead
        new, new_bias = ahead - rate * slope, ahead_bias - rate * gap.mean()
        keep = step / (step + 3)
        ahead, ahead_bias = new + keep * (new - weights), new_bias + keep * (new_bias - bias)
        weights, bias = new, new_bias
    return weights, float(bias)


def score(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id` and `score` (0 to 1) of every row, from its whole text.

    Null and empty texts get the score of a text without any known n-gram. Ids may be null or repeated: each row is
    scored on its own. Other columns are ignored.
    """
    wanted = model.weights != 0

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_pieces(batch.column(1)):
                rows, grams = _present(*_padded(data, offsets), wanted)
                margin = np.bincount(rows, model.weights[grams], last - first) + model.bias
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first), pa.array(1 / (1 + np.exp(-np.clip(margin, -50, 50)))),
                ], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        scored, "doc_id bigint, score double")
